"""Alarms on streams, and what streams would lose behind the watermark."""

import datetime as dt
import json
import random

import pytest
from comparing import rows
from pyspark.sql import functions as F
from test_streaming import REPORT, RUN, T0, report, run, write_files

from tarmac.operators.landings import landing_events
from tarmac.operators.monitoring import Alarm, evaluate_alarm
from tarmac.plans.silver import StateTables, unique_states
from tarmac.streaming import alarms, ingest, late
from tarmac.streaming import states as st

POINT = "metric_name string, component string, value double, ts timestamp"
WATCHED = [
    Alarm("silent", "sent", "producer", 60, 2, 1, comparison="less", missing_breaches=True),
    Alarm("errors", "error", None, 300, 3, 5),
    Alarm("peak", "lag", "consumer", 180, 1, 30, statistic="max"),
    Alarm("unheard", "never", None, 120, 2, 1, comparison="less", missing_breaches=True),
]


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def judged(spark, tmp_path_factory):
    """Five batches of ten minutes; the producer stops after 25 minutes, all others after 35, ticks go on."""
    tmp = tmp_path_factory.mktemp("alarms")
    st.with_state_store(spark)
    rng = random.Random(3)
    batches = []
    for b in range(5):
        moments = [b * 600 + rng.randrange(-60 if b else 0, 600) for _ in range(60)]
        batch = [(rng.choice(["error", "lag"]), rng.choice(["producer", "consumer", None]),
                  rng.choice([None, 1.0, 2.0, 31.0]), at(m)) for m in moments if m < 2100]
        batch += [("sent", "producer", 1.0, at(m)) for m in range(b * 600, b * 600 + 600, 20) if m < 1500]
        batches.append(batch + [("clock", None, None, at(b * 600 + 599)), ("error", None, 9.0, None)])
    source = write_files(spark, str(tmp / "in"), batches, POINT)
    stream = ingest.file_stream(spark, source, POINT, files_per_trigger=1)
    ticks = stream.filter("metric_name = 'clock'").select("ts")
    got = run(spark, alarms.alarms_stream(stream, ticks, T0, WATCHED, "90 seconds"), tmp, "out")
    return got, spark.createDataFrame([r for b in batches for r in b], POINT)


def test_alarms_of_a_stream_equal_the_batch_rule(judged):
    got, points = judged
    mark = at(2999 - 90)
    for alarm in WATCHED:
        end = at((2999 - 90) // alarm.period_seconds * alarm.period_seconds)
        expected = evaluate_alarm(points, alarm, T0, end)
        names = ["window_start", "value", "breach", "state"]
        mine = got.filter(F.col("alarm") == alarm.name)
        assert rows(mine, *names) == rows(expected, *names), alarm.name
        assert mine.agg(F.max("window_start")).first()[0] + dt.timedelta(seconds=alarm.period_seconds) <= mark


def test_silence_raises_an_alarm_once(judged):
    got, _ = judged
    raised = rows(got.filter("alarm = 'silent' and changed"), "window_start", "state")
    assert raised == [(at(1560), "ALARM")]  # two minutes after the last point, and no all-clear
    assert rows(got.filter("alarm = 'unheard' and changed"), "window_start") == [(at(120),)]
    assert got.filter("alarm = 'unheard' and value is not null").count() == 0


def test_windows_must_start_on_a_border(spark):
    with pytest.raises(ValueError, match="errors"):
        alarms.alarms_stream(None, None, at(60), WATCHED)


def test_clock_ticks(spark, tmp_path):
    query = st.append_stream(alarms.clock(spark, 1), str(tmp_path / "out"), str(tmp_path / "check")).start()
    try:
        query.awaitTermination(6)
    finally:
        query.stop()
    assert spark.read.schema("ts timestamp").parquet(str(tmp_path / "out")).count() > 0


@pytest.fixture(scope="module")
def arrivals():
    """Twelve days in six files; a third of the reports comes one to three files late."""
    rng = random.Random(11)
    files = [[] for _ in range(6)]
    for minute in rng.sample(range(12 * 1440), 700):
        r = report(f"a{rng.randrange(5)}", minute, rng.random() < 0.4, rng.choice([None, 10.0, 80.0]), minute)
        files[min(5, minute // 2880 + (rng.randrange(1, 4) if rng.random() < 0.33 else 0))].append(r)
    return files


def split(spark, source, folders, checkpoint):
    stream = ingest.file_stream(spark, source, REPORT, files_per_trigger=1)
    ingest.available_now(late.split_late(stream, folders, checkpoint, "12 hours"))


def test_rows_in_are_timely_and_late_rows(spark, tmp_path, arrivals):
    source = write_files(spark, str(tmp_path / "in"), arrivals, REPORT)
    folders = late.LateFolders.below(str(tmp_path))
    split(spark, source, folders, str(tmp_path / "check"))
    mark, expected = None, []
    for i, batch in enumerate(arrivals):
        behind = sum(mark is not None and r[3] <= mark - dt.timedelta(hours=12) for r in batch)
        expected.append((i, len(batch), len(batch) - behind, behind))
        mark = max([r[3] for r in batch] + ([mark] if mark else []))
    assert rows(late.late_counts(spark, folders)) == expected and sum(e[3] for e in expected) > 50
    timely = spark.read.parquet(folders.timely).drop("batch")
    behind = spark.read.parquet(folders.late).select(*timely.columns)
    assert rows(timely.unionByName(behind)) == rows(spark.createDataFrame([r for b in arrivals for r in b], REPORT))
    assert set(late.late_days(spark, folders)) == {r.d for r in behind.select(F.to_date("event_ts").alias("d")).collect()}

    shown, lost = rows(timely), behind.count()

    # A batch whose commit was lost is split as before, shown once, and counted once.
    for name in ("commits/5", "commits/.5.crc"):
        (tmp_path / "check" / name).unlink(missing_ok=True)
    split(spark, source, folders, str(tmp_path / "check"))
    assert rows(late.late_counts(spark, folders)) == expected
    assert rows(spark.read.parquet(folders.timely).drop("batch")) == shown
    assert spark.read.parquet(folders.late).count() == lost


def test_a_note_that_is_missing_stops_the_split(spark, tmp_path, arrivals):
    source = write_files(spark, str(tmp_path / "in"), arrivals[:2], REPORT)
    folders = late.LateFolders.below(str(tmp_path))
    split(spark, source, folders, str(tmp_path / "check"))
    for name in ("check/commits/1", "check/commits/.1.crc", "notes/0"):
        (tmp_path / name).unlink(missing_ok=True)
    with pytest.raises(Exception, match="no note"):
        split(spark, source, folders, str(tmp_path / "check"))


def test_split_keeps_no_batch_in_memory(spark, tmp_path, arrivals, monkeypatch):
    folders, kept, renamed = late.LateFolders.below(str(tmp_path)), [], late.files.rename
    before = spark.sparkContext._jsc.getPersistentRDDs().size()

    def rename(session, source, target):
        kept.append(session.sparkContext._jsc.getPersistentRDDs().size())
        renamed(session, source, target)

    monkeypatch.setattr(late.files, "rename", rename)
    split(spark, write_files(spark, str(tmp_path / "in"), arrivals, REPORT), folders, str(tmp_path / "check"))
    assert len(kept) >= len(arrivals) and max(kept) <= before


def test_backfill_looks_up_touched_days_once(spark, tmp_path, arrivals, monkeypatch):
    folders, tables = late.LateFolders.below(str(tmp_path)), StateTables.below(str(tmp_path / "silver"))
    split(spark, write_files(spark, str(tmp_path / "in"), arrivals, REPORT), folders, str(tmp_path / "check"))
    ingest.available_now(st.merge_stream(late.timely_stream(spark, folders, REPORT), tables, str(tmp_path / "merge"), RUN))
    runs, chained = spark.sparkContext.accumulator(0), late._next_days

    def counted(rows):
        runs.add(1)
        return rows

    def next_days(*given):
        chain = chained(*given).coalesce(1)
        return chain.mapInPandas(counted, chain.schema)

    monkeypatch.setattr(late, "_next_days", next_days)
    assert late.backfill_landings(spark, folders, tables, str(tmp_path / "corrected"), RUN, dt.date(2024, 1, 30))
    assert runs.value == 1


def test_backfill_of_listed_days_gives_the_whole_result(spark, tmp_path, arrivals):
    st.with_state_store(spark)
    folders, tables = late.LateFolders.below(str(tmp_path)), StateTables.below(str(tmp_path / "silver"))
    corrected, names = str(tmp_path / "corrected"), ["icao24", "live_landing_ts", "approach_velocity_mps"]
    split(spark, write_files(spark, str(tmp_path / "in"), arrivals, REPORT), folders, str(tmp_path / "check"))
    timely = late.timely_stream(spark, folders, REPORT)
    ingest.available_now(st.merge_stream(timely, tables, str(tmp_path / "merge"), RUN))
    got = run(spark, st.landings_stream(timely, "12 hours"), tmp_path, "out")
    whole = [r for b in arrivals for r in b]
    mark = max(r[3] for r in whole) - dt.timedelta(hours=12)
    expected = landing_events(unique_states(spark.createDataFrame(whole, REPORT))).filter(F.col("live_landing_ts") <= F.lit(mark))
    assert rows(got, *names) != rows(expected, *names)

    # Late days that reach into an open day stay on the list.
    early = mark.date() - dt.timedelta(days=5)
    late.backfill_landings(spark, folders, tables, corrected, RUN, early)
    assert any(day < early for day in late.late_days(spark, folders, corrected))

    closed = mark.date()
    remade = late.backfill_landings(spark, folders, tables, corrected, RUN, closed)
    assert remade and max(remade) < closed
    before = F.col("live_landing_ts") < F.lit(closed).cast("timestamp")
    served = late.landings_served(spark, got, corrected)
    assert rows(served.filter(before), *names) == rows(expected.filter(before), *names)

    # Repeated, also with nothing but the notes of what was seen lost, it gives the same.
    for note in (tmp_path / "corrected" / "_seen").glob("20*"):
        assert json.loads(note.read_text())
        note.unlink()
    late.backfill_landings(spark, folders, tables, corrected, RUN, closed)
    again = late.landings_served(spark, got, corrected)
    assert rows(again.filter(before), *names) == rows(expected.filter(before), *names)
    late.backfill_landings(spark, folders, tables, corrected, RUN, dt.date(2025, 1, 1), patience_days=0)
    assert not late.late_days(spark, folders, corrected)
    assert late.backfill_landings(spark, folders, tables, corrected, RUN, dt.date(2025, 1, 1)) == []
