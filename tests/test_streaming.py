"""Streams over several micro-batches must equal the batch operators."""

import datetime as dt
import random

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac.operators.monitoring import metric_windows
from tarmac.operators.tables import read_table
from tarmac.operators.dedupe import latest_aircraft
from tarmac.operators.landings import day_tails, landing_events
from tarmac.plans.flights import mapped_callsigns
from tarmac.plans.silver import StateTables, silver_aircraft_state, unique_states
from tarmac.sources.payload import accepted, parse_messages
from tarmac.streaming import ingest
from tarmac.streaming import states as st

RUN = dt.datetime(2024, 2, 1)
T0 = dt.datetime(2024, 1, 10)
REPORT = ("icao24 string, callsign string, origin_country string, event_ts timestamp, longitude double, latitude double, "
          "baro_altitude_m double, geo_altitude_m double, on_ground boolean, velocity_mps double, true_track_deg double, "
          "vertical_rate_mps double, squawk string, position_source int, bronze_loaded_at timestamp")


def report(icao, minutes, ground, velocity, loaded=0):
    at = T0 + dt.timedelta(minutes=minutes)
    return (icao, None, None, at, 0.0, 0.0, None, None, ground, velocity, None, None, None, 0,
            RUN + dt.timedelta(seconds=loaded))


@pytest.fixture(scope="module")
def batches():
    """Four hours of reports in arrival order, with late ones and replays."""
    rng = random.Random(5)
    everything = [
        report(f"a{rng.randrange(6)}", minute, rng.random() < 0.4, rng.choice([None, 10.0, 80.0]), minute)
        for minute in rng.sample(range(600), 400)
    ]
    everything.sort(key=lambda r: r[3] + dt.timedelta(minutes=rng.uniform(0, 50)))
    cut = [everything[i::1][:100] for i in (0, 100, 200, 300)]
    cut[1] += cut[0][:10]
    cut[3] += cut[2][-10:]
    return cut


def write_files(spark, path, batches, schema):
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, schema).coalesce(1)
        frame.write.mode("append").parquet(f"{path}/part{i}")
    return f"{path}/*"


def run(spark, stream, tmp_path, name):
    ingest.available_now(st.append_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_dedupe_equals_batch(spark, tmp_path, batches):
    source = write_files(spark, str(tmp_path / "in"), batches, REPORT)
    stream = ingest.file_stream(spark, source, REPORT, files_per_trigger=1)
    got = run(spark, st.dedupe_stream(stream, "2 hours").select("icao24", "event_ts"), tmp_path, "out")
    whole = spark.createDataFrame([r for b in batches for r in b], REPORT)
    assert rows(got) == rows(unique_states(whole), "icao24", "event_ts")


def test_latest_copies_equal_batch_up_to_the_watermark(spark, tmp_path, batches):
    changed = [b + [r[:8] + (not r[8],) + r[9:14] + (RUN + dt.timedelta(days=1),) for r in b[:5]] for b in batches]
    source = write_files(spark, str(tmp_path / "in"), changed, REPORT)
    stream = ingest.file_stream(spark, source, REPORT, files_per_trigger=1)
    got = run(spark, st.latest_stream(stream, "2 hours"), tmp_path, "out")
    whole = spark.createDataFrame([r for b in changed for r in b], REPORT)
    mark = max(r[3] for b in changed for r in b) - dt.timedelta(hours=2)
    assert rows(got) == rows(unique_states(whole).filter(F.col("event_ts") <= F.lit(mark)))


def test_landings_equal_batch_up_to_the_watermark(spark, tmp_path, batches):
    st.with_state_store(spark)
    source = write_files(spark, str(tmp_path / "in"), batches, REPORT)
    stream = ingest.file_stream(spark, source, REPORT, files_per_trigger=1)
    got = run(spark, st.landings_stream(stream, "2 hours"), tmp_path, "out")
    whole = spark.createDataFrame([r for b in batches for r in b], REPORT)
    mark = max(r[3] for b in batches for r in b) - dt.timedelta(hours=2)
    expected = landing_events(unique_states(whole)).filter(F.col("live_landing_ts") <= F.lit(mark))
    names = ["icao24", "live_landing_ts", "approach_velocity_mps"]
    assert rows(got, *names) == rows(expected, *names)
    assert expected.count() > 20


def test_landings_across_days_with_state_that_does_not_grow(spark, tmp_path):
    """Thirty days: landings at midnight are found, a busy airframe has many keys, and closed days leave no state."""
    st.with_state_store(spark)
    rng = random.Random(9)
    days = []
    for day in range(30):
        some = [report(f"a{rng.randrange(3)}", day * 1440 + m, rng.random() < 0.5, rng.choice([None, 10.0, 80.0]))
                for m in rng.sample(range(1440), 12)]
        some += [report("hot", day * 1440 + m, m < 200, 90.0) for m in (0, 100, 700, 1439)]  # lands at each midnight
        days.append(some)
    files = [sum(days[i:i + 3], []) for i in range(0, 30, 3)]
    for f in files:
        rng.shuffle(f)
    source = write_files(spark, str(tmp_path / "in"), files, REPORT)
    stream = st.landings_stream(ingest.file_stream(spark, source, REPORT, files_per_trigger=1), "2 hours")
    query = st.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "out-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    whole = spark.createDataFrame([r for f in files for r in f], REPORT)
    mark = max(r[3] for f in files for r in f) - dt.timedelta(hours=2)
    expected = landing_events(unique_states(whole)).filter(F.col("live_landing_ts") <= F.lit(mark))
    names = ["icao24", "live_landing_ts", "approach_velocity_mps"]
    assert rows(got, *names) == rows(expected, *names)
    assert got.filter("icao24 = 'hot'").count() == 29
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert len(held) >= 10 and max(held[-4:]) <= 1.5 * max(held[2:6])


def test_landings_of_many_airframes_in_few_groups(spark, tmp_path):
    """Calls and state of the keyed operator go by groups of airframes; unknown ids, speeds and places are as in the batch rule."""
    st.with_state_store(spark)
    rng = random.Random(4)
    reports = [report(f"b{i}", rng.randrange(4 * 1440), rng.random() < 0.5, rng.choice([None, 10.0, 80.0]))
               for i in range(2500) for _ in range(3)]
    reports += [report(None, m, rng.choice([None, True, False]), 90.0) for m in range(0, 5600, 50)]
    reports += [report("hot", m, rng.choice([None, True, False]), rng.choice([None, 31.0])) for m in range(5600)]
    reports.sort(key=lambda r: r[3] + dt.timedelta(minutes=rng.uniform(0, 100)))
    files = [reports[i:i + 3300] for i in range(0, len(reports), 3300)]
    source = write_files(spark, str(tmp_path / "in"), files, REPORT)
    stream = st.landings_stream(ingest.file_stream(spark, source, REPORT, files_per_trigger=1), "2 hours")
    query = st.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "out-checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    mark = max(r[3] for r in reports) - dt.timedelta(hours=2)
    expected = landing_events(unique_states(spark.createDataFrame(reports, REPORT))).filter(F.col("live_landing_ts") <= F.lit(mark))
    names = ["icao24", "live_landing_ts", "approach_velocity_mps"]
    assert rows(got, *names) == rows(expected, *names)
    assert got.filter("icao24 is null").count() > 5 and got.filter("icao24 like 'b%'").count() > 300
    keyed = [o for p in query.recentProgress for o in p["stateOperators"] if "transformWithState" in o["operatorName"]]
    assert 0 < max(o["numRowsTotal"] for o in keyed) < 2500 / 2


def test_windows_equal_batch_up_to_the_watermark(spark, tmp_path):
    schema = "metric_name string, value double, ts timestamp"
    rng = random.Random(2)
    data = [[("m", float(rng.randrange(9)), T0 + dt.timedelta(minutes=60 * b + rng.randrange(-50, 60)))
             for _ in range(30)] for b in range(4)]
    source = write_files(spark, str(tmp_path / "in"), data, schema)
    stream = ingest.file_stream(spark, source, schema, files_per_trigger=1)
    got = run(spark, st.windows_stream(stream, 300, "2 hours", "metric_name"), tmp_path, "out")
    whole = metric_windows(spark.createDataFrame([r for b in data for r in b], schema), 300, "metric_name")
    mark = max(r[2] for b in data for r in b) - dt.timedelta(hours=2)
    assert rows(got) == rows(whole.filter(F.col("window_end") <= F.lit(mark)))


MESSAGES = [
    [("a", '{"icao24":"a","event_ts":1}'), ("b", "junk")],
    [("c", '{"icao24":"c","event_ts":"x"}'), ("d", '{"icao24":"d","event_ts":2,"velocity":1.5,"more":1}')],
    [("e", '{"event_ts":3}')],
]


def test_roll_routes_counts_and_survives_replay(spark, tmp_path):
    schema = "key string, value string"
    source = write_files(spark, str(tmp_path / "in"), MESSAGES, schema)
    bronze, dead, metrics = (str(tmp_path / n) for n in ("bronze", "dead", "metrics"))

    def roll():
        stream = ingest.file_stream(spark, source, schema, files_per_trigger=1)
        return ingest.roll_to_bronze(stream, bronze, dead, metrics, str(tmp_path / "checkpoint"))

    ingest.available_now(roll())
    whole = spark.createDataFrame([m for b in MESSAGES for m in b], schema)
    landed = spark.read.parquet(bronze)
    assert rows(landed.drop("ds", "hr", "batch")) == rows(accepted(parse_messages(whole)))
    assert {"ds", "hr"} <= set(landed.columns)
    assert rows(spark.read.parquet(dead), "key", "value", "reject") == [
        ("b", "junk", "unparseable"), ("c", MESSAGES[1][0][1], "unparseable"), ("e", '{"event_ts":3}', "missing_key")]
    totals = spark.read.parquet(metrics).groupBy("metric_name").agg(F.sum("value"))
    assert rows(totals) == [("MessagesDLQ", 3.0), ("RowsFlushed", 2.0)]

    # The last batch was written but its commit was lost: it runs again.
    (tmp_path / "checkpoint" / "commits" / "2").unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    ingest.available_now(roll())
    assert spark.read.parquet(bronze).count() == 2
    assert spark.read.parquet(dead).count() == 3
    assert rows(spark.read.parquet(metrics).groupBy("metric_name").agg(F.sum("value"))) == rows(totals)


def test_failed_flush_is_counted_and_not_committed(spark, tmp_path):
    schema = "key string, value string"
    source = write_files(spark, str(tmp_path / "in"), MESSAGES[:1], schema)
    (tmp_path / "blocked").write_text("a file where a folder should be")
    stream = ingest.file_stream(spark, source, schema)
    with pytest.raises(Exception):
        ingest.available_now(ingest.roll_to_bronze(
            stream, str(tmp_path / "bronze"), str(tmp_path / "blocked" / "dead"), str(tmp_path / "metrics"),
            str(tmp_path / "checkpoint")))
    assert rows(spark.read.parquet(str(tmp_path / "metrics")), "metric_name", "value") == [
        ("ConsumerError", 1.0), ("FlushError", 1.0)]
    ingest.available_now(ingest.roll_to_bronze(
        stream, str(tmp_path / "bronze"), str(tmp_path / "dead"), str(tmp_path / "metrics"),
        str(tmp_path / "checkpoint")))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 1
    assert rows(spark.read.parquet(str(tmp_path / "metrics")), "metric_name", "value") == [
        ("ConsumerError", 1.0), ("FlushError", 1.0), ("MessagesDLQ", 1.0), ("RowsFlushed", 1.0)]


def test_publish_counts_messages(spark, tmp_path):
    schema = "key string, value string"
    source = write_files(spark, str(tmp_path / "in"), MESSAGES, schema)
    stream = ingest.file_stream(spark, source, schema, files_per_trigger=1)
    ingest.available_now(ingest.publish(
        stream, "parquet", str(tmp_path / "checkpoint"), str(tmp_path / "metrics"), path=str(tmp_path / "topic")))
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 5
    assert rows(spark.read.parquet(str(tmp_path / "metrics")), "metric_name", "value", "component") == [
        ("MessagesPublished", 1.0, "producer")] + [("MessagesPublished", 2.0, "producer")] * 2


def test_merge_stream_equals_batch_and_resumes(spark, tmp_path, batches):
    silver, checkpoint = StateTables.below(str(tmp_path / "silver")), str(tmp_path / "checkpoint")
    folder = str(tmp_path / "in")

    def refresh():
        stream = ingest.file_stream(spark, f"{folder}/*", REPORT, files_per_trigger=1)
        ingest.available_now(st.merge_stream(stream, silver, checkpoint, RUN))

    write_files(spark, folder, batches[:2], REPORT)
    refresh()
    refresh()
    for i, batch in enumerate(batches[2:]):
        spark.createDataFrame(batch, REPORT).coalesce(1).write.parquet(f"{folder}/late{i}")
    refresh()
    whole = spark.createDataFrame([r for b in batches for r in b], REPORT)
    names = ["icao24", "event_ts", "on_ground", "velocity_mps", "bronze_loaded_at"]
    assert rows(read_table(spark, silver.states), *names) == rows(silver_aircraft_state(whole, RUN), *names)
    seen = latest_aircraft(mapped_callsigns(whole, None))
    assert rows(spark.read.parquet(silver.sightings).drop("event_ts")) == rows(seen)
    days = day_tails(read_table(spark, silver.states))
    assert rows(spark.read.parquet(silver.tails), *days.columns) == rows(days)
