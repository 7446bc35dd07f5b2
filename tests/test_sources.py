import datetime as dt
import json
import zipfile

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac.operators.drift import append_drift, drift_rows, read_drift_log, schema_drift, unreviewed_drift, unreviewed_drift_count
from tarmac.operators.staging import stg_flights
from tarmac.schemas import FLIGHTS_RAW_COLUMNS
from tarmac.sources import archives, bronze, payload

RUN = dt.datetime(2024, 2, 1)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_headers_may_differ_within_a_month(spark, tmp_path):
    folder = tmp_path / "ds=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("Origin,Dest\nJFK,LAX\n")
    (folder / "b.csv").write_text("Dest,Origin,More\nSFO,BOS,x\n")
    got = bronze.read_csv_bronze(spark, str(tmp_path))
    assert rows(got, "Origin", "Dest", "More") == [("BOS", "SFO", "x"), ("JFK", "LAX", None)]


def test_reference_lists_with_a_header(spark, tmp_path):
    folder = tmp_path / "ds=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "airlines.csv").write_text('airline_id,name,alias,iata,icao,callsign,country,active\n1,"A, B",,AB,,,,Y\n')
    assert bronze.read_airlines(spark, str(tmp_path)).count() == 1
    (folder / "airlines.csv").write_text('1,"A, B",,AB,,,,Y\n-1,U,,,,,,N\n')
    assert bronze.read_airlines(spark, str(tmp_path)).count() == 2


def test_csv_headers_may_differ_between_months(spark, tmp_path):
    write(tmp_path / "ds=2024-01-01" / "raw.csv",
          "FlightDate,Reporting_Airline,Flight_Number_Reporting_Airline,DivAirportLandings\n2024-01-05,AA,1,1.00\n")
    write(tmp_path / "ds=2024-02-01" / "raw.csv",
          'Reporting_Airline,FlightDate,Div_Airport_Landings,Flight_Number_Reporting_Airline\n"DL",2024-02-05,2.00,7\n')
    raw = bronze.read_csv_bronze(spark, str(tmp_path))
    got = stg_flights(raw)
    assert rows(got, "carrier_code", "flight_date", "flight_number", "div_airport_landings", "flight_date_partition") == [
        ("AA", dt.date(2024, 1, 5), "1", 1, dt.date(2024, 1, 1)), ("DL", dt.date(2024, 2, 5), "7", 2, dt.date(2024, 2, 1))]
    assert got.filter("bronze_loaded_at is null").count() == 0


def test_reference_files_take_the_newest_day(spark, tmp_path):
    for day, name in (("2023-10-01", "Old"), ("2024-01-01", "New")):
        write(tmp_path / f"ds={day}" / "airlines.csv", f'1,"{name}",\\N,"AA","AAL","X","US","Y"\n')
    assert bronze.read_airlines(spark, str(tmp_path)).first().name == "New"
    assert bronze.read_airlines(spark, str(tmp_path), as_of=dt.date(2023, 12, 31)).first().name == "Old"
    with pytest.raises(FileNotFoundError):
        bronze.read_airports(spark, str(tmp_path))


def test_observe_files(spark, tmp_path):
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    assert bronze.observe_files(spark, str(tmp_path), now).first().data_version == "empty"
    for i in (0, 1, 9):
        day = (now.date() - dt.timedelta(days=i)).isoformat()
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / f"ds={day}" / "hr=1"))
    seen = bronze.observe_files(spark, str(tmp_path), now).first()
    assert seen.object_count == 2 and seen.data_version != "empty" and abs(seen.lag_seconds) < 600


def zip_file(path, csv_text, member="On_Time.CSV"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.html", "<html>")
        if csv_text is not None:
            z.writestr(member, csv_text)


def test_ingest_is_idempotent_and_notices_changes(spark, tmp_path):
    src, landing, manifest = tmp_path / "in", str(tmp_path / "landing"), str(tmp_path / "manifest")
    zip_file(src / "ds=2024-01-01" / "a.zip", 'FlightDate,Origin\n2024-01-05,"A, B"\n2024-01-06,C\n')
    zip_file(src / "ds=2024-02-01" / "b.zip", "Origin,FlightDate,New\nX,2024-02-05,1\n")
    zip_file(src / "ds=2024-03-01" / "c.zip", None)

    def ingest(hour, force=False):
        return archives.ingest_archives(
            spark, archives.read_archives(spark, str(src)), landing, manifest,
            FLIGHTS_RAW_COLUMNS, RUN + dt.timedelta(hours=hour), force)

    with pytest.raises(archives.MissingMember) as missing:
        ingest(0)  # the others have landed and are noted all the same
    assert [p.rsplit("/", 1)[1] for p in missing.value.paths] == ["c.zip"]
    first = {r.partition: r for r in archives.read_manifest(spark, manifest).collect()}
    assert set(first) == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}
    assert first[dt.date(2024, 1, 1)].row_count_estimate == 2
    assert first[dt.date(2024, 1, 1)].member_filename == "On_Time.CSV"
    with pytest.raises(archives.MissingMember):
        ingest(1)  # it has not been noted, so it is tried again
    zip_file(src / "ds=2024-03-01" / "c.zip", "FlightDate,Origin\n")
    assert [r.row_count_estimate for r in ingest(1).collect()] == [0]
    assert rows(spark.read.parquet(landing), "flightdate", "origin") == [
        ("2024-01-05", "A, B"), ("2024-01-06", "C"), ("2024-02-05", "X")]
    assert ingest(2).count() == 0
    zip_file(src / "ds=2024-02-01" / "b.zip", "Origin,FlightDate\nY,2024-02-05\nZ,2024-02-06\n")
    assert [r.partition for r in ingest(3).collect()] == [dt.date(2024, 2, 1)]
    assert rows(spark.read.parquet(landing), "origin") == [("A, B",), ("C",), ("Y",), ("Z",)]
    assert ingest(4, force=True).count() == 3
    assert archives.read_manifest(spark, manifest).count() == 7


def test_months(spark):
    assert archives.target_month(dt.date(2026, 5, 5)) == dt.date(2026, 4, 1)
    months = rows(archives.month_partitions(spark, dt.date(2009, 4, 30)))
    assert months == [(dt.date(2009, m, 1),) for m in (1, 2, 3)]
    loaded = spark.createDataFrame([(dt.date(2009, 2, 1),)], "partition date")
    assert rows(archives.missing_partitions(spark, loaded, dt.date(2009, 4, 30))) == [
        (dt.date(2009, 1, 1),), (dt.date(2009, 3, 1),)]


def poll(*states, time=1000):
    return json.dumps({"time": time, "states": list(states)})


def aircraft(**changes):
    from tarmac.schemas import STATE_ARRAY_FIELDS

    base = dict(zip(STATE_ARRAY_FIELDS, ["ABC123", "AAL1  ", "US", 500, 600, 1.5, 2.5, 100.0, False, 70.0, 1.0, 0.0,
                                         None, 90.0, "1200", False, 0]))
    return list({**base, **changes}.values())


def test_decode_payload(spark):
    polls = [
        poll(aircraft(), aircraft(icao24=None), aircraft(icao24=""), aircraft()[:16], aircraft(icao24="X") + ["extra"]),
        poll(aircraft(icao24="zero", time_position=0), aircraft(icao24="none", time_position=None, last_contact=0)),
        poll(), '{"time": 1, "states": null}', "[]", "junk",
    ]
    got = payload.decode_payload(spark.createDataFrame([(p,) for p in polls], "value string"))
    assert rows(got, "icao24", "event_ts", "polled_at") == [
        ("abc123", 500, 1000), ("none", 1000, 1000), ("x", 500, 1000), ("zero", 600, 1000)]
    first = got.filter("icao24 = 'abc123'").first()
    assert (first.callsign, first.on_ground, first.velocity, first.spi) == ("AAL1", False, 70.0, False)


@pytest.mark.parametrize("text,reject", [
    ('{"icao24":"a","event_ts":1,"extra":{"x":1}}', None),
    ('{"icao24":"a","event_ts":1,"velocity":2}', None),
    ('{"icao24":"a","event_ts":"soon"}', "unparseable"),
    ('{"icao24":"a","event_ts":1,"on_ground":"maybe"}', "unparseable"),
    ('{"icao24":"a"', "unparseable"), ("[1,2]", "unparseable"), ("7", "unparseable"), ("", "unparseable"),
    (None, "unparseable"), ('{"event_ts":1}', "missing_key"), ('{"icao24":"a"}', "missing_key"),
    ('{"icao24":null,"event_ts":1}', "missing_key"),
])
def test_message_routing(spark, text, reject):
    parsed = payload.parse_messages(spark.createDataFrame([("k", text)], "key string, value string"))
    assert parsed.first().reject == reject
    assert payload.accepted(parsed).count() == int(reject is None)
    kept = payload.dead_letters(parsed, "key", "value").collect()
    assert [tuple(r) for r in kept] == ([] if reject is None else [("k", text, reject)])


def test_events_to_json_round_trip(spark):
    events = payload.decode_payload(spark.createDataFrame([(poll(aircraft()),)], "value string"))
    sent = payload.events_to_json(events)
    assert sent.first().key == "abc123" and sent.first().timestamp == dt.datetime(1970, 1, 1, 0, 8, 20)
    assert rows(payload.coerce_state_json(sent)) == rows(events)


def test_drift(spark, tmp_path):
    live = spark.createDataFrame([("A",), ("b",), ("New",)], "column_name string")
    assert rows(schema_drift(live, ["a", "B", "gone"])) == [("added", "new"), ("removed", "gone")]
    path = str(tmp_path / "log")
    append_drift(drift_rows("bronze", "t", live, ["a", "B", "gone"], RUN), path)
    append_drift(drift_rows("bronze", "t", live, ["a", "b", "new"], RUN), path)
    log = read_drift_log(spark, path)
    assert rows(log, "kind", "column_name") == [
        ("added", "new"), ("removed", "gone"), ("run_marker", None), ("run_marker", None)]
    week, later = RUN + dt.timedelta(days=7), RUN + dt.timedelta(days=7, seconds=1)
    assert unreviewed_drift(log, week).count() == 0
    assert unreviewed_drift(log, later).count() == 2
    assert unreviewed_drift_count(log, later).first()[0] == 2
    assert unreviewed_drift_count(log, later, kinds=None).first()[0] == 4
    reviewed = log.withColumn("reviewed_at", F.col("detected_at"))
    assert unreviewed_drift_count(reviewed, later, kinds=None).first()[0] == 0


def test_discover_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(bronze.discover_schema(df)) == [(0, "a", "int", 2), (1, "b", "string", 1)]
