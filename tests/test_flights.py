"""Staging, deduplication, landings, matching and reconciliation."""

import datetime as dt
import random

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac.operators.dedupe import keep_latest, latest_aircraft
from tarmac.operators.landings import landing_events
from tarmac.operators.matching import landing_candidates, nearest_landings
from tarmac.operators.staging import (
    parse_callsigns, stg_airlines, stg_airports, stg_flights, stg_states,
)
from tarmac.plans.flights import int_flights, mapped_callsigns, reconcile, with_zones

RUN = dt.datetime(2024, 2, 1)
T0 = dt.datetime(2024, 1, 10, 12)


def test_stg_flights_survives_missing_and_renamed_columns(spark):
    raw = spark.createDataFrame(
        [("2024-01-05", " aa ", " 0012 ", "n1 ", "den", "lax", "2400", "-4.00", "1.00", "", "2.00"),
         ("bad", "AA", "1", None, "DEN", "LAX", "10", None, None, None, None),
         ("2024-01-05", "AA", " ", None, "DEN", "LAX", "10", None, None, None, None)],
        "FlightDate string, REPORTING_AIRLINE string, flight_number_reporting_airline string, "
        "Tail_Number string, Origin string, Dest string, CRSDepTime string, ArrDelay string, "
        "Cancelled string, CancellationCode string, DivAirportLandings string")
    got = stg_flights(raw).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.carrier_code, r.flight_number, r.tail_number, r.origin_iata) == ("AA", "0012", "N1", "DEN")
    assert (r.crs_dep_time_hhmm, r.arr_delay_min, r.dep_time_hhmm) == (2400, -4, None)
    assert (r.cancelled_flag, r.diverted_flag, r.cancellation_code) == (True, False, None)
    assert r.div_airport_landings == 2


def test_stg_states_range_and_defaults(spark):
    raw = spark.createDataFrame(
        [(" ABC ", "AAL1 ", "1704888000", None, "x"), ("a", " ", "0", "true", "1"),
         ("b", None, "9999999999", "true", "1"), (None, None, "1704888000", "true", "1")],
        "icao24 string, callsign string, event_ts string, on_ground string, velocity string")
    got = stg_states(raw).select("icao24", "callsign", "event_ts", "on_ground", "velocity_mps").collect()
    assert [tuple(r) for r in got] == [("abc", "AAL1", T0, False, None)]


def test_reference_staging_codes(spark):
    airports = spark.createDataFrame(
        [("1", "Denver", "den", "\\N", "39.8617"), ("2", "Short", "DE", "K", "1"),
         ("3", "Long", "DENV", "K", "1"), ("4", "None", "\\N", "K", "1"), ("5", " ", " lax ", "KLAX", "x")],
        "openflights_id string, name string, iata string, icao string, latitude string"
    ).select("*", *[F.lit(None).cast("string").alias(c) for c in (
        "city", "country", "longitude", "altitude", "timezone_offset", "dst", "tz_database", "type", "source")])
    assert rows(stg_airports(airports, RUN), "iata", "icao", "name", "latitude") == [
        ("DEN", None, "Denver", 39.8617), ("LAX", "KLAX", None, None)]
    airlines = spark.createDataFrame(
        [("1", "A", "\\N", "aa", "\\N", "\\N", "", "y"), ("2", "B", "x", "\\N", "B", "c", "US", "N"),
         ("3", "C", "x", "ABC", "B", "c", "US", "?")],
        "openflights_id string, name string, alias string, iata string, icao string, callsign string, "
        "country string, active string")
    assert rows(stg_airlines(airlines, RUN), "carrier_key", "icao_code", "country", "is_active") == [
        ("AA", None, None, True)]


def test_callsigns(spark):
    names = ["AA123", "AAL0123", "aa1", "B61", "N123AB", "", None, "AB" + "9" * 45]
    df = spark.createDataFrame([("x", n, T0) for n in names], "icao24 string, callsign string, event_ts timestamp")
    assert rows(parse_callsigns(df), "cs_carrier", "cs_flight_num") == [("AA", "123"), ("AAL", "123")]


def test_latest_aircraft_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", "AA", "1", T0), ("b", "AA", "1", T0), ("c", "AA", "1", T0 - dt.timedelta(1))],
        "icao24 string, cs_carrier string, cs_flight_num string, event_ts timestamp")
    assert rows(latest_aircraft(df)) == [("AA", "1", "b")]


def test_keep_latest_is_repeatable_on_ties(spark):
    data = [(1, T0, i) for i in range(50)] + [(2, T0, 1), (2, T0 + dt.timedelta(1), 0), (2, None, 9)]
    df = spark.createDataFrame(data, "k int, loaded timestamp, v int")
    first = rows(keep_latest(df, ["k"], "loaded"))
    again = rows(keep_latest(df.repartition(7), ["k"], "loaded"))
    assert first == again and first[1] == (2, T0 + dt.timedelta(1), 0)


STATE = ("icao24 string, callsign string, event_ts timestamp, latitude double, longitude double, "
         "on_ground boolean, velocity_mps double, bronze_loaded_at timestamp")


def state(icao, at, ground, velocity):
    return (icao, None, at, 0.0, 0.0, ground, velocity, T0)


def brute_landings(data):
    found, last = [], {}
    for icao, _, at, _, _, ground, velocity, _ in sorted(data, key=lambda r: (r[0], r[2])):
        before = last.get(icao)
        if before and ground and not before[0] and (before[1] or 0) > 30:
            found.append((icao, at, before[1]))
        last[icao] = (ground, velocity)
    return sorted(found, key=repr)


def test_landing_edges(spark):
    s = dt.timedelta(seconds=1)
    data = [
        state("first", T0, True, 50.0),
        state("null", T0, False, None), state("null", T0 + s, True, 0.0),
        state("slow", T0, False, 30.0), state("slow", T0 + s, True, 0.0),
        state("fast", T0, False, 30.5), state("fast", T0 + s, True, 0.0), state("fast", T0 + 2 * s, True, 0.0),
        # over midnight, and over days without any report
        state("night", dt.datetime(2024, 1, 10, 23, 59, 59), False, 70.0),
        state("night", dt.datetime(2024, 1, 11), True, 5.0),
        state("gap", dt.datetime(2024, 1, 1), False, 70.0), state("gap", dt.datetime(2024, 1, 9), True, 5.0),
    ]
    got = landing_events(spark.createDataFrame(data, STATE))
    assert rows(got, "icao24", "live_landing_ts", "approach_velocity_mps") == brute_landings(data)
    assert {r.icao24 for r in got.collect()} == {"fast", "night", "gap"}


def test_landings_match_brute_force_with_one_busy_airframe(spark):
    rng = random.Random(7)
    data = []
    for icao, n in [("busy", 900)] + [(f"a{i}", rng.randint(1, 30)) for i in range(60)]:
        for offset in rng.sample(range(6 * 86400), n):
            data.append(state(icao, T0 + dt.timedelta(seconds=offset), rng.random() < 0.4,
                              rng.choice([None, 10.0, 30.0, 31.0, 200.0])))
    got = landing_events(spark.createDataFrame(data, STATE).repartition(5))
    assert rows(got, "icao24", "live_landing_ts", "approach_velocity_mps") == brute_landings(data)


ARRIVAL = "icao24 string, scheduled_arr_ts timestamp"
LANDING = "icao24 string, live_landing_ts timestamp"


def test_nearest_band_is_inclusive_and_ties_go_to_the_earlier(spark):
    h, s = dt.timedelta(hours=1), dt.timedelta(seconds=1)
    asked = [("in-", T0), ("in+", T0), ("out", T0), ("tie", T0), ("same", T0), ("none", None), (None, T0)]
    landed = [("in-", T0 - 2 * h), ("in+", T0 + 2 * h), ("out", T0 + 2 * h + s), ("out", T0 - 2 * h - s),
              ("tie", T0 - h), ("tie", T0 + h), ("same", T0), ("same", T0 + s)]
    got = nearest_landings(spark.createDataFrame(asked, ARRIVAL), spark.createDataFrame(landed, LANDING))
    assert rows(got, "icao24", "live_actual_arr_ts", "ts_diff_s") == sorted(
        [("in-", T0 - 2 * h, 7200), ("in+", T0 + 2 * h, 7200), ("tie", T0 - h, 3600), ("same", T0, 0)], key=repr)


def test_nearest_and_candidates_match_brute_force(spark):
    rng = random.Random(3)
    at = [T0 + dt.timedelta(seconds=rng.randrange(3 * 86400)) for _ in range(500)]
    asked = [(rng.choice(["hot", "hot", "x", "y"]), rng.choice(at)) for _ in range(400)]
    landed = sorted({(rng.choice(["hot", "hot", "x", "z"]), rng.choice(at)) for _ in range(300)})
    best, pairs = {}, set()
    for icao, t in set(asked):
        near = [(abs((x - t).total_seconds()), x) for i, x in landed if i == icao]
        near = [n for n in near if n[0] <= 7200]
        pairs |= {(f"{icao}{t}", x, int(g)) for g, x in near}
        if near:
            gap, x = min(near)
            best[(icao, t)] = (x, int(gap))
    a, l = spark.createDataFrame(asked, ARRIVAL), spark.createDataFrame(landed, LANDING)
    got = {(r.icao24, r.scheduled_arr_ts): (r.live_actual_arr_ts, r.ts_diff_s)
           for r in nearest_landings(a, l).collect()}
    assert got == best
    keyed = a.distinct().withColumn("flight_event_natural_key", F.concat("icao24", F.col("scheduled_arr_ts").cast("string")))
    assert {tuple(r) for r in landing_candidates(keyed, l).collect()} == pairs


def staged(spark, *flights):
    base = dict(flight_date=dt.date(2024, 1, 10), carrier_code="AA", flight_number="1", tail_number="N1",
                origin_iata="DEN", dest_iata="JFK", crs_dep_time_hhmm=800, dep_time_hhmm=810,
                dep_delay_min=10, crs_arr_time_hhmm=1300, arr_time_hhmm=1305, arr_delay_min=5,
                cancelled_flag=False, cancellation_code=None, diverted_flag=False, distance_miles=1600,
                bronze_loaded_at=T0, flight_event_natural_key="k")
    schema = ("flight_date date, carrier_code string, flight_number string, tail_number string, origin_iata string, "
              "dest_iata string, crs_dep_time_hhmm int, dep_time_hhmm int, dep_delay_min int, crs_arr_time_hhmm int, "
              "arr_time_hhmm int, arr_delay_min int, cancelled_flag boolean, cancellation_code string, "
              "diverted_flag boolean, distance_miles int, bronze_loaded_at timestamp, flight_event_natural_key string")
    return spark.createDataFrame([tuple({**base, **f}.values()) for f in flights], schema)


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(
        [("DEN", "America/Denver", 1), ("JFK", "America/New_York", 2), ("JFK", "Asia/Tokyo", 9),
         ("BAD", "Nowhere/Land", 3)], "iata string, timezone string, openflights_id int")


def test_zones_never_multiply_flights(spark, airports):
    got = with_zones(staged(spark, {}, {"origin_iata": "BAD", "dest_iata": "ZZZ"}), airports)
    assert rows(got, "origin_timezone", "dest_timezone") == [("America/Denver", "America/New_York"), (None, None)]


def test_int_flights_times(spark, airports):
    got = int_flights(staged(
        spark, {"flight_event_natural_key": "a"},
        {"flight_event_natural_key": "b", "cancelled_flag": True},
        {"flight_event_natural_key": "c", "crs_arr_time_hhmm": None, "origin_iata": "BAD"},
        {"flight_event_natural_key": "d", "crs_dep_time_hhmm": 2300, "crs_arr_time_hhmm": 430},
    ), airports)
    by_key = {r.flight_event_natural_key: r for r in got.collect()}
    assert by_key["a"].scheduled_dep_ts == dt.datetime(2024, 1, 10, 15)
    assert by_key["a"].actual_arr_ts == dt.datetime(2024, 1, 10, 18, 5)
    assert by_key["b"].actual_dep_ts is None and by_key["b"].scheduled_arr_ts is not None
    assert by_key["c"].scheduled_arr_ts is None and by_key["c"].scheduled_dep_ts == dt.datetime(2024, 1, 10, 8)
    assert by_key["d"].scheduled_arr_ts == dt.datetime(2024, 1, 10, 9, 30)


def test_roll_overnight(spark, airports):
    flight = staged(spark, {"crs_dep_time_hhmm": 2300, "crs_arr_time_hhmm": 430})
    assert int_flights(flight, airports, roll_overnight=True).first().scheduled_arr_ts == dt.datetime(2024, 1, 11, 9, 30)


def test_reconcile_statuses(spark, airports):
    numbers = ["15min", "16min", "cancelled-live", "cancelled", "unmapped", "no-landing"]
    flights = int_flights(staged(spark, *[
        {"flight_event_natural_key": n, "flight_number": n, "cancelled_flag": n.startswith("cancelled")}
        for n in numbers]), airports)
    actual = dt.datetime(2024, 1, 10, 18, 5)
    aircraft = spark.createDataFrame(
        [("AA", n, n) for n in numbers if n != "unmapped"], "carrier_code string, flight_number string, icao24 string")
    m = dt.timedelta(minutes=1)
    landed = [("15min", actual + 15 * m + dt.timedelta(seconds=59)), ("16min", actual + 16 * m),
              ("cancelled-live", actual)]
    got = reconcile(flights, aircraft, spark.createDataFrame(landed, LANDING))
    assert {r.flight_number: (r.reconciliation_status, r.source_system) for r in got.collect()} == {
        "15min": ("matched", "bts"), "16min": ("mismatch", "bts"),
        "cancelled-live": ("live_only", "opensky_reconciled"), "cancelled": ("bts_only", "bts"),
        "unmapped": ("bts_only", "bts"), "no-landing": ("bts_only", "bts")}


def test_one_landing_may_serve_several_flights(spark, airports):
    flights = int_flights(staged(
        spark, {"flight_event_natural_key": "a"}, {"flight_event_natural_key": "b", "origin_iata": "JFK"}), airports)
    aircraft = spark.createDataFrame([("AA", "1", "x")], "carrier_code string, flight_number string, icao24 string")
    landings = spark.createDataFrame([("x", dt.datetime(2024, 1, 10, 18))], LANDING)
    got = reconcile(flights, aircraft, landings)
    assert got.filter("live_actual_arr_ts is not null").count() == 2


def test_leading_zeros_matter_unless_asked(spark, airports):
    flights = int_flights(staged(spark, {"flight_number": "0012"}), airports)
    aircraft = spark.createDataFrame([("AA", "12", "x")], "carrier_code string, flight_number string, icao24 string")
    landings = spark.createDataFrame([("x", dt.datetime(2024, 1, 10, 18))], LANDING)
    assert reconcile(flights, aircraft, landings).first().live_actual_arr_ts is None
    found = reconcile(flights, aircraft, landings, plain_numbers=True).first()
    assert (found.flight_number, found.live_actual_arr_ts) == ("0012", dt.datetime(2024, 1, 10, 18))


def test_icao_prefixes_may_be_mapped(spark):
    states = spark.createDataFrame([("x", "AAL0123", T0), ("y", "ZZZ1", T0)],
                                   "icao24 string, callsign string, event_ts timestamp")
    codes = spark.createDataFrame([("AA", "AAL"), ("XX", None)], "carrier_key string, icao_code string")
    assert rows(mapped_callsigns(states, codes), "cs_carrier", "cs_flight_num") == [("AA", "123"), ("ZZZ", "1")]
    assert rows(mapped_callsigns(states), "cs_carrier") == [("AAL",), ("ZZZ",)]
