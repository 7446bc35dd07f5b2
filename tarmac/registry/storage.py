"""Registered queries: sources, landing, sinks and table upkeep."""

from __future__ import annotations

import datetime as dt
import io
import json
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files, standins
from tarmac.operators import tables
from tarmac.operators.drift import append_drift, drift_rows, read_drift_log, schema_drift
from tarmac.operators.windows import late_arrival, since_last_load
from tarmac.plans import gold, silver
from tarmac.registry import frames
from tarmac.registry.oracle import sql
from tarmac.schemas import FLIGHTS_RAW_COLUMNS
from tarmac.session import scratch_path
from tarmac.sources import archives, bronze, payload

RUN_TS = frames.RUN_TS
CHANGE_DAY, WINDOW_DAYS = dt.date(2024, 1, 20), 10


# --- scans -----------------------------------------------------------------------------

def q_scan_csv(spark: SparkSession, d: str) -> DataFrame:
    """Two half-months of CSV whose headers differ in names and order, read back as one."""
    raw = standins.flights_raw(spark, d).drop("ds", "bronze_loaded_at")
    path = scratch_path(spark, "csv-bronze")
    early = F.col("FlightDate") <= "2024-01-15"
    halves = {
        "2024-01-01": raw.filter(early).drop("Div_Airport_Landings"),
        "2024-01-16": raw.filter(~early).drop("DivAirportLandings").select(
            "Div_Airport_Landings", *[c for c in raw.columns if not c.startswith("Div") or c == "Diverted"]),
    }
    for day, half in halves.items():
        half.write.option("header", True).csv(f"{path}/ds={day}")
    back = bronze.read_csv_bronze(spark, path)
    return back.select(
        *[F.col(c).alias(c) for c in FLIGHTS_RAW_COLUMNS], "div_airport_landings", "divairportlandings",
        "ds", F.col("bronze_loaded_at").isNotNull().alias("has_load_time"))


def q_scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    raw = standins.states_raw(spark, d)
    path = scratch_path(spark, "parquet-bronze")
    standins.state_events(raw).withColumns({
        "ds": F.to_date(F.timestamp_seconds("event_ts")),
        "hr": F.hour(F.timestamp_seconds("event_ts")),
    }).write.option("compression", "zstd").partitionBy("ds", "hr").parquet(path)
    back = bronze.read_parquet_bronze(spark, path)
    return back.withColumn("has_load_time", F.col("bronze_loaded_at").isNotNull()).drop("bronze_loaded_at")


def _reference_files(spark: SparkSession, raw: DataFrame, file_name: str) -> str:
    """An outdated and a current copy of a headerless reference file."""
    path = scratch_path(spark, "reference")
    outdated = raw.withColumn("name", F.lit("outdated"))
    for day, rows in (("2023-10-01", outdated), ("2024-01-01", raw)):
        rows.write.option("ignoreLeadingWhiteSpace", False).csv(f"{path}/ds={day}/{file_name}")
    return path


def q_scan_airports(spark: SparkSession, d: str) -> DataFrame:
    path = _reference_files(spark, standins.airports_raw(spark, d), "airports.csv")
    return bronze.read_airports(spark, path)


def q_scan_airlines(spark: SparkSession, d: str) -> DataFrame:
    path = _reference_files(spark, standins.airlines_raw(spark, d), "airlines.csv")
    return bronze.read_airlines(spark, path)


def q_discover_schema(spark: SparkSession, d: str) -> DataFrame:
    return bronze.discover_schema(standins.table(spark, d, "events"))


def q_source_freshness_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "rolls")
    standins.states_raw(spark, d).drop("hr").repartition("ds").write.partitionBy("ds").parquet(path)  # a file a day
    seen = bronze.observe_files(spark, path, dt.datetime(2024, 1, 30, 12))
    # When the files were written is not in the tables, but that it was noted is.
    return seen.select("object_count", F.col("latest").isNotNull().alias("dated"), (F.col("data_version") != "empty").alias("versioned"))


# --- payloads and messages -------------------------------------------------------------

def payloads(spark: SparkSession, d: str) -> DataFrame:
    return payloads_of(standins.states_raw(spark, d))


def payloads_of(e: DataFrame) -> DataFrame:
    """Poll payloads as the position service answers: one aircraft each, at times with a
    truncated state, one without an id, a zero time of position, or in capitals."""
    state = F.to_json(F.array(
        F.upper("icao24"), F.concat(F.col("callsign"), F.lit("  ")), F.col("origin_country"),
        F.when(F.col("event_id") % 4 == 0, "0").otherwise(F.col("time_position")),
        F.when(F.col("event_id") % 8 == 0, "0").otherwise(F.col("last_contact")),
        "longitude", "latitude", "baro_altitude", "on_ground", "velocity", "true_track",
        "vertical_rate", F.lit(None).cast("string"), "geo_altitude", "squawk", F.lit("false"),
        "position_source",
    ))
    more = (
        F.when(F.col("event_id") % 3 == 0, F.lit(',["abc123","SHORT"]'))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit(',[null'), F.lit(',"x"' * 16), F.lit("]")))
        .otherwise(F.lit(""))
    )
    polled = (F.col("event_ts").cast("bigint") + 5).cast("string")
    return e.select(
        "event_id",
        F.concat(F.lit('{"time":'), polled, F.lit(',"states":['), state, more, F.lit("]}")).alias("value"))


def messages(spark: SparkSession, d: str) -> DataFrame:
    return messages_of(standins.states_raw(spark, d))


def messages_of(raw: DataFrame) -> DataFrame:
    """Keyed messages; some are cut off, of the wrong type, without a key, or no object."""
    events = standins.state_events(raw, "event_id")
    fields = [c for c in events.columns if c != "event_id"]
    good = F.to_json(F.struct(*fields, F.lit("x").alias("unknown")))
    kind = F.col("event_id") % 13
    value = (
        F.when(kind == 0, F.substring(good, 1, 40))
        .when(kind == 1, F.regexp_replace(good, '"event_ts":[0-9]+', '"event_ts":"soon"'))
        .when(kind == 2, F.regexp_replace(good, '"icao24":"[^"]*",', ""))
        .when(kind == 3, F.lit("[1,2]"))
        .otherwise(good)
    )
    return events.select("event_id", F.col("icao24").alias("key"), value.alias("value"))


def q_dlq_split(spark: SparkSession, d: str) -> DataFrame:
    parsed = payload.parse_messages(messages(spark, d))
    return parsed.select(
        "event_id", "key", F.coalesce("reject", F.lit("accepted")).alias("route"))


def q_coerce(spark: SparkSession, d: str) -> DataFrame:
    return payload.coerce_state_json(messages(spark, d))


def q_events_to_json(spark: SparkSession, d: str) -> DataFrame:
    return payload.events_to_json(standins.state_events(standins.states_raw(spark, d)))


# --- landing ---------------------------------------------------------------------------

def _zip_day(day: pd.DataFrame) -> pd.DataFrame:
    """One archive per day, as a publisher would hand them over."""
    packed, date = io.BytesIO(), next(c for c in day.columns if c.lower() == "flightdate")
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("readme.html", "<html></html>")
        z.writestr("On_Time.csv", day.to_csv(index=False))
    return pd.DataFrame({
        "path": [f"archive-{day[date].iloc[0]}.zip"],
        "partition": [dt.date(2009, 1, 1)], "content": [packed.getvalue()]})


def zipped(spark: SparkSession, d: str) -> DataFrame:
    raw = standins.flights_raw(spark, d).drop("ds", "bronze_loaded_at")
    return raw.groupBy("flightdate").applyInPandas(_zip_day, "path string, partition date, content binary")


def q_expand_archives(spark: SparkSession, d: str) -> DataFrame:
    return archives.expand_archives(zipped(spark, d), FLIGHTS_RAW_COLUMNS).select(*FLIGHTS_RAW_COLUMNS)


def q_idempotent_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Landing the same archives twice leaves one manifest row for each."""
    stored = scratch_path(spark, "incoming")
    zipped(spark, d).write.parquet(stored)
    landing, manifest = scratch_path(spark, "landing"), scratch_path(spark, "manifest")
    for hour in (1, 2):
        archives.ingest_archives(
            spark, spark.read.parquet(stored), landing, manifest, FLIGHTS_RAW_COLUMNS,
            dt.datetime(2024, 2, 1, hour))
    return archives.read_manifest(spark, manifest).select(
        "source_url", "partition", "member_filename", "row_count_estimate")


def q_land_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Two lists landed on three days: unchanged, then one of them changed."""
    root, manifest = scratch_path(spark, "seeds"), scratch_path(spark, "seed-manifest")
    airports, airlines = standins.airports_raw(spark, d), standins.airlines_raw(spark, d)
    for day, some in ((1, airlines), (2, airlines), (3, airlines.filter("openflights_id % 2 = 0"))):
        found = {}
        for name, rows in (("airports.csv", airports), ("airlines.csv", some)):
            folder = scratch_path(spark, "published")
            rows.orderBy("openflights_id").coalesce(1).write.csv(folder)
            part = next(n for n in files.names(spark, folder) if n.startswith("part-"))
            found[name] = f"{folder}/{part}"
        archives.land_seeds(spark, found, root, manifest, dt.date(2024, 1, day), dt.datetime(2024, 2, 1, day))
    return archives.read_manifest(spark, manifest).select("member_filename", "partition", "row_count_estimate")


def q_missing_partitions(spark: SparkSession, d: str) -> DataFrame:
    loaded = standins.table(spark, d, "orders").select(
        F.trunc("o_orderdate", "month").alias("partition"))
    return archives.missing_partitions(
        spark, loaded, dt.date(2002, 3, 5), first=dt.date(1994, 1, 1))


# --- airport history -------------------------------------------------------------------

HISTORY = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21)]


def airport_history(spark: SparkSession, d: str) -> DataFrame:
    """The stored snapshot after three lists: the second renames airports, the third lacks some."""
    path, listed = scratch_path(spark, "airport-history"), frames.airports(spark, d)
    renamed = listed.withColumn("name", F.when(
        F.col("openflights_id") % 3 == 0, F.concat("name", F.lit(" II"))).otherwise(F.col("name")))
    fewer = renamed.filter("openflights_id % 5 <> 0")
    for source, as_of in zip((listed, renamed, fewer), HISTORY, strict=True):
        gold.load_airport_snapshot(spark, path, source, as_of)
    return spark.read.parquet(path)


def q_airport_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return airport_history(spark, d).select("iata", "name", "valid_from", "valid_to")


def q_fact_at(spark: SparkSession, d: str) -> DataFrame:
    """Facts with the first day of the airport versions of their own day."""
    dim = gold.dim_airport(airport_history(spark, d), frames.RUN_TS)
    fact = gold.fct_flight_event_at(frames.gold_tables(spark, d)["silver_flight_event"], dim, frames.RUN_TS)
    first = dim.select(F.col("airport_sk").alias("sk"), "valid_from")
    for end in ("origin", "dest"):
        fact = fact.join(first, F.col(f"{end}_airport_sk") == F.col("sk"), "left").withColumnRenamed(
            "valid_from", f"{end}_from").drop("sk")
    return fact.select("flight_event_sk", "flight_date_key", "origin_from", "dest_from")


# --- merges ----------------------------------------------------------------------------

_MERGED = ["flight_event_natural_key", "flight_date", "carrier_code", "dep_delay_min", "arr_delay_min"]


def _first_load(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """A table with the flights up to the change day, and all flights with later delays."""
    unique = silver.unique_flights(frames.flights(spark, d)).select(*_MERGED)
    path = scratch_path(spark, "merge-target")
    tables.upsert(spark, path, unique.filter(F.col("flight_date") <= F.lit(CHANGE_DAY)),
                  silver.FLIGHT_KEY, "flight_date")
    changed = unique.withColumn("dep_delay_min", F.col("dep_delay_min") + 1000)
    return path, changed


def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Changed and new flights merged twice; every source row arrives in two copies."""
    path, changed = _first_load(spark, d)
    late = changed.filter(F.col("flight_date") >= F.lit(dt.date(2024, 1, 16)))
    doubled = late.withColumn("load", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "dep_delay_min", F.col("dep_delay_min") + F.col("load"))
    for _ in range(2):
        tables.upsert(spark, path, doubled, silver.FLIGHT_KEY, "flight_date",
                      latest_by=[F.col("load").desc()], sort_by=["carrier_code"])
    return tables.read_table(spark, path).drop("load")


def q_upsert_moved(spark: SparkSession, d: str) -> DataFrame:
    """Flights that change their day: a third of ten days moves three weeks on, twice; some come back."""
    unique = silver.unique_flights(frames.flights(spark, d)).select(*_MERGED)
    path, key = scratch_path(spark, "moving-target"), ["flight_event_natural_key"]
    tables.upsert_by_key(spark, path, unique, key, "flight_date")
    place = F.conv(F.substring("flight_event_natural_key", 1, 6), 16, 10).cast("long")
    early = unique.filter(F.col("flight_date") <= F.lit(dt.date(2024, 1, 10)))
    moved = early.filter(place % 3 == 0).withColumns({
        "flight_date": F.date_add("flight_date", 21), "dep_delay_min": F.col("dep_delay_min") + 1000})
    for _ in range(2):
        tables.upsert_by_key(spark, path, moved, key, "flight_date", sort_by=["carrier_code"])
    tables.upsert_by_key(spark, path, early.filter(place % 6 == 0), key, "flight_date")
    return tables.read_table(spark, path)


def q_daily_changes(spark: SparkSession, d: str) -> DataFrame:
    """The daily aggregate after three loads of facts: all, then flights later and four weeks on, then these again."""
    facts = frames.gold_tables(spark, d)["fct_flight_event"].select(
        "flight_event_sk", "flight_date_key", "carrier_key", "arr_delay_min", "cancelled_flag")
    fact_path, daily_path = scratch_path(spark, "change-facts"), scratch_path(spark, "change-daily")
    gold.load_changes(spark, fact_path, daily_path, facts)
    day, place = F.col("flight_date_key"), F.conv(F.substring("flight_event_sk", 1, 6), 16, 10).cast("long")
    moves = (day <= F.lit(dt.date(2024, 1, 10))) & (
        (place % 3 == 0) | (day == F.lit(dt.date(2024, 1, 3))) & (F.col("carrier_key") == "AA"))
    moved = facts.filter(moves).withColumns({
        "flight_date_key": F.date_add("flight_date_key", 28), "arr_delay_min": F.col("arr_delay_min") + 5})
    for _ in range(2):
        gold.load_changes(spark, fact_path, daily_path, moved)
    return gold.daily_from_sums(spark.read.parquet(daily_path)).withColumns({
        c: F.round(c, 6) for c in ("on_time_pct", "avg_arr_delay_min")})


def q_late_arrival(spark: SparkSession, d: str) -> DataFrame:
    """Only changes inside the window before the table's latest day are merged."""
    path, changed = _first_load(spark, d)
    recent = since_last_load(spark, changed, path, "flight_date", "flight_date", WINDOW_DAYS)
    tables.upsert(spark, path, recent, silver.FLIGHT_KEY, "flight_date")
    return tables.read_table(spark, path)


def q_incremental_window(spark: SparkSession, d: str) -> DataFrame:
    path, changed = _first_load(spark, d)
    return since_last_load(spark, changed, path, "flight_date", "flight_date", WINDOW_DAYS)


def q_backfill_window(spark: SparkSession, d: str) -> DataFrame:
    bounds = (dt.date(2024, 1, 5), dt.date(2024, 1, 9))
    return frames.flights(spark, d).filter(
        late_arrival(F.col("flight_date"), CHANGE_DAY, WINDOW_DAYS, backfill=bounds))


def q_schema_append(spark: SparkSession, d: str) -> DataFrame:
    """The second load lacks a column of the table and brings a new one."""
    unique = silver.unique_flights(frames.flights(spark, d))
    path = scratch_path(spark, "evolving")
    key = ["flight_event_natural_key", "flight_date"]
    old = unique.filter(F.col("flight_date") <= F.lit(CHANGE_DAY)).select(*key, "carrier_code", "tail_number")
    new = unique.filter(F.col("flight_date") >= F.lit(CHANGE_DAY)).select(
        *key, "carrier_code", F.col("distance_miles").alias("gate_distance"))
    tables.upsert(spark, path, old, silver.FLIGHT_KEY, "flight_date")
    tables.upsert(spark, path, new, silver.FLIGHT_KEY, "flight_date")
    return tables.read_table(spark, path)


def q_full_refresh(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "refreshed")
    aircraft = gold.dim_aircraft(frames.flights(spark, d), RUN_TS)
    tables.full_refresh(spark, path, aircraft.filter(F.col("operator_carrier_key") == "AA"))
    tables.full_refresh(spark, path, aircraft)
    return spark.read.parquet(path)


def versions(spark: SparkSession, d: str) -> DataFrame:
    """Three snapshot runs over customers: renamed segments, removals, newcomers, no change."""
    c = standins.table(spark, d, "customer")
    first = c.selectExpr("c_custkey as code", "c_name as name", "c_mktsegment as segment", "c_nationkey as nation")
    new = standins.table(spark, d, "supplier").selectExpr(
        "-1 - s_suppkey as code", "s_name as name", "'SUPPLIER' as segment", "s_nationkey as nation")
    second = c.filter("c_acctbal >= 0").selectExpr(
        "c_custkey as code", "c_name as name",
        "case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as segment",
        "c_nationkey as nation").unionByName(new)
    check = ["name", "segment", "nation"]
    path = scratch_path(spark, "versions")
    tables.open_versions(first, dt.datetime(1996, 1, 1)).write.parquet(f"{path}/1")
    for run, when in ((2, dt.datetime(1998, 1, 1)), (3, dt.datetime(1999, 1, 1))):
        before = spark.read.parquet(f"{path}/{run - 1}")
        tables.scd2_merge(before, second, "code", check, when).write.parquet(f"{path}/{run}")
    return spark.read.parquet(f"{path}/3")


def q_scd2_asof(spark: SparkSession, d: str) -> DataFrame:
    orders = standins.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("order_ts"))
    joined = tables.version_at(orders, versions(spark, d), "o_custkey", "code", "order_ts")
    return joined.select("o_orderkey", "order_ts", F.col("dim_segment").alias("segment"),
                         F.col("dim_valid_from").alias("valid_from"))


def q_promote_parity(spark: SparkSession, d: str) -> DataFrame:
    t = {n: standins.table(spark, d, n) for n in ("orders", "lineitem", "customer", "supplier", "events")}
    prod = {
        "orders": t["orders"].filter("o_orderstatus <> 'P'"),
        "lineitem": t["lineitem"], "customer": t["customer"].filter("c_acctbal > 1e9"),
        "events": t["events"].unionByName(t["events"].filter("value < 1")),
    }
    return tables.promote_parity(t, prod)


def q_promote(spark: SparkSession, d: str) -> DataFrame:
    """Dev takes the place of prod, back, and again; the last run dies between the renames and is finished."""
    dev, prod = scratch_path(spark, "dev"), scratch_path(spark, "prod")
    orders = standins.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    orders.write.parquet(f"{prod}/orders")
    orders.withColumn("o_custkey", F.col("o_custkey") + 1).write.parquet(f"{dev}/orders")
    for _ in range(2):
        tables.promote(spark, dev, prod, ["orders"])
    files.write_note(spark, f"{prod}.promotion", json.dumps({"dev": dev, "parked": f"{prod}.swap"}))
    files.rename(spark, prod, f"{prod}.swap")
    tables.settle_promotion(spark, prod)
    return spark.read.parquet(f"{prod}/orders").withColumn("place", F.lit("prod")).unionByName(
        spark.read.parquet(f"{dev}/orders").withColumn("place", F.lit("dev")))


def q_expire(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "retention")
    staged = frames.flights(spark, d).select(
        "carrier_code", "flight_number", "bronze_loaded_at", F.col("flight_date").alias("ds"))
    staged.write.partitionBy("ds").parquet(path)
    tables.expire_partitions(spark, path, "ds", dt.date(2024, 2, 1), 15)
    return spark.read.parquet(path)


# --- drift -----------------------------------------------------------------------------

def _live_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of the flight files in which any row has a value."""
    return bronze.discover_schema(standins.flights_raw(spark, d)).filter("rows_with_value > 0")


_EXPECTED = [*FLIGHTS_RAW_COLUMNS, "wheels_off"]


def q_schema_drift(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift(_live_columns(spark, d), _EXPECTED)


def q_drift_log(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "drift-log")
    live = _live_columns(spark, d)
    for day in (1, 2):
        append_drift(drift_rows("bronze", "bts_raw", live, _EXPECTED, dt.datetime(2024, 2, day)), path)
    return read_drift_log(spark, path)


QUERIES = {
    "scan_csv_bronze": q_scan_csv,
    "scan_parquet_bronze": q_scan_parquet,
    "scan_airports": q_scan_airports,
    "scan_airlines": q_scan_airlines,
    "discover_schema": q_discover_schema,
    "source_freshness_files": q_source_freshness_files,
    "decode_state_payload": lambda s, d: payload.decode_payload(payloads(s, d)).drop("sensors"),
    "coerce_state_json": q_coerce,
    "dlq_split": q_dlq_split,
    "events_to_json": q_events_to_json,
    "expand_archives": q_expand_archives,
    "idempotent_ingest": q_idempotent_ingest,
    "land_seeds": q_land_seeds,
    "missing_partitions": q_missing_partitions,
    "airport_snapshot": q_airport_snapshot,
    "fct_flight_event_at": q_fact_at,
    "upsert_merge": q_upsert,
    "upsert_moved_key": q_upsert_moved,
    "daily_from_changes": q_daily_changes,
    "late_arrival_merge": q_late_arrival,
    "incremental_window": q_incremental_window,
    "backfill_window": q_backfill_window,
    "schema_append": q_schema_append,
    "full_refresh": q_full_refresh,
    "scd2_snapshot": versions,
    "scd2_asof_join": q_scd2_asof,
    "promote_parity": q_promote_parity,
    "promote_exchange": q_promote,
    "expire_partitions": q_expire,
    "schema_drift": q_schema_drift,
    "schema_drift_log": q_drift_log,
}

# Blank and missing text look the same in CSV files.
_RAW_BLANK = ", ".join(f"nullif({c}, '') as {c}" for c in FLIGHTS_RAW_COLUMNS)
_EVENT = """icao24, callsign, origin_country, event_ts, event_ts + 5 as polled_at, time_position,
    last_contact, longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate,
    geo_altitude, {squawk} as squawk, false as spi, position_source"""
_PAYLOAD_TIME = """case when event_id % 8 = 0 then event_ts + 5 when event_id % 4 = 0 then last_contact
    else time_position end"""
_OLD_ROWS = "select {c} from uniq_flights where flight_date <= date '2024-01-20'"
_C = ", ".join(_MERGED)
_EXPECTED_DRIFT = """
    select 'added' as kind, unnest(['div_airport_landings', 'divairportlandings', 'ds', 'bronze_loaded_at']) as column_name
    union all select 'removed', 'wheels_off'"""

_TEXT_FIELDS = ("icao24", "callsign", "origin_country", "squawk")
_EVENT_FIELDS = (
    "icao24 callsign origin_country event_ts polled_at time_position last_contact longitude latitude baro_altitude "
    "on_ground velocity true_track vertical_rate geo_altitude squawk spi position_source").split()
_HISTORY_SQL = """with listed as (
    select iata, name, openflights_id % 3 = 0 as renamed, openflights_id % 5 = 0 as gone from stg_airports
    where iata is not null qualify row_number() over (partition by iata order by openflights_id nulls last) = 1),
  versions_ as (
    select iata, name, timestamp '2024-01-01' as valid_from, case when renamed then timestamp '2024-01-11'
      when gone then timestamp '2024-01-21' end as valid_to from listed
    union all select iata, name || ' II', timestamp '2024-01-11', case when gone then timestamp '2024-01-21' end
      from listed where renamed) """
PAYLOAD_SQL = (

        "select event_id, " + _EVENT.format(squawk="squawk")
        .replace("event_ts, event_ts + 5", f"{_PAYLOAD_TIME} as event_ts, event_ts + 5")
        .replace("time_position,\n    last_contact,",
                 "case when event_id % 4 = 0 then 0 else time_position end as time_position, "
                 "case when event_id % 8 = 0 then 0 else last_contact end as last_contact,")
        + " from states_raw")
ORACLES = {
    "scan_csv_bronze": sql(
        f"select {_RAW_BLANK}, case when flightdate > '2024-01-15' then div_new end as div_airport_landings, "
        "case when flightdate <= '2024-01-15' then div_old end as divairportlandings, "
        "case when flightdate <= '2024-01-15' then date '2024-01-01' else date '2024-01-16' end as ds, "
        "true as has_load_time from flights_raw"),
    "scan_parquet_bronze": sql(f"select {_EVENT.format(squawk='squawk')}, ds, hr, true as has_load_time from states_raw"),
    "scan_airports": sql("select openflights_id, name, city, country, iata, icao, latitude, longitude, altitude, "
                         "timezone_offset, dst, tz_database, type, source from airports_raw"),
    "scan_airlines": sql("select openflights_id, name, alias, iata, icao, callsign, nullif(country, '') as country, "
                         "active from airlines_raw"),
    "discover_schema": " union all ".join(
        f"select {i} as position, '{c}' as column_name, '{t}' as data_type, count({c}) as rows_with_value from events"
        for i, (c, t) in enumerate([
            ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
            ("value", "double"), ("props", "string")])),
    "source_freshness_files": sql(
        "select count(distinct ds) as object_count, count(*) > 0 as dated, count(*) > 0 as versioned from states_raw "
        "where cast(ds as date) between date '2024-01-29' and date '2024-01-30'"),
    "decode_state_payload": sql(PAYLOAD_SQL),
    "coerce_state_json": sql(f"select {_EVENT.format(squawk='squawk')} from states_raw where event_id % 13 > 3"),
    "dlq_split": sql(
        "select event_id, icao24 as key, case event_id % 13 when 0 then 'unparseable' when 1 then 'unparseable' "
        "when 2 then 'missing_key' when 3 then 'unparseable' else 'accepted' end as route from states_raw"),
    "events_to_json": sql(
        "select icao24 as key, '{' || concat_ws(',', " + ", ".join(
            f"'\"{c}\":' || " + (f"('\"' || {c} || '\"')" if c in _TEXT_FIELDS else f"cast({c} as varchar)")
            for c in _EVENT_FIELDS)
        + ") || '}' as value, "
        "timestamp '1970-01-01 00:00:00' + to_seconds(event_ts) as timestamp "
        f"from (select {_EVENT.format(squawk='squawk')} from states_raw)"),
    "expand_archives": sql(
        "select flightdate, reporting_airline, flight_number_reporting_airline, tail_number, origin, dest, "
        "crsdeptime, crsarrtime, cancelled, cancellationcode, diverted, distance, "
        + ", ".join(f"coalesce({c}, '') as {c}" for c in ("deptime", "depdelay", "arrtime", "arrdelay"))
        + " from flights_raw"),
    "idempotent_ingest": sql(
        "select 'archive-' || flightdate || '.zip' as source_url, date '2009-01-01' as partition, "
        "'On_Time.csv' as member_filename, count(*) as row_count_estimate from flights_raw group by flightdate"),
    "land_seeds": sql(
        "select 'airports.csv' as member_filename, date '2024-01-01' as partition, count(*) as row_count_estimate "
        "from airports_raw union all select 'airlines.csv', date '2024-01-01', count(*) from airlines_raw "
        "union all select 'airlines.csv', date '2024-01-03', count(*) from airlines_raw "
        "where cast(openflights_id as integer) % 2 = 0"),
    "airport_snapshot": sql(f"select iata, name, valid_from, valid_to from ({_HISTORY_SQL} select * from versions_)"),
    "fct_flight_event_at": sql(
        "select flight_event_sk, flight_date_key, cast(o.valid_from as date) as origin_from, "
        "cast(e.valid_from as date) as dest_from from fact f "
        f"left join ({_HISTORY_SQL} select * from versions_) o on o.iata = f.origin_airport_key "
        "and o.valid_from <= f.flight_date_key and (o.valid_to is null or f.flight_date_key < o.valid_to) "
        f"left join ({_HISTORY_SQL} select * from versions_) e on e.iata = f.dest_airport_key "
        "and e.valid_from <= f.flight_date_key and (e.valid_to is null or f.flight_date_key < e.valid_to)"),
    "missing_partitions":
        "select cast(m as date) as partition from (select unnest(generate_series(timestamp '1994-01-01', "
        "timestamp '2002-02-01', interval 1 month)) as m) where cast(m as date) not in "
        "(select cast(date_trunc('month', o_orderdate) as date) from orders)",
    "upsert_merge": sql(
        f"select {_C} from uniq_flights where flight_date < date '2024-01-16' union all "
        "select * replace (dep_delay_min + 1002 as dep_delay_min) from "
        f"(select {_C} from uniq_flights where flight_date >= date '2024-01-16')"),
    "daily_from_changes": sql(
        "select flight_date, carrier_key, count(*) as flights_scheduled, "
        "count(*) filter (not cancelled_flag) as flights_completed, count(*) filter (cancelled_flag) as flights_cancelled, "
        "round(count(*) filter (delay <= 14) * 100.0::double / nullif(count(*) filter (not cancelled_flag), 0), 6) as on_time_pct, "
        "round(avg(delay), 6) as avg_arr_delay_min, cast(sum(coalesce(delay, 0)) as bigint) as total_delay_min from ("
        "select carrier_key, cancelled_flag, case when moves then flight_date_key + 28 else flight_date_key end as flight_date, "
        "case when moves then arr_delay_min + 5 else arr_delay_min end as delay from ("
        "select *, flight_date_key <= date '2024-01-10' and (('0x' || substr(flight_event_sk, 1, 6))::bigint % 3 = 0 "
        "or (flight_date_key = date '2024-01-03' and carrier_key = 'AA')) as moves from fact)) group by flight_date, carrier_key"),
    "upsert_moved_key": sql(
        "select flight_event_natural_key, case when moves then flight_date + 21 else flight_date end as flight_date, "
        "carrier_code, case when moves then dep_delay_min + 1000 else dep_delay_min end as dep_delay_min, arr_delay_min from ("
        f"select {_C}, flight_date <= date '2024-01-10' and "
        "('0x' || substr(flight_event_natural_key, 1, 6))::bigint % 6 = 3 as moves from uniq_flights)"),
    "late_arrival_merge": sql(
        f"select {_C} from uniq_flights where flight_date < date '2024-01-10' union all "
        "select * replace (dep_delay_min + 1000 as dep_delay_min) from "
        f"(select {_C} from uniq_flights where flight_date >= date '2024-01-10')"),
    "incremental_window": sql(
        "select * replace (dep_delay_min + 1000 as dep_delay_min) from "
        f"(select {_C} from uniq_flights where flight_date >= date '2024-01-10')"),
    "backfill_window": sql(
        "select * from stg_flights where flight_date between date '2024-01-05' and date '2024-01-09'"),
    "schema_append": sql(
        "select flight_event_natural_key, flight_date, carrier_code, "
        "case when flight_date < date '2024-01-20' then tail_number end as tail_number, "
        "case when flight_date >= date '2024-01-20' then distance_miles end as gate_distance from uniq_flights"),
    "full_refresh": sql("select * from aircraft_dim"),
    "scd2_snapshot": sql("select * from versions"),
    "scd2_asof_join": sql(
        "select o_orderkey, o_orderdate as order_ts, v.segment, v.valid_from from orders left join versions v "
        "on o_custkey = v.code and v.valid_from <= o_orderdate and (v.valid_to is null or o_orderdate < v.valid_to)"),
    "promote_parity": """
        with dev as (select 'orders' as table_name, (select count(*) from orders) as dev_rows union all
            select 'lineitem', (select count(*) from lineitem) union all
            select 'customer', (select count(*) from customer) union all
            select 'events', (select count(*) from events)),
          prod as (select 'orders' as table_name, (select count(*) from orders where o_orderstatus <> 'P') as prod_rows union all
            select 'lineitem', (select count(*) from lineitem) union all
            select 'customer', (select count(*) from customer where c_acctbal > 1e9) union all
            select 'events', (select count(*) + count(*) filter (value < 1) from events)),
          both_sides as (select *, cast(dev_rows as double) / nullif(prod_rows, 0) as ratio from dev join prod using (table_name))
        select *, case when prod_rows = 0 then 'SKIP' when ratio between 0.99 and 1.05 then 'OK' else 'FAIL' end as status
        from both_sides""",
    "promote_exchange":
        "select o_orderkey, o_custkey + 1 as o_custkey, 'prod' as place from orders union all "
        "select o_orderkey, o_custkey, 'dev' from orders",
    "expire_partitions": sql(
        "select carrier_code, flight_number, bronze_loaded_at, flight_date as ds from stg_flights "
        "where flight_date >= date '2024-01-17'"),
    "schema_drift": _EXPECTED_DRIFT,
    "schema_drift_log": f"""
        select detected_at, 'bronze' as source_name, 'bts_raw' as table_name, kind, column_name,
          cast(null as timestamp) as reviewed_at, cast(null as varchar) as reviewed_by, cast(null as varchar) as notes
        from (select unnest([timestamp '2024-02-01', timestamp '2024-02-02']) as detected_at) cross join
          ({_EXPECTED_DRIFT} union all select 'run_marker', null)""",
}
