"""Gold star schema: dimensions, flight fact, daily carrier aggregate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files
from tarmac.functions.keys import change_marker, flight_surrogate, version_key
from tarmac.functions.values import month_number
from tarmac.operators.dedupe import keep_first
from tarmac.operators.tables import (
    change_feed, full_refresh, open_versions, replace_partitions, scd2_merge, settle, upsert, upsert_by_key, version_at)
from tarmac.operators.windows import month_of, since_last_load
from tarmac.plans.silver import FLIGHTS_LATE_DAYS
from tarmac.session import scratch_path

# Fixed value: an arrival up to this many minutes late is on time.
ON_TIME_MINUTES = 14

# Attributes whose change opens a new airport version.
AIRPORT_CHECK_COLUMNS = [
    "name", "city", "country", "icao", "latitude", "longitude", "elevation_ft", "timezone",
]

# United States federal holidays.
FEDERAL_HOLIDAYS = [
    ("2024-01-01", "New Years Day"),
    ("2024-01-15", "Martin Luther King Jr. Day"),
    ("2024-02-19", "Washingtons Birthday"),
    ("2024-05-27", "Memorial Day"),
    ("2024-06-19", "Juneteenth"),
    ("2024-07-04", "Independence Day"),
    ("2024-09-02", "Labor Day"),
    ("2024-10-14", "Columbus Day"),
    ("2024-11-11", "Veterans Day"),
    ("2024-11-28", "Thanksgiving"),
    ("2024-12-25", "Christmas"),
]
FIRST_DAY = dt.date(1987, 1, 1)


def _stamp(run_ts: dt.datetime) -> Column:
    return F.lit(run_ts).cast("timestamp")


def dim_carrier(airlines: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row per carrier code; rows with an ICAO code win, then the lowest id."""
    chosen = keep_first(
        airlines.filter(F.col("carrier_key").isNotNull()), ["carrier_key"],
        [F.col("icao_code").isNull(), F.col("openflights_id").asc_nulls_last()],
    )
    return chosen.select(
        "carrier_key", "carrier_name", "icao_code", "country",
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.lit(FIRST_DAY).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        _stamp(run_ts).alias("ingested_at"),
    )


def airport_snapshot_source(airports: DataFrame) -> DataFrame:
    """The airport attributes whose history is kept, one row per code."""
    unique = keep_first(
        airports.filter(F.col("iata").isNotNull()), ["iata"],
        [F.col("openflights_id").asc_nulls_last()],
    )
    return unique.select("iata", *AIRPORT_CHECK_COLUMNS)


def airport_snapshot(airports: DataFrame, as_of: dt.datetime, table: DataFrame | None = None) -> DataFrame:
    source = airport_snapshot_source(airports)
    if table is None:
        return open_versions(source, as_of)
    return scd2_merge(table, source, "iata", AIRPORT_CHECK_COLUMNS, as_of)


def load_airport_snapshot(spark: SparkSession, path: str, airports: DataFrame, as_of: dt.datetime) -> None:
    """Bring the stored history of airports up to what a list says as of a time."""
    settle(spark, path)
    known = spark.read.parquet(path) if files.holds_data(spark, path) else None
    full_refresh(spark, path, airport_snapshot(airports, as_of, known))


def dim_airport(snapshot: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return snapshot.filter(F.col("iata").isNotNull()).select(
        version_key(F.col("iata"), F.col("valid_from")).alias("airport_sk"),
        F.col("iata").alias("airport_key"),
        F.col("icao").alias("icao_code"),
        "name", "city", "country",
        F.lit(None).cast("string").alias("state"),
        "latitude", "longitude", "elevation_ft", "timezone",
        F.to_date("valid_from").alias("valid_from"),
        F.to_date("valid_to").alias("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
        _stamp(run_ts).alias("ingested_at"),
    )


def dim_aircraft(flights: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Tail numbers seen in staged flights with their operator."""
    unknown_text, unknown_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    return (
        flights.filter(F.col("tail_number").isNotNull())
        .groupBy(F.col("tail_number").alias("aircraft_key"))
        .agg(F.max("carrier_code").alias("operator_carrier_key"))
        .select(
            "aircraft_key",
            unknown_text.alias("icao24"), unknown_text.alias("manufacturer"),
            unknown_text.alias("model"), "operator_carrier_key",
            unknown_int.alias("year_built"), unknown_int.alias("seat_capacity"),
            _stamp(run_ts).alias("ingested_at"),
        )
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """All days from ``start`` up to but not including ``end`` of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence("start", F.date_sub("end", 1), F.expr("interval 1 day")))
        .alias("date_key")
    )


def calendar_bounds(flights: DataFrame) -> DataFrame:
    """From the first day kept to two years past the latest flight."""
    return flights.agg(F.max("flight_date").alias("last")).select(
        F.lit(FIRST_DAY).alias("start"), F.add_months("last", 24).alias("end")
    )


def holiday_frame(spark: SparkSession) -> DataFrame:
    rows = [(dt.date.fromisoformat(day), name) for day, name in FEDERAL_HOLIDAYS]
    return spark.createDataFrame(rows, "date_key date, holiday_name string")


def dim_date(days: DataFrame, holidays: DataFrame) -> DataFrame:
    day = F.col("date_key")
    iso_day = F.weekday(day) + 1
    return days.join(
        holidays.select("date_key", F.lit(True).alias("listed")), "date_key", "left"
    ).select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
        F.col("listed").isNotNull().alias("is_us_federal_holiday"),
        # The fiscal year starts in October, so shifting by three months aligns it.
        F.year(F.add_months(day, 3)).alias("fiscal_year"),
        F.quarter(F.add_months(day, 3)).alias("fiscal_quarter"),
        F.weekofyear(day).alias("iso_week"),
    )


def fct_flight_event(silver: DataFrame, airports: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row per scheduled flight, with the current airport versions."""
    current = airports.filter("is_current").select("airport_key", "airport_sk")
    origin = current.select(
        F.col("airport_key").alias("origin_iata"), F.col("airport_sk").alias("origin_airport_sk"))
    dest = current.select(
        F.col("airport_key").alias("dest_iata"), F.col("airport_sk").alias("dest_airport_sk"))
    joined = silver.join(origin, "origin_iata", "left").join(dest, "dest_iata", "left")
    key = F.col("flight_event_natural_key")
    return joined.select(
        flight_surrogate(key).alias("flight_event_sk"),
        F.col("flight_date").alias("flight_date_key"),
        F.col("carrier_code").alias("carrier_key"),
        F.col("origin_iata").alias("origin_airport_key"),
        F.col("dest_iata").alias("dest_airport_key"),
        "origin_airport_sk", "dest_airport_sk",
        F.col("tail_number").alias("aircraft_key"),
        "flight_number", "scheduled_dep_ts", "actual_dep_ts", "scheduled_arr_ts", "actual_arr_ts",
        "dep_delay_min", "arr_delay_min", "cancelled_flag", "cancellation_code", "diverted_flag",
        "distance_miles", "live_actual_arr_ts", "reconciliation_status", "source_system",
        _stamp(run_ts).alias("ingested_at"),
        change_marker(key, F.col("actual_dep_ts"), F.col("actual_arr_ts"),
                      F.col("cancelled_flag"), F.col("cancellation_code")).alias("record_hash"),
    )


def fct_flight_event_at(silver: DataFrame, airports: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The fact with the airport versions valid on the day of the flight instead of the current ones.

    Versions go by days: one is valid from its first day up to, not including, its last.
    """
    fact = fct_flight_event(silver, airports, run_ts)
    versions = airports.select("airport_key", "airport_sk", "valid_from", "valid_to")
    for end in ("origin", "dest"):
        names = {f"dim_{c}" for c in versions.columns}
        found = version_at(fact, versions, f"{end}_airport_key", "airport_key", "flight_date_key")
        fact = found.withColumn(f"{end}_airport_sk", F.col("dim_airport_sk")).drop(*names)
    return fact


def agg_carrier_otp_daily(fact: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Daily punctuality per carrier.

    The numerator of the on-time share counts every row with an on-time arrival, the
    denominator only flights that were not cancelled; without any, the share is NULL.
    """
    delay, cancelled = F.col("arr_delay_min"), F.col("cancelled_flag")
    completed = F.count_if(~cancelled)
    return fact.groupBy(F.col("flight_date_key").alias("flight_date"), "carrier_key").agg(
        F.count(F.lit(1)).alias("flights_scheduled"),
        completed.alias("flights_completed"),
        F.count_if(cancelled).alias("flights_cancelled"),
        (F.count_if(delay <= ON_TIME_MINUTES) * F.lit(100.0) / F.nullif(completed, F.lit(0)))
        .alias("on_time_pct"),
        F.avg(delay).alias("avg_arr_delay_min"),
        F.sum(F.coalesce(delay, F.lit(0))).alias("total_delay_min"),
    ).withColumn("ingested_at", _stamp(run_ts))


def _month_folder(table: DataFrame):
    return ("flight_month", month_of) if "flight_month" in table.columns else None


def load_fact(
    spark: SparkSession, path: str, silver: DataFrame, airports: DataFrame, run_ts: dt.datetime,
    backfill: tuple[dt.date, dt.date] | None = None,
) -> None:
    recent = since_last_load(
        spark, silver, path, "flight_date", "flight_month", FLIGHTS_LATE_DAYS, backfill,
        target_column="flight_date_key", folder=_month_folder(silver), folder_end=month_of,
    )
    rows = fct_flight_event(recent, airports, run_ts).withColumn(
        "flight_month", month_number(F.col("flight_date_key")))
    upsert(spark, path, rows, ["flight_event_sk"], "flight_month",
           sort_by=["flight_date_key", "carrier_key"])


def load_daily(
    spark: SparkSession, path: str, fact: DataFrame, run_ts: dt.datetime,
    backfill: tuple[dt.date, dt.date] | None = None,
) -> None:
    recent = since_last_load(
        spark, fact, path, "flight_date_key", "flight_month", FLIGHTS_LATE_DAYS, backfill,
        target_column="flight_date", folder=_month_folder(fact), folder_end=month_of,
    )
    rows = agg_carrier_otp_daily(recent, run_ts).withColumn(
        "flight_month", month_number(F.col("flight_date")))
    upsert(spark, path, rows, ["flight_date", "carrier_key"], "flight_month",
           sort_by=["flight_date"])


# --- the daily aggregate from changes ----------------------------------------------------

_DAY = ["flight_date", "carrier_key"]
_FEED = ["flight_date_key", "carrier_key", "arr_delay_min", "cancelled_flag"]
# What can be added up and taken away again; shares and averages are made from these when read.
DAILY_SUMS = ["flights_scheduled", "flights_completed", "flights_cancelled", "on_time_flights", "arrivals", "total_delay_min"]


def daily_sums(rows: DataFrame) -> DataFrame:
    """Additive counts by day and carrier of facts; with a ``sign`` column, of a change feed."""
    sign = F.col("sign") if "sign" in rows.columns else F.lit(1)
    delay, cancelled = F.col("arr_delay_min"), F.col("cancelled_flag")
    of = lambda condition: F.sum(F.when(condition, sign).otherwise(0)).cast("long")
    return rows.groupBy(F.col("flight_date_key").alias("flight_date"), "carrier_key").agg(
        F.sum(sign).cast("long").alias("flights_scheduled"), of(~cancelled).alias("flights_completed"),
        of(cancelled).alias("flights_cancelled"), of(delay <= ON_TIME_MINUTES).alias("on_time_flights"),
        of(delay.isNotNull()).alias("arrivals"), F.sum(F.coalesce(delay, F.lit(0)) * sign).cast("long").alias("total_delay_min"))


def daily_from_sums(sums: DataFrame) -> DataFrame:
    """Punctuality as ``agg_carrier_otp_daily`` gives it, from additive counts."""
    return sums.select(
        *_DAY, "flights_scheduled", "flights_completed", "flights_cancelled",
        (F.col("on_time_flights") * F.lit(100.0) / F.nullif("flights_completed", F.lit(0))).alias("on_time_pct"),
        (F.col("total_delay_min") / F.nullif("arrivals", F.lit(0))).alias("avg_arr_delay_min"), "total_delay_min")


def _months_of(spark: SparkSession, path: str, months: list[str]) -> DataFrame | None:
    known = [m for m in files.partition_values(spark, path, "flight_month") if m in set(months)]
    return spark.read.option("basePath", path).parquet(
        *[f"{path}/flight_month={m}" for m in known]) if known else None


def _put_days(spark: SparkSession, path: str, days: DataFrame, replace: bool) -> None:
    """Add the sums of ``days`` to the table, or put them in place of its rows; a day without flights goes."""
    days = days.withColumn("flight_month", month_number(F.col("flight_date")))
    months = [str(r[0]) for r in days.select("flight_month").distinct().collect()]
    held = _months_of(spark, path, months)
    rows = days.select(*_DAY, *DAILY_SUMS, "flight_month")
    if held is not None:
        kept = held.join(days.select(*_DAY), _DAY, "left_anti") if replace else held
        rows = rows.unionByName(kept.select(*rows.columns))
    total = rows.groupBy(*_DAY, "flight_month").agg(*[F.sum(c).alias(c) for c in DAILY_SUMS]).filter("flights_scheduled > 0")
    replace_partitions(spark, path, total, "flight_month", months, sort_by=["flight_date"])


def settle_daily(spark: SparkSession, fact_path: str, daily_path: str) -> None:
    """After a run that died: the days its changes touched are made again from the facts as they are."""
    note = f"{daily_path}.pending"
    if not files.exists(spark, note):
        return
    settle(spark, fact_path)
    days = spark.read.parquet(files.read_note(spark, note)).select(
        F.col("flight_date_key").alias("flight_date"), "carrier_key").distinct()
    months = [str(r[0]) for r in days.select(month_number(F.col("flight_date"))).distinct().collect()]
    none = days.withColumns({c: F.lit(0).cast("long") for c in DAILY_SUMS})
    facts = _months_of(spark, fact_path, months)
    if facts is not None:
        again = daily_sums(facts.withColumnRenamed("flight_date_key", "flight_date").join(days, _DAY, "left_semi")
                           .withColumnRenamed("flight_date", "flight_date_key"))
        none = none.unionByName(again)
    settle(spark, daily_path)
    _put_days(spark, daily_path, none.groupBy(*_DAY).agg(*[F.sum(c).alias(c) for c in DAILY_SUMS]), replace=True)
    files.delete(spark, note)


def load_changes(spark: SparkSession, fact_path: str, daily_path: str, rows: DataFrame) -> None:
    """Merge facts by key and carry what has changed into the daily sums; unchanged rows cost nothing there.

    ``rows`` are facts, each key once. Late, changed and moved flights take their old version out of
    its day and add the new one; a carrier-day whose last flight has gone disappears. The feed is
    noted beside the daily table before the facts change, so a run that dies is put right by the
    next one (``settle_daily``), whichever step it had reached.
    """
    settle_daily(spark, fact_path, daily_path)
    rows = rows.withColumn("flight_month", month_number(F.col("flight_date_key")))
    feed = scratch_path(spark, "fact-changes")
    change_feed(spark, fact_path, rows, ["flight_event_sk"], "flight_month", _FEED).write.parquet(feed)
    note = f"{daily_path}.pending"
    files.write_note(spark, note, feed)
    upsert_by_key(spark, fact_path, rows, ["flight_event_sk"], "flight_month", sort_by=["flight_date_key", "carrier_key"])
    _put_days(spark, daily_path, daily_sums(spark.read.parquet(feed)), replace=False)
    files.delete(spark, note)
    files.delete(spark, feed)
