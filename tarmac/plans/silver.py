"""Silver tables: cleaned states, reconciled flights, and their upkeep."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files
from tarmac.functions.values import month_number
from tarmac.operators.dedupe import keep_latest, latest_aircraft, latest_sightings, sightings
from tarmac.operators.landings import REPORT_COLUMNS, day_tails, landing_events, reports_from
from tarmac.operators.tables import full_refresh, settle, upsert
from tarmac.operators.windows import since_last_load, window_start
from tarmac.plans.flights import mapped_callsigns, reconcile_staged
from tarmac.schemas import SILVER_FLIGHT_COLUMNS, SILVER_STATE_COLUMNS

# How far back late rows may still arrive.
FLIGHTS_LATE_DAYS = 35
STATES_LATE_DAYS = 2

STATE_KEY = ["icao24", "event_ts"]
FLIGHT_KEY = ["flight_event_natural_key"]


def unique_states(states: DataFrame) -> DataFrame:
    return keep_latest(states, STATE_KEY, "bronze_loaded_at", decisive=REPORT_COLUMNS)


def unique_reports(states: DataFrame) -> DataFrame:
    """What landing detection needs of ``unique_states``, reading only that."""
    return unique_states(states.select(*STATE_KEY, *REPORT_COLUMNS, "bronze_loaded_at"))


def unique_flights(flights: DataFrame) -> DataFrame:
    return keep_latest(flights, FLIGHT_KEY, "bronze_loaded_at")


def silver_aircraft_state(states: DataFrame, run_ts: dt.datetime) -> DataFrame:
    narrow = states.select(*[c for c in SILVER_STATE_COLUMNS if c != "ingested_at"])
    return unique_states(narrow).withColumn("ingested_at", F.lit(run_ts).cast("timestamp"))


def _silver_rows(events: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return events.withColumn("ingested_at", F.lit(run_ts).cast("timestamp")).select(
        *SILVER_FLIGHT_COLUMNS)


def silver_flight_event(
    flights: DataFrame, airports: DataFrame, states: DataFrame, run_ts: dt.datetime,
    map_icao: DataFrame | None = None, **options: bool,
) -> DataFrame:
    """Reconciled flights from staged flights and the whole of the staged states.

    ``options`` are ``roll_overnight`` and ``plain_numbers`` of the reconciliation.
    """
    aircraft = latest_aircraft(mapped_callsigns(states, map_icao))
    landings = landing_events(unique_reports(states), passed_on=())
    events = reconcile_staged(
        flights, unique_flights(flights), airports, aircraft, landings, **options)
    return _silver_rows(events, run_ts)


# --- incremental loads -----------------------------------------------------------------

@dataclass(frozen=True)
class StateTables:
    """Silver states with two small tables that spare going back over their history."""

    states: str     # partitioned by event_day
    tails: str      # last report of each airframe and day, same partitions
    sightings: str  # last sighting of each (carrier, flight number)

    @classmethod
    def below(cls, root: str) -> StateTables:
        return cls(f"{root}/silver_aircraft_state", f"{root}/aircraft_day_tail", f"{root}/aircraft_sighting")


def recent_states(
    spark: SparkSession, path: str, states: DataFrame, backfill: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """The staged reports a load has to look at; the bounds are fixed now.

    Bronze folders go by ingest day, which is never before the event; one day of slack
    covers clocks that disagree. A backfill ends as many days late as reports may be.
    """
    return since_last_load(
        spark, states, path, "event_ts", "event_day", STATES_LATE_DAYS, backfill,
        folder=("event_date", lambda day: day - dt.timedelta(days=1))
        if "event_date" in states.columns else None,
        folder_end=lambda day: day + dt.timedelta(days=STATES_LATE_DAYS + 1),
    )


def load_silver_states(
    spark: SparkSession, path: str, states: DataFrame, run_ts: dt.datetime,
    backfill: tuple[dt.date, dt.date] | None = None,
) -> list[str]:
    """Merge new states into the table partitioned by the day of ``event_ts``.

    Returns the days that were rewritten.
    """
    return _merge_states(spark, path, recent_states(spark, path, states, backfill), run_ts)


def _merge_states(spark: SparkSession, path: str, recent: DataFrame, run_ts: dt.datetime) -> list[str]:
    rows = silver_aircraft_state(recent, run_ts).withColumn("event_day", F.to_date("event_ts"))
    return upsert(spark, path, rows, STATE_KEY, "event_day", sort_by=["icao24", "event_ts"])


def load_states(
    spark: SparkSession, tables: StateTables, states: DataFrame, run_ts: dt.datetime,
    backfill: tuple[dt.date, dt.date] | None = None, map_icao: DataFrame | None = None,
) -> list[str]:
    """Merge new states and bring the two tables derived from them up to date.

    Sightings come from all staged reports of the load, as in the plan, also from copies that
    the silver states replace; the last of old and new ones is kept. They go first: if the
    run dies, the next sees the same reports again and nothing is missed.
    """
    for path in (tables.states, tables.tails, tables.sightings):
        settle(spark, path)
    recent = recent_states(spark, tables.states, states, backfill)
    seen = sightings(mapped_callsigns(recent, map_icao))
    if files.holds_data(spark, tables.sightings):
        seen = seen.unionByName(spark.read.parquet(tables.sightings))
    full_refresh(spark, tables.sightings, latest_sightings(seen))
    days = _merge_states(spark, tables.states, recent, run_ts)
    if days:
        touched = spark.read.option("basePath", tables.states).parquet(
            *[f"{tables.states}/event_day={d}" for d in days])
        day_tails(touched).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("event_day").parquet(tables.tails)
    return days


def landings_from(
    spark: SparkSession, tables: StateTables, start: dt.date | None, end: dt.date | None = None,
) -> DataFrame:
    """Landings from a day on and up to another, or all of them, out of the silver states."""
    states = spark.read.parquet(tables.states)
    if end is not None:
        states = states.filter(F.col("event_day") <= F.lit(end))
    if start is None:
        return landing_events(states, passed_on=())
    reports = reports_from(states, spark.read.parquet(tables.tails), start)
    return landing_events(reports, passed_on=()).filter(
        F.col("live_landing_ts") >= F.lit(start).cast("timestamp"))


def load_silver_flights(
    spark: SparkSession, path: str, flights: DataFrame, airports: DataFrame, tables: StateTables,
    run_ts: dt.datetime, backfill: tuple[dt.date, dt.date] | None = None, **options: bool,
) -> list[str]:
    """Merge new flights into the table partitioned by month.

    Flights are cut to the late-arrival window by month folder and date. Landings are
    computed from two days before it: zones and the band move an arrival by less.
    """
    window = (path, "flight_date", "flight_month", FLIGHTS_LATE_DAYS, backfill)
    recent = since_last_load(
        spark, flights, path, "flight_date", "flight_month", FLIGHTS_LATE_DAYS, backfill,
        folder=("flight_date_partition", lambda day: day.replace(day=1)), folder_end=lambda day: day.replace(day=1),
    )
    start = window_start(spark, *window)
    margin = dt.timedelta(days=2)
    end = backfill[1] + margin if backfill and all(backfill) else None
    landings = landings_from(spark, tables, start and start - margin, end)
    aircraft = spark.read.parquet(tables.sightings).drop("event_ts")
    events = reconcile_staged(
        recent, unique_flights(recent), airports, aircraft, landings, **options)
    rows = _silver_rows(events, run_ts).withColumn("flight_month", month_number(F.col("flight_date")))
    return upsert(spark, path, rows, FLIGHT_KEY, "flight_month", sort_by=["carrier_code", "flight_date"])


def silver_lookup(
    silver: DataFrame, carrier: str, number: str, day: dt.date
) -> DataFrame:
    """One flight by carrier, number and date; all three reach the scan as filters.

    Should several qualify, the first departure counts.
    """
    columns = ["distance_miles", "scheduled_dep_ts", "origin_iata", "dest_iata", "dep_delay_min"]
    hit = (
        (F.col("carrier_code") == carrier)
        & (F.col("flight_number") == str(number))
        & (F.col("flight_date") == F.lit(day))
    )
    if "flight_month" in silver.columns:
        hit &= F.col("flight_month") == day.year * 100 + day.month
    return (
        silver.filter(hit).orderBy("scheduled_dep_ts", "flight_event_natural_key").limit(1)
        .select(*columns)
    )
