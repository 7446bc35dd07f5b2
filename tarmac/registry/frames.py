"""Frames the registered queries start from, and the tables some of them read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import standins
from tarmac.operators.staging import stg_airlines, stg_airports, stg_flights, stg_states
from tarmac.operators.tables import full_refresh, read_table
from tarmac.plans import gold, silver
from tarmac.plans.flights import int_flights
from tarmac.session import scratch_path

RUN_TS = dt.datetime(2024, 2, 1)
SNAPSHOT_TS = dt.datetime(2024, 1, 1)
START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 31)


def flights(spark: SparkSession, d: str) -> DataFrame:
    return stg_flights(standins.flights_raw(spark, d))


def states(spark: SparkSession, d: str) -> DataFrame:
    return stg_states(standins.states_raw(spark, d))


def airports(spark: SparkSession, d: str) -> DataFrame:
    return stg_airports(standins.airports_raw(spark, d), RUN_TS)


def airlines(spark: SparkSession, d: str) -> DataFrame:
    return stg_airlines(standins.airlines_raw(spark, d), RUN_TS)


def timed_flights(spark: SparkSession, d: str) -> DataFrame:
    return int_flights(silver.unique_flights(flights(spark, d)), airports(spark, d))


def silver_flights(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_flight_event(
        flights(spark, d), airports(spark, d), states(spark, d), RUN_TS)


def airport_dim(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_airport(gold.airport_snapshot(airports(spark, d), SNAPSHOT_TS), RUN_TS)


def carrier_dim(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_carrier(airlines(spark, d), RUN_TS)


def points(spark: SparkSession, d: str) -> DataFrame:
    return points_of(standins.table(spark, d, "events"))


def points_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("metric_name"), "value",
        F.when(F.col("user_id") % 2 == 0, "producer").otherwise("consumer").alias("component"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


_built: dict[tuple[str, str], dict[str, str]] = {}


def warehouse(spark: SparkSession, d: str) -> dict[str, str]:
    """Paths of silver and gold tables, loaded by the merges once per session and input.

    Dashboards, checks and the delay service read tables, not the plans behind them.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _built:
        root = scratch_path(spark, "warehouse")
        paths = {
            name: f"{root}/{name}" for name in (
                "silver_flight_event", "fct_flight_event", "agg_carrier_otp_daily", "dim_carrier",
                "dim_airport", "dim_aircraft", "dim_date")
        }
        staged = flights(spark, d)
        state_tables = silver.StateTables.below(root)
        silver.load_states(spark, state_tables, states(spark, d), RUN_TS)
        silver.load_silver_flights(
            spark, paths["silver_flight_event"], staged, airports(spark, d), state_tables, RUN_TS)
        full_refresh(spark, paths["dim_carrier"], carrier_dim(spark, d))
        full_refresh(spark, paths["dim_airport"], airport_dim(spark, d))
        full_refresh(spark, paths["dim_aircraft"], gold.dim_aircraft(staged, RUN_TS))
        full_refresh(spark, paths["dim_date"], gold.dim_date(
            gold.date_spine(gold.calendar_bounds(staged)), gold.holiday_frame(spark)))
        gold.load_fact(
            spark, paths["fct_flight_event"], spark.read.parquet(paths["silver_flight_event"]),
            spark.read.parquet(paths["dim_airport"]), RUN_TS)
        gold.load_daily(
            spark, paths["agg_carrier_otp_daily"], spark.read.parquet(paths["fct_flight_event"]), RUN_TS)
        _built[key] = paths
    return _built[key]


def gold_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, path) for name, path in warehouse(spark, d).items()}
