"""What dashboards ask of the gold tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.windows import month_of
from tarmac.plans.gold import ON_TIME_MINUTES

# Smallest number of flights a ranked route has, and default list sizes.
MIN_ROUTE_FLIGHTS = 30
TOP_ROUTES = 25
RECENT_FLIGHTS = 200
ACTIVE_DAYS = 90


def _days(table: DataFrame, column: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Rows of a span of days; the month folders, where there are any, are bounded as well."""
    rows = table.filter(F.col(column) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(column) <= F.lit(end))
    if "flight_month" in table.columns:
        rows = rows.filter(F.col("flight_month") >= month_of(start))
        if end is not None:
            rows = rows.filter(F.col("flight_month") <= month_of(end))
    return rows


def carrier_options(carriers: DataFrame, daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Carriers with a flight in the last ninety days, by name."""
    active = _days(daily, "flight_date", as_of - dt.timedelta(days=ACTIVE_DAYS))
    return (
        carriers.join(active.select("carrier_key"), "carrier_key", "left_semi")
        .select("carrier_key", "carrier_name").orderBy("carrier_name", "carrier_key")
    )


def otp_overview(
    daily: DataFrame, carriers: DataFrame, start: dt.date, end: dt.date,
    only: Sequence[str] | None = None,
) -> DataFrame:
    rows = _days(daily, "flight_date", start, end)
    if only:
        rows = rows.filter(F.col("carrier_key").isin(*only))
    return rows.join(carriers.select("carrier_key", "carrier_name"), "carrier_key").select(
        "flight_date", "carrier_key", "carrier_name", "flights_scheduled", "flights_completed",
        "flights_cancelled", "on_time_pct", "avg_arr_delay_min", "total_delay_min",
    ).orderBy("flight_date", "carrier_key")


def otp_pivot(overview: DataFrame, carriers: Sequence[str]) -> DataFrame:
    """On-time share by day, one column per carrier asked for."""
    return (
        overview.groupBy("flight_date").pivot("carrier_key", list(carriers)).avg("on_time_pct")
        .orderBy("flight_date")
    )


def top_delay_routes(
    fact: DataFrame, start: dt.date, end: dt.date, limit: int = TOP_ROUTES
) -> DataFrame:
    """Routes with the highest mean arrival delay; cancelled flights do not count."""
    delay = F.col("arr_delay_min")
    flown = _days(fact, "flight_date_key", start, end).filter(~F.col("cancelled_flag"))
    return (
        flown.groupBy(F.col("origin_airport_key").alias("origin_iata"),
                      F.col("dest_airport_key").alias("dest_iata"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.avg(delay).alias("avg_arr_delay_min"),
            F.count_if(delay > ON_TIME_MINUTES).alias("flights_late"),
            (F.count_if(delay <= ON_TIME_MINUTES) * F.lit(100.0) / F.count(F.lit(1)))
            .alias("on_time_pct"),
        )
        .filter(F.col("flights") >= MIN_ROUTE_FLIGHTS)
        .orderBy(F.col("avg_arr_delay_min").desc_nulls_last(), "origin_iata", "dest_iata")
        .limit(limit)
    )


def recent_flights(fact: DataFrame, day: dt.date, carrier: str, limit: int = RECENT_FLIGHTS) -> DataFrame:
    """Flights of one carrier on one day in departure order."""
    return (
        _days(fact, "flight_date_key", day, day).filter(F.col("carrier_key") == carrier)
        .orderBy("scheduled_dep_ts", "flight_event_sk").limit(limit)
        .select(
            F.col("flight_date_key").alias("flight_date"), "carrier_key", "flight_number",
            F.col("origin_airport_key").alias("origin_iata"),
            F.col("dest_airport_key").alias("dest_iata"),
            "scheduled_dep_ts", "actual_dep_ts", "scheduled_arr_ts", "actual_arr_ts",
            "dep_delay_min", "arr_delay_min", "cancelled_flag", "cancellation_code",
            "diverted_flag", "distance_miles", "reconciliation_status",
        )
    )


def kpi_summary(daily: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Totals over a date range; zeros where there is nothing to add up."""
    measures = {
        "flights_scheduled": F.sum("flights_scheduled"),
        "flights_completed": F.sum("flights_completed"),
        "flights_cancelled": F.sum("flights_cancelled"),
        "on_time_pct": F.avg("on_time_pct"),
        "total_delay_min": F.sum(F.coalesce("total_delay_min", F.lit(0))),
    }
    return _days(daily, "flight_date", start, end).agg(*[
        F.coalesce(value.cast("double"), F.lit(0.0)).alias(name) for name, value in measures.items()
    ])
