"""Joins of flights to landings: by time band, and to the nearest one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a landing counts up to two hours before or after the scheduled arrival.
BAND_SECONDS = 2 * 3600
_SLOT = 2 * BAND_SECONDS  # a band touches at most two slots of this width


def _slots(instant: str):
    """The one or two time slots the band around ``instant`` touches."""
    at = F.unix_seconds(instant)
    low = F.floor((at - BAND_SECONDS) / _SLOT)
    high = F.floor((at + BAND_SECONDS) / _SLOT)
    return F.explode(F.array_distinct(F.array(low, high)))


def _slot(instant: str):
    return F.floor(F.unix_seconds(instant) / _SLOT)


def flights_with_aircraft(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Every flight, with the airframe its carrier and number point to (or NULL)."""
    return flights.join(aircraft, ["carrier_code", "flight_number"], "left")


def landing_candidates(flights: DataFrame, landings: DataFrame) -> DataFrame:
    """Landings of a flight's airframe within the band, both ends included.

    Equality on airframe and time slot makes it a hash-partitioned join: a busy
    airframe is spread over its slots, and a row meets only landings of its own band.
    """
    left = flights.filter(F.col("icao24").isNotNull() & F.col("scheduled_arr_ts").isNotNull()).select(
        "flight_event_natural_key", "icao24", "scheduled_arr_ts",
        _slots("scheduled_arr_ts").alias("slot"),
    )
    right = landings.select("icao24", "live_landing_ts", _slot("live_landing_ts").alias("slot"))
    apart = F.abs(F.unix_seconds("live_landing_ts") - F.unix_seconds("scheduled_arr_ts"))
    return left.join(right, ["icao24", "slot"]).filter(apart <= BAND_SECONDS).select(
        "flight_event_natural_key", "live_landing_ts", apart.alias("ts_diff_s")
    )


def nearest_landings(arrivals: DataFrame, landings: DataFrame) -> DataFrame:
    """For each (icao24, scheduled_arr_ts) the landing nearest to it, if one is in the band.

    An as-of lookup that builds no pairs: arrivals and landings are put in time order
    within an airframe's slot, and each arrival sees the last landing before it and the
    first one after it. Slots hold at most a few thousand distinct seconds. Of two
    equally near landings the earlier one counts.
    """
    asked = arrivals.filter(F.col("icao24").isNotNull() & F.col("scheduled_arr_ts").isNotNull())
    asked = asked.select("icao24", "scheduled_arr_ts").distinct()
    points = asked.select(
        "icao24", _slots("scheduled_arr_ts").alias("slot"),
        F.unix_seconds("scheduled_arr_ts").alias("at"), F.lit(None).cast("bigint").alias("landed"),
        F.lit(1).alias("asks"),
    ).unionByName(
        landings.select(
            "icao24", _slot("live_landing_ts").alias("slot"),
            F.unix_seconds("live_landing_ts").alias("at"),
            F.unix_seconds("live_landing_ts").alias("landed"), F.lit(0).alias("asks"),
        )
    )
    group = Window.partitionBy("icao24", "slot")
    seen = points.select(
        "*",
        F.last("landed", ignorenulls=True).over(group.orderBy("at", "asks")).alias("before"),
        F.last("landed", ignorenulls=True).over(group.orderBy(F.desc("at"), "asks")).alias("after"),
    ).filter("asks = 1")

    def option(c: str):
        gap = F.abs(F.col(c) - F.col("at"))
        return F.when(gap <= BAND_SECONDS, F.struct(gap.alias("gap"), F.col(c).alias("landed")))

    best = F.min(F.least(option("before"), option("after")))
    return (
        seen.groupBy("icao24", "at").agg(best.alias("best"))
        .filter(F.col("best").isNotNull())
        .select(
            "icao24",
            F.timestamp_seconds("at").alias("scheduled_arr_ts"),
            F.timestamp_seconds("best.landed").alias("live_actual_arr_ts"),
            F.col("best.gap").alias("ts_diff_s"),
        )
    )
