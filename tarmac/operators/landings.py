"""Landing detection: airborne and fast in one report, on the ground in the next."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: slowest approach that still counts, metres per second.
MIN_APPROACH_MPS = 30


def touched_down(on_ground: Column, was_on_ground: Column, was_velocity: Column) -> Column:
    return on_ground & ~was_on_ground & (F.coalesce(was_velocity, F.lit(0.0)) > MIN_APPROACH_MPS)


# What a report says about landing.
REPORT_COLUMNS = ["on_ground", "velocity_mps"]
PASSED_ON = ("callsign", "latitude", "longitude", "bronze_loaded_at")


def landing_events(states: DataFrame, passed_on: Sequence[str] = PASSED_ON) -> DataFrame:
    """Landings from deduplicated state vectors, with columns of the landing report.

    "The previous report" is looked up inside one aircraft-day, so no group is longer
    than the seconds of a day, however many rows an aircraft has over the years. What
    a day cannot know - the report before its first one - is settled in a second pass
    that carries just the first and last report of each aircraft-day. Landings already
    found travel through that pass in groups of their own day.
    """
    in_day = Window.partitionBy("icao24", "event_day").orderBy("event_ts")
    rows = states.select(
        "icao24", "event_ts", *REPORT_COLUMNS, *passed_on, F.to_date("event_ts").alias("event_day"),
    ).select(
        "*",
        F.lag(F.struct(*REPORT_COLUMNS)).over(in_day).alias("before"),
        F.lead("event_ts").over(in_day).isNull().alias("closes_day"),
    )
    opens_day = F.col("before").isNull()
    found = F.coalesce(
        touched_down(F.col("on_ground"), F.col("before.on_ground"), F.col("before.velocity_mps")),
        F.lit(False),
    )
    edge = opens_day | F.col("closes_day")
    kept = rows.filter(edge | found).withColumn("chain_day", F.when(~edge, F.col("event_day")))

    along_chain = Window.partitionBy("icao24", "chain_day").orderBy("event_ts")
    settled = kept.withColumn(
        "earlier", F.lag(F.struct(*REPORT_COLUMNS)).over(along_chain)
    ).withColumn("before", F.when(opens_day, F.col("earlier")).otherwise(F.col("before")))
    return settled.filter(
        touched_down(F.col("on_ground"), F.col("before.on_ground"), F.col("before.velocity_mps"))
    ).select(
        "icao24", F.col("event_ts").alias("live_landing_ts"),
        F.col("before.velocity_mps").alias("approach_velocity_mps"), *passed_on,
    )


def day_tails(states: DataFrame) -> DataFrame:
    """The last report of each airframe on each day."""
    return states.groupBy("icao24", F.to_date("event_ts").alias("event_day")).agg(
        F.max(F.struct("event_ts", *REPORT_COLUMNS)).alias("last")
    ).select("icao24", "event_day", "last.*")


def reports_from(states: DataFrame, tails: DataFrame, start: dt.date) -> DataFrame:
    """Reports from ``start`` on, and each airframe's last report before it.

    That is all landing detection needs for landings from ``start`` on. Both inputs are
    partitioned by ``event_day``, so only the days asked for and the tails are read.
    """
    columns = ["icao24", "event_ts", *REPORT_COLUMNS]
    last = F.max(F.struct("event_ts", *REPORT_COLUMNS)).alias("last")
    before = tails.filter(F.col("event_day") < F.lit(start)).groupBy("icao24").agg(last)
    return states.filter(F.col("event_day") >= F.lit(start)).select(*columns).unionByName(
        before.select("icao24", "last.*").select(*columns))
