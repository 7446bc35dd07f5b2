"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.keys import row_hash


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The rank filter is pushed below the shuffle as a per-partition group limit, so
    each map task sends at most one row per key however many copies a key has.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame, keys: Sequence[str], loaded_at: str, decisive: Sequence[str] = ()
) -> DataFrame:
    """The latest loaded row of every key; equal load times are settled by row hashes.

    The hash of the ``decisive`` columns comes first. A caller that has just those
    columns then gets the same values as one that has all, without reading the rest.
    """
    order = [F.col(loaded_at).desc_nulls_last()]
    if decisive:
        order.append(row_hash(decisive).desc())
    rest = sorted(set(df.columns) - {*keys, loaded_at, *decisive})
    if rest:
        order.append(row_hash(rest).desc())
    return keep_first(df, keys, order)


def latest_aircraft(callsigns: DataFrame) -> DataFrame:
    """The airframe last seen flying under each (carrier, flight number)."""
    return latest_sightings(sightings(callsigns)).drop("event_ts")


def sightings(callsigns: DataFrame) -> DataFrame:
    return callsigns.select(
        F.col("cs_carrier").alias("carrier_code"), F.col("cs_flight_num").alias("flight_number"),
        "icao24", "event_ts")


def latest_sightings(seen: DataFrame) -> DataFrame:
    """The last sighting of each (carrier, flight number), with its time.

    Earlier results may be put in again together with new sightings, which keeps a
    lookup table current without going back to old reports.
    """
    last = F.max(F.struct("event_ts", "icao24"))
    return seen.groupBy("carrier_code", "flight_number").agg(last.alias("last")).select(
        "carrier_code", "flight_number", "last.icao24", "last.event_ts")
