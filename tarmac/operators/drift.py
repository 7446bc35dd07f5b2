"""Schema drift: columns that appeared or went missing, and who looked at it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import DRIFT_LOG

# Kinds that need a review, and the days a review may take.
REVIEWED_KINDS = ("added", "removed")
REVIEW_DAYS = 7


def schema_drift(live: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(kind, column_name) for every column only one side has; letter case is ignored.

    ``live`` has the found columns in ``column_name``, as ``discover_schema`` gives them.
    """
    have = live.select(F.lower("column_name").alias("column_name"))
    want = live.sparkSession.createDataFrame([(c.lower(),) for c in expected], "column_name string")
    added = have.subtract(want).select(F.lit("added").alias("kind"), "column_name")
    removed = want.subtract(have).select(F.lit("removed").alias("kind"), "column_name")
    return added.unionByName(removed)


def drift_rows(
    source_name: str, table_name: str, live: DataFrame, expected: Sequence[str],
    detected_at: dt.datetime,
) -> DataFrame:
    """Log rows of one run. A marker row shows that the run took place."""
    marker = live.sparkSession.createDataFrame(
        [("run_marker", None)], "kind string, column_name string")
    found = marker.unionByName(schema_drift(live, expected))
    nothing = F.lit(None)
    return found.select(
        F.lit(detected_at).cast("timestamp").alias("detected_at"),
        F.lit(source_name).alias("source_name"), F.lit(table_name).alias("table_name"),
        "kind", "column_name", nothing.cast("timestamp").alias("reviewed_at"),
        nothing.cast("string").alias("reviewed_by"), nothing.cast("string").alias("notes"),
    )


def append_drift(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_drift_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DRIFT_LOG).parquet(path)


def overdue(as_of: dt.datetime, kinds: Sequence[str] | None = REVIEWED_KINDS) -> Column:
    """Entries nobody reviewed in time; ``kinds=None`` takes marker rows in as well."""
    limit = F.lit(as_of - dt.timedelta(days=REVIEW_DAYS)).cast("timestamp")
    late = F.col("reviewed_at").isNull() & (F.col("detected_at") < limit)
    return late if kinds is None else late & F.col("kind").isin(*kinds)


def unreviewed_drift(log: DataFrame, as_of: dt.datetime) -> DataFrame:
    return log.filter(overdue(as_of)).select(
        "detected_at", "source_name", "table_name", "kind", "column_name")


def unreviewed_drift_count(
    log: DataFrame, as_of: dt.datetime, kinds: Sequence[str] | None = REVIEWED_KINDS
) -> DataFrame:
    return log.agg(F.count_if(overdue(as_of, kinds)).alias("unreviewed"))
