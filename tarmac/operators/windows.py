"""Which rows an incremental run takes: late-arrival window or backfill bounds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files


def high_water_mark(
    spark: SparkSession, path: str, date_column: str, partition_column: str
) -> dt.date | None:
    """Latest date in a table whose partitions ascend with that date.

    Partition folders are compared by name and one column of the last one is read,
    so the cost does not grow with the table.
    """
    values = files.partition_values(spark, path, partition_column)
    values = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
    if not values:
        return None
    if date_column == partition_column:
        return dt.date.fromisoformat(values[-1])
    newest = spark.read.parquet(f"{path}/{partition_column}={values[-1]}")
    return newest.agg(F.max(F.col(date_column).cast("date"))).first()[0]


def late_arrival(
    date: Column, mark: dt.date | None, days: int,
    backfill: tuple[dt.date, dt.date] | None = None,
) -> Column:
    """Backfill bounds if given (both included), else ``days`` back from the mark.

    Without a mark - an empty target - every row is taken. The bounds are literals,
    which lets the scan prune partitions.
    """
    if backfill and all(backfill):
        start, end = backfill
        return date.between(F.lit(start), F.lit(end))
    if mark is None:
        return F.lit(True)
    return date >= F.lit(mark - dt.timedelta(days=days))


def month_of(day: dt.date) -> int:
    """The month folder of a day, e.g. 202401."""
    return day.year * 100 + day.month


def window_start(
    spark: SparkSession, target_path: str, target_column: str, target_partition: str, days: int,
    backfill: tuple[dt.date, dt.date] | None = None,
) -> dt.date | None:
    """First day an incremental run looks at; None if it looks at everything."""
    if backfill and all(backfill):
        return backfill[0]
    mark = high_water_mark(spark, target_path, target_column, target_partition)
    return None if mark is None else mark - dt.timedelta(days=days)


def since_last_load(
    spark: SparkSession, source: DataFrame, target_path: str, source_column: str,
    target_partition: str, days: int, backfill: tuple[dt.date, dt.date] | None = None,
    target_column: str | None = None,
    folder: tuple[str, Callable[[dt.date], dt.date | int]] | None = None,
    folder_end: Callable[[dt.date], dt.date | int] | None = None,
) -> DataFrame:
    """Rows of ``source`` the next merge into ``target_path`` has to look at.

    ``folder`` names the source's partition column and tells, for a first day, the
    earliest partition such a day can be in; older partitions are then not read at all.
    ``folder_end`` tells the same of the last day of a backfill and the latest partition.
    """
    target_column = target_column or source_column
    start = window_start(spark, target_path, target_column, target_partition, days, backfill)
    if start is None:
        return source
    date = F.col(source_column).cast("date")
    if backfill:
        recent = source.filter(late_arrival(date, None, days, backfill))
    else:
        recent = source.filter(date >= F.lit(start))
    if folder:
        column, earliest = folder
        inside = F.col(column) >= F.lit(earliest(start))
        if folder_end and backfill and all(backfill):
            inside &= F.col(column) <= F.lit(folder_end(backfill[1]))
        recent = recent.filter(F.col(column).isNull() | inside)
    return recent
