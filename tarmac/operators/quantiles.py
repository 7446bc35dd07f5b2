"""Quantiles without rereading: a mergeable sketch for each period of a table, kept beside it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files

# Size of a sketch. Ranks are off by 0.28 % at most in 99 of 100 cases; the error stated allows for nearly twice that.
SKETCH_K = 1000
RANK_ERROR = 0.005


def period_sketches(df: DataFrame, column: str, period: str) -> DataFrame:
    """(period, sketch, rows) of a whole-number column; NULL values and periods are left out.

    Map tasks sketch what they read, so a period is a few sketches in the shuffle however large it is.
    """
    value = F.col(column).cast("bigint")
    return df.filter(value.isNotNull() & F.col(period).isNotNull()).groupBy(period).agg(
        F.kll_sketch_agg_bigint(value, SKETCH_K).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def refresh_sketches(
    spark: SparkSession, path: str, df: DataFrame, column: str, period: str, periods: Iterable | None = None,
) -> None:
    """Sketch the given periods anew (all if None), a folder each; only their rows are read.

    A period that has no values any more loses its folder. Repeating a run changes nothing but
    the sketches' own chance.
    """
    chosen = df if periods is None else df.filter(F.col(period).isin(periods := list(periods)))
    if periods is not None:
        names = {str(p) for p in periods}
    else:
        names = set(files.partition_values(spark, path, period))
    made = period_sketches(chosen, column, period)
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(f"{path}/.new")
    fresh = set(files.partition_values(spark, f"{path}/.new", period))
    for name in sorted(fresh | names):
        files.delete(spark, f"{path}/{period}={name}")
        if name in fresh:
            files.rename(spark, f"{path}/.new/{period}={name}", f"{path}/{period}={name}")
    files.delete(spark, f"{path}/.new")


def merged_quantile(sketches: DataFrame, q: float) -> DataFrame:
    """(periods, rows, quantile) from the sketches of all periods; NULL if there are none."""
    merged = sketches.agg(
        F.count(F.lit(1)).alias("periods"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))
    return merged.select(
        "periods", "rows",
        F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q))).alias("quantile"))


def rank_within(df: DataFrame, column: str, value: int | None, q: float, error: float = RANK_ERROR) -> DataFrame:
    """(rows, within): whether ``value`` has rank ``q`` among the rows, give or take the error."""
    known = df.filter(F.col(column).isNotNull())
    found = known.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(column) < F.lit(value)).alias("below"),
        F.count_if(F.col(column) <= F.lit(value)).alias("up_to"))
    return found.select("rows", (
        (F.col("below") <= (q + error) * F.col("rows")) & (F.col("up_to") >= (q - error) * F.col("rows"))).alias("within"))
