"""Projection over inputs whose columns come and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column of that name in any letter case, or a NULL of ``dtype``.

    Returns a bare expression, so that it can stand inside another one.
    """
    for actual in df.columns:
        if actual.lower() == name.lower():
            return F.col(f"`{actual}`")
    return F.lit(None).cast(dtype)


def first_present(df: DataFrame, *names: str, dtype: str = "string") -> Column:
    """Value of a renamed column: the first non-NULL among its old and new names."""
    return F.coalesce(*[column_or_null(df, n, dtype) for n in names])
