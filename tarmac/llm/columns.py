"""Column expressions and tables shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import scratch_path


def lower_ascii(text: str | Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % modulus


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later plans start from files, whichever executors are left."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
