"""Reading the bronze layer: partitioned files without an enforced schema."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import files
from tarmac.schemas import AIRLINES_RAW, AIRPORTS_RAW

_MODIFIED = "_metadata.file_modification_time"


def _all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv_bronze(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """CSV files below ``ds=`` folders, every column a string, plus their load time.

    Files may have other columns, or the same in another order, also within a month, and
    Spark reads CSV by position. So the header of each file is looked up first (its first
    line; files are months or parts of them) and files with equal headers are read together.
    """
    found = dates if dates is not None else files.partition_values(spark, path, "ds")
    paths = [
        f"{path}/ds={d}/{name}" for d in found for name in files.names(spark, f"{path}/ds={d}")
        if not name.startswith(("_", "."))
    ]

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(file).columns)

    with ThreadPoolExecutor(max_workers=8) as pool:
        headers = list(pool.map(header, paths))
    alike: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, columns in zip(paths, headers, strict=True):
        alike[columns].append(file)
    parts = [
        spark.read.schema(_all_strings(list(columns))).option("header", True)
        .option("basePath", path).csv(group)
        .withColumn("ds", F.col("ds").cast("date"))
        .withColumn("bronze_loaded_at", F.col(_MODIFIED))
        for columns, group in alike.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_parquet_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Parquet rolls below ``ds=/hr=`` folders, plus their load time."""
    return (
        spark.read.option("mergeSchema", "true").parquet(path)
        .withColumn("ds", F.col("ds").cast("date"))
        .withColumn("bronze_loaded_at", F.col(_MODIFIED))
    )


def _read_reference(
    spark: SparkSession, path: str, file_name: str, schema: T.StructType, as_of: dt.date | None
) -> DataFrame:
    days = [
        d for d in files.partition_values(spark, path, "ds")
        if (as_of is None or d <= as_of.isoformat()) and files.exists(spark, f"{path}/ds={d}/{file_name}")
    ]
    if not days:
        raise FileNotFoundError(f"no {file_name} below {path}")
    file = f"{path}/ds={days[-1]}/{file_name}"
    first = spark.read.text(file).first()
    # Every record starts with a number; a first line that does not is a header.
    headed = first is not None and not first.value.split(",")[0].strip(' "\ufeff').lstrip("-").isdigit()
    return spark.read.schema(schema).option("header", headed).option("enforceSchema", True).csv(file)


def read_airports(spark: SparkSession, path: str, as_of: dt.date | None = None) -> DataFrame:
    """The newest airport list, with or without a header line (columns are named here)."""
    return _read_reference(spark, path, "airports.csv", AIRPORTS_RAW, as_of)


def read_airlines(spark: SparkSession, path: str, as_of: dt.date | None = None) -> DataFrame:
    """The newest airline list, with or without a header line (columns are named here)."""
    return _read_reference(spark, path, "airlines.csv", AIRLINES_RAW, as_of)


def discover_schema(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, rows_with_value) of whatever was found."""
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    lines = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("rows_with_value"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return counted.select(F.explode(lines).alias("line")).select("line.*")


def observe_files(spark: SparkSession, path: str, as_of: dt.datetime) -> DataFrame:
    """Newest file, number of files and lag over today's and yesterday's partitions.

    The binary file source lists files without opening them as long as their content
    is not asked for. No partition or no file gives the version ``empty``.
    """
    days = [(as_of.date() - dt.timedelta(days=n)).isoformat() for n in (0, 1)]
    present = [d for d in files.partition_values(spark, path, "ds") if d in days]
    if present:
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "[!_.]*")
            .load([f"{path}/ds={d}" for d in present]).select("path", "modificationTime")
        )
    else:
        listing = spark.createDataFrame([], "path string, modificationTime timestamp")
    now = F.lit(as_of).cast("timestamp")
    return listing.agg(
        F.max("modificationTime").alias("latest"), F.count("path").alias("object_count")
    ).select(
        "latest", "object_count",
        (F.unix_seconds(now) - F.unix_seconds("latest")).alias("lag_seconds"),
        F.coalesce(F.date_format("latest", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("empty")).alias("data_version"),
    )
