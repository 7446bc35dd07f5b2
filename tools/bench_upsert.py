"""Time the merge of one month (600,000 rows) into a fact of five million rows."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.operators.tables import upsert  # noqa: E402
from tarmac.session import build_session, scratch_path  # noqa: E402


def facts(spark, first: int, last: int, delay: int):
    """Rows of consecutive keys, 600,000 to a month."""
    rows = spark.range(first, last)
    month = F.col("id").cast("int") / 600_000
    return rows.select(
        F.md5(F.col("id").cast("string")).alias("flight_event_sk"),
        F.concat(F.lit("N"), F.col("id") % 9000).alias("aircraft_key"),
        (F.col("id") % 120 + delay).cast("int").alias("arr_delay_min"),
        F.timestamp_seconds(F.lit(1700000000) + F.col("id")).alias("scheduled_dep_ts"),
        (F.lit(202401) + F.floor(month)).cast("int").alias("flight_month"),
    )


def main() -> None:
    spark = build_session("tarmac-upsert", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    path, key = scratch_path(spark, "fact"), ["flight_event_sk"]
    begin = time.perf_counter()
    upsert(spark, path, facts(spark, 0, 5_000_000, 0), key, "flight_month")
    loaded = time.perf_counter()
    touched = upsert(spark, path, facts(spark, 4_500_000, 5_100_000, 1000), key, "flight_month")
    merged = time.perf_counter()
    rows = spark.read.parquet(path)
    print(json.dumps({
        "load_sec": round(loaded - begin, 2), "merge_sec": round(merged - loaded, 2),
        "partitions_rewritten": touched, "rows": rows.count(),
        "changed": rows.filter("arr_delay_min >= 1000").count()}))


if __name__ == "__main__":
    main()
