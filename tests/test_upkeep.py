"""Promotion and compaction that survive a failure at any step."""

import datetime as dt

from comparing import rows
from pyspark.sql import functions as F
from test_tables import Died, dying

from tarmac import files
from tarmac.operators import tables
from tarmac.streaming import ingest


def test_promotion_that_dies_anywhere_never_loses_prod(spark, tmp_path, monkeypatch):
    old, new = spark.range(100), spark.range(100, 201)
    died = 0
    for step in range(14):
        dev, prod = str(tmp_path / f"dev{step}"), str(tmp_path / f"prod{step}")
        old.write.parquet(f"{prod}/t")
        new.write.parquet(f"{dev}/t")
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                tables.exchange(spark, dev, prod)
            except Died:
                died += 1
        tables.settle_promotion(spark, prod)
        counts = (spark.read.parquet(f"{prod}/t").count(), spark.read.parquet(f"{dev}/t").count())
        assert counts in ((100, 101), (101, 100))
        assert not [f for f in tmp_path.iterdir() if f.name.startswith(f"prod{step}.") and not f.name.endswith(".draft")]
        if died <= step:
            assert counts == (101, 100)
            break
    assert died >= 8


def test_promotion_is_refused_or_made(spark, tmp_path):
    dev, prod = str(tmp_path / "dev"), str(tmp_path / "prod")
    spark.range(100).write.parquet(f"{prod}/t")
    spark.range(300).write.parquet(f"{dev}/t")
    assert tables.promote(spark, dev, prod, ["t"]).first().status == "FAIL"
    assert spark.read.parquet(f"{prod}/t").count() == 100
    spark.range(102).write.mode("overwrite").parquet(f"{dev}/t")
    assert tables.promote(spark, dev, prod, ["t"], dry_run=True).first().status == "OK"
    assert spark.read.parquet(f"{prod}/t").count() == 100
    tables.promote(spark, dev, prod, ["t"])
    assert spark.read.parquet(f"{prod}/t").count() == 102 and spark.read.parquet(f"{dev}/t").count() == 100


def bronze(spark, path):
    data = spark.range(0, 240, 1, 2).select(
        "id", F.when(F.col("id") % 2 == 0, "2024-01-01").otherwise("2024-01-02").alias("ds"),
        (F.col("id") / 2 % 3).cast("int").alias("hr"), (F.col("id") / 6 % 10).cast("int").alias("batch"))
    data.write.partitionBy("ds", "hr", "batch").parquet(path)
    return rows(data, "id", "ds", "hr")


def read(spark, path):
    return rows(spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string")), "id", "ds", "hr")


def test_closed_hours_become_few_files(spark, tmp_path):
    path = str(tmp_path / "bronze")
    before = bronze(spark, path)
    hour = lambda d, h: [f for f in files.sizes(spark, f"{path}/ds={d}/hr={h}")]
    assert len(hour("2024-01-01", 0)) >= 10
    done = ingest.compact_bronze(spark, path, dt.datetime(2024, 1, 2, 2, 30))
    assert done == ["2024-01-01 0", "2024-01-01 1", "2024-01-01 2", "2024-01-02 0", "2024-01-02 1"]
    assert read(spark, path) == before
    assert len(hour("2024-01-01", 0)) == len(hour("2024-01-02", 1)) == 1 and len(hour("2024-01-02", 2)) >= 10
    assert ingest.compact_bronze(spark, path, dt.datetime(2024, 1, 2, 2, 30)) == []
    # A target smaller than the hour: files are bounded by its bytes, not one.
    big = sum(files.sizes(spark, f"{path}/ds=2024-01-02/hr=2").values())
    assert ingest.compact_bronze(spark, path, dt.datetime(2024, 1, 3), target_bytes=-(-big // 3)) == ["2024-01-02 2"]
    assert 1 <= len(hour("2024-01-02", 2)) <= 3 and read(spark, path) == before


def test_compaction_that_dies_anywhere_changes_no_row(spark, tmp_path, monkeypatch):
    made = str(tmp_path / "made")
    before, died = bronze(spark, made), 0
    for step in range(0, 30, 3):
        path = str(tmp_path / f"t{step}")
        files.copy(spark, made, path)
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                ingest.compact_bronze(spark, path, dt.datetime(2024, 1, 2))
            except Died:
                died += 1
        tables.settle(spark, f"{path}/ds=2024-01-01")
        assert read(spark, path) == before
        if died <= step // 3:
            break
    assert died >= 2
