"""Merges by key alone, and the filters that tell them where to look."""

import datetime as dt

from comparing import rows
from pyspark.sql import functions as F
from test_tables import COLS, D, Died, dying, frame, read

from tarmac import files
from tarmac.operators import keyindex, tables


def test_a_key_that_moves_leaves_one_row(spark, tmp_path):
    path = str(tmp_path / "t")
    merge = lambda data: tables.upsert_by_key(spark, path, frame(spark, data), ["k"], "day")
    assert merge([(1, D[0], "a"), (2, D[0], "b"), (3, D[1], "c"), (4, D[2], "d")]) == [str(d) for d in D[:3]]
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2024-01-03").rglob("*")}
    # To a new partition, between known ones, and within one; the partition that loses its last row goes.
    assert merge([(1, D[3], "A"), (3, D[0], "C"), (2, D[0], "B")]) == [str(D[0]), str(D[1]), str(D[3])]
    assert read(spark, path) == [(1, D[3], "A"), (2, D[0], "B"), (3, D[0], "C"), (4, D[2], "d")]
    assert files.partition_values(spark, path, "day") == [str(D[0]), str(D[2]), str(D[3])]
    assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2024-01-03").rglob("*")}
    assert merge([]) == []
    assert merge([(1, D[3], "A")]) == [str(D[3])]


def test_repeated_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.upsert_by_key(spark, path, frame(spark, [(1, D[0], "x"), (1, D[1], "z"), (None, D[0], "n")]), ["k"], "day",
                             latest_by=[F.col("v").desc()])
    assert read(spark, path) == [(1, D[1], "z"), (None, D[0], "n"), (None, D[0], "n")]


def test_only_folders_that_may_hold_the_key_are_looked_into(spark, tmp_path, monkeypatch):
    path, days = str(tmp_path / "t"), [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(12)]
    data = spark.range(6000).select(F.col("id").cast("int").alias("k"), F.date_add(F.lit(days[0]), (F.col("id") % 12).cast("int")).alias("day"),
                                    F.lit("a").alias("v"))
    tables.upsert_by_key(spark, path, data, ["k"], "day")
    wanted = data.filter("k in (5, 17, 6)").select("k")
    assert keyindex.folders_that_may_hold(spark, path, [str(d) for d in days], wanted, ["k"], "day") == [str(days[5]), str(days[6])]
    absent = spark.range(6000, 106_000).select(F.col("id").cast("int").alias("k"))
    named = keyindex.folders_that_may_hold(spark, path, [str(d) for d in days], absent.limit(2000), ["k"], "day")
    assert len(named) <= 2
    # A data file that must not be listed: its folder is made unreadable as a table.
    (tmp_path / "t" / f"day={days[9]}" / "part-broken.parquet").write_text("not a table")
    assert tables.upsert_by_key(spark, path, frame(spark, [(5, days[3], "moved")]), ["k"], "day") == [str(days[3]), str(days[5])]


def test_folders_without_filter_are_looked_into_and_can_get_one(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, D[0], "a"), (2, D[1], "b")]), ["k"], "day")
    asked = frame(spark, [(9, D[0], "")]).select("k")
    days = [str(D[0]), str(D[1])]
    assert keyindex.folders_that_may_hold(spark, path, days, asked, ["k"], "day") == days
    keyindex.write_filters(spark, path, days, ["k"], "day")
    assert keyindex.folders_that_may_hold(spark, path, days, asked, ["k"], "day") == []
    tables.upsert_by_key(spark, path, frame(spark, [(1, D[1], "A")]), ["k"], "day")
    assert read(spark, path) == [(1, D[1], "A"), (2, D[1], "b")]
    # A plain merge rewrites a folder without its filter: the next one looks into it.
    tables.upsert(spark, path, frame(spark, [(3, D[1], "c")]), ["k"], "day")
    tables.upsert_by_key(spark, path, frame(spark, [(3, D[2], "C")]), ["k"], "day")
    assert read(spark, path) == [(1, D[1], "A"), (2, D[1], "b"), (3, D[2], "C")]


def test_filters_of_many_blocks_hold_every_key(spark):
    data = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("p"))
    made = keyindex.filters_of(data, ["k"], "p")
    sizes = {r.p: r.blocks for r in made.select("p", "blocks").distinct().collect()}
    assert sizes[0] == 32 and sizes[1] == 4
    set_bits = made.select(F.expr("aggregate(words, 0, (n, w) -> n + int(bit_count(w)))").alias("n")).agg(F.avg("n")).first()[0]
    assert 4_000 < set_bits < 16_000


def test_merge_by_key_that_dies_anywhere(spark, tmp_path, monkeypatch):
    before = [(1, D[0], "a"), (2, D[0], "b"), (3, D[1], "c")]
    source = frame(spark, [(3, D[0], "C"), (1, D[2], "A"), (4, D[2], "d")])
    after = [(1, D[2], "A"), (2, D[0], "b"), (3, D[0], "C"), (4, D[2], "d")]
    made, died = str(tmp_path / "first"), 0
    tables.upsert_by_key(spark, made, frame(spark, before), ["k"], "day")
    for step in range(0, 60, 4):
        path = str(tmp_path / f"t{step}")
        spark.read.parquet(made).write.partitionBy("day").parquet(path)
        keyindex.write_filters(spark, path, [str(D[0]), str(D[1])], ["k"], "day")
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                tables.upsert_by_key(spark, path, source, ["k"], "day")
            except Died:
                died += 1
        tables.settle(spark, path)
        assert read(spark, path) in (sorted(before), after)
        if step % 8 == 0:
            tables.upsert_by_key(spark, path, source, ["k"], "day")
            assert read(spark, path) == after
        if died <= step // 4:
            break
    assert died > 3


def test_columns_come_and_go(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_by_key(spark, path, frame(spark, [(1, D[0], "a"), (9, D[1], "q")]), ["k"], "day")
    tables.upsert_by_key(spark, path, frame(spark, [(1, D[1], 7)], "k int, day date, extra int"), ["k"], "day")
    assert rows(tables.read_table(spark, path), "k", "day", "v", "extra") == [(1, D[1], None, 7), (9, D[1], "q", None)]
    assert COLS
