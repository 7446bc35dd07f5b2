import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac import files
from tarmac.operators import tables
from tarmac.operators.windows import high_water_mark, late_arrival, since_last_load

D = [dt.date(2024, 1, n) for n in range(1, 10)]
COLS = "k int, day date, v string"


def frame(spark, data, schema=COLS):
    return spark.createDataFrame(data, schema)


def read(spark, path, *cols):
    return rows(tables.read_table(spark, path), *(cols or ("k", "day", "v")))


def test_upsert_inserts_updates_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, D[0], "a"), (2, D[0], "b"), (3, D[1], "c")]), ["k"], "day")
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2024-01-02").iterdir()}
    source = frame(spark, [(2, D[0], "B"), (4, D[2], "d")])
    for _ in range(2):
        assert tables.upsert(spark, path, source, ["k"], "day") == ["2024-01-01", "2024-01-03"]
        assert read(spark, path) == [(1, D[0], "a"), (2, D[0], "B"), (3, D[1], "c"), (4, D[2], "d")]
    assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "day=2024-01-02").iterdir()}


def test_upsert_empty_source_and_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, D[0], "a")]), ["k"], "day")
    assert tables.upsert(spark, path, frame(spark, []), ["k"], "day") == []
    tables.upsert(spark, path, frame(spark, [(1, D[0], "x"), (1, D[0], "z"), (1, D[0], "y")]), ["k"], "day",
                  latest_by=[F.col("v").desc()])
    assert read(spark, path) == [(1, D[0], "z")]


def test_upsert_into_nothing_with_empty_source(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.upsert(spark, path, frame(spark, []), ["k"], "day") == []
    assert not files.exists(spark, path)


class Died(Exception):
    pass


def dying(monkeypatch, step):
    """From now on the ``step``-th folder operation fails, after it has been done for even steps."""
    done = [0]
    for name in ("rename", "delete", "make_folder"):
        def operation(*args, real=getattr(files, name)):
            done[0] += 1
            if done[0] == step // 2 + 1:
                if step % 2:
                    real(*args)
                raise Died
            return real(*args)
        monkeypatch.setattr(files, name, operation)


def test_upsert_that_dies_anywhere_loses_nothing(spark, tmp_path, monkeypatch):
    before = [(1, D[0], "a"), (2, D[0], "b"), (3, D[1], "c")]
    source = frame(spark, [(2, D[0], "B"), (3, D[1], "C"), (4, D[2], "d")])
    after = [(1, D[0], "a"), (2, D[0], "B"), (3, D[1], "C"), (4, D[2], "d")]
    died = 0
    for step in range(40):
        path = str(tmp_path / f"t{step}")
        tables.upsert(spark, path, frame(spark, before), ["k"], "day")
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                tables.upsert(spark, path, source, ["k"], "day")
            except Died:
                died += 1
        tables.settle(spark, path)
        assert read(spark, path) in (sorted(before), after)
        tables.upsert(spark, path, source, ["k"], "day")
        assert read(spark, path) == after
        assert not [n for n in files.names(spark, path) if n.startswith("_") and n != "_SUCCESS"]
        if died <= step:
            break
    assert died > 12


def test_refresh_that_dies_anywhere_leaves_a_table(spark, tmp_path, monkeypatch):
    old, new = frame(spark, [(1, D[0], "a")]), frame(spark, [(2, D[1], "b")])
    for step in range(12):
        path = str(tmp_path / f"t{step}")
        tables.full_refresh(spark, path, old)
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                tables.full_refresh(spark, path, new)
            except Died:
                pass
        tables.settle(spark, path)
        assert rows(spark.read.parquet(path)) in ([(1, D[0], "a")], [(2, D[1], "b")])
        tables.full_refresh(spark, path, new)
        assert rows(spark.read.parquet(path)) == [(2, D[1], "b")]
        assert not [f for f in tmp_path.iterdir() if f.name.startswith(f"t{step}.")]


def test_upsert_columns_come_and_go(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, D[0], "a"), (9, D[1], "q")]), ["k"], "day")
    tables.upsert(spark, path, frame(spark, [(2, D[0], 7)], "k int, day date, extra int"), ["k"], "day")
    assert read(spark, path, "k", "v", "extra") == [(1, "a", None), (2, None, 7), (9, "q", None)]


def test_numeric_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in ("a", "b"):
        tables.upsert(spark, path, frame(spark, [(1, 202401, v)], "k int, month int, v string"), ["k"], "month")
    assert read(spark, path, "k", "month", "v") == [(1, 202401, "b")]


def test_full_refresh_may_read_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.full_refresh(spark, path, frame(spark, [(1, D[0], "a"), (2, D[0], "b")]))
    tables.full_refresh(spark, path, spark.read.parquet(path).filter("k = 2"))
    assert rows(spark.read.parquet(path)) == [(2, D[0], "b")]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


ATTR = "k int, name string, lat double"
T = [dt.datetime(2024, 1, n) for n in range(1, 9)]


def test_scd2_cases(spark):
    first = frame(spark, [(1, "a", None), (2, "b", 1.0), (3, "c", 3.0), (4, "d", 4.0)], ATTR)
    table = tables.open_versions(first, T[0])
    second = frame(spark, [(1, "a", 1.5), (2, "b", None), (3, "c", 3.0), (5, "e", 5.0)], ATTR)
    check = ["name", "lat"]
    table = tables.scd2_merge(table, second, "k", check, T[1])
    expected = sorted([
        (1, "a", None, T[0], T[1]), (1, "a", 1.5, T[1], None),     # NULL to value
        (2, "b", 1.0, T[0], T[1]), (2, "b", None, T[1], None),     # value to NULL
        (3, "c", 3.0, T[0], None),                                 # unchanged
        (4, "d", 4.0, T[0], T[1]),                                 # deleted
        (5, "e", 5.0, T[1], None),                                 # new
    ], key=repr)
    assert rows(table, "k", "name", "lat", "valid_from", "valid_to") == expected
    again = tables.scd2_merge(table, second, "k", check, T[2])
    assert rows(again, "k", "name", "lat", "valid_from", "valid_to") == expected
    back = tables.scd2_merge(again, second.unionByName(frame(spark, [(4, "d", 4.0)], ATTR)), "k", check, T[3])
    assert rows(back.filter("k = 4"), "valid_from", "valid_to") == [(T[0], T[1]), (T[3], None)]


def test_scd2_unchecked_columns_do_not_open_versions(spark):
    table = tables.open_versions(frame(spark, [(1, "a", 1.0)], ATTR), T[0])
    table = tables.scd2_merge(table, frame(spark, [(1, "a", 2.0)], ATTR), "k", ["name"], T[1])
    assert rows(table, "lat", "valid_from", "valid_to") == [(1.0, T[0], None)]


def test_scd2_columns_come_and_go(spark):
    table = tables.open_versions(frame(spark, [(1, "a", 1.0)], ATTR), T[0])
    table = tables.scd2_merge(table, frame(spark, [(1, "a", "x")], "k int, name string, city string"), "k", ["name"], T[1])
    assert rows(table, "k", "name", "lat", "city", "valid_to") == [(1, "a", 1.0, None, None)]
    table = tables.scd2_merge(table, frame(spark, [(1, "b", "x")], "k int, name string, city string"), "k", ["name"], T[2])
    assert rows(table, "name", "lat", "city", "valid_from", "valid_to") == [
        ("a", 1.0, None, T[0], T[2]), ("b", None, "x", T[2], None)]


def test_version_at_bounds(spark):
    versions = frame(spark, [(1, "old", T[1], T[3]), (1, "new", T[3], None)],
                     "k int, name string, valid_from timestamp, valid_to timestamp")
    facts = frame(spark, [(n, 1, T[n]) for n in range(5)] + [(9, 2, T[2])], "id int, ref int, at timestamp")
    got = tables.version_at(facts, versions, "ref", "k", "at")
    assert rows(got, "id", "dim_name") == [(0, None), (1, "old"), (2, "old"), (3, "new"), (4, "new"), (9, None)]


def test_promote_parity_bounds(spark):
    def n(count):
        return spark.range(count)

    dev = {"low": n(98), "edge": n(99), "high": n(106), "top": n(105), "zero": n(5), "only_dev": n(1)}
    prod = {"low": n(100), "edge": n(100), "high": n(100), "top": n(100), "zero": n(0), "only_prod": n(1)}
    got = {r.table_name: r.status for r in tables.promote_parity(dev, prod).collect()}
    assert got == {"low": "FAIL", "edge": "OK", "high": "FAIL", "top": "OK", "zero": "SKIP"}


def test_promote_swaps_only_when_all_pass(spark, tmp_path):
    dev, prod = str(tmp_path / "dev"), str(tmp_path / "prod")
    spark.range(100).write.parquet(f"{dev}/t")
    spark.range(100, 200).write.parquet(f"{prod}/t")
    assert [r.status for r in tables.promote(spark, dev, prod, ["t"], dry_run=True).collect()] == ["OK"]
    assert spark.read.parquet(f"{prod}/t").agg(F.min("id")).first()[0] == 100
    tables.promote(spark, dev, prod, ["t"])
    assert spark.read.parquet(f"{prod}/t").agg(F.min("id")).first()[0] == 0
    spark.range(1).write.mode("overwrite").parquet(f"{dev}/t")
    assert [r.status for r in tables.promote(spark, dev, prod, ["t"]).collect()] == ["FAIL"]
    assert spark.read.parquet(f"{prod}/t").count() == 100
    with pytest.raises(ValueError):
        tables.promote(spark, dev, prod, ["other"])


def test_expire_keeps_the_boundary_day(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [(i, d, "x") for i, d in enumerate(D)]).write.partitionBy("day").parquet(path)
    gone = tables.expire_partitions(spark, path, "day", dt.date(2024, 1, 10), 5)
    assert gone == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    assert spark.read.parquet(path).agg(F.min("day")).first()[0] == dt.date(2024, 1, 5)


def test_late_arrival_and_backfill(spark, tmp_path):
    path = str(tmp_path / "t")
    source = frame(spark, [(i, d, "x") for i, d in enumerate(D)]).withColumn("month", F.lit(202401))
    assert high_water_mark(spark, path, "day", "month") is None
    assert since_last_load(spark, source, path, "day", "month", 2).count() == 9
    source.filter("k <= 6").write.partitionBy("month").parquet(path)
    assert high_water_mark(spark, path, "day", "month") == D[6]
    assert rows(since_last_load(spark, source, path, "day", "month", 2), "k") == [(4,), (5,), (6,), (7,), (8,)]
    between = since_last_load(spark, source, path, "day", "month", 2, backfill=(D[0], D[1]))
    assert rows(between, "k") == [(0,), (1,)]
    assert source.filter(late_arrival(F.col("day"), None, 2)).count() == 9
