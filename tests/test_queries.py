"""Every registered query against its reference SQL, and the rules for the registry."""


import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="session")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, db, name):
    df = entry_module.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert found
        return
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, found) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_module.queries())


def test_plans_of_the_flagship(spark):
    """Copies are cut before the shuffle, and no join compares all pairs."""
    plan = entry_module.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
