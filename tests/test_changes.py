"""The daily aggregate kept from changes equals the one made from all facts."""

import datetime as dt

from comparing import rows
from test_tables import D, Died, dying

from tarmac import files
from tarmac.operators import tables
from tarmac.plans import gold

FACT = "flight_event_sk string, flight_date_key date, carrier_key string, arr_delay_min int, cancelled_flag boolean"
RUN = dt.datetime(2024, 2, 1)
FIRST = [("a", D[0], "AA", 5, False), ("b", D[0], "AA", 30, False), ("c", D[1], "DL", None, True), ("d", D[1], "DL", -3, False)]
# Later, moved to another month, moved from a day that has no other flight, cancelled, new, unchanged.
NEXT = [("a", D[0], "AA", 50, False), ("b", dt.date(2024, 3, 1), "AA", 30, False), ("d", D[1], "DL", None, True), ("e", D[2], "WN", 0, False)]


def kept(spark, daily):
    return rows(gold.daily_from_sums(spark.read.parquet(daily)))


def made(spark, facts):
    names = ["flight_date", "carrier_key", "flights_scheduled", "flights_completed", "flights_cancelled", "on_time_pct",
             "avg_arr_delay_min", "total_delay_min"]
    return rows(gold.agg_carrier_otp_daily(facts, RUN), *names)


def test_changes_equal_the_recomputed_table(spark, tmp_path):
    fact, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    for load in (FIRST, NEXT, NEXT, [("b", D[0], "AA", 30, False)], [("c", D[4], "DL", None, True), ("d", D[4], "DL", 1, False)]):
        gold.load_changes(spark, fact, daily, spark.createDataFrame(load, FACT))
        assert kept(spark, daily) == made(spark, spark.read.parquet(fact))
    assert not [r for r in kept(spark, daily) if r[0] == D[1]]  # its last flights have gone
    assert files.partition_values(spark, daily, "flight_month") == ["202401"]


def test_feed_has_changed_rows_only(spark, tmp_path):
    fact, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    gold.load_changes(spark, fact, daily, spark.createDataFrame(FIRST, FACT))
    source = spark.createDataFrame([*NEXT, FIRST[2]], FACT).selectExpr("*", "int(date_format(flight_date_key, 'yyyyMM')) as flight_month")
    feed = tables.change_feed(spark, fact, source, ["flight_event_sk"], "flight_month", ["flight_date_key", "arr_delay_min"])
    assert sorted(r.sign for r in feed.collect()) == [-1, -1, -1, 1, 1, 1, 1]


def test_load_that_dies_anywhere_is_put_right(spark, tmp_path, monkeypatch):
    died, source = 0, spark.createDataFrame(NEXT, FACT)
    first_fact, first_daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    gold.load_changes(spark, first_fact, first_daily, spark.createDataFrame(FIRST, FACT))
    for step in range(1, 60, 9):
        fact, daily = str(tmp_path / f"fact{step}"), str(tmp_path / f"daily{step}")
        files.copy(spark, first_fact, fact)
        files.copy(spark, first_daily, daily)
        with monkeypatch.context() as patch:
            dying(patch, step)
            try:
                gold.load_changes(spark, fact, daily, source)
            except Died:
                died += 1
        gold.settle_daily(spark, fact, daily)
        tables.settle(spark, fact)
        tables.settle(spark, daily)
        assert kept(spark, daily) == made(spark, spark.read.parquet(fact))
    assert died >= 3
