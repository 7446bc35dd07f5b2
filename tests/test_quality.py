import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac.operators import monitoring as m
from tarmac.operators import quality as q

NOW = dt.datetime(2024, 2, 1, 12)
H = dt.timedelta(hours=1)


def test_row_conditions_and_nulls(spark):
    df = spark.createDataFrame([("A", "AA"), ("X", "ABC"), (None, None)], "code string, carrier string")
    assert rows(df.filter(q.not_in("code", ["A"])), "code") == [("X",)]
    assert rows(df.filter(q.length_differs("carrier", 2)), "carrier") == [("ABC",)]
    assert rows(df.filter(q.is_null("code")), "code") == [(None,)]
    assert df.filter(q.untrue(F.col("code") == "A")).count() == 2


def test_delay_and_cancel_expressions(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame(
        [("ok", 5, False, t, t + dt.timedelta(minutes=5, seconds=30), t), ("bad", 6, False, t, t + dt.timedelta(minutes=5), t),
         ("none", None, False, t, None, t), ("cancelled", 9, True, t, None, None), ("unknown", 5, False, t, None, t),
         ("departed", 0, True, t, t, t)],
        "id string, arr_delay_min int, cancelled_flag boolean, scheduled_arr_ts timestamp, actual_arr_ts timestamp, "
        "actual_dep_ts timestamp")
    assert rows(df.filter(q.untrue(q.delay_matches_times())), "id") == [("bad",), ("unknown",)]
    assert rows(df.filter(q.untrue(q.cancelled_never_departed())), "id") == [("departed",)]
    assert rows(df.filter(q.arrives_after(t)), "id") == [("bad",), ("ok",)]


def test_duplicates_and_orphans_ignore_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "b")], "k int, v string")
    assert rows(q.duplicates(df, ["k", "v"])) == [(1, "a", 2)]
    parent = spark.createDataFrame([("a",)], "key string")
    assert rows(q.orphans(df, "v", parent, "key")) == [("b", 1)]


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.95, 1.0])
def test_quantile_is_exact(spark, fraction):
    import numpy as np

    data = [int(x) for x in np.random.default_rng(1).integers(-30, 200, 997)]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "v int").repartition(4)
    assert q.quantile(df, "v", fraction).first()[0] == pytest.approx(np.quantile(data, fraction))


def test_recency_and_freshness(spark):
    def at(*times):
        return spark.createDataFrame([(t,) for t in times], "ts timestamp")

    assert q.recency(at(NOW - 25 * H), "ts", NOW, 25).first().stale is False
    assert q.recency(at(NOW - 26 * H), "ts", NOW, 25).first().stale is True
    assert q.recency(at(), "ts", NOW, 25).first().stale is True
    got = q.source_freshness({
        "opensky_raw": (at(NOW - dt.timedelta(minutes=16)), "ts"), "bts_raw": (at(NOW - 36 * 24 * H), "ts"),
        "x": (at(NOW - 49 * H), "ts"), "y": (at(NOW - 24 * H), "ts"), "empty": (at(), "ts"),
    }, NOW)
    assert {r.table_name: r.status for r in got.collect()} == {
        "opensky_raw": "warn", "bts_raw": "warn", "x": "error", "y": "pass", "empty": "error"}
    sla = q.sla_status({"silver_aircraft_state": (at(NOW - dt.timedelta(minutes=31)), "ts"),
                        "dim_date": (at(NOW - 6 * H), "ts"), "fct_flight_event": (at(), "ts")}, NOW)
    assert {r.table_name: r.breached for r in sla.collect()} == {
        "silver_aircraft_state": True, "dim_date": False, "fct_flight_event": True}


def test_trailing_volume(spark):
    data = [(dt.date(2024, mth, 1),) for mth, n in ((1, 10), (2, 10), (3, 8), (4, 7)) for _ in range(n)]
    got = q.trailing_volume(spark.createDataFrame(data, "d date"), "d").orderBy("month").collect()
    assert [r.low for r in got] == [False, False, False, True]
    by_value = q.trailing_volume(spark.createDataFrame(data, "d date"), "d", value=F.lit(5.0))
    assert by_value.filter("volume <> 5.0 or low").count() == 0


def test_counts_differ_both_ways(spark):
    d = dt.date(2024, 1, 1)
    detail = spark.createDataFrame([(d, "AA"), (d, "AA"), (d, "DL")], "flight_date_key date, carrier_key string")
    daily = spark.createDataFrame([(d, "AA", 2), (d, "WN", 1)], "flight_date date, carrier_key string, flights_scheduled bigint")
    assert rows(q.counts_differ(detail, daily), "carrier_key", "detail_count", "flights_scheduled") == [
        ("DL", 1, None), ("WN", None, 1)]


def test_runner_and_failures(spark, tmp_path):
    t = {"t": spark.createDataFrame([(1, "a"), (1, None), (None, None)], "k int, v string")}
    checks = [
        q.RowCheck("k_null", "t", q.is_null("k"), tags=q.CRITICAL), q.RowCheck("v_null", "t", q.is_null("v"), "warn"),
        q.RowCheck("v_ok", "t", q.not_in("v", ["a"])), q.TableCheck("k_unique", lambda x: q.duplicates(x["t"], ["k"])),
    ]
    report = q.run_checks(t, checks)
    assert rows(report) == [("k_null", "error", 1), ("k_unique", "error", 1), ("v_null", "warn", 2), ("v_ok", "error", 0)]
    assert rows(q.gate(report), "check_name") == [("k_null",), ("k_unique",)]
    assert [c.name for c in q.select_checks(checks, tags=["critical"])] == ["k_null"]
    assert [c.name for c in q.select_checks(checks, severity="warn")] == ["v_null"]
    folders = q.store_failures(t, checks, str(tmp_path / "f"))
    assert q.read_failures(spark, folders["v_null"]).count() == 2
    assert rows(q.read_failures(spark, folders["k_unique"])) == [(1, 2)]
    assert q.read_failures(spark, folders["v_ok"]) is None


def points(spark, *values):
    return spark.createDataFrame(
        [("m", float(v), "c", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t)) for t, v in values],
        "metric_name string, value double, component string, ts timestamp")


SPAN = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 6))


def states(df):
    return [r.state for r in df.orderBy("window_start").collect()]


def test_alarm_needs_consecutive_breaches(spark):
    alarm = m.Alarm("a", "m", "c", 60, 2, 5)
    data = points(spark, (0, 6), (1, 3), (1.5, 3), (3, 9), (4, 5), (5, 6))
    assert states(m.evaluate_alarm(data, alarm, *SPAN)) == ["OK", "ALARM", "OK", "OK", "OK", "OK"]


def test_missing_data_may_breach(spark):
    silent = m.Alarm("a", "m", None, 60, 2, 1, comparison="less", missing_breaches=True)
    data = points(spark, (0, 1), (3, 5))
    assert states(m.evaluate_alarm(data, silent, *SPAN)) == ["OK", "OK", "ALARM", "OK", "OK", "ALARM"]
    nothing = m.evaluate_alarm(points(spark, (99, 1)), silent, *SPAN)
    assert states(nothing) == ["OK"] + ["ALARM"] * 5


def test_alarm_statistic_and_groups(spark):
    alarm = m.Alarm("a", "m", None, 60, 1, 5, statistic="max")
    data = points(spark, (0, 4), (0.5, 4), (1, 6))
    assert states(m.evaluate_alarm(data, alarm, *SPAN))[:2] == ["OK", "ALARM"]
    both = data.unionByName(data.withColumn("component", F.lit("other")))
    assert m.evaluate_alarm(both, alarm, *SPAN, "component").filter("state = 'ALARM'").count() == 2


def test_lag_usage_alerts(spark):
    lags = spark.createDataFrame([(n, None if s is None else NOW - dt.timedelta(seconds=s)) for n, s in
                                  (("a", 120), ("b", 121), ("c", 600), ("d", 601), ("e", None))], "n string, latest timestamp")
    assert rows(m.lag_status(lags, NOW), "n", "status") == [
        ("a", "ok"), ("b", "warn"), ("c", "warn"), ("d", "fatal"), ("e", "no_data")]
    usage = spark.createDataFrame(
        [("w", NOW - dt.timedelta(minutes=75), 9.0), ("w", NOW - dt.timedelta(minutes=74), 1.5), ("w", NOW, 2.0)],
        "warehouse_name string, end_time timestamp, credits_used double")
    assert rows(m.usage_last_window(usage, NOW)) == [("w", 3.5)]
    alerts = spark.createDataFrame(
        [("1", NOW, "test", "Critical,gold"), ("2", NOW + H, "test", "gold"), ("3", NOW + H, "other", "critical"),
         ("4", NOW + 2 * H, "model_error", "CRITICAL"), ("5", NOW + 2 * H, "test", None)],
        "alert_id string, detected_at timestamp, alert_class string, tags string")
    assert rows(alerts.withColumn("s", m.alert_severity()), "alert_id", "s") == [
        ("1", "critical"), ("2", "warning"), ("3", "warning"), ("4", "critical"), ("5", "warning")]
    page = m.alerts_after(alerts, NOW, limit=2)
    assert [r.alert_id for r in page.collect()] == ["2", "3"]
    assert tuple(m.next_cursor(page, NOW).first()) == (NOW + H, "3")
    assert tuple(m.next_cursor(m.alerts_after(alerts, NOW + 9 * H), NOW).first()) == (NOW, None)
    # A page that ends between alerts of one time: the next goes on inside it.
    one = m.next_cursor(m.alerts_after(alerts, NOW, limit=1), NOW).first()
    assert [r.alert_id for r in m.alerts_after(alerts, one.cursor, one.cursor_id).collect()] == ["3", "4", "5"]


def test_materialization_rate(spark):
    runs = [("x", NOW + dt.timedelta(minutes=i)) for i in range(11)] + [("y", NOW)] * 10 + [
        ("z", NOW + dt.timedelta(minutes=55 + i)) for i in range(11)]
    got = m.materialization_rate(spark.createDataFrame(runs, "asset string, ts timestamp"))
    assert rows(got) == [("x", NOW, 11)]


def test_key_checks_share_a_scan_and_count_as_their_own_plans(spark):
    """Uniqueness over several columns with NULLs, references within a table and across, frequent and absent values."""
    a = spark.createDataFrame(
        [(1, "x", 7), (1, "x", 7), (1, None, 8), (1, None, None), (2, "y", 9), (None, "z", 9), (3, "a,b", 2)],
        "k int, n string, up int")
    b = spark.createDataFrame([(1, "x"), (7, None), (9, "q")], "id int, name string")
    tables = {"a": a, "b": b, "none": a.limit(0)}
    checks = [
        q.RowCheck("wrong", "a", q.is_null("n")), q.UniqueCheck("pair", "a", ("k", "n")), q.UniqueCheck("single", "a", ("k",)),
        q.ReferenceCheck("across", "a", "up", "b", "id"), q.ReferenceCheck("within", "a", "up", "a", "k"),
        q.ReferenceCheck("to_none", "b", "id", "none", "k", severity="warn"), q.ReferenceCheck("from_none", "none", "k", "b", "id"),
        q.UniqueCheck("none_unique", "none", ("k",)), q.TableCheck("own", lambda t: t["b"].filter("id = 7")),
    ]
    report = {r.check_name: (r.severity, r.failures) for r in q.run_checks(tables, checks).collect()}
    for c in checks[1:-1]:
        assert report[c.name] == (c.severity, c.violations(tables).count()), c.name
    assert report == {
        "wrong": ("error", 2), "pair": ("error", 1), "single": ("error", 1), "across": ("error", 2), "within": ("error", 3),
        "to_none": ("warn", 3), "from_none": ("error", 0), "none_unique": ("error", 0), "own": ("error", 1)}
    assert rows(q.run_checks({"none": a.limit(0)}, [q.RowCheck("w", "none", q.is_null("k"))])) == [("w", "error", 0)]
    plan = q.run_checks(tables, checks[:-1])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_quantile_sketches_merge_and_follow_changed_periods(spark, tmp_path):
    import random

    from tarmac.operators import quantiles

    rng, path = random.Random(4), str(tmp_path / "sketches")
    data = [(f"m{i % 5}", None if rng.random() < 0.05 else int(rng.gauss(0, 300)) * (i % 5 + 1)) for i in range(20000)]
    df = spark.createDataFrame([*data, (None, 5), ("empty", None)], "m string, v int")
    quantiles.refresh_sketches(spark, path, df.filter("m <> 'm4' or m is null"), "v", "m")
    quantiles.refresh_sketches(spark, path, df, "v", "m", ["m4", "empty"])
    known = df.filter("m is not null")
    for share in (0.0, 0.05, 0.5, 0.95, 1.0):
        got = quantiles.merged_quantile(spark.read.parquet(path), share).first()
        assert got["periods"] == 5 and got["rows"] == known.filter("v is not null").count()
        assert quantiles.rank_within(known, "v", got["quantile"], share).first()["within"]
    assert not quantiles.rank_within(known, "v", 100000, 0.5).first()["within"]
    # A period whose values have all gone loses its sketch, the others are left alone.
    others = {p: p.stat().st_mtime_ns for p in (tmp_path / "sketches").glob("m=m[0-3]/*.parquet")}
    quantiles.refresh_sketches(spark, path, df.filter("m <> 'm4'"), "v", "m", ["m4"])
    assert quantiles.merged_quantile(spark.read.parquet(path), 0.5).first()["periods"] == 4
    assert others and others == {p: p.stat().st_mtime_ns for p in (tmp_path / "sketches").glob("m=m[0-3]/*.parquet")}
    none = quantiles.merged_quantile(spark.read.parquet(path).limit(0), 0.5).first()
    assert (none["periods"], none["rows"], none["quantile"]) == (0, 0, None)
