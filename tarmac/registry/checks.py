"""Registered queries: data quality, freshness, metric windows, alarms."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import standins
from tarmac.operators import monitoring as m
from tarmac.operators import quality as q
from tarmac.operators import quantiles
from tarmac.operators.drift import REVIEW_DAYS, unreviewed_drift, unreviewed_drift_count
from tarmac.plans import silver
from tarmac.registry import frames
from tarmac.registry.oracle import RUN_TS as RUN_SQL
from tarmac.registry.oracle import sql
from tarmac.session import scratch_path

RUN_TS = frames.RUN_TS
AS_OF = dt.datetime(2024, 1, 30, 12)


def _fact(spark: SparkSession, d: str) -> DataFrame:
    return frames.gold_tables(spark, d)["fct_flight_event"]


def drift_log(spark: SparkSession, d: str) -> DataFrame:
    """Events as drift entries; some kinds only mark runs, some entries were reviewed."""
    return standins.table(spark, d, "events").selectExpr(
        "cast(ts as timestamp) as detected_at", "'bronze' as source_name", "'bts_raw' as table_name",
        "case event_type when 'view' then 'added' when 'click' then 'removed' else 'run_marker' end as kind",
        "'column_' || cast(user_id as string) as column_name",
        "case when value > 10 then cast(ts as timestamp) + interval 1 day end as reviewed_at")


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return standins.table(spark, d, "events").selectExpr(
        "lpad(cast(event_id as string), 12, '0') as alert_id", "cast(ts as timestamp) as detected_at",
        "case event_type when 'view' then 'test' when 'click' then 'model_error' else 'source_freshness' end as alert_class",
        "'model.' || cast(user_id as string) as model_unique_id", "event_type as test_name", "'fail' as status",
        "props as alert_description",
        """case when user_id % 3 = 0 then '["Critical", "gold"]' when user_id % 3 = 1 then '["silver"]' end as tags""")


# --- data quality ----------------------------------------------------------------------

def q_not_null(spark: SparkSession, d: str) -> DataFrame:
    """Staged flights without a tail number."""
    return frames.flights(spark, d).filter(q.is_null("tail_number")).select(
        "flight_event_natural_key", "bronze_loaded_at")


def q_unique(spark: SparkSession, d: str) -> DataFrame:
    return q.duplicates(standins.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_relationships(spark: SparkSession, d: str) -> DataFrame:
    """Line items and facts whose parent is missing."""
    lines = q.orphans(
        standins.table(spark, d, "lineitem"), "l_suppkey",
        standins.table(spark, d, "supplier").filter("s_acctbal > 1000"), "s_suppkey")
    t = frames.gold_tables(spark, d)
    days = q.orphans(t["fct_flight_event"], "flight_date_key",
                     t["dim_date"].filter("not is_us_federal_holiday"), "date_key")
    return lines.select(F.lit("l_suppkey").alias("check_name"), F.col("value").cast("string").alias("value"), "rows"
                        ).unionByName(days.select(F.lit("flight_date_key").alias("check_name"),
                                                  F.col("value").cast("string").alias("value"), "rows"))


def q_accepted(spark: SparkSession, d: str) -> DataFrame:
    return _fact(spark, d).filter(q.not_in("reconciliation_status", ["bts_only", "matched"])).select(
        "flight_event_sk", "reconciliation_status")


def _live_fact(spark: SparkSession, d: str) -> DataFrame:
    """The fact with live arrivals in place of reported ones, which breaks its delays."""
    return _fact(spark, d).withColumn(
        "actual_arr_ts", F.coalesce("live_actual_arr_ts", "actual_arr_ts"))


def q_expression(spark: SparkSession, d: str) -> DataFrame:
    return _live_fact(spark, d).filter(q.violated(q.delay_matches_times()) | q.violated(q.cancelled_never_departed())).select(
        "flight_event_sk", "arr_delay_min", "cancelled_flag")


def q_recency(spark: SparkSession, d: str) -> DataFrame:
    return q.recency(standins.table(spark, d, "events"), "ts", dt.datetime(2024, 2, 1, 2), 25)


def _loads(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, str]]:
    return {
        "bts_raw": (standins.flights_raw(spark, d), "bronze_loaded_at"),
        "opensky_raw": (standins.table(spark, d, "events"), "ts"),
        "other": (standins.table(spark, d, "orders"), "o_orderdate"),
    }


def q_sla(spark: SparkSession, d: str) -> DataFrame:
    events = standins.table(spark, d, "events")
    return q.sla_status({
        "silver_aircraft_state": (events, "ts"),
        "silver_flight_event": (events.filter("event_type = 'view'"), "ts"),
        "fct_flight_event": (_fact(spark, d), "ingested_at"),
        "dim_carrier": (events.filter("value > 1e9"), "ts"),
    }, RUN_TS)


def q_length(spark: SparkSession, d: str) -> DataFrame:
    return standins.airlines_raw(spark, d).select("openflights_id", F.trim("iata").alias("code")).filter(
        q.length_differs("code", 2))


def q_quantile(spark: SparkSession, d: str) -> DataFrame:
    return q.quantile_between(_fact(spark, d).filter("not cancelled_flag"), "arr_delay_min", 0.95, -30, 240)


def q_quantile_sketches(spark: SparkSession, d: str) -> DataFrame:
    """p95 merged from a sketch a day, the last day sketched later by itself, beside the exact one."""
    flown, path = _fact(spark, d).filter("not cancelled_flag"), scratch_path(spark, "sketches")
    last = flown.agg(F.max("flight_date_key")).first()[0]
    early = flown.filter(F.col("flight_date_key") < F.lit(last))
    quantiles.refresh_sketches(spark, path, early, "arr_delay_min", "flight_date_key")
    quantiles.refresh_sketches(spark, path, flown, "arr_delay_min", "flight_date_key", [last])
    merged = quantiles.merged_quantile(spark.read.parquet(path), 0.95).first()
    near = quantiles.rank_within(flown, "arr_delay_min", merged["quantile"], 0.95)
    exact = q.quantile(flown, "arr_delay_min", 0.95).first()[0]
    return near.select(
        F.lit(merged["periods"]).cast("bigint").alias("periods"), F.lit(merged["rows"]).cast("bigint").alias("sketched_rows"), "rows", "within",
        F.lit(exact).alias("exact_quantile"))


def q_no_future(spark: SparkSession, d: str) -> DataFrame:
    return _fact(spark, d).filter(q.arrives_after(AS_OF)).select(
        "flight_event_sk", "actual_arr_ts", F.lit(AS_OF).cast("timestamp").alias("observed_at"))


def q_agg_matches(spark: SparkSession, d: str) -> DataFrame:
    """Carrier-days of an aggregate that has gaps, and counts late rows twice."""
    t = frames.gold_tables(spark, d)
    daily = t["agg_carrier_otp_daily"].filter("carrier_key <> 'B6'").withColumn(
        "flights_scheduled", F.when(F.col("flight_date") == "2024-01-05", F.col("flights_scheduled") * 2)
        .otherwise(F.col("flights_scheduled")))
    return q.counts_differ(t["fct_flight_event"], daily)


def q_trailing(spark: SparkSession, d: str) -> DataFrame:
    """Monthly volume of all orders, and of those that thin out with the day of the month."""
    return q.trailing_volume(standins.table(spark, d, "orders"), "o_orderdate").withColumn(
        "trailing_avg", F.round("trailing_avg", 6))


def _all_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    staged = {
        "stg_flights": frames.flights(spark, d), "stg_states": frames.states(spark, d),
        "stg_airports": frames.airports(spark, d), "stg_airlines": frames.airlines(spark, d),
    }
    states = silver.silver_aircraft_state(staged["stg_states"], RUN_TS)
    return {**frames.gold_tables(spark, d), **staged, "silver_aircraft_state": states, "schema_drift": drift_log(spark, d)}


def q_report(spark: SparkSession, d: str) -> DataFrame:
    """Failures of the checks of all layers, as noted in the history."""
    path = scratch_path(spark, "dq-history")
    report = q.run_checks(_all_tables(spark, d), q.all_checks(RUN_TS))
    q.record_report(report, path, RUN_TS)
    return spark.read.parquet(path)


def q_store_failures(spark: SparkSession, d: str) -> DataFrame:
    """Rows kept for failed checks, counted by check. Live arrivals stand for actual ones."""
    tables, root = {**frames.gold_tables(spark, d)}, scratch_path(spark, "dq-failures")
    tables["fct_flight_event"] = _live_fact(spark, d)
    folders = q.store_failures(tables, q.gold_checks(AS_OF), root)
    kept = [
        (name, rows) for name, folder in folders.items()
        if (rows := q.read_failures(spark, folder)) is not None
    ]
    return reduce(DataFrame.unionByName, [
        rows.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        for name, rows in kept
    ])


# --- monitoring ------------------------------------------------------------------------

ERROR_RATE = m.Alarm("error-rate", "error", "consumer", 3600, 2, 40.0)
SILENCE = m.Alarm("purchase-silence", "purchase", None, 7200, 2, 15.0, statistic="max",
                  comparison="less", missing_breaches=True)
SPAN = (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31))


def q_metric_windows(spark: SparkSession, d: str) -> DataFrame:
    windows = m.metric_windows(frames.points(spark, d), 300, "metric_name", "component")
    return windows.withColumn("sum_value", F.round("sum_value", 4))


def q_alarms(spark: SparkSession, d: str) -> DataFrame:
    points = frames.points(spark, d)
    parts = [
        m.evaluate_alarm(points, alarm, *SPAN, *groups)
        .select(F.lit(alarm.name).alias("alarm"), *groups, "window_start",
                F.round("value", 4).alias("value"), "breach", "state")
        for alarm, groups in ((ERROR_RATE, []), (SILENCE, ["component"]))
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


SERVICE_METRICS = list(dict.fromkeys(a.metric for a in m.ALARMS))


SERVICE_SPAN = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 7))


def service_counters(events: DataFrame) -> DataFrame:
    """The events as points of the metrics the declared alarms watch."""
    names = F.array(*[F.lit(n) for n in SERVICE_METRICS])
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), "value",
        F.when(F.col("user_id") % 2 == 0, "producer").otherwise("consumer").alias("component"),
        F.get(names, (F.col("event_id") % len(SERVICE_METRICS)).cast("int")).alias("metric_name"))


def q_alarms_in_service(spark: SparkSession, d: str) -> DataFrame:
    """The declared alarms over two days of counters: windows, breaches and windows in alarm."""
    counters = service_counters(standins.table(spark, d, "events"))
    return reduce(DataFrame.unionByName, [
        m.evaluate_alarm(counters, alarm, *SERVICE_SPAN).agg(
            F.count(F.lit(1)).alias("windows"), F.count_if("breach").alias("breaches"),
            F.count_if(F.col("state") == "ALARM").alias("alarms"))
        .select(F.lit(alarm.name).alias("alarm"), "windows", "breaches", "alarms")
        for alarm in m.ALARMS])


def q_lag(spark: SparkSession, d: str) -> DataFrame:
    """Lag of every airframe against the last evening of the data."""
    latest = frames.states(spark, d).groupBy("icao24").agg(F.max("event_ts").alias("latest"))
    return m.lag_status(latest, dt.datetime(2024, 1, 30, 23, 59))


def q_usage(spark: SparkSession, d: str) -> DataFrame:
    usage = standins.table(spark, d, "events").select(
        F.col("event_type").alias("warehouse_name"), F.col("ts").cast("timestamp").alias("end_time"),
        F.col("value").alias("credits_used"))
    return m.usage_last_window(usage, AS_OF).withColumn("credits", F.round("credits", 4))


def q_alerts_page(spark: SparkSession, d: str) -> DataFrame:
    """Two pages of alerts that come in bursts: the first ends inside one."""
    bursts = alerts(spark, d).withColumn("detected_at", F.date_trunc("hour", "detected_at"))
    first = m.alerts_after(bursts, dt.datetime(2024, 1, 15))
    after = m.next_cursor(first, dt.datetime(2024, 1, 15)).first()
    page = first.unionByName(m.alerts_after(bursts, after.cursor, after.cursor_id))
    return page.withColumn("severity", m.alert_severity()).drop("alert_description", "tags")


def q_materialization(spark: SparkSession, d: str) -> DataFrame:
    runs = standins.table(spark, d, "events").select(
        F.when(F.col("event_type").isin("view", "click", "signup"), "silver_aircraft_state")
        .otherwise("fct_flight_event").alias("asset"), F.col("ts").cast("timestamp").alias("ts"))
    return m.materialization_rate(runs)


QUERIES = {
    "dq_not_null": q_not_null,
    "dq_unique": q_unique,
    "dq_relationships": q_relationships,
    "dq_accepted_values": q_accepted,
    "dq_expression": q_expression,
    "dq_recency": q_recency,
    "dq_source_freshness": lambda s, d: q.source_freshness(_loads(s, d), dt.datetime(2024, 3, 15)),
    "dq_value_length": q_length,
    "dq_quantile_between": q_quantile,
    "quantile_sketches": q_quantile_sketches,
    "dq_no_future": q_no_future,
    "dq_agg_matches_detail": q_agg_matches,
    "dq_unreviewed_drift": lambda s, d: unreviewed_drift(drift_log(s, d), RUN_TS),
    "unreviewed_drift_count": lambda s, d: unreviewed_drift_count(drift_log(s, d), RUN_TS, kinds=None),
    "dq_trailing_volume": q_trailing,
    "dq_report": q_report,
    "store_failures": q_store_failures,
    "sla_status": q_sla,
    "metric_windows": q_metric_windows,
    "alarm_evaluate": q_alarms,
    "alarms_in_service": q_alarms_in_service,
    "lag_status": q_lag,
    "usage_last_window": q_usage,
    "alerts_after_cursor": q_alerts_page,
    "alert_severity": lambda s, d: alerts(s, d).select("alert_id", m.alert_severity().alias("severity")),
    "materialization_rate": q_materialization,
}

_LAG = "cast(floor(epoch(timestamp '{at}')) - floor(epoch(latest)) as bigint)"
_SEVERITY = """case when alert_class in ('test', 'model_error') and contains(lower(coalesce(tags, '')), 'critical')
    then 'critical' else 'warning' end"""
_FACT = "fact"


def _freshness(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as table_name, {e}" for n, e in tables.items())


def _check_lines(fact: str = "fact", as_of: str = RUN_SQL) -> list[tuple[str, str, str]]:
    """The checks again, each in plain SQL: name, severity and a query of its violations."""
    views = {
        "fct_flight_event": fact, "agg_carrier_otp_daily": "daily", "dim_aircraft": "aircraft_dim", "dim_date": "days",
        "silver_flight_event": "silver", "silver_aircraft_state": "uniq_states"}
    keys = {
        "stg_flights": ["flight_event_natural_key", "flight_date", "carrier_code", "origin_iata", "dest_iata"],
        "stg_states": ["icao24", "event_ts"], "stg_airports": ["iata"], "stg_airlines": ["carrier_key"],
        "silver_flight_event": ["flight_event_natural_key", "flight_date", "carrier_code"],
        "silver_aircraft_state": ["icao24", "event_ts"],
        "fct_flight_event": ["flight_event_sk", "flight_date_key", "carrier_key", "origin_airport_key", "dest_airport_key"],
        "dim_carrier": ["carrier_key"], "dim_airport": ["airport_sk", "airport_key"], "dim_aircraft": ["aircraft_key"],
        "dim_date": ["date_key"], "agg_carrier_otp_daily": ["flight_date", "carrier_key"]}
    unique = [
        ("stg_airports", "iata"), ("stg_airlines", "carrier_key"), ("silver_flight_event", "flight_event_natural_key"),
        ("fct_flight_event", "flight_event_sk"), ("dim_carrier", "carrier_key"), ("dim_airport", "airport_sk"),
        ("dim_aircraft", "aircraft_key"), ("dim_date", "date_key"), ("agg_carrier_otp_daily", "flight_date, carrier_key")]
    refers = [
        ("fct_flight_event", "flight_date_key", "dim_date", "date_key"),
        ("fct_flight_event", "carrier_key", "dim_carrier", "carrier_key"),
        ("fct_flight_event", "origin_airport_key", "dim_airport", "airport_key"),
        ("fct_flight_event", "dest_airport_key", "dim_airport", "airport_key"),
        ("agg_carrier_otp_daily", "carrier_key", "dim_carrier", "carrier_key")]
    view = lambda t: views.get(t, t)
    late = "date_diff('minute', scheduled_arr_ts, actual_arr_ts)"
    lines = [(f"{t}.{c}.not_null", "error", f"select 1 from {view(t)} where {c} is null") for t, cs in keys.items() for c in cs]
    lines += [
        (f"{t}.{k.replace(', ', '_')}.unique", "error",
         f"select {k} from {view(t)} where {' and '.join(f'{c} is not null' for c in k.split(', '))} group by {k} having count(*) > 1")
        for t, k in unique]
    lines += [
        (f"{t}.{c}.relationships", "error",
         f"select distinct {c} from {view(t)} where {c} is not null and {c} not in (select {k} from {view(p)})")
        for t, c, p, k in refers]
    codes = "where cancellation_code is not null and cancellation_code not in ('A', 'B', 'C', 'D')"
    status = "where reconciliation_status not in ('live_only', 'bts_only', 'matched', 'mismatch')"
    lines += [
        ("stg_flights.carrier_code.length", "warn", "select 1 from stg_flights where length(carrier_code) <> 2"),
        ("stg_flights.cancellation_code.accepted_values", "warn", f"select 1 from stg_flights {codes}"),
        ("fct_flight_event.cancellation_code.accepted_values", "warn", f"select 1 from {fact} {codes}"),
        ("silver_flight_event.reconciliation_status.accepted_values", "error", f"select 1 from silver {status}"),
        ("fct_flight_event.reconciliation_status.accepted_values", "error", f"select 1 from {fact} {status}"),
        ("fct_flight_event.arr_delay_matches_timestamps", "error",
         f"select 1 from {fact} where not (arr_delay_min is null or cancelled_flag or arr_delay_min = {late})"),
        ("fct_flight_event.cancelled_means_no_actual_dep", "error",
         f"select 1 from {fact} where cancelled_flag and actual_dep_ts is not null"),
        ("fct_flight_event.no_future_actual_arrivals", "error", f"select 1 from {fact} where actual_arr_ts > {as_of}"),
        ("fct_flight_event.arr_delay_min.p95", "warn",
         f"select 1 from (select quantile_cont(arr_delay_min, 0.95) p from {fact} where not cancelled_flag) "
         "where not coalesce(p between -30 and 240, false)"),
        ("fct_flight_event.ingested_at.recency", "error",
         f"select 1 from (select max(ingested_at) m from {fact}) where not coalesce(m >= {as_of} - interval 25 hour, false)"),
        ("agg_carrier_otp_daily.matches_detail", "error",
         f"select 1 from (select flight_date_key as flight_date, carrier_key, count(*) n from {fact} group by 1, 2) "
         "full join daily using (flight_date, carrier_key) where n is distinct from flights_scheduled"),
        ("schema_drift.unreviewed", "error",
         "select 1 from log where reviewed_at is null and kind in ('added', 'removed') "
         f"and detected_at < {RUN_SQL} - interval {REVIEW_DAYS} day"),
    ]
    return lines


def _report_sql() -> str:
    return sql(" union all ".join(
        f"select '{name}' as check_name, '{severity}' as severity, (select count(*) from ({text})) as failures, "
        f"{RUN_SQL} as run_ts" for name, severity, text in _check_lines()))


def _stored_sql() -> str:
    """Checks of single rows keep a folder only if they found some; the others always do."""
    whole = (".unique", ".relationships", ".p95", ".recency", ".matches_detail")
    gold = ("fct_", "dim_", "agg_")
    live = ("(select * replace (coalesce(live_actual_arr_ts, actual_arr_ts) as actual_arr_ts) from fact)")
    return sql(" union all ".join(
        f"select '{name}' as check_name, count(*) as failures from ({text}) "
        + ("" if name.endswith(whole) else "having count(*) > 0")
        for name, _, text in _check_lines(live, "timestamp '2024-01-30 12:00:00'") if name.startswith(gold)))


def _service_sql() -> str:
    parts = []
    for alarm in m.ALARMS:
        step, statistic = alarm.period_seconds, alarm.statistic
        sign = "<" if alarm.comparison == "less" else ">"
        component = f"and component = '{alarm.component}'" if alarm.component else ""
        parts.append(f"""
            select '{alarm.name}' as alarm, count(*) as windows, count(*) filter (breach) as breaches,
              count(*) filter (in_row = {alarm.periods}) as alarms from (
              select breach, sum(breach::int) over (order by window_start rows {alarm.periods - 1} preceding) as in_row from (
                select window_start, coalesce(v {sign} {alarm.threshold}, {str(alarm.missing_breaches).lower()}) as breach
                from (select unnest(generate_series(timestamp '2024-01-05',
                  timestamp '2024-01-07' - interval {step} second, interval {step} second)) as window_start) s
                left join (select timestamp '1970-01-01' + to_seconds(cast(floor(epoch(ts) / {step}) * {step} as bigint)) as w,
                  {statistic}(value) as v from counters where metric_name = '{alarm.metric}' {component} group by 1) on w = window_start))""")
    metrics = ", ".join(f"'{name}'" for name in SERVICE_METRICS)
    return (f"with counters as (select ts, value, case when user_id % 2 = 0 then 'producer' else 'consumer' end as component, "
            f"([{metrics}])[event_id % {len(SERVICE_METRICS)} + 1] as metric_name from events) " + " union all ".join(parts))


def _alarm_sql() -> str:
    spine = ("select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31' - interval {s} second, "
             "interval {s} second)) as window_start")
    bucket = "timestamp '1970-01-01' + to_seconds(cast(floor(epoch(ts) / {s}) * {s} as bigint))"
    return sql(f"""
        select 'error-rate' as alarm, cast(null as varchar) as component, window_start, round(value, 4) as value, breach,
          case when sum(cast(breach as int)) over (order by window_start rows 1 preceding) = 2 then 'ALARM' else 'OK' end as state
        from (select s.window_start, w.value, coalesce(w.value > 40, false) as breach
              from ({spine.format(s=3600)}) s left join (
                select {bucket.format(s=3600)} as window_start, sum(value) as value from points
                where metric_name = 'error' and component = 'consumer' group by 1) w using (window_start))
        union all
        select 'purchase-silence', component, window_start, round(value, 4), breach,
          case when sum(cast(breach as int)) over (partition by component order by window_start rows 1 preceding) = 2
            then 'ALARM' else 'OK' end
        from (select c.component, s.window_start, w.value, coalesce(w.value < 15, true) as breach
              from (select distinct component from points where metric_name = 'purchase') c
              cross join ({spine.format(s=7200)}) s left join (
                select component, {bucket.format(s=7200)} as window_start, max(value) as value from points
                where metric_name = 'purchase' group by 1, 2) w using (component, window_start))""")


ORACLES = {
    "dq_not_null": sql("select flight_event_natural_key, bronze_loaded_at from stg_flights where tail_number is null"),
    "dq_unique": "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
    "dq_relationships": sql(
        "select 'l_suppkey' as check_name, cast(l_suppkey as varchar) as value, count(*) as rows from lineitem "
        "where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 1000) group by 2 union all "
        "select 'flight_date_key', cast(flight_date_key as varchar), count(*) from fact "
        "where flight_date_key in (date '2024-01-01', date '2024-01-15') group by 2"),
    "dq_accepted_values": sql(
        "select flight_event_sk, reconciliation_status from fact where reconciliation_status not in ('bts_only', 'matched')"),
    "dq_expression": sql(
        "select flight_event_sk, arr_delay_min, cancelled_flag from fact where not (arr_delay_min is null "
        "or cancelled_flag or arr_delay_min = date_diff('minute', scheduled_arr_ts, "
        "coalesce(live_actual_arr_ts, actual_arr_ts))) or not (not cancelled_flag or actual_dep_ts is null)"),
    "dq_recency": "select max(ts) as latest, max(ts) < timestamp '2024-02-01 02:00:00' - interval 25 hour as stale from events",
    "dq_source_freshness": sql(
        "select table_name, latest, lag_seconds, case when lag_seconds > error then 'error' when lag_seconds > warn "
        "then 'warn' else 'pass' end as status from (select table_name, latest, "
        f"{_LAG.format(at='2024-03-15')} as lag_seconds, warn, error from ("
        "select 'bts_raw' as table_name, max(bronze_loaded_at) as latest, 35*86400 as warn, 45*86400 as error from flights_raw "
        "union all select 'opensky_raw', max(ts), 900, 3600 from events "
        "union all select 'other', max(o_orderdate), 86400, 172800 from orders))"),
    "sla_status": sql(
        "select table_name, latest, lag_minutes, sla_minutes, not coalesce(lag_minutes <= sla_minutes, false) as breached "
        "from (select table_name, latest, sla_minutes, cast(floor("
        f"{_LAG.format(at='2024-02-01')} / 60.0) as bigint) as lag_minutes from ("
        "select 'silver_aircraft_state' as table_name, max(ts) as latest, 30 as sla_minutes from events union all "
        "select 'silver_flight_event', max(ts), 1440 from events where event_type = 'view' union all "
        f"select 'fct_flight_event', max({RUN_SQL}), 60 from fact union all "
        "select 'dim_carrier', max(ts), 360 from events where value > 1e9))"),
    "dq_value_length": sql("select openflights_id, trim(iata) as code from airlines_raw where length(trim(iata)) <> 2"),
    "dq_quantile_between": sql(
        "select quantile, quantile between -30 and 240 as passed from (select quantile_cont(arr_delay_min, 0.95) "
        "as quantile from fact where not cancelled_flag)"),
    "quantile_sketches": sql(
        "select count(distinct flight_date_key) as periods, count(*) as sketched_rows, count(*) as rows, true as within, "
        "quantile_cont(arr_delay_min, 0.95) as exact_quantile from fact where not cancelled_flag and arr_delay_min is not null"),
    "dq_no_future": sql(
        "select flight_event_sk, actual_arr_ts, timestamp '2024-01-30 12:00:00' as observed_at from fact "
        "where actual_arr_ts > timestamp '2024-01-30 12:00:00'"),
    "dq_agg_matches_detail": sql(
        "select flight_date, carrier_key, d.detail_count, a.flights_scheduled from "
        "(select flight_date_key as flight_date, carrier_key, count(*) as detail_count from fact group by 1, 2) d "
        "full join (select flight_date, carrier_key, flights_scheduled * case when flight_date = date '2024-01-05' "
        "then 2 else 1 end as flights_scheduled from daily where carrier_key <> 'B6') a using (flight_date, carrier_key) "
        "where coalesce(d.detail_count, -1) <> coalesce(a.flights_scheduled, -1)"),
    "dq_unreviewed_drift": sql(
        "select detected_at, source_name, table_name, kind, column_name from log where kind in ('added', 'removed') "
        "and reviewed_at is null and detected_at < timestamp '2024-01-25'"),
    "unreviewed_drift_count": sql(
        "select count(*) as unreviewed from log where reviewed_at is null and detected_at < timestamp '2024-01-25'"),
    "dq_trailing_volume":
        "select month, volume, round(trailing_avg, 6) as trailing_avg, coalesce(volume < trailing_avg * 0.8, false) as low "
        "from (select month, volume, avg(volume) over (order by month rows between 6 preceding and 1 preceding) as trailing_avg "
        "from (select cast(date_trunc('month', o_orderdate) as date) as month, cast(count(*) as double) as volume "
        "from orders group by 1))",
    "metric_windows": sql(
        "select timestamp '1970-01-01' + to_seconds(b * 300) as window_start, "
        "timestamp '1970-01-01' + to_seconds(b * 300 + 300) as window_end, metric_name, component, "
        "round(sum(value), 4) as sum_value, max(value) as max_value, count(*) as points "
        "from (select *, cast(floor(epoch(ts) / 300) as bigint) as b from points) group by b, metric_name, component"),
    "dq_report": _report_sql(),
    "store_failures": _stored_sql(),
    "alarms_in_service": _service_sql(),
    "alarm_evaluate": _alarm_sql(),
    "lag_status": sql(
        "select *, case when lag_seconds > 600 then 'fatal' when lag_seconds > 120 then 'warn' else 'ok' end as status "
        f"from (select icao24, max(event_ts) as latest, {_LAG.format(at='2024-01-30 23:59:00')} as lag_seconds "
        "from stg_states group by 1)"),
    "usage_last_window":
        "select event_type as warehouse_name, round(sum(value), 4) as credits from events "
        "where ts > timestamp '2024-01-30 12:00:00' - interval 75 minute group by 1",
    "alerts_after_cursor": sql(
        "select * from (select alert_id, date_trunc('hour', detected_at) as detected_at, alert_class, model_unique_id, "
        f"test_name, status, {_SEVERITY} as severity from alerts) "
        "where detected_at > timestamp '2024-01-15' order by detected_at, alert_id limit 200"),
    "alert_severity": sql(f"select alert_id, {_SEVERITY} as severity from alerts"),
    "materialization_rate":
        "select case when event_type in ('view', 'click', 'signup') then 'silver_aircraft_state' else 'fct_flight_event' end "
        "as asset, date_trunc('hour', ts) as hour_start, count(*) as runs from events group by 1, 2 having count(*) > 10",
}
