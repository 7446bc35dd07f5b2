"""Registered queries: streams run over everything that has arrived, and the delay model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import standins
from tarmac.operators import delay_model
from tarmac.operators.staging import stg_states
from tarmac.operators.tables import read_table
from tarmac.plans.silver import StateTables
from tarmac.registry import frames
from tarmac.registry.checks import ORACLES as CHECK_ORACLES
from tarmac.registry.checks import SERVICE_SPAN, service_counters
from tarmac.registry.core import ORACLES as CORE_ORACLES
from tarmac.registry.core import requests_by_id
from tarmac.registry.oracle import sql
from tarmac.registry.storage import PAYLOAD_SQL, messages_of, payloads_of
from tarmac.session import scratch_path
from tarmac.sources.payload import decode_payload
from tarmac.streaming import alarms, ingest, late
from tarmac.streaming import states as st

LATE = "2 days"


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream; the folder holds other tables too."""
    schema = standins.table(spark, d, "events").schema
    return ingest.file_stream(spark, d, schema, pattern="events.parquet")


def _sink(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    ingest.available_now(st.append_stream(stream, path, checkpoint))
    return spark.read.schema(stream.schema).parquet(path)


def q_source(spark: SparkSession, d: str) -> DataFrame:
    """Poll payloads arriving as a stream, decoded to one event per airframe."""
    polled = payloads_of(standins.states_of(event_stream(spark, d)))
    return _sink(spark, decode_payload(polled), "stream-source")


def _rolled(spark: SparkSession, d: str) -> dict[str, str]:
    paths = {n: scratch_path(spark, f"roll-{n}") for n in ("bronze", "dead", "metrics", "checkpoint")}
    stream = messages_of(standins.states_of(event_stream(spark, d))).drop("event_id")
    ingest.available_now(ingest.roll_to_bronze(
        stream, paths["bronze"], paths["dead"], paths["metrics"], paths["checkpoint"]))
    return paths


def q_roll(spark: SparkSession, d: str) -> DataFrame:
    """Accepted messages as rolled to bronze files, without the folders' ingest time."""
    return spark.read.parquet(_rolled(spark, d)["bronze"]).drop("ds", "hr", "batch")


def q_compaction(spark: SparkSession, d: str) -> DataFrame:
    """Messages rolled to bronze, their hours closed and compacted twice: one file an hour, no row changed."""
    bronze = _rolled(spark, d)["bronze"]
    for _ in range(2):
        ingest.compact_bronze(spark, bronze, dt.datetime(2200, 1, 1))
    rows = spark.read.parquet(bronze)
    return rows.drop("ds", "hr").withColumn("compacted", F.col("batch") == -1).drop("batch")


def q_batch_metrics(spark: SparkSession, d: str) -> DataFrame:
    counters = spark.read.parquet(_rolled(spark, d)["metrics"])
    return counters.groupBy("metric_name", "unit", "component").agg(F.sum("value").alias("value"))


def _sent_twice(spark: SparkSession, d: str) -> DataFrame:
    """Reports of which a tenth come again later with another track."""
    return stg_states(standins.replayed(standins.states_of(event_stream(spark, d))))


def q_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Each report once; which copy comes first is up to arrival, so only keys are shown."""
    unique = st.dedupe_stream(_sent_twice(spark, d).select("icao24", "event_ts", "callsign"), LATE)
    return _sink(spark, unique.select("icao24", "event_ts"), "dedupe")


def q_dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    """Each closed report once, in its latest copy."""
    return _sink(spark, st.latest_stream(_sent_twice(spark, d), LATE), "dedupe-latest")


def _landings_of(spark: SparkSession, reports: DataFrame) -> DataFrame:
    before = spark.conf.get(st.STATE_STORE, None)
    st.with_state_store(spark)
    try:
        return _sink(spark, st.landings_stream(reports, LATE), "landings")
    finally:
        spark.conf.set(st.STATE_STORE, before) if before else spark.conf.unset(st.STATE_STORE)


def q_landings(spark: SparkSession, d: str) -> DataFrame:
    return _landings_of(spark, stg_states(standins.states_of(event_stream(spark, d))))


def _two_files(spark: SparkSession, d: str) -> tuple[late.LateFolders, StateTables]:
    """Reports up to January 20 come after all others, so they are behind the watermark; split, timely ones merged."""
    landed, folders = scratch_path(spark, "late-landed"), late.LateFolders.below(scratch_path(spark, "late"))
    checkpoint, tables = scratch_path(spark, "late-checkpoint"), StateTables.below(scratch_path(spark, "late-silver"))
    reports = frames.states(spark, d)
    for part in (F.col("event_ts") >= "2024-01-21", F.col("event_ts") < "2024-01-21"):
        reports.filter(part).write.mode("append").parquet(landed)
        ingest.available_now(late.split_late(ingest.file_stream(spark, landed, reports.schema), folders, checkpoint, LATE))
    timely = late.timely_stream(spark, folders, reports.schema)
    ingest.available_now(st.merge_stream(timely, tables, scratch_path(spark, "late-merge"), frames.RUN_TS))
    return folders, tables


def q_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows in, timely and late of each micro-batch."""
    return late.late_counts(spark, _two_files(spark, d)[0])


def q_late_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Landings of the timely rows by stream, those that late rows touch made anew by day; up to the watermark."""
    folders, tables = _two_files(spark, d)
    corrected = scratch_path(spark, "late-corrected")
    streamed = _landings_of(spark, late.timely_stream(spark, folders, frames.states(spark, d).schema))
    late.backfill_landings(spark, folders, tables, corrected, frames.RUN_TS, dt.date(2024, 2, 1))
    mark = frames.states(spark, d).agg(F.max("event_ts") - F.expr(f"interval {LATE}")).first()[0]
    return late.landings_served(spark, streamed, corrected).filter(F.col("live_landing_ts") <= F.lit(mark))


def q_stream_alarms(spark: SparkSession, d: str) -> DataFrame:
    """The declared alarms on the stream of counters over two days; every event proves that time passes."""
    stream = event_stream(spark, d)
    ticks = stream.select(F.col("ts").cast("timestamp").alias("ts"))
    before = spark.conf.get(st.STATE_STORE, None)
    st.with_state_store(spark)
    try:
        states = alarms.alarms_stream(service_counters(stream), ticks, SERVICE_SPAN[0])
        judged = _sink(spark, states, "alarms")
    finally:
        spark.conf.set(st.STATE_STORE, before) if before else spark.conf.unset(st.STATE_STORE)
    return judged.filter(F.col("window_start") < F.lit(SERVICE_SPAN[1])).groupBy("alarm").agg(
        F.count(F.lit(1)).alias("windows"), F.count_if("breach").alias("breaches"),
        F.count_if(F.col("state") == "ALARM").alias("alarms"))


def q_windows(spark: SparkSession, d: str) -> DataFrame:
    stream = st.windows_stream(frames.points_of(event_stream(spark, d)), 3600, LATE, "metric_name", "component")
    return _sink(spark, stream, "windows").withColumn("sum_value", F.round("sum_value", 4))


def _current(spark: SparkSession, stream: DataFrame, name: str, keys: list[str], day: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    dated = stream.withColumn("day", F.to_date(day))
    ingest.available_now(st.current_stream(dated, path, keys, "day", checkpoint))
    return spark.read.schema(dated.schema).parquet(path).drop("day")


def q_dedupe_current(spark: SparkSession, d: str) -> DataFrame:
    """Each report in its latest copy, also those the watermark has not closed."""
    stream = st.latest_stream(_sent_twice(spark, d), LATE)
    return _current(spark, stream, "dedupe-current", ["icao24", "event_ts"], "event_ts")


def q_windows_current(spark: SparkSession, d: str) -> DataFrame:
    """All metric windows, also open ones."""
    stream = st.windows_stream(frames.points_of(event_stream(spark, d)), 3600, LATE, "metric_name", "component")
    keys = ["window_start", "metric_name", "component"]
    return _current(spark, stream, "windows-current", keys, "window_start").withColumn(
        "sum_value", F.round("sum_value", 4))


def q_landings_current(spark: SparkSession, d: str) -> DataFrame:
    """All landings, also of the last days."""
    tables, path = StateTables.below(scratch_path(spark, "current")), scratch_path(spark, "landings-current")
    reports = stg_states(standins.states_of(event_stream(spark, d)))
    ingest.available_now(st.landings_current(
        reports, tables, path, scratch_path(spark, "landings-current-checkpoint"), frames.RUN_TS))
    return spark.read.parquet(path).select("icao24", "live_landing_ts", "approach_velocity_mps")


def q_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Three refreshes of the silver states; the second finds nothing new, the third a late file."""
    landed, silver = scratch_path(spark, "landed"), StateTables.below(scratch_path(spark, "silver"))
    checkpoint = scratch_path(spark, "refresh-checkpoint")
    raw = standins.states_raw(spark, d)
    schema = raw.schema

    def refresh(hour: int) -> None:
        reports = stg_states(ingest.file_stream(spark, landed, schema))
        ingest.available_now(st.merge_stream(reports, silver, checkpoint, dt.datetime(2024, 2, 1, hour)))

    early = F.col("ds") <= "2024-01-20"
    raw.filter(early).write.mode("append").parquet(landed)
    refresh(1)
    refresh(2)
    raw.filter(~early).write.mode("append").parquet(landed)
    refresh(3)
    return read_table(spark, silver.states)


# --- delay model -----------------------------------------------------------------------

_models: dict[tuple[str, str], delay_model.DelayModel] = {}


def _rows(spark: SparkSession, d: str) -> DataFrame:
    silver = frames.gold_tables(spark, d)["silver_flight_event"]
    return delay_model.split(delay_model.training_rows(silver), "flight_event_natural_key")


def model(spark: SparkSession, d: str) -> delay_model.DelayModel:
    """The model with its declared parameters on all silver flights, trained once per session and input."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _models:
        _models[key] = delay_model.train(_rows(spark, d), frames.RUN_TS)
    return _models[key]


def q_split(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("flight_event_natural_key", "is_validation")


def q_train(spark: SparkSession, d: str) -> DataFrame:
    """Trains, saves, loads again, and shows what the model was made of and what it is worth."""
    path = scratch_path(spark, "model")
    delay_model.save(spark, model(spark, d), path)
    loaded = delay_model.load(spark, path)
    importance = loaded.pipeline.stages[-1].featureImportances.toArray()
    about = loaded.metadata
    rows = [
        (name, 0.0 <= float(weight) <= 1.0, about["n_rows"], 1 <= about["best_iteration"] <= delay_model.TREES,
         about["median_mae_minutes"], about["val_mae_minutes"] < about["median_mae_minutes"])
        for name, weight in zip(about["feature_order"], importance, strict=True)
    ]
    return spark.createDataFrame(
        rows, "feature string, importance_is_share boolean, n_rows bigint, rounds_within_limit boolean, "
        "median_mae_minutes double, mae_below_median boolean")


def q_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Validation error after each round, beside that of the median, and whether the round was kept."""
    about = model(spark, d).metadata
    rows = [(i, mae, about["median_mae_minutes"], i <= about["best_iteration"])
            for i, mae in enumerate(about["val_mae_by_round"], 1)]
    return spark.createDataFrame(rows, "round int, mae_minutes double, median_mae_minutes double, kept boolean")


def q_score(spark: SparkSession, d: str) -> DataFrame:
    scored = delay_model.score(model(spark, d), _rows(spark, d))
    return scored.select(
        "flight_event_natural_key", F.col("predicted_arr_delay_min").between(-300, 3000).alias("predicted"),
        "feature_source")


def q_mae(spark: SparkSession, d: str) -> DataFrame:
    """The model's error on held-back rows against that of the training rows' median."""
    rows = _rows(spark, d)
    median = rows.filter("not is_validation").agg(F.median("arr_delay_min")).first()[0]
    errors = delay_model.model_mae(model(spark, d).pipeline.transform(rows.filter("is_validation")), median)
    return errors.select(
        "rows", F.round("constant_mae_minutes", 6).alias("median_mae_minutes"),
        (F.col("mae_minutes") < F.col("constant_mae_minutes")).alias("mae_below_median"))


def q_score_by_id(spark: SparkSession, d: str) -> DataFrame:
    """Every request with its status, and whether it has a prediction within reason."""
    silver = frames.gold_tables(spark, d)["silver_flight_event"]
    scored = delay_model.score_by_id(model(spark, d), requests_by_id(spark, d), silver)
    return scored.select(
        "o_orderkey", "carrier_code", "flight_number", "status", "feature_source",
        F.col("predicted_arr_delay_min").between(-300, 3000).alias("predicted"))


QUERIES = {
    "stream_source": q_source,
    "stream_roll_sink": q_roll,
    "batch_metrics": q_batch_metrics,
    "stream_compaction": q_compaction,
    "stream_dedupe": q_dedupe,
    "stream_dedupe_latest": q_dedupe_latest,
    "stream_landings": q_landings,
    "stream_late_rows": q_late_rows,
    "stream_late_backfill": q_late_backfill,
    "stream_alarms": q_stream_alarms,
    "stream_metric_windows": q_windows,
    "stream_dedupe_latest_current": q_dedupe_current,
    "stream_landings_current": q_landings_current,
    "stream_metric_windows_current": q_windows_current,
    "incremental_refresh": q_refresh,
    "train_val_split": q_split,
    "train_delay_model": q_train,
    "score_delays": q_score,
    "model_mae": q_mae,
    "delay_model_rounds": q_rounds,
    "score_by_id": q_score_by_id,
}

_MARK = "(select max(event_ts) - interval 2 day from stg_states)"
_CLOSED_LANDINGS = f"select icao24, live_landing_ts, approach_velocity_mps from landings where live_landing_ts <= {_MARK}"
_TRAINING = "arr_delay_min is not null and scheduled_dep_ts is not null and distance_miles is not null"
_HELD_BACK = "('0x' || substr(md5(flight_event_natural_key || ':42'), 1, 8))::bigint % 100 < 20"
_MEDIAN = f"(select median(arr_delay_min) as middle from silver where {_TRAINING} and not ({_HELD_BACK}))"
SCORED_SQL = f"""
    select o_orderkey, carrier_code, flight_number, case when found then 'ok'
        when regexp_full_match(carrier_code, '[A-Z0-9]{{2,3}}') then 'not_found' else 'invalid' end as status,
      case when found then 'silver' end as feature_source, case when found then true end as predicted
    from ({CORE_ORACLES["hydrate_features"]})"""
_ROLLED = (
    "select icao24, callsign, origin_country, event_ts, event_ts + 5 as polled_at, time_position, last_contact, "
    "longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate, geo_altitude, "
    "squawk, false as spi, position_source{} from states_raw where event_id % 13 > 3")
ORACLES = {
    "stream_roll_sink": sql(_ROLLED.format("")),
    "stream_compaction": sql(_ROLLED.format(", true as compacted")),
    "batch_metrics":
        "select 'RowsFlushed' as metric_name, 'Count' as unit, 'consumer' as component, "
        "cast(count(*) filter (event_id % 13 > 3) as double) as value from events union all "
        "select 'MessagesDLQ', 'Count', 'consumer', cast(count(*) filter (event_id % 13 <= 3) as double) from events",
    "stream_dedupe": sql("select icao24, event_ts from uniq_states"),
    "stream_dedupe_latest": sql(
        f"select * from (select * from replayed where event_ts <= {_MARK}) "
        "qualify row_number() over (partition by icao24, event_ts order by bronze_loaded_at desc) = 1"),
    "stream_landings": sql(_CLOSED_LANDINGS),
    "stream_late_backfill": sql(_CLOSED_LANDINGS),
    "stream_late_rows": sql(
        "select batch, count(*) as rows_in, count(*) filter (not behind) as rows_timely, count(*) filter (behind) as rows_late "
        "from (select cast(event_ts < timestamp '2024-01-21' as bigint) as batch, "
        f"event_ts < timestamp '2024-01-21' and event_ts <= {_MARK} as behind from stg_states) group by batch"),
    "stream_alarms": CHECK_ORACLES["alarms_in_service"],
    "stream_metric_windows": sql(
        "select timestamp '1970-01-01' + to_seconds(b * 3600) as window_start, "
        "timestamp '1970-01-01' + to_seconds(b * 3600 + 3600) as window_end, metric_name, component, "
        "round(sum(value), 4) as sum_value, max(value) as max_value, count(*) as points "
        "from (select *, cast(floor(epoch(ts) / 3600) as bigint) as b from points) group by b, metric_name, component "
        "having timestamp '1970-01-01' + to_seconds(b * 3600 + 3600) <= (select max(ts) - interval 2 day from points)"),
    "stream_dedupe_latest_current": sql(
        "select * from replayed "
        "qualify row_number() over (partition by icao24, event_ts order by bronze_loaded_at desc) = 1"),
    "stream_landings_current": sql("select icao24, live_landing_ts, approach_velocity_mps from landings"),
    "stream_metric_windows_current": sql(
        "select timestamp '1970-01-01' + to_seconds(b * 3600) as window_start, "
        "timestamp '1970-01-01' + to_seconds(b * 3600 + 3600) as window_end, metric_name, component, "
        "round(sum(value), 4) as sum_value, max(value) as max_value, count(*) as points "
        "from (select *, cast(floor(epoch(ts) / 3600) as bigint) as b from points) group by b, metric_name, component"),
    "stream_source": sql(PAYLOAD_SQL),
    "score_by_id": SCORED_SQL,
    "train_delay_model": sql(
        "select unnest(['carrier_code', 'origin_iata', 'dest_iata', 'distance_miles', 'scheduled_dep_hour', 'day_of_week', "
        "'month', 'dep_delay_min']) as feature, true as importance_is_share, n_rows, true as rounds_within_limit, "
        "median_mae_minutes, true as mae_below_median "
        f"from (select count(*) as n_rows from silver where {_TRAINING}), "
        f"(select round(avg(abs(arr_delay_min - middle)), 3) as median_mae_minutes from silver, {_MEDIAN} where {_TRAINING} and {_HELD_BACK})"),
    "score_delays": sql(
        "select flight_event_natural_key, true as predicted, 'request' as feature_source "
        f"from silver where {_TRAINING}"),
    "model_mae": sql(
        "select count(*) as rows, round(avg(abs(arr_delay_min - middle)), 6) as median_mae_minutes, true as mae_below_median "
        f"from silver, {_MEDIAN} where {_TRAINING} and {_HELD_BACK}"),
    "train_val_split": sql(
        f"select flight_event_natural_key, {_HELD_BACK} as is_validation from silver where {_TRAINING}"),
    "incremental_refresh": sql(
        "select icao24, callsign, origin_country, event_ts, longitude, latitude, baro_altitude_m, "
        "geo_altitude_m, on_ground, velocity_mps, true_track_deg, vertical_rate_mps, squawk, position_source, "
        "bronze_loaded_at, timestamp '2024-02-01 01:00:00' + case when event_date > date '2024-01-20' "
        "then interval 2 hour else interval 0 hour end as ingested_at, event_date as event_day from uniq_states"),
}
