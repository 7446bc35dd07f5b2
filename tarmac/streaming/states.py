"""Event-time streams over aircraft reports: dedupe, landings, metric windows, merges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tarmac import files
from tarmac.functions.keys import row_hash
from tarmac.operators.landings import MIN_APPROACH_MPS, REPORT_COLUMNS
from tarmac.operators.monitoring import metric_windows
from tarmac.operators.tables import upsert
from tarmac.plans.silver import STATE_KEY, StateTables, landings_from, load_states

# Fixed value: how late a report may come.
LATE = "2 days"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def dedupe_stream(states: DataFrame, late: str = LATE) -> DataFrame:
    """The first copy of each report to arrive, passed on at once.

    State is dropped after the lateness bound. How many copies meet in one batch is
    limited by the rate of the source.
    """
    return states.withWatermark("event_ts", late).dropDuplicatesWithinWatermark(STATE_KEY)


def latest_stream(states: DataFrame, late: str = LATE) -> DataFrame:
    """The latest loaded copy of each report, passed on when the watermark closes it.

    Settles copies exactly as the batch rule does. Being an aggregation it reduces the
    copies of a report before they are shuffled.
    """
    decisive = [c for c in REPORT_COLUMNS if c in states.columns]
    rest = sorted(set(states.columns) - {*STATE_KEY, "bronze_loaded_at", *decisive})
    values = [c for c in states.columns if c not in STATE_KEY]
    hashes = [row_hash(group) for group in (decisive, rest) if group]
    latest = F.max_by(F.struct(*values), F.struct("bronze_loaded_at", *hashes))
    return (
        states.withWatermark("event_ts", late).groupBy(*STATE_KEY).agg(latest.alias("latest"))
        .select(*STATE_KEY, "latest.*").select(*states.columns)
    )


def windows_stream(points: DataFrame, period_seconds: int, late: str, *groups: str) -> DataFrame:
    """Metric windows, each emitted once when the watermark closes it."""
    return metric_windows(points.withWatermark("ts", late), period_seconds, *groups)


# Airframes are dealt to so many groups; changing it needs new checkpoints.
BUCKETS = 1024
STEPS = "bucket int, steps binary"
LANDINGS = "icao24 string, at bigint, velocity double"

_FIRST, _LANDING, _LAST = 0, 1, 2
_STEP = pa.schema([
    ("icao24", pa.string()), ("at", pa.int64()), ("on_ground", pa.bool_()), ("velocity", pa.float64()), ("step", pa.int8())])


def _packed(steps: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, steps.schema) as writer:
        writer.write_table(steps.combine_chunks())
    return sink.getvalue().to_pybytes()


def _in_order(reports: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Reports by airframe and time, whether each is its airframe's first, and whether it landed after the one before."""
    codes = reports["icao24"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    steps = [reports["step"].to_numpy()] if "step" in reports.column_names else []
    order = np.lexsort((*steps, reports["at"].to_numpy(), codes))
    reports, codes = reports.take(pa.array(order)), codes[order]
    on_ground, velocity = reports["on_ground"].to_numpy(), reports["velocity"].to_numpy()
    opens, landed = np.ones(len(codes), bool), np.zeros(len(codes), bool)
    opens[1:] = codes[1:] != codes[:-1]
    landed[1:] = ~opens[1:] & on_ground[1:] & ~on_ground[:-1] & (velocity[:-1] > MIN_APPROACH_MPS)  # an unknown speed is NaN
    return reports, opens, landed


def day_steps(reports: pa.Table) -> pa.Table:
    """What the reports of a group of airframes and a day say: landings among them, and each airframe's first and last one."""
    bucket = reports["bucket"][0].as_py()
    reports, opens, landed = _in_order(reports.select(["icao24", "at", "on_ground", "velocity"]))
    velocity = reports["velocity"].to_numpy()
    approach = pa.chunked_array([np.concatenate((velocity[:1], velocity[:-1]))])
    found = []
    for step, rows, kept in (
        (_FIRST, reports, opens), (_LANDING, reports.set_column(3, "velocity", approach), landed),
        (_LAST, reports, np.append(opens[1:], True)),
    ):
        rows = rows.filter(pa.array(kept))
        found.append(rows.append_column("step", pa.array(np.full(len(rows), step, np.int8))).cast(_STEP))
    return pa.table({"bucket": pa.array([bucket], pa.int32()), "steps": pa.array([_packed(pa.concat_tables(found))], pa.binary())})


class BorderProcessor(StatefulProcessor):
    """Puts days together: an airframe's first report of a day is judged by its last one before.

    A key is a group of airframes, so its calls and state do not number as many as airframes. Reports
    come in the order of time: those of a batch are later than all of the batches before it, and a day
    that is spread over batches comes in parts. So one report is all the state an airframe has.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "reports binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [bytes(part) for frame in rows for part in frame["steps"]]
        if self.last.exists():
            parts.append(bytes(self.last.get()[0]))
        steps, opens, landed = _in_order(pa.concat_tables([pa.ipc.open_stream(part).read_all() for part in parts]))
        step, velocity = steps["step"].to_numpy(), steps["velocity"].to_numpy()
        # A first report follows the last one of the part before, or it opens its airframe.
        border, inner = landed & (step == _FIRST), step == _LANDING
        approach = np.where(border, np.concatenate((velocity[:1], velocity[:-1])), velocity)
        self.last.update((_packed(steps.filter(pa.array(np.append(opens[1:], True)))),))
        found = border | inner
        if found.any():
            yield pd.DataFrame({
                "icao24": steps["icao24"].filter(pa.array(found)).to_pylist(), "at": steps["at"].to_numpy()[found],
                "velocity": approach[found]})

    def close(self) -> None:
        pass


def landings_stream(states: DataFrame, late: str = LATE) -> DataFrame:
    """Landings of a stream of reports, each emitted when no earlier report can come any more.

    Copies are settled first. That operator holds each report until the watermark has passed it, so
    what a micro-batch hands on is later than all that was handed on before, and late reports are in
    their place. Within a batch the reports of a group of airframes and a day are put in order and
    judged; an airframe with very many reports is spread over its days. A keyed operator has a group
    of airframes and sees the landings and two reports of each airframe, day and batch. Needs the
    RocksDB state store.
    """
    unique = latest_stream(states.select(*STATE_KEY, *REPORT_COLUMNS, "bronze_loaded_at"), late)
    reports = unique.select(
        F.pmod(F.xxhash64("icao24"), F.lit(BUCKETS)).cast("int").alias("bucket"), F.to_date("event_ts").alias("event_day"),
        "icao24", F.unix_micros("event_ts").alias("at"),
        # Whether it is on the ground may be unknown: that is neither a landing nor a flight.
        F.coalesce("on_ground", F.lit(False)).alias("on_ground"),
        F.coalesce(F.when(F.col("on_ground").isNotNull(), F.col("velocity_mps").cast("double")), F.lit(float("nan"))).alias("velocity"),
    )
    days = reports.groupBy("bucket", "event_day").applyInArrow(day_steps, STEPS)
    found = days.groupBy("bucket").transformWithStateInPandas(
        BorderProcessor(), outputStructType=LANDINGS, outputMode="Append", timeMode="None")
    return found.select(
        "icao24", F.timestamp_micros("at").alias("live_landing_ts"), F.col("velocity").alias("approach_velocity_mps"))


def merge_stream(
    states: DataFrame, tables: StateTables, checkpoint: str, run_ts: dt.datetime,
    map_icao: DataFrame | None = None,
) -> DataStreamWriter:
    """Merge each micro-batch into the silver states, the latest load of a report winning.

    The day tails and sightings follow, so flights can be loaded after any batch.

    Replays change nothing. The two-day window of the batch merge applies here too,
    measured against what the table already holds.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        load_states(batch.sparkSession, tables, batch.persist(), run_ts, map_icao=map_icao)
        batch.unpersist()

    return states.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def current_stream(
    stream: DataFrame, path: str, keys: Sequence[str], partition_by: str, checkpoint: str,
) -> DataStreamWriter:
    """Keep a table of an aggregation's current results, open groups included.

    Each micro-batch brings the groups that changed and replaces their rows; when the watermark
    closes a group its row simply stays. What a stream has not closed when its source ends is
    therefore in the table, with all that has arrived.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, path, batch, keys, partition_by)

    return stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)


def landings_current(
    states: DataFrame, tables: StateTables, path: str, checkpoint: str, run_ts: dt.datetime,
) -> DataStreamWriter:
    """Keep a table of landings, by day, equal to the batch rule over all that has arrived.

    A micro-batch is merged into the silver states, then the landings of the days it touched,
    and of the day after, are made again from them: a late report can add, move or remove one.
    No airframe's reports are held in one task's state.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = [dt.date.fromisoformat(d) for d in load_states(spark, tables, batch, run_ts)]
        if not days:
            return
        after = max(days) + dt.timedelta(days=1)
        found = landings_from(spark, tables, min(days), after).withColumn("day", F.to_date("live_landing_ts"))
        found.filter(F.col("day") <= F.lit(after)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        filled = set(files.partition_values(spark, path, "day"))
        remade = [d.isoformat() for d in dict.fromkeys([*days, *[d + dt.timedelta(days=1) for d in days]])]
        kept = {r.day.isoformat() for r in found.select("day").distinct().collect()}  # days, not landings
        for day in remade:
            if day in filled and day not in kept:
                files.delete(spark, f"{path}/day={day}")

    return states.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def append_stream(stream: DataFrame, path: str, checkpoint: str, *partition_by: str) -> DataStreamWriter:
    """Append a stream's rows to Parquet files, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer


def with_state_store(spark: SparkSession) -> None:
    """Keyed state of ``landings_stream`` needs RocksDB."""
    spark.conf.set(STATE_STORE, ROCKSDB)
