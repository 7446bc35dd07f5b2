"""Late rows of a stream: told apart before anything drops them, counted, and put right by day."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tarmac import files
from tarmac.plans.silver import StateTables, landings_from, load_states
from tarmac.streaming.states import LATE


@dataclass(frozen=True)
class LateFolders:
    """Where a split stream goes."""

    timely: str  # batch=
    late: str    # event_day=, batch=
    notes: str   # one a batch: latest event time so far, rows by kind

    @classmethod
    def below(cls, root: str) -> LateFolders:
        return cls(f"{root}/timely", f"{root}/late", f"{root}/notes")


def _note(spark: SparkSession, path: str) -> dict | list | None:
    return json.loads(files.read_note(spark, path)) if files.exists(spark, path) else None


def _put_note(spark: SparkSession, path: str, content: dict | list) -> None:
    files.delete(spark, path)
    files.write_note(spark, path, json.dumps(content))


def split_late(
    states: DataFrame, folders: LateFolders, checkpoint: str, late: str = LATE, time_column: str = "event_ts",
) -> DataStreamWriter:
    """Route each micro-batch: rows behind the watermark to ``late`` by day, the others to ``timely``.

    The watermark of a batch is the latest event time of the batches before it, less ``late``, in whole
    milliseconds: Spark's own rule. It comes from the note of the batch before, so a repeated batch is
    split as it was. Streams that drop late rows read ``timely`` (``timely_stream``); what they would
    have lost is in ``late``: rows in = timely rows + late rows, batch by batch. A row without event
    time is timely. A batch shows its timely rows all at once, by a rename, and only once:
    repeated after a failure it does not show them again. Nothing is shuffled but the counts, and nothing
    is kept in memory: rows are counted while the timely ones are written, and read again if some are late.
    """
    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _note(spark, f"{folders.notes}/{batch_id - 1}") if batch_id else {"latest_us": None}
        if before is None:
            raise ValueError(f"batch {batch_id} has no note of the batch before it below {folders.notes}")
        us = F.unix_micros(F.col(time_column))
        mark = F.lit(before["latest_us"]).cast("bigint")
        border = F.floor(mark / 1000) * 1000 - F.expr(f"unix_micros(timestamp_micros(0) + interval {late})")
        batch = batch.withColumn("_late", F.coalesce(us <= border, F.lit(False)))
        counted = [F.max(us).alias("latest"), F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late")]
        shown, hidden = f"{folders.timely}/batch={batch_id}", f"{folders.timely}/.batch={batch_id}"
        if files.exists(spark, shown):
            counts = batch.agg(*counted).first()
        else:
            seen = Observation()
            batch.observe(seen, *counted).filter("not _late").drop("_late").write.mode("overwrite").parquet(hidden)
            files.rename(spark, hidden, shown)
            counts = seen.get
        if counts["late"]:
            batch.filter("_late").drop("_late").withColumn("event_day", F.to_date(time_column)).withColumn(
                "batch", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("event_day", "batch").parquet(folders.late)
        latest = max((v for v in (before["latest_us"], counts["latest"]) if v is not None), default=None)
        _put_note(spark, f"{folders.notes}/{batch_id}", {
            "latest_us": latest, "rows_in": counts["rows"], "rows_late": counts["late"]})

    return states.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)


def timely_stream(spark: SparkSession, folders: LateFolders, schema: T.StructType | str) -> DataFrame:
    """The timely rows as a stream of whole batches, of which a stream with the same bound drops none."""
    return spark.readStream.schema(schema).parquet(f"{folders.timely}/batch=*")


def late_counts(spark: SparkSession, folders: LateFolders) -> DataFrame:
    """(batch, rows_in, rows_timely, rows_late): a row a micro-batch."""
    notes = {int(name): _note(spark, f"{folders.notes}/{name}") for name in files.names(spark, folders.notes) if name.isdigit()}
    lines = [(b, n["rows_in"], n["rows_in"] - n["rows_late"], n["rows_late"]) for b, n in sorted(notes.items())]
    return spark.createDataFrame(lines, "batch bigint, rows_in bigint, rows_timely bigint, rows_late bigint")


def late_days(spark: SparkSession, folders: LateFolders, corrected: str | None = None) -> dict[dt.date, list[str]]:
    """The backfill list: days with late rows, and the batches that brought them, less what ``corrected`` has seen.

    From folder names alone.
    """
    found = {}
    for day in files.partition_values(spark, folders.late, "event_day"):
        batches = files.partition_values(spark, f"{folders.late}/event_day={day}", "batch")
        seen = _note(spark, f"{corrected}/_seen/{day}") if corrected else None
        if set(batches) - set(seen or []):
            found[dt.date.fromisoformat(day)] = batches
    return found


def _next_days(late: DataFrame, tables: StateTables) -> DataFrame:
    """(event_day, next_day) of each airframe with late rows on a day: its next day with reports, looked up among airframe-days."""
    tails = late.sparkSession.read.parquet(tables.tails).select("icao24", "event_day")
    hit = late.select("icao24", "event_day").distinct().withColumn("hit", F.lit(True))
    following = F.lead("event_day").over(Window.partitionBy("icao24").orderBy("event_day"))
    chain = tails.join(hit, ["icao24", "event_day"], "left").withColumn("next_day", following)
    return chain.filter("hit").select("event_day", "next_day").distinct()


def backfill_landings(
    spark: SparkSession, folders: LateFolders, tables: StateTables, corrected: str, run_ts: dt.datetime,
    closed_before: dt.date, patience_days: int = 30,
) -> list[dt.date]:
    """Merge the listed late rows into the silver states and make the landings they touch anew, by day.

    ``tables`` hold the timely rows already (``merge_stream``). A late row can change landings of its own
    day and of the airframe's next day with reports. Days from ``closed_before`` on are still open in the
    stream and left to it: a late day whose airframes reach into one, or have not reported since, stays
    on the list, the latter for ``patience_days``. A day made anew has a folder in ``corrected``, if it
    has landings, and a note there while it counts (``landings_served``); the late batches it was made
    from are noted last, so a run that dies is repeated. Returns the days made anew.
    """
    listed = {day: batches for day, batches in late_days(spark, folders, corrected).items() if day < closed_before}
    if not listed:
        return []
    late = spark.read.option("basePath", folders.late).parquet(
        *[f"{folders.late}/event_day={day}" for day in listed]).drop("batch")
    load_states(spark, tables, late.drop("event_day"), run_ts, backfill=(min(listed), max(listed)))
    chain = _next_days(late, tables).collect()  # pairs of days
    remade = sorted(d for d in {day for pair in chain for day in pair} if d is not None and d < closed_before)
    patient = closed_before - dt.timedelta(days=patience_days)
    waits = {r.event_day for r in chain if (r.event_day >= patient if r.next_day is None else r.next_day >= closed_before)}
    for day in remade:
        files.delete(spark, f"{corrected}/_days/{day}")
        files.delete(spark, f"{corrected}/day={day}")
    landings_from(spark, tables, remade[0], remade[-1]).withColumn("day", F.to_date("live_landing_ts")).filter(
        F.col("day").isin(remade)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(corrected)
    for day in remade:
        _put_note(spark, f"{corrected}/_days/{day}", [])
    for day, batches in listed.items():
        if day not in waits:
            _put_note(spark, f"{corrected}/_seen/{day}", batches)
    return remade


def landings_served(spark: SparkSession, landings: DataFrame, corrected: str) -> DataFrame:
    """Landings of a stream, those of corrected days replaced."""
    days = [dt.date.fromisoformat(name) for name in files.names(spark, f"{corrected}/_days") if not name.startswith(".")]
    if not days:
        return landings
    left = landings.filter(~F.to_date("live_landing_ts").isin(days))
    made = spark.read.schema(landings.schema).parquet(corrected).select(*landings.columns).filter(
        F.to_date("live_landing_ts").isin(days))
    return left.unionByName(made)
