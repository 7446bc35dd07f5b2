"""From the message stream to bronze files: source, sink with dead letters, counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tarmac import files
from tarmac.operators.tables import TARGET_BYTES, compact
from tarmac.sources.payload import accepted, dead_letters, parse_messages

# A file is closed after a minute or five thousand messages.
ROLL_INTERVAL = "60 seconds"
ROLL_ROWS = 5000


def message_stream(spark: SparkSession, servers: str, topic: str, max_batch: int | None = None) -> DataFrame:
    """Messages of a Kafka topic from its beginning (needs the Kafka connector).

    Offsets live in the checkpoint of the query that reads the stream; they advance
    only after its batch has been written. Intake is not limited unless ``max_batch`` is
    given; how large files get is the sink's concern.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_batch)
    return (
        reader.load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of Parquet files as a stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def available_now(writer: DataStreamWriter) -> None:
    """Run a stream over everything that has arrived, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def _count_metrics(
    spark: SparkSession, batch_id: int, counts: dict[str, int], path: str, component: str
) -> None:
    """Counters of one batch; a replayed batch replaces those it had written."""
    rows = [(batch_id, name, float(n), "Count", component) for name, n in counts.items()]
    frame = spark.createDataFrame(
        rows, "batch bigint, metric_name string, value double, unit string, component string")
    frame.coalesce(1).withColumn("ts", F.current_timestamp()).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch", "metric_name").parquet(path)


def roll_to_bronze(
    messages: DataFrame, bronze: str, dead_letter: str, metrics: str, checkpoint: str,
    interval: str = ROLL_INTERVAL, rows_per_file: int = ROLL_ROWS,
) -> DataStreamWriter:
    """Write messages (key, value) to ``ds=/hr=`` folders, rejected ones to the dead letters.

    Folders go by ingest time, which is the start of the micro-batch and is kept in the
    checkpoint. A batch that is replayed after a failure therefore overwrites exactly
    the files it had written: no row is lost, none is written twice. A failed write is
    counted and fails the batch, so its offsets are not committed. Batches start every
    ``interval`` and take all that has arrived; files end at ``rows_per_file``.
    """
    parsed = parse_messages(messages).withColumn("ingest_ts", F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        flushed, rejected = Observation(), Observation()
        rows = F.count(F.lit(1)).alias("rows")
        good = accepted(batch, "ingest_ts").select(
            "*", F.to_date("ingest_ts").alias("ds"), F.hour("ingest_ts").alias("hr"),
            F.lit(batch_id).alias("batch"),
        ).drop("ingest_ts").observe(flushed, rows)
        bad = dead_letters(batch, "key", "value").withColumn(
            "batch", F.lit(batch_id)).observe(rejected, rows)
        try:
            for frame, path, folders in (
                (good, bronze, ["ds", "hr", "batch"]), (bad, dead_letter, ["batch"])
            ):
                (
                    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    .option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*folders).parquet(path)
                )
        except Exception:
            _count_metrics(spark, batch_id, {"FlushError": 1, "ConsumerError": 1}, metrics, "consumer")
            raise
        finally:
            batch.unpersist()
        _count_metrics(spark, batch_id, {
            "RowsFlushed": flushed.get["rows"], "MessagesDLQ": rejected.get["rows"],
        }, metrics, "consumer")

    return (
        parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval))


def compact_bronze(spark: SparkSession, bronze: str, before: dt.datetime, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Turn the batch folders of closed hours into few files; returns the hours rewritten.

    An hour is closed if it ends by ``before``, which the caller takes no later than the hour of the
    stream's last committed batch: only that batch can be written again. What is compacted stands
    under ``batch=-1``. An hour of 60 s rolls is 60 folders before, and one of a few files after.
    """
    done = []
    for day in files.partition_values(spark, bronze, "ds"):
        begin = dt.datetime.fromisoformat(day)
        hours = [h for h in files.partition_values(spark, f"{bronze}/ds={day}", "hr")
                 if begin + dt.timedelta(hours=int(h) + 1) <= before]
        done += [f"{day} {h}" for h in compact(spark, f"{bronze}/ds={day}", "hr", hours, "batch=-1", target_bytes)]
    return done


def publish(
    events_json: DataFrame, fmt: str, checkpoint: str, metrics: str, **options: str
) -> DataStreamWriter:
    """Send keyed JSON messages to a sink such as Kafka, where the key fixes the partition.

    Delivery is at least once: a replayed batch is sent again.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        # A message without a key has no partition to go to and is dropped, but counted.
        keyed, offered, sent = F.col("key").isNotNull(), Observation(), Observation()
        counted = batch.observe(offered, F.count(F.lit(1)).alias("rows")).filter(keyed).observe(
            sent, F.count(F.lit(1)).alias("rows"))
        try:
            counted.write.format(fmt).options(**options).mode("append").save()
        except Exception:
            _count_metrics(batch.sparkSession, batch_id, {"MessagesFailed": batch.count()}, metrics, "producer")
            raise
        counts = {"MessagesPublished": sent.get["rows"]}
        if dropped := offered.get["rows"] - sent.get["rows"]:
            counts["MessagesDropped"] = dropped
        _count_metrics(batch.sparkSession, batch_id, counts, metrics, "producer")

    return events_json.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
