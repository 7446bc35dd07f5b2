"""Monthly archives: which are due, unpacking them, landing them once."""

from __future__ import annotations

import csv
import datetime as dt
import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files
from tarmac.schemas import MANIFEST

# Fixed value: the first month the source publishes.
FIRST_MONTH = dt.date(2009, 1, 1)
_RECORDS_PER_BATCH = 20_000


class MissingMember(ValueError):
    """Archives without a CSV member; ``paths`` names them."""

    def __init__(self, paths: Sequence[str]) -> None:
        super().__init__(f"no CSV member in {', '.join(paths)}")
        self.paths = list(paths)


def target_month(as_of: dt.date) -> dt.date:
    """The month a run on ``as_of`` has to load: the one before."""
    return (as_of.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def month_partitions(spark: SparkSession, as_of: dt.date, first: dt.date = FIRST_MONTH) -> DataFrame:
    """Every month from the first to the one before ``as_of``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(target_month(as_of)), F.expr("interval 1 month")))
        .alias("partition")
    )


def missing_partitions(
    spark: SparkSession, manifest: DataFrame, as_of: dt.date, first: dt.date = FIRST_MONTH
) -> DataFrame:
    """Months no manifest row covers."""
    loaded = manifest.select("partition").distinct()
    return month_partitions(spark, as_of, first).join(loaded, "partition", "left_anti")


def read_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, partition, content) of archives below ``ds=`` folders, one row each."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(paths)
    return found.select("path", F.col("ds").cast("date").alias("partition"), "content")


def _csv_member(archive: zipfile.ZipFile) -> str | None:
    return next((n for n in archive.namelist() if n.lower().endswith(".csv")), None)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for content in batch["content"]:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                found.append(_csv_member(archive))
        yield batch.drop(columns=["content"]).assign(member=found)


def csv_members(archives: DataFrame) -> DataFrame:
    """(path, partition, sha256, content_length, member) from the archives' directories; no data is unpacked.

    ``member`` is the first CSV member and NULL for an archive that has none.
    """
    return archives.select(
        "path", F.col("partition").cast("date").alias("partition"), F.sha2("content", 256).alias("sha256"),
        F.octet_length("content").cast("bigint").alias("content_length"), "content",
    ).mapInPandas(_members, "path string, partition date, sha256 string, content_length bigint, member string")


def expand_archives(archives: DataFrame, names: Sequence[str]) -> DataFrame:
    """Records of the first CSV member of each archive: the wanted columns, as text.

    Archives (path, partition, content) are unpacked in parallel, one row each; a member
    is decompressed as a stream and leaves the task in batches, so its size does not
    matter. Columns are found by the header, in any letter case, once per archive; one that
    the archive lacks is NULL. An archive without a CSV member has no records.
    """
    wanted = [n.lower() for n in names]

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, partition, content in zip(batch["path"], batch["partition"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    member = _csv_member(archive)
                    if member is None:
                        continue
                    with archive.open(member) as raw:
                        records = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                        header = [h.strip().lower() for h in next(records, [])]
                        places = [header.index(n) if n in header else None for n in wanted]
                        while rows := list(islice(records, _RECORDS_PER_BATCH)):
                            yield pd.DataFrame({
                                "path": path, "partition": partition, "member": member,
                                **{f"c{i}": pd.Series(
                                    [r[at] if at is not None and at < len(r) else None for r in rows], dtype=object)
                                   for i, at in enumerate(places)}})

    fields = "".join(f", c{i} string" for i in range(len(wanted)))
    found = archives.select("path", "partition", "content").mapInPandas(
        unpack, f"path string, partition date, member string{fields}")
    return found.select("path", "partition", "member", *[F.col(f"c{i}").alias(n) for i, n in enumerate(wanted)])


def land_seeds(
    spark: SparkSession, found: Mapping[str, str], root: str, manifest_path: str, day: dt.date, run_ts: dt.datetime,
) -> DataFrame:
    """Land reference files (name to path) that changed as ``ds=<day>/<name>`` and note them.

    A file is as it was published; it is compared by hash with what was last landed under its
    name, so an unchanged list is not landed again. The file is complete before it gets its
    name, and the manifest comes last. Returns the manifest rows of this run.
    """
    paths = {name: path for name, path in sorted(found.items())}
    read = spark.read.format("binaryFile").load(list(paths.values()))
    place = F.create_map(*[F.lit(x) for name, path in paths.items() for x in (path.rsplit("/", 1)[1], name)])
    listed = read.select(
        place[F.element_at(F.split("path", "/"), -1)].alias("name"), F.sha2("content", 256).alias("sha256"),
        F.col("length").alias("content_length"),
        F.size(F.filter(F.split(F.col("content").cast("string"), "\n"), lambda line: F.trim(line) != "")).alias("lines"))
    last = read_manifest(spark, manifest_path).groupBy(F.col("member_filename").alias("name")).agg(
        F.max_by("sha256", "downloaded_at").alias("last"))
    # One short row per file.
    fresh = listed.join(last, "name", "left").filter(~F.col("sha256").eqNullSafe(F.col("last"))).collect()
    for r in fresh:
        target = f"{root}/ds={day.isoformat()}/{r.name}"
        files.copy(spark, paths[r.name], f"{target}.incoming")
        files.delete(spark, target)
        files.rename(spark, f"{target}.incoming", target)
    notes = spark.createDataFrame([
        (paths[r.name], run_ts, r.content_length, r.sha256, r.name, r.lines, day) for r in fresh], MANIFEST)
    if fresh:
        notes.coalesce(1).write.mode("append").parquet(manifest_path)
    return notes


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """What was last loaded from each archive of a partition."""
    return manifest.groupBy("partition", F.col("source_url").alias("path")).agg(
        F.max_by("sha256", "downloaded_at").alias("sha256"))


def new_archives(incoming: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Archives whose content differs from what was last loaded from them.

    ``incoming`` has path, content and partition. Only hashes and partitions are
    compared; the archive bytes take part in no shuffle when the manifest is broadcast.
    """
    hashed = incoming.withColumn("sha256", F.sha2("content", 256))
    if force:
        return hashed
    return hashed.join(latest_manifest(manifest), ["partition", "path", "sha256"], "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    if files.holds_data(spark, path):
        return spark.read.schema(MANIFEST).parquet(path)
    return spark.createDataFrame([], MANIFEST)


def ingest_archives(
    spark: SparkSession, incoming: DataFrame, landing: str, manifest_path: str,
    columns: Sequence[str], run_ts: dt.datetime, force: bool = False,
) -> DataFrame:
    """Land new archives below ``ds=/archive=`` folders and note them in the manifest.

    An archive's rows are replaced as a whole and the manifest is written last: a run
    that dies in between is repeated without leaving rows twice. Returns the manifest
    rows of this run. An archive without a CSV member is not noted, so it comes again with
    the next run; once the others have landed it is reported as an error.
    """
    # One short row per archive: the months of a run, not their data.
    chosen = csv_members(new_archives(incoming, read_manifest(spark, manifest_path), force)).collect()
    broken = sorted(r.path for r in chosen if r.member is None)
    chosen = [r for r in chosen if r.member is not None]
    if not chosen:
        if broken:
            raise MissingMember(broken)
        return spark.createDataFrame([], MANIFEST)
    wanted = spark.createDataFrame(
        chosen, "path string, partition date, sha256 string, content_length bigint, member string")
    records = expand_archives(incoming.join(wanted.select("path"), "path", "left_semi"), columns)
    rows = records.withColumnRenamed("partition", "ds").withColumn("archive", F.md5("path"))
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds", "archive").parquet(landing)
    )
    # What was landed is counted from the landed partitions, not by unpacking again.
    landed = (
        spark.read.parquet(landing).filter(F.col("ds").isin(*[r.partition for r in chosen]))
        .groupBy("path").agg(F.count(F.lit(1)).alias("row_count_estimate"))
    )
    notes = wanted.join(landed, "path", "left").select(
        F.col("path").alias("source_url"), F.lit(run_ts).cast("timestamp").alias("downloaded_at"),
        "content_length", "sha256", F.col("member").alias("member_filename"),
        F.coalesce("row_count_estimate", F.lit(0).cast("bigint")).alias("row_count_estimate"),
        "partition",
    )
    done = spark.createDataFrame(notes.collect(), MANIFEST)
    done.coalesce(1).write.mode("append").parquet(manifest_path)
    if broken:
        raise MissingMember(broken)
    return done
