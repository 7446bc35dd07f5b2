"""Upkeep of Parquet tables: upsert, full refresh, versions, promotion, expiry."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import files
from tarmac.operators import keyindex
from tarmac.operators.dedupe import keep_first
from tarmac.session import scratch_path


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A table whose partitions may differ in later columns.

    Without ``schema`` the footers of all files are merged; name the schema where that
    is too much reading.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` in place of those with the same key.

    Columns only one side has are kept; they come last and are NULL for the other side.
    """
    untouched = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return untouched.unionByName(source, allowMissingColumns=True)


def _laid_out(df: DataFrame, partition_by: str, sort_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value and sorted for tight row-group statistics.

    Rebalancing, unlike a plain repartition, splits a value that outgrows one task.
    """
    return df.hint("rebalance", partition_by).sortWithinPartitions(partition_by, *sort_by)


# Hidden folders in a table: a merge that is complete but may not be in place yet, and one that is
# not complete. A table has one writer at a time.
_READY, _DRAFT = "_merged-", "_draft-"


def settle(spark: SparkSession, path: str) -> None:
    """Finish what a run that died has left: a complete merge or refresh is put in place.

    Every write to a table starts with this; a reader that follows a failure can call it too.
    """
    old, new = f"{path}.old", f"{path}.next"
    if files.exists(spark, old):  # a swap was under way
        if files.exists(spark, path):
            files.delete(spark, old)
        else:
            files.rename(spark, *((new, path) if files.exists(spark, new) else (old, path)))
            files.delete(spark, old)
    for name in files.names(spark, path):
        if name.startswith(_READY):
            _put_in_place(spark, path, name)
        elif name.startswith(_DRAFT):
            files.delete(spark, f"{path}/{name}")


def _put_in_place(spark: SparkSession, path: str, name: str) -> None:
    """Move each merged partition over the old one; each is either still to be moved or done.

    A partition that the merge has left without rows is an empty folder here, and goes.
    """
    staged = f"{path}/{name}"
    for folder in files.names(spark, staged):
        if "=" in folder:
            files.delete(spark, f"{path}/{folder}")
            if files.names(spark, f"{staged}/{folder}"):
                files.rename(spark, f"{staged}/{folder}", f"{path}/{folder}")
    files.delete(spark, staged)


def upsert(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str,
    latest_by: Sequence[Column] | None = None, sort_by: Sequence[str] = (),
) -> list[str]:
    """Merge ``source`` into a partitioned table; returns the partition values rewritten.

    Only partitions the source touches are read and written. A key must determine its
    partition. ``latest_by`` settles repeated keys in the source. The partitions are written
    once, complete, to a hidden folder of the table; renaming it is the commit, and from then
    on moving its partitions into place can be repeated (``settle``). A run that dies before
    the commit has changed nothing, one that dies after it is finished by the next.
    """
    settle(spark, path)
    if latest_by:
        source = keep_first(source, keys, latest_by)
    run = uuid.uuid4().hex[:12]
    draft, staged = f"{path}/{_DRAFT}{run}", scratch_path(spark, "upsert-source")
    present = set(files.partition_values(spark, path, partition_by))
    first = staged if present else draft
    _laid_out(source, partition_by, sort_by).write.partitionBy(partition_by).parquet(first)
    touched = files.partition_values(spark, first, partition_by)
    known = [v for v in touched if v in present]
    if known:
        # Whole folders are named, so other partitions are not even listed.
        old = (
            spark.read.option("mergeSchema", "true").option("basePath", path)
            .parquet(*[f"{path}/{partition_by}={v}" for v in known])
        )
        dtype = source.schema[partition_by].dataType
        old = old.withColumn(partition_by, F.col(partition_by).cast(dtype))
        again = spark.read.schema(source.schema).option("basePath", staged).parquet(
            *[f"{staged}/{partition_by}={v}" for v in known])
        result = merge_rows(old, again, list(dict.fromkeys([*keys, partition_by])))
        _laid_out(result, partition_by, sort_by).write.partitionBy(partition_by).parquet(draft)
    if present and touched:  # what the table did not have is complete as it is
        files.make_folder(spark, draft)
        for value in touched:
            if value not in present:
                files.rename(spark, f"{staged}/{partition_by}={value}", f"{draft}/{partition_by}={value}")
    if touched:
        files.rename(spark, draft, f"{path}/{_READY}{run}")
        _put_in_place(spark, path, f"{_READY}{run}")
    elif not present:
        files.delete(spark, path)
    files.delete(spark, staged)
    return touched


def upsert_by_key(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str,
    latest_by: Sequence[Column] | None = None, sort_by: Sequence[str] = (),
) -> list[str]:
    """Merge by key alone: a key whose partition has changed leaves no row in the old one.

    Returns the partition values rewritten: those of the source, and those that lose rows to it.
    Keys the source's own partitions do not have are looked up in the key filters that each merge
    leaves inside the folders it writes (``keyindex``); only folders that these do not rule out are
    listed, and only their key columns read, to see which hold an old version. Folders that other
    writers made have no filter and are looked into; ``keyindex.write_filters`` gives them one.
    ``latest_by`` settles repeated keys in the source, whatever their partitions. A NULL in a key
    matches nothing. Commit and failures are those of ``upsert``; filters move with their folders.
    """
    settle(spark, path)
    if latest_by:
        source = keep_first(source, keys, latest_by)
    run = uuid.uuid4().hex[:12]
    draft, staged = f"{path}/{_DRAFT}{run}", scratch_path(spark, "upsert-source")
    present = files.partition_values(spark, path, partition_by)
    _laid_out(source, partition_by, sort_by).write.partitionBy(partition_by).parquet(staged)
    touched = files.partition_values(spark, staged, partition_by)
    if not touched:
        files.delete(spark, staged)
        return []
    dtype = source.schema[partition_by].dataType
    again = spark.read.schema(source.schema).option("basePath", staged).parquet(
        *[f"{staged}/{partition_by}={v}" for v in touched])

    def folders(values: Sequence[str]) -> DataFrame:
        old = (
            spark.read.option("mergeSchema", "true").option("basePath", path)
            .parquet(*[f"{path}/{partition_by}={v}" for v in values])
        )
        return old.withColumn(partition_by, F.col(partition_by).cast(dtype))

    # Keys that are new to their partition: inserted, or moved here from another.
    known = [v for v in touched if v in set(present)]
    asked = again.select(*keys, partition_by)
    if known:
        asked = asked.join(folders(known).select(*keys, partition_by), [*keys, partition_by], "left_anti")
    asked_path = scratch_path(spark, "upsert-new-keys")
    asked.select(*keys).write.parquet(asked_path)
    asked = spark.read.schema(source.select(*keys).schema).parquet(asked_path)
    maybe = [v for v in keyindex.folders_that_may_hold(
        spark, path, [v for v in present if v not in set(known)], asked, keys, partition_by)]
    losing: list[str] = []
    if maybe:
        held = folders(maybe).select(*keys, partition_by).join(asked, list(keys), "left_semi")
        losing = sorted(str(r[0]) for r in held.select(F.col(partition_by).cast("string")).distinct().collect())
        losing = [v for v in maybe if unquote(v) in set(losing)]
    result = again
    if known or losing:
        result = merge_rows(folders([*known, *losing]), again, keys)
    _laid_out(result, partition_by, sort_by).write.partitionBy(partition_by).parquet(draft)
    written = files.partition_values(spark, draft, partition_by)
    keyindex.write_filters(spark, draft, written, keys, partition_by)
    for value in losing:
        if value not in set(written):
            files.make_folder(spark, f"{draft}/{partition_by}={value}")
    files.rename(spark, draft, f"{path}/{_READY}{run}")
    _put_in_place(spark, path, f"{_READY}{run}")
    for used in (staged, asked_path):
        files.delete(spark, used)
    return sorted({*touched, *losing})


def change_feed(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: str, columns: Sequence[str],
) -> DataFrame:
    """What merging ``source`` by key into a table will change, in ``columns``: rows with a ``sign``.

    A row the merge replaces counts -1, also where it lies in another partition than the new one; a
    row it brings counts 1; rows that stay the same in all ``columns`` are left out. Only partitions
    of the source are read, and those that the key filters do not rule out (``keyindex``). The
    source has each key once. To be taken before the merge.
    """
    settle(spark, path)
    present = files.partition_values(spark, path, partition_by)
    new = source.select(*keys, *columns, F.lit(1).alias("sign"))
    if not present:
        return new.select(*columns, "sign")
    touched = {str(r[0]) for r in source.select(F.col(partition_by).cast("string")).distinct().collect()}
    known = [v for v in present if unquote(v) in touched]
    maybe = keyindex.folders_that_may_hold(
        spark, path, [v for v in present if v not in set(known)], source.select(*keys), keys, partition_by)
    if not [*known, *maybe]:
        return new.select(*columns, "sign")
    old = (
        spark.read.option("mergeSchema", "true").option("basePath", path)
        .parquet(*[f"{path}/{partition_by}={v}" for v in [*known, *maybe]])
        .join(source.select(*keys), list(keys), "left_semi").select(*keys, *columns, F.lit(-1).alias("sign")))
    # Equal versions cancel out.
    same = [*keys, *columns]
    return new.unionByName(old).groupBy(*same).agg(F.sum("sign").cast("int").alias("sign")).filter(
        "sign <> 0").select(*columns, "sign")


def replace_partitions(
    spark: SparkSession, path: str, rows: DataFrame, partition_by: str, values: Sequence[str], sort_by: Sequence[str] = (),
) -> None:
    """Put ``rows`` in the place of the partitions ``values``; one without rows goes. Commits as ``upsert`` does."""
    settle(spark, path)
    if not values:
        return
    run = uuid.uuid4().hex[:12]
    draft = f"{path}/{_DRAFT}{run}"
    _laid_out(rows, partition_by, sort_by).write.partitionBy(partition_by).parquet(draft)
    for value in set(values) - set(files.partition_values(spark, draft, partition_by)):
        files.make_folder(spark, f"{draft}/{partition_by}={value}")
    files.rename(spark, draft, f"{path}/{_READY}{run}")
    _put_in_place(spark, path, f"{_READY}{run}")


def full_refresh(spark: SparkSession, path: str, df: DataFrame) -> None:
    """Replace a table. The new one is complete before it takes the old one's place."""
    settle(spark, path)
    incoming = f"{path}.next"
    files.delete(spark, incoming)  # the draft of a run that died
    df.write.parquet(incoming)
    swap(spark, incoming, path)


def swap(spark: SparkSession, incoming: str, path: str) -> None:
    """Put ``incoming`` in the place of ``path``, dropping what was there.

    Between the renames ``settle`` finds a complete table beside the path, whichever it is.
    """
    outgoing = f"{path}.old"
    if files.exists(spark, path):
        files.rename(spark, path, outgoing)
    files.rename(spark, incoming, path)
    files.delete(spark, outgoing)


# --- versioned dimension -------------------------------------------------------------

def open_versions(source: DataFrame, as_of: dt.datetime) -> DataFrame:
    """First load of a versioned table: every row is current."""
    stamp = F.lit(as_of).cast("timestamp")
    return source.withColumn("valid_from", stamp).withColumn(
        "valid_to", F.lit(None).cast("timestamp")
    )


def scd2_merge(
    table: DataFrame, source: DataFrame, key: str, check: Sequence[str], as_of: dt.datetime
) -> DataFrame:
    """Next state of a versioned table after seeing ``source``.

    A change in a checked column closes the open version and opens another; a key the
    source no longer has is closed; one that comes back gets a new version. One outer
    join of open versions and source decides all cases; closed versions pass through.
    Columns only one side has are kept and NULL for the other.
    """
    fixed = {key, "valid_from", "valid_to"}
    attributes = [c for c in dict.fromkeys([*table.columns, *source.columns]) if c not in fixed]
    types = {f.name: f.dataType for f in [*source.schema, *table.schema]}
    absent = lambda df: {c: F.lit(None).cast(types[c]) for c in attributes if c not in df.columns}
    table, source = table.withColumns(absent(table)), source.withColumns(absent(source))
    stamp = F.lit(as_of).cast("timestamp")
    columns = [key, *attributes, "valid_from", "valid_to"]
    closed = table.filter(F.col("valid_to").isNotNull()).select(*columns)
    current = table.filter(F.col("valid_to").isNull()).select(
        key, F.struct(*attributes, "valid_from").alias("old")
    )
    incoming = source.select(key, F.struct(*attributes).alias("new"))

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = has_old & has_new
    for c in check:
        same &= F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    open_end = F.lit(None).cast("timestamp")

    def version(side: str, start: Column, end: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in attributes]
        return F.struct(*fields, start.alias("valid_from"), end.alias("valid_to"))

    kept = F.when(has_old, version("old", F.col("old.valid_from"), F.when(same, open_end).otherwise(stamp)))
    opened = F.when(has_new & ~same, version("new", stamp, open_end))
    decided = current.join(incoming, key, "full").select(
        key, F.explode(F.array_compact(F.array(kept, opened))).alias("v")
    )
    return closed.unionByName(decided.select(key, "v.*").select(*columns))


def version_at(facts: DataFrame, versions: DataFrame, fact_key: str, dim_key: str, day: str) -> DataFrame:
    """Each fact with the version valid on its day (``valid_from`` in, ``valid_to`` out)."""
    v = versions.select(*[F.col(c).alias(f"dim_{c}") for c in versions.columns])
    on = (
        (F.col(fact_key) == F.col(f"dim_{dim_key}"))
        & (F.col("dim_valid_from") <= F.col(day))
        & (F.col("dim_valid_to").isNull() | (F.col(day) < F.col("dim_valid_to")))
    )
    return facts.join(v, on, "left")


# --- promotion -----------------------------------------------------------------------

def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of several tables; counting reads no columns."""
    counts = None
    for name in sorted(tables):
        one = tables[name].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def promote_parity(
    dev: Mapping[str, DataFrame], prod: Mapping[str, DataFrame],
    tolerance: float = 0.01, upper_bound: float = 0.05,
) -> DataFrame:
    """Row counts of the tables both sides have, and whether dev may replace prod."""
    dev_counts, prod_counts = row_counts(dev), row_counts(prod)
    common = dev_counts.select("table_name").intersect(prod_counts.select("table_name"))
    ratio = F.col("dev_rows") / F.nullif(F.col("prod_rows"), F.lit(0)).cast("double")
    return (
        common.join(dev_counts.withColumnRenamed("rows", "dev_rows"), "table_name")
        .join(prod_counts.withColumnRenamed("rows", "prod_rows"), "table_name")
        .withColumn("ratio", ratio)
        .withColumn(
            "status",
            F.when(F.col("prod_rows") == 0, "SKIP")
            .when(F.col("ratio").between(1.0 - tolerance, 1.0 + upper_bound), "OK")
            .otherwise("FAIL"),
        )
    )


def _promotion(prod_root: str) -> str:
    return f"{prod_root}.promotion"


def settle_promotion(spark: SparkSession, prod_root: str) -> None:
    """Finish an exchange that a run which died has begun.

    The note names the folders; which of them exist tells the steps that are done. Every promotion
    starts with this; a reader that finds no prod folder can call it too.
    """
    note = _promotion(prod_root)
    if not files.exists(spark, note):
        return
    about = json.loads(files.read_note(spark, note))
    dev_root, parked = about["dev"], about["parked"]
    if files.exists(spark, parked):
        if not files.exists(spark, prod_root):
            files.rename(spark, dev_root, prod_root)
        files.rename(spark, parked, dev_root)
    files.delete(spark, note)


def exchange(spark: SparkSession, dev_root: str, prod_root: str) -> None:
    """Put each of two folders in the other's place; a run that dies anywhere is finished by the next."""
    settle_promotion(spark, prod_root)
    parked = f"{prod_root}.swap-{uuid.uuid4().hex[:8]}"
    files.write_note(spark, _promotion(prod_root), json.dumps({"dev": dev_root, "parked": parked}))
    files.rename(spark, prod_root, parked)
    settle_promotion(spark, prod_root)


def promote(
    spark: SparkSession, dev_root: str, prod_root: str, tables: Sequence[str], dry_run: bool = False
) -> DataFrame:
    """Exchange the dev and prod folders if every common table passes the parity check.

    What is to be done is noted beside the prod folder first, so a run that dies between the
    renames never leaves prod missing for good (``settle_promotion``).
    """
    settle_promotion(spark, prod_root)

    def present(root: str) -> dict[str, DataFrame]:
        return {
            t: spark.read.parquet(f"{root}/{t}")
            for t in tables if files.holds_data(spark, f"{root}/{t}")
        }

    dev, prod = present(dev_root), present(prod_root)
    if not set(dev) & set(prod):
        raise ValueError("no common tables, nothing to promote")
    # One row per table, far below any driver limit; fixed now, before folders move.
    parity = promote_parity(dev, prod)
    report = spark.createDataFrame(parity.collect(), parity.schema)
    if not dry_run and report.filter("status = 'FAIL'").isEmpty():
        exchange(spark, dev_root, prod_root)
    return report


# --- compaction ----------------------------------------------------------------------

TARGET_BYTES = 128 << 20


def compact(
    spark: SparkSession, path: str, folder: str, values: Sequence[str], into: str,
    target_bytes: int = TARGET_BYTES, sort_by: Sequence[str] = (),
) -> list[str]:
    """Rewrite partitions of many small files as few of about ``target_bytes``; returns those rewritten.

    ``values`` of the partition column ``folder`` name folders that nobody writes to any more. Each
    gets one subfolder ``into`` (``column=value``; what the subfolders were goes). A partition that
    has no more files than it needs is left alone, so repeating this changes nothing. The commit is
    that of ``upsert``: readers see a partition as it was or as it is, and ``settle`` finishes what
    a run that died has left.
    """
    settle(spark, path)
    column = into.split("=", 1)[0]
    wanted: dict[str, int] = {}
    for value in values:
        sizes = files.sizes(spark, f"{path}/{folder}={value}")
        count = max(1, -(-sum(sizes.values()) // target_bytes))
        if len(sizes) > count:
            wanted[value] = count
    if not wanted:
        return []
    run = uuid.uuid4().hex[:12]
    draft = f"{path}/{_DRAFT}{run}"
    for value, count in wanted.items():
        rows = spark.read.option("mergeSchema", "true").parquet(f"{path}/{folder}={value}").drop(column)
        # Each task reads whole neighbouring files: nothing is shuffled unless rows are to be sorted.
        rows = rows.repartitionByRange(count, *sort_by).sortWithinPartitions(*sort_by) if sort_by else rows.coalesce(count)
        rows.write.option("compression", "zstd").parquet(f"{draft}/{folder}={value}/{into}")
    files.rename(spark, draft, f"{path}/{_READY}{run}")
    _put_in_place(spark, path, f"{_READY}{run}")
    return list(wanted)


# --- retention -----------------------------------------------------------------------

# Days that partitions of the two bronze tables are kept.
KEEP_STREAM_DAYS = 90
KEEP_BATCH_DAYS = 1095


def expired_partitions(
    spark: SparkSession, path: str, column: str, as_of: dt.date, keep_days: int
) -> list[str]:
    limit = (as_of - dt.timedelta(days=keep_days)).isoformat()
    return [v for v in files.partition_values(spark, path, column) if v < limit]


def expire_partitions(
    spark: SparkSession, path: str, column: str, as_of: dt.date, keep_days: int
) -> list[str]:
    """Drop day partitions older than ``keep_days``; returns the dropped values."""
    gone = expired_partitions(spark, path, column, as_of, keep_days)
    for value in gone:
        files.delete(spark, f"{path}/{column}={value}")
    return gone
