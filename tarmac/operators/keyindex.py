"""Which folders of a partitioned table may hold a key: a Bloom filter inside each folder.

The filter lies in a hidden folder of the partition it describes, so whatever moves or drops the
partition moves or drops its filter with it. It is made of blocks of 32,768 bits, as many (a power
of two) as the rows of the partition need; a key sets HASHES bits of one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import files
from tarmac.session import scratch_path

FOLDER = "_keys"
# Bits for each key, and bits that a key sets: of a million keys that a folder lacks it may seem to hold two.
BITS_PER_KEY, HASHES = 32, 10
_BLOCK, _WORD = 1 << 15, 64
SCHEMA = "folder string, blocks long, block long, words array<long>"


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _bits(h: Column) -> list[Column]:
    """Positions in its block that a key's hash sets."""
    mixed = F.xxhash64(h, F.lit("bits"))
    start, step = F.pmod(mixed, F.lit(_BLOCK)), F.pmod(F.shiftright(mixed, 32), F.lit(_BLOCK // 2)) * 2 + 1
    return [(start + i * step) % _BLOCK for i in range(HASHES)]


def filters_of(rows: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """(partition, folder, blocks, block, words) of the keys in each partition; two aggregations, no group of a partition."""
    sizes = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("n")).select(
        partition, F.expr(f"bigint(pow(2, ceil(log2(greatest(n * {BITS_PER_KEY} / {_BLOCK}, 1)))))").alias("blocks"))
    # One row for each partition.
    sizes = F.broadcast(sizes.withColumnRenamed(partition, "_sized"))
    sized = rows.select(partition, _hash(keys).alias("h")).join(sizes, F.col(partition).eqNullSafe(F.col("_sized")))
    bit = F.explode(F.array(*_bits(F.col("h")))).alias("bit")
    set_ = sized.select(partition, "blocks", F.pmod("h", "blocks").alias("block"), bit)
    words = set_.groupBy(partition, "blocks", "block", F.expr(f"bit div {_WORD}").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(bit % {_WORD}))")).alias("value"))
    filled = words.groupBy(partition, "blocks", "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "value"))).alias("set"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(_BLOCK // _WORD - 1).cast("long")),
                        lambda w: F.coalesce(F.try_element_at("set", w), F.lit(0).cast("long")))
    return filled.select(partition, F.col(partition).cast("string").alias("folder"), "blocks", "block", every.alias("words"))


def write_filters(spark: SparkSession, root: str, values: Iterable[str], keys: Sequence[str], partition: str) -> None:
    """Filters for the folders of ``root`` (partition values) from the keys that lie there."""
    values = list(values)
    if not values:
        return
    rows = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(
        *[f"{root}/{partition}={v}" for v in values]).select(partition, *keys)
    made = scratch_path(spark, "key-filters")
    filters_of(rows, keys, partition).hint("rebalance", partition).write.partitionBy(partition).parquet(made)
    for value in files.partition_values(spark, made, partition):
        files.delete(spark, f"{root}/{partition}={value}/{FOLDER}")
        files.rename(spark, f"{made}/{partition}={value}", f"{root}/{partition}={value}/{FOLDER}")
    files.delete(spark, made)


def folders_that_may_hold(
    spark: SparkSession, path: str, values: Iterable[str], wanted: DataFrame, keys: Sequence[str], partition: str,
) -> list[str]:
    """Of the partitions ``values`` those whose filter does not rule out every key of ``wanted``.

    A folder without a filter may hold anything. Data files are neither listed nor read. Keys meet
    the blocks that they belong to, one block a folder; what leaves the join is folder names.
    """
    known = {v: files.exists(spark, f"{path}/{partition}={v}/{FOLDER}") for v in values}
    maybe = [v for v, indexed in known.items() if not indexed]
    indexed = [v for v, has in known.items() if has]
    if not indexed:
        return sorted(maybe)
    filters = spark.read.schema(SCHEMA).parquet(*[f"{path}/{partition}={v}/{FOLDER}" for v in indexed])
    sizes = [r.blocks for r in filters.select("blocks").distinct().collect()]
    h = F.col("h")
    asked = wanted.select(_hash(keys).alias("h")).distinct().select(
        "h", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("blocks")).withColumn("block", F.pmod("h", "blocks"))
    hit = F.lit(True)
    for bit in _bits(h):
        hit &= F.getbit(F.get("words", F.floor(bit / _WORD).cast("int")), (bit % _WORD).cast("int")) == 1
    found = asked.join(filters, ["blocks", "block"]).filter(hit).select("folder").distinct()
    hits = {r.folder for r in found.collect()}
    return sorted([*maybe, *(v for v in indexed if unquote(v) in hits)])
