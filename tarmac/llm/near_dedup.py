"""Near-duplicates by SetSketch registers.

A document's set of word shingles is sketched by registers: exponentially distributed values of
its elements, the smallest of each kept on a logarithmic scale and truncated. Registers of a
union are the larger ones of both (mergeable), and sets that are alike agree in many, so bands
of registers find candidates. Within a bucket the counts of larger, smaller and equal registers
give the similarity of most likelihood, and what may be similar enough is gathered into
clusters. In a cluster links are verified on the full sets, whatever the sketches said.

Equal sets are one node throughout. Buckets and clusters beyond a bound are cut into blocks, and
every pair of blocks is a group of its own, so neither loses a pair nor ends in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.arrow import column
from tarmac.llm.columns import written
from tarmac.llm.groups import boundaries, components, runs, spanning
from tarmac.llm.words import chunks, mix, word_hashes

# A link of similarity 0.8 shares a band with probability 1 - (1 - 0.8^6)^42 = 1 - 3e-6.
BANDS, BAND_REGISTERS = 42, 6
REGISTERS = BANDS * BAND_REGISTERS
_BASE, _RATE, _TOP = 1.001, 20.0, 65_534
# Likelihood estimates so many standard errors below the similarity are still candidates.
SLACK = 5.0
# Members of a bucket and nodes of a cluster in a block; rows sent to all executors at most.
BUCKET_BLOCK, CLUSTER_BLOCK, BROADCAST_ROWS = 20_000, 2_000, 300_000

_random = np.random.default_rng(20_240_611)
_FACTOR = _random.integers(0, 1 << 32, REGISTERS, np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _random.integers(0, 1 << 32, REGISTERS, np.uint64).astype(np.uint32)

SKETCH = "doc_id bigint, text_key string, node bigint, n_shingles bigint, registers binary, bands array<bigint>"


def shingle_sets(values: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; none for a row without words."""
    for begin, stop in chunks(values):
        words, at = word_hashes(values.slice(begin, stop - begin))
        joined = words.copy()
        for k in range(1, size):
            joined[:-k] = mix(joined[:-k] * np.uint64(31) + words[k:]) if len(words) > k else joined[:-k]
        for row in range(stop - begin):
            a, b = at[row], at[row + 1]
            if b - a >= size:
                yield np.unique(joined[a:b - size + 1])
            elif b > a:  # the whole sequence is the one shingle
                short = np.array([b - a], np.uint64)
                for k in range(a, b):
                    short = mix(short * np.uint64(37) + words[k:k + 1])
                yield short
            else:
                yield np.zeros(0, np.uint64)


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that is not empty."""
    low = shingles.astype(np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    half = REGISTERS // 2
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(shingles), 512):
        part = slice(begin, begin + 512)
        values = np.empty((len(low[part]), REGISTERS), np.uint32)
        np.multiply(low[part, None], _FACTOR[:half], out=values[:, :half])
        np.multiply(high[part, None], _FACTOR[half:], out=values[:, half:])
        values += _SHIFT
        np.minimum(least, values.min(0), out=least)
    smallest = -np.log1p(-(least.astype(float) + 0.5) / 2 ** 32) / _RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(_BASE)), 0, _TOP + 1).astype(np.uint16)


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(one, other)


def band_keys(values: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for column_ in values.reshape(BANDS, BAND_REGISTERS).T:
        key = mix(key * np.uint64(65_599) + column_.astype(np.uint64) + np.uint64(1))
    return key.astype(np.int64)


def likely_similarity(
    mine: np.ndarray, my_size: float, others: np.ndarray, sizes: np.ndarray,
) -> np.ndarray:
    """Similarity of most likelihood, from how many registers are larger, smaller and equal.

    For a base near 1 they are so with probabilities u - vJ, v - uJ and J, where u and v are the
    shares of the set sizes; the likelihood is largest where a quadratic in J is 0.
    """
    equal = np.count_nonzero(others == mine, axis=1).astype(float)
    larger = np.count_nonzero(mine > others, axis=1).astype(float)
    smaller = REGISTERS - equal - larger
    u = my_size / (my_size + sizes)
    v = 1 - u
    linear = equal * (u * u + v * v) + v * v * larger + u * u * smaller
    square = REGISTERS * u * v
    root = np.sqrt(np.maximum(linear * linear - 4 * square * equal * u * v, 0))
    return (linear - root) / (2 * square)


def _sketch(size: int):
    names = [f.strip().split(" ")[0] for f in SKETCH.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts, values, keys = [], [], [], []
            for found in shingle_sets(column(batch, "text"), size):
                counts.append(len(found))
                if not len(found):
                    nodes.append(None), values.append(None), keys.append(None)
                    continue
                sketch = registers(found)
                digest = hashlib.blake2b(found.tobytes(), digest_size=8).digest()
                nodes.append(int.from_bytes(digest, "little", signed=True))
                values.append(sketch.tobytes())
                keys.append(band_keys(sketch))
            made = [column(batch, "doc_id"), column(batch, "text_key"), nodes, counts, values, keys]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(made, types, strict=True)], names=names)
    return run


def _text_key() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """One row per document: its set's hash (node), size, registers and band keys; NULL if the set is empty."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), "text")
    return keyed.mapInArrow(_sketch(shingle), SKETCH)


def _blocked(members: DataFrame, group: str, count: str, block: int) -> DataFrame:
    """Members of groups, once for every pair of blocks their block is in: (group, one, two)."""
    blocks = F.ceil(F.col(count) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    each = F.explode(F.when(blocks > 1, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(F.lit(0))))
    return (
        members.withColumn("own", F.when(blocks > 1, own).otherwise(F.lit(0))).withColumn("other", each)
        .withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
        .drop("own", "other", count))


def _likely_edges(least: float):
    margin = least - SLACK * np.sqrt(least * (1 - least) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["bucket", "one", "two"]):
            nodes = table["node"].to_numpy()
            sizes = table["n_shingles"].to_numpy().astype(float)
            values = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            a, b = [], []
            at = boundaries(table, ["bucket", "one", "two"])
            for begin, stop in zip(at[:-1], at[1:], strict=True):
                own, own_sizes, own_nodes = values[begin:stop], sizes[begin:stop], nodes[begin:stop]

                def linked(i, others, own=own, own_sizes=own_sizes):
                    s = own_sizes[others]
                    fits = np.minimum(s, own_sizes[i]) >= least * np.maximum(s, own_sizes[i])
                    hit = np.zeros(len(others), bool)
                    if fits.any():
                        hit[fits] = likely_similarity(own[i], own_sizes[i], own[others[fits]], s[fits]) >= margin
                    return hit

                for i, j in spanning(stop - begin, linked):
                    a.append(own_nodes[i]), b.append(own_nodes[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def candidate_edges(nodes: DataFrame, least: float, block: int = BUCKET_BLOCK) -> DataFrame:
    """Edges (a, b) that span what may be similar: nodes with a band in common and a likely similarity.

    Buckets with the same members, as bands of small groups mostly are, are looked at once.
    """
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sums = banded.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("node")).alias("mark"),
        F.min("node").alias("first"), F.max("node").alias("last")).filter("members > 1")
    once = sums.groupBy("members", "mark", "first", "last").agg(F.min("bucket").alias("bucket"))
    members = banded.join(once.select("bucket", "members"), "bucket")
    full = members.join(nodes.select("node", "n_shingles", "registers"), "node")
    grouped = _blocked(full, "bucket", "members", block)
    return (
        grouped.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
        .mapInArrow(_likely_edges(least), "a bigint, b bigint"))


def _cluster_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(column(batch, "text"), size)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "cluster"), column(batch, "nodes"), column(batch, "node"), pa.array(found, pa.binary())],
                names=["cluster", "nodes", "node", "shingles"])
    return run


def _exact_edges(percent: int):
    keys = ["cluster", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            nodes, sets = table["node"].to_numpy(), table["shingles"]
            a, b = [], []
            at = boundaries(table, keys)
            for begin, stop in zip(at[:-1], at[1:], strict=True):
                own = [np.frombuffer(s.as_py(), np.uint64) for s in sets.slice(begin, stop - begin)]
                sizes = np.array([len(s) for s in own])
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                words, place = np.unique(np.concatenate(own), return_inverse=True)
                seen = np.zeros(len(words), np.int32)

                def linked(i, others, place=place, starts=starts, sizes=sizes, seen=seen):
                    mine = place[starts[i]:starts[i] + sizes[i]]
                    seen[mine] = 1
                    if len(others) * 4 > len(sizes):
                        common = np.add.reduceat(seen[place], starts)[others]
                    else:
                        common = np.array([seen[place[starts[o]:starts[o] + sizes[o]]].sum() for o in others])
                    seen[mine] = 0
                    return 100 * common >= percent * (sizes[i] + sizes[others] - common)

                own_nodes = nodes[begin:stop]
                for i, j in spanning(stop - begin, linked):
                    a.append(own_nodes[i]), b.append(own_nodes[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def exact_edges(docs: DataFrame, classes: DataFrame, clusters: DataFrame, shingle: int, percent: int,
                block: int = CLUSTER_BLOCK) -> DataFrame:
    """Edges that span all links inside clusters, each confirmed on the full sets of both nodes."""
    sizes = clusters.groupBy(F.col("root").alias("cluster")).agg(F.count(F.lit(1)).alias("nodes"))
    chosen = written(
        clusters.withColumnRenamed("root", "cluster").join(sizes, "cluster").join(classes, "node")
        .select("cluster", "nodes", "node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")),
        "clustered")
    few = chosen.count() <= BROADCAST_ROWS
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_key().alias("text_key"), "text")
    texts = keyed.join(
        F.broadcast(chosen) if few else chosen,
        (F.col("text_key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id")))
    sets = texts.select("cluster", "nodes", "node", "text").mapInArrow(
        _cluster_sets(shingle), "cluster bigint, nodes bigint, node bigint, shingles binary")
    grouped = _blocked(sets, "cluster", "nodes", block)
    return (
        grouped.repartition("cluster", "one", "two").sortWithinPartitions("cluster", "one", "two")
        .mapInArrow(_exact_edges(percent), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, component_id, and the component's first row (rep).

    Rows are linked if ``100 * intersection >= percent * union`` of their sets; a text of fewer
    words is one shingle. component_id is the smallest doc_id that can be reached, its own
    included. NULL, empty and blank texts have an empty set and are linked with nothing. Rows
    with equal sets are linked; NULL ids do not count as smallest unless there is no other.
    """
    rows = written(sketches(docs, shingle), "sketches")
    known = rows.filter(F.col("node").isNotNull())
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    classes = written(known.groupBy("node").agg(rep.alias("rep")), "classes")
    nodes = written(known.groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"),
        F.first("bands").alias("bands")), "nodes")
    clusters = components(candidate_edges(nodes, percent / 100))
    links = components(exact_edges(docs, classes, clusters, shingle, percent))
    linked = classes.join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = linked.groupBy("root").agg(F.min("rep").alias("first"))
    found = linked.join(firsts, "root").select("node", "first")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    out = rows.select("doc_id", "text_key", "n_shingles", "node").join(found, "node", "left")
    first = F.when(F.col("node").isNull(), own).otherwise(F.col("first"))
    return out.select(
        "doc_id", "text_key", "n_shingles", first["doc_id"].alias("component_id"), first.alias("rep"))


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, all columns as they came: the one with the smallest id.

    Rows that are equal in id and text are one; texts without words all stay.
    """
    found = near_duplicates(docs, shingle, percent)
    gone = written(
        found.filter(~(F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.text_key") == F.col("text_key"))))
        .select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")).distinct(), "gone")
    few = gone.count() <= BROADCAST_ROWS
    kept = docs.join(
        F.broadcast(gone) if few else gone,
        (_text_key() == F.col("_gone_key")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("_gone_id")), "left_anti")
    twice = (
        kept.filter(F.length(F.trim("text")) > 0)
        .select(F.col("doc_id").alias("_id"), _text_key().alias("_key")).groupBy("_id", "_key")
        .count().filter("count > 1").select("_id", "_key"))
    if twice.isEmpty():
        return kept
    order = Window.partitionBy("_row_id", "_row_key").orderBy(F.monotonically_increasing_id())
    numbered = kept.withColumn("_row_id", F.col("doc_id")).withColumn("_row_key", _text_key())
    return (
        numbered.withColumn("_n", F.row_number().over(order))
        .filter((F.col("_n") == 1) | F.coalesce(F.length(F.trim("text")) == 0, F.lit(True))).select(*docs.columns))
