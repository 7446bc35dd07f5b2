"""Documents sorted into shards of near equal bytes (histogram sort)."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.arrow import column
from tarmac.llm.columns import written

# Shares of a shard's even size within which the border of a group of equal texts is taken.
TOLERANCE = 0.01
# Candidate boundaries that are counted for each open splitter in a round.
PROBES = 64
# Rows and bytes that are sorted together after the exchange.
BLOCK_ROWS = 250_000
BLOCK_BYTES = 64 << 20
_LEVELS = ("a", "b", "c")
LEAST = -(1 << 63)


def size_of(text: str | Column) -> Column:
    """UTF-8 bytes of a text (NULL: none) and one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_key(text: str | Column) -> Column:
    """The first 60 bits of the text's md5: evenly spread, and equal texts stand together."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


@dataclass
class _Bracket:
    """Rows that begin with ``prefix`` and continue from ``low`` to ``high``; the wanted boundary is among them.

    ``bytes`` and ``rows`` lie below the bracket, ``inside`` (bytes, rows) in it.
    """

    prefix: tuple[int, ...]
    low: int
    high: int
    bytes: int
    rows: int
    inside: tuple[int, int]


@dataclass
class Splitter:
    """Rows from ``key`` on lie above it, ``bytes`` and ``rows`` below."""

    key: tuple[int, ...]
    bytes: int
    rows: int


@dataclass
class Target:
    """An amount of bytes or rows that shall lie below a splitter.

    A strict one ends at the border nearest to it, between texts if that is within the tolerance;
    a loose one at the first border found within the tolerance.
    """

    measure: str
    amount: int
    tolerance: float
    strict: bool = False


def _splitter(b: _Bracket, target: Target) -> tuple[Splitter, float]:
    """The side of a bracket that is nearer to the target (ties: the lower), and how far it is."""
    k = target.measure == "rows"
    below = (b.bytes, b.rows)[k]
    short, over = abs(target.amount - below), abs(below + b.inside[k] - target.amount)
    if over >= short:
        key, taken = (*b.prefix, b.low), (0, 0)
    elif b.high < -LEAST - 1:
        key, taken = (*b.prefix, b.high + 1), b.inside
    else:  # nothing can follow the greatest number: the next key of the level above
        key, taken = (*b.prefix[:-1], b.prefix[-1] + 1), b.inside
    key += (LEAST,) * (len(_LEVELS) - len(key))
    return Splitter(key, b.bytes + taken[0], b.rows + taken[1]), min(short, over)


def _probes(b: _Bracket) -> list[int]:
    """First values of the pieces that a bracket is counted in."""
    count = min(PROBES, b.high - b.low + 1)
    return [b.low + (b.high - b.low + 1) * i // count for i in range(count)]


def _histogram(keys: DataFrame, brackets: list[_Bracket]) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(bracket, piece) to exact bytes, rows, least and greatest value of the level.

    A task looks up where its rows stand among the candidate boundaries of all brackets and sends
    a row for each piece that it has rows of, whatever it has read.
    """
    plan: list[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]] = []
    for prefix in sorted({b.prefix for b in brackets}):
        own = sorted((b.low, k) for k, b in enumerate(brackets) if b.prefix == prefix)
        starts, ids, ends = [], [], []
        for _, k in own:
            probes = _probes(brackets[k])
            starts += probes
            ids += [(k, i) for i in range(len(probes))]
            ends += [brackets[k].high] * len(probes)
        plan.append((prefix, np.array(starts, np.int64), np.array(ids, np.int64).reshape(-1, 2), np.array(ends, np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(starts), 2), np.int64) for _, starts, _, _ in plan]
        least = [np.full(len(starts), np.iinfo(np.int64).max) for _, starts, _, _ in plan]
        most = [np.full(len(starts), np.iinfo(np.int64).min) for _, starts, _, _ in plan]
        for batch in batches:
            levels = [column(batch, c).to_numpy() for c in _LEVELS]
            size = column(batch, "size").to_numpy()
            for k, (prefix, starts, _, ends) in enumerate(plan):
                rows = np.ones(batch.num_rows, bool)
                for level, v in zip(levels, prefix, strict=False):
                    rows &= level == v
                value, bytes_ = levels[len(prefix)][rows], size[rows]
                at = np.searchsorted(starts, value, "right") - 1
                inside = at >= 0
                inside[inside] = value[inside] <= ends[at[inside]]
                at, value, bytes_ = at[inside], value[inside], bytes_[inside]
                np.add.at(sums[k][:, 0], at, bytes_)
                sums[k][:, 1] += np.bincount(at, minlength=len(starts))
                np.minimum.at(least[k], at, value)
                np.maximum.at(most[k], at, value)
        for k, (_, _, ids, _) in enumerate(plan):
            some = np.flatnonzero(sums[k][:, 1])
            columns = (ids[some, 0], ids[some, 1], sums[k][some, 0], sums[k][some, 1], least[k][some], most[k][some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns], names=["bracket", "piece", "bytes", "rows", "least", "most"])

    parts = keys.mapInArrow(run, "bracket long, piece long, bytes long, rows long, least long, most long")
    found = parts.groupBy("bracket", "piece").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"))
    return {(r.bracket, r.piece): (r.bytes, r["rows"], r.least, r.most) for r in found.collect()}


def splitters(keys: DataFrame, targets: list[Target], total: tuple[int, int]) -> list[Splitter]:
    """The splitter of each target.

    All targets are narrowed together. Each round counts exact bytes and rows below evenly placed
    candidates within the brackets that are still open, and keeps the piece that holds the target,
    from the least to the greatest key found in it. A bracket of one key ends its level: its rows
    are split at the next one (text, document, row) unless a side of it is near enough. So what
    strict targets get depends on the rows alone, not on the candidates.
    """
    least, most = keys.agg(F.min("a"), F.max("a")).first()
    open_ = {i: _Bracket((), least, most, 0, 0, total) for i in range(len(targets))}
    done: dict[int, Splitter] = {}

    def settle(i: int) -> None:
        """Closes the bracket if one of its sides will do, and goes to the next level from one key."""
        while i in open_:
            b = open_[i]
            side, off = _splitter(b, targets[i])
            level, single = len(b.prefix), b.low == b.high
            near = off <= targets[i].tolerance and (not targets[i].strict or single and level == 0)
            if near or single and (b.inside[1] == 1 or level == len(_LEVELS) - 1):
                done[i] = side
                del open_[i]
            elif single:
                open_[i] = _Bracket((*b.prefix, b.low), LEAST, -LEAST - 1, b.bytes, b.rows, b.inside)
            else:
                return

    for i in list(open_):
        settle(i)
    while open_:
        # Targets that share a bracket are counted once.
        shared: dict[tuple, int] = {}
        brackets: list[_Bracket] = []
        for b in open_.values():
            if (b.prefix, b.low, b.high) not in shared:
                shared[(b.prefix, b.low, b.high)] = len(brackets)
                brackets.append(b)
        pieces: dict[int, list[_Bracket]] = {}
        for (k, _), (own_bytes, own_rows, first, last) in sorted(_histogram(keys, brackets).items()):
            b, before = brackets[k], pieces.setdefault(k, [])
            base = before[-1] if before else _Bracket(b.prefix, 0, 0, b.bytes, b.rows, (0, 0))
            before.append(_Bracket(
                b.prefix, first, last, base.bytes + base.inside[0], base.rows + base.inside[1], (own_bytes, own_rows)))
        for i, b in list(open_.items()):
            own = pieces[shared[(b.prefix, b.low, b.high)]]
            k = targets[i].measure == "rows"
            open_[i] = next((p for p in own if targets[i].amount <= (p.bytes, p.rows)[k] + p.inside[k]), own[-1])
            settle(i)
    return [done[i] for i in range(len(targets))]


def _places(levels: list[np.ndarray], keys: list[tuple[int, ...]]) -> np.ndarray:
    """How many of the sorted ``keys`` are not above each row."""
    first = np.array([k[0] for k in keys], np.int64)
    at = np.searchsorted(first, levels[0], "right")
    if len(levels) == 1:
        return at
    for value in {k[0] for k in keys if any(v != LEAST for v in k[1:])}:
        rows = np.flatnonzero(levels[0] == value)
        if len(rows):
            own = [k[1:] for k in keys if k[0] == value]
            at[rows] = np.searchsorted(first, value, "left") + _places([v[rows] for v in levels[1:]], own)
    return at


def shard_documents(
    docs: DataFrame, shards: int = 8, text: str = "text", id: str = "doc_id", tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` with shard (int) and slot (long, gapless from 0 in each shard), shards of near equal bytes.

    The documents are sorted by the md5 of their text, then by id. A splitter is the border between
    two texts that is nearest to its even share of the bytes; if that misses the share by more than
    ``tolerance`` of a shard, the border between two documents. So copies of a text stand together
    unless their group is large itself, and no shard misses the even size by more than twice
    ``tolerance`` or a document. Boundaries are found by counting exact bytes below candidates;
    then all documents are exchanged once, in blocks of about ``BLOCK_ROWS`` rows that no group of
    copies, however large, makes larger; slots come from the exact counts below the blocks.

    A NULL text has no bytes, as an empty one; each document has one byte for its end. Rows without
    an id come first among copies. Repeated rows are sorted as they were written and may be parted.
    An empty table gives an empty result. Very long documents are never split; a shard may stay
    empty beside one that is larger than a shard. ``id`` is an integer. Columns named shard or slot
    are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    staged = written(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), text_key(text).alias("a"),
        F.coalesce(F.col(id).cast("long"), F.lit(LEAST)).alias("b"), F.monotonically_increasing_id().alias("c"),
        size_of(text).alias("size")), "keyed")
    keys = staged.select(*_LEVELS, "size")
    bytes_, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(tasks, -(-bytes_ // BLOCK_BYTES))
    found: list[Splitter] = []
    if rows:
        wanted = [Target("bytes", bytes_ * k // shards, tolerance * bytes_ / shards, strict=True) for k in range(1, shards)]
        # Blocks bound both the bytes and the rows of a task; a tenth more or less will do.
        wanted += [Target(measure, whole * k // count, whole / count / 10)
                   for measure, whole, count in (("bytes", bytes_, blocks), ("rows", rows, max(tasks, -(-rows // BLOCK_ROWS))))
                   for k in range(1, count)]
        found = splitters(keys, wanted, (bytes_, rows))
    ends = sorted(s.key for s in found[:shards - 1])
    borders = sorted(found, key=lambda s: s.key)
    shard = np.array([0, *(bisect_right(ends, s.key) for s in borders)], np.int32)
    below = np.array([0, *(s.rows for s in borders)], np.int64)
    # Rows of its shard that lie below a block.
    base = below - below[np.searchsorted(shard, shard)]
    cuts = [s.key for s in borders]

    @F.pandas_udf("block int, shard int, base long")
    def place(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.DataFrame:
        block = _places([a.to_numpy(), b.to_numpy(), c.to_numpy()], cuts)
        return pd.DataFrame({"block": block.astype(np.int32), "shard": shard[block], "base": base[block]})

    dealt = staged.select("doc", *_LEVELS, place(*_LEVELS).alias("at")).repartition(blocks, "at.block")
    place_in_block = F.row_number().over(Window.partitionBy("at.block").orderBy(*_LEVELS))
    return dealt.withColumn("slot", (F.col("at.base") + place_in_block - 1).cast("long")).select("doc.*", "at.shard", "slot")
