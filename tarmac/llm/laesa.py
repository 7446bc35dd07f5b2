"""Vectors as short codes of codebook entries; the nearest entry is found through fixed pivots (LAESA)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tarmac.llm.arrow import column
from tarmac.llm.columns import written
from tarmac.llm.vectors import finite, integers, longs, matrix, numbers, replaced, totals

PARTS = 4
ENTRIES = 256
SCALE = 1024
PIVOTS = 8
# Entries with the least bounds that are evaluated first.
FIRST = 4
# Share of pairs that the bounds leave beyond which they are evaluated as a matrix product.
PRODUCT_SHARE = 1 / 16
ROWS = 2048
# A table of sums by label is sent to all executors up to this many rows, else shuffled.
BROADCAST_ROWS = 100_000


def _narrow(width: int) -> int:
    """Below this, squared distances of parts of this width are exact in float64."""
    return 1 << ((50 - max(width - 1, 1).bit_length()) // 2)


def _cuts(size: int, parts: int) -> list[slice]:
    return [slice(size * p // parts, size * (p + 1) // parts) for p in range(parts)]


def far_apart(entries: np.ndarray, count: int) -> np.ndarray:
    """Numbers of entries that lie far apart: each next one is farthest from those before."""
    chosen = [0]
    apart = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(entries)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots; squares over 10^300 count as that, which no difference of two roots gains by."""
    if squares.dtype == object:
        squares = np.minimum(squares, 10 ** 300)
    return np.sqrt(squares.astype(np.float64))


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all pivots; of Python's integers as near as float64 comes."""
    return _root(((x[:, None, :] - pivots[None]) ** 2).sum(axis=2))


def nearest(x: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row (ties: the lower index) and the exact squared distance.

    The difference of two distances to one pivot is at most the distance between the two, so the
    largest over the pivots is a lower bound. Entries with the least bounds are evaluated first;
    of the others only those whose bound does not exceed the best distance found, one by one where
    few are left, as a matrix product where the bounds prune little.
    """
    bound = np.abs(to_pivots[:, :1] - entry_pivots[:, 0])
    for p in range(1, entry_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p:p + 1] - entry_pivots[:, p]), out=bound)
    exact = np.full(bound.shape, np.inf)
    if x.dtype == object:
        exact = exact.astype(object)
    least = np.argpartition(bound, FIRST, axis=1)[:, :FIRST] if bound.shape[1] > FIRST else np.indices(bound.shape)[1]
    row = np.arange(len(x))[:, None]
    exact[row, least] = ((x[:, None, :] - entries[least]) ** 2).sum(axis=2)
    best = _root(exact.min(axis=1))
    # Roots are rounded: the margin is far above their errors, so no tie is lost.
    margin = 1e-12 * (to_pivots.max(initial=0) + entry_pivots.max(initial=0))
    bound[row, least] = np.inf
    left = bound - margin <= (best * (1 + 1e-12))[:, None]
    if x.dtype != object and left.mean() > PRODUCT_SHARE:
        # Exact as well: every term is an integer that float64 holds. Entries that all rows have pruned stay out.
        some = left.any(axis=0)
        e = entries[some]
        exact[:, some] = (x * x).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (x @ e.T)
    else:
        rows, cols = np.nonzero(left)
        gap = x[rows] - entries[cols]
        exact[rows, cols] = (gap * gap).sum(axis=1)
    which = exact.argmin(axis=1)
    return which, exact[np.arange(len(x)), which]


class _Books:
    """The codebooks of a round, and the pivots that stay."""

    def __init__(self, books: list[list[list[int]]], pivots: list[list[list[int]]], cuts: list[slice]):
        self.cuts = cuts
        self.narrow = min(_narrow(c.stop - c.start) for c in cuts)
        self.books = [numbers(b, self.narrow) for b in books]
        self.pivots = [numbers(p, self.narrow) for p in pivots]
        self.of_entries = [distances(b, p) for b, p in zip(self.books, self.pivots, strict=True)]

    def pivot_distances(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([distances(x[:, c], p) for c, p in zip(self.cuts, self.pivots, strict=True)], axis=1)

    def codes(self, x: np.ndarray, to_pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each part position the entries and squared distances of all rows."""
        begin = 0
        for cut, book, pivots, near in zip(self.cuts, self.books, self.pivots, self.of_entries, strict=True):
            own = to_pivots[:, begin:begin + len(pivots)]
            begin += len(pivots)
            part = x[:, cut]
            if part.dtype != object and book.dtype == object:
                part = part.astype(int).astype(object)
            if part.dtype == object and book.dtype != object:
                book = book.astype(int).astype(object)
            yield nearest(part, book, own, near)

    def pieces(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Rows, integer vectors and pivot distances; wide vectors in pieces of their own."""
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            x, wide = integers(matrix(column(part, "v")), SCALE, self.narrow)
            pivot = matrix(column(part, "pivot")) if "pivot" in part.schema.names else np.zeros((len(x), 0))
            at = np.arange(begin, begin + len(x))
            if wide is None:
                yield at, x, pivot
                continue
            yield at[wide], x[wide], pivot[wide]
            if not wide.all():
                yield at[~wide], x[~wide].astype(np.float64), pivot[~wide]


def encode_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = 4,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """(id, label, code: array<int>, error: long) of every finite vector, and the codebooks by part.

    A component x counts as the integer floor(1024 x). Vectors are cut into equal consecutive parts
    (as equal as whole numbers allow); the codebook of a part position starts as that part of the
    rows with the smallest ids. Each round assigns every part to the nearest entry (ties: the lower
    index) and replaces entries by the floor of their parts' exact means; unused entries stay.

    Distances of parts to fixed pivots (entries of the first codebook that lie far apart) are
    computed once and kept beside the vectors. The number of parts times entries bounds what a
    task sends and what the driver gets each round.

    NULL vectors and vectors with a NULL, NaN or infinite component are left out, and so are vectors
    of another length than the one with the smallest id, and empty ones. Rows without an id are
    encoded, but start codebooks only where others run out; of rows with one id the smaller vector
    comes first; repeated rows count each. With fewer rows than entries the codebook is as small;
    an empty table gives an empty result. Components beyond the exact range of float64 are computed
    in Python's integers; an error beyond 64 bits is NULL. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(finite(vector) & (F.size(vector) > 0)).select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    out = StructType([
        StructField(id, kept.schema["id"].dataType), StructField(label, kept.schema["label"].dataType),
        *StructType.fromDDL("code array<int>, error long").fields])
    order = [F.col("id").asc_nulls_last(), "v", F.col("label").asc_nulls_last()]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], out), []
    kept = kept.filter(F.size("v") == len(first[0].v))
    start = [r.v for r in kept.orderBy(*order).limit(entries).collect()]
    begin, _ = integers(np.array(start, np.float64), SCALE, 0)
    cuts = _cuts(begin.shape[1], parts)
    books = [[[int(v) for v in row] for row in begin[:, c]] for c in cuts]
    pivots = [[book[i] for i in far_apart(np.array(book, np.float64), PIVOTS)] for book in books]

    fixed = _Books(books, pivots, cuts)
    schema = StructType([*kept.schema.fields, StructField("pivot", ArrayType(DoubleType()))])
    arrow = to_arrow_schema(schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = np.zeros((batch.num_rows, sum(len(p) for p in fixed.pivots)))
            for at, x, _ in fixed.pieces(batch):
                far[at] = fixed.pivot_distances(x)
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * far.shape[1])
            pivot = pa.ListArray.from_arrays(ends, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c).cast(arrow.field(c).type) for c in ("id", "label", "v")), pivot.cast(arrow.field("pivot").type)],
                schema=arrow)

    near = written(kept.mapInArrow(measure, schema), "pivots")

    def place(now: _Books):
        def of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for _, x, pivot in now.pieces(batch):
                for p, (which, _) in enumerate(now.codes(x, pivot)):
                    own = x[:, now.cuts[p]]
                    if own.shape[1] < width:
                        own = np.concatenate([own, np.zeros((len(own), width - own.shape[1]), own.dtype)], axis=1)
                    yield p * entries + which, own
        return of

    width = max(c.stop - c.start for c in cuts)
    for _ in range(rounds):
        found = totals(near.select("v", "pivot"), parts * entries, width, place(_Books(books, pivots, cuts)))
        found = {k: (n, sums[:cuts[k // entries].stop - cuts[k // entries].start]) for k, (n, sums) in found.items()}
        books = [replaced(book, found, p * entries) for p, book in enumerate(books)]
    last, arrow_out = _Books(books, pivots, cuts), to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x, pivot in last.pieces(batch):
                found = list(last.codes(x, pivot))
                code = np.stack([w for w, _ in found], axis=1).astype(np.int32)
                error = sum(d.astype(np.int64) if d.dtype != object and x.dtype != object else d.astype(object) for _, d in found)
                rows = pa.array(at)
                ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * parts)
                made = [column(batch, "id").take(rows), column(batch, "label").take(rows),
                        pa.ListArray.from_arrays(ends, pa.array(code.ravel())), longs(error)]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip(made, arrow_out, strict=True)], schema=arrow_out)

    return written(near.mapInArrow(run, out), "codes"), books


def code_digests(coded: DataFrame, books: list[list[list[int]]], label: str = "label") -> DataFrame:
    """``coded`` with its code in hexadecimal, the errors summed over equal labels, and the codebooks' sha256.

    NULL labels count as equal. A sum is NULL where an error is, or where it has no room in 64 bits.
    A label with most of the rows is one row after the map side of the sum; the sums go to all
    executors while they are at most ``BROADCAST_ROWS``, else both sides are shuffled by label.
    """
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count_if(F.col("error").isNull()) == 0) & (total <= F.lit(9223372036854775807))
    sums = written(coded.groupBy(F.col(label).alias("_label")).agg(
        F.when(fits, total).cast("long").alias("label_error")), "label-errors")
    few = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    digits = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return coded.join(few, F.col(label).eqNullSafe(F.col("_label"))).drop("_label").withColumns(
        {"code": digits, "codebooks_sha256": F.lit(digest)})
