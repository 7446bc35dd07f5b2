"""Clusters around centroids, the nearest found coarse to fine in Walsh-Hadamard coefficients."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tarmac.llm.arrow import column
from tarmac.llm.columns import written
from tarmac.llm.vectors import LONG_MAX, finite, integers, longs, matrix, numbers, replaced, totals

SIZE = 64
SCALE = 256
# Coefficients looked at together, coarse to fine; after each lot the centroids that are too far go.
LOTS = (4, 4, 8, 16, 32)
# Below this all sums of squared coefficients are exact in float64: 64 * (2 * 64 * 2^16)^2 / 64 < 2^53.
NARROW = 1 << 16
ROWS = 4096


def _transform() -> np.ndarray:
    """The rows of the Hadamard matrix by their number of sign changes."""
    h = np.ones((1, 1))
    while len(h) < SIZE:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h) != 0).sum(axis=1), kind="stable")]


H = _transform()


def coefficients(x: np.ndarray) -> np.ndarray:
    """Exact coefficients; their squared differences sum to 64 times those of the vectors."""
    return x @ (H.T.astype(int).astype(object) if x.dtype == object else H.T)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of c for each row of x (ties: the first) and the squared distance.

    x and c are coefficients. Sums of squared differences over the first coefficients are lower
    bounds. The centroid with the least one is finished at once; whichever bound exceeds that
    distance is strictly worse and goes. Those left at the end have all 64 coefficients summed.
    """
    lot = slice(0, LOTS[0])
    a, b = x[:, lot], c[:, lot]
    bound = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    limit = None
    row, cent = np.indices(bound.shape).reshape(2, -1)
    bound, begin = bound.ravel(), LOTS[0]
    for size in (*LOTS[1:], 0):
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        least = np.minimum.reduceat(bound, start)
        first = np.flatnonzero(bound == np.repeat(least, np.diff(np.r_[start, len(row)])))
        guess = first[np.r_[True, row[first][1:] != row[first][:-1]]]
        if not size:
            return cent[guess], bound[guess] // SIZE
        gap = x - c[cent[guess]]
        whole = (gap * gap).sum(axis=1)
        limit = whole if limit is None else np.minimum(limit, whole)
        stay = np.asarray(bound <= limit[row], bool)
        row, cent, bound = row[stay], cent[stay], bound[stay]
        gap = x[row, begin:begin + size] - c[cent, begin:begin + size]
        bound = bound + (gap * gap).sum(axis=1)
        begin += size
    raise AssertionError


def _assigned(column_: pa.Array, centroids: list[list[int]]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each piece of a column: its rows, integer vectors, nearest centroids and squared distances."""
    c = coefficients(numbers(centroids, NARROW))
    for begin in range(0, len(column_), ROWS):
        part = column_.slice(begin, ROWS)
        x, wide = integers(matrix(part), SCALE, NARROW)
        if wide is None and c.dtype != object:
            which, far = nearest(coefficients(x), c)
        elif c.dtype == object:
            which, far = nearest(coefficients(x.astype(int).astype(object) if wide is None else x), c)
        else:  # only the wide rows take Python's integers
            which, far = np.zeros(len(x), np.int64), np.zeros(len(x), object)
            which[wide], far[wide] = nearest(coefficients(x[wide]), c.astype(int).astype(object))
            if not wide.all():
                own = x[~wide].astype(np.float64)
                which[~wide], few = nearest(coefficients(own), c)
                far[~wide] = few.astype(np.int64).astype(object)
        yield slice(begin, begin + len(part)), x, which, far


def cluster_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", centroids: int = 40, rounds: int = 5, seed: int = 2,
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster int, distance long) of every vector of 64 finite components, and the centroids.

    A component x counts as the integer floor(256 x). The first centroids are the vectors with the
    smallest sha256 of ``<seed>:<id>``; each round assigns all vectors to the nearest (ties: the
    smaller number) and takes the floor of the exact means; a centroid without vectors stays.

    Vectors that are NULL, of another length, or hold a NULL, NaN or infinity are left out. Rows
    without an id are assigned, but start as centroids only where others run out. Repeated rows
    count each; of rows with one id the smaller vector starts first. With fewer vectors than
    centroids all are centroids; an empty table gives an empty result. Components beyond 2^16 are
    computed in Python's integers; a squared distance beyond 64 bits is NULL. Other columns are
    not looked at.
    """
    spark = vectors.sparkSession
    kept = written(
        vectors.filter((F.size(vector) == SIZE) & finite(vector)).select(F.col(id).alias("id"), F.col(vector).alias("v")), "vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = kept.orderBy(hashed.asc_nulls_last(), "v").limit(centroids).collect()
    centers = integers(np.array([r.v for r in start], np.float64).reshape(-1, SIZE), SCALE, 0)[0] if start else []
    centers = [[int(v) for v in row] for row in centers]

    def place(now: list[list[int]]):
        def of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for _, x, which, _ in _assigned(column(batch, "v"), now):
                yield which, x
        return of

    for _ in range(rounds if centers else 0):
        centers = replaced(centers, totals(kept.select("v"), len(centers), SIZE, place(centers)))
    last, kind = centers, to_arrow_type(kept.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, which, far in _assigned(column(batch, "v"), last) if batch.num_rows else ():
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "id")[rows].cast(kind), pa.array(which.astype(np.int32)), longs(far)],
                    names=[id, "cluster", "distance"])

    name = f"`{id}` {kept.schema['id'].dataType.simpleString()}"
    found = kept.mapInArrow(run, f"{name}, cluster int, distance long")
    return written(found if centers else spark.createDataFrame([], found.schema), "clusters"), centers


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the distances summed over its cluster and over all, and the centroid's sha256.

    A sum is NULL where a distance is, or where it has no room in 64 bits. The table joined has one
    row for each centroid.
    """
    found = {r.cluster: r for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count_if(F.col("distance").isNull()).alias("unknown")).collect()}
    room = lambda v, known: int(v) if known and v <= LONG_MAX else None
    known = all(not r.unknown for r in found.values())
    total = room(sum(r.inertia or 0 for r in found.values()), known)
    rows = [(k, room(r.inertia, not r.unknown), total,
             hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for k, r in sorted(found.items())]
    sums = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster")
