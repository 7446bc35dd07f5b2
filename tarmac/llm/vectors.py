"""Vectors as exact integers, and exact sums of them over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_MAX = (1 << 63) - 1
# Sums leave a task in digits of 32 bits, so that no total over any number of tasks overflows.
_DIGIT = 32
_MASK = (1 << _DIGIT) - 1


def finite(vector: str | Column) -> Column:
    """True for a vector without a NULL, NaN or infinite component; false for a NULL vector."""
    column = F.col(vector) if isinstance(vector, str) else vector
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return column.isNotNull() & ~F.coalesce(odd, F.lit(True))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length as float64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def integers(values: np.ndarray, scale: int, narrow: int) -> tuple[np.ndarray, np.ndarray | None]:
    """floor(scale * values), scale a power of two, and which rows are wide.

    Rows with a component of ``narrow`` or more are wide: with any, the array holds Python's
    integers, else exact float64 and None for the rows.
    """
    with np.errstate(over="ignore"):
        out = np.floor(values * scale)
    wide = np.abs(out).max(axis=1, initial=0) >= narrow
    if not wide.any():
        return out, None
    exact = np.empty(values.shape, object)
    exact[:] = [[int(np.floor(v * scale)) if abs(v) < 2.0 ** 40 else int(v) * scale + int(np.floor((v - int(v)) * scale)) for v in row]
                for row in values.tolist()]
    return exact, wide


def numbers(rows: Sequence[Sequence[int]], narrow: int) -> np.ndarray:
    """Rows of integers as float64 if all are below ``narrow``, else as Python's integers."""
    if all(abs(v) < narrow for row in rows for v in row):
        return np.array(rows, np.float64).reshape(len(rows), -1)
    out = np.empty((len(rows), len(rows[0])), object)
    out[:] = [list(row) for row in rows]
    return out


def longs(values: np.ndarray) -> pa.Array:
    """int64; a number that has no room in it is NULL."""
    if values.dtype == object:
        return pa.array([int(v) if v <= LONG_MAX else None for v in values], pa.int64())
    return pa.array(values.astype(np.int64))


class Totals:
    """Counts and sums of integer rows by cell, within a task."""

    def __init__(self, cells: int, width: int):
        self.counts = np.zeros(cells, np.int64)
        self.sums = np.zeros((cells, width), object)

    def add(self, cell: np.ndarray, rows: np.ndarray) -> None:
        if not len(cell):
            return
        order = np.argsort(cell, kind="stable")
        cell, rows = cell[order], rows[order]
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sums = np.add.reduceat(rows, start, axis=0)
        self.sums[cell[start]] += sums if sums.dtype == object else sums.astype(np.int64).astype(object)
        self.counts += np.bincount(cell, minlength=len(self.counts))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """(cell, digit, n, sums): a row for each digit that any sum of the cell has."""
        out: list[tuple[int, int, int, list[int]]] = []
        for cell in np.flatnonzero(self.counts).tolist():
            digit, rest = 0, [int(v) for v in self.sums[cell]]
            while digit == 0 or any(rest):
                last = all(-(1 << 62) < v < (1 << 62) for v in rest)
                out.append((cell, digit, int(self.counts[cell]) if digit == 0 else 0,
                            [v if digit and last else v & _MASK for v in rest]))
                rest = [0] * len(rest) if digit and last else [v >> _DIGIT for v in rest]
                digit += 1
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["cell", "digit", "n", "sums"])


def totals(
    df: DataFrame, cells: int, width: int, place: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]],
) -> dict[int, tuple[int, list[int]]]:
    """Count and exact sums of each cell that ``place`` (a batch's cells and integer rows) puts rows in.

    A task sends a few rows for each cell, whatever it has read; the driver gets ``cells`` sums.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Totals(cells, width)
        for batch in batches:
            if batch.num_rows:
                for cell, rows in place(batch):
                    own.add(cell, rows)
        yield from own.batches()

    parts = df.mapInArrow(run, "cell int, digit int, n long, sums array<long>")
    found: dict[int, tuple[int, list[int]]] = {}
    summed = parts.groupBy("cell", "digit").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    for r in summed.collect():
        n, sums = found.get(r.cell, (0, [0] * width))
        found[r.cell] = (n + r.n, [s + (v << (_DIGIT * r.digit)) for s, v in zip(sums, r.sums, strict=True)])
    return found


def replaced(entries: list[list[int]], found: dict[int, tuple[int, list[int]]], first: int = 0) -> list[list[int]]:
    """Each entry's floor mean of the rows in its cell; an entry without rows stays."""
    out = []
    for i, entry in enumerate(entries):
        n, sums = found.get(first + i, (0, entry))
        out.append([s // n for s in sums] if n else entry)
    return out
