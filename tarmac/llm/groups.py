"""Links between rows: connected components, and groups of rows streamed in order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.columns import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b: long), root the smallest node it is linked to.

    Every node points to its smallest neighbour, and the graph is contracted along the pointers
    until no edge is left: each round at least halves the nodes that still have edges. A hub is
    one row after the map side of the aggregation. Rounds are cut by tables in the shared folder.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(edges.filter("a != b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        step = both(edges).groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        # A node may point to one that points on: two jumps keep chains short.
        hop = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = written(step.join(hop, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "step")
        to = lambda c: step.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = written(
                labels.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        edges = written(
            edges.join(to("a"), "a").join(to("b"), "b")
            .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
            .filter("a != b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that are sorted by ``keys`` (integers, not NULL).

    A table has as many groups as ended in a batch; the last group waits for the next batch.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        differs = np.zeros(batch.num_rows, bool)
        for v in values:
            differs |= v != v[-1]
        start = int(differs.sum())  # rows of the last group stand together at the end
        held = [waiting[-1].column(waiting[-1].schema.get_field_index(k))[-1].as_py() for k in keys] if waiting else None
        if start == 0 and (held is None or held == [int(v[-1]) for v in values]):
            waiting.append(batch)
            continue
        yield pa.Table.from_batches([*waiting, batch.slice(0, start)])
        waiting = [batch.slice(start)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def boundaries(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First rows of the groups of a sorted table, and its length."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = table[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.r_[np.flatnonzero(new), table.num_rows]


def spanning(size: int, linked) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the numbers below ``size``.

    ``linked(i, others)`` tells which of ``others`` are linked to i. Each number is compared
    only with those not yet reached, so a group that hangs together costs little.
    """
    left = np.arange(size)
    edges: list[tuple[int, int]] = []
    while len(left):
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            hit = linked(here, left)
            if hit.any():
                found = left[hit].tolist()
                edges += [(here, f) for f in found]
                frontier += found
                left = left[~hit]
    return edges
