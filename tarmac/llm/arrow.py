"""Arrow batches in and out of tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


# Rows whose results a task holds at once.
ROWS = 256


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The strings of a column; NULL is empty."""
    return [value or "" for value in column(batch, name).to_pylist()]


def add_columns(
    docs: DataFrame, fields: str, make: Callable[[], Callable[[pa.RecordBatch], Sequence]], drop: Iterable[str] = (),
) -> DataFrame:
    """``docs`` without ``drop``, and the columns ``fields`` that a task makes of each batch.

    ``make`` is called once per task. A column that has the name of a new one gives way to it.
    """
    added = StructType.fromDDL(fields)
    gone = {c.lower() for c in [*drop, *added.names]}
    kept = [c for c in docs.columns if c.lower() not in gone]
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        compute = make()
        for whole in batches:
            for begin in range(0, max(whole.num_rows, 1), ROWS):
                batch = whole.slice(begin, ROWS)
                made = [v if isinstance(v, pa.Array) else pa.array(v, f.type)
                        for v, f in zip(compute(batch), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(column(batch, c) for c in kept), *made], names=[*kept, *arrow.names])

    return docs.mapInArrow(run, StructType([docs.schema[c] for c in kept] + added.fields))


def sample_by_class(docs: DataFrame, label: str, key: Column, per_class: int) -> DataFrame:
    """Up to ``per_class`` rows of each class, those with the smallest hash of ``key``.

    Classes are few. They are counted without reading more than the label and the key, and a
    threshold on the hash leaves little more than the wanted rows before any is moved.
    """
    space = 1 << 30
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(space))
    counts = {r[label]: r["count"] for r in docs.groupBy(label).count().collect() if r[label] is not None}
    limit = F.lit(0).cast("long")
    for value, count in sorted(counts.items(), key=lambda x: str(x[0])):
        share = min(1.0, (2 * per_class + 50) / count)
        limit = F.when(F.col(label) == F.lit(value), F.lit(int(share * space))).otherwise(limit)
    from pyspark.sql import Window

    few = docs.filter(place < limit).withColumn("_place", place)
    order = Window.partitionBy(label).orderBy("_place", key)
    return few.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_class).drop("_place")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
