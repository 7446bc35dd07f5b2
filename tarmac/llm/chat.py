"""Chat formatting by columnar byte assembly.

A turn is five segments: two fixed ones around its role, the text and the end. For a batch of
turns their lengths make offsets, the offsets make scatter indices, and headers and contents are
copied column by column into one preallocated buffer that becomes the Arrow strings.

Control strings inside roles and texts are broken by a backslash behind their first character,
and backslashes are doubled, so what the template marks cannot be forged and reads back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.arrow import column

# Control strings and the template of a turn.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST]", b"</s>"
FORMATTED = "n_turns bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"
DIGESTS = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
# Bytes that one round of scatter indices covers; longer contents are copied as they are.
_ROUND = 4 << 20
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(values: pa.Array) -> pa.Array:
    values = pc.replace_substring(pc.fill_null(values, ""), "\\", "\\\\")
    for control in CONTROL:
        values = pc.replace_substring(values, control, f"{control[0]}\\{control[1:]}")
    return values


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Content and offsets of a string column."""
    values = values.cast(pa.large_string())
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def _scatter(target: np.ndarray, places: np.ndarray, source: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Copy ``source[starts:starts + sizes]`` to ``places``, many rows with one pair of index arrays."""
    ends = np.cumsum(sizes)
    row = 0
    while row < len(sizes):
        done = ends[row - 1] if row else 0
        stop = max(int(np.searchsorted(ends, done + _ROUND, "right")), row + 1)
        if stop == row + 1:
            target[places[row]:places[row] + sizes[row]] = source[starts[row]:starts[row] + sizes[row]]
        else:
            part = slice(row, stop)
            within = np.arange(ends[stop - 1] - done) - np.repeat(ends[part] - sizes[part] - done, sizes[part])
            target[np.repeat(places[part], sizes[part]) + within] = source[np.repeat(starts[part], sizes[part]) + within]
        row = stop


def assemble(roles: pa.Array, contents: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all turns, where each ends in it, and in code points its head and text lengths."""
    escaped_roles, escaped = escape(roles), escape(contents)
    role_bytes, role_at = _bytes(escaped_roles)
    text_bytes, text_at = _bytes(escaped)
    n = len(role_at) - 1
    lengths = np.empty((n, 5), np.int64)
    lengths[:] = len(OPEN), 0, len(MIDDLE), 0, len(CLOSE)
    lengths[:, 1], lengths[:, 3] = np.diff(role_at), np.diff(text_at)
    ends = np.cumsum(lengths.ravel()).reshape(n, 5)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for segment, fixed in ((0, OPEN), (2, MIDDLE), (4, CLOSE)):
        out[begins[:, segment, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    _scatter(out, begins[:, 1], role_bytes, role_at[:-1], lengths[:, 1])
    _scatter(out, begins[:, 3], text_bytes, text_at[:-1], lengths[:, 3])
    head = len(OPEN) + len(MIDDLE) + np.asarray(pc.utf8_length(escaped_roles), np.int64)
    return out, ends[:, -1], head, np.asarray(pc.utf8_length(escaped), np.int64)


def _format(turns: pa.Table) -> pa.RecordBatch:
    """Whole conversations, sorted, to one row each."""
    ids = turns["conv_id"].combine_chunks()
    filled = np.asarray(pc.fill_null(ids, 0))
    missing = np.asarray(pc.is_null(ids))
    new = np.r_[True, (filled[1:] != filled[:-1]) | (missing[1:] != missing[:-1])]
    first = np.flatnonzero(new)
    out, ends, head, size = assemble(turns["role"].combine_chunks(), turns["text"].combine_chunks())
    last = np.r_[first[1:], turns.num_rows] - 1
    offsets = np.r_[0, ends[last]]
    formatted = pa.Array.from_buffers(
        pa.large_string(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
    # Code points before each turn of its conversation; the loss is on the assistant's texts.
    chars = np.cumsum(head + size + len(CLOSE)) - (head + size + len(CLOSE))
    begin = chars - np.repeat(chars[first], np.diff(np.r_[first, turns.num_rows])) + head
    mine = np.asarray(pc.fill_null(pc.equal(turns["role"].combine_chunks(), "assistant"), False))
    spans = pa.StructArray.from_arrays([pa.array(begin[mine]), pa.array((begin + size)[mine])], ["start", "end"])
    loss = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(mine)[last]].astype(np.int32)), spans)
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(first)), pa.array(np.diff(np.r_[first, turns.num_rows])), formatted.cast(pa.string()), loss],
        names=["conv_id", "n_turns", "formatted", "loss"])


def _sorted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats what is complete; the last conversation of a batch waits for the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = column(batch, "conv_id")
        last = ids[-1]
        same = pc.is_null(ids) if not last.is_valid else pc.fill_null(pc.equal(ids, last), False)
        start = batch.num_rows - pc.sum(same).as_py()
        held = column(waiting[-1], "conv_id")[-1] if waiting else last
        if start == 0 and held.equals(last):
            waiting.append(batch)
            continue
        done = [*waiting, batch.slice(0, start)]
        yield _format(pa.Table.from_batches(done))
        waiting = [batch.slice(start)]
    if waiting:
        yield _format(pa.Table.from_batches(waiting))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: n_turns, the formatted text, and the spans under the loss.

    Rows are ordered by turn, then role and text, NULLs first; NULL roles and texts are empty,
    and rows without conv_id are one conversation. Spans are code points of ``formatted``, end
    exclusive: the texts (not the headers) of turns whose role is ``assistant``. A conversation
    is one string, so its turns meet in one task; tasks stream their conversations in order.
    """
    ordered = (
        turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text"))
    return ordered.mapInArrow(_sorted_batches, f"conv_id bigint, {FORMATTED}")


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [f.strip().split(" ")[0] for f in f"conv_id bigint, {DIGESTS}".split(",")]
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            turns = read_back(row["formatted"])
            whole = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
            loss = "".join(unescape(row["formatted"][s["start"]:s["end"]]) for s in row["loss"])
            made.append((row["conv_id"], len(turns), whole.hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(row["formatted"])))
        columns = list(zip(*made, strict=True)) or [()] * len(fields)
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=fields)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted text and its loss spans."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(_digests, f"conv_id bigint, {DIGESTS}")
