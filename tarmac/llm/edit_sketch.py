"""Document fingerprints by a randomised edit embedding.

A walk goes over the characters of a text and stays on each for a number of steps that depends
on the character and the step, by random bits that all texts share. After an edit two walks
drift back together, so edit distance becomes Hamming distance between the paths. The paths are
sampled at shared places; what is found there, a hash of the next characters, makes the
fingerprint. The Hamming likeness of two fingerprints estimates that of the paths; bands of
sampled places find candidates, and the likeness verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.arrow import code_points, column

# Sampled places of a path (about), characters hashed at each, bands and places in a band.
PLACES, GRAM, BANDS, BAND_PLACES = 256, 4, 24, 3
_PERIOD, _CLASSES, _SEED = 4096, 256, 20_240_607
_LANES, _CELLS, _FEW = 512, 6_000_000, 24
# Buckets of ids: rows of one are sorted and read by one task.
ROWS_PER_BUCKET, MOST_BUCKETS = 6_000, 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _stays() -> np.ndarray:
    """Steps the walk stays on a character of a class from a step on: until a random bit is set."""
    bits = np.random.default_rng(_SEED).integers(0, 2, (_CLASSES, _PERIOD), np.uint8)
    bits[:, ::16] = 1
    stay = np.ones((_CLASSES, _PERIOD), np.int32)
    for step in range(2 * _PERIOD - 1, -1, -1):
        here, after = step % _PERIOD, (step + 1) % _PERIOD
        stay[:, here] = np.where(bits[:, here] == 1, 1, stay[:, after] + 1)
    return stay


def _walks(texts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The step at which each character is reached, and the length of the path: n + 1 numbers a text."""
    stay, mask = _stays(), _PERIOD - 1
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    at = 0
    while at < len(order):
        longest = max(len(texts[order[at]]), 1)
        lanes = order[at:at + max(1, min(_LANES, _CELLS // longest))]
        at += len(lanes)
        sizes = np.array([len(texts[i]) for i in lanes])
        common = int(sizes[_FEW - 1]) if len(lanes) >= _FEW else 0
        kinds = np.zeros((common, len(lanes)), np.uint8)
        for lane, i in enumerate(lanes):
            head = texts[i][:common]
            kinds[:len(head), lane] = _kinds(head)
        path = np.zeros((common + 1, len(lanes)), np.int64)
        step = np.zeros(len(lanes), np.int64)
        active = len(lanes)
        for t in range(common):
            while sizes[active - 1] <= t:
                active -= 1
            now = step[:active]
            now += stay[kinds[t, :active], now & mask]
            path[t + 1, :active] = now
        for lane, i in enumerate(lanes):
            n = int(sizes[lane])
            own = path[:min(n, common) + 1, lane]
            if n > common:  # few are left: one after the other
                now, tail, flat = int(own[-1]), [], _flat_stays()
                for kind in _kinds(texts[i][common:]).tolist():
                    now += flat[kind][now & mask]
                    tail.append(now)
                own = np.concatenate([own, np.array(tail, np.int64)])
            out[i] = np.ascontiguousarray(own)
    return out


@lru_cache(maxsize=1)
def _flat_stays() -> list[bytes]:
    return [row.astype(np.uint8).tobytes() for row in _stays()]


def _kinds(points: np.ndarray) -> np.ndarray:
    return (_mix(points.astype(np.uint64) + np.uint64(1)) & np.uint64(_CLASSES - 1)).astype(np.uint8)


@lru_cache(maxsize=40)
def sampled_places(level: int) -> np.ndarray:
    """Places below 2^level that all texts of the level sample; those of a level above are among them."""
    share = min(1.0, PLACES / 2 ** level)
    found = []
    for begin in range(0, 2 ** level, 1 << 20):
        places = np.arange(begin, min(begin + (1 << 20), 2 ** level), dtype=np.uint64)
        found.append(places[(_mix(places + np.uint64(_SEED)) >> np.uint64(11)) < np.uint64(share * 2 ** 53)])
    return np.concatenate(found).astype(np.int64)


def fingerprints(texts: Sequence[str]) -> list[str]:
    """``level-length-symbols`` of each text: the path's length and a byte for every sampled place.

    Places beyond the path are 0; an empty text has a path of length 0. Equal texts have equal
    fingerprints.
    """
    points = [code_points(t) for t in texts]
    out = []
    for x, path in zip(points, _walks(points), strict=True):
        length = int(path[-1])
        level = max(int(length - 1).bit_length() if length else 0, 4)
        places = sampled_places(level)
        inside = places[places < length]
        where = np.searchsorted(path, inside, "right") - 1
        padded = np.concatenate([x, np.zeros(GRAM, np.uint32)]).astype(np.uint64)
        gram = np.zeros(len(where), np.uint64)
        for k in range(GRAM):
            gram = _mix(gram * np.uint64(31) + padded[where + k] + np.uint64(k + 1))
        symbols = np.zeros(len(places), np.uint8)
        symbols[:len(inside)] = (gram % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        out.append(f"{level}-{length}-{symbols.tobytes().hex()}")
    return out


def _parse(fingerprint: str) -> tuple[int, int, np.ndarray]:
    level, length, symbols = fingerprint.split("-")
    return int(level), int(length), np.frombuffer(bytes.fromhex(symbols), np.uint8)


def _raised(level: int, symbols: np.ndarray, to: int) -> np.ndarray:
    """Symbols at the places of a higher level; beyond the own level there is no path."""
    if level == to:
        return symbols
    places = sampled_places(to)
    own = np.zeros(len(places), np.uint8)
    inside = places < 2 ** level
    own[inside] = symbols[np.searchsorted(sampled_places(level), places[inside])]
    return own


def likeness(one: str, other: str) -> float:
    """Share of sampled places, up to the end of the longer path, where both paths agree."""
    if one == other:
        return 1.0
    (la, na, a), (lb, nb, b) = _parse(one), _parse(other)
    level = max(la, lb)
    a, b = _raised(la, a, level), _raised(lb, b, level)
    within = sampled_places(level) < max(na, nb)
    return float((a[within] == b[within]).mean()) if within.any() else float(na == nb)


def bands(fingerprint: str) -> list[int]:
    """Keys of sampled groups of places: those of the own level, and those shared with the level below and above.

    Places are drawn by a hash, of the own level below its half, and of two levels below a quarter
    of the upper one: there every path of them runs, so both texts draw the same places.
    """
    level, length, symbols = _parse(fingerprint)
    keys = []
    for to, below, salt in ((level, level - 1, level + 100), (level, level - 2, level), (level + 1, level - 1, level + 1)):
        own = _raised(level, symbols, to)
        low = np.flatnonzero(sampled_places(to) < 2 ** below)
        if not len(low) or not length:
            continue
        draw = low[(_mix(np.arange(BANDS * BAND_PLACES) + np.uint64(_SEED * 7 + salt)) % np.uint64(len(low))).astype(int)]
        picked = own[draw].reshape(BANDS, BAND_PLACES).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64) + np.uint64(salt * 1000)
        for k in range(BAND_PLACES):
            key = _mix(key * np.uint64(257) + picked[:, k] + np.uint64(1))
        keys += key.astype(np.int64).tolist()
    return keys


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, band_edited boolean, band_next boolean")
_NAMES = [f.strip().split(" ")[0] for f in EDITED.split(",")]
_ARROW = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.bool_()] * 2]


def _edited_rows(rows: list[tuple[int | None, str]], ahead: str) -> pa.RecordBatch:
    texts = [t for _, t in rows]
    following = [*texts[1:], ahead]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, following, strict=True)]
    marks = fingerprints([*texts, ahead, *edited])
    own, after, changed = marks[:len(rows)], marks[1:len(rows) + 1], marks[len(rows) + 1:]
    shared = lambda a, b: a == b or not set(bands(a)).isdisjoint(bands(b))
    columns = [
        [i for i, _ in rows], [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        own, changed, [likeness(a, b) for a, b in zip(own, changed, strict=True)],
        [likeness(a, b) for a, b in zip(own, after, strict=True)],
        [shared(a, b) for a, b in zip(own, changed, strict=True)],
        [shared(a, b) for a, b in zip(own, after, strict=True)]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)], names=_NAMES)


def _edited(batches: Iterator[pa.RecordBatch], chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; the last of a bucket is a guard, the first row of the next bucket."""
    rows: list[tuple[int | None, str]] = []
    size, bucket, closed = 0, None, False
    for batch in batches:
        for b, guard, i, text in zip(*(column(batch, c).to_pylist() for c in ("bucket", "guard", "doc_id", "text")),
                                     strict=True):
            if b != bucket:
                bucket, closed, rows, size = b, False, [], 0
            if closed:
                continue  # several rows may have the guard's id: the first is next
            if guard or size > chars:
                if rows:
                    yield _edited_rows(rows, text)
                rows, size, closed = [], 0, guard
            rows.append((i, text))
            size += len(text)


def with_edits(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text and of its edit with the head of the next document's text.

    Next is the next row by (doc_id, text), NULL ids first, and after the last the first; a NULL
    text is empty. Ids are cut into buckets of about equal rows at approximate quantiles; a
    bucket is sorted in one task, and the first row of the next one is added to it as a guard,
    so each text is moved once and no order is made of all rows at once.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    count = min(MOST_BUCKETS, max(1, ids.count() // rows_per_bucket))
    shares = [i / count for i in range(1, count)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 20 * count)).first()[0] if shares else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids):
        known = ids.notna()
        place = np.zeros(len(ids), np.int32)
        place[known.to_numpy()] = np.searchsorted(cuts, ids[known].astype("int64").to_numpy(), "right")
        return pd.Series(place)

    bucket = bucket_of("doc_id") if len(cuts) else F.lit(0)
    firsts = ids.withColumn("bucket", bucket).groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("m")).orderBy("bucket")
    starts = [(r.bucket, r.m.doc_id) for r in firsts.collect()]  # a row per bucket
    before = {b: starts[k - 1][0] for k, (b, _) in enumerate(starts)}
    known = [i for _, i in starts if i is not None]
    is_first = F.col("doc_id").isin(known) if known else F.lit(False)
    if any(i is None for _, i in starts):
        is_first = F.col("doc_id").isNull() | is_first
    placed = rows.withColumn("bucket", bucket)
    moved = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map()
    guards = placed.filter(is_first).withColumn("bucket", moved[F.col("bucket")]) if before else placed.limit(0)
    union = placed.withColumn("guard", F.lit(False)).unionByName(guards.withColumn("guard", F.lit(True)))
    ordered = union.repartition(max(count, 1), "bucket").sortWithinPartitions("bucket", "guard", "doc_id", "text")
    return ordered.mapInArrow(_edited, EDITED)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = fingerprints([t or "" for t in column(batch, "text").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(marks, pa.string()), pa.array([bands(m) for m in marks], pa.list_(pa.int64()))],
            names=["doc_id", "fingerprint", "bands"])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint and band keys of every row (doc_id, text); NULL texts are empty and have no bands."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _fingerprint_batches, "doc_id bigint, fingerprint string, bands array<bigint>")


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [likeness(a, b) for a, b in zip(
                column(batch, "query_print").to_pylist(), column(batch, "fingerprint").to_pylist(), strict=True)]
            keep = pa.array([n >= least for n in near], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [column(batch, "query_id"), column(batch, "fingerprint"), pa.array(near, pa.float64())],
                names=["query_id", "fingerprint", "near"])
            yield out.filter(keep)
    return run


def search(prints: DataFrame, queries: DataFrame, least: float = 0.8) -> DataFrame:
    """Rows of ``prints`` like the ``queries``: (query_id, doc_id, near) with a likeness of ``least`` or more.

    Both come from ``fingerprint_documents``; the queries are a stated set. Candidates share a
    band, and equal fingerprints are compared once.
    """
    once = prints.filter(F.size("bands") > 0).groupBy("fingerprint").agg(F.first("bands").alias("bands"))
    asked = queries.filter(F.size("bands") > 0).select(
        F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("query_print"), F.explode("bands").alias("band"))
    pairs = (
        asked.join(once.select("fingerprint", F.explode("bands").alias("band")), "band")
        .select("query_id", "query_print", "fingerprint").distinct())
    verified = pairs.mapInArrow(_verify(least), "query_id bigint, fingerprint string, near double")
    return verified.join(prints.select("doc_id", "fingerprint"), "fingerprint").select("query_id", "doc_id", "near")
