"""Shards against a plain sort, and their edge cases."""

import hashlib

import numpy as np
import pytest

from tarmac.llm import sharding


def key(text):
    return int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16)


def plain(rows, shards=8, tolerance=0.01):
    """(doc_id, text, shard, slot) by one sort and running sums."""
    rows = sorted(rows, key=lambda r: (key(r[1]), -(1 << 63) if r[0] is None else r[0]))
    ends = np.cumsum([len((r[1] or "").encode()) + 1 for r in rows])
    total, borders = int(ends[-1]), [0, *ends.tolist()]
    texts = [0, *[int(e) for e, r, n in zip(ends, rows, [*rows[1:], None], strict=True) if n is None or key(n[1]) != key(r[1])]]
    cuts = []
    for k in range(1, shards):
        want = total * k // shards
        best = min(texts, key=lambda b: (abs(b - want), b))
        cuts.append(best if abs(best - want) <= tolerance * total / shards else min(borders, key=lambda b: (abs(b - want), b)))
    out, slots = [], [0] * shards
    for r, end in zip(rows, ends, strict=True):
        shard = sum(c < end for c in cuts)
        out.append((r[0], r[1], shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.text, r.shard, r.slot) for r in df.collect()), key=repr)


def some(rng, count):
    return [(int(i), "é" * int(rng.integers(0, 9)) + " ".join(rng.choice(["a", "bb", "ccc"], int(rng.integers(0, 60))))) for i in range(count)]


@pytest.mark.parametrize("hot", ["", "copy of a text " * 3, None])
def test_equals_plain_sort(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 40)
    rows = some(np.random.default_rng(3), 400) + [(1000 + i, hot) for i in range(300)]
    rows += [(5000, "long " * 3000), (None, None), (None, "no id"), ((1 << 63) - 1, hot), (-(1 << 63) + 1, hot)]
    got = sharding.shard_documents(documents(rows, extra=True).repartition(5))
    assert found(got) == plain(rows)
    assert {"lang", "key", "block", "at"} <= set(got.columns)


def test_hot_rows_that_are_alike_in_all(spark, documents):
    """One row a thousand times: no key parts it, its rows are dealt all the same."""
    rows = [(7, "the same")] * 1000 + [(8, "another")] * 3
    got = found(sharding.shard_documents(documents(rows).repartition(4)))
    assert [r[2:] for r in sorted(got, key=lambda r: r[2:])] == [r[2:] for r in sorted(plain(rows), key=lambda r: r[2:])]
    counts = [sum(r[2] == s for r in got) for s in range(8)]
    assert max(counts) - min(counts) <= 5


def test_even_sizes_and_copies_together(spark, documents):
    rng = np.random.default_rng(1)
    rows = [(i, "".join(rng.choice(list("abcdef "), 80))) for i in range(3000)]
    rows += [(9000 + i, rows[i // 5][1]) for i in range(500)]
    got = found(sharding.shard_documents(documents(rows)))
    sizes = [sum(len(r[1]) + 1 for r in got if r[2] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.04 * sum(sizes) / 8
    homes = {}
    for r in got:
        homes.setdefault(r[1], set()).add(r[2])
    assert all(len(h) == 1 for h in homes.values())
    for s in range(8):
        assert sorted(r[3] for r in got if r[2] == s) == list(range(sum(r[2] == s for r in got)))


def test_few_and_no_documents(spark, documents):
    assert sharding.shard_documents(documents([])).count() == 0
    one = sharding.shard_documents(documents([(1, "x")])).collect()
    assert len(one) == 1 and one[0].slot == 0 and 0 <= one[0].shard < 8
    assert found(sharding.shard_documents(documents([(1, "x"), (2, "y" * 100_000)]))) == plain([(1, "x"), (2, "y" * 100_000)])
    again = sharding.shard_documents(sharding.shard_documents(documents([(i, str(i)) for i in range(50)])), shards=3)
    assert again.columns.count("shard") == 1 and {r.shard for r in again.collect()} == {0, 1, 2}


def test_splitters_need_few_rounds(spark, documents, monkeypatch):
    rounds = []
    counted = sharding._histogram
    monkeypatch.setattr(sharding, "_histogram", lambda *a: rounds.append(1) or counted(*a))
    sharding.shard_documents(documents([(i, f"{i} {'x' * (i % 97)}") for i in range(20_000)]))
    assert len(rounds) <= 4
