"""Clusters and codes of vectors against plain Python, and their edge cases."""

import hashlib
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import laesa, walsh
from tarmac.llm.columns import table

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def floors(vector, scale):
    return [floor(Fraction(x) * scale) for x in vector]


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def rounds_of(points, entries, count):
    """k-means in exact integers; points and entries are lists of lists."""
    near = lambda p: min(range(len(entries)), key=lambda k: (squared(p, entries[k]), k))
    for _ in range(count):
        which = [near(p) for p in points]
        entries = [
            [sum(c) // len(own) for c in zip(*own, strict=True)] if (own := [p for p, w in zip(points, which, strict=True) if w == k]) else e
            for k, e in enumerate(entries)]
    return [(near(p), squared(p, entries[near(p)])) for p in points], entries


def kept(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]


def odd_rows(rng, count, size, spread=1.0):
    rows = [(int(i), [float(v) for v in rng.normal(0, spread, size)], int(i % 3)) for i in rng.permutation(count)]
    same = [0.5] * size  # ties: one vector many times, and centroids that are equal
    rows += [(1000 + i, same, None) for i in range(12)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [None] + [0.0] * (size - 1), 1), (2003, [float("nan")] * size, 1),
             (2004, [float("inf")] + [0.0] * (size - 1), 1), (None, [-0.25] * size, 2), (None, [-0.25] * size, 2), (3, same, 2)]
    return rows


@pytest.mark.parametrize("spread, wide", [(1.0, False), (0.001, False), (1.0, True)])
def test_clusters_equal_plain_python(spark, spread, wide):
    rows = odd_rows(np.random.default_rng(5), 70, 64, spread)
    rows += [(2005, [0.0] * 63, 1), (2006, [0.0] * 65, 1)]
    if wide:
        rows += [(3000, [1e30] + [0.0] * 63, 1), (3001, [-1e30] * 64, 1), (3002, [2.0 ** 20 + 0.125] * 64, 1)]
    extra = [F.lit("x").alias(c) for c in ("id", "v", "cluster", "distance", "cell", "n")]
    got, centers = walsh.cluster_vectors(spark.createDataFrame(rows, SCHEMA).select("*", *extra).repartition(3), centroids=9)
    points = sorted((r for r in kept(rows) if len(r[1]) == 64),
                    key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    want, entries = rounds_of([floors(r[1], 256) for r in points], [floors(r[1], 256) for r in points[:9]], 5)
    assert centers == entries
    room = lambda d: d if d < 1 << 63 else None
    expected = sorted(((r[0], k, room(d)) for r, (k, d) in zip(points, want, strict=True)), key=repr)
    assert sorted((tuple(r) for r in got.select("vec_id", "cluster", "distance").collect()), key=repr) == expected
    sums = walsh.with_inertia(got, centers).collect()
    assert len(sums) == len(points)
    for r in sums:
        own = [d for _, k, d in expected if k == r.cluster]
        assert r.cluster_inertia == (None if None in own else room(sum(own)))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, entries[r.cluster])).encode()).hexdigest()
        everything = [d for _, _, d in expected]
        assert r.inertia == (None if None in everything else sum(everything))


def test_clusters_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0] * 64, 0), (2, [2.0] * 64, 0)], SCHEMA)
    got, centers = walsh.cluster_vectors(few)
    assert len(centers) == 2 and [r.distance for r in got.collect()] == [0, 0]
    none, centers = walsh.cluster_vectors(few.filter("vec_id > 5"))
    assert centers == [] and walsh.with_inertia(none, centers).count() == 0
    assert walsh.with_inertia(none, centers).columns == ["cluster", "vec_id", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_progressive_search_is_exact(spark):
    rng = np.random.default_rng(2)
    c = rng.integers(-300, 300, (40, 64)).astype(float)
    c[7] = c[3]
    x = np.concatenate([rng.integers(-300, 300, (500, 64)).astype(float), c, (c[3] + c[9])[None]])
    which, far = walsh.nearest(walsh.coefficients(x), walsh.coefficients(c))
    plain = ((x[:, None] - c) ** 2).sum(axis=2)
    assert (which == plain.argmin(axis=1)).all() and (far == plain.min(axis=1)).all()


@pytest.mark.parametrize("size, wide", [(16, False), (10, False), (16, True)])
def test_codes_equal_plain_python(spark, size, wide):
    rows = odd_rows(np.random.default_rng(8), 60, size)
    rows += [(2005, [0.0] * (size + 1), 1)]
    if wide:
        rows += [(3000, [1e30] + [0.0] * (size - 1), 1), (-1, [-1e20] * size, 1), (3002, [2.0 ** 30 + 2.0 ** -11] * size, 1)]
    extra = [F.lit("x").alias(c) for c in ("id", "v", "pivot", "code", "error", "cell", "_label")]
    got, books = laesa.encode_vectors(spark.createDataFrame(rows, SCHEMA).select("*", *extra).repartition(3), entries=20)
    points = sorted((r for r in kept(rows) if len(r[1]) == size),
                    key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))
    whole, codes, errors = [floors(r[1], 1024) for r in points], [[] for _ in points], [0] * len(points)
    for p in range(4):
        part = [v[size * p // 4:size * (p + 1) // 4] for v in whole]
        want, entries = rounds_of(part, part[:20], 4)
        assert books[p] == entries
        for i, (k, d) in enumerate(want):
            codes[i].append(k)
            errors[i] += d
    room = lambda d: d if d is not None and d < 1 << 63 else None
    expected = sorted(((r[0], r[2], c, room(e)) for r, c, e in zip(points, codes, errors, strict=True)), key=repr)
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got.collect()), key=repr) == expected
    for limit in (laesa.BROADCAST_ROWS, 0):
        laesa.BROADCAST_ROWS, before = limit, laesa.BROADCAST_ROWS
        digests = laesa.code_digests(got, books).collect()
        laesa.BROADCAST_ROWS = before
        assert len(digests) == len(points)
        for r in digests:
            own = [e for _, label, _, e in expected if label == r.label]
            assert r.label_error == (None if None in own else room(sum(own))) and len(r.code) == 8


def test_codes_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0] * 8, 0), (2, [2.0] * 8, None), (2, [2.0] * 8, None)], SCHEMA)
    got, books = laesa.encode_vectors(few)
    assert [len(b) for b in books] == [3] * 4 and sorted(r.code for r in got.collect()) == [[0] * 4, [1] * 4, [1] * 4]
    none, books = laesa.encode_vectors(few.filter("vec_id > 5"))
    assert laesa.code_digests(none, books).count() == 0 and none.columns == ["vec_id", "label", "code", "error"]


def test_pivot_bounds_lose_no_entry(spark):
    rng = np.random.default_rng(4)
    entries = rng.integers(-2000, 2000, (256, 16)).astype(float)
    entries[200] = entries[13]
    x = np.concatenate([rng.integers(-2000, 2000, (700, 16)).astype(float), entries, (entries[13] + entries[14])[None] // 2])
    pivots = entries[laesa.far_apart(entries, laesa.PIVOTS)]
    which, far = laesa.nearest(x, entries, laesa.distances(x, pivots), laesa.distances(entries, pivots))
    plain = ((x[:, None] - entries) ** 2).sum(axis=2)
    assert (which == plain.argmin(axis=1)).all() and (far == plain.min(axis=1)).all()


def test_given_vectors_keep_their_label(spark):
    vectors = table(spark, "/root/testdata/sf0.001", "embeddings")
    got, _ = laesa.encode_vectors(vectors)
    assert got.join(vectors.select("vec_id", F.col("label").alias("own")), "vec_id").filter("own <=> label").count() == vectors.count()
