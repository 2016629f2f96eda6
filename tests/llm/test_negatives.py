"""Mined negatives equal a full comparison."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, rank string"


def brute(rows, k=5):
    good = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)))
    asked = {}
    for i, label, v in good:
        if i % 10 == 0:
            asked[i] = min(asked.get(i, (label, len(v), v)), (label, len(v), v))
    out = Counter()
    for a, (label, dim, q) in asked.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, same) for i, same, v in good if i != a and len(v) == dim)
        for s, p, _ in [x for x in scored if x[2] == label][:k]:
            near = [(t, n) for t, n, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s]
            out.update((a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(near[:k]))
    return out


def check(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, label, "a", "b", "c") for i, v, label in rows], SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in negatives.mine(frame, F.col("vec_id") % 10 == 0, **options).collect())
    assert got == brute(rows)
    return got


def structured(n=600, seed=1, spread=0.05):
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(6, 24))
    vectors = centres[rng.randint(6, size=n)] + spread * rng.normal(size=(n, 24))
    vectors *= rng.lognormal(0, 0.6, size=(n, 1))
    return [(i, v.tolist(), int(rng.randint(4))) for i, v in enumerate(vectors)]


def test_structured_and_random(spark):
    assert check(spark, structured())
    assert check(spark, structured(seed=2, spread=1.0), slice_bytes=4000)


def test_ties_repeats_and_odd_rows(spark):
    rows = structured(60)
    flat = [0.5] * 24
    rows += [(1000 + i, flat, i % 2) for i in range(40)] + [(1010, flat, 0)] * 7 + [(1003, flat, 1)] * 3
    rows += [(2000, None, 1), (2010, [None] * 24, 1), (2020, [float("nan")] * 24, 1), (2030, [float("inf")] * 24, 0), (None, flat, 1)]
    rows += [(2040, flat, None), (2050, [1.0, 2.0], 1), (2051, [1.0, 1.0], 1), (2052, [1.0, 1.9], 0), (2060, [0.0] * 24, 1), (2061, [0.0] * 24, 0)]
    rows += [(2070, [], 1), (2071, [], 1), (2072, [], 0), (-10, flat, 3), (1020, [0.25] * 24, 0)]
    assert check(spark, rows)


def test_empty_and_lonely(spark):
    assert not check(spark, [])
    assert not check(spark, [(10, [1.0, 0.0], 1)])
    assert not check(spark, [(1, [1.0], 1), (2, [1.0], 2)])


def test_ranges_discard_rows_but_no_result():
    rows = structured(1500)
    vectors = np.floor(256 * np.array([v for _, v, _ in rows]))
    ids, labels = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    scores = vectors[:64] @ vectors.T
    theta = np.sort(scores, axis=1)[:, -20:-19]
    search = negatives.Search(ids[:64], labels[:64], vectors[:64], theta, np.full((64, 1), np.inf), np.full((64, 1), -np.inf), True, 5)
    length = np.sqrt((vectors**2).sum(axis=1))
    kept = 0
    for part in np.array_split(np.argsort(-length), 6):
        anchor, row = search.candidates(negatives.Bucket(ids[part], labels[part], vectors[part]))
        pairs = set(zip(anchor.tolist(), ids[part][row].tolist()))
        wanted = {(a, int(i)) for a in range(64) for i in part if scores[a, i] >= theta[a, 0]}
        assert wanted <= pairs and len(pairs) == len(anchor)
        kept += len(pairs)
    assert kept < 0.3 * 64 * len(rows)
