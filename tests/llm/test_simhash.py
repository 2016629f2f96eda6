"""Fingerprints and classes equal a full comparison."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash

from riskloom.llm import common, queries, simhash
from tests.llm import helpers


def brute_print(text):
    words = [w for w in (text or "").encode().lower().split() if w] if (text or "").isascii() else (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(shingles))


def brute_classes(prints):
    """prints: doc_id -> unsigned fingerprint."""
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(prints), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in prints}


def test_covering_sets():
    for size in (4, 5):
        sets = [set(s) for s in simhash.covering(size)]
        assert all(any(s <= set(five) for s in sets) for five in combinations(range(8), 5))


def test_awkward_texts(spark):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(helpers.docs(spark, helpers.AWKWARD)).collect()}
    prints = {i: brute_print(t) for i, t in enumerate(helpers.AWKWARD)}
    assert {i: r["fp"] % (1 << 64) for i, r in got.items()} == prints
    assert {i: r["component"] for i, r in got.items()} == brute_classes(prints)


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_classes(prints)


def test_chains_and_dense_groups(spark, monkeypatch):
    rng = random.Random(4)
    prints = {}
    centre = rng.getrandbits(64)
    for i in range(150):  # one dense group
        prints[i] = centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
    value = rng.getrandbits(64)
    for i in range(150, 220):  # a chain of steps of three bits
        prints[i] = value
        value ^= sum(1 << b for b in rng.sample(range(64), 3))
    for i in range(220, 300):  # four bits off, one byte each: never linked to their centre
        prints[i] = centre ^ (1 << rng.randrange(8)) ^ (1 << 8 + rng.randrange(8)) ^ (1 << 16 + rng.randrange(8)) ^ (1 << 24 + rng.randrange(8))
    ids = list(prints)
    rng.shuffle(ids)
    prints = dict(zip(ids, prints.values()))
    frame = spark.createDataFrame([(i, str(np.uint64(p).astype(np.int64))) for i, p in prints.items()], "doc_id long, text string")
    monkeypatch.setattr(simhash, "fingerprint", lambda text: simhash.F.col(text).cast("long"))
    got = {r["doc_id"]: r["component"] for r in simhash.near_duplicates(frame).collect()}
    assert got == brute_classes(prints)


def test_keep_one(spark):
    frame = helpers.docs(spark, ["one two three four"] * 5 + ["completely different text over here"]).repartition(3)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 5]


def test_nulls_and_no_rows(spark):
    assert simhash.near_duplicates(helpers.empty(spark)).count() == 0
    frame = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (None, "q")], "doc_id long, text string")
    got = sorted(((str(r["doc_id"]), r["component"]) for r in simhash.near_duplicates(frame).collect()), key=str)
    assert got == [("5", 5), ("5", 5), ("None", 5), ("None", None)]
    assert simhash.keep_one(frame).count() == 4


def test_classes_of_links(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(6000, 6300)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["root"] for r in common.classes(spark.createDataFrame(links, "src long, dst long")).collect()}
    root = {}
    for a, b in links:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in root and b in root and a is not None and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root


def test_rows_are_judged_by_id_and_text(spark):
    rows = [(1, "one text that two ids share here"), (2, "one text that two ids share here"), (2, "quite another text of many other words"), (None, "one text that two ids share here")]
    frame = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, _id string, content string, fp string")
    got = sorted([(r["doc_id"], r["text"]) for r in simhash.keep_one(frame).collect()], key=str)
    assert got == sorted([rows[0], rows[2], rows[3]], key=str) and simhash.keep_one(frame).columns == frame.columns
