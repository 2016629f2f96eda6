"""Matches equal a full comparison of every window; recall at the largest allowed distance."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from riskloom.llm import decontaminate as D
from riskloom.llm.common import pieces
from tests.llm import helpers


def brute_edits(item, words):
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(words):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def changed(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.randint(3), rng.randint(len(words))
        if kind == 0:
            words[at] = vocabulary[rng.randint(len(vocabulary))]
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, vocabulary[rng.randint(len(vocabulary))])
    return words


def corpus(seed=3):
    rng = np.random.RandomState(seed)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.randint(1, 6))) for _ in range(300)]
    items = [[vocabulary[k] for k in rng.zipf(1.3, rng.randint(8, 60)) % 300] for _ in range(40)]
    texts = []
    for i, item in enumerate(items):
        for share in (0.0, 0.1, 0.2):
            near = changed(item, int(share * len(item)), rng, vocabulary)
            around = [[vocabulary[k] for k in rng.zipf(1.3, rng.randint(0, 40)) % 300] for _ in range(2)]
            texts.append(" ".join([*around[0], *near, *around[1]]))
        texts.append(" ".join(vocabulary[k] for k in rng.zipf(1.3, 60) % 300))
    return [" ".join(i) for i in items], texts


def test_against_brute_force(spark):
    items, texts = corpus()
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in D.contaminated(helpers.docs(spark, texts), benchmark).collect()}
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            n = len(item.split())
            e = brute_edits(item.split(), text.split())
            if e <= int(0.2 * n + 1e-9):
                want[d, i] = e
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    exact = {k for k in want if want[k] == 0}
    assert exact <= set(got)
    assert len(set(got)) >= 0.97 * len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.95 * len(got)


def test_awkward(spark):
    items = spark.createDataFrame([(0, "one two three four five six seven eight nine ten"), (1, None), (2, ""), (3, "too short"), (None, "no id but eleven words are here for you to find")], "item_id long, text string")
    texts = [*helpers.AWKWARD, "ONE, two: three four FIVE six seven eight nine ten!", "two three four five six seven eight nine ten", "too short", "xx no id but eleven words are here for you to find"]
    got = sorted((r["doc_id"], r["item_id"] is None, r["edits"]) for r in D.contaminated(helpers.docs(spark, texts), items).collect())
    n = len(helpers.AWKWARD)
    assert got == [(n, False, 0), (n + 1, False, 1), (n + 3, True, 0)]
    assert D.contaminated(helpers.empty(spark), items).count() == 0
    assert D.contaminated(helpers.docs(spark, texts), items.limit(0)).count() == 0
    kept = D.clean(helpers.docs(spark, texts), items)
    assert kept.count() == len(texts) - 3 and kept.columns == helpers.docs(spark, []).columns


def test_slices_of_items(spark):
    items, texts = corpus(9)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = helpers.docs(spark, texts)
    whole = {tuple(r) for r in D.contaminated(docs, benchmark).collect()}
    assert {tuple(r) for r in D.contaminated(docs, benchmark, items_per_pass=7).collect()} == whole


def test_fewest_edits():
    rng = np.random.RandomState(0)
    for _ in range(60):
        item, words = rng.randint(4, size=rng.randint(1, 9)), rng.randint(4, size=rng.randint(1, 14))
        got = D.least_edits(words[None, :].astype(np.int64), item[None, :].astype(np.int64), np.array([len(item)]))
        assert got[0] == brute_edits(item.tolist(), words.tolist())


def test_recall_by_length_and_edits():
    rng = np.random.RandomState(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    for n in (8, 9, 10, 12, 14, 15, 17, 19, 20, 30):
        items = [[vocabulary[k] for k in rng.randint(2000, size=n)] for _ in range(150)]
        ready = D.Items(list(range(150)), [" ".join(i) for i in items], D.Walks())
        for edits in range(n // 5 + 1):
            texts = [" ".join([*vocabulary[:7], *changed(i, edits, rng, vocabulary), *vocabulary[9:17]]) for i in items]
            found = {(d, x) for d, x, *_ in D.matches([D.words_of(t) for t in texts], ready)}
            recall = sum((i, i) in found for i in range(150)) / 150
            assert recall == 1 if n < 25 else recall >= 0.97, (n, edits, recall)


def test_short_items_and_scripts_without_spaces():
    items = ["one two three", "Which planet is largest?", "世界で一番高い山は何ですか", "ประเทศไทย", "中国的首都是哪里"]
    texts = ["so: One, TWO three four", "one two thre three", "a. which planet is largest b", "問:世界で一番高い山は何ですか。答", "在ประเทศไทยครับ", "请问,中国的首城是哪里?"]
    ready = D.Items(list(range(len(items))), items, D.Walks())
    assert {(d, x) for d, x, *_ in D.matches([D.words_of(t) for t in texts], ready)} == {(0, 0), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_rows_are_judged_by_their_own_text(spark):
    item = " ".join(f"word{i}" for i in range(12))
    items = spark.createDataFrame([("first", item)], "item_id string, text string")
    rows = [(None, f"x {item} y"), (None, "clean"), ("7", item), ("7", "also clean"), ("8", None)]
    frame = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id string, text string, item_id string, id string")
    for options in ({}, {"items_per_pass": 1, "bytes_per_pass": 10}):
        kept = D.clean(frame, items, **options)
        assert kept.columns == frame.columns and {(r["doc_id"], r["text"]) for r in kept.collect()} == {(None, "clean"), ("7", "also clean"), ("8", None)}
        found = D.contaminated(frame, items, **options)
        assert sorted((str(r["doc_id"]), r["item_id"]) for r in found.collect()) == [("7", "first"), ("None", "first")]


def test_memory_of_a_piece():
    items = D.Items([1], ["one two three four five six seven eight nine ten"], D.Walks())
    batch = pa.record_batch([pa.array(["lorem ipsum dolor sit amet " * 80] * 2000)], names=["text"])
    tracemalloc.start()
    for piece in pieces([batch], "text", D.PIECE_BYTES):
        assert not D.matches([D.words_of(t) for t in piece.column(0).to_pylist()], items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
