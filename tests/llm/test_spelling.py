"""Spelling variants equal a comparison of all words."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import queries, spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    near = {w: [u for u in counts if one_edit(w, u)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def check(spark, counts: dict[str, int]) -> set[tuple]:
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = [tuple(r) for r in spelling.variants(frame).collect()]
    assert len(got) == len(counts) and set(got) == brute(counts)
    return set(got)


def test_random_words_and_their_variants(spark):
    rng = np.random.RandomState(3)
    letters = "abcé"
    words = {"".join(rng.choice(list(letters), rng.randint(7, 11))) for _ in range(150)}
    for w in list(words):
        i, c = rng.randint(len(w)), rng.choice(list(letters))
        words |= {w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]}
    counts = {w: int(2 * 10 ** rng.randint(4)) for w in words}
    assert any(f and r != f for _, f, r, *_ in check(spark, counts))


def test_runs_of_one_letter_and_long_words(spark):
    counts = {"a" * n: 2 * 10 ** (n % 3) for n in range(7, 30)} | {"b" * i + "a" + "b" * (9 - i): 2 + i for i in range(10)}
    long = "xyz" * 100
    counts |= {long: 500, long[:150] + "q" + long[150:]: 3, long[1:]: 2, long + "é": 2, "q" + long[1:]: 7}
    check(spark, counts)
    check(spark, {"w" * 20_000: 2, "w" * 20_000 + "v": 40})


def test_ties_and_chains(spark):
    got = check(spark, {"abcdefg": 2, "abcdefh": 20, "abcdefi": 20, "abcdexh": 200, "abcdéfg": 2, "zzzzzzzz": 9})
    assert ("abcdefg", "abcdefh", "abcdexh", 2, 3, 20) in got


def test_empty_and_null(spark):
    nothing = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(nothing).collect() == [] and spelling.neighbours(nothing).collect() == []
    some = spark.createDataFrame([(None, 5), ("abcdefgh", 2)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(some).collect()] == [("abcdefgh", None, "abcdefgh", 2, 0, None)]


def test_counts_of_runs(spark):
    texts = [None, "", "short Words", "Wörtliche wörtliche WÖRTLICHE!", "dreißig×dreißig ÷", "straße42straßen straßen", "x" * 50_000, "x" * 50_000, "日本語テキスト日本語"]
    docs = spark.createDataFrame([(t, "w", 1) for t in texts], "text string, word string, n long")
    got = spelling.counted(docs.select(F.explode(spelling.runs(F.col("text"))).alias("run")).select(spelling.lowered(F.col("run")).alias("word")))
    assert {(r.word, r.n) for r in got.collect()} == {("wörtliche", 2), ("straßen", 2), ("x" * 50_000, 2)}


def test_query_over_a_table(spark, tmp_path):
    rng = np.random.RandomState(5)
    words = ["".join(rng.choice(list("abcdé"), 9)) for _ in range(12)]
    rows = [(None if i == 7 else i % 90, None if i == 3 else " ".join(rng.choice(words, 40)) + " Ünderung") for i in range(100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for i, text in rows:
        for run in (text or "").split():
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    wanted = brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})
    assert {tuple(r) for r in queries.QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()} == wanted
