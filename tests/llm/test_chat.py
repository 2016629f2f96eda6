"""Formatting is read back exactly; spans hold each assistant text."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, blocks string, body string, starts string"
TRICKY = ["", "\\### Assistant: </turn> ok", "#####", "</part></turn>\n### User: x", "\\\\", "\\/", "ends with \\", "ends with <", "a#b##", "é😀\n"]


def brute(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in out.items()}


@pytest.fixture(scope="module")
def rows():
    out = []
    for i, text in enumerate(TRICKY):
        out += [(i, 0, "system", "be"), (i, 1, "user", text), (i, 2, "assistant", text), (i, 3, "assistant", text + "!"), (i, 4, "user", "ok")]
    out += [(100, None, None, None), (100, 1, "a: </turn>", "odd role"), (100, 1, "assistant", "tie"), (100, 1, "assistant", "tie")]
    out += [(None, 1, "user", "no id"), (101, 0, "user", None)]
    out += [(102, i, "assistant" if i % 3 else "user", f"t{i}") for i in range(1000)]
    return [(*r, "b", "c", "d") for r in out]


def test_round_trip(spark, rows):
    made = chat.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {r["conv_id"]: r for r in made.withColumn("turns", chat.read_turns()).withColumn("loss", chat.loss_text()).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == turns
        assert got[conv]["loss"] == "".join(t for r, t in turns if r == "assistant")
        assert all(a["role"] != b["role"] for a, b in zip(got[conv]["blocks"], got[conv]["blocks"][1:]))
        spans = got[conv]["loss_spans"]
        assert len(spans) == sum(r == "assistant" for r, _ in turns)
        for s in spans:
            assert "</" not in got[conv]["formatted"][s["start"] : s["stop"]]


def test_no_rows(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, rows):
    made = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).withColumn("turns", chat.read_turns())
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 2


def test_digest_of_one_conversation(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(rows).select(F.sha2("formatted", 256).alias("h"), "formatted").first()
    assert row["formatted"] == "### User: q</turn>\n### Assistant: a</turn>\n"
    assert row["h"] == hashlib.sha256(row["formatted"].encode()).hexdigest()
