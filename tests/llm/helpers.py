"""Small tables with the awkward cases, and brute-force twins."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, key string, fp string, language string, _spans string, toxicity string, decoded string"

LONG = "word " * 30_000 + "end"


def docs(spark, texts, first: int = 0):
    """Documents with nulls in other columns and with extra columns whose names operators use."""
    rows = [
        (first + i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"src{i % 2}", None, "x", "k", "f", "l", "s", "t", "d")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


AWKWARD = [None, "", " \n\t ", "a", "Wort für Wort.", "Wort für Wort.", "Wort für Wort.", "12 34 !!", "日本語 テキスト 😀", LONG, "x" * 70_000, "é é <|endoftext|>"]
