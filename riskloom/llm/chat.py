"""Chat formatting with Spark expressions only.

Turns are collected per conversation, sorted, and runs of one role merged into a block:

    ### Assistant: first text</part>second text</turn>

Inside texts ``\\`` becomes ``\\\\``, ``</`` becomes ``<\\/`` and ``#`` before ``##`` becomes
``#\\``. So neither ``###`` nor ``</`` can come from a text, and removing the backslashes that
stand before ``\\``, ``/`` or ``#`` gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN_END, PART_END, OPEN, COLON = "</turn>\n", "</part>", "### ", ": "
#: Roles with a plain label; any other role is written as = and its URL encoding.
LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_RUN = 256


def escaped(text: Column) -> Column:
    out = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(F.regexp_replace(out, "</", r"<\\/"), "#(?=##)", r"#\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\/#])", "$1")


def role_label(role: Column) -> Column:
    out = F.concat(F.lit("="), F.url_encode(role))
    for name, label in LABELS.items():
        out = F.when(role == name, label).otherwise(out)
    return out


def label_role(label: Column) -> Column:
    out = F.url_decode(F.substring(label, F.lit(2), F.length(label)))
    for name, written in LABELS.items():
        out = F.when(label == written, name).otherwise(out)
    return out


def _before(sizes: Column) -> Column:
    """For each value the sum of those before it: by runs of values, so the work stays linear."""
    none = F.array().cast("array<long>")

    def running(values: Column) -> Column:
        grown = F.aggregate(
            values, F.struct(F.lit(0).cast("long").alias("sum"), none.alias("out")),
            lambda a, v: F.struct((a["sum"] + v).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out")),
        )
        return grown["out"]

    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(sizes) - 1) / _RUN).cast("int"))),
        lambda k: F.slice(sizes, k * _RUN + 1, F.lit(_RUN)),
    )
    begins = running(F.transform(runs, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda a, v: a + v)))
    return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), begins.alias("begin")), lambda z: F.transform(running(z["run"]), lambda v: v + z["begin"])))


def format_chats(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id, blocks, formatted, loss_spans``.

    ``blocks``: merged turns (``role, texts``); ``formatted``: the text; ``loss_spans``: ``start,
    stop`` (code points, end exclusive) of every escaped text of ``loss_role``. Null texts and
    roles are empty, ties in ``turn`` are ordered by role and text, null turns come first,
    repeated rows stay, rows with a null conversation form one. Rows meet once, by conversation;
    other columns are not read.
    """
    turns = rows.select(
        F.col(conv_id).alias("conv_id"), F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("starts", starts)
    block = F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.transform(
            F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s), lambda t: t["text"]
        ).alias("texts"),
    ))
    chats = chats.select("conv_id", block.alias("blocks"))
    # Each block as head, escaped texts; positions follow from the lengths of what is written.
    written = F.transform("blocks", lambda b: F.struct(
        F.concat(F.lit(OPEN), role_label(b["role"]), F.lit(COLON)).alias("head"),
        F.transform(b["texts"], escaped).alias("texts"), (b["role"] == loss_role).alias("loss"),
    ))
    chats = chats.withColumn("written", written)
    body = F.transform("written", lambda w: F.concat(w["head"], F.array_join(w["texts"], PART_END), F.lit(TURN_END)))
    chats = chats.withColumn("body", body)
    begin = _before(F.transform("body", lambda b: F.length(b).cast("long")))
    spans = F.transform(F.arrays_zip(F.col("written").alias("w"), begin.alias("begin")), lambda z: F.when(
        z["w"]["loss"], F.transform(
            F.arrays_zip(
                z["w"]["texts"].alias("text"),
                _before(F.transform(z["w"]["texts"], lambda t: (F.length(t) + len(PART_END)).cast("long"))).alias("at"),
            ),
            lambda p: F.struct(
                (z["begin"] + F.length(z["w"]["head"]) + p["at"]).alias("start"),
                (z["begin"] + F.length(z["w"]["head"]) + p["at"] + F.length(p["text"])).alias("stop"),
            ),
        )
    ).otherwise(F.array().cast("array<struct<start:bigint,stop:bigint>>")))
    return chats.select("conv_id", "blocks", F.array_join("body", "").alias("formatted"), F.flatten(spans).alias("loss_spans"))


def read_turns(formatted: str | Column = "formatted") -> Column:
    """Array of ``role, text`` of every turn, read from a formatted text."""
    column = F.col(formatted) if isinstance(formatted, str) else formatted
    blocks = F.split(column, TURN_END)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def parts(block: Column) -> Column:
        colon = F.locate(COLON, block)
        label = F.substring(block, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        texts = F.split(F.substring(block, colon + len(COLON), F.length(block)), PART_END)
        return F.transform(texts, lambda t: F.struct(label_role(label).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, parts))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    piece = F.transform(spans, lambda s: unescaped(F.substring(F.col(formatted), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return F.array_join(piece, "")
