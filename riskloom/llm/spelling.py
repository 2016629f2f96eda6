"""Spelling variants by a trie frontier: words one edit apart meet on the edges of a distributed trie.

The trie is a table of edges: (node, character, child, words below, the only word's hash where there
is one, the characters that may follow at the next places). A node is a prefix, known by its hash and
depth; an edge with an empty character marks the end of a word. A frontier of (word, position, node,
edits) states is joined with the edges level by level; a state without edits may follow its own
character, replace it by a larger one or insert the edge's character; a state with one edit must
follow its own characters. So every pair is met from one side, the shorter word or the smaller
character, and then turned round.

The edit lies in the second half of a word or in the second half of the reversed word, so there is
a second trie of reversed words, and a state starts at the middle of its word, where nodes are many and have
few edges. An edge with one word below it ends at once: the state's rewritten word either is that word
or nothing. Other states only move on if their next characters may follow the edge.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import stored
from riskloom.session import scratch_path

#: Levels from this depth on are taken in one round; places behind an edge whose characters it knows.
DEEP, AHEAD = 48, 3
UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))


def runs(text: Column, least: int = 7) -> Column:
    """Maximal runs of Latin letters with ``least`` code points or more; none for null texts."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0)), F.array().cast("array<string>"))


def lowered(text: Column) -> Column:
    """A to Z in lower case; every other letter as it is."""
    return F.when(text.rlike("[A-Z]"), F.translate(text, UPPER, LOWER)).otherwise(text)


def counted(words: DataFrame, word: str = "word", least_chars: int = 7, least_uses: int = 2) -> DataFrame:
    """``word, n`` of the words with enough code points and uses; counts are added up before the shuffle."""
    rows = words.select(F.col(word).alias("word")).where(F.length("word") >= least_chars)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_uses)


def _oriented(words: DataFrame) -> DataFrame:
    """Every word as it is (``side`` 0) and reversed (1), with its length and the depth where its states start."""
    both = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("s")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("s")))
    rows = words.select(F.inline(both)).withColumn("size", F.length("s"))
    half = F.floor(F.col("size") / 2).cast("int")
    return rows.withColumn("start", F.when(F.col("side") == 0, half).otherwise(F.col("size") - half))


def _node(depth: Column) -> Column:
    return F.xxhash64("side", F.substring(F.col("s"), F.lit(1), depth))


def _trie(rows: DataFrame) -> DataFrame:
    """Edges ``depth, node, letter, child, below, only, f0, f1, ...`` (masks of the characters that follow).

    A word of ``m`` characters can only be met by states of words up to one shorter, so it needs
    no edges above the middle of such a word.
    """
    first = F.floor((F.col("size") - 1) / 2).cast("int")
    steps = rows.select("side", "s", "size", F.xxhash64("s").alias("hash"), F.explode(F.sequence(first, F.col("size"))).alias("depth"))
    letter = F.substring(F.col("s"), F.col("depth") + 1, F.lit(1))
    child = F.when(F.col("depth") < F.col("size"), _node(F.col("depth") + 1))
    follow = {f"f{k}": _mask(F.substring(F.col("s"), F.col("depth") + 2 + k, F.lit(1))) for k in range(AHEAD)}
    steps = steps.select("depth", _node(F.col("depth")).alias("node"), letter.alias("letter"), child.alias("child"), "hash", *[c.alias(n) for n, c in follow.items()])
    return steps.groupBy("depth", "node", "letter", "child").agg(
        F.count(F.lit(1)).alias("below"), F.min("hash").alias("only"), *[F.bit_or(n).alias(n) for n in follow]
    )


def _mask(letter: Column) -> Column:
    """A 64-bit mask with the letter's bit; the empty letter behind a word has one as well."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(letter).bitwiseAND(F.lit(63)).cast("int"))


def _by_depth(df: DataFrame, name: str, depth: str) -> DataFrame:
    """Stored in folders by depth (one for all deep rows), so a level reads its own rows only."""
    path = scratch_path(df.sparkSession, name)
    level = F.least(F.col(depth), F.lit(DEEP)).alias("level")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.select("*", level).repartition("level", F.pmod(F.xxhash64("node"), F.lit(parts))).write.partitionBy("level").parquet(path)
    return df.sparkSession.read.schema(df.schema.add("level", "integer")).parquet(path)


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: states ``side, s, size, depth, at, node, made`` moved over all edges of their nodes.

    ``made`` is the word after the edit, null before it; ``met``: true where it is a word of the
    trie. Edges that lead to the state's own word only are left out.
    """
    # The bits of a state's characters from its place on, computed before the edges multiply it.
    bits = {f"b{k}": _mask(F.substring(F.col("s"), F.col("at") + 1 + k, F.lit(1))) for k in range(AHEAD + 1)}
    moves = states.withColumns({**bits, "own": F.substring(F.col("s"), F.col("at") + 1, F.lit(1))}).join(edges, ["depth", "node"])
    letter, size, depth, own = (F.col(c) for c in ("letter", "size", "depth", "own"))

    def follows(skipped: int) -> Column:
        """The characters behind the first ``skipped`` ones may follow the edge."""
        fits = F.lit(True)
        for k in range(AHEAD):
            fits = fits & (F.col(f"f{k}").bitwiseAND(F.col(f"b{skipped + k}")) != 0)
        return fits

    head, tail = F.substring(F.col("s"), F.lit(1), depth), F.substring(F.col("s"), depth + 1, size)
    rest = F.substring(F.col("s"), depth + 2, size)
    fresh, inside, single, ended = F.col("made").isNull(), F.col("at") < size, F.col("below") == 1, letter == ""
    # A character inserted into a run of its kind counts behind the run; in the middle of the word for one side only.
    other = fresh & (letter != own) & ~ended
    middle = (F.col("side") == 1) & (depth == size - F.floor(size / 2))
    moves = moves.withColumns({
        "walk": fresh & inside & (letter == own) & ~single, "keep": ~fresh & (letter == own) & follows(1), "change": other & inside & (letter > own) & follows(1),
        "add": other & ~middle & follows(0),
    }).where("walk OR keep OR change OR add")
    move = lambda when, made, to: F.when(F.col(when), F.struct(made.cast("string").alias("made"), to.cast("int").alias("to")))
    options = F.array(
        move("walk", F.lit(None), F.col("at") + 1), move("keep", F.col("made"), F.col("at") + 1),
        move("change", F.concat(head, letter, rest), F.col("at") + 1), move("add", F.concat(head, letter, tail), F.col("at")),
    )
    moved = moves.withColumn("o", F.explode(options)).where(F.col("o").isNotNull())
    made = F.col("o.made")
    met = made.isNotNull() & (ended | (single & (F.col("only") == F.xxhash64(made))))
    return moved.where(met | (~single & ~ended)).select(
        "side", "s", "size", (depth + 1).alias("depth"), F.col("o.to").alias("at"), F.col("child").alias("node"), made.alias("made"), met.alias("met")
    )


def neighbours(counts: DataFrame) -> DataFrame:
    """``word, near, near_n``: both directions of every pair of different words one edit apart.

    ``counts``: distinct words with their ``n``. The rounds are the longest prefix that two words share
    beyond the middle of one of them, but not more than ``DEEP``: deeper down one round takes the
    unedited states of all levels at once, and the words they are rewritten to are looked up whole.
    Hashes only ever add candidates; a met word is looked up among the words as text.
    """
    spark = counts.sparkSession
    rows = _oriented(counts)
    edges = _by_depth(_trie(rows), "trie", "depth")
    begin = rows.select("side", "s", "size", F.col("start").alias("depth"), _node(F.col("start")).alias("node"))
    begin = _by_depth(begin.where(F.col("depth") < DEEP), "starts", "depth")
    depths = sorted(r[0] for r in edges.where(F.col("level") < DEEP).select("level").distinct().collect())
    begins = {r[0] for r in begin.select("level").distinct().collect()}
    fresh = {"at": F.col("depth"), "made": F.lit(None).cast("string")}
    deep = rows.where(F.col("size") >= DEEP).withColumn("depth", F.explode(F.sequence(F.greatest("start", F.lit(DEEP)), F.col("size"))))
    deep = deep.select("side", "s", "size", "depth", _node(F.col("depth")).alias("node")).withColumns(fresh)
    states, found = None, [_step(deep, edges.where(F.col("level") == DEEP).drop("level")).where("made IS NOT NULL").select("side", "s", "made")]
    for depth in depths:
        if depth in begins:
            new = begin.where(F.col("level") == depth).drop("level").withColumns(fresh)
            states = new if states is None else states.unionByName(new)
        if states is None:
            continue
        step = stored(_step(states, edges.where(F.col("level") == depth).drop("level")), "frontier")
        done = F.col("met") if depth + 1 < DEEP else F.col("made").isNotNull()
        found.append(step.where(done).select("side", "s", "made"))
        states = step.where("NOT met").drop("met")
        if states.isEmpty():
            states = None
    turned = lambda c: F.when(F.col("side") == 0, F.col(c)).otherwise(F.reverse(c))
    pairs = reduce(DataFrame.unionByName, found).select(turned("s").alias("word"), turned("made").alias("near"))
    pairs = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))
    real = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.join(real, "near").repartition("word").groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` of rows ``word, form``: forms followed to the last by doubling pointers.

    A chain has at most ``most`` forms, so the rounds are its logarithm.
    """
    out = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max(1, math.ceil(math.log2(max(most, 1) + 1)))):
        onward = out.select(F.col("word").alias("root"), F.col("root").alias("far"))
        out = stored(out.join(onward, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "forms")
    return out


def variants(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table ``word, n`` of distinct words.

    Near words differ by one inserted, deleted or replaced code point. The form is the near word
    of largest ``n`` (ties: the smallest in code-point order) if that is at least ``ratio`` times the
    word's ``n``, else null; the root follows forms to the last. Null words are left out; no words,
    no rows.
    """
    counts = stored(counts.where("word IS NOT NULL").select("word", "n"), "words")
    best = neighbours(counts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("b"))
    joined = counts.join(best, "word", "left")
    chosen = -F.col("b.less") >= ratio * F.col("n")
    rows = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("b.near")).alias("form"), F.when(chosen, -F.col("b.less")).alias("form_n"),
    ), "variants")
    largest = rows.agg(F.max("n")).first()[0] or 1
    ends = roots(rows.where("form IS NOT NULL"), math.ceil(math.log(largest, ratio)) + 1 if ratio > 1 else 63)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
