"""Secret scans with Spark expressions only: spans by pattern, verdicts by ownership in the corpus.

Candidate values are hashed, and for each hash the corpus tells how many repositories and
owners hold it. A value in the hands of one owner looks live, all the more if only one of the owner's
repositories holds it; one that several owners hold is a copied example.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import free_name, stored

#: Fixed patterns of the base kinds, in their order; a match counts when the group is long enough.
BASE = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Candidates of the ownership method are long tokens with letters and digits. What masks texts can ask for more:
#: letters and digits that change places several times (``RANDOM``) within one segment, which spares paths, slugs,
#: version numbers and UUIDs.
TOKEN = ("token", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
LETTER, DIGIT = "[A-Za-z]", "[0-9]"
RANDOM = "(?:[A-Za-z][0-9]+){2}[A-Za-z]|(?:[0-9][A-Za-z]+){2}[0-9]"
UUID = "^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
OWNED = "owned"
KINDS = [*BASE, OWNED]
_SPAN = "array<struct<start:bigint,stop:bigint,value:string>>"
#: Parts into which the rows of one hash are dealt.
SALTS = 32


def found(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans (code points, end exclusive) of a pattern's matches with ``least`` characters in ``group``.

    The text between matches and the matches alternate, so positions are sums of lengths.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(a: Column, z: Column) -> Column:
        begin = a["at"] + F.length(z["gap"])
        stop = begin + F.coalesce(F.length(z["whole"]), F.lit(0))
        keep = F.coalesce(F.length(z["value"]), F.lit(0)) >= least
        span = F.struct(begin.alias("start"), stop.alias("stop"), z["value"].alias("value"))
        return F.struct(stop.alias("at"), F.when(keep, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step, lambda a: a["out"])).otherwise(F.array().cast(_SPAN))


def rendered(spans: Column) -> Column:
    """``kind:start:stop`` by start, then kind in its order, comma-joined."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def kind_spans(name: str, spans: str | Column) -> Column:
    column = F.col(spans) if isinstance(spans, str) else spans
    return F.transform(column, lambda s: F.struct(F.lit(KINDS.index(name)).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))


def mixed(value: Column) -> Column:
    """Whether a token has both letters and digits."""
    return value.rlike(DIGIT) & value.rlike(LETTER)


def candidate(value: Column) -> Column:
    """Whether a token looks drawn at random rather than spelled."""
    return value.rlike(RANDOM) & ~value.rlike(UUID)


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, repositories, owners, copied, shared`` of candidate rows ``hash, repository, owner``.

    Distinct counts by repeated grouping: every step adds up inside the tasks first, so a value
    that is everywhere stays a few rows per task and no set of owners is ever held. A null owner
    counts as one owner, a null repository as one repository. ``copied``: more than one owner;
    ``shared``: one owner, more than one of its repositories.
    """
    pairs = candidates.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    counted = owners.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    copied = F.col("owners") > 1
    return counted.withColumns({"copied": copied, "shared": ~copied & (F.col("repositories") > 1)})


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str | Column = "source",
    owner: str | Column = "source", candidates: Callable[[Column], Column] = candidate,
) -> DataFrame:
    """One row per document: ``doc_id``, the base spans and the owned spans, without texts.

    ``base`` and ``owned`` are arrays of ``kind, start, stop`` (kind: place in ``KINDS``);
    ``n_candidates``, ``n_copied`` and ``n_shared`` count the candidates, those copied between owners
    and those that one owner keeps in several repositories. ``candidates`` says which long tokens are
    judged (``mixed``: all with letters and digits). Base spans never depend on the verdict.
    Null texts are empty; equal rows each have their own result. The texts are read once: spans and
    hashes of values are stored, values never leave their task.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), column(repository).cast("string").alias("repository"),
        column(owner).cast("string").alias("owner"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    _, *token = TOKEN
    judged = F.filter(found(F.col("text"), *token), lambda s: candidates(s["value"]))
    hashed = F.transform(judged, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.xxhash64(s["value"], F.sha2(s["value"], 256)).alias("hash")))
    base = F.concat(*[kind_spans(k, found(F.col("text"), *p)) for k, p in BASE.items()])
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "repository", "owner", F.xxhash64("text").alias("content"),
        base.alias("base"), hashed.alias("mixed"),
    )
    rows = stored(rows, "spans")
    single = rows.select("row", "repository", "owner", F.explode("mixed").alias("s")).select("row", "repository", "owner", "s.start", "s.stop", "s.hash")
    known = ownership(single).where("copied OR shared").select("hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "copied", "shared")
    single = single.select("row", "start", "stop", "hash", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int").alias("salt"))
    judged = single.join(known, ["hash", "salt"], "left")
    marks = judged.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count_if("copied").alias("n_copied"), F.count_if("shared").alias("n_shared"),
        F.collect_set(F.when(~F.coalesce("copied", F.lit(False)), F.struct(F.lit(KINDS.index(OWNED)).alias("kind"), F.col("start"), F.col("stop")))).alias("owned"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(marks, "row", "left").select(
        "doc_id", "content", "base", F.coalesce("owned", F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>")).alias("owned"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_candidates", "n_copied", "n_shared")],
    )


def redact(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str | Column = "source",
    owner: str | Column = "source", mask: str = "[secret]",
) -> DataFrame:
    """All rows and columns; every base and owned span of ``text`` is replaced by ``mask``.

    Overlapping spans become one. Texts without spans, and null texts, stay as they are. Spans are
    found again by id and content, so rows that share an id keep their own.
    """
    sid, scontent, held = (free_name(docs, n) for n in ("_id", "_content", "_spans"))
    both = F.transform(F.concat("base", "owned"), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    spans = scan(docs, doc_id, text, repository, owner).select(
        F.col("doc_id").alias(sid), F.col("content").alias(scontent), F.sort_array(both).alias(held)
    ).where(F.size(held) > 0).dropDuplicates([sid, scontent])
    content = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    joined = docs.join(spans, F.col(doc_id).eqNullSafe(F.col(sid)) & (content == F.col(scontent)), "left")
    value = F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        clear = F.substring(value, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        fresh = s["start"] >= a["at"]
        added = F.when(fresh, F.concat(a["out"], F.array(clear, F.lit(mask)))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), added.alias("out"))

    pieces = F.aggregate(held, start, step, lambda a: F.concat(a["out"], F.array(F.substring(value, (a["at"] + 1).cast("int"), F.length(value)))))
    return joined.withColumn(text, F.when(F.col(held).isNull(), value).otherwise(F.array_join(pieces, ""))).select(*docs.columns)
