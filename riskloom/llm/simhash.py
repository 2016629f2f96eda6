"""Near duplicates by 64-bit fingerprints, a byte-position index and count filtering.

Fingerprints that differ in at most ``bits`` (3) bits share at least 8 - 3 = 5 of their 8
bytes at the same positions. The index therefore lists fingerprints under position sets of
four bytes, chosen so that any five positions contain one of the sets; a pair met in a list is
kept when its tally of equal bytes reaches five, then verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.llm.common import classes, free_name, some_texts, stored

BITS, BYTES, SEED = 3, 8, 42
LEAST = BYTES - BITS
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def covering(size: int, least: int = LEAST) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that any ``least`` positions contain one (greedy)."""
    open_sets = {frozenset(c) for c in combinations(range(BYTES), least)}
    out = []
    while open_sets:
        best = max(combinations(range(BYTES), size), key=lambda c: sum(set(c) <= s for s in open_sets))
        open_sets = {s for s in open_sets if not set(best) <= s}
        out.append(best)
    return out


def mask(positions: tuple[int, ...]) -> int:
    value = sum(255 << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def fingerprint_of(text: str | None, words_per_shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit integer; 0 for null and wordless texts."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    n = min(words_per_shingle, len(words))
    hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(n)))]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        octets = np.array(hashes[i : i + (1 << 16)], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprint(text: str | Column = "text") -> Column:
    """Majority fingerprint over 3-word shingles; lower-cases A-Z, splits at ASCII white space."""

    @F.arrow_udf(T.LongType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([fingerprint_of(t) for texts in some_texts(column) for t in texts], pa.int64())

    return run(F.col(text) if isinstance(text, str) else text)


def hex_digits(value: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def tally(a: str, b: str) -> Column:
    """Number of byte positions at which two fingerprints agree."""
    both = F.col(a).bitwiseXOR(F.col(b))
    same = F.lit(0)
    for p in range(BYTES):
        same = same + (both.bitwiseAND(F.lit(mask((p,)))) == 0).cast("int")
    return same


def linked(a: str, b: str) -> Column:
    return (tally(a, b) >= LEAST) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= BITS)


def _listed(nodes: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """One row per node and position set, under a hash of the set and its bytes."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask(s)))) for i, s in enumerate(sets)])
    return nodes.withColumn("key", F.explode(keys))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``content`` (hash of its text), ``fp`` (signed long), ``component`` (smallest id reachable).

    Equal fingerprints collapse into one node first, so a group of copies costs one node however
    large it is. Then, without ever writing all pairs of a list:

    1. every node of a list is compared with the list's smallest node; the links give classes;
    2. only lists that still hold two classes are split by five byte positions, and only nodes
       of different classes under such a key are compared.

    A pair within one class can't change the classes, so no link between different texts is
    lost. Null and empty texts have fingerprint 0 and are linked like any other; repeated ids
    keep their rows; rows with a null id get the class of their fingerprint.
    """
    content = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    prints = stored(docs.select(F.col(doc_id).alias("doc_id"), content.alias("content"), fingerprint(text).alias("fp")))
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    nodes = groups.where("node IS NOT NULL").select("fp", "node")
    index = _listed(nodes, covering(LEAST - 1))
    heads = index.groupBy("key").agg(F.min(F.struct("node", "fp")).alias("head"), F.max("node").alias("last"))
    heads = stored(heads.where("head.node < last").select("key", F.col("head.node").alias("dst"), F.col("head.fp").alias("other")))
    first = index.join(heads, "key").where((F.col("node") > F.col("dst")) & linked("fp", "other"))
    near = classes(first, "node", "dst")
    # Nodes of lists that still hold more than one class.
    member = index.join(heads.select("key"), "key").join(near, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = stored(member.select("key", "node", "fp", "root"))
    open_lists = stored(member.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key"))
    rest = member.join(open_lists, "key", "left_semi").select("node", "fp", "root").distinct()
    finer = stored(_listed(rest, covering(LEAST)))
    finer_open = finer.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    finer = stored(finer.join(stored(finer_open), "key", "left_semi").select("key", "fp", "root"))
    other = finer.select("key", F.col("fp").alias("other"), F.col("root").alias("dst"))
    second = finer.join(other, "key").where((F.col("root") < F.col("dst")) & linked("fp", "other"))
    merged = classes(second, "root", "dst").select(F.col("node").alias("root"), F.col("root").alias("top"))
    component = F.coalesce("top", "root", "node")
    place = groups.join(near, "node", "left").withColumn("root", F.coalesce("root", "node")).join(merged, "root", "left")
    place = stored(place.select("fp", component.alias("component"), "node", "copies").where("copies > 1 OR component <> node"))
    return prints.join(place.select("fp", "component"), "fp", "left").select(
        "doc_id", "content", "fp", F.coalesce("component", "doc_id").alias("component")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that have a smaller id in their class.

    Rows are judged by id and text, so a row that only shares its id with a dropped one stays. Rows
    equal in both are one document and stay or go together; rows with a null id stay.
    """
    sid, scontent = free_name(docs, "_id"), free_name(docs, "_content")
    found = near_duplicates(docs, doc_id, text).where("component < doc_id").select(F.col("doc_id").alias(sid), F.col("content").alias(scontent)).distinct()
    content = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return docs.join(found, (F.col(doc_id) == F.col(sid)) & (content == F.col(scontent)), "left_anti")
