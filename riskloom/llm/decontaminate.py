"""Benchmark passages in documents: CGK walks, bit-sampling LSH and exact edit verification.

A CGK walk reads a sequence by a random rule: at step ``j`` it writes the word under its
pointer and a random bit of (j, word) says whether the pointer moves on. Two sequences a few
edits apart meet again soon, so their edit distance turns into a Hamming distance between the
walks. A key is a sample of the steps of one walk. Walks start at every word; the walks that
start inside an item-sized window are the window's repetitions, so a document is walked once per
seed however many items and windows there are. A key that an item has at word ``o`` and a
document at word ``p`` proposes the window that begins at ``p - o``; proposals are verified by
the exact edit distance in words. Short items have few walks: an item of under 25 words that may
differ in ``e`` words is also cut into ``e + 1`` pieces, one of which must be unchanged, and the
pieces' word runs are keys as well. Still shorter items are looked up by all their words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.common import pieces, texts_of

#: Bytes of text that are searched at once; the walks of one piece take about 50 MB.
PIECE_BYTES = 1 << 20
_SEPARATORS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
#: Scripts without spaces: each character is a word (Thai, Lao, Burmese, Khmer, kana, Han); their marks separate.
_CHARACTERS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKS = re.compile("[\u3000-\u3004\u3008-\u303f\uff01-\uff0f\uff1a-\uff20]")


@dataclass(frozen=True)
class Walks:
    """``steps`` of a walk, ``sample`` steps per key, ``keys`` per walk, ``seeds`` of walks.

    With the defaults an item of ``n`` words has about ``4 (n - 8)`` keys; a test measures the
    recall at the largest allowed number of edits. ``edits``: allowed share of the item's words
    (similarity 0.8). Items of fewer than ``piece_words`` words also have keys of pieces, so that none
    within the allowed edits is missed. Items of fewer than ``least_words`` words only match exactly;
    under ``least_exact`` words they take no part.
    """

    steps: int = 12
    sample: int = 7
    keys: int = 2
    seeds: int = 2
    edits: float = 0.2
    least_words: int = 8
    piece_words: int = 25
    least_exact: int = 3

    def samples(self) -> list[list[int]]:
        return [
            sorted(np.random.RandomState(97 * i + 11).permutation(self.steps)[: self.sample].tolist())
            for i in range(self.keys)
        ]


def words_of(text: str) -> np.ndarray:
    """Word hashes of a text: lower-cased, split at everything but ASCII letters, digits and non-ASCII.

    Characters of scripts without spaces are words of their own.
    """
    if not text.isascii():
        text = _CHARACTERS.sub(r" \g<0> ", _MARKS.sub(" ", text))
    words = text.encode("utf-8", "replace").translate(_SEPARATORS).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    x = (values.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def walk_keys(words: np.ndarray, n: int, walks: Walks) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each key number: the key of every start below ``n`` and how far its walk has read.

    ``words`` must hold ``steps`` words more than ``n`` (padding counts as words).
    """
    for seed in range(walks.seeds):
        bits = _mixed(words, 1000 + seed)
        symbol = _mixed(words, seed)
        at = np.arange(n, dtype=np.int64)
        read = []
        for j in range(walks.steps):
            read.append(symbol[at])
            last = at
            at = at + ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
        for k, sample in enumerate(walks.samples()):
            key = np.full(n, 7 + seed * walks.keys + k, np.uint64)
            for j in sample:
                key = (key ^ read[j]) * np.uint64(0x9DDFEA08EB382D69)
                key ^= key >> np.uint64(33)
            yield seed * walks.keys + k, key, last


def run_keys(words: np.ndarray, n: int, size: int) -> np.ndarray:
    """The key of the ``size`` words from every start below ``n``; ``words`` must hold them."""
    symbol = _mixed(words, 5000 + size)
    key = np.full(n, 31 + size, np.uint64)
    for j in range(size):
        key = (key ^ symbol[j : j + n]) * np.uint64(0x9DDFEA08EB382D69)
        key ^= key >> np.uint64(33)
    return key


class Items:
    """Word lists and sorted walk keys of a bounded set of benchmark items."""

    BUCKETS = 1024

    def __init__(self, ids: list[int | None], texts: list[str], walks: Walks):
        self.walks = walks
        kept = [(i, w) for i, t in zip(ids, texts) if len(w := words_of(t)) >= walks.least_exact]
        self.ids, self.words = [i for i, _ in kept], [w for _, w in kept]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.limit = np.where(self.n < walks.least_words, 0, np.floor(walks.edits * self.n + 1e-9)).astype(np.int64)
        self.runs: set[int] = set()
        self.has = np.zeros((len(kept), self.BUCKETS), bool)
        keys, item, offset = [], [], []
        for x, w in enumerate(self.words):
            self.has[x, w % self.BUCKETS] = True
            if len(w) < walks.piece_words:
                parts = int(self.limit[x]) + 1
                size = len(w) // parts
                begins = np.arange(parts) * size
                self.runs.add(size)
                keys.append(run_keys(w, len(w) - size + 1, size)[begins])
                item.append(np.full(parts, x))
                offset.append(begins)
            if len(w) < walks.least_words:
                continue
            padded = np.concatenate([w, np.zeros(walks.steps, np.uint32)])
            for _, key, last in walk_keys(padded, len(w), walks):
                inside = np.flatnonzero(last < len(w))  # a walk that leaves the item has read foreign words
                keys.append(key[inside])
                item.append(np.full(len(inside), x))
                offset.append(inside)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = (np.concatenate(item) if item else np.zeros(0, np.int64))[order]
        self.offset = (np.concatenate(offset) if offset else np.zeros(0, np.int64))[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def proposals(self, words: np.ndarray, n: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different (document, item, first word of the window in ``words``); ``begins``: of documents."""
        longest, span = int(self.n.max()), n + int(self.n.max()) + 1
        found = []
        runs = (run_keys(words, n, size) for size in sorted(self.runs))
        for key in chain((key for _, key, _ in walk_keys(words, n, self.walks)), runs):
            at = np.flatnonzero(self.seen[(key >> np.uint64(42)).astype(np.int64)])
            lo, hi = np.searchsorted(self.keys, key[at], "left"), np.searchsorted(self.keys, key[at], "right")
            hits = hi - lo
            entry = np.repeat(lo - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())
            at = np.repeat(at, hits)
            doc = np.searchsorted(begins, at, "right") - 1
            found.append(np.unique((doc * len(self.n) + self.item[entry]) * span + at - self.offset[entry] + longest))
        pairs, start = np.divmod(np.unique(np.concatenate(found)), span)
        return pairs // len(self.n), pairs % len(self.n), start - longest


def least_edits(regions: np.ndarray, items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Fewest word edits that turn an item into some part of its region, row by row.

    ``regions`` and ``items`` are padded (with values that match nothing) to common widths.
    """
    width = regions.shape[1]
    ramp = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(regions), width + 1), np.int32)
    out = np.zeros(len(regions), np.int32)
    for i in range(items.shape[1]):
        step = np.empty_like(row)
        step[:, 0] = i + 1
        step[:, 1:] = np.minimum(row[:, :-1] + (regions != items[:, i : i + 1]), row[:, 1:] + 1)
        row = np.minimum.accumulate(step - ramp, axis=1) + ramp
        done = lengths == i + 1
        if done.any():
            out[done] = row[done].min(axis=1)
    return out


def matches(words: list[np.ndarray], items: Items, cells: int = 1 << 18) -> list[tuple[int, int, int, int]]:
    """(document, item, first word of the window, edits): the best window of each pair.

    A document is seen with all its words; windows that begin before or end after it are cut.
    """
    if not len(items.n):
        return []
    gap = np.zeros(items.walks.steps + 1, np.uint32)
    flat = np.concatenate([x for w in words for x in (w, gap)] or [gap])
    sizes = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(sizes + len(gap)) - sizes - len(gap)
    if not len(begins):
        return []
    doc, item, start = items.proposals(flat, len(flat) - items.walks.steps, begins)
    by_length = np.argsort(items.n[item], kind="stable")
    doc, item, start = doc[by_length], item[by_length], start[by_length]
    n, limit = items.n[item], items.limit[item]
    lo = np.maximum(start - limit, begins[doc])
    hi = np.minimum(start + n + limit, begins[doc] + sizes[doc])
    best: dict[tuple[int, int], tuple[int, int]] = {}
    i = 0
    while i < len(doc):
        part = slice(i, i + max(1, cells // int(n[i] + 2 * limit[i])))
        i = part.stop
        width = max(int((hi[part] - lo[part]).max()), 1)
        at = lo[part, None] + np.arange(width)
        inside = at < hi[part, None]
        region = flat[np.where(inside, at, 0)]
        # An item needs this many of its words in the region, whatever the order.
        shared = (items.has[item[part, None], region % Items.BUCKETS] & inside).sum(axis=1)
        good = np.flatnonzero(shared >= n[part] - limit[part])
        if not len(good):
            continue
        chosen = item[part][good]
        texts = np.full((len(good), int(n[part][good].max())), -2, np.int64)
        for row, x in enumerate(chosen):
            texts[row, : items.n[x]] = items.words[x]
        edits = least_edits(np.where(inside[good], region[good].astype(np.int64), -1), texts, n[part][good])
        for row, x, e in zip(good, chosen, edits):
            if e <= items.limit[x]:
                d = int(doc[part][row])
                value = (int(e), max(0, int(start[part][row] - begins[d])))
                best[d, int(x)] = min(best.get((d, int(x)), value), value)
    return [(d, x, first, e) for (d, x), (e, first) in sorted(best.items())]


def _slices(benchmark: DataFrame, item_id: str, item_text: str, items_per_pass: int, bytes_per_pass: int) -> Iterator[Broadcast]:
    """Items in slices bounded by number and by bytes, one broadcast each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    passes = max(-(-count // items_per_pass), -(-size // bytes_per_pass))
    for k in range(passes):
        share = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k).collect()
        yield spark.sparkContext.broadcast(([r["id"] for r in share], [r["text"] for r in share]))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", walks: Walks = Walks(), items_per_pass: int = 20_000, bytes_per_pass: int = 16 << 20,
) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, word_start, edits, item_words, similarity``.

    Works on whole texts; a document's matches are made where its row is, without a shuffle. The
    items are sent to the executors in slices of about ``items_per_pass`` items and ``bytes_per_pass``
    bytes at most, one pass over the documents for each, so no more than one slice is held in memory.
    Ids keep their types. Null texts count as empty; items and documents without words match nothing;
    repeated documents and items give repeated rows; no documents or no items give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [rows.schema["doc_id"].dataType, benchmark.schema[item_id].dataType, T.IntegerType(), T.IntegerType(), T.IntegerType(), T.DoubleType()]
    names = ["doc_id", "item_id", "word_start", "edits", "item_words", "similarity"]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    out = None
    for sent in _slices(benchmark, item_id, item_text, items_per_pass, bytes_per_pass):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ready, shape = Items(*sent.value, walks), None
            for batch in pieces(batches, "text", PIECE_BYTES):
                shape = shape or to_arrow_schema(schema)
                found = matches([words_of(t) for t in texts_of(batch, "text")], ready)
                ids = batch.column(0).take(pa.array([d for d, *_ in found], pa.int64()))
                lengths = [int(ready.n[x]) for _, x, *_ in found]
                columns = [
                    [ready.ids[x] for _, x, *_ in found], [f[2] for f in found], [f[3] for f in found], lengths,
                    [1.0 - f[3] / n for f, n in zip(found, lengths)],
                ]
                arrays = [ids.cast(shape[0].type), *[pa.array(c, field.type) for c, field in zip(columns, list(shape)[1:])]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        one = rows.mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", *, item_id: str = "item_id", item_text: str = "text",
    walks: Walks = Walks(), items_per_pass: int = 20_000, bytes_per_pass: int = 16 << 20,
) -> DataFrame:
    """The rows in whose text no item is found, with all their columns.

    Each row is judged by its own text in the pass that reads it, so ids play no part: null and
    repeated ids are like any other. One pass over the rows that are left for each slice of items.
    """
    for sent in _slices(benchmark, item_id, item_text, items_per_pass, bytes_per_pass):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ready = Items(*sent.value, walks)
            for batch in pieces(batches, text, PIECE_BYTES):
                dirty = np.zeros(batch.num_rows, bool)
                dirty[[d for d, *_ in matches([words_of(t) for t in texts_of(batch, text)], ready)]] = True
                yield batch.filter(pa.array(~dirty)) if dirty.any() else batch

        docs = docs.mapInArrow(run, docs.schema)
    return docs
