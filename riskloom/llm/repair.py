"""Token ids in shards compressed with a Re-Pair grammar.

A shard holds whole documents. Pairs of neighbouring ids that occur often enough become
nonterminals, again and again, until no pair does. Stored are the rules, the number of ids each
nonterminal expands to, the remaining symbols and a table of documents, so one document can be
decoded without the others. Pairs never cross the end of a document.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.bpe import worker_encoder
from riskloom.llm.common import WHITE_SPACE, pieces
from riskloom.session import scratch_path

#: Ids per shard (a longer document has a shard of its own), the least uses of a new rule.
SHARD_IDS, LEAST_USES = 1 << 20, 16
MAGIC = b"RPG1"
LAYOUT = "part int, shard int, inside long, n_ids long, data binary"
_HEAD = struct.Struct("<4sIIQI")
_WORD = re.compile(f"[^{WHITE_SPACE}]+")
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("symbol", "<u8"), ("start", "<u8"), ("n", "<u8")])


def _frequent(
    keys: np.ndarray, usable: np.ndarray | slice, least: int, turn: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that occur ``least`` times or more; for each usable key the place of its pair there, its count and whether it may have one.

    Pairs are looked up in a table with one pair per hash bucket, the most frequent one; the
    others of the bucket wait for a turn with another hash. The count is 0 where none is found; a key
    in a bucket without pairs is not frequent.
    """
    keys = keys[usable]
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(ordered)))
    often = counts >= least
    pairs, counts = ordered[starts[often]], counts[often]
    if not len(pairs):
        return pairs, np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32), np.zeros(len(keys), bool)
    by_count = np.argsort(counts, kind="stable")
    pairs, counts = pairs[by_count], counts[by_count].astype(np.int32)
    factor, shift = np.uint64(0x9E3779B97F4A7C15 + 2 * turn), np.uint64(47)
    table = np.full(1 << 17, -1, np.int32)
    table[(pairs * factor) >> shift] = np.arange(len(pairs))
    place = table[(keys * factor) >> shift]
    return pairs, place, np.where((pairs[place] == keys) & (place >= 0), counts[place], 0), place >= 0


def compress(
    ids: np.ndarray, first: int, end: int, least: int = LEAST_USES
) -> tuple[np.ndarray, np.ndarray]:
    """Rules (pairs, the k-th standing for ``first + k``) and the remaining symbols.

    In each round every frequent pair that is not beaten by an overlapping neighbour (by count)
    is replaced, from left to right where counts are equal. Rounds end when no pair has ``least`` uses.
    Old pairs only lose uses and new ones hold a new symbol, so a round looks at the positions that were
    frequent in the round before and at those beside a new symbol.
    """
    symbols, rules, made = ids.astype(np.uint32), [], 0
    live = np.ones(max(len(symbols) - 1, 0), bool)
    while len(symbols) > 1:
        left, right = symbols[:-1], symbols[1:]
        at = np.flatnonzero(live & (left != end) & (right != end))
        keys = (left[at].astype(np.uint64) << np.uint64(32)) | right[at]
        pairs, place, uses, hopeful = _frequent(keys, slice(None), least, len(rules))
        if not len(pairs):
            break
        # Frequent positions, each with its neighbours' counts (0 where they are not frequent).
        known = uses > 0
        spot, place, uses = at[known], place[known], uses[known]
        near = np.diff(spot) == 1
        best = np.ones(len(spot), bool)
        best[1:] &= ~near | (uses[1:] >= uses[:-1])
        best[:-1] &= ~near | (uses[:-1] >= uses[1:])
        chosen = _apart(spot[best])
        place = place[np.searchsorted(spot, chosen)]
        used = np.zeros(len(pairs), bool)
        used[place] = True
        number = np.cumsum(used) - 1
        new = pairs[used]
        rules.append(np.stack([new >> np.uint64(32), new & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        symbols = symbols.copy()
        symbols[chosen] = (first + made + number[place]).astype(np.uint32)
        live = np.zeros(len(symbols), bool)
        live[at[hopeful]] = True
        live[chosen] = True
        live[np.maximum(chosen - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols, live, made = symbols[keep], live[keep][:-1], made + len(new)
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)), symbols


def _apart(positions: np.ndarray) -> np.ndarray:
    """Positions without those right after a kept one."""
    if not len(positions):
        return positions
    starts = np.concatenate([[True], np.diff(positions) != 1])
    run_start = np.maximum.accumulate(np.where(starts, np.arange(len(positions)), 0))
    return positions[(np.arange(len(positions)) - run_start) % 2 == 0]


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Number of ids each nonterminal expands to."""
    lengths = np.ones(len(rules), np.uint64)
    depth = np.full(len(rules), -1)
    while (depth < 0).any():
        open_rules = depth < 0
        side = [np.where(rules[:, s] < first, 0, depth[np.maximum(rules[:, s].astype(np.int64) - first, 0)]) for s in (0, 1)]
        ready = open_rules & (side[0] >= 0) & (side[1] >= 0)
        for s in (0, 1):
            inner = np.maximum(rules[ready, s].astype(np.int64) - first, 0)
            part = np.where(rules[ready, s] < first, 1, lengths[inner]).astype(np.uint64)
            lengths[ready] = part if s == 0 else lengths[ready] + part
        depth[ready] = 1
    return lengths


def symbol_sizes(symbols: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """Number of ids of each symbol."""
    sizes = np.ones(len(symbols), np.int64)
    nested = symbols >= first
    sizes[nested] = lengths[symbols[nested].astype(np.int64) - first]
    return sizes


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for: one level of rules at a time."""
    out = symbols.astype(np.uint32)
    while len(out) and (out >= first).any():
        nested = out >= first
        pair = rules[out[nested].astype(np.int64) - first]
        place = np.cumsum(nested.astype(np.int64) + 1) - 1
        longer = np.empty(len(out) + int(nested.sum()), np.uint32)
        longer[place[~nested]] = out[~nested]
        longer[place[nested] - 1], longer[place[nested]] = pair[:, 0], pair[:, 1]
        out = longer
    return out


def to_bytes(doc_ids: list[int | None], parts: list[bytes], first: int, end: int) -> bytes:
    """One shard as bytes; ``parts``: each document's ids with the end id."""
    ids = np.frombuffer(b"".join(parts), "<u4")
    rules, symbols = compress(ids, first, end)
    docs = np.zeros(len(parts), _DOC)
    docs["doc_id"], docs["known"] = [0 if d is None else d for d in doc_ids], [d is not None for d in doc_ids]
    docs["n"] = [len(p) // 4 for p in parts]
    docs["start"] = np.cumsum(docs["n"]) - docs["n"]
    lengths = expansion_lengths(rules, first)
    docs["symbol"] = np.searchsorted(np.cumsum(symbol_sizes(symbols, lengths, first)), docs["start"].astype(np.int64), "right")
    head = _HEAD.pack(MAGIC, first, len(rules), len(symbols), len(docs))
    body = (rules.astype("<u4"), lengths.astype("<u8"), symbols.astype("<u4"), docs)
    return head + b"".join(x.tobytes() for x in body)


class Shard:
    """Reader of one shard."""

    def __init__(self, data: bytes):
        magic, self.first, n_rules, n_symbols, n_docs = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.rules = np.frombuffer(data, "<u4", 2 * n_rules, at).reshape(-1, 2)
        self.lengths = np.frombuffer(data, "<u8", n_rules, at := at + 8 * n_rules)
        self.symbols = np.frombuffer(data, "<u4", n_symbols, at := at + 8 * n_rules)
        self.docs = np.frombuffer(data, _DOC, n_docs, at + 4 * n_symbols)

    def all_ids(self) -> np.ndarray:
        """All ids: each rule is expanded once, then ids are gathered by symbol.

        A rule has 16 uses or more, so a round's rules expand to a sixteenth of the ids at most.
        """
        rules = expand(self.first + np.arange(len(self.rules)), self.rules, self.first)
        table = np.concatenate([np.arange(self.first, dtype=np.uint32), rules])
        lengths = self.lengths.astype(np.int64)
        begins = np.concatenate([np.arange(self.first), self.first + np.cumsum(lengths) - lengths])
        sizes = symbol_sizes(self.symbols, lengths, self.first)
        ends = np.cumsum(sizes)
        at = np.repeat(begins[self.symbols] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return table[at]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own symbols only."""
        stop = int(self.docs["symbol"][k + 1]) if k + 1 < len(self.docs) else len(self.symbols)
        return expand(self.symbols[int(self.docs["symbol"][k]) : stop], self.rules, self.first)

    def ids_between(self, start: int, stop: int) -> np.ndarray:
        """Ids at positions of the shard; the lengths tell which symbols to expand."""
        ends = np.cumsum(symbol_sizes(self.symbols, self.lengths, self.first))
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return expand(self.symbols[a:b], self.rules, self.first)[start - skipped : stop - skipped]


def write(
    docs: DataFrame, vocabulary: str, path: str, *, end: int, doc_id: str = "doc_id", text: str = "text",
    partitions: int | None = None, shard_ids: int = SHARD_IDS,
) -> None:
    """Encode all documents in ascending order of id and store them as shards.

    The texts are range-partitioned by id once; each task then encodes, compresses and emits its
    shards, which Spark writes (and commits) as Parquet rows (``LAYOUT``), so any
    store will do and a lost executor costs one task. Null texts are empty, null ids come first,
    rows with the same id follow each other by text. No rows give an empty table.
    """
    spark = docs.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_encoder(vocabulary, _WORD, fold=True)
        first = encoder.tokenizer.get_vocab_size(with_added_tokens=True)
        part, shard = TaskContext.get().partitionId(), 0
        names, parts, held, inside = [], [], 0, 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                 "inside": pa.array([inside], pa.int64()), "n_ids": pa.array([held], pa.int64()),
                 "data": pa.array([to_bytes(names, parts, first, end)], pa.binary())}
            )

        for batch in pieces(batches, "text", 8 << 20):
            flat, counts = encoder.encode_words(batch.column(1))
            ends = np.cumsum(counts)
            # Each document's ids with the end id behind them.
            coded = memoryview(np.insert(flat, ends, end).astype("<u4").tobytes())
            stops = (ends + np.arange(1, len(ends) + 1)).tolist()
            for name, lo, hi in zip(batch.column(0).to_pylist(), [0, *stops], stops):
                names.append(name)
                parts.append(coded[4 * lo : 4 * hi])
                held += hi - lo
                if held >= shard_ids:
                    yield packed()
                    names, parts, held, shard, inside = [], [], 0, shard + 1, inside + held
        if names:
            yield packed()

    rows.mapInArrow(run, LAYOUT).write.mode("overwrite").parquet(path)


def read(spark, path: str) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32``, decoded from the shards.

    ``start`` counts the ids of all documents before: those of earlier parts (one total per part
    is summed up in one task), of earlier shards of the part (stored) and of the shard.
    """
    shards = spark.read.schema(LAYOUT).parquet(path)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before")
    )
    # One row per partition of the writing job: a bound that doesn't grow with the rows.
    starts = shards.join(F.broadcast(totals), "part").select((F.col("inside") + F.col("before")).alias("begin"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(data.as_py())
                ids, docs = shard.all_ids().astype("<u4"), shard.docs
                raw = memoryview(ids.tobytes())
                spans = zip(docs["start"].tolist(), docs["n"].tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs["doc_id"], mask=docs["known"] == 0), pa.array((docs["start"] + np.uint64(begin)).astype(np.int64)),
                     pa.array(docs["n"].astype(np.int64)), pa.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in spans], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return starts.mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(docs: DataFrame, vocabulary: str, *, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write to a fresh folder of the shared directory and read the documents back."""
    path = scratch_path(docs.sparkSession, "token-shards")
    write(docs, vocabulary, path, end=end, doc_id=doc_id, text=text)
    return read(docs.sparkSession, path)
