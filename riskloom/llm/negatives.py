"""Hard negatives by length buckets and sorted coordinate lists.

The rows are range-partitioned by vector length, so every Arrow batch of the stored table is cut
into buckets of rows of nearly one length. An anchor that needs a score of ``theta`` needs, in a
bucket whose longest vector has length ``l``, a cosine of ``t = theta / (|anchor| l)``. A bucket
falls where ``t`` exceeds one. Otherwise the angle between row and anchor is at most
``arccos t``, so the row's angle to each axis differs by no more than that from the anchor's: for
the anchor's focus coordinates (its largest ones) this gives ranges of feasible values. The
ranges are looked up in the bucket's sorted coordinate lists, the shortest list is read, the
others intersect it, and the scores of what is left are computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.llm.common import stored
from riskloom.llm.topk import scaled
from riskloom.session import scratch_path

#: Rows per bucket, anchors looked up together, focus coordinates, longest rows that give first floors.
BUCKET, TOGETHER, FOCUS, SEEDS = 2048, 64, 4, 4096
_PARTIAL = "anchor_id long, slot int, id long, score long"
_PARTIAL_NAMES = ["anchor_id", "slot", "id", "score"]


class Bucket:
    """Rows of similar length with one sorted list per coordinate (made when first needed)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        length = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = float(length.max(initial=0.0))
        self.unit = vectors / np.where(length > 0, length, 1.0)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in ascending order of a coordinate, and its values in that order."""
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable")
            self._lists[coordinate] = order, self.unit[order, coordinate]
        return self._lists[coordinate]


class Search:
    """Anchors with the best rows found so far.

    Every anchor has slots; a slot takes scores from ``low`` to ``high`` and keeps its ``k`` best
    rows, ties to smaller ids. ``floors``: known lower bounds of a slot's k-th best score.
    """

    def __init__(self, ids, labels, vectors, low, high, floors, same: bool, k: int):
        self.ids, self.labels, self.vectors, self.same, self.k = ids, labels, vectors, same, k
        self.low, self.high, self.floors = low, high, floors.copy()
        self.length = np.sqrt((vectors * vectors).sum(axis=1))
        unit = vectors / np.where(self.length > 0, self.length, 1.0)[:, None]
        n = min(FOCUS, vectors.shape[1])
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :n]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1.0, 1.0))
        self.key, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def candidates(self, bucket: Bucket) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) pairs inside the feasible ranges of all focus coordinates."""
        theta = np.maximum(self.low, self.floors).min(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(theta > 0, theta / (self.length * bucket.longest), -1.0)
        alive = np.flatnonzero(cosine <= 1.0 + 1e-9)
        if not len(alive) or not self.focus.shape[1]:
            return np.repeat(alive, len(bucket.ids)), np.tile(np.arange(len(bucket.ids)), len(alive))
        # The slack covers the rounding of the angles.
        reach = np.arccos(np.clip(cosine[alive], -1.0, 1.0))[:, None] + 1e-6
        least = np.cos(np.minimum(np.pi, self.angle[alive] + reach)) - 1e-9
        most = np.cos(np.maximum(0.0, self.angle[alive] - reach)) + 1e-9
        focus = self.focus[alive]
        begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            values = bucket.sorted_list(int(f))[1]
            begin[at], end[at] = np.searchsorted(values, least[at], "left"), np.searchsorted(values, most[at], "right")
        shortest = np.argmin(end - begin, axis=1)
        rows = np.arange(len(alive))
        size = (end - begin)[rows, shortest]
        anchor = np.repeat(rows, size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[rows, shortest], size)
        row = np.zeros(len(place), np.int64)
        chosen = focus[rows, shortest][anchor]
        for f in np.unique(chosen):
            at = chosen == f
            row[at] = bucket.sorted_list(int(f))[0][place[at]]
        for j in range(focus.shape[1]):
            value = bucket.unit[row, focus[anchor, j]]
            inside = (value >= least[anchor, j]) & (value <= most[anchor, j])
            anchor, row = anchor[inside], row[inside]
        return alive[anchor], row

    def update(self, bucket: Bucket) -> None:
        anchor, row = self.candidates(bucket)
        fits = ((self.labels[anchor] == bucket.labels[row]) == self.same) & (self.ids[anchor] != bucket.ids[row])
        anchor, row = anchor[fits], row[fits]
        if not len(anchor):
            return
        if len(anchor) * 16 > len(self.ids) * len(bucket.ids):
            score = (self.vectors @ bucket.vectors.T)[anchor, row]
        else:
            score = np.einsum("ij,ij->i", self.vectors[anchor], bucket.vectors[row])
        slots = self.low.shape[1]
        least = np.maximum(self.low, self.floors)
        keys, ids, scores = [self.key], [self.id], [self.score]
        for s in range(slots):
            good = (score >= least[anchor, s]) & (score <= self.high[anchor, s])
            keys.append(anchor[good] * slots + s)
            ids.append(bucket.ids[row[good]])
            scores.append(score[good])
        key, found, score = np.concatenate(keys), np.concatenate(ids), np.concatenate(scores)
        order = np.lexsort((found, -score, key))
        key, found, score = key[order], found[order], score[order]
        starts = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
        rank = np.arange(len(key)) - np.maximum.accumulate(np.where(starts, np.arange(len(key)), 0))
        last = rank == self.k - 1
        flat = self.floors.reshape(-1)
        flat[key[last]] = np.maximum(flat[key[last]], score[last])
        kept = rank < self.k
        self.key, self.id, self.score = key[kept], found[kept], score[kept]

    def found(self) -> pa.RecordBatch:
        slots = self.low.shape[1]
        columns = [self.ids[self.key // slots], (self.key % slots).astype(np.int32), self.id, self.score.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_PARTIAL_NAMES)


def _matrix(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch by number of components."""
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for d in np.unique(dims):
        yield batch.filter(pa.array(dims == d)) if (dims != d).any() else batch


def _buckets(batch: pa.RecordBatch) -> Iterator[tuple[int, Bucket]]:
    for part in _by_size(batch):
        for i in range(0, part.num_rows, BUCKET):
            some = part.slice(i, BUCKET)
            ids, labels = (some.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            yield some.column("dim")[0].as_py(), Bucket(ids, labels, _matrix(some.column("v"), some.num_rows))


def _searches(batch: pa.RecordBatch, same: bool, k: int, low: int, high: int) -> Iterator[tuple[int, Search]]:
    """Searches of the anchors of a batch, some at a time.

    Without positives (``same``) an anchor has one slot that takes all scores; else one slot per
    positive, from ``low`` to ``high`` percent of its score.
    """
    for part in _by_size(batch):
        for i in range(0, part.num_rows, TOGETHER):
            some = part.slice(i, TOGETHER)
            n = some.num_rows
            ids, labels = (some.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            if same:
                least, most = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
            else:
                scores = some.column("positive_scores").to_pylist()
                least, most = np.full((n, max(map(len, scores))), np.inf), np.full((n, max(map(len, scores))), -np.inf)
                for x, values in enumerate(scores):
                    # Whole numbers: 100 s >= low p just where s >= ceil(low p / 100).
                    least[x, : len(values)] = [-(-low * p // 100) for p in values]
                    most[x, : len(values)] = [high * p // 100 for p in values]
                least[least > most] = np.inf
            floors = np.full(least.shape, -np.inf)
            if "floors" in some.schema.names:
                for x, values in enumerate(some.column("floors").to_pylist()):
                    floors[x] = values
            yield some.column("dim")[0].as_py(), Search(ids, labels, _matrix(some.column("v"), n), least, most, floors, same, k)


def _nearest(index: DataFrame, seeds: pa.Table, anchors: DataFrame, same: bool, k: int, low: int, high: int, slice_bytes: int) -> DataFrame:
    """``anchor_id, slot, id, score, rank``: the k best rows of every slot of every anchor.

    The anchors are sent in slices of at most ``slice_bytes``, one pass over the index for each. A
    task keeps k rows per slot, so what it returns doesn't grow with its rows. The longest rows of
    the index (``seeds``) first give every slot a floor, which spares each task finding its own.
    """
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(seeds)
    schema = T.StructType([*anchors.schema.fields, T.StructField("floors", T.ArrayType(T.DoubleType()))])

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = [b for batch in sent.value.to_batches() for b in _buckets(batch)]
        for batch in batches:
            for part in _by_size(batch):
                floors = []
                for dim, search in _searches(part, same, k, low, high):
                    for d, bucket in longest:
                        if d == dim:
                            search.update(bucket)
                    floors += search.floors.tolist()
                width = max(map(len, floors))
                floors = [f + [-np.inf] * (width - len(f)) for f in floors]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(floors, pa.list_(pa.float64()))], names=[*part.schema.names, "floors"])

    ready = stored(anchors.mapInArrow(floored, schema), "anchors")
    size = ready.agg(F.sum(8 * F.size("v") + 256)).first()[0] or 0
    passes = max(1, -(-size // slice_bytes))
    path = scratch_path(spark, "nearest")
    for p in range(passes):
        share = spark.sparkContext.broadcast(ready.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).toArrow())

        def run(batches: Iterator[pa.RecordBatch], share=share) -> Iterator[pa.RecordBatch]:
            searches = [s for batch in share.value.to_batches() for s in _searches(batch, same, k, low, high)]
            for batch in batches:
                for dim, bucket in _buckets(batch):
                    for d, search in searches:
                        if d == dim:
                            search.update(bucket)
            yield from (s.found() for _, s in searches if len(s.key))

        index.mapInArrow(run, _PARTIAL).write.mode("append").parquet(path)
    found = spark.read.schema(_PARTIAL).parquet(path)
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *, factor: int = 256,
    positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, slice_bytes: int = 8 << 20,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(factor * x) and scores are exact inner products (below 2**53). Rows
    where ``anchors`` holds ask; their positives are the ``positives`` best other rows of their
    label (a whole number), and each positive gets the ``negatives`` best rows of other labels
    with ``low * positive_score <= 100 * score <= high * positive_score``. Ties go to smaller ids.

    Rows with a null id, label or vector, or with null or non-finite components take no part;
    vectors of different lengths never meet. An id that is repeated asks once, with its smallest
    label and vector, and is never its own positive or negative; as candidates all its rows count,
    so equal rows may fill several ranks. Anchors without positives and positives without rows in
    range give no rows; no rows give no rows.
    """
    spark = rows.sparkSession
    usable = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled(F.col(vector), factor).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    squares = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    index = usable.withColumn("square", squares).repartitionByRange(F.desc("square"), F.xxhash64("id"))
    index = stored(index.sortWithinPartitions(F.desc("square")), "by-length")
    seeds = index.orderBy(F.desc("square"), "id").limit(SEEDS).select("id", "label", "dim", "v").toArrow()
    asking = index.where("asks").groupBy("id").agg(F.min(F.struct("label", "dim", "v")).alias("s")).select("id", "s.*")
    index = index.select("id", "label", "dim", "v")
    near = _nearest(index, seeds, asking, True, positives, low, high, slice_bytes)
    chosen = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), "score"))).alias("p"))
    chosen = stored(chosen, "positives")
    more = asking.join(chosen, F.col("id") == F.col("anchor_id")).select("id", "label", "dim", "v", F.col("p.score").alias("positive_scores"))
    far = _nearest(index, seeds, more, False, negatives, low, high, slice_bytes)
    pairs = chosen.select("anchor_id", F.posexplode("p").alias("slot", "p")).select("anchor_id", "slot", "p.positive_id", F.col("p.score").alias("positive_score"))
    return far.join(pairs, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
