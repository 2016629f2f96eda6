"""Helpers shared by the text operators: stored tables, Arrow pieces and connected classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import scratch_path

#: Code points with the Unicode property White_Space, as the inside of a character class.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def remainder(column: str | Column, n: int) -> Column:
    """crc32 of a value's text modulo ``n``; 0 where the value is null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.coalesce(F.crc32(value.cast("string").cast("binary")), F.lit(0)), F.lit(n))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it while the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``max_bytes`` of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0)
        sizes = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])
        pa.default_memory_pool().release_unused()
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, sizes[start] + max_bytes, "right")) - 1
            stop = min(batch.num_rows, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def some_texts(column: pa.Array, rows: int = 256) -> Iterator[list[str | None]]:
    """The texts of an Arrow column, some rows at a time, so few of them are Python objects at once."""
    for i in range(0, len(column), rows):
        yield column.slice(i, rows).to_pylist()
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch; null reads as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def list_array(flat: np.ndarray, counts: list[int] | np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from all values in a row and the number of values of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage like a checkpoint, and gives the planner the real size: a checkpoint keeps
    the estimate of its plan, which loops of joins blow up without bound.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def classes(edges: DataFrame, source: str = "src", target: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Connected classes of undirected links: ``node``, ``root`` (smallest node of its class).

    Each round sends every node to its smallest neighbour, follows the pointers twice and
    renames the links, so the links shrink to nothing in a logarithmic number of rounds. No
    link reaches the driver; a node with very many links only meets partial minimums and joins
    whose large partitions Spark splits. Loops and null ends are ignored; no links, no rows.
    """
    links = stored(
        edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    roots = None
    for _ in range(max_rounds):
        if links.isEmpty():
            break
        both = links.union(links.select("b", "a"))
        step = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
        for _ in range(2):
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
            step = stored(step.join(onward, "root", "left").select("node", F.coalesce("far", "root").alias("root")))
        to = step.select(F.col("node").alias("a"), F.col("root").alias("to"))
        links = links.join(to, "a").select(F.col("to").alias("a"), "b")
        links = links.join(step.select(F.col("node").alias("b"), F.col("root").alias("to")), "b").select("a", F.col("to").alias("b"))
        links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if roots is None:
            roots = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("far"))
            roots = stored(roots.join(onward, "root", "left").select("node", F.coalesce("far", "root").alias("root")))
    else:
        raise RuntimeError(f"links left after {max_rounds} rounds")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
