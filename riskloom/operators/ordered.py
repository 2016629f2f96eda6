"""Ranks, running totals, exact quantiles and sliding windows without one-task windows.

A plain window over a huge group (or over no group at all) sorts that group in one
task. The operators below keep the exact result and split the work:

* ``global_rank`` / ``running_totals``: one range sort, then per-partition offsets.
* ``order_statistics``: radix selection, four rounds of counts over 16 bits of the values.
* ``previous_row``: windows over (key, slice), joined by one carried row per slice.
* ``running_counts``: counts along one range sort, for windows that reach back in time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskloom.session import ensure_checkpoint_dir, scratch_path

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
_POSITION_MASK = (1 << 33) - 1


def kept(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes read the stored rows instead of recomputing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "rows", spread: bool = False) -> DataFrame:
    """Written to the shared folder as columns and read back: passes over a few columns read only those.

    Columns without a type become texts, which files can hold. ``spread``: dealt over all cores, for
    rows that are read many times; large files are cut further when read.
    """
    path = scratch_path(df.sparkSession, name)
    df = df.repartition(df.sparkSession.sparkContext.defaultParallelism) if spread else df
    df = df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "void"})
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Store a join side and mark it for broadcast only when its measured size allows it.

    Beyond either limit the plain shuffle join (with adaptive skew handling) is used.
    """
    stored = kept(df)
    width = F.octet_length(F.to_json(F.struct(*stored.columns)))
    rows, size = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(stored) if rows <= max_rows and size <= max_bytes else stored


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; keeps the left side's keys."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def sorted_parts(df: DataFrame, order: Sequence[Column], part: str = "_part") -> DataFrame:
    """Range-sorted, stored rows with the number of the partition that holds them."""
    return kept(df.orderBy(*order)).withColumn(part, F.spark_partition_id())


def numbered(stored: DataFrame, name: str) -> DataFrame:
    """1-based position of each row of a stored table, partition after partition.

    The rows must come from ``kept`` or ``sorted_parts``: their partitions are fixed, so
    the counts and the positions refer to the same rows.
    """
    rows = stored.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)),
        }
    )
    # One row per partition: bounded by the partition count, not by the data.
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.join(F.broadcast(starts), F.col("_part") == F.col("_p"))
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .drop("_part", "_p", "_pos", "_start")
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position of every row in a total order.

    ``order`` should end with a unique column. Range partitioning splits repeated
    leading values by the later ones, so a value held by many rows is no hot spot.
    """
    return numbered(kept(df.orderBy(*order)), name)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    key: str,
    sums: Mapping[str, str],
    descending: bool = False,
) -> DataFrame:
    """Inclusive running sums of ``sums`` (new name -> column) in ``key`` order per group.

    Expects one row per (by, key), that is, an already aggregated table.
    """
    direction = F.col(key).desc() if descending else F.col(key).asc()
    rows = sorted_parts(df, [*[F.col(c) for c in by], direction])
    inside = (
        Window.partitionBy(*by, "_part").orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most (groups + partitions) rows, since ranges keep a group's rows together.
    totals = rows.groupBy(*by, "_part").agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()]
    )
    carried = totals.select(
        *by, "_part",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums],
    )
    out = rows.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    out = join_on(out, carried, [*by, "_part"])
    return out.withColumns({n: F.col(n) + F.col(f"_c_{n}") for n in sums}).drop(
        "_part", *[f"_c_{n}" for n in sums]
    )


def order_key(value: str | Column, kind: T.DataType) -> Column:
    """A 64-bit integer per value that sorts like the values; equal values have equal keys.

    A double becomes its sign, exponent and fraction bits as one number, by exact divisions by
    powers of two; minus zero equals zero and NaN is above all numbers.
    """
    x = F.col(value) if isinstance(value, str) else value
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return x.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(x).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x)
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (x.cast("decimal(38,18)") * F.lit(10**kind.scale).cast("decimal(20,0)")).cast("long")
    if not isinstance(kind, T.FractionalType) or isinstance(kind, T.DecimalType):
        raise TypeError(f"no order key for {kind.simpleString()}")
    x = x.cast("double")
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    # The logarithm may be off by one next to a power of two.
    exponent = guess + (size >= F.pow(F.lit(2.0), guess + 1)).cast("long") - (size < F.pow(F.lit(2.0), guess)).cast("long")
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1.0) * float(1 << 52)).cast("long")
    bits = (
        F.when(size == float("inf"), F.lit(2047 << 52))
        .when(size < 2.0**-1022, (size / 2.0**-1074).cast("long"))
        .otherwise((exponent + 1023) * F.lit(1 << 52) + fraction)
    )
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -bits).otherwise(bits)


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    picks: Mapping[str, Callable[[Column], Column]],
    measures: Mapping[str, Column] | None = None,
    count_name: str = "n",
    sizes: DataFrame | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact values at given ranks per group by radix selection, plus further aggregate ``measures``.

    ``picks`` maps a result name to the exact 1-based rank as a function of the number of values;
    a rank outside 1 to that number gives NULL. ``sizes`` may hand in the group sizes (keys,
    ``_n`` and the measures) when they are already known. Values are read as 64-bit keys, 16 bits a
    round: a round counts the values by their next 16 bits, all groups and ranks in one aggregate that
    adds up inside the tasks first, and keeps the cells that hold a wanted rank. So no group is
    sorted, however large it is; a cell with one value ends early, and four rounds end all. Each round
    reads ``df`` once. ``weight``: a whole number per row, as how many rows it counts.
    """
    measures = dict(measures or {})
    keyed = df if keys else df.withColumn("_all", F.lit(0))
    grouped, keys = bool(keys), list(keys) or ["_all"]
    side = (
        sizes if sizes is not None
        else keyed.groupBy(*keys).agg(
            (F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col(weight))), F.lit(0)) if weight else F.count(value)).alias("_n"),
            *[c.alias(n) for n, c in measures.items()],
        )
    )
    held = [F.col(weight).alias("_w")] if weight else []
    rows = keyed.select(*keys, F.col(value).alias("_v"), *held).where(F.col("_v").isNotNull())
    number = F.sum("_w") if weight else F.count(F.lit(1))
    rows = rows.withColumn("_key", order_key("_v", df.schema[value].dataType))
    done, wanted = [], None
    for shift in (48, 32, 16, 0):
        cells = rows.withColumn("_cell", F.shiftright("_key", shift))
        inside = list(keys)
        if wanted is not None:
            inside.append("_prefix")
            cells = join_on(cells.withColumn("_prefix", F.shiftright("_cell", 16)), wanted.select(*inside), inside)
        counted = cells.groupBy(*inside, "_cell").agg(number.alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        # At most 65,536 counters in a window.
        ordered = Window.partitionBy(*inside).orderBy("_cell")
        counted = counted.withColumn("_to", F.sum("_c").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        if wanted is None:
            n = F.sum("_c").over(Window.partitionBy(*inside))
            ranks = [F.struct(F.lit(name).alias("pick"), rank(n).cast("long").alias("rank")) for name, rank in picks.items()]
            counted = counted.withColumn("_ranks", F.array(*ranks))
        else:
            counted = join_on(counted, wanted, inside)
        before = F.col("_to") - F.col("_c")
        hit = F.filter("_ranks", lambda r: (r["rank"] > before) & (r["rank"] <= F.col("_to")))
        onward = F.transform(hit, lambda r: F.struct(r["pick"].alias("pick"), (r["rank"] - before).alias("rank")))
        found = kept(counted.select(*keys, F.col("_cell").alias("_prefix"), "_lo", "_hi", onward.alias("_ranks")).where(F.size("_ranks") > 0))
        single = F.col("_lo").eqNullSafe(F.col("_hi")) | F.lit(shift == 0)
        done.append(found.where(single).select(*keys, F.col("_lo").alias("_v"), F.explode("_ranks.pick").alias("_pick")))
        wanted = found.where(~single).select(*keys, "_prefix", "_ranks")
        # One row per group and wanted cell.
        width = F.octet_length(F.to_json(F.struct("*")))
        count, size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
        if not count:
            break
        if count <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
    values = reduce(DataFrame.unionByName, done)
    values = values.groupBy(*keys).agg(*[F.max(F.when(F.col("_pick") == name, F.col("_v"))).alias(name) for name in picks])
    out = join_on(side.select(*keys, *measures, F.col("_n").alias(count_name)), values, keys, "left")
    return out if grouped else out.drop("_all")


def median_picks() -> dict[str, Callable[[Column], Column]]:
    return {"_m1": lambda n: F.floor((n + 1) / 2), "_m2": lambda n: F.ceil((n + 1) / 2)}


def median_value() -> Column:
    return (F.col("_m1") + F.col("_m2")) / 2


def linear_picks(probs: Sequence[float]) -> dict[str, Callable[[Column], Column]]:
    """Neighbouring ranks for linear interpolation at each probability."""
    out = {}
    for i, p in enumerate(probs):
        out[f"_lo{i}"] = lambda n, p=p: F.floor((n - 1) * F.lit(float(p))) + 1
        out[f"_hi{i}"] = lambda n, p=p: F.ceil((n - 1) * F.lit(float(p))) + 1
    return out


def linear_value(i: int, p: float, n: str = "n") -> Column:
    place = (F.col(n) - 1) * F.lit(float(p))
    part = place - F.floor(place)
    return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part


def upper_decile_picks() -> dict[str, Callable[[Column], Column]]:
    """Ranks around 9(n+1)/10, kept inside 1..n."""

    def low(n: Column) -> Column:
        return F.greatest(F.lit(1), F.least(n - 1, F.floor((n + 1) * 9 / 10)))

    return {"_d1": low, "_d2": lambda n: F.least(n, low(n) + 1)}


def upper_decile_value(n: str = "n") -> Column:
    """Ninth exclusive decile: it may lie beyond the largest value."""
    size = F.col(n)
    low = F.greatest(F.lit(1), F.least(size - 1, F.floor((size + 1) * 9 / 10)))
    weight = (size + 1) * 9 - low * 10
    between = (F.col("_d1") * (10 - weight) + F.col("_d2") * weight) / 10
    return F.when(size == 1, F.col("_d1")).otherwise(between)


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    columns: Sequence[str],
    name: str = "previous",
) -> DataFrame:
    """Struct of ``columns`` from the row before, per key in ``order``.

    ``slice_by`` must grow with ``order`` (a day or month of the ordering time). Windows
    run per (key, slice); one carried row per slice links them.
    """
    rows = df.withColumn("_slice", slice_by)
    fields = F.struct(*columns)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    rows = rows.withColumns({"_prev": F.lag(fields).over(inside), "_rn": F.row_number().over(inside)})
    last = df.withColumn("_slice", slice_by).groupBy(*keys, "_slice").agg(
        F.max_by(fields, F.struct(*order)).alias("_last")
    )
    carried = last.withColumn(
        "_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice"))
    ).drop("_last")
    out = join_on(rows, carried, [*keys, "_slice"], "left")
    return out.withColumn(
        name, F.when(F.col("_rn") == 1, F.col("_carried")).otherwise(F.col("_prev"))
    ).drop("_slice", "_prev", "_rn", "_carried")


def running_counts(stored: DataFrame, flag: str, name: str, last: tuple[str, str] | None = None) -> DataFrame:
    """Number of rows up to and with each one where ``flag`` (0 or 1) holds, over a whole sorted table.

    ``last``: (flag, new name) adds that count as it was at the latest row with the second flag (0
    before the first). The rows must come from ``sorted_parts``. Each partition is counted through
    in its order, a batch at a time; one row per partition carries the totals on, so nothing is
    shuffled and no key has to fit into a task.
    """
    mark, mark_name = last or (flag, "_last")
    schema = T.StructType([*stored.schema.fields, T.StructField(name, T.LongType()), T.StructField(mark_name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, latest = 0, -1
        for batch in batches:
            column = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
            count = total + np.cumsum(column(flag))
            at = np.maximum.accumulate(np.concatenate([[latest], np.where(column(mark) > 0, count, -1)]))[1:]
            if len(count):
                total, latest = int(count[-1]), int(at[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(count), pa.array(at)], names=[*batch.schema.names, name, mark_name])

    counted = kept(stored.mapInArrow(run, schema))
    # One row per partition: bounded by the partition count, not by the data.
    parts = counted.groupBy("_part").agg(F.sum(flag).alias("_n"), F.max(mark_name).alias("_l"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    carried = F.coalesce(F.max(F.when(F.col("_l") >= 0, F.col("_base") + F.col("_l"))).over(before), F.lit(0))
    parts = parts.select(F.col("_part").alias("_p"), "_base", carried.alias("_carried"))
    out = counted.join(F.broadcast(parts), F.col("_part") == F.col("_p"))
    inside = F.when(F.col(mark_name) >= 0, F.col("_base") + F.col(mark_name)).otherwise(F.col("_carried"))
    out = out.withColumns({name: F.col("_base") + F.col(name), mark_name: inside}).drop("_p", "_base", "_carried")
    return out if last else out.drop(mark_name)


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))
