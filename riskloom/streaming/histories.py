"""State machines over long stored histories, cut into slices anywhere.

A stream keeps a key's state in one place; a history of years does not have to. The events are
range-sorted by key and time, so a slice (a partition) may begin and end inside a key. A slice maps
the state in which it is entered to the state in which it is left. All slices run at once, first from
the empty state; a slice whose predecessor leaves another state than was assumed runs again
from that one, until all states fit together. States soon forget where they began, so few slices
run more than twice; what passes through the driver is one state per slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.operators import ordered as R
from riskloom.session import scratch_path

State = tuple[int, ...]
#: (state, time, flags of the event) -> (state after it, results of the event)
Step = Callable[[State, int, tuple], tuple[State, tuple]]
_STATE = "first_key string, last_key string, state array<bigint>"


def replay(rows: DataFrame, step: Step, flags: list[str], results: list[T.StructField]) -> DataFrame:
    """``key, id`` and the results of every event of ``key, us, id`` and ``flags``.

    ``rows`` must come from ``sorted_parts`` in the order of key, time and id. A state is a tuple of
    whole numbers, empty at a key's first event.
    """
    spark = rows.sparkSession
    fields = [rows.schema["key"], rows.schema["id"], *results]
    schema = T.StructType([*fields, T.StructField("_part", T.IntegerType()), *T.StructType.fromDDL(_STATE).fields])
    path = scratch_path(spark, "histories")

    def run_from(entries: dict[int, State]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, state, first, part = None, (), None, None
            for batch in batches:
                columns = {c: batch.column(c).to_pylist() for c in ("key", "us", "id", *flags)}
                if not batch.num_rows:
                    continue
                if part is None:
                    part = batch.column("_part")[0].as_py()
                    if part not in entries:
                        return
                    first = key = columns["key"][0]
                    state = entries[part]
                found = []
                for k, us, *values in zip(columns["key"], columns["us"], *[columns[c] for c in flags]):
                    if k != key:
                        key, state = k, ()
                    state, result = step(state, us, tuple(values))
                    found.append(result)
                n = batch.num_rows
                data = [batch.column("key"), batch.column("id")]
                data += [pa.array(c, type=t) for c, t in zip(zip(*found), types)]
                data += [pa.array([part] * n, pa.int32()), *[pa.nulls(n, t) for t in tail]]
                yield pa.RecordBatch.from_arrays(data, names=schema.names)
            if part is not None:
                data = [pa.nulls(1, t) for t in [key_type, id_type, *types]] + [
                    pa.array([part], pa.int32()), pa.array([first], pa.string()), pa.array([key], pa.string()), pa.array([list(state)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(data, names=schema.names)

        return run

    key_type, id_type, *types = (to_arrow_type(f.dataType) for f in fields)
    tail = (pa.string(), pa.string(), pa.list_(pa.int64()))
    numbers = [r[0] for r in rows.select("_part").distinct().orderBy("_part").collect()]
    entries: dict[int, State] = dict.fromkeys(numbers, ())
    exits: dict[int, tuple] = {}
    firsts: dict[int, str | None] = {}
    newest: dict[int, int] = {}
    todo, turn = dict(entries), 0
    while todo:
        out = f"{path}/turn={turn}"
        rows.mapInArrow(run_from(todo), schema).write.parquet(out)
        left = spark.read.schema(schema).parquet(out).where("state IS NOT NULL").select("_part", *T.StructType.fromDDL(_STATE).names).collect()
        exits |= {r["_part"]: (r["last_key"], tuple(r["state"])) for r in left}
        newest |= dict.fromkeys(todo, turn)
        firsts |= {r["_part"]: r["first_key"] for r in left}
        # A slice notices its predecessor's state if it begins with the key that the other ends with.
        wanted = {p: exits[before][1] if exits[before][0] == firsts[p] else () for before, p in zip(numbers, numbers[1:])}
        todo = {p: w for p, w in wanted.items() if w != entries[p]}
        entries |= todo
        turn += 1
    made = spark.read.schema(T.StructType([*schema.fields, T.StructField("turn", T.IntegerType())])).parquet(path) if numbers else None
    if made is None:
        return spark.createDataFrame([], T.StructType(fields))
    # One row per slice.
    last = spark.createDataFrame(list(newest.items()), "_part int, turn int")
    return made.where("state IS NULL").join(F.broadcast(last), ["_part", "turn"]).select(*[f.name for f in fields])


def lockout_step(limit: int, seconds: int) -> Step:
    """Failures in the window lock a key; refused attempts count for nothing, a success clears."""
    window = seconds * 1_000_000

    def step(state: State, us: int, flags: tuple) -> tuple[State, tuple]:
        state = tuple(t for t in state if t > us - window)
        locked = len(state) >= limit
        failed, succeeded = flags
        if not locked:
            state = (*state, us) if failed else () if succeeded else state
        return state, (locked, len(state))

    return step


def lockouts(
    df: DataFrame, key: str, failed: Column, succeeded: Column, limit: int = 5, seconds: int = 900, ts: str = "ts", tie: str = "event_id",
) -> DataFrame:
    """``key, event_id, refused, failures`` of stored events, as the stateful stream decides them.

    Works for any share of the events in one key. Events without a time are left out; a null flag
    counts as false.
    """
    flag = lambda c: F.coalesce(c, F.lit(False))
    rows = df.select(
        F.col(key).cast("string").alias("key"), R.micros(ts).alias("us"), F.col(tie).alias("id"), flag(failed).alias("failed"), flag(succeeded).alias("succeeded"),
    ).where(F.col("us").isNotNull())
    rows = R.sorted_parts(rows, [F.col("key"), F.col("us"), F.col("id")])
    results = [T.StructField("refused", T.BooleanType()), T.StructField("failures", T.LongType())]
    return replay(rows, lockout_step(limit, seconds), ["failed", "succeeded"], results).withColumnRenamed("id", "event_id")
