"""Request rates, limits, error ratios, latency quantiles and silence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators import decisions as DC, ordered as R

WATERMARK = "10 minutes"

# Upper bounds of the latency histogram, in the unit of the value column.
LATENCY_BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0]


def timed(df: DataFrame, ts: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Event time as a zoned timestamp with a watermark (zone-less times carry none)."""
    stamped = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return stamped.withWatermark(ts, delay) if df.isStreaming else stamped


def window_counts(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", length: str = "60 seconds", step: str | None = None
) -> DataFrame:
    """Events per key and (sliding) window; counts are pre-summed before the shuffle."""
    frame = F.window(ts, length, step) if step else F.window(ts, length)
    return timed(df, ts).groupBy(frame, *keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n"
    )


def over_limit(df: DataFrame, keys: Sequence[str], limit: int, **window) -> DataFrame:
    return window_counts(df, keys, **window).where(F.col("n") > limit)


def _marks(rows: DataFrame, keys: Sequence[str], seconds: int, *columns: Column) -> DataFrame:
    """Every event at its time and a mark where its window begins, sorted by key and time.

    An event (``_kind`` 0) comes before the marks (1) of the same instant. The range sort splits a
    key at any place, so a key may hold any share of the events.
    """
    at = lambda kind, t: F.struct(F.lit(kind).alias("_kind"), t.alias("_t"))
    both = F.array(at(0, F.col("_us")), at(1, F.col("_us") - F.lit(seconds * 1_000_000)))
    marks = rows.select(*keys, "_id", *columns, F.inline(both))
    return R.sorted_parts(marks, [*[F.col(k) for k in keys], F.col("_t"), F.col("_kind"), F.col("_tie"), F.col("_id")])


def _numbered_events(df: DataFrame, ts: str) -> DataFrame:
    """The stored events that have a time, with micros and a number of their own."""
    rows = df.withColumn("_us", R.micros(ts)).where(F.col("_us").isNotNull())
    return R.kept(rows.withColumn("_id", F.monotonically_increasing_id()))


def calls_in_window(df: DataFrame, keys: Sequence[str], seconds: int, limit: int, ts: str = "ts") -> DataFrame:
    """Per event: calls of its key in the trailing window, and whether that exceeds the limit (0: none).

    Positions in one range sort by key and time are counted; the calls in a window are the difference of
    two of them. Events of the same instant count each other; events without a time are left out.
    """
    rows = _numbered_events(df, ts)
    # The end of a window lies behind all events of its instant: a second mark, at the event's time.
    marks = rows.select(*keys, "_id", F.inline(F.array(
        *[F.struct(F.lit(kind).alias("_kind"), (F.col("_us") - F.lit(back)).alias("_t"), F.lit(sign).alias("_sign"))
          for kind, back, sign in ((0, 0, 0), (1, seconds * 1_000_000, -1), (1, 0, 1))]
    )))
    marks = R.sorted_parts(marks, [*[F.col(k) for k in keys], F.col("_t"), F.col("_kind"), F.col("_id")])
    counted = R.running_counts(marks.withColumn("_event", 1 - F.col("_kind")), "_event", "_before")
    calls = counted.where("_kind = 1").groupBy("_id").agg(F.sum(F.col("_sign") * F.col("_before")).alias("calls"))
    return rows.join(calls, "_id").withColumn("over_limit", (F.col("calls") > limit) & F.lit(limit > 0)).drop("_us", "_id")


def failures_since_success(
    df: DataFrame, keys: Sequence[str], failed: Column, succeeded: Column, seconds: int, limit: int,
    ts: str = "ts", tie: str = "event_id",
) -> DataFrame:
    """Per event: failures of its key in the trailing window after the last success in it.

    Failures are counted along one range sort by key, time and ``tie``; what lies before the window or
    before the last success is taken off. A success of another key lies before the window's
    beginning in that sort, so keys need no counts of their own.
    """
    rows = _numbered_events(df, ts)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    marks = _marks(rows, keys, seconds, flag(failed).alias("_f"), flag(succeeded).alias("_s"), F.col(tie).alias("_tie"))
    event = F.col("_kind") == 0
    marks = marks.withColumns({c: F.when(event, F.col(c)).otherwise(0) for c in ("_f", "_s")})
    counted = R.running_counts(marks, "_f", "_cum", last=("_s", "_reset"))
    of = lambda kind, c: F.max(F.when(F.col("_kind") == kind, F.col(c)))
    found = counted.groupBy("_id").agg((of(0, "_cum") - F.greatest(of(0, "_reset"), of(1, "_cum"))).alias("failures"))
    return rows.join(found, "_id").withColumn("locked", F.col("failures") >= limit).drop("_us", "_id")


def error_ratio(df: DataFrame, is_error: Column, ts: str = "ts", length: str = "5 minutes", keys: Sequence[str] = ()) -> DataFrame:
    """Calls, errors and their ratio per window."""
    return (
        timed(df, ts).groupBy(F.window(ts, length), *keys)
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if(is_error).alias("errors"))
        .select(
            F.col("window.start").alias("start"), *keys, "calls", "errors",
            (F.col("errors") / F.greatest(F.col("calls"), F.lit(1))).alias("error_ratio"),
        )
    )


def latency_quantile(
    df: DataFrame, value: str, q: float = 0.95, bounds: Sequence[float] = tuple(LATENCY_BOUNDS),
    ts: str = "ts", length: str = "5 minutes", keys: Sequence[str] = (),
) -> DataFrame:
    """Quantile from cumulative bucket counts, linear inside the bucket.

    The state per window is one counter per bound, whatever the traffic. Above the last
    bound the last bound is reported.
    """
    counters = [F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)]
    agg = timed(df, ts).groupBy(F.window(ts, length), *keys).agg(F.count(value).alias("calls"), *counters)
    rank = F.lit(q) * F.col("calls")
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = float(bounds[i - 1]) if i else 0.0
        below = F.col(f"_le{i - 1}") if i else F.lit(0)
        inside = F.col(f"_le{i}") - below
        part = (rank - below) / F.nullif(inside, F.lit(0))
        out = F.when(F.col(f"_le{i}") >= rank, F.lit(low) + (float(bounds[i]) - low) * part).otherwise(out)
    return agg.select(
        F.col("window.start").alias("start"), *keys, "calls", F.when(F.col("calls") > 0, out).alias("quantile")
    )


def minute_buckets(df: DataFrame, keys: Sequence[str], is_error: Column, ratio_limit: float, ts: str = "ts", minutes: int = 1) -> DataFrame:
    """One row per key and minute bucket with a breach flag."""
    minute = F.floor(R.micros(ts) / F.lit(60_000_000 * minutes)).cast("long")
    return (
        df.groupBy(*keys, minute.alias("minute"))
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if(is_error).alias("errors"))
        .withColumn("breached", F.col("errors") / F.col("calls") > ratio_limit)
    )


def pending_alerts(
    df: DataFrame, keys: Sequence[str], is_error: Column, ratio_limit: float, hold: int = 5, ts: str = "ts",
    minutes: int = 1, no_data_fires: bool = False,
) -> DataFrame:
    """Breaches that lasted ``hold`` consecutive buckets.

    With ``no_data_fires`` the empty buckets between two of a key's buckets count as breached.
    """
    buckets = minute_buckets(df, keys, is_error, ratio_limit, ts, minutes)
    return DC.pending_runs(buckets, list(keys), "minute", "breached", hold, no_data_fires)


def silent_keys(df: DataFrame, keys: Sequence[str], seconds: int, as_of: Column, ts: str = "ts") -> DataFrame:
    """Keys whose last event lies more than ``seconds`` before ``as_of``, whether they return or not."""
    last = df.groupBy(*keys).agg(F.max(ts).alias("last_seen"))
    silent = (R.micros(as_of) - R.micros("last_seen")) / 1_000_000.0
    return last.withColumn("silent_seconds", silent).where(F.col("silent_seconds") > seconds)


def silence_gaps(df: DataFrame, keys: Sequence[str], seconds: int, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Events that came more than ``seconds`` after the one before of their key.

    A key that has not returned yet has no such event: ``silent_keys`` reports it.
    """
    rows = df.select(*keys, ts, tie).withColumn("_us", R.micros(ts))
    day = F.floor(F.col("_us") / F.lit(86_400_000_000))
    out = R.previous_row(rows, keys, ["_us", tie], day, ["_us"])
    gap = (F.col("_us") - F.col("previous._us")) / 1_000_000.0
    return out.withColumn("gap_seconds", gap).where(F.col("gap_seconds") > seconds).select(
        *keys, tie, ts, "gap_seconds"
    )


def quiet_sessions(df: DataFrame, keys: Sequence[str], gap: str, ts: str = "ts") -> DataFrame:
    """Activity sessions closed by silence of ``gap``; works on streams and tables."""
    return (
        timed(df, ts).groupBy(F.session_window(ts, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("session_window.start").alias("start"), F.col("session_window.end").alias("silent_from"),
            *keys, "n",
        )
    )
