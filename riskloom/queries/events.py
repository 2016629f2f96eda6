"""Event-time operators: batch forms and streaming runs over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.queries.base import Tables, query, r6
from riskloom.session import scratch_path
from riskloom.streaming import histories as HI, rates as RT, stateful as ST

IS_ERROR_SQL = "event_type = 'error'"
DAY = 86_400


def is_error():
    return F.col("event_type") == "error"


def event_stream(t: Tables) -> DataFrame:
    """The events table as a stream; one file here, a growing folder in production."""
    schema = T.StructType.fromJson(t.events.schema.jsonValue())
    return (
        t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 100).parquet(t.folder)
    )


def drained(t: Tables, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything that is there and read back what it wrote."""
    out, state = scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-state")
    run = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return t.spark.read.schema(df.schema).parquet(out)


def _seconds(c: str):
    return F.unix_seconds(F.col(c).cast("timestamp")).alias(c)


# --- limits -----------------------------------------------------------------


@query(
    "rate_limit_hits", "T1",
    """WITH c AS (SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS calls FROM events)
    SELECT event_id, event_type, calls, calls > 4 AS over_limit FROM c""",
)
def rate_limit_hits(t: Tables) -> DataFrame:
    out = RT.calls_in_window(t.events, ["event_type"], 3600, 4)
    return out.select("event_id", "event_type", "calls", "over_limit")


@query(
    "sliding_counts", "T1",
    """WITH w AS (SELECT event_type, unnest([0, 600, 1200, 1800, 2400, 3000]) AS back, CAST(floor(epoch(ts) / 600) * 600 AS BIGINT) AS s FROM events)
    SELECT s - back AS start, event_type, count(*) AS n FROM w GROUP BY 1, 2""",
)
def sliding_counts(t: Tables) -> DataFrame:
    out = RT.window_counts(t.events, ["event_type"], length="1 hour", step="10 minutes")
    return out.select(_seconds("start"), "event_type", "n")


@query(
    "sliding_counts_stream", "T1 T9",
    """WITH w AS (SELECT event_type, unnest([0, 600, 1200, 1800, 2400, 3000]) AS back, CAST(floor(epoch(ts) / 600) * 600 AS BIGINT) AS s FROM events)
    SELECT s - back AS start, event_type, count(*) AS n FROM w GROUP BY 1, 2 HAVING s - back + 3600 <= (SELECT epoch(max(ts)) - 600 FROM events)""",
)
def sliding_counts_stream(t: Tables) -> DataFrame:
    """Windows the watermark has closed; later ones stay in state."""
    counted = RT.window_counts(event_stream(t), ["event_type"], length="1 hour", step="10 minutes")
    return drained(t, counted, "sliding").select(_seconds("start"), "event_type", "n")


_ORDERED = """e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)"""


@query(
    "call_limiter", "T1",
    f"""WITH RECURSIVE {_ORDERED},
    r AS (SELECT user_id, rn, event_id, true AS allowed, [us] AS times, 0::BIGINT AS retry_after FROM e WHERE rn = 1 UNION ALL
      SELECT user_id, rn, event_id, len(live) < 2, CASE WHEN len(live) < 2 THEN list_append(live, us) ELSE live END,
        CASE WHEN len(live) < 2 THEN 0 ELSE greatest(1, CAST(trunc(({DAY}::BIGINT * 1000000 - (us - live[1])) / 1e6) AS BIGINT) + 1) END
      FROM (SELECT e.user_id, e.rn, e.event_id, e.us, list_filter(r.times, lambda q: q > e.us - {DAY}::BIGINT * 1000000) AS live FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1))
    SELECT CAST(user_id AS VARCHAR) AS key, event_id, allowed, retry_after FROM r""",
)
def call_limiter(t: Tables) -> DataFrame:
    """Exact limiter as a stateful stream: two calls per user and day."""
    ST.use_rocksdb(t.spark)
    return drained(t, ST.limited_calls(event_stream(t), "user_id", 2, DAY), "limiter")


_FAILS = """WITH f AS (SELECT event_id, user_id, epoch_us(ts) AS us, CAST(event_type = 'error' AS INT) AS f, event_type = 'purchase' AS s FROM events),
    c AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS cum FROM f),
    d AS (SELECT *, coalesce(max(CASE WHEN s THEN cum END) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING), 0) AS reset,
      sum(f) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 604799999999 PRECEDING AND CURRENT ROW) AS inwin FROM c)"""


@query(
    "lockouts", "T2",
    f"{_FAILS} SELECT event_id, user_id, CAST(least(inwin, cum - reset) AS BIGINT) AS failures, least(inwin, cum - reset) >= 3 AS locked FROM d",
)
def lockouts(t: Tables) -> DataFrame:
    out = RT.failures_since_success(
        t.events, ["user_id"], is_error(), F.col("event_type") == "purchase", 7 * DAY, 3
    )
    return out.select("event_id", "user_id", "failures", "locked")


@query(
    "lockout_machine", "T2 T9",
    f"""WITH RECURSIVE {_ORDERED},
    r AS (SELECT user_id, rn, event_id, false AS refused, CASE WHEN event_type = 'error' THEN [us] ELSE []::BIGINT[] END AS times FROM e WHERE rn = 1 UNION ALL
      SELECT user_id, rn, event_id, len(live) >= 3, CASE WHEN len(live) >= 3 THEN live WHEN event_type = 'error' THEN list_append(live, us) WHEN event_type = 'purchase' THEN []::BIGINT[] ELSE live END
      FROM (SELECT e.user_id, e.rn, e.event_id, e.us, e.event_type, list_filter(r.times, lambda q: q > e.us - 604800000000) AS live FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1))
    SELECT CAST(user_id AS VARCHAR) AS key, event_id, refused, len(times) AS failures FROM r""",
)
def lockout_machine(t: Tables) -> DataFrame:
    """Exact lockout as a stateful stream: refused attempts count for nothing."""
    ST.use_rocksdb(t.spark)
    out = ST.lockouts(
        event_stream(t), "user_id", is_error(), F.col("event_type") == "purchase", 3, 7 * DAY
    )
    return drained(t, out, "lockout")


@query(
    "lockout_history", "T2",
    """WITH RECURSIVE e AS (SELECT event_id, key, event_type, us, row_number() OVER (PARTITION BY key ORDER BY us, event_id) AS rn
      FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'most' ELSE CAST(user_id AS VARCHAR) END AS key, event_type, epoch_us(ts) AS us FROM events)),
    r AS (SELECT key, rn, event_id, false AS refused, CASE WHEN event_type = 'error' THEN [us] ELSE []::BIGINT[] END AS times FROM e WHERE rn = 1 UNION ALL
      SELECT key, rn, event_id, len(live) >= 3, CASE WHEN len(live) >= 3 THEN live WHEN event_type = 'error' THEN list_append(live, us) WHEN event_type = 'purchase' THEN []::BIGINT[] ELSE live END
      FROM (SELECT e.key, e.rn, e.event_id, e.us, e.event_type, list_filter(r.times, lambda q: q > e.us - 3600000000) AS live FROM r JOIN e ON e.key = r.key AND e.rn = r.rn + 1))
    SELECT key, event_id, refused, len(times) AS failures FROM r""",
)
def lockout_history(t: Tables) -> DataFrame:
    """The exact lockout over a stored history in which one key holds half of all events."""
    rows = t.events.withColumn("who", F.when(F.col("event_id") % 2 == 0, "most").otherwise(F.col("user_id").cast("string")))
    return HI.lockouts(rows, "who", is_error(), F.col("event_type") == "purchase", 3, 3600)


_STATUS = "CASE WHEN event_type = 'error' THEN 'alert' WHEN event_type IN ('view', 'click') THEN 'watch' ELSE 'ok' END"


@query(
    "alert_history", "T5 D8",
    f"""WITH RECURSIVE {_ORDERED}, s AS (SELECT *, {_STATUS} AS status FROM e),
    r AS (SELECT user_id, rn, us, status, status = 'alert' AS fire, false AS solve, CASE WHEN status = 'alert' THEN us ELSE 0 END AS trig, status = 'alert' AS is_open FROM s WHERE rn = 1 UNION ALL
      SELECT user_id, rn, us, status, fire, solve, CASE WHEN fire THEN us ELSE trig END, CASE WHEN fire THEN true WHEN solve THEN false ELSE is_open END
      FROM (SELECT s.user_id, s.rn, s.us, s.status, s.status = 'alert' AND (NOT r.is_open OR s.us - r.trig >= 86400000000) AS fire, s.status = 'ok' AND r.is_open AS solve, r.trig, r.is_open
        FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1))
    SELECT CAST(user_id AS VARCHAR) AS subject, us, status, fire AS should_alert, solve AS should_resolve FROM r""",
)
def alert_history(t: Tables) -> DataFrame:
    """Alert state machine along each subject's reports."""
    ST.use_rocksdb(t.spark)
    reports = event_stream(t).withColumn("status", F.expr(_STATUS))
    return drained(t, ST.alert_history(reports, "user_id", "status", "ts"), "alerts").drop("late")


@query(
    "alert_expiry", "T5 T9",
    f"""WITH RECURSIVE {_ORDERED}, s AS (SELECT *, {_STATUS} AS status FROM e),
    r AS (SELECT user_id, rn, us, status, status = 'alert' AS fire, false AS solve, CASE WHEN status = 'alert' THEN us ELSE 0 END AS trig, status = 'alert' AS is_open FROM s WHERE rn = 1 UNION ALL
      SELECT user_id, rn, us, status, fire, solve, CASE WHEN fire THEN us ELSE trig END, CASE WHEN fire THEN true WHEN solve THEN false ELSE is_open END
      FROM (SELECT user_id, rn, us, status, status = 'alert' AND (NOT is_open OR us - trig >= 86400000000) AS fire, status = 'ok' AND is_open AS solve, trig, is_open
        FROM (SELECT s.user_id, s.rn, s.us, s.status, CASE WHEN s.us - r.us >= 43200000000 THEN 0 ELSE r.trig END AS trig, r.is_open AND s.us - r.us < 43200000000 AS is_open
          FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)))
    SELECT CAST(user_id AS VARCHAR) AS subject, us, status, fire AS should_alert, solve AS should_resolve, false AS late FROM r""",
)
def alert_expiry(t: Tables) -> DataFrame:
    """Subjects that come back after twelve silent hours begin anew."""
    ST.use_rocksdb(t.spark)
    reports = event_stream(t).withColumn("status", F.expr(_STATUS))
    return drained(t, ST.alert_history(reports, "user_id", "status", "ts", expiry_hours=12), "alerts")


# --- rates ------------------------------------------------------------------


@query(
    "error_ratio", "T3",
    f"SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start, count(*) AS calls, count(*) FILTER ({IS_ERROR_SQL}) AS errors, round(count(*) FILTER ({IS_ERROR_SQL}) / count(*), 6) AS error_ratio FROM events GROUP BY 1",
)
def error_ratio(t: Tables) -> DataFrame:
    out = RT.error_ratio(t.events, is_error(), length="1 hour")
    return out.select(_seconds("start"), "calls", "errors", r6("error_ratio").alias("error_ratio"))


@query(
    "error_ratio_stream", "T3",
    f"""SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start, count(*) AS calls, count(*) FILTER ({IS_ERROR_SQL}) AS errors, round(count(*) FILTER ({IS_ERROR_SQL}) / count(*), 6) AS error_ratio
    FROM events GROUP BY 1 HAVING floor(epoch(any_value(ts)) / 3600) * 3600 + 3600 <= (SELECT epoch(max(ts)) - 600 FROM events)""",
)
def error_ratio_stream(t: Tables) -> DataFrame:
    out = drained(t, RT.error_ratio(event_stream(t), is_error(), length="1 hour"), "ratio")
    return out.select(_seconds("start"), "calls", "errors", r6("error_ratio").alias("error_ratio"))


_B = RT.LATENCY_BOUNDS
_QUANTILE = "CASE " + " ".join(
    f"WHEN le{i} >= rk THEN {(_B[i - 1] if i else 0.0)!r} + ({_B[i]!r} - {(_B[i - 1] if i else 0.0)!r}) * ((rk - {f'le{i - 1}' if i else '0'}) / nullif(le{i} - {f'le{i - 1}' if i else '0'}, 0))"
    for i in range(len(_B))
) + f" ELSE {_B[-1]!r} END"


@query(
    "latency_p95", "T3",
    f"""WITH c AS (SELECT CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT) AS start, event_type, count(value) AS calls, 0.95 * count(value) AS rk, {", ".join(f"count(*) FILTER (value <= {b!r}) AS le{i}" for i, b in enumerate(_B))} FROM events GROUP BY 1, 2)
    SELECT start, event_type, calls, round({_QUANTILE}, 5) AS quantile FROM c""",
)
def latency_p95(t: Tables) -> DataFrame:
    out = RT.latency_quantile(t.events, "value", length="6 hours", keys=["event_type"])
    return out.select(_seconds("start"), "event_type", "calls", r6("quantile", 5).alias("quantile"))


@query(
    "pending_alerts", "T4",
    f"""WITH b AS (SELECT user_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS minute, count(*) FILTER ({IS_ERROR_SQL}) / count(*) > 0.15 AS x FROM events GROUP BY 1, 2),
    i AS (SELECT user_id, minute, minute - row_number() OVER (PARTITION BY user_id ORDER BY minute) AS g FROM b WHERE x)
    SELECT user_id, min(minute) AS from_minute, max(minute) AS to_minute, count(*) AS minutes FROM i GROUP BY user_id, g HAVING count(*) >= 2""",
)
def pending_alerts(t: Tables) -> DataFrame:
    return RT.pending_alerts(t.events, ["user_id"], is_error(), 0.15, hold=2, minutes=1440)


@query(
    "silence_gaps", "T6",
    """WITH g AS (SELECT user_id, event_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1000000.0::DOUBLE AS gap FROM events)
    SELECT user_id, event_id, round(gap, 6) AS gap_seconds FROM g WHERE gap > 43200""",
)
def silence_gaps(t: Tables) -> DataFrame:
    out = RT.silence_gaps(t.events, ["user_id"], 43_200)
    return out.select("user_id", "event_id", r6("gap_seconds").alias("gap_seconds"))


@query(
    "pending_without_data", "T4",
    f"""WITH b AS (SELECT user_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS minute, count(*) FILTER ({IS_ERROR_SQL}) / count(*) > 0.15 AS x FROM events GROUP BY 1, 2),
    every AS (SELECT user_id, unnest(range(min(minute), max(minute) + 1)) AS minute FROM b GROUP BY 1),
    f AS (SELECT e.user_id, e.minute FROM every e LEFT JOIN b ON b.user_id = e.user_id AND b.minute = e.minute WHERE b.x IS NOT FALSE),
    i AS (SELECT user_id, minute, minute - row_number() OVER (PARTITION BY user_id ORDER BY minute) AS g FROM f)
    SELECT user_id, min(minute) AS from_minute, max(minute) AS to_minute, count(*) AS minutes FROM i GROUP BY user_id, g HAVING count(*) >= 2""",
)
def pending_without_data(t: Tables) -> DataFrame:
    """Empty buckets fire too."""
    return RT.pending_alerts(t.events, ["user_id"], is_error(), 0.15, hold=2, minutes=1440, no_data_fires=True)


@query(
    "silent_keys", "T6",
    """WITH l AS (SELECT user_id, max(ts) AS m FROM events GROUP BY 1), e AS (SELECT max(ts) AS now FROM events)
    SELECT user_id, round((epoch_us(now) - epoch_us(m)) / 1000000.0::DOUBLE, 6) AS silent_seconds FROM l, e WHERE epoch_us(now) - epoch_us(m) > 43200000000""",
)
def silent_keys(t: Tables) -> DataFrame:
    """Users that have not come back for twelve hours at the end of the table."""
    end = t.events.agg(F.max("ts")).scalar()
    out = RT.silent_keys(t.events, ["user_id"], 43_200, end)
    return out.select("user_id", r6("silent_seconds").alias("silent_seconds"))


@query(
    "quiet_sessions", "T6",
    """WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 7200000000 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g)
    SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM s GROUP BY user_id, sid""",
)
def quiet_sessions(t: Tables) -> DataFrame:
    return RT.quiet_sessions(t.events, ["user_id"], "2 hours").select("user_id", _seconds("start"), "n")


@query(
    "distinct_records", "T8 T9",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
)
def distinct_records(t: Tables) -> DataFrame:
    """Every event arrives twice; repeats within the watermark are dropped."""
    from riskloom.streaming.jobs import distinct_records as distinct

    once = event_stream(t)
    twice = once.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"), "*").drop("copy")
    seen = drained(t, distinct(twice, ["event_id"], "ts"), "distinct")
    return seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
