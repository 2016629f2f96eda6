"""Drift, retraining, promotion, alerting and run-once decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.operators import decisions as DC, drift as DR
from riskloom.queries.base import Tables, query

DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "is_open", "same", "absent"]
_CUT = "1998-07-01"
_QS = ", ".join(f"{i / 10!r}" for i in range(11))
_SIDE = f"CASE WHEN l_shipdate < TIMESTAMP '{_CUT}' THEN 'r' ELSE 'c' END"
_VALUES = {
    "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice * CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 1.0 ELSE 1.35 END",
    "l_discount": "l_discount", "l_tax": "CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN l_tax ELSE l_tax * l_tax * 10 END",
    "l_linenumber": "l_linenumber", "is_open": "CAST(l_linestatus = 'O' AS INT)", "same": "1.0",
}
PSI_SQL = (
    "v AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_SIDE} AS side, CAST({e} AS DOUBLE) AS x FROM lineitem" for c, e in _VALUES.items()
    ) + f"""),
  g AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, [{_QS}]) FILTER (side = 'r'))) AS e, min(x) AS lo, max(x) AS hi,
        count(*) FILTER (side = 'r') AS nr, count(*) FILTER (side = 'c') AS nc FROM v GROUP BY 1),
  h AS (SELECT *, CASE WHEN len(e) >= 3 THEN e[2:len(e) - 1] ELSE list_transform(range(1, 10), lambda i: lo + (hi - lo) / 10 * i) END AS inn FROM g),
  b AS (SELECT v.feature, side, 1 + len(list_filter(inn, lambda q: q <= x)) AS bin FROM v JOIN h ON v.feature = h.feature),
  n AS (SELECT feature, bin, count(*) FILTER (side = 'r') AS r, count(*) FILTER (side = 'c') AS c FROM b GROUP BY 1, 2),
  s AS (SELECT feature, nr, nc, lo, hi, len(e) AS ne, unnest(range(1, len(inn) + 2)) AS bin FROM h),
  p AS (SELECT s.feature, ne < 3 AND lo = hi AS const, greatest(0.000001, coalesce(r, 0) / nr) AS r, greatest(0.000001, coalesce(c, 0) / nc) AS c
        FROM s LEFT JOIN n ON s.feature = n.feature AND s.bin = n.bin),
  psi AS (SELECT feature, CASE WHEN bool_or(const) THEN 0.0 ELSE sum((c - r) * ln(c / r)) END AS psi FROM p GROUP BY 1 UNION ALL SELECT 'absent', NULL),
  features AS (SELECT feature, round(psi, 6) AS psi, CASE WHEN psi IS NULL THEN 'missing' WHEN psi >= 0.25 THEN 'alert' WHEN psi >= 0.1 THEN 'watch' ELSE 'ok' END AS status FROM psi)"""
)


def drift_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.lineitem.select("l_shipdate", *[F.expr(e).alias(c) for c, e in _VALUES.items()])
    cut = F.lit(f"{_CUT} 00:00:00").cast("timestamp_ntz")
    return rows.where(F.col("l_shipdate") < cut).drop("l_shipdate"), rows.where(F.col("l_shipdate") >= cut).drop("l_shipdate")


@query("psi_report", "D1 D2 D3 D4 D5", f"WITH {PSI_SQL} SELECT feature, psi, status FROM features")
def psi_report(t: Tables) -> DataFrame:
    return DR.drift_features(*drift_sides(t), DRIFT_COLUMNS).select("feature", "psi", "status")


@query(
    "psi_status", "D4 D5",
    f"""WITH {PSI_SQL} SELECT (SELECT count(*) FROM lineitem WHERE {_SIDE} = 'r') AS reference_rows, (SELECT count(*) FROM lineitem WHERE {_SIDE} = 'c') AS current_rows,
    count(*)::INT AS features_checked, count(*) FILTER (status = 'watch')::INT AS watch_count, count(*) FILTER (status = 'alert')::INT AS alert_count,
    CASE WHEN count(*) FILTER (status = 'alert') > 0 THEN 'alert' WHEN count(*) FILTER (status = 'watch') > 0 THEN 'watch' ELSE 'ok' END AS status,
    0.1::DOUBLE AS watch_threshold, 0.25::DOUBLE AS alert_threshold FROM features""",
)
def psi_status(t: Tables) -> DataFrame:
    ref, cur = drift_sides(t)
    return DR.drift_summary(DR.drift_features(ref, cur, DRIFT_COLUMNS), ref, cur)


_DIST_COLS = ["l_quantity", "l_tax"]


@query(
    "binned_shares", "D2",
    f"WITH {PSI_SQL} SELECT feature, side, bin::INT AS bin, count(*) AS n FROM b WHERE feature IN ('l_quantity', 'l_tax') GROUP BY ALL",
)
def binned_shares(t: Tables) -> DataFrame:
    ref, cur = drift_sides(t)
    found = DR.bin_edges(ref, cur, _DIST_COLS)
    edges = {r["feature"]: r["inner_edges"] for r in found.collect()}
    out = DR.binned(ref, edges).withColumn("side", F.lit("r")).unionByName(
        DR.binned(cur, edges).withColumn("side", F.lit("c"))
    )
    return out.select("feature", "side", "bin", "n")


# One decision per customer, from measures of their orders.
_SUBJECTS_SQL = """subjects AS (
  SELECT o_custkey AS subject, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day,
    max(o_totalprice) AS hi, min(o_totalprice) AS lo FROM orders GROUP BY 1)"""


def subjects(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("subject")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"), F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"),
    )


@query(
    "retrain_decision", "D6",
    f"""WITH {_SUBJECTS_SQL}, x AS (SELECT subject, hi > 460000 AS drift, lo < 12000 AS perf, last_day - first_day >= 2000 AS due, n % 2 = 0 AS labels FROM subjects),
    y AS (SELECT *, list_filter([CASE WHEN drift THEN 'data_drift_alert' END, CASE WHEN perf THEN 'performance_alert' END, CASE WHEN due THEN 'annual_review_due' END], lambda r: r IS NOT NULL) AS tr FROM x)
    SELECT subject, CASE WHEN len(tr) = 0 THEN 'monitor' WHEN labels THEN 'train_candidate' ELSE 'investigate_and_collect_labels' END AS action,
      len(tr) > 0 AND labels AS should_train_candidate, len(tr) > 0 AS requires_human_review,
      array_to_string(CASE WHEN len(tr) = 0 THEN ['no_trigger'] WHEN labels THEN tr ELSE list_concat(tr, ['fresh_labels_unavailable']) END, '|') AS reasons FROM y""",
)
def retrain_decision(t: Tables) -> DataFrame:
    rows = subjects(t).select(
        "subject", F.when(F.col("hi") > 460000, "alert").otherwise("ok").alias("drift_status"),
        F.col("first_day").alias("trained_on"), F.col("last_day").alias("as_of"),
        (F.col("n") % 2 == 0).alias("labels_available"), (F.col("lo") < 12000).alias("performance_alert"),
    )
    out = DC.retraining_decision(rows, interval_days=2000)
    return out.select(
        "subject", "action", "should_train_candidate", "requires_human_review", F.array_join("reasons", "|").alias("reasons")
    )


@query(
    "promotion_gate", "D7",
    f"""WITH {_SUBJECTS_SQL}, x AS (SELECT subject, CASE WHEN n % 11 <> 0 THEN 0.7 + hi / 2000003.0 END AS auc, CASE WHEN n % 13 <> 0 THEN 0.8 + lo / 500009.0 END AS rec,
      n / 100.0 AS gap, CASE WHEN n % 3 = 0 THEN 0.93 END AS prod, n % 2 = 0 AS ok FROM subjects),
    y AS (SELECT *, CASE WHEN auc IS NULL OR rec IS NULL THEN ['missing_metrics:' || array_to_string(list_filter([CASE WHEN auc IS NULL THEN 'auc_test' END, CASE WHEN rec IS NULL THEN 'recall_test' END], lambda r: r IS NOT NULL), ',')]
      ELSE list_filter([CASE WHEN auc < 0.85 THEN 'auc_below_0.85' END, CASE WHEN rec < 0.9 THEN 'recall_below_0.90' END, CASE WHEN gap > 0.1 THEN 'fairness_gap_above_0.10' END, CASE WHEN rec < prod THEN 'recall_regression_vs_production' END], lambda r: r IS NOT NULL) END AS f FROM x)
    SELECT subject, len(f) = 0 AS eligible_for_review, len(f) = 0 AND ok AS approved_for_production, array_to_string(CASE WHEN len(f) = 0 AND NOT ok THEN ['human_approval_required'] ELSE f END, '|') AS reasons FROM y""",
)
def promotion_gate(t: Tables) -> DataFrame:
    n = F.col("n")
    rows = subjects(t).select(
        "subject", F.when(n % 11 != 0, 0.7 + F.col("hi") / 2000003.0).alias("auc_test"),
        F.when(n % 13 != 0, 0.8 + F.col("lo") / 500009.0).alias("recall_test"),
        (n / 100.0).alias("fairness_recall_gap_test"), F.when(n % 3 == 0, 0.93).alias("production_recall"),
        (n % 2 == 0).alias("human_approved"),
    )
    out = DC.promotion_decision(rows)
    return out.select(
        "subject", "eligible_for_review", "approved_for_production", F.array_join("reasons", "|").alias("reasons")
    )


@query(
    "alert_step", "D8",
    f"""WITH {_SUBJECTS_SQL}, x AS (SELECT subject, CASE WHEN hi > 460000 THEN 'alert' WHEN hi > 400000 THEN 'watch' ELSE 'ok' END AS status, CASE WHEN n % 3 <> 0 THEN first_day END AS trig,
      CASE WHEN n % 2 = 0 THEN last_day END AS res, last_day FROM subjects)
    SELECT subject, status, status = 'alert' AND (NOT (trig IS NOT NULL AND res IS NULL) OR last_day - trig >= 2000) AS should_alert, status = 'ok' AND trig IS NOT NULL AND res IS NULL AS should_resolve FROM x""",
)
def alert_step(t: Tables) -> DataFrame:
    hi = F.col("hi")
    rows = subjects(t).select(
        "subject", F.when(hi > 460000, "alert").when(hi > 400000, "watch").otherwise("ok").alias("status"),
        F.col("last_day").cast("timestamp").alias("now"),
        F.when(F.col("n") % 3 != 0, F.col("first_day").cast("timestamp")).alias("triggered_at"),
        F.when(F.col("n") % 2 == 0, F.col("last_day").cast("timestamp")).alias("resolved_at"),
    )
    out = DC.alert_step(rows, cooldown_hours=2000 * 24)
    return out.select("subject", "status", "should_alert", "should_resolve")


_RUNS = "runs AS (SELECT event_type AS job, CAST(ts AS DATE) AS day, CASE WHEN max(value) > 45 THEN 'succeeded' ELSE 'failed' END AS status FROM events GROUP BY 1, 2)"


@query(
    "job_gate", "D9",
    f"""WITH {_RUNS}, w AS (SELECT j.job, d.day FROM (SELECT DISTINCT event_type AS job FROM events) j, (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d)
    SELECT w.job, CAST(w.day AS VARCHAR) AS day, CASE WHEN r.status = 'succeeded' THEN 'skipped' ELSE 'run' END AS outcome FROM w LEFT JOIN runs r ON w.job = r.job AND w.day = r.day""",
)
def job_gate(t: Tables) -> DataFrame:
    daily = t.events.groupBy(F.col("event_type").alias("job"), F.to_date("ts").alias("day")).agg(F.max("value").alias("m"))
    runs = daily.select("job", "day", F.when(F.col("m") > 45, "succeeded").otherwise("failed").alias("status"))
    # One row per job type: every day gets all of them.
    names = daily.agg(F.collect_set("job")).scalar()
    wanted = daily.select("day").distinct().select(F.explode(names).alias("job"), "day")
    return DC.job_outcomes(wanted, runs).withColumn("day", F.col("day").cast("string"))


@query(
    "model_aliases", "M13",
    """WITH e AS (SELECT o_orderkey AS event_id, CASE o_orderstatus WHEN 'O' THEN 'candidate' WHEN 'F' THEN 'production' ELSE 'archived' END AS alias, o_custkey AS version, o_orderdate AS moved_at FROM orders)
    SELECT alias, version, CAST(CAST(moved_at AS DATE) AS VARCHAR) AS day FROM e QUALIFY row_number() OVER (PARTITION BY alias ORDER BY moved_at DESC, event_id DESC) = 1""",
)
def model_aliases(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    moves = t.orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.when(status == "O", "candidate").when(status == "F", "production").otherwise("archived").alias("alias"),
        F.col("o_custkey").alias("version"), F.col("o_orderdate").alias("moved_at"),
    )
    return DC.current_aliases(moves).select("alias", "version", F.to_date("moved_at").cast("string").alias("day"))


@query(
    "run_metrics", "M14",
    "SELECT event_id, 'k' AS key, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events",
)
def run_metrics(t: Tables) -> DataFrame:
    from riskloom.sources.registry import flatten_metrics

    return flatten_metrics(t.events, "event_id", "props")


