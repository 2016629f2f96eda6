"""Aggregations: quality, groups, metrics, fairness."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom import constants as K
from riskloom.operators import cohort as C, quality as Q, scoring_metrics as M
from riskloom.queries.base import (
    LABELLED_SQL, LINES_SQL, SCORES_SQL, Tables, labelled, lines, members, query, r6, scores, sql_text,
)
from riskloom.queries.joins import BASE, scoped

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _distinct_count(sql: str) -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({sql}))"


# All rows of the table, some of them twice and a few three times.
_REPEATED = "SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size > 40 UNION ALL SELECT * FROM part WHERE p_size = 50"


def repeated_parts(t: Tables) -> DataFrame:
    return t.part.unionAll(t.part.where("p_size > 40")).unionAll(t.part.where("p_size = 50"))


@query(
    "dup_count", "A2",
    f"SELECT (SELECT count(*) FROM ({_REPEATED})) AS n_rows, (SELECT count(*) FROM ({_REPEATED})) - ({_distinct_count(_REPEATED)}) AS duplicates",
)
def dup_count(t: Tables) -> DataFrame:
    return Q.duplicate_count(repeated_parts(t))


@query(
    "quality_report", "A1",
    f"""SELECT (SELECT count(*) FROM ({_REPEATED})) AS rows_raw, (SELECT count(*) FROM ({_REPEATED})) - ({_distinct_count(_REPEATED)}) AS duplicates_raw,
    count(*) AS rows_after_cleaning, round(avg(CAST(d.p_size > 25 AS INT)), 6) AS target_rate, round(avg(CAST(b.n IS NOT NULL AS INT)), 6) AS join_coverage, 2 AS feature_count
    FROM (SELECT DISTINCT * FROM ({_REPEATED})) d LEFT JOIN (SELECT p_brand, count(*) AS n FROM part WHERE p_brand <> 'Brand#7' GROUP BY 1) b ON d.p_brand = b.p_brand""",
)
def quality_report(t: Tables) -> DataFrame:
    raw = repeated_parts(t)
    dims = t.part.where("p_brand <> 'Brand#7'").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    prepared = raw.dropDuplicates().join(dims, "p_brand", "left").withColumn("big", (F.col("p_size") > 25).cast("int"))
    report = Q.quality_report(raw, prepared, ["n"], "big", 2)
    return report.withColumns({c: r6(c) for c in ("target_rate", "join_coverage")})


_MISSING = {
    "event_type": "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END",
    "value": "CASE WHEN value < 5 THEN NULL ELSE value END", "user_id": "user_id",
}


@query(
    "missing_rates", "A3",
    f"""WITH m AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _MISSING.items())} FROM events),
    r AS (SELECT 'event_type' AS col, avg(CAST(event_type IS NULL AS INT)) AS x FROM m UNION ALL SELECT 'value', avg(CAST(value IS NULL AS INT)) FROM m UNION ALL SELECT 'user_id', avg(CAST(user_id IS NULL AS INT)) FROM m)
    SELECT col AS "column", round(x, 6) AS missing_rate FROM r WHERE x > 0""",
)
def missing_rates(t: Tables) -> DataFrame:
    rows = t.events.select(*[F.expr(e).alias(c) for c, e in _MISSING.items()])
    return Q.missing_rates(rows).withColumn("missing_rate", r6("missing_rate"))


@query(
    "completeness_alerts", "D12",
    f"""WITH m AS (SELECT {", ".join(f"{e} AS {c}" for c, e in _MISSING.items())} FROM events),
    r AS (SELECT 'event_type' AS col, avg(CAST(event_type IS NULL AS INT)) AS x FROM m UNION ALL SELECT 'value', avg(CAST(value IS NULL AS INT)) FROM m UNION ALL SELECT 'user_id', avg(CAST(user_id IS NULL AS INT)) FROM m)
    SELECT col AS "column", round(x, 6) AS missing_rate, x > 0.2 AS alert FROM r""",
)
def completeness_alerts(t: Tables) -> DataFrame:
    rows = t.events.select(*[F.expr(e).alias(c) for c, e in _MISSING.items()])
    return Q.completeness_alerts(rows).withColumn("missing_rate", r6("missing_rate"))


@query(
    "group_means", "A4",
    "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, count(*) AS n, round((SELECT avg(l_quantity) FROM lineitem), 6) AS overall_mean FROM lineitem GROUP BY 1",
)
def group_means(t: Tables) -> DataFrame:
    out = Q.group_means(t.lineitem, "l_returnflag", "l_quantity")
    return out.withColumns({"mean": r6("mean"), "overall_mean": r6("overall_mean")})


@query(
    "decoy_std", "A5",
    """WITH m AS (SELECT 'l_returnflag' AS col, avg(l_quantity) AS m FROM lineitem GROUP BY l_returnflag UNION ALL SELECT 'l_linestatus', avg(l_quantity) FROM lineitem GROUP BY l_linestatus
      UNION ALL SELECT 'l_linenumber', avg(l_quantity) FROM lineitem GROUP BY l_linenumber)
    SELECT col AS "column", round(stddev_samp(m), 6) AS spread, count(*) AS groups FROM m GROUP BY 1""",
)
def decoy_std(t: Tables) -> DataFrame:
    out = Q.decoy_spread(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"], "l_quantity")
    return out.withColumn("spread", r6("spread"))


@query(
    "corr_matrix", "A6",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, CASE WHEN l_linestatus = 'O' OR '{b}' <> 'l_tax' THEN {b} END), 5) AS corr FROM lineitem"
        for i, a in enumerate(LINE_NUMBERS) for b in LINE_NUMBERS[i + 1:]
    ),
)
def corr_matrix(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("l_tax", F.when(F.col("l_linestatus") == "O", F.col("l_tax")))
    return Q.correlations(rows, LINE_NUMBERS).withColumn("corr", r6("corr", 5))


@query("value_counts", "A7", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(t: Tables) -> DataFrame:
    return Q.value_counts(t.events, "event_type")


@query(
    "sample_values", "A8",
    """WITH v AS (SELECT DISTINCT 'p_brand' AS col, p_brand AS v FROM part UNION ALL SELECT DISTINCT 'p_type', p_type FROM part)
    SELECT col AS "column", v AS value, row_number() OVER (PARTITION BY col ORDER BY v) AS position FROM v QUALIFY position <= 6""",
)
def sample_values(t: Tables) -> DataFrame:
    return Q.sample_values(t.part, ["p_brand", "p_type"]).withColumn("position", F.col("position").cast("long"))


ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query(
    "source_inventory", "A9",
    " UNION ALL ".join(
        f"SELECT '{n}' AS source, count(*) AS n_rows, (SELECT count(*)::INT FROM (DESCRIBE {n})) AS n_columns FROM {n}" for n in ALL_TABLES
    ),
)
def source_inventory(t: Tables) -> DataFrame:
    return Q.inventory({n: getattr(t, n) for n in ALL_TABLES})


@query(
    "class_density", "A10",
    """WITH b AS (SELECT CAST(l_returnflag = 'R' AS INT) AS label, least(29, CAST(floor((l_extendedprice - lo) / (hi - lo) * 30) AS INT)) AS bin
      FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem))
    SELECT label, bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM b GROUP BY 1, 2""",
)
def class_density(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return Q.class_density(rows, "y", "l_extendedprice").withColumn("share", r6("share"))


# --- classification metrics -------------------------------------------------

_CONFUSION = """count(*) FILTER (y <> 1 AND flag <> 1) AS tn, count(*) FILTER (y <> 1 AND flag = 1) AS fp,
  count(*) FILTER (y = 1 AND flag <> 1) AS fn, count(*) FILTER (y = 1 AND flag = 1) AS tp"""


@query("confusion", "A11", f"WITH {LABELLED_SQL} SELECT {_CONFUSION} FROM labelled")
def confusion(t: Tables) -> DataFrame:
    return M.confusion(labelled(t), "y", "flag")


@query(
    "prf", "A13",
    f"""WITH {LINES_SQL}, c AS (SELECT {_CONFUSION} FROM lines)
    SELECT tn, fp, fn, tp, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c""",
)
def prf(t: Tables) -> DataFrame:
    out = M.precision_recall(lines(t), "y", "flag")
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


GRID_SQL = "grid AS (SELECT unnest([" + ", ".join(f"{x!r}::DOUBLE" for x in K.threshold_grid()) + "]) AS threshold)"
CURVE_SQL = f"""{GRID_SQL}, curve AS (
  SELECT threshold, count(*) FILTER (y <> 1 AND s < threshold) AS tn, count(*) FILTER (y <> 1 AND s >= threshold) AS fp,
    count(*) FILTER (y = 1 AND s < threshold) AS fn, count(*) FILTER (y = 1 AND s >= threshold) AS tp
  FROM labelled CROSS JOIN grid GROUP BY threshold)"""
_CURVE_COLS = """round(threshold, 6) AS threshold, tn, fp, fn, tp, 5.0 * fn + fp AS cost,
  CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0 END AS recall, CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0 END AS precision"""


def _shown_curve(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in ("threshold", "recall", "precision")})


@query("threshold_curve", "A12", f"WITH {LABELLED_SQL}, {CURVE_SQL} SELECT {_CURVE_COLS.replace('5.0 * fn + fp', 'CAST(5.0 * fn + fp AS DOUBLE)')} FROM curve")
def threshold_curve(t: Tables) -> DataFrame:
    return _shown_curve(M.threshold_curve(labelled(t), "y", "s"))


@query(
    "cheapest_threshold", "A12",
    f"WITH {LABELLED_SQL}, {CURVE_SQL} SELECT {_CURVE_COLS.replace('5.0 * fn + fp', 'CAST(5.0 * fn + fp AS DOUBLE)')} FROM curve ORDER BY cost, curve.threshold LIMIT 1",
)
def cheapest_threshold(t: Tables) -> DataFrame:
    return _shown_curve(M.cheapest_threshold(labelled(t), "y", "s"))


def _counts_sql(source: str) -> str:
    return f"c AS (SELECT s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n FROM {source} GROUP BY s)"


def _auc_sql(source: str) -> str:
    return f"""{_counts_sql(source)}, k AS (SELECT p, n, sum(p + n) OVER (ORDER BY s) - (p + n) + (p + n + 1) / 2.0 AS r FROM c)
    SELECT round((sum(p * r) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * sum(n)), 6) AS auc, sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives FROM k"""


@query("roc_auc", "A14", f"WITH {LINES_SQL}, {_auc_sql('lines')}")
def roc_auc(t: Tables) -> DataFrame:
    return M.roc_auc(lines(t), "y", "s").withColumn("auc", r6("auc"))


@query("roc_auc_labels", "A14", f"WITH {LABELLED_SQL}, {_auc_sql('labelled')}")
def roc_auc_labels(t: Tables) -> DataFrame:
    return M.roc_auc(labelled(t), "y", "s").withColumn("auc", r6("auc"))


@query(
    "avg_precision", "A15",
    f"""WITH {LINES_SQL}, {_counts_sql('lines')}, k AS (SELECT p, sum(p) OVER w AS tp, sum(p + n) OVER w AS m FROM c WINDOW w AS (ORDER BY s DESC))
    SELECT round(sum(p * tp / m) / sum(p), 6) AS average_precision FROM k""",
)
def avg_precision(t: Tables) -> DataFrame:
    return M.average_precision(lines(t), "y", "s").withColumn("average_precision", r6("average_precision"))


@query(
    "roc_points", "A16",
    f"""WITH {LABELLED_SQL}, {_counts_sql('labelled')}, k AS (SELECT s, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM c WINDOW w AS (ORDER BY s DESC))
    SELECT round(s, 6) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(fp / (SELECT sum(n) FROM c), 6) AS fpr, round(tp / (SELECT sum(p) FROM c), 6) AS tpr FROM k""",
)
def roc_points(t: Tables) -> DataFrame:
    out = M.roc_points(labelled(t), "y", "s")
    return out.withColumns({c: r6(c) for c in ("threshold", "fpr", "tpr")})


@query(
    "reg_metrics", "A17",
    """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500.5 + 210.0 AS f FROM lineitem)
    SELECT round(avg(abs(y - f)), 3) AS mae, round(sqrt(avg((y - f) * (y - f))), 3) AS rmse, round(1 - avg((y - f) * (y - f)) / var_pop(y), 6) AS r2 FROM p""",
)
def reg_metrics(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.5 + 210.0).alias("f")
    )
    out = M.regression_metrics(rows, "y", "f")
    return out.withColumns({"mae": r6("mae", 3), "rmse": r6("rmse", 3), "r2": r6("r2")})


_SUBGROUPS = """g AS (SELECT 'lang' AS col, CASE WHEN lang = 'en' THEN 'missing' ELSE lang END AS v, y, flag FROM labelled UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), y, flag FROM labelled),
  k AS (SELECT col, v, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 1 AND flag = 1) AS tp FROM g GROUP BY 1, 2 HAVING count(*) FILTER (y = 1) > 0)"""


def _subgrouped(t: Tables) -> DataFrame:
    return labelled(t).withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))


@query(
    "subgroup_gap", "A18",
    f"""WITH {LABELLED_SQL}, {_SUBGROUPS} SELECT col AS "column", count(*) AS groups, round(CASE WHEN count(*) >= 2 THEN max(tp / pos) - min(tp / pos) END, 6) AS gap FROM k GROUP BY col""",
)
def subgroup_gap(t: Tables) -> DataFrame:
    return M.subgroup_recall_gap(_subgrouped(t), ["lang", "toxic"], "y", "flag").withColumn("gap", r6("gap"))


@query(
    "largest_gap", "A18",
    f"""WITH {LABELLED_SQL}, {_SUBGROUPS}, q AS (SELECT CASE WHEN count(*) >= 2 THEN max(tp / pos) - min(tp / pos) END AS gap FROM k GROUP BY col) SELECT round(coalesce(max(gap), 0), 6) AS gap FROM q""",
)
def largest_gap(t: Tables) -> DataFrame:
    return M.largest_recall_gap(_subgrouped(t), ["lang", "toxic"], "y", "flag").withColumn("gap", r6("gap"))


@query(
    "fairness_audit", "A19 F9",
    f"""WITH {LABELLED_SQL}, g AS (SELECT 'lang' AS col, lang AS v, y, flag FROM labelled UNION ALL SELECT 'source', source, y, flag FROM labelled)
    SELECT col AS "column", v AS value, count(*) AS size, round(avg(y), 6) AS actual_rate, round(avg(flag), 6) AS alert_rate,
      round(count(*) FILTER (y = 1 AND flag = 1) / nullif(count(*) FILTER (y = 1), 0), 6) AS recall FROM g GROUP BY 1, 2 HAVING count(*) >= 20""",
)
def fairness_audit(t: Tables) -> DataFrame:
    out = M.fairness_audit(labelled(t), ["lang", "source"], "y", "flag")
    return out.withColumns({c: r6(c) for c in ("actual_rate", "alert_rate", "recall")})


@query(
    "monitored_periods", "D13",
    f"""WITH p AS (SELECT year(l_shipdate) AS period, CAST(l_returnflag = 'R' AS INT) AS y, l_extendedprice / 105001.0::DOUBLE AS s, CAST(l_extendedprice / 105001.0::DOUBLE >= 0.4 AS INT) AS flag, l_linestatus AS g FROM lineitem),
    r AS (SELECT period, count(*) FILTER (y = 1 AND flag = 1) / nullif(count(*) FILTER (y = 1), 0) AS recall FROM p GROUP BY 1),
    c AS (SELECT period, s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n FROM p GROUP BY 1, 2),
    k AS (SELECT period, p, n, sum(p + n) OVER (PARTITION BY period ORDER BY s) - (p + n) + (p + n + 1) / 2.0 AS rk FROM c),
    a AS (SELECT period, (sum(p * rk) - sum(p) * (sum(p) + 1) / 2.0) / nullif(sum(p) * sum(n), 0) AS auc FROM k GROUP BY 1),
    g AS (SELECT period, g, avg(flag) AS rate, count(*) FILTER (y = 1 AND flag = 1) / nullif(count(*) FILTER (y = 1), 0) AS rec FROM p GROUP BY 1, 2),
    h AS (SELECT period, max(rate) - min(rate) AS rate_gap, max(rec) - min(rec) AS rec_gap FROM g GROUP BY 1),
    z AS (SELECT r.period, recall, auc, rec_gap, rate_gap, lag(recall) OVER (ORDER BY r.period) - recall AS recall_drop FROM r JOIN a ON r.period = a.period JOIN h ON r.period = h.period)
    SELECT CAST(period AS INT) AS period, round(recall, 5) AS recall, round(auc, 5) AS auc, round(rec_gap, 5) AS recall_gap, round(rate_gap, 5) AS alert_rate_gap, round(recall_drop, 5) AS recall_drop,
      coalesce(auc < 0.85, false) OR coalesce(recall_drop > 0.1, false) OR coalesce(rec_gap > 0.1, false) OR coalesce(rate_gap > 0.1, false) AS alert FROM z""",
)
def monitored_periods(t: Tables) -> DataFrame:
    rows = lines(t).select("y", "s", "flag", F.col("l_linestatus").alias("g"))
    s = F.col("l_extendedprice") / F.lit(105001.0)
    rows = t.lineitem.select(
        F.year("l_shipdate").alias("period"), (F.col("l_returnflag") == "R").cast("int").alias("y"), s.alias("s"),
        (s >= 0.4).cast("int").alias("flag"), F.col("l_linestatus").alias("g"),
    )
    out = M.monitored_periods(rows, "period", "y", "flag", "s", ["g"])
    return out.withColumns({c: r6(c, 5) for c in ("recall", "auc", "recall_gap", "alert_rate_gap", "recall_drop")})


# --- cohort aggregates ------------------------------------------------------


@query("count_scores", "A20", f"{BASE} SELECT count(*) AS total, coalesce(sum(alerte), 0)::BIGINT AS alerts FROM scoped")
def count_scores(t: Tables) -> DataFrame:
    return C.counts(scoped(t))


def group_sql(source: str, group: str, score: str, alert: str) -> str:
    stats = """SELECT g AS filiere, agg AS aggregated, count(*) AS effectif, sum(a)::BIGINT AS alertes, round(sum(a) / count(*), 6) AS taux_alerte,
      round(median(s), 6) AS proba_mediane, list_sort(list(s)) AS xs, count(*) AS n FROM z GROUP BY 1, 2 HAVING count(*) >= 5"""
    return f"""n AS (SELECT coalesce(CASE WHEN lower(trim({group})) NOT IN ('', 'nan', 'none', 'null', 'na') THEN trim({group}) END, {sql_text(K.UNKNOWN_GROUP_LABEL)}) AS g, {score} AS s, {alert} AS a FROM {source}),
    q AS (SELECT g, count(*) AS m FROM n GROUP BY 1),
    z AS (SELECT CASE WHEN m < 5 THEN {sql_text(K.SMALL_GROUPS_LABEL)} ELSE n.g END AS g, m < 5 AS agg, s, a FROM n JOIN q ON n.g = q.g),
    t AS ({stats}),
    j AS (SELECT *, greatest(1, least(n - 1, (n + 1) * 9 // 10)) AS j FROM t)
    SELECT filiere, aggregated, effectif, alertes, taux_alerte, proba_mediane,
      round(CASE WHEN n = 1 THEN xs[1] ELSE (xs[j] * (10 - ((n + 1) * 9 - j * 10)) + xs[j + 1] * ((n + 1) * 9 - j * 10)) / 10.0 END, 6) AS proba_decile_sup,
      (SELECT count(*) FROM q WHERE m < 5) AS hidden_groups FROM j"""


def _shown_groups(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in ("taux_alerte", "proba_mediane", "proba_decile_sup")})


@query(
    "group_privacy_stats", "A21 A22 A23 U2",
    "WITH s AS (SELECT n_name, s_acctbal / 10007.0::DOUBLE AS sc, CAST(s_acctbal / 10007.0::DOUBLE >= 0.5 AS INT) AS al FROM supplier JOIN nation ON s_nationkey = n_nationkey), "
    + group_sql("s", "n_name", "sc", "al"),
)
def group_privacy_stats(t: Tables) -> DataFrame:
    score = F.col("s_acctbal") / F.lit(10007.0)
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", score.alias("sc"), (score >= 0.5).cast("int").alias("al")
    )
    return _shown_groups(C.group_statistics(rows, "n_name", "sc", "al")).withColumnRenamed("n_name", "filiere")


@query(
    "programme_stats", "A21 A22 A23 O5",
    f"{BASE}, " + group_sql("scoped", "filiere", "proba_abandon", "alerte"),
)
def programme_stats(t: Tables) -> DataFrame:
    out = C.group_statistics(scoped(t), "filiere", "proba_abandon", "alerte")
    return _shown_groups(out).orderBy(*C.presentation_order())


_EDGES = [(i, i * 0.1, i * 0.1 + 0.1) for i in range(10)]


@query(
    "histogram_fixed", "A24",
    f"""WITH {SCORES_SQL}, e(bin, lo, hi) AS (VALUES {", ".join(f"({i}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for i, lo, hi in _EDGES)})
    SELECT bin, round(lo, 6) AS lower, round(hi, 6) AS upper, count(id) AS n FROM e LEFT JOIN scores ON proba_abandon >= lo AND (proba_abandon < hi OR (bin = 9 AND proba_abandon <= hi)) GROUP BY 1, 2, 3""",
)
def histogram_fixed(t: Tables) -> DataFrame:
    out = C.fixed_histogram(scores(t), "proba_abandon")
    return out.withColumns({"lower": r6("lower"), "upper": r6("upper")})


@query("audit_counts", "A27", "SELECT event_type AS action, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC")
def audit_counts(t: Tables) -> DataFrame:
    return Q.value_counts(t.events.withColumnRenamed("event_type", "action"), "action").orderBy(F.col("n").desc())


@query("label_gate", "A30", "SELECT bool_and(l.quality IS NOT NULL) AS complete FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def label_gate(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.agg(F.bool_and(F.col("quality").isNotNull()).alias("complete"))


_RUNS = "SELECT l_returnflag || l_linestatus AS label, avg(l_quantity) AS duration_s, avg(l_discount) AS auc FROM lineitem GROUP BY 1"


@query(
    "cost_gain_table", "A31",
    f"""WITH r AS ({_RUNS}), b AS (SELECT * FROM r WHERE label = 'AF')
    SELECT r.label AS model, round(r.duration_s / b.duration_s, 6) AS cost_ratio, round(r.auc - b.auc, 8) AS gain,
      CASE WHEN r.auc - b.auc > 0 THEN round((r.duration_s - b.duration_s) / (r.auc - b.auc), 1) ELSE 'Infinity'::DOUBLE END AS cost_per_point FROM r, b""",
)
def cost_gain_table(t: Tables) -> DataFrame:
    runs = t.lineitem.groupBy(F.concat("l_returnflag", "l_linestatus").alias("label")).agg(
        F.avg("l_quantity").alias("duration_s"), F.avg("l_discount").alias("auc")
    ).withColumns({"energy_kwh": F.lit(None).cast("double"), "emissions_kg": F.lit(None).cast("double")})
    table = M.cost_table(M.run_summary(runs), "model", "auc", "duration_s", "AF")
    return table.select(
        "model", r6("cost_ratio").alias("cost_ratio"), r6("gain", 8).alias("gain"),
        F.when(F.col("gain") > 0, F.round("cost_per_point", 1)).otherwise(F.col("cost_per_point")).alias("cost_per_point"),
    )


@query(
    "metric_sheet", "A33",
    f"""WITH {LINES_SQL}, c AS (SELECT {_CONFUSION} FROM lines), m AS (SELECT 'recall_test' AS key, tp / (tp + fn) AS v FROM c UNION ALL SELECT 'precision_test', tp / (tp + fp) FROM c UNION ALL SELECT 'n_test', (tn + fp + fn + tp)::DOUBLE FROM c UNION ALL SELECT 'other', 1.0 FROM c)
    SELECT key, CASE key WHEN 'recall_test' THEN {sql_text(K.METRIC_LABELS['recall_test'])} WHEN 'precision_test' THEN {sql_text(K.METRIC_LABELS['precision_test'])} ELSE {sql_text(K.METRIC_LABELS['n_test'])} END AS label,
      CASE WHEN key = 'n_test' THEN printf('%.0f', v) ELSE printf('%.3f', v) END AS text FROM m WHERE key <> 'other'""",
)
def metric_sheet(t: Tables) -> DataFrame:
    wide = M.precision_recall(lines(t), "y", "flag").select(
        F.col("recall").alias("recall_test"), F.col("precision").alias("precision_test"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("double").alias("n_test"), F.lit(1.0).alias("other"),
    )
    return M.metric_sheet(wide.unpivot([], wide.columns, "key", "value")).select("key", "label", "text")


__all__ = ["group_sql", "members"]
