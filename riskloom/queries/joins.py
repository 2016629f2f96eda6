"""Joins, filters, ranks, pages, histories and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.operators import cleaning as CL, cohort as C, ordered as R, perimeter as PM
from riskloom.queries.base import SCORES_SQL, Tables, members, query, r6, scores

LATEST_SQL = """latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, student_id ORDER BY id DESC) AS rn FROM scores) WHERE rn = 1)"""
SCOPED_SQL = """scoped AS (
  SELECT l.id, l.student_id, l.proba_abandon, l.alerte, l.batch_id, m.filiere FROM latest l LEFT JOIN members m ON l.student_id = m.student_id)"""
BASE = f"WITH {SCORES_SQL}, {LATEST_SQL}, {SCOPED_SQL}"
SCOPE = ["NATION_3", "NATION_7", "NATION_11"]
SCOPE_LIST = "'NATION_3', 'NATION_7', 'NATION_11'"


def latest(t: Tables) -> DataFrame:
    return C.latest_per(scores(t), ["batch_id", "student_id"], [F.col("id").desc()])


def scoped(t: Tables, scope=None) -> DataFrame:
    return C.with_groups(latest(t), members(t), ["student_id"], "filiere", scope).select(
        "id", "student_id", "proba_abandon", "alerte", "batch_id", "filiere"
    )


# --- joins ------------------------------------------------------------------

_HELD_OUT = "CASE WHEN c_nationkey IN (4, 9) THEN ' unknown' ELSE lower(n_name) END"


@query(
    "enrich_left", "J1 C8 C9",
    """SELECT c.c_custkey, coalesce('Nation_' || CAST(c.c_nationkey AS VARCHAR)) AS filiere, n.n_regionkey, r.r_name
    FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_nationkey NOT IN (4, 9)) n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def enrich_left(t: Tables) -> DataFrame:
    people = t.customer.select(
        "c_custkey", F.concat(F.lit(" NATION_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("filiere")
    )
    dims = (
        t.nation.where(~F.col("n_nationkey").isin(4, 9))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.lower("n_name").alias("filiere"), "n_regionkey", "r_name")
    )
    return CL.enrich(people, dims, require_unique=True)


@query(
    "join_coverage", "J8",
    "SELECT round(avg(CAST(n.n_nationkey IS NOT NULL AS INT)), 6) AS coverage FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_nationkey NOT IN (4, 9)) n ON c.c_nationkey = n.n_nationkey",
)
def join_coverage(t: Tables) -> DataFrame:
    people = t.customer.select(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("filiere"))
    dims = t.nation.where(~F.col("n_nationkey").isin(4, 9)).select(F.col("n_name").alias("filiere"), "n_regionkey")
    return CL.join_coverage(CL.enrich(people, dims), ["n_regionkey"]).select(r6("coverage").alias("coverage"))


@query(
    "scores_with_groups", "J2 J7",
    f"{BASE} SELECT id, student_id, batch_id, alerte, round(proba_abandon, 6) AS proba, filiere FROM scoped",
)
def scores_with_groups(t: Tables) -> DataFrame:
    return scoped(t).select("id", "student_id", "batch_id", "alerte", r6("proba_abandon").alias("proba"), "filiere")


@query(
    "scoped_rows", "J3 F4",
    f"{BASE} SELECT id, student_id, batch_id, filiere FROM scoped WHERE filiere IN ({SCOPE_LIST})",
)
def scoped_rows(t: Tables) -> DataFrame:
    return scoped(t, SCOPE).select("id", "student_id", "batch_id", "filiere")


@query(
    "scope_empty", "F4",
    f"{BASE} SELECT id, filiere FROM scoped WHERE false",
)
def scope_empty(t: Tables) -> DataFrame:
    return scoped(t, []).select("id", "filiere")


@query(
    "latest_ids", "J4",
    f"WITH {SCORES_SQL} SELECT id, batch_id, student_id FROM scores WHERE id IN (SELECT max(id) FROM scores GROUP BY batch_id, student_id)",
)
def latest_ids(t: Tables) -> DataFrame:
    return C.latest_ids(scores(t).select("id", "batch_id", "student_id"), ["batch_id", "student_id"], "id")


@query(
    "missing_parents", "J5",
    "SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')",
)
def missing_parents(t: Tables) -> DataFrame:
    parents = t.customer.where(F.col("c_mktsegment") != "BUILDING")
    return C.missing_parents(t.orders.withColumnRenamed("o_custkey", "c_custkey"), parents, "c_custkey")


_BATCHES_SQL = """batches AS (
  SELECT 'B' || CAST(year(o_orderdate) AS VARCHAR) AS batch_id, max(o_orderdate) + INTERVAL 365 DAY AS expires_at FROM orders GROUP BY 1)"""


def batches(t: Tables) -> DataFrame:
    return scores(t).groupBy("batch_id").agg(
        (F.max("created_at") + F.make_dt_interval(F.lit(365))).alias("expires_at")
    )


def cutoff():
    return F.lit("1999-06-30 00:00:00").cast("timestamp_ntz")


@query(
    "purge_survivors", "J6 F6",
    f"WITH {SCORES_SQL}, {_BATCHES_SQL} SELECT id, batch_id FROM scores WHERE batch_id NOT IN (SELECT batch_id FROM batches WHERE expires_at <= TIMESTAMP '1999-06-30')",
)
def purge_survivors(t: Tables) -> DataFrame:
    expired, _ = C.split_survivors(batches(t), cutoff())
    return C.without_batches(scores(t), expired).select("id", "batch_id")


@query(
    "common_columns", "J9",
    "SELECT 'left' AS side, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer UNION ALL SELECT 'right', count(*), round(sum(s_acctbal), 2) FROM supplier",
)
def common_columns(t: Tables) -> DataFrame:
    left = t.customer.withColumnsRenamed({"c_acctbal": "acctbal", "c_nationkey": "nationkey"})
    right = t.supplier.withColumnsRenamed({"s_acctbal": "acctbal", "s_nationkey": "nationkey"})
    shared = [c for c in PM.common_columns(left, right)]
    both = left.select(*shared, F.lit("left").alias("side")).unionByName(
        right.select(*shared, F.lit("right").alias("side"))
    )
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("acctbal"), 2).alias("total"))


@query(
    "visible_groups", "J10 A28",
    f"SELECT DISTINCT n_name AS filiere FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ({SCOPE_LIST}) AND n_nationkey <> 7",
)
def visible_groups(t: Tables) -> DataFrame:
    named = members(t).withColumn("filiere", F.when(F.col("filiere") == "NATION_7", " nan ").otherwise(F.col("filiere")))
    return C.visible_groups(named, "filiere", [*SCOPE, " nan "])


# --- filters ----------------------------------------------------------------


@query(
    "filtered_rows", "F1 F2 F3",
    f"{BASE} SELECT id, batch_id, filiere FROM scoped WHERE batch_id = 'B1998' AND alerte = 1 AND filiere = 'NATION_3'",
)
def filtered_rows(t: Tables) -> DataFrame:
    titled = scoped(t).withColumn("filiere", F.initcap("filiere"))
    rows = C.filtered(titled, "B1998", " nation_3 ", alerts_only=True)
    return rows.select("id", "batch_id", F.upper("filiere").alias("filiere"))


@query(
    "threshold_sim", "A25 F5",
    f"{BASE} SELECT count(*) AS alerts FROM scoped WHERE proba_abandon >= 0.35",
)
def threshold_sim(t: Tables) -> DataFrame:
    return C.alerts_at(scoped(t), "proba_abandon", 0.35)


@query(
    "split_masks", "F7",
    """WITH s AS (SELECT doc_id, quality, CASE WHEN doc_id % 5 = 0 THEN 'test' WHEN doc_id % 5 = 1 THEN 'validation' ELSE 'train' END AS split_set FROM labels)
    SELECT split_set, count(*) AS n, sum(quality)::BIGINT AS positives FROM s GROUP BY 1""",
)
def split_masks(t: Tables) -> DataFrame:
    from riskloom.operators import splitting as S

    part = F.when(F.col("doc_id") % 5 == 0, "test").when(F.col("doc_id") % 5 == 1, "validation").otherwise("train")
    marked = t.labels.withColumn("split_set", part)
    out = None
    for name in ("train", "validation", "test"):
        rows = S.rows_in(marked, name)
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("split_set").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("positives"))


@query(
    "displayable_factors", "F8",
    """WITH f AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'sexe' WHEN 2 THEN 'boursier' WHEN 3 THEN 'jours_inscription' WHEN 4 THEN NULL ELSE 'motivation' END AS source FROM lineitem)
    SELECT l_orderkey, l_linenumber, source FROM f WHERE source IS NULL OR source NOT IN ('sexe', 'boursier', 'etablissement_origine', 'distance_domicile_km', 'heures_travail_remunere_sem', 'charge_travail_externe', 'jours_inscription')""",
)
def displayable_factors(t: Tables) -> DataFrame:
    from riskloom.functions import display as D

    n = F.col("l_linenumber")
    source = (
        F.when(n == 1, "sexe").when(n == 2, "boursier").when(n == 3, "jours_inscription")
        .when(n == 4, F.lit(None)).otherwise("motivation")
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", source.alias("source")).where(D.displayable("source"))


@query(
    "numeric_values", "F10",
    """WITH m AS (SELECT event_id, CASE event_type WHEN 'view' THEN CAST(value AS VARCHAR) WHEN 'click' THEN 'n/a' WHEN 'error' THEN NULL ELSE 'NaN' END AS x FROM events)
    SELECT event_id, round(TRY_CAST(x AS DOUBLE), 6) AS value FROM m WHERE TRY_CAST(x AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(x AS DOUBLE))""",
)
def numeric_values(t: Tables) -> DataFrame:
    from riskloom.functions import numbers as N

    kind = F.col("event_type")
    x = (
        F.when(kind == "view", F.col("value").cast("string")).when(kind == "click", "n/a")
        .when(kind == "error", F.lit(None)).otherwise("NaN")
    )
    rows = t.events.select("event_id", N.nan_to_null(x.try_cast("double")).alias("value"))
    return rows.where(F.col("value").isNotNull()).withColumn("value", r6("value"))


# --- windows, ranks, pages --------------------------------------------------


@query(
    "latest_per_key", "W1",
    f"WITH {SCORES_SQL}, {LATEST_SQL} SELECT id, batch_id, student_id, alerte FROM latest",
)
def latest_per_key(t: Tables) -> DataFrame:
    return latest(t).select("id", "batch_id", "student_id", "alerte")


@query(
    "risk_ranks", "W2",
    f"{BASE} SELECT id, row_number() OVER (ORDER BY proba_abandon DESC, id) AS rank FROM scoped",
)
def risk_ranks(t: Tables) -> DataFrame:
    return C.ranked(scoped(t), "proba_abandon", "id").select("id", "rank")


@query(
    "ranked_page", "O1 W2",
    f"{BASE} SELECT id, student_id, row_number() OVER (ORDER BY proba_abandon DESC, id) AS rank FROM scoped QUALIFY rank BETWEEN 101 AND 150",
)
def ranked_page(t: Tables) -> DataFrame:
    return C.page(scoped(t), "proba_abandon", "id", 3, 50).select("id", "student_id", "rank")


@query(
    "page_info", "O1 A20",
    f"{BASE} SELECT count(*) AS total, sum(alerte)::BIGINT AS alerts, CAST(greatest(1, ceil(count(*) / 50.0)) AS BIGINT) AS pages, true AS has_previous, 3 < ceil(count(*) / 50.0) AS has_next FROM scoped",
)
def page_info(t: Tables) -> DataFrame:
    return C.page_info(scoped(t), 3, 50)


@query(
    "top_k", "O2",
    f"{BASE} SELECT id, round(proba_abandon, 6) AS proba FROM scoped ORDER BY proba_abandon DESC, id LIMIT 100",
)
def top_k(t: Tables) -> DataFrame:
    return C.top(scoped(t), "proba_abandon", "id", 100).select("id", r6("proba_abandon").alias("proba"))


@query(
    "top_k_coverage", "A26",
    f"{BASE}, k AS (SELECT alerte FROM scoped ORDER BY proba_abandon DESC, id LIMIT 200) SELECT (SELECT sum(alerte) FROM k)::BIGINT AS covered, sum(alerte)::BIGINT AS alerts, round((SELECT sum(alerte) FROM k) / sum(alerte), 6) AS coverage FROM scoped",
)
def top_k_coverage(t: Tables) -> DataFrame:
    return C.top_coverage(scoped(t), "proba_abandon", "id", 200).withColumn("coverage", r6("coverage"))


@query(
    "recent_batches", "O3",
    f"WITH {SCORES_SQL}, {_BATCHES_SQL} SELECT batch_id FROM batches ORDER BY expires_at DESC LIMIT 3",
)
def recent_batches(t: Tables) -> DataFrame:
    return C.most_recent(batches(t), [F.col("expires_at").desc()], 3).select("batch_id")


@query(
    "score_history", "W3",
    f"""WITH {SCORES_SQL} SELECT id, student_id, round(lag(proba_abandon) OVER (PARTITION BY student_id ORDER BY created_at, id), 6) AS previous_score FROM scores""",
)
def score_history(t: Tables) -> DataFrame:
    out = C.history(scores(t), "student_id", ["created_at", "id"], "proba_abandon", F.year("created_at"))
    return out.select("id", "student_id", r6("previous_score").alias("previous_score"))


@query(
    "history_trend", "W4 P34",
    f"""WITH {SCORES_SQL}, e AS (SELECT student_id, count(*) AS scores, arg_min(proba_abandon, (created_at, id)) AS a, arg_max(proba_abandon, (created_at, id)) AS b FROM scores GROUP BY 1)
    SELECT student_id, scores, round(b - a, 6) AS delta, CASE WHEN scores > 1 THEN CASE WHEN b - a > 0.05 THEN 'worse' WHEN b - a < -0.05 THEN 'better' ELSE 'stable' END END AS trend FROM e""",
)
def history_trend(t: Tables) -> DataFrame:
    out = C.history_trend(scores(t), "student_id", ["created_at", "id"], "proba_abandon")
    return out.select("student_id", "scores", r6("delta").alias("delta"), "trend")


@query(
    "load_order", "W5",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders",
)
def load_order(t: Tables) -> DataFrame:
    return R.global_rank(t.orders.select("o_orderkey"), [F.col("o_orderkey")], "row_number")


@query(
    "latest_batch", "W6",
    f"WITH {SCORES_SQL} SELECT arg_max(batch_id, (created_at, id)) AS batch_id FROM scores",
)
def latest_batch(t: Tables) -> DataFrame:
    return scores(t).agg(F.max_by("batch_id", F.struct("created_at", "id")).alias("batch_id"))


@query(
    "one_student", "W7",
    f"{BASE} SELECT id, batch_id, round(proba_abandon, 6) AS proba FROM scoped JOIN (SELECT id AS i, created_at FROM scores) ON id = i WHERE filiere IN ({SCOPE_LIST}) AND student_id = (SELECT min(student_id) FROM scoped WHERE filiere IN ({SCOPE_LIST})) ORDER BY created_at DESC, id DESC LIMIT 1",
)
def one_student(t: Tables) -> DataFrame:
    seen = C.with_groups(latest(t), members(t), ["student_id"], "filiere", SCOPE)
    wanted = seen.agg(F.min("student_id")).scalar()
    newest = C.most_recent(seen.where(F.col("student_id") == wanted), [F.col("created_at").desc(), F.col("id").desc()], 1)
    return newest.select("id", "batch_id", r6("proba_abandon").alias("proba"))


@query(
    "latest_summary", "W8 A32",
    f"WITH {SCORES_SQL} SELECT arg_max(model_version, id) AS model_version, arg_max(threshold, id) AS threshold FROM scores",
)
def latest_summary(t: Tables) -> DataFrame:
    return C.current_model(scores(t))


@query(
    "set_operations", "U3",
    """SELECT 'both' AS part, count(*) AS n FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer)
    UNION ALL SELECT 'only_customers', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""",
)
def set_operations(t: Tables) -> DataFrame:
    ordered, known = t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))

    def sized(part: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")

    return sized("both", ordered.intersect(known)).unionByName(sized("only_customers", known.subtract(ordered)))
