"""Splits, weights, explanations and fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom import constants as K
from riskloom.operators import explain as E, ordered as R, splitting as S
from riskloom.queries.base import (
    LABELLED_SQL, LINE_INTERCEPT, LINE_WEIGHTS, Tables, labelled, query, r6, sql_text,
)
from riskloom.session import scratch_path

_HASH = "('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15))::BIGINT"


@query(
    "stratified_split", "M1 U4 F7",
    f"""WITH h AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH.format(seed=42, key='o_orderkey')}) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= round(0.2 * n) THEN 'test' WHEN rn <= 2 * round(0.2 * n) THEN 'validation' ELSE 'train' END AS split_set FROM h""",
)
def stratified_split(t: Tables) -> DataFrame:
    return S.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


@query(
    "split_shares", "M1 A7",
    f"""WITH h AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_HASH.format(seed=7, key='doc_id')}) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels)
    SELECT CASE WHEN rn <= round(0.2 * n) THEN 'test' WHEN rn <= 2 * round(0.2 * n) THEN 'validation' ELSE 'train' END AS split_set, quality, count(*) AS n FROM h GROUP BY 1, 2""",
)
def split_shares(t: Tables) -> DataFrame:
    return S.split_counts(S.assign_split(t.labels, "quality", "doc_id", seed=7), "quality")


def _policy_sql(source: str) -> str:
    """Split of (k, y) rows: by class, over all rows, or by the end of the key order."""
    return f"""WITH l AS ({source}), s AS (SELECT y, count(*) AS c FROM l GROUP BY y),
    p AS (SELECT sum(c) AS n, count(*) AS g, min(c) AS m, ceil(sum(c) / 5.0) AS t FROM s),
    q AS (SELECT *, ceil((n - t) / 4.0) AS v, m - round_even(m * 0.2, 0) AS kept FROM p),
    mode AS (SELECT n, CASE WHEN n < 5 OR g < 2 OR m < 2 THEN CASE WHEN n >= 3 THEN 'shuffled' ELSE 'ranked' END
      WHEN least(t, n - t) >= g AND (kept < 2 OR least(v, n - t - v) >= g) THEN 'stratified' ELSE 'ranked' END AS mode FROM q),
    h AS (SELECT k, mode, n, row_number() OVER (PARTITION BY CASE WHEN mode = 'stratified' THEN y END ORDER BY {_HASH.format(seed=42, key='k')}) AS r,
      count(*) OVER (PARTITION BY CASE WHEN mode = 'stratified' THEN y END) AS c, row_number() OVER (ORDER BY k) AS place,
      greatest(1, round_even(n / 5.0, 0)) AS rt FROM l, mode)
    SELECT k AS key, CASE WHEN mode <> 'ranked' THEN CASE WHEN r <= round(0.2 * c) THEN 'test' WHEN r <= 2 * round(0.2 * c) THEN 'validation' ELSE 'train' END
      WHEN place > n - rt THEN 'test' WHEN place > n - rt - greatest(1, round_even((n - rt) / 4.0, 0)) THEN 'validation' ELSE 'train' END AS split_set FROM h"""


@query("split_many_classes", "M1 U4", _policy_sql("SELECT l_orderkey * 10 + l_linenumber AS k, l_partkey % 1301 AS y FROM lineitem"))
def split_many_classes(t: Tables) -> DataFrame:
    """More than a thousand classes: stratified where every class has its rows, else by the key order."""
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), (F.col("l_partkey") % 1301).alias("y"))
    return S.assign_split(rows, "y", "key", allow_fallback=True).select("key", "split_set")


@query("split_singleton_class", "M1 U4 C4", _policy_sql("SELECT p_partkey AS k, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN -1 ELSE p_size END AS y FROM part"))
def split_singleton_class(t: Tables) -> DataFrame:
    """One class with a single row: all rows are shuffled together."""
    first = t.part.agg(F.min("p_partkey")).scalar()
    rows = t.part.select(F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") == first, -1).otherwise(F.col("p_size")).alias("y"))
    return S.assign_split(rows, "y", "key").select("key", "split_set")


@query(
    "fold_shares", "M4",
    """WITH s AS (SELECT p_size AS y, count(*) AS c FROM part GROUP BY 1)
    SELECT y, CAST(c // 5 AS BIGINT) AS least, CAST((c + 4) // 5 AS BIGINT) AS most, c AS n FROM s""",
)
def fold_shares(t: Tables) -> DataFrame:
    """Smallest and largest number of rows of a class in a fold."""
    folds = S.stratified_folds(t.part.select("p_partkey", "p_size"), "p_size", "p_partkey")
    counts = folds.groupBy(F.col("p_size").alias("y")).agg(
        *[F.count_if(F.col("fold") == i).alias(f"_{i}") for i in range(5)], F.count(F.lit(1)).alias("n")
    )
    sizes = [f"_{i}" for i in range(5)]
    return counts.select("y", F.least(*sizes).alias("least"), F.greatest(*sizes).alias("most"), "n")


@query(
    "class_weights", "M3",
    "SELECT l_returnflag, count(*) AS size, round((SELECT count(*) FROM lineitem) / ((SELECT count(DISTINCT l_returnflag) FROM lineitem) * count(*)), 6) AS weight FROM lineitem GROUP BY 1",
)
def class_weights(t: Tables) -> DataFrame:
    return S.class_weights(t.lineitem, "l_returnflag").withColumn("weight", r6("weight"))


_Z = f"{LINE_INTERCEPT!r} + " + " + ".join(f"{w:.10f}::DOUBLE * {c}" for c, w in LINE_WEIGHTS.items())


@query(
    "explain_linear", "M7 M6",
    f"""SELECT l_orderkey, l_linenumber, round({_Z}, 6) AS log_odds, round(1 / (1 + exp(-({_Z}))), 6) AS proba,
    {", ".join(f"round({w:.10f}::DOUBLE * {c}, 7) AS c_{c}" for c, w in LINE_WEIGHTS.items())} FROM lineitem""",
)
def explain_linear(t: Tables) -> DataFrame:
    out = E.with_contributions(t.lineitem, LINE_WEIGHTS, LINE_INTERCEPT)
    parts = [
        F.round(F.element_at("contributions", i + 1)["contribution"], 7).alias(f"c_{c}")
        for i, c in enumerate(LINE_WEIGHTS)
    ]
    return out.select("l_orderkey", "l_linenumber", r6("log_odds").alias("log_odds"), r6("proba").alias("proba"), *parts)


_LONG = " UNION ALL ".join(
    f"SELECT rid, '{c}' AS name, {w:.10f}::DOUBLE * {c} AS x FROM li" for c, w in LINE_WEIGHTS.items()
)


@query(
    "top_factors", "O4 M8",
    f"""WITH li AS (SELECT *, row_number() OVER () AS rid FROM lineitem), c AS ({_LONG}), r AS (SELECT rid, name, x, CASE WHEN x > 0 THEN 'risk' ELSE 'protective' END AS direction FROM c WHERE abs(x) > 1e-12),
    p AS (SELECT *, row_number() OVER (PARTITION BY rid, direction ORDER BY abs(x) DESC, name) AS position FROM r)
    SELECT direction, position::INT AS position, name, count(*) AS n, sum(CAST(round(x * 1000000) AS BIGINT))::BIGINT AS total_micro FROM p WHERE position <= 5 GROUP BY 1, 2, 3""",
)
def top_factors(t: Tables) -> DataFrame:
    out = E.with_contributions(t.lineitem, LINE_WEIGHTS, LINE_INTERCEPT)
    rows = E.factor_rows(out, ["l_orderkey", "l_linenumber"], 5)
    return rows.groupBy("direction", "position", "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("contribution") * 1000000).cast("long")).alias("total_micro")
    )


_SHEET = {"motivation": 0.4, "taux_presence_pct": -0.03, "sexe": 2.0, "retards_rendus": 0.9}


@query(
    "factor_sheet", "M8 F8 P25 P26",
    f"""WITH p AS (SELECT p_partkey, p_size - 25 AS motivation, p_size * 1.0 AS taux_presence_pct, (p_size - 40) / 10.0 AS retards_rendus FROM part),
    c AS (SELECT p_partkey, {sql_text(K.FEATURE_LABELS['motivation'])} AS label, 'motivation' AS name, 0.4 * motivation AS x, motivation::DOUBLE AS v FROM p
      UNION ALL SELECT p_partkey, {sql_text(K.FEATURE_LABELS['taux_presence_pct'])}, 'taux_presence_pct', -0.03 * taux_presence_pct, taux_presence_pct FROM p
      UNION ALL SELECT p_partkey, {sql_text(K.FEATURE_LABELS['retards_rendus'])}, 'retards_rendus', 0.9 * retards_rendus, retards_rendus FROM p),
    r AS (SELECT *, CASE WHEN x > 0 THEN 'risk' ELSE 'protective' END AS direction FROM c WHERE abs(x) > 1e-12)
    SELECT p_partkey, direction, row_number() OVER (PARTITION BY p_partkey, direction ORDER BY abs(x) DESC, name)::INT AS position, label,
      CASE WHEN name = 'taux_presence_pct' THEN printf('%.0f', v) || ' %' WHEN v = floor(v) THEN printf('%.0f', v) ELSE printf('%.2f', v) END AS value FROM r""",
)
def factor_sheet(t: Tables) -> DataFrame:
    size = F.col("p_size")
    rows = t.part.select(
        "p_partkey", (size - 25).alias("motivation"), (size * 1.0).alias("taux_presence_pct"),
        size.alias("sexe"), ((size - 40) / 10.0).alias("retards_rendus"),
    )
    return E.factor_sheet(E.with_contributions(rows, _SHEET, 0.0), ["p_partkey"], list(_SHEET))


@query(
    "shap_linear", "M12",
    f"""WITH m AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in LINE_WEIGHTS)} FROM lineitem)
    """ + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(abs({w:.10f}::DOUBLE * ({c} - (SELECT {c} FROM m)))), 6) AS importance FROM lineitem" for c, w in LINE_WEIGHTS.items()
    ),
)
def shap_linear(t: Tables) -> DataFrame:
    return E.mean_absolute_contribution(t.lineitem, LINE_WEIGHTS).withColumn("importance", r6("importance"))


def _perm_auc(f: str, rep: int) -> str:
    """AUC in SQL after feature ``f`` takes the value of the next row in hash order."""
    return f"""(WITH o AS (SELECT *, row_number() OVER (ORDER BY {_HASH.format(seed=1000 + rep, key='doc_id')}, doc_id) AS r FROM b),
      z AS (SELECT o.y, o.a + o.c - o.{f} + q.{f} AS s FROM o JOIN o q ON q.r = CASE WHEN o.r = (SELECT count(*) FROM o) THEN 1 ELSE o.r + 1 END),
      k AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n, s FROM z GROUP BY s),
      m AS (SELECT p, n, sum(p + n) OVER (ORDER BY s) - (p + n) + (p + n + 1) / 2.0 AS rk FROM k)
      SELECT (sum(p * rk) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * sum(n)) FROM m)"""


@query(
    "permutation_importance", "M11",
    f"""WITH {LABELLED_SQL}, b AS (SELECT doc_id, y, s * 3.0 AS a, toxic * 0.5 AS c FROM labelled),
    k AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n, a + c AS s FROM b GROUP BY a + c),
    m AS (SELECT p, n, sum(p + n) OVER (ORDER BY s) - (p + n) + (p + n + 1) / 2.0 AS rk FROM k),
    base AS (SELECT (sum(p * rk) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * sum(n)) AS auc FROM m)
    SELECT 'length' AS feature, round((SELECT auc FROM base) - ({" + ".join(_perm_auc('a', i) for i in range(8))}) / 8, 6) AS importance
    UNION ALL SELECT 'toxic', round((SELECT auc FROM base) - ({" + ".join(_perm_auc('c', i) for i in range(8))}) / 8, 6)""",
)
def permutation_importance(t: Tables) -> DataFrame:
    parts = F.array(F.col("s") * 3.0, F.col("toxic") * 0.5)
    out = E.permutation_importance(labelled(t), ["length", "toxic"], parts, "doc_id", "y", repeats=8)
    return out.withColumn("importance", r6("importance"))


# --- fitted models ----------------------------------------------------------

FEATURES = ["n_chars", "n_lines", "n_digits", "share_upper", "lang", "source"]


def document_features(t: Tables, how: str = "inner") -> DataFrame:
    """Labelled documents (with ``left``: all) with measures of their whole text."""
    text = F.col("text")
    size = F.greatest(F.lit(1), F.length(text))
    rows = t.documents.join(t.labels, "doc_id", how).select(
        "doc_id", "quality", "toxic", "lang", "source", "n_chars",
        F.regexp_count(text, F.lit("\n")).alias("n_lines"), F.regexp_count(text, F.lit("[0-9]")).alias("n_digits"),
        (F.regexp_count(text, F.lit(r"\p{Lu}")) / size).alias("share_upper"),
    )
    return rows


def trained(t: Tables):
    from riskloom.plans import training as T

    return T.train_gold(
        document_features(t), FEATURES, "quality", "doc_id", subgroups=("lang",)
    )


@query("train_score", "M2 M4 M5 M6")
def train_score(t: Tables) -> DataFrame:
    """Grid search on train, cut-off on validation; scores of the held-out parts."""
    result = trained(t)
    return result.scored.select(
        "doc_id", "split_set", "quality", r6("proba_abandon").alias("proba"),
        (F.col("proba_abandon") >= result.bundle.threshold).cast("int").alias("alerte"),
    )


_MEASURES_SQL = r"""d AS (SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS n_lines,
      CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits, length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / greatest(1, length(text)) AS share_upper
    FROM documents JOIN labels USING (doc_id))"""


def _number_sql(c: str) -> str:
    return (
        f"SELECT 'num__{c}' AS slot, CAST(NULL AS VARCHAR) AS text_fill, round(m, 6) AS fill, round(avg(coalesce({c}, m)), 4) AS centre, round(stddev_samp(coalesce({c}, m)), 4) AS scale "
        f"FROM d, (SELECT median({c}) AS m FROM d) GROUP BY m"
    )


def _text_sql(c: str) -> str:
    mode = f"(SELECT {c} FROM d WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    return (
        f"SELECT DISTINCT 'cat__{c}_' || coalesce({c}, {mode}), {mode}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM d "
        f"UNION ALL SELECT 'cat__{c}___unknown', {mode}, NULL, NULL, NULL"
    )


@query(
    "fit_certificate", "M2 M4 M5 M6 S15",
    f"""WITH {_MEASURES_SQL}, p AS ({" UNION ALL ".join([*map(_number_sql, ("n_chars", "n_lines", "n_digits", "share_upper")), *map(_text_sql, ("lang", "source"))])}
      UNION ALL SELECT 'intercept', NULL, NULL, NULL, NULL)
    SELECT slot, text_fill, fill, centre, scale, 0.0::DOUBLE AS gradient, (SELECT count(*) FROM d) AS scored, 0::BIGINT AS differ FROM p""",
)
def fit_certificate(t: Tables) -> DataFrame:
    """Fills, moments, value lists and a vanishing gradient of the searched fit; the saved and loaded
    model scores every document like the table of its weights."""
    from riskloom.plans import training as T

    rows = R.kept(document_features(t))
    model, best, _ = T.fit_logistic(rows, FEATURES, "quality", "doc_id")
    path = scratch_path(t.spark, "bundle")
    T.ModelBundle(model, FEATURES, 0.5).save(path)
    bundle = T.ModelBundle.load(t.spark, path)
    table = T.parameters(bundle)
    by_model = T.score_gold(rows, bundle, ["doc_id"]).select("doc_id", F.col("proba_abandon").alias("p"))
    both = T.score_by_table(rows, table, "doc_id").join(by_model, "doc_id")
    checked = both.agg(F.count(F.lit(1)).alias("scored"), F.count_if(F.abs(F.col("p") - F.col("proba_abandon")) > 1e-9).alias("differ"))
    number = F.col("centre").isNotNull()
    out = table.join(T.gradient(rows, bundle, "quality", best), "slot").crossJoin(F.broadcast(checked))  # one row of counts
    return out.select(
        "slot", F.when(~number, F.col("fill")).alias("text_fill"), F.when(number, r6(F.col("fill").cast("double"))).alias("fill"),
        r6("centre", 4).alias("centre"), r6("scale", 4).alias("scale"), F.abs(r6("gradient", 3)).alias("gradient"), "scored", "differ",
    )


@query("model_explanations", "M7 M8")
def model_explanations(t: Tables) -> DataFrame:
    """Exact contributions of a fitted pipeline for every labelled document."""
    from riskloom.plans import training as T

    rows = document_features(t)
    model, _, _ = T.fit_logistic(rows, FEATURES, "quality", "doc_id")
    bundle = T.ModelBundle(model, FEATURES, 0.5)
    out = T.explain(rows, bundle, ["doc_id"])
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, c: acc + c["contribution"])
    return out.select(
        "doc_id", r6("log_odds").alias("log_odds"), r6("proba").alias("proba"),
        r6(F.col("log_odds") - F.col("intercept") - total, 9).alias("remainder"),
    )


@query("candidate_models", "M9")
def candidate_models(t: Tables) -> DataFrame:
    from riskloom.plans import training as T

    split = S.assign_split(document_features(t), "quality", "doc_id")
    return T.compare_candidates(
        S.rows_in(split, "train"), S.rows_in(split, "validation"), FEATURES, "quality", "doc_id"
    )


@query("regression_models", "M10")
def regression_models(t: Tables) -> DataFrame:
    from riskloom.plans import training as T

    split = S.stratified_split(document_features(t, "left"), None, "doc_id")
    return T.compare_regressors(
        S.rows_in(split, "train"), S.rows_in(split, "test"), ["n_lines", "n_digits", "share_upper", "lang"], "n_chars"
    )
