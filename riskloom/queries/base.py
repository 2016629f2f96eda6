"""Registry of queries: an operator on the given tables and its plain SQL twin."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom import constants as K


class Tables:
    """The given Parquet tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Tables], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query with the inventory rows it covers."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, covers, build, sql)
        return build

    return add


def r6(x, digits: int = 6) -> Column:
    return F.round(F.col(x) if isinstance(x, str) else x, digits)


# --- pieces shared by both dialects -----------------------------------------


def sql_text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)


def sql_map(expr: str, mapping: Mapping[str, object]) -> str:
    whens = " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in mapping.items())
    return f"CASE lower(trim({expr})) {whens} END"


def sql_list(values) -> str:
    return ", ".join(sql_text(v) for v in values)


def sql_title(expr: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({expr})), '[\\p{{L}}]+|[^\\p{{L}}]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


# Orders read as risk scores: a customer is a member, a year is a batch.
SCORE_EXPR = "o_totalprice / 500009.0D"
SCORES_SQL = """
scores AS (
  SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS student_id,
         o_totalprice / 500009.0::DOUBLE AS proba_abandon,
         CAST(o_totalprice / 500009.0::DOUBLE >= 0.6 AS INT) AS alerte,
         'B' || CAST(year(o_orderdate) AS VARCHAR) AS batch_id,
         o_orderpriority AS model_version, 0.6::DOUBLE AS threshold, o_orderdate AS created_at
  FROM orders),
members AS (
  SELECT CAST(c_custkey AS VARCHAR) AS student_id, n_name AS filiere, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def scores(t: Tables) -> DataFrame:
    score = F.col("o_totalprice") / F.lit(500009.0)
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("student_id"),
        score.alias("proba_abandon"), (score >= 0.6).cast("int").alias("alerte"),
        F.concat(F.lit("B"), F.year("o_orderdate").cast("string")).alias("batch_id"),
        F.col("o_orderpriority").alias("model_version"), F.lit(0.6).alias("threshold"),
        F.col("o_orderdate").alias("created_at"),
    )


def members(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("student_id"), F.col("n_name").alias("filiere"),
        F.col("c_mktsegment").alias("segment"),
    )


# Documents with a quality label, scored by length.
LABELLED_SQL = """
labelled AS (
  SELECT l.doc_id, l.quality AS y, l.toxic, d.lang, d.source,
         least(1.0, d.n_chars / 5003.0) AS s,
         CAST(least(1.0, d.n_chars / 5003.0) >= 0.25 AS INT) AS flag
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def labelled(t: Tables) -> DataFrame:
    s = F.least(F.lit(1.0), F.col("n_chars") / F.lit(5003.0))
    return t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), "toxic", "lang", "source", s.alias("s"),
        (s >= 0.25).cast("int").alias("flag"),
    )


# Line items as labelled scores: a large table with a continuous score.
LINES_SQL = """
lines AS (
  SELECT CAST(l_returnflag = 'R' AS INT) AS y, l_extendedprice / 105001.0::DOUBLE AS s,
         CAST(l_extendedprice / 105001.0::DOUBLE >= 0.4 AS INT) AS flag, l_linestatus, l_returnflag
  FROM lineitem)
"""


def lines(t: Tables) -> DataFrame:
    s = F.col("l_extendedprice") / F.lit(105001.0)
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), s.alias("s"),
        (s >= 0.4).cast("int").alias("flag"), "l_linestatus", "l_returnflag",
    )


LINE_WEIGHTS = {"l_quantity": 0.031, "l_discount": 7.5, "l_tax": -9.25, "l_extendedprice": -0.00002}
LINE_INTERCEPT = -0.35
MISSING_SQL = sql_list(K.TEXT_MISSING)
