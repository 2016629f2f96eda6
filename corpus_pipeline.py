"""From raw documents to token ids: each stage works on all that the one before has kept.

Stages judge rows by their own text, so null and repeated ids, null texts, equal rows and further
columns are like any other; an empty table passes through empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.llm import decontaminate, language, queries, secrets, simhash  # noqa: E402
from riskloom.session import scratch_path  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents that cross to a Python worker at once, and the session's setting for it.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bounded(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_ROWS`` rows: both sides of a worker buffer whole batches of texts."""
    rows = int(spark.conf.get(BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and long ones between two languages; fill in a missing ``lang``.

    Texts too short for a margin to say anything stay.
    """
    _bounded(spark)
    found = language.identify(docs, language.fit(docs)).where(~F.col("language.rejected"))
    return found.withColumn("lang", F.coalesce("lang", F.col("language.lang"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each class of near duplicates (3-word shingles, at most 3 of 64 bits)."""
    _bounded(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    _bounded(spark)
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; ``n_chars`` follows."""
    masked = secrets.redact(docs, repository=queries.repository(), owner="source")
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with their number and digests of ids and decoded bytes."""
    _bounded(spark)
    return queries.digests(docs.select("doc_id", "text"), ids=True)


STAGES = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("byte_bpe", byte_bpe),
]
#: The compression classifier has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is stored in the shared folder and read again."""
    docs, rows = queries.table(spark, sf_dir, "documents").select(*COLUMNS), spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, rows)
    return docs
