"""The stages in a row equal a plain run of their rules; queries with SQL equal their twins."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from riskloom.llm import bpe, queries
from tests import oracle
from tests.llm import helpers

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    got = oracle.spark_rows(queries.QUERIES[name](spark, FOLDER))
    assert oracle.differences(got, oracle.duck_rows(oracle.connection(FOLDER), queries.SQL[name])) is None


def test_pipeline(spark):
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    docs = queries.table(spark, FOLDER, "documents")
    rejected = {r["doc_id"] for r in queries.language_id(spark, FOLDER).where("rejected").collect()}
    place = {r["doc_id"]: r["component_id"] for r in queries.simhash_near_dedup(spark, FOLDER).collect()}
    leaks = {r["doc_id"] for r in queries.benchmark_decontamination(spark, FOLDER).collect()}
    stays = {d for d in place if place[d] == d} - leaks - rejected
    # A rejected document or another model may move a representative; most must agree.
    assert len(stays ^ set(got)) <= 0.03 * len(stays) and not leaks & set(got)
    encoder = bpe.worker_encoder(queries.vocabulary("byte_bpe_50k.json"), bpe._CHUNK)
    secret = {r["doc_id"] for r in queries.secret_scan(spark, FOLDER).where("spans <> ''").collect()}
    for r in docs.collect():
        if r["doc_id"] in got and r["doc_id"] not in secret:
            assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
            assert got[r["doc_id"]]["n_tokens"] == len(encoder.encode([r["text"] or ""])[0]) // 4
        elif r["doc_id"] in got:
            assert got[r["doc_id"]]["decoded_sha256"] != hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_stages_take_awkward_rows(spark):
    docs = helpers.docs(spark, helpers.AWKWARD + ["token = \"abcdefghijklmnop\" and more words of text here"]).select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        assert made.count() <= docs.count()
        if name != "byte_bpe":
            assert made.columns == corpus_pipeline.COLUMNS
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_texts_cross_to_python_some_rows_at_a_time(spark):
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    docs = helpers.docs(spark, ["one two three"] * 2500)
    try:
        corpus_pipeline.decontamination(spark, docs, FOLDER)
        sizes = docs.coalesce(1).select("text").mapInArrow(lambda batches: (b.slice(0, 1) for b in batches if b.num_rows > 1000), "text string")
        assert sizes.count() == 0
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
