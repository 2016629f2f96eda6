"""Languages by compression: accuracy on held-out rows, rejection and awkward texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.llm import language, queries
from tests.llm import helpers

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "lang")
    got = queries.language_id(spark, FOLDER).join(docs, "doc_id").where("held_out")
    row = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.avg(F.col("rejected").cast("int")).alias("out")).first()
    assert row["right"] > 0.97 and row["out"] < 0.03


def test_awkward(spark):
    train = helpers.docs(spark, ["the quick brown fox and the lazy dog", None, "", "12"] * 3).withColumn("lang", F.lit("en"))
    other = helpers.docs(spark, ["der schnelle braune fuchs und der hund"] * 4, 100).withColumn("lang", F.lit("de"))
    model = language.fit(train.union(other))
    assert sorted(model.dictionaries) == ["de", "en"]
    frame = helpers.docs(spark, helpers.AWKWARD)
    got = language.identify(frame.drop("language"), model).collect()
    assert len(got) == len(helpers.AWKWARD)
    for r in got:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["language"]["lang"] == "und") == (not letters)
        assert 0 <= r["language"]["score"] <= 1


def test_short_texts_are_not_rejected_for_ties(spark):
    docs = queries.table(spark, FOLDER, "documents").withColumn("n", F.length("text"))
    got = queries.language_id(spark, FOLDER).join(docs.select("doc_id", "n"), "doc_id").where("lang_pred <> 'und'")
    by = {r["k"]: (r["out"], r["rows"]) for r in got.groupBy((F.col("n") >= 200).alias("k")).agg(F.avg(F.col("rejected").cast("int")).alias("out"), F.count("*").alias("rows")).collect()}
    assert by[False][0] == 0.0 and by[False][1] > 5 and by[True][0] < 0.01


def test_sizes_equal_a_plain_run(spark):
    """Every text is given to every dictionary again, in one go."""
    import zstandard

    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    model = language.fit(docs)
    for r in language.identify(docs, model).collect():
        sizes = {}
        for name, content in model.dictionaries.items():
            coder = zstandard.ZstdCompressor(level=model.level, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
            data = language.prepared(r["text"] or "")
            sizes[name] = sum(len(coder.compress(data[i : i + model.block])) for i in range(0, len(data), model.block))
        if any(map(str.isalpha, r["text"] or "")):
            assert sizes[r["language"]["lang"]] == min(sizes.values())


def test_classifier_runs_once_under_a_filter(spark):
    docs = helpers.docs(spark, helpers.AWKWARD).drop("language")
    kept = language.identify(docs, language.LanguageModel({"en": b"a"})).where("NOT language.rejected").select("doc_id", "language.lang")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_nothing_to_learn(spark):
    model = language.fit(helpers.empty(spark))
    got = language.identify(helpers.docs(spark, ["text"]), model).first()["language"]
    assert (got["lang"], got["score"], got["rejected"]) == ("und", 0.0, True)


def test_copies_count_once(spark):
    rows = helpers.docs(spark, ["same text again"] * 500 + ["another text here"]).withColumn("lang", F.lit("en"))
    model = language.fit(rows, texts_per_language=2)
    assert b"same text again" in model.dictionaries["en"] and b"another text here" in model.dictionaries["en"]
