"""Column functions and the cleaning step, value by value."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from riskloom.functions import display as D, keys as KEY, numbers as N, payload as P, sql as SQLF, text as X
from riskloom.operators import cleaning as CL, ordered as R, perimeter as PM
from riskloom.operators.lineage import traced


def values(spark, inputs, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def test_parse_number(spark):
    got = values(
        spark,
        ["61,8", "85%", "14.4 km", "", " 1 250,5 ", "NaN", "5d", "0x1A", ".5", "1e3", "1_000", "abc", "-3,0KM", "1,2,3", None, "inf"],
        X.parse_number,
    )
    assert got == [61.8, 85.0, 14.4, None, 1250.5, None, None, None, 0.5, 1000.0, 1000.0, None, -3.0, None, None, float("inf")]


def test_parse_date(spark):
    got = values(
        spark,
        ["2024-09-02", "02/09/2024", "02 Sep 2024", "2 sep 2024", "31/02/2024", "", None, "9/8/2024", "2024/09/02", "soon", "3-9-2024"],
        X.parse_date,
    )
    day = dt.date(2024, 9, 2)
    assert got == [day, day, day, day, None, None, None, dt.date(2024, 8, 9), day, None, dt.date(2024, 9, 3)]


def test_title_key(spark):
    got = values(spark, [" sciences-po ", "L'ÉTÉ", "BIOLOGIE", "1er cycle", "a\tb", None], X.title_key)
    assert got == ["Sciences-Po", "L'Été", "Biologie", "1Er Cycle", "A\tB", None]


def test_clean_text_and_flags(spark):
    assert values(spark, [" a ", "NaN", "", "NA", "none", "x"], X.clean_text) == ["a", None, None, None, None, "x"]
    assert values(spark, ["no", "OFF ", "", "1", None, "non", "x"], X.unless_false) == [False, False, False, True, False, False, True]
    assert values(spark, ["true", "ON", "2", None], X.is_true) == [True, True, False, False]


def test_bounded_values(spark):
    got = values(spark, ["7", " -3", "5.0", "", "x", "99999999999999999999", None], lambda c: X.bounded_int(c, 10, 1, 50))
    assert got == [7, 1, 10, 10, 10, 50, 10]
    got = values(spark, ["0,5", "7", "nan", "", "inf"], lambda c: X.bounded_float(c, 0.0, 1.0))
    assert got == [0.5, 1.0, None, None, 1.0]


def test_csv_safe(spark):
    assert values(spark, ["=1+1", "+1", "-x", "@a", "\tb", "\rc", "ok", None], X.csv_safe) == [
        "'=1+1", "'+1", "'-x", "'@a", "'\tb", "'\rc", "ok", "",
    ]


def test_pseudonym_equals_hmac_and_stays_out_of_plans(spark):
    df = spark.createDataFrame([("ETU-1",), (None,), ("é",)], "student_id string")
    for secret in ("s3cret", "k" * 100):
        out = KEY.pseudonymize(df, secret=secret)
        want = [hmac.new(secret.encode(), v.encode(), hashlib.sha256).hexdigest() for v in ("ETU-1", "é")]
        assert [r[0] for r in out.collect()] == [want[0], None, want[1]]
        plan = out._jdf.queryExecution().toString()
        assert secret not in plan and "36363636" not in plan and "5C5C5C5C" not in plan.upper()


def test_secret_is_mandatory(spark, monkeypatch):
    monkeypatch.delenv(KEY.SECRET_ENV, raising=False)
    with pytest.raises(ValueError):
        KEY.pseudonymize(spark.createDataFrame([("a",)], "student_id string"))


def test_payload_round_trip(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), None, dt.date(2024, 9, 2))], "a int, b double, c string, d date"
    )
    text = df.select(P.to_payload(df)).first()[0]
    assert json.loads(text) == {"a": 1, "b": None, "c": None, "d": "2024-09-02"}


def test_scope_is_fail_closed(spark):
    got = values(spark, [None, "", '["a", " b ", ""]', "oops", '{"a": 1}', "[]", "3"], P.read_scope)
    assert got == [None, None, ["a", "b"], [], [], [], []]
    out = spark.createDataFrame([(["gestion", "Gestion ", ""],), ([],), (None,)], "g array<string>")
    assert [r[0] for r in out.select(P.write_scope("g")).collect()] == ['["Gestion"]', None, None]


def test_visible_fields(spark):
    df = spark.createDataFrame([('{"age": 20, "moyenne_finale": 3, "x": 1}',), ("bad",)], "j string")
    shown = P.visible_fields(P.read_object("j"), ["age", "moyenne_finale"], PM.HIDDEN_FROM_READERS)
    assert [r[0] for r in df.select(shown).collect()] == [{"age": "20"}, {}]


def test_days_left_rounds_down(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-10 00:00:00' AS e, TIMESTAMP '2024-01-10 06:00:00' AS n")
    assert df.select(N.days_left("e", "n")).first()[0] == -1


def test_names_and_labels(spark):
    columns = ["mention_bac", "mention", "taux_rendu_devoirs"]
    got = values(spark, ["num__taux_rendu_devoirs", "cat__mention_bac_TB", "zz"], lambda c: D.source_column(c, columns))
    assert got == ["taux_rendu_devoirs", "mention_bac", None]
    got = values(spark, ["cat__mention_bac_TB", "num__age", "cat__bac_type_a_b", "free_text"], D.feature_label)
    assert got == ["mention au baccalauréat : TB", "âge", "type de baccalauréat : a b", "free text"]
    shown = [("num__taux_rendu_devoirs", 0.825), ("taux_presence_pct", 61.4), ("boursier", 1.0), ("age", 20.0), ("x", 2.5), ("x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(shown)], "i int, n string, v double")
    got = [r[0] for r in df.orderBy("i").select(D.number_text("n", "v")).collect()]
    assert got == ["82 %", "61 %", "oui", "20", "2.50", "non renseigné"]


def test_clean_micro_case(spark):
    row = (" informatique ", "femme", "Général", "Très bien", "Oui", " Lycee_Public ", "14,4 km", "85%", "02 Sep 2024")
    df = spark.createDataFrame(
        [row, row],
        "filiere string, sexe string, bac_type string, mention_bac string, boursier string, "
        "etablissement_origine string, distance_domicile_km string, taux_presence_pct string, date_inscription string",
    )
    got = CL.clean(df).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.filiere, r.sexe, r.bac_type, r.mention_bac, r.boursier) == ("Informatique", "F", "general", "TB", 1)
    assert (r.etablissement_origine, r.distance_domicile_km, r.taux_presence_pct) == ("lycee_public", 14.4, 85.0)
    assert r.date_inscription_parsed == dt.date(2024, 9, 2)
    assert CL.clean(df, drop_duplicates=False).count() == 2


def test_features_and_perimeter(spark, cohort, catalogue):
    prepared = CL.add_features(CL.enrich(CL.clean(cohort), catalogue, require_unique=True))
    row = prepared.where("student_id = 'M000001'").first()
    raw = cohort.where("student_id = 'M000001'").first()
    assert row.taux_rendu_devoirs == pytest.approx(raw.nb_devoirs_rendus / 12)
    assert row.heures_lms_par_connexion == pytest.approx(raw.heures_lms_total / (raw.connexions_lms_30j + 1), rel=1) and row.commentaire_present == int(bool(raw.commentaire_tuteur))
    assert row.jours_inscription >= 0 and row.faculte == "Commerce"
    features = PM.feature_columns(prepared)
    assert not set(features) & PM.EXCLUDED and "capacite_accueil" in features
    gold = PM.gold(prepared, keep=["student_id"])
    assert gold.columns == [*features, "abandon", "moyenne_finale", "student_id"]
    wanted = PM.reindex(gold, ["age", "nope"])
    assert wanted.columns == ["age", "nope"] and wanted.first()["nope"] is None
    with pytest.raises(PM.LeakageError):
        PM.assert_no_leakage(["age", "moyenne_finale"])


def test_renamed_leak_is_found(spark, cohort):
    marked = PM.mark_forbidden(cohort)
    PM.assert_no_marked(marked.select("age"))
    with pytest.raises(PM.LeakageError):
        PM.assert_no_marked(marked.select("age", F.col("moyenne_finale").alias("harmless")))


def test_derived_leaks_are_found(spark, cohort, catalogue):
    base = cohort.withColumn("moyenne_finale", F.col("moyenne_finale").cast("double"))
    peers = base.groupBy("filiere").agg(F.max("moyenne_finale").alias("best"))
    top = base.agg(F.max("moyenne_finale").alias("top"))
    disguised = {
        "renamed": base.withColumn("x", F.col("moyenne_finale")), "times": base.withColumn("y", F.col("moyenne_finale") * 1).withColumn("x", F.col("y") + 0),
        "nested": base.withColumn("x", F.struct("age", "moyenne_finale")), "joined": base.join(peers, "filiere").withColumn("x", F.col("best") > 10),
        "union": base.withColumn("x", F.col("age").cast("double")).unionByName(base.withColumn("x", F.col("moyenne_finale"))),
        "scalar": base.withColumn("x", F.col("age") + top.scalar()), "window": base.withColumn("x", F.expr("rank() OVER (ORDER BY moyenne_finale)")),
        "exploded": base.select("*", F.explode(F.array("moyenne_finale")).alias("x")), "python": base.mapInArrow(lambda b: b, base.schema).withColumnRenamed("age", "x"),
        "stored": R.kept(traced(base.withColumn("x", F.col("moyenne_finale") - 1))), "case": base.withColumn("x", F.when(F.col("moyenne_finale") > 9, 1)),
    }
    for name, df in disguised.items():
        with pytest.raises(PM.LeakageError):
            PM.assert_not_derived(df, ["x"])
            raise AssertionError(name)
    innocent = base.join(peers, "filiere").where(F.col("moyenne_finale") > 0).orderBy("moyenne_finale").withColumn("x", F.col("age") * 2)
    PM.assert_not_derived(innocent, ["x", "age"])
    prepared = CL.add_features(CL.enrich(CL.clean(cohort), catalogue))
    PM.gold(prepared)
    with pytest.raises(PM.LeakageError):
        PM.gold(prepared.withColumn("score", F.col("moyenne_finale") / 20))


def test_repeated_dimension_keys_are_refused(spark, cohort, catalogue):
    twice = catalogue.unionByName(catalogue)
    with pytest.raises(ValueError):
        CL.enrich(cohort, twice, require_unique=True)
    assert CL.enrich(cohort, twice).count() == 24


def test_sql_functions(spark):
    SQLF.register(spark)
    row = spark.sql(
        "SELECT parse_number_fr('61,8 km') a, parse_number_fr('x') b, parse_date_multi('02 Sep 2024') c, csv_safe('=1') d, "
        "classify_psi(0.3D) e, classify_psi(NULL) f, safe_share(3D, 2D) g, clean_text(' nan ') h, risk_trend(0.1D, 0.2D) i"
    ).first()
    assert tuple(row) == (61.8, None, dt.date(2024, 9, 2), "'=1", "alert", "missing", 1.0, None, "worse")
