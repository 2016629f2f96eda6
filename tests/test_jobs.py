"""Storage, training, registry, monitoring and streaming jobs end to end."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from riskloom import constants as K, schemas
from riskloom.operators import cohort as C, perimeter as PM, scoring_metrics as M
from riskloom.plans import medallion as ME, monitoring as MO, training as T
from riskloom.sources import files as FS
from riskloom.sources.registry import Registry, log_run
from riskloom.sources.tables import TableStore
from riskloom.streaming import jobs as J, rates as RT, stateful as ST

SECRET = "test-secret"
UTC = dt.timezone.utc


@pytest.fixture
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "store"))
    s.create()
    return s


def six(cohort):
    return cohort.orderBy("student_id").limit(6)


# --- medallion --------------------------------------------------------------


def test_load_counts_pseudonyms_and_audit(store, cohort, catalogue):
    got = ME.load(store, six(cohort), catalogue, secret=SECRET, actor="tester")
    assert (got.rows_bronze, got.rows_silver, got.rows_gold) == (8, 8, 6)
    raw = [json.loads(r[0]) for r in store.read("bronze_student_raw").select("payload_json").collect()]
    assert any(r["student_id"].startswith("M000") for r in raw)
    for table in ("silver_student", "gold_training_feature"):
        rows = store.read(table).collect()
        assert all(len(r["student_id"]) == 64 for r in rows) and "M0000" not in str(rows)
    features = json.loads(store.read("gold_training_feature").first()["features_json"])
    assert not set(features) & PM.FORBIDDEN
    audit = store.read("privacy_audit_log").first()
    assert (audit["action"], audit["actor"], audit["target_id"]) == ("medallion_load", "tester", got.batch_id)
    numbers = sorted(r[0] for r in store.read("silver_student").select("row_number").collect())
    assert numbers == list(range(1, 7))


def test_unlabelled_batch_has_no_gold(store, cohort, catalogue):
    got = ME.load(store, six(cohort).drop("abandon"), catalogue, secret=SECRET)
    assert (got.rows_bronze, got.rows_silver, got.rows_gold) == (8, 8, 0)


def test_repeated_load_leaves_one_copy(store, cohort, catalogue):
    for _ in range(2):
        ME.load(store, six(cohort), catalogue, secret=SECRET, batch_id="same")
    assert store.read("bronze_student_raw").count() == 6


def test_purge_keeps_only_the_audit(store, cohort, catalogue):
    ME.load(store, six(cohort), catalogue, secret=SECRET, retention_days=-1, batch_id="old")
    ME.load(store, six(cohort), catalogue, secret=SECRET, batch_id="new")
    assert store.purge_expired() == 1
    assert [r[0] for r in store.read("ingestion_batch").select("batch_id").collect()] == ["new"]
    assert {r[0] for r in store.read("silver_student").select("batch_id").distinct().collect()} == {"new"}
    assert store.read("privacy_audit_log").where("action = 'retention_purge'").count() == 1
    assert store.purge_expired() == 0


def test_guards(store, cohort, catalogue, monkeypatch):
    monkeypatch.delenv("RISKLOOM_PSEUDONYM_SECRET", raising=False)
    with pytest.raises(ValueError):
        ME.load(store, cohort, catalogue)
    with pytest.raises(ValueError):
        store.save_predictions("nope", cohort, "v", 0.5)


# --- files ------------------------------------------------------------------


def test_csv_with_bom_and_row_numbers(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("﻿student_id,boursier,note\nA,1,NA\nB,oui,\nC,0,\"a,b\"\n", encoding="utf-8")
    assert FS.csv_columns(spark, str(path)) == ["student_id", "boursier", "note"]
    rows = FS.number_rows(FS.read_csv(spark, str(path), ["student_id", "boursier", "note"], with_position=True))
    got = [tuple(r) for r in rows.orderBy("row_number").collect()]
    assert got == [("A", "1", None, 1), ("B", "oui", None, 2), ("C", "0", "a,b", 3)]


def test_export_is_capped_and_safe(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "p1", 0.4, 0, "=cmd", "b", None, None), (2, "p2", 0.9, 1, "Gestion", "b", "v1", 0.3)],
        "id int, pseudo_id string, proba_abandon double, alerte int, filiere string, batch_id string, model_version string, threshold double",
    )
    with pytest.raises(FS.ExportTooLarge):
        FS.export_csv(rows, str(tmp_path / "no"), 1, "purpose")
    out = str(tmp_path / "out")
    assert FS.export_csv(rows, out, 10, "human support only", generated_at="2024-01-01") == 2
    back = spark.read.option("header", True).csv(out)
    assert back.columns == K.EXPORT_COLUMNS
    got = [(r["rang"], r["pseudo_id"], r["proba_abandon"], r["filiere"], r["threshold"]) for r in back.collect()]
    assert got == [("1", "p2", "0.900000", "Gestion", "0.3000"), ("2", "p1", "0.400000", "'=cmd", None)]
    assert spark.read.text(out + ".purpose").first()[0] == "human support only"


def test_log_lines(spark):
    df = spark.createDataFrame([('{"event":"x","level":"WARN"}',), ("plain",), ("[1]",)], "line string")
    got = [r["fields"] for r in FS.log_lines(df, "line", {"level": F.lit("INFO")}).collect()]
    assert got == [{"level": "WARN", "event": "x"}, {"level": "INFO", "message": "plain"}, {"level": "INFO", "message": "[1]"}]


# --- training ---------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(big_cohort, catalogue):
    return T.train(big_cohort, catalogue, c_grid=(0.1, 1.0), folds=2)


def test_training_result(trained):
    m = trained.metrics
    assert m["model_version"].startswith("local-") and m["n_train"] + m["n_validation"] + m["n_test"] == 120
    assert (m["n_train"], m["n_validation"], m["n_test"]) == (72, 24, 24)
    assert 0 <= m["auc_test"] <= 1 and m["threshold"] in K.threshold_grid() and m["best_params"]["C"] in (0.1, 1.0)
    assert not set(trained.bundle.feature_cols) & PM.EXCLUDED


def test_scoring_contract(spark, trained, cohort):
    some = cohort.select("student_id", "filiere", "age", "nb_devoirs_total", "nb_devoirs_rendus", "connexions_lms_30j", "heures_lms_total", "ressources_consultees")
    twice = some.unionByName(some)
    out = T.score(twice, trained.bundle)
    assert out.columns == ["proba_abandon", "alerte"]
    rows = out.collect()
    assert len(rows) == 24 and all(0 <= r[0] <= 1 and r[1] == int(r[0] >= trained.bundle.threshold) for r in rows)


def test_bundle_round_trip(spark, trained, cohort, tmp_path):
    trained.bundle.save(str(tmp_path / "bundle"))
    back = T.ModelBundle.load(spark, str(tmp_path / "bundle"))
    assert (back.feature_cols, back.threshold, back.since, back.version) == (
        trained.bundle.feature_cols, trained.bundle.threshold, trained.bundle.since, trained.bundle.version)
    a = {r[0]: r[1] for r in T.score(cohort, trained.bundle, ["student_id"]).collect()}
    b = {r[0]: r[1] for r in T.score(cohort, back, ["student_id"]).collect()}
    assert a == pytest.approx(b)


def test_explanations_sum_to_log_odds(trained, cohort):
    gold = T.prepare_features(cohort, trained.bundle, ["student_id"])
    probs = {r[0]: r[1] for r in T.score(cohort, trained.bundle, ["student_id"]).collect()}
    explained = T.explain(gold, trained.bundle, ["student_id"])
    for r in explained.collect():
        total = r["intercept"] + sum(c["contribution"] for c in r["contributions"])
        assert total == pytest.approx(r["log_odds"], abs=1e-9) and r["proba"] == pytest.approx(probs[r["student_id"]], abs=1e-9)
    names = T.transformed_names(trained.bundle)
    assert len(names) == len(set(names)) and any(n.startswith("cat__filiere_Gestion") for n in names)
    shares = T.source_contributions(explained, trained.bundle).first()
    assert sum(shares["shares"]) + shares["intercept"] == pytest.approx(shares["log_odds"], abs=1e-9)
    sheet = T.explanation_sheet(cohort, trained.bundle, ["student_id"]).collect()
    assert sheet and all("boursier" not in r["label"] and "sexe" not in r["label"] and "ancienneté" not in r["label"] for r in sheet)
    assert max(r["position"] for r in sheet) <= 5


# --- registry and cycles ----------------------------------------------------


def test_registry_lifecycle(store):
    reg = Registry(store, "risk")
    good = {"auc_test": 0.95, "recall_test": 0.96, "fairness_recall_gap_test": 0.04, "other": 1.0}
    v1 = reg.register(good, "/m/1")
    assert reg.aliases() == {"candidate": v1}
    assert not reg.promote(v1, human_approved=False)["approved_for_production"]
    assert reg.promote(v1, human_approved=True)["approved_for_production"]
    v2 = reg.register({**good, "recall_test": 0.97}, "/m/2")
    assert reg.promote(v2, True)["approved_for_production"]
    assert reg.aliases() == {"candidate": v2, "production": v2, "archived": v1}
    v3 = reg.register({**good, "recall_test": 0.91}, "/m/3")
    assert reg.promote(v3, True)["reasons"] == ["recall_regression_vs_production"]
    reg.rollback(v1)
    assert reg.aliases()["production"] == v1 and reg.source_of() == "/m/1"
    with pytest.raises(ValueError):
        reg.move("staging", v1)
    with pytest.raises(LookupError):
        Registry(store, "unknown").source_of()


def test_run_log(store):
    run = log_run(store, {"auc_test": 0.9, "flag": True, "settings": {"model_class": "LogisticRegressionModel", "folds": 5}, "subgroups": {}})
    got = {r["key"]: r["value"] for r in store.read("training_run").where(F.col("run_id") == run).collect()}
    assert got["auc_test"] == "0.9" and got["folds"] == "5" and "flag" not in got and "subgroups" not in got


def test_monitoring_cycle_alerts_once(spark, store, cohort, tmp_path):
    shifted = cohort.withColumns({"age": F.col("age") + 30, "student_id": F.concat("student_id", F.lit("x"))})
    told = []

    def run(day, current, notify=told.append):
        return MO.monitoring_cycle(store, cohort, current, str(tmp_path / f"r{day}"), dt.datetime(2024, 1, day, 6, tzinfo=UTC), notify=notify)

    first = run(1, shifted)
    assert first["drift_status"] == "alert" and first["alert"]["should_alert"] and "age" in first["alert"]["affected_features"]
    assert run(1, shifted)["status"] == "skipped"
    again = run(2, shifted, notify=lambda event: 1 / 0)
    assert again["alert"]["should_alert"]
    done = run(3, cohort)
    assert done["alert"]["should_resolve"] and [e["event"] for e in told] == ["drift_alert", "drift_resolved"]
    features, summary = FS.read_report(spark, str(tmp_path / "r1"))
    assert summary.first()["status"] == "alert" and features.count() == summary.first()["features_checked"]


def test_cycles_go_on_behind_each_step(spark, store, cohort, big_cohort, catalogue, tmp_path):
    """Every run is cut off behind one step; effects are there once and the results are those of one run."""
    shifted = cohort.withColumn("age", F.col("age") + 30)
    told, at = [], dt.datetime(2024, 3, 1, 6, tzinfo=UTC)
    store.write_manifest("b1", "x", {})
    for step in ("report", "store_report", "alert", "notify"):
        with pytest.raises(MO.Interrupted):
            MO.monitoring_cycle(store, cohort, shifted, str(tmp_path / "m"), at, batch_id="b1", notify=told.append, stop_after=step)
    done = MO.monitoring_cycle(store, cohort, shifted, str(tmp_path / "m"), at, batch_id="b1", notify=told.append)
    assert done["alert"]["should_alert"] and len(told) == 1
    assert [store.read(x).count() for x in ("gold_drift_report", "alert_state", "job_run")] == [1, 1, 1]
    # An alert step that was cut off between its effect and its journal row decides the same again.
    store.append_row("alert_state", subject="again", triggered_at=at, resolved_at=None, written_at=at)
    again = MO.monitoring_cycle(store, cohort, shifted, str(tmp_path / "n"), at + dt.timedelta(days=9), subject="drift")
    assert again["alert"]["should_alert"]
    assert MO.last_alert(store, "again", at).isEmpty()

    def retrain(stop=None):
        return MO.retraining_cycle(
            store, big_cohort, catalogue, str(tmp_path / "m"), str(tmp_path / "bundle"), dt.date(2020, 1, 1), True,
            now=at, notify=told.append, c_grid=(0.1,), folds=1, stop_after=stop,
        )

    for step in ("decide", "train", "log", "register", "notify"):
        with pytest.raises(MO.Interrupted):
            retrain(step)
    assert retrain()["candidate_version"] == 1 and len(told) == 2
    registry = Registry(store, "cohort-risk")
    assert registry.versions().count() == 1 and registry.moves().count() == 1 and store.read("training_run").select("run_id").distinct().count() == 1
    row = registry.versions().first()
    assert registry.register({}, "elsewhere", row["run_id"]) == 1 and registry.versions().count() == 1


def test_retraining_cycle(spark, store, cohort, big_cohort, catalogue, tmp_path):
    report = str(tmp_path / "r")
    features, summary = MO.drift_report(cohort, cohort)
    FS.write_report(features, summary, report)

    def run(day, labels, since):
        return MO.retraining_cycle(
            store, big_cohort, catalogue, report, str(tmp_path / "b"), since, labels,
            now=dt.datetime(2024, 6, day, 7, tzinfo=UTC), c_grid=(0.1,), folds=1,
        )

    assert run(1, True, dt.date(2024, 1, 1))["decision"]["action"] == "monitor"
    assert run(2, False, dt.date(2020, 1, 1))["decision"]["action"] == "investigate_and_collect_labels"
    got = run(3, True, dt.date(2020, 1, 1))
    assert got["candidate_version"] == 1 and got["promotion"] == "human_approval_required"
    assert run(3, True, dt.date(2020, 1, 1))["status"] == "skipped"


# --- streaming --------------------------------------------------------------

EVENTS = "event_id long, ts timestamp, key string, kind string"


def event_folder(spark, tmp_path, rows):
    folder = str(tmp_path / "events")
    start = dt.datetime(2024, 1, 1)
    data = [(i, start + dt.timedelta(seconds=s), k, kind) for i, (s, k, kind) in enumerate(rows)]
    spark.createDataFrame(data, EVENTS).coalesce(1).write.parquet(folder)
    return spark.readStream.schema(EVENTS).parquet(folder), spark.createDataFrame(data, EVENTS)


def run_stream(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    query = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert not query.isActive
    return spark.read.schema(df.schema).parquet(out)


def test_limiter_and_lockout_streams(spark, tmp_path):
    rows = [(0, "a", "bad"), (10, "a", "bad"), (20, "a", "bad"), (61, "a", "ok"), (70, "b", "bad"), (75, "a", "bad"), (200, "a", "bad")]
    ST.use_rocksdb(spark)
    stream, _ = event_folder(spark, tmp_path, rows)
    got = {r["event_id"]: (r["allowed"], r["retry_after"]) for r in run_stream(spark, ST.limited_calls(stream, "key", 1, 60), tmp_path, "lim").collect()}
    assert [got[i][0] for i in range(7)] == [True, False, False, True, True, False, True]
    assert got[1][1] == 51 and got[0][1] == 0
    locks = ST.lockouts(stream, "key", F.col("kind") == "bad", F.col("kind") == "ok", limit=2, seconds=60)
    got = {r["event_id"]: (r["refused"], r["failures"]) for r in run_stream(spark, locks, tmp_path, "lock").collect()}
    assert got == {0: (False, 1), 1: (False, 2), 2: (True, 2), 3: (False, 0), 4: (False, 1), 5: (False, 1), 6: (False, 1)}


def test_alert_history_stream(spark, tmp_path):
    rows = [(0, "m", "alert"), (3600, "m", "alert"), (7200, "m", "ok"), (9000, "m", "ok"), (90000, "m", "alert"), (90000 + 86400, "m", "alert")]
    stream, _ = event_folder(spark, tmp_path, rows)
    got = run_stream(spark, ST.alert_history(stream, "key", "kind", "ts"), tmp_path, "al").orderBy("us").collect()
    assert [(r["should_alert"], r["should_resolve"]) for r in got] == [
        (True, False), (False, False), (False, True), (False, False), (True, False), (True, False)]


def test_alerts_expire_and_late_reports_are_counted(spark, tmp_path):
    """Three arrivals: the subject is back after its expiry, then an older report of it comes in."""
    hour, folder = 3600, tmp_path / "reports"
    folder.mkdir()
    arrivals = [[(0, "m", "alert"), (hour, "m", "alert"), (2 * hour, "n", "alert")], [(30 * hour, "m", "alert"), (30 * hour + 60, "m", "ok")], [(30 * hour + 30, "m", "alert"), (30 * hour + 90, "m", "alert")]]
    for i, rows in enumerate(arrivals):
        (folder / f"{i}.json").write_text("\n".join(json.dumps({"sec": s, "key": k, "kind": x}) for s, k, x in rows))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    ST.use_rocksdb(spark)
    stream = spark.readStream.schema("sec long, key string, kind string").option("maxFilesPerTrigger", 1).json(str(folder))
    stream = stream.withColumn("ts", F.timestamp_seconds(F.col("sec") + 1_000_000))
    out = run_stream(spark, ST.alert_history(stream, "key", "kind", "ts", cooldown_hours=48, expiry_hours=24), tmp_path, "ex")
    got = {(r["subject"], r["us"] // 1_000_000 - 1_000_000): (r["should_alert"], r["should_resolve"], r["late"]) for r in out.collect()}
    assert got == {
        ("m", 0): (True, False, False), ("m", hour): (False, False, False), ("n", 2 * hour): (True, False, False),
        ("m", 30 * hour): (True, False, False), ("m", 30 * hour + 60): (False, True, False),
        ("m", 30 * hour + 30): (False, False, True), ("m", 30 * hour + 90): (True, False, False),
    }


def test_windowed_counts_same_in_stream_and_batch(spark, tmp_path):
    rows = [(i * 37, "ab"[i % 2], "ok") for i in range(200)]
    stream, batch = event_folder(spark, tmp_path, rows)
    streamed = run_stream(spark, RT.window_counts(stream, ["key"], step="10 seconds"), tmp_path, "wc")
    want = {tuple(r) for r in RT.window_counts(batch, ["key"], step="10 seconds").collect()}
    got = {tuple(r) for r in streamed.collect()}
    assert got and got <= want
    closed = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=199 * 37 - 600)
    assert got == {w for w in want if w[1] <= closed}


def test_trailing_windows_across_slices(spark, tmp_path):
    rows = [(i * 7 % 5000, "hot" if i % 3 else f"k{i % 5}", "bad" if i % 4 else "ok") for i in range(600)]
    _, batch = event_folder(spark, tmp_path, rows)
    out = RT.calls_in_window(batch, ["key"], 60, 3)
    got = {r["event_id"]: r["calls"] for r in out.collect()}
    for i, (s, k, _) in enumerate(rows):
        assert got[i] == sum(1 for t, q, _ in rows if q == k and s - 60 < t <= s)


def test_silence_and_pending(spark, tmp_path):
    rows = [(0, "a", "ok"), (100, "a", "ok"), (200_000, "a", "ok"), (50, "b", "ok")]
    _, batch = event_folder(spark, tmp_path, rows)
    assert [(r["event_id"], r["gap_seconds"]) for r in RT.silence_gaps(batch, ["key"], 1000).collect()] == [(2, 199_900.0)]
    rows = [(60 * m, "a", "bad") for m in (0, 1, 2, 3, 4, 6, 7)]
    (tmp_path / "p").mkdir()
    _, batch = event_folder(spark, tmp_path / "p", rows)
    got = RT.pending_alerts(batch, ["key"], F.col("kind") == "bad", 0.01, hold=5).collect()
    assert len(got) == 1 and got[0]["minutes"] == 5


def test_ingest_and_score_streams(spark, store, trained, cohort, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    columns = [c for c in cohort.columns if c not in ("abandon",)]
    lines = [r[0] for r in cohort.select(F.to_json(F.struct(*columns))).collect()]
    (folder / "one.json").write_text("\n".join([*lines, "{broken"]))
    kinds = [c for c in columns]
    J.ingest_stream(J.record_stream(spark, str(folder), kinds), store, "api", str(tmp_path / "s1"))
    J.ingest_stream(J.record_stream(spark, str(folder), kinds), store, "api", str(tmp_path / "s1"))
    stored = store.committed("bronze_student_raw")
    assert stored.count() == 13 and stored.where("NOT parse_ok").count() == 1
    out = str(tmp_path / "scored")
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cohort.schema if f.name in columns)
    J.score_stream(
        J.record_stream(spark, str(folder), dict(p.split(" ") for p in typed.split(", "))), trained.bundle, out, str(tmp_path / "s2"), ["student_id"]
    )
    got = {r["student_id"]: r["proba_abandon"] for r in J.answers(spark, out).collect()}
    assert [(r["record"], r["reason"]) for r in J.answers(spark, out, "rejects").collect()] == [("{broken", "unreadable record")]
    assert J.commits(spark, out).agg(F.sum("scored"), F.sum("rejected")).first() == (12, 1)
    want = {r["student_id"]: r["proba_abandon"] for r in T.score(cohort, trained.bundle, ["student_id"]).collect()}
    assert got == pytest.approx(want)


def test_schemas_cover_the_extracts():
    assert len(schemas.STUDENT_COLUMNS) == 33 and len(schemas.CATALOGUE_COLUMNS) == 7
    assert set(schemas.NUMBER_COLUMNS) < set(schemas.STUDENT_COLUMNS)
    assert M and C


def test_csv_quotes_breaks_and_header_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,n\n1,"He said ""hi"", ok",5\n2,"two\nlines",6\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('n,id,note\n7,3,plain\n', encoding="utf-8")
    rows = FS.read_csv(spark, str(tmp_path), ["id", "note", "n", "absent"], multi_line=True)
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [("1", 'He said "hi", ok', "5", None), ("2", "two\nlines", "6", None), ("3", "plain", "7", None)]
    FS.write_scores(rows, str(tmp_path / "out"))
    import csv
    import glob

    written = [r for f in glob.glob(str(tmp_path / "out" / "*.csv")) for r in csv.DictReader(open(f, encoding="utf-8", newline=""))]
    assert sorted(r["note"] for r in written) == sorted(g[1] for g in got)


def test_a_fit_reads_its_input_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    made = spark.range(400).selectExpr("concat('k', id) AS k", "CAST(id % 7 AS double) AS x", "concat('t', id % 3) AS w", "CAST(id % 7 + id % 5 > 5 AS int) AS y")
    rows = made.mapInArrow(counted, "k string, x double, w string, y int")
    model, best, auc = T.fit_logistic(rows, ["x", "w"], "y", "k", c_grid=(0.1, 1.0), folds=2)
    assert read.value == 400 and best in (0.1, 1.0) and 0.8 < auc <= 1
    assert model.transform(rows).where("probability IS NULL").count() == 0


def fold_rows(spark):
    made = spark.range(300).selectExpr(
        "concat('k', id) AS k", "CASE WHEN id % 9 <> 0 THEN CAST(id * id % 37 AS double) - 15 END AS x", "CAST(NULL AS double) AS z",
        "CASE WHEN id % 8 <> 0 THEN concat('t', id * id % 5) END AS w", "CAST(id * id % 37 + id % 5 > 18 AS int) AS y", "CAST(id * 7 % 3 AS int) AS _fold",
    )
    return made.repartition(3).persist()


def test_fills_of_all_folds_at_once(spark):
    rows = fold_rows(spark)
    got = T.fills_by_fold(rows, ["x", "z", "w"], "_fold", 3)
    assert got[None] == (T.medians(rows, ["x", "z"]), T.modes(rows, ["w"]))
    for fold in range(3):
        inner = rows.where(F.col("_fold") != fold)
        assert got[fold] == (T.medians(inner, ["x", "z"]), T.modes(inner, ["w"]))
    assert set(T.fills_by_fold(rows, ["x"], "_fold", 1)) == {None}


def test_folds_are_measured_together(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    calls, roc_auc, dealt = [], M.roc_auc, []
    folds = T.S.stratified_folds
    monkeypatch.setattr(M, "roc_auc", lambda *a: calls.append(a) or roc_auc(*a))
    monkeypatch.setattr(T.S, "stratified_folds", lambda *a: dealt.append(folds(*a).persist()) or dealt[0])
    grid = (0.001, 1.0)
    _, best, auc = T.fit_logistic(fold_rows(spark).drop("_fold"), ["x", "w"], "y", "k", c_grid=grid, folds=2)
    assert len(calls) == 1
    rows = dealt[0].withColumn("_label", F.col("y").cast("double"))
    measure = BinaryClassificationEvaluator(labelCol="_label", metricName="areaUnderROC", numBins=0)
    want = {c: [] for c in grid}
    for fold in range(2):
        inner, held = rows.where(F.col("_fold") != fold), rows.where(F.col("_fold") == fold)
        for c in grid:
            lr = LogisticRegression(featuresCol="features", labelCol="_label", weightCol="_weight", maxIter=200, standardization=False, regParam=1 / (c * inner.count()))
            model = Pipeline(stages=[*T.preprocessing_stages(inner, ["x", "w"]), lr]).fit(inner)
            want[c].append(measure.evaluate(model.transform(held)))
    means = {c: sum(v) / 2 for c, v in want.items()}
    assert best == max(grid, key=means.get) and auc == pytest.approx(means[best], abs=1e-9)


def test_a_fit_takes_as_few_tasks_as_its_rows_need(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression

    seen, fits = [], LogisticRegression.fitMultiple
    monkeypatch.setattr(LogisticRegression, "fitMultiple", lambda self, df, maps: seen.append((df.rdd.getNumPartitions(), df.count())) or fits(self, df, maps))
    rows = fold_rows(spark).drop("_fold")
    _, best, auc = T.fit_logistic(rows, ["x", "w"], "y", "k", c_grid=(0.1, 1.0), folds=2)
    assert seen == [(1, 150)] * 2
    # Small tasks: the fit's share of the cores; and more tasks, not larger ones, beyond that.
    monkeypatch.setattr(T, "FIT_VALUES", (100, 100_000))
    assert T.fit_logistic(rows, ["x", "w"], "y", "k", c_grid=(0.1, 1.0), folds=2)[1:] == (best, pytest.approx(auc)) and seen[2:] == [(2, 150)] * 2
    monkeypatch.undo()
    few, many = T.FIT_VALUES
    assert [T.fit_partitions(n, 12, 5) for n in (0, few, 2 * few, many, 100 * many)] == [1, 1, 2, 3, 100]
