"""Sources and sinks: written to the shared folder and read back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import keys as KEY, payload as P, text as X
from riskloom.operators import cohort as C, ordered as R
from riskloom.plans import medallion as ME, monitoring as MO
from riskloom.queries.base import SCORES_SQL, Tables, query, r6, scores, sql_title
from riskloom.queries.decisions import DRIFT_COLUMNS, PSI_SQL, drift_sides
from riskloom.queries.joins import BASE, SCOPE, SCOPE_LIST, scoped
from riskloom.session import scratch_path
from riskloom.sources import files as FS
from riskloom.sources.tables import TableStore

SECRET = "demo-secret"


def new_store(t: Tables) -> TableStore:
    store = TableStore(t.spark, scratch_path(t.spark, "store"))
    store.create()
    return store


@query(
    "csv_scan", "S1",
    "SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_scan(t: Tables) -> DataFrame:
    """A CSV with header and missing-value spellings, read as text and typed after."""
    path = scratch_path(t.spark, "customers-csv")
    messy = t.customer.withColumn("c_name", F.when(F.col("c_nationkey") == 3, "NA").otherwise(F.col("c_name")))
    messy.write.option("header", True).csv(path)
    rows = FS.read_csv(t.spark, path, FS.csv_columns(t.spark, path))
    return rows.select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_name",
        X.optional_int("c_nationkey").alias("c_nationkey"), X.optional_float("c_acctbal").alias("c_acctbal"), "c_mktsegment",
    )


@query(
    "csv_row_numbers", "S1 W5",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders",
)
def csv_row_numbers(t: Tables) -> DataFrame:
    """Numbers in file order, from block offsets instead of a one-task window."""
    path = scratch_path(t.spark, "orders-csv")
    t.orders.select("o_orderkey", "o_orderpriority").orderBy("o_orderkey").write.option("header", True).csv(path)
    rows = FS.read_csv(t.spark, path, ["o_orderkey", "o_orderpriority"], with_position=True)
    return FS.number_rows(rows).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "row_number")


@query("drift_report_file", "S2 S13 D10", f"WITH {PSI_SQL} SELECT feature, psi, status FROM features")
def drift_report_file(t: Tables) -> DataFrame:
    """A report written as one JSON document and read back."""
    ref, cur = drift_sides(t)
    path = scratch_path(t.spark, "drift")
    features, summary = MO.drift_report(ref, cur, DRIFT_COLUMNS)
    FS.write_report(features, summary, path)
    return FS.read_report(t.spark, path)[0]


@query(
    "csv_free_text", "S1 S12 S13",
    "SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INT) AS n FROM documents WHERE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) <> ''",
)
def csv_free_text(t: Tables) -> DataFrame:
    """Whole texts with quotes, commas and line breaks through a CSV file and back."""
    path = scratch_path(t.spark, "texts")
    FS.write_scores(t.documents.where(F.trim(F.regexp_replace("text", r"\s", "")) != "").select("doc_id", "text"), path)
    rows = FS.read_csv(t.spark, path, ["text", "doc_id"], multi_line=True)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), F.length("text").alias("n"))


@query(
    "csv_column_order", "S1 W5",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders",
)
def csv_column_order(t: Tables) -> DataFrame:
    """Files whose headers name the columns in another order, and one column in half of them only."""
    path, even = scratch_path(t.spark, "orders"), F.col("o_orderkey") % 2 == 0
    t.orders.where(even).select("o_orderpriority", "o_orderstatus", "o_orderkey").write.options(header=True, **FS.CSV_QUOTES).csv(f"{path}/a")
    t.orders.where(~even).select("o_orderkey", "o_orderstatus").write.options(header=True, **FS.CSV_QUOTES).csv(f"{path}/b")
    rows = FS.read_csv(t.spark, f"{path}/*", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query(
    "record_batches", "S3",
    "SELECT o_orderkey, o_orderstatus, o_orderkey % 10 = 0 AS broken FROM orders",
)
def record_batches(t: Tables) -> DataFrame:
    """JSON records with unreadable lines kept apart."""
    path = scratch_path(t.spark, "records")
    line = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    broken = F.col("o_orderkey") % 10 == 0
    t.orders.select(F.when(broken, F.concat(F.lit("!"), line)).otherwise(line).alias("value")).write.text(path)
    rows = FS.read_records(t.spark, path, {"o_orderkey": "bigint", "o_orderstatus": "string"})
    fixed = F.from_json(F.substring(F.col("_corrupt"), F.lit(2), F.length("_corrupt")), "o_orderkey bigint, o_orderstatus string")
    return rows.select(
        F.coalesce("o_orderkey", fixed["o_orderkey"]).alias("o_orderkey"),
        F.coalesce("o_orderstatus", fixed["o_orderstatus"]).alias("o_orderstatus"), F.col("_corrupt").isNotNull().alias("broken"),
    )


@query(
    "batch_manifest", "S4 S5 O3",
    f"WITH {SCORES_SQL} SELECT batch_id, count(*) AS rows_gold, 'sql' AS source_name, CAST(CAST(max(created_at) + INTERVAL 365 DAY AS DATE) AS VARCHAR) AS expires FROM scores GROUP BY 1",
)
def batch_manifest(t: Tables) -> DataFrame:
    store = new_store(t)
    rows = scores(t).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_gold"), F.max("created_at").alias("created_at"))
    store.append(
        "ingestion_batch",
        rows.select(
            "batch_id", F.col("batch_id").alias("id"), F.lit("sql").alias("source_name"), "rows_gold", "created_at",
            (F.col("created_at").cast("timestamp") + F.make_dt_interval(F.lit(K.RETENTION_DAYS))).alias("expires_at"),
        ),
    )
    return store.read("ingestion_batch").select(
        "batch_id", "rows_gold", "source_name", F.to_date("expires_at").cast("string").alias("expires")
    )


@query(
    "bronze_append", "S6",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS row_number, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_mktsegment': c_mktsegment}) AS VARCHAR) AS payload_json,
    true AS parse_ok, 'b1' AS batch_id FROM customer""",
)
def bronze_append(t: Tables) -> DataFrame:
    store = new_store(t)
    rows = R.global_rank(t.customer.select("c_custkey", "c_name", "c_mktsegment"), [F.col("c_custkey")], "row_number")
    store.append("bronze_student_raw", ME.bronze(rows, "b1"))
    return store.read("bronze_student_raw").select("row_number", "payload_json", "parse_ok", "batch_id")


_COHORT_SQL = f"""cohort AS (SELECT c_name AS student_id, {sql_title('c_mktsegment')} AS filiere, CAST(c_acctbal > 0 AS INT) AS abandon FROM customer)"""


def _cohort(t: Tables, labels: bool = True) -> DataFrame:
    rows = t.customer.select(
        F.col("c_name").alias("student_id"), F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("filiere"),
        F.lit(10).alias("nb_devoirs_total"), (F.col("c_custkey") % 11).cast("int").alias("nb_devoirs_rendus"),
        (F.col("c_custkey") % 7).cast("int").alias("connexions_lms_30j"), F.col("c_acctbal").alias("heures_lms_total"),
        F.col("c_nationkey").alias("ressources_consultees"),
    )
    flag = (F.col("heures_lms_total") > 0).cast("int")
    return rows.withColumn(K.TARGET_CLF, flag if labels else F.when(F.col("ressources_consultees") != 0, flag))


def _catalogue(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_mktsegment").alias("filiere")).distinct().withColumn("faculte", F.upper("filiere"))


@query(
    "silver_append", "S7 C9",
    f"WITH {_COHORT_SQL} SELECT filiere, abandon, count(*) AS n, count(DISTINCT student_id) AS students, min(length(student_id)) = 18 AS plain FROM cohort GROUP BY 1, 2",
)
def silver_append(t: Tables) -> DataFrame:
    store = new_store(t)
    students = ME.silver_students(_cohort(t), SECRET)
    store.append("silver_student", ME.silver_rows(ME.numbered(students), "b1"))
    stored = store.read("silver_student")
    return stored.groupBy("filiere", "abandon").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("student_id").alias("students"),
        (F.min(F.length("student_id")) == 64).alias("plain"),
    )


@query(
    "medallion_load", "S4 S5 S6 S7 S8 S11 S16 A30 C7 C8",
    "SELECT 2 * count(*) + 2 * count(DISTINCT c_mktsegment) AS rows_layers, count(*) AS rows_gold, 1 AS audits FROM customer",
)
def medallion_load(t: Tables) -> DataFrame:
    """All layers of one load plus its manifest and audit rows."""
    store = new_store(t)
    ME.load(store, _cohort(t), _catalogue(t), secret=SECRET, batch_id="b1")
    audits = store.read("privacy_audit_log").where("action = 'medallion_load'").agg(F.count(F.lit(1)).cast("int"))
    return store.read("ingestion_batch").select(
        (F.col("rows_bronze") + F.col("rows_silver")).alias("rows_layers"), "rows_gold", audits.scalar().alias("audits")
    )


@query(
    "gold_skipped", "S8 A30",
    "SELECT 2 * count(*) + 2 * count(DISTINCT c_mktsegment) AS rows_layers, 0 AS rows_gold FROM customer",
)
def gold_skipped(t: Tables) -> DataFrame:
    """One missing label keeps the whole batch out of Gold."""
    store = new_store(t)
    ME.load(store, _cohort(t, labels=False), _catalogue(t), secret=SECRET, batch_id="b1")
    return store.read("ingestion_batch").select(
        (F.col("rows_bronze") + F.col("rows_silver")).alias("rows_layers"), F.col("rows_gold").cast("int").alias("rows_gold")
    )


@query(
    "prediction_append", "S9 S11 J7",
    f"WITH {SCORES_SQL} SELECT count(*) AS n, count(DISTINCT student_id) AS students, sum(alerte)::BIGINT AS alerts, true AS traced FROM scores",
)
def prediction_append(t: Tables) -> DataFrame:
    store = new_store(t)
    store.write_manifest("b1", "orders", {})
    rows = KEY.pseudonymize(scores(t).select("student_id", "proba_abandon", "alerte"), secret=SECRET)
    scored = rows.withColumn("payload_json", P.to_payload(rows))
    store.save_predictions("b1", scored, "v1", 0.6)
    audits = store.read("privacy_audit_log").where("action = 'prediction_persist' AND target_id = 'b1'")
    return store.read("gold_prediction").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("student_id").alias("students"), F.sum("alerte").alias("alerts")
    ).select("n", "students", "alerts", (audits.agg(F.count(F.lit(1))).scalar() == 1).alias("traced"))


@query(
    "drift_append", "S10 W8",
    f"WITH {PSI_SQL} SELECT CASE WHEN count(*) FILTER (status = 'alert') > 0 THEN 'alert' WHEN count(*) FILTER (status = 'watch') > 0 THEN 'watch' ELSE 'ok' END AS status, count(*) FILTER (status = 'watch')::INT AS watch_count, count(*) FILTER (status = 'alert')::INT AS alert_count FROM features",
)
def drift_append(t: Tables) -> DataFrame:
    store = new_store(t)
    store.write_manifest("b1", "lineitem", {})
    ref, cur = drift_sides(t)
    features, summary = MO.drift_report(ref, cur, DRIFT_COLUMNS)
    store.save_drift_report("b1", FS.report_document(features, summary))
    newest = C.most_recent(store.read("gold_drift_report"), [F.col("created_at").desc()], 1)
    return newest.select("status", "watch_count", "alert_count")


@query("score_csv", "S12", f"WITH {SCORES_SQL} SELECT id, round(proba_abandon, 6) AS proba_abandon, alerte FROM scores")
def score_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "scores-csv")
    FS.write_scores(scores(t).select("id", "proba_abandon", "alerte"), path)
    rows = FS.read_csv(t.spark, path, ["id", "proba_abandon", "alerte"])
    return rows.select(
        F.col("id").cast("long").alias("id"), r6(X.optional_float("proba_abandon")).alias("proba_abandon"),
        X.optional_int("alerte").alias("alerte"),
    )


@query(
    "export_ceiling", "S14",
    f"""WITH {SCORES_SQL}, b AS (SELECT batch_id, count(*) AS n FROM scores GROUP BY 1), m AS (SELECT max(n) AS n FROM b)
    SELECT batch_id, b.n AS rows, CASE WHEN b.n = m.n THEN 'refused' ELSE 'written' END AS outcome,
      CASE WHEN b.n = m.n THEN 0 ELSE b.n END AS stored, CASE WHEN b.n < m.n THEN 'review ' || batch_id END AS purpose FROM b, m""",
)
def export_ceiling(t: Tables) -> DataFrame:
    """One export per batch under a ceiling that the largest batch breaks; files and purpose read back."""
    root = scratch_path(t.spark, "exports")
    counted = scores(t).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    batches = counted.collect()  # a row per batch
    ceiling = max(r["rows"] for r in batches) - 1
    refused = []
    for r in batches:
        rows = scores(t).where(F.col("batch_id") == r["batch_id"]).select(
            "*", F.col("student_id").alias("pseudo_id"), F.lit("x").alias("filiere")
        )
        try:
            FS.export_csv(rows, f"{root}/{r['batch_id']}", ceiling, f"review {r['batch_id']}")
        except FS.ExportTooLarge:
            refused.append(r["batch_id"])
    written = FS.read_csv(t.spark, f"{root}/B????", K.EXPORT_COLUMNS).groupBy("batch_id").agg(F.count(F.lit(1)).alias("stored"))
    note = t.spark.read.text(f"{root}/*.purpose").select(F.col("value").alias("purpose"), F.substring("value", 8, 100).alias("batch_id"))
    return counted.join(written, "batch_id", "left").join(note, "batch_id", "left").select(
        "batch_id", "rows", F.when(F.col("batch_id").isin(refused), "refused").otherwise("written").alias("outcome"),
        F.coalesce("stored", F.lit(0).cast("long")).alias("stored"), "purpose",
    )


@query(
    "export_rows", "S14 P27",
    f"""{BASE}, f AS (SELECT *, row_number() OVER (ORDER BY proba_abandon DESC, id) AS rang FROM scoped WHERE filiere IN ({SCOPE_LIST}) AND alerte = 1)
    SELECT student_id AS pseudo_id, rang, printf('%.6f', proba_abandon) AS proba_abandon, alerte, filiere, batch_id, '''=v1' AS model_version, '0.6000' AS threshold, '2024-01-01T00:00:00' AS generated_at FROM f""",
)
def export_rows(t: Tables) -> DataFrame:
    """The closed export columns for one scope, ranks by range sort instead of one task."""
    rows = scoped(t, SCOPE).where("alerte = 1").withColumns(
        {"pseudo_id": F.col("student_id"), "model_version": F.lit("=v1"), "threshold": F.lit(0.6)}
    )
    return FS.export_rows(C.ranked(rows, "proba_abandon", "id", "rang"), "2024-01-01T00:00:00")


@query(
    "request_logs", "S17 P35",
    "SELECT event_id, 'INFO' AS level, CASE WHEN event_type <> 'error' THEN event_type END AS event, CASE WHEN event_type = 'error' THEN 'plain text' END AS message FROM events",
)
def request_logs(t: Tables) -> DataFrame:
    """JSON log lines merged over base fields; plain lines become the message."""
    line = F.when(F.col("event_type") == "error", "plain text").otherwise(
        F.to_json(F.struct(F.col("event_type").alias("event"), F.col("value").alias("duration_ms")))
    )
    rows = FS.log_lines(
        t.events.select("event_id", line.alias("line")), "line", {"level": F.lit("INFO"), "logger": F.lit("audit")}
    )
    fields = F.col("fields")
    return rows.select(
        "event_id", fields["level"].alias("level"), fields["event"].alias("event"), fields["message"].alias("message")
    )


@query(
    "purged_store", "J6 S11",
    f"""WITH {SCORES_SQL}, b AS (SELECT batch_id, max(created_at) + INTERVAL 365 DAY AS e FROM scores GROUP BY 1)
    SELECT batch_id, count(*) AS n FROM scores WHERE batch_id NOT IN (SELECT batch_id FROM b WHERE e <= TIMESTAMP '1999-06-30') GROUP BY 1""",
)
def purged_store(t: Tables) -> DataFrame:
    """Retention purge of a stored table: expired partitions go, others stay untouched."""
    store = new_store(t)
    rows = scores(t)
    store.append("gold_prediction", rows)
    expiry = (F.max("created_at").cast("timestamp") + F.make_dt_interval(F.lit(K.RETENTION_DAYS))).alias("expires_at")
    store.append(
        "ingestion_batch", rows.groupBy("batch_id").agg(expiry).withColumns({"id": F.col("batch_id"), "source_name": F.lit("sql")})
    )
    store.purge_expired(datetime(1999, 6, 30, tzinfo=timezone.utc))
    return store.committed("gold_prediction").groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ingest_stream", "T8 S3",
    "SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS rejected, count(DISTINCT event_id) AS distinct_rows FROM events",
)
def ingest_stream(t: Tables) -> DataFrame:
    """Arriving JSON files appended to Bronze, unreadable lines marked."""
    from riskloom.streaming import jobs as J

    folder, state = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "arrivals-state")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    t.events.select(F.when(F.col("event_type") == "error", F.concat(F.lit("!"), line)).otherwise(line)).write.text(folder)
    store = new_store(t)
    J.ingest_stream(J.record_stream(t.spark, folder, ["event_id", "event_type", "value"]), store, "events", state)
    stored = store.committed("bronze_student_raw")
    event = F.regexp_extract("payload_json", r'"event_id":"?(\d+)', 1)
    return stored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("parse_ok")).alias("rejected"), F.countDistinct(event).alias("distinct_rows")
    )


@query("score_stream", "T7 S15 M6")
def score_stream(t: Tables) -> DataFrame:
    """A saved model scores arriving records by the same code as batch scoring."""
    from riskloom.plans import training as T
    from riskloom.streaming import jobs as J

    cohort = _cohort(t).withColumn("student_id", F.col("student_id"))
    features = ["nb_devoirs_rendus", "connexions_lms_30j", "ressources_consultees", "filiere", "taux_rendu_devoirs"]
    prepared = ME.prepared_training(cohort, _catalogue(t))
    model, _, _ = T.fit_logistic(prepared, features, K.TARGET_CLF, "student_id")
    path = scratch_path(t.spark, "bundle")
    T.ModelBundle(model, features, 0.5, _catalogue(t), metadata={"model_version": "v1"}).save(path)
    folder, state, out = (scratch_path(t.spark, n) for n in ("arrivals", "scores-state", "scores"))
    cohort.write.json(folder)
    records = J.record_stream(t.spark, folder, cohort.columns)
    J.score_stream(records, T.ModelBundle.load(t.spark, path), out, state, keep=["student_id"])
    return J.answers(t.spark, out).select("student_id", r6("proba_abandon").alias("proba"), "alerte")


@query("monitoring_cycle", "D10 D9 D8 S13")
def monitoring_cycle(t: Tables) -> DataFrame:
    """The whole cycle twice on one day: the second run is skipped."""
    store = new_store(t)
    ref, cur = drift_sides(t)
    at = datetime(2024, 1, 8, 6, tzinfo=timezone.utc)
    runs = [
        MO.monitoring_cycle(store, ref, cur, scratch_path(t.spark, "report"), at) for _ in range(2)
    ]
    skipped = sum(r["status"] == "skipped" for r in runs)
    return store.read("job_run").select("job", "status", F.lit(skipped).alias("skipped"))


@query("retraining_cycle", "D11 D6 M5 M13 M14")
def retraining_cycle(t: Tables) -> DataFrame:
    """Drift report, decision, training, run log and candidate registration."""
    store = new_store(t)
    ref, cur = drift_sides(t)
    features, summary = MO.drift_report(ref, cur, DRIFT_COLUMNS)
    report = scratch_path(t.spark, "report")
    FS.write_report(features, summary, report)
    MO.retraining_cycle(
        store, _cohort(t), _catalogue(t), report, scratch_path(t.spark, "bundle"), datetime(2020, 1, 1).date(), True,
        now=datetime(2024, 1, 8, 7, tzinfo=timezone.utc),
    )
    return store.read("model_alias_event").join(store.read("model_version"), ["name", "version"]).select(
        "name", "alias", "version", F.map_keys("metrics").alias("gate_metrics")
    )




@query(
    "purge_audit", "J6 S11",
    f"""WITH {SCORES_SQL}, b AS (SELECT batch_id, max(created_at) + INTERVAL 365 DAY AS e FROM scores GROUP BY 1)
    SELECT batch_id, 1 AS events, '["' || batch_id || '"]' AS purged FROM b WHERE e <= TIMESTAMP '1999-06-30'""",
)
def purge_audit(t: Tables) -> DataFrame:
    """Every purged batch is named in an audit row of its own; a repeated purge adds none."""
    store = new_store(t)
    rows = scores(t)
    store.append("gold_prediction", rows)
    expiry = (F.max("created_at").cast("timestamp") + F.make_dt_interval(F.lit(K.RETENTION_DAYS))).alias("expires_at")
    batches = rows.groupBy("batch_id").agg(expiry).withColumns({"id": F.col("batch_id"), "source_name": F.lit("sql")})
    for _ in range(2):
        store.append("ingestion_batch", batches)
        store.purge_expired(datetime(1999, 6, 30, tzinfo=timezone.utc))
    log = store.read("privacy_audit_log").where("action = 'retention_purge'")
    return log.groupBy(F.col("target_id").alias("batch_id")).agg(
        F.count(F.lit(1)).cast("int").alias("events"), F.max(F.get_json_object("metadata_json", "$.purged_batches")).alias("purged")
    )


@query(
    "retried_append", "S9 S10 S11",
    f"""WITH {SCORES_SQL} SELECT 'predictions' AS kind, 'first' AS run_id, count(*) AS n, count(*) AS ids, CAST(1 AS BIGINT) AS audits FROM scores
    UNION ALL SELECT 'predictions', 'second', count(*), count(*), 1 FROM scores WHERE alerte = 1
    UNION ALL SELECT 'reports', 'first', 1, 1, 1""",
)
def retried_append(t: Tables) -> DataFrame:
    """A run that writes part of its rows, fails and is repeated by another session leaves one copy; a second run adds its own."""
    store = new_store(t)
    store.write_manifest("b1", "orders", {})
    rows = KEY.pseudonymize(scores(t).select("student_id", "proba_abandon", "alerte"), secret=SECRET)
    scored = R.kept(rows.withColumn("payload_json", P.to_payload(rows)))
    features, summary = MO.drift_report(*drift_sides(t), DRIFT_COLUMNS)
    for part, root in ((scored.where("proba_abandon > 0.5"), t.spark), (scored, t.spark.newSession())):
        again = TableStore(root, store.root)
        again.save_predictions("b1", part, "v1", 0.6, run_id="first")
        again.save_drift_report("b1", FS.report_document(features, summary), run_id="first")
    store.save_predictions("b1", scored.where("alerte = 1"), "v1", 0.6, run_id="second")
    found = store.read("gold_prediction").select(F.lit("predictions").alias("kind"), "run_id", F.col("id").cast("string").alias("id"))
    found = found.unionByName(store.read("gold_drift_report").select(F.lit("reports").alias("kind"), "run_id", "id"))
    log = store.read("privacy_audit_log").select(
        F.when(F.col("action") == "prediction_persist", "predictions").otherwise("reports").alias("kind"),
        F.get_json_object("metadata_json", "$.run").alias("run_id"),
    ).groupBy("kind", "run_id").agg(F.count(F.lit(1)).alias("audits"))
    return found.groupBy("kind", "run_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids")).join(log, ["kind", "run_id"])


@query(
    "score_rejects", "T7 S3 S15 M6",
    "SELECT c_name AS student_id, CASE WHEN c_custkey % 7 = 0 THEN 'rejected' ELSE 'scored' END AS verdict, "
    "CASE WHEN c_custkey % 7 <> 0 THEN round(1 / (1 + exp(1 - 0.3 * (c_custkey % 11))), 6) END AS proba, "
    "CASE WHEN c_custkey % 7 <> 0 THEN CAST(1 / (1 + exp(1 - 0.3 * (c_custkey % 11))) >= 0.6 AS INT) END AS alerte FROM customer",
)
def score_rejects(t: Tables) -> DataFrame:
    """A saved model of known coefficients answers every record, unreadable ones by a reject; the
    stream then loses its checkpoint and starts again, which leaves one answer per record."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    from riskloom.plans import training as T
    from riskloom.streaming import jobs as J

    logit = "1 / (1 + exp(1 - 0.3 * cast(nb_devoirs_rendus AS double)))"
    stages = [SQLTransformer(statement=f"SELECT *, 1 - {logit} AS _p0, {logit} AS _p1 FROM __THIS__"), VectorAssembler(inputCols=["_p0", "_p1"], outputCol="probability")]
    path, folder, out = (scratch_path(t.spark, n) for n in ("bundle", "arrivals", "scores"))
    T.ModelBundle(PipelineModel(stages), ["nb_devoirs_rendus"], 0.6, _catalogue(t), metadata={"model_version": "v1"}).save(path)
    cohort = _cohort(t)
    line = F.to_json(F.struct(*cohort.columns))
    broken = F.pmod(F.substring("student_id", -6, 6).cast("int"), F.lit(7)) == 0
    cohort.select(F.when(broken, F.concat(F.lit("!"), line)).otherwise(line)).repartition(8).write.text(folder)
    for _ in range(2):
        records = J.record_stream(t.spark, folder, cohort.columns, files_per_batch=3)
        J.score_stream(records, T.ModelBundle.load(t.spark, path), out, scratch_path(t.spark, "scores-state"), keep=["student_id"])
    scored = J.answers(t.spark, out).select("student_id", F.lit("scored").alias("verdict"), r6("proba_abandon").alias("proba"), "alerte")
    lost = J.answers(t.spark, out, "rejects").select(
        F.get_json_object(F.substring(F.col("record"), F.lit(2), F.length("record")), "$.student_id").alias("student_id"), F.lit("rejected").alias("verdict"),
    )
    return scored.unionByName(lost, allowMissingColumns=True)


@query(
    "interrupted_cycles", "D10 D11 D8 D9 S10 M13 M14",
    f"""WITH {PSI_SQL}, dd AS (SELECT CASE WHEN count(*) FILTER (status = 'alert') > 0 THEN 'alert' WHEN count(*) FILTER (status = 'watch') > 0 THEN 'watch' ELSE 'ok' END AS status FROM features),
    vv AS (SELECT status, status = 'alert' AS fires FROM dd)
    SELECT 'monitoring' AS job, 1 AS position, 'report' AS step, status AS outcome, 1 AS n FROM vv
    UNION ALL SELECT 'monitoring', 2, 'store_report', 'b1', 1 FROM vv UNION ALL SELECT 'monitoring', 3, 'alert', CASE WHEN fires THEN 'true' ELSE 'false' END, 1 FROM vv
    UNION ALL SELECT 'monitoring', 4, 'notify', NULL, 1 FROM vv UNION ALL SELECT 'monitoring', 9, 'job_run', 'succeeded', 1 FROM vv
    UNION ALL SELECT 'monitoring', 9, 'gold_drift_report', status, 1 FROM vv UNION ALL SELECT 'monitoring', 9, 'alert_state', 'drift', 1 FROM vv WHERE fires
    UNION ALL SELECT 'retraining', 1, 'decide', 'monitor', 1 FROM vv UNION ALL SELECT 'retraining', 9, 'job_run', 'succeeded', 1 FROM vv""",
)
def interrupted_cycles(t: Tables) -> DataFrame:
    """Both cycles cut off behind each step and started again: every step and every effect is there once."""
    store = new_store(t)
    store.write_manifest("b1", "lineitem", {})
    ref, cur = (side.select(*[c for c in DRIFT_COLUMNS if c in side.columns]) for side in drift_sides(t))
    report, at = scratch_path(t.spark, "report"), datetime(2024, 1, 8, 6, tzinfo=timezone.utc)

    def resumed(steps, run) -> None:
        for step in [*steps, None, None]:
            try:
                run(step)
            except MO.Interrupted:
                continue

    resumed(["report", "store_report", "alert", "notify"], lambda s: MO.monitoring_cycle(store, ref, cur, report, at, batch_id="b1", stop_after=s))
    # A fresh model and no drift in the same report's own terms: the decision ends the job.
    calm = scratch_path(t.spark, "report")
    FS.write_report(*MO.drift_report(ref, ref), calm)
    resumed(["decide"], lambda s: MO.retraining_cycle(store, ref, ref, calm, scratch_path(t.spark, "bundle"), at.date(), True, now=at, stop_after=s))
    found = lambda *names: F.coalesce(*[F.get_json_object("result_json", f"$.{n}") for n in names])
    steps = store.read("job_step").select("job", "position", "step", found("should_alert", "action", "batch_id", "status").alias("outcome"))
    effects = store.read("job_run").select("job", F.lit(9).alias("position"), F.lit("job_run").alias("step"), F.col("status").alias("outcome"))
    for name, outcome in (("gold_drift_report", "status"), ("alert_state", "subject")):
        effects = effects.unionByName(store.read(name).select(F.lit("monitoring").alias("job"), F.lit(9).alias("position"), F.lit(name).alias("step"), F.col(outcome).alias("outcome")))
    return steps.unionByName(effects).groupBy("job", "position", "step", "outcome").agg(F.count(F.lit(1)).cast("int").alias("n"))
