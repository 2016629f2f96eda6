"""Bronze, Silver and Gold layers of one load."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import keys as KEY, numbers as N, payload as P, text as X
from riskloom.operators import cleaning as CL, ordered as R, perimeter as PM, splitting as S
from riskloom.operators.lineage import traced
from riskloom.sources.tables import TableStore, utc_now


@dataclass(frozen=True)
class LoadResult:
    batch_id: str
    rows_bronze: int
    rows_silver: int
    rows_gold: int


def bronze(raw: DataFrame, batch_id: str, position: str = "row_number") -> DataFrame:
    """Each raw row as one JSON payload with its 1-based number in load order."""
    body = [c for c in raw.columns if c != position]
    return raw.select(
        F.col(position).cast("long").alias("row_number"),
        P.to_payload(raw, body).alias("payload_json"),
        F.lit(True).alias("parse_ok"),
        F.lit(None).cast("string").alias("rejected_reason"),
        F.lit(batch_id).alias("batch_id"),
    )


def numbered(df: DataFrame, position: str = "row_number") -> DataFrame:
    """Number rows in the order Spark reads them; use ``files.number_rows`` for files."""
    return R.numbered(R.kept(df), position)


def silver_students(raw: DataFrame, secret: str | None = None) -> DataFrame:
    """Pseudonyms first, cleaning after, so no later step sees an identifier."""
    return CL.clean(KEY.pseudonymize(raw, secret=secret))


def silver_catalogue(catalogue: DataFrame, key: str = "filiere") -> DataFrame:
    return catalogue.withColumn(key, X.title_key(key)) if key in catalogue.columns else catalogue


def typed(df: DataFrame, numbers: list[str]) -> DataFrame:
    return df.withColumns({c: N.nan_to_null(X.optional_float(c)) for c in numbers if c in df.columns})


def prepared_training(raw: DataFrame, catalogue: DataFrame, since=None) -> DataFrame:
    """Clean, enrich, derive."""
    return CL.add_features(CL.enrich(CL.clean(raw), catalogue), since)


def gold_with_ids(students: DataFrame, catalogue: DataFrame) -> DataFrame:
    prepared = CL.add_features(CL.enrich(students, catalogue))
    return PM.gold(prepared, keep=K.ID_COLS)


def labels_complete(df: DataFrame, label: str = K.TARGET_CLF) -> bool:
    """One aggregate: every row has a label (false for no rows or no label column)."""
    if label not in df.columns:
        return False
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("k")).first()
    return row["n"] > 0 and row["n"] == row["k"]


def silver_rows(students: DataFrame, batch_id: str) -> DataFrame:
    def optional(c: str, kind: str):
        return (F.col(c) if c in students.columns else F.lit(None)).cast("string").try_cast(kind).alias(c)

    body = [c for c in students.columns if c != "row_number"]
    return students.select(
        "row_number",
        *[optional(c, "string") for c in (*K.ID_COLS, "filiere")],
        optional(K.TARGET_CLF, "double").try_cast("int").alias(K.TARGET_CLF), optional(K.TARGET_REG, "double"),
        P.to_payload(students, body).alias("payload_json"), F.lit(batch_id).alias("batch_id"),
    )


def gold_rows(gold: DataFrame, batch_id: str, key: str = "student_id") -> DataFrame:
    features = [c for c in gold.columns if c not in (*K.ID_COLS, K.TARGET_CLF, K.TARGET_REG, "split_set")]
    return gold.select(
        F.col(key).alias("student_id"), "split_set", F.col(K.TARGET_CLF).cast("int").alias("label_abandon"),
        P.to_payload(gold, features).alias("features_json"), F.lit(batch_id).alias("batch_id"),
    )


def load(
    store: TableStore, raw: DataFrame, catalogue: DataFrame, source_name: str = "csv",
    source_uri: str | None = None, seed: int = 42, retention_days: int = K.RETENTION_DAYS,
    actor: str = "system", secret: str | None = None, batch_id: str | None = None,
    number_columns: list[str] | None = None,
) -> LoadResult:
    """Write all layers of one batch, then its manifest row, then the audit row.

    ``raw`` and ``catalogue`` may carry ``row_number``; otherwise rows are numbered in
    read order. A repeated call with the same batch id replaces the batch.
    """
    KEY.resolve_secret(secret)
    batch_id = batch_id or str(uuid4())
    stamp = F.lit(utc_now())
    students_in = raw if "row_number" in raw.columns else numbered(raw)
    catalogue_in = catalogue if "row_number" in catalogue.columns else numbered(catalogue)
    body = students_in.drop("row_number")
    if number_columns:
        body = typed(body, number_columns)
    # Silver feeds two layers: store it once instead of cleaning twice.
    students = R.kept(traced(silver_students(body, secret)))
    dims = silver_catalogue(catalogue_in.drop("row_number"))

    store.append("bronze_student_raw", bronze(students_in, batch_id).withColumn("created_at", stamp))
    store.append("bronze_catalogue_raw", bronze(catalogue_in, batch_id).withColumn("created_at", stamp))
    store.append("silver_student", silver_rows(R.numbered(students, "row_number"), batch_id).withColumn("created_at", stamp))
    store.append(
        "silver_catalogue",
        dims.select(
            (F.col("filiere") if "filiere" in dims.columns else F.lit(None).cast("string")).alias("filiere"),
            P.to_payload(dims).alias("payload_json"), F.lit(batch_id).alias("batch_id"), stamp.alias("created_at"),
        ),
    )
    if labels_complete(students):
        gold = R.kept(gold_with_ids(students, dims))
        split = S.assign_split(gold, K.TARGET_CLF, "student_id", seed, allow_fallback=True)
        store.append("gold_training_feature", gold_rows(split, batch_id).withColumn("created_at", stamp))

    def rows_in(*tables: str) -> int:
        return sum(store.read(t).where(F.col("batch_id") == batch_id).count() for t in tables)

    counts = {
        "bronze": rows_in("bronze_student_raw", "bronze_catalogue_raw"),
        "silver": rows_in("silver_student", "silver_catalogue"),
        "gold": rows_in("gold_training_feature"),
    }
    store.write_manifest(
        batch_id, source_name, counts, source_uri, retention_days=retention_days,
        metadata={
            "layers": ["bronze", "silver", "gold"], "direct_identifiers": list(K.ID_COLS),
            "pseudonymization": "HMAC-SHA-256", "pseudonymized_from_layer": "silver",
        },
    )
    store.audit(
        "medallion_load", "ingestion_batch", "raw layer kept restricted, later layers pseudonymised",
        batch_id, actor, counts,
    )
    return LoadResult(batch_id, counts["bronze"], counts["silver"], counts["gold"])
