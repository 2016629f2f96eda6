"""Parquet table store: one folder per table, partitioned by batch."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from itertools import islice
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom import constants as K
from riskloom.operators import cohort as C, ordered as R
from riskloom.schemas import LAYER_TABLES, RUN_TABLES, TABLES, partitions

#: Prediction ids: seconds since 2020 above, the row's position in its run below.
EPOCH, POSITION_BITS = 1_577_836_800, 33


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class TableStore:
    """Reads and writes the stored tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self, database: str | None = None) -> list[str]:
        """Create missing tables; with a database name also register them for SQL."""
        for table, ddl in TABLES.items():
            writer = self.spark.createDataFrame([], ddl).write.mode("ignore")
            by = partitions(table)
            (writer.partitionBy(*by) if by else writer).parquet(self.path(table))
            if database:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
                parted = f" PARTITIONED BY ({', '.join(by)})" if by else ""
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl}) USING parquet{parted} "
                    f"LOCATION '{self.path(table)}'"
                )
        return list(TABLES)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(self.path(table))

    def committed(self, table: str) -> DataFrame:
        """Rows of batches that have a manifest row, so half-written batches stay unseen."""
        return self.read(table).join(self.read("ingestion_batch").select("batch_id"), "batch_id", "left_semi")

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows; layer tables replace their own batch, tables of runs their own run of a
        batch, so a retry leaves one copy. Rows without a run are a run of their own."""
        if table in RUN_TABLES and "run_id" not in rows.columns:
            rows = rows.withColumn("run_id", F.lit(uuid4().hex))
        writer, by = shape(rows, table).write, partitions(table)
        if table in LAYER_TABLES:
            writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.mode("append")
        (writer.partitionBy(*by) if by else writer).parquet(self.path(table))

    def append_row(self, table: str, **values) -> None:
        self.append(table, self.spark.createDataFrame([values], _row_schema(table, values)))

    def require_batch(self, batch_id: str) -> None:
        if self.read("ingestion_batch").where(F.col("batch_id") == batch_id).isEmpty():
            raise ValueError(f"unknown batch: {batch_id}")

    def batch_exists(self, batch_id: str) -> bool:
        return not self.read("ingestion_batch").where(F.col("batch_id") == batch_id).isEmpty()

    def write_manifest(
        self, batch_id: str, source_name: str, counts: dict[str, int], source_uri: str | None = None,
        metadata: dict | None = None, retention_days: int = K.RETENTION_DAYS,
        created_at: datetime | None = None, status: str = "loaded",
    ) -> None:
        """The batch row, written after the layers as the commit marker."""
        created = created_at or utc_now()
        self.append_row(
            "ingestion_batch", id=batch_id, batch_id=batch_id, source_name=source_name,
            source_uri=source_uri, status=status, metadata_json=json.dumps(metadata or {}),
            expires_at=created + timedelta(days=retention_days), created_at=created,
            rows_bronze=counts.get("bronze", 0), rows_silver=counts.get("silver", 0),
            rows_gold=counts.get("gold", 0),
        )

    def audit(
        self, action: str, target_type: str, reason: str, target_id: str | None = None,
        actor: str = "system", metadata: dict | None = None, event: str | None = None,
    ) -> str:
        """One audit row; an ``event`` that is there already is not written again."""
        if event and not self.read("privacy_audit_log").where(F.col("id") == event).isEmpty():
            return event
        event = event or uuid4().hex
        self.append_row(
            "privacy_audit_log", id=event, action=action, actor=actor, target_type=target_type,
            target_id=target_id, reason=reason, metadata_json=json.dumps(metadata or {}, default=str),
            created_at=utc_now(),
        )
        return event

    def save_predictions(
        self, batch_id: str, scored: DataFrame, model_version: str | None, threshold: float, run_id: str | None = None,
    ) -> int:
        """Store the scores of one run (with ``student_id`` pseudonyms and payload) and an audit row.

        Scores were computed on the rows themselves, so no positional join is needed. A run that is
        repeated under its ``run_id`` replaces its own rows and no others. Ids are made of the run's
        second and the row's position: they grow from run to run without a look at what is stored,
        so concurrent writers don't race for them.
        """
        self.require_batch(batch_id)
        run_id, stamp = run_id or uuid4().hex, utc_now()
        begin = int(stamp.timestamp()) - EPOCH << POSITION_BITS
        rows = R.numbered(R.kept(scored), "_position").withColumns(
            {
                "id": F.lit(begin) + F.col("_position"),
                "batch_id": F.lit(batch_id), "run_id": F.lit(run_id),
                "model_version": F.lit(model_version or None).cast("string"),
                "threshold": F.lit(float(threshold)),
                "created_at": F.lit(stamp),
            }
        )
        self.append("gold_prediction", rows)
        n = self.read("gold_prediction").where((F.col("batch_id") == batch_id) & (F.col("run_id") == run_id)).count()
        self.audit(
            "prediction_persist", "ingestion_batch", "pseudonymised risk scores stored for human support",
            batch_id, metadata={"rows": n, "run": run_id}, event=f"prediction_persist-{batch_id}-{run_id}",
        )
        return n

    def save_drift_report(self, batch_id: str, document: DataFrame, run_id: str | None = None) -> None:
        """Store one run's drift report; a repeated run replaces its own."""
        self.require_batch(batch_id)
        run_id = run_id or uuid4().hex
        rows = document.select(
            F.lit(run_id).alias("id"), F.col("summary.status").alias("status"),
            F.col("summary.watch_count").alias("watch_count"), F.col("summary.alert_count").alias("alert_count"),
            F.to_json(F.struct("summary", "features"), {"ignoreNullFields": "false"}).alias("report_json"),
            F.lit(utc_now()).alias("created_at"), F.lit(run_id).alias("run_id"), F.lit(batch_id).alias("batch_id"),
        )
        self.append("gold_drift_report", rows)
        self.audit(
            "drift_report_persist", "ingestion_batch", "drift report tied to its batch", batch_id,
            metadata={"run": run_id}, event=f"drift_report_persist-{batch_id}-{run_id}",
        )

    def purge_expired(self, now: datetime | None = None, actor: str = "system") -> int:
        """Delete every batch past its deadline: its layers, then one audit row per batch, then its manifest row.

        Only the expired partitions' folders are removed, many at a time; other batches are not
        rewritten. A purge that is cut off is done again from the manifest rows that are left, and
        leaves one audit row per batch. The ids are stored first and never held as a list.
        """
        cutoff = now or utc_now()
        gone, _ = C.split_survivors(self.read("ingestion_batch"), F.lit(cutoff))
        gone = R.kept(gone.select("batch_id").distinct())
        purged = gone.count()
        if not purged:
            return 0
        self._drop_partitions(gone, LAYER_TABLES)
        note = F.to_json(F.struct(F.array("batch_id").alias("purged_batches"), F.lit(str(cutoff)).alias("cutoff")))
        events = gone.select(
            F.concat(F.lit("retention_purge-"), "batch_id").alias("id"), F.lit("retention_purge").alias("action"), F.lit(actor).alias("actor"),
            F.lit("ingestion_batch").alias("target_type"), F.col("batch_id").alias("target_id"),
            F.lit("expired batch deleted under the retention policy").alias("reason"), note.alias("metadata_json"), F.lit(utc_now()).alias("created_at"),
        )
        self.append("privacy_audit_log", R.kept(events.join(self.read("privacy_audit_log").select("id"), "id", "left_anti")))
        self._drop_partitions(gone, ["ingestion_batch"])
        return purged

    def _drop_partitions(self, batches: DataFrame, tables: Sequence[str], threads: int = 16) -> None:
        """Remove the folders of batches; a few hundred ids are in hand at a time."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()

        def drop(batch_id: str) -> None:
            for table in tables:
                folder = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/batch_id={batch_id}")
                folder.getFileSystem(conf).delete(folder, True)

        ids = (r[0] for r in batches.toLocalIterator())
        with ThreadPoolExecutor(threads) as pool:
            while some := list(islice(ids, 32 * threads)):
                list(pool.map(drop, some))


def _row_schema(table: str, values: dict) -> str:
    kinds = dict(part.strip().split(" ", 1) for part in _fields(TABLES[table]))
    return ", ".join(f"{k} {kinds[k]}" for k in values)


def _fields(ddl: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(ddl[start:i])
            start = i + 1
    return [*out, ddl[start:]]


def shape(rows: DataFrame, table: str) -> DataFrame:
    """Columns of a stored table in order and type; absent ones as NULL."""
    def field(name: str, kind: str) -> Column:
        return (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)

    return rows.select(*[field(*part.strip().split(" ", 1)) for part in _fields(TABLES[table])])
