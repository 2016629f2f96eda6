"""Arriving records: ingestion to Bronze and scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.plans import medallion as ME, training as T
from riskloom.sources import files as FS
from riskloom.sources.tables import TableStore


def record_stream(spark: SparkSession, folder: str, columns: Sequence[str], files_per_batch: int = 100) -> DataFrame:
    """JSON record files as they arrive, unreadable lines in ``_corrupt``."""
    return (
        spark.readStream.schema(FS.record_schema(columns)).option("columnNameOfCorruptRecord", "_corrupt")
        .option("maxFilesPerTrigger", files_per_batch).json(folder)
    )


def drain(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Handle everything that has arrived, batch by batch, then stop."""
    query = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The stream's identity, which lives as long as its checkpoint."""
    text = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()
    return text[0]


def score_stream(records: DataFrame, bundle: T.ModelBundle, out: str, checkpoint: str, keep: Sequence[str] = ()) -> StreamingQuery:
    """Answer every arriving record: a score by the batch code path, or a reject with its reason.

    Both sinks are written per run and micro-batch, and a commit row follows when both are there;
    ``answers`` shows committed rows only. A repeated micro-batch overwrites its own folders. A
    stream that has lost its checkpoint is a new run, which replaces the older ones for readers.
    """
    spark, body = records.sparkSession, [c for c in records.columns if c != "_corrupt"]

    def handle(batch: DataFrame, number: int) -> None:
        run = _run_of(spark, checkpoint)
        good, place = F.col("_corrupt").isNull(), f"run={run}/stream_batch={number}"
        T.score(batch.where(good).drop("_corrupt"), bundle, keep).write.mode("overwrite").parquet(f"{out}/scores/{place}")
        record = F.coalesce("_corrupt", F.to_json(F.struct(*body))).alias("record")
        rejects = batch.where(~good).select(record, F.lit("unreadable record").alias("reason"))
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/{place}")
        scored, rejected = (spark.read.parquet(f"{out}/{kind}/{place}").count() for kind in ("scores", "rejects"))
        row = spark.createDataFrame([(scored, rejected)], "scored long, rejected long").withColumn("committed_at", F.current_timestamp())
        row.write.mode("overwrite").parquet(f"{out}/commits/{place}")

    return drain(records, handle, checkpoint)


def commits(spark: SparkSession, out: str) -> DataFrame:
    """Commit rows of the newest run of a scoring stream: ``run, stream_batch, scored, rejected, committed_at``."""
    rows = spark.read.parquet(f"{out}/commits")
    # One row per micro-batch.
    newest = rows.groupBy("run").agg(F.min("committed_at").alias("began")).orderBy(F.desc("began"), "run").limit(1)
    return rows.join(F.broadcast(newest.select("run")), "run")


def answers(spark: SparkSession, out: str, kind: str = "scores") -> DataFrame:
    """Committed ``scores`` or ``rejects`` of the newest run, once each."""
    done = commits(spark, out).select("run", "stream_batch")
    return spark.read.parquet(f"{out}/{kind}").join(done, ["run", "stream_batch"], "left_semi").drop("run", "stream_batch")


def ingest_stream(records: DataFrame, store: TableStore, source: str, checkpoint: str) -> StreamingQuery:
    """Append arriving records to Bronze, one batch id per micro-batch.

    The id is derived from the micro-batch number and the batch partition is replaced, so
    a repeated micro-batch leaves one copy. Unreadable lines are kept and marked.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch_id = f"{source}-{number:010d}"
        rows = ME.numbered(batch)
        good = F.col("_corrupt").isNull()
        body = [c for c in batch.columns if c != "_corrupt"]
        payload = rows.select(
            F.col("row_number"),
            F.when(good, F.to_json(F.struct(*body), {"ignoreNullFields": "false"}))
            .otherwise(F.col("_corrupt")).alias("payload_json"),
            good.alias("parse_ok"),
            F.when(~good, "unreadable record").alias("rejected_reason"),
            F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("created_at"),
        )
        store.append("bronze_student_raw", payload)
        n = store.read("bronze_student_raw").where(F.col("batch_id") == batch_id).count()
        if not store.batch_exists(batch_id):
            store.write_manifest(batch_id, source, {"bronze": n}, status="streamed")

    return drain(records, handle, checkpoint)


def distinct_records(records: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats that arrive within the watermark; the state of older keys expires."""
    stamped = records.withColumn(ts, F.col(ts).cast("timestamp"))
    if not records.isStreaming:
        return stamped.dropDuplicates(list(keys))
    return stamped.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
