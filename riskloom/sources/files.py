"""CSV, JSON and log sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskloom import constants as K
from riskloom.functions import display as D, payload as P, text as X
from riskloom.operators import ordered as R

# Texts a CSV reader treats as missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

REPORT = (
    "summary struct<reference_rows:bigint,current_rows:bigint,features_checked:int,"
    "watch_count:int,alert_count:int,status:string,watch_threshold:double,alert_threshold:double>,"
    "features array<struct<feature:string,psi:double,status:string>>"
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


#: Quotes inside a quoted text are doubled, as other CSV programs read and write them.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str], with_position: bool = False, multi_line: bool = False
) -> DataFrame:
    """Header CSV with all columns as text; missing-value spellings become NULL.

    Columns are found by the name in each file's own header, whatever their order; one that a
    file lacks is NULL there. ``multi_line`` allows line breaks inside quotes, and then a file is
    one block. Types are parsed afterwards from text: inference would read the same code column
    as a number in one file and as text in another.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):  # only headers are read here
        groups.setdefault(tuple(csv_columns(spark, file)), []).append(file)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    parts = []
    for header, files in groups.items():
        rows = spark.read.schema(text_schema(header)).options(header=True, multiLine=multi_line, **CSV_QUOTES).csv(files)
        known = [F.col(f"`{c}`") if c in header else F.lit(None).cast("string") for c in columns]
        cleaned = [F.when(~v.isin(*CSV_MISSING), v).alias(c) for c, v in zip(columns, known)]
        parts.append(rows.select(*cleaned, *(place if with_position else [])))
    if not parts:
        return spark.createDataFrame([], text_schema([*columns, *(["_file", "_block"] if with_position else [])]))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line, without the byte order mark."""
    return [c.lstrip("﻿") for c in spark.read.options(header=True, **CSV_QUOTES).csv(path).columns]


def number_rows(df: DataFrame, name: str = "row_number") -> DataFrame:
    """1-based numbers in file order for rows read with ``with_position``.

    Rows of a block keep their order inside a task, so a row's number is the count of
    all earlier blocks plus its place in its own block: no window over the table.
    """
    placed = df.withColumn("_id", F.monotonically_increasing_id())
    blocks = placed.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = R.sized(blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return R.join_on(placed, starts, ["_file", "_block"]).withColumn(
        name, F.col("_start") + F.col("_id") - F.col("_first") + 1
    ).drop("_file", "_block", "_id", "_first", "_start")


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, summary) of stored drift reports, one JSON document per file."""
    docs = spark.read.schema(REPORT).option("multiLine", True).json(path)
    return docs.selectExpr("inline(features)"), docs.select("summary.*")


def report_document(features: DataFrame, summary: DataFrame) -> DataFrame:
    """The report as one nested row; its size is bounded by the number of columns."""
    listed = features.agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "feature", "psi", "status"))),
            lambda s: F.struct(s["feature"].alias("feature"), s["psi"].alias("psi"), s["status"].alias("status")),
        ).alias("features")
    )
    return summary.select(F.struct(*summary.columns).alias("summary"), listed.scalar().alias("features"))


def write_report(features: DataFrame, summary: DataFrame, path: str) -> None:
    report_document(features, summary).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_scores(scored: DataFrame, path: str) -> None:
    scored.write.mode("overwrite").options(header=True, **CSV_QUOTES).csv(path)


def read_records(spark: SparkSession, path: str, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Records to score from JSON lines; unreadable lines are kept in ``_corrupt``."""
    return spark.read.schema(record_schema(columns)).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def record_schema(columns: Mapping[str, str] | Sequence[str]) -> str:
    kinds = columns if isinstance(columns, Mapping) else {c: "string" for c in columns}
    return ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", _corrupt string"


def log_lines(df: DataFrame, line: str, base: Mapping[str, Column]) -> DataFrame:
    """Log events merged over their base fields; plain text becomes ``message``."""
    fields = F.create_map(*[x for k, v in base.items() for x in (F.lit(k), v.cast("string"))])
    event = F.from_json(F.col(line), P.TEXT_MAP)
    # A JSON list or number parses to NULL or to an empty map; only objects count.
    is_object = F.coalesce(X.strip(line).startswith("{"), F.lit(False)) & event.isNotNull()
    merged = F.when(is_object, P.overlay(fields, event)).otherwise(
        F.map_concat(fields, F.create_map(F.lit("message"), F.col(line)))
    )
    return df.withColumn("fields", merged)


class ExportTooLarge(ValueError):
    """More rows than the export's ceiling."""


def export_rows(ranked: DataFrame, generated_at: str) -> DataFrame:
    """The closed export columns as formula-safe text."""
    return ranked.select(
        X.csv_safe("pseudo_id").alias("pseudo_id"),
        F.col("rang").cast("long").alias("rang"),
        D.formatted("%.6f", F.col("proba_abandon")).alias("proba_abandon"),
        "alerte",
        X.csv_safe("filiere").alias("filiere"),
        X.csv_safe("batch_id").alias("batch_id"),
        X.csv_safe("model_version").alias("model_version"),
        F.coalesce(D.formatted("%.4f", F.col("threshold")), F.lit("")).alias("threshold"),
        F.lit(generated_at).alias("generated_at"),
    ).select(*K.EXPORT_COLUMNS)


def export_csv(rows: DataFrame, path: str, ceiling: int, purpose: str, score: str = "proba_abandon", id_col: str = "id", generated_at: str = "") -> int:
    """Write a capped export with its purpose in a sidecar; refuse above the ceiling.

    The single output file is bounded by the ceiling.
    """
    from riskloom.operators import cohort as C

    n = rows.limit(ceiling + 1).count()
    if n > ceiling:
        raise ExportTooLarge(f"more than {ceiling} rows match; narrow the filters")
    # At most ``ceiling`` rows from here on.
    place = F.row_number().over(Window.orderBy(*C.risk_order(score, id_col)))
    out = export_rows(rows.withColumn("rang", place), generated_at)
    out.coalesce(1).sortWithinPartitions("rang").write.mode("overwrite").options(header=True, **CSV_QUOTES).csv(path)
    note = rows.sparkSession.createDataFrame([(purpose,)], "value string")
    note.coalesce(1).write.mode("overwrite").text(path.rstrip("/") + ".purpose")
    return n
