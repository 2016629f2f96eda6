"""Population stability over all numeric columns of two tables in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import numbers as N, text as X
from riskloom.operators import ordered as R
from riskloom.operators.perimeter import common_columns, split_by_type
from riskloom.operators.quality import long_form


def numeric_common(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns of both tables that are numeric in at least one."""
    shared = common_columns(reference, current)
    numeric = set(split_by_type(reference, shared)[0]) | set(split_by_type(current, shared)[0])
    return [c for c in shared if c in numeric]


def _as_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles; text that is no number and NaN become NULL."""
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        x = F.col(c)
        x = X.plain_number(x) if kinds[c] == "string" else x.cast("double")
        return F.when(~F.isnan(x), x).alias(c)

    return df.select(*[number(c) for c in columns])


def feature_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = long_form(_as_number(df, columns), columns, kind="double", name="feature")
    return rows.where(F.col("value").isNotNull())


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, _n, _min, _max) from one keyless aggregate over the wide table."""
    wide = _as_number(df, columns).agg(
        *[
            F.struct(F.count(c).alias("_n"), F.min(c).alias("_min"), F.max(c).alias("_max")).alias(c)
            for c in columns
        ]
    )
    listed = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("r")) for c in columns])
    return wide.select(F.inline(listed)).select("feature", "r.*")


def bin_edges(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Inner bin edges per feature.

    Exact linear quantiles of the reference, repeated edges dropped. With fewer than
    three distinct edges, equal widths over both sides; ``constant`` marks one value
    only. One row per feature.
    """
    probs = [i / bins for i in range(1, bins)]
    ref = R.order_statistics(
        feature_values(reference, columns), ["feature"], "value", R.linear_picks(probs),
        measures={"_min": F.min("value"), "_max": F.max("value")}, sizes=column_ranges(reference, columns),
    )
    cur = column_ranges(current, columns).select(
        "feature", F.col("_n").alias("current_n"), F.col("_min").alias("_cmin"), F.col("_max").alias("_cmax")
    )
    edges = F.array_sort(
        F.array_distinct(
            F.array("_min", *[R.linear_value(i, p) for i, p in enumerate(probs)], "_max")
        )
    )
    low, high = F.least("_min", "_cmin"), F.greatest("_max", "_cmax")
    step = (high - low) / bins
    equal = F.array(*[low + step * i for i in range(1, bins)])
    return (
        ref.join(cur, "feature")
        .withColumn("_edges", edges)
        .withColumn("constant", (F.size("_edges") < 3) & (low == high))
        .withColumn(
            "inner_edges",
            F.when(F.size("_edges") >= 3, F.slice("_edges", F.lit(2), F.size("_edges") - 2)).otherwise(equal),
        )
        .select("feature", F.col("n").alias("reference_n"), "current_n", "constant", "inner_edges")
    )


def binned(df: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Counts per (feature, bin): a CASE tree per column, then a narrow unpivot of bin numbers."""
    columns = list(edges)
    placed = _as_number(df, columns).select(*[(N.cut_index(c, edges[c]) + 1).alias(c) for c in columns])
    rows = placed.unpivot([], columns, "feature", "bin").where(F.col("bin").isNotNull())
    return rows.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per feature; NULL when a side has no values."""
    edges = R.kept(bin_edges(reference, current, columns, bins))
    # At most bins - 1 numbers per column: bounded by the schema's width.
    known = {r["feature"]: [e for e in r["inner_edges"] if e is not None] for r in edges.collect()}
    counted = (
        binned(reference, known).withColumn("side", F.lit("r"))
        .unionByName(binned(current, known).withColumn("side", F.lit("c")))
        .groupBy("feature", "bin")
        .agg(
            F.sum(F.when(F.col("side") == "r", F.col("n")).otherwise(0)).alias("r"),
            F.sum(F.when(F.col("side") == "c", F.col("n")).otherwise(0)).alias("c"),
        )
    )
    per_bin = edges.select(
        "feature", "reference_n", "current_n", "constant",
        F.explode(F.sequence(F.lit(1), F.size("inner_edges") + 1)).alias("bin"),
    ).join(counted, ["feature", "bin"], "left")
    floor = F.lit(K.PSI_EPSILON)
    r = F.greatest(floor, F.coalesce("r", F.lit(0)) / F.nullif(F.col("reference_n"), F.lit(0)))
    c = F.greatest(floor, F.coalesce("c", F.lit(0)) / F.nullif(F.col("current_n"), F.lit(0)))
    summed = per_bin.groupBy("feature", "reference_n", "current_n", "constant").agg(
        F.sum((c - r) * F.log(c / r)).alias("_psi")
    )
    empty = (F.col("reference_n") == 0) | (F.col("current_n") == 0)
    value = F.when(empty, F.lit(None)).when(F.col("constant"), F.lit(0.0)).otherwise(F.col("_psi"))
    return summed.select("feature", value.alias("psi"))


def classify_psi(x, watch: float = K.PSI_WATCH, alert: float = K.PSI_ALERT) -> Column:
    value = F.col(x) if isinstance(x, str) else x
    return (
        F.when(value.isNull() | F.isnan(value), "missing")
        .when(value >= alert, "alert")
        .when(value >= watch, "watch")
        .otherwise("ok")
    )


def drift_features(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    watch: float = K.PSI_WATCH,
    alert: float = K.PSI_ALERT,
) -> DataFrame:
    """(feature, psi, status) for every requested column, absent ones as ``missing``."""
    asked = list(columns) if columns is not None else numeric_common(reference, current)
    present = [c for c in asked if c in reference.columns and c in current.columns]
    names = reference.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(asked)], "position int, feature string"
    )
    if present:
        scored = names.join(psi(reference, current, present), "feature", "left")
    else:
        scored = names.withColumn("psi", F.lit(None).cast("double"))
    return scored.select(
        "position", "feature", F.round("psi", 6).alias("psi"),
        classify_psi("psi", watch, alert).alias("status"),
    )


def drift_summary(
    features: DataFrame,
    reference: DataFrame,
    current: DataFrame,
    watch: float = K.PSI_WATCH,
    alert: float = K.PSI_ALERT,
) -> DataFrame:
    rows_of = lambda df: df.agg(F.count(F.lit(1))).scalar()
    counted = features.agg(
        F.count(F.lit(1)).cast("int").alias("features_checked"),
        F.count_if(F.col("status") == "watch").cast("int").alias("watch_count"),
        F.count_if(F.col("status") == "alert").cast("int").alias("alert_count"),
    )
    status = (
        F.when(F.col("alert_count") > 0, "alert").when(F.col("watch_count") > 0, "watch").otherwise("ok")
    )
    return counted.select(
        rows_of(reference).alias("reference_rows"), rows_of(current).alias("current_rows"),
        "features_checked", "watch_count", "alert_count", status.alias("status"),
        F.lit(watch).alias("watch_threshold"), F.lit(alert).alias("alert_threshold"),
    )
