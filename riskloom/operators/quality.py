"""Data-quality and exploration measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import constants as K
from riskloom.functions import text as X


def long_form(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), kind: str = "string",
    name: str = "column", value: str = "value",
) -> DataFrame:
    """One row per (row, column): a narrow unpivot, no shuffle."""
    cast = df.select(*keep, *[F.col(c).cast(kind).alias(c) for c in columns])
    return cast.unpivot([F.col(c) for c in keep], list(columns), name, value)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates"),
    )


def _wide_to_rows(df: DataFrame, columns: Sequence[str], value: str, name: str = "column") -> DataFrame:
    return df.unpivot([], list(columns), name, value)


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None, all_columns: bool = False) -> DataFrame:
    """Share of NULL (or NaN) values per column, from one aggregate over the table."""
    names = list(columns or df.columns)
    floats = {n for n, t in df.dtypes if t in ("double", "float")}

    def absent(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()

    wide = df.agg(*[F.avg(absent(c).cast("double")).alias(c) for c in names])
    rates = _wide_to_rows(wide, names, "missing_rate")
    return rates if all_columns else rates.where("missing_rate > 0")


def completeness_alerts(df: DataFrame, columns: Sequence[str] | None = None, limit: float = K.MAX_MISSING_RATE) -> DataFrame:
    return missing_rates(df, columns, all_columns=True).withColumn(
        "alert", F.col("missing_rate") > limit
    )


def group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean per group next to the overall mean."""
    overall = df.agg(F.avg(value)).scalar()
    return df.groupBy(group).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")).withColumn(
        "overall_mean", overall
    )


def decoy_spread(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """Sample standard deviation of the group means, per candidate decoy column."""
    rows = long_form(df, columns, keep=[value])
    means = rows.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.avg(value).alias("m"))
    return means.groupBy("column").agg(F.stddev_samp("m").alias("spread"), F.count("m").alias("groups"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, all pairs in one aggregate."""
    pairs = list(combinations(columns, 2))
    exprs = [
        F.when(F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()) > 1, F.corr(a, b)).alias(f"{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).agg(*exprs)
    rows = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"{i}").alias("corr"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )
    return rows


def value_counts(df: DataFrame, column: str, labels: Mapping | None = None) -> DataFrame:
    shown = F.col(column)
    if labels:
        shown = None
        for key, label in labels.items():
            hit = F.when if shown is None else shown.when
            shown = hit(F.col(column) == key, F.lit(label))
    return df.groupBy(shown.alias(column)).agg(F.count(F.lit(1)).alias("n"))


def sample_values(df: DataFrame, columns: Sequence[str], n: int = 6) -> DataFrame:
    """The n smallest distinct values of each column."""
    distinct = long_form(df, columns).where(F.col("value").isNotNull()).distinct()
    w = Window.partitionBy("column").orderBy("value")
    return distinct.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def inventory(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per source."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("source"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in sources.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def class_density(df: DataFrame, label: str, value: str, bins: int = 30) -> DataFrame:
    """Histogram of a value per class over the value's own range; last bin closed."""
    rows = df.select(F.col(label).alias("label"), F.col(value).cast("double").alias("v")).where(
        F.col("v").isNotNull()
    )
    low = rows.agg(F.min("v")).scalar()
    high = rows.agg(F.max("v")).scalar()
    place = F.floor((F.col("v") - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    binned = rows.withColumn("bin", F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int"))
    counted = binned.groupBy("label", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("label"))
    return counted.withColumn("share", F.col("n") / whole)


def quality_report(
    raw: DataFrame, prepared: DataFrame, added: Sequence[str], target: str, n_features: int
) -> DataFrame:
    """One row: raw rows, duplicates, cleaned rows, target rate, join coverage, features."""
    dup = duplicate_count(raw)
    hit = F.coalesce(*[F.col(c).cast("string") for c in added]).isNotNull()
    return prepared.agg(
        F.count(F.lit(1)).alias("rows_after_cleaning"),
        F.avg(target).alias("target_rate"),
        F.avg(hit.cast("int")).alias("join_coverage"),
    ).select(
        dup.select("n_rows").scalar().alias("rows_raw"),
        dup.select("duplicates").scalar().alias("duplicates_raw"),
        "rows_after_cleaning", "target_rate", "join_coverage",
        F.lit(n_features).alias("feature_count"),
    )


def named_text(x) -> Column:
    return X.clean_text(x)
