"""Which columns may become features, and the guard that enforces it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom import constants as K
from riskloom.operators.lineage import sources

EXCLUDED = {
    *K.ID_COLS, *K.CONSTANT_COLS, *K.DECOY_COLS, *K.TARGET_LEAK_COLS, *K.TIME_LEAK_COLS,
    *K.RAW_DATE_COLS, K.TARGET_CLF, K.TARGET_REG, K.TEXT_COL,
}
FORBIDDEN = {*K.ID_COLS, *K.TARGET_LEAK_COLS, *K.TIME_LEAK_COLS, K.TARGET_CLF, K.TARGET_REG}
HIDDEN_FROM_READERS = {
    *K.TARGET_LEAK_COLS, *K.TIME_LEAK_COLS, *K.ID_COLS, *K.DECOY_COLS,
    K.TARGET_CLF, K.TARGET_REG, K.TEXT_COL,
}


class LeakageError(ValueError):
    """A forbidden column is among the features."""


def feature_columns(df: DataFrame, excluded: set[str] | None = None) -> list[str]:
    drop = EXCLUDED if excluded is None else excluded
    return [c for c in df.columns if c not in drop]


def assert_no_leakage(columns: Sequence[str], forbidden: set[str] | None = None) -> None:
    found = sorted(set(columns) & (FORBIDDEN if forbidden is None else forbidden))
    if found:
        raise LeakageError(f"forbidden columns among the features: {found}")


def mark_forbidden(df: DataFrame, forbidden: set[str] | None = None) -> DataFrame:
    """Tag forbidden columns in the schema; Spark carries the tag through renames."""
    blocked = FORBIDDEN if forbidden is None else forbidden
    return df.select(
        *[F.col(c).alias(c, metadata={"forbidden": c}) if c in blocked else F.col(c) for c in df.columns]
    )


def assert_no_marked(features: DataFrame) -> None:
    """Refuse features that are renamed forbidden columns (see ``mark_forbidden``)."""
    hidden = {f.name: f.metadata["forbidden"] for f in features.schema if "forbidden" in f.metadata}
    if hidden:
        raise LeakageError(f"features that rename forbidden columns: {hidden}")


def derived_from(df: DataFrame, columns: Sequence[str], forbidden: set[str] | None = None) -> dict[str, list[str]]:
    """Columns computed from forbidden ones, with those they come from."""
    blocked, known = FORBIDDEN if forbidden is None else forbidden, sources(df)
    hidden = {c: sorted(known[c] & blocked) for c in columns if c in known}
    return {c: found for c, found in hidden.items() if found}


def assert_not_derived(df: DataFrame, columns: Sequence[str], forbidden: set[str] | None = None) -> None:
    """Refuse features that carry a forbidden column in any guise: renamed, computed, nested, joined back."""
    assert_no_leakage(columns, forbidden)
    hidden = derived_from(df, columns, forbidden)
    if hidden:
        raise LeakageError(f"features computed from forbidden columns: {hidden}")


def gold(df: DataFrame, include_labels: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Features, then the labels that exist, then carried columns such as ids."""
    features = feature_columns(df)
    assert_not_derived(df, features)
    labels = [c for c in (K.TARGET_CLF, K.TARGET_REG) if include_labels and c in df.columns]
    return df.select(*features, *labels, *[c for c in keep if c in df.columns])


def reindex(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the contract's columns in its order; absent ones as NULL."""
    return df.select(
        *keep,
        *[F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in columns],
    )


def split_by_type(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric or boolean, other) among the given columns, in order."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")
    kinds = dict(df.dtypes)
    is_number = {c: kinds[c] in numeric or kinds[c].startswith("decimal") for c in columns}
    return [c for c in columns if is_number[c]], [c for c in columns if not is_number[c]]


def exclusions(spark: SparkSession) -> DataFrame:
    """One row per excluded column with its group and reason."""
    rows = [(title, c, reason) for title, cols, reason in K.EXCLUSION_REASONS for c in cols]
    return spark.createDataFrame(rows, "title string, column string, reason string")


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]
