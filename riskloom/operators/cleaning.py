"""Cleaning, enrichment and derived features of cohort records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom import constants as K
from riskloom.functions import numbers as N, text as X


def parse_numbers(df: DataFrame, columns: Sequence[str] = tuple(K.TEXT_NUMERIC_COLS)) -> DataFrame:
    return df.withColumns({c: X.parse_number(c) for c in columns if c in df.columns})


def parse_dates(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Add parsed days; by default ``date_inscription`` -> ``date_inscription_parsed``."""
    columns = columns or {"date_inscription": "date_inscription_parsed"}
    return df.withColumns({new: X.parse_date(old) for old, new in columns.items() if old in df.columns})


CATEGORY_RULES: dict[str, object] = {
    "filiere": X.title_key,
    "sexe": K.SEX_CODES,
    "bac_type": K.SCHOOL_TYPE_CODES,
    "mention_bac": K.HONOURS_CODES,
    "boursier": K.GRANT_CODES,
    "etablissement_origine": X.lower_key,
}


def normalize_categories(df: DataFrame, rules: Mapping[str, object] | None = None) -> DataFrame:
    """Apply a code map or a text function to each category column that is present."""

    def rewritten(column: str, rule: object) -> Column:
        return X.map_codes(column, rule) if isinstance(rule, Mapping) else rule(column)

    rules = CATEGORY_RULES if rules is None else rules
    return df.withColumns({c: rewritten(c, r) for c, r in rules.items() if c in df.columns})


def clean(
    df: DataFrame,
    drop_duplicates: bool = True,
    number_columns: Sequence[str] = tuple(K.TEXT_NUMERIC_COLS),
) -> DataFrame:
    """Whole deterministic cleaning: exact duplicates, numbers, dates, categories."""
    rows = df.dropDuplicates() if drop_duplicates else df
    return (
        rows.transform(parse_numbers, number_columns)
        .transform(parse_dates)
        .transform(normalize_categories)
    )


def enrich(
    df: DataFrame, dimension: DataFrame, key: str = "filiere", require_unique: bool = False
) -> DataFrame:
    """Left join to a dimension on a title-cased key.

    No broadcast hint: the optimizer broadcasts the dimension when its size allows it,
    and adaptive execution splits skewed keys when it does not.
    """
    rows = df.withColumn(key, X.title_key(key))
    dim = dimension.withColumn(key, X.title_key(key))
    if require_unique:
        twice = dim.groupBy(key).count().where("count > 1").limit(5).collect()
        if twice:
            raise ValueError(f"repeated dimension keys: {sorted(str(r[0]) for r in twice)}")
    return rows.join(dim, key, "left").select(
        *rows.columns, *[c for c in dim.columns if c != key and c not in rows.columns]
    )


def join_coverage(enriched: DataFrame, added: Sequence[str]) -> DataFrame:
    """Share of rows with at least one non-NULL column from the dimension."""
    hit = F.coalesce(*[F.col(c).cast("string") for c in added]).isNotNull()
    return enriched.agg(F.avg(hit.cast("int")).alias("coverage"))


def first_day(df: DataFrame, column: str = "date_inscription_parsed"):
    """Earliest day of a batch; stored with the model and reused when scoring."""
    return df.agg(F.min(column)).first()[0]


def add_features(df: DataFrame, since=None) -> DataFrame:
    """Derived mid-term features.

    ``since`` is the training minimum for scoring; without it the batch's own minimum
    is read through a scalar subquery.
    """
    new = {
        "taux_rendu_devoirs": N.share(
            F.col("nb_devoirs_rendus").cast("double"), F.col("nb_devoirs_total").cast("double")
        ),
        "heures_lms_par_connexion": N.ratio_or_zero(
            F.col("heures_lms_total").cast("double"), F.col("connexions_lms_30j").cast("double")
        ),
        "ressources_par_connexion": N.ratio_or_zero(
            F.col("ressources_consultees").cast("double"), F.col("connexions_lms_30j").cast("double")
        ),
    }
    if K.TEXT_COL in df.columns:
        new["commentaire_present"] = text_present(K.TEXT_COL)
    if "date_inscription_parsed" in df.columns:
        new["jours_inscription"] = days_since_first(df, "date_inscription_parsed", since)
    return df.withColumns(new)


def text_present(x) -> Column:
    return (F.coalesce(X.strip(x), F.lit("")) != "").cast("int")


def days_since_first(df: DataFrame, column: str, since=None) -> Column:
    start = F.lit(since) if since is not None else df.select(F.min(column)).scalar()
    return F.datediff(F.col(column), start)


def null_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, as a source step."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: N.nan_to_null(c) for c in floats})
