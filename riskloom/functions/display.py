"""Names and values as people read them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from riskloom import constants as K
from riskloom.functions.text import _col, strip


def formatted(pattern: str, x: Column) -> Column:
    """``format_string`` that keeps NULL instead of printing it as text."""
    return F.when(x.isNotNull(), F.format_string(pattern, x))


def short_key(x, length: int = K.PSEUDO_DISPLAY_LENGTH) -> Column:
    return F.substring(_col(x), 1, length)


def short_target(x) -> Column:
    shown = F.coalesce(_col(x), F.lit(""))
    return F.when(shown == "", "—").otherwise(short_key(shown))


def percent_text(x, digits: int = 1) -> Column:
    return formatted(f"%.{digits}f %%", _col(x) * 100.0)


def threshold_text(x) -> Column:
    return F.coalesce(formatted("%.2f", _col(x)), F.lit(K.NOT_PROVIDED))


def bare_name(name) -> Column:
    """Feature name without the prefix a transformer put before it."""
    return F.regexp_replace(_col(name), "^(" + "|".join(K.TRANSFORM_PREFIXES) + ")", "")


def _longest_first(columns: Iterable[str]) -> list[str]:
    return sorted(columns, key=len, reverse=True)


def source_column(name, columns: Iterable[str]) -> Column:
    """Column a transformed feature came from; the longest matching name wins.

    The candidates are a schema's columns, so the choice is one CASE expression and
    no prefix join is needed.
    """
    base = bare_name(name)
    names = _longest_first(columns)
    out = F.when(base.isin(*names), base)
    for column in names:
        out = out.when(base.startswith(f"{column}_"), F.lit(column))
    return out


def feature_label(name, labels: Mapping[str, str] = K.FEATURE_LABELS) -> Column:
    """Readable label; one-hot features keep their modality after a colon."""
    base = bare_name(name)
    out = None
    for column in _longest_first(labels):
        hit = F.when if out is None else out.when
        out = hit(base == column, F.lit(labels[column]))
    for column in _longest_first(labels):
        rest = strip(F.replace(F.substr(base, F.lit(len(column) + 2)), F.lit("_"), F.lit(" ")))
        out = out.when(
            base.startswith(f"{column}_"), F.concat(F.lit(f"{labels[column]} : "), rest)
        )
    return out.otherwise(strip(F.replace(base, F.lit("_"), F.lit(" "))))


def displayable(source) -> Column:
    """False for protected attributes and features that depend on the whole batch."""
    return F.coalesce(
        ~_col(source).isin(*K.HIDDEN_FACTOR_COLS, *K.BATCH_RELATIVE_COLS), F.lit(True)
    )


def number_text(name, value) -> Column:
    """A raw numeric value, shown according to the kind of feature."""
    base, x = bare_name(name), _col(value).cast("double")
    return (
        F.when(x.isNull() | F.isnan(x), F.lit(K.NOT_PROVIDED))
        .when(base == "taux_rendu_devoirs", F.format_string("%.0f %%", F.rint(x * 100.0)))
        .when(base.endswith("_pct"), F.format_string("%.0f %%", F.rint(x)))
        .when(base == "boursier", F.when(x >= 0.5, "oui").otherwise("non"))
        .when(x == F.floor(x), F.format_string("%.0f", x))
        .otherwise(F.format_string("%.2f", x))
    )


def word_text(value) -> Column:
    """A raw text value, or the words for "not provided"."""
    text = F.coalesce(strip(value), F.lit(""))
    return F.when(F.lower(text).isin(*K.NUMBER_MISSING), K.NOT_PROVIDED).otherwise(text)


def flag_text(value) -> Column:
    return F.when(_col(value).isNull(), K.NOT_PROVIDED).when(_col(value), "oui").otherwise("non")
