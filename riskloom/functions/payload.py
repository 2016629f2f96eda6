"""JSON payload columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions.numbers import nan_to_null
from riskloom.functions.text import _col, strip, title_key

TEXT_MAP = "map<string,string>"


def to_payload(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The row as one JSON object: NaN and NULL become ``null``, dates ISO text."""
    names = list(columns) if columns is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for name in names:
        value = F.col(f"`{name}`")
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            value = nan_to_null(value)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def read_object(x) -> Column:
    """A stored JSON object as a text map; empty when missing or broken."""
    return F.coalesce(F.from_json(_col(x), TEXT_MAP), F.create_map().cast(TEXT_MAP))


def visible_fields(
    fields: Column, allowed: Iterable[str], forbidden: Iterable[str]
) -> Column:
    """Entries of a map that are allowed and not forbidden."""
    keep, drop = list(allowed), list(forbidden)
    return F.map_filter(fields, lambda k, v: k.isin(*keep) & ~k.isin(*drop))


def overlay(base: Column, event: Column) -> Column:
    """Base map with the event's entries on top."""
    return F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(event, k)), event)


def read_scope(x) -> Column:
    """Allowed groups: NULL means all, an empty array (also for unreadable text) none."""
    blank = F.coalesce(strip(x), F.lit("")) == ""
    listed = F.filter(
        F.transform(F.from_json(_col(x), "array<string>"), strip),
        lambda v: F.coalesce(v, F.lit("")) != "",
    )
    return F.when(~blank, F.coalesce(listed, F.array().cast("array<string>")))


def write_scope(groups) -> Column:
    """Sorted distinct title-cased groups as a JSON array; NULL when there is none."""
    named = F.filter(F.transform(_col(groups), title_key), lambda v: F.coalesce(v, F.lit("")) != "")
    ordered = F.array_sort(F.array_distinct(named))
    return F.when(F.size(ordered) > 0, F.to_json(ordered))
