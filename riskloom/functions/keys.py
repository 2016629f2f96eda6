"""Keyed pseudonyms (HMAC-SHA-256) from built-in functions."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom import constants as K
from riskloom.functions.text import _col

SECRET_ENV = "RISKLOOM_PSEUDONYM_SECRET"
_BLOCK = 64


def resolve_secret(secret: str | None = None) -> str:
    found = secret or os.environ.get(SECRET_ENV)
    if not found:
        raise ValueError(f"{SECRET_ENV} is required before identifiers are stored")
    return found


def _pads(spark: SparkSession, secret: str) -> tuple[Column, Column]:
    """Inner and outer pads as scalar subqueries, so no plan text shows them."""
    key = secret.encode("utf-8")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    rows = [(bytearray(b ^ 0x36 for b in key), bytearray(b ^ 0x5C for b in key))]
    pads = spark.createDataFrame(rows, "inner_pad binary, outer_pad binary")
    return pads.select("inner_pad").scalar(), pads.select("outer_pad").scalar()


def _keyed_hash(value: Column, inner: Column, outer: Column) -> Column:
    message = F.encode(value.cast("string"), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def pseudonym(spark: SparkSession, x, secret: str | None = None) -> Column:
    """64 hex digits for a value, NULL for NULL."""
    inner, outer = _pads(spark, resolve_secret(secret))
    return _keyed_hash(_col(x), inner, outer)


def pseudonymize(
    df: DataFrame, columns: Iterable[str] = tuple(K.ID_COLS), secret: str | None = None
) -> DataFrame:
    """Replace the identifier columns that are present by their pseudonyms."""
    inner, outer = _pads(df.sparkSession, resolve_secret(secret))
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: _keyed_hash(F.col(c), inner, outer) for c in present})
