"""Every registered query with SQL equals its twin on the smallest tables."""

from __future__ import annotations

import pytest

from riskloom.queries import REGISTRY
from tests import oracle

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n, q in REGISTRY.items() if q.sql]


@pytest.fixture(scope="module")
def con():
    return oracle.connection(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    q = REGISTRY[name]
    assert oracle.differences(oracle.spark_rows(q(spark, FOLDER)), oracle.duck_rows(con, q.sql)) is None


def test_inventory_is_covered():
    """Each inventory row is named by at least one query."""
    import re

    families = {"S": 17, "P": 36, "C": 11, "F": 10, "J": 10, "A": 33, "W": 8, "O": 5, "U": 4, "M": 14, "D": 13, "T": 9}
    named = {token for q in REGISTRY.values() for token in re.findall(r"[A-Z]\d+", q.covers)}
    missing = [f"{f}{i}" for f, n in families.items() for i in range(1, n + 1) if f"{f}{i}" not in named]
    assert missing == []
