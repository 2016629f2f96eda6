"""Compare registered queries with their SQL twins: ``python -m tests.oracle [names]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.01")


def connection(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None if value is None else "nan"
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if hasattr(value, "as_tuple"):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return normal(columns, cursor.fetchall())


def differences(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows vs {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} vs {b}"
    return None


def main(names: list[str]) -> int:
    from riskloom.queries import REGISTRY
    from riskloom.session import get_session

    spark = get_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connection(), 0
    for name, q in REGISTRY.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            got = spark_rows(q(spark, DATA))
            took = time.time() - start
            problem = differences(got, duck_rows(con, q.sql)) if q.sql else None
            note = problem or f"ok {len(got[1])} rows" + ("" if q.sql else " (no SQL)")
        except Exception as error:  # noqa: BLE001
            took, problem = time.time() - start, str(error)
            note = "ERROR " + problem[:600]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {name:24s} {took:6.2f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
