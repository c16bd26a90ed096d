"""Run queries on Spark and their SQL on DuckDB, and report rows or columns that differ.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if hasattr(value, "is_finite"):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in row))


def differences(spark, con, name: str, function, sql: str, sf_dir: str) -> str | None:
    """None if both sides give the same columns and rows, else what differs first."""
    df = function(spark, sf_dir)
    columns = sorted(df.columns)
    ours = _sorted([tuple(_plain(row[c]) for c in columns) for row in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} but SQL has {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = _sorted([tuple(_plain(row[i]) for i in order) for row in result.fetchall()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows but SQL has {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            off = [c for c, x, y in zip(columns, a, b) if x != y]
            return f"first difference in {off}: {str(a)[:400]} but SQL has {str(b)[:400]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from gridclear.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = connect(sf), oracle_sql(), 0
    for name, function in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = differences(spark, con, name, function, sqls[name], sf)
            else:
                problem = None if function(spark, sf).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s {'ok' if problem is None else 'DIFFERS ' + problem}", flush=True)
    print("differing:", bad)
