"""Compare registered queries with their SQL: ``python tests/oracle_check.py DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r),
    )


def compare(spark_df, con, sql):
    """None if equal, else a description of the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(got) != len(expected):
        return f"rows: {len(got)} vs {len(expected)}"
    left, right = _sorted(spark_df.columns, got), _sorted(names, expected)
    bad = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    if bad:
        differs = [
            (name, x, y)
            for name, x, y in zip(sorted(names), *bad[0], strict=True)
            if x != y
        ]
        return f"{len(bad)} of {len(left)} rows differ, first: {differs}"
    types = [{type(v) for v in c if v is not None} for c in zip(*left, strict=True)]
    other = [{type(v) for v in c if v is not None} for c in zip(*right, strict=True)]
    if types != other:
        return f"types: {types} vs {other}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        df = query(spark, sf_dir)
        problem = compare(df, con, oracle[name]) if name in oracle else None
        rows = "no oracle" if name not in oracle else "ok"
        print(f"{name:28} {time.time() - started:6.2f}s  {problem or rows}", flush=True)
        failed += problem is not None
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
