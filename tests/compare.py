"""Run a registered query on Spark and its SQL on DuckDB and compare rows.

``python -m tests.compare [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "hugeint": "int", "integer": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "boolean": "flag",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, sf_dir: str, run, sql: str, con) -> str | None:
    """None when columns, kinds and rows agree, else what differs."""
    got = run(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    expected_kinds = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1])) for d in result.description}
    kinds = {n: KINDS.get(t, t) for n, t in got.dtypes}
    if kinds != expected_kinds:
        return f"types {kinds} != {expected_kinds}"
    expected = _rows(names, result.fetchall())
    actual = _rows(got.columns, got.collect())
    if actual == expected:
        return None if actual else "no rows on either side"
    missing, extra = expected - actual, actual - expected
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())}; "
        f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
    )


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def main(sf: str = "0.01", *only: str) -> int:
    import __spark_entry__ as entry

    spark, sf_dir = session(), f"/root/testdata/sf{sf}"
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(spark, sf_dir, run, sql[name], con) if name in sql else f"no SQL, {run(spark, sf_dir).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:3000]}"
        failed += problem is not None and (name in sql or not problem.startswith("no SQL"))
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
