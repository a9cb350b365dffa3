"""Reading a table in ranges of its key, each by a connection of its own."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_points(rows: DataFrame, keys: Sequence[str], parts: int) -> list[tuple]:
    """At most ``parts - 1`` keys that cut ``rows`` into ranges of about equal counts; keys of several columns too.

    Only the key columns are read, and Spark's own sampling of them finds the ranges, so a value of the first
    column that very many rows share is cut further by the next columns. Rows without a full key are left out.
    """
    keyed = rows.select(*keys).dropna()
    dealt = keyed.repartitionByRange(parts, *keys).groupBy(F.spark_partition_id().alias("part"))
    firsts = dealt.agg(F.min(F.struct(*keys)).alias("first")).orderBy("part").collect()  # one row per range
    return sorted({tuple(r["first"]) for r in firsts})[1:]


def _literal(value) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value:%Y-%m-%d}'"
    return "'" + str(value).replace("'", "''") + "'"


def _beyond(keys: Sequence[str], point: tuple, sign: str, last: str) -> str:
    """SQL of a comparison of whole keys, column by column."""
    cases = []
    for i, value in enumerate(point):
        equal = [f"{k} = {_literal(v)}" for k, v in zip(keys[:i], point)]
        cases.append(" AND ".join([*equal, f"{keys[i]} {last if i + 1 == len(point) else sign} {_literal(value)}"]))
    return "(" + " OR ".join(f"({c})" for c in cases) + ")"


def range_conditions(keys: Sequence[str], points: Sequence[tuple]) -> list[str]:
    """SQL conditions, of which every row meets exactly one; rows without a full key meet the first."""
    full = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    if not points:
        return ["1 = 1"]
    conditions = []
    for low, high in zip([None, *points], [*points, None]):
        inside = [full]
        if low is not None:
            inside.append(_beyond(keys, low, ">", ">="))
        if high is not None:
            inside.append(_beyond(keys, high, "<", "<"))
        conditions.append(" AND ".join(inside))
    conditions[0] = f"({conditions[0]}) OR {missing}"
    return conditions


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, keys: Sequence[str], parts: int = 16, **options: str) -> DataFrame:
    """A database table as a DataFrame with a task and a connection for each range of its key.

    Planning reads the key columns once, through one connection. Later conditions on the DataFrame are still
    pushed into every range.
    """
    names = spark.read.jdbc(url, f"(SELECT {', '.join(keys)} FROM {table}) k", properties=options)
    return spark.read.jdbc(url, table, predicates=range_conditions(keys, split_points(names, keys, parts)), properties=options)
