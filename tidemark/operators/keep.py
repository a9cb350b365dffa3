"""Keep rows by a condition over costly columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """The rows ``filter(condition)`` keeps, without moving the condition.

    Spark moves a filter below the projections it depends on, by repeating their expressions in it.
    Over a chain of JSON reads that runs the reads twice and makes the plan huge. Rows generated
    from a literal of one or no element stay where they are.
    """
    once = F.when(condition, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(once).alias("_kept")).drop("_kept")
