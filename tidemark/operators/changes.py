"""Landed changes -> current state of a table, and profiles of a change set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.envelope import DELETE, INSERT, MARKER_COLUMN, UPDATE

ORDER = ("file_sequence", "row_index")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def last_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The last change of every key, deletes included.

    Spark keeps one row per key in each task before the shuffle, so a key with a third of all
    changes sends one row per task.
    """
    latest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = changes.filter(~_any_null(keys)).withColumn("_rank", F.row_number().over(latest_first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def apply_changes(
    changes: DataFrame,
    keys: Sequence[str],
    base: DataFrame | None = None,
    marker: str = MARKER_COLUMN,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Current rows after the changes: the last change of a key replaces its whole row or removes it.

    With ``base``, an earlier state without marker and order columns, only the changes since then are
    reduced; base rows of changed keys give way to them. Changes without a full key cannot be applied,
    see :func:`keyless_changes`.
    """
    return merge_changes(base, last_changes(changes, keys, order), keys, marker, order)


def merge_changes(
    base: DataFrame | None, last: DataFrame, keys: Sequence[str], marker: str = MARKER_COLUMN, order: Sequence[str] = ORDER
) -> DataFrame:
    """``base`` with the last change of each key on top of it, both read once.

    A base stored in buckets by ``keys`` is not shuffled. Columns that only one side has are NULL in rows of the other.
    """
    if base is None:
        return last.filter(F.col(marker) != DELETE).drop(marker, *order)
    values = [c for c in last.columns if c not in (marker, *order)]
    names = [*values, *(c for c in base.columns if c not in values)]
    old, new = base.alias("old"), last.alias("new")
    both = old.join(new, reduce(lambda a, b: a & b, (F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys)), "full_outer")
    changed = F.col(f"new.`{marker}`").isNotNull()

    def value(name: str) -> Column:
        new_one = F.col(f"new.`{name}`") if name in values else F.lit(None)
        old_one = F.col(f"old.`{name}`") if name in base.columns else F.lit(None)
        return F.when(changed, new_one).otherwise(old_one).alias(name)

    return both.filter(F.coalesce(F.col(f"new.`{marker}`") != DELETE, F.lit(True))).select(*map(value, names))


def keyless_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return changes.filter(_any_null(keys))


def dedupe_changes(changes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Drop exact replays: rows equal in key, position and every other column.

    Rows that share key and position but differ are different changes: offsets repeat across partitions,
    and rows without a key share a NULL one. All columns are grouping columns, so nothing is sorted.
    """
    return changes.dropDuplicates([*keys, *(c for c in changes.columns if c not in keys)])


def change_profile(changes: DataFrame, by: str = "folder", marker: str = "marker") -> DataFrame:
    """Inserts, updates and deletes per table."""
    kind = F.col(marker)
    return changes.groupBy(by).agg(
        F.count_if(kind == INSERT).alias("inserts"),
        F.count_if(kind == UPDATE).alias("updates"),
        F.count_if(kind == DELETE).alias("deletes"),
        F.count("*").alias("changes"),
    )
