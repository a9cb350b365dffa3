"""Events against the catalog: which table an event belongs to, and which have none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.routing import catalog_name

UNKNOWN_TABLE = "unknown table"


def resolve_tables(folders: DataFrame, columns: DataFrame) -> DataFrame:
    """Each folder with its catalog table and column count, by upper-cased name.

    Folders are reduced to distinct ones with a row count before the join, so what is joined is
    one row per folder and not one per event.
    """
    tables = columns.groupBy("owner", "table_name").agg(F.count("*").alias("n_columns"))
    seen = folders.groupBy("folder").agg(F.count("*").alias("n_events"))
    return seen.withColumn("catalog_name", catalog_name(F.col("folder"))).join(
        tables.withColumn("catalog_name", F.concat_ws(".", "owner", "table_name")), "catalog_name", "left"
    )


MAX_LISTED_FOLDERS = 1_000


def unknown_tables(decoded: DataFrame, known: DataFrame) -> DataFrame:
    """Events whose table the catalog does not have; ``known`` holds one ``catalog_name`` per table.

    Only the distinct folders meet the catalog. The folders without a table are then a literal list, or a
    broadcast of their names if there are many, so the events themselves are not moved.
    """
    folders = decoded.select("folder").distinct().withColumn("catalog_name", catalog_name(F.col("folder")))
    homeless = folders.join(known.select("catalog_name").distinct(), "catalog_name", "left_anti").select("folder")
    return events_of(decoded, [r.folder for r in homeless.collect()])


def events_of(decoded: DataFrame, folders: list[str]) -> DataFrame:
    """Events of the given folders, marked as having no table; folders are names of tables, not of rows."""
    if len(folders) <= MAX_LISTED_FOLDERS:
        found = decoded.filter(F.col("folder").isin(folders))
    else:
        names = decoded.sparkSession.createDataFrame([(f,) for f in folders], "folder STRING")
        found = decoded.join(F.broadcast(names), "folder", "left_semi").select(*decoded.columns)
    return found.withColumn("reason", F.lit(UNKNOWN_TABLE))
