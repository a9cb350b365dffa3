"""Reading a landing zone back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import MARKER_COLUMN
from tidemark.functions.naming import SUFFIX, name_sequence, sequence_file
from tidemark.sources.catalog import TableSpec


def read_landing(
    spark: SparkSession,
    base: str,
    folder: str,
    spec: TableSpec | None = None,
    marker: str = MARKER_COLUMN,
    after_sequence: int = 0,
) -> DataFrame:
    """Landed rows with ``file_sequence`` and ``row_index``, their order of arrival.

    With ``spec`` the catalog gives the schema; otherwise the footers of all files are merged, which
    costs one extra job over the files. Either way older files show NULL in columns added later.
    ``after_sequence`` prunes the files already applied before any of them is opened.
    """
    # Spark takes a name starting with _metadata for a Parquet summary file, so data files are named.
    reader = spark.read.option("pathGlobFilter", f"*{SUFFIX}")
    reader = reader.schema(spec.landing_schema(marker)) if spec else reader.option("mergeSchema", "true")
    rows = reader.parquet(f"{base}/{folder}")
    if after_sequence:
        rows = rows.filter(F.col("_metadata.file_name") > sequence_file(after_sequence))
    return rows.select(
        "*",
        name_sequence(F.col("_metadata.file_name")).alias("file_sequence"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def landing_files(spark: SparkSession, base: str, folder: str) -> DataFrame:
    """Names and sizes of the visible files of a table; no content is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{folder}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(path):
        return spark.createDataFrame([], "file_name STRING, length BIGINT")
    return (
        spark.read.format("binaryFile")
        .load(f"{base}/{folder}")
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    )


def max_sequence(names: DataFrame, column: str = "file_name") -> DataFrame:
    """Highest sequence among file names, 0 when none has one."""
    highest = F.max(name_sequence(F.col(column)))
    return names.agg(F.greatest(F.coalesce(highest, F.lit(0)), F.lit(0)).cast("bigint").alias("max_sequence"))
