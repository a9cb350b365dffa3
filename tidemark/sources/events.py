"""Change events as DataFrames of ``topic, key, value, pos``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import envelope, routing

EVENT_SCHEMA = "topic STRING, key STRING, value STRING, pos BIGINT"


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(EVENT_SCHEMA).load(path)


def stream_events(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_kafka(
    spark: SparkSession, servers: str, topics: str, max_offsets_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Events of the topics matching the pattern ``topics``; needs Spark's Kafka connector.

    ``pos`` is the offset: unique per partition, and all changes of a key share a partition.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", topics)
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("pos"),
    )


def with_snapshot(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Initial rows (operation ``r``) and later changes as one feed, where no change falls into the reading."""
    return snapshot.unionByName(changes)


def key_text(keys: Iterable[str]) -> Column:
    """The key columns of an event as texts, from its key or else from its row; wrapped or not."""
    root = F.try_parse_json(F.coalesce("key", "value"))
    wrapped = envelope.is_wrapped(root)
    places = [(), ("after",), ("before",)]
    return F.array(*[F.coalesce(*[envelope.inside(root, wrapped, "string", *p, k) for p in places]) for k in keys])


def hand_over(snapshot: DataFrame, changes: DataFrame, windows: list[tuple[int, int]], keys: Iterable[str]) -> DataFrame:
    """A snapshot read while changes went on, and these changes, as one feed with the true order.

    The snapshot is read in chunks. ``windows`` has, for each, the position before the chunk was read and the one after;
    ``snapshot`` names its chunk in ``window``, the place in this list. A row that a change of its key inside the window
    has overtaken, or may have, is dropped, as the change carries the row or its removal. Any other row was the same all the while: it
    takes the position at the window's end, behind older changes and before later ones.

    Changes are first reduced to the distinct keys of each window, so a key that changes all the time counts once.
    Only these keys and the snapshot's are shuffled against each other.
    """
    keys = list(keys)
    spark = snapshot.sparkSession
    listed = spark.createDataFrame([(i, low, high) for i, (low, high) in enumerate(windows)], "window INT, _low BIGINT, _high BIGINT")
    listed = F.broadcast(listed)  # one row per chunk
    during = changes.join(listed, (F.col("pos") > F.col("_low")) & (F.col("pos") <= F.col("_high")))
    overtaken = during.select("topic", "window", key_text(keys).alias("_key")).distinct()
    rows = snapshot.withColumn("_key", key_text(keys)).join(overtaken, ["topic", "window", "_key"], "left_anti")
    placed = rows.join(listed, "window").select("topic", "key", "value", F.col("_high").alias("pos"))
    return placed.unionByName(changes.select("topic", "key", "value", "pos"))


def allow_tables(
    events: DataFrame, tables: Iterable[str] = (), schemas: Iterable[str] = (), prefix: str = ""
) -> DataFrame:
    """Keep the listed ``SCHEMA.TABLE`` names and whole schemas; both empty keeps everything.

    It tests the topic text itself, so the filter reaches the scan and runs before any decoding.
    """
    head = f"{prefix}." if prefix.strip() else ""
    tables, schemas = list(tables), list(schemas)
    if not tables and not schemas:
        return events
    keep: Column = F.lit(False)
    if tables:
        keep = F.col("topic").isin([f"{head}{t}" for t in tables])
    for schema in schemas:
        keep = keep | F.col("topic").startswith(f"{head}{schema}.")
    return events.filter(keep)


def with_folder(events: DataFrame, prefix: str = "") -> DataFrame:
    return events.withColumn("folder", routing.table_folder(F.col("topic"), prefix))
