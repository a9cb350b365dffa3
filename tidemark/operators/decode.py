"""Raw events -> decoded events: folder, operation, marker, document, reason for refusal."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import envelope as E
from tidemark.functions.routing import table_folder

MALFORMED_VALUE = "malformed value"
MALFORMED_KEY = "malformed key"
DIGESTS = ("digest_1", "digest_2")


def decode_events(events: DataFrame, prefix: str = "", tombstones: str = "delete", digests: bool = False) -> DataFrame:
    """One decoded row per event: table folder, operation (NULL for a tombstone) and marker.

    ``root`` is the parsed value, or the parsed key of a tombstone, and ``wrapped`` tells whether its
    content lies under ``payload``; row images are read from it in place. ``reason`` is set when the
    text is not JSON; only then are ``key`` and ``value`` kept. ``tombstones='drop'`` leaves out
    key-only deletes. ``digests`` adds two hashes of the whole event as it came, and ``size``, the length of its
    texts. A ``partition`` of the events is carried through.
    """
    if tombstones not in ("delete", "drop"):
        raise ValueError(f"tombstones must be 'delete' or 'drop', not {tombstones!r}")
    if tombstones == "drop":
        events = events.filter(F.col("value").isNotNull())
    wrapped, op, decoded = _columns(prefix)
    carried = ["partition"] if "partition" in events.columns else []
    text = events.select("pos", "topic", "key", "value", F.coalesce("value", "key").alias("text"), *carried)
    parsed = E.with_parsed(text, "text", "root").select("*", wrapped).select("*", op)
    return parsed.select(*decoded, *carried, *(_digests() if digests else []))


def _digests() -> list[Column]:
    whole = ["topic", "pos", F.col("key").isNull(), "key", F.col("value").isNull(), "value"]  # a null leaves a hash as it is
    size = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in ("key", "value")), F.lit(0)).cast("long").alias("size")
    return [*[F.xxhash64(F.lit(i), *whole).alias(name) for i, name in enumerate(DIGESTS)], size]


@lru_cache(maxsize=64)
def _columns(prefix: str) -> tuple[Column, Column, list[Column | str]]:
    """The expressions of each step; kept, as every micro-batch needs the same ones."""
    root, op = F.col("root"), F.col("op")
    tombstone = F.col("value").isNull()
    malformed = F.col("text").isNotNull() & root.isNull()
    return (
        E.is_wrapped(root).alias("wrapped"),
        F.when(~tombstone, E.operation(root, F.col("wrapped"))).alias("op"),
        [
            "pos",
            "topic",
            table_folder(F.col("topic"), prefix).alias("folder"),
            "op",
            E.row_marker(op).alias("marker"),
            "root",
            "wrapped",
            F.when(malformed, F.when(tombstone, MALFORMED_KEY).otherwise(MALFORMED_VALUE)).alias("reason"),
            F.when(malformed, F.col("key")).alias("key"),
            F.when(malformed, F.col("value")).alias("value"),
        ],
    )


def document_text() -> list[Column]:
    """``key`` and ``value`` of a decoded event as text again; a tombstone has a key only."""
    text = F.to_json("root")
    return [F.when(F.col("op").isNull(), text).alias("key"), F.when(F.col("op").isNotNull(), text).alias("value")]


def decodable(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason", "key", "value")


def refused(decoded: DataFrame) -> DataFrame:
    """Events that could not be decoded, for the quarantine."""
    return decoded.filter(F.col("reason").isNotNull()).select(
        "pos", "topic", "folder", "reason", "marker", "key", "value"
    )
