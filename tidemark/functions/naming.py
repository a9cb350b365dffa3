"""Sequence file names, key metadata text, codec names."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the landing zone.
SUFFIX = ".parquet"
DIGITS = 20
STATE_FILE = "_sequence.txt"
METADATA_FILE = "_metadata.json"

# Requested codec -> Parquet writer option; anything else is snappy.
CODECS = {"GZIP": "gzip", "LZ4": "lz4", "ZSTD": "zstd", "UNCOMPRESSED": "uncompressed"}
DEFAULT_CODEC = "snappy"

MAX_LONG = 2**63 - 1


def sequence_name(sequence: Column) -> Column:
    return F.concat(F.lpad(sequence.cast("string"), DIGITS, "0"), F.lit(SUFFIX))


def name_sequence(name: Column) -> Column:
    """Sequence in a file name, NULL for any other name."""
    digits = F.when(name.endswith(SUFFIX), F.regexp_extract(name, r"^([+-]?[0-9]+)[.]parquet$", 1))
    return digits.try_cast("bigint")


def sequence_file(sequence: int) -> str:
    return f"{sequence:0{DIGITS}d}{SUFFIX}"


def file_sequence(name: str) -> int | None:
    return _long(name.removesuffix(SUFFIX)) if name.endswith(SUFFIX) else None


def parse_state(text: str | None) -> int | None:
    """Content of a state file as a number; None when it is absent or not one."""
    return _long((text or "").strip())


def _long(text: str) -> int | None:
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    value = int(text)
    return value if -MAX_LONG - 1 <= value <= MAX_LONG else None


def key_metadata(key_columns: Iterable[str]) -> str:
    return json.dumps({"keyColumns": list(key_columns)}, separators=(",", ":"), ensure_ascii=False)


def key_metadata_column(positions: Column, names: Column) -> Column:
    """The same text as an aggregate over key rows, in key order."""
    ordered = F.array_sort(F.collect_list(F.struct(positions.alias("position"), names.alias("name"))))
    return F.to_json(F.struct(F.transform(ordered, lambda k: k["name"]).alias("keyColumns")))


def codec(requested: str | None) -> str:
    return CODECS.get((requested or "").upper(), DEFAULT_CODEC)


def codec_column(requested: Column) -> Column:
    known = F.create_map(*[F.lit(part) for pair in CODECS.items() for part in pair])
    return F.coalesce(F.try_element_at(known, F.upper(requested)), F.lit(DEFAULT_CODEC))
