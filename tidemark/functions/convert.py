"""Catalog types -> landing types, and JSON values -> landing values."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.envelope import json_path

# Catalog type pattern -> landing type, first match wins, else string.
# NUMBER depends on precision and scale and is handled by the limits below.
TYPE_PATTERNS = (
    (r"^DATE$", "date"),
    (r"^TIMESTAMP(\([0-9]+\))? WITH (LOCAL )?TIME ZONE", "string"),
    (r"^TIMESTAMP", "timestamp"),
    (r"^(FLOAT|BINARY_FLOAT)$", "float"),
    (r"^BINARY_DOUBLE$", "double"),
    (r"^(RAW|BLOB|LONG RAW)$|^RAW\(", "binary"),
)
MAX_INT_PRECISION = 9
MAX_LONG_PRECISION = 18

# Unit limits of untyped epoch numbers.
MILLIS_PER_DAY = 86_400_000
MICROS_ABOVE = 1_000_000_000_000_000

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
# Milliseconds outside this range do not fit a microsecond timestamp.
MILLIS_MAX = (2**63 - 1) // 1000


@dataclass(frozen=True)
class Units:
    """How untyped values are read. ``auto`` guesses the unit from the size of the number."""

    date: str = "auto"  # auto | days | millis
    timestamp: str = "auto"  # auto | millis | micros | nanos
    binary: str = "text"  # text | base64

    def __post_init__(self):
        for value, allowed in (
            (self.date, ("auto", "days", "millis")),
            (self.timestamp, ("auto", "millis", "micros", "nanos")),
            (self.binary, ("text", "base64")),
        ):
            if value not in allowed:
                raise ValueError(f"{value!r} is not one of {allowed}")


def landing_type(data_type: str, precision: int | None = 0, scale: int | None = 0) -> str:
    name = data_type.upper()
    if name == "NUMBER":
        precision, scale = precision or 0, scale or 0
        if precision == 0 or scale > 0 or precision > MAX_LONG_PRECISION:
            return "double"
        return "int" if precision <= MAX_INT_PRECISION else "bigint"
    return next((t for pattern, t in TYPE_PATTERNS if re.search(pattern, name)), "string")


def landing_type_column(data_type: Column, precision: Column, scale: Column) -> Column:
    """The same rule over a catalog DataFrame."""
    name = F.upper(data_type)
    precision, scale = F.coalesce(precision, F.lit(0)), F.coalesce(scale, F.lit(0))
    rule = (
        F.when((name == "NUMBER") & ((precision == 0) | (scale > 0)), "double")
        .when((name == "NUMBER") & (precision <= MAX_INT_PRECISION), "int")
        .when((name == "NUMBER") & (precision <= MAX_LONG_PRECISION), "bigint")
        .when(name == "NUMBER", "double")
    )
    for pattern, target in TYPE_PATTERNS:
        rule = rule.when(name.rlike(pattern), target)
    return rule.otherwise("string")


# The type a JSON value is first read as; landing types not named here are read directly.
WIRE_TYPES = {"date": "bigint", "timestamp": "bigint", "float": "double", "binary": "string"}


NUMERIC_WIRE_TYPES = ("int", "bigint", "double")


def is_finite(number: Column) -> Column:
    """False for NaN and the infinities, which JSON has no numbers for; NULL for NULL."""
    return F.abs(number) < float("inf")


def wire_type(target: str) -> str:
    return WIRE_TYPES.get(target, target)


def finish(wire: Column, target: str, units: Units = Units()) -> Column:
    """A value read as its wire type -> its landing type, NULL when it does not fit.

    Texts must have passed :func:`plain_text`.
    """
    if target == "date":
        return _date(wire, units.date)
    if target == "timestamp":
        return _timestamp(wire, units.timestamp)
    if target == "float":
        return wire.cast("float")
    if target == "binary":
        return F.try_to_binary(wire, F.lit("base64")) if units.binary == "base64" else F.encode(wire, "UTF-8")
    return wire


def looks_numeric(text: Column) -> Column:
    """A cheap first test: true for every text a JSON number can have, and for some others."""
    return text.between("-", ":")


def plain_text(text: Column, value: Column) -> Column:
    """Text of a JSON value; fractions print as doubles do, so 23.0 stays 23.0.

    ``value`` is the same value as VARIANT; it matters only for texts that look numeric.
    """
    fraction = F.schema_of_variant(value).startswith("D")  # DOUBLE or DECIMAL
    oversized = ~text.contains(".") & F.try_variant_get(value, "$", "bigint").isNull()
    return F.when(
        looks_numeric(text) & fraction & ~oversized, F.try_variant_get(value, "$", "double").cast("string")
    ).otherwise(text)


def image_value(image: Column, name: str, target: str, units: Units = Units()) -> Column:
    """Member ``name`` of a VARIANT row image as its landing type; NULL when absent, null or not convertible."""
    path = json_path(name)
    wire = F.try_variant_get(image, path, wire_type(target))
    if wire_type(target) == "string":
        wire = plain_text(wire, F.try_variant_get(image, path, "variant"))
    return finish(wire, target, units)


def marker_or_default(marker: Column, data_type: str) -> Column:
    """A numeric marker as INT; an absent or non-numeric one is 0."""
    if data_type == "variant":
        kind = F.schema_of_variant(marker)
        numeric = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
        marker = F.when(numeric, F.try_variant_get(marker, "$", "int"))
    elif data_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or data_type.startswith("decimal"):
        marker = marker.try_cast("int")
    else:
        return F.lit(0)
    return F.coalesce(marker, F.lit(0))


def _quotient(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor).cast("bigint"))


def _floor(value: Column, divisor: int) -> Column:
    unit = F.lit(divisor).cast("bigint")
    return F.call_function("div", F.try_subtract(value, F.pmod(value, unit)), unit)


def _date(number: Column, unit: str) -> Column:
    if unit == "days":
        days = number
    elif unit == "millis":
        days = _floor(number, MILLIS_PER_DAY)
    else:
        # A number that fits 32 bits is already days.
        days = F.when(number.between(INT_MIN, INT_MAX), number).when(
            number > MILLIS_PER_DAY, _quotient(number, MILLIS_PER_DAY)
        )
    return F.date_from_unix_date(days.try_cast("int"))


def _timestamp(number: Column, unit: str) -> Column:
    if unit == "micros":
        millis = _floor(number, 1_000)
    elif unit == "nanos":
        millis = _floor(number, 1_000_000)
    elif unit == "millis":
        millis = number
    else:
        millis = F.when(number > MICROS_ABOVE, _quotient(number, 1_000)).otherwise(number)
    return F.timestamp_millis(F.when(millis.between(-MILLIS_MAX, MILLIS_MAX), millis))
