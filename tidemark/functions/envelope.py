"""Change-event envelope: JSON text -> operation, row image, row marker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row markers and their operation codes.
INSERT, UPDATE, DELETE = 0, 1, 2
DEFAULT_OP = "c"
MARKER_COLUMN = "__rowMarker__"


def json_path(*names: str) -> str:
    """Path to a member; names keep their case and may hold any character."""

    def step(name: str) -> str:
        quote = '"' if "'" in name else "'"
        return f"[{quote}{name}{quote}]"

    return "$" + "".join(step(n) for n in names)


def read(doc: Column, path: str, kind: str = "variant") -> Column:
    """The value at a path, NULL when absent or not convertible; JSON null is a variant null."""
    return F.try_variant_get(doc, path, kind)


def is_wrapped(root: Column) -> Column:
    """True when the document has a ``payload`` member, whatever it holds.

    Reading a sub-document as VARIANT copies it, so the usual case, an object, is told by a struct.
    """
    path = json_path("payload")
    return read(root, path, "struct<op: string>").isNotNull() | read(root, path).isNotNull()


def inside(root: Column, wrapped: Column, kind: str, *names: str) -> Column:
    """A value of the unwrapped document, read in place."""
    return F.when(wrapped, read(root, json_path("payload", *names), kind)).otherwise(
        read(root, json_path(*names), kind)
    )


def operation(root: Column, wrapped: Column) -> Column:
    """Operation code; ``c`` when the member is absent, its text otherwise."""
    absent = inside(root, wrapped, "variant", "op").isNull()
    text = inside(root, wrapped, "string", "op")
    return F.coalesce(text, F.when(absent, F.lit(DEFAULT_OP)).otherwise(F.lit("null")))


def row_marker(op: Column) -> Column:
    """Marker of an operation; no operation is a tombstone, an unknown one an insert."""
    return (
        F.when(op.isNull(), F.lit(DELETE))
        .when(op == "u", F.lit(UPDATE))
        .when(op == "d", F.lit(DELETE))
        .otherwise(F.lit(INSERT))
    )


def row_image(root: Column, wrapped: Column, op: Column, kind: str, use_before: Column | None = None) -> Column:
    """The row an operation carries, read as ``kind``; ``use_before`` overrides the choice.

    A tombstone carries its key. An unknown operation takes ``before`` only without ``after``.
    """
    after, before = (inside(root, wrapped, kind, side) for side in ("after", "before"))
    image = F.when(op.isNull(), inside(root, wrapped, kind))
    if use_before is not None:
        image = image.when(use_before, before)
    return (
        image.when(op.isin("c", "r", "u"), after)
        .when(op == "d", before)
        .otherwise(F.when(inside(root, wrapped, "variant", "after").isNotNull(), after).otherwise(before))
    )


def is_imageless_update(root: Column, wrapped: Column, op: Column) -> Column:
    """True for an update with a ``before`` member whose ``after`` has no member of its own."""
    members = F.coalesce(F.size(inside(root, wrapped, "map<string,variant>", "after")), F.lit(0))
    return (op == "u") & (members < 1) & inside(root, wrapped, "variant", "before").isNotNull()


def scalar_kind(value: Column) -> Column:
    """The kind a JSON scalar is read as; nested values and oversized numbers are kept as JSON text."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "bigint")
    fits_int = number.between(-(2**31), 2**31 - 1)
    oversized = kind.endswith(",0)") & number.isNull()
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when(kind == "STRING", F.lit("text"))
        .when((kind == "BIGINT") & fits_int, F.lit("int"))
        .when(kind == "BIGINT", F.lit("long"))
        .when((kind == "DOUBLE") | (kind.startswith("DECIMAL") & ~oversized), F.lit("double"))
        .otherwise(F.lit("json"))
    )


def row_map(text: Column) -> Column:
    """A JSON object as a map of its members; JSON null gives an empty map."""
    empty = F.create_map().cast("map<string,variant>")
    return F.coalesce(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"), empty)


def with_parsed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the parsed JSON of ``text``; malformed text gives NULL.

    A plain projection would be inlined into every later filter and parse twice. A filter on a
    generated column stays above the generator, so the text is parsed once.
    """
    return df.withColumn(name, F.explode(F.array(F.try_parse_json(text))))
