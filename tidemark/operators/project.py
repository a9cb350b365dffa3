"""Decoded events of one table -> typed rows in catalog order."""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import convert as C
from tidemark.functions import envelope as E
from tidemark.operators.decode import document_text
from tidemark.operators.keep import keep_rows
from tidemark.sources.catalog import TableSpec


def project_rows(
    decoded: DataFrame,
    spec: TableSpec,
    units: C.Units = C.Units(),
    marker: str = E.MARKER_COLUMN,
    lookup_updates: bool = True,
) -> DataFrame:
    """``pos, topic, row, needs_lookup, bad_columns, op, root``; ``row`` holds the catalog columns, marker last.

    A ``size`` of the events is carried through.

    Members the catalog does not know are dropped, missing ones are NULL. ``bad_columns`` names the
    columns whose value cannot be converted; it is empty text for a good row. ``needs_lookup`` marks
    updates whose row image is missing: they carry their ``before`` image until a lookup finds the
    current row. Without ``lookup_updates`` they keep their empty image.

    All columns are read from the document in one pass. Rows with a NULL are read once more to tell a
    missing value from an unconvertible one, rows with numbers in text columns to print them, rows with a
    0 or 1 in a numeric column to refuse booleans.
    """
    rows = decoded
    carried = ["size"] if "size" in decoded.columns else []
    for step in _steps(spec, units, marker, lookup_updates):
        rows = rows.select(*step, *carried)
    return rows


@lru_cache(maxsize=1024)
def _steps(spec: TableSpec, units: C.Units, marker: str, lookup_updates: bool) -> list[list[Column | str]]:
    """The projections of a table; kept, as every micro-batch needs the same ones."""
    root, wrapped, op, wire = F.col("root"), F.col("wrapped"), F.col("op"), F.col("wire")
    columns = [(c.name, c.landing_type) for c in spec.data_columns(marker)]
    texts = [n for n, t in columns if C.wire_type(t) == "string"]
    read = {n: wire.getField(n) for n, _ in columns}
    kind = _struct((n, C.wire_type(t)) for n, t in columns)
    given = ["pos", "topic", "op", "marker", "root", "wrapped"]

    def image(of: str) -> Column:
        return E.row_image(root, wrapped, op, of, F.col("needs_lookup") if lookup_updates else None)

    if lookup_updates:
        first = F.col("first")
        nothing = reduce(and_, (first.getField(n).isNull() for n, _ in columns))
        missing = F.coalesce(nothing & E.is_imageless_update(root, wrapped, op), F.lit(False))
        before = E.inside(root, wrapped, kind, "before")
        steps = [
            [*given, E.row_image(root, wrapped, op, kind).alias("first")],
            [*given, "first", missing.alias("needs_lookup")],
            [*given, "needs_lookup", F.when(F.col("needs_lookup"), before).otherwise(first).alias("wire")],
        ]
    else:
        steps = [[*given, F.lit(False).alias("needs_lookup"), image(kind).alias("wire")]]

    # Of these, only values changed after reading can be lost after reading.
    fits = {n: (C.finish(read[n], t, units) if t in C.WIRE_TYPES else read[n]).isNotNull() for n, t in columns}
    held = F.when(~reduce(and_, fits.values()), image("map<string,string>"))
    # A boolean reads as the number 0 or 1, so only such rows are read once more.
    numbers = [n for n, t in columns if C.wire_type(t) in C.NUMERIC_WIRE_TYPES]
    odd = reduce(or_, (read[n].isin(0, 1) for n in numbers), F.lit(False))
    kinds = F.when(odd, image(_struct((n, "variant") for n in numbers))) if numbers else F.lit(None)

    def refused(name: str, target: str) -> Column:
        if name not in numbers:
            return F.lit(False)
        boolean = F.schema_of_variant(F.col("kinds").getField(name)) == "BOOLEAN"
        infinite = ~C.is_finite(read[name]) if C.wire_type(target) == "double" else F.lit(False)
        return F.coalesce(boolean | infinite, infinite, F.lit(False))

    wrong = {n: refused(n, t) for n, t in columns}
    unread = [F.when((~fits[n] & F.try_element_at("held", F.lit(n)).isNotNull()) | wrong[n], F.lit(n)) for n, _ in columns]
    clean = F.col("held").isNull() & ~reduce(or_, wrong.values())
    bad = F.when(clean, F.lit("")).otherwise(F.concat_ws(", ", *unread))

    as_value = F.lit(None)
    if texts:
        numeric = reduce(or_, (C.looks_numeric(read[n]) for n in texts))
        as_value = F.when(numeric, image(_struct((n, "variant") for n in texts)))

    def landed(name: str, target: str) -> Column:
        value = read[name]
        if name in texts:
            value = C.plain_text(value, F.col("as_value").getField(name))
        return C.finish(value, target, units).alias(name)

    row = F.struct(*[landed(n, t) for n, t in columns], F.coalesce("marker", F.lit(E.INSERT)).alias(marker))
    return [
        *steps,
        ["pos", "topic", "op", "marker", "root", "needs_lookup", "wire", held.alias("held"), as_value.alias("as_value"), kinds.alias("kinds")],
        ["pos", "topic", row.alias("row"), "needs_lookup", bad.alias("bad_columns"), "op", "root"],
    ]


def _struct(fields) -> str:
    quoted = (f"`{n.replace('`', '``')}`: {t}" for n, t in fields)
    return f"struct<{', '.join(quoted)}>"


def convertible(projected: DataFrame) -> DataFrame:
    carried = ["size"] if "size" in projected.columns else []
    return keep_rows(projected, F.col("bad_columns") == "").select("pos", "topic", "row", "needs_lookup", *carried)


def refused_rows(projected: DataFrame, folder: str, marker: str = E.MARKER_COLUMN) -> DataFrame:
    """Rows with an unconvertible value, for the quarantine, with their whole document."""
    return keep_rows(projected, F.col("bad_columns") != "").select(
        "pos",
        "topic",
        F.lit(folder).alias("folder"),
        F.concat(F.lit("unconvertible: "), F.col("bad_columns")).alias("reason"),
        F.col("row").getField(marker).alias("marker"),
        *document_text(),
    )
