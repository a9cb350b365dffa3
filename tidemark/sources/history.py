"""Tables whose columns change: which catalog entry an event was written under, and where its values land."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.convert import Units
from tidemark.functions.envelope import MARKER_COLUMN
from tidemark.operators.project import project_rows
from tidemark.sources.catalog import ColumnSpec, TableSpec, catalog_keys


@dataclass(frozen=True)
class TableHistory:
    """A table's catalog entries, each with the position from which it holds, in rising order.

    Columns are the same column if they have the same id, whatever they are called. A dropped column stays in the
    landing, NULL for later rows, until its id is ``released``. A column that takes a dropped one's name is another one:
    the dropped one then lands with its id behind its name.
    """

    versions: tuple[tuple[int, TableSpec], ...]
    released: frozenset[int] = frozenset()

    @property
    def newest(self) -> TableSpec:
        return self.versions[-1][1]

    @property
    def name(self) -> str:
        return self.newest.name

    def landing_spec(self) -> TableSpec:
        """The newest columns, then the dropped ones in the order of their ids."""
        current = {c.column_id for c in self.newest.columns}
        names = {c.name for c in self.newest.columns}
        last = {c.column_id: c for _, spec in self.versions for c in spec.columns}
        dropped = [last[i] for i in sorted(last) if i not in current and i not in self.released]
        renamed = [ColumnSpec(f"{c.name}__{c.column_id}" if c.name in names else c.name, c.data_type, c.precision, c.scale, True, c.column_id) for c in dropped]
        return TableSpec(self.newest.schema, self.newest.table, (*self.newest.columns, *renamed), self.newest.keys)

    def changed(self, pos: int, spec: TableSpec) -> TableHistory:
        """The history with ``spec`` from ``pos`` on; the same if that is the newest entry already."""
        return self if spec == self.newest else TableHistory((*self.versions, (pos, spec)), self.released)

    def to_dict(self) -> dict:
        return {"versions": [[pos, spec.to_dict()] for pos, spec in self.versions], "released": sorted(self.released)}

    @classmethod
    def from_dict(cls, data: dict) -> TableHistory:
        return cls(tuple((pos, TableSpec.from_dict(spec)) for pos, spec in data["versions"]), frozenset(data["released"]))


def entry_from_dict(data: dict) -> TableSpec | TableHistory:
    return (TableHistory if "versions" in data else TableSpec).from_dict(data)


def project_versions(
    decoded: DataFrame, history: TableHistory, units: Units = Units(), marker: str = MARKER_COLUMN, lookup_updates: bool = True
) -> DataFrame:
    """:func:`project_rows` with each event under the entry of its position, as rows of the landing's columns.

    Events before the first entry's position are read under it. A value that does not fit the column's
    present type refuses its row, as an unconvertible one does.
    """
    target = history.landing_spec()
    types = {f.name: f.dataType for f in target.landing_schema(marker)}
    parts = []
    for i, (start, spec) in enumerate(history.versions):
        here = F.lit(True) if i == 0 else F.col("pos") >= start
        if i + 1 < len(history.versions):
            here = here & (F.coalesce("pos", F.lit(start)) < history.versions[i + 1][0])
        rows = project_rows(decoded.filter(here), spec, units, marker, lookup_updates)
        own = {c.column_id: F.col("row").getField(c.name) for c in spec.data_columns(marker)}
        values = {c.name: own[c.column_id].try_cast(types[c.name]) if c.column_id in own else F.lit(None).cast(types[c.name]) for c in target.data_columns(marker)}
        unfit = [F.when(own[c.column_id].isNotNull() & values[c.name].isNull(), F.lit(c.name)) for c in target.data_columns(marker) if c.column_id in own]
        row = F.struct(*[v.alias(n) for n, v in values.items()], F.col("row").getField(marker).alias(marker)).alias("row")
        bad = F.when(F.col("bad_columns") != "", F.col("bad_columns")).otherwise(F.concat_ws(", ", *unfit)).alias("bad_columns")
        parts.append(rows.select([row if c == "row" else bad if c == "bad_columns" else c for c in rows.columns]))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def collect_history(columns: DataFrame, constraints: DataFrame, key_columns: DataFrame) -> dict[str, TableHistory]:
    """Histories on the driver from catalog column rows with ``valid_from``, the position from which a row holds.

    All rows of a table with one ``valid_from`` are its whole entry from there on. Names and types only.
    """
    ordered = F.struct("ordinal", "column_name")
    keys = catalog_keys(constraints, key_columns).groupBy("owner", "table_name").agg(F.array_sort(F.collect_list(ordered))["column_name"].alias("keys"))
    zero = F.lit(0)
    column = F.struct(
        "column_id", "column_name", "data_type", F.coalesce("data_precision", zero), F.coalesce("data_scale", zero),
        F.coalesce(F.col("nullable") == "Y", F.lit(False)),
    )
    entries = columns.groupBy("owner", "table_name", "valid_from").agg(F.array_sort(F.collect_list(column)).alias("columns"))
    found: dict[str, list] = {}
    for r in entries.join(keys, ["owner", "table_name"], "left").collect():
        named = {c[1] for c in r.columns}
        spec = TableSpec(r.owner, r.table_name, tuple(ColumnSpec(*c[1:], c[0]) for c in r.columns), tuple(k for k in r["keys"] or () if k in named))
        found.setdefault(spec.name, []).append((r.valid_from, spec))
    return {n: TableHistory(tuple(sorted(v, key=lambda x: x[0]))) for n, v in found.items()}
