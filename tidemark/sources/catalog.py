"""Table catalogs: column and key rows, table specs, refresh."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.convert import landing_type, landing_type_column
from tidemark.functions.envelope import MARKER_COLUMN

COLUMN_SCHEMA = (
    "owner STRING, table_name STRING, column_name STRING, data_type STRING, "
    "data_precision INT, data_scale INT, nullable STRING, column_id INT"
)
CONSTRAINT_SCHEMA = "owner STRING, table_name STRING, constraint_name STRING, constraint_type STRING"
KEY_COLUMN_SCHEMA = "owner STRING, constraint_name STRING, column_name STRING, position INT"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    data_type: str
    precision: int = 0
    scale: int = 0
    nullable: bool = True
    column_id: int = 0

    @property
    def landing_type(self) -> str:
        return landing_type(self.data_type, self.precision, self.scale)


@dataclass(frozen=True)
class TableSpec:
    """One table of the catalog: columns in catalog order, key columns in key order."""

    schema: str
    table: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}".upper()

    def data_columns(self, marker: str = MARKER_COLUMN) -> list[ColumnSpec]:
        return [c for c in self.columns if c.name != marker]

    def landing_schema(self, marker: str = MARKER_COLUMN) -> T.StructType:
        """All data columns nullable, the marker last and never null."""
        fields = [
            T.StructField(c.name, T.DataType.fromDDL(c.landing_type), True) for c in self.data_columns(marker)
        ]
        return T.StructType([*fields, T.StructField(marker, T.IntegerType(), False)])

    def to_dict(self) -> dict:
        return {
            "schema": self.schema,
            "table": self.table,
            "keys": list(self.keys),
            "columns": [list(vars(c).values()) for c in self.columns],
        }

    @classmethod
    def from_dict(cls, data: dict) -> TableSpec:
        return cls(
            data["schema"], data["table"], tuple(ColumnSpec(*c) for c in data["columns"]), tuple(data["keys"])
        )


#: A catalog's tables by name; an entry may also be a history of entries (``sources.history``).
Catalog = dict[str, TableSpec]


def catalog_columns(columns: DataFrame) -> DataFrame:
    """Column rows as the landing uses them; ``ordinal`` is the place within the table."""
    in_table = Window.partitionBy("owner", "table_name").orderBy("column_id")
    return columns.select(
        "owner",
        "table_name",
        "column_name",
        "data_type",
        F.coalesce("data_precision", F.lit(0)).alias("data_precision"),
        F.coalesce("data_scale", F.lit(0)).alias("data_scale"),
        F.coalesce(F.col("nullable") == "Y", F.lit(False)).alias("nullable"),
        "column_id",
        F.row_number().over(in_table).alias("ordinal"),
    )


def catalog_keys(constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    """Primary-key columns of every table, ``ordinal`` in key order."""
    in_table = Window.partitionBy("owner", "table_name").orderBy("position")
    return (
        constraints.filter(F.col("constraint_type") == "P")
        .join(key_columns, ["owner", "constraint_name"])
        .select("owner", "table_name", "column_name", "position")
        .withColumn("ordinal", F.row_number().over(in_table))
    )


def landing_types(columns: DataFrame) -> DataFrame:
    return columns.withColumn(
        "landing_type", landing_type_column(F.col("data_type"), F.col("data_precision"), F.col("data_scale"))
    )


def landing_schemas(columns: DataFrame, marker: str = MARKER_COLUMN) -> DataFrame:
    """One row per table: its landing schema as DDL text, columns in catalog order, marker last."""
    field = F.struct("column_id", F.concat_ws(" ", "column_name", "landing_type").alias("ddl"))
    return (
        landing_types(columns)
        .groupBy("owner", "table_name")
        .agg(F.array_sort(F.collect_list(field)).alias("fields"))
        .select(
            "owner",
            "table_name",
            F.size("fields").alias("n_columns"),
            F.concat_ws(", ", F.col("fields.ddl"), F.lit(f"{marker} int NOT NULL")).alias("ddl"),
        )
    )


def read_jdbc_catalog(
    spark: SparkSession, url: str, owners: Iterable[str], **options: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Column, constraint and key-column rows of the given schemas; the database filters them."""

    owners = list(owners)

    def load(table: str, schema: str) -> DataFrame:
        names = [f.split()[0] for f in schema.split(", ")]
        rows = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
        return rows.filter(F.col("owner").isin(owners)).select(
            *[F.col(n).cast(f.split()[1]).alias(n) for n, f in zip(names, schema.split(", "))]
        )

    return (
        load("ALL_TAB_COLUMNS", COLUMN_SCHEMA),
        load("ALL_CONSTRAINTS", CONSTRAINT_SCHEMA),
        load("ALL_CONS_COLUMNS", KEY_COLUMN_SCHEMA),
    )


def collect_catalog(columns: DataFrame, constraints: DataFrame, key_columns: DataFrame) -> Catalog:
    """The catalog on the driver: names and types only, one entry per table, never table data."""
    key = F.struct("ordinal", "column_name")
    keys = (
        catalog_keys(constraints, key_columns)
        .groupBy("owner", "table_name")
        .agg(F.array_sort(F.collect_list(key))["column_name"].alias("keys"))
    )
    column = F.struct("ordinal", "column_name", "data_type", "data_precision", "data_scale", "nullable", "column_id")
    tables = (
        catalog_columns(columns)
        .groupBy("owner", "table_name")
        .agg(F.array_sort(F.collect_list(column)).alias("columns"))
        .join(keys, ["owner", "table_name"], "left")
    )
    specs = (
        TableSpec(r.owner, r.table_name, tuple(ColumnSpec(*c[1:]) for c in r.columns), tuple(r["keys"] or ()))
        for r in tables.collect()
    )
    return {s.name: s for s in specs}


def static_catalog(*specs: TableSpec) -> Callable[[], Catalog]:
    """A caller-supplied catalog that never changes."""
    fixed = {s.name: s for s in specs}
    return lambda: fixed


def cached_catalog(
    load: Callable[[], Catalog], ttl_seconds: float = 300.0, clock: Callable[[], float] = time.monotonic
) -> Callable[[], Catalog]:
    """Call ``load`` again once the last result is older than ``ttl_seconds``."""
    state: dict = {}

    def current() -> Catalog:
        if "at" not in state or clock() - state["at"] > ttl_seconds:
            state["catalog"], state["at"] = load(), clock()
        return state["catalog"]

    return current
