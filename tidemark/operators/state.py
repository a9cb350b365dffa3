"""The current state of a landed table, kept in buckets by key and advanced by what has landed since."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import MARKER_COLUMN
from tidemark.operators.changes import ORDER, keyless_changes, last_changes, merge_changes
from tidemark.plans.files import Files
from tidemark.plans.landing import scan_sequence
from tidemark.sources.catalog import TableSpec
from tidemark.sources.landing import read_landing


@dataclass(frozen=True)
class KeyedState:
    """Current rows of one table under ``root``, stored in ``buckets`` by key.

    The stored rows are read in their buckets, so only changes are shuffled, and changes are read once. Each advance
    writes a new version and then moves a small pointer file to it; the version before stays for its readers.
    """

    root: str
    spec: TableSpec
    buckets: int = 64
    marker: str = MARKER_COLUMN

    def _pointer(self, spark: SparkSession) -> dict:
        text = Files(spark, self.root).read_text(f"{self.root}/current.json")
        return json.loads(text) if text else {"version": 0, "after": 0, "schema": None, "buckets": self.buckets}

    def _keyed(self) -> str:
        return ", ".join(f"`{k}`" for k in self.spec.keys)

    def _open(self, spark: SparkSession, pointer: dict) -> DataFrame | None:
        """The stored rows as a bucketed table of this session; its files are all there is to it."""
        if pointer["schema"] is None:
            return None
        name = f"tidemark_{uuid.uuid4().hex}"
        ddl = T.StructType.fromJson(pointer["schema"]).toDDL()
        spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({self._keyed()}) SORTED BY ({self._keyed()}) "
            f"INTO {pointer['buckets']} BUCKETS LOCATION '{self.root}/v={pointer['version']}'"
        )
        return spark.table(name)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Current rows; None before the first advance."""
        return self._open(spark, self._pointer(spark))

    def after(self, spark: SparkSession) -> int:
        """The sequence number of the last landed file that the state holds."""
        return self._pointer(spark)["after"]

    def next_state(self, spark: SparkSession, changes: DataFrame) -> DataFrame:
        """The rows after ``changes`` on top of the stored ones."""
        pointer = self._pointer(spark)
        return merge_changes(self._open(spark, pointer), last_changes(changes, self.spec.keys), self.spec.keys, self.marker, ORDER)

    def advance(self, spark: SparkSession, base: str, folder: str) -> DataFrame:
        """Apply the files that landed since; returns their changes without a full key, which no row can be found for.

        What lands meanwhile is left to the next call. A call that is stopped changes nothing.
        """
        files, pointer = Files(spark, self.root), self._pointer(spark)
        upto = scan_sequence(Files(spark, base), base, folder)
        changes = read_landing(spark, base, folder, self.spec, self.marker, pointer["after"])
        changes = changes.filter(F.col("file_sequence") <= upto)
        if upto > pointer["after"]:
            rows, version = self.next_state(spark, changes), pointer["version"] + 1
            path, name = f"{self.root}/v={version}", f"tidemark_{uuid.uuid4().hex}"
            files.delete(path)
            rows.write.format("parquet").bucketBy(self.buckets, *self.spec.keys).sortBy(*self.spec.keys).option("path", path).saveAsTable(name)
            made = {"version": version, "after": upto, "schema": rows.schema.jsonValue(), "buckets": self.buckets}
            files.write_text(f"{self.root}/current.json", json.dumps(made))
            files.delete(f"{self.root}/v={version - 2}")
        return keyless_changes(changes, self.spec.keys)
