"""Decoded events split by table into stored segments, and the ledger of segments that are not landed yet."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.files import Files
from tidemark.plans.landing import TableSize, Unit
from tidemark.sources.catalog import TableSpec
from tidemark.sources.history import TableHistory, entry_from_dict

#: What of a decoded event its table needs; ``size`` is the length of its text.
COLUMNS = ("pos", "topic", "op", "marker", "root", "wrapped", "size")
SCHEMA = "pos BIGINT, topic STRING, op STRING, marker INT, root VARIANT, wrapped BOOLEAN, size BIGINT"
#: A task of the split takes text of so many bytes, as far as the batch is large enough.
TASK_BYTES_MIN = 4_000_000
TASK_BYTES_MAX = 128_000_000
#: Reading a row costs as much as so many bytes of its text, so tables of short rows get their share of the tasks.
ROW_BYTES = 200


@dataclass(frozen=True)
class FlushPolicy:
    """A table lands once this many rows or bytes of text wait for it, or its first waiting event is this old."""

    rows: int = 200_000
    bytes: int = 1 << 30
    seconds: float = 10.0

    def is_due(self, waiting: Iterable[Segment], now: float) -> bool:
        waiting = list(waiting)
        return bool(waiting) and (
            sum(s.rows for s in waiting) >= self.rows
            or sum(s.bytes for s in waiting) >= self.bytes
            or now - min(s.at for s in waiting) >= self.seconds
        )


@dataclass(frozen=True)
class Segment:
    """One table's events of one batch, stored as they were decoded."""

    folder: str
    path: str
    rows: int
    bytes: int
    widest: int
    updates: int
    at: float


@dataclass(frozen=True)
class Flush:
    """Segments of one table that land as one unit, with the table's catalog entry at that time."""

    unit: Unit
    segments: tuple[Segment, ...]
    spec: TableSpec | TableHistory
    failed: int = 0
    error: str = ""

    def to_dict(self) -> dict:
        return {
            "unit": asdict(self.unit), "segments": [asdict(s) for s in self.segments],
            "spec": self.spec.to_dict(), "failed": self.failed, "error": self.error,
        }

    @classmethod
    def from_dict(cls, data: dict) -> Flush:
        segments = tuple(Segment(**s) for s in data["segments"])
        return cls(Unit(**data["unit"]), segments, entry_from_dict(data["spec"]), data["failed"], data["error"])


def total_size(segments: Iterable[Segment]) -> TableSize:
    segments = list(segments)
    return TableSize(
        sum(s.rows for s in segments), sum(s.bytes for s in segments),
        max((s.widest for s in segments), default=0), sum(s.updates for s in segments),
    )


def allot(sizes: dict[str, int], tasks: int) -> dict[str, tuple[int, int]]:
    """First task and number of tasks for each table, by its bytes.

    A table above a task's share gets tasks of its own; smaller ones are packed, the largest first.
    """
    share = min(max(sum(sizes.values()) // max(tasks, 1), TASK_BYTES_MIN), TASK_BYTES_MAX)
    placed, following, room = {}, 0, 0
    for table, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size > share:
            placed[table] = (following, math.ceil(size / share))
            following += placed[table][1]
        else:
            if size > room:
                following, room = following + 1, share
            placed[table] = (following - 1, 1)
            room -= size
    return placed


def split(decoded: DataFrame, sizes: dict[str, TableSize], path: str) -> dict[str, str]:
    """Write the good events of the tables in ``sizes``, one folder per table; returns the folders.

    ``decoded`` is read once, however many tables it holds. Tasks are allotted by bytes and rows, so a hot table is
    spread over many and small ones share one. Events go to a table's tasks by their own hash.
    """
    spark = decoded.sparkSession
    placed = allot({f: s.bytes + ROW_BYTES * s.rows for f, s in sizes.items()}, spark.sparkContext.defaultParallelism)
    if not placed:
        return {}
    numbers = {f: i for i, f in enumerate(sorted(placed))}
    places = spark.createDataFrame([(f, numbers[f], *p) for f, p in placed.items()], "folder STRING, table INT, first INT, tasks INT")
    rows = decoded.filter(F.col("reason").isNull()).join(F.broadcast(places), "folder")  # a row per table, not per event
    task = F.col("first") + F.pmod("digest_1", "tasks").cast("int")
    dealt = rows.repartitionById(max(a + n for a, n in placed.values()), task)
    writer = dealt.select("table", *COLUMNS).write.mode("overwrite").partitionBy("table")
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)  # a folder empties with its tables
    return {f: f"{path}/table={n}" for f, n in numbers.items()}


def read_segments(spark: SparkSession, segments: Iterable[Segment]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(*[s.path for s in segments])


class Ledger:
    """What waits to be landed: a plan that must be finished first, then open flushes and loose segments.

    A plan fixes what a batch lands and what waits after it. It is written before anything is landed and removed
    once all is done, so whoever comes next finishes the same plan. Only names and counts are kept here.
    """

    def __init__(self, state: Files, root: str):
        self.state, self.root = state, root

    def plan(self) -> dict | None:
        text = self.state.read_text(f"{self.root}/plan.json")
        return None if text is None else json.loads(text)

    def open_plan(self, batch: str, flushes: list[Flush], loose: list[Segment], **more) -> dict:
        plan = {"batch": batch, "flushes": [f.to_dict() for f in flushes], "loose": [asdict(s) for s in loose], **more}
        self.state.write_text_once(f"{self.root}/plan.json", json.dumps(plan))
        return plan

    def close_plan(self, failed: list[Flush], plan: dict) -> None:
        waiting = {"failed": [f.to_dict() for f in failed], "loose": plan["loose"]}
        self.state.write_text(f"{self.root}/waiting.json", json.dumps(waiting))
        self.state.delete(f"{self.root}/plan.json")

    def waiting(self) -> tuple[list[Flush], list[Segment]]:
        """Flushes that failed, in their order, and segments that no flush has taken yet."""
        held = json.loads(self.state.read_text(f"{self.root}/waiting.json") or '{"failed": [], "loose": []}')
        return [Flush.from_dict(f) for f in held["failed"]], [Segment(**s) for s in held["loose"]]
