"""Land typed rows of one table as numbered Parquet files, once per batch however often it runs.

The order of steps makes a repeated batch harmless. Rows are staged first. The manifest then fixes
the staged files and their sequence numbers, and from there on a repetition only finishes the
renames; before it, staging starts over and no number has been given out.
"""

from __future__ import annotations

import bisect
import json
import math
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import naming
from tidemark.functions.convert import Units
from tidemark.functions.envelope import MARKER_COLUMN
from tidemark.operators.project import convertible, refused_rows
from tidemark.plans.files import Files
from tidemark.sources.catalog import TableSpec

STAGING = "_staging"
QUARANTINE = "_quarantine"
RENAME_THREADS = 16
#: A table of less event text is converted in the task that writes its one file.
ONE_TASK_BYTES = 4_000_000
#: Small files of a large table share a range, which one task writes; a range aims at so many rows and bytes of text.
RANGE_ROWS = 1_000_000
RANGE_BYTES = 128_000_000


@dataclass(frozen=True)
class LandingOptions:
    base: str
    marker: str = MARKER_COLUMN
    compression: str | None = "SNAPPY"
    max_records_per_file: int = 1_000_000
    max_bytes_per_file: int | None = None  # of event text; Parquet files of it are smaller as a rule
    state_file: str = naming.STATE_FILE
    units: Units = Units()


@dataclass(frozen=True)
class Unit:
    """One table of one batch: where its manifest and its staged files lie."""

    folder: str
    batch: str  # unique per stream and batch
    state_dir: str  # beside the checkpoint

    @property
    def manifest(self) -> str:
        return f"{self.state_dir}/{self.key}.json"

    @property
    def done(self) -> str:
        return f"{self.state_dir}/{self.key}.done"

    @property
    def key(self) -> str:
        return re.sub(r"[^A-Za-z0-9_-]", lambda m: f"%{ord(m.group()):x}", self.folder)


@dataclass(frozen=True)
class TableSize:
    """Counted events of one table: rows, bytes of text, the widest of them, updates."""

    rows: int
    bytes: int = 0
    widest: int = 0
    updates: int = 0


def restore_sequence(files: Files, base: str, folder: str, state_file: str = naming.STATE_FILE) -> int:
    """Last sequence of a table: its state file, or the highest file name without a readable one."""
    last = naming.parse_state(files.read_text(f"{base}/{folder}/{state_file}"))
    return scan_sequence(files, base, folder) if last is None else last


def scan_sequence(files: Files, base: str, folder: str) -> int:
    return max((naming.file_sequence(n) or 0 for n in files.names(f"{base}/{folder}")), default=0)


def commit_sequence(files: Files, base: str, folder: str, last: int, state_file: str = naming.STATE_FILE) -> None:
    files.write_text(f"{base}/{folder}/{state_file}", str(last))


def first_free_sequence(files: Files, base: str, folder: str, state_file: str = naming.STATE_FILE) -> int:
    """Next number; a state file that lags behind the files never leads to a taken name."""
    following = restore_sequence(files, base, folder, state_file) + 1
    if files.exists(f"{base}/{folder}/{naming.sequence_file(following)}"):
        following = scan_sequence(files, base, folder) + 1
    return following


def write_key_metadata(files: Files, base: str, folder: str, spec: TableSpec) -> None:
    text = naming.key_metadata(spec.keys)
    path = f"{base}/{folder}/{naming.METADATA_FILE}"
    if files.read_text(path) != text:
        files.write_text(path, text)


def file_count(size: TableSize, options: LandingOptions) -> int:
    """Files to aim at. Ranges are cut by a summary of positions, so several of them aim below the limits."""
    share = size.rows / options.max_records_per_file
    if options.max_bytes_per_file:
        share = max(share, size.bytes / options.max_bytes_per_file)
    return 1 if share <= 1 else math.ceil(share / 0.9)


def range_count(size: TableSize, options: LandingOptions, tasks: int) -> int:
    """Ranges for the ordered write: one for each file as long as there are few, else enough for all ``tasks`` and for the data.

    Each range is a task and a branch of the expression that deals rows, so their number follows the data and not the limits of files.
    """
    enough = max(tasks, math.ceil(size.rows / RANGE_ROWS / 0.9), math.ceil(size.bytes / RANGE_BYTES))
    return min(file_count(size, options), enough)


def position_cuts(events: DataFrame, parts: int) -> list[int]:
    """Positions that cut the events into ``parts`` ranges of about equal counts, taken before any conversion.

    A position that holds several ranges' rows is named several times.
    """
    if parts < 2:
        return []
    at = F.lit([i / parts for i in range(1, parts)]).cast("array<double>")
    return events.agg(F.percentile_approx("pos", at, F.lit(max(10_000, 20 * parts))).alias("cuts")).first().cuts or []


def range_number(pos: Column, tie: Column, cuts: list[int]) -> Column:
    """The range of a row, found by halving the cuts. Ranges rise with ``(pos, tie)``.

    ``tie`` is a whole number from 0 to 2**63 - 1. Where several cuts name one position, its rows are spread over
    the ranges between them by even shares of the tie.
    """
    steps = sorted(set(cuts))

    def within(low: int, high: int) -> Column:  # positions from steps[low - 1] on and below steps[high]
        if low == high:
            first = bisect.bisect_left(cuts, steps[low - 1]) if low else 0
            following = bisect.bisect_right(cuts, steps[low - 1]) if low else 0
            if following - first == 1 or not low:
                return F.lit(following)
            share = F.least((tie / 2.0**63 * (following - first + 1)).cast("int"), F.lit(following - first))
            return F.when(pos == steps[low - 1], F.lit(first) + share).otherwise(F.lit(following))
        middle = (low + high) // 2
        return F.when(pos < steps[middle], within(low, middle)).otherwise(within(middle + 1, high))

    return F.when(pos.isNull(), F.lit(0)).otherwise(within(0, len(steps))).cast("int")


def write_ordered(rows: DataFrame, target: str, size: TableSize, cuts: list[int], options: LandingOptions) -> int:
    """Write ``row`` in ``pos`` order across and within files.

    Rows go to the ranges between ``cuts``, each to its own task, which writes one file or several. Rows that share a position
    are spread by a hash of their content, so a position with many rows does not end up in one task. Where the table has more
    bytes than a file may, files are cut at running sums of rows and bytes. Returns the number of rows.
    """
    limit = options.max_bytes_per_file
    by_bytes = bool(limit) and size.bytes > limit
    tie = F.call_function("shiftrightunsigned", F.xxhash64("row"), F.lit(1))
    dealt = rows.select("pos", tie.alias("tie"), "row", *(["size"] if by_bytes else []))
    dealt = dealt.withColumn("range", range_number(F.col("pos"), F.col("tie"), cuts))
    dealt = dealt.coalesce(1) if not cuts and size.bytes < ONE_TASK_BYTES and not by_bytes else dealt.repartitionById(len(cuts) + 1, "range")
    if by_bytes:
        before = Window.partitionBy("range").orderBy("pos", "tie").rowsBetween(Window.unboundedPreceding, -1)
        # a row above half the limit has a file of its own; of the others a file that starts below its room ends below the limit,
        # with a twentieth of it left for what Parquet adds to text that does not compress
        room, wide = max(1, limit - limit // 20 - min(size.widest, limit // 2)), F.when(F.col("size") > limit // 2, 1).otherwise(0)
        n, done, apart = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in (F.lit(1), F.col("size"), wide))
        file = F.floor(n / options.max_records_per_file) + F.floor(done / room) + 2 * apart + wide
        dealt = dealt.withColumn("file", file).sortWithinPartitions("range", "file", "pos", "tie").select("range", "file", "row.*")
    else:
        dealt = dealt.sortWithinPartitions("pos", "tie").select("row.*")
    counted = Observation()
    dealt = dealt.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = dealt.write.mode("overwrite").option("compression", naming.codec(options.compression))
    if by_bytes:
        writer.partitionBy("range", "file").parquet(target)
    else:
        writer.option("maxRecordsPerFile", options.max_records_per_file).parquet(target)
    return counted.get["rows"]


def land_table(
    projected: DataFrame,
    unit: Unit,
    spec: TableSpec,
    options: LandingOptions,
    size: TableSize,
    events: DataFrame,
    on_step: Callable[[str, str], None] = lambda step, folder: None,
) -> dict:
    """Land projected rows of one table; returns the manifest with the files and their row counts.

    ``events`` are the same rows before conversion; only their positions are read, to cut ranges.
    """
    spark = projected.sparkSession
    base, folder = options.base, unit.folder
    files, state = Files(spark, base), Files(spark, unit.state_dir)
    staging = f"{base}/{STAGING}/{unit.batch}/{unit.key}"

    text = state.read_text(unit.manifest)
    if text is None:
        write_key_metadata(files, base, folder, spec)
        staged = _stage(projected, unit, options, size, events, staging, files)
        on_step("staged", folder)
        first = first_free_sequence(files, base, folder, options.state_file)
        text = json.dumps({"folder": folder, "first": first, "files": staged})
        state.write_text_once(unit.manifest, text)
        on_step("planned", folder)
    manifest = json.loads(text)
    if state.exists(unit.done):
        return manifest

    _publish(files, manifest, staging, f"{base}/{folder}", lambda: on_step("renamed", folder))
    on_step("published", folder)
    if manifest["files"]:
        last = manifest["first"] + len(manifest["files"]) - 1
        # A later batch may have moved the state on already when an old one is repeated.
        if (naming.parse_state(files.read_text(f"{base}/{folder}/{options.state_file}")) or 0) < last:
            commit_sequence(files, base, folder, last, options.state_file)
    on_step("committed", folder)
    state.mark(unit.done)
    files.delete(staging, up_to=f"{base}/{STAGING}")
    return manifest


def _stage(
    projected: DataFrame, unit: Unit, options: LandingOptions, size: TableSize, events: DataFrame, staging: str, files: Files
) -> list:
    """Write the good rows to staging and the others to the quarantine; returns the staged files."""
    cuts = position_cuts(events, range_count(size, options, events.sparkSession.sparkContext.defaultParallelism))
    written = write_ordered(convertible(projected), staging, size, cuts, options)
    staged = _staged_files(projected.sparkSession, files, staging, written)
    if sum(n for _, n in staged) < size.rows:
        target = f"{options.base}/{QUARANTINE}/{unit.batch}/{unit.key}"
        refused_rows(projected, unit.folder, options.marker).write.mode("overwrite").parquet(target)
    return staged


def _staged_files(spark: SparkSession, files: Files, staging: str, written: int) -> list:
    """Staged files in row order with their row counts; of several files the footers tell them."""

    def place(name: str) -> tuple[int, ...]:
        folders = tuple(int(n) for n in re.findall(r"(?:range|file)=(\d+)/", name))
        part, chunk = re.search(r"part-(\d+)-.*[.-]c(\d+)[.]", name).groups()
        return (*folders, int(part), int(chunk))

    names = [n for n in files.tree(staging) if n.endswith(naming.SUFFIX)]
    if len(names) < 2 or not written:
        return [[n, written] for n in names if written]
    every = spark.read.option("recursiveFileLookup", "true").parquet(staging)
    name = F.substring_index("_metadata.file_path", "/", -1 - names[0].count("/"))
    counts = dict(every.groupBy(name.alias("name")).count().collect())
    return [[n, counts[n]] for n in sorted((n for n in names if n in counts), key=place)]


def _publish(files: Files, manifest: dict, staging: str, folder: str, renamed: Callable[[], None]) -> None:
    """Rename staged files to their numbers.

    A file leaves staging only by its rename, so one that is gone has been published, even if a
    consumer has removed it from the landing folder since.
    """
    if not files.exists(staging):
        raise FileNotFoundError(staging)

    def move(item: tuple[int, list]) -> None:
        offset, (name, _) = item
        source = f"{staging}/{name}"
        if files.exists(source):
            files.rename(source, f"{folder}/{naming.sequence_file(manifest['first'] + offset)}")
            renamed()

    with ThreadPoolExecutor(RENAME_THREADS) as pool:
        list(pool.map(move, enumerate(manifest["files"])))
