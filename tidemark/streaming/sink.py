"""The ``foreachBatch`` sink: one micro-batch of events into many landing folders."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.decode import DIGESTS, decode_events, document_text, refused
from tidemark.operators.lookup import fill_from_snapshot
from tidemark.operators.project import project_rows
from tidemark.operators.resolve import UNKNOWN_TABLE, events_of
from tidemark.plans.files import Files
from tidemark.plans.landing import QUARANTINE, STAGING, LandingOptions, TableSize, Unit, land_table
from tidemark.session import prepare
from tidemark.sources.catalog import Catalog, TableSpec
from tidemark.sources.history import TableHistory, entry_from_dict, project_versions
from tidemark.streaming.segments import Flush, FlushPolicy, Ledger, Segment, read_segments, split, total_size

TRIGGER_SECONDS = 10
SPLIT = "split"
#: Up to so many tables filter the cached batch; more are split by one pass over it.
FILTERED_TABLES = 4


class BatchMismatch(ValueError):
    """A batch number is used again for other events; landing them under it would lose them."""


@dataclass
class LandingSink:
    """Lands micro-batches under ``options.base``; give it to ``foreachBatch``, or use :meth:`land_batch`.

    ``checkpoint`` is the stream's own checkpoint folder: what a repeated batch must not decide anew
    (catalog, sequence numbers) is kept beside it. One stream owns one base folder.
    ``snapshots`` names, per ``SCHEMA.TABLE``, how to read the current rows for updates without an image.

    With ``flush`` a table's events wait as stored segments until there are enough of them or they are old
    enough, so many small batches make few files. With ``keep_failed`` a table that cannot be landed does not fail the
    batch: its events wait in order and are tried again with the next batch. With ``drop_replays`` events at or below the
    highest position landed of their topic and ``partition`` are left out, and so are copies within a batch.

    ``copies`` are further zones where the same rows land, with a codec and limits of their own: events are decoded and
    converted once for all zones. Events that cannot be decoded or have no table are put aside under ``options.base`` alone.
    """

    options: LandingOptions
    checkpoint: str
    catalog: Callable[[], Catalog]
    prefix: str = ""
    tombstones: str = "delete"
    lookup_updates: bool = True
    snapshots: Mapping[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    parallel_tables: int = 8
    on_step: Callable[[str, str], None] = lambda step, folder: None
    flush: FlushPolicy | None = None
    keep_failed: bool = False
    drop_replays: bool = False
    clock: Callable[[], float] = time.time
    copies: tuple[LandingOptions, ...] = ()
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False, compare=False)

    def __post_init__(self) -> None:
        zones = (self.options, *self.copies)
        if len({z.base for z in zones}) < len(zones) or any((z.units, z.marker) != (zones[0].units, zones[0].marker) for z in zones):
            raise ValueError("each copy needs a base of its own, and the units and the marker of the options")

    def __call__(self, events: DataFrame, batch_id: int | str) -> dict[str, dict]:
        """Land one batch; returns each landed table's manifest with its files and their row counts.

        A number belongs to the events it was first used for: the same events again finish or change
        nothing, other events raise :class:`BatchMismatch`.
        """
        with self._lock:
            return self._take(events, batch_id)

    def _take(self, events: DataFrame, batch_id: int | str) -> dict[str, dict]:
        spark = prepare(events.sparkSession)
        state = Files(spark, self.checkpoint)
        root = self._root
        batch_dir = f"{root}/{batch_id}"
        batch = f"run={_run_id(state, root)}/batch={batch_id}"
        ledger = Ledger(state, root)
        self._finish(spark, ledger)
        if self.drop_replays:
            events = without_replays(events, self._marks(state, batch_dir))
        decoded = decode_events(events, self.prefix, self.tombstones, digests=True).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        try:
            counts = _counts(decoded)
            _bind(state, f"{batch_dir}/input.json", counts, batch_id, decoded)
            self.on_step("decoded", "")
            specs = _frozen_specs(state, f"{batch_dir}/catalog.json", [c.folder for c in counts], self.catalog)
            self._quarantine(decoded, counts, specs, batch)
            self.on_step("quarantined", "")
            sizes = {c.folder: TableSize(c.good, c.bytes, c.widest, c.updates) for c in counts if c.folder in specs and c.good}
            if self.flush or self.keep_failed:
                landed = self._buffer(decoded, sizes, specs, batch, batch_dir, ledger)
            else:
                landed = self._land_all(decoded, sizes, specs, batch, batch_dir, batch_id)
            if self.drop_replays:
                self._raise_marks(state, decoded)
            return landed
        finally:
            decoded.unpersist()

    @property
    def _root(self) -> str:
        return f"{self.checkpoint}/landing"

    def _land_all(self, decoded: DataFrame, sizes: dict, specs: dict, batch: str, batch_dir: str, batch_id) -> dict[str, dict]:
        """Land every table of the batch at once. Few tables filter the cached batch, many are split first."""
        spark = decoded.sparkSession
        apart = f"{self.options.base}/{STAGING}/{batch}/{SPLIT}"
        paths: dict[str, str] = {}
        if len(sizes) > FILTERED_TABLES:
            paths = split(decoded, sizes, apart)
            self.on_step("split", "")

        def land(folder: str) -> dict:
            if folder in paths:
                rows = read_segments(spark, [Segment(folder, paths[folder], 0, 0, 0, 0, 0.0)])
            else:
                rows = decoded.filter((F.col("folder") == folder) & F.col("reason").isNull())
            return self._land(rows, sizes[folder], specs[folder], Unit(folder, batch, batch_dir))

        landed, errors = self._each({f: lambda f=f: land(f) for f in sizes})
        if errors:
            raise ExceptionGroup(f"batch {batch_id}: {len(errors)} of {len(sizes)} tables failed", list(errors.values()))
        if paths:
            Files(spark, self.options.base).delete(apart, up_to=f"{self.options.base}/{STAGING}")
        return landed

    def _each(self, jobs: dict[str, Callable[[], dict]]) -> tuple[dict[str, dict], dict[str, Exception]]:
        with ThreadPoolExecutor(self.parallel_tables) as pool:
            running = {f: pool.submit(job) for f, job in jobs.items()}
        errors = {f: e for f, j in running.items() if (e := j.exception())}
        return {f: j.result() for f, j in running.items() if f not in errors}, errors

    def _buffer(self, decoded: DataFrame, sizes: dict, specs: dict, batch: str, batch_dir: str, ledger: Ledger) -> dict[str, dict]:
        """Store the batch as segments, once, and land what is due."""
        spark, state = decoded.sparkSession, ledger.state
        if state.exists(f"{batch_dir}/taken"):
            return {}
        paths = split(decoded, sizes, f"{self.options.base}/{STAGING}/{batch}/{SPLIT}")
        self.on_step("split", "")
        now = self.clock()
        new = [Segment(f, paths[f], s.rows, s.bytes, s.widest, s.updates, now) for f, s in sizes.items()]
        return self._plan_and_finish(spark, ledger, new, specs, batch, batch_dir, f"{batch_dir}/taken")

    def _plan_and_finish(
        self, spark: SparkSession, ledger: Ledger, new: list[Segment], specs: dict, batch: str, batch_dir: str, taken: str, all_due: bool = False
    ) -> dict[str, dict]:
        """Fix which waiting segments land now, and land them."""
        failed, loose = ledger.waiting()
        loose += new
        now, known = self.clock(), dict(specs)
        if failed:  # what has not been given numbers is tried with the catalog of today
            current = self.catalog()
            failed = [f if ledger.state.exists(f.unit.manifest) else replace(f, spec=current.get(f.spec.name, f.spec)) for f in failed]
        due = []
        for folder in sorted({s.folder for s in loose}):
            mine = [s for s in loose if s.folder == folder]
            if not (all_due or self.flush is None or self.flush.is_due(mine, now)):
                continue
            spec = known.get(folder) or self.catalog().get(_catalog_name(folder))
            if spec:
                due.append(Flush(Unit(folder, batch, batch_dir), tuple(mine), spec))
        taken_up = {s.path for f in due for s in f.segments}
        if not failed and not due and not new:
            return {}
        ledger.open_plan(batch, failed + due, [s for s in loose if s.path not in taken_up], taken=taken)
        self.on_step("fixed", "")
        return self._finish(spark, ledger)

    def _finish(self, spark: SparkSession, ledger: Ledger) -> dict[str, dict]:
        """Land the flushes of the open plan, if there is one. A table's flushes land in their order."""
        plan = ledger.plan()
        if plan is None:
            return {}
        by_table: dict[str, list[Flush]] = {}
        for data in plan["flushes"]:
            flush = Flush.from_dict(data)
            by_table.setdefault(flush.unit.folder, []).append(flush)
        left: dict[str, list[Flush]] = {f: list(v) for f, v in by_table.items()}
        manifests: dict[str, list[dict]] = {f: [] for f in by_table}

        def land(folder: str) -> dict:
            for flush in by_table[folder]:
                rows = read_segments(spark, flush.segments) if not ledger.state.exists(flush.unit.done) else None
                manifests[folder].append(self._land(rows, total_size(flush.segments), flush.spec, flush.unit, spark))
                left[folder].pop(0)
            return _joined(manifests[folder])

        landed, errors = self._each({f: lambda f=f: land(f) for f in by_table})
        if errors and not self.keep_failed:
            raise ExceptionGroup(f"{plan['batch']}: {len(errors)} of {len(by_table)} tables failed", list(errors.values()))
        failed = [replace(f, failed=f.failed + 1, error=str(errors[t])[:500]) if f is left[t][0] else f for t in errors for f in left[t]]
        gone = [s.path for fs in by_table.values() for f in fs if f not in (x for t in errors for x in left[t]) for s in f.segments]
        self.on_step("flushed", "")
        if plan["taken"]:
            ledger.state.mark(plan["taken"])
        ledger.close_plan(failed, plan)
        files = Files(spark, self.options.base)
        for path in gone:
            files.delete(path, up_to=f"{self.options.base}/{STAGING}")
        return landed | {f: _joined(manifests[f]) for f in errors if manifests[f]}

    def flush_due(self, spark: SparkSession, everything: bool = False) -> dict[str, dict]:
        """Land waiting segments that are due by now, or all of them, without a new batch; failed ones are tried again."""
        with self._lock:
            prepare(spark)
            state = Files(spark, self.checkpoint)
            ledger = Ledger(state, self._root)
            self._finish(spark, ledger)
            if self.flush is None and not self.keep_failed:
                return {}
            name = f"flush-{uuid.uuid4().hex}"
            batch = f"run={_run_id(state, self._root)}/batch={name}"
            return self._plan_and_finish(spark, ledger, [], {}, batch, f"{self._root}/{name}", "", everything)

    def waiting(self, spark: SparkSession) -> dict[str, dict]:
        """Per table what has not landed: rows, failed attempts and the last error."""
        failed, loose = Ledger(Files(spark, self.checkpoint), self._root).waiting()
        held: dict[str, dict] = {}
        for folder, segments, attempts, error in [*((f.unit.folder, f.segments, f.failed, f.error) for f in failed), *((s.folder, (s,), 0, "") for s in loose)]:
            entry = held.setdefault(folder, {"rows": 0, "failed": 0, "error": ""})
            entry["rows"] += sum(s.rows for s in segments)
            entry["failed"] = max(entry["failed"], attempts)
            entry["error"] = entry["error"] or error
        return held

    def land_batch(self, events: DataFrame) -> dict[str, dict]:
        """Land ``events`` under the next number of their own, apart from the stream's.

        The number moves on once all tables have landed, so after a failure the same events are given again.
        """
        state = Files(events.sparkSession, self.checkpoint)
        path = f"{self._root}/next_batch.txt"
        number = int(state.read_text(path) or 0)
        landed = self(events, f"own-{number}")
        state.write_text(path, str(number + 1))
        return landed

    def replay_unknown(self, spark: SparkSession) -> dict[str, dict]:
        """Land quarantined events of tables that the catalog has by now, each once.

        To keep their order they must be replayed before later events of their tables land. What is replayed is
        written down first, so a repeated call after a failure finishes the same batch.
        """
        prepare(spark)
        state, root = Files(spark, self.checkpoint), self._root
        plan_path, done_path = f"{root}/replaying.json", f"{root}/replayed.json"
        done = json.loads(state.read_text(done_path) or "[]")
        held = _quarantined(spark, f"{self.options.base}/{QUARANTINE}")
        if held is None:
            return {}
        text = state.read_text(plan_path)
        if text is None:
            specs = self.catalog()
            pairs = [[r.folder, r.batch] for r in held.select("folder", "batch").distinct().collect()]
            pairs = sorted(p for p in pairs if p not in done and _catalog_name(p[0]) in specs)
            if not pairs:
                return {}
            text = json.dumps({"batch": f"replay-{len(done)}", "pairs": pairs})
            state.write_text_once(plan_path, text)
        plan = json.loads(text)
        wanted = spark.createDataFrame([tuple(p) for p in plan["pairs"]], "folder STRING, batch STRING")
        events = held.join(F.broadcast(wanted), ["folder", "batch"], "left_semi")  # one row per table and batch
        # what was put aside has passed the marks already
        landed = replace(self, drop_replays=False)(events.select("topic", "key", "value", "pos"), plan["batch"])
        state.write_text(done_path, json.dumps(done + [p for p in plan["pairs"] if p not in done]))
        state.delete(plan_path)
        return landed

    def _land(self, rows: DataFrame | None, size: TableSize, spec: TableSpec | TableHistory, unit: Unit, spark: SparkSession | None = None) -> dict:
        options = self.options
        if rows is None:  # landed already
            return json.loads(Files(spark, unit.state_dir).read_text(unit.manifest))
        if isinstance(spec, TableHistory):
            projected = project_versions(rows, spec, options.units, options.marker, self.lookup_updates)
            spec = spec.landing_spec()
        else:
            projected = project_rows(rows, spec, options.units, options.marker, self.lookup_updates)
        read = self.snapshots.get(spec.name)
        if self.lookup_updates and size.updates and read:
            projected = fill_from_snapshot(projected, read(rows.sparkSession), spec, options.marker)
        if not self.copies:
            return land_table(projected, unit, spec, options, size, rows, self.on_step)
        projected = projected.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for copy in self.copies:  # before the unit itself: where that is done, all are
                beside = replace(unit, state_dir=f"{unit.state_dir}/copy={uuid.uuid5(uuid.NAMESPACE_URL, copy.base).hex}")
                land_table(projected, beside, spec, copy, size, rows, self.on_step)
            return land_table(projected, unit, spec, options, size, rows, self.on_step)
        finally:
            projected.unpersist()

    def _quarantine(self, decoded: DataFrame, counts: list, specs: dict, batch: str) -> None:
        unknown = [c.folder for c in counts if c.folder not in specs]
        if not any(c.bad or c.folder in unknown for c in counts):
            return
        homeless = events_of(decoded.filter(F.col("reason").isNull()), unknown).select(
            "pos", "topic", "folder", "reason", "marker", *document_text()
        )
        target = f"{self.options.base}/{QUARANTINE}/{batch}/undecoded"
        refused(decoded).unionByName(homeless).write.mode("overwrite").parquet(target)

    def _marks(self, state: Files, batch_dir: str) -> list[list]:
        """The highest positions landed before this batch: topic, partition, position; one entry per partition."""
        path = f"{batch_dir}/marks.json"
        text = state.read_text(path)
        if text is None:
            text = state.read_text(f"{self._root}/marks.json") or "[]"
            state.write_text_once(path, text)
        return json.loads(text)

    def _raise_marks(self, state: Files, decoded: DataFrame) -> None:
        path = f"{self._root}/marks.json"
        marks = {(t, p): at for t, p, at in json.loads(state.read_text(path) or "[]")}
        number = F.coalesce("partition", F.lit(0)) if "partition" in decoded.columns else F.lit(0)
        for r in decoded.groupBy("topic", number.alias("partition")).agg(F.max("pos").alias("pos")).collect():
            if r.pos is not None:
                marks[r.topic, r.partition] = max(r.pos, marks.get((r.topic, r.partition), r.pos))
        state.write_text(path, json.dumps(sorted(([t, p, at] for (t, p), at in marks.items()), key=str)))


def without_replays(events: DataFrame, marks: list[list]) -> DataFrame:
    """Events above the mark of their topic and partition, each once.

    Only topics, partitions and positions are shuffled to find copies within the batch; events are only if there
    are any. Events without a position stay.
    """
    spark = events.sparkSession
    if "partition" not in events.columns:
        events = events.withColumn("partition", F.lit(0))
    place = ["topic", "partition", "pos"]
    given = spark.createDataFrame([tuple(m) for m in marks], "_topic STRING, _partition INT, _mark BIGINT")
    same = F.col("topic").eqNullSafe(F.col("_topic")) & (F.coalesce("partition", F.lit(0)) == F.col("_partition"))
    fresh = events.join(F.broadcast(given), same & (F.col("pos") <= F.col("_mark")), "left_anti")  # a row per partition of a topic
    placed = fresh.filter("pos is not null")
    if placed.groupBy(*place).count().filter("count > 1").isEmpty():
        return fresh
    return placed.dropDuplicates(place).unionByName(fresh.filter("pos is null"))


def start_landing(
    events: DataFrame, sink: LandingSink, available_now: bool = False, seconds: float = TRIGGER_SECONDS
) -> StreamingQuery:
    """Start landing a stream: every ``seconds``, or until the present input is drained.

    A stream without new input has no batches, so a sink that lets events wait is asked every ``seconds`` whether
    some have become due; at the end of its input a drained stream leaves what waits to :meth:`LandingSink.flush_due`.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    query = (
        events.writeStream.foreachBatch(sink)
        .option("checkpointLocation", sink.checkpoint)
        .trigger(**trigger)
        .start()
    )
    if sink.flush and not available_now:
        threading.Thread(target=_watch, args=(query, sink, events.sparkSession, seconds), daemon=True).start()
    return query


def _watch(query: StreamingQuery, sink: LandingSink, spark: SparkSession, seconds: float) -> None:
    while query.isActive:
        time.sleep(seconds)
        if query.isActive:
            sink.flush_due(spark)


def _joined(manifests: list[dict]) -> dict:
    """One table's manifests of a batch as one: they follow each other in numbers."""
    return manifests[0] | {"files": [f for m in manifests for f in m["files"]]}


def _counts(decoded: DataFrame) -> list:
    """Per table folder: decodable events, undecodable ones and updates, and the good ones' text.

    One row per table reaches the driver.
    """
    good = F.col("reason").isNull()
    size = F.when(good, F.col("size"))
    return (
        decoded.groupBy("folder")
        .agg(
            F.count_if(good).alias("good"),
            F.count_if(~good).alias("bad"),
            F.count_if(good & (F.col("op") == "u")).alias("updates"),
            F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
            F.coalesce(F.max(size), F.lit(0)).alias("widest"),
            F.concat_ws(":", *[F.sum(F.col(d).cast("decimal(20,0)")) for d in DIGESTS]).alias("fingerprint"),
        )
        .collect()
    )


def _bind(state: Files, path: str, counts: list, batch_id: int | str, decoded: DataFrame) -> None:
    """Bind a batch number to its events: counts and sums of the hashes of whole events, per table.

    Numbers bound before whole events were hashed have a whole number as their fingerprint; only then is it computed.
    """
    seen = sorted([c.folder or "", c.good, c.bad, c.fingerprint] for c in counts)
    text = state.read_text(path)
    if text is None:
        state.write_text_once(path, json.dumps(seen))
        return
    bound = json.loads(text)
    if any(isinstance(b[3], int) for b in bound):
        older = decoded.groupBy("folder").agg(F.bit_xor(F.xxhash64("topic", "pos", "marker", "op")).alias("x")).collect()
        prints = {r.folder: r.x for r in older}
        seen = sorted([c.folder or "", c.good, c.bad, prints[c.folder]] for c in counts)
    if bound != seen:
        raise BatchMismatch(f"batch {batch_id} has landed other events before")


def _quarantined(spark: SparkSession, folder: str) -> DataFrame | None:
    """Events of unknown tables with the batch that put them aside; None where nothing was."""
    try:
        rows = spark.read.parquet(f"{folder}/run=*/batch=*/undecoded")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    batch = F.regexp_extract("_metadata.file_path", "(run=[^/]+/batch=[^/]+)/undecoded/", 1)
    return rows.filter(F.col("reason") == UNKNOWN_TABLE).withColumn("batch", batch)


def _run_id(state: Files, root: str) -> str:
    """Identity of the checkpoint: a new one starts its batch numbers over."""
    path = f"{root}/run.txt"
    run = state.read_text(path)
    if run is None:
        run = uuid.uuid4().hex
        state.write_text_once(path, run)
    return run


def _frozen_specs(state: Files, path: str, folders: list[str], catalog: Callable[[], Catalog]) -> dict:
    """The batch's tables as its first attempt saw them."""
    text = state.read_text(path)
    if text is None:
        specs = catalog()
        seen = {f: specs[n] for f in folders if (n := _catalog_name(f)) in specs}
        text = json.dumps({f: s.to_dict() for f, s in seen.items()})
        state.write_text_once(path, text)
    return {f: entry_from_dict(s) for f, s in json.loads(text).items()}


def _catalog_name(folder: str) -> str:
    schema, infix, table = folder.partition(".schema/")
    return (f"{schema}.{table}" if infix and schema else f"{folder}.{folder}").upper()
