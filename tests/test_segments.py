"""Splitting a batch by table, ranges and limits of files, waiting, failing and replayed events."""

import collections
import json
import os
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_landing import EMPLOYEES, FOLDER, THREE, feed, sink, visible
from tidemark.plans import fixtures as X
from tidemark.plans import landing as L
from tidemark.plans.files import Files
from tidemark.plans.queries import QUERIES, spread_orders
from tidemark.sources.catalog import ColumnSpec, TableSpec
from tidemark.sources.events import read_events, stream_events
from tidemark.sources.landing import read_landing
from tidemark.streaming import segments as S
from tidemark.streaming import sink as sinks
from tidemark.streaming.segments import FlushPolicy
from tidemark.streaming.sink import start_landing, without_replays

SF = "/root/testdata/sf0.001"


def test_tasks_are_allotted_by_bytes():
    r = random.Random(1)
    for tasks in (1, 8, 200):
        sizes = {f"t{i}": r.choice([10, 1000, 5_000_000, 90_000_000, 3_000_000_000]) for i in range(r.randint(1, 300))}
        placed = S.allot(sizes, tasks)
        share = min(max(sum(sizes.values()) // tasks, S.TASK_BYTES_MIN), S.TASK_BYTES_MAX)
        load, used = {}, set()
        for table, (first, n) in placed.items():
            assert n == (1 if sizes[table] <= share else -(-sizes[table] // share))
            assert n == 1 or not used & set(range(first, first + n))
            used |= set(range(first, first + n))
            load[first] = load.get(first, 0) + sizes[table] / n
        assert set(placed) == set(sizes) and used == set(range(max(used) + 1))
        assert max(load.values()) <= share
    assert S.allot({}, 8) == {}


def test_short_rows_have_their_share_of_the_tasks(spark, monkeypatch):
    """A row costs its conversion however short its text is."""
    given = {}
    monkeypatch.setattr(S, "allot", lambda sizes, tasks: given.update(sizes) or {})
    S.split(spark.range(0), {"short": L.TableSize(300_000, 12_000_000), "long": L.TableSize(100_000, 20_000_000)}, "")
    assert given["short"] > given["long"]


def test_ranges_rise_with_position_and_tie(spark):
    r = random.Random(2)
    rows = sorted([(p, t) for p in [5] * 4000 + list(range(2000)) for t in [r.randrange(1 << 63)]])
    df = spark.createDataFrame(rows, "pos long, tie long")
    cuts = L.position_cuts(df, 12)
    assert len(cuts) == 11 and cuts.count(5) > 3
    got = [x.n for x in df.withColumn("n", L.range_number(F.col("pos"), F.col("tie"), cuts)).orderBy("pos", "tie").select("n").collect()]
    assert got == sorted(got)
    sizes = [got.count(i) for i in range(12)]
    assert min(sizes) > 250 and max(sizes) < 1100  # the range behind the shared position takes the rest of its rows and its own
    odd = spark.createDataFrame([(None, 3), (7, 0)], "pos long, tie long").select(L.range_number(F.col("pos"), F.col("tie"), [7, 7, 9]).alias("n"))
    assert [x.n for x in odd.collect()] == [0, 0]
    assert L.position_cuts(df.limit(0), 5) == []


def test_each_value_is_converted_once_whatever_the_number_of_files(spark, home):
    """The conversions stand in one job's plan only; ranges are cut from raw positions."""
    X.order_events(spark, SF).write.parquet(f"{home}/events")
    events = read_events(spark, f"{home}/events")
    for limit in (10**6, 200):
        target = sink(f"{home}/{limit}", X.ORDERS, max_records_per_file=limit)
        store = spark._jsparkSession.sharedState().statusStore()
        before = store.executionsCount()
        target(events, 0)
        plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
        assert sum("try_variant_get" in p and "InsertIntoHadoopFsRelationCommand" in p for p in plans) == 2  # the landing and the quarantine of undecoded events
        assert not any("rangepartitioning" in p for p in plans)


def executions_over_the_batch(spark, n_tables, home):
    events, specs = spread_orders(spark, SF)
    events = events.filter(F.substring_index("topic", "_", -1).cast("int") < n_tables)
    target = sink(home, *specs)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    landed = target(events, 0)
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
    return len(landed), sum("InMemoryTableScan" in p for p in plans)


def test_a_batch_of_many_tables_is_scanned_as_often_as_one_of_few(spark, home):
    few, scans_of_few = executions_over_the_batch(spark, 6, f"{home}/a")
    many, scans_of_many = executions_over_the_batch(spark, 60, f"{home}/b")
    assert few <= 6 and many > 45
    assert scans_of_few == scans_of_many <= 3


def test_files_of_wide_rows_end_at_the_byte_limit(spark, home):
    r = random.Random(4)
    rows = [("c", None, {"EMPLOYEE_ID": i, "LAST_NAME": "".join(r.choice("abcdefghijklmnop") for _ in range(r.choice([10, 10, 3000, 20_000])))}) for i in range(400)]
    target = sink(home, EMPLOYEES, max_bytes_per_file=60_000, max_records_per_file=50)
    manifest = target(feed(spark, rows), 0)[FOLDER]
    assert sum(n for _, n in manifest["files"]) == 400 and max(n for _, n in manifest["files"]) <= 50
    folder = f"{home}/zone/{FOLDER}"
    assert max(os.path.getsize(f"{folder}/{n}") for n in visible(folder) if n.endswith(".parquet")) <= 60_000
    back = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).orderBy("file_sequence", "row_index").select("EMPLOYEE_ID").collect()
    assert [x.EMPLOYEE_ID for x in back] == list(range(400))
    # one row above the limit has a file of its own
    wide = sink(f"{home}/w", EMPLOYEES, max_bytes_per_file=100)
    assert len(wide(feed(spark, THREE), 0)[FOLDER]["files"]) == 3


def test_a_row_above_the_byte_limit_leaves_the_other_files_as_they_are(spark, home):
    wide = {7, 8, 150}
    rows = [("c", None, {"EMPLOYEE_ID": i, "LAST_NAME": "x" * (80_000 if i in wide else 500)}) for i in range(200)]
    files = sink(home, EMPLOYEES, max_bytes_per_file=20_000)(feed(spark, rows), 0)[FOLDER]["files"]
    assert sum(n for _, n in files) == 200 and len(files) < 60
    back = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).orderBy("file_sequence", "row_index").collect()
    assert [x.EMPLOYEE_ID for x in back] == list(range(200))
    held = collections.Counter(x.file_sequence for x in back)
    assert all(held[x.file_sequence] == 1 for x in back if x.EMPLOYEE_ID in wide)


def test_ranges_follow_the_data_and_not_the_number_of_files(spark, home):
    small = L.LandingOptions("", max_records_per_file=2_000, max_bytes_per_file=250_000)
    assert L.range_count(L.TableSize(1_500, 200_000), small, 8) == 1
    assert L.range_count(L.TableSize(9_000, 200_000), small, 8) == 5
    assert L.range_count(L.TableSize(9_000_000, 2_600_000_000), small, 12) == 21
    assert L.range_count(L.TableSize(9_000_000, 2_600_000_000), L.LandingOptions(""), 12) == 10
    cut = L.position_cuts(spark.range(5_000).toDF("pos"), L.range_count(L.TableSize(5_000, 10**6), replace(small, max_records_per_file=10), 8))
    assert len(cut) == 7
    rows = [("c", None, {"EMPLOYEE_ID": i}) for i in range(500)]
    files = sink(home, EMPLOYEES, max_records_per_file=7)(feed(spark, rows), 0)[FOLDER]["files"]
    assert max(n for _, n in files) == 7 and sum(n for _, n in files) == 500 and len(files) < 90
    back = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).orderBy("file_sequence", "row_index").collect()
    assert [x.EMPLOYEE_ID for x in back] == list(range(500))


def test_waiting_segments_land_at_a_threshold_and_at_the_end(spark, home):
    target = sink(home, EMPLOYEES, flush=FlushPolicy(rows=5, seconds=1e9))
    assert target(feed(spark, THREE), 0) == {}
    assert target.waiting(spark) == {FOLDER: {"rows": 3, "failed": 0, "error": ""}}
    assert [n for _, n in target(feed(spark, THREE, first=3), 1)[FOLDER]["files"]] == [6]
    assert target.waiting(spark) == {} and target.flush_due(spark) == {}
    target(feed(spark, THREE, first=6), 2)
    target(feed(spark, THREE, first=6), 2)  # given again
    assert target.flush_due(spark) == {}
    assert [n for _, n in target.flush_due(spark, everything=True)[FOLDER]["files"]] == [3]
    target(feed(spark, THREE, first=6), 2)
    assert target.waiting(spark) == {}
    assert visible(f"{home}/zone/_staging") == []
    wide = sink(f"{home}/b", EMPLOYEES, flush=FlushPolicy(bytes=100, seconds=1e9))
    assert wide(feed(spark, THREE), 0)[FOLDER]["first"] == 1


STEPS = ["decoded", "quarantined", "split", "fixed", "staged", "planned", "renamed", "published", "committed", "flushed"]


@pytest.mark.parametrize("step", STEPS)
def test_a_stop_at_any_step_neither_doubles_nor_loses_waiting_events(spark, home, step):
    pending = []

    def stop_once(at, folder):
        if pending and at == pending[0]:
            pending.clear()
            raise RuntimeError(at)

    target = sink(home, EMPLOYEES, flush=FlushPolicy(rows=5, seconds=1e9), on_step=stop_once)
    for batch in range(4):
        events = feed(spark, THREE, first=3 * batch)
        if batch == 1:
            pending.append(step)
            with pytest.raises((RuntimeError, ExceptionGroup)):
                target(events, batch)
        target(events, batch)
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES)
    assert [r["count"] for r in rows.groupBy("file_sequence").count().orderBy("file_sequence").collect()] == [6, 6]
    assert target.waiting(spark) == {}


def test_another_batch_first_finishes_what_a_stopped_one_has_fixed(spark, home):
    def stop_once(at, folder):
        if at == "planned" and not stop_once.done:
            stop_once.done = True
            raise RuntimeError(at)

    stop_once.done = False
    target = sink(home, EMPLOYEES, flush=FlushPolicy(rows=1, seconds=1e9), on_step=stop_once)
    with pytest.raises(ExceptionGroup):
        target(feed(spark, THREE), 0)
    target.land_batch(feed(spark, THREE, first=3))
    target(feed(spark, THREE), 0)
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES)
    assert [r["count"] for r in rows.groupBy("file_sequence").count().orderBy("file_sequence").collect()] == [3, 3]


def test_a_timer_lands_what_waits_on_a_silent_stream(spark, home):
    feed(spark, THREE).coalesce(1).write.parquet(f"{home}/events")
    target = sink(home, EMPLOYEES, flush=FlushPolicy(seconds=3))
    query = start_landing(stream_events(spark, f"{home}/events"), target, seconds=1)
    try:
        until = time.time() + 90
        while not os.path.exists(f"{home}/zone/{FOLDER}/_sequence.txt") and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3


def test_a_processing_time_trigger_lands_new_files(spark, home):
    feed(spark, THREE).coalesce(1).write.parquet(f"{home}/events")
    target = sink(home, EMPLOYEES)
    query = start_landing(stream_events(spark, f"{home}/events"), target, seconds=1)
    try:
        query.processAllAvailable()
        feed(spark, THREE, first=3).coalesce(1).write.mode("append").parquet(f"{home}/events")
        query.processAllAvailable()
    finally:
        query.stop()
    assert {r.file_sequence for r in read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).collect()} == {1, 2}


def test_a_failing_table_waits_in_order_and_others_go_on(spark, home):
    departments = TableSpec("HR", "DEPARTMENTS", (ColumnSpec("DEPARTMENT_ID", "NUMBER", 4),), ("DEPARTMENT_ID",))

    def fail(at, folder):
        if at == "staged" and folder.endswith("DEPARTMENTS") and fail.left:
            fail.left -= 1
            raise RuntimeError("cannot write")

    fail.left = 3
    target = sink(home, EMPLOYEES, departments, on_step=fail, keep_failed=True)
    for batch in range(4):
        both = feed(spark, THREE, first=10 * batch).unionByName(
            feed(spark, [("c", None, {"DEPARTMENT_ID": batch})], "oracle.HR.DEPARTMENTS", 10 * batch + 5)
        )
        landed = target(both, batch)
        assert landed[FOLDER]["first"] == batch + 1
        if batch < 3:
            held = target.waiting(spark)["HR.schema/DEPARTMENTS"]
            assert (held["rows"], held["failed"]) == (batch + 1, batch + 1) and "cannot write" in held["error"]
    assert target.waiting(spark) == {} and landed["HR.schema/DEPARTMENTS"]["first"] == 1
    rows = read_landing(spark, f"{home}/zone", "HR.schema/DEPARTMENTS", departments).orderBy("file_sequence").collect()
    assert [r.DEPARTMENT_ID for r in rows] == [0, 1, 2, 3]


def test_a_table_failing_for_its_catalog_entry_lands_with_a_better_one(spark, home):
    """The entry of the first attempt counts only once numbers are given."""
    good, current = EMPLOYEES, {}
    bad = replace(EMPLOYEES, columns=(*EMPLOYEES.columns, ColumnSpec("LAST_NAME", "VARCHAR2")))  # a name twice cannot be written
    current[bad.name] = bad
    target = replace(sink(home, keep_failed=True), catalog=lambda: current)
    assert target(feed(spark, THREE), 0) == {}
    assert target.waiting(spark)[FOLDER]["failed"] == 1
    current[good.name] = good
    assert target.flush_due(spark)[FOLDER]["first"] == 1
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3


def test_replays_are_left_out_by_topic_and_partition(spark, home):
    def given(*rows):
        return spark.createDataFrame([(t, None, json.dumps({"after": {"EMPLOYEE_ID": v}}), p, n) for t, p, n, v in rows], "topic string, key string, value string, partition int, pos long")

    t = "oracle.HR.EMPLOYEES"
    target = sink(home, EMPLOYEES, drop_replays=True)
    target(given((t, 0, 1, 1), (t, 1, 1, 2), (t, 0, 2, 3), (t, 0, 2, 3), (t, None, 1, 9)), 0)
    target(given((t, 0, 1, 1), (t, 0, 2, 3), (t, 0, 3, 4), (t, 1, 2, 5), (t, 2, 1, 6), (t, 0, None, 7), (t, 0, None, 8)), 1)
    target(given((t, 0, 3, 4)), 2)
    target(given((t, 0, 1, 1), (t, 0, 2, 3), (t, 0, 3, 4), (t, 1, 2, 5), (t, 2, 1, 6), (t, 0, None, 7), (t, 0, None, 8)), 1)  # given again
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).select("EMPLOYEE_ID").collect()
    assert sorted(r.EMPLOYEE_ID for r in rows) == [1, 2, 3, 4, 5, 6, 7, 8, 9]


def test_a_stop_before_the_marks_rise_lands_nothing_twice(spark, home, monkeypatch):
    target = sink(home, EMPLOYEES, drop_replays=True)
    raise_marks = type(target)._raise_marks
    monkeypatch.setattr(type(target), "_raise_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        target(feed(spark, THREE), 0)
    monkeypatch.setattr(type(target), "_raise_marks", raise_marks)
    target(feed(spark, THREE), 0)
    target(feed(spark, THREE), 1)
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3


def test_events_without_copies_are_not_moved(spark):
    events = feed(spark, THREE)
    text = without_replays(events, [["oracle.HR.EMPLOYEES", 0, 0]])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "Broadcast" in text


def test_texts_are_replaced_in_one_step(spark, home):
    files = Files(spark, home)
    for text in ("one", "two", ""):
        files.write_text(f"{home}/state.txt", text)
        assert files.read_text(f"{home}/state.txt") == text
    assert files.names(home) == ["state.txt"] or sorted(files.names(home)) == [".state.txt.crc", "state.txt"]


def test_zones_of_all_codecs_share_one_decoding_and_one_conversion(spark, monkeypatch):
    decoded, converted = [], []
    decode, land = sinks.decode_events, sinks.land_table
    monkeypatch.setattr(sinks, "decode_events", lambda *a, **k: decoded.append(1) or decode(*a, **k))
    monkeypatch.setattr(sinks, "land_table", lambda rows, *a: converted.append((rows, rows.storageLevel.useMemory)) or land(rows, *a))
    assert QUERIES["codecs"](spark, SF).select("asked").distinct().count() == 6
    assert len(decoded) == 1 and len(converted) == 6
    assert len({id(rows) for rows, _ in converted}) == 1 and all(kept for _, kept in converted)


@pytest.mark.parametrize("buffered", [False, True])
def test_a_stop_between_copies_leaves_neither_doubles_nor_gaps(spark, home, buffered):
    moved, at = [], [0]

    def stop(step, folder):
        moved.append(step) if step == "renamed" else None
        if step == "renamed" and len(moved) == at[0]:
            raise RuntimeError("stopped")

    plain = sink(home, EMPLOYEES, on_step=stop, flush=FlushPolicy(rows=1) if buffered else None)
    copies = tuple(replace(plain.options, base=f"{home}/{c}", compression=c) for c in ("GZIP", "ZSTD"))
    target = replace(plain, copies=copies)
    for batch in range(3):  # stopped after the only file of the first copy, of the second, of the zone itself
        events = feed(spark, THREE, first=10 * batch)
        moved.clear()
        at[0] = batch + 1
        with pytest.raises(ExceptionGroup):
            target(events, batch)
        at[0] = 0
        target(events, batch)
        assert len(moved) == 3
    for zone in (plain.options, *copies):
        files = visible(f"{zone.base}/{FOLDER}")
        assert [n for n in files if n[0] == "0"] == [f"{i:020d}.parquet" for i in (1, 2, 3)]
        rows = read_landing(spark, zone.base, FOLDER, EMPLOYEES).select("EMPLOYEE_ID", "file_sequence").collect()
        assert sorted(rows) == sorted((i, s) for i in (41, 42, 43) for s in (1, 2, 3))


def test_copies_need_a_base_of_their_own_and_the_same_marker(home):
    plain = sink(home, EMPLOYEES)
    for odd in (plain.options, replace(plain.options, base=f"{home}/copy", marker="M")):
        with pytest.raises(ValueError, match="copy"):
            replace(plain, copies=(odd,))
