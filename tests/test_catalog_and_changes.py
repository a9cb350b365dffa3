"""Catalog loading and refresh, allow-lists, current state."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, resolve
from tidemark.sources import catalog, events

COLUMNS = [
    ("HR", "EMP", "NAME", "VARCHAR2", None, None, "Y", 2),
    ("HR", "EMP", "ID", "NUMBER", 10, 0, "N", 1),
    ("HR", "DEPT", "DNO", "NUMBER", 4, 0, None, 1),
]
CONSTRAINTS = [("HR", "EMP", "EMP_PK", "P"), ("HR", "EMP", "EMP_UK", "U"), ("XX", "EMP", "EMP_PK", "P")]
KEYS = [("HR", "EMP_PK", "NAME", 2), ("HR", "EMP_PK", "ID", 1), ("HR", "EMP_UK", "NAME", 1), ("XX", "EMP_PK", "Q", 1)]


def frames(spark):
    return (
        spark.createDataFrame(COLUMNS, catalog.COLUMN_SCHEMA),
        spark.createDataFrame(CONSTRAINTS, catalog.CONSTRAINT_SCHEMA),
        spark.createDataFrame(KEYS, catalog.KEY_COLUMN_SCHEMA),
    )


def test_catalog_rows_become_specs(spark):
    specs = catalog.collect_catalog(*frames(spark))
    assert specs == {
        "HR.EMP": catalog.TableSpec(
            "HR",
            "EMP",
            (catalog.ColumnSpec("ID", "NUMBER", 10, 0, False, 1), catalog.ColumnSpec("NAME", "VARCHAR2", 0, 0, True, 2)),
            ("ID", "NAME"),
        ),
        "HR.DEPT": catalog.TableSpec("HR", "DEPT", (catalog.ColumnSpec("DNO", "NUMBER", 4, 0, False, 1),), ()),
    }
    spec = specs["HR.EMP"]
    assert catalog.TableSpec.from_dict(spec.to_dict()) == spec


def test_catalog_is_read_again_after_its_time(spark):
    now, calls = [0.0], []

    def load():
        calls.append(now[0])
        return {"n": len(calls)}

    current = catalog.cached_catalog(load, ttl_seconds=300, clock=lambda: now[0])
    for now[0] in (0, 300, 301, 500, 602):
        current()
    assert calls == [0, 301, 602]


def test_folders_resolve_by_upper_case(spark):
    columns, _, _ = frames(spark)
    folders = spark.createDataFrame([("hr.schema/Emp",)] * 3 + [("NO.schema/T",)], "folder STRING")
    found = {r.folder: (r.n_events, r.n_columns) for r in resolve.resolve_tables(folders, columns).collect()}
    assert found == {"hr.schema/Emp": (3, 2), "NO.schema/T": (1, None)}


@pytest.mark.parametrize(
    "tables, schemas, kept",
    [
        (["HR.EMP"], [], {"oracle.HR.EMP"}),
        ([], ["HR"], {"oracle.HR.EMP", "oracle.HR.DEPT"}),
        (["XX.EMP"], ["HR"], {"oracle.HR.EMP", "oracle.HR.DEPT", "oracle.XX.EMP"}),
        ([], [], {"oracle.HR.EMP", "oracle.HR.DEPT", "oracle.XX.EMP", "oracle.HRX.T"}),
    ],
)
def test_allow_list(spark, tables, schemas, kept):
    topics = ["oracle.HR.EMP", "oracle.HR.DEPT", "oracle.XX.EMP", "oracle.HRX.T"]
    feed = spark.createDataFrame([(t, None, None, 0) for t in topics], events.EVENT_SCHEMA)
    assert {r.topic for r in events.allow_tables(feed, tables, schemas, "oracle").collect()} == kept


def brute_force(rows):
    state = {}
    for k, v, marker, _, _ in sorted(rows, key=lambda r: (r[3], r[4])):
        if k is None:
            continue
        if marker == 2:
            state.pop(k, None)
        else:
            state[k] = v
    return state


def random_changes(seed, n=600):
    rng = random.Random(seed)
    # One key holds about a third of all changes.
    keys = [7 if rng.random() < 0.34 else rng.choice([*range(40), None]) for _ in range(n)]
    return [(k, rng.randrange(10**6), rng.choice([0, 1, 1, 2]), 1 + i // 100, i % 100) for i, k in enumerate(keys)]


SCHEMA = "K BIGINT, V BIGINT, __rowMarker__ INT, file_sequence BIGINT, row_index BIGINT"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_current_state_equals_replaying_every_change(spark, seed):
    rows = random_changes(seed)
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), SCHEMA)
    state = {r.K: r.V for r in changes.apply_changes(df, ["K"]).collect()}
    assert state == brute_force(rows)
    early, late = df.filter("file_sequence <= 3"), df.filter("file_sequence > 3")
    grown = changes.apply_changes(late, ["K"], changes.apply_changes(early, ["K"]))
    assert {r.K: r.V for r in grown.collect()} == state
    assert changes.keyless_changes(df, ["K"]).count() == sum(r[0] is None for r in rows)


def test_composite_keys_and_added_columns(spark):
    first = spark.createDataFrame([(1, "a", 10, 0, 1, 0), (1, "b", 11, 0, 1, 1)], "A INT, B STRING, V INT, __rowMarker__ INT, file_sequence BIGINT, row_index BIGINT")
    later = first.sparkSession.createDataFrame([(1, "b", None, 2, 2, 0), (2, "a", 5, 0, 2, 1)], "A INT, B STRING, W INT, __rowMarker__ INT, file_sequence BIGINT, row_index BIGINT")
    grown = changes.apply_changes(later, ["A", "B"], changes.apply_changes(first, ["A", "B"]))
    assert {(r.A, r.B): (r.V, r.W) for r in grown.collect()} == {(1, "a"): (10, None), (2, "a"): (None, 5)}


def test_replays_are_dropped_once(spark):
    rows = [(1, 1, 0), (1, 1, 0), (1, 1, 1), (1, 2, 0), (2, 1, 0)]
    df = spark.createDataFrame(rows, "K INT, pos BIGINT, __rowMarker__ INT")
    assert changes.dedupe_changes(df, ["K"]).count() == 4


def test_rows_that_only_share_key_and_position_are_no_replays(spark):
    rows = [(None, 7, 0, "a"), (None, 7, 0, "b"), (1, 7, 0, "a"), (1, 7, 0, "b"), (1, 7, 0, "b")]
    df = spark.createDataFrame(rows, "K INT, pos BIGINT, __rowMarker__ INT, V STRING")
    assert changes.dedupe_changes(df, ["K"]).count() == 4


def test_profile(spark):
    df = spark.createDataFrame([("a", 0), ("a", 2), ("a", 2), ("b", 1)], "folder STRING, marker INT")
    rows = {r.folder: (r.inserts, r.updates, r.deletes, r.changes) for r in changes.change_profile(df).collect()}
    assert rows == {"a": (1, 0, 2, 3), "b": (0, 1, 0, 1)}


def test_last_change_is_kept_per_task_before_the_shuffle(spark):
    df = spark.createDataFrame(random_changes(1), SCHEMA).repartition(4)
    plan = changes.apply_changes(df, ["K"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange hashpartitioning(K")[1]
    assert df.select(F.count("*")).first()[0] == 600
