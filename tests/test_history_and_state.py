"""Catalog versions, the stored state, snapshots read while changes go on."""

import json

import pytest

from tests.test_landing import EMPLOYEES, FOLDER, THREE, feed, sink
from tidemark.operators import changes
from tidemark.operators.state import KeyedState
from tidemark.plans import fixtures as X
from tidemark.sources import events
from tidemark.sources.catalog import ColumnSpec, TableSpec
from tidemark.sources.history import TableHistory, entry_from_dict
from tidemark.sources.landing import read_landing

SF = "/root/testdata/sf0.001"


def spec(*columns):
    return TableSpec("HR", "EMPLOYEES", tuple(ColumnSpec(n, t, p, 0, True, i) for i, n, t, p in columns), ("EMPLOYEE_ID",))


ONE = spec((1, "EMPLOYEE_ID", "NUMBER", 9), (2, "NAME", "VARCHAR2", 0), (3, "GRADE", "NUMBER", 9))
TWO = spec((1, "EMPLOYEE_ID", "NUMBER", 9), (2, "FULL_NAME", "VARCHAR2", 0), (3, "GRADE", "NUMBER", 18))  # renamed, widened
THREE_ = spec((1, "EMPLOYEE_ID", "NUMBER", 9), (2, "FULL_NAME", "VARCHAR2", 0), (4, "GRADE", "VARCHAR2", 0))  # dropped, its name taken


def given(spark, *rows):
    return spark.createDataFrame([("oracle.HR.EMPLOYEES", None, json.dumps({"after": r}), p) for p, r in rows], events.EVENT_SCHEMA)


def test_columns_are_told_by_their_ids():
    history = TableHistory(((0, ONE),)).changed(10, TWO).changed(10, TWO).changed(20, THREE_)
    assert [p for p, _ in history.versions] == [0, 10, 20]
    assert [(c.name, c.landing_type) for c in history.landing_spec().columns] == [("EMPLOYEE_ID", "int"), ("FULL_NAME", "string"), ("GRADE", "string"), ("GRADE__3", "bigint")]
    assert [c.name for c in TableHistory(history.versions, frozenset({3})).landing_spec().columns] == ["EMPLOYEE_ID", "FULL_NAME", "GRADE"]
    assert entry_from_dict(json.loads(json.dumps(history.to_dict()))) == history
    assert entry_from_dict(json.loads(json.dumps(ONE.to_dict()))) == ONE


def test_events_land_under_the_entry_of_their_position(spark, home):
    history = TableHistory(((5, ONE), (10, TWO), (20, THREE_)))
    target = sink(home)
    target.catalog = lambda: {history.name: history}
    rows = [(0, {"EMPLOYEE_ID": 1, "NAME": "a", "FULL_NAME": "no", "GRADE": 7}), (9, {"EMPLOYEE_ID": 2, "NAME": "b"}), (10, {"EMPLOYEE_ID": 3, "NAME": "no", "FULL_NAME": "c", "GRADE": 3_000_000_000}),
            (20, {"EMPLOYEE_ID": 4, "FULL_NAME": "d", "GRADE": "high"}), (21, {"EMPLOYEE_ID": "x"}), (None, {"EMPLOYEE_ID": 5, "NAME": "e"})]
    target(given(spark, *rows), 0)
    back = read_landing(spark, f"{home}/zone", FOLDER, history.landing_spec()).orderBy("EMPLOYEE_ID").collect()
    assert [(r.EMPLOYEE_ID, r.FULL_NAME, r.GRADE, r["GRADE__3"]) for r in back] == [
        (1, "a", None, 7), (2, "b", None, None), (3, "c", None, 3_000_000_000), (4, "d", "high", None), (5, "e", None, None)]
    refused = spark.read.option("recursiveFileLookup", "true").parquet(f"{home}/zone/_quarantine").collect()
    assert [r.reason for r in refused] == ["unconvertible: EMPLOYEE_ID"]


def test_a_dropped_column_stays_null_without_a_history(spark, home):
    """The newest entry alone: older files keep the column, a reader by the newest entry does not see it."""
    target = sink(home)
    target.catalog = lambda: {EMPLOYEES.name: EMPLOYEES}
    target(feed(spark, THREE), 0)
    narrow = TableSpec("HR", "EMPLOYEES", EMPLOYEES.columns[:2], EMPLOYEES.keys)
    target.catalog = lambda: {narrow.name: narrow}
    target(feed(spark, THREE, first=3), 1)
    merged = read_landing(spark, f"{home}/zone", FOLDER).orderBy("file_sequence", "row_index").collect()
    assert [r.LAST_NAME for r in merged] == ["Okafor", "Varga", "Lund", None, None, None]
    assert "LAST_NAME" not in read_landing(spark, f"{home}/zone", FOLDER, narrow).columns


def test_the_state_follows_the_landing(spark, home):
    target, state = sink(home, EMPLOYEES), KeyedState(f"{home}/state", EMPLOYEES, buckets=4)
    assert state.read(spark) is None and state.after(spark) == 0
    target(feed(spark, THREE), 0)
    for _ in range(2):
        assert state.advance(spark, f"{home}/zone", FOLDER).count() == 0
        assert sorted(r.EMPLOYEE_ID for r in state.read(spark).collect()) == [41, 42]
    old = state.read(spark)
    target(feed(spark, [("u", None, {"EMPLOYEE_ID": 41, "LAST_NAME": "New"}), ("d", {"EMPLOYEE_ID": 42}, None), ("c", None, {"LAST_NAME": "nobody"}), ("c", None, {"EMPLOYEE_ID": 44})], first=3), 1)
    keyless = state.advance(spark, f"{home}/zone", FOLDER)
    assert [r.LAST_NAME for r in keyless.collect()] == ["nobody"]
    assert sorted((r.EMPLOYEE_ID, r.FIRST_NAME, r.LAST_NAME) for r in state.read(spark).collect()) == [(41, None, "New"), (44, None, None)]
    assert old.count() == 2 and state.after(spark) == 2
    # another session knows nothing but the files
    assert KeyedState(f"{home}/state", EMPLOYEES).read(spark.newSession()).count() == 2


def test_the_stored_state_is_not_shuffled_and_changes_are_read_once(spark, home):
    target, state = sink(home, X.USERS), KeyedState(f"{home}/state", X.USERS, buckets=4)
    users = X.user_events(spark, SF)
    target(users.filter("pos % 2 = 0"), 0)
    state.advance(spark, f"{home}/zone", X.USERS_FOLDER)
    target(users.filter("pos % 2 = 1"), 1)
    later = read_landing(spark, f"{home}/zone", X.USERS_FOLDER, X.USERS, after_sequence=1)
    df = state.next_state(spark, later)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2 and "Bucketed: true" in final
    base_side = next(line for line in final.splitlines() if "Bucketed: true" in line)
    lines = final.splitlines()
    at, depth = lines.index(base_side), len(base_side) - len(base_side.lstrip(" :+-*()0123456789"))
    for line in reversed(lines[:at]):  # from the scan up to the join
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            assert "Exchange" not in line
            depth = own
            if "SortMergeJoin" in line:
                break
    else:
        pytest.fail("no join above the stored state")


def test_base_and_changes_are_each_read_once(spark, home):
    users = X.USERS.landing_schema()
    spark.createDataFrame([], users).write.parquet(f"{home}/{X.USERS_FOLDER}")
    base = spark.createDataFrame([], "USER_ID BIGINT, VALUE DOUBLE, OLD STRING")
    rows = changes.apply_changes(read_landing(spark, home, X.USERS_FOLDER, X.USERS), ["USER_ID"], base)
    assert rows.columns == ["USER_ID", "EVENT_ID", "EVENT_TYPE", "VALUE", "TS", "OLD"]
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


@pytest.mark.parametrize("wrapped", [False, True])
def test_snapshot_rows_give_way_to_changes_inside_their_window(spark, wrapped):
    def event(op, key, value, pos, window=None):
        body = {"op": op, "before": {"K": key} if op == "d" else None, "after": None if op == "d" else {"K": key, "V": value}}
        return ("oracle.A.B", json.dumps({"payload": {"K": key}} if wrapped else {"K": key}), json.dumps(body), pos, window)

    names = "topic string, key string, value string, pos long, window int"
    snapshot = spark.createDataFrame([event("r", k, "read", None, w) for k, w in ((1, 0), (2, 0), (3, 0), (4, 1), (5, 1))], names)
    made = spark.createDataFrame([event("u", 1, "in", 12), event("u", 2, "before", 10), event("u", 3, "after", 21), event("d", 4, None, 30), event("u", 5, "other window", 15), event("u", 1, "in", 13)], names).drop("window")
    got = events.hand_over(snapshot, made, [(10, 20), (20, 30)], ["K"]).orderBy("pos").collect()
    kept = [(json.loads(r.value)["after"]["K"], r.pos) for r in got if json.loads(r.value)["op"] == "r"]
    assert sorted(kept) == [(2, 20), (3, 20), (5, 30)] and len(got) == 9
    assert events.hand_over(snapshot.limit(0), made, [], ["K"]).count() == 6


def test_the_catalog_comes_from_any_reader(spark, monkeypatch):
    """``read_jdbc_catalog`` over plain tables in place of the database's views."""
    from tidemark.sources.catalog import collect_catalog, read_jdbc_catalog

    views = {
        "ALL_TAB_COLUMNS": spark.createDataFrame([("HR", "T", "A", "NUMBER", "9", "0", "N", "1", "x"), ("HR", "T", "B", "CLOB", None, None, "Y", "2", "x"), ("SYS", "U", "C", "DATE", None, None, "Y", "1", "x")],
                                                 "owner string, table_name string, column_name string, data_type string, data_precision string, data_scale string, nullable string, column_id string, more string"),
        "ALL_CONSTRAINTS": spark.createDataFrame([("HR", "T", "PK", "P")], "owner string, table_name string, constraint_name string, constraint_type string"),
        "ALL_CONS_COLUMNS": spark.createDataFrame([("HR", "PK", "A", "1")], "owner string, constraint_name string, column_name string, position string"),
    }

    class Reader:
        def __init__(self):
            self.options_given = {}

        def format(self, name):
            assert name == "jdbc"
            return self

        def option(self, name, value):
            self.options_given[name] = value
            return self

        def options(self, **more):
            self.options_given |= more
            return self

        def load(self):
            assert self.options_given["url"] == "jdbc:x" and self.options_given["user"] == "u"
            return views[self.options_given["dbtable"]]

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    tables = read_jdbc_catalog(spark, "jdbc:x", ["HR"], user="u")
    monkeypatch.undo()
    found = collect_catalog(*tables)
    assert list(found) == ["HR.T"] and found["HR.T"].keys == ("A",)
    assert [(c.name, c.landing_type, c.nullable) for c in found["HR.T"].columns] == [("A", "int", False), ("B", "string", True)]
