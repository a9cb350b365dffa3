"""Streams: equality with a batch, restart at every step, the demo change script over three tables."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_landing import FOLDER, feed, sink
from tidemark.operators.changes import apply_changes, change_profile
from tidemark.plans import fixtures as X
from tidemark.plans import queries as Q
from tidemark.plans.queries import QUERIES
from tidemark.sources.catalog import ColumnSpec, TableSpec
from tidemark.sources.events import allow_tables, stream_events
from tidemark.sources.landing import read_landing
from tidemark.streaming.sink import start_landing

SF = "/root/testdata/sf0.001"


def number(name, precision, scale=0):
    return ColumnSpec(name, "NUMBER", precision, scale)


def text(name):
    return ColumnSpec(name, "VARCHAR2")


EMPLOYEES = TableSpec(
    "HR",
    "EMPLOYEES",
    (number("EMPLOYEE_ID", 6), text("FIRST_NAME"), text("LAST_NAME"), text("EMAIL"), ColumnSpec("HIRE_DATE", "DATE"), text("JOB_ID"),
     number("SALARY", 8, 2), number("COMMISSION_PCT", 2, 2), number("MANAGER_ID", 6), number("DEPARTMENT_ID", 4)),
    ("EMPLOYEE_ID",),
)
DEPARTMENTS = TableSpec("HR", "DEPARTMENTS", (number("DEPARTMENT_ID", 4), text("DEPARTMENT_NAME"), number("MANAGER_ID", 6), number("LOCATION_ID", 4)), ("DEPARTMENT_ID",))
PROJECTS = TableSpec("HR", "PROJECTS", (number("PROJECT_ID", 6), text("PROJECT_NAME"), number("BUDGET", 12, 2), ColumnSpec("START_DATE", "DATE"), number("DEPARTMENT_ID", 4)), ("PROJECT_ID",))


def drain(spark, path, target, **options):
    start_landing(stream_events(spark, path, **options), target, available_now=True).awaitTermination()


def test_stream_lands_what_a_batch_lands(spark, home):
    path = f"{home}/events"
    # A file source takes files by age, so they are written one after the other.
    for low, high in ((-1, 300), (300, 900), (900, 10**9)):
        X.all_events(spark, SF).filter((F.col("pos") > low) & (F.col("pos") <= high)).coalesce(1).write.mode("append").parquet(path)
    streamed, batch = sink(f"{home}/a", X.ORDERS, X.USERS), sink(f"{home}/b", X.ORDERS, X.USERS)
    drain(spark, path, streamed, max_files_per_trigger=1)
    batch(X.all_events(spark, SF), 0)
    for spec, folder in ((X.ORDERS, X.ORDERS_FOLDER), (X.USERS, X.USERS_FOLDER)):
        one, other = (read_landing(spark, s.options.base, folder, spec).drop("file_sequence", "row_index") for s in (streamed, batch))
        assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0
    users = [apply_changes(read_landing(spark, s.options.base, X.USERS_FOLDER, X.USERS), ["USER_ID"]) for s in (streamed, batch)]
    assert users[0].exceptAll(users[1]).count() == 0 and users[0].count() == 12


def test_a_second_run_continues_the_numbers(spark, home):
    path = f"{home}/events"
    X.order_events(spark, SF).filter("pos % 4 < 2").coalesce(1).write.parquet(path)
    target = sink(home, X.ORDERS)
    drain(spark, path, target)
    drain(spark, path, target)
    X.order_events(spark, SF).filter("pos % 4 >= 2").coalesce(1).write.mode("append").parquet(path)
    drain(spark, path, target)
    rows = read_landing(spark, target.options.base, X.ORDERS_FOLDER, X.ORDERS)
    assert {r.file_sequence for r in rows.select("file_sequence").distinct().collect()} == {1, 2}
    assert rows.count() == 1631


def test_restart_at_every_step(spark):
    rows = {r.folder: (r["rows"], r.gaps) for r in QUERIES["restart_no_dup"](spark, SF).collect()}
    assert rows == {X.ORDERS_FOLDER: (1631, 0), X.USERS_FOLDER: (1000, 0)}


def change(op, key, **values):
    row = {key[0]: key[1], **values}
    return (op, None, row) if op in "cru" else (op, row, None)


def test_change_script(spark, home):
    employees = [
        change("c", ("EMPLOYEE_ID", 8), LAST_NAME="Ito", SALARY=10.5, DEPARTMENT_ID=2),
        change("c", ("EMPLOYEE_ID", 9), LAST_NAME="Ito", SALARY=20.5, DEPARTMENT_ID=3),
        change("u", ("EMPLOYEE_ID", 8), LAST_NAME="Ito", SALARY=11.5, DEPARTMENT_ID=2),
        change("u", ("EMPLOYEE_ID", 9), LAST_NAME="Ito", SALARY=21.5, DEPARTMENT_ID=3),
        change("d", ("EMPLOYEE_ID", 9), LAST_NAME="Ito", SALARY=21.5, DEPARTMENT_ID=3),
    ]
    departments = [change("c", ("DEPARTMENT_ID", 4), DEPARTMENT_NAME="Harbour", MANAGER_ID=None, LOCATION_ID=77)]
    projects = [
        change("r", ("PROJECT_ID", 1), PROJECT_NAME="Bridge", BUDGET=50),
        change("r", ("PROJECT_ID", 2), PROJECT_NAME="Tunnel", BUDGET=75),
        change("c", ("PROJECT_ID", 3), PROJECT_NAME="Quay", BUDGET=120),
        change("u", ("PROJECT_ID", 1), PROJECT_NAME="Bridge", BUDGET=60),
        change("d", ("PROJECT_ID", 2)),
    ]
    target = sink(home, EMPLOYEES, DEPARTMENTS, PROJECTS)
    all_changes = (
        feed(spark, employees, "oracle.HR.EMPLOYEES")
        .unionByName(feed(spark, departments, "oracle.HR.DEPARTMENTS", 5))
        .unionByName(feed(spark, projects, "oracle.HR.PROJECTS", 6))
    )
    # The third table joins the allow-list later.
    target(allow_tables(all_changes, ["HR.EMPLOYEES", "HR.DEPARTMENTS"], prefix="oracle"), 0)
    target(allow_tables(all_changes, ["HR.PROJECTS"], prefix="oracle"), 1)

    def state(spec):
        rows = read_landing(spark, target.options.base, f"HR.schema/{spec.table}", spec)
        return rows.count(), [tuple(r) for r in apply_changes(rows, spec.keys).select(*spec.keys, spec.columns[-1 if spec is DEPARTMENTS else 2].name).orderBy(*spec.keys).collect()]

    assert state(EMPLOYEES) == (5, [(8, "Ito")])
    assert state(DEPARTMENTS) == (1, [(4, 77)])
    assert state(PROJECTS) == (5, [(1, 60.0), (3, 120.0)])


def test_an_added_column_needs_no_restart(spark, home):
    current = [replace(EMPLOYEES, columns=EMPLOYEES.columns[:2])]
    target = replace(sink(home), catalog=lambda: {s.name: s for s in current})
    target(feed(spark, [change("c", ("EMPLOYEE_ID", 1), FIRST_NAME="A", LAST_NAME="B")]), 0)
    current[0] = EMPLOYEES
    target(feed(spark, [change("c", ("EMPLOYEE_ID", 2), FIRST_NAME="A", LAST_NAME="B")], first=1), 1)
    rows = read_landing(spark, target.options.base, FOLDER).orderBy("EMPLOYEE_ID").collect()
    assert [r.LAST_NAME for r in rows] == [None, "B"]
    typed = read_landing(spark, target.options.base, FOLDER, EMPLOYEES).orderBy("EMPLOYEE_ID").collect()
    assert [r.LAST_NAME for r in typed] == [None, "B"]


def test_profile_of_a_landing_zone(spark, home):
    target = sink(home, X.ORDERS)
    target(X.order_events(spark, SF), 0)
    rows = read_landing(spark, target.options.base, X.ORDERS_FOLDER, X.ORDERS).withColumn("folder", F.lit("o"))
    assert tuple(change_profile(rows, marker="__rowMarker__").first()) == ("o", 755, 438, 438, 1631)


def test_landed_metadata_is_rewritten_when_keys_change(spark, home):
    target = sink(home, EMPLOYEES)
    target(feed(spark, [change("c", ("EMPLOYEE_ID", 1))]), 0)
    keyed = replace(EMPLOYEES, keys=("EMPLOYEE_ID", "EMAIL"))
    replace(target, catalog=lambda: {keyed.name: keyed})(feed(spark, [change("c", ("EMPLOYEE_ID", 1))], first=1), 1)
    with open(f"{target.options.base}/{FOLDER}/_metadata.json") as file:
        assert json.load(file) == {"keyColumns": ["EMPLOYEE_ID", "EMAIL"]}


def test_kafka_needs_its_connector(spark):
    from tidemark.sources.events import stream_kafka

    with pytest.raises(Exception, match="(?i)kafka"):
        stream_kafka(spark, "nowhere:9092", "oracle[.].*", max_offsets_per_trigger=10)


def test_files_of_events_grow_in_number_and_not_in_size(spark, home, monkeypatch):
    monkeypatch.setattr(Q, "EVENT_FILE_ROWS", 100)
    events = X.order_events(spark, SF)
    each = Q._event_files(spark, events, f"{home}/events", batches=2)
    assert each == -(-events.count() // 200)
    files = spark.read.parquet(f"{home}/events").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    files = files.orderBy("low").collect()
    assert 2 * each - 2 <= len(files) <= 2 * each and max(f.n for f in files) <= 200 and sum(f.n for f in files) == events.count()
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
