"""Landing a table: files, order, numbers, restarts."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import decode, project
from tidemark.plans import fixtures as X
from tidemark.plans import landing as L
from tidemark.plans.files import Files
from tidemark.sources.catalog import ColumnSpec, TableSpec, static_catalog
from tidemark.sources.events import EVENT_SCHEMA
from tidemark.sources.landing import landing_files, max_sequence, read_landing
from tidemark.streaming.sink import LandingSink

EMPLOYEES = TableSpec(
    "HR",
    "EMPLOYEES",
    (
        ColumnSpec("EMPLOYEE_ID", "NUMBER", 10, 0, False, 1),
        ColumnSpec("FIRST_NAME", "VARCHAR2", 0, 0, True, 2),
        ColumnSpec("LAST_NAME", "VARCHAR2", 0, 0, False, 3),
        ColumnSpec("HIRE_DATE", "DATE", 0, 0, True, 4),
        ColumnSpec("SALARY", "NUMBER", 8, 2, True, 5),
    ),
    ("EMPLOYEE_ID",),
)
FOLDER = "HR.schema/EMPLOYEES"


def row(i, first, last, hired, salary):
    return {"EMPLOYEE_ID": i, "FIRST_NAME": first, "LAST_NAME": last, "HIRE_DATE": hired, "SALARY": salary}


THREE = [
    ("c", None, row(41, "Ines", "Okafor", 18262, 512.25)),
    ("u", None, row(42, "Piet", "Varga", 18628, 640.5)),
    ("d", row(43, None, "Lund", None, None), None),
]


def feed(spark, changes, topic="oracle.HR.EMPLOYEES", first=0):
    rows = [
        (topic, None, json.dumps({"op": op, "before": before, "after": after}), first + i)
        for i, (op, before, after) in enumerate(changes)
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def sink(home, *specs, **options):
    names = L.LandingOptions.__dataclass_fields__
    landing = L.LandingOptions(f"{home}/zone", **{k: v for k, v in options.items() if k in names})
    rest = {k: v for k, v in options.items() if k not in names}
    return LandingSink(landing, f"{home}/checkpoint", static_catalog(*specs), "oracle", **rest)


def visible(path):
    return sorted(n for n in os.listdir(path) if not n.startswith("."))


def test_three_changes_land_and_read_back(spark, home):
    sink(home, EMPLOYEES)(feed(spark, THREE), 0)
    folder = f"{home}/zone/{FOLDER}"
    assert visible(folder) == ["00000000000000000001.parquet", "_metadata.json", "_sequence.txt"]
    assert open(f"{folder}/_metadata.json").read() == '{"keyColumns":["EMPLOYEE_ID"]}'
    assert open(f"{folder}/_sequence.txt").read() == "1"
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).orderBy("row_index").collect()
    assert [r["__rowMarker__"] for r in rows] == [0, 1, 2]
    assert [r.EMPLOYEE_ID for r in rows] == [41, 42, 43]
    assert [r.LAST_NAME for r in rows] == ["Okafor", "Varga", "Lund"]
    assert [str(r.HIRE_DATE) for r in rows] == ["2020-01-01", "2021-01-01", "None"]
    merged = read_landing(spark, f"{home}/zone", FOLDER)
    assert merged.drop("file_sequence", "row_index").columns == [c.name for c in EMPLOYEES.columns] + ["__rowMarker__"]


def test_file_schema_has_date_millis_and_required_marker(spark, home):
    import pyarrow.parquet as pq

    spec = replace(EMPLOYEES, columns=(*EMPLOYEES.columns, ColumnSpec("SEEN", "TIMESTAMP(6)")))
    sink(home, spec)(feed(spark, [("c", None, {"EMPLOYEE_ID": 1, "SEEN": 1704067207179575})]), 0)
    schema = pq.ParquetFile(f"{home}/zone/{FOLDER}/00000000000000000001.parquet").schema
    by_name = {schema.column(i).name: schema.column(i) for i in range(len(schema))}
    assert "Date" in str(by_name["HIRE_DATE"].logical_type)
    assert "milliseconds" in str(by_name["SEEN"].logical_type)
    assert by_name["__rowMarker__"].max_definition_level == 0
    assert by_name["EMPLOYEE_ID"].max_definition_level == 1
    assert by_name["EMPLOYEE_ID"].physical_type == "INT64"


@pytest.mark.parametrize("asked, found", [("gzip", "GZIP"), ("ZSTD", "ZSTD"), ("LZ4", "LZ4"), ("UNCOMPRESSED", "UNCOMPRESSED"), ("bogus", "SNAPPY"), (None, "SNAPPY")])
def test_codecs_reach_the_file(spark, home, asked, found):
    import duckdb

    sink(home, EMPLOYEES, compression=asked)(feed(spark, THREE), 0)
    path = f"{home}/zone/{FOLDER}/00000000000000000001.parquet"
    rows = duckdb.connect().execute(f"select distinct compression from parquet_metadata('{path}')").fetchall()
    assert rows == [(found,)]


def test_sequence_survives_a_restart(spark, home):
    files = Files(spark, home)
    assert L.restore_sequence(files, home, FOLDER) == 0
    L.commit_sequence(files, home, FOLDER, 1)
    assert L.restore_sequence(Files(spark, home), home, FOLDER) == 1
    assert L.first_free_sequence(files, home, FOLDER) == 2


def test_broken_or_missing_state_falls_back_to_file_names(spark, home):
    folder = f"{home}/{FOLDER}"
    os.makedirs(folder)
    for name in ("x.parquet", "7.txt", "00000000000000000012.parquet"):
        with open(f"{folder}/{name}", "w") as file:
            file.write("x")
    files = Files(spark, home)
    assert L.restore_sequence(files, home, FOLDER) == 12
    files.write_text(f"{folder}/_sequence.txt", "abc")
    assert L.restore_sequence(files, home, FOLDER) == 12
    names = landing_files(spark, home, FOLDER)
    assert {r.file_name for r in names.collect()} == {"x.parquet", "7.txt", "00000000000000000012.parquet"}
    assert max_sequence(names).first().max_sequence == 12
    assert landing_files(spark, home, "NO.schema/SUCH").count() == 0
    assert max_sequence(landing_files(spark, home, "NO.schema/SUCH")).first().max_sequence == 0


def test_lagging_state_never_overwrites_a_file(spark, home):
    sink(home, EMPLOYEES)(feed(spark, THREE), 0)
    Files(spark, home).write_text(f"{home}/zone/{FOLDER}/_sequence.txt", "0")
    # A new checkpoint knows nothing of the first landing.
    again = LandingSink(L.LandingOptions(f"{home}/zone"), f"{home}/other", static_catalog(EMPLOYEES), "oracle")
    again(feed(spark, THREE), 0)
    assert [n for n in visible(f"{home}/zone/{FOLDER}") if n.endswith("t")] == [
        "00000000000000000001.parquet", "00000000000000000002.parquet", "_sequence.txt",
    ]
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 6


def test_a_batch_without_good_rows_writes_no_file(spark, home):
    sink(home, EMPLOYEES)(feed(spark, [("c", None, {"EMPLOYEE_ID": "x"})]), 0)
    assert visible(f"{home}/zone/{FOLDER}") == ["_metadata.json"]
    quarantined = spark.read.option("recursiveFileLookup", "true").parquet(f"{home}/zone/_quarantine").collect()
    assert [(r.folder, r.reason, r.marker) for r in quarantined] == [(FOLDER, "unconvertible: EMPLOYEE_ID", 0)]


def test_rows_keep_their_order_over_many_files(spark, home):
    events = spark.range(20_000).selectExpr(
        "'oracle.HR.EMPLOYEES' as topic", "cast(null as string) as key", "19999 - id as pos",
        "concat('{\"after\":{\"EMPLOYEE_ID\":', 19999 - id, '}}') as value",
    )
    sink(home, EMPLOYEES, max_records_per_file=1_500)(events, 0)
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES)
    order = [r.EMPLOYEE_ID for r in rows.orderBy("file_sequence", "row_index").select("EMPLOYEE_ID").collect()]
    assert order == list(range(20_000))
    sizes = [r["count"] for r in rows.groupBy("file_sequence").count().collect()]
    assert max(sizes) <= 1_500 and len(sizes) >= 14


def test_rows_of_one_position_do_not_share_one_task(spark, home):
    events = spark.range(30_000).selectExpr(
        "'oracle.HR.EMPLOYEES' as topic", "cast(null as string) as key", "if(id % 3 = 0, 5, id) as pos",
        "concat('{\"after\":{\"EMPLOYEE_ID\":', id, '}}') as value",
    )
    tasks = []
    original = L._staged_files

    def spy(spark, files, staging, *more):
        tasks.extend(files.names(staging))
        return original(spark, files, staging, *more)

    L._staged_files = spy
    try:
        sink(home, EMPLOYEES, max_records_per_file=2_000)(events, 0)
    finally:
        L._staged_files = original
    parts = [n.split("-")[1] for n in tasks if n.startswith("part-")]
    assert len(set(parts)) >= 12
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES)
    assert rows.select("EMPLOYEE_ID").distinct().count() == 30_000 == rows.count()


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["decoded", "quarantined", "staged", "planned", "renamed", "published", "committed"])
def test_a_repeated_batch_neither_doubles_nor_loses_rows(spark, home, step):
    events = X.order_events(spark, "/root/testdata/sf0.001")
    pending = [step]

    def stop_once(at, folder):
        if pending and at == pending[0]:
            pending.clear()
            raise Stop(at)

    target = sink(home, X.ORDERS, max_records_per_file=500, on_step=stop_once)
    with pytest.raises((Stop, ExceptionGroup)):
        target(events, 0)
    target(events, 0)
    target(events, 0)
    rows = read_landing(spark, f"{home}/zone", X.ORDERS_FOLDER, X.ORDERS)
    assert rows.count() == 1631
    sequences = sorted(r.file_sequence for r in rows.select("file_sequence").distinct().collect())
    assert sequences == list(range(1, len(sequences) + 1))
    assert open(f"{home}/zone/{X.ORDERS_FOLDER}/_sequence.txt").read() == str(len(sequences))
    quarantined = spark.read.option("recursiveFileLookup", "true").parquet(f"{home}/zone/_quarantine")
    assert quarantined.count() == 15
    expected = project.convertible(
        project.project_rows(decode.decodable(decode.decode_events(events, "oracle")), X.ORDERS)
    ).select("row.*")
    assert rows.drop("file_sequence", "row_index").exceptAll(expected).count() == 0


def test_a_consumer_may_remove_published_files_before_the_repetition(spark, home):
    pending = ["published"]

    def stop_once(at, folder):
        if pending and at == pending[0]:
            pending.clear()
            raise Stop(at)

    target = sink(home, EMPLOYEES, on_step=stop_once)
    with pytest.raises(ExceptionGroup):
        target(feed(spark, THREE), 0)
    os.remove(f"{home}/zone/{FOLDER}/00000000000000000001.parquet")
    target(feed(spark, THREE), 0)
    target(feed(spark, THREE, first=3), 1)
    assert [n for n in visible(f"{home}/zone/{FOLDER}") if n.endswith(".parquet")] == ["00000000000000000002.parquet"]


def test_the_catalog_of_the_first_attempt_counts(spark, home):
    current, pending = [replace(EMPLOYEES, columns=EMPLOYEES.columns[:1])], ["quarantined"]

    def stop_once(at, folder):
        if pending and at == pending[0]:
            pending.clear()
            raise Stop(at)

    target = replace(sink(home, on_step=stop_once), catalog=lambda: {s.name: s for s in current})
    with pytest.raises(Stop):
        target(feed(spark, THREE), 0)
    current[0] = EMPLOYEES
    target(feed(spark, THREE), 0)
    target(feed(spark, THREE, first=3), 1)
    rows = read_landing(spark, f"{home}/zone", FOLDER).orderBy("file_sequence", "row_index").collect()
    assert [r.LAST_NAME for r in rows] == [None, None, None, "Okafor", "Varga", "Lund"]


def test_one_failing_table_does_not_stop_the_others(spark, home):
    departments = TableSpec("HR", "DEPARTMENTS", (ColumnSpec("DEPARTMENT_ID", "NUMBER", 4),), ("DEPARTMENT_ID",))

    def fail(at, folder):
        if folder.endswith("DEPARTMENTS") and fail.on:
            raise Stop(folder)

    fail.on = True
    target = sink(home, EMPLOYEES, departments, on_step=fail)
    both = feed(spark, THREE).unionByName(
        feed(spark, [("c", None, {"DEPARTMENT_ID": 5})], "oracle.HR.DEPARTMENTS", 3)
    )
    with pytest.raises(ExceptionGroup):
        target(both, 0)
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3
    fail.on = False
    target(both, 0)
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3
    assert read_landing(spark, f"{home}/zone", "HR.schema/DEPARTMENTS", departments).count() == 1


def test_unknown_tables_are_quarantined_until_the_catalog_has_them(spark, home):
    target = sink(home)
    target(feed(spark, THREE), 0)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{home}/zone/_quarantine").orderBy("pos").collect()
    assert [(r.folder, r.reason, r.marker) for r in rows] == [(FOLDER, "unknown table", m) for m in (0, 1, 2)]
    assert json.loads(rows[0].value)["after"]["EMPLOYEE_ID"] == 41
    replace(target, catalog=static_catalog(EMPLOYEES))(feed(spark, THREE, first=3), 1)
    assert read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).count() == 3


def test_landing_fills_updates_from_a_snapshot(spark, home):
    changes = [("u", {"EMPLOYEE_ID": 7}, None), ("u", {"EMPLOYEE_ID": 8, "LAST_NAME": "old"}, None)]
    snapshot = spark.sql("select 7L as EMPLOYEE_ID, 'Ann' as FIRST_NAME, 'Lee' as LAST_NAME, date'2024-03-18' as HIRE_DATE, 1.5 as SALARY")
    sink(home, EMPLOYEES, snapshots={"HR.EMPLOYEES": lambda s: snapshot})(feed(spark, changes), 0)
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES).orderBy("EMPLOYEE_ID").collect()
    assert [(r.EMPLOYEE_ID, r.LAST_NAME, r.SALARY, r["__rowMarker__"]) for r in rows] == [(7, "Lee", 1.5, 1), (8, "old", None, 1)]


def test_other_names_for_marker_and_state(spark, home):
    sink(home, EMPLOYEES, marker="kind", state_file="_last.txt")(feed(spark, THREE), 0)
    assert visible(f"{home}/zone/{FOLDER}") == ["00000000000000000001.parquet", "_last.txt", "_metadata.json"]
    assert [r.kind for r in read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES, "kind").collect()] == [0, 1, 2]


def test_reading_after_a_sequence_opens_later_files_only(spark, home):
    target = sink(home, EMPLOYEES)
    for batch in range(3):
        target(feed(spark, THREE, first=3 * batch), batch)
    rows = read_landing(spark, f"{home}/zone", FOLDER, EMPLOYEES, after_sequence=2)
    assert {r.file_sequence for r in rows.collect()} == {3}
    assert rows.select(F.count("*")).first()[0] == 3


def test_a_used_batch_number_takes_no_other_events(spark, home):
    from tidemark.streaming.sink import BatchMismatch

    target = sink(home, EMPLOYEES)
    first = feed(spark, THREE)
    target(first, 0)
    target(first, 0)
    with pytest.raises(BatchMismatch):
        target(feed(spark, THREE[:2], first=10), 0)
    manifests = target.land_batch(feed(spark, THREE[:2], first=10))
    assert [n for _, n in manifests[FOLDER]["files"]] == [2]
    assert target.land_batch(feed(spark, THREE[:1], first=20))[FOLDER]["first"] == 3


def test_a_used_batch_number_takes_no_other_values(spark, home):
    """Equal tables, positions and operations; only a key or a value differs, or equal events cancel each other."""
    from tidemark.streaming.sink import BatchMismatch

    def events(*rows):
        return spark.createDataFrame([("oracle.HR.EMPLOYEES", k, json.dumps({"op": "c", "after": {"EMPLOYEE_ID": v}}), p) for k, v, p in rows], EVENT_SCHEMA)

    target = sink(home, EMPLOYEES)
    batches = [[(None, 1, 0), (None, 2, 1)], [(None, 1, 0), (None, 3, 1)], [("k", 1, 0), (None, 2, 1)], [(None, 2, 0), (None, 1, 1)]]
    target(events(*batches[0]), 0)
    for other in batches[1:]:
        with pytest.raises(BatchMismatch):
            target(events(*other), 0)
    target(events((None, 1, 0), (None, 1, 0)), 1)
    with pytest.raises(BatchMismatch):
        target(events((None, 2, 0), (None, 2, 0)), 1)
    target(events(*reversed(batches[0])), 0)


def test_numbers_bound_by_the_older_fingerprint_stay_bound(spark, home):
    from tidemark.operators.decode import decode_events
    from tidemark.streaming.sink import BatchMismatch

    target, first = sink(home, EMPLOYEES), feed(spark, THREE)
    target(first, 0)
    old = decode_events(first, "oracle").agg(F.bit_xor(F.xxhash64("topic", "pos", "marker", "op")).alias("f")).first().f
    with open(f"{home}/checkpoint/landing/0/input.json", "w") as file:
        json.dump([[FOLDER, 3, 0, old]], file)
    for name in os.listdir(f"{home}/checkpoint/landing/0"):
        if name.endswith("input.json.crc"):
            os.truncate(f"{home}/checkpoint/landing/0/{name}", 0)
    target(first, 0)
    with pytest.raises(BatchMismatch):
        target(feed(spark, THREE[:2], first=10), 0)


def test_old_batches_stay_known(spark, home):
    target = sink(home, EMPLOYEES)
    for n in range(3):
        target(feed(spark, THREE[:1], first=n), n * 200)
    target(feed(spark, THREE[:1], first=0), 0)
    assert len([p for p in os.listdir(f"{target.options.base}/{FOLDER}") if p.endswith(".parquet") and not p.startswith(".")]) == 3


def test_a_stopped_replay_of_the_quarantine_lands_once(spark, home):
    known, steps = {}, []

    def stop(step, folder):
        if step == "renamed" and known and not steps:
            steps.append(step)
            raise RuntimeError("stopped")

    target = replace(sink(home), catalog=lambda: known, on_step=stop)
    assert target.replay_unknown(spark) == {}
    target.land_batch(feed(spark, THREE))
    known[EMPLOYEES.name] = EMPLOYEES
    with pytest.raises(ExceptionGroup):
        target.replay_unknown(spark)
    target.replay_unknown(spark)
    assert target.replay_unknown(spark) == {}
    rows = spark.read.parquet(f"{target.options.base}/{FOLDER}").select("EMPLOYEE_ID").collect()
    assert sorted(r.EMPLOYEE_ID for r in rows) == [41, 42, 43]
