"""Decoding, projection, lookup and refusal on literal events."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.convert import Units
from tidemark.operators import decode, lookup, project
from tidemark.sources.catalog import ColumnSpec, TableSpec

SPEC = TableSpec("HR", "EMP", (ColumnSpec("ID", "NUMBER", 9, 0), ColumnSpec("NAME", "VARCHAR2"), ColumnSpec("HIRED", "DATE")), ("ID",))
ROW, OLD = '{"ID":1,"NAME":"new","HIRED":19800}', '{"ID":1,"NAME":"old"}'


def events(spark, *pairs):
    rows = [("oracle.HR.EMP", k, v, i) for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, "topic STRING, key STRING, value STRING, pos BIGINT")


def decoded_rows(spark, *values, **options):
    decoded = decode.decode_events(events(spark, *[(None, v) for v in values]), "oracle")
    rows = project.project_rows(decode.decodable(decoded), SPEC, **options).orderBy("pos").collect()
    return [(r["row"].ID, r["row"].NAME, r["row"]["__rowMarker__"], r.needs_lookup) for r in rows]


@pytest.mark.parametrize("wrap", [False, True])
def test_images_and_markers(spark, wrap):
    values = [
        f'{{"op":"c","before":null,"after":{ROW}}}',
        f'{{"op":"r","after":{ROW}}}',
        f'{{"op":"u","before":{OLD},"after":{ROW}}}',
        f'{{"op":"d","before":{OLD},"after":null}}',
        f'{{"after":{ROW}}}',
        f'{{"op":"x","before":{OLD},"after":{ROW}}}',
        f'{{"op":"x","before":{OLD}}}',
        f'{{"op":"x","before":{OLD},"after":null}}',
        f'{{"op":"c","before":{OLD}}}',
        f'{{"op":"d","after":{ROW}}}',
    ]
    if wrap:
        values = [f'{{"payload":{v}}}' for v in values]
    assert decoded_rows(spark, *values) == [
        (1, "new", 0, False),
        (1, "new", 0, False),
        (1, "new", 1, False),
        (1, "old", 2, False),
        (1, "new", 0, False),
        (1, "new", 0, False),
        (1, "old", 0, False),
        (None, None, 0, False),
        (None, None, 0, False),
        (None, None, 2, False),
    ]


def test_documents_without_members_give_an_empty_insert(spark):
    empty = (None, None, 0, False)
    assert decoded_rows(spark, "null", "5", "[]", "{}", '{"payload":null,"op":"d"}', '{"payload":5}') == [empty] * 6


def test_updates_without_an_image(spark):
    values = [
        f'{{"op":"u","before":{OLD},"after":null}}',
        f'{{"op":"u","before":{OLD},"after":{{}}}}',
        f'{{"op":"u","before":{OLD}}}',
        '{"op":"u","after":null}',
        '{"op":"u","before":null,"after":{}}',
        f'{{"op":"u","before":{OLD},"after":{{"OTHER":1}}}}',
    ]
    old, empty = (1, "old", 1, True), (None, None, 1, False)
    assert decoded_rows(spark, *values) == [old, old, old, empty, (None, None, 1, True), empty]
    assert decoded_rows(spark, *values, lookup_updates=False) == [empty] * 6


def test_tombstones(spark):
    feed = events(spark, ('{"ID":1}', None), ('{"payload":{"ID":2}}', None), (None, None), ("{bad", None), ('{"payload":null}', None))
    decoded = decode.decode_events(feed, "oracle")
    rows = project.project_rows(decode.decodable(decoded), SPEC).orderBy("pos").collect()
    assert [(r.pos, r["row"].ID, r["row"]["__rowMarker__"]) for r in rows] == [(0, 1, 2), (1, 2, 2), (2, None, 2), (4, None, 2)]
    assert [tuple(r) for r in decode.refused(decoded).select("pos", "reason", "key").collect()] == [(3, "malformed key", "{bad")]
    assert decode.decode_events(feed, "oracle", tombstones="drop").count() == 0
    with pytest.raises(ValueError):
        decode.decode_events(feed, tombstones="keep")


def test_malformed_values_are_refused_with_their_text(spark):
    decoded = decode.decode_events(events(spark, ('{"ID":1}', "{bad"), (None, "")), "oracle")
    assert decode.decodable(decoded).count() == 0
    rows = {tuple(r) for r in decode.refused(decoded).select("key", "value", "reason").collect()}
    assert rows == {('{"ID":1}', "{bad", "malformed value"), (None, "", "malformed value")}


def test_unconvertible_values_are_refused_by_name(spark):
    values = ['{"after":{"ID":3000000000,"NAME":"x","HIRED":"soon"}}', '{"after":{"ID":2,"NAME":null}}', '{"after":{"ID":"7"}}']
    decoded = decode.decodable(decode.decode_events(events(spark, *[(None, v) for v in values]), "oracle"))
    rows = project.project_rows(decoded, SPEC)
    refused = project.refused_rows(rows, "HR.schema/EMP").collect()
    assert [(r.pos, r.reason) for r in refused] == [(0, "unconvertible: ID, HIRED")]
    assert json.loads(refused[0].value)["after"] == {"ID": 3000000000, "NAME": "x", "HIRED": "soon"}
    assert sorted(r["row"].ID for r in project.convertible(rows).collect()) == [2, 7]


def test_unconvertible_units(spark):
    decoded = decode.decodable(decode.decode_events(events(spark, (None, '{"after":{"HIRED":1700000000123}}')), "oracle"))
    rows = project.project_rows(decoded, SPEC, Units(date="days"))
    assert [r.bad_columns for r in rows.collect()] == ["HIRED"]


def test_odd_column_names(spark):
    spec = TableSpec("S", "T", tuple(ColumnSpec(n, "VARCHAR2") for n in ("it's", 'a"b', "a.b", "a b", "`c`", "$[x]")))
    image = {c.name: c.name for c in spec.columns}
    decoded = decode.decodable(decode.decode_events(events(spark, (None, json.dumps({"after": image}))), "oracle"))
    row = project.convertible(project.project_rows(decoded, spec)).collect()[0]["row"]
    assert row.asDict() == {**image, "__rowMarker__": 0}


def test_marker_column_name_is_free(spark):
    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER", 5), ColumnSpec("kind", "VARCHAR2")))
    decoded = decode.decodable(decode.decode_events(events(spark, (None, '{"op":"d","before":{"A":1,"kind":"x"}}')), "oracle"))
    row = project.convertible(project.project_rows(decoded, spec, marker="kind")).collect()[0]["row"]
    assert row.asDict() == {"A": 1, "kind": 2}


@pytest.mark.parametrize("limit", [100, 1])
def test_lookup_fills_from_the_snapshot(spark, limit):
    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER", 5), ColumnSpec("B", "VARCHAR2"), ColumnSpec("C", "DATE"), ColumnSpec("D", "NUMBER", 5)), ("A", "B"))
    values = [
        '{"op":"u","before":{"A":1,"B":"x"},"after":null}',
        '{"op":"u","before":{"A":2,"B":"x","D":"bad"},"after":null}',
        '{"op":"u","before":{"A":1,"B":null},"after":null}',
        '{"op":"u","before":{"A":9,"B":"x","D":9},"after":{}}',
        '{"op":"c","after":{"A":1,"B":"x"}}',
    ]
    snapshot = spark.sql(
        "select * from values (1L, 'x', date'2024-01-01'), (1L, 'x', date'2024-01-01'), (2L, 'x', date'2024-02-02'), (5L, 'y', null) as t(A, B, C)"
    )
    decoded = decode.decodable(decode.decode_events(events(spark, *[(None, v) for v in values]), "oracle"))
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, spec), snapshot, spec, max_broadcast_keys=limit)
    rows = [(r.pos, r["row"].A, str(r["row"].C), r["row"].D, r["row"]["__rowMarker__"], r.bad_columns) for r in filled.orderBy("pos").collect()]
    assert rows == [
        (0, 1, "2024-01-01", None, 1, ""),
        (1, 2, "2024-02-02", None, 1, ""),
        (2, 1, "None", None, 1, ""),
        (3, 9, "None", 9, 1, ""),
        (4, 1, "None", None, 0, ""),
    ]


@pytest.mark.parametrize("limit", [1000, 1])
def test_lookup_decodes_its_events_twice_at_most(spark, limit):
    """Once for the waiting rows and once for the result, however often the keys are asked."""
    read = spark.sparkContext.accumulator(0)

    def counted(values):
        read.add(len(values))
        return values

    value = F.pandas_udf(counted, "string").asNondeterministic()
    feed = spark.range(600, numPartitions=2).selectExpr(
        "'oracle.HR.EMP' as topic", "cast(null as string) as key", "id as pos", "concat('{\"op\":\"u\",\"before\":{\"ID\":', id, '},\"after\":null}') as value"
    )
    decoded = decode.decodable(decode.decode_events(feed.withColumn("value", value("value")), "oracle"))
    snapshot = spark.range(600).selectExpr("id as ID", "concat('n', id) as NAME")
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, SPEC), snapshot, SPEC, max_broadcast_keys=limit)
    assert all(r["row"].NAME == f"n{r.pos}" for r in filled.collect())
    assert 600 < read.value <= 1200


def test_lookup_without_keys_or_snapshot_changes_nothing(spark):
    decoded = decode.decodable(decode.decode_events(events(spark, (None, f'{{"op":"u","before":{OLD}}}')), "oracle"))
    rows = project.project_rows(decoded, SPEC)
    keyless = TableSpec("HR", "EMP", SPEC.columns)
    assert lookup.fill_from_snapshot(rows, None, SPEC) is rows
    assert lookup.fill_from_snapshot(rows, spark.range(1), keyless) is rows


def test_hot_lookup_key_is_spread(spark):
    """A third of all rows update one key: no task gets them all, and nothing is lost."""
    hot = spark.range(60_000).selectExpr(
        "'oracle.HR.EMP' as topic", "cast(null as string) as key", "id as pos",
        "concat('{\"op\":\"u\",\"before\":{\"ID\":', if(id % 3 = 0, 7, id), '},\"after\":null}') as value",
    )
    snapshot = spark.range(60_000).selectExpr("id as ID", "concat('n', id) as NAME")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        decoded = decode.decodable(decode.decode_events(hot, "oracle"))
        rows = project.project_rows(decoded, SPEC)
        filled = lookup.fill_from_snapshot(rows, snapshot, SPEC, max_broadcast_keys=10, rows_per_slice=500)
        out = filled.select("pos", F.col("row.NAME").alias("name"), F.col("row.ID").alias("id"), F.spark_partition_id().alias("task"))
        assert out.filter(F.col("name") == F.concat(F.lit("n"), "id")).select("pos").distinct().count() == 60_000
        assert out.count() == 60_000
        assert out.groupBy("task").count().agg(F.max("count")).first()[0] < 60_000 / 6
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("n", [lookup.MAX_PUSHED_KEYS - 100, lookup.MAX_PUSHED_KEYS + 100])
def test_lookup_answers_alike_at_every_number_of_keys(spark, n):
    """DATE keys against times of the day in the snapshot, and timestamps that differ below the millisecond."""
    for kind, before, own in (
        ("DATE", "id", "cast(date_from_unix_date(cast(id as int)) as timestamp) + interval 10 hours 30 minutes"),
        ("TIMESTAMP(6)", "1700000000001000 + id * 1000000", "timestamp_micros(1700000000001789 + id * 1000000)"),
    ):
        spec = TableSpec("S", "T", (ColumnSpec("A", kind), ColumnSpec("B", "VARCHAR2")), ("A",))
        feed = spark.range(n).selectExpr(
            "'oracle.S.T' as topic", "cast(null as string) as key", "id as pos",
            f"""concat('{{"op":"u","before":{{"A":', {before}, '}},"after":null}}') as value""",
        )
        rows = project.project_rows(decode.decodable(decode.decode_events(feed, "oracle")), spec)
        filled = lookup.fill_from_snapshot(rows, spark.range(n).selectExpr(f"{own} as A", "'found' as B"), spec)
        assert filled.filter("row.B = 'found'").count() == n


def test_a_snapshot_value_that_does_not_fit_refuses_its_row(spark):
    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER", 5), ColumnSpec("B", "NUMBER", 9)), ("A",))
    values = ['{"op":"u","before":{"A":1},"after":null}', '{"op":"u","before":{"A":2},"after":null}']
    decoded = decode.decodable(decode.decode_events(events(spark, *[(None, v) for v in values]), "oracle"))
    snapshot = spark.createDataFrame([(1, 5_000_000_000), (2, 5)], "A BIGINT, B BIGINT")
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, spec), snapshot, spec).orderBy("pos").collect()
    assert [(r["row"].A, r["row"].B, r.bad_columns) for r in filled] == [(1, None, "B"), (2, 5, "")]


def test_conditions_pushed_to_the_snapshot_never_lose_a_match(spark):
    from datetime import date
    from decimal import Decimal

    from pyspark.sql import types as T

    cases = [
        ([Decimal("2.9"), Decimal("-2.9"), Decimal("3.0")], T.DecimalType(9, 1), T.IntegerType(), [2, -2]),
        ([2.5, 7.0, -0.5], T.DoubleType(), T.LongType(), [2, 0]),
        (["a", "b "], T.StringType(), T.StringType(), ["a"]),
        ([date(2024, 1, 1), date(2024, 1, 2)], T.DateType(), T.DateType(), [date(2024, 1, 2)]),
    ]
    for data, own, target, wanted in cases:
        df = spark.createDataFrame([(x,) for x in data], T.StructType([T.StructField("c", own)]))
        condition = lookup.may_equal(F.col("c"), own, target, wanted)
        typed = lookup.typed(F.col("c"), target).isin(wanted)
        assert condition is not None
        assert df.filter(typed & ~condition).count() == 0 and df.filter(typed).count() > 0


def test_booleans_and_non_finite_numbers_are_refused(spark):
    spec = TableSpec("S", "T", (ColumnSpec("A", "NUMBER", 5), ColumnSpec("D", "DATE"), ColumnSpec("X", "NUMBER"), ColumnSpec("T", "VARCHAR2")))
    values = ['{"A":true,"D":false,"X":true,"T":true}', '{"A":1,"D":0,"X":"NaN"}', '{"A":0,"X":1e999}', '{"A":1,"D":1,"X":0,"T":"1"}']
    decoded = decode.decodable(decode.decode_events(events(spark, *[(None, f'{{"after":{v}}}') for v in values]), "oracle"))
    rows = project.project_rows(decoded, spec).orderBy("pos").collect()
    assert [r.bad_columns for r in rows][:2] == ["A, D, X", "X"]
    assert rows[2].bad_columns in ("X",) and rows[3].bad_columns == ""
    assert (rows[3]["row"].A, rows[3]["row"].X, rows[3]["row"].T) == (1, 0.0, "1")
