"""Reading in ranges of a key: every row once, even ranges on skewed keys, text of the conditions."""

import datetime
import decimal

import pytest

from tidemark.sources.ranges import range_conditions, read_jdbc_ranges, split_points


def test_every_row_meets_one_condition(spark):
    rows = [(a, b, f"x'{(b or 0) % 7}") for a in (1, 1, 1, 1, 1, 2, 3, None) for b in [*range(200), None]]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(5)
    for keys, parts in ((["a"], 4), (["a", "b"], 8), (["c", "a", "b"], 6), (["b", "c"], 1)):
        conditions = range_conditions(keys, split_points(df, keys, parts))
        assert 1 <= len(conditions) <= parts
        counts = [df.filter(c).count() for c in conditions]
        assert sum(counts) == df.count()
        assert df.filter(" AND ".join(f"NOT coalesce({c}, false)" for c in map("({})".format, conditions))).isEmpty()
    assert range_conditions(["a"], split_points(df.limit(0), ["a"], 4)) == ["1 = 1"]


def test_ranges_are_even_on_a_skewed_first_column(spark):
    df = spark.range(30_000).selectExpr("if(id % 10 < 9, 'hot', concat('cold', id % 5)) as a", "id as b")
    conditions = range_conditions(["a", "b"], split_points(df, ["a", "b"], 10))
    counts = [df.filter(c).count() for c in conditions]
    assert len(counts) == 10 and sum(counts) == 30_000 and max(counts) < 4_500 and min(counts) > 1_800


def test_values_of_all_kinds_are_written_as_sql(spark):
    values = [(datetime.date(2020, 2, 29), datetime.datetime(2021, 3, 4, 5, 6, 7, 89), decimal.Decimal("1.50"), "it's", True)]
    df = spark.createDataFrame(values, "d date, t timestamp, n decimal(10,2), s string, f boolean")
    low, high = range_conditions(df.columns, values)
    assert df.filter(low).count() == 0 and df.filter(high).count() == 1


def test_a_database_is_read_by_its_conditions(spark, monkeypatch):
    asked = []
    table = spark.range(100).selectExpr("id as K")

    class Reader:
        def jdbc(self, url, name, predicates=None, properties=None):
            asked.append((url, name, predicates, properties))
            return table

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    assert read_jdbc_ranges(spark, "jdbc:x", "S.T", ["K"], 4, user="u") is table
    monkeypatch.undo()
    assert asked[0][:3] == ("jdbc:x", "(SELECT K FROM S.T) k", None) and asked[1][:2] == ("jdbc:x", "S.T")
    assert len(asked[1][2]) == 4 and sum(table.filter(c).count() for c in asked[1][2]) == 100
    assert asked[1][3] == {"user": "u"}


@pytest.mark.parametrize("points, expected", [([], ["1 = 1"]), ([(5,)], ["(k IS NOT NULL AND ((k < 5))) OR k IS NULL", "k IS NOT NULL AND ((k >= 5))"])])
def test_text_of_conditions(points, expected):
    assert range_conditions(["k"], points) == expected
