"""Change events over the driver's tables, built in Spark, as inputs of queries, tests and bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare
from tidemark.sources.catalog import ColumnSpec, TableSpec

PREFIX = "oracle"
ORDERS_FOLDER = "SALES.schema/ORDERS"
USERS_FOLDER = "APP.schema/USER_STATE"

ORDERS = TableSpec(
    "SALES",
    "ORDERS",
    (
        ColumnSpec("O_ORDERKEY", "NUMBER", 18, 0, False, 1),
        ColumnSpec("O_CUSTKEY", "NUMBER", 9, 0, True, 2),
        ColumnSpec("O_ORDERSTATUS", "CHAR", 0, 0, True, 3),
        ColumnSpec("O_TOTALPRICE", "NUMBER", 12, 2, True, 4),
        ColumnSpec("O_ORDERDATE", "DATE", 0, 0, True, 5),
        ColumnSpec("O_ORDERPRIORITY", "VARCHAR2", 0, 0, True, 6),
    ),
    ("O_ORDERKEY",),
)
USERS = TableSpec(
    "APP",
    "USER_STATE",
    (
        ColumnSpec("USER_ID", "NUMBER", 18, 0, False, 1),
        ColumnSpec("EVENT_ID", "NUMBER", 18, 0, True, 2),
        ColumnSpec("EVENT_TYPE", "VARCHAR2", 0, 0, True, 3),
        ColumnSpec("VALUE", "NUMBER", 0, 0, True, 4),
        ColumnSpec("TS", "TIMESTAMP(6)", 0, 0, True, 5),
    ),
    ("USER_ID",),
)

# What each order row becomes; the first matching rule wins.
ORDER_KINDS = (
    ("k % 101 = 0", "malformed"),
    ("k % 97 = 0", "unknown_op"),
    ("k % 103 = 0", "no_op"),
    ("k % 10 <= 3", "create"),
    ("k % 10 = 4", "snapshot"),
    ("k % 10 in (5, 6)", "update"),
    ("k % 10 = 7", "thin_update"),
    ("k % 10 = 8", "delete"),
    ("k % 10 = 9", "delete_tombstone"),
)
KIND_SQL = "case " + " ".join(f"when {rule} then '{kind}'" for rule, kind in ORDER_KINDS) + " end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under their catalog names, with wire values: dates are epoch milliseconds."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as O_ORDERKEY",
        "o_custkey as O_CUSTKEY",
        "o_orderstatus as O_ORDERSTATUS",
        "o_totalprice as O_TOTALPRICE",
        "unix_millis(cast(o_orderdate as timestamp)) as O_ORDERDATE",
        "o_orderpriority as O_ORDERPRIORITY",
    )


def order_events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """E1: every operation, malformed values and tombstones; even keys are wrapped in ``payload``.

    With ``tasks`` the orders are spread over so many before they become text; else tasks follow the table's row groups.
    """
    rows = order_rows(spark, sf_dir)
    if tasks:
        rows = rows.repartition(tasks, "O_ORDERKEY")
    raised = F.struct(*[(F.col(c) + 1 if c == "O_TOTALPRICE" else F.col(c)).alias(c) for c in rows.columns])
    texts = rows.select(
        F.col("O_ORDERKEY").alias("k"),
        F.to_json(F.struct(*rows.columns)).alias("row"),
        F.to_json(raised).alias("raised"),
        F.to_json(F.struct("O_ORDERKEY")).alias("key"),
    ).withColumn("kind", F.expr(KIND_SQL))

    def envelope(op: str, before: str, after: str) -> str:
        parts = (f"""'{{"op":"{op}","before":'""", before, """',"after":'""", after, "'}'")
        return f"concat({', '.join(parts)})"

    null = "'null'"
    bodies = {
        "unknown_op": envelope("t", "row", "row"),
        "no_op": """concat('{"after":', row, '}')""",
        "create": envelope("c", null, "row"),
        "snapshot": envelope("r", null, "row"),
        "update": envelope("u", "row", "raised"),
        "thin_update": envelope("u", "key", null),
        "delete": envelope("d", "row", null),
        "delete_tombstone": envelope("d", "row", null),
    }
    body = "case kind " + " ".join(f"when '{kind}' then {text}" for kind, text in bodies.items()) + " end"
    value = (
        f"case when kind = 'malformed' then '{{bad'"
        f" when k % 2 = 0 then concat('{{\"payload\":', body, '}}') else body end"
    )
    changes = texts.withColumn("body", F.expr(body)).selectExpr(
        f"'{PREFIX}.SALES.ORDERS' as topic", "key", f"{value} as value", "2 * k as pos", "kind"
    )
    # A deleted row with a tombstone gives two events.
    copies = F.when(F.col("kind") == "delete_tombstone", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changes.withColumn("copy", F.explode(copies)).selectExpr(
        "topic", "key", "if(copy = 1, null, value) as value", "pos + copy as pos"
    )


def user_events(
    spark: SparkSession, sf_dir: str, topic: str = f"{PREFIX}.APP.USER_STATE", tasks: int | None = None
) -> DataFrame:
    """E2: many changes per user; ``error`` events delete the user. With ``tasks`` they are spread as in :func:`order_events`."""
    rows = table(spark, sf_dir, "events")
    if tasks:
        rows = rows.repartition(tasks, "event_id")
    row = (
        rows.selectExpr(
            "user_id as USER_ID",
            "event_id as EVENT_ID",
            "event_type as EVENT_TYPE",
            "value as VALUE",
            "unix_micros(cast(ts as timestamp)) as TS",
        )
        .select("*", F.to_json(F.struct("USER_ID", "EVENT_ID", "EVENT_TYPE", "VALUE", "TS")).alias("row"))
    )
    delete = "concat('{\"op\":\"d\",\"before\":', row, ',\"after\":null}')"
    update = "concat('{\"op\":\"u\",\"before\":null,\"after\":', row, '}')"
    return row.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct("USER_ID")).alias("key"),
        F.expr(f"if(EVENT_TYPE = 'error', {delete}, {update})").alias("value"),
        F.col("EVENT_ID").alias("pos"),
    )


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).unionByName(user_events(spark, sf_dir))


def order_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows for the lookup: only orders of customers with an even key."""
    return table(spark, sf_dir, "orders").filter("o_custkey % 2 = 0").selectExpr(
        "o_orderkey as O_ORDERKEY",
        "o_custkey as O_CUSTKEY",
        "o_orderstatus as O_ORDERSTATUS",
        "o_totalprice as O_TOTALPRICE",
        "cast(o_orderdate as date) as O_ORDERDATE",
        "o_orderpriority as O_ORDERPRIORITY",
    )


def part_catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A source catalog that grows with ``part``: every part is a column, eight of them a table.

    Columns arrive in reverse order; every table has a two-column primary key and a unique key.
    """
    types = (
        "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE", "NUMBER", "FLOAT",
        "BINARY_FLOAT", "BINARY_DOUBLE", "VARCHAR2", "CLOB", "RAW(16)", "BLOB", "LONG RAW", "number", "XMLTYPE",
    )
    names = ", ".join(f"'{t}'" for t in types)
    part = table(spark, sf_dir, "part").selectExpr(
        "concat('S', cast(p_partkey div 8 % 5 as string)) as owner",
        "concat('T', cast(p_partkey div 8 as string)) as table_name",
        "concat('C', cast(p_partkey % 8 as string)) as column_name",
        "cast(p_partkey % 8 as int) as slot",
        "p_partkey",
    )
    columns = part.selectExpr(
        "owner",
        "table_name",
        "column_name",
        f"element_at(array({names}), cast(p_partkey % {len(types)} + 1 as int)) as data_type",
        "cast(if(p_partkey % 3 = 0, null, p_partkey % 23) as int) as data_precision",
        "cast(if(p_partkey % 5 < 2, null, p_partkey % 7 - 3) as int) as data_scale",
        "case when p_partkey % 11 = 0 then null when p_partkey % 2 = 0 then 'Y' else 'N' end as nullable",
        "8 - slot as column_id",
    )
    slots = part.filter("slot < 2")
    constraints = slots.selectExpr(
        "owner",
        "table_name",
        "concat(table_name, if(slot = 0, '_PK', '_UK')) as constraint_name",
        "if(slot = 0, 'P', 'U') as constraint_type",
    )
    key_columns = part.filter("slot < 3").selectExpr(
        "owner",
        "concat(table_name, if(slot = 2, '_UK', '_PK')) as constraint_name",
        "column_name",
        "if(slot = 2, 1, 2 - slot) as position",
    )
    return columns, constraints, key_columns
