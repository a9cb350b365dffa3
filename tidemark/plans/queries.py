"""Registered queries: every operator over the driver's tables, with the SQL that states its result.

The SQL computes the expected rows from the base tables and never sees an event or a file.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import convert, envelope, naming, routing
from tidemark.operators import changes, decode, lookup, project, resolve, state
from tidemark.operators.keep import keep_rows
from tidemark.plans import fixtures as X
from tidemark.plans.files import Files
from tidemark.plans.landing import LandingOptions, restore_sequence, scan_sequence
from tidemark.session import prepare, shared_dir
from tidemark.sources import catalog, events, history, landing, ranges
from tidemark.streaming.segments import FlushPolicy
from tidemark.streaming.sink import LandingSink, start_landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = lambda spark, sf_dir: run(prepare(spark), sf_dir)
        if oracle:
            ORACLE[run.__name__] = oracle
        return run

    return register


# --- shared pieces -----------------------------------------------------------------------------

# Expected decoded rows of the order events, one per event that can be decoded.
ORDER_ROWS = f"""
with o as (select *, {X.KIND_SQL} as kind from (select *, o_orderkey as k from orders)),
ev as (select *, 2 * k as pos from o
       union all by name
       select * replace ('tombstone' as kind), 2 * k + 1 as pos from o where kind = 'delete_tombstone'),
r as (select pos, k, kind, k as orderkey,
        case when kind in ('thin_update', 'tombstone') then null else cast(o_custkey as integer) end as custkey,
        case when kind in ('thin_update', 'tombstone') then null else o_orderstatus end as status,
        case when kind in ('thin_update', 'tombstone') then null
             when kind = 'update' then o_totalprice + 1 else o_totalprice end as price,
        case when kind in ('thin_update', 'tombstone') then null
             else cast(cast(o_orderdate as date) as varchar) end as orderdate,
        case when kind in ('thin_update', 'tombstone') then null else o_orderpriority end as priority,
        case when kind in ('update', 'thin_update') then 1
             when kind in ('delete', 'delete_tombstone', 'tombstone') then 2 else 0 end as row_marker,
        case kind when 'unknown_op' then 't' when 'no_op' then 'c' when 'create' then 'c' when 'snapshot' then 'r'
             when 'update' then 'u' when 'thin_update' then 'u' when 'tombstone' then null else 'd' end as op
      from ev where kind <> 'malformed')
"""
ORDER_COLUMNS = "orderkey, custkey, status, price, orderdate, priority, row_marker"

USER_CHANGES = """
with r as (select event_id as pos, user_id, event_type, value, ts,
             case when event_type = 'error' then 2 else 1 end as row_marker from events)
"""


def order_columns(row: str | None = None) -> list[Column]:
    """The landed order columns under the names the SQL uses."""
    at = f"{row}." if row else ""
    return [
        F.col(f"{at}O_ORDERKEY").alias("orderkey"),
        F.col(f"{at}O_CUSTKEY").alias("custkey"),
        F.col(f"{at}O_ORDERSTATUS").alias("status"),
        F.col(f"{at}O_TOTALPRICE").alias("price"),
        F.col(f"{at}O_ORDERDATE").cast("string").alias("orderdate"),
        F.col(f"{at}O_ORDERPRIORITY").alias("priority"),
        F.col(f"{at}{envelope.MARKER_COLUMN}").alias("row_marker"),
    ]


def decoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_events(X.order_events(spark, sf_dir), X.PREFIX)


def projected_orders(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return project.project_rows(decode.decodable(decoded_orders(spark, sf_dir)), X.ORDERS, **options)


def image_member(name: str, kind: str) -> Column:
    """One column of a decoded event's row image."""
    image = envelope.row_image(F.col("root"), F.col("wrapped"), F.col("op"), "variant")
    return convert.image_value(image, name, kind)


def order_documents(spark: SparkSession, sf_dir: str, document: str) -> DataFrame:
    """One made-up event document per order: ``document`` is SQL text over the order key ``k``."""
    keys = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return keys.select(
        "k", F.lit("oracle.SALES.ORDERS").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.expr(document).alias("value"), F.col("k").alias("pos"),
    )


def new_sink(spark: SparkSession, specs: tuple = (X.ORDERS, X.USERS), **options) -> LandingSink:
    home = shared_dir(spark)
    names = LandingOptions.__dataclass_fields__
    landing_options = LandingOptions(f"{home}/zone", **{k: v for k, v in options.items() if k in names})
    rest = {k: v for k, v in options.items() if k not in names}
    return LandingSink(
        landing_options, f"{home}/checkpoint", catalog.static_catalog(*specs), X.PREFIX, **rest
    )


def landed(spark: SparkSession, feed: DataFrame, specs: tuple = (X.ORDERS, X.USERS), **options) -> str:
    """Land a feed as one batch; returns the landing zone's folder."""
    sink = new_sink(spark, specs, **options)
    sink(feed, 0)
    return sink.options.base


class Interrupted(Exception):
    pass


def read_orders(spark: SparkSession, base: str) -> DataFrame:
    return landing.read_landing(spark, base, X.ORDERS_FOLDER, X.ORDERS)


def read_users(spark: SparkSession, base: str) -> DataFrame:
    return landing.read_landing(spark, base, X.USERS_FOLDER, X.USERS)


def spec_columns(spark: SparkSession, *specs: catalog.TableSpec) -> DataFrame:
    rows = [
        (s.schema, s.table, c.name, c.data_type, c.precision, c.scale, "Y" if c.nullable else "N", c.column_id)
        for s in specs
        for c in s.columns
    ]
    return spark.createDataFrame(rows, catalog.COLUMN_SCHEMA)


# --- sources and catalog -----------------------------------------------------------------------


@query(
    ORDER_ROWS
    + """select pos, 'oracle.SALES.ORDERS' as topic, '{"O_ORDERKEY":' || k || '}' as key,
    case when kind = 'tombstone' then 1 else 0 end as is_tombstone from ev"""
)
def scan_events(spark, sf_dir):
    path = f"{shared_dir(spark)}/events"
    X.order_events(spark, sf_dir).write.parquet(path)
    return events.read_events(spark, path).select(
        "pos", "topic", "key", F.col("value").isNull().cast("int").alias("is_tombstone")
    )


PART_COLUMNS = """
with p as (select p_partkey, p_partkey % 8 as slot, 'S' || (p_partkey // 8 % 5) as owner, 'T' || (p_partkey // 8) as table_name from part),
c as (select owner, table_name, 'C' || slot as column_name,
        ['DATE', 'TIMESTAMP(6)', 'TIMESTAMP(6) WITH TIME ZONE', 'TIMESTAMP WITH LOCAL TIME ZONE', 'NUMBER', 'FLOAT',
         'BINARY_FLOAT', 'BINARY_DOUBLE', 'VARCHAR2', 'CLOB', 'RAW(16)', 'BLOB', 'LONG RAW', 'number', 'XMLTYPE']
          [p_partkey % 15 + 1] as data_type,
        cast(case when p_partkey % 3 = 0 then 0 else p_partkey % 23 end as integer) as data_precision,
        cast(case when p_partkey % 5 < 2 then 0 else p_partkey % 7 - 3 end as integer) as data_scale,
        case when p_partkey % 11 <> 0 and p_partkey % 2 = 0 then 1 else 0 end as nullable,
        cast(8 - slot as integer) as column_id from p),
t as (select *, case
        when data_type = 'DATE' then 'date'
        when data_type in ('TIMESTAMP(6) WITH TIME ZONE', 'TIMESTAMP WITH LOCAL TIME ZONE') then 'string'
        when data_type = 'TIMESTAMP(6)' then 'timestamp'
        when upper(data_type) = 'NUMBER' and (data_precision = 0 or data_scale > 0 or data_precision > 18) then 'double'
        when upper(data_type) = 'NUMBER' and data_precision > 9 then 'bigint'
        when upper(data_type) = 'NUMBER' then 'int'
        when data_type in ('FLOAT', 'BINARY_FLOAT') then 'float'
        when data_type = 'BINARY_DOUBLE' then 'double'
        when data_type in ('RAW(16)', 'BLOB', 'LONG RAW') then 'binary'
        else 'string' end as landing_type from c)
"""


@query(
    PART_COLUMNS
    + """select *, cast(row_number() over (partition by owner, table_name order by column_id) as integer) as ordinal from c"""
)
def catalog_columns(spark, sf_dir):
    columns, _, _ = X.part_catalog(spark, sf_dir)
    return catalog.catalog_columns(columns).withColumn("nullable", F.col("nullable").cast("int"))


PART_KEYS = """
with p as (select p_partkey % 8 as slot, 'S' || (p_partkey // 8 % 5) as owner, 'T' || (p_partkey // 8) as table_name from part),
keyed as (select owner, table_name from p where slot = 0),
k as (select owner, table_name, 'C' || slot as column_name, cast(2 - slot as integer) as position
      from p join keyed using (owner, table_name) where slot < 2)
"""


@query(
    PART_KEYS
    + "select *, cast(row_number() over (partition by owner, table_name order by position) as integer) as ordinal from k"
)
def catalog_keys(spark, sf_dir):
    _, constraints, key_columns = X.part_catalog(spark, sf_dir)
    return catalog.catalog_keys(constraints, key_columns)


@query(PART_COLUMNS + "select owner, table_name, column_name, landing_type from t")
def type_mapping(spark, sf_dir):
    columns, _, _ = X.part_catalog(spark, sf_dir)
    return catalog.landing_types(columns).select("owner", "table_name", "column_name", "landing_type")


@query(
    PART_COLUMNS
    + """select owner, table_name, cast(count(*) as integer) as n_columns,
    string_agg(column_name || ' ' || landing_type, ', ' order by column_id) || ', __rowMarker__ int NOT NULL' as ddl
    from t group by all"""
)
def landing_schema(spark, sf_dir):
    columns, _, _ = X.part_catalog(spark, sf_dir)
    return catalog.landing_schemas(columns)


@query(
    PART_KEYS
    + """select owner, table_name, '{"keyColumns":[' || string_agg('"' || column_name || '"', ',' order by position) || ']}' as metadata
    from k group by all"""
)
def key_metadata_json(spark, sf_dir):
    _, constraints, key_columns = X.part_catalog(spark, sf_dir)
    keys = catalog.catalog_keys(constraints, key_columns)
    metadata = naming.key_metadata_column(F.col("position"), F.col("column_name")).alias("metadata")
    return keys.groupBy("owner", "table_name").agg(metadata)


@query(
    """select folder, upper(replace(folder, '.schema/', '.')) as catalog_name, count(*) as n_events,
    case when folder like '%MISSING' then 0 else 5 end as n_columns
    from (select ['APP.schema/USER_STATE', 'app.schema/user_state', 'App.schema/User_State', 'APP.schema/MISSING']
          [event_id % 4 + 1] as folder from events) group by all"""
)
def catalog_resolve(spark, sf_dir):
    topics = "array('oracle.APP.USER_STATE', 'oracle.app.user_state', 'oracle.App.User_State', 'oracle.APP.MISSING')"
    feed = X.user_events(spark, sf_dir).withColumn("topic", F.expr(f"element_at({topics}, cast(pos % 4 + 1 as int))"))
    none = (spark.createDataFrame([], s) for s in (catalog.CONSTRAINT_SCHEMA, catalog.KEY_COLUMN_SCHEMA))
    current = catalog.cached_catalog(lambda: catalog.collect_catalog(spec_columns(spark, X.ORDERS, X.USERS), *none))
    known = [current() for _ in range(2)][-1]  # the second call is answered by the cache
    found = resolve.resolve_tables(events.with_folder(feed, X.PREFIX), spec_columns(spark, *known.values()))
    return found.select(
        "folder", "catalog_name", "n_events", F.coalesce("n_columns", F.lit(0)).cast("int").alias("n_columns")
    )


@query("select 'oracle.APP.USER_STATE' as topic, event_id as pos from events")
def filter_allowlist(spark, sf_dir):
    return events.allow_tables(
        X.all_events(spark, sf_dir), tables=["APP.USER_STATE", "HR.PROJECTS"], schemas=["HR"], prefix=X.PREFIX
    ).select("topic", "pos")


@query(
    ORDER_ROWS
    + """select pos, orderkey, price, row_marker, op from r
    union all select -k - 1 as pos, k as orderkey, o_totalprice as price, 0 as row_marker, 'r' as op from o"""
)
def snapshot_union(spark, sf_dir):
    rows = X.order_rows(spark, sf_dir)
    snapshot = rows.select(
        F.lit("oracle.SALES.ORDERS").alias("topic"),
        F.to_json(F.struct("O_ORDERKEY")).alias("key"),
        F.to_json(F.struct(F.lit("r").alias("op"), F.struct(*rows.columns).alias("after"))).alias("value"),
        (-F.col("O_ORDERKEY") - 1).alias("pos"),
    )
    feed = events.with_snapshot(snapshot, X.order_events(spark, sf_dir))
    decoded = decode.decodable(decode.decode_events(feed, X.PREFIX))
    rows = project.project_rows(decoded, X.ORDERS)
    return rows.select(
        "pos",
        F.col("row.O_ORDERKEY").alias("orderkey"),
        F.col("row.O_TOTALPRICE").alias("price"),
        F.col(f"row.{envelope.MARKER_COLUMN}").alias("row_marker"),
        "op",
    )


# --- routing and envelope ----------------------------------------------------------------------


@query(
    """select k, case k % 8 when 0 then 'HR.schema/EMPLOYEES_' || k when 1 then 'HR.schema/A_B' || k
      when 2 then 'HR.schema/EMP' || k when 3 then 'EMP' || k when 4 then '_EMP' || k when 5 then 'HR' || k || '_'
      when 6 then '' else 'oracleX.schema/HR_T' || k end as folder,
    case k % 8 when 0 then 'oracle.schema/HR_EMPLOYEES_' || k when 1 then 'oracle.schema/HR_A_B' || k
      when 2 then 'HR.schema/EMP' || k when 3 then 'oracle.schema/EMP' || k when 4 then '_EMP' || k
      when 5 then 'HR' || k || '_' when 6 then 'oracle_' else 'oracleX.schema/HR_T' || k end as folder_without_prefix
    from (select o_orderkey as k from orders)"""
)
def route_topics(spark, sf_dir):
    topic = """case k % 8 when 0 then concat('oracle.HR.EMPLOYEES_', k) when 1 then concat('oracle.HR.A.B', k)
      when 2 then concat('HR.EMP', k) when 3 then concat('oracle.EMP', k) when 4 then concat('.EMP', k)
      when 5 then concat('HR', k, '.') when 6 then 'oracle.' else concat('oracleX.HR.T', k) end"""
    feed = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).withColumn("topic", F.expr(topic))
    return feed.select(
        "k",
        routing.table_folder(F.col("topic"), X.PREFIX).alias("folder"),
        routing.table_folder(F.col("topic"), " ").alias("folder_without_prefix"),
    )


@query(
    """select k, case k % 4 when 0 then 'HR' when 1 then 'EMP' || k when 2 then '.schema/EMP' || k else 'A' end as schema_name,
    case k % 4 when 0 then 'EMP' || k when 1 then 'EMP' || k when 2 then '.schema/EMP' || k else 'B.schema/C' || k end as table_name
    from (select o_orderkey as k from orders)"""
)
def parse_folder(spark, sf_dir):
    folder = """case k % 4 when 0 then concat('HR.schema/EMP', k) when 1 then concat('EMP', k)
      when 2 then concat('.schema/EMP', k) else concat('A.schema/B.schema/C', k) end"""
    folders = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).withColumn("folder", F.expr(folder))
    return folders.select(
        "k",
        routing.folder_schema(F.col("folder")).alias("schema_name"),
        routing.folder_table(F.col("folder")).alias("table_name"),
    )


@query(
    """select k, case when k % 5 = 1 then 0 else 1 end as wrapped,
    case k % 5 when 0 then 'u' when 1 then 'd' when 4 then 'r' else 'c' end as op from (select o_orderkey as k from orders)"""
)
def unwrap_payload(spark, sf_dir):
    documents = """case k % 5 when 0 then '{"payload":{"op":"u"}}' when 1 then '{"op":"d"}' when 2 then '{"payload":null,"op":"d"}'
      when 3 then '{"payload":5,"op":"d"}' else '{"payload":{"payload":{"op":"x"},"op":"r"}}' end"""
    parsed = envelope.with_parsed(order_documents(spark, sf_dir, documents), "value", "root")
    wrapped = parsed.withColumn("wrapped", envelope.is_wrapped(F.col("root")))
    return wrapped.select(
        "k", F.col("wrapped").cast("int").alias("wrapped"), envelope.operation(F.col("root"), F.col("wrapped")).alias("op")
    )


@query(
    """select k, case k % 6 when 1 then 'null' when 2 then 'u' when 3 then '7' else 'c' end as op,
    case when k % 6 = 2 then 1 else 0 end as row_marker from (select o_orderkey as k from orders)"""
)
def op_default(spark, sf_dir):
    documents = """case k % 6 when 0 then '{"after":{}}' when 1 then '{"op":null}' when 2 then '{"op":"u","after":{"A":1}}'
      when 3 then '{"op":7}' when 4 then '5' else 'null' end"""
    decoded = decode.decode_events(order_documents(spark, sf_dir, documents))
    return decode.decodable(decoded).select(F.col("pos").alias("k"), "op", F.col("marker").alias("row_marker"))


@query(ORDER_ROWS + f"select pos, {ORDER_COLUMNS} from r")
def row_image(spark, sf_dir):
    return project.convertible(projected_orders(spark, sf_dir)).select("pos", *order_columns("row"))


FILLED = """case when kind = 'thin_update' and o_custkey % 2 = 0 then 1 else 0 end as found,
    case when kind = 'thin_update' and o_custkey % 2 = 0 then cast(o_custkey as integer) else custkey end as custkey,
    case when kind = 'thin_update' and o_custkey % 2 = 0 then o_totalprice else price end as price,
    case when kind = 'thin_update' and o_custkey % 2 = 0 then cast(cast(o_orderdate as date) as varchar) else orderdate end as orderdate"""


@query(
    ORDER_ROWS
    + f"""select pos, orderkey, {FILLED}, row_marker from r join (select o_orderkey as k, * from orders) using (k)
    where kind = 'thin_update'"""
)
def lookup_updates(spark, sf_dir):
    waiting, path = keep_rows(projected_orders(spark, sf_dir), F.col("needs_lookup")), f"{shared_dir(spark)}/waiting"
    waiting.write.parquet(path)  # decoded once; a sink keeps its batch likewise
    waiting = spark.read.schema(waiting.schema).parquet(path)
    filled = lookup.fill_from_snapshot(waiting, X.order_snapshot(spark, sf_dir), X.ORDERS)
    return filled.select(
        "pos",
        F.col("row.O_ORDERKEY").alias("orderkey"),
        F.col("row.O_CUSTKEY").isNotNull().cast("int").alias("found"),
        F.col("row.O_CUSTKEY").alias("custkey"),
        F.col("row.O_TOTALPRICE").alias("price"),
        F.col("row.O_ORDERDATE").cast("string").alias("orderdate"),
        F.col(f"row.{envelope.MARKER_COLUMN}").alias("row_marker"),
    )


@query(
    ORDER_ROWS
    + f"""select 'on' as lookup, pos, orderkey, {FILLED} from r join (select o_orderkey as k, * from orders) using (k)
    where row_marker = 1
    union all select 'off', pos, case when kind = 'thin_update' then null else orderkey end, 0, custkey, price, orderdate
    from r where row_marker = 1"""
)
def update_fallback(spark, sf_dir):
    def shown(rows: DataFrame, name: str, found: Column) -> DataFrame:
        return keep_rows(rows, F.col(f"row.{envelope.MARKER_COLUMN}") == 1).select(
            F.lit(name).alias("lookup"), "pos", F.col("row.O_ORDERKEY").alias("orderkey"), found.alias("found"),
            F.col("row.O_CUSTKEY").alias("custkey"), F.col("row.O_TOTALPRICE").alias("price"),
            F.col("row.O_ORDERDATE").cast("string").alias("orderdate"),
        )

    filled = lookup.fill_from_snapshot(
        projected_orders(spark, sf_dir), X.order_snapshot(spark, sf_dir), X.ORDERS
    )
    found = (F.col("needs_lookup") & F.col("row.O_CUSTKEY").isNotNull()).cast("int")
    plain = projected_orders(spark, sf_dir, lookup_updates=False)
    return shown(filled, "on", found).unionByName(shown(plain, "off", F.lit(0)))

@query(
    """select l.k, case when s.d is not null then 1 else 0 end as filled
    from (select o_orderkey as k, cast(o_orderdate as date) as d from orders) l
    left join (select distinct cast(o_orderdate as date) as d from orders where o_custkey % 2 = 0) s on l.d = s.d"""
)
def lookup_date_key(spark, sf_dir):
    """A DATE key against a snapshot that holds times of the day, below and above the count of pushed keys."""
    spec = catalog.TableSpec("S", "D", (catalog.ColumnSpec("D", "DATE", 0, 0, False, 1), catalog.ColumnSpec("K", "NUMBER", 18, 0, True, 2), catalog.ColumnSpec("N", "VARCHAR2", 0, 0, True, 3)), ("D",))
    orders = X.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    feed = orders.selectExpr(
        "'oracle.S.D' as topic", "cast(null as string) as key", "o_orderkey as pos",
        """concat('{"op":"u","before":{"D":', unix_date(day), ',"K":', o_orderkey, '},"after":null}') as value""",
    )
    snapshot = orders.filter("o_custkey % 2 = 0").selectExpr(
        "cast(day as timestamp) + interval 10 hours 30 minutes as D", "-1 as K", "'found' as N"
    )
    decoded = decode.decodable(decode.decode_events(feed, X.PREFIX))
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, spec), snapshot, spec)
    return filled.select(F.col("pos").alias("k"), F.col("row.N").isNotNull().cast("int").alias("filled"))


@query(
    """select o_orderkey as k, case when o_custkey % 2 = 0 then o_totalprice end as price from orders"""
)
def lookup_composite_key(spark, sf_dir):
    """Two key columns, a number kept as DECIMAL in the snapshot and a text."""
    columns = (("A", "NUMBER", 18, 0), ("B", "VARCHAR2", 0, 0), ("P", "NUMBER", 12, 2))
    spec = catalog.TableSpec("S", "C", tuple(catalog.ColumnSpec(*c, True, i) for i, c in enumerate(columns)), ("A", "B"))
    orders = X.table(spark, sf_dir, "orders")
    feed = orders.selectExpr(
        "'oracle.S.C' as topic", "cast(null as string) as key", "o_orderkey as pos",
        """concat('{"op":"u","before":{"A":', o_orderkey, ',"B":"', o_orderstatus, '"},"after":null}') as value""",
    )
    snapshot = orders.filter("o_custkey % 2 = 0").selectExpr(
        "cast(o_orderkey as decimal(20,0)) as A", "o_orderstatus as B", "o_totalprice as P"
    )
    decoded = decode.decodable(decode.decode_events(feed, X.PREFIX))
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, spec), snapshot, spec)
    return filled.select(F.col("pos").alias("k"), F.col("row.P").alias("price"))


@query("select o_orderkey as k, case when o_custkey % 2 = 0 then 'N' else '' end as bad_columns from orders")
def lookup_refused(spark, sf_dir):
    """A snapshot value that does not fit its column refuses the rows that look it up, and nothing else."""
    spec = catalog.TableSpec("S", "R", (catalog.ColumnSpec("K", "NUMBER", 18, 0, False, 1), catalog.ColumnSpec("N", "NUMBER", 9, 0, True, 2)), ("K",))
    orders = X.table(spark, sf_dir, "orders")
    feed = orders.selectExpr(
        "'oracle.S.R' as topic", "cast(null as string) as key", "o_orderkey as pos",
        """concat('{"op":"u","before":{"K":', o_orderkey, '},"after":null}') as value""",
    )
    snapshot = orders.selectExpr("o_orderkey as K", "if(o_custkey % 2 = 0, 5000000000L, 7L) as N")
    decoded = decode.decodable(decode.decode_events(feed, X.PREFIX))
    filled = lookup.fill_from_snapshot(project.project_rows(decoded, spec), snapshot, spec)
    return filled.select(F.col("pos").alias("k"), "bad_columns")


@query(
    """select k, case k % 4 when 0 then k + 1 when 1 then k when 3 then k end as orderkey, 0 as row_marker
    from (select o_orderkey as k from orders)"""
)
def unknown_op(spark, sf_dir):
    row = "'{\"O_ORDERKEY\":'"
    documents = f"""case k % 4 when 0 then concat('{{"op":"t","before":', {row}, k, '}},"after":', {row}, k + 1, '}}}}')
      when 1 then concat('{{"op":"t","before":', {row}, k, '}}}}') when 2 then concat('{{"op":"t","before":', {row}, k, '}},"after":null}}')
      else concat('{{"payload":{{"op":"","before":', {row}, k, '}}}}}}') end"""
    decoded = decode.decodable(decode.decode_events(order_documents(spark, sf_dir, documents), X.PREFIX))
    return decoded.select(
        F.col("pos").alias("k"),
        image_member("O_ORDERKEY", "bigint").alias("orderkey"),
        F.col("marker").alias("row_marker"),
    )


@query(
    """select k, case when k % 4 in (0, 1) then k end as orderkey, 2 as row_marker from (select o_orderkey as k from orders)"""
)
def tombstones(spark, sf_dir):
    key = """case k % 4 when 0 then concat('{"O_ORDERKEY":', k, '}') when 1 then concat('{"payload":{"O_ORDERKEY":', k, '}}')
      when 2 then null else '{"payload":null}' end"""
    feed = order_documents(spark, sf_dir, "cast(null as string)").withColumn("key", F.expr(key))
    rows = project.project_rows(decode.decodable(decode.decode_events(feed, X.PREFIX)), X.ORDERS)
    return project.convertible(rows).select(
        F.col("pos").alias("k"),
        F.col("row.O_ORDERKEY").alias("orderkey"),
        F.col(f"row.{envelope.MARKER_COLUMN}").alias("row_marker"),
    )


@query(ORDER_ROWS + "select pos, op, row_marker from r")
def row_markers(spark, sf_dir):
    return decode.decodable(decoded_orders(spark, sf_dir)).select("pos", "op", F.col("marker").alias("row_marker"))


@query(
    ORDER_ROWS
    + """select pos, 'malformed value' as reason, '{"O_ORDERKEY":' || k || '}' as key, '{bad' as value from ev where kind = 'malformed'
    union all select pos, 'unconvertible: O_ORDERSTATUS', null, null from r where status is not null"""
)
def quarantine(spark, sf_dir):
    decoded = decoded_orders(spark, sf_dir)
    # A catalog that wrongly declares a text column as a date refuses every row with a value in it.
    wrong = replace(
        X.ORDERS,
        columns=tuple(replace(c, data_type="DATE") if c.name == "O_ORDERSTATUS" else c for c in X.ORDERS.columns),
    )
    rows = project.refused_rows(project.project_rows(decode.decodable(decoded), wrong), X.ORDERS_FOLDER)
    return (
        decode.refused(decoded)
        .unionByName(rows.withColumn("value", F.lit(None).cast("string")))
        .select("pos", "reason", "key", "value")
    )


@query(
    ORDER_ROWS
    + "select pos, price, cast(null as varchar) as comment, cast(null as integer) as custkey_wrong_case, orderkey, row_marker from r"
)
def project_catalog(spark, sf_dir):
    by_name = {c.name: c for c in X.ORDERS.columns}
    spec = catalog.TableSpec(
        "SALES",
        "ORDERS",
        (
            by_name["O_TOTALPRICE"],
            catalog.ColumnSpec("O_COMMENT", "VARCHAR2"),
            replace(by_name["O_CUSTKEY"], name="o_custkey"),
            by_name["O_ORDERKEY"],
        ),
        ("O_ORDERKEY",),
    )
    rows = project.convertible(project.project_rows(decode.decodable(decoded_orders(spark, sf_dir)), spec))
    return rows.select("pos", "row.*").toDF("pos", "price", "comment", "custkey_wrong_case", "orderkey", "row_marker")


@query("select event_id, case event_id % 6 when 0 then 2 when 4 then 1 else 0 end as row_marker from events")
def marker_default(spark, sf_dir):
    documents = """case event_id % 6 when 0 then '{"m":2}' when 1 then '{"m":"2"}' when 2 then '{}' when 3 then '{"m":null}'
      when 4 then '{"m":1.9}' else '{"m":true}' end"""
    rows = X.table(spark, sf_dir, "events").select("event_id", F.expr(f"parse_json({documents})").alias("image"))
    marker = envelope.read(F.col("image"), envelope.json_path("m"))
    return rows.select("event_id", convert.marker_or_default(marker, "variant").alias("row_marker"))


# --- values ------------------------------------------------------------------------------------


@query("select event_id, 'k' as name, json_extract_string(props, '$.k') as value from events")
def json_row_map(spark, sf_dir):
    rows = X.table(spark, sf_dir, "events").select("event_id", F.explode(envelope.row_map(F.col("props"))).alias("name", "value"))
    return rows.select("event_id", "name", F.try_variant_get("value", "$", "string").alias("value"))


@query(
    """select event_id, case event_id % 10 when 0 then 'int' when 1 then 'long' when 2 then 'double' when 3 then 'text'
      when 4 then 'boolean' when 5 then 'null' when 6 then 'json' when 7 then 'json' when 8 then 'json' else 'double' end as kind,
    case event_id % 10 when 0 then json_extract_string(props, '$.k') when 1 then cast(epoch_us(ts) as varchar)
      when 2 then cast(value + 0.005 as varchar) when 3 then event_type when 4 then 'true' when 6 then '[' || event_id || ']'
      when 7 then '{"a":' || json_extract_string(props, '$.k') || ',"b":"' || event_type || '","c":[1,null]}'
      when 8 then '99999999999999999999' when 9 then event_id || '.0' end as value from events"""
)
def json_scalar_types(spark, sf_dir):
    """Kind and text of every value; objects print with sorted members, without spaces."""
    documents = """case event_id % 10 when 0 then get_json_object(props, '$.k') when 1 then cast(unix_micros(cast(ts as timestamp)) as string)
      when 2 then cast(value + 0.005 as string) when 3 then to_json(named_struct('t', event_type)) when 4 then 'true' when 5 then 'null'
      when 6 then concat('[', event_id, ']') when 7 then concat('{"c": [1, null], "b": "', event_type, '", "a": ', get_json_object(props, '$.k'), '}')
      when 8 then '99999999999999999999' else concat(event_id, '.0') end"""
    rows = X.table(spark, sf_dir, "events").select("event_id", F.expr(f"parse_json({documents})").alias("v"))
    text_member = envelope.read(F.col("v"), envelope.json_path("t"))
    rows = rows.select("event_id", F.when(F.col("event_id") % 10 == 3, text_member).otherwise(F.col("v")).alias("v"))
    text = convert.plain_text(F.try_variant_get("v", "$", "string"), F.col("v"))
    return rows.select("event_id", envelope.scalar_kind(F.col("v")).alias("kind"), text.alias("value"))


def line_values(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    """Every line item as a JSON row image with one member ``V``."""
    lines = X.table(spark, sf_dir, "lineitem")
    return lines.select("*", F.parse_json(F.expr(f"to_json(named_struct('V', {value}))")).alias("image"))


def event_values(spark: SparkSession, sf_dir: str, value: str) -> DataFrame:
    rows = X.table(spark, sf_dir, "events")
    return rows.select("*", F.parse_json(F.expr(f"to_json(named_struct('V', {value}))")).alias("image"))


def value_as(target: str, units: convert.Units = convert.Units()) -> Column:
    return convert.image_value(F.col("image"), "V", target, units)


@query(
    """select l_orderkey as orderkey, l_linenumber as linenumber, cast(cast(l_shipdate as date) as varchar) as shipdate,
    cast(l_linenumber as integer) as day_number from lineitem"""
)
def cast_date(spark, sf_dir):
    millis = "unix_millis(cast(l_shipdate as timestamp))"
    rows = line_values(spark, sf_dir, f"if(l_linenumber % 2 = 1, {millis} div 86400000, {millis})")
    small = F.parse_json(F.expr("to_json(named_struct('V', l_linenumber))"))
    return rows.select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        value_as("date").cast("string").alias("shipdate"),
        F.unix_date(convert.image_value(small, "V", "date")).alias("day_number"),
    )


@query("select event_id, epoch_us(ts) // 1000 as millis, epoch_us(ts) // 1000 as millis_from_nanos from events")
def cast_timestamp(spark, sf_dir):
    micros = "unix_micros(cast(ts as timestamp))"
    rows = event_values(spark, sf_dir, f"if(event_id % 2 = 1, {micros}, {micros} div 1000)")
    nanos = F.parse_json(F.expr(f"to_json(named_struct('V', {micros} * 1000 + 7))"))
    from_nanos = convert.image_value(nanos, "V", "timestamp", convert.Units(timestamp="nanos"))
    return rows.select(
        "event_id",
        F.unix_millis(value_as("timestamp")).alias("millis"),
        F.unix_millis(from_nanos).alias("millis_from_nanos"),
    )


@query(
    """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' as with_zone,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' as with_precision from events"""
)
def cast_tz_string(spark, sf_dir):
    rows = event_values(spark, sf_dir, "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00')")
    return rows.select(
        "event_id",
        value_as(convert.landing_type("TIMESTAMP WITH TIME ZONE")).alias("with_zone"),
        value_as(convert.landing_type("TIMESTAMP(6) WITH TIME ZONE")).alias("with_precision"),
    )


@query(
    """select cast(l_quantity as integer) as quantity, l_orderkey as orderkey, l_extendedprice as price, l_discount as discount,
    cast(trunc(l_extendedprice) as integer) as whole_price from lineitem"""
)
def cast_number(spark, sf_dir):
    members = "to_json(named_struct('Q', l_quantity, 'K', l_orderkey, 'P', l_extendedprice, 'D', l_discount))"
    rows = X.table(spark, sf_dir, "lineitem").select(F.parse_json(F.expr(members)).alias("image"))

    def number(name: str, precision: int = 0, scale: int = 0) -> Column:
        return convert.image_value(F.col("image"), name, convert.landing_type("NUMBER", precision, scale))

    return rows.select(
        number("Q", 4).alias("quantity"),
        number("K", 18).alias("orderkey"),
        number("P", 12, 2).alias("price"),
        number("D").alias("discount"),
        number("P", 9).alias("whole_price"),
    )


@query(
    """select l_orderkey as k, l_linenumber as n, case l_linenumber % 5 when 0 then 'I, L, D, T, F, B' when 1 then 'D, F, B'
    when 2 then 'D' else '' end as bad_columns, count(*) as rows from lineitem group by all"""
)
def refused_numbers(spark, sf_dir):
    """Booleans and values without a finite number are refused by column name; numbers as text are not."""
    columns = (("K", "NUMBER", 18, 0), ("I", "NUMBER", 9, 0), ("L", "NUMBER", 18, 0), ("D", "NUMBER", 0, 0), ("T", "DATE", 0, 0), ("F", "FLOAT", 0, 0), ("B", "BINARY_DOUBLE", 0, 0))
    spec = catalog.TableSpec("S", "N", tuple(catalog.ColumnSpec(*c, True, i) for i, c in enumerate(columns)), ("K",))
    values = """case l_linenumber % 5
        when 0 then '"I":true,"L":false,"D":true,"T":true,"F":false,"B":true'
        when 1 then '"I":1,"L":0,"D":"NaN","T":1,"F":"NaN","B":"-Infinity"'
        when 2 then '"I":"1","L":"0","D":"Infinity","T":0,"F":1,"B":0.0'
        else '"I":0,"L":1,"D":"1.5","T":19800,"F":"0","B":1' end"""
    feed = X.table(spark, sf_dir, "lineitem").selectExpr(
        "'oracle.S.N' as topic", "cast(null as string) as key", "l_orderkey * 10 + l_linenumber as pos",
        f"""concat('{{"after":{{"K":', l_orderkey, ',', {values}, '}}}}') as value""",
    )
    rows = project.project_rows(decode.decodable(decode.decode_events(feed, X.PREFIX)), spec)
    number = F.col("pos") % 10
    return rows.groupBy(((F.col("pos") - number) / 10).cast("long").alias("k"), number.alias("n"), "bad_columns").agg(F.count("*").alias("rows"))


@query("select l_orderkey as orderkey, cast(cast(l_tax as float) as double) as tax from lineitem")
def cast_float(spark, sf_dir):
    rows = line_values(spark, sf_dir, "l_tax")
    return rows.select(F.col("l_orderkey").alias("orderkey"), value_as(convert.landing_type("BINARY_FLOAT")).cast("double").alias("tax"))


@query("select l_orderkey as orderkey, l_tax as tax from lineitem")
def cast_double(spark, sf_dir):
    rows = line_values(spark, sf_dir, "l_tax")
    return rows.select(F.col("l_orderkey").alias("orderkey"), value_as(convert.landing_type("BINARY_DOUBLE")).alias("tax"))


@query("select l_orderkey as orderkey, hex(encode(l_returnflag)) as from_text, hex(encode(l_returnflag)) as from_base64 from lineitem")
def cast_binary(spark, sf_dir):
    rows = line_values(spark, sf_dir, "l_returnflag")
    coded = F.parse_json(F.expr("to_json(named_struct('V', base64(encode(l_returnflag, 'UTF-8'))))"))
    decoded = convert.image_value(coded, "V", "binary", convert.Units(binary="base64"))
    return rows.select(
        F.col("l_orderkey").alias("orderkey"),
        F.hex(value_as(convert.landing_type("RAW(16)"))).alias("from_text"),
        F.hex(decoded).alias("from_base64"),
    )


@query(
    "select l_orderkey as orderkey, l_linestatus as status, cast(l_linenumber as varchar) as number_text, l_linenumber || '.0' as fraction_text from lineitem"
)
def cast_string(spark, sf_dir):
    rows = line_values(spark, sf_dir, "l_linestatus")
    whole = F.parse_json(F.expr("to_json(named_struct('V', l_linenumber))"))
    fraction = F.parse_json(F.expr("to_json(named_struct('V', cast(l_linenumber as double)))"))
    target = convert.landing_type("CHAR")
    return rows.select(
        F.col("l_orderkey").alias("orderkey"),
        value_as(target).alias("status"),
        convert.image_value(whole, "V", target).alias("number_text"),
        convert.image_value(fraction, "V", target).alias("fraction_text"),
    )


# --- names -------------------------------------------------------------------------------------


@query(
    """select k, lpad(cast(k as varchar), 20, '0') || '.parquet' as name,
    lpad(cast(9223372036854775807 - k as varchar), 20, '0') || '.parquet' as high_name from (select o_orderkey as k from orders)"""
)
def sequence_names(spark, sf_dir):
    keys = X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return keys.select(
        "k",
        naming.sequence_name(F.col("k")).alias("name"),
        naming.sequence_name(F.lit(naming.MAX_LONG) - F.col("k")).alias("high_name"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing and stray file names, one per order."""
    name = """case k % 6 when 0 then concat(lpad(cast(k as string), 20, '0'), '.parquet') when 1 then concat('x', k, '.parquet')
      when 2 then concat(k, '.txt') when 3 then concat('+', k, '.parquet') when 4 then concat('9999999999999999999', k, '.parquet')
      else concat(k, '.parquet.parquet') end"""
    return X.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).withColumn("file_name", F.expr(name))


@query("select k, case when k % 6 in (0, 3) then k end as sequence from (select o_orderkey as k from orders)")
def sequence_parse(spark, sf_dir):
    return file_names(spark, sf_dir).select("k", naming.name_sequence(F.col("file_name")).alias("sequence"))


@query("select max(o_orderkey) as max_sequence from orders where o_orderkey % 6 in (0, 3)")
def max_sequence(spark, sf_dir):
    return landing.max_sequence(file_names(spark, sf_dir))


CODECS_ASKED = {"gzip": "GZIP", "LZ4": "LZ4", "Zstd": "ZSTD", "UNCOMPRESSED": "UNCOMPRESSED", "bogus": "SNAPPY", "": "SNAPPY"}


@query(
    ORDER_ROWS
    + f"""select asked, found as codec, orderkey, price, row_marker from r, (values {', '.join(f"('{a}', '{c}')" for a, c in CODECS_ASKED.items())}) as asked(asked, found)"""
)
def codecs(spark, sf_dir):
    """The orders landed with every codec and read back, with the codec that the files' footers name.

    One landing into a zone for each codec: the events are decoded and converted once for all of them.
    """
    path = f"{shared_dir(spark)}/events"
    tasks = _event_tasks(spark, X.table(spark, sf_dir, "orders").count())
    X.order_events(spark, sf_dir, tasks).write.parquet(path)
    sink = new_sink(spark, specs=(X.ORDERS,))
    zones = {a: replace(sink.options, base=f"{sink.options.base}-{i}", compression=a or None) for i, a in enumerate(CODECS_ASKED)}
    first, *copies = zones.values()
    replace(sink, options=first, copies=tuple(copies))(events.read_events(spark, path), 0)
    every = []
    for asked, zone in zones.items():
        base = zone.base
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{naming.SUFFIX}").load(f"{base}/{X.ORDERS_FOLDER}")
        found = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInArrow(_footer_codecs, "name string, codec string")
        found = found.select(naming.name_sequence(F.col("name")).alias("file_sequence"), "codec")
        rows = read_orders(spark, base).join(F.broadcast(found), "file_sequence")  # a row per file
        every.append(rows.select(F.lit(asked).alias("asked"), "codec", F.col("O_ORDERKEY").alias("orderkey"), F.col("O_TOTALPRICE").alias("price"), F.col(envelope.MARKER_COLUMN).alias("row_marker")))
    return reduce(DataFrame.unionByName, every)


def _footer_codecs(batches):
    for batch in batches:
        footers = [pq.ParquetFile(pa.BufferReader(c)).metadata.row_group(0).column(0).compression for c in batch.column(1).to_pylist()]
        # LZ4 in the frames that Spark writes has no name there
        named = ["LZ4" if f == "UNKNOWN" else f for f in footers]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, pa.string())], ["name", "codec"])


# --- tables, counts, profiles ------------------------------------------------------------------


@query("select 'APP.schema/USER_STATE' as folder, event_id as pos, 'unknown table' as reason from events")
def unknown_tables(spark, sf_dir):
    decoded = decode.decodable(decode.decode_events(X.all_events(spark, sf_dir), X.PREFIX))
    known = spec_columns(spark, X.ORDERS).select(F.concat_ws(".", "owner", "table_name").alias("catalog_name"))
    return resolve.unknown_tables(decoded, known).select("folder", "pos", "reason")


BOTH_TABLES = (
    ORDER_ROWS
    + """, both_tables as (select 'SALES.schema/ORDERS' as folder, row_marker from r
    union all select 'APP.schema/USER_STATE', case when event_type = 'error' then 2 else 1 end from events)
"""
)
PROFILE = (
    BOTH_TABLES
    + """select folder, count(*) filter (row_marker = 0) as inserts, count(*) filter (row_marker = 1) as updates,
    count(*) filter (row_marker = 2) as deletes, count(*) as changes from both_tables group by folder"""
)


@query(BOTH_TABLES + "select folder, count(*) as rows from both_tables group by folder")
def rows_per_table(spark, sf_dir):
    decoded = decode.decodable(decode.decode_events(X.all_events(spark, sf_dir), X.PREFIX))
    return decoded.groupBy("folder").agg(F.count("*").alias("rows"))


@query(PROFILE)
def change_profile(spark, sf_dir):
    return changes.change_profile(decode.decodable(decode.decode_events(X.all_events(spark, sf_dir), X.PREFIX)))


@query(ORDER_ROWS + f"select pos, {ORDER_COLUMNS} from r")
def dedupe_changes(spark, sf_dir):
    rows = project.convertible(projected_orders(spark, sf_dir)).select("pos", "row.*")
    replayed = rows.unionByName(rows)
    return changes.dedupe_changes(replayed).select("pos", *order_columns())


# --- landing -----------------------------------------------------------------------------------


@query(ORDER_ROWS + f"select {ORDER_COLUMNS} from r")
def landing_write(spark, sf_dir):
    return read_orders(spark, landed(spark, X.order_events(spark, sf_dir))).select(*order_columns())


@query(
    ORDER_ROWS
    + """select orderkey, price, row_marker, cast(1 as bigint) as file_sequence, row_number() over (order by pos) - 1 as row_index from r"""
)
def landing_read(spark, sf_dir):
    rows = read_orders(spark, landed(spark, X.order_events(spark, sf_dir)))
    return rows.select(
        F.col("O_ORDERKEY").alias("orderkey"), F.col("O_TOTALPRICE").alias("price"),
        F.col(envelope.MARKER_COLUMN).alias("row_marker"), "file_sequence", "row_index",
    )


@query("select '00000000000000000001.parquet' as file_name, 1 as has_content from (select count(*) as n from orders) where n > 0")
def landing_files(spark, sf_dir):
    base = landed(spark, X.order_events(spark, sf_dir))
    return landing.landing_files(spark, base, X.ORDERS_FOLDER).select(
        "file_name", (F.col("length") > 0).cast("int").alias("has_content")
    )


@query(BOTH_TABLES + "select folder, cast(1 as bigint) as file_sequence, count(*) as rows from both_tables group by folder")
def flush_counts(spark, sf_dir):
    base = landed(spark, X.all_events(spark, sf_dir))
    return _both(spark, base).groupBy("folder", "file_sequence").agg(F.count("*").alias("rows"))


def _both(spark: SparkSession, base: str) -> DataFrame:
    columns = ["file_sequence", "row_index", F.col(envelope.MARKER_COLUMN).alias("marker")]
    return (
        read_orders(spark, base).select(F.lit(X.ORDERS_FOLDER).alias("folder"), *columns)
        .unionByName(read_users(spark, base).select(F.lit(X.USERS_FOLDER).alias("folder"), *columns))
    )


@query(PROFILE)
def multi_table_landing(spark, sf_dir):
    return changes.change_profile(_both(spark, landed(spark, X.all_events(spark, sf_dir))))


@query(
    BOTH_TABLES
    + """select folder, count(*) as rows, 1 as is_split, 1 as is_numbered_without_gaps, cast(0 as bigint) as oversized_files
    from both_tables group by folder"""
)
def flush_by_count(spark, sf_dir):
    limit = 3000
    base = landed(spark, X.all_events(spark, sf_dir), max_records_per_file=limit)
    per_file = _both(spark, base).groupBy("folder", "file_sequence").agg(F.count("*").alias("rows"))
    files = F.count("*")
    return per_file.groupBy("folder").agg(
        F.sum("rows").alias("rows"),
        (files >= F.sum("rows") / limit).cast("int").alias("is_split"),
        (F.max("file_sequence") == files).cast("int").alias("is_numbered_without_gaps"),
        F.count_if(F.col("rows") > limit).alias("oversized_files"),
    )


@query(
    ORDER_ROWS
    + "select count(*) as rows, cast(0 as bigint) as swapped_in_file, cast(0 as bigint) as swapped_across_files from r"
)
def ordered_landing(spark, sf_dir):
    """Rows keep arrival order within files and from file to file; order keys rise with it."""
    base = landed(spark, X.order_events(spark, sf_dir), max_records_per_file=2000)
    rows = read_orders(spark, base).select(F.col("O_ORDERKEY").alias("k"), "file_sequence", "row_index")
    before = F.lag("k").over(Window.partitionBy("file_sequence").orderBy("row_index"))
    files = (
        rows.withColumn("before", before)
        .groupBy("file_sequence")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("before") > F.col("k")).alias("swapped"),
            F.min("k").alias("first"),
            F.max("k").alias("last"),
        )
    )
    following = files.select((F.col("file_sequence") - 1).alias("file_sequence"), F.col("first").alias("next_first"))
    return files.join(following, "file_sequence", "left").agg(
        F.sum("rows").alias("rows"),
        F.sum("swapped").alias("swapped_in_file"),
        F.count_if(F.col("next_first") < F.col("last")).alias("swapped_across_files"),
    )


@query(ORDER_ROWS + "select count(*) as rows, 1 as from_state, 1 as from_files, 1 as from_invalid_state from r")
def sequence_restore(spark, sf_dir):
    """The state file, the files themselves and a scan after a broken state file agree on the last number."""
    base = landed(spark, X.order_events(spark, sf_dir), max_records_per_file=2000)
    files = Files(spark, base)
    state = f"{base}/{X.ORDERS_FOLDER}/{naming.STATE_FILE}"
    from_state = naming.parse_state(files.read_text(state))
    files.write_text(state, "abc")
    from_invalid = restore_sequence(files, base, X.ORDERS_FOLDER)
    from_files = scan_sequence(files, base, X.ORDERS_FOLDER)
    return read_orders(spark, base).agg(
        F.count("*").alias("rows"),
        (F.max("file_sequence") == from_state).cast("int").alias("from_state"),
        (F.max("file_sequence") == from_files).cast("int").alias("from_files"),
        (F.max("file_sequence") == from_invalid).cast("int").alias("from_invalid_state"),
    )


@query(
    ORDER_ROWS
    + """select cast(1 + pos // 2 % 3 as bigint) as file_sequence, count(*) as rows, sum(orderkey) as keys from r group by all"""
)
def sequence_assign(spark, sf_dir):
    sink = new_sink(spark)
    feed = X.order_events(spark, sf_dir)
    for batch in range(3):
        sink(feed.filter(F.floor(F.col("pos") / 2) % 3 == batch), batch)
    rows = read_orders(spark, sink.options.base)
    return rows.groupBy("file_sequence").agg(F.count("*").alias("rows"), F.sum("O_ORDERKEY").alias("keys"))


@query(
    ORDER_ROWS
    + "select orderkey, case when k % 2 = 1 then priority end as priority, row_marker, cast(1 + k % 2 as bigint) as file_sequence from r"
)
def schema_evolution(spark, sf_dir):
    """A column enters the catalog between two batches: earlier files show NULL for it."""
    narrow = replace(X.ORDERS, columns=X.ORDERS.columns[:-1])
    current = {"spec": narrow}
    sink = replace(new_sink(spark), catalog=lambda: {current["spec"].name: current["spec"]})
    feed = X.order_events(spark, sf_dir)
    half = F.floor(F.col("pos") / 2) % 2
    sink(feed.filter(half == 0), 0)
    current["spec"] = X.ORDERS
    sink(feed.filter(half == 1), 1)
    rows = landing.read_landing(spark, sink.options.base, X.ORDERS_FOLDER)
    return rows.select(
        F.col("O_ORDERKEY").alias("orderkey"), F.col("O_ORDERPRIORITY").alias("priority"),
        F.col(envelope.MARKER_COLUMN).alias("row_marker"), "file_sequence",
    )


# --- many tables, wide rows, waiting and failing tables ------------------------------------------

N_TABLES = 60
SPREAD_SQL = f"case when o_custkey % 4 = 0 then 0 else o_custkey % {N_TABLES} end"


def spread_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[catalog.TableSpec]]:
    """The order events dealt over many tables by customer, a quarter of them to the first one."""
    of = X.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", f"{SPREAD_SQL} as t")
    feed = X.order_events(spark, sf_dir).withColumn("k", F.floor(F.col("pos") / 2)).join(of, "k")
    feed = feed.select(F.concat(F.col("topic"), F.lit("_"), F.col("t")).alias("topic"), "key", "value", "pos")
    return feed, [replace(X.ORDERS, table=f"ORDERS_{i}") for i in range(N_TABLES)]


@query(
    ORDER_ROWS
    + f""", t as (select o_orderkey as orderkey, {SPREAD_SQL} as t from orders)
    select 'ORDERS_' || t as table_name, {ORDER_COLUMNS}, cast(1 as bigint) as file_sequence from r join t using (orderkey)"""
)
def fan_out(spark, sf_dir):
    """A batch of many tables is split in one pass and lands in all of them."""
    feed, specs = spread_orders(spark, sf_dir)
    sink = new_sink(spark, tuple(specs))
    names = {f"{s.schema}.schema/{s.table}": s for s in specs}
    every = [
        landing.read_landing(spark, sink.options.base, folder, names[folder]).select(F.lit(names[folder].table).alias("table_name"), *order_columns(), "file_sequence")
        for folder in sink(feed, 0)
    ]
    return reduce(DataFrame.unionByName, every)


DOCS = catalog.TableSpec(
    "TEXT", "DOCS",
    (
        catalog.ColumnSpec("DOC_ID", "NUMBER", 18, 0, False, 1),
        catalog.ColumnSpec("BODY", "CLOB", 0, 0, True, 2),
        catalog.ColumnSpec("LANG", "VARCHAR2", 0, 0, True, 3),
    ),
    ("DOC_ID",),
)
DOCS_FOLDER = "TEXT.schema/DOCS"


def document_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from a few to many thousand bytes."""
    row = F.to_json(F.struct(F.col("doc_id").alias("DOC_ID"), F.col("text").alias("BODY"), F.col("lang").alias("LANG")))
    return X.table(spark, sf_dir, "documents").select(
        F.lit("oracle.TEXT.DOCS").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.concat(F.lit('{"op":"c","after":'), row, F.lit("}")).alias("value"), F.col("doc_id").alias("pos"),
    )


@query(
    """select doc_id, md5(text) as body_md5, lang, 1 as is_within_limit, 1 as is_one_of_several, 1 as is_in_order from documents"""
)
def flush_by_bytes(spark, sf_dir):
    """Files of wide rows end at a limit of bytes; a file above it would hold a single row."""
    limit = 250_000
    base = landed(spark, document_events(spark, sf_dir), specs=(DOCS,), max_bytes_per_file=limit)
    rows = landing.read_landing(spark, base, DOCS_FOLDER, DOCS)
    names = landing.landing_files(spark, base, DOCS_FOLDER)
    files = names.select(naming.name_sequence(F.col("file_name")).alias("file_sequence"), "length").filter("file_sequence is not null")
    spans = rows.groupBy("file_sequence").agg(F.count("*").alias("n"), F.min("DOC_ID").alias("low"), F.max("DOC_ID").alias("high"))
    following = spans.select((F.col("file_sequence") - 1).alias("file_sequence"), F.col("low").alias("next_low"))
    marked = spans.join(files, "file_sequence").join(following, "file_sequence", "left").select(
        "file_sequence",
        ((F.col("length") <= limit) | (F.col("n") == 1)).cast("int").alias("is_within_limit"),
        F.lit(int(files.count() > 1)).alias("is_one_of_several"),
        F.coalesce(F.col("high") < F.col("next_low"), F.lit(True)).cast("int").alias("is_in_order"),
    )
    return rows.join(marked, "file_sequence").select(
        F.col("DOC_ID").alias("doc_id"), F.md5("BODY").alias("body_md5"), F.col("LANG").alias("lang"),
        "is_within_limit", "is_one_of_several", "is_in_order",
    )


N_SMALL = 9
SMALL_BATCHES = f"""
with r as (select *, ntile({N_SMALL}) over (order by event_id) - 1 as batch from events)
select user_id, event_id, case when event_type = 'error' then 2 else 1 end as row_marker,
"""


def small_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The user events cut into as equal batches as their number allows, in order.

    A batch is a range of positions, which lies in few row groups of the table; its rows are spread over all tasks.
    """
    n = X.table(spark, sf_dir, "events").count()
    feed = X.user_events(spark, sf_dir, tasks=_event_tasks(spark, -(-n // N_SMALL)))
    ends = [0]
    for i in range(N_SMALL):
        ends.append(ends[-1] + n // N_SMALL + (i < n % N_SMALL))
    first = X.table(spark, sf_dir, "events").agg(F.min("event_id")).first()[0]
    return [feed.filter((F.col("pos") >= first + low) & (F.col("pos") < first + high)) for low, high in zip(ends, ends[1:])]


def landed_users(spark: SparkSession, base: str) -> DataFrame:
    return read_users(spark, base).select(
        F.col("USER_ID").alias("user_id"), F.col("EVENT_ID").alias("event_id"),
        F.col(envelope.MARKER_COLUMN).alias("row_marker"), "file_sequence",
    )


@query(SMALL_BATCHES + "cast(batch // 3 + 1 as bigint) as file_sequence from r")
def carry_over(spark, sf_dir):
    """Small batches wait until there are enough rows: three of them make a file."""
    batches = small_batches(spark, sf_dir)
    least = sum(b.count() for b in batches[-3:])
    sink = replace(new_sink(spark), flush=FlushPolicy(rows=least, seconds=1e9))
    for i, batch in enumerate(batches):
        sink(batch, i)
    sink.flush_due(spark, everything=True)
    return landed_users(spark, sink.options.base)


@query(SMALL_BATCHES + "cast(batch // 4 + 1 as bigint) as file_sequence from r")
def flush_by_age(spark, sf_dir):
    """Ten seconds between batches: a table lands with the first batch after its oldest event is 25 seconds old."""
    now = [0.0]
    sink = replace(new_sink(spark), flush=FlushPolicy(rows=1 << 40, bytes=1 << 60, seconds=25), clock=lambda: now[0])
    for i, batch in enumerate(small_batches(spark, sf_dir)):
        now[0] = 10.0 * i
        sink(batch, i)
    now[0] += 100
    sink.flush_due(spark)
    return landed_users(spark, sink.options.base)


@query(
    SMALL_BATCHES
    + f"""cast(batch + 1 as bigint) as file_sequence from r
    union all select null, o_orderkey, 0, cast(o_orderkey % {N_SMALL} + 1 as bigint) from orders"""
)
def failing_table(spark, sf_dir):
    """A table that fails three times lands in order afterwards, a file for each batch; the other one is not held up."""
    keys = X.table(spark, sf_dir, "orders").select("o_orderkey")
    orders = keys.repartition(_event_tasks(spark, -(-keys.count() // N_SMALL)), "o_orderkey").select(
        F.lit("oracle.SALES.ORDERS").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.expr("concat('{\"after\":{\"O_ORDERKEY\":', o_orderkey, '}}')").alias("value"), F.col("o_orderkey").alias("pos"),
    )
    attempts: list[str] = []

    def fail(step: str, folder: str) -> None:
        if step == "staged" and folder == X.ORDERS_FOLDER and len(attempts) < 3:
            attempts.append(folder)
            raise Interrupted(folder)

    sink = replace(new_sink(spark), keep_failed=True, on_step=fail)
    for i, batch in enumerate(small_batches(spark, sf_dir)):
        sink(batch.unionByName(orders.filter(F.col("pos") % N_SMALL == i)), i)
    rows = read_orders(spark, sink.options.base).select(
        F.lit(None).cast("bigint").alias("user_id"), F.col("O_ORDERKEY").alias("event_id"),
        F.col(envelope.MARKER_COLUMN).alias("row_marker"), "file_sequence",
    )
    return landed_users(spark, sink.options.base).unionByName(rows)


@query(USER_CHANGES + "select user_id, pos as event_id, row_marker from r")
def replay_overlap(spark, sf_dir):
    """Batches that overlap, whole replays and copies within a batch: each change lands once.

    Offsets are counted per partition, so equal ones of two partitions are different changes.
    """
    feed = X.user_events(spark, sf_dir)
    numbered = feed.select("topic", "key", "value", (F.col("pos") % 2).cast("int").alias("partition"), F.expr("pos div 2").alias("pos"))
    n = X.table(spark, sf_dir, "events").count() // 2
    sink = replace(new_sink(spark), drop_replays=True)
    early, late = numbered.filter(F.col("pos") < 0.6 * n), numbered.filter(F.col("pos") >= 0.4 * n)
    sink.land_batch(early.unionByName(early.filter("pos % 7 = 0")))
    sink.land_batch(early)
    sink.land_batch(late)
    sink.land_batch(numbered)
    return landed_users(spark, sink.options.base).drop("file_sequence")


# --- streams -----------------------------------------------------------------------------------


#: Rows of one file of events: a task sorts and writes so many.
EVENT_FILE_ROWS = 250_000


def _event_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks that so many rows are spread over to become events: all there are, and more beyond :data:`EVENT_FILE_ROWS` each."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // EVENT_FILE_ROWS))


def _event_files(spark: SparkSession, feed: DataFrame, path: str, batches: int = 4) -> int:
    """Write a feed for so many batches, in arrival order; returns the files of a batch, which grow in number and not in size."""
    each = max(1, -(-feed.count() // (batches * EVENT_FILE_ROWS)))
    feed.repartitionByRange(batches * each, "pos").sortWithinPartitions("pos").write.parquet(path)
    return each


@query(ORDER_ROWS + f"select {ORDER_COLUMNS} from r")
def stream_landing(spark, sf_dir):
    path = f"{shared_dir(spark)}/events"
    each = _event_files(spark, X.order_events(spark, sf_dir), path)
    sink = new_sink(spark)
    start_landing(events.stream_events(spark, path, max_files_per_trigger=each), sink, available_now=True).awaitTermination()
    return read_orders(spark, sink.options.base).select(*order_columns())


@query(
    BOTH_TABLES
    + "select folder, count(*) as rows, 0 as gaps, count(*) filter (row_marker = 2) as deletes from both_tables group by folder"
)
def restart_no_dup(spark, sf_dir):
    """A stream stopped at every step of its landing and started again leaves no duplicate and no gap."""
    path = f"{shared_dir(spark)}/events"
    each = _event_files(spark, X.all_events(spark, sf_dir), path, batches=2)
    to_fail = ["decoded", "quarantined", "staged", "planned", "renamed", "published", "committed"]

    def stop_once(step: str, folder: str) -> None:
        if to_fail and step == to_fail[0]:
            raise Interrupted(to_fail.pop(0))

    sink = replace(new_sink(spark), on_step=stop_once)
    for _ in range(len(to_fail) + 1):
        stream = start_landing(events.stream_events(spark, path, max_files_per_trigger=each), sink, available_now=True)
        try:
            stream.awaitTermination()
        except Exception as error:
            if "Interrupted" not in str(error):
                raise
    rows = _both(spark, sink.options.base)
    per_file = rows.groupBy("folder", "file_sequence").agg(
        F.count("*").alias("rows"), F.count_if(F.col("marker") == 2).alias("deletes")
    )
    return per_file.groupBy("folder").agg(
        F.sum("rows").alias("rows"),
        (F.max("file_sequence") - F.count("*")).cast("int").alias("gaps"),
        F.sum("deletes").alias("deletes"),
    )


# --- snapshots in ranges -----------------------------------------------------------------------

N_RANGES = 8


@query("select o_orderkey as orderkey, o_custkey as custkey, 1 as is_even from orders")
def snapshot_ranges(spark, sf_dir):
    """A snapshot read in ranges of a composite key whose first column has three values: even ranges, each row once."""
    orders = X.table(spark, sf_dir, "orders")
    keys = ["o_orderstatus", "o_orderkey"]
    conditions = ranges.range_conditions(keys, ranges.split_points(orders, keys, N_RANGES))
    parts = [orders.filter(c).select("o_orderkey", "o_custkey", F.lit(i).alias("range")) for i, c in enumerate(conditions)]
    rows = reduce(DataFrame.unionByName, parts)
    sizes = rows.groupBy("range").agg(F.count("*").alias("n"))
    share = orders.count() / N_RANGES
    even = sizes.select("range", F.col("n").between(0.6 * share, 1.5 * share).cast("int").alias("is_even"))
    return rows.join(F.broadcast(even), "range").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "is_even")


# --- catalog versions --------------------------------------------------------------------------

ID_OF_STATUS = 3


def order_history(spark: SparkSession, sf_dir: str) -> tuple[catalog.Catalog, int, int]:
    """Three catalog entries of the orders, from their rows with the positions from which they hold.

    The second one adds a column, the third one drops a column and gives another one a new name.
    """
    last = X.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    starts = (0, last // 3, 2 * last // 3)
    columns = [c for c in X.ORDERS.columns if c.name != "O_ORDERDATE"]
    second = columns
    third = [replace(c, name="O_STATE") if c.column_id == ID_OF_STATUS else c for c in columns if c.name != "O_CUSTKEY"]
    rows = [
        ("SALES", "ORDERS", c.name, c.data_type, c.precision, c.scale, "Y" if c.nullable else "N", c.column_id, start)
        for start, entry in zip(starts, (second[:-1], second, third))
        for c in entry
    ]
    listed = spark.createDataFrame(rows, f"{catalog.COLUMN_SCHEMA}, valid_from BIGINT")
    constraints = spark.createDataFrame([("SALES", "ORDERS", "PK", "P")], catalog.CONSTRAINT_SCHEMA)
    keys = spark.createDataFrame([("SALES", "PK", "O_ORDERKEY", 1)], catalog.KEY_COLUMN_SCHEMA)
    return history.collect_history(listed, constraints, keys), starts[1], starts[2]


@query(
    """with b as (select max(o_orderkey) // 3 as second, 2 * max(o_orderkey) // 3 as third from orders)
    select o_orderkey as orderkey, case when o_orderkey < third then o_orderstatus else lower(o_orderstatus) end as state, o_totalprice as price,
    case when o_orderkey >= second then o_orderpriority end as priority, case when o_orderkey < third then cast(o_custkey as integer) end as custkey,
    cast(o_orderkey % 2 + 1 as bigint) as file_sequence from orders, b"""
)
def catalog_versions(spark, sf_dir):
    """Each event is read under the catalog entry of its position; a renamed column goes on, a dropped one stays NULL."""
    entries, _, _ = order_history(spark, sf_dir)
    rows = X.order_rows(spark, sf_dir).withColumn("O_STATE", F.lower("O_ORDERSTATUS"))  # entries tell which of the two names counts
    feed = rows.select(
        F.lit("oracle.SALES.ORDERS").alias("topic"), F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(F.struct(*rows.columns).alias("after"))).alias("value"), F.col("O_ORDERKEY").alias("pos"),
    )
    sink = replace(new_sink(spark), catalog=catalog.cached_catalog(lambda: entries))
    for batch in range(2):
        sink(feed.filter(F.col("pos") % 2 == batch), batch)
    spec = entries[X.ORDERS.name].landing_spec()
    return landing.read_landing(spark, sink.options.base, X.ORDERS_FOLDER, spec).select(
        F.col("O_ORDERKEY").alias("orderkey"), F.col("O_STATE").alias("state"), F.col("O_TOTALPRICE").alias("price"),
        F.col("O_ORDERPRIORITY").alias("priority"), F.col("O_CUSTKEY").alias("custkey"), "file_sequence",
    )


# --- current state -----------------------------------------------------------------------------

LAST_USERS = (
    USER_CHANGES
    + """select user_id, pos as event_id, event_type, value, epoch_us(ts) // 1000 as millis from
    (select *, row_number() over (partition by user_id order by pos desc) as n from r) where n = 1 and row_marker <> 2"""
)


def user_state(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("USER_ID").alias("user_id"), F.col("EVENT_ID").alias("event_id"), F.col("EVENT_TYPE").alias("event_type"),
        F.col("VALUE").alias("value"), F.unix_millis("TS").alias("millis"),
    )


@query(LAST_USERS)
def apply_changes(spark, sf_dir):
    rows = read_users(spark, landed(spark, X.user_events(spark, sf_dir)))
    return user_state(changes.apply_changes(rows, X.USERS.keys))


@query(
    USER_CHANGES
    + """select user_id, pos as event_id, event_type, value, epoch_us(ts) // 1000 as millis from
    (select *, row_number() over (partition by user_id order by pos % 10 >= 7 desc, pos desc) as n from r)
    where n = 1 and row_marker <> 2"""
)
def apply_changes_incremental(spark, sf_dir):
    """State after the first batch, then only the files of the second one on top of it."""
    sink = new_sink(spark)
    feed = X.user_events(spark, sf_dir)
    late = F.col("pos") % 10 >= 7
    sink(feed.filter(~late), 0)
    base = sink.options.base
    first = changes.apply_changes(read_users(spark, base), X.USERS.keys)
    sink(feed.filter(late), 1)
    since = landing.read_landing(spark, base, X.USERS_FOLDER, X.USERS, after_sequence=1)
    return user_state(changes.apply_changes(since, X.USERS.keys, first))


@query(LAST_USERS)
def snapshot_hand_over(spark, sf_dir):
    """A snapshot read in two chunks while changes go on, then the changes from its start: the true last state.

    Each user's row is read at some position inside the window of its chunk, and may be overtaken there.
    """
    n = X.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    windows = [(3 * n // 10, 45 * n // 100), (45 * n // 100, 6 * n // 10)]
    feed = X.user_events(spark, sf_dir)
    user = F.get_json_object("key", "$.USER_ID").cast("long")
    low, high = (F.when(user % 2 == 0, windows[0][i]).otherwise(windows[1][i]) for i in range(2))
    read_at = low + 1 + user * 7919 % (high - low)
    seen = feed.filter(F.col("pos") <= read_at).groupBy("topic", "key").agg(F.max_by("value", "pos").alias("value"))
    snapshot = seen.filter(F.get_json_object("value", "$.op") == "u").select(
        "topic", "key", F.replace("value", F.lit('"op":"u"'), F.lit('"op":"r"')).alias("value"), (user % 2).cast("int").alias("window")
    )
    handed = events.hand_over(snapshot, feed.filter(F.col("pos") > windows[0][0]), windows, X.USERS.keys)
    return user_state(changes.apply_changes(read_users(spark, landed(spark, handed)), X.USERS.keys))


KEYED = "(case when event_id % 13 <> 0 then user_id end)"


@query(
    USER_CHANGES.replace("user_id,", f"{KEYED} as user_id,")
    + """, l as (select *, row_number() over (partition by user_id order by case when pos % 10 < 4 then 0 when pos % 10 < 7 then 1 else 2 end desc, pos desc) as n
      from r where user_id is not null)
    select 1 as is_state, user_id, pos as event_id, event_type, value from l where n = 1 and row_marker <> 2
    union all select 0, user_id, pos, event_type, value from r where user_id is null"""
)
def state_advance(spark, sf_dir):
    """The state advanced by three landed batches, and the changes without a key that each call hands on."""
    keyless = "if(pos % 13 = 0, replace(value, concat('\"USER_ID\":', get_json_object(key, '$.USER_ID'), ','), ''), value)"
    feed = X.user_events(spark, sf_dir).withColumn("value", F.expr(keyless))
    sink, home = new_sink(spark), shared_dir(spark)
    current = state.KeyedState(f"{home}/state", X.USERS, buckets=8)
    handed = []
    for batch in range(3):
        sink(feed.filter(F.col("pos") % 10 < 4 if batch == 0 else F.col("pos") % 10 >= 7 if batch == 2 else (F.col("pos") % 10).between(4, 6)), batch)
        handed.append(current.advance(spark, sink.options.base, X.USERS_FOLDER))
    columns = [F.col("USER_ID").alias("user_id"), F.col("EVENT_ID").alias("event_id"), F.col("EVENT_TYPE").alias("event_type"), F.col("VALUE").alias("value")]
    rows = current.read(spark).select(F.lit(1).alias("is_state"), *columns)
    return reduce(DataFrame.unionByName, [rows, *(h.select(F.lit(0).alias("is_state"), *columns) for h in handed)])


@query("select o_orderkey as k, 1 as row_marker from orders where o_orderkey % 3 = 0")
def keyless_changes(spark, sf_dir):
    """Changes that no current row can be found for are handed on, not dropped unseen."""
    rows = X.table(spark, sf_dir, "orders").selectExpr("if(o_orderkey % 3 = 0, null, o_orderkey) as K", "o_orderkey as k2", "1 as m")
    return changes.keyless_changes(rows, ["K"]).select(F.col("k2").alias("k"), F.col("m").alias("row_marker"))


@query(USER_CHANGES + "select user_id, pos as event_id, row_marker from r")
def batch_twice(spark, sf_dir):
    """Two batches under numbers of their own: all rows of both land; a batch given again changes nothing."""
    sink, feed = new_sink(spark), X.user_events(spark, sf_dir)
    early = F.col("pos") % 3 == 0
    sink.land_batch(feed.filter(early))
    sink.land_batch(feed.filter(~early))
    sink(feed.filter(~early), "own-1")
    rows = read_users(spark, sink.options.base)
    return rows.select(F.col("USER_ID").alias("user_id"), F.col("EVENT_ID").alias("event_id"), F.col(envelope.MARKER_COLUMN).alias("row_marker"))


@query(USER_CHANGES + "select user_id, pos as event_id, row_marker from r")
def quarantine_replay(spark, sf_dir):
    """A table enters the catalog after its events: what was put aside lands once, and before later events."""
    known: dict = {}
    sink = replace(new_sink(spark), catalog=lambda: known)
    feed = X.user_events(spark, sf_dir)
    early = F.col("pos") % 10 < 5
    sink.land_batch(feed.filter(early))
    known[X.USERS.name] = X.USERS
    for _ in range(2):
        sink.replay_unknown(spark)
    sink.land_batch(feed.filter(~early))
    rows = read_users(spark, sink.options.base)
    return rows.select(F.col("USER_ID").alias("user_id"), F.col("EVENT_ID").alias("event_id"), F.col(envelope.MARKER_COLUMN).alias("row_marker"))
