"""Fill updates that came without a row image from a snapshot of the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import MARKER_COLUMN
from tidemark.operators.keep import keep_rows
from tidemark.session import shared_dir
from tidemark.sources.catalog import TableSpec

# Keys and the snapshot rows found for them are broadcast up to this count and these bytes.
MAX_BROADCAST_KEYS = 100_000
MAX_BROADCAST_BYTES = 64_000_000
# Up to this many keys become a condition on the snapshot, which a database or Parquet applies itself.
MAX_PUSHED_KEYS = 500
# A key is hot from this many rows on.
ROWS_PER_SLICE = 100_000


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions) -> Column:
    """Their disjunction, halved again and again so that it does not nest deeply."""
    conditions = list(conditions)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def typed(value: Column, target: T.DataType) -> Column:
    """A snapshot value as its landing type, NULL when it does not fit; timestamps keep whole milliseconds."""
    value = value.try_cast(target)
    return F.timestamp_millis(F.unix_millis(value)) if isinstance(target, T.TimestampType) else value


def may_equal(column: Column, own: T.DataType, target: T.DataType, values: list) -> Column | None:
    """A condition in the column's own type that holds for every value whose typed form is in ``values``.

    It only narrows what the source sends; the typed join decides. None where no such condition is known.
    Timestamps in ``values`` are epoch milliseconds.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(target, whole):
        if isinstance(own, whole) or (isinstance(own, T.DecimalType) and own.scale == 0):
            return column.isin(values)
        if isinstance(own, T.NumericType):  # a fraction is cut by the cast
            return _any((column > v - 1) & (column < v + 1) for v in values)
    elif isinstance(target, (T.FloatType, T.DoubleType)):
        if isinstance(own, (T.DoubleType, *whole[:3])) and isinstance(target, T.DoubleType):
            return column.isin(values)
    elif isinstance(target, T.StringType):
        if isinstance(own, T.StringType):
            return column.isin(values)
    elif isinstance(target, T.DateType):
        if isinstance(own, T.DateType):
            return column.isin(values)
        if isinstance(own, (T.TimestampType, T.TimestampNTZType)):  # any time of the day
            days = [(F.lit(v).cast(own), F.date_add(F.lit(v), 1).cast(own)) for v in values]
            return _any((column >= start) & (column < end) for start, end in days)
    elif isinstance(target, T.TimestampType) and isinstance(own, T.TimestampType):
        return _any((column >= F.timestamp_millis(F.lit(v))) & (column < F.timestamp_millis(F.lit(v + 1))) for v in values)
    return None


def _narrowed(snapshot: DataFrame, wanted: DataFrame, names: list[str], targets: dict[str, T.DataType]) -> DataFrame:
    """The snapshot with the distinct values of every key column as conditions on its source."""
    shown = [F.unix_millis(n) if isinstance(t, T.TimestampType) else F.col(n) for n, t in zip(names, targets.values())]
    rows = wanted.select(*shown).collect()
    for i, (key, target) in enumerate(targets.items()):
        condition = may_equal(F.col(key), snapshot.schema[key].dataType, target, sorted({r[i] for r in rows}))
        if condition is not None:
            snapshot = snapshot.filter(condition)
    return snapshot


def fill_from_snapshot(
    projected: DataFrame,
    snapshot: DataFrame | None,
    spec: TableSpec,
    marker: str = MARKER_COLUMN,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Give each ``needs_lookup`` row the snapshot's current row for its key, if there is one.

    The waiting rows are written once to the shared folder, so that events are decoded for them once and once for the
    result, whatever is asked of the keys. These are reduced to distinct ones and counted. Keys and snapshot rows are compared as landing
    types at every size; a few keys are pushed to the snapshot's source besides. A snapshot value that does
    not fit its landing type refuses the rows that look it up, by column name.

    Unless the source itself finds them, the rows found are written once to the shared folder. If they are few
    they are broadcast onto the projected rows, all in one pass. Else only the waiting rows are joined, by shuffle; the rows of a hot
    key are spread over slices, and its one snapshot row is repeated for each slice.
    """
    if snapshot is None or not spec.keys:
        return projected
    row = F.col("row")
    has_key = _all(row.getField(k).isNotNull() for k in spec.keys)
    keyed = F.coalesce(F.col("needs_lookup") & has_key, F.lit(False))
    names = [f"_k{i}" for i in range(len(spec.keys))]
    keys = [row.getField(k).alias(n) for n, k in zip(names, spec.keys)]
    waiting = _written(keep_rows(projected, keyed).select("*", *keys))
    wanted = waiting.groupBy(names).agg(F.count("*").alias("_rows"))
    width = reduce(lambda a, b: a + b, (F.octet_length(F.col(n).cast("string")) + 16 for n in names))
    seen = wanted.agg(
        F.count("*").alias("keys"), F.max("_rows").alias("most"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    if not seen.keys:
        return projected

    schema = spec.landing_schema(marker)
    fields = schema.fields[:-1]
    pushed = seen.keys <= MAX_PUSHED_KEYS
    if pushed:
        snapshot = _narrowed(snapshot, wanted, names, {k: schema[k].dataType for k in spec.keys})
    few = seen.keys <= max_broadcast_keys and seen.bytes <= MAX_BROADCAST_BYTES
    present = set(snapshot.columns)
    values = {f.name: typed(F.col(f.name), f.dataType) if f.name in present else F.lit(None).cast(f.dataType) for f in fields}
    unfit = [F.when(F.col(n).isNotNull() & v.isNull(), F.lit(n)) for n, v in values.items() if n in present]
    current = (
        snapshot.select(
            F.struct(*[v.alias(n) for n, v in values.items()]).alias("found"),
            F.concat_ws(", ", *unfit).alias("found_bad"),
            *[values[k].alias(n) for n, k in zip(names, spec.keys)],
        )
        .join(F.broadcast(wanted.select(names)) if few else wanted.select(names), names, "left_semi")
        .dropDuplicates(names)
    )
    if not pushed:
        current = _written(current)
    if few:
        size = current.agg(F.sum(F.octet_length(F.to_json("found"))).alias("n")).first().n or 0
        few = size <= MAX_BROADCAST_BYTES

    filled = F.struct(
        *[
            F.when(F.col("found").isNotNull(), F.col("found").getField(f.name)).otherwise(row.getField(f.name)).alias(f.name)
            for f in fields
        ],
        row.getField(marker).alias(marker),
    )
    bad = F.when(F.col("found").isNull(), F.col("bad_columns")).otherwise(F.col("found_bad")).alias("bad_columns")
    columns = [filled.alias("row") if c == "row" else bad if c == "bad_columns" else F.col(c) for c in projected.columns]
    if few:
        asked = projected.select("*", *[F.when(keyed, k).alias(n) for n, k in zip(names, keys)])
        return asked.join(F.broadcast(current), names, "left").select(columns)

    on = names
    if seen.most > rows_per_slice:
        hot = wanted.filter(F.col("_rows") > rows_per_slice)
        hot = _written(hot.select(*names, F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias("_slices")))
        if hot.count() <= max_broadcast_keys and seen.bytes <= MAX_BROADCAST_BYTES:
            hot = F.broadcast(hot)
        slices = F.coalesce("_slices", F.lit(1))
        waiting = waiting.join(hot, names, "left").withColumn("_slice", F.pmod(F.xxhash64("pos"), slices).cast("int"))
        current = current.join(hot, names, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        on = [*names, "_slice"]
    looked_up = waiting.join(current, on, "left").select(columns)
    return keep_rows(projected, ~keyed).unionByName(looked_up)


def _written(rows: DataFrame) -> DataFrame:
    path = shared_dir(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
