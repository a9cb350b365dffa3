"""What the operators share: reading, cutting lineage, ranges by key, components of a graph."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.session import shared_dir

#: Rows of a text column that a Python task turns into objects at a time.
CHUNK = 256
#: Rows of a batch that Spark hands to Python.
BATCH_ROWS = 1_024
#: A side of a join is broadcast only if it was counted and holds at most so many bytes.
BROADCAST_BYTES = 32_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs no recomputation of it."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: How to empty what an operator keeps in a Python worker from task to task.
STORES: dict[str, Callable[[], None]] = {}


def chunks(batches: Iterator[pa.RecordBatch], owner: str = "") -> Iterator[pa.RecordBatch]:
    """The batches in small pieces. Workers serve one operator after another: what others have kept is dropped."""
    for name, empty in STORES.items():
        if name != owner:
            empty()
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)
    pa.default_memory_pool().release_unused()


def small_batches(df: DataFrame) -> DataFrame:
    """Let Spark hand Python few rows at a time: texts are long, and a batch is held several times over."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def with_made(df: DataFrame, reads: list[str], make: Callable[..., dict], made: dict[str, T.DataType]) -> DataFrame:
    """``df`` with the columns ``made``, in place of columns of these names or behind the others.

    ``make`` gets lists of the columns ``reads``, a few rows at a time, and gives a list for each new column.
    """
    names = [*df.columns, *(n for n in made if n not in df.columns)]
    kinds = {f.name: f.dataType for f in df.schema} | made
    at = [df.columns.index(r) for r in reads]
    arrow = {n: to_arrow_type(t) for n, t in made.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            new = make(*[batch.column(i).to_pylist() for i in at])
            columns = [pa.array(new[n], arrow[n]) if n in new else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return small_batches(df).mapInArrow(work, T.StructType([T.StructField(n, kinds[n]) for n in names]))


def by_size(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """Mark a counted side for broadcast when it is small; else leave the join to Spark."""
    return F.broadcast(df) if rows * bytes_per_row <= BROADCAST_BYTES else df


#: Keys that hold one row in so many are met by broadcast: there cannot be more than so many of them.
HOT_SHARE = 10_000


def looked_up(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``found`` (one row per key, ``n`` the rows of ``rows`` under it) and ``met``.

    Rows without a match have nulls and ``met`` false. Keys that hold more than one row in ``HOT_SHARE`` are
    broadcast, and their rows stay where they are; the other rows are shuffled, and none of their keys is hot.
    Both tables are read twice, so they should be stored. Keys are not null.
    """
    others = [c for c in found.columns if c not in (*keys, "n")]
    least = max(1_000, rows.count() // HOT_SHARE)
    hot = found.filter(F.col("n") > least).select(*keys, *others)
    cold = found.filter(F.col("n") <= least).select(*keys, *others, F.lit(True).alias("met"))
    near = rows.join(F.broadcast(hot), keys).withColumn("met", F.lit(True))
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "left")
    return near.unionByName(far.withColumn("met", F.coalesce("met", F.lit(False))))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts - 1`` values that cut the rows into ranges of about equal counts."""
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, F.lit(cuts).cast("array<double>"), 10_000).alias("c")).first().c
    return sorted(set(found or []))


def range_of(key: Column, bounds: list) -> Column:
    """The number of bounds at or below the key; nulls count as smallest."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.size(F.filter(array, lambda b: b <= key)), F.lit(0)).cast("int")


class Forest:
    """Union-find over the keys it is given; the root of a tree is its smallest key."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        parent.setdefault(x, x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


#: Links that one task's forest holds before it passes its trees on.
FOREST_LINKS = 500_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def trees(forest: Forest) -> pa.RecordBatch:
        pairs = [(k, forest.root(k)) for k in list(forest.parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"]
        )

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) > FOREST_LINKS:
            yield trees(forest)
            forest = Forest()
    yield trees(forest)


def _lowest(links: DataFrame) -> DataFrame:
    """For every node the smallest of itself and its neighbours."""
    both = links.union(links.select("b", "a"))
    return both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _ordered(links: DataFrame) -> DataFrame:
    links = links.toDF("x", "y").filter("x <> y")
    return stored(links.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b: long) -> (node, component): the smallest node reachable.

    Union-find inside each task first turns its links into trees. Then, in turns, every node's larger neighbours
    are pointed at the smallest of its neighbourhood, and every node and its smaller neighbours are, until only
    stars are left. Paths halve with each round, and the links never grow in number. Each step is written to
    the shared folder; links are only tested on the driver. Null ends are dropped, loops do no harm.
    """
    links = links.select("a", "b").filter("a is not null and b is not null and a <> b")
    links = _ordered(links.mapInArrow(_forests, "a long, b long"))
    for _ in range(max_rounds):
        # only stars: every node but the smallest of its component has one link, and the other end has none further down
        ends = links.groupBy("a").agg(F.count("*").alias("n"))
        deeper = links.select(F.col("b").alias("a")).join(ends, "a", "left_semi")
        if ends.filter("n > 1").select("a").union(deeper).isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        least = _lowest(links)
        larger = links.join(least.select(F.col("a").alias("b"), "low"), "b").select("a", "low")
        links = _ordered(larger)
        least = _lowest(links)
        smaller = links.join(least, "a").select("b", "low")
        links = _ordered(smaller.union(least.select("a", "low")))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def runs(key: str, handle: Callable[[list[dict]], list[dict]], schema: pa.Schema, limit: int = 20_000):
    """A mapInArrow function over rows sorted by ``key``: ``handle`` gets the rows of one key at a time.

    A key's rows may lie in several batches. The caller bounds the rows of a key.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0][key] != row[key]:
                    out += handle(held)
                    held = []
                    if len(out) >= limit:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
                held.append(row)
        if held:
            out += handle(held)
        yield pa.RecordBatch.from_pylist(out, schema)

    return work


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())
