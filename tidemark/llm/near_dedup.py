"""Near-duplicate groups: SuperMinHash, banding, exact verification, union-find.

A document's set of five-word shingles gives a SuperMinHash signature: every shingle draws a permutation of the
components, and its rank in a component plus a fraction is its value there, so the values of one shingle are
correlated and vary less than independent ones; once all components are lower than the rank at hand, the rest
of the permutations is not drawn. Documents with equal bands are candidates. Candidates are first joined into
clusters, of which most are small and are compared exactly within one task. A large cluster is dealt into
blocks that are compared with a few central documents and inside; only documents that are then still outside
the cluster's largest component meet all other blocks. Pairs never leave a task: it hands on the links of a
union-find forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from tidemark.llm.common import STORES, Forest, by_size, chunks, components, looked_up, runs, small_batches, stored

SHINGLE = 5
#: Components of a signature.
M = 180
#: A pair just similar enough is missed by all bands with at most this probability.
MISSED = 1e-6
#: Clusters up to this size are compared within one task; larger ones are dealt into blocks of half of it.
CLUSTER = 400
#: Documents of a large cluster that all of its blocks are compared with.
CENTRES = 8
#: Shingles of a comparison that are counted at a time.
COLUMNS = 8192
STORED_WORDS = 100_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "doc_id long, n_shingles long, low long, high long, bands array<long>"
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class _Hashes(dict):
    """Hashes of words, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= STORED_WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


_words = _Hashes()
STORES["shingles"] = _words.clear


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the input moves about half of the bits of the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; all words together if they are fewer than five; none without words."""
    split = text.encode().lower().split() if text else []  # A-Z only, ASCII white space only
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        total = np.full(n, min(len(h), SHINGLE), np.uint64)
        for k in range(min(len(h), SHINGLE)):
            total = total * GOLDEN + mixed(h[k : k + n])
        return np.unique(mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of several sets at once: rank in the upper half and fraction in the lower; (sets, M)."""
    values = np.full((len(sets), M), np.iinfo(np.uint64).max, np.uint64)
    flat = values.reshape(-1)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order, low = None, np.uint64(0xFFFFFFFF)
    for rank in range(M):
        if not len(element):
            break
        with np.errstate(over="ignore"):
            drawn = mixed(element + np.uint64(rank + 1) * GOLDEN)
        swap = (rank + ((drawn & low) * np.uint64(M - rank) >> np.uint64(32))).astype(np.int64)
        if rank == 0:
            component = swap
        else:
            here = np.arange(len(element))
            component = order[here, swap]
            order[here, swap] = order[here, rank]
        np.minimum.at(flat, owner * M + component, np.uint64(rank) << np.uint64(32) | drawn >> np.uint64(32))
        # a set is done when no later rank can lower any of its components
        done = values.max(axis=1) >> np.uint64(32) <= np.uint64(rank)
        left = ~done[owner]
        if rank == 0:
            swap = swap[left]
            order = np.tile(np.arange(M, dtype=np.uint8), (len(swap), 1))
            order[np.arange(len(swap)), swap] = 0  # what stood first has changed places with the one drawn
        elif not left.all():
            order = order[left]
        element, owner = element[left], owner[left]
    return values


def rows_per_band(percent: int) -> int:
    """The longest bands that lose no more than ``MISSED``: 6 at 85 percent (30 bands), 5 at 80 (36 bands)."""
    return max(r for r in range(1, 21) if M % r == 0 and (r == 1 or (1 - (percent / 100) ** r) ** (M // r) <= MISSED))


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    bands = values.reshape(len(values), M // rows, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, M // rows + 1, dtype=np.uint64), bands.shape[:2])
        for r in range(rows):
            key = mixed(key * GOLDEN + bands[:, :, r])
    return key.view(np.int64)


def sketches(docs: DataFrame, rows: int) -> DataFrame:
    """Per row: size of the set, a 128-bit hash of it, band keys (none for the empty set). One narrow stage."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "shingles"):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            with np.errstate(over="ignore"):
                low = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
                high = [int(mixed(s ^ GOLDEN).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            sizes = np.array([len(s) for s in sets], np.int64)
            keys = band_keys(signatures(sets), rows)[sizes > 0].reshape(-1)
            ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, M // rows, 0))]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(low, pa.int64()), pa.array(high, pa.int64()), bands],
                ["doc_id", "n_shingles", "low", "high", "bands"],
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, SKETCH)


def _intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, counted over the shingles that occur twice at least."""
    every, place = np.unique(np.concatenate(a + b), return_inverse=True)
    often = np.bincount(place, minlength=len(every)) > 1
    column = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in a + b])
    kept = often[place]
    row, column = row[kept], column[place[kept]]
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    total, width = np.zeros((len(a), len(b)), np.float64), int(often.sum())
    for start in range(0, width, COLUMNS):
        first, last = np.searchsorted(column, [start, start + COLUMNS])
        marks = np.zeros((len(a) + len(b), min(COLUMNS, width - start)), np.float32)
        marks[row[first:last], column[first:last] - start] = 1
        total += marks[: len(a)] @ marks[len(a) :].T
    return total


def linked(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Index pairs (into a, into b) of sets that are similar enough, exactly."""
    if not a or not b:
        return np.zeros((0, 2), np.int64)
    both = _intersections(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - both
    return np.argwhere(100 * both >= percent * union)


def _sets(rows: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(r["shingles"], np.uint64) for r in rows]


def _forest(pairs, left: list[dict], right: list[dict]) -> list[dict]:
    forest = Forest()
    return [{"a": left[i]["rep"], "b": right[j]["rep"]} for i, j in pairs.tolist() if forest.join(left[i]["rep"], right[j]["rep"])]


def _read_sets(docs: DataFrame, members: DataFrame, n_members: int) -> DataFrame:
    """``rep, cluster, size, n_blocks, centre`` of the members with their sets, read from the documents again."""
    wanted = by_size(members.withColumnRenamed("rep", "wanted"), n_members, 64)
    found = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "shingles"):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            same = [int(s.sum(dtype=np.uint64).view(np.int64)) == low for s, low in zip(sets, batch.column(2).to_pylist())]
            data = pa.array([s.tobytes() for s in sets], pa.binary())
            made = pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[3:], data], ["rep", "cluster", "size", "centre", "shingles"])
            yield made.filter(pa.array(same, pa.bool_()))  # of rows with equal ids, the one whose set it is

    ddl = "rep long, cluster long, size long, centre boolean, shingles binary"
    return found.select("doc_id", "text", "low", "cluster", "size", "centre").mapInArrow(work, ddl)


def similar(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Two rows are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets; a component is what links
    reach, named by its smallest id. The empty set is linked with nothing. Exact copies are one node from the
    start, counted inside each task before they meet. Rows with equal ids are one node as well; of a row
    without an id, only copies with an id link it, and its component is null if there are none. Null texts and texts
    without words have the empty set. Texts are read whole, other columns are not read, an empty table gives no rows.
    """
    every = stored(sketches(docs, rows_per_band(percent)))
    sets = every.filter("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "low", "high").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")
    )
    sets = stored(sets)

    # candidates: every document with the smallest one of its bucket; n counts how central it is
    keys = sets.select("rep", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = stored(keys.join(buckets, "key").groupBy("rep", "least").agg(F.sum("n").alias("n")))
    clusters = components(stars.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    inside = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    inside = stored(inside.union(clusters.select("component", "component").distinct()))
    sizes = inside.groupBy("cluster").agg(F.count("*").alias("size"))
    central = stars.groupBy("rep").agg(F.sum("n").alias("n"))
    large = inside.join(sizes.filter(F.col("size") > CLUSTER), "cluster").join(central, "rep")
    first = Window.partitionBy("cluster").orderBy(F.desc("n"), "rep")
    centres = large.select("rep", F.row_number().over(first).alias("r")).filter(F.col("r") <= CENTRES).select("rep", F.lit(True).alias("c"))
    members = (
        inside.join(sizes, "cluster")
        .join(centres, "rep", "left")
        .join(sets.select("rep", "low"), "rep")
        .select("rep", "low", "cluster", "size", F.coalesce("c", F.lit(False)).alias("centre"))
    )
    members = stored(members)
    whole = stored(_read_sets(docs, members, members.count()))

    links = _within_clusters(whole.filter(F.col("size") <= CLUSTER), percent)
    big = whole.filter(F.col("size") > CLUSTER)
    if not big.isEmpty():
        links = links.union(_across_blocks(big, percent))
    found = components(links)

    nodes = sets.select("low", "high", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    nodes = nodes.select("low", "high", F.coalesce("component", "rep").alias("component"))
    # only sets that have a copy or a link need to be looked up; those of very many copies are met where the rows lie
    shared = every.groupBy("low", "high").agg(F.count("*").alias("n"))
    nodes = nodes.join(shared, ["low", "high"]).join(found.select(F.col("component").alias("top")).distinct(), F.col("component") == F.col("top"), "left")
    nodes = stored(nodes.filter("n > 1 or top is not null").select("low", "high", "component", "n"))
    placed = looked_up(every.select("doc_id", "n_shingles", "low", "high"), nodes, ["low", "high"])
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _within_clusters(rows: DataFrame, percent: int) -> DataFrame:
    def compare(group: list[dict]) -> list[dict]:
        sets = _sets(group)
        pairs = linked(sets, sets, percent)
        return _forest(pairs[pairs[:, 0] < pairs[:, 1]], group, group)

    dealt = rows.select("cluster", "rep", "shingles").repartition("cluster").sortWithinPartitions("cluster")
    return dealt.mapInArrow(runs("cluster", compare, LINKS), "a long, b long")


def _across_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Links of clusters too large for one task.

    Blocks hold about ``CLUSTER / 2`` documents, dealt by hash. First each block meets the centres and itself.
    What has joined the cluster's largest component then need not be compared with its like; blocks of the
    other documents meet every block.
    """
    half = CLUSTER // 2
    n_blocks = F.ceil(F.col("size") / half).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), n_blocks).cast("int"))

    def near_centres(group: list[dict]) -> list[dict]:
        own, centres = [r for r in group if not r["guest"]], [r for r in group if r["guest"]]
        everyone = own + centres
        return _forest(linked(_sets(own), _sets(everyone), percent), own, everyone)

    own = rows.select("cluster", "block", "rep", "shingles", F.lit(False).alias("guest"))
    guests = rows.filter("centre").select("cluster", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"), "rep", "shingles", F.lit(True).alias("guest"))
    dealt = own.union(guests).select(F.xxhash64("cluster", "block").alias("task"), "rep", "shingles", "guest")
    dealt = dealt.repartition("task").sortWithinPartitions("task")
    links = stored(dealt.mapInArrow(runs("task", near_centres, LINKS), "a long, b long"))

    found = components(links).withColumnRenamed("node", "rep")
    placed = rows.select("rep", "cluster", "size", "block").join(found, "rep", "left")
    placed = stored(placed.select("rep", "cluster", "size", "block", F.coalesce("component", "rep").alias("component")))
    counts = placed.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("cluster").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"))
    outside = placed.join(main, "cluster").filter("component <> main")
    left_over = outside.groupBy("cluster").agg(F.count("*").alias("n_out")).withColumn("n_turns", F.ceil(F.col("n_out") / half).cast("int"))

    everyone = rows.join(left_over, "cluster").join(placed.select("rep", "component"), "rep")
    turns = F.explode(F.sequence(F.lit(0), F.col("n_turns") - 1)).alias("turn")
    hosts = everyone.select("cluster", turns, "block", "rep", "component", "shingles", F.lit(False).alias("guest"))
    asking = everyone.join(outside.select("rep"), "rep").withColumn("turn", F.pmod(F.xxhash64("rep", F.lit(1)), "n_turns").cast("int"))
    blocks = F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block")
    asking = asking.select("cluster", "turn", blocks, "rep", "component", "shingles", F.lit(True).alias("guest"))

    def across(group: list[dict]) -> list[dict]:
        hosts, guests = [r for r in group if not r["guest"]], [r for r in group if r["guest"]]
        pairs = linked(_sets(guests), _sets(hosts), percent)
        return _forest(pairs, guests, hosts)

    dealt = hosts.union(asking).select(F.xxhash64("cluster", "turn", "block").alias("task"), "rep", "shingles", "guest")
    dealt = dealt.repartition("task").sortWithinPartitions("task")
    return links.union(dealt.mapInArrow(runs("task", across, LINKS), "a long, b long"))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without documents that a smaller id stands for; rows without an id and without words stay."""
    gone = similar(docs, percent).filter("not kept and doc_id is not null").select(F.col("doc_id").alias("__gone_id")).distinct()
    return docs.join(stored(gone), F.col("doc_id") == F.col("__gone_id"), "left_anti")
