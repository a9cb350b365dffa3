"""SimHash near-duplicate groups: a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Four differing bits lie in four bytes at most, so fingerprints that are to be
linked share at least four bytes at equal positions. Postings of single bytes would hold one fingerprint in 256;
a posting here is keyed by a set of positions and its bytes. The sets are chosen such that any four positions
contain one of them, so two fingerprints with four shared bytes meet under some key. Inside a posting the shared
positional bytes of each pair are tallied, pairs that reach four are kept, and their differing bits are counted.
Pairs never leave a task: it hands on the links of a union-find forest.

Postings above ``POSTING`` fingerprints are not compared pair by pair. Two fingerprints within four bits have
one within two bits of both, so the fingerprints of such postings emit all of those, and equal ones meet: as many
rows as fingerprints, times 2,081, however dense the group, and never more than 2,081 under one key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import Forest, chunks, components, looked_up, small_batches, stored

SHINGLE = 4
SEED = 42
#: Fingerprints link at so many differing bits at most; the methods below hold for this number.
BITS = 4
#: Bytes of eight that linked fingerprints share at least.
LEAST_SHARED = 8 - BITS
#: Random fingerprints that a posting holds on average at most; more fingerprints get longer keys.
EXPECTED = 16
#: Larger postings are split by neighbouring values instead of being compared inside a task.
POSTING = 4096
#: Hashes of a long text that are counted at a time.
COUNTED = 65_536

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's shingles, repeats counted; 0 without words."""
    words = text.encode().lower().split() if text else []  # A-Z only, ASCII white space only
    if not words:
        return 0
    ahead = [words[k:] for k in range(SHINGLE)] if len(words) >= SHINGLE else [[w] for w in words]
    n = max(1, len(words) - SHINGLE + 1)
    h = np.fromiter(map(xxh64_intdigest, map(b" ".join, zip(*ahead)), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, COUNTED):
        part = h[at : at + COUNTED]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (long) per row of ``docs``; whole texts, one narrow stage."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            made = pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["doc_id", "fingerprint"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, "doc_id long, fingerprint long")


def position_sets(size: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions such that any four positions contain one of them: 7, 20 or 70 sets.

    The positions are dealt into three classes in a ring. Four positions have two in one class; three of them
    are in one class or have two in one class and the third in the next.
    """
    ring = [0, 0, 0, 1, 1, 1, 2, 2]

    def chosen(s: tuple[int, ...]) -> bool:
        classes = [ring[i] for i in s]
        alike = {c: classes.count(c) for c in classes}
        if size == 2:
            return len(alike) == 1
        if size == 3:
            return len(alike) == 1 or any(n == 2 and (c + 1) % 3 in alike for c, n in alike.items())
        return True

    return [s for s in combinations(range(8), size) if chosen(s)]


def key_size(n_fingerprints: int) -> int:
    """Bytes of a key: as few as keep a posting of random fingerprints within ``EXPECTED``."""
    return next((k for k in (2, 3) if n_fingerprints <= EXPECTED << 8 * k), LEAST_SHARED)


def postings(nodes: DataFrame, size: int) -> DataFrame:
    """``positions, bytes, fingerprint``: every fingerprint under each set of positions."""
    masks = [sum(0xFF << 8 * i for i in s) for s in position_sets(size)]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("positions"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)])
    return nodes.select("fingerprint", F.explode(keys).alias("k")).select("k.positions", "k.bytes", "fingerprint")


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """The number of zero bytes of each value: the tally of shared positional bytes of two fingerprints."""
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    marked = (((x & low) + low) | x) & ~low  # the high bit of every byte that is not zero
    return 8 - np.bitwise_count(marked)


def posting_links(group: np.ndarray, value: np.ndarray) -> list[tuple[int, int]]:
    """Links of a forest over ``value`` (uint64), which joins exactly what close pairs with equal ``group`` reach.

    ``group`` is sorted. Pairs are taken by their distance in the sorted rows, all groups at once; what is
    joined already is not compared again.
    """
    n = len(value)
    if n < 2:
        return []
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    tree, forest, links = np.arange(n), Forest(), []
    here, apart = np.arange(n), 1
    while True:
        here = here[here + apart < ends[here]]
        if not len(here):
            return links
        open_pairs = here[tree[here] != tree[here + apart]]
        x = value[open_pairs] ^ value[open_pairs + apart]
        kept = shared_bytes(x) >= LEAST_SHARED
        close = open_pairs[kept][np.bitwise_count(x[kept]) <= BITS]
        joined = False
        for i in close.tolist():
            if forest.join(i, i + apart):
                links.append((int(value[i]), int(value[i + apart])))
                joined = True
        if joined:
            parent = tree.copy()
            for i, p in forest.parent.items():
                parent[i] = p
            while (parent[parent] != parent).any():
                parent = parent[parent]
            tree = parent
        apart += 1


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _as_links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([_signed(both[:, 0].copy()), _signed(both[:, 1].copy())], schema=LINKS)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``positions, bytes``: postings may lie across batches, the last one waits for the next batch."""
    held = np.zeros((3, 0), np.int64)
    for batch in batches:
        rows = np.concatenate([held, np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])], axis=1)
        if not rows.shape[1]:
            continue
        new = np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
        last = int(np.flatnonzero(new)[-1])
        yield _as_links(posting_links(np.cumsum(new[:last]), rows[2, :last].view(np.uint64)))
        held = rows[:, last:]
    yield _as_links(posting_links(np.zeros(held.shape[1]), np.ascontiguousarray(held[2]).view(np.uint64)))


def _neighbours() -> np.ndarray:
    """What turns a value into the ones within two bits of it, itself included."""
    one = [1 << i for i in range(64)]
    return np.array([0, *one, *(a | b for a, b in combinations(one, 2))], np.uint64)


def _meeting_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    change = _neighbours()
    for batch in batches:
        value = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for at in range(0, len(value), 64):
            part = value[at : at + 64]
            yield pa.RecordBatch.from_arrays([_signed((part[:, None] ^ change).ravel()), _signed(np.repeat(part, len(change)))], ["value", "fingerprint"])


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``value``: fingerprints under one value are within four bits, each is linked to the one before."""
    before: tuple = ()
    for batch in batches:
        value, mark = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        if before:
            value, mark = np.concatenate([[before[0]], value]), np.concatenate([[before[1]], mark])
        same = value[1:] == value[:-1]
        pairs = np.unique(np.stack([mark[:-1][same], mark[1:][same]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=LINKS)
        before = (value[-1], mark[-1]) if len(value) else ()


def links(nodes: DataFrame, n_nodes: int) -> DataFrame:
    """``a, b`` over the distinct fingerprints of ``nodes``, joining what fingerprints within four bits reach."""
    every = postings(nodes, key_size(n_nodes))
    sizes = every.groupBy("positions", "bytes").agg(F.count("*").alias("n"))
    large = stored(sizes.filter(F.col("n") > POSTING).select("positions", "bytes"))
    some_large = not large.isEmpty()
    small = every.join(large, ["positions", "bytes"], "left_anti") if some_large else every
    dealt = small.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes")
    found = dealt.mapInArrow(_compare, "a long, b long")
    if not some_large:
        return found
    dense = every.join(large, ["positions", "bytes"], "left_semi").select("fingerprint").distinct()
    met = dense.mapInArrow(_meeting_values, "value long, fingerprint long").repartition("value").sortWithinPartitions("value", "fingerprint")
    return found.union(met.mapInArrow(_chains, "a long, b long"))


def similar(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id, text).

    ``fingerprint`` is printed as 16 hexadecimal digits. Rows link if their fingerprints differ in ``BITS`` bits
    at most; a component is what links reach, named by its smallest id. Null, empty and blank texts have the
    fingerprint zero and link like any other. Rows with equal ids or equal texts are rows of their own; a row
    without an id belongs to a component, whose name is null if no row of it has an id. Texts are read whole;
    columns other than these two are not read. An empty table gives no rows.
    """
    every = stored(fingerprints(docs))
    nodes = stored(every.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    found = components(links(nodes.select("fingerprint"), nodes.count()))
    placed = nodes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    placed = stored(placed.select("fingerprint", "least", "n", F.coalesce("component", "fingerprint").alias("component")))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("rows"))
    # only rows that are not alone need to be looked up
    shared = placed.join(names.filter("rows > 1"), "component").select("fingerprint", "component_id", "n")
    met = looked_up(every, stored(shared), ["fingerprint"])
    printed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return met.select("doc_id", printed, F.when(F.col("met"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
