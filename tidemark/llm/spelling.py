"""Spelling variants: the words of a corpus that are one edit apart, by walking a trie as a table.

The trie is an edge table: a node is a prefix (by its hash), an edge leads by one letter to the next prefix. A
state (word, position, node, edits) says that the word up to ``position`` has reached ``node`` with so many edits.
The frontier of all words' states is joined with the edges level by level; what reaches the end of its word with
one edit is a neighbour.

An edit lies in one half of a word, and the other half stays as it is. So every word also walks backwards, in a
trie of reversed words, and edits are only made in the half walked last: there the trie has few branches, while at
its top every letter would be one. Without edits a word follows its own path, so its states up to the middle are
known. Each edge also tells which lengths words below it have, which letters follow and whether a word ends, and
states are only kept if their own length and next letter are among these.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_size, chunks, small_batches, stored

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: One run in so many, chosen by its hash, loses a letter.
DAMAGED = 199
#: A form is at least so many times as frequent as its variant.
FORM_FACTOR = 5
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
#: Words that a task counts before it hands them on.
HELD = 300_000
#: No word makes an edit before so many letters, as none is shorter than ``LEAST_LENGTH``.
DEPTH = LEAST_LENGTH // 2
#: Levels walked one by one. What has letters left after them, of very long words, is met by the whole rest.
LEVELS = 24

STATE = ["spelled", "side", "size", "position", "node", "target"]


def runs_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of one text, damaged as the hash of id and run says, with their counts; a null id prints as nothing."""
    found: Counter = Counter()
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall((text or "").encode().lower().decode())).items():
        h = crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            found[run] += n
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that occur often enough; counted inside each task before they meet."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in chunks(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(runs_of(doc_id, text))
            if len(counts) > HELD:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    counted = small_batches(docs).select("doc_id", "text").mapInArrow(work, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _letter(position: str) -> Column:
    """The letter behind ``position`` letters; empty at the end."""
    return F.expr(f"substring(spelled, {position} + 1, 1)")


def _node(length: str) -> Column:
    return F.expr(f"xxhash64(side, substring(spelled, 1, {length}))")


def _size_bit(size: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.least(size, F.lit(63)).cast("int"))


def _letter_bit(letter: Column) -> Column:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(letter), F.lit(64)).cast("int"))
    return F.when(letter == "", F.lit(0).cast("long")).otherwise(bit)


def both_ways(words: DataFrame) -> DataFrame:
    """``word, spelled, side, size``: every word forwards (side 0) and backwards (side 1)."""
    ways = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("spelled")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("spelled")))
    return words.select("word", F.char_length("word").alias("size"), F.explode(ways).alias("w")).select("word", "w.spelled", "w.side", "size")


def paths(ways: DataFrame) -> DataFrame:
    """A row for every node of a word from ``DEPTH`` letters on, its end included."""
    return ways.withColumn("position", F.explode(F.sequence(F.lit(DEPTH), "size"))).withColumn("node", _node("position"))


def edge_table(steps: DataFrame) -> DataFrame:
    """``node, letter, child`` with what lies below the child; the letter is empty where a word ends at the node."""
    after = _letter("position + 1")
    rows = steps.select(
        "node", "position", _letter("position").alias("letter"), _node("position + 1").alias("child"),
        _size_bit(F.col("size")).alias("sizes"), _letter_bit(after).alias("nexts"), (F.col("position") + 1 == F.col("size")).alias("ends"),
    )
    return rows.groupBy("node", "letter", "child").agg(
        F.bit_or("sizes").alias("sizes"), F.bit_or("nexts").alias("nexts"), F.max("ends").alias("ends"), F.max("position").alias("depth")
    )


def node_table(edges: DataFrame) -> DataFrame:
    """``node`` with its children, of which it has no more than the alphabet letters, and what lies below it."""
    child = F.when(F.col("letter") != "", F.struct("letter", "child", "sizes", "nexts", "ends"))
    return edges.groupBy("node").agg(
        F.collect_list(child).alias("children"), F.bit_or("sizes").alias("below"),
        F.bit_or(_letter_bit(F.col("letter"))).alias("letters"), F.max(F.col("letter") == "").alias("is_word"),
    )


def _goes_on(position: str, target: Column, sizes: Column, nexts: Column, ends: Column) -> Column:
    """Whether what lies below a node has words of the state's length that go on with the state's next letter."""
    letter = _letter(position)
    fits = sizes.bitwiseAND(_size_bit(target)) != 0
    return fits & F.when(letter == "", ends).otherwise(nexts.bitwiseAND(_letter_bit(letter)) != 0)


def edited(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """The states after one edit: from every position in the half walked last, a letter skipped, added or replaced."""
    middle = F.when(F.col("side") == 0, F.floor(F.col("size") / 2)).otherwise(F.ceil(F.col("size") / 2))
    here = steps.filter(F.col("position") >= middle).select("spelled", "side", "size", "position", "node").join(nodes, "node")
    size, inside = F.col("size"), F.col("position") < F.col("size")
    as_state = lambda position, node, target: F.struct(position.cast("int").alias("position"), node.alias("node"), target.cast("int").alias("target"))
    skipped = F.when(
        inside & _goes_on("position + 1", size - 1, F.col("below"), F.col("letters"), F.col("is_word")),
        F.array(as_state(F.col("position") + 1, F.col("node"), size - 1)),
    )
    added = F.transform(
        F.filter("children", lambda c: _goes_on("position", size + 1, c.sizes, c.nexts, c.ends)),
        lambda c: as_state(F.col("position"), c.child, size + 1),
    )
    replaced = F.when(
        inside,
        F.transform(
            F.filter("children", lambda c: (c.letter != _letter("position")) & _goes_on("position + 1", size, c.sizes, c.nexts, c.ends)),
            lambda c: as_state(F.col("position") + 1, c.child, size),
        ),
    )
    none = F.array().cast("array<struct<position:int,node:bigint,target:int>>")
    made = F.concat(*[F.coalesce(x, none) for x in (skipped, added, replaced)])
    return here.select("spelled", "side", "size", F.explode(made).alias("s")).select("spelled", "side", "size", "s.position", "s.node", "s.target")


def walked(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level further on; those whose next letter leads nowhere are gone."""
    met = frontier.withColumn("letter", _letter("position")).join(edges, ["node", "letter"])
    on = _goes_on("position + 1", F.col("target"), F.col("sizes"), F.col("nexts"), F.col("ends"))
    return met.filter(on).select("spelled", "side", "size", (F.col("position") + 1).alias("position"), F.col("child").alias("node"), "target")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, near``: all ordered pairs of ``words`` (word) that one letter added, removed or replaced turns into each other.

    Nodes are told by 64-bit hashes of prefixes, so no pair is missed, and every pair is compared letter by letter.
    """
    ways = stored(both_ways(words))
    steps = paths(ways)
    edges = stored(edge_table(steps))
    nodes = stored(node_table(edges))
    ended, level = [], 0
    frontier = stored(edited(steps, nodes))
    while True:
        ended.append(frontier.filter("position = size"))
        frontier = frontier.filter("position < size")
        if level == LEVELS or frontier.isEmpty():
            break
        # what has walked so many levels since its edit stands so deep at least
        frontier = stored(walked(frontier, edges.filter(F.col("depth") >= DEPTH + level)))
        level += 1
    # of very long words the rest is met at once: a node and the whole rest below it
    rest = F.expr("xxhash64(substring(spelled, position + 1))").alias("rest")
    tails = paths(ways.filter(F.col("size") > DEPTH + LEVELS)).filter(F.col("position") >= DEPTH + LEVELS)
    tails = tails.select("node", rest, F.col("word").alias("near"))
    whole = reduce(DataFrame.union, ended).select("spelled", "side", "node")
    ends = ways.select(_node("size").alias("node"), F.col("word").alias("near"))
    found = whole.join(ends, "node").select("spelled", "side", "near")
    found = found.union(frontier.select("spelled", "side", "node", rest).join(tails, ["node", "rest"]).select("spelled", "side", "near"))
    word = F.when(F.col("side") == 0, F.col("spelled")).otherwise(F.reverse("spelled")).alias("word")
    return found.select(word, "near").distinct().filter("levenshtein(word, near, 1) = 1")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (word, form): where following forms ends. Each round doubles the steps.

    Counts grow from form to form by ``FORM_FACTOR``, so chains are short and have no loops.
    """
    jumps = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = stored(jumps.join(further, "root", "left").select("word", "root", "beyond"))
        jumps = step.select("word", F.coalesce("beyond", "root").alias("root"))
        if step.filter("beyond is not null").isEmpty():
            return jumps


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs`` (doc_id, text) that is frequent enough.

    Words are runs of letters, lower-cased A-Z only, of whole texts; null and empty texts have none. Repeated rows
    and rows with equal ids all count. Of near words with equal counts the first in code-point order is the form. An
    empty table gives no rows. Only the two columns are read.
    """
    words = stored(vocabulary(docs))
    pairs = stored(neighbours(words.select("word")))
    counted = pairs.join(words.withColumnRenamed("word", "near"), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near"))).alias("best"))
    chosen = F.col("best.less") * -1 >= FORM_FACTOR * F.col("n")
    table = words.join(best, "word", "left").select(
        "word", F.when(chosen, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, -F.col("best.less")).alias("form_n"),
    )
    table = stored(table)
    linked = roots(table.filter("form is not null"))
    linked = by_size(linked, table.filter("form is not null").count(), 64)
    return table.join(linked, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
