"""Benchmark decontamination: n-gram seeds bring passages and test items together, local alignment scores the pairs.

The benchmark is a stated query set. It is dealt into blocks of bounded size, and each block meets the whole
corpus in one reading. Every n-gram of an item is a seed wherever it stands in a text, however common it is, as
the ones an edited copy holds cannot be told from the item. Around seeds, parts of a text that hold too few of the
item's words for the score asked for are passed over, which loses nothing; the others are scored by Smith-Waterman
alignment over words, so edited and partly copied items are found. A pair must share one n-gram. An excerpt counts
from a number of words on, however long its item is; items of a few words count where they are a whole line.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, small_batches, stored

SEED_WORDS = 3
#: Shorter items are evidence only as a whole line of a text, word for word.
LEAST_WORDS = 5
#: Words of the benchmark that one block holds; a block is what each task keeps in memory.
BLOCK_WORDS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the score of a whole exact copy from which a document counts as contaminated.
LEAST_SCORE = 0.5
#: An alignment that scores as this many equal words do counts too, whatever share of a long item it is.
EXCERPT_WORDS = 30

WORD = re.compile(r"[^\W_]+")
HIT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Block:
    """Items as arrays of word numbers (from 1), and their distinct n-grams in order."""

    def __init__(self, items: list[tuple[int, str]]):
        self.numbers: dict[str, int] = {}
        self.items = []
        self.short: dict[tuple[str, ...], list[int]] = {}
        for item_id, text in items:
            words = words_of(text)
            if 0 < len(words) < LEAST_WORDS:
                self.short.setdefault(tuple(words), []).append(item_id)
            elif words:
                self.items.append((item_id, np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)))
        keys = [self.keys(w) for _, w in self.items]
        flat = np.concatenate([np.zeros(0, np.int64), *keys])
        order = np.argsort(flat, kind="stable")
        self.grams, starts = np.unique(flat[order], return_index=True)
        #: Where each n-gram's places begin, and of these places the item and the offset in it.
        self.starts = np.append(starts, len(flat))
        self.of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])[order]
        self.offsets = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(k)) for k in keys]])[order]

    def least(self, least: float) -> np.ndarray:
        """Share of each item's own score from which an alignment with it counts."""
        return np.array([min(least, EXCERPT_WORDS / len(w)) for _, w in self.items], np.float64)

    def whole_lines(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Short items that are a line of their own: item, first and last word."""
        at = 0
        for line in text.split("\n"):
            words = words_of(line)
            for item_id in self.short.get(tuple(words), ()) if len(words) < LEAST_WORDS else ():
                yield item_id, at, at + len(words) - 1
            at += len(words)

    def errors(self, n: int, least: float) -> int:
        """Words left out, added or replaced that an alignment of ``least`` with an item of ``n`` words can have."""
        return math.floor(MATCH * n * (1 - least) / min(-MISMATCH, -GAP)) + 1

    def keys(self, numbers: np.ndarray) -> np.ndarray:
        """A key for each n-gram; 0 where a word is not of this block."""
        size = len(self.numbers) + 1
        n = max(0, len(numbers) - SEED_WORDS + 1)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(SEED_WORDS):
            part = numbers[k : k + n]
            key, known = key * size + part, known & (part > 0)
        return np.where(known, key, 0)

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the block's n-grams in a text, and which they are."""
        keys = self.keys(numbers)
        places = np.flatnonzero(keys)
        at = np.searchsorted(self.grams, keys[places])
        at = np.minimum(at, max(len(self.grams) - 1, 0))
        hit = self.grams[at] == keys[places] if len(self.grams) else np.zeros(0, bool)
        return places[hit], at[hit]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its score as a share of a whole copy's, and where in the passage it begins and ends."""
    n = len(passage)
    steps = GAP * np.arange(n + 1)
    above, begin_above = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best, span = 0, (0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        row = np.zeros(n + 1, np.int64)
        begin = np.arange(n + 1)
        down = above[1:] + GAP
        row[1:] = np.maximum(diagonal, down)
        begin[1:] = np.where(diagonal >= down, begin_above[:-1], begin_above[1:])
        begin = np.where(row > 0, begin, np.arange(n + 1))
        row = np.maximum(row, 0)
        lifted = row - steps  # a gap in the item: the best of the places to the left, less a gap for each step
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row, begin = top + steps, begin[source]
        at = int(row.argmax())
        if row[at] > best:
            best, span = int(row[at]), (int(begin[at]), at)
        above, begin_above = row, begin
    return best / (MATCH * len(item)), span[0], span[1]


def regions(block: Block, numbers: np.ndarray, least: np.ndarray, slack: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Item, begin and end of each part of a text where an n-gram of an item stands and its score may reach ``least``.

    An alignment that reaches ``least`` has at most ``block.errors(n, least)`` words left out, added or replaced,
    so it stays that near to the diagonals of its n-grams, and that bounds how many words it covers and how many of
    them are the item's. ``least`` and ``slack`` have the share and this number for each item.
    """
    places, grams = block.find(numbers)
    if not len(places):
        return
    sizes = block.starts[grams + 1] - block.starts[grams]
    at = np.arange(sizes.sum()) + np.repeat(block.starts[grams] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    items, diagonals = block.of[at], np.repeat(places, sizes) - block.offsets[at]
    order = np.lexsort((diagonals, items))
    items, diagonals = items[order], diagonals[order]
    cut = np.flatnonzero((np.diff(items) != 0) | (np.diff(diagonals) > slack[items[1:]])) + 1
    known, last = np.zeros(len(block.numbers) + 1, bool), 0
    for low, high in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(items)]]) - 1):
        item = int(items[low])
        words = block.items[item][1]
        n, reach = len(words), int(slack[item])
        if item != last:
            known[block.items[last][1]], last = False, item
        known[words] = True
        begin, end = max(0, int(diagonals[low]) - reach), min(len(numbers), int(diagonals[high]) + n + reach)
        held = np.concatenate([[0], np.cumsum(known[numbers[begin:end]])])
        covered = min(n + reach, end - begin)
        if (held[covered:] - held[: len(held) - covered]).max() >= least[item] * n:
            yield item, begin, end


def _hits(block: Block, least: np.ndarray, slack: np.ndarray, numbers: np.ndarray) -> Iterator[dict]:
    for item, begin, end in regions(block, numbers, least, slack):
        item_id, words = block.items[item]
        score, first, last = align(words, numbers[begin:end])
        if score >= least[item]:
            yield {"item_id": item_id, "score": score, "first_word": begin + first, "last_word": begin + last - 1}


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` for documents that hold an item, or enough of it.

    ``docs`` has doc_id, text; ``benchmark`` item_id, text. Words are runs of letters and digits in lower case,
    counted from 0 in the document. Enough of an item is ``least`` of a whole copy's score, or the score of
    ``EXCERPT_WORDS`` equal words. Items of less than ``LEAST_WORDS`` words count where they are a whole line, with
    score 1. Null and blank texts and items match nothing; of repeated ids the best score counts, and of equal
    scores the earliest place. Texts are read whole, once per block of the benchmark; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    total = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first().n or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    found = None
    for number in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        hits = _contaminated_by(docs, Block([(r.item_id, r.text) for r in sorted(part)]), least)
        found = hits if found is None else found.union(hits)
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct("score", -F.col("first_word"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def _contaminated_by(docs: DataFrame, block: Block, least: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.numbers.get
        shares = block.least(least)
        slack = np.array([block.errors(len(w), s) for (_, w), s in zip(block.items, shares)], np.int64)
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                numbers = np.array([number(w, 0) for w in words_of(text)], np.int64)
                rows += [{"doc_id": doc_id} | h for h in _hits(block, shares, slack, numbers)]
                if block.short and text:
                    rows += [{"doc_id": doc_id, "item_id": i, "score": 1.0, "first_word": a, "last_word": b} for i, a, b in block.whole_lines(text)]
            yield pa.RecordBatch.from_pylist(rows, HIT)

    ddl = "doc_id long, item_id long, score double, first_word long, last_word long"
    return small_batches(docs).select("doc_id", "text").mapInArrow(work, ddl)


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without contaminated documents; rows without an id stay."""
    bad = stored(contaminated(docs, benchmark, least).filter("doc_id is not null").select(F.col("doc_id").alias("bad_id")).distinct())
    return docs.join(bad, docs["doc_id"] == bad["bad_id"], "left_anti")
