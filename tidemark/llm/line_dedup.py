"""Near-duplicate lines across a corpus, removed but for the earliest, by a deletion-neighbourhood join.

Two lines are near when one word inserted, deleted or replaced turns one into the other. Then the two share a
variant: one with the word at some place left out. Variants of equal length carry the place of the deletion,
variants that meet a whole line do not, so every line of a group under one key is within the bound of the
earliest one the key compares it with. Groups are reduced to their earliest line, never to pairs.

Lines that are too short for an edit to leave them the same meet their exact copies only. Only lines
that can have a partner emit variants. An edit leaves the first or the last half of a line as it
is, so lines whose halves nobody shares have none; this test loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tidemark.llm.common import by_size, chunks, small_batches, stored, with_made

#: Lines of fewer words have no near lines: one edit changes a third of them or more.
LEAST_WORDS = 4
#: Every line that is not blank.
ANY_LINE = 1
#: Odd base of the rolling sum by which all deletions of a line are hashed at once.
BASE = np.uint64(0x9E3779B97F4A7C15)
HALVES = ["head", "tail", "longer_head", "longer_tail"]
NO_HALVES = [None] * len(HALVES)
LINE = f"doc_id long, line_no int, h long, {', '.join(f'{c} long' for c in HALVES)}"


def line_words(line: str) -> list[str]:
    return line.lower().split()


def _hash(*words: str) -> int:
    return xxh64_intdigest(" ".join(words)) - (1 << 63)


def _halves(words: list[str], size: int) -> list[int]:
    """Hashes of the first and the last half of ``size`` words, counted from either end of the line."""
    h = size // 2
    return [_hash(f"head {size}", *words[:h]), _hash(f"tail {size}", *words[len(words) - (size - h) :])]


def hashed_lines(docs: DataFrame, exact_from: int = ANY_LINE) -> DataFrame:
    """Lines of ``exact_from`` words or more: place, hash of the words, hashes of the halves.

    Halves are taken twice: for a partner of the same number of words, and for one that is a word shorter.
    Lines below ``LEAST_WORDS`` have none. Null texts and blank lines do not take part.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids, numbers, hashes, halves = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for number, line in enumerate((text or "").split("\n")):
                    words = line_words(line)
                    if len(words) >= max(exact_from, ANY_LINE):
                        ids.append(doc_id)
                        numbers.append(number)
                        hashes.append(_hash(*words))
                        halves.append(_halves(words, len(words)) + _halves(words, len(words) - 1) if len(words) >= LEAST_WORDS else NO_HALVES)
            columns = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(hashes, pa.int64())]
            columns += [pa.array([x[i] for x in halves], pa.int64()) for i in range(len(HALVES))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line_no", "h", *HALVES])

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, LINE)


def may_have_partners(distinct: DataFrame) -> DataFrame:
    """``h, place`` of distinct lines that share a half, in fitting roles, with another one."""
    roles = [F.struct(F.col(c).alias("key"), F.lit(not c.startswith("longer")).alias("own")) for c in HALVES]
    keyed = distinct.select("h", F.explode(F.array(*roles)).alias("r")).select("h", "r.key", "r.own")
    groups = keyed.groupBy("key").agg(F.max("own").alias("own"), F.min("h").alias("low"), F.max("h").alias("high"))
    shared = groups.filter("own and low <> high").select("key")
    open_lines = keyed.select("h", "key").join(shared, "key", "left_semi").select("h").distinct()
    return distinct.select("h", "place").join(open_lines, "h")


def _worded(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``h, doc_id, line_no, words`` of the lines at ``places``, read from the documents again."""
    wanted = places.groupBy("place.doc_id").agg(F.collect_list(F.struct("place.line_no", "h")).alias("wanted"))
    wanted = stored(wanted.withColumnRenamed("doc_id", "wanted_id"))
    wanted = by_size(wanted, places.count(), 48)
    found = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for doc_id, text, lines in zip(*(c.to_pylist() for c in batch.columns)):
                split = (text or "").split("\n")
                for line in lines:
                    words = line_words(split[line["line_no"]]) if line["line_no"] < len(split) else []
                    if words and _hash(*words) == line["h"]:
                        rows.append({"h": line["h"], "doc_id": doc_id, "line_no": line["line_no"], "words": words})
            yield pa.RecordBatch.from_pylist(rows, WORDED)

    return found.select("doc_id", "text", "wanted").mapInArrow(work, "h long, doc_id long, line_no int, words array<string>").dropDuplicates(["h"])


WORDED = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("line_no", pa.int32()), ("words", pa.list_(pa.string()))])
REPLACED, SHORTENED, WHOLE = 0, 1, 2


def deletion_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """For every word: the hash of the line without it, with and without its place; and the hash of the line."""
    values = np.array([xxh64_intdigest(w) for w in words], np.uint64)
    n = len(values)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(n + 1, BASE))  # BASE ** (1 .. n + 1), all modulo 2 ** 64
        ahead = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:n])])
        left_out = ahead[:-1] + (ahead[-1] - ahead[1:]) * np.uint64(pow(int(BASE), -1, 1 << 64))
        place = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(n)
        return (left_out ^ place) * BASE, np.unique(left_out), int(ahead[-1])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        keys, kinds, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int8)], []
        for words in batch.column(3).to_pylist():
            replaced, shortened, whole = deletion_hashes(words)
            keys += [replaced, shortened, np.array([whole], np.uint64)]
            kinds += [np.full(len(replaced), REPLACED, np.int8), np.full(len(shortened), SHORTENED, np.int8), np.full(1, WHOLE, np.int8)]
            sizes.append(len(replaced) + len(shortened) + 1)
        of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(kinds))] + [batch.column(i).take(of) for i in range(3)],
            ["key", "kind", "h", "doc_id", "line_no"],
        )


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether at most one word inserted, deleted or replaced turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h, earlier`` of distinct lines for which a near line stands at an earlier place.

    Under one key only the earliest place of each kind crosses the join; the two lines are then compared word
    by word.
    """
    worded = stored(_worded(docs, stored(may_have_partners(distinct))))
    variants = worded.mapInArrow(_variants, "key long, kind byte, h long, doc_id long, line_no int")
    # lines replaced at one place meet under their own key; shortened lines meet the whole ones
    placed = variants.select("key", "kind", (F.col("kind") == REPLACED).alias("side"), F.struct("doc_id", "line_no").alias("place"), "h")
    who = F.struct("place", "h")
    groups = (
        placed.groupBy("key", "side")
        .agg(*(F.min(F.when(F.col("kind") == k, who)).alias(f"first_{k}") for k in (REPLACED, SHORTENED, WHOLE)), F.count("*").alias("n"))
        .filter("n > 1")
    )
    partner = F.when(F.col("kind") == REPLACED, F.col(f"first_{REPLACED}")).when(F.col("kind") == SHORTENED, F.col(f"first_{WHOLE}")).otherwise(F.col(f"first_{SHORTENED}"))
    found = placed.join(groups, ["key", "side"]).withColumn("partner", partner).filter("partner.place < place")
    found = found.select("h", F.col("partner.h").alias("other"), F.col("partner.place").alias("earlier")).distinct()
    compared = found.join(worded.select("h", "words"), "h").join(worded.select(F.col("h").alias("other"), F.col("words").alias("other_words")), "other")

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([within_one(list(x), list(y)) for x, y in zip(a, b)], dtype=bool)

    return compared.filter(near("words", "other_words")).groupBy("h").agg(F.min("earlier").alias("earlier"))


def repeated_lines(docs: DataFrame, exact_from: int = ANY_LINE) -> DataFrame:
    """``doc_id, gone`` per document that loses lines; ``gone`` lists the lines' numbers and hashes.

    A line of ``exact_from`` words or more goes if the same or a near line stands at an earlier place (doc_id,
    then line number, null ids first), whether or not that one goes too. Hot lines are reduced inside each task; where their places meet
    the decision, Spark can split them.
    """
    hashed = stored(hashed_lines(docs, exact_from))
    place = F.struct("doc_id", "line_no")
    distinct = stored(
        hashed.groupBy("h").agg(F.min(place).alias("place"), F.max(place).alias("last"), *[F.first(c).alias(c) for c in HALVES])
    )
    near = near_lines(docs, distinct.filter("head is not null")).select(F.col("h").alias("near_h"))
    decided = distinct.join(near, F.col("h") == F.col("near_h"), "left").filter("place < last or near_h is not null")
    decided = stored(decided.select("h", F.col("place").alias("kept_place"), F.col("near_h").isNotNull().alias("near")))
    met = hashed.select("doc_id", "line_no", "h").join(by_size(decided, decided.count(), 48), "h")
    gone = met.filter(F.col("near") | (F.struct("doc_id", "line_no") > F.col("kept_place")))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "h")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, exact_from: int = ANY_LINE) -> DataFrame:
    """``docs`` with lines that repeat earlier ones taken out of ``text``, and ``n_lines``, ``n_dropped`` longs.

    Documents stay, if need be with an empty text; null texts stay null. A document's own repeated lines go as
    well. Exact copies go from ``exact_from`` words on (all but blank lines, unless told otherwise), near ones from
    ``LEAST_WORDS``. Rows with equal ids count as one document: their equal lines at equal places stay.
    Only ``doc_id`` and ``text`` are read, other columns pass.
    """
    gone = stored(repeated_lines(docs, exact_from)).select(F.col("doc_id").alias("__gone_id"), F.col("gone").alias("__gone"))
    size = gone.agg(F.count("*").alias("n"), F.sum(F.size("__gone")).alias("lines")).first()
    gone = by_size(gone, size.n + (size.lines or 0), 32)
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone_id")), "left").select(*[docs[c] for c in docs.columns], "__gone")

    def without(texts: list, lists: list) -> dict:
        kept, sizes, dropped = [], [], []
        for text, lines in zip(texts, lists):
            split = (text or "").split("\n")
            drop = {x["line_no"] for x in lines or [] if x["line_no"] < len(split) and _hash(*line_words(split[x["line_no"]])) == x["h"]}
            kept.append("\n".join([x for i, x in enumerate(split) if i not in drop]) if drop else text)
            sizes.append(0 if text is None else len(split))
            dropped.append(len(drop))
        return {"text": kept, "n_lines": sizes, "n_dropped": dropped}

    made = {"text": T.StringType(), "n_lines": T.LongType(), "n_dropped": T.LongType()}
    return with_made(joined, ["text", "__gone"], without, made).drop("__gone")
