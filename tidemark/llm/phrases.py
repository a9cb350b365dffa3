"""Phrases of two and three words that stand together more often than their parts do, by the stripes pattern.

Every prefix keys an associative counter of the words that follow it, its stripe. The stripe of the empty prefix
counts the words of a language; the stripe of a pair counts the third words, the end of a piece among them. Merged
elementwise, a pair's stripe holds three things at once: its elements are the frequencies of its extensions, their
sum is the pair's own frequency, and their maximum tells whether a longer phrase subsumes it.

Tasks count into stripes before anything is shuffled: words are numbered, a prefix and its next word make one whole
number, and equal numbers are counted. Stripes are dealt into buckets by a hash of their prefix and travel
together, so a prefix is written once. The number of buckets follows the number of words. A pair of two very
frequent words may have any number of extensions: its stripe is split by a hash of the third word. A bucket that
outgrows a task's memory is passed on in parts, which Spark sums up.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from tidemark.llm.common import by_size, chunks, small_batches, stored

LEAST_COUNT = 10
#: A longer phrase that has so many percent of a phrase's occurrences takes its place.
SUBSUMED = 50
TOP = 2_000
UNKNOWN = "und"
#: Lower-case A-Z, one blank, and one sign for all that ends a piece.
PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + b"\t.,;:!?\x0b\x0c\r", string.ascii_lowercase.encode() + b" " + b"\n" * 9)
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 300_000
#: Occurrences that a task holds before it counts them, and elements of a bucket that it merges at a time.
HELD = 1_500_000
#: Occurrences of words for each bucket of stripes.
BUCKET_WORDS = 200_000
#: Words above one occurrence in so many are frequent: there are no more of them than this.
FREQUENT = 1_000
#: Parts of the stripe of a pair of frequent words.
PARTS = 64
#: Numbers of words have so many bits, three of them make a key.
BITS = 21

COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
STRIPES = pa.schema(
    [("bucket", pa.int64()), ("lang", pa.string()), ("firsts", pa.binary()), ("seconds", pa.binary()), ("lengths", pa.binary()), ("thirds", pa.binary()), ("counts", pa.binary())]
)
MERGED = pa.schema(
    [("lang", pa.string()), ("first", pa.string()), ("second", pa.string()), ("third", pa.string()), ("n", pa.int64()), ("most", pa.int64()), ("whole", pa.bool_())]
)


class Numbers(dict):
    """Words to numbers as they come; what no word can be is numbered first."""

    END, NONE = 0, 1

    def __init__(self):
        super().__init__({b"\n": self.END, b"": self.NONE})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def words(self) -> list[bytes]:
        """The words by number; the end of a piece prints as nothing."""
        return [b"", *list(self)[1:]]

    def full(self) -> bool:
        return len(self) > min(HELD_WORDS, (1 << BITS) - HELD_WORDS)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes]]]:
    for batch in chunks(batches):
        langs, texts = (c.to_pylist() for c in batch.columns)
        yield [(lang if lang is not None else UNKNOWN, (text or "").encode().translate(PLAIN)) for lang, text in zip(langs, texts)]


def _by_lang(docs: DataFrame) -> DataFrame:
    return small_batches(docs.select("lang", "text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], schema=COUNTED)
        counts.clear()

    counts: dict[str, Counter] = defaultdict(Counter)
    for texts in _texts(batches):
        for lang, text in texts:
            counts[lang].update(text.split())
        if sum(map(len, counts.values())) > HELD_WORDS:
            yield from rows()
    yield from rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n``: the stripe of the empty prefix of every language."""
    return _by_lang(docs).mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Dealing:
    """Where stripes go: a bucket by the prefix, and by the third word too if both words of the prefix are frequent."""

    def __init__(self, buckets: int, frequent: set[tuple[str, bytes]]):
        self.buckets, self.frequent = buckets, frequent

    def often(self, lang: str, words: list[bytes]) -> np.ndarray:
        return np.array([(lang, w) in self.frequent for w in words], bool)

    def bucket(self, lang: str, hashes: np.ndarray, often: np.ndarray, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = hashes[first] * np.uint64(0x9E3779B97F4A7C15) + hashes[second] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(xxh64_intdigest(lang))
            part = np.where(often[first] & often[second], hashes[third] % np.uint64(PARTS), np.uint64(0))
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + part * np.uint64(0x94D049BB133111EB)
            return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(self.buckets)).astype(np.int64)


def keys_of(numbers: np.ndarray) -> np.ndarray:
    """Keys of all pairs of words with what follows them, of words and ends of pieces in a row."""
    padded = np.concatenate([numbers, np.zeros(2, np.int64)])
    first, second, third = padded[:-2], padded[1:-1], padded[2:]
    pair = (first > Numbers.NONE) & (second > Numbers.NONE)
    return first[pair] << 2 * BITS | second[pair] << BITS | third[pair]


def parts_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << BITS) - 1
    return keys >> 2 * BITS, keys >> BITS & low, keys & low


def _joined(words: pa.Array, numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Words by number, those up to each end as one text."""
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), words.take(pa.array(numbers)))
    return pc.binary_join(lists, b"\n")


def _sliced(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([p.tobytes() for p in np.split(values, ends[:-1])], pa.binary())


def _dealt(lang: str, keys: np.ndarray, numbers: Numbers, dealing: Dealing) -> pa.RecordBatch:
    """The keys of one language as stripes, a row for every bucket."""
    keys, counts = np.unique(keys, return_counts=True)
    words = numbers.words()
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    bucket = dealing.bucket(lang, hashes, dealing.often(lang, words), *parts_of(keys))
    order = np.argsort(bucket, kind="stable")  # keys stay sorted inside a bucket
    bucket, keys, counts = bucket[order], keys[order], counts[order]
    first, second, third = parts_of(keys)
    new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] >> BITS != keys[:-1] >> BITS)]) | new_bucket)  # of stripes
    lengths = np.diff(np.append(starts, len(keys))).astype(np.int32)
    ends = np.append(np.flatnonzero(new_bucket)[1:], len(keys))  # of buckets, in elements
    stripe_ends = np.searchsorted(starts, ends)
    known = pa.array(words, pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[new_bucket]), pa.array([lang] * len(ends), pa.string()),
            _joined(known, first[starts], stripe_ends), _joined(known, second[starts], stripe_ends), _sliced(lengths, stripe_ends),
            _joined(known, third, ends), _sliced(counts.astype(np.int64), ends),
        ],
        schema=STRIPES,
    )


def stripes(docs: DataFrame, dealing: Dealing) -> DataFrame:
    """The stripes of all pairs in buckets, counted inside each task as far as ``HELD`` allows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for lang, parts in keys.items():
                if sum(map(len, parts)):
                    yield _dealt(lang, np.concatenate(parts), numbers, dealing)
            keys.clear()

        numbers, keys, held = Numbers(), defaultdict(list), 0
        for texts in _texts(batches):
            for lang, text in texts:
                row = numbers.of(text.replace(b"\n", b" \n ").split(b" "))
                found = keys_of(row[row != Numbers.NONE])
                keys[lang].append(found)
                held += len(found)
                if held > HELD or numbers.full():
                    yield from rows()
                    numbers, held = Numbers(), 0
        yield from rows()

    kinds = "bucket long, lang string, firsts binary, seconds binary, lengths binary, thirds binary, counts binary"
    return _by_lang(docs).mapInArrow(work, kinds)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _found(lang: str, keys: np.ndarray, counts: np.ndarray, numbers: Numbers, dealing: Dealing, whole: bool) -> pa.RecordBatch:
    """What merged stripes tell. A stripe in parts (not ``whole``) hands on all its elements."""
    first, second, third = parts_of(keys)
    words = numbers.words()
    known = pa.array(words, pa.binary()).cast(pa.string())

    def rows(of: np.ndarray, n: np.ndarray, most: np.ndarray, with_third: bool) -> pa.RecordBatch:
        thirds = known.take(pa.array(third[of])) if with_third else pa.nulls(len(of), pa.string())
        columns = [pa.array([lang] * len(of), pa.string()), known.take(pa.array(first[of])), known.take(pa.array(second[of])), thirds, pa.array(n), pa.array(most), pa.array(np.full(len(of), whole))]
        return pa.RecordBatch.from_arrays(columns, schema=MERGED)

    if not whole:
        return rows(np.arange(len(keys)), counts, np.zeros(len(keys), np.int64), True)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] >> BITS != keys[:-1] >> BITS]))
    longer = (counts >= LEAST_COUNT) & (third > Numbers.NONE)
    totals, most = np.add.reduceat(counts, starts), np.maximum.reduceat(np.where(longer, counts, 0), starts)
    often = dealing.often(lang, words)
    kept = (totals >= LEAST_COUNT) | (often[first[starts]] & often[second[starts]])
    pairs = rows(starts[kept], totals[kept], most[kept], False)
    triples = rows(np.flatnonzero(longer), counts[longer], np.zeros(longer.sum(), np.int64), True)
    return pa.Table.from_batches([pairs, triples]).combine_chunks().to_batches(max_chunksize=len(pairs) + len(triples) + 1)[0] if len(pairs) + len(triples) else pairs


def merged_stripes(dealt: DataFrame, dealing: Dealing) -> DataFrame:
    """``lang, first, second, third, n, most, whole`` of the merged stripes.

    A row without ``third`` is a pair: the sum of its stripe and its largest element that is frequent enough.
    A row with it is an element that is frequent enough. Pairs of frequent words have a row for each part. Elements
    of a bucket too large for a task come in parts that are not ``whole``, none left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(whole: bool) -> Iterator[pa.RecordBatch]:
            for lang, parts in merged.items():
                yield _found(lang, *_summed(*(np.concatenate(p) for p in zip(*parts))), numbers, dealing, whole)
            merged.clear()

        numbers, merged, held, bucket, outgrown = Numbers(), defaultdict(list), 0, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                key, lang, firsts, seconds, lengths, thirds, counts = (c[i].as_py() for c in batch.columns)
                if key != bucket:
                    yield from found(not outgrown)
                    numbers, held, bucket, outgrown = Numbers(), 0, key, False
                elif held > HELD or numbers.full():
                    outgrown = True
                    yield from found(False)
                    numbers, held = Numbers(), 0
                pair = numbers.of(firsts.split(b"\n")) << 2 * BITS | numbers.of(seconds.split(b"\n")) << BITS
                third = numbers.of(thirds.split(b"\n"))
                merged[lang].append((np.repeat(pair, np.frombuffer(lengths, np.int32)) | third, np.frombuffer(counts, np.int64)))
                held += len(third)
        yield from found(not outgrown)

    sorted_ = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return sorted_.mapInArrow(work, "lang string, first string, second string, third string, n long, most long, whole boolean")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), in whole decimals of 38 digits."""
    return F.expr(f"cast((cast({a} as decimal(38,0)) * {a} * 1000000) div (cast({left} as decimal(38,0)) * {right}) as bigint)")


def _with_words(df: DataFrame, words: DataFrame, frequent: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the frequency of the word in ``column``; frequent words, which many rows hold, are met by broadcast."""
    named = lambda w: w.select(F.col("lang"), F.col("word").alias(column), F.col("n").alias(name))
    keys = ["lang", column]
    near = df.join(F.broadcast(named(frequent)), keys)
    far = df.join(F.broadcast(named(frequent).select(*keys)), keys, "left_anti").join(named(words), keys)
    return near.unionByName(far)


def phrases(docs: DataFrame) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two and three words.

    ``docs`` has ``lang`` (null: ``und``) and ``text`` (null: empty); other columns are not read. Texts are read
    whole and cut at ``. , ; : ! ?`` and line ends; words are what blanks and tabs leave. ``a`` counts the phrase, ``l`` and ``r``
    the two parts of its lowest-scoring cut, ``n`` all words of the language. Repeated rows count each time; equal
    scores are ordered by ``a``, then by the phrase. A language without candidates, or an empty table, gives no rows.
    """
    words = stored(word_counts(docs))
    total = words.agg(F.sum("n").alias("n")).first().n or 0
    often = words.filter(F.col("n") > total // FREQUENT)
    frequent = {(r.lang, r.word.encode()) for r in often.collect()}  # fewer than FREQUENT rows
    dealing = Dealing(1 + total // BUCKET_WORDS, frequent)
    merged = stored(merged_stripes(stripes(docs, dealing), dealing))

    # stripes that came in parts are merged by element first; the end of a piece prints as nothing
    elements = merged.filter("not whole").groupBy("lang", "first", "second", "third").agg(F.sum("n").alias("n"))
    longer = (F.col("third") != "") & (F.col("n") >= LEAST_COUNT)
    whole = merged.filter("whole and third is null").select("lang", "first", "second", "n", "most")
    parts = elements.select("lang", "first", "second", "n", F.when(longer, F.col("n")).otherwise(0).alias("most"))
    pairs = whole.union(parts).groupBy("lang", "first", "second").agg(F.sum("n").alias("a"), F.max("most").alias("most"))
    pairs = stored(pairs.filter(F.col("a") >= LEAST_COUNT))
    triples = merged.filter("whole and third is not null").select("lang", "first", "second", "third", F.col("n").alias("a"))
    triples = triples.union(elements.filter(longer).select("lang", "first", "second", "third", F.col("n").alias("a")))
    known = words.filter(F.col("n") >= LEAST_COUNT)

    before = triples.groupBy("lang", F.col("second").alias("first"), F.col("third").alias("second")).agg(F.max("a").alias("most_before"))
    two = pairs.join(before, ["lang", "first", "second"], "left")
    two = two.filter(100 * F.greatest("most", F.coalesce("most_before", F.lit(0))) < SUBSUMED * F.col("a"))
    two = _with_words(_with_words(two, known, often, "first", "l"), known, often, "second", "r")
    two = two.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", "l", "r", score("a", "l", "r").alias("score"))

    three = _with_words(_with_words(triples, known, often, "first", "l1"), known, often, "third", "r2")
    three = three.join(pairs.select("lang", "first", "second", F.col("a").alias("l2")), ["lang", "first", "second"])
    three = three.join(pairs.select("lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("r1")), ["lang", "second", "third"])
    three = three.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l2", "r2"))
    lower = F.col("s2") < F.col("s1")
    chosen = lambda name: F.when(lower, F.col(f"{name}2")).otherwise(F.col(f"{name}1"))
    three = three.select("lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a", chosen("l").alias("l"), chosen("r").alias("r"), chosen("s").alias("score"))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = two.union(three).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP)
    sizes = stored(words.groupBy("lang").agg(F.sum("n").alias("n")))
    top = top.join(by_size(sizes, sizes.count(), 64), "lang")
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
