"""Token ids packed at a fixed number of bits, in files whose blocks can be read at random.

A shard image holds a header, the lengths of its documents, the byte offset of every block of ``BLOCK`` ids
and the packed ids. Images are rows of a Parquet table, so Spark writes them to any store it can reach.

    header  4s magic, u16 version, u16 bits per id, u32 documents, u64 ids, u32 ids per block
    lengths u32 per document
    offsets u64 per block, from the start of the packed ids
    ids     blocks one after another, each id in ``bits`` bits, lowest bit first, each block ending on a byte
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import STORES, chunks, range_bounds, range_of, shuffle_parts, small_batches

MAGIC, VERSION = b"TMID", 1
HEADER = struct.Struct("<4sHHIQI")
BLOCK = 4096
#: A shard is closed once it holds so many ids. One longer document makes a longer shard.
SHARD_IDS = 1_000_000
#: Words that one Python worker keeps with their ids, twice; longer words are encoded each time.
STORED_WORDS = 250_000
LONGEST_STORED = 64


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(wide[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: memoryview, count: int, bits: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(data, "<u2", count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def build_image(documents: list[np.ndarray], bits: int) -> bytes:
    ids = np.concatenate(documents) if documents else np.zeros(0, "<u4")
    packed = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0] + [len(p) for p in packed[:-1]]).astype("<u8")[: len(packed)]
    head = HEADER.pack(MAGIC, VERSION, bits, len(documents), len(ids), BLOCK)
    return b"".join([head, np.array([len(d) for d in documents], "<u4").tobytes(), offsets.tobytes(), *packed])


class Image:
    """A shard image opened for reading; nothing is unpacked before it is asked for."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        magic, version, self.bits, documents, self.ids, self.block = HEADER.unpack_from(self.data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("no shard of token ids")
        at = HEADER.size
        self.lengths = np.frombuffer(self.data, "<u4", documents, at).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        blocks = -(-self.ids // self.block)
        self.offsets = np.frombuffer(self.data, "<u8", blocks, at + 4 * documents)
        self.body = at + 4 * documents + 8 * blocks

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start``: only the blocks that hold them are unpacked."""
        if start < 0 or count < 0 or start + count > self.ids:
            raise IndexError("outside the shard")
        out = []
        while count:
            number, inside = divmod(start, self.block)
            held = min(self.block, self.ids - number * self.block)
            at = self.body + int(self.offsets[number])
            size = -(-held * self.bits // 8)
            take = min(count, held - inside)
            out.append(unpack(self.data[at : at + size], held, self.bits)[inside : inside + take])
            start, count = start + take, count - take
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.lengths[number]))


#: ASCII marks but the apostrophe, between a letter of Latin-1 and white space: they are a word of their own for every
#: tokenizer whose words are runs of letters or of other signs.
_MARK = rb"[!-&(-/:-@\[-`{-~]"
CLOSING = re.compile(
    rb"(%b)(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))(%b*)(?=[ \t\n\r\v\f]|\Z)" % (_MARK, _MARK), re.DOTALL
)


class WordEncoder:
    """Ids of whole texts for a tokenizer that drops white space and never joins what it divides.

    The words between ASCII white space, cut before closing marks and in lower case, are encoded by the library
    and kept in a bounded store, so most words of a corpus are looked up. A full store gives way to a new one that takes from it what is still in use.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        special = sorted((i, t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.mark = special[0] if special and not any(t.lstrip or t.rstrip for t in self.tokenizer.get_added_tokens_decoder().values()) else None
        close = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = None
        if close:
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.closes[[i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith(close)]] = True
        self.words: dict = {}
        self.older: dict = {}

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _spaced(self, words: list[bytes]) -> dict:
        """Words of letters in one call: each is one run, whose last id is a piece that closes a word."""
        made = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)
        ids = np.array(made[0].ids, "<u4")
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
        return {w: raw[s:e] for w, s, e in zip(words, [0, *ends], ends)} if len(ends) == len(words) else {}

    def _marked(self, words: list[bytes]) -> dict:
        """Many words in one call: a special token stands between them, on either side of which ids do not depend."""
        number, text = self.mark
        ids = self._ids(text.join([*words, b""]))
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(ids == number)).tolist()
        if len(ends) != len(words):
            return {}
        starts = [0, *(e + 4 for e in ends)]
        return {w: raw[s:e] for w, s, e in zip(words, starts, ends)}

    def _words(self, text: bytes) -> list[bytes]:
        if b"<|" in text:  # special tokens are matched as they stand, not in lower case
            return text.split()
        return CLOSING.sub(rb" \1\2", text.lower()).split()

    def learn(self, words: set[bytes]) -> dict:
        """Ids of words as bytes, those of the store included."""
        found, new = {}, []
        for w in words:
            if (ids := self.older.get(w)) is not None:
                found[w] = ids
            else:
                new.append(w)
        letters = [w for w in new if w.decode().isalpha()] if self.closes is not None else []
        for at in range(0, len(letters), 4096):
            found.update(self._spaced(letters[at : at + 4096]))
        plain = [w for w in new if w not in found and self.mark is not None and self.mark[1] not in w]
        for at in range(0, len(plain), 4096):
            found.update(self._marked(plain[at : at + 4096]))
        for w in new:
            if w not in found:
                found[w] = self._ids(w).tobytes()
        if len(self.words) + len(found) > STORED_WORDS:
            self.older, self.words = self.words, {}
        self.words.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_STORED)
        return found

    def encode(self, texts: list[str | None], end: int | None) -> list[np.ndarray]:
        close = b"" if end is None else np.array([end], "<u4").tobytes()
        split = [self._words(t.encode()) if t else [] for t in texts]
        flat = [w for words in split for w in words]
        found = list(map(self.words.get, flat))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            fresh = self.learn({flat[i] for i in missing})
            for i in missing:
                found[i] = fresh[flat[i]]
        ends = list(accumulate(map(len, split), initial=0))
        return [np.frombuffer(b"".join(found[i:j]) + close, "<u4") for i, j in zip(ends, ends[1:])]


@lru_cache(maxsize=4)
def encoder(name: str) -> WordEncoder:
    return WordEncoder(SparkFiles.get(name))


STORES["tokens"] = encoder.cache_clear


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, end: int | None, parts: int | None = None) -> None:
    """Encode whole texts and write the ids to ``path`` in ascending ``doc_id`` order.

    Null and empty texts have no ids but the end id. Null ids of documents come first, rows with equal ids in the
    order of their token ids. Other columns are not read; texts are encoded whole, however long. Documents are dealt
    into ranges of doc_id that hold about equally many, so only packed ids are shuffled; shards are numbered by range
    and place.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]
    parts = parts or shuffle_parts(spark)
    bounds = range_bounds(docs, "doc_id", parts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(name)
        for batch in chunks(batches, "tokens"):
            ids = made.encode(batch.column(2).to_pylist(), end)
            packed = pa.array([pack(x, made.bits) for x in ids], pa.binary())
            counts = pa.array([len(x) for x in ids], pa.int64())
            bits = pa.array([made.bits] * len(ids), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), counts, bits, packed], ["range", "doc_id", "n", "bits", "packed"]
            )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        keys: list = []
        number, at, size, bits = 0, None, 0, 0

        def close() -> pa.RecordBatch:
            row = {"range": at, "shard": number, "doc_ids": keys, "n_ids": size, "image": build_image(held, bits)}
            return pa.RecordBatch.from_pylist([row], SHARD)

        for batch in chunks(batches, "tokens"):
            for where, key, n, bits, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (where != at or size >= SHARD_IDS):
                    yield close()
                    number = number + 1 if where == at else 0
                    held, keys, size = [], [], 0
                at = where
                held.append(unpack(memoryview(packed), n, bits))
                keys.append(key)
                size += n
        if held:
            yield close()

    placed = small_batches(docs).select(range_of(F.col("doc_id"), bounds).alias("range"), "doc_id", "text")
    encoded = placed.mapInArrow(encode, "range int, doc_id long, n long, bits int, packed binary")
    dealt = encoded.repartitionById(parts, "range").sortWithinPartitions("range", "doc_id", "packed")
    dealt.mapInArrow(shards, "range int, shard int, doc_ids array<long>, n_ids long, image binary").write.parquet(path)


SHARD = pa.schema(
    [("range", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("image", pa.binary())]
)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document ``doc_id``, ``start`` (ids before it in the whole order), ``n_tokens``, ``ids_crc32``.

    Starts come from the shards' counts: sums over the shards of a range, and over the ranges, of which there
    are as many as the writer had parts.
    """
    shards = spark.read.parquet(path)
    order = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = shards.select("range", "shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    totals = shards.groupBy("range").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = totals.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    starts = inside.join(ranges, "range").select("range", "shard", (F.col("before") + F.col("earlier")).alias("first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                where, number, keys = (batch.column(i)[row].as_py() for i in range(3))
                image = Image(batch.column(3)[row].as_buffer())
                ids = image.read(0, image.ids)
                crcs = [zlib.crc32(ids[s : s + n]) for s, n in zip(image.starts.tolist(), image.lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([where] * len(keys), pa.int32()),
                        pa.array([number] * len(keys), pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(image.starts),
                        pa.array(image.lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["range", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    read = shards.select("range", "shard", "doc_ids", "image").mapInArrow(
        work, "range int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return read.join(starts, ["range", "shard"]).select(
        "doc_id", (F.col("inside") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
