"""SentencePiece BPE encoding and decoding with a prefix table.

For every prefix of a word exactly one piece can be the last one of its encoding. An automaton finds the
pieces that end at each place; a piece is the last one if the prefix before it ends in a piece it can stand
beside, that is, if encoding the two together gives just these two. Ids are then read backwards.
No piece of the model spans a boundary before a space, so words are encoded apart and kept in a bounded store.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tidemark.llm.common import STORES, chunks, small_batches

SPACE = "▁"
#: Units of text that are encoded apart start at a run of spaces or of these.
MARKS = "\n.,!?;:|"
#: Words and pairs that one Python worker keeps, words twice: a full store gives way to a new one that takes
#: from it what is still in use. A word is kept from its second sight on, as its text and its ids.
STORED_WORDS = 100_000
#: Marks by hash for words seen once; they start anew when a quarter is set.
SEEN = 1 << 20
STORED_PAIRS = 200_000
#: Longer words are encoded each time.
LONGEST_STORED = 64
# Fixed values of the model format: kinds of pieces.
NORMAL, UNKNOWN, BYTE = 1, 2, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _utf8(data: bytes) -> str:
    """Text of the bytes, with U+FFFD for every single byte that is not part of a character."""
    out = []
    while data:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as error:
            out.append(data[: error.start].decode() + "\ufffd")
            data = data[error.start + 1 :]
    return "".join(out)


class PieceModel:
    """A BPE model with byte fallback and no normalisation beyond marking spaces."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        prefix, squeeze, rules = True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 3:
                spec = dict(_fields(value))
                prefix, squeeze, rules = spec.get(3, 1), spec.get(4, 1), spec.get(2, b"")
        if rules or squeeze or not prefix:
            raise ValueError("only models without normalisation and with a leading space are supported")
        normal = [i for i, k in enumerate(self.kinds) if k == NORMAL]
        self.ids = {self.pieces[i]: i for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if len(self.bytes) != 256 or any(re.search(f"[^{SPACE}]{SPACE}|^{SPACE}{SPACE}.*[^{SPACE}]", p) for p in self.ids):
            raise ValueError("only models with byte fallback whose pieces start words are supported")
        self.ends = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if not piece.startswith(SPACE * 2):  # runs of spaces have their own order of merges
                self.ends.add_word(piece, (i, len(piece)))
        self.ends.make_automaton()
        self.beside: dict = {}
        self.whole: dict = {}
        self.halves: dict = {}  # the parts of a piece's last merge and its score
        self.unordered: set = set()  # pieces that score no less than a part of theirs
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.seen, self.n_seen = bytearray(SEEN), 0
        self.other: dict[str, str] = {}  # units of the present text that decode to something else, and to what
        # Marks that in no piece follow another character, or only the listed ones: texts are cut before them.
        before = {p: set() for p in MARKS}
        for piece in self.ids:
            for x, y in zip(piece, piece[1:]):
                if y in before and x != SPACE and x not in before:
                    before[y].add(x)
        tied = [f"(?<=[{re.escape(''.join(sorted(x)))}]){re.escape(p)}" for p, x in before.items() if x]
        body = f"[^ {re.escape(MARKS)}]*"
        if tied:
            body += f"(?:(?:{'|'.join(tied)}){body})*"
        marks = f"[{re.escape(MARKS)}]+"
        self.units = re.compile(f" +(?:{marks})?{body}|{marks}{body}")

    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """Pieces by plain merging, the highest score first and of equals the leftmost. Characters stay if unknown.

        ``steps`` gets the two parts of every merge.
        """
        parts: list = list(text)
        right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(parts) and (found := self.ids.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (-self.scores[found], a, b, len(parts[a]) + len(parts[b])))

        for a in range(len(parts) - 1):
            offer(a, a + 1)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or right[a] != b or len(parts[a]) + len(parts[b]) != size:
                continue
            if steps is not None:
                steps.append((parts[a], parts[b]))
            parts[a], parts[b], right[a] = parts[a] + parts[b], None, right[b]
            if right[b] < len(parts):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p is not None]

    def _reachable(self, piece: int) -> bool:
        """Whether merging the text of the piece gives the piece. Its halves are noted, and whether they come first."""
        if (ok := self.whole.get(piece)) is None:
            text, score = self.pieces[piece], self.scores[piece]
            steps: list = []
            ok = self.whole[piece] = self.merged(text, steps) == [text]
            if ok and steps:
                self.halves[text] = (*steps[-1], score)
                made = [self.ids[h] for h in steps[-1] if len(h) > 1]
                if not all(self.scores[h] > score and self._reachable(h) and h not in self.unordered for h in made):
                    self.unordered.add(piece)
        return ok

    def _stay_apart(self, x: str, y: str) -> bool:
        """Whether no merge crosses the border of two pieces.

        The parts at the border grow as each piece is put together, in the order of the scores. Going back in that
        order, a pair of parts would merge if it does so before the step that replaces one of them; of equal scores
        the step further left comes first.
        """
        ids, scores, halves = self.ids, self.scores, self.halves
        limit, behind = -math.inf, False
        while True:
            if (both := ids.get(x + y)) is not None and ((score := scores[both]) > limit or behind and score == limit):
                return False
            a, b = halves.get(x), halves.get(y)
            if b is not None and (a is None or b[2] <= a[2]):
                y, limit, behind = b[0], b[2], True
            elif a is not None:
                x, limit, behind = a[1], a[2], False
            else:
                return True

    def _compatible(self, first: int, second: int) -> bool:
        if first < 0:  # nothing merges with an unknown character
            return self._reachable(second)
        if len(self.beside) >= STORED_PAIRS:
            self.beside.clear()
        a, b = self.pieces[first], self.pieces[second]
        ok = self._reachable(first) and self._reachable(second)
        if ok and (first in self.unordered or second in self.unordered):
            ok = self.merged(a + b) == [a, b]
        else:
            ok = ok and self._stay_apart(a, b)
        self.beside[first << 20 | second] = ok
        return ok

    def _word(self, text: str) -> list[int]:
        """Ids of a word with at most one space, at its start."""
        last = [-1] * (len(text) + 1)  # the last piece of each prefix; -1: a character without a piece
        size = [1] * (len(text) + 1)
        beside = self.beside
        for end, (piece, length) in self.ends.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if start := end - length:
                before = last[start]
                if (fits := beside.get(before << 20 | piece)) is None:
                    fits = self._compatible(before, piece)
            else:
                fits = self._reachable(piece)
            if fits:
                last[end], size[end] = piece, length
        out: list[int] = []
        at = len(text)
        while at:
            if last[at] < 0:
                out += [self.bytes[b] for b in reversed(text[at - 1].encode())]
            else:
                out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a run of spaces and the word behind it."""
        spaces = len(unit) - len(unit.lstrip(SPACE))
        if spaces <= 1:
            return self._word(unit)
        ids = self._word(unit[spaces - 1 :])
        if ids[0] == self.ids[SPACE]:  # the last space stays apart from the word, so it merges with the others
            return [self.ids[p] for p in self.merged(SPACE * spaces)] + ids[1:]
        return [self.ids[p] for p in self.merged(SPACE * (spaces - 1))] + ids

    def decode(self, ids: list[int]) -> str:
        """Text of the ids. Bytes that are no UTF-8 become U+FFFD; the leading space goes."""
        return self._text(ids)[1:] if ids and self.pieces[ids[0]].startswith(SPACE) else self._text(ids)

    def _text(self, ids: list[int]) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held = bytearray()
            if self.kinds[i] == NORMAL:
                out.append(self.pieces[i])
            elif self.kinds[i] == UNKNOWN:
                out.append(" ⁇ ")  # fixed value: how the library prints an unknown piece
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out).replace(SPACE, " ")

    def unit(self, unit: str) -> bytes:
        """A unit's ids as 32-bit integers, from the store if they are there. Units that decode to themselves are stored."""
        if (found := self.older_words.get(unit)) is None:
            ids = self.encode_unit(unit.replace(" ", SPACE))
            found = struct.pack(f"<{len(ids)}i", *ids)
            if (text := self._text(ids)) != unit:
                self.other[unit] = text
                return found
            if not self.seen[at := hash(unit) % SEEN]:
                if self.n_seen >= SEEN // 4:
                    self.seen, self.n_seen = bytearray(SEEN), 0
                self.seen[at], self.n_seen = 1, self.n_seen + 1
                return found
        if len(unit) <= LONGEST_STORED:
            if len(self.words) >= STORED_WORDS:
                self.older_words, self.words = self.words, {}
            self.words[unit] = found
        return found

    def encode_and_decode(self, text: str | None) -> tuple[bytes, str]:
        """All ids of a text and what they decode to. Null and empty texts have no ids."""
        if not text:
            return b"", ""
        self.other.clear()
        get, unit, other = self.words.get, self.unit, self.other
        units = self.units.findall(" " + text.replace(SPACE, " "))
        ids = b"".join([get(w) or unit(w) for w in units])
        return ids, "".join([other.get(w, w) for w in units] if other else units)[1:]


@lru_cache(maxsize=4)
def model(name: str) -> PieceModel:
    """The model file that the driver has handed to every executor."""
    with open(SparkFiles.get(name), "rb") as file:
        return PieceModel(file.read())


STORES["pieces"] = model.cache_clear


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (all of the text's ids) and ``decoded``, their text, for every row.

    Null texts count as empty: no ids, empty text. Texts are encoded whole, however long; rows with equal
    keys are encoded each. Other columns are not read. One narrow stage.
    """
    docs.sparkSession.sparkContext.addFile(model_path)
    name = model_path.rsplit("/", 1)[-1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model(name)
        for batch in chunks(batches, "pieces"):
            done = [encoder.encode_and_decode(t) for t in batch.column(1).to_pylist()]
            values = np.frombuffer(b"".join(d[0] for d in done), "<i4")
            ends = np.cumsum([0] + [len(d[0]) // 4 for d in done]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), pa.array([d[1] for d in done], pa.string())],
                ["k", "ids", "decoded"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return small_batches(docs).select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(work, f"k {kind}, ids array<int>, decoded string").withColumnRenamed("k", key)
