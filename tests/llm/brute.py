"""Plain versions of the operators, over lists in memory."""

from __future__ import annotations

import collections
import re
import struct

import pyarrow.dataset as ds
import xxhash

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use inside.
CLASH = "k string, t string, ids int, decoded string, labels string, score string, found string, spans string, gone int, range int, block int, row int, words string, anchors string, shingles string, n_words int"


def rows(name: str, sf_dir: str = SF) -> list[dict]:
    return ds.dataset(f"{sf_dir}/{name}.parquet").to_table().to_pylist()


def texts(sf_dir: str = SF) -> dict[int, str]:
    return {r["doc_id"]: r["text"] for r in rows("documents", sf_dir)}


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows and keys, extra columns with clashing names."""
    names = CLASH.replace(" string", "").replace(" int", "").split(", ")
    base = [(1, None), (1, ""), (None, "a b c d e f"), (None, None), (2, "same text here " * 4), (2, "same text here " * 4), (3, "x" * 30_000), (4, "lang words " * 8_000)]
    return spark.createDataFrame([(i, t, *[None] * len(names)) for i, t in base], f"doc_id long, text string, {CLASH}")


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.parent[b] = a


def shingle_set(text: str | None) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_components(docs: list[tuple[int, str]], percent: int) -> set[tuple]:
    sets = [shingle_set(t) for _, t in docs]
    groups, seen = Groups(), {}
    for (key, _), s in zip(docs, sets):
        if s:
            groups.join(key, seen.setdefault(s, key))
    where = collections.defaultdict(list)
    unique = list(seen)
    for i, s in enumerate(unique):
        shared = collections.Counter(j for x in s for j in where[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(unique[j]) - n):
                groups.join(seen[s], seen[unique[j]])
        for x in s:
            where[x].append(i)
    return {(key, len(s), groups.root(key)) for (key, _), s in zip(docs, sets)}


def edits_within_one(a: list, b: list) -> bool:
    """By the table of edit distances, so apart from the operator's own test."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1] <= 1


def without_repeated_lines(docs: list[tuple[int, str]], exact: int = 1, near: int = 4) -> dict[int, str]:
    """Exact repeats go from ``exact`` words on, near ones from ``near`` words on."""
    first: dict[tuple, tuple] = {}
    places = sorted((d, i, tuple(x.lower().split())) for d, t in docs for i, x in enumerate(t.split("\n")))
    for d, i, w in places:
        if len(w) >= min(exact, near):
            first.setdefault(w, (d, i))
    by_end = collections.defaultdict(list)
    for w in first:
        # an edit leaves one end of a line as it is
        if len(w) >= near:
            for end in {("first", *w[:2]), ("last", *w[-2:])}:
                by_end[end, len(w)].append(w)
    edited = {
        w
        for w in first
        if len(w) >= near
        for end in {("first", *w[:2]), ("last", *w[-2:])}
        for size in (len(w) - 1, len(w), len(w) + 1)
        for v in by_end[end, size]
        if first[v] < first[w] and edits_within_one(list(v), list(w))
    }
    gone = {(d, i) for d, i, w in places if w in edited or (len(w) >= exact and first[w] < (d, i))}
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in docs}


def whole_items(docs: dict[int, str], items: list[dict]) -> set[tuple[int, int]]:
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    flat = {d: plain(t) for d, t in docs.items()}
    return {(d, i["item_id"]) for i in items for d, t in flat.items() if plain(i["text"]) in t}


def _hash(*values) -> int:
    """Spark's xxhash64 of texts and longs."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def fingerprint(text: str, size: int = 8, k: int = 6) -> str:
    """Closed syncmers of the pieces of a text between blank ones, as ``hash:place`` in hexadecimal digits."""
    h = [_hash(p) for p in re.findall(rf"[^ \t\n\x0b\f\r]{{1,{size}}}", text)]
    h = h and [0] * (k - 1) + h + [0] * (k - 1)
    pairs = [_hash(a, b) for a, b in zip(h, h[1:])]
    found, met, out = [], collections.Counter(), []
    for i in range(len(h) - k + 1):
        window = pairs[i : i + k - 1]
        if min(window) in (window[0], window[-1]):
            found.append((_hash(*h[i : i + k]) & 0x7FFFFFFF, i))
    for x, i in sorted(found):
        n, met[x] = met[x], met[x] + 1
        # the next one of equal hashes is told apart by the number before it
        out.append((x if n == 0 else _later(x, n), i))
    return ",".join(f"{x:x}:{i:x}" for x, i in sorted(out))


def _later(x: int, n: int) -> int:
    first = xxhash.xxh64_intdigest(struct.pack("<q", x), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", n), first) & 0x7FFFFFFF


def likeness(a: str, b: str, shift: int = 8) -> float:
    """From two printed fingerprints: anchors of both in runs of like shifts, as a share of all."""
    x, y = ({int(h, 16): int(i, 16) for h, i in (v.split(":") for v in f.split(",") if v)} for f in (a, b))
    if not x and not y:
        return 1.0
    met = sorted((x[h], y[h]) for h in x.keys() & y.keys())
    moved = [i - j for i, j in met]
    alike = lambda i, j: 0 <= j < len(moved) and abs(moved[i] - moved[j]) <= shift
    in_runs = sum(len(met) == 1 or alike(i, i - 1) or alike(i, i + 1) for i in range(len(met)))
    return in_runs / (len(x) + len(y) - len(met))
