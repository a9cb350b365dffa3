"""Spelling variants against plain versions."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tests.llm.brute import SF, odd_documents, texts
from tidemark.llm import queries, spelling


def plain_words(docs):
    found = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def plain_near(words):
    """Every word that some edit makes, looked up."""
    letters, near = sorted({c for w in words for c in w}), {}
    for w in words:
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
        near[w] = {v for v in made if v in words and v != w}
    return near


def plain(docs):
    words = plain_words(docs)
    near, form = plain_near(words), {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def test_query(spark):
    got = queries.op12_spelling(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "bigint", "bigint", "bigint"]
    assert Counter(map(tuple, got.collect())) == Counter(plain(list(texts().items())))


@pytest.mark.parametrize("letters, levels", [("ab", 24), ("abcé", 24), ("aàÿz", 2), ("ab", 0)])
def test_all_pairs_one_edit_apart(spark, monkeypatch, letters, levels):
    monkeypatch.setattr(spelling, "LEVELS", levels)
    r = random.Random(len(letters) + levels)
    words = {"".join(r.choice(letters) for _ in range(r.randint(6, 11))) for _ in range(400)}
    words |= {w + "long" * r.randint(5, 9) + r.choice(["", "x", "y"]) for w in list(words)[:60]}
    got = Counter(tuple(p) for p in spelling.neighbours(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect())
    assert got == Counter((w, v) for w, near in plain_near(words).items() for v in near)


def test_very_long_words_and_chains(spark):
    """Chains of forms over several steps, ties, and words of thousands of letters one edit apart."""
    long = "ab" * 1500
    texts = {"station": 700, "stations": 130, "statsions": 25, "statsionsx": 5, "stetion": 130, "lonely": 9}
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(texts.items())]
    docs += [(50, " ".join([long] * 30)), (51, " ".join([long[:700] + "z" + long[700:]] * 6)), (52, " ".join([long[:2500] + "q" + long[2501:]] * 5))]
    got = {tuple(x) for x in spelling.variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain(docs)
    assert ("statsionsx", "statsions", "station", 5, 1, 25) in got


def test_damaged_runs():
    """A damaged run loses the letter that its hash names, and all its occurrences in a text do."""
    damaged = [(d, w) for d in range(4000) for w in ("variant", "Größeres") if crc32(f"{d}:{w.lower()}".encode()) % 199 == 0]
    assert damaged
    for d, w in damaged:
        low = w.lower()
        at = crc32(f"{d}:{low}".encode()) % len(low)
        assert spelling.runs_of(d, f"{w} {low}, {w}") == Counter({low[:at] + low[at + 1 :]: 3})


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = {tuple(x) for x in spelling.variants(docs).collect()}
    rows = [("" if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()]
    assert got == plain(rows)
    assert spelling.variants(docs.limit(0)).count() == 0
    many = spark.createDataFrame([(1, "Zürich Zürich ", 1, 2, 3)] * 4 + [(None, "Zurich" + " zürich" * 3 + "É" * 6, 1, 2, 3)], "doc_id long, text string, word int, n int, node int")
    assert {tuple(x) for x in spelling.variants(many).collect()} == plain([("" if r.doc_id is None else r.doc_id, r.text) for r in many.collect()])
