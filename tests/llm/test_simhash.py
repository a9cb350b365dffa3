"""SimHash fingerprints and groups against plain versions."""

import itertools
import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tests.llm import brute
from tests.llm.brute import SF, odd_documents, texts
from tidemark.llm import queries, simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    groups = brute.Groups()
    for a, b in itertools.combinations(set(values), 2):
        if (a ^ b).bit_count() <= 4:
            groups.join(a, b)
    return groups


def plain(docs):
    marks = [(d, plain_fingerprint(t)) for d, t in docs]
    groups, least = plain_groups([m for _, m in marks]), {}
    for d, m in marks:
        least[groups.root(m)] = min(least.get(groups.root(m), d), d)
    return {(d, f"{m:016x}", least[groups.root(m)]) for d, m in marks}


def test_query(spark):
    got = queries.op13_simhash(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and [t for _, t in got.dtypes] == ["bigint", "string", "bigint"]
    got = {tuple(r) for r in got.collect()}
    assert got == plain(list(texts().items()))
    assert len({c for _, _, c in got}) < len(got)


def test_four_shared_bytes_always_meet():
    for size, n in ((2, 7), (3, 20), (4, 70)):
        sets = [set(s) for s in simhash.position_sets(size)]
        assert len(sets) == n
        assert all(any(s <= set(four) for s in sets) for four in itertools.combinations(range(8), 4))
    assert [simhash.key_size(n) for n in (0, 1 << 20, (1 << 20) + 1, 1 << 28, 1 << 40)] == [2, 2, 3, 3, 4]


def test_the_tally():
    r = random.Random(1)
    values = [int.from_bytes(bytes(r.choice([0, 0, 1, 128, r.randrange(256)]) for _ in range(8)), "big") for _ in range(3000)]
    assert simhash.shared_bytes(np.array(values, np.uint64)).tolist() == [v.to_bytes(8, "big").count(0) for v in values]


def scattered(r, n):
    """Fingerprints around a few centres, from one to seven bits apart, and random ones."""
    centres = [r.getrandbits(64) for _ in range(n // 40)]
    near = [r.choice(centres) ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 7))) for _ in range(n)]
    return sorted({*near, *(r.getrandbits(64) for _ in range(n)), 0, (1 << 64) - 1})


@pytest.mark.parametrize("posting, size", [(4096, 2), (4096, 3), (4096, 4), (3, 2), (0, 2)])
def test_links_reach_what_all_pairs_reach(spark, monkeypatch, posting, size):
    monkeypatch.setattr(simhash, "POSTING", posting)
    monkeypatch.setattr(simhash, "key_size", lambda n: size)
    values = scattered(random.Random(posting + size), 400 if posting else 120)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    df = spark.createDataFrame(signed, "fingerprint long").repartition(7)
    groups, expected = brute.Groups(), plain_groups(values)
    for a, b in simhash.links(df, len(values)).collect():
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        groups.join(a, b)
    assert all((groups.root(a) == groups.root(b)) == (expected.root(a) == expected.root(b)) for a, b in itertools.combinations(values, 2))


def test_near_copies_link(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(3000)}" for _ in range(1500)]
    docs = [(5 * k + 2, " ".join([*base[: 50 * k], "other", *base[50 * k :]])) for k in range(25)]
    docs += [(1000 + k, " ".join(f"v{r.randrange(10**6)}" for _ in range(300))) for k in range(25)]
    got = {tuple(x) for x in simhash.similar(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == plain(docs) and sum(c < 1000 for _, _, c in got) == 25


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.similar(docs).collect()), key=str)
    zero = "0" * 16
    # the texts without words link, whatever their ids, and take the smallest id
    assert got.count((1, zero, 1)) == 2 and (None, zero, 1) in got and len(got) == docs.count()
    assert (None, f"{plain_fingerprint('a b c d e f'):016x}", None) in got
    assert sum(r[0] == 2 and r[2] == 2 for r in got) == 2
    assert simhash.similar(docs.limit(0)).collect() == []
    clash = docs.selectExpr("doc_id", "text", "1 as fingerprint", "2 as component_id", "3 as n", "4 as met", "5 as least")
    assert sorted((tuple(r) for r in simhash.similar(clash).collect()), key=str) == got


def test_hot_rows_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.common.HOT_SHARE", 4)
    docs = [(k, "one two three four five" if k % 3 else f"text {k} stands alone") for k in range(6, 3600)]
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs) and {c for k, c in got.items() if k % 3} == {7}
