"""Near copies, repeated lines, benchmark passages and fingerprints against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.brute import SF, odd_documents, rows, texts
from tidemark.llm import common, decontamination, fingerprints, line_dedup, near_dedup, queries


def near_rows(df, percent=85):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.similar(df, percent).collect()}


def test_near_query(spark):
    got = queries.op2_near_dedup(spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute.near_components(list(texts().items()), 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """A group far larger than a task compares: most link to the middle, some only to each other, some to nothing."""
    monkeypatch.setattr(near_dedup, "CLUSTER", 60)
    r = random.Random(4)
    base = [f"w{r.randrange(5000)}" for _ in range(100)]
    docs = []
    for k in range(500):
        words = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4])):
            words[r.randrange(100)] = f"x{r.randrange(10**6)}"
        docs.append((3 * k + 1, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert near_rows(df) == brute.near_components(docs, 85)


def test_signatures_estimate_similarity_and_stop_early():
    rng, errors = np.random.default_rng(1), []
    for n in (3, 10, 50, 400, 3000):
        for _ in range(10):
            a = np.unique(near_dedup.mixed(rng.integers(0, 2**62, n).astype(np.uint64)))
            b = np.unique(np.concatenate([a[: int(n * 0.8)], near_dedup.mixed(rng.integers(0, 2**62, n // 5 + 1).astype(np.uint64))]))
            both = near_dedup.signatures([a, b])
            errors.append((both[0] == both[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
            assert (near_dedup.signatures([b, a, b])[1] == both[0]).all()
    assert np.abs(errors).mean() < 0.035 and abs(np.mean(errors)) < 0.02
    many = near_dedup.signatures([np.unique(near_dedup.mixed(np.arange(5000, dtype=np.uint64)))])
    assert (many >> np.uint64(32)).max() == 0  # all components are filled by the first ranks


def test_bands_miss_little():
    for percent in (80, 85, 90, 95):
        r = near_dedup.rows_per_band(percent)
        assert near_dedup.M % r == 0 and (1 - (percent / 100) ** r) ** (near_dedup.M // r) <= near_dedup.MISSED


def test_components(spark):
    r = random.Random(2)
    order = list(range(600))
    r.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(599) if i % 70] + [(i, i + 1) for i in range(1000, 1400)]
    groups = brute.Groups()
    for a, b in edges:
        groups.join(a, b)
    df = spark.createDataFrame([*edges, (None, 3), (5, 5)], "a long, b long").repartition(100)
    got = {x.node: x.component for x in common.components(df).collect()}
    assert got == {k: groups.root(k) for k in groups.parent if groups.root(k) != k}
    assert common.components(df.limit(0)).count() == 0


def test_odd_documents_near(spark):
    docs = odd_documents(spark)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.similar(docs).collect())
    assert got[(1, 0, 1, True)] == 2 and got[(None, 2, None, True)] == 1 and got[(2, 3, 2, True)] == 2
    assert near_dedup.similar(docs.limit(0)).count() == 0
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_line_query(spark):
    got = {r.doc_id: r.text for r in queries.op8_line_dedup(spark, SF).collect()}
    assert got == brute.without_repeated_lines(list(texts().items()))


def test_edited_lines(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    base = [[r.choice(words) for _ in range(r.randint(2, 14))] for _ in range(25)]

    def edited():
        line = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            at = r.randrange(max(1, len(line)))
            kind = r.randrange(3)
            line[at : at + (kind != 0)] = [] if kind == 1 else [r.choice(words)]
        return " ".join(line)

    docs = [(d, "\n".join(edited() for _ in range(r.randint(0, 8)))) for d in range(100)]
    got = {x.doc_id: x.text for x in line_dedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.without_repeated_lines(docs)


def test_short_lines(spark):
    """Exact copies of any length go, near ones from four words on; blank lines stay."""
    docs = [(1, "of.\na b c d e f g\n\nnospaces\nx y z\np q r s"), (2, "Of.\na b c d e f x\n\nnospaces\nx y w\np q s"), (3, "of.\nof the\nA  b c d e f g\n \na b c d e f g h\nx y z\np q t s\nt s q p")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got == {1: (docs[0][1], 0), 2: ("\nx y w\np q s", 3), 3: ("of the\n \nt s q p", 5)}
    assert {k: t for k, (t, _) in got.items()} == brute.without_repeated_lines(docs)


def test_line_query_leaves_no_exact_repeat(spark):
    """Repeats of any length go, and beyond them only what the near step takes."""
    docs, seen, expected = list(texts().items()), set(), {}
    for key, text in sorted(docs):
        left = []
        for line in text.split("\n"):
            words = tuple(line.lower().split())
            if len(words) >= line_dedup.LEAST_WORDS or not words or words not in seen:
                left.append(line)
            seen.add(words)
        expected[key] = "\n".join(left)
    got = {r.doc_id: r.text for r in queries.op8_line_dedup(spark, SF).collect()}
    assert got == brute.without_repeated_lines(list(expected.items()))


def test_within_one_edit():
    r = random.Random(1)
    for _ in range(3000):
        a, b = ([r.randrange(3) for _ in range(r.randint(1, 6))] for _ in range(2))
        assert line_dedup.within_one(a, b) == brute.edits_within_one(a, b)


def test_odd_documents_lose_lines(spark):
    docs = odd_documents(spark)
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == [*docs.columns, "n_lines", "n_dropped"] and left.count() == docs.count()
    assert sorted((str(r.doc_id), r.text is None, r.n_dropped) for r in left.collect())[:2] == [("1", False, 0), ("1", True, 0)]
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_contamination_query(spark):
    got = queries.op1_decontamination(spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.score == 1.0} == brute.whole_items(texts(), rows("benchmark"))


def test_alignment_equals_the_plain_table():
    r = random.Random(0)

    def plain(a, b):
        table, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
                best = max(best, table[i][j])
        return best / (2 * len(a))

    for _ in range(300):
        a, b = (np.array([r.randrange(5) for _ in range(r.randint(1, 14))]) for _ in range(2))
        score, first, last = decontamination.align(a, b)
        assert abs(score - plain(a, b)) < 1e-9 and abs(plain(a, b[first:last]) - score) < 1e-9


def test_edited_items_are_found_and_clean_texts_are_not(spark):
    r, items = random.Random(5), [(i["item_id"], i["text"]) for i in rows("benchmark")]
    filler = [w for t in list(texts().values())[:60] for w in decontamination.words_of(t)]
    docs = []
    for k in range(120):
        words = decontamination.words_of(items[k % len(items)][1])
        rate = (0, 0.1, 0.2)[k % 3]
        edited = [x for w in words for x in (r.choice([[], [r.choice(filler)], [w, r.choice(filler)]]) if r.random() < rate else [w])]
        pad = [[r.choice(filler) for _ in range(r.randint(0, 150))] for _ in range(2)]
        docs.append((k, " ".join(pad[0] + edited + pad[1])))
    clean = [(1000 + k, " ".join(r.choice(filler) for _ in range(200))) for k in range(60)]
    got = decontamination.contaminated(
        spark.createDataFrame(docs + clean, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    found = {(x.doc_id, x.item_id) for x in got}
    assert sum((k, items[k % len(items)][0]) in found for k in range(120)) >= 117
    assert not any(d >= 1000 for d, _ in found)


def test_evenly_edited_items_are_found(spark):
    """Every fourth or fifth word replaced: most n-grams are broken, and intact ones also stand in other texts."""
    items = [(i["item_id"], decontamination.words_of(i["text"])) for i in rows("benchmark")]
    docs, expected = [], set()
    for step in (4, 5):
        for item_id, words in items:
            key = 1000 * step + item_id
            edited = [f"other{i}" if i % step == step - 1 else w for i, w in enumerate(words)]
            docs.append((key, " ".join(["before"] * 30 + edited + ["after"] * 30)))
            score = decontamination.align(*(np.array([hash(w) for w in x]) for x in (words, edited)))[0]
            assert score >= decontamination.LEAST_SCORE
            expected.add((key, item_id))
    every = [(item_id, " ".join(words)) for item_id, words in items]
    df = spark.createDataFrame(docs + every, "doc_id long, text string")
    got = decontamination.contaminated(df, spark.createDataFrame(every, "item_id long, text string")).collect()
    assert expected <= {(r.doc_id, r.item_id) for r in got}


def test_long_excerpts_and_short_items_are_found(spark):
    """An excerpt counts by its words, however long its item; a few words count as a line of their own."""
    r = random.Random(8)
    item = [f"w{r.randrange(4000)}" for _ in range(1000)]
    pad = lambda n: [f"p{r.randrange(4000)}" for _ in range(n)]
    items = [(1, " ".join(item)), (2, "Four words, only here"), (3, "one two"), (4, "")]
    docs = [
        (1, " ".join(pad(50) + item[200:650] + pad(50))), (2, " ".join(item[500:980])), (3, " ".join(pad(9) + item[40:71] + pad(9))),
        (4, " ".join(pad(9) + item[40:60] + pad(9))), (5, "four words only here"), (6, "a line\nFour words - only here.\nanother"),
        (7, "they have four words only here and there"), (8, "One two"), (9, "one two three"), (10, "\n\n"),
    ]
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in got} == {(1, 1), (2, 1), (3, 1), (5, 2), (6, 2), (8, 3)}
    places = {(x.doc_id, x.item_id): (x.first_word, x.last_word) for x in got}
    assert places[1, 1] == (50, 499) and places[3, 1] == (9, 39) and places[6, 2] == (2, 5)


def test_all_scores_equal_a_full_alignment(spark):
    """Pairs that share a trigram: every score is that of the whole table of whole texts."""
    r = random.Random(12)
    items = [(k, [f"w{r.randrange(60)}" for _ in range(r.randint(5, 40))]) for k in range(12)]
    docs = []
    for k in range(60):
        words = [x for w in r.choice(items)[1] for x in (r.choice([[], ["other"], [w, "more"]]) if r.random() < 0.2 else [w])]
        docs.append((k, [f"w{r.randrange(60)}" for _ in range(r.randint(0, 40))] + words + [f"w{r.randrange(60)}" for _ in range(r.randint(0, 40))]))
    grams = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    numbered = lambda w: np.array([hash(x) for x in w])
    expected = {}
    for d, text in docs:
        for i, item in items:
            score = decontamination.align(numbered(item), numbered(text))[0]
            if score >= 0.5 and grams(item) & grams(text):
                expected[d, i] = round(score, 9)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    got = decontamination.contaminated(df, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id): round(x.score, 9) for x in got} == expected
    assert any(s < 1 for s in expected.values())


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    one = {tuple(r) for r in decontamination.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 300)
    several = {tuple(r) for r in decontamination.contaminated(docs, items).collect()}
    assert {r[:3] for r in one} == {r[:3] for r in several}


def test_odd_documents_against_odd_items(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "A, b c D e F"), (1, "A, b c D e F"), (2, "a b"), (None, "x"), (3, None)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.score) for r in decontamination.contaminated(docs, items).collect()] == [(None, 1, 1.0)]
    assert decontamination.contaminated(docs.withColumn("item_id", F.lit(9)), items.withColumn("doc_id", F.lit(9)).withColumn("score", F.lit(2))).count() == 1
    left = decontamination.clean_documents(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert decontamination.contaminated(docs.limit(0), items.limit(0)).count() == 0


def test_fingerprint_query(spark):
    got = {r.doc_id: r for r in queries.op5_fingerprints(spark, SF).collect()}
    docs = sorted(texts().items(), reverse=True)
    same = collections.defaultdict(set)
    for i, (key, text) in enumerate(docs):
        third = len(text) // 3
        edited = text[: len(text) - third] + docs[(i + 1) % len(docs)][1][:third]
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        same[text].add(got[key].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    long = [r for r in got.values() if r.n_chars > 500]
    assert min(r.near_edited for r in long) > 0.2 and sum(r.near_edited > r.near_next + 0.1 for r in long) >= 0.98 * len(long)


def test_fingerprint_query_equals_the_plain_version(spark):
    """Every column, and likeness worked out from the two printed fingerprints alone."""
    got = {r.doc_id: r for r in queries.op5_fingerprints(spark, SF).collect()}
    docs = sorted(texts().items(), reverse=True)
    for i, (key, text) in enumerate(docs):
        following, third = docs[(i + 1) % len(docs)], len(text) // 3
        r, edited = got[key], text[: len(text) - third] + following[1][:third]
        assert (r.fingerprint, r.edited_fingerprint) == (brute.fingerprint(text), brute.fingerprint(edited))
        assert r.near_edited == brute.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == brute.likeness(r.fingerprint, got[following[0]].fingerprint)


def test_texts_of_any_length_are_compared_alike(spark):
    """Texts of 1 to 40 pieces: each has anchors, and shares some with itself after a few more words."""
    from pyspark.sql import functions as F

    words = [f"q{i * 7919 % 1000}" for i in range(45)]
    df = spark.createDataFrame([(n, " ".join(words[:n]), " ".join(words[: n + 3])) for n in range(1, 41)], "n int, a string, b string")
    df = df.select("n", fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    got = df.select("*", fingerprints.likeness(F.col("a"), F.col("b")).alias("like"), fingerprints.printed(F.col("a")).alias("p"), fingerprints.printed(F.col("b")).alias("q")).collect()
    for x in got:
        assert x.a and x.like == brute.likeness(x.p, x.q) and (x.n < 4 or x.like > 0)
    likes = [x.like for x in sorted(got, key=lambda x: x.n)]
    assert all(abs(a - b) < 0.15 for a, b in zip(likes, likes[1:])) and likes[16] > 0.4  # no step at any length


def test_anchors_are_the_closed_syncmers(spark):
    """Against a plain search with the hashes that Spark gives; and away from an edit anchors stay."""
    from pyspark.sql import functions as F

    r = random.Random(9)
    words = [f"p{r.randrange(400)}" for _ in range(120)]
    changed = words[:60] + ["other"] + words[61:]
    df = spark.createDataFrame([(" ".join(words),), (" ".join(changed),)], "text string")
    first, second = (row.a for row in df.select(fingerprints.anchors(F.col("text")).alias("a")).collect())
    pieces = [m for w in words for m in re.findall(r"\S{1,8}", w)]
    hashes = [row.h for row in spark.createDataFrame(enumerate(pieces), "i int, p string").select("i", F.xxhash64("p").alias("h")).orderBy("i").collect()]
    pairs = spark.createDataFrame(list(zip(range(len(hashes)), hashes, hashes[1:])), "i int, a long, b long").select("i", F.xxhash64("a", "b").alias("h")).orderBy("i").collect()
    pair = [row.h for row in pairs]
    k = fingerprints.K
    expected = {i for i in range(len(pieces) - k + 1) if min(pair[i], pair[i + k - 2]) <= min(pair[i + 1 : i + k - 2])}
    assert {a & 0xFFFFFFFF for a in first} <= expected and len(first) >= 0.9 * len(expected)
    apart = {a for a in first if not 60 - k < (a & 0xFFFFFFFF) <= 60}
    assert apart <= set(second)


def test_odd_documents_have_fingerprints(spark):
    docs = odd_documents(spark)
    assert fingerprints.with_edits(docs).count() == docs.count()
    assert fingerprints.with_edits(docs.limit(0)).count() == 0
    one = fingerprints.with_edits(docs.filter("doc_id = 3")).first()
    assert one.edited == "x" * 30_000


def test_next_texts_of_odd_documents(spark):
    """Null ids come last, equal ids by their texts, the first follows the last; other columns do not matter."""
    docs = spark.createDataFrame([(1, "one", 5), (None, "none", 5), (3, None, 5), (2, "b", 5), (2, "a", 5)], "doc_id long, text string, range int")
    docs = docs.withColumn("copy", F.lit("c")).withColumn("next_text", F.lit("n"))
    for parts in (1, 3):
        made = fingerprints.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"], parts)
        got = {(r.doc_id, r.text): r.next_text for r in made.collect()}
        assert got == {(3, ""): "a", (2, "a"): "b", (2, "b"): "one", (1, "one"): "none", (None, "none"): ""}
    edits = [(r.doc_id, r.n_chars, r.edited) for r in fingerprints.with_edits(docs).collect()]
    assert sorted(edits, key=str) == [(1, 3, "onn"), (2, 1, "a"), (2, 1, "b"), (3, 0, ""), (None, 4, "non")]


def test_fingerprints_keep_all_anchors_at_all_lengths(spark):
    from pyspark.sql import functions as F

    r = random.Random(6)
    words = lambda n: [f"q{r.randrange(10**6)}" for _ in range(n)]
    text, long = words(17), words(3000)
    pairs = [(text, text + words(2)), (long, long[:1500] + words(500) + long[1500:]), (words(19), words(17)), (["a", "b"] * 300, ["a", "b"] * 300)]
    pairs += [(text[:n], text[:n]) for n in (0, 1, 5, 6, 8)] + [(long, long[:1500] + words(1) + long[1501:])]
    df = spark.createDataFrame([(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    df = df.select("i", fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    got = {x.i: x for x in df.select("*", fingerprints.likeness(F.col("a"), F.col("b")).alias("like"), fingerprints.printed(F.col("a")).alias("p"), fingerprints.printed(F.col("b")).alias("q")).collect()}
    assert all(x.like == brute.likeness(x.p, x.q) for x in got.values())
    assert 0.5 < got[0].like < 0.9 and got[2].like == 0
    assert 0.8 < got[1].like < 0.92 and len(got[1].a) > 900  # 3,000 of 3,500 pieces, apart by a long insertion
    assert all(got[i].like == 1 for i in range(3, 9)) and len(got[3].a) > 200
    assert 0.98 < got[9].like < 1 and got[9].p != got[9].q
