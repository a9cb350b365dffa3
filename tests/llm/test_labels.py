"""Licences, personal data and toxicity."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.brute import SF, odd_documents, rows, texts
from tidemark.llm import license_scan, pii, queries, toxicity

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def base_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places = [
        (i, label)
        for phrase, label in license_scan.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [p[0] for p in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p[1] for p in places}))


def test_licence_query(spark):
    found = texts()
    for r in queries.op3_license_scan(spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_licences(found[r.doc_id])
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert ("gpl-3" in r.labels) == ("GNU General Public License, version 3" in found[r.doc_id])


def test_licences_of_odd_and_edited_texts(spark):
    full = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    cases = {
        1: (None, ""), 2: ("MIT  License, mit\nlicense; Apache License Version 2.0", "apache-2,mit"), 3: ("mit mit license license", "mit"),
        4: (full, "mit"), 5: (full.replace("to any person", "to each and every person"), "mit"), 6: ("public license permission software", ""),
        7: ("general words on a public license of version 3", ""), 8: ("x " * 5000 + "Licensed under CC BY-NC 4.0. " + "y " * 5000, "cc-by-nc"),
    }
    df = spark.createDataFrame([(k, t, "z") for k, (t, _) in cases.items()], "doc_id long, text string, labels string")
    for r in license_scan.scan(df).collect():
        text, labels = cases[r.doc_id]
        assert r.labels == labels and (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_licences(text)
        assert (r.score > 0) == bool(labels) and r.score <= 1
    assert license_scan.scan(odd_documents(spark)).count() == odd_documents(spark).count()
    assert license_scan.scan(df.limit(0)).count() == 0


NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
NOTICES = {
    NOTICE.format("General Public License", 2): "gpl-2",
    NOTICE.format("General Public License", 3): "gpl-3",
    NOTICE.format("Lesser General Public License", 3): "lgpl",
    NOTICE.format("Affero General Public License", 3): "agpl-3",
    NOTICE.format("General Public License", 3).replace("free software: ", "free software; ").replace("either version", "\n# either version"): "gpl-3",
    NOTICE.format("General Public License", 3).replace("This program", "This small program here"): "gpl-3",
    NOTICE.format("General Public License", 2).replace("and/or modify it", "and modify it"): "gpl-2",
    "This file is free; you may copy it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation.": "gpl-2",
    "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": "gpl-3",
    "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.": "gpl-2",
    "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": "lgpl",
    "GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.": "agpl-3",
    "// SPDX-License-Identifier: MIT": "mit",
    "# SPDX-License-Identifier: Apache-2.0": "apache-2",
    "/* SPDX-License-Identifier: GPL-2.0-only */": "gpl-2",
    "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.': "apache-2",
    "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/": "apache-2",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.': "mit",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "The general public may license version 3 of the software foundation's terms, or either version.": "",
    "This program is not free software; ask the foundation for the terms of its public license.": "",
}


def test_notices_are_told_apart_by_name_and_version(spark):
    """Each notice in a text of its own and behind other words, and all labels of a text of several."""
    docs = [(i, pad + text + " and so on", label) for i, (text, label) in enumerate(NOTICES.items()) for pad in ("", "some words before it " * 30)]
    docs.append((1000, "\n".join(NOTICES), ",".join(sorted(set(NOTICES.values()) - {""}))))
    df = spark.createDataFrame(docs, "doc_id long, text string, wanted string")
    wanted = {r.doc_id: r.wanted for r in df.collect()}
    got = [(r.doc_id, r.labels) for r in license_scan.scan(df).collect()]
    assert len(got) == len(docs)
    assert [(i, labels, wanted[i]) for i, labels in got if labels != wanted[i]] == []


PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
CHECKS = (lambda t: True, pii.valid_ip, pii.valid_card, pii.valid_phone)


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k in range(4) for m in PATTERNS[k].finditer(text or "") if CHECKS[k](m[0]))


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    for _ in range(20_000):
        text = "".join(r.choice("ab._%@@..-+ 0123456789()é") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("x" * 300_000 + "1" * 300_000) == []


def test_personal_data_query(spark):
    found = texts()
    got = {r.doc_id: r for r in queries.op4_pii(spark, SF).collect()}
    for key, text in found.items():
        spans = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_spans(text)]
        import hashlib

        assert got[key].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got[key].spans.split(","))
        counts = collections.Counter(x.split(":")[0] for x in spans)
        assert [got[key][f"n_{k}"] for k in pii.KINDS] == [counts[k] for k in pii.KINDS]


def test_gradient_of_the_network():
    net = pii.Network.fresh(3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, pii.N_SYMBOLS, (6, 2)), rng.integers(0, pii.TAGS, (6, 2))

    def loss():
        w, total = net.weights, 0.0
        scores = pii.emissions(net, x)
        for b in range(2):
            a = w["first"] + scores[0, b]
            for t in range(1, 6):
                a = np.log(np.exp(a[:, None] + w["moves"]).sum(0)) + scores[t, b]
            true = w["first"][y[0, b]] + scores[range(6), b, y[:, b]].sum() + w["moves"][y[:-1, b], y[1:, b]].sum()
            total += np.log(np.exp(a).sum()) - true
        return total / 2

    gradient = pii._gradient(net, x, y)
    for name, w in net.weights.items():
        at = (int(x[2, 1]), 5) if name in ("fx", "bx") else tuple(rng.integers(0, n) for n in w.shape)
        kept, step = w[at], 1e-3
        w[at] = kept + step
        up = loss()
        w[at] = kept - step
        down = loss()
        w[at] = kept
        assert gradient[name][at] == pytest.approx((up - down) / 2 / step, abs=2e-3)


@pytest.fixture(scope="module")
def network():
    r, windows = random.Random(6), []
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    for _ in range(300):
        digits = "".join(r.choice("0123456789") for _ in range(16))
        item = r.choice([f"{word()}.{r.randint(0, 99)}@mail{r.randint(0, 9)}.example.com", f"{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}", digits, f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}", f"{r.randint(1, 2030)}", f"{word()}{digits[:9]}{word()}"])
        text = " ".join([*(word() for _ in range(r.randint(1, 8))), item, *(word() for _ in range(r.randint(1, 8)))])
        windows += pii.training_windows(text, pii.shaped_spans(text))
    signs, tags = (np.stack([np.frombuffer(w[i], np.uint8) for w in windows]) for i in (0, 1))
    return pii.fit(signs, tags,)


def test_the_network_finds_most_held_out_spans(network):
    r, right, total = random.Random(77), 0, 0
    for _ in range(100):
        text = f"the mail of {r.choice('abc')}xyz.{r.randint(0, 99)}@mail3.example.com was sent to +1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)} by me"
        places = pii.stretches(text)
        found = {(k, places[j][0] + s, places[j][0] + e) for j, k, s, e in pii._decoded(network, [pii.symbols(text[a:b]) for a, b in places])}
        wanted = {(k, s, e) for s, k, e in plain_spans(text)}
        right, total = right + len(found & wanted), total + len(wanted)
    assert right >= 0.85 * total


@pytest.fixture(scope="module")
def trained(spark):
    """The network as the query trains it, on the larger documents."""
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def other_notation(r):
    """A span in a notation that no pattern finds: its kind, the text before it, the span, the text behind it."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    kind, before, span, behind = r.choice([
        ("phone", "", f"({d(3)}) 555-{d(4)}", ""), ("phone", "", f"{d(3)}.{d(3)}.{d(4)}", ""), ("phone", "", f"00{r.randint(31, 69)} {d(2)} {d(3)} {d(2)} {d(2)}", ""),
        ("email", "", f"{word()}.{word()} [at] example.com", ""), ("email", "", f"{word()}_{word()}(at)mail{d(1)}.org", ""),
        ("ip", "", ".".join(str(r.randint(0, 255)) for _ in range(4)).replace(".", "[.]"), ""),
        ("secret", r.choice(["password: ", "api_key=", "client_secret = '"]), "".join(r.choice(pii._LETTERS) for _ in range(r.randint(20, 44))) + "5", ""),
    ])
    words = lambda n: " ".join(word() for _ in range(n))
    return kind, words(r.randint(2, 10)) + " " + before, span, ("'" if before.endswith("'") else "") + " " + words(5) + behind


def test_the_network_finds_what_the_patterns_miss(trained):
    r, hits, wanted, added = random.Random(7), collections.Counter(), collections.Counter(), collections.Counter()
    for _ in range(500):
        kind, before, span, behind = other_notation(r)
        text = before + span + behind
        base = pii.base_spans(text)
        if any(s < len(before) + len(span) and len(before) < e for s, _, e in base):
            continue  # by chance a pattern finds part of it
        found = [(pii.NAMES[k], s, e) for s, k, e, is_base in pii.find_all(trained, [text])[0] if not is_base]
        wanted[kind] += 1
        hits[kind] += (kind, len(before), len(before) + len(span)) in found
        added[kind] += len(found)
    assert set(wanted) == {"phone", "email", "ip", "secret"}
    assert all(hits[k] >= 0.9 * wanted[k] for k in wanted), (hits, wanted)
    assert sum(hits.values()) >= 0.95 * sum(added.values()), (hits, added)


def test_the_network_adds_the_secrets_of_the_documents(trained):
    documents = [t for t in texts(SF.replace("0.001", "0.1")).values() if t]
    places = [{(m.start(1), m.end(1)) for m in pii.ASSIGNED.finditer(t)} for t in documents]
    found = pii.find_all(trained, documents)
    added = [{(s, e) for s, k, e, base in f if not base} for f in found]
    secrets = [{(s, e) for s, k, e, _ in f if k == pii.SECRET} for f in found]
    assert sum(map(len, places)) > 100
    assert sum(len(a & b) for a, b in zip(places, secrets)) >= 0.9 * sum(map(len, places))
    assert sum(len(a - b) for a, b in zip(added, places)) <= 0.05 * sum(map(len, places))


def test_long_texts_of_digits_are_read_in_pieces(trained, monkeypatch):
    """Pieces give the spans of the whole; what is held at a time is bounded."""
    r, gap = random.Random(3), " and then some more words "
    text = "".join(f"{gap if r.random() < 0.5 else ' 7 '}token = \"{''.join(r.choice('0123456789abcdef') for _ in range(40))}\"" for _ in range(150))
    whole = pii.find_all(trained, [text])
    monkeypatch.setattr(pii, "PIECE", 1024)
    monkeypatch.setattr(pii, "OVERLAP", 256)
    monkeypatch.setattr(pii, "DECODED", 2000)
    pieces = pii.find_all(trained, [text])
    assert sum(k == pii.SECRET for _, k, _, _ in whole[0]) >= 100
    assert len(set(whole[0]) ^ set(pieces[0])) <= 4
    sizes = []
    spans_of = pii._spans_of
    monkeypatch.setattr(pii, "_spans_of", lambda net, parts: (sizes.append(sum(map(len, parts))), spans_of(net, parts))[1])
    pii.find_all(trained, ["1 2 3 " * 20_000, "x1" * 3000, None, ""])
    assert max(sizes) <= 2000 * 1.3


def test_overlapping_windows_agree_with_one(network):
    """A stretch of many windows gives the spans that its places give alone."""
    gap = " and then some more words of text go on for a while until "
    text = gap.join(["mail bcd.11@mail3.example.com"] * 6)
    spans = pii.find_all(network, [text])[0]
    assert [s for s, _, _, base in spans if base] == [m.start() for m in re.finditer("bcd", text)]
    assert all(s >= e for (_, _, e, _), (s, _, _, _) in zip(spans, spans[1:]))


def test_odd_documents_have_spans(spark, network):
    docs = odd_documents(spark)
    assert pii.find(docs, network).count() == docs.count() and pii.find(docs.limit(0), network).count() == 0
    assert pii.train(docs.limit(0)) is None
    r = pii.find(spark.createDataFrame([(1, "é a@b.c ")], "doc_id long, text string"), None).first()
    assert [tuple(s) for s in r.found] == [("email", 2, 7, True)]


def test_toxicity_of_held_out_documents(spark):
    sf = SF.replace("0.001", "0.1")
    found = {r.doc_id: r for r in queries.op10_toxicity(spark, sf).collect()}
    held = [r for r in rows("labels", sf) if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(found[r["doc_id"]].held_out for r in held) and all(r.predicted == int(r.score >= 0.5) for r in found.values())
    toxic = [found[r["doc_id"]].score for r in held if r["toxic"]]
    clean = [found[r["doc_id"]].score for r in held if not r["toxic"]]
    assert np.mean(np.array(clean) < 0.5) > 0.98 and np.mean(np.array(toxic) >= 0.5) > 0.8
    assert np.mean(np.array(toxic)[:, None] > np.array(clean)[None, :]) > 0.9


def test_the_label_model_finds_accuracies_and_dependence():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, 2 * truth - 1, 1 - 2 * truth)
    one = vote(0.8)
    votes = np.stack([one, one, one, vote(0.9), vote(0.7), vote(0.85)], axis=1)
    model = toxicity.fit_label_model(votes, np.clip(0.5 + 0.3 * votes.mean(axis=1), 0, 1))
    assert model.weights[:3].max() < 0.5 < model.weights[3:].min()
    assert model.correlations[0, 1] > 0.8 > abs(model.correlations[0, 3])
    assert abs(model.chances[model.groups.index([3]), 1, 2] - 0.9) < 0.06
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.9


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model, "new")
    assert scored.columns == [*docs.columns, "new"] and scored.filter("new between 0 and 1").count() == docs.count()
    none = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs, none, "new").filter("new < 0.5").count() == docs.count()
