"""Piece encoding and token files against the libraries, WARC archives against plain digests."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.brute import SF, odd_documents, rows, texts
from tidemark.llm import piece_encoding, queries, token_files, warc

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def own():
    with open(PIECES, "rb") as file:
        return piece_encoding.PieceModel(file.read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pieces_equal_the_library(own, library):
    r = random.Random(1)
    signs = [*"aábcdeéèt  \n▁.,!éüß漢😀01\x00", "the", "ing", "tion", "  "]
    odd = ["", " ", "  a  b\n\tc ", "<s> </s> <0x41>", " " * 37 + "é" + " " * 100, "▁▁ ▁a", "﻿abc ﬁ Å", "漢字テスト한국어  ไทย"]
    for text in odd + ["".join(r.choice(signs) for _ in range(r.randint(0, 40))) for _ in range(3000)]:
        ids, decoded = own.encode_and_decode(text)
        expected = library.encode(text)
        assert np.frombuffer(ids, "<i4").tolist() == expected, text
        assert decoded == own.decode(expected) == library.decode(expected), text


def test_pairs_stay_apart_as_merging_them_shows(own):
    r = random.Random(2)
    inner = [i for i in own.ids.values() if "▁" not in own.pieces[i]]
    common = sorted(inner, key=lambda i: -own.scores[i])[:300]
    pairs = [(r.choice(inner), r.choice(inner)) for _ in range(2000)] + [(r.choice(common), r.choice(common)) for _ in range(2000)]
    pairs += [(own.ids[a], own.ids[b]) for a in ("a", "aa", "s", "ss") for b in ("a", "aa", "s", "ss")]
    alike = [own._compatible(a, b) == (own.merged(own.pieces[a] + own.pieces[b]) == [own.pieces[a], own.pieces[b]]) for a, b in pairs]
    assert all(alike)


def test_a_model_whose_parts_score_below_the_whole():
    """Pieces that are put together before their parts would be: pairs of these are told by merging."""
    field = lambda n, data: bytes([n << 3 | 2, len(data)]) + data
    scored = [("a", -9.0), ("b", -9.0), ("c", -9.0), ("ab", -5.0), ("abc", -1.0), ("bc", -2.0), ("▁", -9.0), ("ca", -3.0), ("cab", -1.5)]
    pieces = [field(1, p.encode()) + b"\x15" + np.float32(s).tobytes() for p, s in scored]
    pieces += [field(1, f"<0x{i:02X}>".encode()) + b"\x18\x06" for i in range(256)]
    model = piece_encoding.PieceModel(b"".join(field(1, p) for p in pieces) + field(3, b"\x20\x00"))
    r = random.Random(3)
    assert model._reachable(model.ids["cab"]) and model.ids["cab"] in model.unordered
    for a, b in [(r.choice(scored[:6] + scored[7:])[0], r.choice(scored[:6] + scored[7:])[0]) for _ in range(300)]:
        assert model._compatible(model.ids[a], model.ids[b]) == (model.merged(a + b) == [a, b])


def test_broken_bytes_decode_as_in_the_library(own, library):
    for ids in ([3 + 0xE6, 3 + 0xBC], [3 + 0xFF, 264], [264, 3 + 0xC3, 3 + 0xA9]):
        assert own.decode(ids) == library.decode(ids)


def test_a_full_store_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(piece_encoding, "STORED_WORDS", 3)
    monkeypatch.setattr(piece_encoding, "STORED_PAIRS", 2)
    text = "one two three four five six seven one two"
    before = own.encode_and_decode(text)
    assert all(own.encode_and_decode(text) == before for _ in range(3))


def test_words_seen_once_take_no_room(library):
    """The store of a worker holds words that come again; each takes its text and its ids only."""
    with open(PIECES, "rb") as file:
        made = piece_encoding.PieceModel(file.read())
    text = " ".join(f"w{i}" for i in range(3000)) + " again" * 5 + " a\u2581b"
    assert made.encode_and_decode(text)[1] == library.decode(library.encode(text))
    assert len(made.words) < 100 and isinstance(made.words[" again"], bytes)
    assert np.frombuffer(made.encode_and_decode(text)[0], "<i4").tolist() == library.encode(text)
    assert len(made.words) > 3000


def test_piece_query(spark, library):
    got = {r.doc_id: tuple(r) for r in queries.op6_piece_encoding(spark, SF).collect()}
    for key, text in texts().items():
        ids = library.encode(text)
        assert got[key] == (key, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_odd_documents_encode(spark, library):
    got = piece_encoding.encode_documents(odd_documents(spark), PIECES).collect()
    expected = [(r.doc_id, library.encode(r.text or "")) for r in odd_documents(spark).collect()]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(k), v) for k, v in expected)


def test_token_query(spark):
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    got = {r.doc_id: tuple(r) for r in queries.op7_token_files(spark, SF).collect()}
    for key, text in sorted(texts().items()):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[key] == (key, start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_words_apart_equal_whole_texts():
    made = token_files.WordEncoder(WORDS)
    odd = ["<|endoftext|> a.", "<|ENDOFTEXT|> b", "it's. é. foo.) a..", "Don't, stop. . ,x .y", "İstanbul ΑΣ ΑΣ. é́ 123", "a\x85b\xa0c d\x1ce", "x" * 500]
    r, signs = random.Random(2), ["a", "Bc", "é", "É", "×", "÷", "…", ".", ",", "!!", "'s", "'", "<", "|", "#", " ", "\n", "1", "́", "ß", "漢"]
    odd += ["".join(r.choice(signs) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(odd, made.encode(odd, None)):
        assert ids.tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 31])
def test_images_round_trip_and_read_at_random(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 9999).astype("<u4")
    image = token_files.Image(token_files.build_image([ids[:5], ids[5:5], ids[5:]], bits))
    assert (image.document(2) == ids[5:]).all() and len(image.document(1)) == 0
    assert (image.read(4090, 20) == ids[4090:4110]).all()
    assert len(image.data) - image.body == sum(-(-n * bits // 8) for n in (4096, 4096, 9999 - 8192))
    with pytest.raises(IndexError):
        image.read(9990, 10)


def test_odd_documents_as_token_files(spark, home):
    docs = odd_documents(spark)
    token_files.write_ids(docs, WORDS, f"{home}/ids", end=2)
    got = sorted(token_files.read_ids(spark, f"{home}/ids").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 2, 3, 4]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    token_files.write_ids(docs.limit(0), WORDS, f"{home}/none", end=2)
    assert token_files.read_ids(spark, f"{home}/none").count() == 0


def expected_records(pages):
    largest = {}
    for key, html in pages:
        largest[html or ""] = max(largest.get(html or "", key), key)
    out = []
    for key, html in pages:
        data, top = (html or "").encode(), largest[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "response" if top == key else "revisit", None if top == key else top))
    return sorted(out)


def test_warc_query(spark):
    assert sorted(tuple(r) for r in queries.op9_warc(spark, SF).collect()) == expected_records([(r["page_id"], r["html"]) for r in rows("pages")])


def test_archives_hold_revisits_and_are_plain_gzip(spark, home):
    pages = [(1, None), (2, ""), (3, "hé\r\n\r\nx"), (9, "hé\r\n\r\nx"), (4, "hé\r\n\r\nx"), (5, "y" * 200_000)]
    df = spark.createDataFrame([(k, "http://a b\n", h, "z") for k, h in pages], "page_id long, url string, html string, payload string")
    warc.write_archives(df, f"{home}/warc")
    got = warc.read_archives(spark, f"{home}/warc", payloads=True).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected_records(pages)
    assert {r.page_id: bytes(r.payload) for r in got}[9] == "hé\r\n\r\nx".encode() and {r.url for r in got} == {"http://a%20b%0A"}
    data = b"".join(r.content for r in spark.read.format("binaryFile").load(f"{home}/warc").collect())
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 6


def test_repeated_pages_and_none(spark, home):
    df = spark.createDataFrame([(7, None, "a"), (7, None, "a"), (None, None, "a")], "page_id long, url string, html string")
    warc.write_archives(df, f"{home}/a")
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(spark, f"{home}/a").collect())
    assert got == [("7", "response", None), ("7", "response", None), ("None", "revisit", 7)]
    warc.write_archives(df.limit(0), f"{home}/b")
    assert warc.read_archives(spark, f"{home}/b").count() == 0


def test_pages_with_columns_named_as_those_of_records(spark, home):
    pages = [(1, "same"), (2, "same"), (3, None)]
    plain = spark.createDataFrame([(k, "http://x", h) for k, h in pages], "page_id long, url string, html string")
    clashing = plain.selectExpr("'d' as digest", "9L as refers_to", "*", "'w' as record_type", "1 as payload_bytes", "'q' as payload_digest", "0 as archive", "5 as n")
    found = []
    for name, df in (("plain", plain), ("clashing", clashing)):
        warc.write_archives(df, f"{home}/{name}")
        found.append(sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, f"{home}/{name}").collect()))
    assert found[0] == found[1] == expected_records(pages)


def test_damage_is_noticed():
    good = warc.member(warc.record(1, "u", b"abc", None))
    assert [warc.parse(m)["payload"] for m in warc.members(good + warc.EMPTY_MEMBER + good)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.members(good[:-5]))
    with pytest.raises(ValueError):
        warc.parse(warc.record(1, "u", b"abc", None).replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))
