"""The registered queries, and the pipeline against plain versions of its stages."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from tests.llm.brute import SF, rows, texts
from tidemark.llm import queries, toxicity
from tidemark.llm.common import table

COLUMNS = {
    "op2": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op10": ["doc_id", "held_out", "score", "predicted"],
}
KINDS = {"score": "double", "near_edited": "double", "near_next": "double", "held_out": "boolean", "kept": "boolean", "predicted": "int"}
TEXT = {"base_labels", "labels", "base_sha256", "spans", "edited_sha256", "fingerprint", "edited_fingerprint", "ids_sha256", "decoded_sha256", "payload_digest", "record_type"}


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_sql_of_the_archives(spark):
    from tests.compare import connect, difference

    for name, sql in queries.ORACLE.items():
        assert difference(spark, SF, queries.QUERIES[name], sql, connect(SF)) is None


def test_columns_and_types(spark):
    for name, run in queries.QUERIES.items():
        if (wanted := COLUMNS.get(name.split("_")[0])) and name != "op7_token_files":
            df = run(spark, SF)
            assert df.columns == wanted
            assert dict(df.dtypes) == {c: KINDS.get(c, "string" if c in TEXT else "bigint") for c in wanted}


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels").filter(~queries.held_out()))
    toxic = {r.doc_id for r in toxicity.score(docs, model).filter("toxicity >= 0.5").collect()}
    left = {k: t for k, t in texts().items() if k not in toxic}
    left = brute.without_repeated_lines(list(left.items()))
    left = {k: left[k] for k, _, top in brute.near_components(list(left.items()), 80) if k == top}
    bad = {d for d, _ in brute.whole_items(left, rows("benchmark"))}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = {k: (library.encode(t), t) for k, t in left.items() if k not in bad}
    got = {r.doc_id: (r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_stages_keep_columns_and_take_nothing(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs.limit(0), SF)
        assert left.columns == docs.columns and left.count() == 0


def test_stages_take_odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, clashing names: nothing is lost, and other columns pass."""
    docs = brute.odd_documents(spark).withColumn("source", F.lit("odd"))
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, SF)
        assert left.count() == docs.count(), name
        rows_left = left.collect()
        assert {r.doc_id for r in rows_left} == {1, 2, 3, 4, None}
        if name != "encoding":
            assert left.columns == docs.columns and {r.source for r in rows_left} == {"odd"}
            assert sum(r.text is None for r in rows_left) == 2
        else:
            assert sum(len(r.ids) == 0 for r in rows_left) == 3 and max(len(r.ids) for r in rows_left) > 8_000
            assert stage(spark, docs.limit(0), SF).count() == 0
