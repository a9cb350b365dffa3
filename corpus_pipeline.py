"""From raw documents to token ids: five stages, each a table of documents in and out.

Every stage reads whole texts, takes null, empty and very long ones, and passes other columns on, whatever their names.
Rows with equal ids are rows of their own. No document is dropped for lacking an id or a text. An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, near_dedup, piece_encoding, toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.queries import held_out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go; texts without words score low."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return toxicity.score(docs, model, "__toxicity").filter("__toxicity < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat earlier ones go; documents stay, null texts null. Ties of place go by document, then line."""
    columns = docs.columns
    left = line_dedup.drop_repeated_lines(docs, line_dedup.ANY_LINE).select(*columns)
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in columns else left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id. Texts without words have no copies."""
    return near_dedup.one_of_each(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or enough of one, go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text left and the text they decode to; null and empty texts have none."""
    return piece_encoding.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: SQL states neither the trained classifier of the first stage nor the encoding of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
