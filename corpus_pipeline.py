"""From raw documents to encoded training text: each stage works on all that the one before it kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame, all but the last
in the columns of ``docs``. ``run`` writes each stage as Parquet in the shared folder and reads it again. No stage reads
a column by place, so further columns of documents pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltline.llm import language, mixing, pieces, simhash, suffix_array
from siltline.llm.common import Scratch, prepare, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, letterless, far from every learned profile) go."""
    prepare(spark)
    return language.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of 50 words and more are cut out; documents left without a word go."""
    prepare(spark)
    return suffix_array.drop_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken to their target weights: whole passes, and the words of a partial one."""
    prepare(spark)
    return mixing.take(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mixture, and the text that they decode to."""
    prepare(spark)
    return pieces.encode(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_passages),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

#: SQL cannot express the stages; tests compare them with brute force on a fixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        after = scratch.save(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
