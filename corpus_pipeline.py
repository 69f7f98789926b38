"""A training-data pipeline over documents: quality, boilerplate lines, near duplicates, benchmark passages, tokens.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last keep the
columns of documents; a stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm import bpe, cotrain, decontaminate, linededup, ordermin
from tallyroll.llm.common import stored, table
from tallyroll.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained classifier doesn't reject."""
    return cotrain.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their hosts' boilerplate lines; n_chars follows the text."""
    cleaned = linededup.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else cleaned


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the least id."""
    return ordermin.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), shortest=1)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document left."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("tokens", tokens)]

#: A trained classifier decides, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each over the table that the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
