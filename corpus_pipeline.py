"""The corpus pipeline: stages in order, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.llm import bitpack, decontam, langid, mixing, simhash_vp
from caresift.llm.tables import read
from caresift.session import materialize

#: SQL cannot express profiles, fingerprints, alignment or a tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the profiles are learned from the ``lang`` of the rows not held out.

    Dropped are texts that are null or have no letter.
    """
    return langid.known(docs, langid.fit(langid.train_rows(docs)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest id.

    Near copies are linked by fingerprints of three-word shingles that differ in at most two bits, directly or over others.
    """
    return simhash_vp.one_of_each(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: a document taken twice is there twice."""
    return mixing.repeated(docs, F.array("source"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the written id files."""
    return bitpack.encode_table(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
