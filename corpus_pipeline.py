"""Corpus pipeline: toxic documents go, copies go, sources are mixed, and what stays is packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsieve.llm import exact, mixing, near, packing, toxicity
from flowsieve.llm.queries import table, word_tokenizer
from flowsieve.session import written

#: No SQL: a trained classifier and sampled signatures decide in between. The tests run a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a classifier trained on the labels of ``docs``."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal normalised text."""
    return exact.keep_distinct(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the probabilities of their source, language and topic."""
    return mixing.keep_sampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in the training sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
