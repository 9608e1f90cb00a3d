"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, secrets are
cut out, sources are mixed to their target weights, and the rest is packed into sequences.

Each stage reads what the one before has written. Rows without text pass the filters and are packed as
empty documents, unless the mix does not take them (their size is 0, so it does not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import jaccard, mixing, packing, secrets, toxicity
from tillstar.llm.common import cut, run_folder, table

# Near duplicates in the pipeline: word 5-grams, similarity of 0.8 or more.
NEAR = jaccard.Measure(5, 80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the lexicon, learned from the labelled ones of these documents, scores 0.5 or more."""
    return toxicity.reject(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group that similarity links."""
    return jaccard.keep_one(docs, NEAR)


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document; each secret in its text becomes ``[SECRET]``."""
    return secrets.redact(docs, run_folder(spark, "blob-ledger"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document 0, 1 or 2 times, so that sources meet their target weights."""
    return mixing.repeat(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each_group), ("secrets", cut_secrets), ("mixing", mix_sources), ("packing", pack)]
# A learned lexicon, random balanced draws and tokenizer ids are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = run_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
