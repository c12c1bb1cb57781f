"""A training corpus from raw documents: toxicity, exact and near deduplication, decontamination, packing.

Each stage takes the documents its predecessor kept, as Parquet, and returns a table with the same columns; the last
returns the packed pieces. ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arearisk.llm import chunkdedup, fmindex, packing, segjoin, toxicity
from arearisk.llm import common as C


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of a model learned from the labels."""
    return toxicity.keep_clean(docs, toxicity.train(docs, C.table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts (white space aside)."""
    return chunkdedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every group linked by shingle similarity."""
    return segjoin.keep_first(docs)


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out of the texts; a text of nothing else goes."""
    return fmindex.remove_spans(docs, C.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies),
          ("benchmark_decontamination", cut_benchmarks), ("best_fit_packing", pack)]

#: tokens and trained scores are beyond SQL; tests/llm holds the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
