"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokenisation.

Each stage takes what its predecessor kept, as a written table, and decides about all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import decontaminate, line_dedup, near_dup, pieces, quality_rules
from gridtally.llm.cluster import Workspace
from gridtally.llm.queries import MERGE_VOCABULARY, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    return quality_rules.good_documents(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are boilerplate in their source."""
    return line_dedup.documents_without_boilerplate(docs, F.col("source"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8."""
    return near_dup.keep_one(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document with the end id, and digests of the ids and of the text they decode to."""
    done = pieces.encode_decode(docs, MERGE_VOCABULARY, ["doc_id", "lang", "source"])
    digests = pieces.digests(F.col("ids"), F.col("decoded"))
    return done.select("doc_id", "lang", "source", *digests, "ids")


STAGES = [
    ("quality rules", good_quality),
    ("line dedup", without_boilerplate),
    ("near-dedup", one_of_each),
    ("decontamination", not_in_benchmark),
    ("sentencepiece", tokens),
]

#: SQL cannot express the stages after line dedup; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = space.keep(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            space.drop(f"stage-{k - 1}")
    return docs
