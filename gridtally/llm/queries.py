"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm import (
    decontaminate,
    html_extract,
    line_dedup,
    near_dup,
    packing,
    pieces,
    quality_model,
    quality_rules,
    spelling,
    substring_dedup,
    token_counts,
    token_files,
    whitening,
)
from gridtally.llm.cluster import Workspace

MERGE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pieces.encode_decode(table(spark, sf_dir, "documents"), MERGE_VOCABULARY, ["doc_id"])
    return done.select("doc_id", *pieces.digests(F.col("ids"), F.col("decoded")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"), F.col("source"), ["doc_id"])
    kept = F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    return done.select("doc_id", "n_lines", "n_dropped", kept)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), MERGE_VOCABULARY, ["doc_id"])


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_model.quality_scores(docs, labels, ["doc_id"], train=~held_out, threshold=0.7)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark, ["doc_id"])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Workspace(spark, "token-files").root
    token_files.write_token_files(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, folder, end_id=2, added=True)
    read = token_files.read_token_files(spark, folder)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return read.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.without_repeats(table(spark, sf_dir, "documents"), length=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=4)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, end_id=2, added=True)
    # digests first, so that the ids stay out of the join
    pieces_ = packed.pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packed.placed(pieces_).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_quality_model": op5_quality_model,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_files": op9_token_files,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_best_fit_packing": op13_best_fit_packing,
}
