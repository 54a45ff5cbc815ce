"""The queries of this subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, licenses, mixing, near, packing, quality, ranked, search, suffix, symbols, tokens, toxicity, urls
from .sql import STATEMENTS

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def document_path() -> Column:
    """The documents as a tree of files: source, language, shelves of 64; the first of a shelf is its license file, the
    first of 64 shelves that of the language's folder."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")))
    shelf = F.concat_ws("/", top, F.concat(F.lit("shelf-"), F.floor(F.col("doc_id") / 64).cast("string")))
    return (
        F.when(F.col("doc_id") % 4096 == 0, F.concat(top, F.lit("/LICENSE."), F.col("doc_id").cast("string")))
        .when(F.col("doc_id") % 64 == 0, F.concat(shelf, F.lit("/LICENSE")))
        .otherwise(F.concat(shelf, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    files = _table(spark, folder, "documents").select("doc_id", document_path().alias("path"), "text")
    return licenses.scanned(files)


def op3_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return search.searched(docs, docs.where("doc_id % 50 = 0"), k=10)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.without_repeats(_table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filtered(_table(spark, folder, "pages"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(_table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(_table(spark, folder, "documents"), k=4, num=85, den=100)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judged(_table(spark, folder, "documents")).select(*names)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    rows = symbols.encoded(_table(spark, folder, "documents"))
    digest = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees"
    )


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def queries() -> dict[str, Query]:
    own = [
        op1_mix_sources, op2_license_scan, op3_top_k_search, op4_suffix_dedup, op5_url_filter,
        op6_token_counts, op7_best_fit_packing, op8_ngram_jaccard, op9_quality_rules, op10_toxicity,
        op11_ranked_search, op12_sentencepiece, op13_importance_resampling,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
