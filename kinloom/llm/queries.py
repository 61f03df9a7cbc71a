"""The registered queries of the training-data operators.

Each applies its operator, with production parameters, to its whole table and
returns the full result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, imatch, jaccard_join, kneser_ney, language_mixture, lexical_nra, mixing, pfor, secret_scan, simplex_clusters, token_counts, topk, url_filter
from .common import table


#: Fixed rules of the URL query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, names = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *names.values())


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.token_file(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op11_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents"))


def op12_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, length=64)


def op13_lexical_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_topk": op1_topk,
    "op2_imatch": op2_imatch,
    "op3_quality": op3_quality,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_source_mix": op5_source_mix,
    "op6_token_counts": op6_token_counts,
    "op7_token_file": op7_token_file,
    "op8_url_filter": op8_url_filter,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_secret_scan": op10_secret_scan,
    "op11_language_mixture": op11_language_mixture,
    "op12_simplex_clusters": op12_simplex_clusters,
    "op13_lexical_nra": op13_lexical_nra,
}
