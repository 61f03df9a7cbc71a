"""Corpus pipeline: the stages that turn ``documents`` into a mixed, encoded training set.

Each stage is written as Parquet and read again as the next one's input.

Defined results, for every stage: rows without an id, a language, a source or a
count are rows like others; a null or empty text passes the quality classifier,
the near duplicates (it is like no other row) and the secret scan, and is not
taken by the mix, as it has no words; repeated rows are near duplicates of each
other, so one stays; very long texts are treated whole; an empty table gives an
empty table; columns beyond those of ``documents`` are kept up to the last stage,
whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import bpe, jaccard_join, kneser_ney, mixing, secret_scan
from kinloom.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    judged, names = kneser_ney.classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter(F.col(names["keep"])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; ``n_chars`` follows."""
    return secret_scan.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document that is left."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mix),
    ("BPE encoding and decoding", encode),
]

#: The trained model and the tokenizer cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``.

    A stage's own tables are removed when its result is stored; those results are
    removed when the application ends."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(docs, f"stage{i + 1}", lambda d, stage=stage: stage(spark, d, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
