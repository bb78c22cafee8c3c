"""Corpus pipeline: documents in, token ids of the clean and distinct ones out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, quality, simhash
from tidemark.llm.common import staged
from tidemark.llm.queries import RANKS, remainder

#: Documents with a lower probability of good quality go.
QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject; it learns from the labels of the same documents' training part."""
    net = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda i: remainder(i, 5) != 0)
    return docs.filter(quality.score(F.col("text"), net) >= QUALITY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, size=3, distance=2)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids of the whole texts, and a digest of what they decode to."""
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(bpe.decode(F.col("ids"), RANKS), 256).alias("decoded_sha256"))


STAGES = [("quality classifier", good_quality), ("exact dedup", exact), ("simhash near-dedup", near),
          ("benchmark decontamination", clean_of_benchmark), ("byte-level bpe", tokens)]

#: A network that learns from labels and SimHash cannot be said in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
