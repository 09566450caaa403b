"""Five stages that make packed training sequences of ``documents``; each is written as Parquet and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatframe.llm import exact_dedup, ngram_jaccard, packing, quality, secrets
from threatframe.llm.common import id_and_text, remainder, table
from threatframe.session import shared_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from labelled documents, never from those held out of training."""
    learnt = remainder(F.col("doc_id"), 5) != 0
    model = quality.fit(id_and_text(docs.where(learnt)), table(spark, sf_dir, "labels").where(learnt))
    return quality.keep_good(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_documents(docs, exact_dedup.DigestIndex(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_jaccard.keep_documents(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by a mark, and ``n_chars`` counted again where the table has it."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens."""
    pieces = packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality classifier", good_quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("secret scan", without_secrets), ("best-fit packing", packed)]
# a trained network and a tokenizer are no SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
