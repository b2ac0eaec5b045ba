"""A training corpus from ``documents``: each stage works on what its predecessor kept, written as Parquet in between."""

from __future__ import annotations

import tempfile
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import byte_bpe, language_id, line_dedup, minhash_dedup, mixing

VOCABULARY = "byte_bpe_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, which are those with spans, also if no lang is given at all. A missing lang is filled in."""
    found = language_id.identified(docs, docs).where(F.size("lang_spans") > 0)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has brought; those that lose all their lines go."""
    found = line_dedup.deduplicated(docs).where((F.col("n_dropped") == 0) | (F.btrim("text") != ""))
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash_dedup.keep_one(docs).select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the quality domains ask for."""
    domains = mixing.quality_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.mixed(docs, domains, mixing.QUALITY_TARGETS, mixing.BUDGET)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids of every document, and whether the ids decode to its text."""
    shared = byte_bpe.shared_ranks(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return byte_bpe.tokenised(docs, shared).select("doc_id", "lang", "source", "n_tokens", "ids", "exact")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("minhash_dedup", drop_near_duplicates),
    ("mixing", mix_domains),
    ("byte_bpe", tokenise),
]

#: Learned models and token ids are beyond SQL; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokenised corpus of one directory of tables. The stages' tables stay in the shared folder, which its owner clears."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="corpus-")
    folder = f"{shared.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
