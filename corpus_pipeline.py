"""Corpus pipeline: quality rules, near duplicates, personal data, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a frame that is written as Parquet and reread as the next
stage's ``docs``. All stages but the last return the columns of
``documents``. ``run`` applies them to the whole ``documents`` table.

Null or empty texts fail the quality rules and go no further; an empty table
goes through all stages as an empty table. Columns beyond those of
``documents`` are carried along up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfold.llm import byte_bpe, mixing, ngram_join, pii, quality
from chainfold.llm.queries import FILTERED_TARGETS, RANK_FILE, domain_labels
from chainfold.storage import write_intermediate

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from every language reference go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, Jaccard 0.8."""
    return ngram_join.drop_near_duplicates(docs, shingle=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, telling terms are generalised or removed; ``n_chars`` follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their rate says, so that domains reach their target weights."""
    mix = mixing.fit_rates(docs, domain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")), FILTERED_TARGETS)
    return mixing.take_copies(docs, mix)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (array<int>) and round_trip: whether the ids decode to the text."""
    encoded = byte_bpe.encode(docs.withColumn("hash", F.xxhash64(F.col("text").cast("binary"))), RANK_FILE, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANK_FILE)
    return decoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.xxhash64("decoded") == F.col("hash")).alias("round_trip")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram join", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix_sources),
    ("byte-level BPE", tokens),
]

# The references, rates and token ids are beyond SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_intermediate(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
