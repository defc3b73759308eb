"""Corpus pipeline: quality rules, line dedup, near duplicates, mixing, BPE.

Every stage takes all its predecessor kept; all but the last return the columns
of ``documents``. Between stages the documents are written to the shared folder,
so no stage computes an earlier one again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlake.llm import bpe, line_chunks, mixing, ngram_join, quality_rules
from termlake.llm.queries import byte_bpe
from termlake.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIX_SHARE = 0.9  # expected part of the tokens that the mix keeps
MIX_POWER = 0.8  # targets: shares of sources, languages and topics to this power
MIX_SEED = 11


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return quality_rules.keep_good(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts; all documents stay."""
    done = line_chunks.dedup_lines(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return ngram_join.keep_one(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics meet smoothed targets."""
    return mixing.keep_sampled(docs.select(*COLUMNS), MIX_SHARE, MIX_POWER, seed=MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text decoded from them."""
    return bpe.round_trip(docs, byte_bpe())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]

# Estimates of the first stage and the hashes of the third have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
