"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
between stages documents are written as Parquet and read again.  All but the last
return the columns of documents.  Files keep no order when they are read, so the last
stage returns the schedule of the mix with its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import bpe, langid, mixing, quality, simhash
from helixframe.llm.queries import BLOCK_ROWS, RANKS, WEIGHTS
from helixframe.runtime import materialize, release

#: SQL cannot express the models of the stages; tests/llm/test_pipeline.py checks them by brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages."""
    found = langid.identify(docs, text=F.col("text"), declared=F.col("lang"), host=F.col("source"))
    return found.where("lang_kept").select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer accepts."""
    return quality.classify(docs).where("quality_kept").select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the schedule interleaves their sources."""
    return mixing.mixed_order(docs, WEIGHTS, block_rows=BLOCK_ROWS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, whether they decode to its text, and its place in the mix.

    Rows in order of (mix_slot, mix_row) are the mix that source_mix decided on: the
    schedule depends on the documents' ids and sources only.
    """
    mixed = mixing.mix(docs.select("doc_id", "source", "text"), WEIGHTS, block_rows=BLOCK_ROWS)
    both = bpe.round_trip(mixed, RANKS)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return both.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("decodes"), *mixing.OWN)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
