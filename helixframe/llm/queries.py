"""The registered queries of the subpackage: thin layers over its operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import ann, bpe, chat, itq, langid, mixing, oracles, quality, sharding, simhash, tokencount
from helixframe.runtime import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

#: Production parameters.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKEN_LIMIT = 512
#: Weight units of the mix: named sources, and one unit for every other source.
WEIGHTS = {"src0": 6, "src1": 5, "src2": 4, "src3": 3, "src4": 2}
BLOCK_ROWS = 32
#: Tokens of a chat window, and of the history that it repeats.
BUDGET, HISTORY = 512, 64
ARRIVALS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs).select("doc_id", F.round("quality_score", 6).alias("quality_score"), F.col("quality_kept").alias("kept"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs).select("doc_id", "fingerprint", "component_id")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, WEIGHTS, block_rows=BLOCK_ROWS)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    windows = chat.format_windows(table.unionByName(planted), BUDGET, HISTORY)
    back = windows.select("conv_id", "window", chat.new_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").alias("chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select("conv_id", F.struct("window", said.alias("said"), "loss").alias("x"), F.size("turns").alias("n"), "chars")
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"), F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"))
    loss = F.array_join("x.loss", "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("x.said", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    store = sharding.ShardStore(spark, f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}", docs.schema)
    store.append(docs, F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)))
    store.compact()
    store.vacuum(older_than=0)  # nobody else writes to this store
    return store.read().select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.md5("text").alias("text_md5"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = langid.identify(docs, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "lang_id", F.round("lang_posterior", 6).alias("posterior"), F.col("lang_kept").alias("kept"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over web pages: markup, address suffix and host are all there."""
    pages = _table(spark, sf_dir, "pages")
    html = F.col("html")
    found = langid.identify(pages, text=langid.page_text(html), declared=langid.declared_in(html), host=langid.host_of(F.col("url")))
    return found.select("page_id", "lang_id", F.round("lang_posterior", 6).alias("posterior"), F.col("lang_kept").alias("kept"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    counted = tokencount.count_tokens(docs, TOKENIZER)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, RANKS)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Query]:
    every = (
        op1_quality_classifier,
        op2_simhash_dedup,
        op3_embedding_dedup,
        op4_source_mix,
        op5_chat_format,
        op6_sharding,
        op7_language_id,
        op8_nearest_neighbours,
        op9_token_counts,
        op10_byte_bpe,
        page_languages,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    cases = " ".join(f"WHEN sk = 's{k}' THEN {w}" for k, w in WEIGHTS.items())
    return {
        "op4_source_mix": oracles.SOURCE_MIX.format(cases=cases, named=", ".join(f"'s{k}'" for k in WEIGHTS), rows=BLOCK_ROWS),
        "op5_chat_format": oracles.CHAT_FORMAT.format(budget=BUDGET, history=HISTORY),
        "op6_sharding": oracles.SHARDING,
    }
