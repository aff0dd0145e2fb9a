"""The corpus operators as registered queries, over the whole synthetic tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, context_mixing, html_text, langid, mixing, mpeg, parsing, secrets, sharding, simhash
from candela.llm.common import spread_table, table

Query = Callable[[SparkSession, str], DataFrame]

#: Share of a source in the mix: its length to this power.
MIX_ALPHA = 0.7


def tokenizer() -> tuple[str, str]:
    """Rank file and split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), alpha=MIX_ALPHA)
    return mixed.withColumn("rate", F.round("rate", 9))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(spread_table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(spread_table(spark, sf_dir, "documents"))


def op5_mpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.store_documents(spread_table(spark, sf_dir, "documents"))


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(spread_table(spark, sf_dir, "documents"), *tokenizer())


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs, langid.training_rows()))


def op9_phrase_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_documents(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_main_text": op2_main_text,
        "op3_simhash": op3_simhash,
        "op4_secret_scan": op4_secret_scan,
        "op5_mpeg_media": op5_mpeg_media,
        "op6_shard": op6_shard,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_language": op8_language,
        "op9_phrase_prints": op9_phrase_prints,
        "op10_context_mixing": op10_context_mixing,
        "pipeline": pipeline,
    }
