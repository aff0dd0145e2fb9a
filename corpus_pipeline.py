"""From raw documents to token ids: the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; it works on all
that its predecessor kept. All stages but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.llm import bpe, langid, mixing, secrets, simhash
from candela.llm.common import DOCUMENT_COLUMNS, table, written
from candela.llm.queries import MIX_ALPHA, tokenizer


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language classifier does not reject."""
    return langid.keep_known(docs, langid.fit(docs, langid.training_rows()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, a similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their text replaced."""
    return secrets.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources reach their weights, in random order."""
    return mixing.mix(docs, alpha=MIX_ALPHA).select(*DOCUMENT_COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, which decode to the same text."""
    return bpe.encode(docs, *tokenizer())


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_duplicates),
    ("secret_scan", without_secrets),
    ("source_mix", mixed_sources),
    ("byte_bpe", token_ids),
]

#: The stages use trained models, graph search and tokenizers; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as Parquet and read again.

    The written tables go when the session ends.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
