from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, token_ids string, shard string, extra int"
WORDS = "the of and to in is was for that with on as by at from éa ñu über straße 日本 data model".split()


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, columns with clashing names."""
    r = random.Random(5)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 60))) for _ in range(40)]
    rows = [(k, t, r.choice(("en", "de", None)), r.choice(("a", "b", None)), len(t), "clash", "clash", k) for k, t in enumerate(texts)]
    rows += [
        (None, None, None, None, None, None, None, None),
        (None, "null id", "en", "a", 7, None, None, None),
        (50, None, "en", None, None, "x", "y", 1),
        (51, "", "en", "a", 0, None, None, 1),
        (52, " \t\n ", "de", "a", 4, None, None, 1),
        (53, "x " * 50_000, "de", "a", 100_000, None, None, 1),
        (54, "a" * 60_000, "en", "b", 60_000, None, None, 1),
        (55, texts[0], "en", "a", len(texts[0]), None, None, 1),
        (55, texts[0], "en", "a", len(texts[0]), None, None, 1),
        (56, "12345 67890 !!! --- 🎉", "en", "b", 20, None, None, 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
