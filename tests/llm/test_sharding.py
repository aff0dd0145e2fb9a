from __future__ import annotations

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from candela.llm import sharding


def test_hypergeometric_law():
    rng = random.Random(1)
    n = Counter(sharding.hypergeometric(rng, 5, 7, 4) for _ in range(20_000))
    expected = {0: 35, 1: 175, 2: 210, 3: 70, 4: 5}  # of 495
    assert set(n) <= set(expected)
    assert sum((n[k] - 20_000 * v / 495) ** 2 / (20_000 * v / 495) for k, v in expected.items()) < 20


def test_matrix_sums():
    counts, sizes = [100, 0, 37, 1], [35, 35, 34, 34]
    dealt = sharding.matrix(counts, sizes, 7)
    assert [sum(row) for row in dealt] == counts
    assert [sum(column) for column in zip(*dealt, strict=True)] == sizes


def test_shards(docs, odd, none):
    for table in (docs, odd):
        rows = sharding.shard_documents(table).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in table.collect())
        by = {}
        for r in rows:
            by.setdefault(r.shard, []).append(r.slot)
        sizes = [len(by.get(s, [])) for s in range(16)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
        texts = {r.doc_id: r.text for r in table.collect()}
        for r in rows:
            if r.doc_id is not None:
                raw = (texts[r.doc_id] or "").encode()
                assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert sharding.shard_documents(none).count() == 0


def test_same_shards_in_any_partitioning(docs):
    deal = lambda df: {(r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(df).collect()}
    assert deal(docs) == deal(docs.repartition(7, "lang"))


def test_equal_ids_and_repeated_rows_in_any_partitioning(spark):
    rows = [(k % 3 if k % 5 else None, f"text {k % 700}") for k in range(3_000)] + [(None, "one text")] * 1_000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    deal = lambda df: Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in sharding.shard_documents(df).collect())
    first = deal(docs.repartition(1))
    assert first == deal(docs.repartition(7)) == deal(docs.repartition(4, "doc_id"))
    assert len(first) == 4_000


def test_matrix_law_against_all_deals():
    # blocks of 2 and 2 rows into shards of 2 and 2: of the 6 deals, 4 split the first block
    n = Counter(sharding.matrix([2, 2], [2, 2], seed)[0][0] for seed in range(6_000))
    assert sum((n[k] - e) ** 2 / e for k, e in {0: 1_000, 1: 4_000, 2: 1_000}.items()) < 14


def test_shards_and_slots_are_uniform(spark):
    docs = spark.range(16_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_documents(docs).collect()
    for cell in (lambda r: (r.doc_id // 2_000, r.shard // 2), lambda r: (r.doc_id // 2_000, r.slot // 125), lambda r: (r.shard // 2, r.doc_id % 8)):
        n = Counter(map(cell, rows))
        e = 16_000 / 64
        assert len(n) == 64 and sum((x - e) ** 2 / e for x in n.values()) < 105  # chi-square, 49 degrees: 1 in 100,000


def test_plan_has_no_python(docs):
    plan = sharding.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
