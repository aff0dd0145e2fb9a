from __future__ import annotations

import hashlib
import math
from collections import Counter

from candela.llm import mixing


def inverted(rate, u):
    """The least k with P(X <= k) > u, in exact fractions of a scaled exponential series."""
    k = total = 0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if total > u:
            return k
        k += 1


def brute(rows, alpha, seed=42):
    chars = Counter()
    for _, text, source in rows:
        chars[source] += max(len(text or ""), 1)
    weights = {s: n**alpha for s, n in chars.items()}
    rate = {s: weights[s] / sum(weights.values()) * sum(chars.values()) / chars[s] for s in chars}
    out = Counter()
    for doc_id, text, source in rows:
        null = chr(92) + "N"
        key = f"{seed}/count|{null if doc_id is None else doc_id}|{null if text is None else hashlib.md5(text.encode()).hexdigest()}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        out[doc_id] += inverted(rate[source], u)
    return +out


def test_counts_are_those_of_inverted_poisson(odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    got = Counter(r.doc_id for r in mixing.mix(odd, alpha=0.5).select("doc_id").collect())
    assert got == brute(rows, 0.5)


def test_given_weights_reach_their_shares(spark):
    rows = [(k, "x" * 10, "a" if k % 10 else "b") for k in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    n = Counter(r.source for r in mixing.mix(docs, weights={"a": 1.0, "b": 1.0}).select("source").collect())
    assert abs(n["b"] / sum(n.values()) - 0.5) < 0.02


def test_many_sources_take_the_salted_join(odd, monkeypatch):
    plain = sorted((r.doc_id or -1, r.copy) for r in mixing.mix(odd).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted((r.doc_id or -1, r.copy) for r in mixing.mix(odd).collect()) == plain


def test_empty_table_and_columns(none):
    out = mixing.mix(none)
    assert out.count() == 0
    assert set(none.columns) <= set(out.columns)


def test_any_rate_has_its_own_law(spark):
    for rate in (0.01, 1.0, 50.0, 1_000.0):
        made = mixing.with_thresholds(spark.createDataFrame([("a", rate)], "_source string, rate double"), "lo", "ts").first()
        for u in (1e-12, 0.001, 0.3, 0.5, 0.97, 0.999999):
            assert made.lo + sum(t <= u for t in made.ts) == inverted(rate, u)


def test_sql_agrees_at_higher_rates(spark, tmp_path):
    import duckdb

    from candela.llm import oracles, queries

    rows = [(k, "y" * 40 if k else "y" * 3_000_000, None, "b" if k else "a", 1) for k in range(30)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = "doc_id, n_copies, copy, rate"
    expected = sorted(duck.execute(f"SELECT {columns} FROM ({oracles.MIX})").fetchall())
    got = sorted(map(tuple, queries.op1_mix_sources(spark, str(tmp_path)).select(*columns.split(", ")).collect()))
    assert got == expected and max(r[1] for r in got) > 12


def test_clashing_names_and_shared_ids(spark):
    rows = [(1, f"t{k}", "a", k, k, k) for k in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _at_most int, lowest int, `from` int")
    out = mixing.mix(docs)
    n = Counter(r.text for r in out.collect())
    assert 1_800 < sum(n.values()) < 2_200 and len(set(n.values())) > 2
    assert set(docs.columns) <= set(out.columns)
