from __future__ import annotations

import random
from collections import Counter

import numpy as np
import xxhash

from candela.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=2):
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min([x for x in (least.get(find(k)), i) if x is not None], default=None)
    return [least[find(k)] for k in range(len(ids))]


def near_texts(n=60):
    """Long texts in groups that differ in a word or two, so that fingerprints link in chains."""
    r = random.Random(3)
    out = []
    for _ in range(n // 12):
        base = [f"w{r.randint(0, 5000)}" for _ in range(400)]
        for _ in range(12):
            if r.random() < 0.8:
                base = base[:]
                base[r.randrange(400)] = f"z{r.random()}"
            out.append(" ".join(base))
    return out


def check(docs, most=simhash.MOST):
    rows = docs.collect()
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.labelled(docs, most=most).collect())
    prints = [brute_print(r.text) for r in rows]
    expected = Counter(zip([r.doc_id for r in rows], prints, brute_components([r.doc_id for r in rows], prints), strict=True))
    assert got == expected


def test_against_brute_force(spark, odd):
    check(odd)
    texts = near_texts()
    check(spark.createDataFrame([(k * 7 % 61, t) for k, t in enumerate(texts)], "doc_id bigint, text string"))


def test_crowded_buckets_are_cut_exactly(spark):
    texts = near_texts(36)
    check(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string"), most=2)


def test_fingerprint_format(odd):
    rows = {r.doc_id: r for r in simhash.components(odd).collect()}
    assert rows[51].fingerprint == "0" * 16
    assert all(len(r.fingerprint) == 16 for r in rows.values())


def test_close_pairs_for_many_radii():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, (3, 2), dtype="uint64")[rng.integers(0, 3, 150)]
    for k in range(len(fps)):
        for b in rng.choice(128, rng.integers(0, 20), replace=False):
            fps[k, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    distance = np.bitwise_count(fps[:, None] ^ fps[None]).sum(axis=2)
    for radius in (1, 2, 3, 7, 8, 20):
        i, j = simhash.close_pairs(fps, np.zeros(len(fps), int), radius)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*np.nonzero(np.triu(distance <= radius, 1)), strict=True))


def test_leaders_keep_components(monkeypatch):
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**63, (4, 4), dtype="uint64")[rng.integers(0, 4, 300)]
    for k in range(len(fps)):
        for b in rng.choice(256, rng.integers(0, 40), replace=False):
            fps[k, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    bucket = np.zeros(len(fps), int)
    plain = simhash.forest(np.arange(300), *simhash.close_pairs(fps, bucket, 44))
    monkeypatch.setattr(simhash, "CROWDED", 20)
    thin = simhash.forest(np.arange(300), *simhash.spanning(fps, bucket, 44))
    assert [x.tolist() for x in plain] == [x.tolist() for x in thin]


def test_components_of_a_chain(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in simhash.label_components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}


def test_keep_one(spark, odd, none):
    r = random.Random(4)
    base = [f"w{r.randint(0, 10**6)}" for _ in range(300)]
    near = base[:150] + ["other"] + base[151:]
    far = [f"w{r.randint(0, 10**6)}" for _ in range(300)]
    rows = [(9, " ".join(base)), (4, " ".join(near)), (5, " ".join(base).upper()), (6, " ".join(far)), (6, " ".join(far)), (7, "short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [4, 6, 7]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 55 not in ids
    assert simhash.keep_one(none).count() == simhash.components(none).count() == 0


def planted_pairs(n):
    """Texts 2k and 2k + 1 of n pairs, whose five-word shingles have a similarity of 317/397, just under 0.8."""
    r = np.random.default_rng(6)
    texts = []
    for k in range(n):
        base = [f"w{x}" for x in r.integers(0, 10**9, 361)]
        other = list(base)
        for place in range(20, 340, 40):
            other[place] = f"z{k}"
        texts += [" ".join(base), " ".join(other)]
    return texts


def wide(spark, texts):
    prints = [[k, *simhash.fingerprint(t, 5, 4).view("int64").tolist()] for k, t in enumerate(texts)]
    return spark.createDataFrame(prints, "node bigint, " + ", ".join(f"{c} bigint" for c in simhash.NUMBERS))


def test_wide_links_find_pairs_at_the_required_similarity(spark):
    prints = wide(spark, planted_pairs(1_000))
    roots = {x.node: x.root for x in simhash.label_components(simhash.wide_links(prints)).collect()}
    assert all(roots[k] // 2 == k // 2 for k in roots)
    assert sum(2 * k + 1 in roots for k in range(1_000)) >= 0.93 * 1_000


def test_split_buckets_lose_few_links(spark):
    prints = wide(spark, planted_pairs(200))
    plain = {x.node: x.root for x in simhash.label_components(simhash.wide_links(prints)).collect()}
    split = {x.node: x.root for x in simhash.label_components(simhash.wide_links(prints, most=2)).collect()}
    assert set(split.items()) <= set(plain.items()) and len(split) >= 0.97 * len(plain)
    near = wide(spark, near_texts(36))
    plain = simhash.label_components(simhash.wide_links(near)).collect()
    assert sorted(plain) == sorted(simhash.label_components(simhash.wide_links(near, most=3)).collect())


def test_similar_sets():
    r = np.random.default_rng(9)
    sets = [np.unique(r.choice(40, r.integers(1, 40))).astype("uint64") for _ in range(60)]
    i, j = simhash.similar_sets(sets[:25], sets[20:])
    similar = lambda x, y: 5 * len(set(x) & set(y)) >= 4 * len(set(x) | set(y))
    assert sorted(zip(i, j, strict=True)) == [(a, b) for a in range(25) for b in range(40) if similar(sets[a], sets[20 + b])]


def words(r, n):
    return [f"w{x}" for x in r.integers(0, 10**9, n)]


def test_near_fingerprints_are_confirmed_on_sets(spark, monkeypatch):
    r = np.random.default_rng(7)
    line = words(r, 12)
    rows = [" ".join(line * 40 + words(r, 100)) for _ in range(10)]  # a repeated line, different bodies
    base = words(r, 400)
    for k in range(20):  # of similarity 0.7 to the base, less to one another
        near = list(base)
        for place in range(k, 396, 28):
            near[place] = f"z{k}"
        rows.append(" ".join(near))
    rows += [" ".join(base[:200] + [f"y{k}"] + base[201:]) for k in range(5)]  # of similarity 0.97: one remains
    few = words(r, 9)
    rows += [" ".join(few), " ".join(few[:8])]  # 5 and 4 shingles: 0.8
    sets = [set(simhash.shingles(t, 5).tolist()) for t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root = [root[b] if x == root[a] else x for x in root]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    expected = sorted({x: k for k, x in reversed(list(enumerate(root)))}.values())
    assert sorted(x.doc_id for x in simhash.keep_one(docs).collect()) == expected
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "TOGETHER", 2)
    assert sorted(x.doc_id for x in simhash.keep_one(docs, most=4).collect()) == expected
    assert len(expected) == 10 + 20 + 1 + 1


def test_one_row_remains_of_each_component_whatever_the_ids(spark):
    r = np.random.default_rng(8)
    texts = [" ".join(words(r, 60)) for _ in range(12)]
    rows = [(None, t) for t in texts[:5]] + [(1, t) for t in texts[5:9]] + [(2, texts[5]), (1, texts[9]), (0, texts[9]), (None, texts[9]), (None, texts[0])]
    rows += [(3, texts[10]), (3, texts[11]), (3, texts[11])]
    kept = sorted((x.doc_id is None, x.doc_id or 0, x.text) for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    expected = [(True, 0, t) for t in texts[:5]] + [(False, 1, t) for t in texts[5:9]]
    assert kept == sorted([*expected, (False, 0, texts[9]), (False, 3, texts[10]), (False, 3, texts[11])])


def test_columns_with_names_of_its_own(spark):
    rows = [(1, "a b c d e f", 7, 8, 9, 10), (2, "a b c d e f", 7, 8, 9, 10), (3, "g", None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _ROW int, none int, id int, hash int")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [rows[0], rows[2]]
