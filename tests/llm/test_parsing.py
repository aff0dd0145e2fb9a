from __future__ import annotations

import hashlib
import random

import numpy as np
import xxhash

from candela.llm import parsing


def order(row):
    text = row.text or ""
    tie = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return (row.doc_id is not None, row.doc_id or 0, tie - (tie >> 63 << 64), text)


def expected(rows):
    rows = sorted(rows, key=order)
    out = []
    for k, row in enumerate(rows):
        text, following = row.text or "", rows[(k + 1) % len(rows)].text or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        a, b, c = parsing.fingerprints([text, edited, following])
        near = [float(parsing.likeness(a[None], x[None])[0]) for x in (b, c)]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((row.doc_id or -1, len(text), sha, *parsing.written_out(np.stack([a, b])), *near))
    return sorted(out)


def got(df):
    rows = parsing.fingerprint_documents(df).collect()
    return sorted((r.doc_id or -1, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows)


def test_against_brute_force(docs, odd, none, monkeypatch):
    assert got(odd) == expected(odd.collect())
    monkeypatch.setattr(parsing, "RANGE_ROWS", 10)  # many ranges
    assert got(docs.repartition(5)) == expected(docs.collect())
    assert got(odd) == expected(odd.collect())
    assert parsing.fingerprint_documents(none).count() == 0
    assert got(odd.filter("doc_id = 3")) == expected(odd.filter("doc_id = 3").collect())


def test_shared_text_is_seen_at_any_offset():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(400)]
    text = " ".join(r.choice(words) for _ in range(500))
    other = " ".join("".join(r.choice("ijklmnop") for _ in range(5)) for _ in range(500))
    a, b, c, d = parsing.fingerprints([text, "Some words in front, " + text, text[: len(text) * 3 // 4] + other[: len(text) // 4], other])
    like = lambda x, y: float(parsing.likeness(x[None], y[None])[0])
    assert like(a, b) > 0.9 and like(a, c) > 0.4 and like(a, d) < 0.1 and like(a, a) == 1


def test_batches_do_not_matter(docs):
    texts = [r.text for r in docs.limit(30).collect()]
    assert (parsing.fingerprints(texts) == np.concatenate([parsing.fingerprints([t]) for t in texts])).all()
    blank = parsing.fingerprints(["", None])
    assert not blank.any() and parsing.likeness(blank[:1], blank[1:])[0] == 1


def test_a_hot_id_is_split(docs, monkeypatch):
    monkeypatch.setattr(parsing, "RANGE_ROWS", 10)
    for hot in ("NULL", "60", "9223372036854775807", "9007199254740993"):
        third = docs.selectExpr(f"CASE WHEN doc_id % 3 = 0 THEN {hot} ELSE doc_id END AS doc_id", "text").cache()
        assert got(third.repartition(4)) == expected(third.collect())
        parts = parsing.with_next(third).filter("NOT extra").groupBy("part").count().collect()
        assert sum(r["count"] for r in parts) == third.count() and max(r["count"] for r in parts) < 60
    same = docs.selectExpr("CASE WHEN doc_id % 3 > 0 THEN 7 ELSE doc_id END AS doc_id", "IF(doc_id % 3 > 0, 'one text', text) AS text")
    assert got(same.repartition(4)) == expected(same.collect())
    assert parsing.with_next(same.coalesce(1)).filter("extra").count() < 40


def test_bounds():
    bounds = parsing.Bounds.of([3, 5, 9], {5: 3})
    keys = np.array([1, 3, 4, 5, 5, 5, 6, 8, 9, 99])
    ties = np.array([0, 0, 0, -(1 << 63), 0, (1 << 63) - 1, 0, 0, 0, 0])
    assert bounds.part(keys, ties).tolist() == [0, 1, 1, 2, 3, 4, 5, 5, 6, 6]
    assert parsing.Bounds.of([], {}).part(keys, ties).tolist() == [0] * 10
