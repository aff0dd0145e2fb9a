from __future__ import annotations

import math

from pyspark.sql import functions as F

from candela.llm import langid


def test_held_out_accuracy(docs):
    model = langid.fit(docs, langid.training_rows())
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert set(model.names) == {"de", "en", "es", "fr"} and 4 <= len(model.names) <= 12


def test_labels_of_held_out_rows_do_not_matter(docs):
    held = ~langid.training_rows()
    changed = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (langid.fit(d, langid.training_rows()) for d in (docs, changed))
    assert a.names == b.names and (a.rows == b.rows).all()


def test_unknown_texts(docs, odd, none):
    model = langid.fit(docs, langid.training_rows())
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    for doc_id in (50, 51, 52, 56):
        assert (by[doc_id].lang_pred, by[doc_id].score, by[doc_id].rejected) == ("und", 0.0, True)
    far = model.predict(["Ωμέγα και άλφα στην αρχή του κειμένου που ακολουθεί εδώ " * 20])
    assert far[0][2]
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and not {50, 51, 52, 56} & {r.doc_id for r in kept.collect()}
    assert langid.predict(none, model).count() == 0
    empty = langid.fit(none, langid.training_rows())
    assert empty.predict(["word"]) == [("und", 0.0, True)]


def slow_predict(model, text):
    """The same law in plain loops: counts of n-grams in a dictionary, one cosine after the other."""
    lowered = (text or "").lower()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    kept = ""
    for k, c in enumerate(lowered):
        if c.isalpha():
            kept += c
        elif k == 0 or lowered[k - 1].isalpha():
            kept += " "
    counts = {}
    for order in langid.ORDERS:
        for k in range(len(kept) - order + 1):
            code = 0
            for c in kept[k : k + order]:
                code = (code ^ ord(c)) * 0x9E3779B1 % (1 << 32)
            bucket = (code + order * 0x85EBCA6B) % (1 << 32) >> 18
            counts[bucket] = counts.get(bucket, 0) + 1
    vector = {b: (1 + math.log(n)) * float(model.idf[b]) for b, n in counts.items()}
    norm = math.sqrt(sum(v * v for v in vector.values())) or 1.0
    cosines = [sum(v * float(row[b]) for b, v in vector.items()) / norm for row in model.rows]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    floor = float(model.floor[best]) * min(1.0, len(text) / langid.FULL_LENGTH) ** 0.5
    return model.names[best], cosines[best], cosines[best] < floor


def test_against_plain_loops(docs, odd):
    model = langid.fit(docs, langid.training_rows())
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()] + [r.text for r in odd.collect()]
    texts += ["ÀÉÎ!", "a", " x", "word, 12 word--WORD", "İstanbul ß ǅ", "der " * 5_000 + "the " * 20_000]
    for text, (name, score, rejected) in zip(texts, model.predict(texts), strict=True):
        expected = slow_predict(model, text)
        assert name == expected[0] and abs(score - expected[1]) < 1e-4, text
        assert rejected == expected[2], text
