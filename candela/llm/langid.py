"""Language identification by nearest centroid over normalised TF-IDF character n-grams.

Texts become vectors of hashed n-grams of code points, weighted by
(1 + log tf) * idf and of unit length. Each language has several centroids,
found by spherical k-means within the language. A text gets the language of
the centroid with the largest cosine. It is rejected if that cosine falls
below a share of what its language's own sample shows, so texts in no known
language stand out while odd or short but clean ones pass.

The classifier is fitted on a bounded sample: ``SAMPLE`` labelled documents of
each language, ``SAMPLE_ALL`` in all, those with the smallest hash of id and text,
of ``SAMPLE_CHARS`` characters at most. Prediction reads every text whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and rejected; equal texts get equal results; no labelled rows give a model
without languages, which predicts ``und``; other columns, clashing ones too,
are not read by ``predict`` and kept by ``keep_known``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import map_batches, remainder

#: Labelled rows taken for each language and in all, characters that are read of each, and languages that a model can hold.
SAMPLE, SAMPLE_ALL = 400, 10_000
SAMPLE_CHARS = 20_000
LANGUAGES = 1_000
#: Hash buckets of n-grams; lengths of n-grams; centroids of a language.
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
CENTROIDS = 3
#: Share of the cosine that all but 1 % of the sample reach, below which a text is rejected.
REJECT = 0.4
#: Letters from which that share holds; shorter texts have smaller cosines by nature, and a bound that follows.
FULL_LENGTH = 512
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and next(filter(str.isalpha, text), None) is not None


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


def term_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the lower-cased text, in which any stretch of non-letters is one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "uint32")
    letters = letter_table()[points]
    points = np.where(letters, points, np.uint32(32))[letters | np.concatenate([[True], letters[:-1]])]
    counts = np.zeros(BUCKETS, "float32")
    code = np.zeros(len(points), "uint32")
    for order in range(1, max(ORDERS) + 1):
        if len(points) < order:
            break
        code = (code[: len(points) - order + 1] ^ points[order - 1 :]) * np.uint32(0x9E3779B1)
        if order in ORDERS:
            counts += np.bincount((code + np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(18), minlength=BUCKETS)
    return counts


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors, one row for each text."""
    out = np.zeros((len(texts), BUCKETS), "float32")
    for row, text in zip(out, texts, strict=True):
        counts = term_counts(text)
        at = np.flatnonzero(counts)
        row[at] = (1 + np.log(counts[at])) * idf[at]
        if norm := np.sqrt(np.dot(row[at], row[at])):
            row /= norm
    return out


@dataclass
class Centroids:
    idf: np.ndarray
    names: list[str] = field(default_factory=list)  # of each centroid's language
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS), "float32"))
    floor: np.ndarray = field(default_factory=lambda: np.zeros(0, "float32"))  # smallest cosine accepted

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        lettered = [k for k, t in enumerate(texts) if has_letter(t)] if self.names else []
        for at in range(0, len(lettered), 256):
            here = lettered[at : at + 256]
            cosines = vectors([texts[k] for k in here], self.idf) @ self.rows.T
            lengths = [min(1.0, len(texts[k]) / FULL_LENGTH) ** 0.5 for k in here]
            best = cosines.argmax(axis=1)
            top = cosines[np.arange(len(here)), best].tolist()
            for k, b, c, share in zip(here, best.tolist(), top, lengths, strict=True):
                out[k] = (self.names[b], min(1.0, max(0.0, c)), c < self.floor[b] * share)
        return out


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from rows that are far from those chosen before."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin((rows @ rows[chosen].T).max(axis=1))))
    centroids = rows[chosen].copy()
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        for c in range(len(centroids)):
            if (nearest == c).any():
                mean = rows[nearest == c].sum(axis=0)
                centroids[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids


def fit_texts(labelled: dict[str, list[str]]) -> Centroids:
    """A model from texts by language."""
    every = [t for lang in sorted(labelled) for t in labelled[lang]]
    seen = np.zeros(BUCKETS)
    for text in every:
        seen += term_counts(text) > 0
    model = Centroids((np.log((1 + len(every)) / (1 + seen)) + 1).astype("float32"))
    parts, floors = [], []
    for lang in sorted(labelled):
        rows = vectors(labelled[lang], model.idf)
        centroids = spherical_kmeans(rows, CENTROIDS)
        parts.append(centroids)
        floors += [REJECT * float(np.quantile((rows @ centroids.T).max(axis=1), 0.01))] * len(centroids)
        model.names += [lang] * len(centroids)
    if parts:
        model.rows, model.floor = np.concatenate(parts).astype("float32"), np.array(floors, "float32")
    return model


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Centroids:
    """A model from a bounded sample of the labelled rows for which ``learn`` holds; rows are drawn by id and text."""
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = F.xxhash64(F.lit("sample"), "doc_id", "text")
    mark = drawn.bitwiseXOR(F.lit(-1 << 63))  # order of unsigned hashes
    share = (drawn / F.lit(2.0**64)) + 0.5
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} labels; a label is a language")
    if not counts:
        return Centroids(np.ones(BUCKETS, "float32"))
    sample = min(sample, max(1, SAMPLE_ALL // len(counts)))
    # a hash threshold leaves somewhat more than the sample of each language; the rest is cut by order of hash
    limits = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, (sample + 6 * sample**0.5) / r["n"]))])
    taken = known.filter(share <= F.try_element_at(limits, F.col("lang"))).select("lang", F.left("text", F.lit(SAMPLE_CHARS)).alias("text"), mark.alias("mark")).distinct().collect()
    labelled: dict[str, list[str]] = {}
    for row in sorted(taken, key=lambda r: (r["mark"], r["text"])):
        texts = labelled.setdefault(row["lang"], [])
        if len(texts) < sample and has_letter(row["text"]):
            texts.append(row["text"])
    return fit_texts(labelled)


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    schema = rows.select("doc_id", "held_out").schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.predict(batch.column(2).to_pylist())
        langs, scores, rejected = zip(*found, strict=True)
        arrays = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array([bool(r) for r in rejected])]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], schema.names)

    return map_batches(rows, schema, work)


def keep_known(docs: DataFrame, model: Centroids) -> DataFrame:
    """The rows whose text is not rejected, with the columns they have."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        return batch.filter(pa.array([not r for _, _, r in shared.value.predict(texts)], pa.bool_()))

    return map_batches(docs, docs.schema, work)


def training_rows() -> Column:
    """Rows that a classifier may learn from."""
    return remainder(F.col("doc_id"), 3) != 1
