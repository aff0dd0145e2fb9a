"""Document fingerprints by locally consistent parsing.

A text's code points are parsed into phrases again and again. At each level,
equal neighbours become one symbol; deterministic coin tossing (the lowest bit
in which a symbol differs from its left neighbour, three rounds) gives small
labels; local maxima of the labels begin phrases; a phrase's name is a hash of
its symbols. Where phrases begin depends on a few neighbours only, so equal
substrings share all interior phrases at any offset. A fingerprint keeps, for
each of ``BINS`` ranges of names, the least name at level ``LEVELS``; likeness
is the share of bins with equal entries, an estimate of the phrase sets'
Jaccard similarity.

Edits pair each document with the next one in order of doc_id. Documents are
dealt into ranges of doc_id by bounds from quantiles; each range also gets a
copy of the first row of the next one, so no global sort is needed. An id (or
the lack of one) that fills several ranges is split by a hash of the text.

Defined cases: a null text is an empty one; an empty text has the fingerprint
of zeros, and two of these have likeness 1; rows with equal doc_id are ordered
by a hash of the text, then by text, null ids come first; one row is its own
next; rows equal in id and text stay in one range, which is read as a stream;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import arrow, slices

BINS = 64
LEVELS = 2
#: Documents in a range of doc_id, on average.
RANGE_ROWS = 500
#: Rows of a task, about.
TASK_ROWS = 8_000
MOST_RANGES = 20_000
GOLDEN, MIX_A, MIX_B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def toss_table() -> np.ndarray:
    """The label of a value below 128 given its left neighbour's: 2 * (lowest differing bit) + own bit there."""
    own, left = np.divmod(np.arange(128 * 128), 128)
    low = (own ^ left) & -(own ^ left)
    position = np.where(low > 0, np.log2(np.maximum(low, 1)).astype("int64"), 0)
    return (2 * position + (own >> position & 1)).astype("uint8")


def parse_level(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases' names and documents, one level up; doc is ascending."""
    new_doc = np.ones(len(doc), bool)
    new_doc[1:] = doc[1:] != doc[:-1]
    heads = np.flatnonzero(new_doc | np.concatenate([[True], names[1:] != names[:-1]]))
    runs = np.diff(np.append(heads, len(names)))
    names, doc, first = names[heads], doc[heads], new_doc[heads]
    repeated = runs > 1
    if repeated.any():
        names = names.copy()
        names[repeated] = mixed(names[repeated] + runs[repeated].astype("uint64") * GOLDEN)
        # a run's name could equal its neighbour's only by a hash collision
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = ~names[first]
    differ = names ^ left
    position = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype("uint64")
    position &= np.uint64(63)
    label = (np.uint64(2) * position + (names >> position & np.uint64(1))).astype("int64")
    for _ in range(2):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        label = toss_table()[label << 7 | before].astype("int64")
    before, after = np.full(len(label), -1), np.full(len(label), -1)
    before[1:] = label[:-1]
    after[:-1] = np.where(first[1:], -1, label[1:])
    starts = np.flatnonzero(first | (label > before) & (label >= after))
    within = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
    summed = np.add.reduceat(mixed(names + (within.astype("uint64") + np.uint64(1)) * GOLDEN), starts)
    return mixed(summed), doc[starts]


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """One row of BINS numbers below 2 ** 16 for each text; 0 where a bin has no phrase."""
    out = np.zeros((len(texts), BINS), "uint16")
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    points = np.frombuffer(b"".join(raw), "uint32").astype("uint64")
    if not len(points):
        return out
    doc = np.repeat(np.arange(len(texts)), [len(r) // 4 for r in raw])
    names = mixed((points + np.uint64(1)) * GOLDEN)
    for _ in range(LEVELS):
        names, doc = parse_level(names, doc)
    # bin from the name's low bits, order within the bin from the high ones
    slot = doc.astype("uint64") * np.uint64(BINS) + (names & np.uint64(BINS - 1))
    keyed = np.sort(slot << np.uint64(32) | names >> np.uint64(32))
    slot = (keyed >> np.uint64(32)).astype("int64")
    heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    least = mixed(keyed[heads] & np.uint64(0xFFFFFFFF)) % np.uint64(65535) + np.uint64(1)
    out.reshape(-1)[slot[heads]] = least.astype("uint16")
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise: bins that agree among those that either has; 1 for two without any."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(used == 0, 1.0, same / np.maximum(used, 1))


def written_out(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the next text, or all that it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


class Bounds:
    """Where ranges of (key, tie) begin; ranges end within a key only if it fills several of them."""

    def __init__(self, keys: np.ndarray, split: dict[int, int]) -> None:
        self.keys = keys  # ascending; a range begins at each
        self.split = split  # into how many ranges a key's rows go
        sizes = np.array([split.get(k, 1) for k in keys.tolist()], "int64")
        # number of the first range of each key; range 0 lies before all keys
        self.first = np.concatenate([[0], 1 + np.cumsum(sizes) - sizes]).astype("int64")

    @classmethod
    def of(cls, cuts: list[int], split: dict[int, int]) -> Bounds:
        """From quantiles, and from the keys that get several ranges of their own."""
        limits = {k + 1 for k in split if k < (1 << 63) - 1}
        return cls(np.array(sorted(limits.union(cuts, split)), "int64"), split)

    def part(self, keys: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """The range of each row; ties are spread evenly, being hashes."""
        out = self.first[np.searchsorted(self.keys, keys, "right")]
        for k in np.unique(keys).tolist() if self.split else ():
            if (m := self.split.get(k, 1)) > 1:
                own = np.flatnonzero(keys == k)
                share = (ties[own] >> 32) + (1 << 31)  # the tie's upper half, from 0
                out[own] += share * m >> 32
        return out


def with_next(docs: DataFrame) -> DataFrame:
    """part, extra, doc_id, text: sorted partitions in which each row's next document follows it.

    A row with ``extra`` is the first of the part that comes next, there only
    to be looked at. What is kept in the driver is a bound and a first row's key
    and tie for each part, of which there are at most two for each of MOST_RANGES.
    """
    lowest = -(1 << 63)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("key")
    tie = F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")
    total = docs.count()
    n = max(1, min(MOST_RANGES, total // RANGE_ROWS))
    tasks = max(1, min(n, -(-total // TASK_ROWS)))  # follows the rows, whatever the session's number of partitions
    cuts = docs.select(key).approxQuantile("key", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
    # quantiles are doubles, so a hot key is looked up; of keys with so many rows there are at most n
    hot = [c for c, times in Counter(cuts).items() if times > 1]
    counts = docs.select(key).filter(F.col("key").cast("double").isin(hot)).groupBy("key").count()
    counts = counts.filter(F.col("count") >= 2 * (total // n)).collect() if hot else []
    split = {r["key"]: r["count"] * n // total for r in counts}
    bounds = Bounds.of([min(int(c), (1 << 63) - 1) for c in cuts], split)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            part = bounds.part(keys, ties)
            order = np.lexsort((ties, keys, part))
            heads = order[np.concatenate([[True], np.diff(part[order]) > 0])] if len(keys) else order
            yield pa.RecordBatch.from_arrays([pa.array(x[heads]) for x in (part, keys, ties)], ["part", "key", "tie"])

    # the text is read only where an id is split; elsewhere all rows of a range's first id are copied
    seen = docs.select(key, tie if bounds.split else F.lit(0).cast("bigint").alias("tie"))
    least = arrow(seen, first_rows, "part bigint, key bigint, tie bigint").groupBy("part").agg(F.min(F.struct("key", "tie")).alias("row"))
    found = sorted((r["part"], r["row"]["key"], r["row"]["tie"]) for r in least.collect())
    # the part before the one that begins with a key, or with a key and tie; the last, for the first
    before = {(k, t if k in bounds.split else 0): found[at - 1][0] for at, (_, k, t) in enumerate(found)}
    firsts = np.array(sorted({k for k, _ in before}), "int64")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            extra, target = [], []
            copied = set()
            for k in np.flatnonzero(np.isin(keys, firsts)).tolist():
                start = int(keys[k])
                start = start, int(ties[k]) if start in bounds.split else 0
                # of rows equal in id and text, one for each batch will do
                if start in before and (start, text := batch.column(3)[k].as_py()) not in copied:
                    copied.add((start, text))
                    extra.append(k)
                    target.append(before[start])
            rows = batch.take(pa.array(np.concatenate([np.arange(len(keys)), np.array(extra, "int64")])))
            part = np.concatenate([bounds.part(keys, ties), np.array(target, "int64")])
            flag = np.arange(len(part)) >= len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(flag), *rows.columns], names)

    wide = docs.select(key, tie, "doc_id", "text")
    names = ["part", "extra", *wide.columns]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part bigint, extra boolean, key bigint, tie bigint, doc_id {kind}, text string"
    dealt = arrow(wide, deal, schema).repartition(tasks, "part")
    return dealt.sortWithinPartitions("part", "extra", "key", "tie", "text").select("part", "extra", "doc_id", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    fields = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    schema = docs.select("doc_id").schema
    for name, kind in zip(fields, ("long", "string", "string", "string", "double", "double"), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen: its batch row, text, fingerprint
        for batch in batches:
            for part in slices(batch, 1_000_000):
                texts = [t or "" for t in part.column(3).to_pylist()]
                extra = part.column(1).to_pylist()
                prints = fingerprints(texts)
                ids = part.column(2)
                if held is not None:
                    ids = pa.concat_arrays([held[0], ids])
                    extra, texts, prints = [held[1], *extra], [held[2], *texts], np.concatenate([held[3], prints])
                own = [k for k in range(len(texts) - 1) if not extra[k]]
                held = (ids.slice(len(texts) - 1, 1), extra[-1], texts[-1], prints[-1:])
                if not own:
                    continue
                changed = [edited(texts[k], texts[k + 1]) for k in own]
                made = fingerprints(changed)
                here, following = prints[own], prints[[k + 1 for k in own]]
                columns = (
                    [len(texts[k]) for k in own],
                    [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                    written_out(here),
                    written_out(made),
                    likeness(here, made),
                    likeness(here, following),
                )
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(own)), *arrays], ["doc_id", *fields])

    return arrow(with_next(docs), run, schema)
