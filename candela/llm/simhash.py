"""SimHash near-duplicates: bit-sliced comparison of fingerprints, then connected components.

A fingerprint has 64 bits, each the majority over the hashes of a text's word
shingles. Distinct fingerprints within the radius are found exactly. The bits
are cut into bands; fingerprints at distance r or less agree on all but r of
the bands, so each choice of bands makes a bucket key. Inside a bucket the
fingerprints are stored as bit planes, one machine word for 64 of them.
Carry-save counters add up the differing bits of many fingerprints at once,
and a block of words is left as soon as all of its distances pass the radius.

A bucket with more than ``MOST`` fingerprints is cut again by bands of the
bits that its key leaves open, twice if need be; at most 15 bits are open
then, and no bucket can hold more than 32768 fingerprints. Buckets yield a spanning forest of their
links, not all pairs; reachability, hence components, stays the same.

``components`` links fingerprints of 64 bits at a small radius, as stated.
That radius misses many texts of similarity 0.8, so ``keep_one`` uses 256 bits
of five-word shingles, where a similarity of 0.8 means some 39 differing bits
(standard deviation 6), unrelated texts differ in about 128, and the radius is
64. Its buckets come from random subsets of ``KEY_BITS`` bits. Their number is
the same for any input: as many as find a pair of similarity 0.8, over all
distances it may have, with a probability of ``FOUND``. A bucket with more than
``MOST`` fingerprints is split: what is near its least node is linked to that;
the others, which are few in a group of near copies, are compared with all of
the bucket, under keys of further bits and in blocks of bounded size. These
links only propose: ``keep_one`` confirms each on the sets of distinct
shingles, of which the wide fingerprints are made too, so that a repeated line
counts once. A proposed group is compared with its least node; members that are
not similar to it are compared with all of the group, again in blocks.

Defined cases: null, empty and blank texts have fingerprint zero and are
linked like any other; fewer words than a shingle make one shingle; copies
share a fingerprint; null ids are kept, and are no component's name unless all
ids of the component are null; an empty table gives no rows; other columns are
ignored by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import arrow, map_batches, unused, written

BITS = 64
SEED = 42
#: Largest bucket that is compared as it is.
MOST = 2_048
#: Plane words that one comparison step handles.
STEP = 1 << 18


def fingerprint(text: str | None, words: int = 3, width: int = 1) -> np.ndarray:
    """Majority bits over XXH64 of the text's word shingles, as ``width`` numbers; zeros for a text without words.

    Numbers after the first take their bits from hashes of these hashes.
    """
    hashes = shingles(text, words)
    return print_of(hashes, width)


def shingles(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the text's word shingles, with repeats; a text of fewer words is one shingle, one without words none."""
    import xxhash

    tokens = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not tokens:
        return np.zeros(0, "uint64")
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "uint64")
    sizes = np.fromiter(map(len, tokens), "int64", len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(tokens) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    return np.array(found, "uint64")


def print_of(hashes: np.ndarray, width: int) -> np.ndarray:
    if not len(hashes):
        return np.zeros(width, "uint64")
    return np.array([_majority(hashes if k == 0 else _rehashed(hashes, k)) for k in range(width)], "uint64")


def _rehashed(hashes: np.ndarray, k: int) -> np.ndarray:
    x = (hashes + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _majority(hashes: np.ndarray) -> int:
    rows = hashes.view("uint8").reshape(-1, 8)
    counts = np.zeros(BITS, "int64")
    for at in range(0, len(rows), 255):  # sums of 255 bits fit a byte
        counts += np.unpackbits(rows[at : at + 255], axis=1, bitorder="little").sum(axis=0, dtype="uint8")
    return int.from_bytes(np.packbits(2 * counts > len(rows), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (long, the fingerprint's bits) for every document."""
    schema = docs.select("doc_id").schema.add("fp", "long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, words)[0] for t in batch.column(1).to_pylist()], "uint64")
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view("int64"))], ["doc_id", "fp"])

    return map_batches(docs.select("doc_id", "text"), schema, work)


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes [bit, word] of fingerprints [row, number]: lane k of word w has the bit of row 64 w + k."""
    n = -(-len(fps) // 64) * 64
    padded = np.zeros((n, fps.shape[1]), "uint64")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view("uint8").reshape(n, 8 * fps.shape[1]), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("uint64")


def close_pairs(fps: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices i < j of fingerprints [row, number] of the same bucket within the radius; bucket is ascending."""
    rows = np.arange(len(fps))
    return _pairs(fps, planes(fps), rows, rows + 1, np.searchsorted(bucket, bucket, "right"), radius)


def _pairs(fps, vertical, rows, low, high, radius):
    """Pairs of each of the rows with lanes low .. high - 1, within the radius; steps of bounded size."""
    out_i, out_j = [np.empty(0, "int64")], [np.empty(0, "int64")]
    keep = high > low
    rows, low, high = rows[keep], low[keep], high[keep]
    n_words = (high - 1) // 64 - low // 64 + 1
    ends = np.cumsum(n_words)
    start = 0
    while start < len(rows):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + STEP, "right")))
        here = np.repeat(np.arange(start, stop), n_words[start:stop])
        offset = np.arange(len(here)) - np.repeat(ends[start:stop] - n_words[start:stop] - base, n_words[start:stop])
        i, j = _compare(fps, vertical, rows[here], low[here] // 64 + offset, low[here], high[here], radius)
        out_i.append(i)
        out_j.append(j)
        start = stop
    return np.concatenate(out_i), np.concatenate(out_j)


def _compare(fps, vertical, rows, words, low, high, radius):
    """Lanes within the radius, for pairs of a fingerprint and a word of 64 others."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    mask = lambda k: np.where(k >= 64, full, (np.uint64(1) << np.minimum(k, 63).astype("uint64")) - np.uint64(1))
    alive = mask(np.clip(high - words * 64, 0, 64)) & ~mask(np.clip(low - words * 64, 0, 64))
    # counters of a few bits, one plane for each, start so that radius + 1 differences overflow them
    size = radius.bit_length()
    counter = [np.full(len(rows), full if (1 << size) - 1 - radius >> k & 1 else 0, "uint64") for k in range(size)]
    for bit in range(len(vertical)):
        own = np.uint64(0) - (fps[rows, bit // 64] >> np.uint64(bit % 64) & np.uint64(1))
        carry = vertical[bit][words] ^ own
        for k in range(size):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        alive &= ~carry
        if bit % 8 == 7 and bit >= radius:
            keep = alive != 0
            if keep.mean() < 0.9:
                rows, words, alive = rows[keep], words[keep], alive[keep]
                counter = [c[keep] for c in counter]
            if not len(rows):
                break
    keep = alive != 0
    rows, words, alive = rows[keep], words[keep], alive[keep]
    lanes = np.unpackbits(alive.view("uint8").reshape(-1, 8), axis=1, bitorder="little") if len(rows) else np.empty((0, 64))
    at, lane = np.nonzero(lanes)
    return rows[at], words[at] * 64 + lane


#: Rows from which a bucket is thinned by leaders, and leaders at most.
CROWDED, LEADERS = 1_024, 64


def spanning(fps: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of close pairs of the same bucket that span all components; bucket is ascending."""
    sizes = np.bincount(bucket)
    plain = sizes[bucket] <= CROWDED
    rows = np.flatnonzero(plain)
    i, j = close_pairs(fps[rows], bucket[rows], radius)
    out = [(rows[i], rows[j])]
    for crowded in np.flatnonzero(sizes > CROWDED):
        rest = np.flatnonzero(bucket == crowded)
        for _ in range(LEADERS):
            if len(rest) <= CROWDED:
                break
            near = np.bitwise_count(fps[rest] ^ fps[rest[0]]).sum(axis=1, dtype="int64") <= radius
            group, rest = rest[near], rest[~near]
            out.append((np.full(len(group) - 1, group[0]), group[1:]))
            if len(group) > 1 and len(rest):  # what is near the leader may be near others that are not
                few, many = (group, rest) if len(group) < len(rest) else (rest, group)
                both = np.concatenate([many, few])
                end = np.full(len(few), len(many))
                i, j = _pairs(fps[both], planes(fps[both]), np.arange(len(many), len(both)), end * 0, end, radius)
                out.append((both[i], both[j]))
        i, j = close_pairs(fps[rest], np.zeros(len(rest), "int64"), radius)
        out.append((rest[i], rest[j]))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def forest(names: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that span the same components as the pairs do; b is the name of a component's first row."""
    label = np.arange(len(names))
    while True:  # min-label passes with pointer jumping
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        while (jumped := new[new]).tobytes() != new.tobytes():
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    members = np.flatnonzero(label != np.arange(len(names)))
    return names[members], names[label[members]]


def _masks(open_bits: list[int], radius: int, keep: int) -> list[int]:
    """Bit masks of the keys: the open bits cut into keep + radius bands, any keep of them."""
    bands = [part.tolist() for part in np.array_split(np.array(open_bits), keep + radius)]
    return [sum(1 << b for part in chosen for b in part) for chosen in combinations(bands, keep)]


def links(distinct: DataFrame, radius: int = 2, most: int = MOST) -> DataFrame:
    """Links a, b between distinct fingerprints, spanning each component of near ones.

    Levels: keys of 2 of 4 bands leave 32 bits open; a crowded bucket is cut by
    1 of 3 bands of these, twice, which leaves 15 bits at most.
    """
    level = distinct.select("fp", F.lit(0).cast("bigint").alias("mask"))
    found: DataFrame | None = None
    for keep, deepest in ((2, False), (1, False), (1, True)):
        level = _cut(level, radius, keep)
        counts = written(level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        sized = level.join(counts, ["mask", "key"])
        small = sized if deepest else sized.filter(F.col("n") <= most)
        part = _linked(small, radius)
        found = part if found is None else found.unionByName(part)
        if deepest:
            break
        level = written(sized.filter(F.col("n") > most).select("fp", "mask"))
        if level.isEmpty():
            break
    return found


def _cut(level: DataFrame, radius: int, keep: int) -> DataFrame:
    """fp, mask, key: each fingerprint under every choice of bands among the bits that its mask leaves open."""
    schema = "fp bigint, mask bigint, key bigint"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.asarray(batch.column(0)).view("uint64")
        masks = np.asarray(batch.column(1)).view("uint64")
        out_fp, out_mask = [], []
        for mask in np.unique(masks):
            here = fps[masks == mask]
            for more in _masks([b for b in range(BITS) if not int(mask) >> b & 1], radius, keep):
                out_fp.append(here)
                out_mask.append(np.full(len(here), int(mask) | more, "uint64"))
        fp, mask = np.concatenate(out_fp), np.concatenate(out_mask)
        arrays = [pa.array(x.view("int64")) for x in (fp, mask, fp & mask)]
        return pa.RecordBatch.from_arrays(arrays, ["fp", "mask", "key"])

    return map_batches(level.select("fp", "mask"), schema, work)


def whole_buckets(batches: Iterator[np.ndarray], keys: int) -> Iterator[np.ndarray]:
    """Sorted rows again, cut where the first ``keys`` columns change; only one bucket is held back."""
    held: list[np.ndarray] = []
    for rows in batches:
        if not len(rows):
            continue
        if held and (held[0][0, :keys] != rows[0, :keys]).any():
            yield np.concatenate(held)
            held = []
        new = np.flatnonzero((rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)) + 1
        if len(new):
            at = int(new[-1])
            yield np.concatenate([*held, rows[:at]])
            held, rows = [], rows[at:]
        held.append(rows)
    if held:
        yield np.concatenate(held)


def bucket_numbers(rows: np.ndarray, keys: int) -> np.ndarray:
    return np.cumsum(np.concatenate([[0], (rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)]))


def linked(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (a, b)], ["a", "b"])


def _linked(sized: DataFrame, radius: int) -> DataFrame:
    """Compares the buckets; a partition's rows come sorted, and only one bucket is held back between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets((np.column_stack([np.asarray(c) for c in b.columns]) for b in batches), 2):
            fps = rows[:, 2].copy().view("uint64")
            i, j = spanning(fps[:, None], bucket_numbers(rows, 2), radius)
            yield linked(*forest(rows[:, 2], i, j))

    ordered = sized.select("mask", "key", "fp").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return arrow(ordered, run, "a bigint, b bigint")


def contracted(edges: DataFrame) -> DataFrame:
    """Links with the same components, of which each node that has only smaller neighbours keeps one.

    The smaller neighbours of a node are linked to the least of them.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.collect_set("b").alias("all")).select("a", "all", F.array_min("all").alias("b"))
    least = least.select(F.explode(F.array_union("all", F.array("a"))).alias("a"), "b")
    return least.filter("a <> b").distinct()


def label_components(edges: DataFrame) -> DataFrame:
    """node, root: every node of the links with one node that its whole component shares.

    Alternates large-star and small-star steps until the links are stars.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written, so that the joins read plain tables and hot nodes can be split
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct())
        least = written(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        inner = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if least.filter("n > 1").isEmpty() and inner.isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def labelled(docs: DataFrame, radius: int = 2, words: int = 3, most: int = MOST) -> DataFrame:
    """doc_id, fp, component_id for every document."""
    prints = written(fingerprints(docs, words))
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = label_components(links(classes.select("fp"), radius, most))
    return _named(prints, classes, roots, "fp").select("doc_id", "fp", "component_id")


def _named(prints: DataFrame, classes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """prints with component_id: the least of the classes that share a root; a class without links is its own."""
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    members = members.withColumnRenamed("node", key)
    members = written(members.join(classes, key).select(key, "root", "least"))
    names = written(members.groupBy("root").agg(F.min("least").alias("component_id")))
    linked = members.join(names, "root").select(key, "component_id")
    named = classes.join(linked, key, "left").select(key, F.coalesce("component_id", "least").alias("component_id"))
    return prints.join(written(named), key)


def components(docs: DataFrame, radius: int = 2, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id that links reach)."""
    return labelled(docs, radius, words).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Numbers of a wide fingerprint, its radius and the words of its shingles; bits of a bucket key and the chance
#: that the keys find a pair; the same for the keys that cut a crowded bucket.
WIDE, WIDE_RADIUS, WIDE_WORDS = 4, 64, 5
KEY_BITS, FOUND = 16, 0.95
CUT_BITS, CUT_FOUND = 8, 0.99
#: Probability that a bit differs at a similarity of 0.8: the angle between the shingle vectors over pi.
DIFFERS = math.acos(2 * 0.8 / 1.8) / math.pi
#: Sets of so many shingles are also found by what is left without one of them; pairs that a hot node's set
#: shares; sets of a block, and their bytes.
FEW, TOGETHER, BLOCK, BLOCK_BYTES = 7, 256, 256, 16 << 20
NUMBERS = [f"f{k}" for k in range(WIDE)]


def wide_prints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, node (hash of the set of shingles), the print's numbers and few for every document.

    ``few`` is for sets of ``FEW`` shingles at most: hashes of the set and of the
    set without each one. Such sets of similarity 0.8 differ by one shingle at
    most, so they share one of these, however their fingerprints differ.
    """
    import xxhash

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} bigint" for c in NUMBERS)
    schema = f"doc_id {kind}, text_hash bigint, node bigint, {numbers}, few array<bigint>"
    name = lambda hashes: xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, prints, few = [], [], []
        for text in batch.column(2).to_pylist():
            hashes = np.unique(shingles(text, WIDE_WORDS))
            nodes.append(name(hashes))
            prints.append(print_of(hashes, WIDE))
            small = 0 < len(hashes) <= FEW
            few.append([nodes[-1], *[name(np.delete(hashes, k)) for k in range(len(hashes))]] if small else None)
        arrays = [batch.column(0), batch.column(1), pa.array(nodes, pa.int64())]
        arrays += [pa.array(column.view("int64")) for column in np.ascontiguousarray(np.array(prints).T)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(few, pa.list_(pa.int64()))], ["doc_id", "text_hash", "node", *NUMBERS, "few"])

    return map_batches(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), schema, work)


def key_masks(size: int, found: float) -> np.ndarray:
    """Masks [table, number] of bucket keys: as many random sets of ``size`` bits as find a pair with the given chance.

    The chance is over all distances within the radius that a pair of
    similarity 0.8 may have. The number of documents plays no part.
    """
    bits, d = BITS * WIDE, range(WIDE_RADIUS + 1)
    met = np.array([math.comb(bits, k) * DIFFERS**k * (1 - DIFFERS) ** (bits - k) for k in d])
    agree = np.array([math.comb(bits - k, size) / math.comb(bits, size) for k in d])
    tables = 1
    while (met * (1 - (1 - agree) ** tables)).sum() < found:
        tables += 1
    rng = np.random.default_rng(SEED + size)
    chosen = np.zeros((tables, bits), "uint8")
    for table in chosen:
        table[rng.permutation(bits)[:size]] = 1
    return np.packbits(chosen, axis=1, bitorder="little").view("int64")


def bucketed(rows: DataFrame, size: int, found: float, *also: str) -> DataFrame:
    """Each row once for each table, with its bucket there; buckets also differ by the columns ``also``."""
    tables = [[t, *mask] for t, mask in enumerate(key_masks(size, found).tolist())]
    masks = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in table]) for table in tables])
    key = lambda m: F.xxhash64(*also, m[0], *[F.col(c).bitwiseAND(m[k + 1]) for k, c in enumerate(NUMBERS)])
    return rows.select("*", F.explode(F.transform(masks, key)).alias("bucket"))


def _within_buckets(dealt: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets((np.column_stack([np.asarray(c) for c in b.columns]) for b in batches), 1):
            bucket = bucket_numbers(rows, 1)
            rows = rows[np.bincount(bucket)[bucket] > 1]
            if len(rows):
                fps = np.ascontiguousarray(rows[:, 2:]).view("uint64")
                yield linked(*forest(rows[:, 1], *spanning(fps, bucket_numbers(rows, 1), WIDE_RADIUS)))

    ordered = dealt.select("bucket", "node", *NUMBERS).repartition("bucket").sortWithinPartitions("bucket", "node")
    return arrow(ordered, run, "a bigint, b bigint")


def in_blocks(members: DataFrame, sizes: DataFrame, payload: list[str]) -> DataFrame:
    """Rows for comparing a group's open members with all of it: group, i, j, side, node and the payload, dealt by block.

    ``members`` has group, node, open; ``sizes`` has group, n_left and n_right,
    the numbers of blocks of the open members (side 0) and of all (side 1).
    Every pair of blocks meets under its (group, i, j).
    """
    joined = members.join(sizes, "group")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    own = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    left = joined.filter("open").select("group", own("n_left", 1).alias("i"), each("n_right").alias("j"), F.lit(0).cast("bigint").alias("side"), "node", *payload)
    right = joined.select("group", each("n_left").alias("i"), own("n_right", 2).alias("j"), F.lit(1).cast("bigint").alias("side"), "node", *payload)
    return left.unionByName(right).repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side", "node")


def _split_buckets(crowd: DataFrame, most: int) -> DataFrame:
    """Links within crowded buckets, no one of which is held by one task; crowd has bucket, node and numbers."""
    first = crowd.groupBy("bucket").agg(F.min(F.struct("node", *NUMBERS)).alias("first"))
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"first.{c}"))) for c in NUMBERS), F.lit(0))
    led = crowd.join(first, "bucket").select(
        F.col("bucket").alias("parent"), "node", *NUMBERS, F.col("first.node").alias("b"), (differ > WIDE_RADIUS).alias("open")
    )
    led = written(led)
    found = led.filter("not open and node <> b").select(F.col("node").alias("a"), "b")
    mixed = led.filter("open").select("parent").distinct()
    cut = bucketed(led.join(mixed, "parent", "left_semi").drop("b"), CUT_BITS, CUT_FOUND, "parent")
    cut = written(cut.select(F.col("bucket").alias("group"), "node", *NUMBERS, "open"))
    blocks = lambda n: F.ceil(n / most).cast("bigint")
    sizes = cut.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("n_open")).filter("n > 1 and n_open > 0")
    sizes = written(sizes.select("group", blocks(F.col("n_open")).alias("n_left"), blocks(F.col("n")).alias("n_right")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_buckets((np.column_stack([np.asarray(c) for c in b.columns]) for b in batches), 3):
            pairs = bucket_numbers(rows, 3)
            rows = rows[np.lexsort((rows[:, 4], -rows[:, 3], pairs))]  # of each pair of blocks, all members first
            side, fps = rows[:, 3], np.ascontiguousarray(rows[:, 5:]).view("uint64")
            ends = np.flatnonzero(np.append(np.diff(pairs) > 0, True)) + 1
            starts = np.append(0, ends[:-1])
            left = np.flatnonzero(side == 0)
            low = starts[pairs[left]]
            high = low + np.bincount(pairs, side, len(starts)).astype("int64")[pairs[left]]
            i, j = _pairs(fps, planes(fps), left, low, high, WIDE_RADIUS)
            yield linked(*forest_of(rows[i, 4], rows[j, 4]))

    return found.unionByName(arrow(in_blocks(cut, sizes, NUMBERS), run, "a bigint, b bigint"))


def forest_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the same components as the links (a, b) of names do."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    return forest(names, at[: len(a)], at[len(a) :])


def few_links(classes: DataFrame) -> DataFrame:
    """Links a, b between small sets that share a key, through the least node of the key."""
    keyed = classes.filter("few is not null").select("node", F.explode("few").alias("key"))
    least = keyed.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b <> last")
    return keyed.join(least, "key").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def wide_links(classes: DataFrame, most: int = MOST) -> DataFrame:
    """Links a, b that span the components of nodes with near wide fingerprints; classes has node, numbers and maybe few."""
    dealt = bucketed(classes.select("node", *NUMBERS), KEY_BITS, FOUND)
    crowds = written(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("bucket"))
    if crowds.isEmpty():
        found = _within_buckets(dealt)
    else:
        found = _within_buckets(dealt.join(crowds, "bucket", "left_anti"))
        found = found.unionByName(_split_buckets(written(dealt.join(crowds, "bucket")), most))
    return found.unionByName(few_links(classes)) if "few" in classes.columns else found


def text_key() -> list[Column]:
    """What tells rows apart, up to copies of id and text; docs has text_hash."""
    return [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash")]


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, hashes (binary): the sorted shingle set of each node; nodes has node and first, the key of a row that has it."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [np.unique(shingles(t, WIDE_WORDS)).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "hashes"])

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).select(*text_key(), "text")
    found = keyed.join(nodes.select("node", "first.*"), ["none", "id", "text_hash"]).select("node", "text")
    return map_batches(found, "node bigint, hashes binary", work).dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, same: whether the shingle sets of each pair have a similarity of 0.8 or more."""
    # a hot node's set is repeated, for each TOGETHER of its pairs
    hot = pairs.groupBy("a").agg((F.count(F.lit(1)) / TOGETHER).cast("bigint").alias("more")).filter("more > 0")
    hot = written(hot)
    more = F.coalesce("more", F.lit(0))
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), more + 1).alias("part"))
    left = sets.withColumnRenamed("node", "a").join(hot, "a", "left")
    left = left.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), more)).alias("part"), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, "uint64"), np.frombuffer(y, "uint64")
            both = len(np.intersect1d(x, y, assume_unique=True))
            same.append(5 * both >= 4 * (len(x) + len(y) - both))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], ["a", "b", "same"])

    whole = dealt.join(left, ["a", "part"]).join(right, "b").select("a", "b", "left", "right")
    return written(map_batches(whole, "a bigint, b bigint, same boolean", work))


def similar_sets(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of sets with a similarity of 0.8 or more; common members are counted by products of 0/1 matrices."""
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    values, at = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    on_left = owner < len(left)
    shared = (np.bincount(at[on_left], minlength=len(values)) > 0) & (np.bincount(at[~on_left], minlength=len(values)) > 0)
    place = np.cumsum(shared) - 1
    keep = shared[at]
    column, owner = place[at[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(left), len(right)), "float32")
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(left) + len(right), 4096), "float32")
        part[owner[a:b], column[a:b] - start] = 1
        both += part[: len(left)] @ part[len(left) :].T
    return np.nonzero(5 * both >= 4 * (sizes[0][:, None] + sizes[1][None] - both))


def _similar_in_blocks(members: DataFrame) -> DataFrame:
    """Links of similarity 0.8 or more that span what the open members of groups have; members has hashes."""
    n, size, open_ = F.count(F.lit(1)), F.sum(F.length("hashes")), F.col("open")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("bigint")
    open_size = F.coalesce(F.sum(F.when(open_, F.length("hashes"))), F.lit(0))
    sizes = members.groupBy("group").agg(blocks(F.count_if(open_), open_size).alias("n_left"), blocks(n, size).alias("n_right"), n.alias("n"))
    sizes = written(sizes.filter("n > 2").drop("n"))  # of two, the pair is known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            for at, (side, node, hashes) in zip(keys, zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True), strict=True):
                if at != key:
                    if sides[0] and sides[1]:
                        yield found(*sides)
                    key, sides = at, ([], [])
                sides[side].append((node, np.frombuffer(hashes, "uint64")))
        if sides[0] and sides[1]:
            yield found(*sides)

    def found(left: list, right: list) -> pa.RecordBatch:
        i, j = similar_sets([x[1] for x in left], [x[1] for x in right])
        names = [np.array([x[0] for x in side], "int64") for side in (left, right)]
        return linked(*forest_of(names[0][i], names[1][j]))

    return arrow(in_blocks(members, sizes, ["hashes"]), run, "a bigint, b bigint")


def wide_components(docs: DataFrame, classes: DataFrame, most: int = MOST) -> DataFrame:
    """node, root: components of nodes that links of similarity 0.8 or more join; classes has node, numbers, few, first.

    Fingerprints propose; shingle sets decide. Near fingerprints form components
    first. All nodes of one are compared with its least node; where all are
    similar to it, that is all. In the others, the nodes that are not similar to
    it are compared with all of the component.
    """
    stars = written(label_components(contracted(wide_links(classes, most))))
    nodes = stars.select("node").unionByName(stars.select(F.col("root").alias("node"))).distinct()
    sets = written(shingle_sets(docs, classes.join(nodes, "node").select("node", "first")))
    checked = compared(stars.select(F.col("root").alias("a"), F.col("node").alias("b")), sets)
    links = checked.filter("same").select("a", "b")
    mixed = written(checked.filter("not same").select(F.col("a").alias("group")).distinct())
    if not mixed.isEmpty():
        members = checked.join(mixed, F.col("a") == F.col("group")).select("group", F.col("b").alias("node"), (~F.col("same")).alias("open"))
        members = members.unionByName(mixed.select("group", F.col("group").alias("node"), F.lit(False).alias("open")))
        links = links.unionByName(_similar_in_blocks(written(members.join(sets, "node"))))
    return label_components(contracted(links))


def wide_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' prints; of each node its print and the first row that has it, null ids last."""
    prints = written(wide_prints(docs))
    own = [F.first(c).alias(c) for c in (*NUMBERS, "few")]
    return prints, written(prints.groupBy("node").agg(*own, F.min(F.struct(*text_key())).alias("first")))


def keep_one(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Of each group of near duplicates one row: by order of doc_id (nulls last), text hash and text."""
    names = docs.columns
    _, classes = wide_classes(docs)
    roots = wide_components(docs, classes, most)
    named = classes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "first")
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    none, id_, hash_, row = unused(names, "none", "id", "hash", "row")
    keyed = docs.withColumns({none: F.col("doc_id").isNull(), id_: F.coalesce("doc_id", F.lit(0)), hash_: F.xxhash64("text")})
    found = keyed.join(kept.toDF(none, id_, hash_), [none, id_, hash_], "left_semi")
    first = Window.partitionBy(none, id_, hash_).orderBy("text")  # what is left are copies of id and text
    return found.withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1).select(*names)
