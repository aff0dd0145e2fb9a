"""Language-model scoring by logistic context mixing.

A text is a sequence of tokens, lower-cased words and one end. A token is
spelt as bytes and a stop; a byte is a path in a binary tree (a Huffman tree of
byte frequencies), so every token is a sequence of bits. Several predictors
give each bit's probability, each from counts kept under a hash of its context
and of the place in the tree: the last 1, 2, 3 and 4 bytes of the word, and the
whole word so far. Their logits are added with weights that a gate selects, by
how often the longest contexts were seen. The counts are over every occurrence
of the training tokens, and every occurrence trains the weights online, in
small steps and itself taken out of the counts, so that the mixer knows how far
a context can be trusted on new words. This is done in ``GROUPS`` parts: the
occurrences of a token are dealt evenly to them, and in a part to its steps;
those in one step are spelt once, with their number as weight, as contexts stay
within a word and all give the same step. A gate's weights are then averaged over the parts by how many bits
each has seen, so the model does not depend on the cluster. A refinement maps
the mixed logit, under the same gate, to the probability that was met in
training. The spelling, which knows any token, is mixed with the tokens' own frequencies, and gets the weight
that tokens seen once have (Good and Turing's estimate of the unseen).

Documents adapt: a token that the document has used before gets probability
from the document's own past. And contexts cross words: a text is cut into
segments, at its start and wherever the hash of the last three tokens says so.
What followed the same context in *other* training documents, and how often,
predicts the whole segment; it is mixed with the product of the tokens'
probabilities, by a weight that a gate selects from the number of times the
context was seen, learnt from the training documents. So passages and documents
that occur again are scored apart. A document is left out of the counts that
predict its own segments.

All probabilities are proper: bits sum to one at each branch, frequencies sum
to one, the weight of a document's past depends on the position only, and a
segment ends where its own tokens say, so no segment begins another.

What the corpus gives: the count of every distinct training token and of every
segment after its context, gathered by shuffles that grow with the input; and
from the tokens the spelling contexts' counts, a table of fixed size. For the
counts and the scores each distinct token is spelt once. Documents look the ``HEAD`` most frequent tokens
up in a table of bounded size; all others are joined.

Defined cases: a null text is an empty one, of one token, the end; a null
doc_id is in the training part; equal texts of the same part have equal scores;
without training rows all counts are 0; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import arrow, remainder, slices, written

#: Contexts: bytes of the word that each predictor sees; 0 stands for the whole word so far.
ORDERS = (1, 2, 3, 4, 0)
#: Slots of one predictor's table, as a power of two; slots in a row when tables are added up.
SLOT_BITS = 20
ROW_SLOTS = 1 << 13
#: Most frequent tokens kept in each worker.
HEAD = 1 << 18
#: Parts in which the mixer is trained, tokens (occurrences) of a step at least, rate; a part of few tokens is gone over until it has SEEN.
GROUPS, MIXER_STEP, MIXER_RATE, SEEN = 64, 500, 0.02, 30_000
#: A part takes LEAST_STEPS steps, or more of LARGEST_STEP tokens; a gate moves by its mean gradient times LARGEST_MOVE at most.
LEAST_STEPS, LARGEST_STEP, LARGEST_MOVE = 100, 16_384, 0.5
#: Tokens whose spellings one task counts.
SPELT = 500_000
#: Tokens of a segment's context; one place in so many begins a segment, unless its context stood in the last NEAR places.
CONTEXT, EVERY, NEAR = 3, 32, 16
#: Gates of the segments' weights: bit lengths of the context's count, and the start.
START_GATE = 16
#: Weight of a document's own past at most, and the tokens after which half of it is reached.
PAST, PAST_HALF = 0.15, 100
#: Counts kept in a worker before they are handed on.
COUNTED = 300_000
STOP = 0x20
#: Bytes of a shared prefix that are spelt once for several tokens.
SHARED = 24
PRIME = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only), split at ASCII white space; the end is the empty token."""
    words = (text or "").encode().lower().split()
    words.append(b"")
    return words


# ---------------------------------------------------------------- bits and contexts


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and length for each of 256 byte values."""
    heap = [(float(c) + 0.5, b, (b,)) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    length, code = np.zeros(256, "int64"), np.zeros(256, "int64")
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for bit, part in ((0, a[2]), (1, b[2])):
            at = list(part)
            code[at] |= bit << length[at]
            length[at] += 1
        heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
    return code, length


@dataclass
class Bits:
    """The bits of some tokens in order."""

    bit: np.ndarray
    slots: np.ndarray  # [predictor, bit]
    starts: np.ndarray  # of each token, or of each byte where bytes were picked


def laid(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens with STOP after each, where each token starts, and its size with the stop."""
    sizes = np.fromiter(map(len, tokens), "int64", len(tokens)) + 1
    return np.frombuffer(b" ".join(tokens) + b" ", "uint8"), np.cumsum(sizes) - sizes, sizes


def met_bytes(tokens: list[bytes], times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the tokens to be spelt, and in how many occurrences each is met.

    All contexts are prefixes of the token, so a prefix that a token shares with
    the one before it is spelt once for both; at most SHARED bytes of it, the
    rest is spelt again.
    """
    raw, starts, sizes = laid(tokens)
    same = np.zeros(len(tokens), "int64")
    left = np.arange(1, len(tokens))
    for p in range(SHARED):
        own = raw[starts[left] + p]
        left = left[(own == raw[starts[left - 1] + p]) & (own != STOP)]
        if not len(left):
            break
        same[left] = p + 1
    first = np.arange(len(raw))
    number = np.arange(len(tokens))
    for p in range(int(same.max())):
        inside = np.flatnonzero(same > p)
        first[starts[inside] + p] = starts[np.maximum.accumulate(np.where(same > p, 0, number))[inside]] + p
    kept = np.flatnonzero(first == np.arange(len(raw)))
    return kept, np.bincount(first, np.repeat(times, sizes), len(raw))[kept]


def spelt(tokens: list[bytes], code: np.ndarray, length: np.ndarray, kept: np.ndarray | None = None) -> Bits:
    """The bits of the tokens, or of the bytes ``kept`` alone."""
    raw, starts, sizes = laid(tokens)
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    value = raw.astype("uint64") + np.uint64(1)
    contexts = []
    whole = _running(value, place, starts, sizes)
    recent = np.zeros(len(raw), "uint64")
    for back in range(1, max(ORDERS) + 1):
        before = np.zeros(len(raw), "uint64")
        before[back:] = value[:-back] if back < len(raw) else 0
        before[place < back] = 0
        recent = recent * PRIME + before + np.uint64(back)
        if back in ORDERS:
            contexts.append(recent)
    contexts.append(whole ^ np.uint64(0x5851F42D4C957F2D))
    if kept is not None:
        raw, contexts, starts = raw[kept], [context[kept] for context in contexts], np.arange(len(kept))
    n_bits = length[raw]
    ends = np.cumsum(n_bits)
    of = np.repeat(np.arange(len(raw)), n_bits)
    left = np.repeat(ends, n_bits) - np.arange(int(ends[-1]))  # bits of the byte from this one on
    path = code[raw][of] | np.int64(1) << n_bits[of]
    bit = (path >> (left - 1) & 1).astype("uint8")
    node = ((path >> left).view("uint64") + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    slots = np.empty((len(ORDERS), len(of)), "int64")
    for k, context in enumerate(contexts):
        h = ((context + np.uint64(k)) * PRIME)[of]
        h ^= node
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h >>= np.uint64(64 - SLOT_BITS)
        np.add(h.view("int64"), k << SLOT_BITS, out=slots[k])
    return Bits(bit, slots, (ends - n_bits)[starts])


def _running(value: np.ndarray, place: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each token's bytes before each place."""
    powers = np.cumprod(np.full(int(place.max()) + 1, PRIME | np.uint64(1), "uint64"))
    total = np.cumsum(value * powers[place])
    before = total - value * powers[place]
    return before - np.repeat(before[starts], sizes)


# ---------------------------------------------------------------- the model


def stretch_counts(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (n - ones + 0.4)).astype("float32")


def confidence(n: np.ndarray) -> np.ndarray:
    """0 for unseen, then the bit length of the count, 7 at most."""
    return np.minimum(7, np.ceil(np.log2(n + 1))).astype("uint8")


def gate(sure: np.ndarray | dict[int, np.ndarray]) -> np.ndarray:
    """The weight set for each bit, from the confidence of the whole-word, order-4 and order-2 contexts."""
    return (sure[4].astype("int64") * 8 + sure[3]) * 3 + np.minimum(sure[1] // 3, 2)


def gates_of(sure: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The gate of each bit, ``sure`` being that of each slot."""
    return gate({k: sure[slots[k]] for k in GATED})


GATES = 8 * 8 * 3
GATED = (1, 3, 4)  # predictors whose confidence the gate asks
STEPS = 33  # of the refinement, over logits from -8 to 8


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Mixer:
    code: np.ndarray
    length: np.ndarray
    logits: np.ndarray  # of each slot
    sure: np.ndarray
    weights: np.ndarray  # [gate, predictor]
    refined: np.ndarray  # [gate, step]: probability met at that logit

    def probability(self, logits: np.ndarray, gates: np.ndarray) -> np.ndarray:
        """Of a one, for logits [predictor, bit]."""
        mixed = np.einsum("kb,bk->b", logits, self.weights[gates])
        p = squash(mixed)
        at = np.clip((mixed + 8) * ((STEPS - 1) / 16), 0, STEPS - 1.001)
        low = at.astype("int64")
        share = at - low
        refined = self.refined[gates, low] * (1 - share) + self.refined[gates, low + 1] * share
        return np.clip((p + refined) / 2, 1e-6, 1 - 1e-6)

    def log10(self, tokens: list[bytes]) -> np.ndarray:
        """log10 probability of each token."""
        if not tokens:
            return np.zeros(0)
        bits = spelt(tokens, self.code, self.length)
        p = self.probability(self.logits[bits.slots], gates_of(self.sure, bits.slots))
        return np.add.reduceat(np.log10(np.where(bits.bit == 1, p, 1 - p)), bits.starts)


@dataclass
class Trained:
    """What one part of the tokens has taught: weights, bits seen by gate, and ones and visits by gate and step."""

    weights: np.ndarray
    seen: np.ndarray
    hits: np.ndarray
    met: np.ndarray


def dealt_steps(times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deals the occurrences of tokens to steps, those of a token evenly: tokens in order of steps, their weights, each step's first."""
    total = int(times.sum())
    steps = max(1, -(-total // min(max(MIXER_STEP, total // LEAST_STEPS), LARGEST_STEP)))
    shown = np.minimum(times, steps)
    who = np.repeat(np.arange(len(times)), shown)
    at = ((_within(shown) + (who * 0.6180339887) % 1) * (steps / shown[who])).astype("int64")
    order = np.argsort(at, kind="stable")
    nth = np.arange(len(who)) - np.repeat(np.cumsum(shown) - shown, shown)
    weight = times[who] // shown[who] + (nth < times[who] % shown[who])
    return who[order], weight[order], np.searchsorted(at[order], np.arange(steps + 1))


def without_one(ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each slot says to an occurrence that is taken out of its counts: logits by slot and bit, and the confidence."""
    here = np.maximum(n - 1, 0)
    logits = np.empty((len(n), 2), "float32")
    for bit in (0, 1):
        logits[:, bit] = stretch_counts(np.clip(ones - bit, 0, here), here)
    return logits.ravel(), confidence(here)


def train_part(code, length, ones: np.ndarray, n: np.ndarray, tokens: list[bytes], times: np.ndarray | None = None) -> Trained:
    """Online over every occurrence of the tokens, ``times`` of each (once if not given), itself taken out of the counts."""
    return train(code, length, *without_one(ones, n), tokens, np.ones(len(tokens), "int64") if times is None else times)


def train(code, length, logits_of: np.ndarray, sure: np.ndarray, tokens: list[bytes], times: np.ndarray) -> Trained:
    """As ``train_part``, from what ``without_one`` gives. Bits that tokens of a step share are computed once, so sorted tokens take less time."""
    out = Trained(np.full((GATES, len(ORDERS)), 0.3), np.zeros(GATES), np.zeros((GATES, STEPS)), np.zeros((GATES, STEPS)))
    who, weight, cuts = dealt_steps(times)
    rounds = max(1, min(30, SEEN // max(1, int(times.sum()))))
    for round_ in range(rounds):
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            if at == end:
                continue
            step = [tokens[i] for i in who[at:end].tolist()]
            kept, met = met_bytes(step, weight[at:end])
            bits = spelt(step, code, length, kept)
            many = np.repeat(met, np.diff(np.append(bits.starts, len(bits.bit))))
            gates = gates_of(sure, bits.slots)
            bits.slots <<= 1
            bits.slots += bits.bit
            logits = logits_of[bits.slots]
            mixed = np.zeros(len(gates))
            for k in range(len(ORDERS)):
                mixed += logits[k] * out.weights[:, k][gates]
            error = (bits.bit - squash(mixed)) * many
            seen = np.bincount(gates, many, GATES)
            move = np.minimum(MIXER_RATE * seen**0.5, LARGEST_MOVE) / np.maximum(seen, 1)
            for k in range(len(ORDERS)):
                out.weights[:, k] += np.bincount(gates, error * logits[k], GATES) * move
            if round_ == rounds - 1:
                out.seen += seen
                spot = np.clip(np.rint((mixed + 8) * ((STEPS - 1) / 16)), 0, STEPS - 1).astype("int64")
                flat = gates * STEPS + spot
                out.hits += np.bincount(flat, bits.bit * many, GATES * STEPS).reshape(GATES, STEPS)
                out.met += np.bincount(flat, many, GATES * STEPS).reshape(GATES, STEPS)
    return out


def merged_mixer(code, length, ones: np.ndarray, n: np.ndarray, parts: Iterable[Trained]) -> Mixer:
    """The mixer of all parts: a gate's weights averaged by the bits that each part has seen there. Parts are not kept."""
    plain = np.tile(squash(np.linspace(-8, 8, STEPS)), (GATES, 1))
    weights, seen = np.zeros((GATES, len(ORDERS))), np.zeros(GATES)
    hits, met = plain * 20, np.full((GATES, STEPS), 20.0)
    for part in parts:
        weights += part.weights * part.seen[:, None]
        seen += part.seen
        hits += part.hits
        met += part.met
    weights = np.where(seen[:, None] > 0, weights / np.maximum(seen, 1)[:, None], 0.3)
    return Mixer(code, length, stretch_counts(ones, n), confidence(n), weights, hits / met)


# ---------------------------------------------------------------- over the corpus


def count_tokens(docs: DataFrame) -> DataFrame:
    """token, c: every distinct token and its count in training rows; docs has training and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for part in slices(batch):
                for training, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if training:
                        held.update(tokens_of(text))
                    else:
                        for token in set(tokens_of(text)):
                            held.setdefault(token, 0)
                if len(held) > COUNTED:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    def out(held: Counter[bytes]) -> pa.RecordBatch:
        arrays = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["token", "c"])

    counted = arrow(docs.select("training", "text"), run, "token binary, c bigint")
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


def context_counts(vocabulary: DataFrame, code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ones and visits of every slot, over every occurrence of the training tokens; tables of fixed size, added by rows of slots."""
    size = len(ORDERS) << SLOT_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, size))
        for batch in batches:
            for part in slices(batch, 200_000):
                bits = spelt(part.column(0).to_pylist(), code, length)
                times = np.repeat(np.asarray(part.column(1)), np.diff(np.append(bits.starts, len(bits.bit))))
                for k in range(len(ORDERS)):
                    own = slice(k << SLOT_BITS, (k + 1) << SLOT_BITS)
                    at = bits.slots[k] - (k << SLOT_BITS)
                    tables[0, own] += np.bincount(at, bits.bit * times, 1 << SLOT_BITS)
                    tables[1, own] += np.bincount(at, times, 1 << SLOT_BITS)
        rows = tables.reshape(2, -1, ROW_SLOTS)
        for at in range(0, rows.shape[1], 64):
            places = np.flatnonzero(rows[1, at : at + 64].any(axis=1)) + at
            arrays = [pa.array(places, pa.int64())]
            arrays += [pa.array([rows[t, p].tobytes() for p in places], pa.binary()) for t in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "ones", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held = None, None
        for batch in batches:
            for place, ones, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.stack([np.frombuffer(ones), np.frombuffer(n)])
                if place == row:
                    held = held + own
                    continue
                if row is not None:
                    yield out(row, held)
                row, held = place, own
        if row is not None:
            yield out(row, held)

    def out(row: int, held: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([row], pa.int64()), *[pa.array([t.astype("float32").tobytes()], pa.binary()) for t in held]]
        return pa.RecordBatch.from_arrays(arrays, ["row", "ones", "n"])

    schema = "row bigint, ones binary, n binary"
    training = vocabulary.filter("c > 0").select("token", "c")
    parts = arrow(training.coalesce(max(1, -(-training.count() // SPELT))), run, schema)
    summed = arrow(parts.repartition("row").sortWithinPartitions("row"), add, schema)
    tables = np.zeros((2, size), "float32")
    for r in summed.toLocalIterator():
        own = slice(r["row"] * ROW_SLOTS, (r["row"] + 1) * ROW_SLOTS)
        tables[0, own], tables[1, own] = np.frombuffer(r["ones"], "float32"), np.frombuffer(r["n"], "float32")
    return tables[0], tables[1]


def byte_counts(training: DataFrame) -> np.ndarray:
    """How often each byte, and the stop, stands in the distinct training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(256, "int64")
        for batch in batches:
            for part in slices(batch):
                counts += np.bincount(np.frombuffer(b" ".join(part.column(0).to_pylist()) + b" ", "uint8"), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(counts)], ["value", "n"])

    out = np.zeros(256, "int64")
    for r in arrow(training.select("token"), run, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n")).collect():  # 256 rows
        out[r["value"]] = r["n"]
    return out


def fit(vocabulary: DataFrame) -> Mixer:
    """The model of the training tokens, every occurrence of which trains it."""
    training = vocabulary.filter("c > 0")
    code, length = huffman(byte_counts(training))
    ones, n = context_counts(vocabulary, code, length)
    shared = vocabulary.sparkSession.sparkContext.broadcast((code, length, *without_one(ones, n)))
    names = ["weights", "seen", "hits", "met"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, times = None, [], []
        for batch in batches:
            for g, token, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != group:
                    if held:
                        yield out(held, times)
                    group, held, times = g, [], []
                held.append(token)
                times.append(many)
        if held:
            yield out(held, times)

    def out(tokens: list[bytes], times: list[int]) -> pa.RecordBatch:
        made = train(*shared.value, tokens, np.array(times))
        return pa.RecordBatch.from_arrays([pa.array([getattr(made, x).astype("float64").tobytes()], pa.binary()) for x in names], names)

    place = F.xxhash64("token")
    groups = max(GROUPS, -(-training.count() // SPELT))
    part = F.explode(F.sequence(F.lit(0), F.least(F.col("c"), F.lit(groups)).cast("int") - 1)).alias("part")  # each has an even share
    # tokens in order share prefixes with the one before; most are told apart by a number, which needs no copies of bytes
    start = F.expr("cast(conv(hex(rpad(substring(token, 1, 7), 7, x'00')), 16, 10) as bigint)").alias("start")
    dealt = training.select("token", "c", place.alias("place"), start, part)
    share = (F.floor(F.col("c") / groups) + (F.col("part") < F.col("c") % groups).cast("int")).cast("bigint")
    dealt = dealt.select(F.pmod(F.pmod("place", F.lit(groups)) + F.col("part"), F.lit(groups)).alias("g"), "token", share.alias("share"), "start")
    dealt = dealt.repartition("g").sortWithinPartitions("g", "start", "token").select("g", "token", "share")
    rows = written(arrow(dealt, run, ", ".join(f"{x} binary" for x in names))).toLocalIterator()  # read a part at a time
    shapes = ((GATES, len(ORDERS)), (GATES,), (GATES, STEPS), (GATES, STEPS))
    parts = (Trained(*(np.frombuffer(r[x]).reshape(shape) for x, shape in zip(names, shapes, strict=True))) for r in rows)
    return merged_mixer(code, length, ones, n, parts)


def score_tokens(vocabulary: DataFrame, mixer: Mixer, total: int, distinct: int, once: int) -> DataFrame:
    """token, c, base, lm: log10 probabilities of every distinct token; ``once`` training tokens were seen once."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(mixer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 100_000):
                c = np.asarray(part.column(1))
                lm = token_log10(shared.value.log10(part.column(0).to_pylist()), c, total, once)
                base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base), pa.array(lm)], ["token", "c", "base", "lm"])

    return arrow(vocabulary.select("token", "c"), run, "token binary, c bigint, base double, lm double")


def token_log10(spelling: np.ndarray, c: np.ndarray, total: int, once: int) -> np.ndarray:
    """Spelling and frequency, mixed by Good and Turing's weight of the unseen."""
    unseen = (once + 1) / (total + 2)
    new, known = np.log10(unseen) + spelling, np.log10(np.maximum((1 - unseen) * c / max(total, 1), 1e-300))
    high, low = np.maximum(new, known), np.minimum(new, known)
    return high + np.log10(1 + 10 ** (low - high))


def head_of(scored: DataFrame, most: int) -> pa.Table:
    """The most frequent tokens, ``most`` at most: all those above a count that a histogram of log counts gives."""
    steps = (F.floor(F.log2(F.col("c") + 1) * 16)).cast("int")
    histogram = scored.groupBy(steps.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # under a thousand rows
    left, lowest = most, None
    for row in sorted(histogram, key=lambda r: -r["step"]):
        left -= row["n"]
        if left < 0:
            break
        lowest = row["step"]
    chosen = scored.filter(steps >= lowest) if lowest is not None else scored.limit(0)
    return chosen.toArrow()


# ---------------------------------------------------------------- segments


def stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def contexts_of(hashes: np.ndarray) -> np.ndarray:
    """A hash of the CONTEXT tokens before each place; the first places have what stands before the array."""
    out = np.zeros(len(hashes), "uint64")
    for back in range(1, CONTEXT + 1):
        factor = (int(PRIME) * (2 * back + 1) & 0xFFFFFFFFFFFFFFFF) | 1
        out[back:] += hashes[:-back] * np.uint64(factor)
    return stirred(out)


def segment_starts(contexts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Places that begin a segment; ``index`` is a token's place in its document."""
    start = (contexts & np.uint64(EVERY - 1) == 0) & (index >= CONTEXT)
    at = np.flatnonzero(start)
    for back in range(1, NEAR + 1):
        at = at[(index[at] < CONTEXT + back) | (contexts[at] != contexts[np.maximum(at - back, 0)])]
    start = index == 0
    start[at] = True
    return np.flatnonzero(start)


def segment_names(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each segment's tokens in order."""
    sizes = np.diff(np.append(starts, len(hashes)))
    return stirred(np.add.reduceat(stirred(hashes + PRIME * _within(sizes).astype("uint64")), starts))


def documents_pass(docs: DataFrame, head: tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Three kinds of rows: for each document its sums, for each segment its head tokens' sums, and rare tokens.

    A document has segment -1 in its row. ``uid`` ties them together. It is made
    in the pass, so the result must be written before it is used twice.
    """
    import xxhash

    shared = docs.sparkSession.sparkContext.broadcast(head)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = {
        "uid": "bigint", "segment": "int", "doc_id": id_type, "held_out": "boolean", "n_tokens": "bigint", "n_bytes": "bigint",
        "n_known": "bigint", "base": "double", "lm": "double", "context": "bigint", "name": "bigint", "own_context": "bigint",
        "own_name": "bigint", "token": "binary", "n": "bigint", "past": "array<double>",
    }
    arrow_kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}

    def rows(count: int, id_kind: pa.DataType, **columns: object) -> pa.RecordBatch:
        arrays = []
        for name, kind in kinds.items():
            own = id_kind if name == "doc_id" else arrow_kinds[kind]
            value = columns.get(name)
            arrays.append(pa.nulls(count, own) if value is None else value if isinstance(value, pa.Array) else pa.array(value, own))
        return pa.RecordBatch.from_arrays(arrays, list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, *values = shared.value
        known, base, lm = (np.append(v, np.nan) for v in values)
        place = dict(zip(words, range(len(words)), strict=True)).get
        outside = len(words)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, 1_000_000):
                n, id_kind = part.num_rows, part.column(0).type
                texts = part.column(2).to_pylist()
                local: dict[bytes, int] = {}
                ids, sizes = [], []
                for text in texts:
                    tokens = tokens_of(text)
                    sizes.append(len(tokens))
                    ids += [local.setdefault(t, len(local)) for t in tokens]
                vocabulary = list(local)
                at = np.fromiter((place(t, outside) for t in vocabulary), "int64", len(vocabulary))
                names = np.fromiter((xxhash.xxh64_intdigest(t) for t in vocabulary), "uint64", len(vocabulary))
                ids, sizes = np.array(ids), np.array(sizes)
                doc = np.repeat(np.arange(n), sizes)
                index = _within(sizes)
                odds, order, heads, times = past_odds(doc * len(vocabulary) + ids, index)
                spot = at[ids]
                inside = spot < outside
                past = PAST * index / (index + PAST_HALF)
                gain = np.log10(1 - past)
                gain[inside] += lm[spot[inside]] + log10_gain(odds[inside], lm[spot[inside]])

                uids = np.arange(uid, uid + n)
                uid += n
                n_known = np.bincount(doc[inside], known[spot[inside]], n).astype("int64")
                bases = np.bincount(doc[inside], base[spot[inside]], n)
                n_bytes = [len((t or "").encode()) for t in texts]
                yield rows(n, id_kind, uid=uids, segment=np.full(n, -1), doc_id=part.column(0), held_out=part.column(1),
                           n_tokens=sizes, n_bytes=n_bytes, n_known=n_known, base=bases)

                hashes = names[ids]
                contexts = contexts_of(hashes)
                starts = segment_starts(contexts, index)
                contexts = np.where(index[starts] == 0, np.uint64(0), contexts[starts] | np.uint64(1))  # 0: the start
                segment_names_ = segment_names(hashes, starts)
                segment = np.cumsum(np.bincount(starts, minlength=len(ids))) - 1  # of each token
                owner = doc[starts]
                first_segment = np.searchsorted(owner, np.arange(n))
                number = (np.arange(len(starts)) - first_segment[owner]).astype("int32")
                yield rows(len(starts), id_kind, uid=uids[owner], segment=number, held_out=part.column(1).take(pa.array(owner)),
                           lm=np.add.reduceat(gain, starts), context=contexts.view("int64"), name=segment_names_.view("int64"),
                           own_context=times_in(owner, contexts), own_name=times_in(owner, contexts, segment_names_))

                rare = np.flatnonzero(~inside[order[heads]])
                if not len(rare):
                    continue
                # of each rare token of a document a row for each segment that has it
                held = np.repeat(heads[rare], times[rare]) + _within(times[rare])
                tokens_at = order[held]
                group = np.concatenate([[True], (ids[tokens_at[1:]] != ids[tokens_at[:-1]]) | (segment[tokens_at[1:]] != segment[tokens_at[:-1]])])
                begin = np.flatnonzero(group)
                counts = np.diff(np.append(begin, len(tokens_at)))
                first = tokens_at[begin]
                lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(tokens_at)).astype("int32")), pa.array(odds[tokens_at]))
                yield rows(len(begin), id_kind, uid=uids[doc[first]], segment=number[segment[first]],
                           token=[vocabulary[k] for k in ids[first].tolist()], n=counts, past=lists)

    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    return arrow(docs.select("doc_id", "held_out", "text"), run, schema)


def past_odds(group: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Odds that a document's past gives each of its tokens; then the order that puts equal tokens of a document together.

    ``group`` tells tokens and documents apart. Also the places in that order where a
    token begins, and how often it occurs.
    """
    order = np.argsort(group, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) > 0]))
    times = np.diff(np.append(heads, len(order)))
    prior = np.empty(len(group), "int64")
    prior[order] = np.arange(len(order)) - np.repeat(heads, times)
    past = PAST * index / (index + PAST_HALF)
    return past / (1 - past) * prior / np.maximum(index, 1), order, heads, times


def log10_gain(odds: np.ndarray, lm: np.ndarray) -> np.ndarray:
    """log10(1 + odds / 10 ** lm), for any lm."""
    with np.errstate(divide="ignore"):
        e = np.log10(odds) - lm
    return np.maximum(e, 0) + np.log10(1 + 10 ** -np.abs(e))


def times_in(owner: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """How often each row's keys occur among the rows of its owner."""
    _, at, n = np.unique(np.rec.fromarrays([owner, *keys]), return_inverse=True, return_counts=True)
    return n[at]


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def predicted(segments: DataFrame) -> DataFrame:
    """uid, segment, weight, share: what other training documents say about segments whose context they have.

    ``segments`` has uid, segment, held_out, context, name and the document's own
    counts. ``share`` is how often the segment followed the context, of all that
    did; ``weight`` is how often such a prediction holds.
    """
    learnt = (~F.col("held_out")).cast("bigint")
    starts, others = segments.filter("context = 0"), segments.filter("context <> 0")
    n_documents = starts.agg(F.coalesce(F.sum(learnt), F.lit(0))).first()[0]
    shared = others.groupBy("context").agg(F.count(F.lit(1)).alias("n"), F.sum(learnt).alias("total"))
    shared = written(shared.filter("n > 1 and total > 0").select("context", "total"))
    seen = others.join(shared, "context").unionByName(starts.withColumn("total", F.lit(n_documents).cast("bigint")))
    seen = written(seen.withColumn("learnt", learnt))
    names = written(seen.groupBy("context", "name").agg(F.sum("learnt").alias("c")))
    counted = seen.join(names, ["context", "name"]).select(
        "uid", "segment", "held_out", (F.col("c") - F.col("learnt") * F.col("own_name")).alias("c"),
        (F.col("total") - F.col("learnt") * F.col("own_context")).alias("total"),
        (F.col("context") == 0).alias("first"),
    )
    gate_ = F.when(F.col("first"), START_GATE).otherwise(F.least(F.lit(START_GATE - 1), F.ceil(F.log2(F.col("total") + 1)))).cast("int")
    counted = written(counted.filter("total > 0").withColumn("gate", gate_))
    met = counted.filter("not held_out").groupBy("gate").agg(F.count_if(F.col("c") > 0).alias("hits"), F.count(F.lit(1)).alias("n")).collect()  # 17 rows
    weights = {r["gate"]: (r["hits"] + 0.5) / (r["n"] + 1) for r in met}
    table = F.array(*[F.lit(weights.get(k, 0.5)) for k in range(START_GATE + 1)])
    return counted.select("uid", "segment", F.get(table, "gate").alias("weight"), (F.col("c") / F.col("total")).alias("share"))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every document."""
    held_out = (remainder(F.col("doc_id"), 5) == 1).alias("held_out")
    docs = docs.select("doc_id", held_out, "text")
    vocabulary = written(count_tokens(docs.select((~F.col("held_out")).alias("training"), "text")))
    totals = (F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1))
    total, distinct, once = vocabulary.agg(*totals).first()
    scored = written(score_tokens(vocabulary, fit(vocabulary), total, distinct, once))
    head = head_of(scored, HEAD)
    known = np.asarray(head["c"]) > 0
    values = [known.astype("float64"), np.asarray(head["base"]), np.asarray(head["lm"])]
    passed = written(documents_pass(docs, (head["token"].to_pylist(), *values)))
    more = lambda e: F.greatest(e, F.lit(0.0)) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(e)))  # noqa: E731  as log10_gain
    again = F.aggregate("past", F.lit(0.0), lambda a, odds: a + F.when(odds > 0, more(F.log10(odds) - F.col("lm"))).otherwise(0.0))
    rare = passed.filter("token is not null").select("uid", "segment", "token", "n", "past").join(scored, "token")
    rare = rare.select(
        "uid",
        "segment",
        (F.col("n") * F.col("lm") + again).alias("lm"),
        (F.col("n") * F.col("base")).alias("base"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
    )
    segments = passed.filter("segment >= 0 and token is null")
    mixed = predicted(segments.select("uid", "segment", "held_out", "context", "name", "own_context", "own_name"))
    nothing = F.lit(None).cast("double")
    parts = segments.select("uid", "segment", "lm").withColumns({"base": F.lit(0.0), "n_known": F.lit(0).cast("bigint"), "weight": nothing, "share": nothing})
    parts = parts.unionByName(rare.withColumns({"weight": nothing, "share": nothing}))
    zero = {"lm": F.lit(0.0), "base": F.lit(0.0), "n_known": F.lit(0).cast("bigint")}
    parts = parts.unionByName(mixed.withColumns(zero))
    sums = [F.sum(c).alias(c) for c in ("lm", "base", "n_known")] + [F.max(c).alias(c) for c in ("weight", "share")]
    whole = parts.groupBy("uid", "segment").agg(*sums)
    plain, jump = F.log10(1 - F.col("weight")) + F.col("lm"), F.log10(F.col("weight") * F.col("share"))
    high, low = F.greatest(plain, jump), F.least(plain, jump)
    both = F.when(F.col("share") > 0, high + F.log10(1 + F.pow(F.lit(10.0), low - high))).otherwise(plain)
    lm = F.when(F.col("weight").isNull(), F.col("lm")).otherwise(both)
    whole = whole.groupBy("uid").agg(F.sum(lm).alias("score"), F.sum("base").alias("rare_base"), F.sum("n_known").alias("rare_known"))
    return passed.filter("segment = -1").join(whole, "uid").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("rare_base")).alias("base_score"),
        "score",
        F.when(F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
