from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from candela.llm import context_mixing as lm


def brute_base(rows):
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        own = tokens(r.text)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        out.append((r.doc_id or -1, held(r.doc_id), len(own), sum(counts[w] > 0 for w in own), total, round(base, 5)))
    return sorted(out)


def check(df):
    rows = lm.score_documents(df).collect()
    found = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    assert found == brute_base(df.collect())
    assert all(r.score < 0 for r in rows)
    return rows


def test_base_scores_and_head_does_not_matter(docs, odd, monkeypatch):
    whole = {r.doc_id: r.score for r in check(docs)}
    check(odd)
    monkeypatch.setattr(lm, "HEAD", 50)  # nearly all tokens are joined
    joined = {r.doc_id: r.score for r in check(docs)}
    assert all(math.isclose(whole[k], joined[k], rel_tol=1e-9) for k in whole)


def test_empty_and_untrained(spark, none):
    assert lm.score_documents(none).count() == 0
    rows = spark.createDataFrame([(4, "a b"), (4, None)], "doc_id bigint, text string")
    assert lm.score_documents(rows).count() == 2


def model(words):
    counts = np.bincount(np.frombuffer(b" ".join(words), "uint8"), minlength=256)
    code, length = lm.huffman(counts)
    bits = lm.spelt(words, code, length)
    size = len(lm.ORDERS) << lm.SLOT_BITS
    ones = sum(np.bincount(s, bits.bit, size) for s in bits.slots)
    n = sum(np.bincount(s, minlength=size) for s in bits.slots)
    return lm.merged_mixer(code, length, ones, n, [lm.train_part(code, length, ones, n, words)])


def test_code_is_a_prefix_code():
    code, length = lm.huffman(np.arange(256))
    assert math.isclose(sum(2.0**-n for n in length), 1)
    words = {format(c, f"0{n}b") for c, n in zip(code, length, strict=True)}
    assert len(words) == 256 and not any(a != b and b.startswith(a) for a in list(words)[:40] for b in words)


def test_spelling_is_a_distribution_and_learns():
    mixer = model([f"{a}{b}ing".encode() for a in "abcdefgh" for b in ("at", "ot", "el", "un")] * 3)
    # all one-byte words and the empty word, by the sum over what may follow the first byte, stay below one
    singles = 10 ** mixer.log10([bytes([b]) for b in range(256) if b not in (0x20,)] + [b""])
    assert 0 < singles.sum() < 1
    like, unlike = mixer.log10([b"bating", b"zqxjkv"])
    assert like > unlike + 3


def test_bits_against_a_plain_loop():
    words = [f"{a}{b}ing".encode() for a in "abcd" for b in ("at", "ot", "el")]
    mixer = model(words)
    for word in (b"bating", b"x", b""):
        bits = lm.spelt([word], mixer.code, mixer.length)
        total = 0.0
        for k, bit in enumerate(bits.bit):
            slots = bits.slots[:, k]
            sure = [int(mixer.sure[s]) for s in slots]
            g = (sure[4] * 8 + sure[3]) * 3 + min(sure[1] // 3, 2)
            mixed = sum(mixer.weights[g][i] * float(mixer.logits[s]) for i, s in enumerate(slots))
            at = min(max((mixed + 8) * 2, 0), 31.999)
            refined = mixer.refined[g][int(at)] * (1 - at % 1) + mixer.refined[g][int(at) + 1] * (at % 1)
            p = min(max((1 / (1 + math.exp(-mixed)) + refined) / 2, 1e-6), 1 - 1e-6)
            total += math.log10(p if bit else 1 - p)
        assert math.isclose(total, mixer.log10([word])[0], rel_tol=1e-5)


def mask(x):
    return x & (1 << 64) - 1


def stir(x):
    x = mask((x ^ x >> 30) * 0xBF58476D1CE4E5B9)
    x = mask((x ^ x >> 27) * 0x94D049BB133111EB)
    return x ^ x >> 31


def plain_segments(tokens):
    """(first place, context, tokens) of each segment, by one pass over the text."""
    prime = 0x9E3779B97F4A7C15
    h = [xxhash.xxh64_intdigest(t) for t in tokens]
    contexts = [stir(mask(sum(h[i - b] * (mask(prime * (2 * b + 1)) | 1) for b in (1, 2, 3)))) if i >= 3 else None for i in range(len(h))]
    starts = [0]
    for i in range(3, len(h)):
        if contexts[i] % 32 == 0 and contexts[i] not in contexts[max(3, i - 16) : i]:
            starts.append(i)
    return [(a, contexts[a] | 1 if a else 0, tuple(tokens[a:b])) for a, b in zip(starts, [*starts[1:], len(h)], strict=True)]


def plain_scores(rows, spelling, counts):
    """Scores of (id, held out, text), by loops."""
    total, once = sum(counts.values()), sum(c == 1 for c in counts.values())
    unseen = (once + 1) / (total + 2)
    cut = [plain_segments(lm.tokens_of(text)) for _, _, text in rows]
    after, followed = Counter(), Counter()
    for (_, held, _), parts in zip(rows, cut, strict=True):
        for _, context, tokens in parts:
            followed[context] += not held
            after[context, tokens] += not held
    def counted(parts, held):
        own_context, own = Counter(c for _, c, _ in parts), Counter((c, t) for _, c, t in parts)
        for _, c, t in parts:
            yield after[c, t] - (not held) * own[c, t], followed[c] - (not held) * own_context[c]
    gate = lambda context, n: 16 if context == 0 else min(15, math.ceil(math.log2(n + 1)))
    met = Counter()
    for (_, held, _), parts in zip(rows, cut, strict=True):
        for (_, context, _), (c, n) in zip(parts, counted(parts, held), strict=True):
            if n > 0 and not held:
                met[gate(context, n), c > 0] += 1
    out = []
    for (doc_id, held, _), parts in zip(rows, cut, strict=True):
        score, past, index = 0.0, Counter(), 0
        for (_, context, tokens), (c, n) in zip(parts, counted(parts, held), strict=True):
            p0 = 0.0
            for t in tokens:
                own = unseen * 10 ** spelling[t] + (1 - unseen) * counts.get(t, 0) / total
                weight = 0.15 * index / (index + 100)
                p0 += math.log10((1 - weight) * own + weight * past[t] / max(index, 1))
                past[t] += 1
                index += 1
            if n > 0:
                g = gate(context, n)
                weight = (met[g, True] + 0.5) / (met[g, True] + met[g, False] + 1) if (met[g, True] or met[g, False]) else 0.5
                score += math.log10(weight * c / n + (1 - weight) * 10**p0) if p0 > -300 or c == 0 and p0 > -300 else max(
                    math.log10(weight * c / n) if c else -math.inf, math.log10(1 - weight) + p0)
            else:
                score += p0
        out.append((doc_id, score))
    return dict(out)


def test_scores_against_plain_loops(docs):
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(80).collect()]
    rows += [(10_000 + i, t) for i, t in rows[:9]] + [(20_000 + i, "new start " + t) for i, t in rows[5:20]]
    table = docs.sparkSession.createDataFrame(rows, "doc_id bigint, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, text in rows if not held(i) for t in lm.tokens_of(text))
    vocabulary = lm.count_tokens(table.select((F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 1).alias("training"), "text"))
    mixer = lm.fit(vocabulary)
    every = sorted({t for _, text in rows for t in lm.tokens_of(text)})
    spelling = dict(zip(every, mixer.log10(every).tolist(), strict=True))
    expected = plain_scores([(i, held(i), t) for i, t in rows], spelling, counts)
    got = {r.doc_id: r.score for r in lm.score_documents(table).collect()}
    assert all(math.isclose(got[k], expected[k], rel_tol=1e-6) for k in expected)


def test_held_out_texts_score_above_base_and_copies_apart(docs):
    rows = docs.collect()
    copies = [(100_000 + r.doc_id, r.text) for r in rows if r.text and len(r.text) > 1_500][:30]
    table = docs.sparkSession.createDataFrame([(r.doc_id, r.text) for r in rows] + copies, "doc_id bigint, text string")
    found = {r.doc_id: r for r in lm.score_documents(table).collect()}
    held = [r for r in found.values() if r.held_out]
    assert np.mean([r.score for r in held]) > np.mean([r.base_score for r in held])
    usual = np.quantile([r.bits_per_byte for i, r in found.items() if i < 100_000 and i + 100_000 not in found and r.bits_per_byte], 0.1)
    twice = [found[i] for i, _ in copies if not found[i - 100_000].held_out]  # the other is learnt from
    assert np.mean([r.bits_per_byte < usual for r in twice]) > 0.9


def test_every_occurrence_trains():
    """A token met many times trains by each of them: dealt to all steps, none lost, and the weights differ."""
    times = np.array([40_000, 700, 3, 1, 1, 12_345])
    who, weight, cuts = lm.dealt_steps(times)
    assert np.bincount(who, weight).tolist() == times.tolist()
    steps = len(cuts) - 1
    each = [weight[a:b].sum() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert cuts[-1] == len(who) and steps >= 100 and max(each) < 1.1 * times.sum() / steps
    words = [b"the", b"bating", b"hot", b"zqx", b"kel", b"of"]
    code, length = lm.huffman(np.bincount(np.frombuffer(b" ".join(words), "uint8"), minlength=256))
    bits = lm.spelt(words, code, length)
    many = np.repeat(times, np.diff(np.append(bits.starts, len(bits.bit))))
    size = len(lm.ORDERS) << lm.SLOT_BITS
    ones = sum(np.bincount(s, bits.bit * many, size) for s in bits.slots)
    n = sum(np.bincount(s, many, size) for s in bits.slots)
    part = lm.train_part(code, length, ones, n, words, times)
    assert part.seen.sum() == part.met.sum() == many.sum()


def test_a_prefix_shared_in_a_step_is_computed_once(monkeypatch):
    """Training over what tokens of a step share gives what training over each of them gives, from fewer bits."""
    words = sorted({f"{a}{b}{c}".encode() for a in ("inter", "ins", "x", "") for b in ("act", "ac", "") for c in ("ing", "ed", "s", "")})
    words += [b"x", b"inter" * 9 + b"s", b"inter" * 9 + b"t", b"x"]  # unsorted, repeated, and longer than what is shared
    times = np.arange(len(words)) * 37 % 500 + 1
    code, length = lm.huffman(np.bincount(np.frombuffer(b" ".join(words), "uint8"), minlength=256))
    all_bits = lm.spelt(words, code, length)
    many = np.repeat(times, np.diff(np.append(all_bits.starts, len(all_bits.bit))))
    size = len(lm.ORDERS) << lm.SLOT_BITS
    ones = sum(np.bincount(s, all_bits.bit * many, size) for s in all_bits.slots)
    n = sum(np.bincount(s, many, size) for s in all_bits.slots)

    who, weight, cuts = lm.dealt_steps(times)
    weights, seen, spelt = np.full((lm.GATES, len(lm.ORDERS)), 0.3), np.zeros(lm.GATES), 0
    rounds = lm.SEEN // int(times.sum())
    assert 0 < rounds < 30
    for round_ in range(rounds):
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            move, met = np.zeros_like(weights), np.zeros(lm.GATES)
            for i, w in zip(who[at:end], weight[at:end], strict=True):
                bits = lm.spelt([words[i]], code, length)
                here = np.maximum(n[bits.slots] - 1, 0)
                logits = lm.stretch_counts(np.clip(ones[bits.slots] - bits.bit, 0, here), here)
                gates = lm.gate(lm.confidence(here))
                error = w * (bits.bit - lm.squash((logits.T * weights[gates]).sum(axis=1)))
                np.add.at(move, gates, (error * logits).T)
                np.add.at(met, gates, w)
                spelt += len(bits.bit)
            rate = np.minimum(lm.MIXER_RATE * met**0.5, lm.LARGEST_MOVE) / np.maximum(met, 1)
            weights += move * rate[:, None]
            seen += met if round_ == rounds - 1 else 0

    computed = []
    squash = lm.squash
    monkeypatch.setattr(lm, "squash", lambda x: computed.append(len(x)) or squash(x))
    part = lm.train_part(code, length, ones, n, words, times)
    assert np.allclose(part.weights, weights, rtol=1e-9) and part.seen.tolist() == seen.tolist()
    assert sum(computed) < 0.7 * spelt


def test_counts_and_training_are_over_occurrences(spark):
    rows = [("hot " * 900 + "zqx",), ("bating hot kel",)]
    docs = spark.createDataFrame(rows, "text string").select(F.lit(True).alias("training"), "text")
    mixer = lm.fit(lm.count_tokens(docs))
    hot, rare = mixer.log10([b"hot", b"kel"])
    assert hot > math.log10(0.8) and rare < hot - 1
