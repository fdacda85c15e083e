"""The language model's score against a plain version: dictionaries of counts and one bit after the other."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import lm

MASK = (1 << 64) - 1


def slot_of(x):
    return (x & MASK) * 0xD6E8FEB86659FD93 % (1 << 64) >> 64 - lm.BITS


def word_contexts(before, end):
    """``before``: the symbols before the one that is coded."""
    three, two, one = [s + 1 for s in ([end] * 3 + before)[-3:]]
    pair = one * 0x9E3779B97F4A7C15 & MASK ^ two
    return [0, slot_of(two + (1 << 40)), slot_of(pair * 0xBF58476D1CE4E5B9 & MASK ^ three), slot_of(one + (1 << 41)), slot_of(pair)]


def byte_contexts(before, end):
    last = [0] * 6 + before
    orders = [slot_of(sum(b << 8 * i for i, b in enumerate(last[: -k - 1 : -1])) + (k << 50)) for k in lm.ORDERS]
    return [*orders, slot_of(sum((b + 7) * pow(0x2545F4914F6CDD1D, i, 1 << 64) for i, b in enumerate(before)) + (5 << 40))]


def coded_bits(code, contexts, symbols, end):
    """For each bit of a text and its end: (is it a one, its slot for each context)."""
    for i, s in enumerate([*symbols, end]):
        own = contexts(list(symbols[:i]), end)
        for at in range(code.first[s], code.first[s] + code.length[s]):
            yield bool(code.sign[at] < 0), [(c + int(code.node[at])) % lm.SLOTS for c in own]


def counted(code, contexts, texts, end):
    found = defaultdict(lambda: [0, 0])
    for symbols in texts:
        for one, slots in coded_bits(code, contexts, symbols, end):
            for c, slot in enumerate(slots):
                found[c, slot][one] += 1
    return found


def met(found):
    """Stretched probability of a one and the gate's level, by context and slot, as tables hold them."""

    def look(c, slot):
        zeros, ones = found.get((c, slot), (0, 0))
        odds = math.log((ones + lm.PRIOR) / (zeros + lm.PRIOR))
        return round(lm.SCALE * max(-lm.LIMIT, min(lm.LIMIT, odds))) / lm.SCALE, min(lm.LEVELS - 1, int(math.log2(1 + zeros + ones) / 2))

    return look


def inputs(code, contexts, symbols, end, look):
    for one, slots in coded_bits(code, contexts, symbols, end):
        seen = [look(c, slot) for c, slot in enumerate(slots)]
        yield np.array([-x if one else x for x, _ in seen]), seen[-2][1] * lm.LEVELS + seen[-1][1]


def cost(code, contexts, symbols, end, look, weights):
    """Natural log of a text's probability, times -1."""
    total, offset, step = 0.0, np.zeros(lm.N_CONTEXTS), np.zeros(lm.N_CONTEXTS)
    for i, (x, gate) in enumerate(inputs(code, contexts, symbols, end, look)):
        if i % lm.BLOCK == 0:
            offset, step = offset - lm.RATE / (8 * lm.BLOCK) * step, np.zeros(lm.N_CONTEXTS)
        z = max(-20.0, min(20.0, float((weights[gate] + offset) @ x)))
        total += math.log1p(math.exp(z))
        step += x / (1 + math.exp(-z))
    return total


def test_score_against_single_bits(spark, monkeypatch):
    """Words of the head, rarer ones, unknown ones, texts of several blocks, empty, null and repeated ones."""
    common, rarer = "the of and river long name was in".split(), "quay reef silt tarn vale weir zeal".split()
    r = np.random.default_rng(14)
    draw = lambda n, words: " ".join(r.choice(words, n))
    texts = [draw(int(r.integers(1, 30)), common * 4 + rarer) for _ in range(60)] + [draw(400, common * 3 + rarer + ["unmet", "né"]), "", None, "THE River", "the river", "qq zz qq"]
    held = {i for i in range(len(texts)) if i % 5 == 0} | {60, 65}
    mixers, real = [], lm._mixer
    monkeypatch.setattr(lm, "HEAD", 9)
    monkeypatch.setattr(lm, "_mixer", lambda *a: mixers.append(real(*a)) or mixers[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["score"] for x in lm.scores(docs, F.col("doc_id").isin(list(held))).collect()}
    words, speller = mixers

    split = [[w.encode() for w in (t or "").lower().split()] for t in texts]
    counts = Counter(w for i, ws in enumerate(split) if i not in held for w in ws)
    number = words.code.alphabet.number
    rare = {w: n for w, n in counts.items() if w not in number}
    assert 0 < len(number) <= 9 and len(rare) > 5 and any(w not in counts for ws in split for w in ws)
    other, end = len(number), len(number) + 1
    symbols = [[number.get(w, other) for w in ws] for ws in split]
    look = met(counted(words.code, word_contexts, [s for i, s in enumerate(symbols) if i not in held], end))
    spell = met(counted(speller.code, byte_contexts, map(list, counts), 256))
    bottom = math.log10(sum(rare.values()) + len(rare) + 1)
    for i, ws in enumerate(split):
        want = -cost(words.code, word_contexts, symbols[i], end, look, words.weights) / math.log(10)
        for w in (w for w in ws if w not in number):
            want += (math.log10(rare[w] + 1) if w in rare else -cost(speller.code, byte_contexts, list(w), 256, spell, speller.weights) / math.log(10)) - bottom
        assert got[i] == pytest.approx(want, rel=1e-4), i


def test_weights_against_single_bits():
    """Three steps of one text."""
    r = np.random.default_rng(15)
    code = lm.Code(np.append(r.integers(1, 1000, 256), 10))
    tables, gates = r.integers(-60, 60, (lm.N_CONTEXTS, lm.SLOTS)).astype(np.int8), r.integers(0, lm.LEVELS, (2, lm.SLOTS)).astype(np.int8)
    mixer = lm.Mixer(code, tables, gates * np.array([[lm.LEVELS], [1]], np.int8))
    text, step = bytes(r.integers(97, 110, 120).astype(np.uint8)), 400
    mixer.learn([text], step=step)
    look = lambda c, slot: (tables[c, slot] / lm.SCALE, int(gates[c - lm.N_CONTEXTS + 2, slot]) if c >= lm.N_CONTEXTS - 2 else 0)
    bits = list(inputs(code, byte_contexts, list(text), 256, look))
    assert len(bits) > 2 * step and mixer.met.sum() == len(bits)
    want = np.full((lm.GATES, lm.N_CONTEXTS), 0.35)
    for at in range(0, len(bits), step):
        change, n = np.zeros_like(want), Counter()
        for x, g in bits[at : at + step]:
            change[g] += x / (1 + math.exp(-float(want[g] @ x)))
            n[g] += 1
        for g, k in n.items():
            want[g] -= 0.02 * change[g] / max(1, math.sqrt(16 * k))
    assert np.allclose(mixer.weights, want, atol=1e-5)
