"""Language-model scores by logistic context mixing.

A text is its tokens: lower-cased words, then an end. Tokens are coded as the bits of a Huffman code of the most frequent
words (at most ``HEAD``), the end, and a sign for any other word. Each bit is predicted from several hashed contexts (none,
the last word, the last two, the last three, and the one before the last); their predictors are bit counts of all training
documents, held in tables of ``SLOTS`` slots. Predictions are mixed in the logistic domain with weights that a gate
chooses, the confidence of two of the contexts; these weights are learnt online on all training documents, those of each
of ``FOLDS`` folds with tables that leave their fold out, in each partition on its own and then averaged by the bits that a
gate has met. The tables used in scoring hold all training documents. In scoring, each text also has an offset of the
weights of its own, refined after every ``BLOCK`` bits.

Other words have exact counts in a table that grows with the corpus and is met by a join, where no key is frequent: after
the sign, a word of count c has the probability (c + 1) / (T + V + 1), of T such tokens and V such words in training; the
rest is for unknown words, which are spelt out by a second mixer, over the bytes of a word (contexts: the last two, three,
four and six bytes, the word so far) and learnt from all words of the training documents, each once. So the probabilities
of all texts sum to one, and the score of a text is comparable with its base score, that of a unigram model with exact
counts. ``bits_per_byte`` is per byte of the text's UTF-8.

Defined cases: a null or empty text is its end alone; without training documents all bits are even and all
counts zero; null ids count as the empty text for the fold; repeated rows get equal results; an empty table gives an
empty result. Of the input only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from math import log, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tallyforge.llm.shared import fold, table, written

ORDERS = (2, 3, 4, 6)  # bytes of the speller's contexts before the word so far
N_CONTEXTS = 5
BITS = 20
SLOTS = 1 << BITS
CHUNK = 1 << 15  # slots that move together
HEAD = 1 << 16
FOLDS = 2
BLOCK = 256
RATE = 2.0
PRIOR = 0.1
LIMIT = 8.0  # of a stretched probability
SURE = np.float32(20.0)  # of a mixed one
LEVELS = 8
GATES = LEVELS**2
PIECE = 1 << 17  # symbols (of a byte's bits) that are scored at once
STRETCH = 1 << 14
COUNT_PIECE = 1 << 16  # symbols that are counted at once
COUNT_BYTES = 64 << 20  # of training text that a task counts, if there are more tasks than cores
COUNT_WORDS = 1 << 20  # that a task of the speller counts
SUMMED = 64  # tables of tasks that are summed at once
SCALE = 15.0  # of stretched probabilities in one signed byte
RESULT = StructType([
    StructField("n_tokens", LongType()), StructField("head_known", LongType()), StructField("head_log", DoubleType()),
    StructField("tail", ArrayType(StringType())), StructField("score", DoubleType()), StructField("n_bytes", LongType()),
])


class Code:
    """A Huffman code of an alphabet's symbols: for each symbol the bits of its word and the tree's nodes that they leave."""

    def __init__(self, histogram: np.ndarray, alphabet: Bytes | Words | None = None):
        self.alphabet = alphabet or BYTES
        heap = [(float(n) + 0.01, s, s) for s, n in enumerate(histogram)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        node = len(histogram)
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y] = (node, 0), (node, 1)
            heapq.heappush(heap, (a + b, node, node))
            node += 1
        nodes, bits, self.length = [], [], np.zeros(len(histogram), np.int64)
        for s in range(len(histogram)):
            path, at = [], s
            while at in parent:
                path.append(parent[at])
                at = parent[at][0]
            self.length[s] = len(path)
            nodes += [n for n, _ in reversed(path)]
            bits += [b for _, b in reversed(path)]
        self.first = np.cumsum(self.length) - self.length
        # A node's number is spread over the slots.
        self.node = ((np.array(nodes, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
        self.sign = 1 - 2 * np.array(bits, np.float32)


def _hashed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int32)


POWERS = np.full(COUNT_PIECE + (1 << 18), 0x2545F4914F6CDD1D, np.uint64)
POWERS[0] = 1
INVERSE = np.full(len(POWERS), pow(0x2545F4914F6CDD1D, -1, 1 << 64), np.uint64)
INVERSE[0] = 1
with np.errstate(over="ignore"):
    POWERS, INVERSE = np.multiply.accumulate(POWERS), np.multiply.accumulate(INVERSE)


def _contexts(b: np.ndarray) -> list[np.ndarray]:
    """For each place of a byte array, hashes of what stands before it."""
    with np.errstate(over="ignore"):
        x = b.astype(np.uint64)
        last = np.concatenate(([np.uint64(0)], x[:-1]))
        orders, sofar = [], last
        for k in range(1, max(ORDERS)):
            sofar = sofar | (np.concatenate((np.zeros(k, np.uint64), last[:-k])) << np.uint64(8 * k))
            if k + 1 in ORDERS:
                orders.append(_hashed(sofar + np.uint64(k + 1 << 50)))
        sums = np.concatenate(([np.uint64(0)], np.add.accumulate((x + np.uint64(7)) * POWERS[: len(x)])))[:-1]
        places = np.arange(len(x))
        starts = np.maximum.accumulate(np.where(last <= 32, places, 0))
        orders.append(_hashed((sums - sums[starts]) * INVERSE[starts] + np.uint64(5 << 40)))
    return orders


class Bytes:
    """The bytes of a word, and its end."""

    end, pad, look_back, bits = 256, 0, 32, 1

    def symbols(self, text: bytes) -> np.ndarray:
        return np.frombuffer(text, np.uint8).astype(np.int64)

    def contexts(self, symbols: np.ndarray) -> list[np.ndarray]:
        return _contexts(np.where(symbols == self.end, 0, symbols))


class Words:
    """Frequent words, a sign for any other, and a text's end."""

    look_back, bits = 3, 4  # bits: about as many a symbol as so many bytes have

    def __init__(self, words: list[bytes]):
        self.number = {w: i for i, w in enumerate(words)}
        self.other, self.end = len(words), len(words) + 1
        self.pad = self.end

    def symbols(self, text: bytes | np.ndarray) -> np.ndarray:
        if isinstance(text, np.ndarray):
            return text
        get, other = self.number.get, self.other
        return np.array([get(w, other) for w in text.lower().split()], np.int64)

    def contexts(self, symbols: np.ndarray) -> list[np.ndarray]:
        """The two on which the gate depends, those of the last word and of the last two, come last."""
        one, two, three = (np.concatenate((np.full(k, self.pad), symbols[:-k]))[: len(symbols)].astype(np.uint64) + np.uint64(1) for k in (1, 2, 3))
        with np.errstate(over="ignore"):
            pair = one * np.uint64(0x9E3779B97F4A7C15) ^ two
            return [np.zeros(len(symbols), np.int32), _hashed(two + np.uint64(1 << 40)), _hashed((pair * np.uint64(0xBF58476D1CE4E5B9)) ^ three), _hashed(one + np.uint64(1 << 41)), _hashed(pair)]


BYTES = Bytes()


class Bits:
    """The coded bits of a piece: the symbol and node of each, its sign (1 for a zero bit, -1 for a one, 0 for a filler)
    and the contexts of the coded symbols."""

    def __init__(self, code: Code, symbols: np.ndarray, coded: np.ndarray, counts: np.ndarray | None = None):
        """``symbols``: those of the alphabet; ``coded``: which of them are coded, the others being context only. With ``counts``,
        the coded symbols of each text, bits are arranged by blocks: the first BLOCK bits of each text, then the next of
        each that has more, and so on, texts with more bits first; the last block of a text is filled up."""
        self.contexts = [c[coded].astype(np.int64) for c in code.alphabet.contexts(symbols)]
        s = symbols[coded]
        lengths = code.length[s]
        ends = np.cumsum(lengths)
        self.place = np.repeat(np.arange(len(s)), lengths)
        at = np.arange(len(self.place)) + np.repeat(code.first[s] - (ends - lengths), lengths)
        filled = np.empty(0, np.int64)
        if counts is not None:
            stops = ends[np.cumsum(counts) - 1]
            sizes = np.diff(stops, prepend=0)
            self.order = np.argsort(-sizes, kind="stable")
            stops, sizes = stops[self.order], sizes[self.order]
            self.live = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(0, int(sizes[0]), BLOCK)]
            heads = np.concatenate([(stops - sizes)[:n] + t * BLOCK for t, n in enumerate(self.live)])
            limits = np.concatenate([stops[:n] for n in self.live])
            moved = (heads[:, None] + np.arange(BLOCK)).ravel()
            filled = np.flatnonzero(moved >= np.repeat(limits, BLOCK))
            moved[filled] = 0
            self.place, at = self.place[moved], at[moved]
        self.node, self.sign = code.node[at], code.sign[at]
        self.sign[filled] = 0
        self.filled = filled


def _counted(code: Code, symbols: np.ndarray, coded: np.ndarray, counts: np.ndarray) -> None:
    """Add a piece's bits to ``counts`` (contexts, 2 * SLOTS)."""
    s = symbols[coded]
    lengths = code.length[s]
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(code.first[s] - (ends - lengths), lengths)
    node, one, place = code.node[at], (code.sign[at] < 0).astype(np.int64), np.repeat(np.arange(len(s)), lengths)
    for own, context in zip(counts, code.alphabet.contexts(symbols)):
        slots = context[coded].astype(np.int64)[place]
        slots += node
        slots &= SLOTS - 1
        slots *= 2
        slots += one
        np.add.at(own, slots, own.dtype.type(1))


def _pieces(texts: list, most: int = 0, alphabet: Bytes | Words = BYTES) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of about PIECE symbols: numbers of the texts, symbols, which are coded, and each text's coded count. Short
    texts share a piece; a long one is in several, each with the symbols before it as context."""
    most, back = most or PIECE // alphabet.bits, alphabet.look_back
    of = [alphabet.symbols(t) for t in texts]
    gap = np.full(back, alphabet.pad, np.int64)
    held: list[int] = []
    size = 0

    def shared():
        parts, coded = [], []
        for i in held:
            parts += [gap, of[i], [alphabet.end]]
            coded += [np.zeros(back, bool), np.ones(len(of[i]) + 1, bool)]
        return list(held), np.concatenate(parts), np.concatenate(coded), np.array([len(of[i]) + 1 for i in held])

    for i in sorted(range(len(of)), key=lambda i: -len(of[i])):
        if len(of[i]) + back >= most:
            for start in range(0, len(of[i]), most):
                lead = gap[min(start, back) :]
                tail = [alphabet.end] if start + most >= len(of[i]) else []
                symbols = np.concatenate((lead, of[i][max(0, start - back) : start + most], tail)).astype(np.int64)
                coded = np.arange(len(symbols)) >= back
                yield [i], symbols, coded, np.array([int(coded.sum())])
        else:
            if held and size + len(of[i]) + back + 1 > most:
                yield shared()
                held.clear()
                size = 0
            held.append(i)
            size += len(of[i]) + back + 1
    if held:
        yield shared()


def _encoded(column) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "replace") for t in column]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, word, n): kind 0 counts words, kind 1 bytes (as numbers), kind 2 documents."""
    histogram, docs, words = np.zeros(256, np.int64), 0, Counter()

    def rows(kind, names, n):
        words_ = pa.array(names, pa.binary()).cast(pa.string())  # cut at ASCII signs, so still UTF-8
        return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(names), kind, np.int32)), "word": words_, "n": pa.array(n, pa.int64())})

    for batch in batches:
        for text in _encoded(batch["text"]):
            histogram += np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            docs += 1
            words.update(text.lower().split())
            if len(words) > 400_000:
                yield rows(0, list(words), list(words.values()))
                words.clear()
    yield rows(0, list(words), list(words.values()))
    yield rows(1, [str(i).encode() for i in range(256)], histogram.tolist())
    yield rows(2, [b""], [docs])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The sum of each place's chunks. Memory: the places of one partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, n in zip(batch["place"].to_pylist(), batch["n"]):
            planes = np.frombuffer(n.as_py(), np.uint8).reshape(-1, 2 * CHUNK)
            part = planes.T.ravel().view(f"<i{len(planes)}").astype(np.int64)
            sums[place] = sums[place] + part if place in sums else part
    yield from sums.items()


def _chunk(place: int, salt: int, counts: np.ndarray) -> pa.RecordBatch:
    """``place``: fold and chunk."""
    kind = "<i4" if counts.max(initial=0) < 1 << 31 else "<i8"
    planes = counts.astype(kind).view(np.uint8).reshape(len(counts), -1).T.tobytes()  # the high bytes, mostly zero, compress well
    arrays = pa.array([place], pa.int32()), pa.array([salt], pa.int32()), pa.array([planes], pa.binary())
    return pa.RecordBatch.from_arrays(list(arrays), ["place", "salt", "n"])


def _by_fold(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    texts, folds = _encoded(batch["text"]), batch["fold"].to_pylist()
    for f in range(FOLDS):
        yield f, [t for t, own in zip(texts, folds) if own == f]


def _chunks_of(places: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, dict[int, np.ndarray]]]:
    """For each chunk of the tables the counts of the folds that have any."""
    n, found = N_CONTEXTS * SLOTS // CHUNK, {}
    for place, counts in places:
        found.setdefault(place % n, {})[place // n] = counts
    yield from found.items()


def bit_tables(docs: DataFrame, code: Code, tasks: int = 1 << 20) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the bits of ``docs`` (columns text and fold), counted by so many tasks at most: for each context and slot the stretched probability of a one, and
    for the two longest contexts the slot's part of the gate. One pair of tables for each fold, of the rows in other folds,
    and last that of all rows."""
    shared = docs.sparkSession.sparkContext.broadcast(code)

    def count(batches):
        from pyspark import TaskContext

        counts = np.zeros((FOLDS, N_CONTEXTS, 2 * SLOTS), np.int32)
        for batch in batches:
            for f, texts in _by_fold(batch):
                for _, symbols, coded, _ in _pieces(texts, COUNT_PIECE, shared.value.alphabet):
                    _counted(shared.value, symbols, coded, counts[f])
        for place, part in enumerate(counts.reshape(-1, 2 * CHUNK)):
            if part.any():
                yield _chunk(place, TaskContext.get().partitionId() % salts, part)

    def add(batches):
        for place, counts in _added(batches):
            yield _chunk(place, 0, counts)

    def finish(batches):
        for chunk, folds in _chunks_of(_added(batches)):
            whole = sum(folds.values())
            for f in range(FOLDS + 1):
                zeros, ones = (whole - folds.get(f, 0)).reshape(-1, 2).T
                stretched = np.rint(SCALE * np.clip(np.log((ones + PRIOR) / (zeros + PRIOR)), -LIMIT, LIMIT)).astype(np.int8)
                gate = np.minimum(LEVELS - 1, np.log2(1 + zeros + ones) / 2).astype(np.int8)
                kinds = pa.array([f * n + chunk], pa.int32()), pa.array([stretched.tobytes()], pa.binary()), pa.array([gate.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays(list(kinds), ["place", "stretched", "gate"])

    n, chunk = N_CONTEXTS * SLOTS // CHUNK, "place int, salt int, n binary"
    rows = docs.select("text", "fold").coalesce(tasks)
    salts = -(-min(tasks, rows.rdd.getNumPartitions()) // SUMMED)
    parts = rows.mapInArrow(count, chunk)
    if salts > 1:  # each salt has SUMMED of the tasks
        parts = parts.repartition(n, "place", "salt").mapInArrow(add, chunk)
    done = parts.repartition(n, F.col("place") % n).mapInArrow(finish, "place int, stretched binary, gate binary").toArrow()  # 2 bytes a slot
    shared.destroy()
    tables, gates = np.zeros(((FOLDS + 1) * n, CHUNK), np.int8), np.zeros(((FOLDS + 1) * n, CHUNK), np.int8)
    for place, stretched, gate in zip(done["place"].to_pylist(), done["stretched"], done["gate"]):
        tables[place], gates[place] = np.frombuffer(stretched.as_py(), np.int8), np.frombuffer(gate.as_py(), np.int8)
    levels = np.array([[LEVELS], [1]], np.int8)
    return [(t, g[-2:] * levels) for t, g in zip(tables.reshape(-1, N_CONTEXTS, SLOTS), gates.reshape(-1, N_CONTEXTS, SLOTS))]


class Mixer:
    """Tables of stretched probabilities, the gate's tables and the weights of each gate."""

    def __init__(self, code: Code, tables: np.ndarray, gates: np.ndarray):
        self.code, self.tables, self.gates = code, tables, gates
        self.weights = np.full((GATES, N_CONTEXTS), 0.35, np.float32)
        self.met = np.zeros(GATES, np.int64)

    def inputs(self, bits: Bits) -> tuple[np.ndarray, np.ndarray]:
        """Stretched probabilities of the other bit than the one that is there, and gates; STRETCH bits at a time, whose
        arrays stay in a core's cache."""
        size = len(bits.sign)
        x, gate = np.empty((N_CONTEXTS, size), np.float32), np.zeros(size, np.int64)
        slots = np.empty(STRETCH, np.int64)
        for at in range(0, size, STRETCH):
            now, n = slice(at, at + STRETCH), min(STRETCH, size - at)
            scale, own = bits.sign[now] * np.float32(1 / SCALE), slots[:n]
            for c in range(N_CONTEXTS):
                np.take(bits.contexts[c], bits.place[now], out=own, mode="clip")
                own += bits.node[now]
                own &= SLOTS - 1
                np.multiply(self.tables[c].take(own, mode="clip"), scale, out=x[c, now])
                if c >= N_CONTEXTS - 2:
                    gate[now] += self.gates[c - N_CONTEXTS + 2].take(own, mode="clip")
        return x, gate

    def learn(self, texts: list[bytes], rate: float = 0.02, step: int = 1 << 12) -> None:
        """One online pass over the texts. ``met``: the bits of each gate."""
        for _, symbols, coded, _ in _pieces(texts, 0, self.code.alphabet):
            bits = Bits(self.code, symbols, coded)
            x, gate = self.inputs(bits)
            for at in range(0, len(gate), step):
                xs, g = x[:, at : at + step], gate[at : at + step]
                wrong = 1 / (1 + np.exp(-np.einsum("cn,nc->n", xs, self.weights[g])))
                n = np.bincount(g, minlength=GATES)
                self.met += n
                for c in range(N_CONTEXTS):
                    self.weights[:, c] -= (rate * np.bincount(g, wrong * xs[c], GATES) / np.maximum(1, np.sqrt(n * 16.0))).astype(np.float32)

    def costs(self, texts: list) -> np.ndarray:
        """Natural log of each text's probability, times -1."""
        out, own = np.zeros(len(texts)), np.zeros((len(texts), N_CONTEXTS), np.float32)
        weights, step = np.ascontiguousarray(self.weights.T), np.float32(RATE / (8 * BLOCK))
        for numbers, symbols, coded, counts in _pieces(texts, 0, self.code.alphabet):
            bits = Bits(self.code, symbols, coded, counts)
            x, gate = self.inputs(bits)
            odds = np.zeros(len(gate), np.float32)  # stretched at first
            for c in range(N_CONTEXTS):
                odds += np.take(weights[c], gate) * x[c]
            which = np.array(numbers)[bits.order]
            offsets, at = own[which], 0
            for n in bits.live:
                now, at = slice(at, at + n * BLOCK), at + n * BLOCK
                xs, z = x[:, now].reshape(N_CONTEXTS, n, BLOCK).transpose(1, 0, 2), odds[now].reshape(n, BLOCK)
                z += np.matmul(offsets[:n, None, :], xs)[:, 0]
                np.minimum(z, SURE, out=z)
                np.maximum(z, -SURE, out=z)
                np.exp(z, out=z)
                offsets[:n] -= step * np.matmul(xs, (z / (1 + z))[:, :, None])[:, :, 0]
            odds[bits.filled] = 0
            spent = np.log1p(odds, out=odds).reshape(-1, BLOCK).sum(axis=1, dtype=np.float64)
            texts_of = np.concatenate([which[:n] for n in bits.live])
            out += np.bincount(texts_of, spent, len(texts))
            own[which] = offsets
        return out


class Model:
    """The mixer over words, and log10(count + 1) of each of its symbols (0 for other words and the end)."""

    def __init__(self, mixer: Mixer, logs: np.ndarray):
        self.mixer, self.logs = mixer, logs

    def score(self, texts: list[bytes]) -> list[tuple]:
        """n_tokens, words of the head, sum of log10(count + 1) over them, other words, log10 score without these, bytes."""
        words = self.mixer.code.alphabet
        get, other, split, coded = words.number.get, words.other, [t.lower().split() for t in texts], []
        for ws in split:
            coded.append(np.array([get(w, other) for w in ws], np.int64))
        out = []
        for text, ws, s, cost in zip(texts, split, coded, self.mixer.costs(coded)):
            rare = np.flatnonzero(s == other).tolist()
            tail = [ws[i].decode("utf-8", "replace") for i in rare]
            out.append((len(ws) + 1, len(ws) - len(tail), float(self.logs[s].sum()), tail, -cost / log(10), len(text)))
        return out


def learnt_weights(docs: DataFrame, code: Code, others: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights from all rows of ``docs`` (columns text and fold), each fold with its tables of ``others``: learnt online in
    each partition, and averaged by gate."""
    start = docs.sparkSession.sparkContext.broadcast((code, others))

    def learn(batches):
        mixers = [Mixer(start.value[0], *tables) for tables in start.value[1]]
        for batch in batches:
            for f, texts in _by_fold(batch):
                mixers[f].learn(texts)
        for m in mixers:
            w = m.weights.astype(np.float64) * m.met[:, None]
            kinds = np.repeat(np.arange(GATES), N_CONTEXTS), np.tile(np.arange(N_CONTEXTS), GATES), w.ravel(), np.repeat(m.met, N_CONTEXTS)
            yield pa.RecordBatch.from_arrays([pa.array(k, t) for k, t in zip(kinds, (pa.int32(), pa.int32(), pa.float64(), pa.int64()))], ["gate", "context", "w", "met"])

    sums = docs.select("text", "fold").mapInArrow(learn, "gate int, context int, w double, met long").groupBy("gate", "context").agg(F.sum("w").alias("w"), F.sum("met").alias("met"))
    weights = np.full((GATES, N_CONTEXTS), 0.35, np.float32)
    for r in sums.filter("met > 0").collect():  # a row for each gate and context
        weights[r["gate"], r["context"]] = r["w"] / r["met"]
    start.destroy()
    return weights


def _scored(model, text: Column) -> Column:
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in RESULT.fields]

    @F.arrow_udf(RESULT)
    def score(texts: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, max(1, len(texts)), 1000):  # a batch may have ten thousand texts
            rows = model.value.score(_encoded(texts[at : at + 1000]))
            parts.append(pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], RESULT.fieldNames()))
        return pa.concat_arrays(parts)

    return score(text.cast("string"))


def _spelt(mixer, word: Column) -> Column:
    """log10 of a word's probability by the speller; null for null."""

    @F.arrow_udf(DoubleType())
    def spelt(words: pa.Array) -> pa.Array:
        there = [i for i, valid in enumerate(words.is_valid().to_pylist()) if valid]
        out = np.full(len(words), np.nan)
        if there:
            out[there] = -mixer.value.costs(_encoded(words.take(pa.array(there)))) / log(10)
        return pa.array(out, pa.float64(), from_pandas=True)

    return spelt(word)


def _head(words: DataFrame) -> tuple[list[bytes], np.ndarray, int]:
    """Words of at least the returned count, as few as HEAD, and their counts, by count and name."""
    sizes = words.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("size")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["size"]):  # a few hundred rows
        total += row["words"]
        if total > HEAD:
            break
        least = row["least"]
    if least is None:
        return [], np.zeros(0, np.int64), 1 << 62
    found = words.filter(F.col("n") >= least).toArrow()
    rows = sorted(zip(found["n"].to_pylist(), found["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
    return [w.encode() for _, w in rows], np.array([n for n, _ in rows], np.int64), least


def _mixer(rows: DataFrame, code: Code, tasks: int) -> Mixer:
    """Tables and weights from ``rows`` (columns text and fold). Each of ``tasks`` tasks counts into tables of its own."""
    *others, whole = bit_tables(rows, code, tasks)
    mixer = Mixer(code, *whole)
    mixer.weights = learnt_weights(rows, code, others)
    return mixer


def scores(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    training = rows.filter("NOT held_out")
    counted = written(training.select("text").mapInArrow(_words, "kind int, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n")), "lm-words")
    words = counted.filter("kind = 0").select("word", "n")
    bytes_ = {int(r["word"]): r["n"] for r in counted.filter("kind = 1").collect()}  # 256 rows
    n_docs = (counted.filter("kind = 2").first() or {"n": 0})["n"]
    head, n_head, least = _head(words)
    rare = words.filter(F.col("n") < least)
    rare_tokens, rare_words = rare.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, distinct = rare_tokens + int(n_head.sum()) + n_docs, rare_words + len(head) + bool(n_docs)
    bottom, rare_bottom = log10(tokens + distinct + 1), log10(rare_tokens + rare_words + 1)

    halves = lambda c: F.pmod(F.xxhash64(c), F.lit(FOLDS)).cast("int").alias("fold")  # noqa: E731  copies share a fold
    cores = spark.sparkContext.defaultParallelism
    code = Code(np.concatenate((n_head, [rare_tokens, n_docs])), Words(head))
    mixer = _mixer(training.select("text", halves("text")), code, max(cores, sum(bytes_.values()) // COUNT_BYTES))
    speller = _mixer(words.select(F.col("word").alias("text"), halves("word")), Code(np.array([bytes_.get(i, 0) for i in range(256)] + [tokens])), 1 + distinct // COUNT_WORDS)
    model = spark.sparkContext.broadcast(Model(mixer, np.concatenate((np.log10(n_head + 1), [0.0, 0.0]))))
    spelling = spark.sparkContext.broadcast(speller)

    found = rows.select("doc_id", "held_out", F.monotonically_increasing_id().alias("row"), _scored(model, F.col("text")).alias("s"))
    found = written(found.select("doc_id", "held_out", "row", "s.*"), "lm-scores")
    tail = found.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("k"))
    met = tail.join(rare, "word", "left")
    met = met.withColumn("spelt", _spelt(spelling, F.when(F.col("n").isNull(), F.col("word"))))
    each = F.coalesce(F.log10(F.col("n") + 1), F.col("spelt")) - F.lit(rare_bottom)
    rest = met.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("k"))).alias("tail_known"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k") * F.log10(F.col("n") + 1))).alias("tail_log"),
        F.sum(F.col("k") * each).alias("tail_score"),
    )
    joined = found.join(rest, "row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = F.col("score") + zero("tail_score")
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + zero("tail_known") + int(bool(n_docs))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + zero("tail_log") + log10(n_docs + 1) - F.col("n_tokens") * bottom).alias("base_score"),
        score.alias("score"),
        (-score * log(10, 2) / F.greatest(F.lit(1), "n_bytes")).alias("bits_per_byte"),
    )


def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fold(F.col("doc_id"), 7) == 2)
