"""Mixing by soft membership: domain posteriors, then document rates whose expected token totals match targets.

A softmax regression over hashed words and word shapes is fitted to a sample of at most ``MAX_PER_DOMAIN`` labelled
documents a domain (chosen by hash), and gives each document's posteriors p. It is fitted in ``ROUNDS`` rounds: each of
``PARTS`` parts of the sample goes on from the last weights by passes of its own, and the driver averages the parts' weights.

Rates r >= 0 minimize the squared distance between the totals sum(r * tokens * p) and the targets, by projected gradient
steps from r = 1. A step needs the totals only, one small vector that a distributed sum brings to the driver; the gradient
of a document is its posteriors times that vector. The distance is weighted by the inverse second moments of the
documents, with which a step of length one never goes up. Longer steps and steps weighted by the moments of the
documents whose rates aren't zero are measured in the same pass, and the best is taken. Steps end when the targets are
met, or when none goes down any more, which is logged. So a rate is a function of a document's posteriors and the steps,
and no join brings it back.

The total is, unless given, the largest that the targets allow without repeating documents on the whole: the scarcest
domain keeps its rate. Documents are repeated or left out by rate: floor(rate + u) copies, with u a seeded hash.

Defined cases: a null or blank text has no tokens and the posteriors of such a text; labels with null domain aren't
used, and of repeated labels of an id the smallest domain counts; target domains without labelled documents are left
out and the other weights scaled up; without any, all rates are 1; repeated rows get equal rates; an empty table gives an empty
result. Of the inputs only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import logging
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tallyforge.llm.shared import table, written

MAX_PER_DOMAIN = 4000
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 14, 1 << 9
SEED = 3
PARTS, ROUNDS, PASSES = 8, 4, 30
STEPS, TOLERANCE = 40, 1e-6
#: Domains of the registered query and of the pipeline's stage, by the table of labels, and their shares of tokens.
TARGETS = {"high": 0.94, "low": 0.04, "toxic": 0.02}
RUNS = re.compile(r"(.)\1+")
MEMBERSHIP = StructType([StructField("tokens", LongType()), StructField("p", ArrayType(DoubleType()))])


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the columns quality and toxic."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "high")
    return labels.select("doc_id", domain.alias("domain"))


class _Shape(dict):
    """From a character's number to A, a, 0 or the character itself."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        self[code] = "0" if ch.isdigit() else ("A" if ch.isupper() else "a") if ch.isalpha() else ch
        return self[code]


class _Places(dict):
    """From a word to its bucket and, 16 bits up, that of its shape; remembered for words that come again."""

    def __init__(self):
        self.shape = _Shape()

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        shape = RUNS.sub(r"\1", word.translate(self.shape))
        self[word] = xxhash.xxh32_intdigest(word.lower(), SEED) % WORD_BUCKETS | (WORD_BUCKETS + xxhash.xxh32_intdigest(shape, SEED) % SHAPE_BUCKETS) << 16
        return self[word]


class Features:
    """Buckets of words. Their counts are taken from the sorted buckets of a text: an array for all buckets costs more than
    most texts."""

    def __init__(self):
        self.seen = _Places()

    def __call__(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of words; buckets and their weights, log(1 + count)."""
        words = (text or "").split()
        both = np.fromiter(map(self.seen.__getitem__, words), np.uint32, len(words)).view(np.uint16)  # of words and of shapes
        places, counts = np.unique(both, return_counts=True)
        return len(words), places.astype(np.int64), np.log1p(counts)


def _passes(w: np.ndarray, y: np.ndarray, sizes: np.ndarray, places: np.ndarray, values: np.ndarray, rounds: int = PASSES) -> np.ndarray:
    """Softmax weights (bucket, domain), the last row for the intercept, from ``w`` on by Adagrad on whole passes. Row i has
    domain y[i] and the next sizes[i] of the buckets ``places`` with their ``values``."""
    at = np.repeat(np.arange(len(y)), sizes)
    size, n_domains = len(w) - 1, w.shape[1]
    w = w.copy()
    past = np.full_like(w, 1e-8)
    hot = np.eye(n_domains)[y]
    for _ in range(rounds):
        z = np.column_stack([np.bincount(at, values * w[places, k], len(y)) for k in range(n_domains)]) + w[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        gap = p / p.sum(axis=1, keepdims=True) - hot
        grad = np.vstack([np.column_stack([np.bincount(places, values * gap[at, k], size) for k in range(n_domains)]), gap.sum(axis=0)]) / len(y)
        grad[:-1] += 1e-5 * w[:-1]
        past += grad**2
        w -= 0.3 * grad / np.sqrt(past)
    return w


def _fitted(sample: DataFrame, n_domains: int) -> np.ndarray:
    """Weights from rows (part, y, b, v). The driver gets the weights of each part, whatever the size of the sample."""
    spark = sample.sparkSession
    w = np.zeros((WORD_BUCKETS + SHAPE_BUCKETS + 1, n_domains))
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast(w)

        def learn(key, rows):
            y, sizes = rows["y"].to_numpy(), pc.list_value_length(rows["b"]).to_numpy()
            own = _passes(start.value, y, sizes, pc.list_flatten(rows["b"]).to_numpy(), pc.list_flatten(rows["v"]).to_numpy())  # noqa: B023
            return pa.table({"n": pa.array([len(y)], pa.int64()), "w": pa.array([own.tobytes()], pa.binary())})

        found = sample.groupBy("part").applyInArrow(learn, "n long, w binary").collect()  # PARTS rows
        total = sum(r["n"] for r in found)
        if not total:
            break
        w = sum(r["n"] / total * np.frombuffer(r["w"]).reshape(w.shape) for r in found)
    return w


def train(docs: DataFrame, domains: DataFrame, names: list[str], doc_id: str = "doc_id", text: str = "text") -> tuple[list[str], np.ndarray]:
    """The names that have labelled documents, and the classifier's weights. ``domains``: rows (doc_id, domain)."""
    known = domains.select(F.col("doc_id").alias("id"), F.col("domain")).dropna().groupBy("id").agg(F.min("domain").alias("domain")).filter(F.col("domain").isin(names))
    n = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    names = [d for d in names if n.get(d)]
    if not names:
        return [], np.zeros((WORD_BUCKETS + SHAPE_BUCKETS + 1, 0))
    part, number = F.lit(0.0), F.lit(0)
    for i, d in enumerate(names):
        part = F.when(F.col("domain") == d, F.lit(min(1.0, MAX_PER_DOMAIN / n[d]))).otherwise(part)
        number = F.when(F.col("domain") == d, F.lit(i)).otherwise(number)
    even = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    chosen = F.broadcast(known.filter(even < part).select("id", number.alias("y")))  # MAX_PER_DOMAIN ids a domain

    def featured(batches):
        make = Features()
        for batch in batches:
            found = [make(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_pydict({"part": batch["part"], "y": batch["y"], "b": pa.array([x[1] for x in found], pa.list_(pa.int32())), "v": pa.array([x[2] for x in found], pa.list_(pa.float32()))})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).join(chosen, "id").select(F.pmod(F.xxhash64("id", "text"), F.lit(PARTS)).alias("part"), "y", "text")
    sample = written(rows.mapInArrow(featured, "part long, y int, b array<int>, v array<float>"), "mixing-sample")  # MAX_PER_DOMAIN ids a domain
    return names, _fitted(sample, len(names))


def membership(spark, weights: np.ndarray, text: Column) -> Column:
    """A struct of tokens (words) and p (the posteriors) for a text column."""
    shared = spark.sparkContext.broadcast(weights)  # buckets x domains

    @F.arrow_udf(MEMBERSHIP)
    def member(texts: pa.Array) -> pa.Array:
        make, w = Features(), shared.value
        n, p = [], []
        for t in texts:
            words, places, values = make(t.as_py())
            z = values @ w[places] + w[-1]
            e = np.exp(z - z.max()) if len(z) else z
            n.append(words)
            p.append(e / e.sum() if len(z) else z)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))], ["tokens", "p"])

    return member(text.cast("string"))


def _times(p: Column, step: list[float]) -> Column:
    return sum(p[i] * F.lit(float(g)) for i, g in enumerate(step))


def _rate(p: Column, steps: list[list[float]]) -> Column:
    rate = F.lit(1.0)
    for step in steps:
        rate = F.greatest(F.lit(0.0), rate - _times(p, step))
    return rate


def fit_rates(members: DataFrame, targets: list[float], total: float | None = None) -> tuple[list[list[float]], list[float], list[float]]:
    """``members``: rows (tokens, p). The steps that make up a document's rate, the totals reached and those asked."""
    d = len(targets)
    share = np.array(targets, float) / sum(targets) if d else np.zeros(0)
    p, tokens = F.col("p"), F.col("tokens").cast("double")

    def measured(steps: list[list[float]], tried: list[list[float]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each step tried after ``steps``: totals, and second moments of the documents whose rate isn't zero."""
        held = members.select("tokens", "p", _rate(p, steps).alias("r0"))
        held = held.select("tokens", "p", *[F.greatest(F.lit(0.0), F.col("r0") - _times(p, x)).alias(f"r{k}") for k, x in enumerate(tried)])
        sums = []
        for k in range(len(tried)):
            r = F.col(f"r{k}")
            sums += [F.sum(tokens * p[i] * r) for i in range(d)] + [F.sum(F.when(r > 0, tokens * p[i] * p[j])) for i in range(d) for j in range(i + 1)]
        rows = np.array([x or 0.0 for x in held.agg(*[x.alias(f"x{k}") for k, x in enumerate(sums)]).first()]).reshape(len(tried), -1)
        moments = np.zeros((len(tried), d, d))
        moments[:, *np.tril_indices(d)] = rows[:, d:]
        return [(row[:d], h + np.tril(h, -1).T) for row, h in zip(rows, moments)]

    steps: list[list[float]] = []
    if not d:
        return steps, [], []
    ((there, h),) = measured(steps, [[0.0] * d])
    if not there.sum():
        return steps, list(there), list(there)
    asked = share * (total or min(there[i] / share[i] for i in range(d) if share[i] > 0))
    solve = lambda m, gap: np.linalg.solve(m + np.eye(d) * 1e-9 * max(np.trace(m), 1e-300), gap)
    whole = h
    far = lambda totals: float((totals - asked) @ solve(whole, totals - asked))
    while not met(there, asked):
        own, plain = solve(h, there - asked), solve(whole, there - asked)
        tried = [list(float(x) for x in k * own) for k in (1.0, 0.3)] + [list(float(x) for x in k * plain) for k in (1.0, 4.0, 16.0)]
        step, (totals, moments) = min(zip(tried, measured(steps, tried)), key=lambda x: far(x[1][0]))
        if len(steps) == STEPS or far(totals) >= far(there) * (1 - 1e-3):
            logging.getLogger(__name__).warning("the targets can't be met: asked for %s, reached %s", asked, there)
            break
        steps.append(step)
        there, h = totals, moments
    return steps, list(there), list(asked)


def met(there: np.ndarray, asked: np.ndarray) -> bool:
    return bool(np.abs(np.array(there) - np.array(asked)).sum() <= TOLERANCE * np.sum(asked))


def _copies(rate: Column, key: Column) -> Column:
    u = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("int")


def rates(docs: DataFrame, domains: DataFrame, targets: dict[str, float] = TARGETS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each document: doc_id, source, tokens, p_<domain> for each domain, rate, copies."""
    names, weights = train(docs, domains, list(targets), doc_id, text)
    key = F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), key.alias("key"), membership(docs.sparkSession, weights, F.col(text)).alias("m"))
    members = written(found.select("doc_id", "source", "key", "m.*"), "mixing")
    steps, _, _ = fit_rates(members, [targets[d] for d in names])
    rated = members.withColumn("rate", _rate(F.col("p"), steps))
    each = [F.get("p", names.index(d)).alias(f"p_{d}") if d in names else F.lit(0.0).alias(f"p_{d}") for d in targets]
    return rated.select("doc_id", "source", "tokens", *each, "rate", _copies(F.col("rate"), F.col("key")).alias("copies"))


def mixed(docs: DataFrame, domains: DataFrame, targets: dict[str, float] = TARGETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, each as often as its rate says, with all their columns."""
    spark = docs.sparkSession
    names, weights = train(docs, domains, list(targets), doc_id, text)
    member = membership(spark, weights, F.col(text))
    packed = docs.select(F.struct("*").alias("doc"), F.xxhash64(F.lit(SEED), F.col(doc_id), F.col(text)).alias("key"), member.alias("m"))
    packed = written(packed, "mixing")  # posteriors are worked out once
    steps, _, _ = fit_rates(packed.select("m.*"), [targets[d] for d in names])
    counted = packed.select("doc", _copies(_rate(F.col("m.p"), steps), F.col("key")).alias("copies")).filter("copies > 0")
    return counted.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")


def op3(spark, sf_dir):
    return rates(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")))
