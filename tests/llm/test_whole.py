"""Cases in which less than the whole job was done before."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import langid, lm, simhash
from tallyforge.llm.shared import table

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


def plain_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_kept(texts):
    """The smallest id of each component of texts with Jaccard 0.8 or more, all pairs tried."""
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    root, by_size = {d: d for d in sets}, sorted(sets, key=lambda d: len(sets[d]))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, d in enumerate(by_size):
        for e in by_size[i + 1 :]:
            if len(sets[d]) < 0.8 * len(sets[e]):
                break
            both = len(sets[d] & sets[e])
            if both >= 0.8 * (len(sets[d]) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {find(d) for d in sets}


def near_copies():
    r = random.Random(11)
    rows = {}
    for _ in range(12):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randint(8, 150))]
        for _ in range(12):
            words = list(base)
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = f"x{r.randrange(3000)}"
            rows[len(rows)] = " ".join(words)
    return rows | {len(rows): "", len(rows) + 1: " \n", len(rows) + 2: "A few words", len(rows) + 3: "a FEW  words"}


@pytest.mark.parametrize("stars", [simhash.STARS, 0])
def test_near_copies_go(spark, monkeypatch, stars):
    monkeypatch.setattr(simhash, "STARS", stars)
    rows = near_copies()
    want = plain_kept(rows)
    assert 12 < len(want) < len(rows) - 40
    kept = corpus_pipeline.dedup(spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string"), DATA)
    assert {r["doc_id"] for r in kept.collect()} == want


def test_dedup_stage_against_all_pairs(spark):
    docs = table(spark, DATA, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, DATA).collect()} == plain_kept(texts)


def test_lm_learns_from_all_training_documents(spark, monkeypatch):
    """Tables hold every training document, and the weights come from every one."""
    docs = [(i, f"{'abcdefgh'[i % 8]} text number {i} of them") for i in range(60)]
    made, learnt = [], []
    tables, weights = lm.bit_tables, lm.learnt_weights
    monkeypatch.setattr(lm, "bit_tables", lambda d, c, *n: made.append((d.count(), tables(d, c, *n))) or made[-1][1])
    monkeypatch.setattr(lm, "learnt_weights", lambda d, c, o: learnt.append((d.count(), weights(d, c, o))) or learnt[-1][1])
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lm.scores(frame, F.col("doc_id") % 6 == 0).collect()
    assert made[0][0] == learnt[0][0] == 50
    # A piece counts as its texts did when each was alone in one fold.
    code = lm.Code(np.ones(257))
    rows = spark.createDataFrame([(t, i % 2) for i, t in docs], "text string, fold int")
    got = tables(rows, code)
    alone = [tables(rows.filter(f"fold = {f}").withColumn("fold", F.lit(0)), code)[-1] for f in (1, 0)]
    assert all((a == b).all() for k in (0, 1) for a, b in zip(got[k], alone[k]))
    counts = np.zeros((lm.N_CONTEXTS, 2 * lm.SLOTS), np.int32)
    for _, symbols, coded, _ in lm._pieces([t.encode() for _, t in docs]):
        lm._counted(code, symbols, coded, counts)
    zeros, ones = counts.reshape(lm.N_CONTEXTS, -1, 2).transpose(2, 0, 1)
    assert ((got[2][0] > 0) == (ones > zeros)).all()


def test_lm_weights_are_learnt_in_every_partition(spark):
    """The weights of two partitions are the average, by bits, of what each learns alone: no single task reads all."""
    rng = np.random.default_rng(12)
    code = lm.Code(np.ones(257))
    tables = [(rng.integers(-60, 60, (lm.N_CONTEXTS, lm.SLOTS)).astype(np.int8), rng.integers(0, 8, (2, lm.SLOTS)).astype(np.int8)) for _ in range(lm.FOLDS)]
    parts = [[("first text of all", 0)], [("and one of another part", 0), ("third", 0)]]
    rdd = spark.sparkContext.parallelize(parts, 2).flatMap(lambda x: x)
    got = lm.learnt_weights(spark.createDataFrame(rdd, "text string, fold int"), code, tables)
    sums, met = 0, 0
    for part in parts:
        own = lm.Mixer(code, *tables[0])
        own.learn([t.encode() for t, _ in part])
        sums, met = sums + own.weights * own.met[:, None], met + own.met[:, None]
    assert np.allclose(got, np.where(met > 0, sums / np.maximum(1, met), 0.35), atol=1e-6)


def test_any_number_of_languages(spark):
    """130 languages, each with letters of its own."""
    r = random.Random(13)
    make = lambda i: " ".join("".join(chr(0x4E00 + 20 * i + r.randrange(20)) for _ in range(5)) for _ in range(60))
    rows = [(3 * i + k, f"l{i:03}", make(i)) for i in range(130) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs)
    found = docs.select("lang", langid.predicted(spark, model, F.col("text")).alias("p")).collect()
    assert len(model.names) == 130 and all(x["p"]["lang_pred"] == x["lang"] for x in found)
