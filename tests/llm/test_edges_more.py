"""Edge cases that were asserted too loosely: equal rows, repeated labels, ties, classes that are missing, very long words."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import langid, lm, mixing, toxicity

BAD, GOOD = "you are a worthless idiot and scum number {}", "the weather in the valley was mild and clear on day {}"


@pytest.fixture(scope="module")
def talk(spark):
    rows = [(i, (BAD if i % 3 == 0 else GOOD).format(f"{'abcdefghij'[i % 10]}{i % 7}")) for i in range(240)]
    return spark.createDataFrame(rows + [(1000, None), (1001, ""), (1002, " \n")], "doc_id long, text string")


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)], "doc_id long, toxic int")


def _scores(spark, model, docs):
    return {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.scored(spark, model, F.col("text")).alias("s")).collect()}


def test_toxicity_of_empty_texts_ties_and_repeats(spark, talk, marks):
    model = toxicity.train(talk, marks)
    got = _scores(spark, model, talk.union(talk.limit(5)))
    assert got[1000] == got[1001] == got[1002] == got[1], "texts without hits have one score"
    assert got[0] > 0.5 > got[1] and got[0] == got[210], "equal texts have equal scores"
    twice = toxicity.train(talk, marks.union(marks))
    assert np.allclose(twice.weights, model.weights) and set(twice.words) == set(model.words), "repeated labels count once"
    largest = toxicity.train(talk, marks.union(marks.withColumn("toxic", F.lit(0))))
    assert np.allclose(largest.weights, model.weights), "of repeated labels the largest counts"
    for only in (0, 1):
        alone = _scores(spark, toxicity.train(talk, marks.filter(F.col("toxic") == only)), talk)
        assert len(set(alone.values())) == 1 and abs(alone[0] - only) < 1e-6, "one class alone: its share"


def test_mixing_of_repeats_and_missing_domains(spark, talk):
    domains = spark.createDataFrame([(i, "bad" if i % 3 == 0 else "good") for i in range(240)], "doc_id long, domain string")
    targets = {"bad": 0.2, "good": 0.8}
    both = talk.withColumn("source", F.lit("s"))
    got = mixing.rates(both.union(both), domains, targets).collect()
    assert len(got) == 2 * both.count()
    by_id: dict = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add((round(r["rate"], 9), r["copies"]))
    assert all(len(x) == 1 for x in by_id.values()), "equal rows have equal rates and copies"
    tokens = {d: sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in got) for d in targets}
    assert tokens["bad"] / sum(tokens.values()) == pytest.approx(0.2, abs=0.01)
    more = mixing.rates(both, domains, targets | {"none": 0.1}).collect()
    assert all(r["p_none"] == 0 for r in more) and any(r["rate"] > 0 for r in more), "a target without labels has no documents, the others keep their proportions"
    share = {d: sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in more) for d in targets}
    assert share["bad"] / sum(share.values()) == pytest.approx(0.2, abs=0.01)


def test_language_ties_and_repeats(spark):
    rows = [(i, "xx" if i % 2 else "yy", "abcabcabc defdefdef") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs)
    got = {(r["p"]["lang_pred"], r["p"]["score"]) for r in docs.union(docs).select(langid.predicted(spark, model, F.col("text")).alias("p")).collect()}
    assert len(got) == 1 and next(iter(got))[0] == "xx", "of languages that fit alike the first by name"


def test_lm_of_repeats_and_a_very_long_word(spark):
    rows = [(i, f"one two three {'four' if i % 2 else 'five'} six") for i in range(40)] + [(100, "x" * 300_000), (101, "one " + "y" * 100_000 + " two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") >= 35
    got = {}
    for r in lm.scores(docs.union(docs), held).collect():
        got.setdefault(r["doc_id"], []).append((r["score"], r["base_score"], r["n_tokens"], r["n_known"]))
    assert all(len(x) == 2 and x[0] == x[1] for x in got.values()), "repeated rows have equal results"
    assert got[100][0][2:] == (2, 1) and got[101][0][2:] == (4, 3)
    assert -1e9 < got[100][0][0] < got[101][0][0] < 0, "an unknown word pays for its letters"
