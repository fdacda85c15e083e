"""Large groups of near copies: few comparisons, and no link lost."""

import random

import pytest

from tallyforge.llm import simhash
from tests.llm.test_whole import plain_kept


def test_copies_of_one_text_are_compared_few_times(spark, monkeypatch):
    """500 texts made from one by up to twelve edits: some are similar to it, the others to none or few."""
    r, rows = random.Random(31), {}
    base = [f"w{r.randrange(5000)}" for _ in range(150)]
    for i in range(500):
        words = list(base)
        for at in r.sample(range(150), r.randrange(13)):
            words[at] = f"x{r.randrange(10**9)}"
        rows[i] = " ".join(words)
    compared, real = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: (compared.append(df.count()) if name == "simhash-pairs" else None) or real(df, name))
    kept = {x["doc_id"] for x in simhash.keep_one(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    want = plain_kept(rows)
    assert kept == want and 150 < len(want) < 400
    assert sum(compared) < 8 * len(rows), compared


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9])
def test_bounds_leave_out_no_similar_pair(spark, similarity):
    """A pair that is similar fits by what each of both has in common with any other text."""
    r = random.Random(32)
    sets = {0: []} | {i: sorted(r.sample(range(40), r.randint(1, 40))) for i in range(1, 60)} | {60 + i: list(range(100 + i, 118 + 2 * i)) for i in range(12)}
    verify = simhash._Verifier(None, None, None, 5, similarity)
    verify.sets, verify.make = spark.createDataFrame(list(sets.items()), "fp long, hashes array<int>"), lambda fps: None
    got = {x["fp"]: x for x in verify.bounds(verify.sets.select("fp")).collect()}
    for i, x in sets.items():
        assert got[i]["n"] == len(x) and got[i]["common"] == sum(any(h in y for j, y in sets.items() if j != i) for h in x)
    pairs = [(got[i]["n"], got[j]["n"], got[i]["common"], got[j]["common"]) for i in sets for j in sets if i < j and sets[i] and 1e-9 + len({*sets[i]} & {*sets[j]}) >= similarity * len({*sets[i]} | {*sets[j]})]
    assert len(pairs) > 5
    frame = spark.createDataFrame(pairs, "n_a int, n_b int, c_a long, c_b long")
    assert frame.filter(~verify.fits(frame.n_a, frame.n_b, frame.c_a, frame.c_b)).count() == 0
