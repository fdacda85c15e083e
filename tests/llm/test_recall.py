"""How many pairs just above the dedup stage's similarity are met."""

import random

from tallyforge.llm import sharding, simhash


def test_recall_just_above_the_limit(spark):
    """Pairs of a similarity of 0.80 to 0.85, each of unrelated words: nine in ten or more lose one document."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") for _ in range(r.randint(2, 4)))
    rows, similar = [], []
    for i in range(150):
        a = [word() for _ in range(200)]
        b = list(a)
        for at in range(20, 200, 45):  # each word takes five shingles with it
            b[at] = word()
        x, y = ({tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (a, b))
        similar.append(len(x & y) / len(x | y))
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    assert 0.8 <= min(similar) and max(similar) <= 0.85
    kept = {x["doc_id"] for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(2 * i in kept for i in range(150)), "the smaller id stays"
    assert sum(2 * i + 1 not in kept for i in range(150)) >= 135


def test_texts_with_a_common_passage_meet_by_what_is_rare(spark):
    """Texts of which half is one passage, among them pairs of a similarity of 0.8 or more: all are found from their heads."""
    passage = [f"common{i}" for i in range(60)]
    texts, pairs = {}, set()
    for i in range(80):
        own = [f"w{i}_{k}" for k in range(60)]
        texts[2 * i] = passage + own
        near = list(own)
        near[30] = f"other{i}"
        texts[2 * i + 1] = passage + near
        pairs.add((2 * i, 2 * i + 1))
    rows = [(k, [hash(tuple(t[j : j + 5])) % (1 << 31) for j in range(len(t) - 4)]) for k, t in texts.items()]
    sets = spark.createDataFrame([(k, sorted(set(h))) for k, h in rows], "fp long, hashes array<int>")
    verify = simhash._Verifier(None, None, None, 5, 0.8)
    verify.sets, verify.make = sets, lambda fps: None
    found = {tuple(sorted((x["a"], x["b"]))) for x in verify.by_rare_shingles(sets.selectExpr("fp", "fp AS root")).collect()}
    assert pairs <= found and len(found) <= 2 * len(pairs), "not all pairs of the passage's texts"


def test_string_ids(spark):
    """Ids of any type that can be ordered: the smallest of each group stays, a null id last."""
    rows = [("b2", "one two three four five six seven"), ("a1", "one two three four five six seven"), (None, "one two three four five six seven"), ("c3", "something else that has nothing in common")]
    df = spark.createDataFrame([(*r, "web") for r in rows], "doc_id string, text string, source string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == ["a1", "c3"]
    path = sharding.write_shards(df, n_shards=2)
    assert sorted(str(r["doc"]["doc_id"]) for r in spark.read.parquet(path).collect()) == ["None", "a1", "b2", "c3"]
