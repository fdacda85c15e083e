"""Nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names, for every operator."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import decontaminate, langid, lm, mixing, quality, secrets, sharding, simhash, toxicity, warc
from tallyforge.llm.shared import fold, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, p string, score double, rate int, component_id string, doc struct<a: int>, k_id int, shard string"
WORDS = "the of and in to was that with from this only red green blue stone river tree house road light".split()


def _text(i: int, n: int = 40) -> str:
    return " ".join(WORDS[(i * 7 + k * k + k) % len(WORDS)] + ("" if (i + k) % 3 else f"{(i * k) % 97}x") for k in range(n))


def rows():
    extra = (0, "p", 0.5, 1, "c", (1,), 2, "s")
    made = [(i, _text(i), ["en", "de", None][i % 3], f"s{i % 4}", 1, *extra) for i in range(40)]
    odd = [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \n\t ", "en", "s0", 3), (103, "12 34 %%", "de", None, 8), (None, _text(3), "en", "s1", 9), (104, "ä 中 \U0001f600 word", "en", "s1", 9)]
    long = (105, " ".join(_text(i, 60) for i in range(400)), "en", "s2", 9)
    return made + [(*r, *extra) for r in [*odd, long, (7, _text(7), "de", "s3", 1), (7, _text(7), "de", "s3", 1)]]


@pytest.fixture(scope="module")
def docs(spark):
    return written(spark.createDataFrame(rows(), SCHEMA), "edges")


@pytest.fixture(scope="module")
def nothing(spark):
    return written(spark.createDataFrame([], SCHEMA), "nothing")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 5 == 0), "x") for i in range(40)] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 1, 0, "x"), (4, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, _text(5)), (2, None), (3, ""), (None, "one two three"), (1, _text(5))], "item_id long, text string")


def test_simhash(docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows())
    zero = {r["doc_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert zero == {100, 101, 102} and {r["component_id"] for r in got if r["doc_id"] in zero} == {100}
    assert next(r for r in got if r["doc_id"] is None)["component_id"] == 3
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 7 in ids and 101 not in ids and None not in ids
    assert simhash.keep_one(nothing).count() == 0


def test_decontaminate(spark, docs, nothing, bench):
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert (5, 1) in got and all(i == 1 for _, i in got)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.filter("doc_id = 5").count() == 0 and clean.filter("doc_id = 100").count() == 1
    for a, b in ((nothing, bench), (docs, bench.limit(0))):
        assert decontaminate.contaminated(a, b).count() == 0
        assert decontaminate.clean(a, b).count() == a.count()


def test_mixing(docs, nothing, labels):
    domains = mixing.label_domains(labels)
    got = mixing.rates(docs, domains).collect()
    assert len(got) == len(rows()) and all(r["rate"] >= 0 and r["copies"] >= 0 for r in got)
    assert mixing.mixed(docs, domains).columns == docs.columns
    assert mixing.rates(nothing, domains).count() == 0 and mixing.mixed(nothing, domains).count() == 0
    assert {r["rate"] for r in mixing.rates(docs, domains.limit(0)).collect()} == {1.0}


def test_toxicity(spark, docs, nothing, labels):
    for model in (toxicity.train(docs, labels), toxicity.train(docs, labels.limit(0)), toxicity.train(nothing, labels)):
        got = docs.select(toxicity.scored(spark, model, F.col("text")).alias("s")).collect()
        assert len(got) == len(rows()) and all(0 <= r["s"] <= 1 for r in got)
    assert nothing.select(toxicity.scored(spark, model, F.col("text"))).count() == 0


def test_secrets(docs, nothing):
    table = secrets.train(docs)
    assert secrets.scan(docs, table).count() == len(rows())
    assert secrets.scan(nothing, secrets.train(nothing)).count() == 0


def test_langid(spark, docs, nothing):
    model = langid.train(docs)
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", langid.predicted(spark, model, F.col("text")).alias("p")).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102, 103))
    assert got[104]["lang_pred"] in ("en", "de") and all(0 <= p["score"] <= 1 for p in got.values())
    empty = langid.train(nothing)
    assert {r["p"]["lang_pred"] for r in docs.select(langid.predicted(spark, empty, F.col("text")).alias("p")).collect()} == {"und"}
    assert nothing.select(langid.predicted(spark, model, F.col("text"))).count() == 0


def test_quality(docs, nothing):
    got = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert got[100]["n_words"] == 0 and got[100]["base_failed"] and not got[100]["kept"] and got[102]["n_dup_lines"] == 0
    assert got[103]["n_symbols"] == 2
    assert quality.judged(nothing).count() == 0


def test_warc(spark, nothing):
    page = "x" * 150
    data = [(1, "http://a", page), (2, None, page), (None, "http://b", page), (3, "u\r\nEvil: 1", "short"), (4, "u", None), (5, "u", ""), (6, "u", "short"), (2, None, page), (7, "u", "ä" * 60), (8, "u", "ä" * 60)]
    pages = spark.createDataFrame([(*d, "n", 1) for d in data], "page_id long, url string, html string, digest string, first int")
    got = sorted(warc.read_warc(spark, warc.write_warc(pages), split_bytes=64).collect(), key=str)
    assert len(got) == len(data)
    kind = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in got)
    assert kind == sorted([("1", "response", "None"), ("2", "revisit", "1"), ("2", "revisit", "1"), ("None", "response", "None"), ("3", "response", "None"), ("4", "response", "None"), ("5", "response", "None"), ("6", "response", "None"), ("7", "response", "None"), ("8", "revisit", "7")])
    assert next(r for r in got if r["page_id"] == 8)["payload_bytes"] == 120
    assert warc.read_warc(spark, warc.write_warc(nothing.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html")))).count() == 0


def test_lm(docs, nothing):
    got = lm.scores(docs, fold(F.col("doc_id"), 7) == 2).collect()
    assert len(got) == len(rows()) and all(r["score"] <= 0 and r["base_score"] <= 0 for r in got)
    blank = next(r for r in got if r["doc_id"] == 100)
    assert blank["n_tokens"] == 1 and blank["n_known"] == 1
    assert lm.scores(nothing, F.lit(False)).count() == 0
    untrained = lm.scores(docs, F.lit(True)).first()
    assert untrained["train_tokens"] == 0 and untrained["n_known"] == 0 and untrained["base_score"] == 0


def test_sharding(spark, docs, nothing):
    got = sharding.shard_plan(docs).collect()
    assert len(got) == len(rows())
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        if r["doc_id"] == 100:
            assert (r["size"], r["text_crc32"], r["source"]) == (1, 0, None)
    assert sorted(by) == list(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard_plan(nothing).count() == 0
    back = spark.read.parquet(sharding.write_shards(docs.drop("shard"), n_shards=4))
    assert back.count() == len(rows()) and back.select("shard").distinct().count() == 4


def test_stages(spark, docs, nothing, labels, bench, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, nothing):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, now, str(tmp_path)), name)
            assert out.columns == table.columns and out.count() <= now.count()
            now = out
        assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() == now.count()


def test_fold_is_crc32(spark):
    row = spark.createDataFrame([(123, None)], "a long, b long").select(fold(F.col("a"), 7), fold(F.col("b"), 7)).first()
    assert tuple(row) == (zlib.crc32(b"123") % 7, 0)
