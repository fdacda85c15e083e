"""One pass of the gate, bounded samples, sketches, generated rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import clean, resolve, sanity
from tallyforge.plans import queries
from tallyforge.plans.pipeline import run_pipeline
from tallyforge.sources import tables

DATA = "/root/testdata/sf0.001"


def test_gate_is_one_pass(spark):
    mapped = queries._mapped(spark, DATA)
    rows = clean.settled(mapped)
    want = sorted(map(str, clean.keep_first(clean.gate(mapped)).collect()))
    assert sorted(map(str, clean.settled_rows(rows).collect())) == want
    plan = clean.gate_stats(mapped)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == mapped._jdf.queryExecution().optimizedPlan().toString().count("Relation"), "the source is read once"
    row = clean.gate_stats(mapped).first()
    n, kept = mapped.count(), len(want)
    assert (row["input_rows"], row["output_rows"]) == (n, kept) and row["input_rows"] == row["dropped_missing_required"] + row["duplicate_rows_removed"] + kept
    assert row["null_timestamp"] == mapped.filter("timestamp IS NULL").count() > 0
    empty = clean.gate_stats(mapped.limit(0)).first()
    assert (empty["input_rows"], empty["output_rows"], empty["retained_pct"]) == (0, 0, 0.0)


def test_rows_without_required_fields_are_few(spark):
    """However many rows lack a field, they are a row for each set of lacking fields."""
    mapped = queries._mapped(spark, DATA).withColumn("amount", F.when(F.col("_row_id") % 2 == 0, F.col("amount")))
    rows = clean.settled(mapped)
    assert rows.filter("_no_amount OR _no_timestamp OR _no_entity_id").count() <= 7


def test_unread_dates_are_told(spark):
    rows = [("a", "2026-01-01", "1"), ("a", "Jan the 2nd", "2"), ("a", "Feb the 3rd", "3"), ("a", "45000", "4"), ("a", "", "5")]
    out = run_pipeline(spark, spark.createDataFrame(rows, "customer_id string, date string, amount string"), "s", [])
    assert out.manifest["schema_resolution"]["unread_dates"] == [{"layout": "a a 9a", "n": 2, "example": "Feb the 3rd"}, {"layout": "9", "n": 1, "example": "45000"}]
    assert any("like '45000'" in w for w in out.manifest["warnings"]) and out.cleaning_stats["null_timestamp"] == 4


def test_sample_is_the_sorted_sample(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "val").otherwise("test").alias("split"), F.concat(F.lit("t"), F.col("id") % 1700).alias("text"), (F.col("id") % 3).cast("string").alias("output"), (F.col("id") % 2).alias("dataset"))
    most = {"train": 40, "val": 15}
    got = Counter(map(tuple, sanity.sampled(df, 5, ["dataset"], most).collect()))
    key = df.withColumn("h", sanity.portable_hash(F.lit(5), F.col("text"), F.col("output"))).collect()
    want = Counter()
    for d in (0, 1):
        for s, n in most.items():
            own = sorted((r["h"], r["text"], r["output"]) for r in key if r["dataset"] == d and r["split"] == s)
            want += Counter((s, t, o, d) for _, t, o in own[:n])
    assert got == want
    plan = sanity.sampled(df, 5, ["dataset"], most)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, "each task keeps its own smallest rows before the shuffle"


def test_sketches_within_their_error(spark):
    df = spark.range(200_000).select(F.col("id").cast("string").alias("all"), (F.col("id") % 3000).cast("string").alias("few"), F.lit(None).cast("string").alias("none"))
    got = {r["name"]: r for r in resolve.full_profile(df).collect()}
    assert got["few"]["distinct"] == 3000 and got["none"]["distinct"] == 0 and got["none"]["n"] == 0
    assert abs(got["all"]["distinct"] - 200_000) < 200_000 * 4 / 2 ** (resolve.SKETCH / 2)
    assert "Expand" not in resolve.full_profile(df)._jdf.queryExecution().executedPlan().toString()


def test_generated_rows_are_the_same_for_any_partitioning(spark):
    ids = spark.range(200).select(F.concat(F.lit("E"), "id").alias("entity_id"))
    a = tables.synthetic_for(ids.repartition(1)).collect()
    assert Counter(a) == Counter(tables.synthetic_for(ids.repartition(7)).collect())
    assert Counter(a) != Counter(tables.synthetic_for(ids, seed=43).collect())
    per = Counter(r["entity_id"] for r in a)
    assert min(per.values()) >= 15 and max(per.values()) <= 59 and len(per) == 200
    n = len(a)
    odd = [r for r in a if r["label"]]
    assert 0.012 < len(odd) / n < 0.028 and all(r["channel"] == "online" for r in odd)
    usual = sum(tables.MERCHANTS[r["counterparty"]] == r["category"] for r in a) / n
    assert 0.89 < usual < 0.935, "nine in ten, and the tenth that hits it by chance"
    logs = spark.createDataFrame([(r["amount"],) for r in a if not r["label"]], "v double").select(F.avg(F.log("v")), F.stddev(F.log("v")), F.avg((F.log("v") < 3.2 - 0.9).cast("int"))).first()
    assert logs[0] == pytest.approx(3.2, abs=0.05) and logs[1] == pytest.approx(0.9, abs=0.04) and logs[2] == pytest.approx(0.1587, abs=0.02)
