"""Cases that crashed, or in which a question's answer and its SQL were apart."""

from datetime import datetime

import pytest

from tallyforge.operators import evaluate, facts, questions, resolve, split
from tallyforge.plans.pipeline import prepare_all
from tallyforge.sources import tables

SCHEMA = "entity_id string, timestamp timestamp_ntz, amount double, currency string, category string, channel string, counterparty string, status string, label string, _row_id long"


def _rows(spark, *rows):
    """From (entity, time, category)."""
    data = [(e, t, -float(i + 1), "USD", c, "web", f"M{i % 3}", "COMPLETED", None, i) for i, (e, t, c) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def test_entities_with_little_choice(spark):
    """One category, one month, no category: no candidate needs a second one, and nothing crashes."""
    at = lambda m, d: datetime(2026, m, d)
    df = _rows(spark, ("one", at(1, 1), "food"), ("none", at(1, 2), None), ("cats", at(1, 3), "food"), ("cats", at(1, 4), "fuel"), ("months", at(1, 5), "food"), ("months", at(2, 6), "food"))
    found = questions.candidates(df).collect()
    two = {t.name: i for i, t in enumerate(questions.TEMPLATES)}
    assert {r["entity_id"] for r in found} == {"one", "none", "cats", "months"}
    assert {r["entity_id"] for r in found if r["number"] == two["compare_categories"]} <= {"cats"}
    assert {r["entity_id"] for r in found if r["number"] == two["compare_periods"]} <= {"months"}
    assert questions.examples(df, split.cutoffs(df), facts.detect(df)).count() > 0


def test_answers_equal_their_sql_at_a_months_end(spark):
    """A transaction in the fraction of a month's last second is in neither the answer nor the SQL's result."""
    times = [datetime(2026, m, d, 12) for m in (1, 2) for d in (3, 9, 20)] + [datetime(2026, 1, 31, 23, 59, 59, 500000), datetime(2026, 1, 31, 23, 59, 59)]
    df = _rows(spark, *[("E", t, f"c{i % 2}") for i, t in enumerate(times)])
    questions.register(df)
    made = questions.examples(df, split.cutoffs(df), facts.detect(df), per_entity=24).dropDuplicates(["output"]).collect()
    seen = set()
    for r in made:
        got = questions.run_query(spark, r["output"])
        assert got.ok, got.error
        rows = got.df.collect()
        if r["output"].startswith(("SELECT SUM", "SELECT AVG")):
            assert f"{rows[0][0]:.2f}" == r["reference_answer"]
            seen.add("number")
        elif r["output"].startswith("SELECT COUNT"):
            assert str(rows[0][0]) == r["reference_answer"]
            seen.add("count")
        elif r["template_kind"] == "retrieval":
            assert r["reference_answer"] == f"{len(rows)} matching row(s)"
            seen.add("list")
    assert seen >= {"number", "list"}


def test_order_within_a_subquery(spark):
    spark.range(5).createOrReplaceTempView("few")
    assert evaluate.same_rows(spark, "SELECT id FROM few ORDER BY id DESC", "SELECT id FROM (SELECT id FROM few ORDER BY id LIMIT 9)") == (True, True)
    assert evaluate.same_rows(spark, "SELECT id FROM few ORDER BY id DESC", "SELECT id FROM few ORDER BY id") == (True, False)
    pairs = spark.createDataFrame([("SELECT 1", "SELECT 1"), ("SELECT 2", "SELECT 1"), ("SELEC", "SELECT 1"), (None, "SELECT 1")], "generated string, reference string")
    assert evaluate.query_rates(spark, pairs) == {"n": 4, "executable_rate": 0.5, "correct_rate": 0.25}


def test_csv_with_short_long_and_broken_rows(spark, tmp_path):
    short = tmp_path / "short.csv"
    short.write_text('a,b,a\n1,2,3\n4\n\n"x\ny",5,6\n')
    rows = [tuple(r)[:3] for r in tables.read_csv_strict(spark, str(short), multi_line=True).collect()]
    assert rows == [("1", "2", "3"), ("4", None, None), ("x\ny", "5", "6")]
    long = tmp_path / "long.csv"
    long.write_text("a,b\n1,2\n3,4,5\n")
    assert [tuple(r)[:2] for r in tables.read_csv(spark, str(long)).collect()] == [("1", "2")]
    with pytest.raises(Exception, match="malformed"):
        tables.read_csv_strict(spark, str(long)).collect()


def test_median_without_the_amounts(spark):
    for values, large in (([999.0, 1001.0, 1002.0], True), ([1.0, 999.0, 1500.0], False), ([900.0, 1101.0], True), ([900.0, 1099.0], False), ([], False)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert resolve.amount_measures(df, df["v"]).first()["large"] is large


def test_sources_that_fail_are_skipped(spark):
    good = spark.createDataFrame([("c1", "2026-01-01", "1"), ("c2", "2026-01-02", "2")], "customer_id string, date string, amount string")
    ready, skipped = prepare_all(spark, {"good": good, "bare": good.select("date"), "lost": good.selectExpr("customer_id", "date", "CAST(raise_error('gone') AS STRING) AS amount")}, ["categorization"])
    assert list(ready) == ["good"] and set(skipped) == {"bare", "lost"} and "gone" in skipped["lost"]
