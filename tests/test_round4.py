"""Large tables: sums of millions, many distinct values, losses between two decimals, texts that differ in few literals."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import evaluate, facts, questions, resolve, shape, split, sqlpairs
from tallyforge.plans import queries

DATA = "/root/testdata/sf0.001"


def test_doubles_without_exponents(spark):
    values = {0.0: "0.0", 0.0001: "0.0001", 0.00012345: "0.00012345", 0.01: "0.01", 9999999.99: "9999999.99", 1e7: "10000000.0", -114898010.4: "-114898010.4", 123456789012345.67: "123456789012345.67", 9999999999999998.0: "9999999999999998.0"}
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", shape.plain(F.col("v")).alias("text")).collect()
    assert {r["v"]: r["text"] for r in got} == values


def test_answers_of_large_sums(spark):
    """Rows of an answer hold numbers as the SQL's text does: no exponents, whatever the amount."""
    rows = spark.createDataFrame([(f"a{i}", -11489801.04) for i in range(10)], "category string, amount double").select(
        F.lit("e").alias("entity_id"), F.expr("TIMESTAMP_NTZ '1996-01-02 00:00:00'").alias("timestamp"), "amount", F.lit("USD").alias("currency"), F.when(F.col("category") == "a3", 'a "b"').otherwise("x").alias("category"),
        F.lit("web").alias("channel"), F.when(F.col("category") != "a0", "S").alias("counterparty"), F.lit("O").alias("status"), F.lit(None).cast("string").alias("label"), F.substring("category", 2, 1).cast("long").alias("_row_id"),
    )
    number = {t.name: i for i, t in enumerate(questions.TEMPLATES)}
    asked = spark.createDataFrame([("e", n) for n in (number["top_category"], number["largest"])], "entity_id string, number int")
    asked = asked.select("entity_id", F.col("number").alias("attempt"), "number", F.lit("x").alias("c"), F.lit(None).cast("string").alias("d"), F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'").alias("month"), F.lit(None).cast("timestamp_ntz").alias("month2"))
    got = {r["number"]: r["reference_answer"] for r in questions.answers(rows, asked, facts.Convention(True, "O")).collect()}
    assert got == {number["top_category"]: '{"category":"x","total":103408209.36}', number["largest"]: '{"timestamp":"1996-01-02T00:00:00.000","amount":-11489801.04,"category":"x"}'}


def test_examples_of_large_sums(spark):
    """The training examples carry the same texts."""
    rows = spark.range(40).select(
        F.lit("e").alias("entity_id"), F.expr("TIMESTAMP_NTZ '1996-01-02 00:00:00'").alias("timestamp"), F.lit(-2.5e7).alias("amount"), F.lit("USD").alias("currency"), F.lit("x").alias("category"),
        F.lit("web").alias("channel"), F.lit("S").alias("counterparty"), F.lit("O").alias("status"), F.lit(None).cast("string").alias("label"), F.col("id").alias("_row_id"),
    )
    cells = facts.cells(rows)
    made = questions.examples(cells, split.cutoffs(rows), facts.Convention(True, "O"), per_entity=24)
    got = {r["reference_answer"] for r in made.collect() if r["reference_answer"].startswith("{")}
    assert got and got <= {'{"category":"x","total":1000000000.0}', '{"timestamp":"1996-01-02T00:00:00.000","amount":-25000000.0,"category":"x","counterparty":"S"}'}


def test_distinct_values_are_exact(spark):
    """However many they are, where no sketch is asked for; nulls and missing values are no values."""
    df = spark.range(60_000).select(
        F.concat(F.lit("n"), "id").alias("all"), (F.col("id") % 7).cast("double").alias("a `b"), F.when(F.col("id") % 2 == 0, "2026-01-02").when(F.col("id") % 4 == 1, "x").when(F.col("id") % 8 == 3, "").alias("mixed"), F.lit(None).cast("string").alias("none")
    ).withColumnRenamed("a `b", "a b")
    got = {r["name"]: tuple(r)[1:] for r in resolve.full_profile(df.repartition(3)).collect()}
    assert got == {"all": (60_000, 60_000, 0.0, 0.0), "a b": (60_000, 7, 0.0, 1.0), "mixed": (45_000, 2, 30 / 45, 0.0), "none": (0, 0, None, None)}
    sketched = {r["name"]: r for r in resolve.full_profile(df, resolve.SKETCH).collect()}
    assert sketched["mixed"]["distinct"] == 2 and sketched["all"]["n"] == 60_000 != sketched["all"]["distinct"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
def test_profile_of_all_columns(spark):
    customers = queries.load(spark, DATA, "customer")
    got = {r["name"]: r["n"] for r in queries.content_profile(spark, DATA).collect()}
    assert got == {c: customers.count() for c in customers.columns}


@pytest.mark.parametrize("digits", [2, 3])
def test_perplexity_is_the_sql_s_to_the_last_bit(spark, digits):
    """Losses whose perplexity lies between two decimals, where the JVM's exp and rounding give another one."""
    near = [18.9916359796974, 19.80537024761841, 19.6657743932252, 18.942364801132445, 19.145440198875395, 19.22532075048401, 19.70844508772446, 19.76817461178074]
    losses = [*near, *(i / 1000 for i in range(0, 20_100, 7)), -5.0, 800.0, 20.0, None]
    got = spark.createDataFrame([(x,) for x in losses], "loss double").select("loss", evaluate.rounded_perplexity(F.col("loss"), digits).alias("p")).collect()
    theirs = duckdb.execute(f"SELECT CASE WHEN x < 20 THEN round(exp(x), {digits}) ELSE CAST('inf' AS DOUBLE) END FROM (SELECT unnest(?::DOUBLE[]) AS x)", [losses]).fetchall()
    assert [r["p"] for r in got] == [r[0] for r in theirs]
    if digits == 3:
        jvm = spark.createDataFrame([(x,) for x in near], "loss double").select(F.round(evaluate.perplexity(F.col("loss")), 3).alias("p")).collect()
        assert all(a["p"] != b[0] for a, b in zip(jvm, theirs)), "what it was before"


def test_aggregates_of_many_texts_meet_by_equal_columns(spark):
    """A range of time beside the entity must not join each row with each range; empty groups, groups and scalar subqueries
    keep their results."""
    spark.range(3000).selectExpr("CAST(id % 50 AS STRING) AS who", "id % 7 AS k", "CAST(id AS DOUBLE) AS v", "TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 90 AS INT)) AS at").createOrReplaceTempView("visits")
    count = lambda who, a, b: f"SELECT COUNT(*), SUM(v) FROM visits WHERE who='{who}' AND k IN (1,2) AND at BETWEEN '{a}' AND '{b}'"
    both = lambda who, a, b: f"SELECT (SELECT COUNT(*) FROM visits WHERE who='{who}' AND at >= '{a}') AS x, coalesce((SELECT MAX(v) FROM visits WHERE who='{who}' AND at < '{b}'), 0) AS y"
    top = lambda who, a, b: f"SELECT k, SUM(v) AS t FROM visits WHERE who='{who}' AND at BETWEEN '{a}' AND '{b}' GROUP BY k ORDER BY t DESC LIMIT 1"
    days = [f"2026-0{1 + i // 28}-{1 + i % 28:02d}" for i in range(56)]
    cases = [(w, a, b) for w in ("3", "17", "nobody") for a, b in zip(days, days[9:])]
    pairs = [(f(*c).replace("SELECT", "select", 1), f(*c)) for f in (count, both, top) for c in cases] + [(f(*c), f("5", *c[1:])) for f in (count, both, top) for c in cases[:90:7]]
    for shape in (count, both, top):
        spark.createDataFrame([(1, *"abcd")], "_text long, l0 string, l1 string, l2 string, l3 string").createOrReplaceTempView("given")
        pieces = re.split(r"'[^']*'", shape("a", "b", "c"))
        c = sqlpairs.clauses(pieces[0] + "".join(f"p.l{i}{x}" for i, x in enumerate(pieces[1:])))
        plan = sqlpairs._answer(spark, c, "given")._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join" in x and "visits" not in x and "true" not in x]
        assert not [x for x in joins if " >= " in x and " = " not in x] and any("who" in x or "_text" in x for x in joins), plan
    made = sqlpairs.rates(spark, spark.createDataFrame([(a, b, a, b) for a, b in pairs], "generated string, reference string, g string, r string"), keep=["g", "r"])
    got = {(r["g"], r["r"]): (r["executable"], r["correct"]) for r in made.pairs.collect()}
    assert made.alone == 0 and all(got[a, b] == (True, True) for a, b in pairs[: 3 * len(cases)])
    for a, b in pairs[3 * len(cases) :: 9]:
        assert got[a, b] == sqlpairs.same_rows(spark, a, b), (a, b)
