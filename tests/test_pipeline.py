import json
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import clean, evaluate, facts, questions, resolve, sanity, shape, split
from tallyforge.plans.pipeline import run_pipeline
from tallyforge.plans.schema import AUTO_INDEX
from tallyforge.sources import tables
from tallyforge.streaming.rollup import month_spend

MESSY = str(Path(__file__).parent / "messy.csv")


@pytest.fixture(scope="module")
def messy(spark):
    return tables.read_csv(spark, MESSY).cache()


def test_lenient_and_strict_csv(spark, messy):
    refs = [r[0] for r in messy.orderBy("_row_id").select("`Ref No`").collect()]
    assert refs[:3] == ["R01", "R02", "R03"]
    assert "R13" in refs and "R14" not in refs, "short rows stay, long rows go"
    assert messy.filter("`Ref No` = 'R13'").first()["Currency"] is None
    assert messy.filter("`Ref No` = 'R15'").first()["Merchant"] == 'The "Best" Shop'
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv_strict(spark, MESSY).collect()


def test_resolution(messy):
    found = resolve.resolve(messy.drop("_row_id"))
    assert found.columns == {"Customer_ID": "entity_id", "TxnDateTime": "timestamp", "Amount": "amount", "Currency": "currency", "Category": "category", "Channel": "channel", "Merchant": "counterparty", "Is_Fraud": "label", "Status": "status"}
    by_name = {r["source_column"]: r for r in found.report}
    assert by_name["TxnDateTime"]["method"] == "fuzzy_alias" and by_name["TxnDateTime"]["confidence"] == 0.63 and by_name["TxnDateTime"]["status"] == "auto_mapped_flagged"
    assert "Notes" in found.quarantined


def test_names():
    assert resolve.match_name("Account ID") == ("entity_id", 0.95, "exact_alias")
    assert resolve.match_name("dr_cr")[0] == "_direction"
    assert resolve.match_name("zzz") == (None, 0.0, None)


def test_collision_and_content(spark):
    df = spark.createDataFrame([(f"u{i}", f"2026-01-{i + 1:02d}", str(i * 1.5), "web", "pos") for i in range(20)], "x string, when_ string, q string, channel string, payment_channel string")
    found = resolve.resolve(df)
    assert found.columns == {"x": "entity_id", "when_": "timestamp", "q": "amount", "channel": "channel"}
    assert next(r for r in found.report if r["source_column"] == "payment_channel")["status"] == "quarantined_collision"


def test_conventions(spark):
    b = tables.provider_b(spark)
    found = resolve.resolve(b)
    by = resolve.conventions(b, found)
    assert by.cents and by.day_first and found.direction == "dr_cr"
    sample = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert resolve.date_order(sample("01/25/2026", "02/03/2026"))[0] is False
    assert resolve.date_order(sample("01/02/2026"))[0] is True


def test_run(spark, messy):
    tasks = ["fraud_flagging", "categorization", "general_behavioral", "query_sql", "spend_summarization"]
    seen = []
    out = run_pipeline(spark, messy, "messy", tasks, extra_context_cols=["Notes"], progress=lambda s, f: seen.append(f))
    rows = out.clean_df.orderBy("_row_id").collect()
    assert out.fatal_error is None and seen[-1] == 1.0
    assert [r["extra__Notes"] for r in rows][:5] == ["plain", "day first", "comma decimal", "accounting", "trailing minus"]
    assert not {"no such day", "epoch", "no id", "word", "copy"} & {r["extra__Notes"] for r in rows}
    assert [r["amount"] for r in rows[:5]] == [12.5, 1234.56, 1234.56, -123.45, -123.45]
    assert rows[5]["timestamp"] == rows[6]["timestamp"] == datetime(2026, 3, 9, 10, 30)
    assert all(len(r["entity_id"]) == 16 for r in rows)
    assert out.cleaning_stats["duplicate_rows_removed"] == 1
    assert out.cleaning_stats["output_rows"] == len(rows) == sum(out.split_stats["row_counts"].values())
    assert out.shaped["categorization"].count() == len(rows)
    assert out.shaped["fraud_flagging"].count() == sum(r["label"] is not None for r in rows)
    assert "extra" not in out.shaped["categorization"].first()["context"][0] and "Notes: plain" in out.shaped["categorization"].first()["context"][0]
    json.dumps(out.manifest, default=str)


def test_missing_and_overrides(spark):
    df = spark.createDataFrame([("2026-01-01", "1.5", "a"), ("2026-01-02", "2.5", "a")], "date string, amount string, thing string")
    assert run_pipeline(spark, df, "s", []).fatal_error == "Missing required field(s): ['entity_id']"
    assert resolve.missing_fields(df)[0] == ["entity_id"]
    by_row = run_pipeline(spark, df, "s", ["categorization"], overrides={"entity_id": AUTO_INDEX})
    assert by_row.fatal_error is None and by_row.clean_df.select("entity_id").distinct().count() == 2
    by_thing = run_pipeline(spark, df, "s", [], overrides={"entity_id": "thing"})
    assert by_thing.clean_df.select("entity_id").distinct().count() == 1
    two = run_pipeline(spark, df.withColumn("amt", F.lit("9")), "s", [], overrides={"entity_id": "thing", "amount": "amt"})
    assert {r["amount"] for r in two.clean_df.collect()} == {9.0} and "amount" in two.quarantined_columns


def test_empty_input(spark):
    df = spark.createDataFrame([], "customer_id string, date string, amount string")
    out = run_pipeline(spark, df, "none", ["query_sql", "spend_summarization", "fraud_flagging"])
    assert out.clean_df.count() == 0 and all(x.count() == 0 for x in out.shaped.values())


def _rows(spark, n=60, entities=3):
    start = datetime(2026, 1, 1)
    data = [(f"E{i % entities}", start + timedelta(days=i * 2, hours=i % 5), -float(i % 17 + 1), "USD", f"cat{i % 4}", "web", f"M{i % 5}", "COMPLETED", str(i % 2), i) for i in range(n)]
    return spark.createDataFrame(data, "entity_id string, timestamp timestamp_ntz, amount double, currency string, category string, channel string, counterparty string, status string, label string, _row_id long")


def test_features_are_causal(spark):
    early = clean.with_features(_rows(spark, 40)).orderBy("_row_id").collect()
    late = clean.with_features(_rows(spark, 60)).filter("_row_id < 40").orderBy("_row_id").collect()
    assert early == late
    first = early[0]
    assert first["time_since_last_txn_hours"] is None and first["rolling_avg_amount_3"] is None and first["day_of_week"] == 3


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_split_positions(spark, n):
    df = _rows(spark, n)
    at = sorted(r["timestamp"] for r in df.collect())
    row = split.cutoffs(df).first()
    assert row["train_cutoff"] == at[min(int(n * 0.7), n - 1)] and row["val_cutoff"] == at[min(int(n * 0.85), n - 1)]
    assert sum(r["n"] for r in split.split_counts(split.with_split(df, split.cutoffs(df))).collect()) == n
    with pytest.raises(ValueError):
        split.cutoffs(df, 0.9, 0.2)


def test_window_ends(spark):
    for n in (1, 2, 3, 6, 7, 8, 13):
        df = split.with_split(_rows(spark, n, entities=1), split.cutoffs(_rows(spark, n, entities=1)))
        got = sorted(r["_row_id"] + 1 for r in shape.behaviour_examples(df).collect())
        assert got == sorted({*range(2, n, 5), *([n] if n > 1 else [])})


def test_sql_examples_run(spark):
    df = _rows(spark)
    questions.register(df)
    by = facts.detect(df)
    made = questions.examples(df, split.cutoffs(df), by).collect()
    assert made and Counter(r["template_kind"] for r in made).keys() <= {"aggregation", "extremes", "comparison", "retrieval"}
    for r in made[::5]:
        got = questions.run_query(spark, r["output"])
        assert got.ok, got.error
        bound = questions.run_query(spark, r["_debug_sql_template"], list(r["_debug_sql_params"]))
        assert bound.ok and bound.df.collect() == got.df.collect()
        if r["template_kind"] == "aggregation" and r["output"].startswith(("SELECT SUM", "SELECT AVG")):
            assert f"{got.df.first()[0]:.2f}" == r["reference_answer"]
        if r["output"].startswith("SELECT COUNT"):
            assert str(got.df.first()[0]) == r["reference_answer"]
    assert not questions.run_query(spark, "SELECT nothing FROM nowhere").ok
    assert evaluate.same_rows(spark, made[0]["output"], made[0]["output"]) == (True, True)


def test_unsigned_adapts(spark):
    df = _rows(spark).withColumn("amount", -F.col("amount"))
    by = facts.detect(df)
    assert not by.signed
    sql, names = questions.adapted(next(t for t in questions.TEMPLATES if t.name == "largest"), by)
    assert "1=1" in sql and "ORDER BY amount DESC" in sql and names == ["entity_id", "status", "currency", "start", "end"]
    assert facts.facts(df, by).filter("max_amount > 0").count() > 0


def test_literals(spark):
    row = spark.createDataFrame([("O'Hara",)], "x string").select(questions.rendered("a=? b", [F.col("x")])).first()
    assert row[0] == "a='O''Hara' b"
    with pytest.raises(ValueError):
        questions.rendered("? ?", [F.lit("x")])


def test_jsonl_and_names(spark, tmp_path):
    df = _rows(spark)
    made = shape.category_examples(split.with_split(df, split.cutoffs(df)))
    tables.write_jsonl(made, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 60
    assert tables.safe_name("a b/c.csv") == "a_b_c_csv"
    tables.write_manifest({"at": datetime(2026, 1, 1)}, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text())["at"].startswith("2026")


def test_provider_a_round(spark):
    a = tables.provider_a(spark)
    out = run_pipeline(spark, a, "a", ["fraud_flagging"])
    assert out.fatal_error is None and out.cleaning_stats["dropped_missing_required"] == 0
    assert 500 < out.clean_df.count() < 2500
    assert out.clean_df.filter("amount >= 0").count() == 0


def test_grid(spark):
    df = split.with_split(_rows(spark, 200), split.cutoffs(_rows(spark, 200)))
    ex = df.select(F.lit("d").alias("dataset"), shape.serialized(df.columns).alias("text"), F.col("category").alias("output"), "split")
    runs = sanity.run_grid(ex, {"small": (16, 40, 0.1)}, seeds=(0, 1)).collect()
    assert len(runs) == 2 and all(r["final_val_accuracy"] > 0.8 for r in runs), runs
    assert evaluate.eligible(ex) and evaluate.small_sample(10, 5)


def test_gradients():
    import numpy as np

    m = sanity.Classifier(9, 3, 4, 5, 0)
    ids, y = np.array([[2, 3, 4, 0], [5, 6, 0, 0]]), np.array([0, 2])
    loss = lambda: -np.log(m.forward(ids)[0][np.arange(2), y]).mean()
    start = {k: v.copy() for k, v in m.p.items()}
    m.step(ids, y, 1e-3)
    for name in m.p:
        moved = (start[name] - m.p[name]) / 1e-3
        at = np.unravel_index(np.abs(moved).argmax(), moved.shape)
        after, m.p = m.p, {k: v.copy() for k, v in start.items()}
        m.p[name][at] += 1e-5
        up = loss()
        m.p[name][at] -= 2e-5
        slope = (up - loss()) / 2e-5
        assert abs(slope - moved[at]) < 1e-4 * max(1, abs(slope)), name
        m.p = after


def test_stream(spark, tmp_path):
    _rows(spark).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(_rows(spark).schema).parquet(str(tmp_path / "in"))
    run = month_spend(stream).writeStream.outputMode("complete").format("memory").queryName("month_spend").start()
    run.processAllAvailable()
    run.stop()
    got = {(r["entity_id"], r["month"]): r["total"] for r in spark.table("month_spend").collect()}
    want = {(r["entity_id"], r["month"]): r["total"] for r in facts.by_month(facts.spend(_rows(spark), facts.Convention(True))).collect()}
    assert got == want


def test_ids_can_be_normalized(spark):
    df = spark.createDataFrame([("c1", "2026-01-01", "1"), (" C1 ", "2026-01-02", "2")], "customer_id string, date string, amount string")
    count = lambda **k: run_pipeline(spark, df, "s", [], **k).clean_df.select("entity_id").distinct().count()
    assert (count(), count(normalize_ids=True)) == (2, 1)


def test_prompts(spark):
    row = spark.createDataFrame([("How much?", "e1", ["a", "b"])], "q string, e string, s array<string>").select(
        evaluate.question_prompt(F.col("q"), F.col("e")), evaluate.behaviour_text(F.col("s")), evaluate.first_statement(F.lit("SELECT 1; DROP"))
    ).first()
    assert tuple(row) == ("Question: How much? Entity: e1 SQL:", "a b", "SELECT 1")
