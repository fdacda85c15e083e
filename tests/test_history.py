"""Windows over chunks with halos equal those over whole entities."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import clean, history, shape, split

SCHEMA = "entity_id string, timestamp timestamp_ntz, amount double, currency string, category string, channel string, counterparty string, status string, label string, _row_id long"


@pytest.fixture(scope="module")
def rows(spark):
    """One entity has half of the rows, many of them at one time; one has no name."""
    start = datetime(2026, 1, 1)
    data = []
    for i in range(600):
        entity = "hot" if i % 2 else ("warm" if i % 4 else (None if i % 16 == 0 else f"e{i % 24}"))
        at = start + timedelta(hours=(i * 37) % 400) if i % 10 else start + timedelta(days=3)
        data.append((entity, at, float(i % 23), "USD", f"c{i % 4}", "web", f"M{i % 5}", "COMPLETED", str(i % 2), i))
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("hot, chunk", [(100, 40), (20, 3)])
def test_equal_to_whole_entities(spark, rows, monkeypatch, hot, chunk):
    cut = split.with_split(rows, split.cutoffs(rows))
    made = lambda: [sorted(map(str, df.collect())) for df in (clean.with_features(rows), shape.with_context(rows), shape.behaviour_examples(cut), shape.behaviour_examples(cut, 5), shape.fraud_examples(cut, 4))]
    want = made()
    monkeypatch.setattr(history, "HOT_ROWS", hot)
    monkeypatch.setattr(history, "CHUNK_ROWS", chunk)
    assert made() == want


def test_a_hot_entity_is_spread(spark, rows):
    seen = history.history(rows, back=3, hot_rows=100, chunk_rows=40)
    parts = {(r["entity_id"], r["_part"]): r["n"] for r in seen.rows.groupBy("entity_id", "_part").agg(F.count("*").alias("n")).collect()}
    assert sum(e == "hot" for e, _ in parts) >= 5 and max(parts[p] for p in parts if p[0] == "hot") < 150
    assert [n for (e, _), n in parts.items() if e is None] == [rows.filter("entity_id IS NULL").count()]
    places = seen.done(seen.rows.select("*", seen.at.alias("at"), seen.of.alias("of"))).filter("entity_id = 'hot'").collect()
    assert sorted(r["at"] for r in places) == list(range(1, 301)) and {r["of"] for r in places} == {300}
    ordered = sorted(places, key=lambda r: (r["timestamp"], r["_row_id"]))
    assert [r["at"] for r in ordered] == list(range(1, 301))
    assert history.history(rows.limit(0), back=3).rows.count() == 0
