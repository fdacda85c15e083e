"""Facts from cells against plain Python, at the edges of days and months; the rows are read once."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import facts

SCHEMA = "entity_id string, timestamp timestamp_ntz, amount double, currency string, category string, channel string, counterparty string, status string, label string, _row_id long"


@pytest.fixture(scope="module", params=[True, False])
def case(request, spark):
    r = random.Random(7)
    edges = [timedelta(0), timedelta(milliseconds=500), timedelta(seconds=1), timedelta(hours=23, minutes=59, seconds=59), timedelta(hours=23, minutes=59, seconds=59, milliseconds=1), timedelta(hours=9)]
    data = []
    for i in range(700):
        at = datetime(2026, 1, 1) + timedelta(days=r.choice([0, 27, 28, 29, 30, 31, 58, 59, 60, 75, 89, 90, r.randint(0, 100)])) + r.choice(edges)
        amount = r.choice([None, round(r.uniform(0.01, 90), 2), 5.0, 5.0, 0.0])
        if amount is not None and request.param:
            amount = amount if r.random() < 0.2 else -amount
        data.append((f"e{r.randint(0, 3)}", at, amount, r.choice(["USD", "USD", "EUR", None]), r.choice(["a", "b", "c", None]), "web", r.choice(["M", "N", None]), r.choice(["OK", "OK", "NO"]), None, i))
    data.append(("few", datetime(2026, 1, 5), -1.0 if request.param else 1.0, "USD", "a", "web", "M", "OK", None, 1000))
    return spark.createDataFrame(data, SCHEMA).repartition(4), data, request.param


def _months(data, signed):
    """What the facts must be, from a loop over entities and months."""
    top = lambda counts: min(counts, key=lambda k: (-counts[k], k)) if counts else None
    tally = lambda xs: {x: sum(y == x for y in xs) for x in xs if x is not None}
    status = top(tally([d[7] for d in data]))
    out = {}
    for e in {d[0] for d in data}:
        own = [d for d in data if d[0] == e]
        currency = top(tally([d[3] for d in own]))
        spend = [d for d in own if d[2] is not None and (d[2] < 0 if signed else True) and d[7] == status and d[3] == currency]
        for month in {d[1].replace(day=1, hour=0, minute=0, second=0, microsecond=0) for d in spend}:
            end = (month + timedelta(days=32)).replace(day=1)
            here = [d for d in spend if month <= d[1] < end]
            total = round(sum(abs(d[2]) for d in here), 2)
            if len(own) < 5 or total == 0:
                continue
            by = defaultdict(float)
            for d in here:
                by[d[4]] += abs(d[2])
            by = {k: round(v, 2) for k, v in by.items()}
            cat = min(by, key=lambda k: (-by[k], k is not None, k or ""))
            since = month - (end - timedelta(seconds=1) - month)
            before = [abs(d[2]) for d in spend if since <= d[1] < month]
            big = min(here, key=lambda d: (-abs(d[2]), d[1], d[9]))
            prev = round(sum(before), 2) if before else None
            trend = None if not prev else round(abs((total - prev) / prev * 100), 4)
            out[e, month] = (total, len(here), cat, by[cat], abs(big[2]), big[4], big[6], trend, currency)
    return out


def test_facts_equal_a_loop(case):
    df, data, signed = case
    got = {(r["entity_id"], r["month"]): (round(r["total_spend"], 2), r["transaction_count"], r["top_category"], round(r["top_category_amount"], 2), r["max_amount"], r["max_category"], r["max_merchant"], r["trend_pct"] and round(r["trend_pct"], 4), r["currency"]) for r in facts.facts(df).collect()}
    want = _months(data, signed)
    assert len(want) > 8 and any(w[7] for w in want.values())
    assert {k: v[:7] + v[8:] for k, v in got.items()} == {k: v[:7] + v[8:] for k, v in want.items()}
    assert {k: v[7] or None for k, v in got.items()} == pytest.approx({k: v[7] or None for k, v in want.items()}, abs=1e-3)


def test_rows_are_read_once(spark, tmp_path, case):
    df, _, _ = case
    df.write.parquet(str(tmp_path / "rows"))
    made = facts.facts(spark.read.parquet(str(tmp_path / "rows")))
    plan = made._jdf.queryExecution().toString()
    assert str(tmp_path / "rows") not in plan and "cells" in plan, "everything reads the written cells"


def test_any_range(spark, case):
    """Ranges that begin and end within months: difference of two running sums."""
    df, data, signed = case
    c = facts.cells(df)
    by = facts.Convention(signed)
    rows = facts.spend(c, by)
    r = random.Random(3)
    ranges = []
    for i in range(40):
        a, b = sorted((datetime(2025, 12, 20) + timedelta(days=r.randint(0, 130)), datetime(2025, 12, 20) + timedelta(days=r.randint(0, 130))))
        ranges.append((f"e{i % 5}", datetime(2000 + i, 1, 1), a.date(), r.randint(0, 2), (b + timedelta(days=1)).date(), r.randint(0, 2)))
    asked = spark.createDataFrame(ranges, "entity_id string, month timestamp_ntz, from_day date, from_segment int, to_day date, to_segment int")
    got = {(x["entity_id"], x["month"]): (x["total"], x["n"]) for x in facts.range_totals(rows, asked).collect()}
    listed = rows.select("entity_id", "day", "segment", F.col("paid").cast("double").alias("paid"), "n").collect()
    for e, m, a, s, b, t in ranges:
        here = [x for x in listed if x["entity_id"] == e and (a, s) <= (x["day"], x["segment"]) < (b, t)]
        total, n = got[e, m]
        assert n == sum(x["n"] for x in here) and (total is None) == (n == 0)
        assert n == 0 or total == pytest.approx(sum(x["paid"] for x in here))
