from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import parsing

AMOUNTS = {
    "12.50": 12.5, "$1,234.56": 1234.56, "1.234,56": 1234.56, "1234,56": 1234.56, "1,000": 1000.0, "1,234,567.8": 1234567.8, "(123.45)": -123.45, "123.45-": -123.45, "USD 99.10": 99.1,
    "45.00 usd": 45.0, "€5": 5.0, "-0.00": 0.0, "1.2e2": 120.0, "": None, "   ": None, "lots": None, "inf": None, "NaN": None, "5d": None, "1e999": None, None: None, "₹1,00,000": 100000.0,
}
DATES = {
    "2026-01-05": datetime(2026, 1, 5), "2026-01-05 10:20:30": datetime(2026, 1, 5, 10, 20, 30), "2026-01-05T10:20": datetime(2026, 1, 5, 10, 20), "2026-03-09T10:30:00Z": datetime(2026, 3, 9, 10, 30),
    "2026-03-09T16:00:00+05:30": datetime(2026, 3, 9, 10, 30), "25/01/2026": datetime(2026, 1, 25), "01/25/2026": datetime(2026, 1, 25), "03/04/2026": datetime(2026, 4, 3), "3-Feb-2026": datetime(2026, 2, 3),
    "March 7, 2026": datetime(2026, 3, 7), "Mar 7 2026 08:15": datetime(2026, 3, 7, 8, 15), "2026/03/08": datetime(2026, 3, 8), "10.03.2026 09:05": datetime(2026, 3, 10, 9, 5), "12-11-26": datetime(2026, 11, 12),
    "05/06/97": datetime(1997, 6, 5), "30/02/2026": None, "1767225600": None, "46030": None, "": None, "N/A": None, None: None, "yesterday": None, "  2026-01-05  ": datetime(2026, 1, 5),
}


@pytest.mark.parametrize(("cases", "parse"), [(AMOUNTS, parsing.amount), (DATES, parsing.timestamp)])
def test_values(spark, cases, parse):
    rows = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", parse(F.col("raw")).alias("v")).collect()
    assert {r["raw"]: r["v"] for r in rows} == cases


def test_month_first(spark):
    row = spark.createDataFrame([("03/04/2026", "25/01/2026")], "a string, b string").select(*[parsing.timestamp(F.col(c), day_first=False) for c in "ab"]).first()
    assert tuple(row) == (datetime(2026, 3, 4), datetime(2026, 1, 25))


def test_direction_and_cents(spark):
    rows = spark.createDataFrame([("100", "DR"), ("-100", "cr"), ("100", None), ("5", " debit ")], "v string, d string")
    found = [r[0] for r in rows.select(parsing.amount(F.col("v"), cents=True, direction=F.col("d"))).collect()]
    assert found == [-1.0, 1.0, 1.0, -0.05]


def test_pseudonym(spark):
    import hashlib

    row = spark.createDataFrame([("C1", None)], "a string, b string").select(parsing.pseudonym(F.col("a"), "s"), parsing.pseudonym(F.col("b"), "s")).first()
    assert tuple(row) == (hashlib.sha256(b"s:C1").hexdigest()[:16], None)
