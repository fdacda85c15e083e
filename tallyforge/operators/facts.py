"""Month facts of all entities at once: the aggregates that questions and summaries read.

A relation keyed by (entity, month) or (entity, month, category) stands for what would be a query for each entity and
month. Months are half-open ranges of real timestamps.

All facts come from one partial aggregate, ``cells``: counts, sums and extremes by entity, day, category, counterparty and
the few columns that conventions look at. It is written once; what follows reads it and not the rows. The total of any
range is the difference of two running sums, so no range is joined with the rows in it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.parsing import money
from tallyforge.sources.scratch import kept

KEY = ["entity_id", "month"]


@dataclass(frozen=True)
class Convention:
    """``signed``: spend is negative; else every amount is spend."""

    signed: bool
    status: str | None = None


@dataclass
class Cells:
    """The partial aggregate of some rows. ``segment``: 0 for a day's first second, 2 for what lies behind its last whole
    second, 1 between. ``most`` and ``least``: the largest and the smallest transaction."""

    all: DataFrame


def cells(rows: DataFrame | Cells) -> Cells:
    """One scan of the rows, combined before the shuffle; an entity's cells lie in many tasks."""
    if isinstance(rows, Cells):
        return rows
    at, amount = F.col("timestamp"), F.col("amount")
    start = F.date_trunc("DAY", at).cast("timestamp_ntz")
    segment = F.when(at < start + F.expr("INTERVAL 1 SECOND"), 0).when(at <= start + F.expr("INTERVAL 86399 SECOND"), 1).otherwise(2)
    row = lambda rank: F.min(F.when(amount.isNotNull(), F.struct(rank.alias("rank"), "timestamp", "_row_id", "amount")))
    by = [F.date_trunc("MONTH", at).cast("timestamp_ntz").alias("month"), F.to_date(at).alias("day"), segment.alias("segment"), (amount < 0).alias("negative")]
    made = rows.groupBy("entity_id", *by, "currency", "status", "category", "counterparty").agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum(money(F.abs(amount))).alias("paid"), row(-F.abs(amount)).alias("most"), row(F.abs(amount)).alias("least")
    )
    return Cells(kept(made, "cells"))


def detect(df: DataFrame | Cells, spend: str = "auto") -> Convention:
    """Signed if any amount is negative, unless ``spend`` says signed or unsigned; the most frequent status."""
    df = cells(df)
    negative = df.all.agg(F.bool_or("negative").alias("negative")).first()["negative"]
    status = majority(df, "status").first()
    return Convention({"auto": bool(negative), "signed": True, "unsigned": False}[spend], status["status"] if status else None)


def majority(df: DataFrame | Cells, column: str, by: list[str] = ()) -> DataFrame:
    """The most frequent value of a column, of equals the smallest; without ``by`` over all rows."""
    rows, size = (df.all, F.sum("n")) if isinstance(df, Cells) else (df, F.count("*"))
    counts = rows.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(size.alias("_n"))
    if not by:
        return counts.orderBy(F.desc("_n"), column).limit(1).select(column)
    return counts.groupBy(*by).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(column))


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_trunc("MONTH", "timestamp").cast("timestamp_ntz"))


def month_windows(df: DataFrame) -> DataFrame:
    """The months in which an entity has transactions, with label and bounds."""
    months = with_month(df).select(*KEY).distinct()
    return months.select(*KEY, F.date_format("month", "MMMM yyyy").alias("label"), month_end("month").alias("month_end"))


def month_end(month: str | Column) -> Column:
    """The last second of a month."""
    c = F.col(month) if isinstance(month, str) else month
    return (F.add_months(c, 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")).cast("timestamp_ntz")


def spend(df: DataFrame | Cells, by: Convention) -> DataFrame:
    """Cells of spend of the majority status in each entity's majority currency; ``paid`` sums up absolute amounts."""
    df = cells(df)
    rows = df.all.filter("negative" if by.signed else "amounts > 0")
    if by.status is not None:
        rows = rows.filter(F.col("status") == by.status)
    currency = majority(df, "currency", ["entity_id"]).withColumnRenamed("currency", "_currency")
    rows = rows.join(currency, "entity_id", "left").filter(F.col("_currency").isNull() | (F.col("currency") == F.col("_currency")))
    return rows.drop("_currency", "n").withColumnRenamed("amounts", "n")


def within_month(cell: DataFrame) -> DataFrame:
    """Without what lies behind a month's last whole second."""
    return cell.filter((F.col("segment") < 2) | (F.col("day") < F.last_day("day")))


def paid_sum() -> Column:
    return F.sum("paid").cast("double")


def by_category(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY, "category").agg(paid_sum().alias("total"), F.sum("n").alias("n"))


def by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(paid_sum().alias("total"), F.sum("n").alias("n")).withColumn("mean", F.col("total") / F.col("n"))


def top_category(rows: DataFrame) -> DataFrame:
    """Of equal totals the category that sorts first."""
    best = F.min_by(F.struct("category", "total"), F.struct(-F.col("total"), F.col("category"))).alias("t")
    return by_category(rows).groupBy(*KEY).agg(best).select(*KEY, F.col("t.category").alias("top_category"), F.col("t.total").alias("top_category_amount"))


def top_merchant(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy(*KEY, "counterparty").agg(F.sum("n").alias("n"))
    best = F.min_by(F.struct("counterparty", "n"), F.struct(-F.col("n"), F.col("counterparty"))).alias("t")
    return counts.groupBy(*KEY).agg(best).select(*KEY, F.col("t.counterparty").alias("top_merchant"), F.col("t.n").alias("top_merchant_count"))


def extreme(rows: DataFrame, largest: bool = True) -> DataFrame:
    """The largest or smallest transaction of each month; of equals the earliest, then the lowest row."""
    side = "most" if largest else "least"
    row = F.struct(*[F.col(f"{side}.{c}").alias(c) for c in ("rank", "timestamp", "_row_id", "amount")], "category", "counterparty")
    return rows.groupBy(*KEY).agg(F.min(row).alias("t")).select(*KEY, "t.timestamp", "t.amount", "t.category", "t.counterparty")


def compare_categories(rows: DataFrame) -> DataFrame:
    """Each pair of a month's categories with both totals. Pairs are of categories, never of rows."""
    totals = by_category(rows).select(*KEY, F.struct("category", "total").alias("x"))
    listed = totals.groupBy(*KEY).agg(F.array_sort(F.collect_list("x")).alias("all"))
    first = listed.select(*KEY, F.posexplode("all").alias("at", "a"), "all")
    later = first.select(*KEY, "a", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("b"))
    return later.select(*KEY, F.col("a.category").alias("category_a"), F.col("a.total").alias("total_a"), F.col("b.category").alias("category_b"), F.col("b.total").alias("total_b"))


def compare_periods(rows: DataFrame, first: Column, second: Column) -> DataFrame:
    """Totals of two months side by side, from one scan; null for a month without spend."""
    total = lambda m: F.sum(F.when(F.col("month") == m, F.col("paid"))).cast("double")
    return rows.filter(F.col("month").isin(first, second)).groupBy("entity_id").agg(total(first).alias("p1"), total(second).alias("p2"))


def listing(df: DataFrame) -> DataFrame:
    """Transactions with their month, to be filtered; spend or not."""
    return with_month(df).select(*KEY, "timestamp", "amount", "category", "counterparty", "_row_id")


def listing_by_category(df: DataFrame) -> DataFrame:
    """Each list that a question for a category and a month shows, with the place of its rows in time; rows of one time have
    one place."""
    place = F.rank().over(Window.partitionBy(*KEY, "category").orderBy("timestamp")).cast("long")
    return with_month(df).filter("category IS NOT NULL").select(*KEY, "category", "timestamp", "amount", "counterparty", place.alias("place"))


def range_totals(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (entity_id, month, from_day, from_segment, to_day, to_segment: the first cell that is in and the first that
    isn't) with the total (null without rows) and n of their spend: each end is looked up in the entity's running sums, by
    standing among its days."""
    daily = rows.groupBy("entity_id", "day", "segment").agg(F.sum("paid").alias("paid"), F.sum("n").alias("n"))
    end = lambda name, sign: F.struct(F.col(f"{name}_day").alias("day"), F.col(f"{name}_segment").alias("segment"), F.lit(sign).alias("sign"))
    ends = ranges.select(*KEY, F.explode(F.array(end("from", -1), end("to", 1))).alias("e")).select(*KEY, "e.*")
    both = daily.withColumns({"month": F.lit(None).cast("timestamp_ntz"), "sign": F.lit(0)}).unionByName(ends.withColumns({"paid": F.lit(0).cast("decimal(38,4)"), "n": F.lit(0).cast("long")}))
    before = Window.partitionBy("entity_id").orderBy("day", "segment", F.col("sign") == 0).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # three rows a day
    run = both.withColumns({"_paid": F.sum("paid").over(before), "_n": F.sum("n").over(before)}).filter("sign <> 0")
    found = run.groupBy(*KEY).agg(F.sum(F.when(F.col("sign") > 0, F.col("_paid")).otherwise(-F.col("_paid"))).cast("double").alias("total"), F.sum(F.col("sign") * F.col("_n")).alias("n"))
    return found.select(*KEY, F.when(F.col("n") > 0, F.col("total")).alias("total"), "n")


def trend(rows: DataFrame, months: DataFrame) -> DataFrame:
    """For each (entity, month): the total of the period of equal length just before it, which starts a second into a day."""
    since = F.col("month") - (month_end("month") - F.col("month"))
    ranges = months.select(*KEY, F.to_date(since).alias("from_day"), F.lit(1).alias("from_segment"), F.to_date("month").alias("to_day"), F.lit(0).alias("to_segment"))
    return range_totals(rows, ranges).select(*KEY, F.col("total").alias("prev_total"))


def facts(df: DataFrame | Cells, by: Convention | None = None, least: int = 5) -> DataFrame:
    """All facts of each month of the entities with at least ``least`` transactions. The rows are read once."""
    df = cells(df)
    rows = spend(df, by or detect(df))
    eligible = df.all.groupBy("entity_id").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= least).select("entity_id")
    core = by_month(rows).join(eligible, "entity_id", "left_semi").filter("total != 0")
    largest = extreme(rows).select(*KEY, F.abs("amount").alias("max_amount"), F.col("category").alias("max_category"), F.col("counterparty").alias("max_merchant"))
    currency = majority(df, "currency", ["entity_id"])
    out = core.join(top_category(rows), KEY, "left").join(top_merchant(rows), KEY, "left").join(largest, KEY, "left").join(trend(rows, core), KEY, "left").join(currency, "entity_id", "left")
    change = F.when(F.col("prev_total") != 0, (F.col("total") - F.col("prev_total")) / F.col("prev_total") * 100)
    return out.select(
        *KEY, F.col("total").alias("total_spend"), F.col("n").alias("transaction_count"),
        "top_category", "top_category_amount", (F.col("top_category_amount") / F.col("total") * 100).alias("top_category_pct"),
        "top_merchant", "top_merchant_count", "max_amount", "max_category", "max_merchant",
        F.when(change > 0, "up").when(change <= 0, "down").alias("trend_direction"), F.abs(change).alias("trend_pct"), "currency",
    )
