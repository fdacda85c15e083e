"""Month totals of a stream of canonical transactions: the batch relation's twin, with late rows up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.parsing import money


def month_spend(transactions: DataFrame, late: str = "7 days", signed: bool = True) -> DataFrame:
    """Running total and count of each entity and month; update mode sends those that changed."""
    rows = transactions.filter(F.col("amount") < 0) if signed else transactions
    timed = rows.withColumn("at", F.col("timestamp").cast("timestamp")).withWatermark("at", late)
    month = F.date_trunc("MONTH", "at").cast("timestamp_ntz").alias("month")
    return timed.groupBy("entity_id", month).agg(F.sum(money(F.abs("amount"))).cast("double").alias("total"), F.count("*").alias("n"))
