"""Chronological splits with cutoffs that all entities share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN, VAL = 0.70, 0.15


def cutoffs(df: DataFrame, train: float = TRAIN, val: float = VAL) -> DataFrame:
    """One row (train_cutoff, val_cutoff): the timestamps at the places int(n * share) in order of time.

    Rows are counted by timestamp, and the counts summed up by day first, so no task sorts all rows; within the two
    days that hold a cutoff the sum goes on by timestamp."""
    if not (0 < train < 1 and 0 <= val <= 1 - train):
        raise ValueError("train and val must be shares that leave a rest")
    each = df.groupBy("timestamp").agg(F.count("*").alias("n"))
    daily = each.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("n").alias("n"))
    w = Window.orderBy("day")  # one row a day
    daily = daily.select("day", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    inner = Window.partitionBy("day").orderBy("timestamp")
    placed = each.withColumn("day", F.to_date("timestamp")).join(daily, "day").withColumn("last", F.sum("n").over(inner) + F.col("before"))
    at = lambda share: F.least(F.floor(F.col("total") * F.lit(share)), F.col("total") - 1)
    cut = lambda share: F.min(F.when(F.col("last") > at(share), F.col("timestamp")))
    return placed.agg(cut(train).alias("train_cutoff"), cut(train + val).alias("val_cutoff"))


def label(at: Column, train_cutoff: Column, val_cutoff: Column) -> Column:
    return F.when(at <= train_cutoff, "train").when(at <= val_cutoff, "val").otherwise("test")


def with_split(df: DataFrame, cuts: DataFrame) -> DataFrame:
    cuts = F.broadcast(cuts)  # one row
    return df.join(cuts, F.lit(True)).withColumn("split", label(F.col("timestamp"), F.col("train_cutoff"), F.col("val_cutoff"))).drop("train_cutoff", "val_cutoff")


def split_counts(df: DataFrame) -> DataFrame:
    """A row for each split, with 0 for one without rows."""
    names = df.sparkSession.createDataFrame([("train",), ("val",), ("test",)], "split string")
    return names.join(df.groupBy("split").agg(F.count("*").alias("n")), "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))
