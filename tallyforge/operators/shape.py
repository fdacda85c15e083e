"""Stage B: sequences of serialized transactions as training examples. Every builder returns one lazy relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.history import history
from tallyforge.plans.schema import EXTRA

CONTEXT = 10
#: Labels that count as fraud, and the instructions of the tasks.
FRAUD_LABELS = ["1", "1.0", "True", "true", "FRAUD"]
FRAUD_TEXT = (
    "Given this customer's recent transaction history, determine whether the most recent transaction is fraudulent. "
    "Respond with FRAUD or LEGITIMATE and a brief reason."
)
CATEGORY_TEXT = "Categorize the following transaction."


def decimals(c: Column) -> Column:
    """Two decimals, half up."""
    return c.cast("decimal(30,6)").cast("decimal(30,2)").cast("string")


def plain(c: Column) -> Column:
    """A double's text; without an exponent from 1e-4 up to below 1e16."""
    size = F.abs(c)
    fixed = F.regexp_replace(c.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3)), fixed).otherwise(c.cast("string"))


def serialized(columns: list[str], without: set[str] = frozenset()) -> Column:
    """``{date: ..., amount: ..., ...}``. Null values print as None; null extras are left out."""
    values = {"date": F.date_format("timestamp", "yyyy-MM-dd HH:mm"), "amount": decimals(F.col("amount"))}
    values |= {c: F.col(c) for c in ("currency", "category", "channel", "counterparty", "status")}
    parts = {k: F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit("None"))) for k, v in values.items()}
    for c in columns:
        if c.startswith(EXTRA):
            own = c[len(EXTRA):]
            given = F.concat(F.lit(f"{own}: "), F.col(f"`{c}`"))
            parts[own] = F.coalesce(given, parts[own]) if own in parts else given  # an extra may stand in for a field
    return F.concat(F.lit("{"), F.concat_ws(", ", *[p for k, p in parts.items() if k not in without]), F.lit("}"))


def with_context(df: DataFrame, n: int = CONTEXT) -> DataFrame:
    """``context``: the up to n last rows of an entity, serialized, oldest first."""
    seen = history(df, back=n - 1)
    return seen.done(seen.rows.withColumn("context", F.collect_list(serialized(df.columns)).over(seen.window.rowsBetween(-(n - 1), 0))))


def fraud_examples(df: DataFrame, n: int = CONTEXT, fraud: list[str] = FRAUD_LABELS) -> DataFrame:
    """An example for each labelled row; unlabelled rows are context only."""
    answer = F.when(F.col("label").isin(fraud), "FRAUD").otherwise("LEGITIMATE")
    return with_context(df, n).filter("label IS NOT NULL").select(
        F.lit("fraud_flagging").alias("task"), F.lit(FRAUD_TEXT).alias("instruction"), "context", answer.alias("output"), "split", "_row_id"
    )


def category_examples(df: DataFrame) -> DataFrame:
    """An example for each row, without its category in the text."""
    return df.select(
        F.lit("categorization").alias("task"), F.lit(CATEGORY_TEXT).alias("instruction"), F.array(serialized(df.columns, {"category"})).alias("context"),
        F.col("category").alias("output"), "split", "_row_id",
    )


def behaviour_examples(df: DataFrame, n: int = CONTEXT) -> DataFrame:
    """Windows of up to n rows that end at an entity's rows 2, 2 + n/2, ... and its last."""
    seen = history(df, back=n - 1)
    every = max(1, n // 2)
    placed = seen.done(seen.rows.select(
        "split", "_row_id", seen.at.alias("_at"), seen.of.alias("_of"), "_own",
        F.collect_list(serialized(df.columns)).over(seen.window.rowsBetween(-(n - 1), 0)).alias("sequence"),
    ))
    ends = placed.filter((F.col("_at") >= 2) & (((F.col("_at") - 2) % every == 0) | (F.col("_at") == F.col("_of"))))
    return ends.select(F.lit("general_behavioral").alias("task"), "sequence", "split", "_row_id")


BUILDERS = {"fraud_flagging": fraud_examples, "categorization": category_examples, "general_behavioral": behaviour_examples}


def shape(df: DataFrame, task: str) -> DataFrame:
    return BUILDERS[task](df)


def shape_stats(examples: DataFrame) -> DataFrame:
    """Examples by split and, where there is one, by output."""
    by = [c for c in ("task", "split", "output") if c in examples.columns]
    return examples.groupBy(*by).agg(F.count("*").alias("n"))


def unlabelled(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("label").isNull()).alias("skipped_unlabeled_rows"))
