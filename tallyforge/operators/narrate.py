"""Summaries whose every number is a fact of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.parsing import portable_hash
from tallyforge.operators.facts import Cells, Convention, facts, month_end
from tallyforge.operators.shape import decimals
from tallyforge.operators.split import label

#: Signs of currencies.
SIGNS = {"USD": "$", "EUR": "€", "GBP": "£", "INR": "₹", "JPY": "¥"}
FACTS = ["total_spend", "transaction_count", "top_category", "top_category_amount", "top_category_pct", "top_merchant", "top_merchant_count", "max_amount", "max_category", "max_merchant", "trend_direction", "trend_pct", "currency"]


def currency_sign(code: Column) -> Column:
    known = F.coalesce(*[F.when(code == c, F.lit(s)) for c, s in SIGNS.items()])
    return F.coalesce(known, F.concat(F.nullif(code, F.lit("")), F.lit(" ")), F.lit("$"))


def whole(c: Column) -> Column:
    return c.cast("decimal(30,6)").cast("decimal(30,0)").cast("string")


def narrative(choice: Column) -> Column:
    """One to five sentences; those without their facts are left out. ``choice``: 0 to 3, of two phrasings for each of
    the two middle sentences."""
    sign, month = currency_sign(F.col("currency")), F.date_format("month", "MMMM yyyy")
    put = lambda text, *cols: F.format_string(text, *cols)
    paid = lambda c: F.concat(sign, decimals(F.col(c)))
    share = whole(F.col("top_category_pct"))
    first = put("In %s, you made %d transaction%s totaling %s.", month, F.col("transaction_count"), F.when(F.col("transaction_count") == 1, "").otherwise("s"), paid("total_spend"))
    top = F.when(choice % 2 == 0, put("Most of that went to %s (%s, %s%% of your spending).", F.col("top_category"), paid("top_category_amount"), share)).otherwise(
        put("%s was your top category at %s (%s%% of the total).", F.col("top_category"), paid("top_category_amount"), share)
    )
    shop = F.when(F.floor(choice / 2) == 0, put("You shopped most often at %s (%d times).", F.col("top_merchant"), F.col("top_merchant_count"))).otherwise(
        put("%s was your most frequent merchant, with %d visits.", F.col("top_merchant"), F.col("top_merchant_count"))
    )
    most = put("Your largest single transaction was %s at %s (%s).", paid("max_amount"), F.coalesce("max_merchant", F.lit("None")), F.coalesce("max_category", F.lit("None")))
    trend = put("Compared to the previous period, spending was %s by %s%%.", F.col("trend_direction"), whole(F.col("trend_pct")))
    has = lambda c, text: F.when(F.col(c).isNotNull(), text)
    return F.concat_ws(" ", first, has("top_category", top), has("top_merchant", shop), F.when(F.col("max_amount") != 0, most), has("trend_direction", trend))


def examples(df: DataFrame | Cells, cuts: DataFrame, by: Convention, phrasings: int = 2, seed: int = 0) -> DataFrame:
    found = facts(df, by).join(F.broadcast(cuts), F.lit(True))  # one row
    each = found.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(phrasings - 1))))
    choice = portable_hash(F.lit(f"{seed}summary"), F.col("entity_id"), F.date_format("month", "yyyy-MM"), F.col("variant")) % 4
    return each.select(
        F.lit("spend_summarization").alias("task"), "entity_id", "month", "variant",
        F.format_string("Summarize my spending in %s.", F.date_format("month", "MMMM yyyy")).alias("instruction"),
        narrative(choice).alias("output"), F.struct(*FACTS).alias("facts_used"), F.lit(True).alias("output_is_fact_grounded"),
        label(month_end("month"), F.col("train_cutoff"), F.col("val_cutoff")).alias("split"),
    )
