"""Measures of trained models, and rebalancing of their training data."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyforge.operators import sqlpairs
from tallyforge.operators.narrate import whole
from tallyforge.operators.shape import decimals
from tallyforge.operators.sqlpairs import same_rows  # noqa: F401

GOOD, WEAK = 0.15, 0.03
BUCKETS = 1024


def baselines(examples: DataFrame) -> DataFrame:
    """One row from rows (split, output): classes, the random baseline, the majority class of train (of equals the
    first by name) and its share of val."""
    classes = examples.filter(F.col("split").isin("train", "val")).agg(F.count_distinct("output").alias("num_classes"))
    counts = examples.filter("split = 'train'").groupBy("output").agg(F.count("*").alias("n"))
    top = counts.agg(F.min_by("output", F.struct(-F.col("n"), F.col("output"))).alias("majority"))
    val = examples.filter("split = 'val'").join(F.broadcast(top), F.lit(True)).agg(F.avg((F.col("output") == F.col("majority")).cast("int")).alias("majority_baseline"), F.first("majority").alias("majority"))
    return classes.join(val, F.lit(True)).select("num_classes", (1.0 / F.col("num_classes")).alias("random_baseline"), "majority", "majority_baseline")


def per_class_accuracy(predictions: DataFrame) -> DataFrame:
    """From rows (label, predicted): label, n, accuracy to three decimals."""
    return predictions.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg((F.col("label") == F.col("predicted")).cast("int")), 3).alias("accuracy"))


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.avg((F.col("label") == F.col("predicted")).cast("int")).alias("accuracy"))


def verdict(final: Column, majority: Column) -> Column:
    margin = final - majority
    return F.when(margin.isNull(), "none").when(margin > GOOD, "good").when(margin > WEAK, "weak").otherwise("none")


def small_sample(train: int, val: int) -> str | None:
    return f"small sample (train={train}, val={val}): results are noisy" if train < 50 or val < 20 else None


def eligible(examples: DataFrame, train: int = 20, val: int = 5) -> bool:
    n = {r["split"]: r["n"] for r in examples.groupBy("split").agg(F.count("*").alias("n")).collect()}  # one row a split
    return n.get("train", 0) >= train and n.get("val", 0) >= val


def grid_summary(runs: DataFrame, measure: str = "margin_over_majority") -> DataFrame:
    """Mean, sample deviation (0 for one run) and number of runs of each dataset and config."""
    return runs.groupBy("dataset", "model_config").agg(F.avg(measure).alias("mean"), F.coalesce(F.stddev_samp(measure), F.lit(0.0)).alias("std"), F.count(measure).alias("n_seeds")).orderBy("dataset", F.desc("mean"))


def grid_pivot(summary: DataFrame, configs: list[str]) -> DataFrame:
    return summary.groupBy("dataset").pivot("model_config", configs).agg(F.first("mean"))


def repeated(examples: DataFrame, is_scarce: Column, need: Column, key: str) -> DataFrame:
    """``examples`` and ``need`` more rows (an expression over n, all rows, and scarce, the scarce ones), dealt in turn
    over the scarce rows. Their order is that of (key % BUCKETS, key), for a long ``key``: rows are numbered within their
    buckets and the buckets' sizes summed up, so no task numbers them all."""
    sizes = examples.agg(F.count("*").alias("n"), F.count_if(is_scarce).alias("scarce"))
    marked = examples.filter(is_scarce).withColumn("_bucket", F.pmod(F.col(key), F.lit(BUCKETS)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows
    starts = marked.groupBy("_bucket").agg(F.count("*").alias("_size")).select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    scarce = marked.withColumn("_in", within).join(F.broadcast(starts), "_bucket").withColumn("_at", F.col("_in") + F.col("_start")).drop("_in", "_start", "_bucket")
    more = scarce.join(F.broadcast(sizes.withColumn("_need", F.greatest(F.lit(0), need))), F.lit(True))
    times = F.floor((F.col("_need") - F.col("_at") + F.col("scarce") - 1) / F.col("scarce")).cast("int")
    copies = more.withColumn("_times", times).filter("_times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "_times")))
    return examples.withColumn("copy", F.lit(0)).unionByName(copies.select(*examples.columns, "copy"))


def oversample_minority(examples: DataFrame, label: str, scarce: str, ratio: float = 0.15, key: str = "_row_id") -> DataFrame:
    """Copies of the scarce class until it is ``ratio`` of all; none if it is already."""
    need = F.floor((F.col("n") - F.col("scarce")) * F.lit(ratio) / F.lit(1 - ratio)).cast("long") - F.col("scarce")
    return repeated(examples, F.col(label) == scarce, need, key)


def balance_kind(examples: DataFrame, kind: str, share: float = 0.20, key: str = "_row_id") -> DataFrame:
    """Copies of one template kind until it is ``share`` of the original number of rows."""
    need = F.floor(F.col("n") * F.lit(share)).cast("long") - F.col("scarce")
    return repeated(examples, F.col("template_kind") == kind, need, key)


def class_weights(examples: DataFrame, label: str = "output") -> DataFrame:
    counts = examples.groupBy(label).agg(F.count("*").alias("n"))
    all_ = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    return counts.join(F.broadcast(all_), F.lit(True)).select(label, "n", (F.col("total") / (F.col("k") * F.col("n"))).alias("weight"))


def latest_first(context: Column) -> Column:
    """The context as one text, its last entry first."""
    return F.array_join(F.concat(F.slice(context, -1, 1), F.slice(context, 1, F.size(context) - 1)), " ")


def question_prompt(question: Column, entity: Column) -> Column:
    """What a question-to-SQL model reads; without the entity it couldn't write the filter."""
    return F.concat(F.lit("Question: "), question, F.lit(" Entity: "), entity, F.lit(" SQL:"))


def summary_prompt(instruction: Column, f) -> Column:
    """What a summary model reads: the instruction and the facts it may use."""
    return F.concat(instruction, F.lit(" Facts: "), facts_string(f), F.lit(" Summary:"))


def behaviour_text(sequence: Column) -> Column:
    """A behaviour example as one text, for perplexity."""
    return F.array_join(sequence, " ")


def first_statement(sql: Column) -> Column:
    return F.trim(F.substring_index(sql, ";", 1))


def perplexity(loss: Column) -> Column:
    return F.when(loss < 20, F.exp(loss)).otherwise(F.lit(float("inf")))


@F.arrow_udf(DoubleType())
def _exp(losses: pa.Array) -> pa.Array:
    """The C library's ``exp``: the JVM's is another double for one value in ten."""
    return pa.array([None if x is None else math.exp(x) for x in losses.to_pylist()], pa.float64())


def rounded_perplexity(loss: Column, digits: int) -> Column:
    """``perplexity`` as SQL's ``round(exp(loss), digits)`` gives it elsewhere, to the last bit: scaled, rounded and scaled
    back. ``F.round`` of the JVM's ``exp`` is another number for about one loss in a million."""
    scale = float(10**digits)
    return F.when(loss < 20, F.round(_exp(F.when(loss < 20, loss)) * scale, 0) / scale).otherwise(F.lit(float("inf")))


def facts_string(f) -> Column:
    """The facts that a summary may use, as ``name: value`` pairs. ``f``: a function from a fact's name to its column."""
    parts = [
        F.concat(F.lit("total: "), decimals(f("total_spend"))), F.concat(F.lit("count: "), f("transaction_count").cast("string")),
        F.concat(F.lit("top category: "), f("top_category"), F.lit(" ("), decimals(f("top_category_amount")), F.lit(")")),
        F.concat(F.lit("top merchant: "), f("top_merchant")), F.concat(F.lit("largest: "), decimals(f("max_amount"))),
        F.concat(F.lit("trend: "), f("trend_direction"), F.lit(" "), whole(f("trend_pct")), F.lit("%")),
    ]
    return F.concat_ws(", ", *parts)


def fact_inclusion(text: Column, f) -> Column:
    """The share of up to five facts that a text holds: total, count, top category, top merchant, trend. Numbers are
    searched as substrings, so 1 is found in 12."""
    low = F.lower(text)
    number = lambda c: text.contains(decimals(c)) | text.contains(whole(c))
    checks = F.array(
        number(f("total_spend")), text.contains(f("transaction_count").cast("string")), low.contains(F.lower(f("top_category"))),
        low.contains(F.lower(f("top_merchant"))), F.when(f("trend_direction").isNotNull(), low.contains(f("trend_direction"))),
    )
    given = F.array_compact(checks)
    return F.try_divide(F.size(F.filter(given, lambda x: x)).cast("double"), F.size(given))


def query_rates(spark, pairs: DataFrame) -> dict[str, float | int]:
    """Of the pairs (generated, reference) of a table: how many, and the shares that are executable and correct."""
    return sqlpairs.rates(spark, pairs).summary().first().asDict()


def comparison(parts: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Long rows (approach, task, metric, value) from one-row relations of measures."""
    out = None
    for approach, task, row in parts:
        long = row.select(F.explode(F.create_map(*[x for c in row.columns for x in (F.lit(c), F.col(c).cast("double"))])).alias("metric", "value"))
        long = long.select(F.lit(approach).alias("approach"), F.lit(task).alias("task"), "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out
