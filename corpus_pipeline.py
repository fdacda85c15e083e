"""From raw documents to shards: each stage reads what the one before it wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, langid, mixing, sharding, simhash
from tallyforge.llm.shared import fold, table, written

#: A document whose predicted language holds less than this share of its trigrams is rejected.
MIN_LANGUAGE_SCORE = 0.3

#: A batch of texts for Python has this many bytes or a little more, not ten thousand texts of any length: the executor and its
#: workers each hold some batches, next to what the stages before have left in the heap.
BATCH_BYTES = 2 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Language ID, shingle sets, tiling and fitted rates are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on batches to BATCH_BYTES. It stays: what a stage returns runs later."""
    digits, unit = re.match(r"(\d+)\s*([kmgtp]?)", spark.conf.get(BATCH_CONF).lower()).groups()
    if int(digits) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, or in none of the learnt languages, go. Learnt from the same rows as
    the operator's query."""
    small_batches(spark)
    model = langid.train(docs.filter(fold(F.col("doc_id"), 4) != 2))
    found = docs.select(F.struct("*").alias("doc"), langid.predicted(spark, model, F.col("text")).alias("p"))
    return found.filter((F.col("p.lang_pred") != langid.UNKNOWN) & (F.col("p.score") >= MIN_LANGUAGE_SCORE)).select("doc.*")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup by fingerprints of five-word shingles, verified at a similarity of 0.8: one document of each group stays."""
    small_batches(spark)
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold an item of the benchmark go."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each document stays as often as its rate says."""
    small_batches(spark)
    return mixing.mixed(docs, mixing.label_domains(table(spark, sf_dir, "labels")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: a shard and a slot for each document."""
    return sharding.shard_plan(docs)


STAGES = [("language", language), ("dedup", dedup), ("decontaminate", decontaminated), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
