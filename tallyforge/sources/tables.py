"""Sources and sinks: CSV files of any header, JSON lines, manifests, and two synthetic providers."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions.parsing import portable_hash
from tallyforge.sources import csvfile

def read_csv_strict(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as strings; short rows are padded with nulls, a row with too many fields fails the read. Quoted fields
    may hold line breaks (so ``multi_line`` makes no difference); files are read in parts all the same. ``_row_id`` numbers
    the rows from 0."""
    return csvfile.read(spark, path, strict=True).df


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """As ``read_csv_strict``, but rows with too many fields are skipped."""
    return csvfile.read(spark, path).df


def numbered(df: DataFrame, name: str = "_row_id") -> DataFrame:
    """``df`` with dense numbers from 0. Rows of Parquet files are numbered by file name and place in the file, whatever the
    partitions. Other relations are numbered in the order of their partitions; each
    must give the same rows whenever it is computed."""
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
        sizes = placed.groupBy("_file").agg((F.max("_place") + 1).alias("_n"))
        plain = df.columns == [c for c in placed.columns if c not in ("_file", "_place")] and placed.agg(F.count("*").alias("n")).first()["n"] == (sizes.agg(F.sum("_n").alias("n")).first()["n"] or 0)
    except AnalysisException:
        plain = False
    if not plain:  # no file, or rows were filtered
        placed = df.select("*", F.spark_partition_id().alias("_file"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
        before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
        sizes = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_file").withColumn(name, F.col("_place") + F.col("_start")).select(*df.columns, name)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def read_sources(spark: SparkSession, paths: dict[str, str], strict: bool = False) -> dict[str, DataFrame]:
    """One relation a source, each with its own columns; sources without rows are left out."""
    read = read_csv_strict if strict else read_csv
    found = {name: read(spark, path) for name, path in paths.items()}
    return {name: df for name, df in found.items() if has_rows(df)}


def write_jsonl(examples: DataFrame, path: str) -> None:
    """One folder a split."""
    examples.write.mode("overwrite").partitionBy("split").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def safe_name(name: str) -> str:
    return re.sub(r"[^\w-]+", "_", name).strip("_") or "source"


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)


def write_manifest(manifest: dict, path: str) -> None:
    """One JSON file, in any store that Spark can write to."""
    spark = SparkSession.active()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(json.dumps(manifest, indent=2, default=str).encode()))
    finally:
        out.close()


#: What the synthetic merchants sell, and the channels.
MERCHANTS = {
    "Whole Foods": "groceries", "Amazon": "electronics", "Uber": "travel", "Delta Airlines": "travel", "Netflix": "entertainment", "Shell": "fuel",
    "Target": "clothing", "Best Buy": "electronics", "CVS Pharmacy": "healthcare", "Starbucks": "dining", "Spotify": "subscription", "City Power & Light": "utilities",
}
CHANNELS = ["card_present", "card_not_present", "online", "atm", "mobile_app"]


def draw(seed: int, purpose: str, *by: str) -> Column:
    """A number between 0 and 1 that depends on seed, purpose and the columns ``by`` only: the same for any partitioning, and
    in any engine that has md5."""
    return (portable_hash(F.lit(f"{seed}{purpose}"), *[F.col(b) for b in by]) + 0.5) / float(1 << 32)


def normal(seed: int, purpose: str, *by: str) -> Column:
    """A standard normal draw, from two uniform ones (Box and Muller)."""
    return F.sqrt(-2.0 * F.log(draw(seed, purpose + "1", *by))) * F.cos(2.0 * F.pi() * draw(seed, purpose + "2", *by))


def synthetic_for(entities: DataFrame, days: int = 90, seed: int = 42) -> DataFrame:
    """15 to 59 transactions for each of ``entities`` (entity_id) over ``days`` days from 2026-01-01: log-normal amounts, a
    category that follows the merchant in nine cases of ten, and two per cent of anomalies. A row's draws depend on the
    seed, its entity and its number ``k``."""
    categories = sorted(set(MERCHANTS.values()))
    at = ("entity_id", "k")
    pick = lambda items, purpose: F.get(F.array(*[F.lit(x) for x in items]), F.floor(draw(seed, purpose, *at) * len(items)).cast("int"))
    users = entities.select("entity_id", F.explode(F.sequence(F.lit(1), F.floor(draw(seed, "count", "entity_id") * 45 + 15).cast("int"))).alias("k"))
    drawn = users.select(
        *at,
        F.timestamp_seconds(F.lit(1767225600) + F.floor(draw(seed, "second", *at) * days * 86400) + F.floor(draw(seed, "hour", *at) * 24) * 3600).cast("timestamp_ntz").alias("timestamp"),
        pick(list(MERCHANTS), "merchant").alias("counterparty"), pick(categories, "category").alias("other"), draw(seed, "noise", *at).alias("noise"), pick(CHANNELS, "channel").alias("way"),
        F.exp(normal(seed, "paid", *at) * 0.9 + 3.2).alias("paid"), draw(seed, "odd", *at).alias("odd"), draw(seed, "times", *at).alias("times"),
    )
    usual = F.create_map(*[F.lit(x) for pair in MERCHANTS.items() for x in pair])
    strange = F.col("odd") < 0.02
    return drawn.select(
        "entity_id", "k", "timestamp", F.round(F.col("paid") * F.when(strange, F.col("times") * 9 + 6).otherwise(1.0), 2).alias("amount"), F.lit("USD").alias("currency"),
        F.when(F.col("noise") > 0.10, F.element_at(usual, F.col("counterparty"))).otherwise(F.col("other")).alias("category"),
        F.when(strange, "online").otherwise(F.col("way")).alias("channel"), "counterparty", F.lit("COMPLETED").alias("status"), strange.cast("int").alias("label"),
    )


def synthetic_base(spark: SparkSession, entities: int | DataFrame = 40, days: int = 90, seed: int = 42) -> DataFrame:
    """``synthetic_for`` numbered entities, or those of a relation."""
    ids = entities if isinstance(entities, DataFrame) else spark.range(entities).select(F.format_string("CUST%04d", "id").alias("entity_id"))
    return synthetic_for(ids, days, seed).drop("k")


def provider_a(spark: SparkSession, seed: int = 42, entities: int | DataFrame = 40) -> DataFrame:
    """Readable headers, ISO dates, spend as negative amounts."""
    return synthetic_base(spark, entities, seed=seed).select(
        F.col("entity_id").alias("account_id"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("txn_date"), (-F.col("amount")).alias("amount"), "currency",
        F.col("category").alias("merchant_category"), F.col("channel").alias("payment_channel"), F.col("counterparty").alias("merchant_name"), F.col("status").alias("txn_status"), F.col("label").alias("is_fraud"),
    )


def provider_b(spark: SparkSession, seed: int = 43, entities: int | DataFrame = 40) -> DataFrame:
    """Short headers, whole cents, day-first dates, a debit mark for the sign."""
    return synthetic_base(spark, entities, seed=seed).select(
        F.col("entity_id").alias("acct_no"), F.date_format("timestamp", "dd/MM/yyyy HH:mm").alias("date"), F.round(F.col("amount") * 100).cast("int").alias("amt_cents"), F.col("category").alias("mcc"),
        F.col("channel").alias("chnl"), F.col("counterparty").alias("merchant"), F.lit("DR").alias("dr_cr"), F.col("label").alias("fraud_flag"),
    )
