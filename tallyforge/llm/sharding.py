"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source. A row of rank r among the n rows of its source gets the
fractional rank (r + 0.5) / n; all rows in order of fractional rank are cut into shards of equal row counts. Each
shard thus covers the same share of every source, and the shards' row counts differ by one at most.

Ranks come from two range-partitioned sorts of narrow rows (no texts), so a source with a third of all rows is
spread over many tasks. Only tables of one row per partition and source are summed up by windows.

Defined cases: a null source is a stratum of its own; a null text has size 1 and the CRC of the empty text; a null id
is shuffled like any other; repeated rows get places of their own; an empty table gives an empty result. Of the
input only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.shared import new_path, written

SEED = 20


def _ordered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows of ``df`` in a total order, as ``part`` (a partition's number) and ``local`` (the place in it)."""
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    stored = written(spread.withColumn("_place", place), name)
    return stored.withColumn("_part", F.shiftright("_place", 33)).withColumn(
        "_local", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    ).drop("_place")


def assign_shards(rows: DataFrame, stratum: Column, key: Column, n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within each shard).

    ``rows`` should be narrow: they are sorted twice. ``key`` is the seeded shuffle key of a row."""
    columns = [f"c{i}" for i in range(len(rows.columns))]  # private names, whatever the rows call theirs
    stratum_text = F.coalesce(F.concat(F.lit("="), stratum.cast("string")), F.lit("null"))
    named = rows.select(*[rows[c].alias(n) for c, n in zip(rows.columns, columns)], stratum_text.alias("_stratum"), key.alias("_key"))

    by_source = _ordered(named, ["_stratum", "_key", *columns], "shard-source")
    counts = by_source.groupBy("_stratum", "_part").agg(F.count("*").alias("_count"), F.min("_local").alias("_first"))
    each = Window.partitionBy("_stratum").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_stratum", "_part",
        (F.coalesce(F.sum("_count").over(each), F.lit(0)) - F.col("_first")).alias("_offset"),
        F.sum("_count").over(Window.partitionBy("_stratum")).alias("_of"),
    )
    ranked = by_source.join(offsets, ["_stratum", "_part"]).select(
        *columns, "_stratum", "_key", ((F.col("_local") + F.col("_offset") + 0.5) / F.col("_of")).alias("_share")
    ).withColumn("_tie", F.xxhash64(F.lit(SEED), "_stratum"))

    mixed = _ordered(ranked, ["_share", "_tie", "_stratum", "_key"], "shard-order")
    sizes = mixed.groupBy("_part").agg(F.count("*").alias("_count"))  # one row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"),
        F.sum("_count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    placed = mixed.join(starts, "_part").withColumn("_place", F.col("_local") + F.col("_start"))
    placed = placed.withColumn("_shard", F.expr(f"_place * {int(n_shards)} div _all"))
    placed = placed.withColumn("_slot", F.col("_place") - F.expr(f"(_shard * _all + {int(n_shards) - 1}) div {int(n_shards)}"))
    return placed.select(*[F.col(n).alias(c) for c, n in zip(rows.columns, columns)], F.col("_shard").cast("int").alias("shard"), F.col("_slot").alias("slot"))


def shard_plan(docs: DataFrame, n_shards: int = 16, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, source, shard, slot."""
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    key = F.xxhash64(F.lit(SEED), "doc_id", "text_crc32")
    return assign_shards(narrow, F.col("source"), key, n_shards)


def write_shards(docs: DataFrame, path: str | None = None, n_shards: int = 16, doc_id: str = "doc_id") -> str:
    """Write whole documents as Parquet, one folder a shard, ordered by slot within each file. Documents with equal
    (id, size, CRC) are interchangeable, so each such row takes one of their places."""
    path = path or new_path(docs.sparkSession, "shards")
    content = F.coalesce(F.col("text"), F.lit(""))
    plan = shard_plan(docs, n_shards, doc_id)
    mark = [F.coalesce(F.col(doc_id), F.lit(-1).cast(docs.schema[doc_id].dataType)), F.octet_length(content).cast("long") + 1, F.crc32(content.cast("binary"))]
    plan_mark = [F.coalesce(F.col("doc_id"), F.lit(-1).cast(docs.schema[doc_id].dataType)), F.col("size"), F.col("text_crc32")]
    nth = lambda cols: F.row_number().over(Window.partitionBy(*cols).orderBy(F.lit(0)))
    left = docs.select(F.struct("*").alias("doc"), *[c.alias(f"k{i}") for i, c in enumerate(mark)])
    left = left.withColumn("nth", nth(["k0", "k1", "k2"]))
    right = plan.select("shard", "slot", *[c.alias(f"k{i}") for i, c in enumerate(plan_mark)])
    right = right.withColumn("nth", nth(["k0", "k1", "k2"]))
    joined = left.join(right, ["k0", "k1", "k2", "nth"]).select("doc", "shard", "slot")
    per = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_shards)
    spread = joined.repartition(n_shards * per, "shard", F.col("slot") % per).sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
    return path


def op10(spark, sf_dir):
    from tallyforge.llm.shared import table

    plan = shard_plan(table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
