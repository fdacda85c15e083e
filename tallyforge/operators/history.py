"""An entity's rows in order of time, with those right before them, when one entity may hold any share of all rows.

Windows by entity put an entity's rows into one task. Entities of more than ``hot_rows`` rows are therefore sorted by
ranges of (entity, time, row) first; each range is a chunk, and gets the last rows before it as a halo. Windows by
(entity, chunk) then see what windows by entity would, for any frame of up to ``back`` rows before the current one.
Other entities are one chunk each. Without hot entities nothing is added but the count of rows by entity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.scratch import kept

#: Rows of an entity from which it is cut, and rows of its chunks.
HOT_ROWS, CHUNK_ROWS = 2_000_000, 500_000
_ADDED = ["_part", "_own", "_base", "_total"]


@dataclass
class History:
    """``rows``: chunks with their halos. Expressions over its windows hold for rows with ``_own``; ``done`` keeps these."""

    rows: DataFrame
    columns: list[str]

    @property
    def window(self):
        return Window.partitionBy("entity_id", "_part").orderBy("timestamp", "_row_id")

    @property
    def at(self) -> Column:
        """A row's place within its entity, from 1."""
        halo = F.count_if(~F.col("_own")).over(Window.partitionBy("entity_id", "_part"))
        return F.col("_base") + F.row_number().over(self.window) - halo

    @property
    def of(self) -> Column:
        """How many rows its entity has."""
        return F.coalesce("_total", F.count("*").over(Window.partitionBy("entity_id", "_part")))

    def done(self, df: DataFrame) -> DataFrame:
        return df.filter("_own").drop(*_ADDED)


def _small(df: DataFrame) -> DataFrame:
    return df.withColumns({"_part": F.lit(0), "_own": F.lit(True), "_base": F.lit(0).cast("long"), "_total": F.lit(None).cast("long")})


def history(df: DataFrame, back: int, hot_rows: int | None = None, chunk_rows: int | None = None) -> History:
    """``df`` (entity_id, timestamp, _row_id and more) for windows of up to ``back`` rows before the current one."""
    hot_rows, chunk_rows = hot_rows or HOT_ROWS, chunk_rows or CHUNK_ROWS
    hot = kept(df.groupBy("entity_id").agg(F.count("*").alias("_total")).filter(F.col("_total") > hot_rows).filter("entity_id IS NOT NULL"), "hot")
    rows = hot.agg(F.sum("_total")).first()[0]
    if not rows:
        return History(_small(df), df.columns)
    ids = hot.select("entity_id")
    ranged = df.join(ids, "entity_id", "left_semi").repartitionByRange(-(-rows // chunk_rows), "entity_id", "timestamp", "_row_id")
    cut = kept(ranged.select(*df.columns, (F.spark_partition_id() + 1).alias("_part")), "chunks")
    # A row for each entity and chunk: few against the rows.
    own = Window.partitionBy("entity_id").orderBy("_part")
    parts = cut.groupBy("entity_id", "_part").agg(F.count("*").alias("_n"))
    parts = kept(parts.select("entity_id", "_part", F.row_number().over(own).alias("_i"), F.coalesce(F.sum("_n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base")).join(hot, "entity_id"), "parts")
    latest = Window.partitionBy("entity_id", "_part").orderBy(F.desc("timestamp"), F.desc("_row_id"))
    last = cut.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= back).drop("_back")
    # Every chunk has a row of its entity at least, so what a chunk looks back on lies in the ``back`` chunks before it.
    sent = last.join(parts.select("entity_id", "_part", "_i"), ["entity_id", "_part"]).drop("_part").withColumn("_i", F.explode(F.sequence(F.col("_i") + 1, F.col("_i") + back)))
    halo = sent.join(parts.select("entity_id", "_i", "_part"), ["entity_id", "_i"]).withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= back)
    columns = [F.col(f"`{c}`") for c in df.columns]
    both = cut.select(*columns, "_part", F.lit(True).alias("_own")).unionByName(halo.select(*columns, "_part", F.lit(False).alias("_own")))
    placed = both.join(parts.select("entity_id", "_part", "_base", "_total"), ["entity_id", "_part"]).select(*columns, *_ADDED)
    cold = _small(df.join(ids, "entity_id", "left_anti")).select(*columns, *_ADDED)
    return History(cold.unionByName(placed), df.columns)
