"""Connected components of a graph given by its links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round. Large star: of a node's neighbours the greater ones are linked to the smallest of the
    neighbourhood. Small star: a node's smaller neighbours, and itself, are linked to the smallest of them."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    if large:
        both = both.union(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low"))
    kept = both.filter("other > node") if large else both
    moved = kept.join(least, "node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    if not large:
        moved = moved.union(least.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return moved.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b))")).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links``: rows (a, b) of two longs; self-links and repeats do no harm. Returns (node, root) for each node
    that has a link, root being the smallest node of its component. No links: no rows.

    Links, labels and groups stay distributed; the driver sees three numbers a round. Each round is written to the
    shared folder, so a lost executor costs one round at most."""
    links = written(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = _mark(links)
    while mark[0]:
        links = written(_star(_star(links, large=True), large=False), name)
        last, mark = mark, _mark(links)
        if mark == last:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
