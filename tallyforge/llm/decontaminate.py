"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed, a run of ``MIN_TILE`` tokens, are tiled: the longest runs of tokens
that both have unmarked are marked as tiles, again and again, until none of MIN_TILE tokens is left. Runs are found by
Karp-Rabin hashes of all unmarked windows of a length, which falls as runs get shorter, and are verified token by
token. An item whose tiles cover ``THRESHOLD`` of its tokens or more is in the document, in whatever order.

The benchmark is the stated query set: it is cut into blocks of about ``BLOCK_TOKENS`` tokens, each block is broadcast
in turn, and all documents are read against it. Documents never leave their rows, so a passage that a third of them
share makes no skew.

Tokens are lower-cased words without punctuation at their ends. Defined cases: null or blank texts match nothing, nor
do items of fewer than MIN_TILE tokens, which chance could hold; repeated items and repeated documents each match;
null ids are returned as they are; an empty table on either side gives an empty result and keeps all documents. Of the
inputs only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tallyforge.llm.shared import table

MIN_TILE = 5
THRESHOLD = 0.5
BLOCK_TOKENS = 2_000_000
FIRST_LENGTH = 32
REMEMBERED, SHORT = 100_000, 64  # words that a worker remembers, and their greatest length
BASE = np.uint64(0x9E3779B97F4A7C15)
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
TILE = StructType([StructField("doc_at", IntegerType()), StructField("item_at", IntegerType()), StructField("length", IntegerType())])
MATCH = StructType([StructField("item_id", LongType()), StructField("coverage", DoubleType()), StructField("item_tokens", IntegerType()), StructField("tiles", ArrayType(TILE))])


def tokens(text: str | None) -> list[str]:
    return [w for w in (EDGES.sub("", x) for x in (text or "").lower().split()) if w]


def _windows(ids: np.ndarray, length: int) -> np.ndarray:
    """The Karp-Rabin hash of each window, for all windows at once."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(ids) - length + 1, np.uint64)
        for k in range(length):
            out = out * BASE + (ids[k : len(ids) - length + 1 + k].astype(np.int64) + 2).astype(np.uint64)
        return out


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(marked)))
    return sums[length:] == sums[:-length]


def tile(item: np.ndarray, doc: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (place in doc, place in item, length) of two arrays of token numbers; -1 in doc matches nothing."""
    in_item, in_doc = np.zeros(len(item), bool), doc < 0
    out: list[tuple[int, int, int]] = []
    length = min(max(least, FIRST_LENGTH), len(item))
    while length >= least and len(doc) >= least:
        found = []
        if len(doc) >= length:
            hashes = _windows(doc, length), _windows(item, length)
            free = np.flatnonzero(_free(in_doc, length))
            own = {}
            for i in np.flatnonzero(_free(in_item, length)):
                own.setdefault(int(hashes[1][i]), []).append(int(i))
            if own:
                hit = free[np.isin(hashes[0][free], np.fromiter(own, np.uint64, len(own)))]
                for j in hit.tolist():
                    for i in own[int(hashes[0][j])]:
                        n = 0
                        while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not in_item[i + n] and not in_doc[j + n]:
                            n += 1
                        if n >= length:
                            found.append((n, j, i))
        for n, j, i in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if not in_item[i : i + n].any() and not in_doc[j : j + n].any():
                in_item[i : i + n] = in_doc[j : j + n] = True
                out.append((j, i, n))
        # A match that lost tokens to a longer one may still be long enough: the same length is tried until none is left.
        if not found:
            length = length - 1 if length <= 2 * least else max(length // 2, 2 * least)
    return sorted(out)


class Block:
    """Items of the benchmark with their tokens numbered, and the seeds that point to items."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.numbers: dict[str, int] = {}
        self.items = []
        seeds: dict[int, set[int]] = {}
        for item_id, text in items:
            ids = np.array([self.numbers.setdefault(t, len(self.numbers)) for t in tokens(text)], np.int64)
            if len(ids) >= MIN_TILE:
                for h in _windows(ids, MIN_TILE).tolist():
                    seeds.setdefault(h, set()).add(len(self.items))
                self.items.append((item_id, ids))
        self.seeds = seeds
        self.keys = np.sort(np.fromiter(seeds, np.uint64, len(seeds)))
        self.cache: dict[str, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def _number(self, raw: str) -> int:
        """The token's number, -1 for one of no item, -2 for no token."""
        word = EDGES.sub("", raw)
        found = self.numbers.get(word, -1) if word else -2
        if len(raw) <= SHORT:
            if len(self.cache) >= REMEMBERED:
                self.cache.clear()
            self.cache[raw] = found
        return found

    def matches(self, text: str | None, threshold: float) -> list[dict]:
        get = self.cache.get
        ids = [self._number(w) if (n := get(w)) is None else n for w in (text or "").lower().split()]
        doc = np.array(ids, np.int64)
        doc = doc[doc > -2]
        if len(doc) < MIN_TILE or not len(self.keys):
            return []
        at = np.flatnonzero(_free(doc < 0, MIN_TILE))
        if not len(at):
            return []
        hashes = _windows(doc, MIN_TILE)[at]
        near = self.keys[np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)]
        out = []
        for number in sorted({i for h in set(hashes[near == hashes].tolist()) for i in self.seeds[h]}):
            item_id, item = self.items[number]
            tiles = tile(item, doc)
            coverage = sum(n for _, _, n in tiles) / len(item)
            if coverage >= threshold:
                out.append({"item_id": item_id, "coverage": coverage, "item_tokens": len(item), "tiles": [dict(zip(("doc_at", "item_at", "length"), t)) for t in tiles]})
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str):
    """Broadcast blocks of the benchmark, one at a time."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = ceil(total / BLOCK_TOKENS)
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        items = sorted(((r["item_id"], r["text"]) for r in part.toLocalIterator()), key=str)
        yield benchmark.sparkSession.sparkContext.broadcast(Block(items))  # about BLOCK_TOKENS tokens


def _matched(block, text: Column, threshold: float) -> Column:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = ArrayType(MATCH)

    @F.arrow_udf(kind)
    def match(texts: pa.Array) -> pa.Array:
        return pa.array([block.value.matches(t.as_py(), threshold) for t in texts], to_arrow_type(kind))

    return match(text.cast("string"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item in it: doc_id, item_id, coverage, item_tokens, tiles."""
    schema = "doc_id bigint, item_id bigint, coverage double, item_tokens int, tiles array<struct<doc_at: int, item_at: int, length: int>>"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_id, item_text):
        part = docs.select(F.col(doc_id).alias("doc_id"), F.explode(_matched(block, F.col(text), threshold)).alias("m"))
        found = found.union(part.select("doc_id", "m.*"))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for block in _blocks(benchmark, item_id, item_text):
        docs = docs.filter(F.size(_matched(block, F.col(text), threshold)) == 0)
    return docs


def op2(spark, sf_dir):
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "item_tokens", F.size("tiles").alias("n_tiles"))
