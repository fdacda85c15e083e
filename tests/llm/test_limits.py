"""What holds memory and time down: sizes of batches, words remembered."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

import corpus_pipeline
from tallyforge.llm import decontaminate, mixing


def test_pipeline_hands_python_small_batches(spark):
    @F.arrow_udf(LongType())
    def batch_bytes(texts: pa.Array) -> pa.Array:
        return pa.array([sum(len(t.as_py()) for t in texts)] * len(texts), pa.int64())

    """Nine thousand texts made one batch of 9.9 MB."""
    before = spark.conf.get(corpus_pipeline.BATCH_CONF)
    docs = spark.range(9000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 100).alias("text"))
    bench = spark.createDataFrame([(1, "nothing of this is in any of the texts")], "item_id long, text string")
    try:
        corpus_pipeline.small_batches(spark)
        kept = decontaminate.clean(docs, bench)
        assert kept.count() == 9000
        most = docs.select(batch_bytes("text").alias("n")).agg(F.max("n")).first()[0]
        assert most <= 2 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(corpus_pipeline.BATCH_CONF, "4k")  # a smaller bound is kept
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(corpus_pipeline.BATCH_CONF) == "4k"
    finally:
        spark.conf.set(corpus_pipeline.BATCH_CONF, before)


def test_decontaminate_remembers_a_bounded_number_of_short_words(monkeypatch):
    monkeypatch.setattr(decontaminate, "REMEMBERED", 10, raising=False)
    item = "one two three four five six seven"
    block = decontaminate.Block([(1, item)])
    long = "x" * 5000
    text = " ".join([f"w{i}" for i in range(100)] + [long, item, long])
    assert [m["item_id"] for m in block.matches(text, 0.5)] == [1]
    assert len(block.cache) <= 10 and long not in block.cache


def test_mixing_counts_short_texts_without_an_array_for_all_buckets():
    make = mixing.Features()
    text = "The cat saw THE dog, and 12 cats saw the Dog."
    words, places, values = make(text)
    tally = Counter(at for w in text.split() for at in divmod(make.seen[w], 1 << 16)[::-1])
    assert words == 11 and dict(zip(places.tolist(), values.tolist())) == {at: np.log1p(n) for at, n in tally.items()}
    assert places.tolist() == sorted(tally)
    tracemalloc.start()
    try:
        make(text)
        assert tracemalloc.get_traced_memory()[1] < 50_000  # 405,504 for three arrays of all buckets
    finally:
        tracemalloc.stop()
