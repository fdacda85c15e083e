"""Language ID by bit-sliced Bloom filters over character trigrams.

Training counts the trigrams of each language over a sample of at most ``MAX_PER_LANGUAGE`` labelled documents a
language (chosen by hash; with fewer documents all are used). A language contains a trigram that it uses at least
``MIN_RATE`` times a trigram and at least ``MIN_SHARE`` as often as the language that uses it most. One array of
``SLOTS`` words holds the filters of ``WORD_LANGUAGES`` languages: bit l of each of a trigram's ``HASHES`` slots is set if
language l contains it, so one lookup returns the languages of a trigram as a bitmask. More languages have more arrays.

A text's count for a language is the number of its trigrams with the language's bit; of it, what the language's filter
would return by chance is taken off. The language with the largest corrected count is predicted, and the score is its
share of the text's trigrams.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a text with letters but no known trigram
gets the language with most training documents and score 0; ties go to the language with more training documents,
then by name. Rows with null lang or null text are not trained on; with no row to train on, everything is ``und``.
Repeated rows get equal results; an empty table gives an empty result. Of the input only the named columns are read,
so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyforge.llm.shared import fold, table

MAX_PER_LANGUAGE = 4000
MIN_RATE = 2e-6
MIN_SHARE = 0.1
SLOTS = 1 << 20
HASHES = 2
WORD_LANGUAGES = 63  # bits of a slot's word
UNKNOWN = "und"
RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """A 64-bit hash for each trigram of the lower-cased letters, runs of anything else being one space."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.uint32(32)).astype(np.uint64)
    gap = codes == 32
    codes = codes[~(gap & np.concatenate(([False], gap[:-1])))]
    if len(codes) < 3:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h = codes[:-2] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h = (h + codes[1:-1]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h = (h + codes[2:]) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams: dict[int, list] = {}
        for number, text in zip(batch["number"].to_pylist(), batch["text"]):
            grams.setdefault(number, []).append(trigrams(text.as_py()))
        for number, found in grams.items():
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"number": pa.array(np.full(len(gram), number, np.int32)), "gram": pa.array(gram.view(np.int64)), "n": pa.array(n.astype(np.int64))})


class Model:
    """Slots (an array, or one for each WORD_LANGUAGES languages), language names in order of training documents, and each
    filter's rate of false positives."""

    def __init__(self, names: list[str], slots: np.ndarray):
        self.names, self.slots = names, np.atleast_2d(slots)
        fill = [float(np.mean((self.slots[i // WORD_LANGUAGES] >> np.uint64(i % WORD_LANGUAGES)) & np.uint64(1))) for i in range(len(names))]
        self.chance = np.array([f**HASHES for f in fill])

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = trigrams(text)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        size, counts = np.uint64(self.slots.shape[1] - 1), []
        places = [(grams >> np.uint64(24 * k)) & size for k in range(HASHES)]
        for slots in self.slots:
            masks = slots[places[0]]
            for place in places[1:]:
                masks &= slots[place]
            here = min(WORD_LANGUAGES, len(self.names) - len(counts))
            counts += [np.count_nonzero(masks & np.uint64(1 << i)) for i in range(here)]
        counts = np.array(counts)
        right = np.maximum(0, (counts - len(grams) * self.chance) / np.maximum(1e-9, 1 - self.chance))
        best = int(right.argmax())
        return self.names[best], float(right[best]) / len(grams)


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", most: int = MAX_PER_LANGUAGE) -> Model:
    """A model of all languages in column ``lang`` of ``labelled``."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    known = sorted(rows.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r["lang"]))  # one row a language
    if not known:
        return Model([], np.zeros(1, np.uint64))
    spark = labelled.sparkSession
    sampled = [(r["lang"], i, min(1.0, most / r["count"])) for i, r in enumerate(known)]
    shares = F.broadcast(spark.createDataFrame(sampled, "lang string, number int, part double"))
    even = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    picked = rows.join(shares, "lang").filter(even < F.col("part")).select("number", "text")
    counts = picked.mapInArrow(_counted, "number int, gram long, n long").groupBy("number", "gram").agg(F.sum("n").alias("n"))
    slots = _slots(counts).toArrow()
    filled = np.zeros((-(-len(known) // WORD_LANGUAGES), SLOTS), np.uint64)
    filled[slots["word"].to_numpy(), slots["slot"].to_numpy()] = slots["mask"].to_numpy().view(np.uint64)
    return Model([r["lang"] for r in known], filled)


def _slots(counts: DataFrame) -> DataFrame:
    """(word, slot, mask): at most SLOTS rows for each WORD_LANGUAGES languages, whatever the number of trigrams."""
    totals = counts.groupBy("number").agg(F.sum("n").alias("total"))
    rated = counts.join(F.broadcast(totals), "number").selectExpr("gram", "n / total AS rate", f"number div {WORD_LANGUAGES} AS word", f"shiftleft(1L, number % {WORD_LANGUAGES}) AS bit")  # one row a language
    peak = rated.groupBy("gram").agg(F.max("rate").alias("peak"), F.collect_list(F.struct("word", "bit", "rate")).alias("by"))
    within = F.filter("by", lambda x: (x["rate"] >= MIN_RATE) & (x["rate"] >= MIN_SHARE * F.col("peak")))
    places = F.array(*[F.shiftrightunsigned("gram", 24 * k).bitwiseAND(F.lit(SLOTS - 1)) for k in range(HASHES)])
    held = peak.select("gram", F.explode(within).alias("x")).groupBy("gram", "x.word").agg(F.expr("bit_or(x.bit)").alias("mask"))
    return held.select("word", F.explode(places).alias("slot"), "mask").groupBy("word", "slot").agg(F.expr("bit_or(mask)").alias("mask"))


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct of lang_pred and score for a text column."""
    shared = spark.sparkContext.broadcast(model)  # SLOTS words

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["lang_pred", "score"])

    return predict(text.cast("string"))


def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), predicted(spark, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")
