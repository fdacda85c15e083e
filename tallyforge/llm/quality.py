"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Everything is computed within a document's row, so there is no shuffle, and a long document costs in proportion to
its length (its eight-word windows are sorted by hash only if some window occurs twice).

Defined cases: a null text has no words and no lines, so it fails the base rules; so does an empty one. Repeated rows
get equal results; an empty table gives an empty result; a null id is kept as it is. Of the input only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = (
    "the be to of and that have with is for in it on was as at by this are or "
    "der die das und ist von zu den mit des ein eine nicht im dem für auf sich auch als "
    "le la les de du et des un une que qui dans en pour par sur est au pas ou "
    "el los las del y se una con no al lo su por como más o "
    "il di che non per sono e da os em um uma não do het een van niet te"
).split()

#: Metric, least and greatest value that a kept document may have (None: no bound). Metrics are ratios of counts. A rule with
#: a fourth entry holds only for documents of which that metric is half or more: other scripts have words of other lengths,
#: and no stop words in the list.
THRESHOLDS = [
    ("mean_word_length", 2.0, 14.0, "latin_ratio"),
    ("symbol_ratio", None, 0.3),
    ("letter_word_ratio", 0.7, None),
    ("stop_word_ratio", 0.01, None, "latin_ratio"),
    ("upper_case_ratio", None, 0.6),
    ("shout_ratio", None, 0.3),
    ("dup_line_ratio", None, 0.5),
    ("ellipsis_line_ratio", None, 0.3),
    ("bullet_line_ratio", None, 0.9),
]


def _ratio(count: Column, of: Column) -> Column:
    return F.when(of > 0, count / of).otherwise(F.lit(0.0))


def _kept(text: str, pattern: str) -> Column:
    """How many characters are left without the pattern's matches."""
    return F.char_length(F.regexp_replace(text, pattern, ""))


def _count(items: str, test) -> Column:
    return F.size(F.filter(F.col(items), test))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts of the contract and the metrics of THRESHOLDS, one row for each document."""
    raw = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    split = raw.select(
        "doc_id", "t",
        F.array_remove(F.split("t", SPACE, -1), "").alias("words"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") >= WINDOW, F.transform(F.expr(f"sequence(1, size(words) - {WINDOW - 1})"), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).alias("hashes"),
    )
    # Windows in order of their hash: those that equal a neighbour occur twice or more.
    repeats = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    ordered = hashed.select("*", repeats.alias("w"))
    again = F.filter(F.col("w"), lambda e, j: (e["h"] == F.get(F.col("w"), j - 1)["h"]) | (e["h"] == F.get(F.col("w"), j + 1)["h"]))
    starts = ordered.select("*", F.sort_array(F.transform(again, lambda e: e["i"])).alias("at"))
    step = F.transform(F.col("at"), lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - x, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(step, F.lit(0), lambda a, b: a + b), F.lit(0))
    counted = starts.select(
        "doc_id", "n_words",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        _count("words", lambda w: w.rlike(r"\p{L}")).alias("n_letter_words"),
        _count("words", lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop"),
        _count("words", lambda w: w.endswith("!!")).alias("n_shout"),
        _kept("t", r"\P{Lu}+").alias("n_upper"),
        _kept("t", r"\P{L}+").alias("n_letters"),
        _kept("t", r"\P{IsLatin}+").alias("n_latin"),
        _count("lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")).alias("n_ellipsis"),
        _count("lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[•●*-][\x20\x09-\x0D]")).alias("n_bullets"),
    )
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_length"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        _ratio(F.col("n_letter_words"), F.col("n_words")).alias("letter_word_ratio"),
        _ratio(F.col("n_stop"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_upper"), F.col("n_letters")).alias("upper_case_ratio"),
        _ratio(F.col("n_latin"), F.col("n_letters")).alias("latin_ratio"),
        _ratio(F.col("n_shout"), F.col("n_words")).alias("shout_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_ellipsis"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        _ratio(F.col("n_bullets"), F.col("n_lines")).alias("bullet_line_ratio"),
    )


def judged(docs: DataFrame, thresholds=THRESHOLDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``measured`` with base_failed, failed (the names of the failed rules) and kept."""
    rules = []
    for name, least, most, *only in thresholds:
        fails = F.lit(False)
        if least is not None:
            fails = fails | (F.col(name) < least)
        if most is not None:
            fails = fails | (F.col(name) > most)
        rules.append(F.when(reduce(lambda a, b: a & (F.col(b) >= 0.5), only, fails), F.lit(name)))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    rated = measured(docs, doc_id, text).select("*", base.alias("base_failed"), failed.alias("failed"))
    return rated.select("*", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))


def op7(spark, sf_dir):
    found = judged(table(spark, sf_dir, "documents"))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*counts, "base_failed", "kept", F.array_join("failed", ",").alias("failed_rules"))
