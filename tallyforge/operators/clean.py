"""Stage A: projection, parsing, gating, deduplication and pseudonyms."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.parsing import amount, present, pseudonym, timestamp
from tallyforge.operators.history import history
from tallyforge.operators.resolve import Conventions, Resolution
from tallyforge.plans.schema import CANONICAL, EXTRA, HASHED, REQUIRED, SALT
from tallyforge.sources.scratch import kept

DEDUP_KEY = ["entity_id", "timestamp", "amount", "counterparty"]


def unique_headers(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Of columns with one name the first stays; returns the names that were repeated."""
    repeated = [c for c, n in Counter(df.columns).items() if n > 1]
    if not repeated:
        return df, []
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    first = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    return numbered.select(*[F.col(f"_{i}").alias(c) for c, i in sorted(first.items(), key=lambda x: x[1])]), repeated


def to_canonical(df: DataFrame, found: Resolution, by: Conventions, extras: list[str] = (), row_id: str = "_row_id", normalize_ids: bool = False) -> DataFrame:
    """The canonical columns, the extras and the row id. Absent optional columns get their defaults; null cells of
    present ones stay null. ``normalize_ids``: ids that differ in case and outer spaces only become one."""
    doubled = [f for f, n in Counter(found.columns.values()).items() if n > 1]
    if doubled:
        raise ValueError(f"more than one column is mapped to {', '.join(doubled)}")
    source = {f: present(F.col(f"`{c}`").cast("string")) for c, f in found.columns.items()}
    columns: list[Column] = []
    for name, spec in CANONICAL.items():
        if name == "entity_id" and found.auto_index:
            value = F.format_string("ROW_%06d", F.col(row_id))
        elif name not in source:
            value = F.lit(spec.default).cast("string")
        elif name == "amount":
            direction = F.col(f"`{found.direction}`").cast("string") if found.direction else None
            value = amount(source[name], by.cents, direction)
        elif name == "timestamp":
            value = timestamp(source[name], by.day_first)
        else:
            value = source[name]
            if normalize_ids and spec.kind == "id":
                value = F.upper(F.trim(value))
        columns.append(value.alias(name))
    carried = [F.col(f"`{c}`").cast("string").alias(EXTRA + c) for c in extras if c in df.columns]
    return df.select(*columns, *carried, F.col(row_id).alias("_row_id"))


def gate(df: DataFrame) -> DataFrame:
    """Rows with all required fields."""
    return df.na.drop(subset=REQUIRED)


def keep_first(df: DataFrame, key: list[str] = DEDUP_KEY, order: str = "_row_id") -> DataFrame:
    """Of rows with one key (nulls equal) the first. An aggregate, so copies are merged before the shuffle."""
    rest = [c for c in df.columns if c not in key and c != order]
    first = F.min_by(F.struct(*rest, order), order) if rest else F.struct(F.min(order).alias(order))
    kept = df.groupBy(*key).agg(first.alias("_first"))
    return kept.select(*[F.col(f"_first.`{c}`").alias(c) if c not in key else F.col(c) for c in df.columns])


def null_counts(df: DataFrame, fields: list[str] = REQUIRED) -> DataFrame:
    return df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in fields])


def settled(mapped: DataFrame, key: list[str] = DEDUP_KEY, order: str = "_row_id") -> DataFrame:
    """The gate and the removal of copies with all that their statistics need, from one pass: the first row of each key (as
    ``keep_first``) with ``_copies``, how many rows had it, and the rows that lack required fields as one row for each set of
    these. ``_no_...``: which are lacking. The counts are part of the rows, so they hold whatever is computed twice after
    an executor is lost, which counters that run along don't."""
    lacking = [F.col(f).isNull().alias(f"_no_{f}") for f in REQUIRED]
    fits = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in REQUIRED])
    rest = [c for c in mapped.columns if c not in key]
    grouped = mapped.groupBy(*[F.when(fits, F.col(c)).alias(c) for c in key], *lacking).agg(F.min_by(F.struct(*rest), order).alias("_first"), F.count("*").alias("_copies"))
    return grouped.select(*[F.col(f"_first.`{c}`").alias(c) if c not in key else F.col(c) for c in mapped.columns], *[f"_no_{f}" for f in REQUIRED], "_copies")


def _complete() -> Column:
    return reduce(lambda a, b: a & b, [~F.col(f"_no_{f}") for f in REQUIRED])


def settled_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(_complete()).drop("_copies", *[f"_no_{f}" for f in REQUIRED])


def settled_stats(rows: DataFrame) -> DataFrame:
    """One row: rows in, nulls of each required field, rows dropped for nulls, copies removed, rows out, per cent kept."""
    whole = _complete()
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("_copies"))), F.lit(0))
    sums = rows.agg(
        count(F.lit(True)).alias("input_rows"), count(~whole).alias("dropped_missing_required"), *[count(F.col(f"_no_{f}")).alias(f"null_{f}") for f in REQUIRED],
        F.count_if(whole).alias("output_rows"), (count(whole) - F.count_if(whole)).alias("duplicate_rows_removed"),
    )
    return sums.select("*", F.coalesce(F.try_divide(F.col("output_rows") * 100.0, F.col("input_rows")), F.lit(0.0)).alias("retained_pct"))


def gate_stats(mapped: DataFrame) -> DataFrame:
    """The statistics of gate and removal of copies; values are parsed once."""
    return settled_stats(settled(mapped))


def hash_ids(df: DataFrame, fields: list[str] = HASHED, salt: str = SALT) -> DataFrame:
    return df.withColumns({f: pseudonym(F.col(f), salt) for f in fields if f in df.columns})


def with_features(df: DataFrame) -> DataFrame:
    """Day of the week (Monday 0), hour, hours since the entity's last transaction, and the mean of its up to three
    amounts before. One window, so one shuffle and one sort; hot entities are cut into chunks."""
    seen = history(df, back=3)
    before = F.lag("timestamp").over(seen.window)
    since = F.timestamp_diff("MICROSECOND", before, F.col("timestamp")) / 3600e6
    return seen.done(seen.rows.select(
        "*",
        F.weekday("timestamp").alias("day_of_week"),
        F.hour("timestamp").alias("hour_of_day"),
        since.alias("time_since_last_txn_hours"),
        F.avg("amount").over(seen.window.rowsBetween(-3, -1)).alias("rolling_avg_amount_3"),
    ))


def cleaned(df: DataFrame, found: Resolution, by: Conventions, extras: list[str] = (), normalize_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """(clean rows with features, their statistics). The raw rows are read and parsed once: what is left of them is written."""
    rows = kept(settled(to_canonical(df, found, by, extras, normalize_ids=normalize_ids)), "clean")
    return with_features(hash_ids(settled_rows(rows))), settled_stats(rows)
