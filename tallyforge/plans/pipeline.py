"""From a raw table to clean rows and training examples. Results are lazy; what is collected is bounded metadata."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import clean, facts, narrate, questions, resolve, shape, split

QUERY_TASKS = ("query_sql", "spend_summarization")


class Manifest:
    """The log of what was decided automatically."""

    def __init__(self, source: str):
        self.data = {"source_name": source, "run_timestamp": datetime.now(timezone.utc).isoformat(), "schema_resolution": {}, "cleaning": {}, "splitting": {}, "shaping": {}, "warnings": []}

    def warn(self, text: str) -> None:
        self.data["warnings"].append(text)


@dataclass
class Outcome:
    mapping_report: list[dict]
    quarantined_columns: list[str]
    manifest: dict
    clean_df: DataFrame | None = None
    cleaning_stats: dict | None = None
    split_stats: dict | None = None
    shaped: dict[str, DataFrame] = field(default_factory=dict)
    fatal_error: str | None = None


def prepare_all(spark: SparkSession, sources: dict[str, DataFrame], tasks: list[str], **options) -> tuple[dict[str, Outcome], dict[str, str]]:
    """``run_pipeline`` on each source: what came of those that could be prepared, and why the others could not."""
    ready: dict[str, Outcome] = {}
    skipped: dict[str, str] = {}
    for name, raw in sources.items():
        try:
            out = run_pipeline(spark, raw, name, tasks, **options)
        except Exception as e:  # noqa: BLE001  one source that fails must not stop the others
            skipped[name] = str(e)
            continue
        if out.fatal_error:
            skipped[name] = out.fatal_error
        else:
            ready[name] = out
    return ready, skipped


def run_pipeline(
    spark: SparkSession, raw: DataFrame, source: str, tasks: list[str], overrides: dict[str, str] | None = None, train_frac: float = split.TRAIN, val_frac: float = split.VAL,
    extra_context_cols: list[str] = (), progress: Callable[[str, float], None] | None = None, spend: str = "auto",
    normalize_ids: bool = False,
) -> Outcome:
    tell = progress or (lambda *_: None)
    log = Manifest(source)
    raw, repeated = clean.unique_headers(raw)
    if repeated:
        log.warn(f"repeated headers {repeated}: the first of each is kept")
    if "_row_id" not in raw.columns:
        raw = raw.withColumn("_row_id", F.monotonically_increasing_id())
    tell("schema resolution", 0.05)
    data = raw.drop("_row_id")
    found = resolve.override(resolve.resolve(data), overrides or {})
    tell("conventions", 0.15)
    by = resolve.conventions(data, found)
    log.data["schema_resolution"] = {"mapping": found.report, "quarantined_columns": found.quarantined, "convention_assumptions": by.notes}
    for r in found.report:
        if "note" in r:
            log.warn(f"[{r['source_column']}] {r['note']}")
    for n in by.notes:
        log.warn(f"[{n['field']}] {n['assumption']} (confidence: {n['confidence']})")
    if found.auto_index:
        log.warn("entity_id is the row's number: every transaction stands alone, so contexts and features have length one")
    out = Outcome(found.report, found.quarantined, log.data)
    if missing := found.missing():
        out.fatal_error = f"Missing required field(s): {missing}"
        log.warn(out.fatal_error)
        return out
    tell("cleaning", 0.30)
    rows, stats = clean.cleaned(raw, found, by, list(extra_context_cols), normalize_ids)
    out.cleaning_stats = stats.first().asDict()
    if out.cleaning_stats["null_timestamp"]:
        source = next(c for c, f in found.columns.items() if f == "timestamp")
        unread = [r.asDict() for r in resolve.unread_dates(raw, source, by).collect()]  # at most 20
        log.data["schema_resolution"]["unread_dates"] = unread
        for r in unread:
            log.warn(f"[timestamp] {r['n']} value(s) like '{r['example']}' are no dates")
    log.data["cleaning"] = out.cleaning_stats | {"pii_fields_hashed": list(clean.HASHED)}
    if extra_context_cols:
        log.warn(f"extra columns carried through unhashed: {list(extra_context_cols)}")
    tell("split", 0.45)
    cuts = split.cutoffs(rows, train_frac, val_frac)
    row = cuts.first()
    cuts = spark.createDataFrame([tuple(row)], cuts.schema)  # two timestamps
    rows = split.with_split(rows, cuts)
    out.clean_df = rows
    if row["train_cutoff"] is not None:
        counts = {r["split"]: r["n"] for r in split.split_counts(rows).collect()}  # three rows
        out.split_stats = {"train_frac_requested": train_frac, "val_frac_requested": val_frac, "train_cutoff": str(row["train_cutoff"]), "val_cutoff": str(row["val_cutoff"]), "row_counts": counts}
        log.data["splitting"] = out.split_stats
    cells = facts.cells(rows) if set(tasks) & set(QUERY_TASKS) else None
    convention = facts.detect(cells, spend) if cells else None
    for i, task in enumerate(tasks):
        tell(f"shaping: {task}", 0.5 + 0.45 * i / max(1, len(tasks)))
        if task == "query_sql":
            out.shaped[task] = questions.examples(cells, cuts, convention)
        elif task == "spend_summarization":
            out.shaped[task] = narrate.examples(cells, cuts, convention)
        else:
            out.shaped[task] = shape.shape(rows, task)
        log.data["shaping"][task] = {"task_type": task}
    tell("done", 1.0)
    return out
