"""CSV files of any size, cut anywhere, as rows with dense numbers.

Whether a range of a file starts within a quoted field can't be seen from the range itself. So a first job walks every range
twice, from outside and from inside of quotes, and gives for both how it ends, how many rows it holds and what its open
ends are; only lines with quotes reach Python, the others as counts of commas. Put together in the order of the ranges,
these summaries tell how each range really starts and the number of its first row. The second job cuts the ranges into
records, which Spark's own parser splits into fields. Records that lie across ranges are put together from their pieces.

The summaries are two short rows for each of Spark's splits of the input; the driver holds as much for every split of any
scan. MOST_RANGES bounds them; beyond it, ``spark.sql.files.maxPartitionBytes`` must be larger.

A quote opens a field only at its start and is written twice within; elsewhere it is a character. Blank lines are no
records. The first record of each file is its header, which must hold the same names as that of the first file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_RANGES = 4_000_000
_REST = re.compile(r'[^"]*+(?:""[^"]*+)*+"')


def scan(line: str, inside: bool) -> tuple[int, bool]:
    """(commas outside of quotes, whether the line ends inside) for a line that starts outside or inside."""
    commas, at = 0, 0
    while True:
        if inside or line.startswith('"', at):
            closed = _REST.match(line, at if inside else at + 1)
            if not closed:
                return commas, True
            at, inside = closed.end(), False
        at = line.find(",", at) + 1
        if not at:
            return commas, False
        commas += 1


def _marked(quoted: pa.Array, commas: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """For each line whether it starts inside, and its commas outside of quotes; and how the last one ends. ``quoted``: the
    lines that hold quotes, null for the others."""
    before, outer, at = np.zeros(len(commas), bool), commas.copy(), 0
    for i in np.flatnonzero(quoted.is_valid().to_numpy(zero_copy_only=False)):
        if inside:
            before[at : i + 1] = True
            outer[at:i] = 0
        outer[i], inside = scan(quoted[i].as_py(), inside)
        at = i + 1
    if inside:
        before[at:] = True
        outer[at:] = 0
    return before, outer, inside


@dataclass
class Walk:
    """One range of a file, from a given start: what lies open across batches, and what has been counted."""

    inside: bool
    fields: int
    header: bool
    rows: int = 0
    long: int = 0
    head_commas: int = 0
    commas: int = 0  # of the record that is open
    in_head: bool = field(init=False)
    open: bool = field(init=False)
    text: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.in_head = self.open = self.inside

    def records(self, quoted: pa.Array, commas: np.ndarray, blank: np.ndarray, values: pa.Array | None = None):
        """Feed lines; gives (kind, text) for each record that ends: its kind is ``head``, ``header``, ``long`` or ``row``.
        Without ``values`` nothing is given, only counted."""
        before, outer, after = _marked(quoted, commas, self.inside)
        starts = np.flatnonzero(~before & ~blank)
        self.inside = after
        out = []
        ends_before = starts[0] if len(starts) else len(before)
        rest = outer[:ends_before].sum()
        if self.open:
            if values is not None:
                self.text += [v for v, b in zip(values[:ends_before].to_pylist(), before[:ends_before]) if b]
            self.commas += int(rest)
            if len(starts) or not after:
                out += self._close()
        if not len(starts):
            return out
        total = np.add.reduceat(outer, starts)
        last = len(starts) - 1 if after else len(starts)  # the last record is open if the lines end inside
        fields = total[:last] + 1
        head = 0
        if last and self.header:
            self.header, head = False, 1
        kept = fields[head:] <= self.fields
        self.rows += int(kept.sum())
        self.long += int((~kept).sum())
        if values is not None:
            out += self._texts(values, before, starts, last, head, kept)
        if after:
            self.open, self.commas = True, int(total[-1])
            if values is not None:
                self.text = [v for v, b in zip(values[starts[-1] :].to_pylist(), np.r_[True, before[starts[-1] + 1 :]]) if b]
        return out

    def _close(self) -> list:
        text, self.text, self.open = "\n".join(self.text), [], False
        if self.in_head:
            self.in_head, self.head_commas = False, self.commas
            return [("head", text)]
        if self.header:
            self.header = False
            return [("header", text)]
        fits = self.commas + 1 <= self.fields
        self.rows, self.long = self.rows + fits, self.long + (not fits)
        return [("row" if fits else "long", text)]

    def _texts(self, values, before, starts, last, head, kept) -> list:
        ends = np.r_[starts[1:], len(before)][:last]
        lines = values.to_pylist()
        texts = [lines[a] if b - a == 1 else "\n".join([lines[a], *[lines[k] for k in range(a + 1, b) if before[k]]]) for a, b in zip(starts[:last].tolist(), ends.tolist())]
        return [("header", t) for t in texts[:head]] + [("row" if k else "long", t) for t, k in zip(texts[head:], kept.tolist())]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file and the start of its range, in order within a task."""
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _measures() -> list[Column]:
    v = F.col("value")
    return [F.when(F.contains(v, F.lit('"')), v).alias("quoted"), (F.length(v) - F.length(F.replace(v, F.lit(","), F.lit("")))).alias("commas"), v.rlike(r"^[ \t\r]*$").alias("blank")]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """A batch cut where its file or range changes."""
    start = batch.column("start").to_numpy()
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(start) != 0) | (np.diff(file) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(start)]):
        if b > a:
            yield (batch.column("file")[a].as_py(), int(start[a])), batch.slice(a, b - a)


def _parts(run: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return run.column("quoted"), run.column("commas").to_numpy().astype(np.int64), run.column("blank").to_numpy(zero_copy_only=False)


SUMMARY = "file string, start long, inside boolean, ends_inside boolean, rows long, long long, head_ends boolean, head_commas long, open_header boolean, open_commas long"


def summaries(lines: DataFrame, fields: int) -> DataFrame:
    """A row for each range and way to start it."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, both = None, []

        def told() -> pa.RecordBatch:
            rows = [(*now, i == 1, w.inside, w.rows, w.long, not w.in_head, w.head_commas if not w.in_head else w.commas, w.open and w.header and not w.in_head, w.commas if w.open and not w.in_head else 0) for i, w in enumerate(both)]
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

        names = [x.split()[0] for x in SUMMARY.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in SUMMARY.split(", ")])
        for batch in batches:
            for key, run in _runs(batch):
                if key != now:
                    if both:
                        yield told()
                    now, both = key, [Walk(inside, fields, key[1] == 0) for inside in (False, True)]
                for w in both:
                    w.records(*_parts(run))
        if both:
            yield told()

    return lines.select("file", "start", *_measures()).mapInArrow(walk, SUMMARY)


@dataclass
class Plan:
    """How each range starts. ``ranges``: (file, start) to (inside, number of its first row, number of the row that is open
    at its start, that of the one open at its end); -1: none, or none that is kept."""

    ranges: dict[tuple[str, int], tuple[bool, int, int, int]]
    rows: int
    skipped: int

    @property
    def across(self) -> set[tuple[str, int]]:
        return {k for k, (_, _, head, tail) in self.ranges.items() if head >= 0 or tail >= 0}


def planned(told: pa.Table, fields: int) -> Plan:
    """Put the summaries together, files by name, ranges by place."""
    found: dict[str, dict[int, dict[bool, dict]]] = {}
    for r in told.to_pylist():
        found.setdefault(r["file"], {}).setdefault(r["start"], {})[r["inside"]] = r
    ranges: dict[tuple[str, int], list] = {}
    number = skipped = 0
    for file in sorted(found):
        inside, open_ = False, None  # [commas, whether it is the header, the places that wait for its number]

        def close() -> None:
            nonlocal number, skipped, open_
            if not open_[1] and open_[0] + 1 <= fields:
                for place, i in open_[2]:
                    ranges[place][i] = number
                number += 1
            elif not open_[1]:
                skipped += 1
            open_ = None

        for start in sorted(found[file]):
            r, place = found[file][start][inside], (file, start)
            ranges[place] = [inside, 0, -1, -1]
            if inside:
                open_[0] += r["head_commas"]
                open_[2].append((place, 2))
                if r["head_ends"]:
                    close()
            ranges[place][1] = number
            number, skipped = number + r["rows"], skipped + r["long"]
            if r["ends_inside"] and open_ is None:
                open_ = [r["open_commas"], r["open_header"], [(place, 3)]]
            inside = r["ends_inside"]
        if open_:  # the file ends within quotes
            close()
    return Plan({k: tuple(v) for k, v in ranges.items()}, number, skipped)


RECORD = "file string, start long, kind string, number long, text string"


def _records(lines: DataFrame, plan, fields: int, pieces: bool) -> DataFrame:
    """Whole records of each range with their numbers, or only the pieces of those that lie across ranges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, walk, number = None, None, 0

        def made(rows: list[tuple]) -> pa.RecordBatch:
            kinds, numbers, texts = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(rows), pa.string()), pa.array([now[1]] * len(rows), pa.int64()), pa.array(kinds, pa.string()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], ["file", "start", "kind", "number", "text"])

        def ended() -> pa.RecordBatch:
            """What is open at the end of a range."""
            at = plan.value.ranges[now]
            tail = at[2] if walk.in_head else at[3]
            return made([("piece", tail, "\n".join(walk.text))] if pieces and walk.open and tail >= 0 else [])

        for batch in batches:
            for key, run in _runs(batch):
                if key != now:
                    if walk:
                        yield ended()
                    now = key
                    inside, number = plan.value.ranges[key][:2]
                    walk = Walk(inside, fields, key[1] == 0)
                out = []
                for kind, text in walk.records(*_parts(run), run.column("value")):
                    if kind == "head":
                        owner = plan.value.ranges[now][2]
                        out += [("piece", owner, text)] if pieces and owner >= 0 else []
                    elif kind == "row":
                        out += [("row", number, text)] if not pieces else []
                        number += 1
                    elif not pieces and kind == "header":
                        out.append((kind, -1, text))
                yield made(out)
        if walk:
            yield ended()

    return lines.select("file", "start", "value", *_measures()).mapInArrow(cut, RECORD)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The first file's names; repeated ones have their place behind them."""
    names = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("recursiveFileLookup", True).csv(path).columns
    return [n.removeprefix("\ufeff").strip('"') if n.startswith("\ufeff") else n for n in names]


@dataclass
class CsvRows:
    """``df``: string columns and ``_row_id``, from 0 without gaps, whatever the ranges. ``skipped``: rows with too many fields."""

    df: DataFrame
    rows: int
    skipped: int
    ranges: int


def read(spark: SparkSession, path: str, strict: bool = False) -> CsvRows:
    """Rows with fewer fields than the header are padded with nulls; those with more are skipped, or an error if ``strict``."""
    names = csv_header(spark, path)
    if not names:
        return CsvRows(spark.createDataFrame([], "_row_id long"), 0, 0, 0)
    lines = _lines(spark, path)
    told = summaries(lines, len(names))
    table = told.limit(2 * MOST_RANGES + 1).toArrow()  # two rows for each of Spark's splits
    if table.num_rows > 2 * MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges; raise spark.sql.files.maxPartitionBytes")
    plan = planned(table, len(names))
    if strict and plan.skipped:
        raise ValueError(f"malformed rows: {plan.skipped} have more than the header's {len(names)} fields")
    shared = spark.sparkContext.broadcast(plan)
    records = _records(lines, shared, len(names), False).select("kind", "number", "text", "file")
    if across := plan.across:
        near = lines.filter(F.col("start").isin(sorted({s for _, s in across})))
        pieces = _records(near, shared, len(names), True).groupBy("number").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("all"))
        whole = F.array_join(F.transform("all", lambda p: p["text"]), "\n")
        records = records.unionByName(pieces.select(F.lit("row").alias("kind"), "number", whole.alias("text"), F.lit(None).cast("string").alias("file")))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.regexp_replace("text", "\r$", "")
    text = F.when(F.col("kind") == "header", F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    parsed = records.select("kind", "number", "file", F.from_csv(text, schema, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}).alias("r"))
    same = F.lit(True)
    for i, n in enumerate(names):
        same = same & F.coalesce(F.col(f"r.c{i}").isin(n, n.removesuffix(str(i))) | (F.lit(n) == f"_c{i}"), F.lit(n) == f"_c{i}")
    odd = F.raise_error(F.concat(F.lit("another header in "), F.coalesce("file", F.lit("a file")))).cast("boolean")
    rows = parsed.filter(F.when(F.col("kind") == "header", F.when(same, False).otherwise(odd)).otherwise(True))
    return CsvRows(rows.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)], F.col("number").alias("_row_id")), plan.rows, plan.skipped, len(plan.ranges))
