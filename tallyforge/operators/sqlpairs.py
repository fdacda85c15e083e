"""Rates of a whole table of (generated, reference) SQL pairs, in few jobs.

Texts that differ in their string literals only have one shape. A shape's literals become a relation, and its text a
lateral subquery over it, which Catalyst turns into joins by the literals; so one plan answers all pairs of a shape, and
one job the plans of several shapes. What a shape can't be answered by (other dialects' correlation, a literal that isn't
a value) is answered pair by pair, and if a job fails for one pair's values, its pairs are halved until that pair is found.

Results are compared by content: numbers to six decimals whatever their type, other values as text. Where the reference
orders its rows, each group of rows with equal keys is a multiset at its places; a generated query must have the same
multisets at the same places, and must not leave open what the reference orders. Where it doesn't, results are multisets.
LIMIT takes the first rows by the keys, of equals the first by content. Two results without rows are equal.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.sources.scratch import kept

#: Shapes of a job, and rows of one result from which it is ordered by itself.
SHAPES_A_JOB, LARGE_RESULT = 24, 1_000_000
#: Texts of a shape that are halved in search of those that fail; of a shape with more, each is answered alone.
HALVED = 1024
_QUOTED = r"'[^']*'|\"[^\"]*\"|`[^`]*`"
LITERAL = r"'[^']*(?:''[^']*)*'"
#: Spark's error classes and messages that speak of a query's values, not of the cluster.
_VALUE_ERRORS = ("SparkArithmeticException", "SparkDateTimeException", "SparkNumberFormatException", "SparkRuntimeException", "SparkArrayIndexOutOfBoundsException")


def value_error(e: Exception) -> bool:
    """Whether an exception is the query's own (it can't be analysed, or a value can't be computed), not an executor's."""
    if isinstance(e, (AnalysisException, ParseException)):
        return True
    if isinstance(e, PySparkException) and (e.getSqlState() or "").startswith("22"):  # data exceptions
        return True
    return any(x in str(e) for x in _VALUE_ERRORS)


@dataclass
class Clauses:
    """A query without its top-level ORDER BY and LIMIT, and these."""

    body: str
    keys: list[str]
    limit: int | None
    source: int  # place of the top-level FROM in body, -1: none


def _outer(sql: str) -> str:
    """``sql`` with what stands in quotes or brackets blanked out, place by place."""
    blank = lambda m: " " * len(m.group())
    text = re.sub(_QUOTED, lambda m: "x" * len(m.group()), sql)
    while (less := re.sub(r"\([^()]*\)", blank, text)) != text:
        text = less
    return text


def clauses(sql: str) -> Clauses:
    sql = sql.strip().rstrip(";").rstrip()
    outer = _outer(sql)
    found = lambda p, start=0: (m := re.compile(p, re.I).search(outer, start)) and m or None
    if found(r"\b(offset|union|intersect|except|with|qualify|cluster\s+by|sort\s+by|distribute\s+by)\b"):
        raise ValueError("clauses that aren't taken apart")
    limit = found(r"\blimit\s+(\d+)\s*$")
    end = limit.start() if limit else len(sql)
    order = found(r"\border\s+by\b")
    keys = []
    if order:
        a = order.end()
        for m in [*re.finditer(",", outer[a:end]), None]:
            b = end if m is None else order.end() + m.start()
            keys.append(sql[a:b].strip())
            a = b + 1
    source = found(r"\bfrom\b")
    if found(r"\blimit\b") and not limit:
        raise ValueError("a limit that isn't a number")
    return Clauses(sql[: order.start() if order else end].rstrip(), keys, int(limit.group(1)) if limit else None, source.start() if source else -1)


def content(df: DataFrame) -> Column:
    """A hash of a row's values: numbers to six decimals, other values as text."""

    def one(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float", "int", "bigint", "smallint", "tinyint", "boolean") or kind.startswith("decimal"):
            text = F.concat(F.lit("n"), (F.round(c.cast("double"), 6) + F.lit(0.0)).cast("string"))
        else:
            text = F.concat(F.lit("t"), (F.to_json(F.struct(c)) if kind.startswith(("array", "map", "struct")) else c.cast("string")))
        return F.coalesce(text, F.lit("null"))

    return F.xxhash64(F.array(*[one(n, k) for n, k in df.dtypes])) if df.columns else F.lit(0).cast("long")


_AGGREGATE = re.compile(r"^\s*select\b.*?\b(?P<from>from\s+)(?P<table>[\w.]+)\s+(?P<where>where\b).*?(?P<group>\bgroup\s+by\b.*)?$", re.I | re.S)
_LITERAL_COLUMN = r"\bp\.l\d+\b"


def _aggregated(spark: SparkSession, body: str, params: str) -> DataFrame | None:
    """An aggregate over one table for all literals: the table is joined with them by its whole condition, so by the columns
    that have to equal them, and grouped by text. (As a lateral subquery the table would be joined with the other literals
    alone, each row with each different range of time.) None if the body isn't of this form."""
    outer = _outer(body)
    m = _AGGREGATE.match(outer)
    if not m or len(re.findall(r"\bselect\b", re.sub(LITERAL, "", body), re.I)) > 1 or re.search(r"\b(distinct|having|over|window|rollup|cube|grouping\s+sets)\b", outer, re.I):
        return None
    end = m.start("group") if m.group("group") else len(body)
    table = body[slice(*m.span("table"))]
    columns, where, group = body[: m.start("from")].strip()[len("select") :], body[m.end("where") : end], re.sub(r"^group\s+by\b", "", body[end:], flags=re.I)
    if not re.search(_LITERAL_COLUMN, where) or re.search(_LITERAL_COLUMN, columns + " " + group) or re.search(r"\b(\d+|all)\b", group, re.I):
        return None
    source = f"FROM {params} p JOIN {table} ON {where}"
    try:
        if group:
            return spark.sql(f"SELECT p._text, {columns} {source} GROUP BY p._text, {group}")
        if _analysed(spark, f"SELECT p._text, {columns} {source}"):
            return None  # no aggregate
        found = spark.sql(f"SELECT p._text, {columns}, true AS _in {source} GROUP BY p._text")
        none = spark.sql(f"SELECT {columns} FROM {table} WHERE false")  # the row of texts that meet no rows
    except (AnalysisException, ParseException):
        return None
    names = none.columns
    value = [F.when(F.col("_in"), F.col(f"_m{i}")).otherwise(F.col(f"_e{i}")).alias(x) for i, x in enumerate(names)]
    met = found.toDF("_text", *[f"_m{i}" for i in range(len(names))], "_in")
    return spark.table(params).select("_text").join(met, "_text", "left").join(F.broadcast(none.toDF(*[f"_e{i}" for i in range(len(names))])), F.lit(True)).select("_text", *value)  # one row


def _of_aggregates(spark: SparkSession, body: str, params: str) -> DataFrame | None:
    """A list of scalar subqueries that are such aggregates, without a source of its own; None if the body is none."""
    parts, at, values = [], 0, []
    flat = re.sub(_QUOTED, lambda m: "x" * len(m.group()), body)
    for m in re.finditer(r"\(\s*select\b", flat, re.I):
        if m.start() < at:
            continue
        depth = accumulate((x == "(") - (x == ")") for x in flat[m.start() :])
        end = m.start() + next((i for i, d in enumerate(depth) if not d), len(body))
        values.append(None if re.search(r"\bgroup\s+by\b", flat[m.start() : end], re.I) else _aggregated(spark, body[m.start() + 1 : end], params))
        if values[-1] is None or len(values[-1].columns) != 2:
            return None
        parts += [body[at : m.start()], f"_v{len(values) - 1}"]
        at = end + 1
    text = ("".join(parts) + body[at:]).strip()
    if not values or re.search(r"\bselect\b|" + _LITERAL_COLUMN, text[len("select"):], re.I):
        return None
    both = reduce(lambda a, b: a.join(b, "_text"), [v.toDF("_text", f"_v{i}") for i, v in enumerate(values)])
    both.createOrReplaceTempView(f"{params}_values")
    try:
        return spark.sql(f"SELECT _text, {text[len('select'):]} FROM {params}_values")
    except (AnalysisException, ParseException):
        return None
    finally:
        spark.catalog.dropTempView(f"{params}_values")


def _answer(spark: SparkSession, c: Clauses, params: str | None) -> DataFrame:
    """Rows of a shape for all its literals: text, the order's keys k0, k1, ..., hash; without ``params`` of one query.
    Keys are looked for among the outputs first, as SQL does, then among the source's columns."""
    own = "p._text" if params else "0L AS _text"
    plain = [re.sub(r"\s+(asc|desc)?(\s+nulls\s+(first|last))?\s*$", "", k + " ", flags=re.I).strip() for k in c.keys]

    def joined(body: str, source: int) -> DataFrame:
        aggregate = params and (_aggregated if source >= 0 else _of_aggregates)(spark, body, params)
        if aggregate:
            return aggregate
        if params and source < 0:
            return spark.sql(f"SELECT {own}, {body.strip()[len('select'):]} FROM {params} p")
        if params:
            return spark.sql(f"SELECT {own}, r.* FROM {params} p JOIN LATERAL ({body}) r ON true")
        return spark.sql(f"SELECT {own}, r.* FROM ({body}) r")

    df = joined(c.body, c.source)
    n = len(df.columns) - 1
    places = [f"_c{i}" for i in range(n)]
    numbered = df.toDF("_text", *places)
    try:
        by_name = numbered if len(set(df.columns)) < n + 1 else df
        keys = [F.col(places[int(k) - 1]) if k.isdigit() else F.expr(k) for k in plain]
        both = by_name.select("*", *[numbered_.alias(p) for numbered_, p in zip([F.col(f"`{x}`") for x in by_name.columns[1:]], places)]) if by_name is df else numbered
        return both.select("_text", *[k.alias(f"_k{i}") for i, k in enumerate(keys)], content(numbered.drop("_text")).alias("_hash"))
    except AnalysisException:
        if c.source < 0 or any(k.isdigit() for k in plain):
            raise
        added = "".join(f", {k} AS _k{i}" for i, k in enumerate(plain))
        ordered = [f"_k{i}" for i in range(len(plain))]
        df = joined(c.body[: c.source].rstrip() + added + " " + c.body[c.source :], c.source).toDF("_text", *places, *ordered)
        return df.select("_text", *ordered, content(df.select(*places)).alias("_hash"))


def _order(c: Clauses) -> list[Column]:
    out = []
    for i, k in enumerate(c.keys):
        down, nulls = re.search(r"\bdesc\b", k, re.I), re.search(r"nulls\s+(first|last)", k, re.I)
        first = nulls.group(1).lower() == "first" if nulls else not down
        col = F.col(f"_k{i}")
        out.append((col.desc_nulls_first() if first else col.desc_nulls_last()) if down else (col.asc_nulls_first() if first else col.asc_nulls_last()))
    return out


def _placed(df: DataFrame, c: Clauses) -> DataFrame:
    """Rows (text, at, rank, hash) of the first rows of each text. Results of LARGE_RESULT rows are left to ``_alone``."""
    own = Window.partitionBy("_text")
    rank = F.rank().over(own.orderBy(*_order(c))) if c.keys else F.lit(1)
    place = F.row_number().over(own.orderBy(*_order(c), "_hash"))
    out = df.select("_text", place.cast("long").alias("_at"), rank.cast("long").alias("_rank"), "_hash")
    return out.filter(F.col("_at") <= c.limit) if c.limit is not None else out


def compared(mine: DataFrame, right: DataFrame) -> DataFrame:
    """(pair, same) for pairs with rows on either side, from rows (_pair, _at, _rank, _hash). Rows meet by place; the
    reference's rank is the group that both must fill with the same rows."""
    a = mine.select("_pair", "_at", F.col("_rank").alias("_own"), F.col("_hash").alias("_mine"))
    b = right.select("_pair", "_at", F.col("_rank").alias("_group"), F.col("_hash").alias("_right"))
    met = a.join(b, ["_pair", "_at"], "full")
    number = lambda x: F.coalesce(F.sum(F.col(x).cast("decimal(38,0)")), F.lit(0))
    groups = met.groupBy("_pair", "_group").agg((number("_mine") == number("_right")).alias("same"), (F.count("_mine") == F.count("_right")).alias("even"))
    open_ = met.groupBy("_pair", "_own").agg(((F.min("_group") == F.max("_group")) | (F.min("_mine") == F.max("_mine"))).alias("same"))
    both = groups.select("_pair", (F.col("same") & F.col("even")).alias("same")).unionByName(open_.filter("_own IS NOT NULL").select("_pair", F.coalesce("same", F.lit(False)).alias("same")))
    return both.groupBy("_pair").agg(F.bool_and("same").alias("same"))


def _shaped(texts: DataFrame) -> DataFrame:
    """``texts`` with their shape and literals."""
    found = F.regexp_extract_all("text", F.lit(LITERAL), F.lit(0))
    value = F.transform(found, lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'")))
    odd = F.col("text").rlike(r"[?\\]")  # marks and escapes stay as they are: such a text is a shape of its own
    return texts.select("_text", "text", F.when(odd, F.col("text")).otherwise(F.regexp_replace("text", LITERAL, "?")).alias("shape"), F.when(odd, F.array().cast("array<string>")).otherwise(value).alias("literals"))


def _shape_rows(spark: SparkSession, texts: DataFrame, view: str, shape: str, n: int) -> DataFrame:
    texts.select("_text", *[F.col("literals")[i].alias(f"l{i}") for i in range(n)]).createOrReplaceTempView(view)
    pieces = shape.split("?") if n else [shape]
    c = clauses(pieces[0] + "".join(f"p.l{i}{x}" for i, x in enumerate(pieces[1:])))
    return _placed(_answer(spark, c, view), c)


def _analysed(spark: SparkSession, text: str) -> bool:
    try:
        spark.sql(text)
        return True
    except (AnalysisException, ParseException):
        return False


@dataclass
class Rates:
    """``pairs``: (_pair, kept columns, executable, correct). How many jobs were run over shapes, and how many pairs alone."""

    pairs: DataFrame
    jobs: int
    alone: int

    def summary(self, *by: str) -> DataFrame:
        share = lambda c: F.coalesce(F.avg(F.col(c).cast("int")), F.lit(0.0))
        return self.pairs.groupBy(*by).agg(F.count("*").alias("n"), share("executable").alias("executable_rate"), share("correct").alias("correct_rate"))


def rates(spark: SparkSession, pairs: DataFrame, keep: list[str] = ()) -> Rates:
    """Of each pair (generated, reference) over the registered views: whether the generated query can be executed, and
    whether it gives the reference's rows. Each text is run once, however many pairs hold it."""
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r";\s*$", ""))
    pairs = pairs.select(F.monotonically_increasing_id().alias("_pair"), clean("generated").alias("generated"), clean("reference").alias("reference"), *keep)
    pairs = kept(pairs, "pairs")
    texts = kept(_shaped(pairs.select(F.explode(F.array("generated", "reference")).alias("text")).distinct().withColumn("_text", F.monotonically_increasing_id())), "texts")
    shapes = texts.groupBy("shape", F.size("literals").alias("n")).agg(F.count("*").alias("of"), F.min("text").alias("text")).orderBy(F.desc("of"), "shape").collect()  # a row a shape
    good, bad, alone, views = [], [], [], []
    for i, s in enumerate(shapes):
        here = texts.filter(F.col("shape") == s["shape"]).filter(F.size("literals") == s["n"])
        if not _analysed(spark, s["text"]):
            bad.append(here.select("_text"))
            continue
        try:
            views.append(f"_literals_{i}")
            good.append((i, here, _shape_rows(spark, here, views[-1], s["shape"], s["n"])))
        except (AnalysisException, ParseException, ValueError):
            alone.append(here.select("_text"))
    results: list[DataFrame] = []
    jobs = 0

    def run(some: list[tuple[int, DataFrame, DataFrame]]) -> None:
        """A job for some shapes; if a value fails it, the shapes and then the texts are halved."""
        nonlocal jobs
        jobs += 1
        try:
            results.append(kept(reduce(DataFrame.unionByName, [r for _, _, r in some]), "answers"))
            return
        except Exception as e:  # noqa: BLE001  looked at just here
            if not value_error(e):
                raise
        if len(some) > 1:
            run(some[: len(some) // 2])
            run(some[len(some) // 2 :])
            return
        i, here, _ = some[0]
        ids = [r["_text"] for r in here.select("_text").orderBy("_text").limit(HALVED + 1).collect()]
        if len(ids) == 1 or len(ids) > HALVED:
            alone.append(here.select("_text"))
            return
        for part in (ids[: len(ids) // 2], ids[len(ids) // 2 :]):
            views.append(f"_literals_{i}_{part[0]}_{len(part)}")
            few = here.filter(F.col("_text").isin(part))
            run([(i, few, _shape_rows(spark, few, views[-1], shapes[i]["shape"], shapes[i]["n"]))])

    for k in range(0, len(good), SHAPES_A_JOB):
        run(good[k : k + SHAPES_A_JOB])
    for view in views:
        spark.catalog.dropTempView(view)
    none = spark.createDataFrame([], "_text long")
    failed = reduce(DataFrame.unionByName, bad, none)
    answers = reduce(DataFrame.unionByName, results, spark.createDataFrame([], "_text long, _at long, _rank long, _hash long"))
    large = answers.groupBy("_text").agg(F.count("*").alias("n")).filter(F.col("n") >= LARGE_RESULT).select("_text")
    lone = reduce(DataFrame.unionByName, alone, large).distinct()
    number = lambda name, c: texts.select(F.col("text").alias(c), F.col("_text").alias(name))
    pairs = pairs.join(number("_mine", "generated"), "generated").join(number("_right", "reference"), "reference")
    for side in ("_mine", "_right"):
        for flag, own in ((f"{side}_failed", failed), (f"{side}_alone", lone)):
            pairs = pairs.join(own.select(F.col("_text").alias(side), F.lit(True).alias(flag)), side, "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    pairs = kept(pairs.select("_pair", "generated", "reference", *keep, "_mine", "_right", *[no(f"{s}_{w}").alias(f"{s}_{w}") for s in ("_mine", "_right") for w in ("failed", "alone")]), "pairs")
    done = []
    for r in pairs.filter("NOT _mine_failed AND NOT _right_failed AND (_mine_alone OR _right_alone)").toLocalIterator():
        done.append((r["_pair"], *same_rows(spark, r["generated"], r["reference"])))
    for r in pairs.filter("NOT _mine_failed AND _right_failed AND _mine_alone").toLocalIterator():
        done.append((r["_pair"], same_rows(spark, r["generated"], r["generated"])[0], False))
    single = spark.createDataFrame(done, "_pair long, _ran boolean, _same boolean")
    apart = pairs.filter("_mine <> _right AND NOT _mine_failed AND NOT _right_failed AND NOT _mine_alone AND NOT _right_alone")
    rows = lambda side: apart.select("_pair", F.col(side).alias("_text")).join(answers, "_text")
    all_ = pairs.join(compared(rows("_mine"), rows("_right")), "_pair", "left").join(single, "_pair", "left")
    executable = F.coalesce("_ran", ~F.col("_mine_failed"))
    correct = F.coalesce("_same", ~F.col("_mine_failed") & ~F.col("_right_failed") & F.coalesce("same", F.lit(True)))
    return Rates(kept(all_.select("_pair", *keep, executable.alias("executable"), correct.alias("correct")), "rates"), jobs, len(done))


def _alone(spark: SparkSession, sql: str) -> DataFrame:
    """Rows (_pair, _at, _rank, _hash) of one query, however many: sorted by ranges, numbered by partitions, ranked by the
    first place of each key."""
    c = clauses(sql)
    df = _answer(spark, c, None)
    if not c.keys and c.limit is None:
        place = df.groupBy("_hash").agg(F.count("*").alias("_n"))  # order is open: equal rows are put together
        rows = place.select("_hash", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_"))
        df, keys = rows.drop("_"), []
    else:
        keys = [f"_k{i}" for i in range(len(c.keys))]
    ordered = kept(df.orderBy(*_order(c), "_hash").withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    numbered = numbered.withColumn("_at", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_start") + 1)
    if c.limit is not None:
        numbered = numbered.filter(F.col("_at") <= c.limit)
    if not keys:
        return numbered.select(F.lit(0).cast("long").alias("_pair"), "_at", F.lit(1).cast("long").alias("_rank"), "_hash")
    first = numbered.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.min("_at").alias("_rank"))
    return numbered.join(first, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])).select(F.lit(0).cast("long").alias("_pair"), "_at", "_rank", "_hash")


def same_rows(spark: SparkSession, generated: str, reference: str) -> tuple[bool, bool]:
    """(executable, correct) of one pair. A query whose clauses can't be taken apart is compared as a multiset."""

    def answered(sql: str) -> DataFrame | None:
        if not _analysed(spark, sql):
            return None
        try:
            try:
                return kept(_alone(spark, sql), "answer")
            except (AnalysisException, ParseException, ValueError):  # its clauses can't be taken apart
                df = spark.sql(sql)
                rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
                rows = rows.select(F.lit(0).cast("long").alias("_pair"), content(rows).alias("_hash"))
                return kept(rows.select("_pair", F.row_number().over(Window.partitionBy("_pair").orderBy("_hash")).cast("long").alias("_at"), F.lit(1).cast("long").alias("_rank"), "_hash"), "answer")
        except Exception as e:  # noqa: BLE001  looked at just here
            if not value_error(e):
                raise
            return None

    mine = answered(generated)
    right = answered(reference)
    if mine is None or right is None:
        return mine is not None, False
    row = compared(mine, right).first()
    return True, row is None or bool(row["same"])
