"""Question-to-SQL examples: candidates are drawn for all entities at once and joined to the facts that answer them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions.parsing import portable_hash
from tallyforge.operators import facts as fx
from tallyforge.operators.shape import decimals, plain

PER_ENTITY, ATTEMPTS, VARIANTS = 6, 24, 3

#: Texts that the questions and their SQL have to equal. {c}, {d}: categories; {m}, {k}: months' labels.
SPENT, IN_MONTH, ROWS = "entity_id=? AND amount<0", "timestamp BETWEEN ? AND ?", "timestamp, amount, category, counterparty"


@dataclass(frozen=True)
class Template:
    """``needs``: columns of the question's parameters; ``result``: how the answer is read."""

    name: str
    kind: str
    result: str
    sql: str
    params: tuple[str, ...]
    variants: tuple[str, str, str]


TEMPLATES = [
    Template("spend_by_category", "aggregation", "scalar", f"SELECT SUM(ABS(amount)) FROM transactions WHERE entity_id=? AND category=? AND amount<0 AND {IN_MONTH}", ("c", "start", "end"),
             ("How much did I spend on {c} in {m}?", "What did I spend on {c} during {m}?", "Total {c} spending for {m}?")),
    Template("spend", "aggregation", "scalar", f"SELECT SUM(ABS(amount)) FROM transactions WHERE {SPENT} AND {IN_MONTH}", ("start", "end"),
             ("How much did I spend in {m}?", "What was my total spending in {m}?", "How much money went out in {m}?")),
    Template("count", "aggregation", "count", f"SELECT COUNT(*) FROM transactions WHERE {SPENT} AND {IN_MONTH}", ("start", "end"),
             ("How many transactions did I make in {m}?", "How many purchases did I have in {m}?", "Number of transactions in {m}?")),
    Template("mean", "aggregation", "scalar", f"SELECT AVG(ABS(amount)) FROM transactions WHERE {SPENT} AND {IN_MONTH}", ("start", "end"),
             ("What was my average transaction amount in {m}?", "On average, how much was each purchase in {m}?", "Average spend per transaction, {m}?")),
    Template("top_category", "aggregation", "row", f"SELECT category, SUM(ABS(amount)) as total FROM transactions WHERE {SPENT} AND {IN_MONTH} GROUP BY category ORDER BY total DESC LIMIT 1", ("start", "end"),
             ("What did I spend the most on in {m}?", "My top spending category in {m}?", "Which category did I spend the most in during {m}?")),
    Template("largest", "extremes", "row", f"SELECT {ROWS} FROM transactions WHERE {SPENT} AND {IN_MONTH} ORDER BY amount ASC LIMIT 1", ("start", "end"),
             ("What was my largest transaction in {m}?", "Biggest purchase I made in {m}?", "What's the highest amount I spent on a single transaction in {m}?")),
    Template("smallest", "extremes", "row", f"SELECT {ROWS} FROM transactions WHERE {SPENT} AND {IN_MONTH} ORDER BY amount DESC LIMIT 1", ("start", "end"),
             ("What was my smallest transaction in {m}?", "Smallest purchase I made in {m}?", "What's the lowest amount I spent on a single transaction in {m}?")),
    Template("compare_categories", "comparison", "compare_rows", f"SELECT category, SUM(ABS(amount)) as total FROM transactions WHERE {SPENT} AND category IN (?,?) AND {IN_MONTH} GROUP BY category", ("c", "d", "start", "end"),
             ("Did I spend more on {c} or {d} in {m}?", "Which did I spend more on in {m}: {c} or {d}?", "Compare my {c} and {d} spending in {m}.")),
    Template("compare_periods", "comparison", "period_compare", f"SELECT (SELECT SUM(ABS(amount)) FROM transactions WHERE {SPENT} AND {IN_MONTH}) as p1, (SELECT SUM(ABS(amount)) FROM transactions WHERE {SPENT} AND {IN_MONTH}) as p2", ("start", "end", "start2", "end2"),
             ("Did I spend more in {m} or {k}?", "Which month did I spend more in: {m} or {k}?", "Compare my spending between {m} and {k}.")),
    Template("list", "retrieval", "table", f"SELECT {ROWS} FROM transactions WHERE entity_id=? AND {IN_MONTH} ORDER BY timestamp", ("start", "end"),
             ("Show me my transactions in {m}.", "List my transactions from {m}.", "What transactions did I make in {m}?")),
    Template("list_category", "retrieval", "table", f"SELECT timestamp, amount, counterparty FROM transactions WHERE entity_id=? AND category=? AND {IN_MONTH} ORDER BY timestamp", ("c", "start", "end"),
             ("Show me my {c} transactions in {m}.", "List all {c} purchases from {m}.", "What {c} transactions did I have in {m}?")),
]


def adapted(t: Template, by: fx.Convention, currency: bool = True) -> tuple[str, list[str]]:
    """The template's SQL for a dataset, with ? for parameters, and the parameters' columns in order."""
    sql = t.sql
    if not by.signed:
        sql = sql.replace("amount<0", "1=1")
        if t.kind == "extremes":
            here, there = ("ASC", "DESC") if t.name == "largest" else ("DESC", "ASC")
            sql = sql.replace(f"ORDER BY amount {here}", f"ORDER BY amount {there}")
    filters = []
    if t.kind != "retrieval":
        filters = ["status"] * (by.status is not None) + ["currency"] * currency
        sql = sql.replace("entity_id=?", "entity_id=?" + "".join(f" AND {f}=?" for f in filters))
    rest = list(t.params)
    own = ["entity_id", *filters]
    return sql, own + rest[:2] + own + rest[2:] if t.name == "compare_periods" else own + rest


def literal(c: Column) -> Column:
    """A string as an SQL literal."""
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))


def rendered(sql: str, values: list[Column]) -> Column:
    """SQL text with literals for its question marks."""
    pieces = sql.split("?")
    if len(pieces) - 1 != len(values):
        raise ValueError(f"{len(pieces) - 1} placeholders, {len(values)} values")
    out = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        out += [literal(value), F.lit(piece)]
    return F.concat(*out)


def _pick(seed: int, purpose: str, items: Column, *by: str) -> Column:
    """One of the items, null if there are none."""
    return F.get(items, F.try_mod(portable_hash(F.lit(f"{seed}{purpose}"), *[F.col(b) for b in by]), F.size(items)).cast("int"))


def candidates(df: DataFrame | fx.Cells, seed: int = 0, attempts: int = ATTEMPTS) -> DataFrame:
    """For each entity and attempt a template with its parameters: number, c, d, month, month2 (null where not needed)."""
    own = fx.cells(df).all.groupBy("entity_id").agg(F.array_sort(F.collect_set("category")).alias("cats"), F.array_sort(F.collect_set("month")).alias("months"))
    tried = own.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))))
    at = ("entity_id", "attempt")
    drawn = tried.select(
        *at, "cats", "months", (portable_hash(F.lit(f"{seed}template"), *[F.col(x) for x in at]) % len(TEMPLATES)).cast("int").alias("number"),
        _pick(seed, "category", F.col("cats"), *at).alias("c"), _pick(seed, "month", F.col("months"), *at).alias("month"),
    )
    other = drawn.select("*", _pick(seed, "category2", F.array_remove("cats", F.col("c")), *at).alias("d"), _pick(seed, "month2", F.array_remove("months", F.col("month")), *at).alias("month2"))
    needs = {t.name: i for i, t in enumerate(TEMPLATES)}
    uses = lambda p: [i for i, t in enumerate(TEMPLATES) if p in t.params]
    kept = other.select(
        *at, "number",
        F.when(F.col("number").isin(uses("c")), F.col("c")).alias("c"),
        F.when(F.col("number").isin(uses("d")), F.col("d")).alias("d"),
        "month",
        F.when(F.col("number") == needs["compare_periods"], F.col("month2")).alias("month2"),
    )
    c_ok = ~F.col("number").isin(uses("c")) | F.col("c").isNotNull()
    d_ok = ~F.col("number").isin(uses("d")) | F.col("d").isNotNull()
    k_ok = (F.col("number") != needs["compare_periods"]) | F.col("month2").isNotNull()
    return kept.filter(c_ok & d_ok & k_ok)


def json_row(row: str, fields: list[tuple[str, str]]) -> Column:
    """A struct of (name, type) fields as JSON, nulls left out; doubles are written as ``plain`` does, large sums too."""

    def member(name: str, kind: str) -> Column:
        c = F.col(f"{row}.{name}")
        text = F.concat(F.lit(f'"{name}":'), plain(c)) if kind == "double" else F.btrim(F.to_json(F.struct(c.alias(name))), F.lit("{}"))
        return F.when(c.isNotNull(), text)

    return F.when(F.col(row).isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *[member(*x) for x in fields]), F.lit("}")))


def answers(df: DataFrame | fx.Cells, asked: DataFrame, by: fx.Convention) -> DataFrame:
    """``asked`` with the answer's text where it is usable, null elsewhere. As in the questions' SQL, a month ends with its
    last whole second: what lies in the fraction behind it is in no month."""
    df = fx.cells(df)
    rows = fx.within_month(fx.spend(df, by))
    cat = fx.by_category(rows)
    month = fx.by_month(rows)
    listed = fx.within_month(df.all).groupBy(*fx.KEY, "category").agg(F.sum("n").alias("listed_c"))
    all_listed = listed.groupBy(*fx.KEY).agg(F.sum("listed_c").alias("listed"))
    total = lambda c, name: cat.select(*fx.KEY, F.col("category").alias(c), F.col("total").alias(name))
    row = lambda f, name: f.select(*fx.KEY, F.struct(*[x for x in f.columns if x not in fx.KEY]).alias(name))
    out = asked.join(total("c", "total_c"), [*fx.KEY, "c"], "left").join(total("d", "total_d"), [*fx.KEY, "d"], "left")
    out = out.join(listed.withColumnRenamed("category", "c"), [*fx.KEY, "c"], "left").join(all_listed, fx.KEY, "left")
    out = out.join(month, fx.KEY, "left").join(month.select("entity_id", F.col("month").alias("month2"), F.col("total").alias("total2")), ["entity_id", "month2"], "left")
    top = fx.top_category(rows).select(*fx.KEY, F.col("top_category").alias("category"), F.col("top_category_amount").alias("total"))
    most, least = fx.extreme(rows), fx.extreme(rows, False)
    out = out.join(row(top, "top"), fx.KEY, "left").join(row(most, "most"), fx.KEY, "left").join(row(least, "least"), fx.KEY, "left")
    text = lambda f, name: json_row(name, [x for x in f.dtypes if x[0] not in fx.KEY])
    found = {
        "spend_by_category": decimals(F.col("total_c")),
        "spend": decimals(F.col("total")),
        "count": F.col("n").cast("string"),
        "mean": decimals(F.col("mean")),
        "top_category": text(top, "top"), "largest": text(most, "most"), "smallest": text(least, "least"),
        "compare_categories": F.concat("c", F.lit(": "), decimals(F.col("total_c")), F.lit("; "), "d", F.lit(": "), decimals(F.col("total_d"))),
        "compare_periods": F.concat(F.lit("period 1: "), decimals(F.col("total")), F.lit(", period 2: "), decimals(F.col("total2"))),
        "list": F.concat(F.col("listed").cast("string"), F.lit(" matching row(s)")),
        "list_category": F.concat(F.col("listed_c").cast("string"), F.lit(" matching row(s)")),
    }
    answer = F.coalesce(*[F.when(F.col("number") == i, found[t.name]) for i, t in enumerate(TEMPLATES)])
    return out.select(*asked.columns, answer.alias("reference_answer"))


def usable(df: DataFrame | fx.Cells, by: fx.Convention, seed: int = 0, per_entity: int = PER_ENTITY, attempts: int = ATTEMPTS) -> DataFrame:
    """The first ``per_entity`` attempts of each entity that have an answer."""
    df = fx.cells(df)
    answered = answers(df, candidates(df, seed, attempts), by).filter("reference_answer IS NOT NULL")
    order = Window.partitionBy("entity_id").orderBy("attempt")  # at most ``attempts`` rows
    return answered.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_entity).drop("_n")


def examples(df: DataFrame | fx.Cells, cuts: DataFrame, by: fx.Convention, seed: int = 0, variants: int = VARIANTS, per_entity: int = PER_ENTITY) -> DataFrame:
    """The training examples: a row for each usable candidate and phrasing, split by the later month's end."""
    from tallyforge.operators.split import label

    df = fx.cells(df)
    kept = usable(df, by, seed, per_entity).join(fx.majority(df, "currency", ["entity_id"]), "entity_id", "left")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    name = lambda c: F.date_format(c, "MMMM yyyy")
    value = {"entity_id": F.col("entity_id"), "status": F.lit(by.status), "currency": F.col("currency"), "c": F.col("c"), "d": F.col("d"),
             "start": iso(F.col("month")), "end": iso(fx.month_end("month")), "start2": iso(F.col("month2")), "end2": iso(fx.month_end("month2"))}
    text, template, kind, params, phrases = [], [], [], [], []
    for i, t in enumerate(TEMPLATES):
        here = F.col("number") == i
        sql, names = adapted(t, by)
        text.append(F.when(here, rendered(sql, [value[n] for n in names])))
        template.append(F.when(here, F.lit(sql)))
        kind.append(F.when(here, F.lit(t.kind)))
        params.append(F.when(here, F.array(*[value[n] for n in names])))
        says = []
        for v in t.variants:
            said = F.lit(v)
            for mark, c in (("{c}", F.col("c")), ("{d}", F.col("d")), ("{m}", name(F.col("month"))), ("{k}", name(F.col("month2")))):
                if mark in v:
                    said = F.replace(said, F.lit(mark), c)
            says.append(said)
        phrases.append(F.when(here, F.array(*says)))
    shift = portable_hash(F.lit(f"{seed}phrase"), F.col("entity_id"), F.col("attempt")) % 3
    out = kept.select("*", F.coalesce(*text).alias("output"), F.coalesce(*kind).alias("template_kind"), F.coalesce(*template).alias("_debug_sql_template"), F.coalesce(*params).alias("_debug_sql_params"), F.coalesce(*phrases).alias("_says"), shift.alias("_shift"))
    out = out.join(F.broadcast(cuts), F.lit(True))  # one row
    end = fx.month_end(F.greatest("month", "month2"))
    out = out.withColumn("split", label(end, F.col("train_cutoff"), F.col("val_cutoff"))).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(min(variants, VARIANTS) - 1))))
    said = F.get("_says", ((F.col("_k") + F.col("_shift")) % 3).cast("int"))
    return out.select(F.lit("query_sql").alias("task"), "entity_id", "attempt", said.alias("instruction"), "output", "reference_answer", "template_kind", "split", "_debug_sql_template", "_debug_sql_params")


@dataclass
class QueryResult:
    ok: bool
    df: DataFrame | None = None
    error: str | None = None


def run_query(spark: SparkSession, sql: str, params: list | None = None) -> QueryResult:
    """Run SQL over the registered views; an error, of analysis or of execution, is part of the result. Question marks
    become named parameters, as the engine doesn't number those of subqueries by their place in the text. The rows are
    persisted, so that reading them doesn't run the query again; ``df.unpersist()`` lets them go."""
    df = None
    try:
        pieces = sql.split("?") if params else [sql]
        if params and len(pieces) - 1 != len(params):
            raise ValueError(f"{len(pieces) - 1} placeholders, {len(params)} values")
        named = pieces[0] + "".join(f":p{i}{piece}" for i, piece in enumerate(pieces[1:]))
        df = spark.sql(named, args={f"p{i}": v for i, v in enumerate(params or [])}).persist()
        df.write.format("noop").mode("overwrite").save()
        return QueryResult(True, df)
    except Exception as e:  # noqa: BLE001  whatever the query raises is its result
        if df is not None:
            df.unpersist()
        return QueryResult(False, error=str(e))


def register(df: DataFrame, name: str = "transactions") -> None:
    from tallyforge.plans.schema import QUERY_COLUMNS

    df.select(*QUERY_COLUMNS).createOrReplaceTempView(name)
