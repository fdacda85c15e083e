"""The registered queries and, for each, SQL of its own for another engine.

Transactions come from the driver's tables: ``ev`` from events (unsigned), ``od`` from orders (signed, by customer),
``nat`` the same by nation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import parsing
from tallyforge.operators import clean, evaluate, facts, narrate, questions, resolve, sanity, shape, split, sqlpairs
from tallyforge.plans.schema import AUTO_INDEX, QUERY_COLUMNS, SALT
from tallyforge.sources import csvfile, tables
from tallyforge.sources.scratch import kept, new_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ev(spark, d) -> DataFrame:
    return load(spark, d, "events").select(
        F.col("user_id").cast("string").alias("entity_id"), F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("value").alias("amount"), F.lit("USD").alias("currency"),
        F.col("event_type").alias("category"), F.when(F.col("event_id") % 2 == 0, "online").otherwise("pos").alias("channel"), F.concat(F.lit("M"), F.col("event_id") % 37).alias("counterparty"),
        F.lit("COMPLETED").alias("status"), F.when(F.col("event_type") == "error", "1").otherwise("0").alias("label"), F.col("event_id").alias("_row_id"),
    )


def _orders(spark, d, entity: str) -> DataFrame:
    key = F.col("o_orderkey")
    joined = load(spark, d, "orders").join(load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col(entity).cast("string").alias("entity_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.when(key % 10 == 0, F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).alias("amount"), F.when(key % 5 == 0, "EUR").otherwise("USD").alias("currency"),
        F.col("o_orderpriority").alias("category"), F.col("c_mktsegment").alias("channel"), F.concat(F.lit("S"), key % 97).alias("counterparty"), F.col("o_orderstatus").alias("status"),
        F.lit(None).cast("string").alias("label"), key.alias("_row_id"),
    )


def od(spark, d):
    return _orders(spark, d, "o_custkey")


def nat(spark, d):
    return _orders(spark, d, "c_nationkey")


EV = """ev AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, CAST(ts AS TIMESTAMP) AS "timestamp", value AS amount, 'USD' AS currency, event_type AS category,
  CASE WHEN event_id % 2 = 0 THEN 'online' ELSE 'pos' END AS channel, 'M' || CAST(event_id % 37 AS VARCHAR) AS counterparty, 'COMPLETED' AS status,
  CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS label, event_id AS _row_id FROM events)"""


def _orders_sql(name: str, entity: str) -> str:
    return f"""{name} AS (SELECT CAST({entity} AS VARCHAR) AS entity_id, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
  CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE -o_totalprice END AS amount, CASE WHEN o_orderkey % 5 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
  o_orderpriority AS category, c_mktsegment AS channel, 'S' || CAST(o_orderkey % 97 AS VARCHAR) AS counterparty, o_orderstatus AS status, o_orderkey AS _row_id
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


OD, NAT = _orders_sql("od", "o_custkey"), _orders_sql("nat", "c_nationkey")
MONTH = "CAST(date_trunc('month', \"timestamp\") AS TIMESTAMP)"
MONEY = "CAST(sum(CAST({} AS DECIMAL(20,4))) AS DOUBLE)"
#: Spend of the majority status in each entity's majority currency.
SP = f"""{NAT}, st AS (SELECT status AS top FROM nat GROUP BY status ORDER BY count(*) DESC, status LIMIT 1),
cu AS (SELECT entity_id, currency AS own FROM (SELECT entity_id, currency, row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, currency) AS k FROM nat GROUP BY entity_id, currency) WHERE k = 1),
sp AS (SELECT nat.*, {MONTH} AS month, abs(amount) AS paid FROM nat JOIN cu USING (entity_id), st WHERE amount < 0 AND status = top AND currency = own)"""
CAT = f"cat AS (SELECT entity_id, month, category, {MONEY.format('paid')} AS total, count(*) AS n FROM sp GROUP BY ALL)"
CUTS = """cuts AS (SELECT max(CASE WHEN k = least(CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT), n - 1) + 1 THEN "timestamp" END) AS train_cutoff,
  max(CASE WHEN k = least(CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT), n - 1) + 1 THEN "timestamp" END) AS val_cutoff
  FROM (SELECT "timestamp", row_number() OVER (ORDER BY "timestamp") AS k, count(*) OVER () AS n FROM {}))"""


def _label(at: str) -> str:
    return f"CASE WHEN {at} <= train_cutoff THEN 'train' WHEN {at} <= val_cutoff THEN 'val' ELSE 'test' END"


EVS = f"{EV}, {CUTS.format('ev')}, evs AS (SELECT ev.*, {_label('\"timestamp\"')} AS split FROM ev, cuts)"


def _d2(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(30,6)) AS DECIMAL(30,2)) AS VARCHAR)"


def _d0(x: str) -> str:
    return f"CAST(CAST(CAST({x} AS DECIMAL(30,6)) AS DECIMAL(30,0)) AS VARCHAR)"


def _ser(category: bool = True) -> str:
    part = "', category: ' || category || " if category else ""
    return f"('{{date: ' || strftime(\"timestamp\", '%Y-%m-%d %H:%M') || ', amount: ' || {_d2('amount')} || ', currency: ' || currency || {part}', channel: ' || channel || ', counterparty: ' || counterparty || ', status: ' || status || '}}')"


def evs(spark, d) -> DataFrame:
    rows = ev(spark, d)
    return split.with_split(rows, split.cutoffs(rows))


def _spend(spark, d) -> DataFrame:
    rows = facts.cells(nat(spark, d))
    return facts.spend(rows, facts.detect(rows))


# Parsing and conventions


@query("amount_normalize", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (2, 3) THEN -1 ELSE 1 END * CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""")
def amount_normalize(spark, d):
    two = F.col("o_totalprice").cast("decimal(18,2)")
    plain, grouped, k = two.cast("string"), F.format_number(two, 2), F.col("o_orderkey") % 6
    raw = (
        F.when(k == 0, F.concat(F.lit("$"), grouped)).when(k == 1, F.translate(grouped, ",.", ".,")).when(k == 2, F.concat(F.lit("("), plain, F.lit(")")))
        .when(k == 3, F.concat(plain, F.lit("-"))).when(k == 4, F.concat(F.lit("EUR "), plain)).otherwise(F.concat(plain, F.lit(" usd ")))
    )
    return load(spark, d, "orders").select("o_orderkey", parsing.amount(raw).alias("amount"))


@query("date_parse_mixed", "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders")
def date_parse_mixed(spark, d):
    at, k = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey") % 8
    layouts = ["yyyy-MM-dd", "dd/MM/yyyy", "d-MMM-yyyy", "MMMM d, yyyy", "yyyy/MM/dd HH:mm", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "dd-MM-yy"]
    raw = F.coalesce(*[F.when(k == i, F.date_format(at, p)) for i, p in enumerate(layouts)])
    return load(spark, d, "orders").select("o_orderkey", parsing.timestamp(raw).alias("parsed"))


@query("date_dayfirst_vote", "SELECT CAST(0 AS DOUBLE) AS iso, count(*) FILTER (WHERE day(o_orderdate) > 12) AS day_first, CAST(0 AS BIGINT) AS month_first FROM orders")
def date_dayfirst_vote(spark, d):
    return resolve.date_votes(load(spark, d, "orders").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("v")))


@query("cents_sign_detect", f"""WITH {OD} SELECT avg(CASE WHEN amount % 1 = 0 THEN 1.0 ELSE 0.0 END) AS whole, median(amount) > {resolve.LARGE} AS large, count(*) FILTER (WHERE amount < 0) AS negative FROM od""")
def cents_sign_detect(spark, d):
    return resolve.amount_measures(od(spark, d), F.col("amount"))


@query("content_profile", """WITH x AS (SELECT 'c_custkey' AS name, CAST(c_custkey AS VARCHAR) AS v FROM customer UNION ALL SELECT 'c_name', c_name FROM customer UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
 UNION ALL SELECT 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)
SELECT name, count(v) AS n, count(DISTINCT v) AS "distinct", CAST(0 AS DOUBLE) AS dates, avg(CASE WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0.0 END) AS numbers FROM x GROUP BY name""")
def content_profile(spark, d):
    return resolve.full_profile(load(spark, d, "customer"))


@query("direction_sign", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * o_totalprice AS amount FROM orders")
def direction_sign(spark, d):
    mark = F.when(F.col("o_orderstatus") == "F", " dr ").when(F.col("o_orderstatus") == "O", "CR")
    return load(spark, d, "orders").select("o_orderkey", parsing.amount(F.col("o_totalprice").cast("string"), direction=mark).alias("amount"))


_RESOLVED = """SELECT * FROM (VALUES ('acct_no', 'entity_id', 0.95, 'exact_alias', 'auto_mapped'), ('date', 'timestamp', 0.95, 'exact_alias', 'auto_mapped'),
 ('amt_cents', 'amount', 0.95, 'exact_alias', 'auto_mapped'), ('mcc', 'category', 0.95, 'exact_alias', 'auto_mapped'), ('chnl', 'channel', 0.95, 'exact_alias', 'auto_mapped'),
 ('merchant', 'counterparty', 0.95, 'exact_alias', 'auto_mapped'), ('dr_cr', '_direction (sign helper)', 0.95, 'exact_alias', 'used_for_sign_resolution'), ('fraud_flag', 'label', 0.95, 'exact_alias', 'auto_mapped'))
 AS t(source_column, canonical_field, confidence, method, status)"""


def _draw_sql(purpose: str, *by: str) -> str:
    return f"((CAST('0x' || substr(md5(concat_ws('|', '42{purpose}', {', '.join(by)})), 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE))"


def _pick_sql(items: list[str], purpose: str) -> str:
    return f"[{', '.join(_text(x) for x in items)}][1 + CAST(floor({_draw_sql(purpose, 'entity_id', 'CAST(k AS VARCHAR)')} * {len(items)}) AS BIGINT)]"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_AT = ("entity_id", "CAST(k AS VARCHAR)")
_USUAL = " ".join(f"WHEN {_text(m)} THEN {_text(c)}" for m, c in tables.MERCHANTS.items())


@query("synthetic_transactions", f"""WITH u AS (SELECT 'C' || c_custkey AS entity_id FROM customer), n AS (SELECT entity_id, unnest(range(1, 1 + CAST(floor({_draw_sql('count', 'entity_id')} * 45 + 15) AS BIGINT))) AS k FROM u),
d AS (SELECT entity_id, k, floor({_draw_sql('second', *_AT)} * 90 * 86400) + floor({_draw_sql('hour', *_AT)} * 24) * 3600 AS s, {_pick_sql(list(tables.MERCHANTS), 'merchant')} AS counterparty, {_pick_sql(sorted(set(tables.MERCHANTS.values())), 'category')} AS other,
 {_draw_sql('noise', *_AT)} AS noise, {_pick_sql(tables.CHANNELS, 'channel')} AS way, exp(sqrt(-2 * ln({_draw_sql('paid1', *_AT)})) * cos(2 * pi() * {_draw_sql('paid2', *_AT)}) * CAST(0.9 AS DOUBLE) + CAST(3.2 AS DOUBLE)) AS paid, {_draw_sql('odd', *_AT)} AS odd, {_draw_sql('times', *_AT)} AS times FROM n)
SELECT entity_id, CAST(k AS INTEGER) AS k, TIMESTAMP '2026-01-01' + to_seconds(CAST(s AS BIGINT)) AS "timestamp", round(paid * CASE WHEN odd < 0.02 THEN times * 9 + 6 ELSE CAST(1 AS DOUBLE) END, 2) AS amount, 'USD' AS currency,
 CASE WHEN noise > 0.10 THEN CASE counterparty {_USUAL} END ELSE other END AS category, CASE WHEN odd < 0.02 THEN 'online' ELSE way END AS channel, counterparty, 'COMPLETED' AS status, CAST(CASE WHEN odd < 0.02 THEN 1 ELSE 0 END AS INTEGER) AS label FROM d""")
def synthetic_transactions(spark, d):
    """Transactions made up for each of the given customers."""
    return tables.synthetic_for(_customers(spark, d))


@query("schema_resolution", _RESOLVED.replace("0.95", "CAST(0.95 AS DOUBLE)"))
def schema_resolution(spark, d):
    return _report(spark, resolve.resolve(tables.provider_b(spark, entities=_customers(spark, d))))


def _customers(spark, d) -> DataFrame:
    return load(spark, d, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("entity_id"))


def _report(spark, found: resolve.Resolution) -> DataFrame:
    names = ["source_column", "canonical_field", "confidence", "method", "status"]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in found.report], "source_column string, canonical_field string, confidence double, method string, status string")


def _oddly_named(spark, d) -> DataFrame:
    """Orders under a header that is near a known one, two of one field, and three that only contents explain."""
    return load(spark, d, "orders").select(
        F.concat(F.lit("C"), "o_orderkey").alias("who"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("TxnDateTime"), F.col("o_totalprice").cast("string").alias("q"),
        F.col("o_orderpriority").alias("channel"), F.col("o_orderpriority").alias("payment_channel"), F.col("o_orderstatus").alias("remark"),
    )


def _report_sql(*rows: str) -> str:
    return f"SELECT source_column, canonical_field, CAST(confidence AS DOUBLE) AS confidence, method, status FROM (VALUES {', '.join(rows)}) AS t(source_column, canonical_field, confidence, method, status)"


_BY_CONTENT = ["('who', 'entity_id', 0.4, 'content_inference', 'auto_mapped_flagged')", "('TxnDateTime', 'timestamp', 0.63, 'fuzzy_alias', 'auto_mapped_flagged')", "('q', 'amount', 0.5, 'content_inference', 'auto_mapped_flagged')"]


@query("schema_resolution_content", _report_sql(*_BY_CONTENT, "('channel', 'channel', 0.95, 'exact_alias', 'auto_mapped')", "('payment_channel', NULL, 0.95, 'exact_alias', 'quarantined_collision')", "('remark', NULL, 0.3, 'content_inference', 'quarantined')"))
def schema_resolution_content(spark, d):
    return _report(spark, resolve.resolve(_oddly_named(spark, d)))


@query("schema_override", _report_sql(*_BY_CONTENT, "('remark', 'label', 1.0, 'user_provided', 'manual_override')", "('channel', NULL, 0.0, 'superseded_by_override', 'quarantined')", "('payment_channel', 'channel', 1.0, 'user_provided', 'manual_override')"))
def schema_override(spark, d):
    return _report(spark, resolve.override(resolve.resolve(_oddly_named(spark, d)), {"channel": "payment_channel", "label": "remark"}))


def _bank_export(spark, d) -> DataFrame:
    """Orders under headers of which two speak of the sign, one merely near a name, and one near a name its values belie."""
    key = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("acct_nos"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("posted_at2"), F.floor(F.col("o_totalprice") * 100).cast("string").alias("q"),
        F.col("o_orderpriority").alias("TransactionAmounts"), F.when(key % 10 == 0, "CR").otherwise("DR").alias("dr_cr"), F.when(key % 10 == 0, "C").otherwise("D").alias("debit_credits"),
    )


@query("schema_resolution_direction", _report_sql(
    "('acct_nos', 'entity_id', 0.69, 'fuzzy_alias', 'auto_mapped_flagged')", "('posted_at2', 'timestamp', 0.71, 'fuzzy_alias', 'auto_mapped_flagged')", "('q', 'amount', 0.5, 'content_inference', 'auto_mapped_flagged')",
    "('TransactionAmounts', NULL, 0.3, 'content_inference', 'quarantined')", "('dr_cr', '_direction (sign helper)', 0.95, 'exact_alias', 'used_for_sign_resolution')", "('debit_credits', '_direction (sign helper)', 0.72, 'fuzzy_alias', 'used_for_sign_resolution')",
))
def schema_resolution_direction(spark, d):
    return _report(spark, resolve.resolve(_bank_export(spark, d)))


@query("signed_by_direction", """SELECT CAST(o_custkey AS VARCHAR) AS entity_id, CAST(o_orderdate AS TIMESTAMP) AS "timestamp", CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE -1 END * (CAST(floor(o_totalprice * 100) AS DOUBLE) / 100) AS amount FROM orders""")
def signed_by_direction(spark, d):
    """What is decided about the export, applied: day first, cents, and the last column that gives a sign."""
    raw = _bank_export(spark, d).withColumn("_row_id", F.monotonically_increasing_id())
    found = resolve.resolve(raw.drop("_row_id"))
    return clean.to_canonical(raw, found, resolve.conventions(raw, found)).select("entity_id", "timestamp", "amount")


@query("convention_notes", f"""WITH {OD}, x AS (SELECT 'export' AS source, CAST(floor(o_totalprice * 100) AS DOUBLE) AS v FROM orders UNION ALL SELECT 'plain', amount FROM od UNION ALL SELECT 'bare', o_totalprice FROM orders),
m AS (SELECT source, avg(CASE WHEN v % 1 = 0 THEN 1.0 ELSE 0.0 END) > 0.98 AND median(v) > {resolve.LARGE} AS cents, count(*) FILTER (WHERE v < 0) = 0 AS positive FROM x GROUP BY 1)
SELECT source, 'amount' AS field, 'amounts look like cents and are divided by 100' AS assumption, 'medium' AS confidence FROM m WHERE cents
UNION ALL SELECT source, 'amount', 'column ''debit_credits'' gives the sign', 'high' FROM m WHERE source = 'export'
UNION ALL SELECT source, 'amount', 'neither negative amounts nor a direction column: every amount counts as spend', 'low' FROM m WHERE positive AND source <> 'export'
UNION ALL SELECT 'export', 'timestamp', 'dates that can only be day-first', 'medium' FROM (SELECT 1 FROM orders WHERE day(o_orderdate) > 12 LIMIT 1)
UNION ALL SELECT source, 'timestamp', 'ISO date format (YYYY-MM-DD)', 'high' FROM m WHERE source <> 'export'""")
def convention_notes(spark, d):
    iso = lambda c: F.date_format(c, "yyyy-MM-dd").alias("date")
    sources = {"export": _bank_export(spark, d), "plain": od(spark, d).select(iso("timestamp"), "amount"), "bare": load(spark, d, "orders").select(iso("o_orderdate"), F.col("o_totalprice").alias("amount"))}
    notes = [(name, n["field"], n["assumption"], n["confidence"]) for name, df in sources.items() for n in resolve.conventions(df, resolve.resolve(df)).notes]
    return spark.createDataFrame(notes, "source string, field string, assumption string, confidence string")


@query("mapping_status_tally", f"SELECT status, count(*) AS n FROM ({_RESOLVED}) GROUP BY status")
def mapping_status_tally(spark, d):
    return resolve.status_tally(schema_resolution(spark, d))


# Reading


#: Rows of a file that ``_as_csv`` writes.
_FILE_ROWS = 20_000


def _as_csv(spark, d) -> str:
    """Orders as CSV files of up to _FILE_ROWS keys, and their folder: notes with commas, quotes and line breaks, every 11th row
    with a field too many, every 13th without its note, every 17th behind a blank line."""
    key = F.col("o_orderkey")
    said = F.concat(F.lit("\"said \"\""), F.col("o_orderpriority"), F.lit("\"\", then\n\nleft\""))
    note = F.when(key % 3 == 0, said).when(key % 3 == 1, F.lit("5\" wide")).otherwise(F.concat(F.lit("\"a, b: "), F.col("o_orderstatus"), F.lit("\"")))
    fields = F.concat_ws(",", key.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.when(key % 13 != 0, note), F.when((key % 11 == 0) & (key % 13 != 0), F.lit("more")))
    line = F.concat(F.when(key % 17 == 0, F.lit("\n")).otherwise(F.lit("")), fields)
    bucket = F.format_string("%012d", F.floor(key / _FILE_ROWS))
    files = load(spark, d, "orders").groupBy(bucket.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct(key, line.alias("line")))).alias("all"))
    text = F.concat(F.lit("txn,date,amount,note\n"), F.array_join(F.transform("all", lambda x: x["line"]), "\n"))
    path = new_path(spark, "csv")
    files.select("bucket", text.alias("value")).write.partitionBy("bucket").text(path)
    return path


_CSV = """c AS (SELECT o_orderkey AS k, o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0 AS long, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'said "' || o_orderpriority || '", then' || chr(10) || chr(10) || 'left' WHEN o_orderkey % 3 = 1 THEN '5" wide' ELSE 'a, b: ' || o_orderstatus END AS note FROM orders),
csv AS (SELECT *, row_number() OVER (ORDER BY k) - 1 AS _row_id FROM c WHERE NOT long)"""


@query("csv_read", f"WITH {_CSV} SELECT CAST(k AS VARCHAR) AS txn, date, amount, note, _row_id FROM csv")
def csv_read(spark, d):
    return tables.read_csv(spark, _as_csv(spark, d))


@query("csv_malformed", f"WITH {_CSV} SELECT count(*) FILTER (WHERE NOT long) AS n, count(*) FILTER (WHERE long) AS skipped FROM c")
def csv_malformed(spark, d):
    found = csvfile.read(spark, _as_csv(spark, d))
    return found.df.agg(F.count("*").alias("n"), F.lit(found.skipped).cast("long").alias("skipped"))


@query("auto_index_ids", f"WITH {_CSV} SELECT k AS txn, printf('ROW_%06d', _row_id) AS entity_id FROM csv")
def auto_index_ids(spark, d):
    raw = tables.read_csv(spark, _as_csv(spark, d))
    found = resolve.override(resolve.Resolution([], {"date": "timestamp", "amount": "amount"}, ["txn", "note"]), {"entity_id": AUTO_INDEX})
    mapped = clean.to_canonical(raw, found, resolve.Conventions(day_first=False), ["txn"])
    return mapped.select(F.col("extra__txn").cast("long").alias("txn"), "entity_id")


# Cleaning


def _raw(spark, d) -> DataFrame:
    """Orders with holes and copies: every 13th amount and every 17th date is missing, every 7th row comes twice."""
    key = F.col("o_orderkey")
    rows = load(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"), F.when(key % 17 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("txn_date"),
        F.when(key % 13 != 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("note"), key.alias("_row_id"),
    )
    return rows.union(rows.filter(F.col("_row_id") % 7 == 0).withColumn("_row_id", F.col("_row_id") + 1_000_000_000))


_FOUND = dict(report=[], quarantined=["note"], columns={"customer_id": "entity_id", "txn_date": "timestamp", "amount": "amount", "category": "category"})
RAW = """raw AS (SELECT * FROM (SELECT CAST(o_custkey AS VARCHAR) AS entity_id, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS "timestamp",
 CASE WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount, o_orderpriority AS category, o_orderstatus AS note, o_orderkey AS _row_id FROM orders)),
both_ AS (SELECT * FROM raw UNION ALL SELECT * REPLACE (_row_id + 1000000000 AS _row_id) FROM raw WHERE _row_id % 7 = 0),
gated AS (SELECT * FROM both_ WHERE entity_id IS NOT NULL AND "timestamp" IS NOT NULL AND amount IS NOT NULL),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, "timestamp", amount ORDER BY _row_id) AS k FROM gated) WHERE k = 1)"""


def _mapped(spark, d) -> DataFrame:
    return clean.to_canonical(_raw(spark, d), resolve.Resolution(**_FOUND), resolve.Conventions(day_first=False), ["note"])


@query("null_gate", f'WITH {RAW} SELECT entity_id, "timestamp", amount, _row_id FROM gated')
def null_gate(spark, d):
    return clean.gate(_mapped(spark, d)).select("entity_id", "timestamp", "amount", "_row_id")


@query("dedup_keep_first", f'WITH {RAW} SELECT entity_id, "timestamp", amount, category, _row_id FROM kept')
def dedup_keep_first(spark, d):
    return clean.keep_first(clean.gate(_mapped(spark, d))).select("entity_id", "timestamp", "amount", "category", "_row_id")


@query("gate_stats", f"""WITH {RAW} SELECT (SELECT count(*) FROM both_) AS input_rows, (SELECT count(*) FROM both_) - (SELECT count(*) FROM gated) AS dropped_missing_required,
 (SELECT count(*) FILTER (WHERE entity_id IS NULL) FROM both_) AS null_entity_id, (SELECT count(*) FILTER (WHERE "timestamp" IS NULL) FROM both_) AS null_timestamp, (SELECT count(*) FILTER (WHERE amount IS NULL) FROM both_) AS null_amount,
 (SELECT count(*) FROM kept) AS output_rows, (SELECT count(*) FROM gated) - (SELECT count(*) FROM kept) AS duplicate_rows_removed, (SELECT count(*) FROM kept) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM both_) AS retained_pct""")
def gate_stats(spark, d):
    return clean.gate_stats(_mapped(spark, d))


@query("settled_rows", f'WITH {RAW} SELECT entity_id, "timestamp", amount, category, _row_id FROM kept')
def settled_rows(spark, d):
    return clean.settled_rows(clean.settled(_mapped(spark, d))).select("entity_id", "timestamp", "amount", "category", "_row_id")


@query("date_unread_layouts", """WITH r AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
v AS (SELECT CASE k % 5 WHEN 0 THEN d WHEN 1 THEN 'on ' || d WHEN 2 THEN CAST(k AS VARCHAR) WHEN 3 THEN d || ' 25:61' ELSE substr(d, 1, 7) END AS v, CASE k % 5 WHEN 1 THEN 'a 9-9-9' WHEN 2 THEN '9' WHEN 3 THEN '9-9-9 9:9' WHEN 4 THEN '9-9' END AS layout FROM r)
SELECT layout, count(*) AS n, min(v) AS example FROM v WHERE layout IS NOT NULL GROUP BY layout""")
def date_unread_layouts(spark, d):
    """Values of which one in five is a date."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    forms = [day, F.concat(F.lit("on "), day), key.cast("string"), F.concat(day, F.lit(" 25:61")), F.substring(day, 1, 7)]
    rows = load(spark, d, "orders").select(F.coalesce(*[F.when(key % 5 == i, f) for i, f in enumerate(forms)]).alias("date"))
    return resolve.unread_dates(rows, "date", resolve.Conventions())


@query("defaults_extras", f"WITH {RAW} SELECT _row_id, 'USD' AS currency, 'UNKNOWN' AS channel, 'UNKNOWN' AS counterparty, 'COMPLETED' AS status, note AS extra__note FROM both_")
def defaults_extras(spark, d):
    return _mapped(spark, d).select("_row_id", "currency", "channel", "counterparty", "status", "extra__note")


@query("pii_hash", f"SELECT c_custkey, substr(sha256('{SALT}:' || c_name), 1, 16) AS hashed FROM customer")
def pii_hash(spark, d):
    return load(spark, d, "customer").select("c_custkey", parsing.pseudonym(F.col("c_name")).alias("hashed"))


_W = 'PARTITION BY entity_id ORDER BY "timestamp", _row_id'


@query("causal_features", f"""WITH {EV} SELECT _row_id, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week, CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
 round(date_diff('microsecond', lag("timestamp") OVER ({_W}), "timestamp") / CAST(3600e6 AS DOUBLE), 6) AS hours_since, round(avg(amount) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS rolling FROM ev""")
def causal_features(spark, d):
    rows = clean.with_features(ev(spark, d))
    return rows.select("_row_id", "day_of_week", "hour_of_day", F.round("time_since_last_txn_hours", 6).alias("hours_since"), F.round("rolling_avg_amount_3", 6).alias("rolling"))


@query("time_split", f"WITH {EVS} SELECT _row_id, split FROM evs")
def time_split(spark, d):
    return evs(spark, d).select("_row_id", "split")


@query("split_counts", f"WITH {EVS} SELECT s.split, count(_row_id) AS n FROM (VALUES ('train'), ('val'), ('test')) AS s(split) LEFT JOIN evs USING (split) GROUP BY s.split")
def split_counts(spark, d):
    return split.split_counts(evs(spark, d))


# Shaping


@query("serialize_txn", f"WITH {EV} SELECT _row_id, {_ser()} AS text FROM ev")
def serialize_txn(spark, d):
    rows = ev(spark, d)
    return rows.select("_row_id", shape.serialized(rows.columns).alias("text"))


@query("fraud_context", f"""WITH {EVS}, s AS (SELECT *, {_ser()} AS text FROM evs), c AS (SELECT *, list(text) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS context FROM s)
SELECT _row_id, array_to_string(context, ' ') AS context, CASE WHEN label = '1' THEN 'FRAUD' ELSE 'LEGITIMATE' END AS output, split FROM c""")
def fraud_context(spark, d):
    return shape.fraud_examples(evs(spark, d)).select("_row_id", F.array_join("context", " ").alias("context"), "output", "split")


@query("fraud_context_unlabelled", f"""WITH {EVS}, s AS (SELECT *, {_ser()} AS text FROM evs), c AS (SELECT *, list(text) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS context FROM s)
SELECT _row_id, array_to_string(context, ' ') AS context, CASE WHEN label = '1' THEN 'FRAUD' ELSE 'LEGITIMATE' END AS output FROM c WHERE category <> 'view'""")
def fraud_context_unlabelled(spark, d):
    rows = evs(spark, d).withColumn("label", F.when(F.col("category") != "view", F.col("label")))
    return shape.fraud_examples(rows).select("_row_id", F.array_join("context", " ").alias("context"), "output")


@query("categorize_examples",f"WITH {EVS} SELECT _row_id, {_ser(False)} AS context, category AS output, split FROM evs")
def categorize_examples(spark, d):
    return shape.category_examples(evs(spark, d)).select("_row_id", F.array_join("context", " ").alias("context"), "output", "split")


@query("behavior_windows", f"""WITH {EVS}, s AS (SELECT *, {_ser()} AS text FROM evs), c AS (SELECT *, row_number() OVER ({_W}) AS k, count(*) OVER (PARTITION BY entity_id) AS n,
 list(text) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS seq FROM s) SELECT _row_id, array_to_string(seq, ' ') AS sequence, split FROM c WHERE k >= 2 AND ((k - 2) % 5 = 0 OR k = n)""")
def behavior_windows(spark, d):
    return shape.behaviour_examples(evs(spark, d)).select("_row_id", F.array_join("sequence", " ").alias("sequence"), "split")


@query("shape_stats", f"WITH {EVS} SELECT 'fraud_flagging' AS task, split, CASE WHEN label = '1' THEN 'FRAUD' ELSE 'LEGITIMATE' END AS output, count(*) AS n FROM evs GROUP BY ALL")
def shape_stats(spark, d):
    return shape.shape_stats(shape.fraud_examples(evs(spark, d)))


@query("task_counts", f"WITH {EV}, n AS (SELECT entity_id, count(*) AS n FROM ev GROUP BY 1) SELECT 'categorization' AS task, count(*) AS n FROM ev UNION ALL SELECT 'fraud_flagging', count(*) FROM ev UNION ALL SELECT 'general_behavioral', CAST(sum(CASE WHEN n < 2 THEN 0 ELSE (n - 2) // 5 + 1 + CASE WHEN (n - 2) % 5 = 0 THEN 0 ELSE 1 END END) AS BIGINT) FROM n")
def task_counts(spark, d):
    rows = evs(spark, d)
    parts = [shape.shape(rows, t).select("task") for t in shape.BUILDERS]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("task").agg(F.count("*").alias("n"))


# Facts


@query("month_windows", f"WITH {OD} SELECT DISTINCT entity_id, {MONTH} AS month, strftime(\"timestamp\", '%B %Y') AS label, {MONTH} + INTERVAL 1 MONTH - INTERVAL 1 SECOND AS month_end FROM od")
def month_windows(spark, d):
    return facts.month_windows(od(spark, d))


@query("spend_by_category_month", f"WITH {SP}, {CAT} SELECT * FROM cat")
def spend_by_category_month(spark, d):
    return facts.by_category(_spend(spark, d))


@query("spend_by_month", f"WITH {SP} SELECT entity_id, month, {MONEY.format('paid')} AS total FROM sp GROUP BY ALL")
def spend_by_month(spark, d):
    return facts.by_month(_spend(spark, d)).select("entity_id", "month", "total")


@query("txn_count_month", f"WITH {SP} SELECT entity_id, month, count(*) AS n FROM sp GROUP BY ALL")
def txn_count_month(spark, d):
    return facts.by_month(_spend(spark, d)).select("entity_id", "month", "n")


@query("avg_txn_month", f"WITH {SP} SELECT entity_id, month, round({MONEY.format('paid')} / count(*), 3) AS mean FROM sp GROUP BY ALL")
def avg_txn_month(spark, d):
    return facts.by_month(_spend(spark, d)).select("entity_id", "month", F.round("mean", 3).alias("mean"))


TOP = "top AS (SELECT entity_id, month, category AS top_category, total AS top_category_amount FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, month ORDER BY total DESC, category) AS k FROM cat) WHERE k = 1)"
SHOP = "shop AS (SELECT entity_id, month, counterparty AS top_merchant, n AS top_merchant_count FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, month ORDER BY n DESC, counterparty) AS k FROM (SELECT entity_id, month, counterparty, count(*) AS n FROM sp GROUP BY ALL)) WHERE k = 1)"


@query("top_category_month", f"WITH {SP}, {CAT}, {TOP} SELECT * FROM top")
def top_category_month(spark, d):
    return facts.top_category(_spend(spark, d))


@query("facts_top_merchant", f"WITH {SP}, {SHOP} SELECT * FROM shop")
def facts_top_merchant(spark, d):
    return facts.top_merchant(_spend(spark, d))


def _extreme_sql(order: str) -> str:
    return f'SELECT entity_id, month, "timestamp", amount, category, counterparty FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, month ORDER BY paid {order}, "timestamp", _row_id) AS k FROM sp) WHERE k = 1'


@query("largest_txn_month", f"WITH {SP} {_extreme_sql('DESC')}")
def largest_txn_month(spark, d):
    return facts.extreme(_spend(spark, d))


@query("smallest_txn_month", f"WITH {SP} {_extreme_sql('ASC')}")
def smallest_txn_month(spark, d):
    return facts.extreme(_spend(spark, d), largest=False)


@query("compare_categories", f"WITH {SP}, {CAT} SELECT a.entity_id, a.month, a.category AS category_a, a.total AS total_a, b.category AS category_b, b.total AS total_b FROM cat a JOIN cat b ON a.entity_id = b.entity_id AND a.month = b.month AND a.category < b.category")
def compare_categories(spark, d):
    return facts.compare_categories(_spend(spark, d))


@query("compare_periods", f"""WITH {SP} SELECT entity_id, CAST(sum(CAST(paid AS DECIMAL(20,4))) FILTER (WHERE month = TIMESTAMP '1996-03-01') AS DOUBLE) AS p1, CAST(sum(CAST(paid AS DECIMAL(20,4))) FILTER (WHERE month = TIMESTAMP '1997-05-01') AS DOUBLE) AS p2
FROM sp WHERE month IN (TIMESTAMP '1996-03-01', TIMESTAMP '1997-05-01') GROUP BY entity_id""")
def compare_periods(spark, d):
    month = lambda m: F.lit(m).cast("timestamp_ntz")
    return facts.compare_periods(_spend(spark, d), month("1996-03-01"), month("1997-05-01"))


def _listed_sql(source: str, name: str) -> str:
    return f'WITH {source} SELECT entity_id, {MONTH} AS month, "timestamp", amount, category, counterparty, _row_id FROM {name}'


def _by_category_sql(source: str, name: str) -> str:
    return f"""WITH {source} SELECT entity_id, {MONTH} AS month, category, "timestamp", amount, counterparty, rank() OVER (PARTITION BY entity_id, {MONTH}, category ORDER BY "timestamp") AS place FROM {name} WHERE category IS NOT NULL"""


@query("list_txns", _listed_sql(OD, "od"))
def list_txns(spark, d):
    return facts.listing(od(spark, d))


@query("list_txns_all", _listed_sql(NAT, "nat"))
def list_txns_all(spark, d):
    """The same by nation."""
    return facts.listing(nat(spark, d))


@query("list_txns_events", _listed_sql(EV, "ev"))
def list_txns_events(spark, d):
    """The same over events, which have no sign."""
    return facts.listing(ev(spark, d))


@query("list_txns_category", _by_category_sql(OD, "od"))
def list_txns_category(spark, d):
    return facts.listing_by_category(od(spark, d))


@query("list_txns_category_all", _by_category_sql(NAT, "nat"))
def list_txns_category_all(spark, d):
    """The same by nation."""
    return facts.listing_by_category(nat(spark, d))


@query("list_txns_category_events", _by_category_sql(EV, "ev"))
def list_txns_category_events(spark, d):
    """The same over events, which have no sign."""
    return facts.listing_by_category(ev(spark, d))


@query("majority_status", f"WITH {NAT} SELECT status FROM nat GROUP BY status ORDER BY count(*) DESC, status LIMIT 1")
def majority_status(spark, d):
    return facts.majority(nat(spark, d), "status")


@query("majority_currency", f"WITH {SP} SELECT entity_id, own AS currency FROM cu")
def majority_currency(spark, d):
    return facts.majority(nat(spark, d), "currency", ["entity_id"])


FACTS = f"""{SP}, {CAT}, {TOP}, {SHOP}, big AS ({_extreme_sql('DESC')}),
core AS (SELECT entity_id, month, {MONEY.format('paid')} AS total, count(*) AS n FROM sp GROUP BY ALL HAVING total <> 0),
able AS (SELECT entity_id FROM nat GROUP BY 1 HAVING count(*) >= 5),
prev AS (SELECT c.entity_id, c.month, {MONEY.format('s.paid')} AS prev_total FROM core c JOIN sp s ON s.entity_id = c.entity_id AND s."timestamp" < c.month AND s."timestamp" >= c.month - ((c.month + INTERVAL 1 MONTH - INTERVAL 1 SECOND) - c.month) GROUP BY ALL),
f0 AS (SELECT core.*, top_category, top_category_amount, top_category_amount / total * 100 AS top_category_pct, top_merchant, top_merchant_count, abs(big.amount) AS max_amount, big.category AS max_category, big.counterparty AS max_merchant,
 (total - prev_total) / nullif(prev_total, 0) * 100 AS change, own AS currency
 FROM core JOIN able USING (entity_id) LEFT JOIN top USING (entity_id, month) LEFT JOIN shop USING (entity_id, month) LEFT JOIN big USING (entity_id, month) LEFT JOIN prev USING (entity_id, month) LEFT JOIN cu USING (entity_id)),
facts AS (SELECT * EXCLUDE (change), CASE WHEN change > 0 THEN 'up' WHEN change <= 0 THEN 'down' END AS trend_direction, abs(change) AS trend_pct FROM f0)"""


def _facts(spark, d) -> DataFrame:
    return facts.facts(nat(spark, d))


@query("facts_core", f"WITH {FACTS} SELECT entity_id, month, total AS total_spend, n AS transaction_count, top_category, top_category_amount, round(top_category_pct, 4) AS top_category_pct FROM facts")
def facts_core(spark, d):
    return _facts(spark, d).select("entity_id", "month", "total_spend", "transaction_count", "top_category", "top_category_amount", F.round("top_category_pct", 4).alias("top_category_pct"))


@query("facts_max_txn", f"WITH {FACTS} SELECT entity_id, month, max_amount, max_category, max_merchant, currency FROM facts")
def facts_max_txn(spark, d):
    return _facts(spark, d).select("entity_id", "month", "max_amount", "max_category", "max_merchant", "currency")


@query("facts_trend", f"WITH {FACTS} SELECT entity_id, month, trend_direction, round(trend_pct, 4) AS trend_pct FROM facts")
def facts_trend(spark, d):
    return _facts(spark, d).select("entity_id", "month", "trend_direction", F.round("trend_pct", 4).alias("trend_pct"))


def _hash(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


_SIGN = "CASE currency WHEN 'USD' THEN '$' WHEN 'EUR' THEN '€' END"
_CHOICE = _hash("'0summary'", "entity_id", "strftime(month, '%Y-%m')", "CAST(variant AS VARCHAR)") + " % 4"


@query("narrative", f"""WITH {FACTS}, {CUTS.format('nat')}, v AS (SELECT *, {_CHOICE} AS choice, {_SIGN} AS s FROM facts, (VALUES (0), (1)) AS p(variant))
SELECT entity_id, month, CAST(variant AS INTEGER) AS variant, 'Summarize my spending in ' || strftime(month, '%B %Y') || '.' AS instruction,
 concat_ws(' ', 'In ' || strftime(month, '%B %Y') || ', you made ' || n || ' transaction' || CASE WHEN n = 1 THEN '' ELSE 's' END || ' totaling ' || s || {_d2('total')} || '.',
 CASE WHEN choice % 2 = 0 THEN 'Most of that went to ' || top_category || ' (' || s || {_d2('top_category_amount')} || ', ' || {_d0('top_category_pct')} || '% of your spending).'
  ELSE top_category || ' was your top category at ' || s || {_d2('top_category_amount')} || ' (' || {_d0('top_category_pct')} || '% of the total).' END,
 CASE WHEN choice < 2 THEN 'You shopped most often at ' || top_merchant || ' (' || top_merchant_count || ' times).' ELSE top_merchant || ' was your most frequent merchant, with ' || top_merchant_count || ' visits.' END,
 'Your largest single transaction was ' || s || {_d2('max_amount')} || ' at ' || max_merchant || ' (' || max_category || ').',
 'Compared to the previous period, spending was ' || trend_direction || ' by ' || {_d0('trend_pct')} || '%.') AS output,
 {_label("(month + INTERVAL 1 MONTH - INTERVAL 1 SECOND)")} AS split FROM v, cuts""")
def narrative(spark, d):
    rows = nat(spark, d)
    cells = facts.cells(rows)
    made = narrate.examples(cells, split.cutoffs(rows), facts.detect(cells))
    return made.select("entity_id", "month", "variant", "instruction", "output", "split")


# Questions


_PICK = "{0}[1 + " + _hash("'0{1}'", "entity_id", "CAST(attempt AS VARCHAR)") + " % nullif(len({0}), 0)]"
_USES = {p: ", ".join(str(i) for i, t in enumerate(questions.TEMPLATES) if p in t.params) for p in ("c", "d", "start2")}
CANDIDATES = f"""{NAT}, own AS (SELECT entity_id, list_sort(list_distinct(list(category))) AS cats, list_sort(list_distinct(list({MONTH}))) AS months FROM nat GROUP BY 1),
t0 AS (SELECT *, {_hash("'0template'", "entity_id", "CAST(attempt AS VARCHAR)")} % {len(questions.TEMPLATES)} AS number FROM own, (SELECT unnest(range(24)) AS attempt)),
t1 AS (SELECT *, {_PICK.format('cats', 'category')} AS c, {_PICK.format('months', 'month')} AS month FROM t0),
t2 AS (SELECT *, list_filter(cats, lambda x: x <> c) AS rest, list_filter(months, lambda x: x <> month) AS later FROM t1),
t3 AS (SELECT *, {_PICK.format('rest', 'category2')} AS d, {_PICK.format('later', 'month2')} AS month2 FROM t2),
candidates AS (SELECT entity_id, CAST(attempt AS INTEGER) AS attempt, CAST(number AS INTEGER) AS number, CASE WHEN number IN ({_USES['c']}) THEN c END AS c, CASE WHEN number IN ({_USES['d']}) THEN d END AS d, month, CASE WHEN number IN ({_USES['start2']}) THEN month2 END AS month2
 FROM t3 WHERE (number NOT IN ({_USES['c']}) OR c IS NOT NULL) AND (number NOT IN ({_USES['d']}) OR d IS NOT NULL) AND (number NOT IN ({_USES['start2']}) OR month2 IS NOT NULL))"""


@query("question_candidates", f"WITH {CANDIDATES} SELECT * FROM candidates")
def question_candidates(spark, d):
    return questions.candidates(nat(spark, d))


def _row_sql(t: str) -> str:
    return f"""'{{"timestamp":"' || strftime({t}."timestamp", '%Y-%m-%dT%H:%M:%S.000') || '","amount":' || CAST({t}.amount AS VARCHAR) || ',"category":"' || {t}.category || '","counterparty":"' || {t}.counterparty || '"}}'"""


_ANSWERS = {
    "spend_by_category": _d2("a.total"), "spend": _d2("m.total"), "count": "CAST(m.n AS VARCHAR)", "mean": _d2("m.mean"),
    "top_category": """'{"category":"' || t.top_category || '","total":' || CAST(t.top_category_amount AS VARCHAR) || '}'""", "largest": _row_sql("big"), "smallest": _row_sql("small"),
    "compare_categories": f"q.c || ': ' || {_d2('a.total')} || '; ' || q.d || ': ' || {_d2('b.total')}",
    "compare_periods": f"'period 1: ' || {_d2('m.total')} || ', period 2: ' || {_d2('k.total')}",
    "list": "CAST(l.n AS VARCHAR) || ' matching row(s)'", "list_category": "CAST(o.n AS VARCHAR) || ' matching row(s)'",
}
_ON = "ON {0}.entity_id = q.entity_id AND {0}.month = q.{1}"
ANSWERED = f"""{SP.replace(NAT, CANDIDATES)}, {CAT}, {TOP}, big AS ({_extreme_sql('DESC')}), small AS ({_extreme_sql('ASC')}),
m AS (SELECT entity_id, month, {MONEY.format('paid')} AS total, count(*) AS n, {MONEY.format('paid')} / count(*) AS mean FROM sp GROUP BY ALL),
o AS (SELECT entity_id, {MONTH} AS month, category, count(*) AS n FROM nat GROUP BY ALL), l AS (SELECT entity_id, month, CAST(sum(n) AS BIGINT) AS n FROM o GROUP BY ALL),
answered AS (SELECT q.*, CASE q.number {' '.join(f'WHEN {i} THEN {_ANSWERS[t.name]}' for i, t in enumerate(questions.TEMPLATES))} END AS reference_answer
 FROM candidates q {' '.join(f"LEFT JOIN {x} {_ON.format(x, 'month')}" for x in ('m', 'l', 'big', 'small'))} LEFT JOIN top t {_ON.format('t', 'month')} LEFT JOIN m k {_ON.format('k', 'month2')}
 LEFT JOIN o {_ON.format('o', 'month')} AND o.category = q.c LEFT JOIN cat a {_ON.format('a', 'month')} AND a.category = q.c LEFT JOIN cat b {_ON.format('b', 'month')} AND b.category = q.d)"""


@query("answer_format", f"WITH {ANSWERED} SELECT entity_id, attempt, reference_answer FROM answered")
def answer_format(spark, d):
    rows = facts.cells(nat(spark, d))
    return questions.answers(rows, questions.candidates(rows), facts.detect(rows)).select("entity_id", "attempt", "reference_answer")


@query("render_literal_sql", f"""WITH {SP} SELECT DISTINCT entity_id, month, 'SELECT SUM(ABS(amount)) FROM transactions WHERE entity_id=''' || entity_id || ''' AND status=''' || top || ''' AND currency=''' || own || ''' AND amount<0 AND timestamp BETWEEN ''' || strftime(month, '%Y-%m-%dT%H:%M:%S') || ''' AND ''' || strftime(month + INTERVAL 1 MONTH - INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S') || '''' AS sql
FROM (SELECT DISTINCT entity_id, {MONTH} AS month FROM nat) JOIN cu USING (entity_id), st""")
def render_literal_sql(spark, d):
    rows = nat(spark, d)
    by = facts.detect(rows)
    t = next(x for x in questions.TEMPLATES if x.name == "spend")
    sql, names = questions.adapted(t, by)
    months = facts.month_windows(rows).join(facts.majority(rows, "currency", ["entity_id"]), "entity_id")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    value = {"entity_id": F.col("entity_id"), "status": F.lit(by.status), "currency": F.col("currency"), "start": iso("month"), "end": iso("month_end")}
    return months.select("entity_id", "month", questions.rendered(sql, [value[n] for n in names]).alias("sql"))


_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S')"
_LAST = "{} + INTERVAL 1 MONTH - INTERVAL 1 SECOND"
_VALUES = {"entity_id": "entity_id", "status": "top", "currency": "own", "c": "c", "d": "d", "start": _ISO.format("month"), "end": _ISO.format(_LAST.format("month")), "start2": _ISO.format("month2"), "end2": _ISO.format(_LAST.format("month2"))}
_MARKS = {"{c}": "c", "{d}": "d", "{m}": "strftime(month, '%B %Y')", "{k}": "strftime(month2, '%B %Y')"}


def ev_seconds(spark, d) -> DataFrame:
    """Events at whole seconds: transactions of which every amount is spend."""
    return ev(spark, d).withColumn("timestamp", F.date_trunc("SECOND", "timestamp").cast("timestamp_ntz"))


_EVN = f"""{EV}, evn AS (SELECT * REPLACE (CAST(date_trunc('second', "timestamp") AS TIMESTAMP) AS "timestamp") FROM ev)"""


def _unsigned(sql: str) -> str:
    """SQL over nat as SQL over evn, with every amount as spend."""
    return re.sub(r"\bnat\b", "evn", sql.replace(NAT, _EVN)).replace("amount < 0", "amount IS NOT NULL")


def _by_template(f) -> str:
    return f"CASE number {' '.join(f'WHEN {i} THEN {f(t)}' for i, t in enumerate(questions.TEMPLATES))} END"


def _output_sql(t: questions.Template, signed: bool = True) -> str:
    sql, names = questions.adapted(t, facts.Convention(signed, "any"))
    pieces = sql.split("?")
    return " || ".join([_text(pieces[0]), *[x for n, piece in zip(names, pieces[1:]) for x in (f"'''' || replace({_VALUES[n]}, '''', '''''') || ''''", _text(piece))]])


def _said_sql(t: questions.Template) -> str:
    said = lambda v: " || ".join(_MARKS.get(x) or _text(x) for x in re.split(r"(\{[cdmk]\})", v) if x)
    return f"CASE pick {' '.join(f'WHEN {i} THEN {said(v)}' for i, v in enumerate(t.variants))} END"


def _examples_sql(answered: str, cuts: str, signed: bool) -> str:
    by = facts.Convention(signed, "any")
    return f"""WITH {answered}, {cuts}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY attempt) AS k FROM answered WHERE reference_answer IS NOT NULL) WHERE k <= {questions.PER_ENTITY}),
e AS (SELECT kept.*, own, st.top, (variant + {_hash("'0phrase'", 'entity_id', 'CAST(attempt AS VARCHAR)')} % 3) % 3 AS pick FROM kept JOIN cu USING (entity_id), st, (VALUES (0), (1), (2)) AS v(variant))
SELECT 'query_sql' AS task, entity_id, attempt, {_by_template(_said_sql)} AS instruction, {_by_template(lambda t: _output_sql(t, signed))} AS output, reference_answer, {_by_template(lambda t: _text(t.kind))} AS template_kind,
 {_label('(' + _LAST.format('coalesce(greatest(month, month2), month)') + ')')} AS split, {_by_template(lambda t: _text(questions.adapted(t, by)[0]))} AS _debug_sql_template FROM e, cuts"""


@query("nl_sql_examples", _examples_sql(ANSWERED, CUTS.format("nat"), True))
def nl_sql_examples(spark, d):
    rows = nat(spark, d)
    cells = facts.cells(rows)
    made = questions.examples(cells, split.cutoffs(rows), facts.detect(cells))
    return made.drop("_debug_sql_params").select("*")


@query("nl_sql_examples_unsigned", _examples_sql(_unsigned(ANSWERED), _unsigned(CUTS.format("nat")), False))
def nl_sql_examples_unsigned(spark, d):
    """Over events, which have no sign: the templates lose their condition on it, and extremes turn round."""
    rows = ev_seconds(spark, d)
    cells = facts.cells(rows)
    return questions.examples(cells, split.cutoffs(rows), facts.detect(cells)).drop("_debug_sql_params")


@query("facts_unsigned", _unsigned(f"WITH {FACTS} SELECT entity_id, month, total AS total_spend, n AS transaction_count, top_category, max_amount, max_merchant, trend_direction, currency FROM facts"))
def facts_unsigned(spark, d):
    return facts.facts(ev_seconds(spark, d)).select("entity_id", "month", "total_spend", "transaction_count", "top_category", "max_amount", "max_merchant", "trend_direction", "currency")


# Evaluation


@query("tokenize_vocab", f"""WITH t AS (SELECT unnest(regexp_extract_all(lower(p_name || ' ' || p_brand || ' ' || p_type), '{sanity.TOKEN}')) AS token FROM part)
SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id FROM (SELECT token, count(*) AS n FROM t GROUP BY 1) ORDER BY n DESC, token LIMIT 498""")
def tokenize_vocab(spark, d):
    texts = load(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"))
    return sanity.vocabulary(texts)


@query("token_encode", f"""WITH t AS (SELECT p_partkey, regexp_extract_all(lower(p_name || ' ' || p_brand || ' ' || p_type), '{sanity.TOKEN}') AS ts FROM part),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS id FROM (SELECT token, count(*) AS n FROM (SELECT unnest(ts) AS token FROM t) GROUP BY 1) ORDER BY n DESC, token LIMIT 498),
u AS (SELECT p_partkey, unnest(ts[1:12]) AS token, unnest(range(1, 1 + len(ts[1:12]))) AS k FROM t),
e AS (SELECT p_partkey, k, coalesce(id, 1) AS id FROM u LEFT JOIN v USING (token)),
g AS (SELECT p_partkey, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY k) AS s, count(*) AS n FROM e GROUP BY 1) SELECT p_partkey, s || repeat(' 0', 12 - n) AS ids FROM g""")
def token_encode(spark, d):
    texts = load(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("text"))
    return sanity.encoded(texts, sanity.vocabulary(texts), 12).select("p_partkey", F.array_join("ids", " ").alias("ids"))


_PREDICTED = "CASE WHEN amount > 50 THEN category ELSE 'view' END"


@query("baselines", f"""WITH {EVS}, t AS (SELECT category AS output, count(*) AS n FROM evs WHERE split = 'train' GROUP BY 1), m AS (SELECT output AS majority FROM t ORDER BY n DESC, output LIMIT 1)
SELECT count(DISTINCT category) AS num_classes, CAST(1 AS DOUBLE) / count(DISTINCT category) AS random_baseline, max(majority) AS majority, avg(CASE WHEN category = majority THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'val') AS majority_baseline FROM evs, m WHERE split IN ('train', 'val')""")
def baselines(spark, d):
    return evaluate.baselines(evs(spark, d).select("split", F.col("category").alias("output")))


def _predictions(spark, d) -> DataFrame:
    rows = evs(spark, d)
    return rows.select("entity_id", F.col("category").alias("label"), F.when(F.col("amount") > 50, F.col("category")).otherwise("view").alias("predicted"), "split", "_row_id")


@query("per_class_accuracy", f"WITH {EV} SELECT category AS label, count(*) AS n, round(avg(CASE WHEN category = {_PREDICTED} THEN 1.0 ELSE 0.0 END), 3) AS accuracy FROM ev GROUP BY 1")
def per_class_accuracy(spark, d):
    return evaluate.per_class_accuracy(_predictions(spark, d))


@query("verdict", f"""WITH {EV}, a AS (SELECT channel, avg(CASE WHEN category = {_PREDICTED} THEN 1.0 ELSE 0.0 END) AS final, avg(CASE WHEN category = 'view' THEN 1.0 ELSE 0.0 END) AS base FROM ev GROUP BY 1)
SELECT channel, CASE WHEN final - base > 0.15 THEN 'good' WHEN final - base > 0.03 THEN 'weak' ELSE 'none' END AS verdict FROM a""")
def verdict(spark, d):
    rows = ev(spark, d).withColumn("predicted", F.when(F.col("amount") > 50, F.col("category")).otherwise("view"))
    right = lambda c, x: F.avg((F.col(c) == x).cast("int"))
    both = rows.groupBy("channel").agg(right("category", F.col("predicted")).alias("final"), right("category", F.lit("view")).alias("base"))
    return both.select("channel", evaluate.verdict(F.col("final"), F.col("base")).alias("verdict"))


_RUNS = f"""{EV}, runs AS (SELECT category AS dataset, channel AS model_config, _row_id % 5 AS seed, avg(CAST(amount AS DECIMAL(20,4))) AS margin FROM ev GROUP BY ALL),
grid AS (SELECT dataset, model_config, round(avg(margin), 4) AS mean, round(coalesce(stddev_samp(margin), 0), 4) AS std, count(margin) AS n_seeds FROM runs GROUP BY ALL)"""


def _grid(spark, d) -> DataFrame:
    runs = ev(spark, d).groupBy(F.col("category").alias("dataset"), F.col("channel").alias("model_config"), (F.col("_row_id") % 5).alias("seed")).agg(F.avg(F.col("amount").cast("decimal(20,4)")).cast("double").alias("margin"))
    found = evaluate.grid_summary(runs, "margin")
    return found.select("dataset", "model_config", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "n_seeds")


@query("grid_summary", f"WITH {_RUNS} SELECT * FROM grid")
def grid_summary(spark, d):
    return _grid(spark, d)


@query("grid_pivot", f"WITH {_RUNS} SELECT dataset, max(mean) FILTER (WHERE model_config = 'online') AS online, max(mean) FILTER (WHERE model_config = 'pos') AS pos FROM grid GROUP BY 1")
def grid_pivot(spark, d):
    return evaluate.grid_pivot(_grid(spark, d), ["online", "pos"])


def _copies_sql(rows: str, scarce: str, need: str) -> str:
    return f"""{rows}, z AS (SELECT count(*) AS n, count(*) FILTER (WHERE {scarce}) AS s FROM r), w AS (SELECT r.*, row_number() OVER (ORDER BY _row_id % 1024, _row_id) - 1 AS k FROM r WHERE {scarce}),
x AS (SELECT _row_id, k, greatest(0, {need}) AS need, s FROM w, z) SELECT _row_id, CAST(0 AS INTEGER) AS copy FROM r UNION ALL SELECT _row_id, CAST(unnest(range(1, 1 + CAST(greatest(0, (need - k + s - 1) // s) AS BIGINT))) AS INTEGER) AS copy FROM x"""


_OVERSAMPLED = f"WITH {EV}, " + _copies_sql("r AS (SELECT _row_id, CASE WHEN category = 'error' AND _row_id % 11 = 0 THEN 'scarce' ELSE 'other' END AS kind FROM ev)", "kind = 'scarce'", "CAST(floor((n - s) * CAST(0.15 AS DOUBLE) / CAST(0.85 AS DOUBLE)) AS BIGINT) - s")


@query("oversample_minority", _OVERSAMPLED)
def oversample_minority(spark, d):
    """All events, of which some errors count as the scarce class."""
    rows = ev(spark, d).select("_row_id", F.when((F.col("category") == "error") & (F.col("_row_id") % 11 == 0), "scarce").otherwise("other").alias("kind"))
    return evaluate.oversample_minority(rows, "kind", "scarce").select("_row_id", "copy")


@query("oversample_minority_all", f"WITH {EV}, " + _copies_sql("r AS (SELECT _row_id, CASE WHEN category = 'purchase' AND _row_id % 13 = 0 THEN 'scarce' ELSE 'other' END AS kind FROM ev)", "kind = 'scarce'", "CAST(floor((n - s) * CAST(0.15 AS DOUBLE) / CAST(0.85 AS DOUBLE)) AS BIGINT) - s"))
def oversample_minority_all(spark, d):
    """All events, of which some purchases count as the scarce class."""
    rows = ev(spark, d).select("_row_id", F.when((F.col("category") == "purchase") & (F.col("_row_id") % 13 == 0), "scarce").otherwise("other").alias("kind"))
    return evaluate.oversample_minority(rows, "kind", "scarce").select("_row_id", "copy")


@query("oversample_orders", f"WITH {OD}, " + _copies_sql("r AS (SELECT _row_id, CASE WHEN _row_id % 41 = 0 THEN 'scarce' ELSE 'other' END AS kind FROM od)", "kind = 'scarce'", "CAST(floor((n - s) * CAST(0.15 AS DOUBLE) / CAST(0.85 AS DOUBLE)) AS BIGINT) - s"))
def oversample_orders(spark, d):
    """All orders, of which one in 41 counts as the scarce class."""
    rows = od(spark, d).select("_row_id", F.when(F.col("_row_id") % 41 == 0, "scarce").otherwise("other").alias("kind"))
    return evaluate.oversample_minority(rows, "kind", "scarce").select("_row_id", "copy")


@query("balance_kinds", f"WITH {EV}, " + _copies_sql("r AS (SELECT _row_id, CASE WHEN _row_id % 9 = 0 THEN 'comparison' ELSE 'aggregation' END AS template_kind FROM ev)", "template_kind = 'comparison'", "CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) - s"))
def balance_kinds(spark, d):
    rows = ev(spark, d).select("_row_id", F.when(F.col("_row_id") % 9 == 0, "comparison").otherwise("aggregation").alias("template_kind"))
    return evaluate.balance_kind(rows, "comparison").select("_row_id", "copy")


@query("class_weights", f"WITH {EV}, c AS (SELECT category AS output, count(*) AS n FROM ev GROUP BY 1) SELECT output, n, round((SELECT sum(n) FROM c) / CAST((SELECT count(*) FROM c) * n AS DOUBLE), 6) AS weight FROM c")
def class_weights(spark, d):
    return evaluate.class_weights(ev(spark, d).select(F.col("category").alias("output"))).select("output", "n", F.round("weight", 6).alias("weight"))


#: Ways in which the pairs below differ from their reference.
_CHANGES = ["spelling", "condition", "entity", "table", "order"]


def _sql_pairs(rows: DataFrame | facts.Cells, cuts: DataFrame, by: facts.Convention) -> DataFrame:
    """Each question's SQL and a changed copy: spelt otherwise, with a condition more that holds anyway, for an entity that
    doesn't exist, of a table that doesn't exist, or (lists only) in descending order."""
    made = questions.examples(rows, cuts, by, variants=1)
    change = (parsing.portable_hash(F.lit("change"), F.col("entity_id"), F.col("attempt")) % len(_CHANGES)).cast("int")
    text = F.col("output")
    changed = [
        F.concat(F.replace(text, F.lit("SELECT"), F.lit("select")), F.lit(" ;")), F.replace(text, F.lit("entity_id="), F.lit("entity_id IS NOT NULL AND entity_id=")),
        F.replace(text, F.lit("entity_id='"), F.lit("entity_id='no")), F.replace(text, F.lit("FROM transactions"), F.lit("FROM transaction")), F.replace(text, F.lit("ORDER BY timestamp"), F.lit("ORDER BY timestamp DESC")),
    ]
    generated = F.coalesce(*[F.when(change == i, c) for i, c in enumerate(changed)])
    return made.select("entity_id", "attempt", "template_kind", F.get(F.array(*map(F.lit, _CHANGES)), change).alias("change"), generated.alias("generated"), text.alias("reference"))


_PAIRS = re.sub(r"\bnat\b", "od", f"""WITH {ANSWERED}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY attempt) AS k FROM answered WHERE reference_answer IS NOT NULL) WHERE k <= {questions.PER_ENTITY}),
g AS (SELECT *, {_by_template(lambda t: _text(t.kind))} AS template_kind, {_by_template(lambda t: _text(t.name))} AS name, {_hash("'change'", 'entity_id', 'CAST(attempt AS VARCHAR)')} % {len(_CHANGES)} AS change FROM kept),
w AS (SELECT entity_id, {MONTH} AS month, category, "timestamp" AS ts FROM nat), w1 AS (SELECT entity_id, month, count(DISTINCT ts) AS n FROM w GROUP BY ALL), w2 AS (SELECT entity_id, month, category AS c, count(DISTINCT ts) AS n FROM w GROUP BY ALL),
h AS (SELECT g.*, change <> 3 AS executable, CASE WHEN change IN (2, 3) THEN false WHEN change = 4 AND name = 'list' THEN w1.n = 1 WHEN change = 4 AND name = 'list_category' THEN w2.n = 1 ELSE true END AS correct
 FROM g LEFT JOIN w1 ON g.entity_id = w1.entity_id AND g.month = w1.month LEFT JOIN w2 ON g.entity_id = w2.entity_id AND g.month = w2.month AND g.c = w2.c)
SELECT template_kind, CASE change {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_CHANGES))} END AS change, count(*) AS n, avg(CASE WHEN executable THEN 1.0 ELSE 0.0 END) AS executable_rate, avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS correct_rate FROM h GROUP BY ALL""").replace(NAT, OD).replace(_orders_sql("od", "c_nationkey"), OD)


@query("sql_pair_rates", _PAIRS)
def sql_pair_rates(spark, d):
    """Rates by template and change over all questions about all customers."""
    rows = od(spark, d)
    questions.register(kept(rows.select(*QUERY_COLUMNS), "transactions"))  # each kind of question reads them
    cells = facts.cells(rows)
    pairs = kept(_sql_pairs(cells, split.cutoffs(rows), facts.detect(cells)), "changed")
    found = sqlpairs.rates(spark, pairs, keep=["template_kind", "change"])
    return found.summary("template_kind", "change")


@query("context_join", f"""WITH {EVS}, s AS (SELECT *, {_ser()} AS text FROM evs), c AS (SELECT _row_id, list(text) OVER ({_W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS x FROM s)
SELECT _row_id, array_to_string(list_concat([x[len(x)]], x[1:len(x) - 1]), ' ') AS text FROM c""")
def context_join(spark, d):
    return shape.fraud_examples(evs(spark, d)).select("_row_id", evaluate.latest_first(F.col("context")).alias("text"))


_FS = f"""concat_ws(', ', 'total: ' || {_d2('total')}, 'count: ' || n, 'top category: ' || top_category || ' (' || {_d2('top_category_amount')} || ')', 'top merchant: ' || top_merchant, 'largest: ' || {_d2('max_amount')}, 'trend: ' || trend_direction || ' ' || {_d0('trend_pct')} || '%')"""


@query("facts_string", f"WITH {FACTS} SELECT entity_id, month, {_FS} AS text FROM facts")
def facts_string(spark, d):
    return _facts(spark, d).select("entity_id", "month", evaluate.facts_string(F.col).alias("text"))


@query("fact_inclusion", f"""WITH {FACTS}, t AS (SELECT *, 'I spent ' || {_d2('total')} || ' at ' || upper(top_merchant) || ', going down.' AS text FROM facts)
SELECT entity_id, month, (CASE WHEN contains(text, {_d2('total')}) OR contains(text, {_d0('total')}) THEN 1 ELSE 0 END + CASE WHEN contains(text, CAST(n AS VARCHAR)) THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), lower(top_category)) THEN 1 ELSE 0 END
 + CASE WHEN contains(lower(text), lower(top_merchant)) THEN 1 ELSE 0 END + CASE WHEN trend_direction = 'down' THEN 1 ELSE 0 END) / CAST(CASE WHEN trend_direction IS NULL THEN 4 ELSE 5 END AS DOUBLE) AS score FROM t""")
def fact_inclusion(spark, d):
    rows = _facts(spark, d)
    text = F.concat(F.lit("I spent "), shape.decimals(F.col("total_spend")), F.lit(" at "), F.upper("top_merchant"), F.lit(", going down."))
    return rows.select("entity_id", "month", evaluate.fact_inclusion(text, F.col).alias("score"))


_PERPLEXITY = f"WITH {EV} SELECT _row_id, CASE WHEN amount / 10 < 20 THEN round(exp(amount / 10), 3) ELSE CAST('inf' AS DOUBLE) END AS perplexity FROM ev"


@query("perplexity", _PERPLEXITY)
def perplexity(spark, d):
    return ev(spark, d).select("_row_id", evaluate.rounded_perplexity(F.col("amount") / 10, 3).alias("perplexity"))


@query("perplexity_all", f"WITH {EV} SELECT _row_id, CASE WHEN amount / 5 < 20 THEN round(exp(amount / 5), 2) ELSE CAST('inf' AS DOUBLE) END AS perplexity FROM ev")
def perplexity_all(spark, d):
    """Of losses twice as large."""
    return ev(spark, d).select("_row_id", evaluate.rounded_perplexity(F.col("amount") / 5, 2).alias("perplexity"))


@query("perplexity_orders", """WITH l AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(20,4))) AS DOUBLE) / count(*) / 2 AS loss FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN loss < 20 THEN round(exp(loss), 3) ELSE CAST('inf' AS DOUBLE) END AS perplexity FROM l""")
def perplexity_orders(spark, d):
    """Of mean losses: half the quantities of each order's lines."""
    loss = F.sum(parsing.money(F.col("l_quantity"))).cast("double") / F.count("*") / 2
    lines = load(spark, d, "lineitem").groupBy("l_orderkey").agg(loss.alias("loss"))
    return lines.select("l_orderkey", evaluate.rounded_perplexity(F.col("loss"), 3).alias("perplexity"))


@query("bounded_sample", f"""WITH {EVS}, s AS (SELECT channel AS dataset, split, _row_id, {_ser(False)} AS text, category AS output FROM evs WHERE split <> 'test'),
k AS (SELECT *, row_number() OVER (PARTITION BY dataset, split ORDER BY CAST('0x' || substr(md5(concat_ws('|', '0', text, output)), 1, 8) AS BIGINT), text, output) AS k FROM s)
SELECT dataset, split, text, output FROM k WHERE k <= CASE split WHEN 'train' THEN {sanity.MAX_TRAIN} ELSE {sanity.MAX_VAL} END""")
def bounded_sample(spark, d):
    rows = evs(spark, d)
    examples = rows.select(F.col("channel").alias("dataset"), "split", shape.serialized(rows.columns, {"category", "split"}).alias("text"), F.col("category").alias("output"))
    return sanity.sampled(examples, by=["dataset"]).select("dataset", "split", "text", "output")


@query("union_sources", f"WITH {EV}, {OD} SELECT 'events' AS source, count(*) AS n, {MONEY.format('amount')} AS total FROM ev UNION ALL SELECT 'orders', count(*), {MONEY.format('amount')} FROM od")
def union_sources(spark, d):
    both = ev(spark, d).withColumn("source", F.lit("events")).unionByName(od(spark, d).withColumn("source", F.lit("orders")))
    return both.groupBy("source").agg(F.count("*").alias("n"), F.sum(parsing.money(F.col("amount"))).cast("double").alias("total"))


@query("lineitem_spend_rollup", f"""WITH l AS (SELECT CAST(o_custkey AS VARCHAR) AS entity_id, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, p_type AS category, s_name AS counterparty, l_extendedprice AS paid
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
SELECT entity_id, month, category, {MONEY.format('paid')} AS total, count(*) AS n, count(DISTINCT counterparty) AS merchants FROM l GROUP BY ALL""")
def lineitem_spend_rollup(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    rows = (
        lines.join(load(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, d, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(load(spark, d, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    )
    month = F.date_trunc("MONTH", "l_shipdate").cast("timestamp_ntz").alias("month")
    return rows.groupBy(F.col("o_custkey").cast("string").alias("entity_id"), month, F.col("p_type").alias("category")).agg(
        F.sum(parsing.money(F.col("l_extendedprice"))).cast("double").alias("total"), F.count("*").alias("n"), F.count_distinct("s_name").alias("merchants")
    )
