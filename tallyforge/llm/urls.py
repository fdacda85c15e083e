"""URL filters: host rules first, then a weighted vocabulary counted by Aho-Corasick.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's; of the rules
that fit, the longest host plus path wins, of equally long ones the longer host, then ``block``. A url without a rule is
judged by its terms: every term of the vocabulary that stands in the url (A-Z lower-cased) with no letter or digit right
before or behind it counts once, however often it comes. Strict terms weigh as much as the limit, so that one rejects;
soft terms weigh less, so that it takes several different ones.

Defined cases: a null url, and one without ``://``, has an empty host and path, no rule and (if null) no term, so a null
url is allowed. Userinfo and ports are part of the host. Long urls are scanned whole. Repeated rows each keep their row.
Columns of the input whose names clash with the added ones are replaced by these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import lower_ascii, table

#: A url is rejected from this weight on. Strict terms weigh LIMIT, soft ones 1.
LIMIT = 3
#: Rules that are held as literals; more go through a join.
MOST_LITERAL_RULES = 1_000

#: The rules that the contract gives.
CONTRACT_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Terms that reject alone, and terms that reject from LIMIT different ones on.
STRICT = ["bdsm", "camgirl", "camgirls", "hentai", "nudes", "porn", "porno", "pornstar", "sexcam", "sexcams", "sexshop", "xxx", "warez", "keygen", "escorts", "milf", "onlinecasino", "viagra"]
SOFT = [
    "adult", "amateur", "bet", "bets", "betting", "bonus", "cam", "cams", "casino", "crack", "dating", "download", "erotic", "escort", "free", "gambling", "girl", "girls", "hot", "jackpot", "live",
    "loan", "loans", "lottery", "mature", "naked", "nude", "nudity", "payday", "pharmacy", "pills", "poker", "serial", "sex", "sexy", "slot", "slots", "spin", "teen", "teens", "torrent", "tube", "webcam", "win",
]


@dataclass(frozen=True)
class Vocabulary:
    """Terms with their weights; letters in lower case. A bounded list of the caller's, sent with the tasks."""

    weights: dict[str, int]
    limit: int = LIMIT

    def __post_init__(self):
        if bad := [t for t in self.weights if not t or t != t.lower()]:
            raise ValueError(f"terms must be lower-case and not empty: {bad[:3]}")


def vocabulary(strict: list[str] = STRICT, soft: list[str] = SOFT, limit: int = LIMIT) -> Vocabulary:
    return Vocabulary(dict.fromkeys(soft, 1) | dict.fromkeys(strict, limit), limit)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """A host and the domains above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _best(fitting: Column) -> Column:
    """Of structs (host, path, verdict) the one that wins; null if there is none."""
    rank = F.transform(fitting, lambda r: F.struct((F.length(r["host"]) + F.length(r["path"])).alias("all"), F.length(r["host"]).alias("own"), r["verdict"].alias("verdict"), r["path"].alias("path"), r["host"].alias("host")))
    return F.array_max(rank)  # 'block' sorts behind 'allow'


def ruled_by_list(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rows`` (with host and path) and a struct ``_rule``. The rules are one literal map by host; no shuffle."""
    by_host: dict[str, list] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append(F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict")))
    if not by_host:
        return rows.withColumn("_rule", _best(F.array().cast("array<struct<host:string,path:string,verdict:string>>")))
    held = F.create_map(*[x for host, own in by_host.items() for x in (F.lit(host), F.array(*own))])
    near = F.flatten(F.filter(F.transform(suffixes(F.col("host")), lambda s: F.try_element_at(held, s)), lambda x: x.isNotNull()))
    return rows.withColumn("_rule", _best(F.filter(near, lambda r: F.startswith(F.col("path"), r["path"]))))


def ruled_by_table(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """As ``ruled_by_list`` for a table (host, path, verdict) of any size. Distinct pairs of host and path meet the rules by
    each domain above the host, so rows of one host are merged before the join; a domain of many rules and urls is split
    by adaptive execution."""
    pairs = rows.select("host", "path").distinct()
    met = pairs.select("host", "path", F.explode(suffixes(F.col("host"))).alias("_on")).join(rules.select(F.col("host").alias("_on"), F.struct("host", "path", "verdict").alias("_r")), "_on")
    met = met.filter(F.startswith(F.col("path"), F.col("_r.path")))
    best = met.groupBy("host", "path").agg(F.max(_best(F.array("_r"))).alias("_rule"))
    return rows.join(best, ["host", "path"], "left")


def hits(url: Column, words: Vocabulary) -> Column:
    """(weight, terms): the summed weight of a url's different terms, and the terms in order, comma-joined. One automaton
    a worker; its time doesn't depend on the number of terms."""
    weights = dict(words.weights)

    @F.arrow_udf("struct<weight: int, terms: string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:

        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        joins = lambda text, at: 0 <= at < len(text) and text[at].isalnum()

        def terms(text: str) -> list[str]:
            ends = automaton.iter(text) if weights else ()
            return sorted({t for end, t in ends if not joins(text, end - len(t)) and not joins(text, end + 1)})

        for batch in batches:
            own = [terms(x or "") for x in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([sum(weights[t] for t in x) for x in own], pa.int32()), pa.array([",".join(x) for x in own], pa.string())], ["weight", "terms"])

    return found(lower_ascii(url))


def judged(df: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] | DataFrame = (), words: Vocabulary | None = None) -> DataFrame:
    """``df`` with host, path, rule, verdict (``allow`` or ``block``), weight and terms."""
    words = words or vocabulary()
    own = ["host", "path", "rule", "verdict", "weight", "terms", "_rule", "_hits"]
    rows = df.withColumn("_url", F.col(f"`{url}`")).drop(*[c for c in own if c in df.columns])
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    if isinstance(rules, DataFrame):
        rows = ruled_by_table(rows, rules)
    elif len(rules) > MOST_LITERAL_RULES:
        rows = ruled_by_table(rows, df.sparkSession.createDataFrame(rules, "host string, path string, verdict string"))
    else:
        rows = ruled_by_list(rows, rules)
    rows = rows.withColumn("_hits", hits(F.col("_url"), words))
    weight = F.col("_hits.weight")
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(weight >= words.limit, "block").otherwise("allow"))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("_url", "_rule", "_hits", "host", "path")]
    return rows.select(*kept, "host", "path", F.concat(F.col("_rule.host"), F.col("_rule.path")).alias("rule"), verdict.alias("verdict"), weight.alias("weight"), F.col("_hits.terms").alias("terms"))


def op13(spark, sf_dir):
    """All pages by the contract's rules and the vocabulary."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, "url", CONTRACT_RULES).select("page_id", "host", "path", "rule", "verdict", "weight")


_LOWER = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WEIGHT = " + ".join(f"CASE WHEN regexp_matches(low, '(?:^|[^\\p{{L}}\\p{{N}}]){t}(?:[^\\p{{L}}\\p{{N}}]|$)') THEN {w} ELSE 0 END" for t, w in vocabulary().weights.items())
_RULES = 1_000

#: The rules that the contract gives.
CONTRACT_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Terms that reject alone, and terms that reject from LIMIT different ones on.
STRICT = ["bdsm", "camgirl", "camgirls", "hentai", "nudes", "porn", "porno", "pornstar", "sexcam", "sexcams", "sexshop", "xxx", "warez", "keygen", "escorts", "milf", "onlinecasino", "viagra"]
SOFT = [
    "adult", "amateur", "bet", "bets", "betting", "bonus", "cam", "cams", "casino", "crack", "dating", "download", "erotic", "escort", "free", "gambling", "girl", "girls", "hot", "jackpot", "live",
    "loan", "loans", "lottery", "mature", "naked", "nude", "nudity", "payday", "pharmacy", "pills", "poker", "serial", "sex", "sexy", "slot", "slots", "spin", "teen", "teens", "torrent", "tube", "webcam", "win",
]


@dataclass(frozen=True)
class Vocabulary:
    """Terms with their weights; letters in lower case. A bounded list of the caller's, sent with the tasks."""

    weights: dict[str, int]
    limit: int = LIMIT

    def __post_init__(self):
        if bad := [t for t in self.weights if not t or t != t.lower()]:
            raise ValueError(f"terms must be lower-case and not empty: {bad[:3]}")


def vocabulary(strict: list[str] = STRICT, soft: list[str] = SOFT, limit: int = LIMIT) -> Vocabulary:
    return Vocabulary(dict.fromkeys(soft, 1) | dict.fromkeys(strict, limit), limit)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """A host and the domains above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _best(fitting: Column) -> Column:
    """Of structs (host, path, verdict) the one that wins; null if there is none."""
    rank = F.transform(fitting, lambda r: F.struct((F.length(r["host"]) + F.length(r["path"])).alias("all"), F.length(r["host"]).alias("own"), r["verdict"].alias("verdict"), r["path"].alias("path"), r["host"].alias("host")))
    return F.array_max(rank)  # 'block' sorts behind 'allow'


def ruled_by_list(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rows`` (with host and path) and a struct ``_rule``. The rules are one literal map by host; no shuffle."""
    by_host: dict[str, list] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append(F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict")))
    if not by_host:
        return rows.withColumn("_rule", _best(F.array().cast("array<struct<host:string,path:string,verdict:string>>")))
    held = F.create_map(*[x for host, own in by_host.items() for x in (F.lit(host), F.array(*own))])
    near = F.flatten(F.filter(F.transform(suffixes(F.col("host")), lambda s: F.try_element_at(held, s)), lambda x: x.isNotNull()))
    return rows.withColumn("_rule", _best(F.filter(near, lambda r: F.startswith(F.col("path"), r["path"]))))


def ruled_by_table(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """As ``ruled_by_list`` for a table (host, path, verdict) of any size. Distinct pairs of host and path meet the rules by
    each domain above the host, so rows of one host are merged before the join; a domain of many rules and urls is split
    by adaptive execution."""
    pairs = rows.select("host", "path").distinct()
    met = pairs.select("host", "path", F.explode(suffixes(F.col("host"))).alias("_on")).join(rules.select(F.col("host").alias("_on"), F.struct("host", "path", "verdict").alias("_r")), "_on")
    met = met.filter(F.startswith(F.col("path"), F.col("_r.path")))
    best = met.groupBy("host", "path").agg(F.max(_best(F.array("_r"))).alias("_rule"))
    return rows.join(best, ["host", "path"], "left")


def hits(url: Column, words: Vocabulary) -> Column:
    """(weight, terms): the summed weight of a url's different terms, and the terms in order, comma-joined. One automaton
    a worker; its time doesn't depend on the number of terms."""
    weights = dict(words.weights)

    @F.arrow_udf("struct<weight: int, terms: string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:

        automaton = ahocorasick.Automaton()
        for term in weights:
            automaton.add_word(term, term)
        automaton.make_automaton()
        joins = lambda text, at: 0 <= at < len(text) and text[at].isalnum()

        def terms(text: str) -> list[str]:
            ends = automaton.iter(text) if weights else ()
            return sorted({t for end, t in ends if not joins(text, end - len(t)) and not joins(text, end + 1)})

        for batch in batches:
            own = [terms(x or "") for x in batch.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([sum(weights[t] for t in x) for x in own], pa.int32()), pa.array([",".join(x) for x in own], pa.string())], ["weight", "terms"])

    return found(lower_ascii(url))


def judged(df: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] | DataFrame = (), words: Vocabulary | None = None) -> DataFrame:
    """``df`` with host, path, rule, verdict (``allow`` or ``block``), weight and terms."""
    words = words or vocabulary()
    own = ["host", "path", "rule", "verdict", "weight", "terms", "_rule", "_hits"]
    rows = df.withColumn("_url", F.col(f"`{url}`")).drop(*[c for c in own if c in df.columns])
    rows = rows.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))})
    if isinstance(rules, DataFrame):
        rows = ruled_by_table(rows, rules)
    elif len(rules) > MOST_LITERAL_RULES:
        rows = ruled_by_table(rows, df.sparkSession.createDataFrame(rules, "host string, path string, verdict string"))
    else:
        rows = ruled_by_list(rows, rules)
    rows = rows.withColumn("_hits", hits(F.col("_url"), words))
    weight = F.col("_hits.weight")
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(weight >= words.limit, "block").otherwise("allow"))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("_url", "_rule", "_hits", "host", "path")]
    return rows.select(*kept, "host", "path", F.concat(F.col("_rule.host"), F.col("_rule.path")).alias("rule"), verdict.alias("verdict"), weight.alias("weight"), F.col("_hits.terms").alias("terms"))


def op13(spark, sf_dir):
    """All pages by the contract's rules and the vocabulary."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, "url", CONTRACT_RULES).select("page_id", "host", "path", "rule", "verdict", "weight")


_LOWER = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = ", ".join(f"('{t}', {w})" for t, w in vocabulary().weights.items())
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in CONTRACT_RULES)
ORACLE_SQL = f"""WITH u AS (SELECT page_id, {_LOWER} AS low, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT * FROM (VALUES {_RULES}) AS t(rhost, rpath, rverdict)),
w AS (SELECT page_id, CAST({_WEIGHT} AS INTEGER) AS weight FROM u),
b AS (SELECT page_id, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) + length(rpath) DESC, length(rhost) DESC, rverdict DESC) AS k
 FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT u.page_id, host, path, rule, coalesce(rverdict, CASE WHEN weight >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, weight
FROM u JOIN w USING (page_id) LEFT JOIN (SELECT * FROM b WHERE k = 1) b USING (page_id)"""
