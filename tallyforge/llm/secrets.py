"""Secret scans: rules with fixed patterns, and character Markov models that tell random strings from identifiers.

Everything is built-in functions within a document's row. Positions come from the lengths of what lies between matches.
The models are counts of character pairs over ``SYMBOLS``: of the values that the rules find (random strings) and of other
long tokens that read as words (ordinary identifiers), labelled so in a sample of at most ``MAX_DOCS`` documents, chosen
by hash. Tokens that neither label fits, among them secrets that no rule finds, teach neither model. Both are smoothed
alike: a pair has the chance of its step between classes (lower, upper, digit, sign), times that of the character within
its class, which for letters depends on the letter before, whatever their case; both back off where little was seen.
Tokens without small letters are read as if in small letters. So a name isn't taken for random because the sample's names
are joined by other signs or written in another case. A token of ``MIN_TOKEN`` or more characters whose log-likelihood
ratio is ``MIN_RATIO`` or more, and ``MIN_MEAN`` or more a character, is a span of kind ``markov``, unless it overlaps a
rule's span. Random strings of letters of one case alone are too near to names of an unknown language to be told apart.

Defined cases: a null text is empty; an empty text has no spans and the digest of the empty string; repeated rows get
equal results; an empty table gives an empty result, and without a sample both models are uniform and find nothing. Of the input only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import table

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind, pattern, group that must be long enough, its least length. A run that is too short holds no longer one, so
#: the lengths of these two can be part of the pattern.
RULES = [("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32)]
MIN_TOKEN = 16
MIN_RATIO = 8.0
MAX_DOCS = 10_000
TRAINING_TOKEN = 8
#: An ordinary identifier: words of one case or capitalized, or short numbers, joined by signs or humps.
PIECE = "(?:[A-Z]?[a-z]{2,15}|[A-Z]{2,15}|[0-9]{1,4})"
ORDINARY = f"^[+/_.=-]*{PIECE}(?:(?:[+/_.=-]+|(?<=[a-z])(?=[A-Z]|[0-9]+(?![A-Za-z0-9]))){PIECE})*[+/_.=-]*$"
MIN_MEAN = 0.46
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_.=-"]
BLOCK = 64  # matches whose places are summed up together
#: Pairs at which what was seen counts as much as what is backed off to, and the share that always is uniform.
BACK_OFF, UNIFORM = 200.0, (0.1, 0.5)  # the share for ordinary and for random strings, whose sample has few alphabets


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _located(text: DataFrame, name: str, pattern: str, group: int = 0) -> DataFrame:
    """``text`` (with a column t) and an array of structs (start, kind, end, value), one for each match."""
    kind = KINDS.index(name)
    found = text.select("*", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias("_m"))
    value = F.regexp_extract_all("t", F.lit(pattern), F.lit(group)) if group else F.col("_m")
    parted = found.select(
        "*",
        F.when(F.size("_m") > 0, value).alias("_v"),
        F.when(F.size("_m") > 0, F.transform(F.split("t", pattern, -1), F.char_length)).alias("_gap"),
    )
    # Within a block each place is the last one plus a gap; blocks start where the one before ended. An array that grows
    # is copied at each step, so one over all matches would cost their square.
    block = f"""aggregate(sequence(b * {BLOCK} + 1, least(size(_m), (b + 1) * {BLOCK})),
          named_struct('at', 0, 'out', cast(array() AS array<struct<start: int, kind: int, end: int, value: string>>)),
          (a, i) -> named_struct(
            'at', a.at + _gap[i - 1] + char_length(_m[i - 1]),
            'out', concat(a.out, array(named_struct(
              'start', a.at + _gap[i - 1], 'kind', {kind}, 'end', a.at + _gap[i - 1] + char_length(_m[i - 1]), 'value', _v[i - 1])))))"""
    spans = F.expr(f"""
        flatten(aggregate(transform(sequence(0, (size(_m) - 1) div {BLOCK}), b -> {block}),
          named_struct('at', 0, 'out', cast(array() AS array<array<struct<start: int, kind: int, end: int, value: string>>>)),
          (a, x) -> named_struct(
            'at', a.at + x.at,
            'out', concat(a.out, array(transform(x.out, s -> named_struct('start', s.start + a.at, 'kind', s.kind, 'end', s.end + a.at, 'value', s.value))))),
          a -> a.out))""")
    nothing = F.expr("cast(array() AS array<struct<start: int, kind: int, end: int, value: string>>)")
    return parted.select(*text.columns, F.when(F.size("_m") > 0, spans).otherwise(nothing).alias(name))


def _base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, t and the spans of each rule."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    for name, pattern, group, least in RULES:
        rows = _located(rows, name, pattern, group)
        rows = rows.withColumn(name, F.filter(name, lambda s: F.char_length(s["value"]) >= least))  # noqa: B023
    return rows


def _free(rows: DataFrame, tokens: str) -> DataFrame:
    """Without the tokens that overlap a rule's span. A token is a longest run of its characters, and a rule's match begins
    and ends with such: so a token is overlapped if the place that follows it in order, among all tokens' starts and all
    matches' first and last places, is a match's and lies within it."""
    rules = F.concat(*[r[0] for r in RULES])
    place = lambda p, kind, end, value: F.struct(p.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"))
    ends = F.flatten(F.transform(rules, lambda b: F.array(place(b["start"], 9, b["start"], F.lit("")), place(b["end"] - 1, 9, b["end"], F.lit("")))))
    own = KINDS.index("markov")
    ordered = rows.withColumn("_all", F.sort_array(F.concat(tokens, ends)))
    after = lambda i: F.get(F.col("_all"), i + 1)
    met = lambda t, i: F.coalesce((after(i)["kind"] == 9) & (after(i)["start"] < t["end"]), F.lit(False))
    return ordered.withColumn(tokens, F.filter("_all", lambda t, i: (t["kind"] == own) & ~met(t, i))).drop("_all")


def _models(seen: dict[tuple[int, str], int]) -> list[float]:
    """Log-likelihood ratios for each pair of SYMBOLS from the counts (random, pair)."""
    kind = {c: k for k, cs in enumerate(CLASSES) for c in cs}
    share = [len(cs) / len(SYMBOLS) for cs in CLASSES]

    def chances(model: int) -> dict[str, float]:
        uniform = UNIFORM[model]
        steps = [[0.0] * 4 for _ in range(4)]
        letters, pairs, signs = dict.fromkeys(CLASSES[0], 0), {}, dict.fromkeys(CLASSES[3], 0)
        for (m, pair), n in seen.items():
            if m != model or pair[0] not in kind or pair[1] not in kind:
                continue
            a, b = kind[pair[0]], kind[pair[1]]
            steps[a][b] += n
            if b < 2:
                letters[pair[1].lower()] += n
                if a < 2:
                    pairs[pair.lower()] = pairs.get(pair.lower(), 0) + n
            if b == 3:
                signs[pair[1]] += n
        step = [[(1 - uniform) * (row[b] + BACK_OFF * share[b]) / (sum(row) + BACK_OFF) + uniform * share[b] for b in range(4)] for row in steps]
        total = sum(letters.values())
        alone = {c: (n + BACK_OFF / 26) / (total + BACK_OFF) for c, n in letters.items()}
        sign = {c: (n + BACK_OFF / 6) / (sum(signs.values()) + BACK_OFF) for c, n in signs.items()}
        out = {}
        for x in SYMBOLS:
            before = sum(pairs.get(x.lower() + c, 0) for c in CLASSES[0]) if kind[x] < 2 else 0
            for y in SYMBOLS:
                if kind[y] < 2:
                    own = (pairs.get((x + y).lower(), 0) + BACK_OFF * alone[y.lower()]) / (before + BACK_OFF) if kind[x] < 2 else alone[y.lower()]
                    within = (1 - uniform) * own + uniform / 26
                else:
                    within = sign[y] if kind[y] == 3 else 1 / 10
                out[x + y] = step[kind[x]][kind[y]] * within
        return out

    random, ordinary = chances(1), chances(0)
    return [round(log(random[a + b] / ordinary[a + b]), 4) for a in SYMBOLS for b in SYMBOLS]


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MAX_DOCS) -> list[float]:
    """Log-likelihood ratios of next characters, row by row of SYMBOLS x SYMBOLS: random against ordinary."""
    n = docs.count()
    even = F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) / (1 << 20)
    sample = _base(docs.filter(even < most / max(n, 1)), doc_id, text)
    sample = _free(_located(sample, "markov", f"[A-Za-z0-9+/_.=-]{{{TRAINING_TOKEN},}}"), "markov")
    values = lambda spans: F.transform(spans, lambda s: s["value"])
    labelled = sample.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), values(F.concat(*[r[0] for r in RULES])).alias("texts")),
        F.struct(F.lit(0).alias("random"), F.filter(values(F.col("markov")), lambda t: t.rlike(ORDINARY)).alias("texts")),
    )).alias("x")).select("x.random", F.explode("x.texts").alias("text"))
    labelled = labelled.withColumn("text", F.when(F.col("text") == F.upper("text"), F.lower("text")).otherwise(F.col("text")))
    pairs = F.expr("transform(sequence(1, char_length(text) - 1), i -> substr(text, i, 2))")
    counts = labelled.filter("char_length(text) > 1").select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count()
    seen = {(r["random"], r["pair"]): r["count"] for r in counts.collect()}  # two rows for each pair of symbols at most
    return _models(seen)


def scan(docs: DataFrame, ratios: list[float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans: an array of structs (start, kind, end, value), by start, then kind."""
    rows = _free(_located(_base(docs, doc_id, text), "markov", f"[A-Za-z0-9+/_.=-]{{{MIN_TOKEN},}}"), "markov")
    folded = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")  # one constant, once folded
    rows = rows.select("doc_id", *[r[0] for r in RULES], "markov")
    rows = rows.withColumn("_ratios", folded)
    likely = F.expr(f"""
        filter(markov, s -> aggregate(split(if(s.value = upper(s.value), lower(s.value), s.value), ''), named_struct('at', -1, 'sum', 0D),
          (a, c) -> named_struct('at', instr('{SYMBOLS}', c) - 1,
            'sum', a.sum + if(a.at < 0, 0D, coalesce(get(_ratios, a.at * {len(SYMBOLS)} + instr('{SYMBOLS}', c) - 1), 0D))),
          a -> a.sum) >= greatest({MIN_RATIO}D, {MIN_MEAN}D * char_length(s.value)))""")
    return rows.select("doc_id", F.sort_array(F.concat(*[r[0] for r in RULES], likely)).alias("spans"))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS.index("markov"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
