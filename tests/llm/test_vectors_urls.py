"""Hard negatives, vector codes and URL filters against plain versions, and their edge cases."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import codes, negatives, urls
from tallyforge.llm.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def _finite(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def _plain_negatives(rows, positives=5, negatives_=3):
    """Every anchor against every row, as tuples."""
    kept = [(i, label if i is None or i % 7 else (label + 1) % 10, [max(-(1 << 20), min(1 << 20, math.floor(256 * float(np.float32(x))))) for x in v]) for i, v, label in rows if label is not None and _finite(v)]
    out = []
    for a, (i, label, v) in enumerate(kept):
        if i is None or i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), 2**63 - 1 if j is None else j, b, own == label, j) for b, (j, own, w) in enumerate(kept) if b != a and len(w) == len(v)]
        for minus, _, _, _, j in sorted(x[:5] for x in scored if x[3])[:positives]:
            fits = sorted(x for x in scored if not x[3] and 50 * -minus <= 100 * -x[0] <= 95 * -minus)[:negatives_]
            out += [(i, j, k + 1, x[4], -minus, -x[0]) for k, x in enumerate(fits)]
    return sorted(out, key=str)


def _mined(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    id, label = F.col("vec_id"), F.col("label")
    got = negatives.mine(df, id % 50 == 0, label=F.when(id % 7 == 0, (label + 1) % 10).otherwise(label), **more)
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got.collect()), key=str)


def _vectors(n, dim=12, seed=0, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, dim))
    own = r.integers(0, labels, n)
    return [(int(i), [float(np.float32(x)) for x in centres[k] * 0.7 + r.normal(size=dim) * 0.4], int(k)) for i, k in enumerate(own)]


@pytest.mark.parametrize("seed", [0, 1])
def test_negatives_equal_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", 12 * 20)  # several blocks (of 64 anchors at least)
    monkeypatch.setattr(negatives, "LEAST_ROWS", 64)
    rows = _vectors(1500, seed=seed)
    want = _plain_negatives(rows)
    assert len(want) > 100 and _mined(spark, rows) == want


def test_negatives_with_a_hot_vector_and_odd_rows(spark):
    rows = _vectors(600, dim=6, seed=2)
    hot = rows[50][1]
    rows = [(i, hot if i % 3 == 0 else v, label) for i, v, label in rows]  # a third of all rows are equal: only ids tell
    rows += rows[100:102] + [(700, None, 1), (750, [1.0] * 6, None), (800, [1.0, None] * 3, 1), (850, [math.nan] * 6, 1), (900, [math.inf] * 6, 1), (None, hot, 2), (950, [0.5, 0.25], 2), (951, [0.5, 0.5], 2), (952, [0.25, 0.25], 3), (1000, [], 1), (1001, [], 1), (1002, [], 2), (1050, [3e38] * 6, 1)]
    assert _mined(spark, rows) == _plain_negatives(rows)


def test_negatives_prune_whole_groups():
    """Far clusters leave without a score; what is left is exact."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 16)) * 3
    points = lambda n, own: negatives.Points(np.arange(n) + 10**6 * own, np.arange(n), np.arange(n) % 40, np.floor(256 * (centres[np.arange(n) % 40] + 0.05 * r.normal(size=(n, 16)))))
    a, c = points(800, 0), points(8000, 1)
    tree = negatives.grow(a, 16)
    best = negatives.Best(negatives.Wish(5, True, np.full((800, 1), -np.inf), np.full((800, 1), np.inf)))
    tally = {}
    negatives.search(tree, negatives.grow(c, 64), best, tally)
    score = np.where(tree.points.label[:, None] == c.label[None, :], tree.points.v @ c.v.T, -np.inf)
    assert (np.sort(score, axis=1)[:, ::-1][:, :5] == best.score[:, 0]).all()
    assert tally["scored"] < 0.2 * tally["pairs"], tally


def test_negatives_empty(spark):
    assert _mined(spark, []) == [] and _mined(spark, [(1, [1.0], 1)]) == [] and _mined(spark, [(50, [1.0], 1)]) == []


def _plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [max(-(1 << 24), min(1 << 24, math.floor(4096 * float(np.float32(x))))) for x in v], label) for i, v, label in rows if _finite(v)]
    width = max([1, *(len(v) for _, v, _ in kept)])
    width = -(-width // parts)
    cut = [[(v + [0] * (width * parts))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, v, _), c in zip(kept, cut):
        if i is not None and (i not in first or v < first[i][0]):
            first[i] = (v, c)
    ids = sorted(first)[:entries]
    books = [[first[i][1][p] for i in ids] for p in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    near = lambda p, x: min(range(len(ids)), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds if ids else 0):
        for p in range(parts):
            own = [near(p, c[p]) for c in cut]
            for e in range(len(ids)):
                mine = [c[p] for c, k in zip(cut, own) if k == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    if not ids:
        return [], None
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        own = [near(p, c[p]) for p in range(parts)]
        error = sum(far(c[p], books[p][e]) for p, e in enumerate(own))
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e in own), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, code, error, by_label[label]) for i, code, error, label in out], key=str), digest


def _coded(spark, rows):
    made = codes.encode(spark.createDataFrame(rows, VECTORS).repartition(3))
    got = codes.with_label_error(made.rows).collect()
    return sorted([(r["id"], r["code"], r["error"], r["label_error"]) for r in got], key=str), made


@pytest.mark.parametrize("chunk", [4096, 50])
def test_codes_equal_plain_rounds(spark, monkeypatch, chunk):
    monkeypatch.setattr(codes, "CHUNK", chunk)
    rows = _vectors(400, dim=24, seed=4)
    got, made = _coded(spark, rows)
    want, digest = _plain_codes(rows)
    assert got == want and made.digest == digest
    assert made.measured[0] == 400 * 8 and sum(made.measured[1:]) < 6 * 400 * 8 * 0.9, f"heaps spare work: {made.measured}"


def test_codes_with_ties_and_odd_rows(spark):
    rows = [(i, [float(i % 3)] * 8, i % 2) for i in range(60)]  # equal entries from the start: ties go to the lower one
    rows += rows[:2] + [(100, None, 1), (101, [1.0, None], 1), (102, [math.nan] * 8, 1), (103, [-math.inf] * 8, None), (None, [0.5] * 8, None), (104, [0.5] * 3, None), (105, [], 7), (106, [0.25] * 11, 7), (107, [1e30] * 8, 7)]
    got, made = _coded(spark, rows)
    want, digest = _plain_codes(rows)
    assert got == want and made.digest == digest and made.entries.shape == (8, 16, 2)


def test_codes_of_few_and_none(spark):
    assert _coded(spark, [])[0] == [] and _coded(spark, [(1, None, 1)])[0] == [] and _coded(spark, [(None, [1.0], 1)])[0] == []
    rows = [(5, [1.0, 2.0], None), (6, [1.5, 2.0], None)]
    assert _coded(spark, rows)[0] == _plain_codes(rows)[0]
    with pytest.raises(ValueError):
        codes.encode(spark.createDataFrame(rows, VECTORS), entries=300)


def test_heap_pops_what_the_loss_has_reached():
    heap = codes.Heaps.empty(2)
    heap.push(np.array([0, 1, 2], np.int32), np.array([0, 0, 1]), np.array([3.0, 1.0, 2.0]))
    heap.push(np.array([3], np.int32), np.array([0]), np.array([2.0]))
    rows, own = heap.pop(np.array([2.5, 1.0]))
    assert rows.tolist() == [1, 3] and own.tolist() == [0, 0] and heap.codes(4).tolist() == [0, 0, 1, 0]


def _plain_verdict(url, rules, words):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    at = (url or "").find("://")
    host, path = "", ""
    if at >= 0:
        rest = re.split(r"[?#]", url[at + 3 :], maxsplit=1)[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    terms = [t for t in words.weights if any((m.start() == 0 or not low[m.start() - 1].isalnum()) and (m.end() == len(low) or not low[m.end()].isalnum()) for m in re.finditer(f"(?={re.escape(t)})", low) for m in [re.compile(re.escape(t)).match(low, m.start())])]
    weight = sum(words.weights[t] for t in terms)
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "block" if weight >= words.limit else "allow", weight


URLS = [
    None, "", "no scheme", "://", "http://", "http://A.Example.NET/en/1", "http://example.net/en", "http://notexample.net/en/", "https://x.example.com/de/1?u=porn", "https://x.example.com/en/porn-1", "https://EXAMPLE.org/fr/1",
    "https://example.org?x=/fr/", "https://example.org#a://b/c", "https://h/a://x/y", "https://sussex.gov/sexual", "https://h.io/free-sex-cams", "https://h.io/free/free/free", "https://h.io/hot.girls_live", "https://h.io/HOT-GIRLS?LIVE", "https://h.io/éporn", "https://h.io/porn²",
    "https://u:p@h.io:80/en/x", "https://h.io/\nxxx", "https://net/", "https://net", "https://h.io/" + "a" * 200_000 + "/xxx", "https://onlinecasino.io/", "https://online-casino-bonus.io/spin", "http://..net/", "https://日本.org/fr/", "https://h.io/porno",
]


def test_urls_equal_plain(spark):
    r = random.Random(5)
    pieces = ["http", "://", "/", "?", "#", ".", "-", "net", "org", "example", "en", "fr", "xxx", "hot", "free", "live", "A", "é", "1", "porn"]
    all_ = URLS + ["".join(r.choice(pieces) for _ in range(r.randint(1, 14))) for _ in range(400)]
    words = urls.vocabulary()
    rules = urls.CONTRACT_RULES + [("example.net", "/", "allow"), ("h.io", "/h", "block"), ("b.h.io", "/", "allow")]
    df = spark.createDataFrame(list(enumerate(all_)), "page_id int, url string")
    want = {i: _plain_verdict(u, rules, words) for i, u in enumerate(all_)}
    for given in (rules, spark.createDataFrame(rules, "host string, path string, verdict string")):
        got = {r["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict", "weight")) for r in urls.judged(df, "url", given, words).collect()}
        assert got == want


def test_urls_edges(spark):
    rows = spark.createDataFrame([("https://h.io/xxx", "mine", 1), ("https://h.io/xxx", "mine", 1), (None, None, 2)], "url string, host string, terms int")
    got = urls.judged(rows, "url").orderBy("url").collect()
    assert [r["verdict"] for r in got] == ["allow", "block", "block"] and [r["host"] for r in got] == ["", "h.io", "h.io"] and got[1]["terms"] == "xxx"
    assert urls.judged(rows.limit(0), "url").count() == 0
    assert urls.judged(rows, "url", (), urls.vocabulary([], [])).filter("verdict = 'block'").count() == 0
    with pytest.raises(ValueError):
        urls.vocabulary(["Big"])


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_vector_codes", "op13_url_filter"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    other = con.sql(oracle_sql()[name])
    got = queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(other.columns)
    columns = sorted(other.columns)
    plain = lambda rows: sorted(str([r[c] for c in columns]) for r in rows)
    assert plain([r.asDict() for r in got.collect()]) == plain([dict(zip(other.columns, r)) for r in other.fetchall()])
