"""Operators against plain versions of themselves, round trips and held-out labels."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallyforge.llm import components, decontaminate, langid, lm, mixing, quality, secrets, sharding, simhash, toxicity, warc
from tallyforge.llm.shared import table, written
from tests.llm.test_whole import plain_kept

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_fingerprint(text):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def plain_components(fps):
    values = sorted(set(fps.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    array = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for w in array[i + 1 :][np.bitwise_count(array[i + 1 :] ^ np.uint64(v)) <= 2].tolist():
            root[find(w)] = find(v)
    least = {}
    for d, v in sorted(fps.items()):
        least.setdefault(find(v), d)
    return {d: least[find(v)] for d, v in fps.items()}


def test_simhash(spark, texts):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1(spark, DATA).collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    groups = plain_components(fps)
    assert got == {d: (f"{fps[d]:016x}", groups[d]) for d in texts}


@pytest.mark.parametrize("hot", [256, 0])
def test_links_are_whole(spark, monkeypatch, hot):
    """Also with every bucket taken for a hot one."""
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    r = random.Random(1)
    seeds = [r.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1, 1 << 63]
    values = set(seeds)
    for s in seeds:
        for _ in range(12):
            for bit in r.sample(range(64), r.randint(1, 3)):
                s ^= 1 << bit
            values.add(s)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    got = {(x["a"], x["b"]) for x in found.collect()}
    assert got == {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_components(spark):
    r = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 70)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)] + [(5, 5), (500, -3)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_decontaminate(spark, texts):
    bench = {r["item_id"]: r["text"] for r in table(spark, DATA, "benchmark").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.op2(spark, DATA).collect()}
    joined = {d: " ".join(decontaminate.tokens(t)) for d, t in texts.items()}
    assert got == {(d, i) for d, t in joined.items() for i, b in bench.items() if " ".join(decontaminate.tokens(b)) in t}


def plain_tiles(item, doc, least):
    """Greedy string tiling as it is defined, by trying every pair of places."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for j in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                best = max(best, (n, -j, -i))
        n, j, i = best[0], -best[1], -best[2]
        if n < least:
            return out
        for k in range(n):
            a[i + k] = b[j + k] = True
        out.append((j, i, n))


def test_tiles():
    r = random.Random(3)
    for _ in range(60):
        item = [r.randrange(6) for _ in range(r.randint(5, 40))]
        doc = [r.randrange(7) - 1 for _ in range(20)]
        cut = r.randrange(len(item))
        doc += item[cut:] + [-1, -1] + item[:cut] + doc[:5]
        got = decontaminate.tile(np.array(item), np.array(doc), 4)
        want = plain_tiles(item, [x if x >= 0 else None for x in doc], 4)
        assert sum(n for *_, n in got) == sum(n for *_, n in want)
        assert all(item[i : i + n] == doc[j : j + n] for j, i, n in got)


def test_reordered_passage():
    words = [f"w{i}" for i in range(45)]
    block = decontaminate.Block([(9, " ".join(words)), (8, "something else that is not there at all")])
    moved = " ".join([*words[30:], "and", *words[:15], "or", *words[15:30]])
    assert [m["item_id"] for m in block.matches(f"before {moved} after", 0.5)] == [9]
    assert block.matches(" ".join(words[:10]) + " other words follow here", 0.5) == []


def test_blocks_cover_the_benchmark(spark, monkeypatch, docs):
    bench = table(spark, DATA, "benchmark")
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).select("doc_id", "item_id").collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", 500)
    assert {tuple(r) for r in decontaminate.contaminated(docs, bench).select("doc_id", "item_id").collect()} == whole


def test_rates_reach_targets(spark):
    r = np.random.default_rng(4)
    p = r.dirichlet([0.3, 0.2, 0.2], 500)
    rows = spark.createDataFrame([(int(n), [float(x) for x in q]) for n, q in zip(r.integers(1, 1000, 500), p)], "tokens long, p array<double>")
    steps, there, asked = mixing.fit_rates(rows, [0.2, 0.7, 0.1])
    assert np.allclose(there, asked, rtol=1e-6)
    rates = np.ones(500)
    for s in steps:
        rates = np.maximum(0, rates - p @ np.array(s))
    tokens = np.array([x["tokens"] for x in rows.collect()])
    assert np.allclose((tokens * rates) @ p, asked, rtol=1e-6) and rates.min() >= 0


def test_mixing(spark):
    got = mixing.op3(spark, DATA).toPandas()
    kept = got["tokens"] * got["rate"]
    for d, share in mixing.TARGETS.items():
        assert abs((kept * got[f"p_{d}"]).sum() / kept.sum() - share) < 1e-4
    labels = mixing.label_domains(table(spark, DATA, "labels")).toPandas().merge(got, on="doc_id")
    best = labels[[f"p_{d}" for d in mixing.TARGETS]].idxmax(axis=1).str[2:]
    assert (best == labels["domain"]).mean() > 0.95
    assert abs((got["copies"] - got["rate"]).sum()) < 4 * math.sqrt(len(got))


def edits(a, b):
    """Letters put in, left out or changed, and neighbours swapped."""
    d = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        d.append([i])
        for j, y in enumerate(b, 1):
            best = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                best = min(best, d[i - 2][j - 2] + 1)
            d[i].append(best)
    return d[-1][-1]


def test_automaton():
    words, stems = ["scum", "idiot", "moron", "worthless", "disgusting"], ["vequ"]
    automaton, r = toxicity.Automaton(words, stems), random.Random(5)
    for _ in range(4000):
        w = list(r.choice(words))
        for _ in range(r.randint(0, 3)):
            k, at = r.randrange(4), r.randrange(len(w) + 1)
            if k == 3:
                w[at : at + 2] = w[at : at + 2][::-1]
                continue
            w[at : at + (k != 0)] = [r.choice("abcdiot1")] if k != 2 else []
        w = "".join(w)
        near = [edits(w, t) for t in words if edits(w, t) <= toxicity.edits_allowed(t)]
        assert automaton.match(w) == min(near, default=-1), w
    assert automaton.match("vequaire") == 0 and automaton.match("veq") == -1


def test_toxicity_held_out(spark):
    got = toxicity.op4(spark, DATA).toPandas().merge(table(spark, DATA, "labels").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.94
    assert set(got["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got["doc_id"]]) == {True}


def test_quoted_is_milder():
    m = toxicity.Matcher(["idiot"], [])
    bare, quoted, none = (toxicity.features(t, m) for t in ("you are an idiot and so on", 'he used the term "idiot" in his book', "nothing here"))
    assert bare[0] > quoted[0] > none[0] == 0
    assert toxicity.features("you idi0t", m)[0] > 0


def test_secrets(spark, texts):
    got = {r["doc_id"]: r for r in secrets.op5(spark, DATA).collect()}
    for d, t in texts.items():
        spans = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, t, re.A) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        r, n = got[d], Counter(k for _, k, _ in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == (n[0], n[1], n[2], hashlib.sha256(text.encode()).hexdigest())


def test_markov_finds_random_strings(spark):
    r = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    make = lambda: "".join(r.choice(alphabet) for _ in range(32))
    names = ["get_user_account_name", "the_longest_river_name", "transaction_history_table", "customer_address_line", "account_balance_report"]
    rows = [(i, f"é call {r.choice(names)} with token={make()} then {names[i % 5]} \U0001f600 end") for i in range(300)] + [(1000 + i, f"see {make()} in {names[i % 5]}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.scan(docs, secrets.train(docs)).collect()
    texts = dict(rows)
    hits = {x["doc_id"]: [s for s in x["spans"] if s["kind"] == 3] for x in found}
    assert sum(len(hits[1000 + i]) == 1 for i in range(40)) >= 38
    assert not any(s["value"] in names for v in hits.values() for s in v)
    for x in found:
        for s in x["spans"]:
            part = texts[x["doc_id"]][s["start"] : s["end"]]
            assert part.endswith(s["value"])


def test_langid_held_out(spark, docs):
    got = langid.op6(spark, DATA).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got["held_out"] & (got["lang_pred"] != "und")]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_bloom_is_corrected():
    rng = np.random.default_rng(7)
    slots = np.zeros(1 << 12, np.uint64)
    slots[rng.choice(1 << 12, 1 << 11, replace=False)] |= np.uint64(2)  # a language that chance often finds
    for h in langid.trigrams("hello there"):
        for k in range(langid.HASHES):
            slots[int(h >> np.uint64(24 * k)) & 4095] |= np.uint64(1)
    assert langid.Model(["a", "b"], slots).predict("hello there") == ("a", pytest.approx(1.0, abs=0.05))


def test_quality(spark, texts):
    got = {r["doc_id"]: r for r in quality.op7(spark, DATA).collect()}
    for d, t in texts.items():
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        n = len({i + k for i, w in enumerate(windows) if w in twice for k in range(8)})
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), n)
        assert r["base_failed"] == (len(words) < 20 or 100 * n > 30 * len(words)) and not (r["kept"] and r["base_failed"])
    labels = {r["doc_id"]: r for r in table(spark, DATA, "labels").collect()}
    clean = [got[d] for d in labels if labels[d]["quality"] == 1]
    assert all(r["kept"] or r["base_failed"] for r in clean)


def test_quality_needs_no_python(spark):
    plan = quality.op7(spark, DATA)._jdf.queryExecution().executedPlan().toString() + secrets.op5(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_warc_round_trip(spark):
    pages = table(spark, DATA, "pages")
    folder = warc.write_warc(pages)
    want = {r["page_id"]: (r["url"], (r["html"] or "").encode()) for r in pages.collect()}
    for size in (997, 1 << 16, warc.SPLIT_BYTES):
        got = warc.read_warc(spark, folder, size).collect()
        assert sorted(r["page_id"] for r in got) == sorted(want)
        assert all(r["payload_digest"] == hashlib.sha256(want[r["page_id"]][1]).hexdigest() for r in got)
        assert all((r["url"], bytes(r["payload"])) == want[r["page_id"]] for r in got if r["record_type"] == "response")


def test_false_magic(tmp_path):
    """Magic bytes within a member, at the start of a range, and junk between members."""
    import gzip

    body = b"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 4\r\nContent-Length: 9000\r\n\r\n" + (bytes(random.Random(8).choices(range(256), k=3000)) + warc.MAGIC + b"\x00" * 5) * 3
    stored = gzip.compress(body, 0)  # not compressed: the magic is there to see
    data = b"junk" + warc.MAGIC + b"junk" + stored + b"\0\0" + gzip.compress(b"no record") + stored
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for size in (100, 1000, 3333, len(data)):
        rows = [r for s in range(0, len(data), size) for r in warc._records(f"file://{path}", len(data), s, min(s + size, len(data)))]
        assert [r["offset"] for r in rows] == [11, len(data) - len(stored)]


def test_lm(spark, texts):
    got = {r["doc_id"]: r for r in lm.op9(spark, DATA).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    tokens = {d: [*WORD.findall(lower(t)), None] for d, t in texts.items()}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, bottom = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    for d, ws in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(ws), sum(w in counts for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10(counts[w] + 1) - bottom for w in ws), rel=1e-9)
    assert np.mean([r["bits_per_byte"] for d, r in got.items() if held[d] and r["n_tokens"] > 50]) < 3.0


def test_lm_tail(spark, docs, monkeypatch):
    """The same counts if few words are in the broadcast head."""
    whole = {r["doc_id"]: r for r in lm.op9(spark, DATA).collect()}
    monkeypatch.setattr(lm, "HEAD", 50)
    for r in lm.op9(spark, DATA).collect():
        assert r["n_known"] == whole[r["doc_id"]]["n_known"] and r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"], rel=1e-9)


def test_lm_is_a_distribution():
    """Probabilities of all next symbols sum to one: one bit's costs do, at every node of the code."""
    r = np.random.default_rng(9)
    code = lm.Code(np.append(r.integers(1, 1000, 256), 10))
    assert sum(2.0 ** -int(n) for n in code.length) == pytest.approx(1.0)
    mixer = lm.Mixer(code, r.normal(0, 1, (lm.N_CONTEXTS, lm.SLOTS)).astype(np.float32), np.zeros((2, lm.SLOTS), np.int8))
    total = sum(math.exp(-mixer.costs([bytes([b])])[0]) for b in range(256)) + math.exp(-mixer.costs([b""])[0])
    assert 0 < total < 1  # texts of up to one byte, out of all texts
    text = bytes(r.integers(97, 110, 3000).astype(np.uint8))
    alone, among = mixer.costs([text])[0], mixer.costs([b"abc", text, b""])[1]
    assert alone == pytest.approx(among, rel=1e-6)


def test_long_text_in_pieces(monkeypatch):
    r = np.random.default_rng(10)
    code = lm.Code(np.append(r.integers(1, 1000, 256), 10))
    mixer = lm.Mixer(code, r.normal(0, 1, (lm.N_CONTEXTS, lm.SLOTS)).astype(np.float32), np.zeros((2, lm.SLOTS), np.int8))
    text = b" ".join(bytes(r.integers(97, 110, 6).astype(np.uint8)) for _ in range(2000))
    monkeypatch.setattr(lm, "RATE", 0.0)
    whole = mixer.costs([text])[0]
    monkeypatch.setattr(lm, "PIECE", 1000)
    assert mixer.costs([text])[0] == pytest.approx(whole, rel=1e-4)


def test_sharding(spark, docs):
    got = sharding.op10(spark, DATA).toPandas()
    size = got.groupby("shard").size()
    assert len(size) == 16 and size.max() - size.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    shares = got.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (shares.max(axis=1) - shares.min(axis=1)).max() <= 2
    want = {r["doc_id"]: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()}
    assert dict(zip(got["doc_id"], zip(got["size"], got["text_crc32"]))) == want
    again = sharding.op10(spark, DATA).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_pipeline(spark, docs):
    """Each stage against a plain version, on what the one before it left."""
    stages = dict(corpus_pipeline.STAGES)
    pull = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    first = written(stages["language"](spark, docs, DATA), "t1")
    gone = set(pull(docs)) - set(pull(first))
    assert all(not re.search(r"[^\W\d_]", t) for d, t in pull(docs).items() if d in gone)
    second = written(stages["dedup"](spark, first, DATA), "t2")
    assert set(pull(second)) == plain_kept(pull(first))
    third = written(stages["decontaminate"](spark, second, DATA), "t3")
    bench = [" ".join(decontaminate.tokens(r["text"])) for r in table(spark, DATA, "benchmark").collect()]
    assert set(pull(third)) == {d for d, t in pull(second).items() if not any(b in " ".join(decontaminate.tokens(t)) for b in bench)}
    fourth = written(stages["mix"](spark, third, DATA), "t4")
    rates = {r["doc_id"]: r["copies"] for r in mixing.rates(third, mixing.label_domains(table(spark, DATA, "labels"))).collect()}
    assert Counter(r["doc_id"] for r in fourth.collect()) == Counter({d: n for d, n in rates.items() if n})
    assert stages["shard"](spark, fourth, DATA).count() == fourth.count()
    assert all(s.columns == docs.columns for s in (first, second, third, fourth))


def test_last_pairs_of_near_copies(spark):
    """A group of near copies beside texts that share its entries but are similar to none, against all pairs."""
    r = random.Random(8)
    base = [f"w{r.randrange(5000)}" for _ in range(150)]

    def edited(n):
        words = list(base)
        for i in r.sample(range(150), n):
            words[i] = f"x{r.randrange(10**9)}"
        return " ".join(words)

    texts = [edited(r.choice([1, 1, 2])) for _ in range(150)] + [edited(r.choice([6, 7, 8])) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [set(zip(*(t.split()[i:] for i in range(5)))) for t in texts]
    similar = lambda a, b: 10 * len(a & b) >= 8 * len(a | b)
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if similar(sets[a], sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    kept = {x["doc_id"] for x in simhash.keep_one(docs).collect()}
    assert 1 < len(set(group)) < 150
    assert kept == set(group)
