"""Toxicity by a lexicon that tolerates misspelling, and context windows around its hits.

The lexicon is learnt from a sample of at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other labelled documents, chosen by
hash. It has words, and stems (beginnings that many different words share), whose rate among toxic documents is at least
``MIN_LIFT`` times that among the others. A term must occur in several different contexts, so that copies of one
document don't make its words toxic. Terms have three letters or more; how many there are is bounded by the sample only.

Words are matched by Levenshtein automata intersected with the trie of the lexicon. The product is made deterministic
as words are read: a state is a set of (trie node, letter that must come next, edits), and a transition is worked out
once. Terms of three letters match exactly, longer ones within one edit and from nine letters on two; an edit is a letter
put in, left out or changed, or two neighbours swapped. Stems match exactly. Words that the sample's clean documents use
are no misspellings.

A hit scores by its edits and its context window: less in quotation marks or beside a word of reporting, more beside
another hit. The sum, the largest score and the density of hits give the score by a logistic regression on the sample.

Defined cases: a null or empty text has no hits and gets the score of such texts, like any text without hits. Rows
without label are not trained on; of repeated labels of an id the largest counts. If either class is missing, no
lexicon is learnt and every score is the share of toxic labels (0 without labels). Repeated rows get equal results; an
empty table gives an empty result. Of the inputs only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyforge.llm.shared import fold, table, written

MAX_TOXIC, MAX_CLEAN = 4000, 8000
MIN_DOCS, MIN_CONTEXTS, MIN_LIFT = 5, 5, 20.0
PREFIXES = range(4, 9)
SKETCH = 16
WINDOW = 6
EDIT_WEIGHT = (1.0, 0.7, 0.5)
QUOTED, BESIDE = 0.3, 0.5
OPENING, CLOSING = "\"“„«", "\"”“»"
#: Words that report what others said.
REPORTING = set("said says quoted quote called word term sagte zitat nannte wort dit cité appelé mot dijo cita llamó palabra".split())
EDGES = re.compile(r"^[^\w@$!*]+|[^\w@$*]+$")
DEAD, STEM = -1, -2


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Automaton:
    """The lexicon's trie with an allowance of edits, determinized as it is used."""

    def __init__(self, words: list[str], stems: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]  # edits that a word ending here allows; -1: none ends here
        self.stem: list[bool] = [False]
        self.most: list[int] = [0]  # the largest allowance below a node
        for text, is_stem in [(w, False) for w in words] + [(s, True) for s in stems]:
            node, allowed = 0, 0 if is_stem else edits_allowed(text)
            self.most[0] = max(self.most[0], allowed)
            for ch in text:
                if ch not in self.next[node]:
                    self.next[node][ch] = len(self.next)
                    self.next.append({}), self.end.append(-1), self.stem.append(False), self.most.append(0)
                node = self.next[node][ch]
                self.most[node] = max(self.most[node], allowed)
            if is_stem:
                self.stem[node] = True
            else:
                self.end[node] = allowed
        self.alphabet = {ch for x in self.next for ch in x}
        self.states: list[frozenset] = []
        self.ids: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []  # to a state that decides the word whatever follows: DEAD or STEM
        self.ended: list[int] = []  # what a word that ends in a state gets
        self.start = self._id(self._closed({(0, ""): 0}))

    def _closed(self, found: dict[tuple[int, str], int]) -> frozenset:
        """With the nodes that are reached by leaving letters out; fewest edits for each node."""
        todo = [key for key in found if not key[1]]
        while todo:
            node, _ = key = todo.pop()
            for child in self.next[node].values():
                e = found[key] + 1
                if e <= self.most[child] and e < found.get((child, ""), 9):
                    found[child, ""] = e
                    todo.append((child, ""))
        return frozenset((*key, e) for key, e in found.items())

    def _id(self, state: frozenset) -> int:
        if not state:
            return DEAD
        if state not in self.ids:
            if any(e == 0 and self.stem[n] for n, _, e in state):
                self.ids[state] = STEM
            else:
                self.ids[state] = len(self.states)
                self.states.append(state)
                self.moves.append({})
                self.ended.append(min((e for n, due, e in state if not due and e <= self.end[n]), default=-1))
        return self.ids[state]

    def _move(self, state: int, ch: str) -> int:
        found: dict[tuple[int, str], int] = {}

        def reach(node: int, e: int, due: str = "") -> None:
            if e <= self.most[node] and e < found.get((node, due), 9):
                found[node, due] = e

        for node, due, e in self.states[state]:
            if due:  # the second of two swapped letters
                if ch == due:
                    reach(node, e)
                continue
            if ch in self.next[node]:
                child = self.next[node][ch]
                if e == 0:
                    found[child, ""] = 0
                else:
                    reach(child, e)
            reach(node, e + 1)
            for first, child in self.next[node].items():
                reach(child, e + 1)
                if first != ch and ch in self.next[child]:
                    reach(self.next[child][ch], e + 1, first)
        return self._id(self._closed(found))

    def match(self, word: str) -> int:
        """The fewest edits from a term (0 for a stem); -1 if none is near enough."""
        state, all_moves = self.start, self.moves
        for ch in word:
            to = all_moves[state].get(ch)
            if to is None:
                key = ch if ch in self.alphabet else "\0"
                to = all_moves[state].get(key)
                if to is None:
                    to = all_moves[state][key] = self._move(state, key)
            if to < 0:
                return -1 if to == DEAD else 0
            state = to
        return self.ended[state]


class Matcher:
    """Hits of words, remembered for words that come again."""

    def __init__(self, words: list[str], stems: list[str], plain: set[str] = frozenset()):
        self.automaton, self.plain, self.seen = Automaton(words, stems), plain, {}

    def hit(self, raw: str) -> int:
        found = self.seen.get(raw)
        if found is None:
            if len(self.seen) > 300_000:
                self.seen.clear()
            word = EDGES.sub("", raw)
            bare = word.rstrip("*$")  # as letters at a word's end they'd each be an edit
            found = min((e for e in map(self.automaton.match, {word, bare} - {""}) if e >= 0), default=-1)
            if found > 0 and not self.plain.isdisjoint((word, bare)):
                found = -1
            self.seen[raw] = found
        return found

    def hits(self, words: list[str]) -> list[tuple[int, int]]:
        get, slow = self.seen.get, self.hit
        found = []
        for i, w in enumerate(words):
            e = get(w)
            if e is None:
                e = slow(w)
            if e >= 0:
                found.append((i, e))
        return found


def features(text: str | None, matcher: Matcher) -> tuple[float, float, float]:
    """Log of the sum, and the largest, of the hits' scores; hits per hundred words."""
    words = (text or "").lower().split()
    found = matcher.hits(words)
    if not found:
        return 0.0, 0.0, 0.0
    total = most = 0.0
    at = [i for i, _ in found]
    for k, (i, edits) in enumerate(found):
        before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
        opens = sum(w[0] in OPENING for w in before)
        shut = sum(w[-1] in CLOSING or w.rstrip(".,;:!?")[-1:] in set(CLOSING) for w in after)
        ended = sum(w.rstrip(".,;:!?")[-1:] in set(CLOSING) for w in before[:-1])
        quoted = opens > ended and shut > 0 or not REPORTING.isdisjoint(before)
        near = k > 0 and i - at[k - 1] <= WINDOW or k + 1 < len(at) and at[k + 1] - i <= WINDOW
        score = EDIT_WEIGHT[edits] * (QUOTED if quoted else 1.0) + (0.0 if quoted else BESIDE * near)
        total, most = total + score, max(most, score)
    return float(np.log1p(total)), most, 100.0 * len(found) / len(words)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch, class and term: documents, and the smallest hashes of the contexts (for a stem: of the words)."""
    for batch in batches:
        docs: dict[tuple, int] = {}
        seen: dict[tuple, set] = {}
        for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"]):
            words = [EDGES.sub("", w) for w in (text.as_py() or "").lower().split()]
            own: dict[tuple, int] = {}
            for i, w in enumerate(words):
                if len(w) >= 3:
                    if (0, w) not in own:
                        own[0, w] = xxhash.xxh32_intdigest(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}")
                        mark = xxhash.xxh32_intdigest(w)
                        for n in PREFIXES:
                            if len(w) > n:
                                own[n, w[:n]] = mark
            for term, mark in own.items():
                key = (toxic, *term)
                docs[key] = docs.get(key, 0) + 1
                marks = seen.setdefault(key, set())
                if len(marks) < SKETCH:
                    marks.add(mark)
                elif mark not in marks and mark < (top := max(marks)):
                    marks.remove(top)
                    marks.add(mark)
        keys = list(docs)
        yield pa.RecordBatch.from_pydict({
            "toxic": pa.array([k[0] for k in keys], pa.int32()), "size": pa.array([k[1] for k in keys], pa.int32()), "term": pa.array([k[2] for k in keys], pa.string()),
            "docs": pa.array(list(docs.values()), pa.int64()), "marks": pa.array([list(seen[k]) for k in keys], pa.list_(pa.int64())),
        })


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], list[str]]:
    """(words, stems) from rows (text, toxic)."""
    counts = sample.mapInArrow(_terms, "toxic int, size int, term string, docs long, marks array<long>")
    pos, neg = F.sum(F.when(F.col("toxic") == 1, F.col("docs"))), F.sum(F.when(F.col("toxic") == 0, F.col("docs")))
    marks = F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("toxic") == 1, F.col("marks"))))))
    rated = counts.groupBy("size", "term").agg(pos.alias("pos"), F.coalesce(neg, F.lit(0)).alias("neg"), marks.alias("marks"))
    lift = (F.col("pos") / n_toxic) / ((F.col("neg") + 0.5) / n_clean)
    good = rated.filter((F.col("pos") >= MIN_DOCS) & (F.col("marks") >= MIN_CONTEXTS) & (lift >= MIN_LIFT))
    rows = good.orderBy(F.desc("pos"), "size", "term").collect()  # of the bounded sample, in which each is in MIN_DOCS texts
    found = {(r["size"], r["term"]): r["pos"] for r in rows}
    # The longest stem that loses no document, and no stem within another. ``beyond``: of stems one letter longer, the most
    # documents.
    beyond: dict[str, int] = {}
    for (size, term), docs in found.items():
        if size:
            beyond[term[:-1]] = max(docs, beyond.get(term[:-1], 0))
    stems: dict[str, None] = {}
    starts = lambda term: any(term[:n] in stems for n in PREFIXES)
    for (size, term), docs in sorted(found.items(), key=lambda x: x[0][0]):
        if size and beyond.get(term, 0) < docs and not starts(term):
            stems[term] = None
    words = [t for size, t in found if size == 0 and not starts(t)]
    return words, list(stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights, the intercept first, by Newton's method; the ridge is on the features' weights only."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, words: list[str], stems: list[str], plain: set[str], weights: np.ndarray):
        self.words, self.stems, self.plain, self.weights = words, stems, plain, weights
        self.matcher: Matcher | None = None

    def __getstate__(self):
        return self.__dict__ | {"matcher": None}

    def score(self, text: str | None) -> float:
        if self.matcher is None:
            self.matcher = Matcher(self.words, self.stems, self.plain)
        z = self.weights[0] + float(np.dot(self.weights[1:], features(text, self.matcher)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Learn from the documents that ``labels`` has; give it only rows to learn from."""
    spark = docs.sparkSession
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic")).dropna().groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        rate = (n.get(1, 0) + 1e-9) / (n.get(1, 0) + n.get(0, 0) + 2e-9) if n else 0.0
        return Model([], [], set(), np.array([np.log(max(rate, 1e-9) / max(1 - rate, 1e-9)), 0, 0, 0]))
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, MAX_TOXIC / n[1]))).otherwise(F.lit(min(1.0, MAX_CLEAN / n[0])))
    even = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    chosen = F.broadcast(known.filter(even < part))  # MAX_TOXIC + MAX_CLEAN ids
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = written(texts.join(chosen, "id").select("text", "toxic"), "toxic-sample")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    words, stems = learn_lexicon(sample, max(1, size.get(1, 0)), max(1, size.get(0, 0)))
    rough = spark.sparkContext.broadcast((words, stems))

    def near(batches):
        matcher = Matcher(*rough.value)
        for batch in batches:
            found = {EDGES.sub("", w) for t in batch["text"] for w in t.as_py().lower().split() if matcher.hit(w) > 0}
            yield pa.RecordBatch.from_pydict({"word": pa.array(sorted(found), pa.string())})

    used = sample.filter("toxic = 0").mapInArrow(near, "word string").distinct()
    plain = {r["word"] for r in used.collect()}  # words near a term, of MAX_CLEAN documents
    model = spark.sparkContext.broadcast(Model(words, stems, plain, np.zeros(4)))

    def measure(batches):
        matcher = Matcher(model.value.words, model.value.stems, model.value.plain)
        for batch in batches:
            x = [features(t.as_py(), matcher) for t in batch["text"]]
            cols = [pa.array([r[i] for r in x], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*cols, batch["toxic"]], ["a", "b", "c", "toxic"])

    rows = sample.mapInArrow(measure, "a double, b double, c double, toxic int").toPandas()
    if rows["toxic"].nunique() < 2:
        return Model(words, stems, plain, np.array([-3.0, 1.0, 1.0, 0.0]))
    weights = fit_logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy())
    return Model(words, stems, plain, weights)


def scored(spark: SparkSession, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)  # the sample's lexicon, and the words near it

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())

    return score(text.cast("string"))


def op4(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = train(docs.select("doc_id", "text"), labels.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), scored(spark, model, F.col("text")).alias("score"))
    return found.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
