"""Hard negatives by dual-tree search over inner products.

Candidates are laid out by a tree of hyperplanes (fitted to at most SAMPLE_VALUES values of sampled rows, so its depth is
bounded; it only decides where rows lie) and written; each task grows ball trees over the chunks that it reads. Anchors come
in blocks of at most BLOCK_VALUES values, each with a tree of its own that the tasks get. A pair of nodes is given an
interval that holds every inner product between them (centres' product +- what the radii allow); whole groups of anchors
leave a node of candidates as soon as that interval can't reach any of their bounds, and pairs of leaves are scored
exactly. The bounds start from the sampled rows and rise as better ones are found.

A block takes two searches: the anchors' positives, then, with each positive's score as the band, the negatives. A search's
tasks give each anchor's best rows of theirs, which meet by anchor; anchors are few against rows (one in fifty) and what
a task gives for one is bounded by the number asked for. Each search is written, so a lost executor costs its tasks.

Scores are integer inner products of floor(scale * x). Defined cases: rows with a null label, a null vector or
a null or non-finite component take no part; scaled components are held within +-2^20. Vectors meet vectors of their own
length only. Rows are told apart by their place, so a repeated row is another row: also a positive of its copy. Rows
without an id are candidates behind all others of equal score. A hot vector or label is spread over chunks like any rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.codes import scaled
from tallyforge.llm.shared import deleted, table, written_at

SCALE = 256
#: Anchors of a block, rows of the sample that bounds start from, and of a task's chunk, each by the values they hold.
BLOCK_VALUES, SAMPLE_VALUES, CHUNK_VALUES = 1 << 20, 1 << 19, 1 << 22
ANCHOR_LEAF, LEAF = 64, 256
#: Rows that a leaf of the layout should hold, and the fewest, where that leaves cores idle.
LAYOUT_ROWS, LEAST_ROWS = 1 << 15, 1 << 10
#: Scaled components are held within this, so that doubles hold the inner products of up to 8,192 of them exactly.
LARGEST = 1 << 20
NO_ID = np.iinfo(np.int64).max


@dataclass
class Points:
    """Rows of one length: their place, id, label and scaled vector (doubles that hold integers)."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray

    def take(self, order: np.ndarray) -> Points:
        return Points(self.row[order], self.id[order], self.label[order], self.v[order])

    def __len__(self) -> int:
        return len(self.row)


@dataclass
class Tree:
    """A ball tree: ``points`` in the order of its leaves; each node is a range of them with centre, radius, the labels'
    range and its children (-1: a leaf)."""

    points: Points
    start: np.ndarray
    end: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    low_label: np.ndarray
    high_label: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray = field(init=False)

    def __post_init__(self):
        self.length = np.linalg.norm(self.centre, axis=1)


def grow(points: Points, leaf: int) -> Tree:
    """Cuts each range between two far points (at the median, where the middle leaves too few on a side), until a leaf is left."""
    order, nodes, todo = np.arange(len(points)), [], [(0, len(points), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        v = points.v[order[a:b]]
        centre = v.mean(axis=0)
        away = np.linalg.norm(v - centre, axis=1)
        labels = points.label[order[a:b]]
        at = len(nodes)
        nodes.append([a, b, centre, away.max(), labels.min(), labels.max(), -1, -1])
        if parent >= 0:
            nodes[parent][6 + side] = at
        if b - a > leaf and away.max() > 0:
            far = v[away.argmax()]
            along = v @ (far - v[np.linalg.norm(v - far, axis=1).argmax()])
            half = int((along < (along.min() + along.max()) / 2).sum())
            half = half if (b - a) // 16 < half < b - a - (b - a) // 16 else (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(along, half)]
            todo += [(a, a + half, at, 0), (a + half, b, at, 1)]
        elif b - a > leaf:  # equal vectors: cut anywhere
            half = (b - a) // 2
            todo += [(a, a + half, at, 0), (a + half, b, at, 1)]
        else:  # ties go by id, then place
            order[a:b] = order[a:b][np.lexsort((points.row[order[a:b]], points.id[order[a:b]]))]
    column = lambda i, kind=None: np.array([n[i] for n in nodes], kind)
    return Tree(points.take(order), column(0), column(1), column(2), column(3, float), column(4), column(5), column(6), column(7))


@dataclass
class Wish:
    """What each anchor looks for, in up to ``slots`` searches at once: the ``k`` best scores from ``low`` to ``high`` (both
    anchors x slots, in the order of the tree), of its own label or of any other."""

    k: int
    own: bool
    low: np.ndarray
    high: np.ndarray

    def take(self, order: np.ndarray) -> Wish:
        return Wish(self.k, self.own, self.low[order], self.high[order])


class Best:
    """The k best (score, id, row) of each anchor and slot so far, and the score from which a row may still enter."""

    def __init__(self, wish: Wish):
        shape = (*wish.low.shape, wish.k)
        self.wish, self.score = wish, np.full(shape, -np.inf)
        self.id, self.row = np.full(shape, NO_ID), np.full(shape, NO_ID)
        self.floor = wish.low.astype(float).copy()

    def offer(self, at: np.ndarray, slot: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """``score``: anchors ``at`` by candidates, -inf where they don't suit. Candidates come sorted by (id, row)."""
        k = self.wish.k
        first = np.argsort(-score, axis=1, kind="stable")[:, :k]
        s = np.concatenate([self.score[at, slot], np.take_along_axis(score, first, axis=1)], axis=1)
        i, r = (np.concatenate([mine[at, slot], new[first]], axis=1) for mine, new in ((self.id, ids), (self.row, rows)))
        order = np.lexsort((r, i, -s), axis=-1)[:, :k]
        self.score[at, slot], self.id[at, slot], self.row[at, slot] = (np.take_along_axis(x, order, axis=1) for x in (s, i, r))
        self.floor[at, slot] = np.maximum(self.wish.low[at, slot], self.score[at, slot, k - 1])


def search(anchors: Tree, candidates: Tree, best: Best, tally: dict | None = None) -> None:
    """Walk both trees together, one level of the smaller node at a time; pairs that can't matter leave with all their
    anchors. The rest, leaf by leaf, best first. ``tally``: counts the pairs of rows that were scored and those there were."""
    own = best.wish.own
    a, c = np.zeros(1, int), np.zeros(1, int)
    leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    starts = np.sort(anchors.start[anchors.left < 0])  # of the leaves of anchors
    low, high = np.minimum.reduceat(best.floor.min(axis=1), starts), np.maximum.reduceat(best.wish.high.max(axis=1), starts)
    first, last = np.searchsorted(starts, anchors.start), np.searchsorted(starts, anchors.end)
    node_low = np.array([low[i:j].min() for i, j in zip(first, last)])
    node_high = np.array([high[i:j].max() for i, j in zip(first, last)])
    while len(a):
        middle = np.einsum("ij,ij->i", anchors.centre[a], candidates.centre[c])
        reach = anchors.length[a] * candidates.radius[c] + candidates.length[c] * anchors.radius[a] + anchors.radius[a] * candidates.radius[c]
        reach += 1e-9 * (np.abs(middle) + reach) + 1e-6
        meets = (middle + reach >= node_low[a]) & (middle - reach <= node_high[a])
        if own:
            meets &= (anchors.low_label[a] <= candidates.high_label[c]) & (candidates.low_label[c] <= anchors.high_label[a])
        else:
            pure = (anchors.low_label[a] == anchors.high_label[a]) & (candidates.low_label[c] == candidates.high_label[c])
            meets &= ~(pure & (anchors.low_label[a] == candidates.low_label[c]))
        a, c, bound = a[meets], c[meets], (middle + reach)[meets]
        ends_a, ends_c = anchors.left[a] < 0, candidates.left[c] < 0
        done = ends_a & ends_c
        leaves.append((a[done], c[done], bound[done]))
        a, c, ends_a, ends_c = a[~done], c[~done], ends_a[~done], ends_c[~done]
        split_a = ends_c | (~ends_a & (anchors.radius[a] >= candidates.radius[c]))
        x, y, z, w = a[split_a], c[split_a], a[~split_a], c[~split_a]
        a = np.concatenate([anchors.left[x], anchors.right[x], z, z])
        c = np.concatenate([y, y, candidates.left[w], candidates.right[w]])
    a, c, bound = (np.concatenate(x) for x in zip(*leaves))
    for i in np.argsort(-bound, kind="stable"):
        _scored(anchors, candidates, best, a[i], c[i], bound[i], tally)
    if tally is not None:
        tally["pairs"] = tally.get("pairs", 0) + len(anchors.points) * len(candidates.points)


def _scored(anchors: Tree, candidates: Tree, best: Best, a: int, c: int, bound: float, tally: dict | None) -> None:
    """A pair of leaves, exactly, for the anchors that its bound can still reach."""
    mine = np.arange(anchors.start[a], anchors.end[a])
    mine = mine[bound >= best.floor[mine].min(axis=1)]
    if not len(mine):
        return
    here = slice(candidates.start[c], candidates.end[c])
    p = candidates.points
    ids, rows, labels = p.id[here], p.row[here], p.label[here]
    score = anchors.points.v[mine] @ p.v[here].T  # exact: every sum is an integer that a double holds
    same = anchors.points.label[mine][:, None] == labels[None, :]
    suits = (same & (anchors.points.row[mine][:, None] != rows[None, :])) if best.wish.own else ~same
    if tally is not None:
        tally["scored"] = tally.get("scored", 0) + score.size
    for slot in range(best.wish.low.shape[1]):
        fits = suits & (score >= best.floor[mine, slot][:, None]) & (score <= best.wish.high[mine, slot][:, None])
        some = fits.any(axis=1)
        if some.any():
            best.offer(mine[some], slot, np.where(fits[some], score[some], -np.inf), ids, rows)


@dataclass
class Layout:
    """A tree of hyperplanes over sampled rows: which way a row goes at each node. Only a layout: any answer is right."""

    along: list[np.ndarray]
    cut: list[np.ndarray]

    @classmethod
    def fit(cls, v: np.ndarray, depth: int) -> Layout:
        leaf, along, cut = np.zeros(len(v), int), [], []
        for level in range(depth):
            directions, cuts = np.zeros((1 << level, v.shape[1])), np.zeros(1 << level)
            for node in range(1 << level):
                mine = v[leaf == node]
                if len(mine) > 1:
                    far = mine[np.linalg.norm(mine - mine.mean(axis=0), axis=1).argmax()]
                    directions[node] = far - mine[np.linalg.norm(mine - far, axis=1).argmax()]
                    cuts[node] = np.median(mine @ directions[node])
            along.append(directions)
            cut.append(cuts)
            leaf = 2 * leaf + (np.einsum("ij,ij->i", v, directions[leaf]) > cuts[leaf])
        return cls(along, cut)

    def leaf(self, v: np.ndarray) -> np.ndarray:
        at = np.zeros(len(v), int)
        for directions, cuts in zip(self.along, self.cut):
            at = 2 * at + (np.einsum("ij,ij->i", v, directions[at]) > cuts[at])
        return at


def _matrices(v: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, flat values) of a list array."""
    return v.value_lengths().to_numpy(zero_copy_only=False), v.flatten().to_numpy(zero_copy_only=False).astype(float)


def _points(batch: pa.Table) -> dict[int, Points]:
    """Rows (row, id, label, v) by the length of their vectors."""
    batch = batch.combine_chunks()
    column = lambda n: batch.column(n).combine_chunks()
    lengths, flat = _matrices(column("v"))
    starts = np.cumsum(lengths) - lengths
    row, label = column("row").to_numpy(zero_copy_only=False), column("label").to_numpy(zero_copy_only=False)
    ids = column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        out[int(n)] = Points(row[at], ids[at], label[at], flat[starts[at][:, None] + np.arange(n)[None, :]])
    return out


def _laid_out(rows: DataFrame, sample: pa.Table, n: int) -> DataFrame:
    """``rows`` with those that lie together in one place; rows of one leaf of the layout are split by their number."""
    by_length = _points(sample)
    places = max(1, -(-n // LAYOUT_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))
    depth = min(12, int(np.ceil(np.log2(places))))
    layouts = {k: Layout.fit(p.v, min(depth, int(np.log2(max(1, len(p) // 16) or 1)))) for k, p in by_length.items() if k}
    if not depth:
        return rows
    shared = rows.sparkSession.sparkContext.broadcast(layouts)

    @F.arrow_udf("long")
    def leaf(v: pa.Array) -> pa.Array:
        lengths, flat = _matrices(v)
        starts, out = np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.int64)
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            if size in shared.value:
                out[at] = shared.value[size].leaf(flat[starts[at][:, None] + np.arange(size)[None, :]])
        return pa.array(out)

    return rows.withColumn("leaf", leaf("v")).repartitionByRange(places, "leaf", "row").drop("leaf")


FOUND = "row long, slot int, score long, found_id long, found_row long"


def _searched(rows: DataFrame, trees: dict[int, tuple[Tree, Wish]], k: int, name: str) -> DataFrame:
    """The k best rows of every anchor and slot of the block, written."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {k: Best(w) for k, (_, w) in shared.value.items()}
        held, values = [], 0

        def look() -> None:
            for k, p in _points(pa.Table.from_batches(held)).items():
                if k in best:
                    search(shared.value[k][0], grow(p, LEAF), best[k])

        for batch in batches:
            held.append(batch)
            values += len(batch.column("v").flatten()) + batch.num_rows
            if values >= CHUNK_VALUES:
                look()
                held, values = [], 0
        if held:
            look()
        for k, b in best.items():
            at, slot, place = np.nonzero(b.score > -np.inf)
            ids = b.id[at, slot, place]
            cells = [shared.value[k][0].points.row[at], slot.astype(np.int32), b.score[at, slot, place].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cells), pa.array(ids, mask=ids == NO_ID), pa.array(b.row[at, slot, place])], ["row", "slot", "score", "found_id", "found_row"])

    out = written_at(_ranked(rows.mapInArrow(run, FOUND), k), name)[1]
    shared.unpersist()
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of an anchor and slot, with ``rank`` from 1: highest score, then smallest id. What a task found is k rows
    at most, so a group holds k rows a task."""
    order = F.struct((-F.col("score")).alias("s"), F.coalesce("found_id", F.lit(int(NO_ID))).alias("i"), F.col("found_row").alias("r"), F.col("found_id").alias("found_id"), F.col("score").alias("score"))
    best = found.groupBy("row", "slot").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("best"))
    return best.select("row", "slot", F.posexplode("best").alias("rank", "b")).select("row", "slot", (F.col("rank") + 1).cast("int").alias("rank"), "b.score", "b.found_id")


def _wished(trees: dict[int, Tree], sample: dict[int, Points], made) -> dict[int, tuple[Tree, Wish]]:
    """Wishes whose lower bounds are the k-th best of the sampled rows: what lies below them can't be among the best."""
    out = {}
    for k, tree in trees.items():
        wish = made(tree)
        if k in sample:
            best = Best(wish)
            search(tree, grow(sample[k], LEAF), best)
            wish = Wish(wish.k, wish.own, best.floor, wish.high)
        out[k] = (tree, wish)
    return out


def mine(df: DataFrame, is_anchor: Column, id: str = "vec_id", vector: str = "embedding", label: Column | str = "label", positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95), scale: int = SCALE) -> DataFrame:
    """For each anchor (a condition on df's columns; bounded blocks of them are looked up one after the other) and each of
    its first ``positives`` rows of its own label: the first ``negatives`` rows of other labels whose score is between the
    two per cents of the positive's. Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score;
    also positive_rank."""
    spark = df.sparkSession
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), label.cast("long").alias("label"), scaled(F.col(f"`{vector}`"), scale, LARGEST).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    first, rows = written_at(rows.filter("v IS NOT NULL AND label IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "vectors")
    counted = rows.agg(F.count("*").alias("n"), F.coalesce(F.count_if("anchor"), F.lit(0)).alias("anchors"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("longest")).first()
    longest = max(1, counted["longest"])
    most = max(64, SAMPLE_VALUES // longest)
    taken = rows if counted["n"] <= most else rows.sample(0.9 * most / counted["n"], seed=1).limit(most)
    taken = taken.select("row", "id", "label", "v").toArrow()  # ``most`` rows
    second, rows = written_at(_laid_out(rows, taken, counted["n"]), "laid-out")
    deleted(spark, first)
    sample, data = _points(taken), rows.select("row", "id", "label", "v")
    blocks = -(-counted["anchors"] // max(64, BLOCK_VALUES // longest))
    out = []
    for b in range(blocks):
        mine_ = rows.filter("anchor").filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "id", "label", "v").toArrow()
        trees = {k: grow(p, ANCHOR_LEAF) for k, p in _points(mine_).items()}
        every = lambda t: Wish(positives, True, np.full((len(t.points), 1), -np.inf), np.full((len(t.points), 1), np.inf))
        found = _searched(data, _wished(trees, sample, every), positives, "positives")
        scores = found.select("row", "rank", "score", "found_id").toArrow()  # ``positives`` rows an anchor of the block
        place = {k: np.argsort(t.points.row) for k, t in trees.items()}
        low, high = band

        def bounded(t: Tree, k: int) -> Wish:
            """Empty where an anchor has fewer positives."""
            lows, highs = np.full((len(t.points), positives), np.inf), np.full((len(t.points), positives), -np.inf)
            row, rank, score = (scores.column(c).to_numpy() for c in ("row", "rank", "score"))
            ordered = t.points.row[place[k]]
            at = np.minimum(np.searchsorted(ordered, row), len(ordered) - 1)
            here = ordered[at] == row
            at, slot, score = place[k][at[here]], rank[here] - 1, score[here]
            whole, rest = score // 100, score % 100
            lows[at, slot], highs[at, slot] = low * whole - (-low * rest // 100), high * whole + high * rest // 100
            return Wish(negatives, False, lows, highs)

        wished = {}
        for k, t in trees.items():
            wished |= _wished({k: t}, sample, lambda tree, k=k: bounded(tree, k))
        hard = _searched(data, wished, negatives, "negatives")
        positive = found.select("row", (F.col("rank") - 1).alias("slot"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
        anchor = rows.filter("anchor").select("row", F.col("id").alias("anchor_id"))
        out.append(hard.withColumnsRenamed({"score": "negative_score", "found_id": "negative_id"}).join(positive, ["row", "slot"]).join(anchor, "row"))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int")
    all_ = out[0]
    for part in out[1:]:
        all_ = all_.unionByName(part)
    return all_.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", (F.col("slot") + 1).alias("positive_rank"))


def op11(spark, sf_dir):
    """All vectors; anchors are the ids divisible by 50, labels of ids divisible by 7 are shifted by one first."""
    id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings"), id % 50 == 0, label=shifted)


ORACLE_SQL = f"""WITH k AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS own, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM k a JOIN k b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS positive_rank FROM s WHERE own),
n AS (SELECT p.*, other_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS k
 FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score WHERE positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score, CAST(positive_rank AS INTEGER) AS positive_rank FROM n WHERE k <= 3"""
