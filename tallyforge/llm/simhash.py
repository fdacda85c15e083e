"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits, from the XXH64 values of a text's word shingles. Two fingerprints are linked if they
differ in at most two bits. They are found by two tables over halves of 32 bits: of two such fingerprints either the
low halves are equal or the high halves differ in one bit at most. So each fingerprint asks the low table for its own
half and the high table for the Hamming ball of radius one around its half, and the whole distance of what they return is
verified. Only distinct fingerprints take part, so exact copies cost one comparison however many there are.

Where a half is shared by more than ``HOT_BUCKET`` fingerprints, those that ask for it look up their whole Hamming
ball of radius two (2,081 exact keys) instead, so no bucket is ever paired up with itself and no link is lost.

Links by similarity (``keep_one``): documents are linked if they share at least ``SIMILARITY`` of their distinct
``WIDTH``-word shingles (Jaccard). Each shingle's hash gives a signed byte for each bit of a long fingerprint, which is set
if their sum is positive; of SEGMENTS x SEGMENT_BITS bits such documents' fingerprints differ in up to 15 %. That is far
for a segment, so there are many and short ones, and the ball around a segment is spanned by its ``SOFT`` least certain
bits, those whose sums are nearest to zero: a segment enters the tables under each of its 8 values, and two segments meet
if they differ in such bits of either only. What meets is verified by the complete distance, then by the shingles
themselves. A pair of similarity 0.8 is met with a chance of 0.96, one of 0.85 of 0.997, whatever the number of documents.
SEGMENT_BITS suits up to 30 million different texts or so (unrelated ones then rarely meet); for each doubling beyond, a
bit more in a segment and a tenth more segments keep both.

Only groups are asked for, so texts that are in one group already aren't compared with each other. Of the texts that
share table entries with two others or more, those shingles are counted that another of them has: two texts can't have more
in common than either has with all, so a text with too few is compared with none of them, and a pair with too few isn't
compared. The first and the last text of each entry are compared, of ``FIRST`` segments first and then of the others; of
entries with more, one text of each group that has any there with the one of these that has the greatest share in common
with others, in ``STARS`` rounds: the text that a group's others were made from has all in common, and meets them first. The
texts whose entries then still hold different groups meet by their rarest shingles: two similar ones share one of these,
and what many texts have in common isn't among them. So a large group of near copies, or a passage that many texts
hold, costs few comparisons, and no link that can be is left out.

Defined cases: a null or blank text has fingerprint zero, which links like any other; repeated rows and equal texts
share a fingerprint and so a component; null ids belong to components but don't name them, unless all ids of a
component are null, whose id is then null; an empty table gives an empty result. Of the input only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tallyforge.llm.components import components
from tallyforge.llm.shared import bitmap, in_bitmap, maybe_in, table, written

SHINGLE = 3
SEED = 42
HOT_BUCKET = 256
WIDTH = 5
SIMILARITY = 0.8
SEGMENTS, SEGMENT_BITS, SOFT = 20, 28, 3
SOFT_AT = 33  # bit from which on a segment's word has the places of its least certain bits
FIRST, STARS = 2, 1
#: Shingles in more texts than RARE, up to FREQUENT of them, stand last in the order by which texts meet.
RARE, FREQUENT = 4, 500_000
SALTS = np.random.default_rng(SEED).integers(0, 1 << 63, SEGMENTS * SEGMENT_BITS // 8, np.int64).astype(np.uint64)
SKETCH = StructType([StructField("fp", LongType()), StructField("segs", ArrayType(LongType()))])
NAMES = ["k_null", "k_id", "k_text"]
#: All words with one or two of 64 bits set.
BALL = [0] + [1 << i for i in range(64)] + [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())


def fingerprint_column(text: Column) -> Column:
    return _fingerprints(text.cast("string"))


def _unsigned_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame) -> DataFrame:
    """``fps``: distinct longs in column fp. Rows (a, b) of fingerprints at distance one or two."""
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    kept = fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key")))).alias("k"))
    kept = kept.select("fp", "k.seg", "k.key")
    # Of two halves that differ in bit i, the one without it asks: each pair is met once.
    one_bit = F.array(*[F.lit(1 << i) for i in range(32)])
    ball = F.concat(F.array(F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key"))),
                    F.transform(F.filter(one_bit, lambda b: high.bitwiseAND(b) == 0), lambda b: F.struct(F.lit(0).alias("seg"), high.bitwiseOR(b).alias("key"))))
    asked = fps.select("fp", F.explode(ball).alias("k")).select(F.col("fp").alias("asks"), "k.seg", "k.key")
    hot = kept.groupBy("seg", "key").count().filter(F.col("count") > HOT_BUCKET).select("seg", "key")
    pairs = asked.join(hot, ["seg", "key"], "left_anti").join(kept, ["seg", "key"]).select(F.col("asks").alias("a"), F.col("fp").alias("b"))
    pairs = pairs.filter("a != b AND bit_count(a ^ b) <= 2")
    crowded = asked.join(hot, ["seg", "key"], "left_semi").select("asks").distinct()
    flips = F.explode(F.array(*[F.lit(_as_long(m)).cast("long") for m in BALL[1:]])).alias("flip")
    around = crowded.select(F.col("asks").alias("a"), flips).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("fp"))
    met = around.join(fps, "fp").select("a", F.col("fp").alias("b"))
    return pairs.union(met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def fingerprint_groups(marked: DataFrame) -> DataFrame:
    """``marked``: rows (doc_id, fp). One row for each distinct fingerprint: fp, root (that of its component),
    component_id."""
    known = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(known.select("fp")), "simhash-links").withColumnRenamed("node", "fp")
    rooted = known.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(named, "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 hex digits), component_id."""
    marked = written(docs.select(F.col(doc_id).alias("doc_id"), fingerprint_column(F.col(text)).alias("fp")), "simhash")
    found = marked.join(fingerprint_groups(marked), "fp")
    return found.select("doc_id", _unsigned_text(F.col("fp")).alias("fingerprint"), "component_id")


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; those of a text with fewer words are one, a blank text has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in parts), np.uint64))


def segments(hashes: np.ndarray) -> np.ndarray:
    """The long fingerprint of a set of hashes: for each segment its bits, above them its number, and from SOFT_AT on the
    places of its least certain bits."""
    even, sums = np.uint64(0x00FF00FF00FF00FF), np.zeros((2, 4 * len(SALTS)), np.int64)
    for at in range(0, len(hashes), 256):
        mixed = (hashes[at : at + 256, None] ^ SALTS) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        for k in range(2):  # four bytes at a time, 256 of which fit in 16 bits
            sums[k] += (mixed >> np.uint64(8 * k) & even).sum(axis=0).view(np.uint16)
    votes = (2 * sums - 255 * len(hashes)).reshape(SEGMENTS, SEGMENT_BITS)
    soft = np.argsort(np.abs(votes), axis=1, kind="stable")[:, :SOFT] << 5 * np.arange(SOFT)
    return (votes > 0) @ (1 << np.arange(SEGMENT_BITS)) + (np.arange(SEGMENTS) << SEGMENT_BITS) + (soft.sum(axis=1) << SOFT_AT)


def _sketched(width: int):
    @F.arrow_udf(SKETCH)
    def sketched(texts: pa.Array) -> pa.Array:
        fps, found = [], []
        for t in texts:
            hashes = shingles(t.as_py(), width)
            fps.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0)
            found.append(segments(hashes))
        offsets = pa.array(np.arange(len(fps) + 1) * SEGMENTS, pa.int32())
        flat = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
        return pa.StructArray.from_arrays([pa.array(np.array(fps, np.uint64).view(np.int64)), pa.ListArray.from_arrays(offsets, flat)], ["fp", "segs"])

    return sketched


def _sets(width: int):
    """Shingles by 32 bits of their hashes, of which a text has hardly ever two alike."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([np.unique((shingles(t.as_py(), width) >> np.uint64(32)).astype(np.uint32)).view(np.int32) for t in texts], pa.list_(pa.int32()))

    return sets


def _entries(sketches: DataFrame) -> DataFrame:
    """(key, fp): the entries of each text's segments."""
    each = sketches.select("fp", F.explode("segs").alias("seg")).select("fp", "seg", F.explode(F.array(*[F.lit(j).cast("long") for j in range(1 << SOFT)])).alias("j"))
    flips = " ^ ".join(f"shiftleft(shiftright(j, {i}) & 1, cast(shiftright(seg, {SOFT_AT + 5 * i}) & 31 AS int))" for i in range(SOFT))
    return each.selectExpr(f"(seg & {(1 << SOFT_AT) - 1}) ^ {flips} AS key", "fp")


def _entries_in(shared):
    """The keys of a text's entries that a bitmap lets through."""

    @F.arrow_udf(ArrayType(LongType()))
    def entries(segs: pa.Array) -> pa.Array:
        j, out = np.arange(1 << SOFT), []
        for at in range(0, len(segs), 500):
            own = segs.slice(at, 500).flatten().to_numpy(zero_copy_only=False).reshape(-1, SEGMENTS, 1)
            keys = own & (1 << SOFT_AT) - 1
            for i in range(SOFT):
                keys = keys ^ (j >> i & 1) << (own >> SOFT_AT + 5 * i & 31)
            keys = keys.reshape(len(own), -1)
            good = in_bitmap(shared.value, keys)
            out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(good.sum(axis=1))), pa.int32()), pa.array(keys[good])))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))

    return entries


def _any_in(shared):
    """Whether a bitmap lets any of a text's keys through."""

    @F.arrow_udf(BooleanType())
    def found(keys: pa.Array) -> pa.Array:
        return pa.array([bool(in_bitmap(shared.value, x.values.to_numpy(zero_copy_only=False)).any()) for x in keys], pa.bool_())

    return found


def _heads(shared, similarity: float):
    """The first shingles of each text, of which similar ones share one. ``shared``: frequent shingles and their counts."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def heads(sets: pa.Array) -> pa.Array:
        hashes, counts = shared.value
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
        out = []
        for x in sets:
            own = x.values.to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
            often = np.where(hashes[at] == own, counts[at], 0) if len(hashes) else np.zeros(len(own), np.int64)
            first = len(own) - int(np.ceil(len(own) * similarity - 1e-9)) + 1
            out.append(own[np.lexsort((own, often))[:first]])
        return pa.array(out, pa.list_(pa.int32()))

    return heads


class _Verifier:
    """Verifies pairs of texts: by the complete distance of their fingerprints, then by their shingles, which are made for
    such texts only."""

    def __init__(self, sketches: DataFrame, rows: DataFrame, best: DataFrame, width: int, similarity: float):
        """``rows``: (mark, NAMES, text); ``best``: (fp, mark, NAMES), one row for each fp."""
        self.sketches, self.rows, self.best, self.width, self.similarity = sketches, rows, best, width, similarity
        # The share of bits in which fingerprints of just similar sets differ, and five standard deviations more.
        share, n = np.arccos(2 * similarity / (1 + similarity)) / np.pi, SEGMENTS * SEGMENT_BITS
        self.radius = int(n * share + 5 * np.sqrt(n * share * (1 - share)))
        self.sets: DataFrame | None = None

    def make(self, fps: DataFrame) -> None:
        """Make the shingles of those texts that have none yet."""
        wanted = fps if self.sets is None else fps.join(self.sets, "fp", "left_anti")
        wanted = written(self.best.join(wanted, "fp"), "simhash-wanted")
        if not wanted.isEmpty():
            marks = bitmap(wanted, "mark")
            met = self.rows.filter(maybe_in(marks, F.col("mark"))).join(wanted.drop("mark"), NAMES)
            texts = met.groupBy("fp").agg(F.first("text").alias("text"))
            made = written(texts.select("fp", _sets(self.width)(F.col("text")).alias("hashes")), "simhash-sets")
            marks.destroy()
            self.sets = made if self.sets is None else self.sets.union(made)

    def by_rare_shingles(self, texts: DataFrame) -> DataFrame:
        """``texts``: rows (fp, root). Pairs (a, b) of different roots, among them all that are similar: if shingles are put in
        one order, two similar texts share one of their first n - similarity * n + 1. In the order used the FREQUENT most
        frequent stand last (any order is right), so those that only share a frequent passage don't meet. Of each shingle
        the texts of its largest group meet the others only."""
        self.make(texts.select("fp"))
        own = written(self.sets.join(texts, "fp").select("fp", "root", "hashes"), "simhash-open")
        counts = own.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("f")).filter(f"f > {RARE}")
        frequent = counts.orderBy(F.desc("f"), "hash").limit(FREQUENT).toArrow()  # FREQUENT rows at most
        shared = own.sparkSession.sparkContext.broadcast((frequent["hash"].to_numpy(), frequent["f"].to_numpy()))
        heads = own.select("fp", "root", F.size("hashes").alias("n"), F.posexplode(_heads(shared, self.similarity)(F.col("hashes"))).alias("at", "hash"))
        # ``left``: how many of a text's shingles stand behind this one
        heads = written(heads.select("fp", "root", "n", "hash", (F.col("n") - F.col("at") - 1).alias("left")), "simhash-heads")
        shared.destroy()
        groups = heads.groupBy("hash", "root").agg(F.count("*").alias("rows")).groupBy("hash").agg(F.count("*").alias("roots"), F.max_by("root", F.struct("rows", "root")).alias("main"))
        rest = heads.join(groups.filter("roots > 1").select("hash", "main"), "hash").filter("root != main")
        rest = rest.select("hash", F.col("fp").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"))
        both = rest.join(heads.withColumnRenamed("fp", "b"), "hash").filter("root_a != root")
        return both.filter(self.fits(F.col("n_a"), F.col("n"), 1 + F.col("left_a"), 1 + F.col("left"))).select("a", "b")

    def fits(self, n_a: Column, n_b: Column, most_a: Column, most_b: Column) -> Column:
        """Whether sets of these sizes can be similar, if they have no more in common than either has at ``most``."""
        need = self.similarity / (1 + self.similarity) * (n_a + n_b) - 1e-9
        return (F.least(n_a, n_b) >= self.similarity * F.greatest(n_a, n_b) - 1e-9) & (F.least(most_a, most_b) >= need)

    def bounds(self, fps: DataFrame) -> DataFrame:
        """``fps``: distinct texts. Rows (fp, n, common): its shingles, and how many of them another of these texts has."""
        self.make(fps)
        own = self.sets.join(fps, "fp")
        each = own.select("fp", F.explode("hashes").alias("hash"))
        shared = each.groupBy("hash").agg(F.count("*").alias("f")).filter("f > 1").select("hash")
        common = each.join(shared, "hash").groupBy("fp").agg(F.count("*").alias("common"))
        return own.select("fp", F.size("hashes").alias("n")).join(common, "fp", "left").select("fp", "n", F.coalesce("common", F.lit(0)).alias("common"))

    def __call__(self, pairs: DataFrame) -> DataFrame | None:
        side = lambda c: self.sketches.select(F.col("fp").alias(c), F.col("segs").alias(f"s_{c}"))
        apart = F.expr(f"aggregate(zip_with(s_a, s_b, (x, y) -> bit_count((x ^ y) & {(1 << SOFT_AT) - 1})), 0, (n, x) -> n + x)")
        near = pairs.join(side("a"), "a").join(side("b"), "b").filter(apart <= self.radius).select("a", "b")
        near = written(near, "simhash-near")
        self.make(near.select(F.col("a").alias("fp")).union(near.select("b")).distinct())
        if self.sets is None:
            return None
        side = lambda c: self.sets.select(F.col("fp").alias(c), F.col("hashes").alias(f"h_{c}"))
        both = F.size(F.array_intersect("h_a", "h_b"))
        fits = F.least(F.size("h_a"), F.size("h_b")) >= self.similarity * F.greatest(F.size("h_a"), F.size("h_b"))
        found = near.join(side("a"), "a").join(side("b"), "b").filter(fits)
        found = found.filter(both >= self.similarity * (F.size("h_a") + F.size("h_b") - both)).select("a", "b")
        found = written(found, "simhash-similar")
        return None if found.isEmpty() else found


def similar_groups(sketches: DataFrame, verify: _Verifier) -> DataFrame | None:
    """``sketches``: rows (fp, segs), one for each text. Rows (node, root) of the texts that are linked to others; None
    if there are no links."""
    ordered = lambda pairs: pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    spread = sketches.repartition(int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few rows become many
    buckets = _entries(spread).groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    buckets = written(buckets, "simhash-buckets")
    links = roots = members = None
    larger, first = buckets.filter("n > 2").select("key"), buckets.filter("n = 2").select("key", "a", "b")
    crowded = not larger.isEmpty()
    if crowded:
        keys = bitmap(larger, "key")
        members = sketches.select("fp", _entries_in(keys)(F.col("segs")).alias("keys"))  # and a few others by chance
        members = written(members.filter(F.size("keys") > 0), "simhash-members")
        keys.destroy()
        bounds = written(verify.bounds(members.select("fp")), "simhash-bounds")
        side = lambda c: bounds.select(F.col("fp").alias(c), F.col("n").alias(f"n_{c}"), F.col("common").alias(f"common_{c}"))
        can = verify.fits(F.col("n_a"), F.col("n_b"), F.col("common_a"), F.col("common_b"))
        first = first.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(F.coalesce(can, F.lit(True))).select("key", "a", "b")
        able = bounds.filter(F.col("common") >= verify.similarity * F.col("n") - 1e-9)
        # ``text`` compares by the share in common
        share = F.coalesce(F.col("common") / F.col("n"), F.lit(0.0))
        members = members.join(able, "fp").select("fp", "keys", F.struct(share.alias("share"), F.xxhash64("fp").alias("mark"), "fp", "n", "common").alias("text"))
        members = written(members, "simhash-able")
        fits = lambda a, b: verify.fits(F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.common"), F.col(f"{b}.common"))
        ends = members.select("text", F.explode("keys").alias("key")).groupBy("key").agg(F.min_by("text", "text.fp").alias("a"), F.max_by("text", "text.fp").alias("b")).filter("a.fp != b.fp")
        first = written(first.union(ends.filter(fits("a", "b")).select("key", "a.fp", "b.fp")), "simhash-ends")
    for segment in (f"key < {FIRST << SEGMENT_BITS}", f"key >= {FIRST << SEGMENT_BITS}"):
        pairs = ordered(first.filter(segment))
        if roots:
            side = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r_{c}"))  # noqa: B023, E731
            pairs = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").filter("coalesce(r_a, a) != coalesce(r_b, b)").select("a", "b")
        found = verify(written(pairs, "simhash-pairs"))
        if found:
            links = found if links is None else links.union(found)
            roots = components(links, "simhash-stars")
    for k in range(STARS + 1) if crowded else ():
        with_root = lambda df: (df.join(roots.withColumnRenamed("node", "fp"), "fp", "left") if roots else df.withColumn("root", F.col("fp"))).withColumn("root", F.coalesce("root", "fp"))  # noqa: B023, E731
        if k == 0:
            rooted = with_root(members).select("root", "text", F.explode("keys").alias("key"))
        else:  # groups only grow, so one text of each that an entry had tells those that it has now
            rooted = with_root(rooted.select("key", "text", "text.fp"))
        rooted = written(rooted.groupBy("key", "root").agg(F.max("text").alias("text")), "simhash-rooted")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.struct("text", "root")).alias("hub")).filter("low != high")
        if k < STARS:
            met = rooted.join(mixed.select("key", F.col("hub.root").alias("other"), F.col("hub.text").alias("hub")), "key").filter("root != other")
            pairs = met.filter(fits("text", "hub")).select(F.col("text.fp").alias("a"), F.col("hub.fp").alias("b"))
        else:
            keys = bitmap(mixed, "key")
            texts = written(with_root(members.filter(_any_in(keys)(F.col("keys")))).select("fp", "root"), "simhash-texts")  # and a few others by chance
            keys.destroy()
            pairs = verify.by_rare_shingles(texts)
        pairs = written(ordered(pairs), "simhash-pairs")
        found = None if pairs.isEmpty() else verify(pairs)
        if found:
            links = found if links is None else links.union(found)
            roots = components(links, "simhash-stars")
    return roots


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of each group linked by similarity the row with the smallest id stays (null ids
    last; among rows of that id the one with the smallest text hash, once if it is repeated). All columns are kept; a
    text of fewer than ``width`` words is one shingle, and blank texts are copies of each other."""
    key = [F.col(doc_id).isNull(), F.coalesce(F.col(doc_id), F.lit(0).cast(docs.schema[doc_id].dataType)), F.xxhash64(F.coalesce(F.col(text), F.lit("")))]
    columns = [c.alias(n) for c, n in zip(key, NAMES)] + [F.xxhash64(*key).alias("mark")]
    marked = docs.select(*columns, _sketched(width)(F.col(text).cast("string")).alias("s")).select(*NAMES, "mark", "s.*")
    marked = written(marked, "simhash-sketches")
    best = written(marked.groupBy("fp").agg(F.min(F.struct(*NAMES, "mark", "segs")).alias("best")).select("fp", "best.*"), "simhash-first")
    rows = docs.select(*columns, F.col(text).cast("string").alias("text"))
    sketches, best = best.select("fp", "segs"), best.select("fp", *NAMES, "mark")
    roots = similar_groups(sketches, _Verifier(sketches, rows, best, width, similarity))
    if roots:
        grouped = best.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        best = grouped.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(F.struct(*NAMES)).alias("best")).select("best.*")
    counted = marked.groupBy(*NAMES, "mark").agg(F.count("*").alias("n"))
    decided = counted.join(best.select(*NAMES, F.lit(True).alias("stays")), NAMES, "left").withColumn("stays", F.coalesce("stays", F.lit(False)))
    doubtful = written(decided.filter("NOT stays OR n > 1"), "simhash-doubtful")
    # Rows that surely stay aren't shuffled.
    packed = docs.select(F.struct("*").alias("doc"), *columns).withColumn("met", maybe_in(bitmap(doubtful, "mark"), F.col("mark")))
    met = packed.filter("met").join(doubtful.select(*NAMES, "stays"), NAMES, "left").filter("stays IS NULL OR stays")
    return packed.filter("NOT met").select("doc.*").union(met.dropDuplicates(NAMES).select("doc.*"))


def op1(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
