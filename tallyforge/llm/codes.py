"""Vector codes by product quantization: exact Lloyd rounds in which heaps tell which parts have to be looked at.

Vectors are cut into equal consecutive parts, each with a codebook of its own. A part keeps two bounds from the round in
which it was last looked at: an upper one on the distance to its entry and a lower one on that to any other. When entries
move, a part of entry ``e`` loses at most the drift of ``e`` plus the largest drift of another entry between the two. So
every chunk of rows has a heap for each position and entry, keyed by lower minus upper bound plus what ``e``'s parts had
lost until then; a round pops the parts whose key the cumulative drift has reached, and only those are measured against
all entries again. Entries' sums change by what moved. The result equals that of measuring everything in each round.

Chunks of up to CHUNK rows hold their vectors and heaps as binary columns. A round reads and writes the table of chunks in
the shared folder, so a lost executor costs its tasks of that round only; the table of the round before is deleted. What
reaches the driver are codebooks and their sums, whatever the rows.

Defined cases: rows with a null vector or a null or non-finite component are dropped. Scaled components are held within
+-2^24, so that squared errors stay in a long. Vectors shorter than the longest one are filled up with zeros, and all to
a multiple of the number of parts. The codebook starts from the smallest different ids (of rows with one id the smallest
vector); rows without an id are coded but start none; where there are fewer ids than entries the codebook is that much
smaller; without any id, all entries' places stay empty and nothing is returned. Repeated rows are coded each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import deleted, table, written_at

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows of a chunk, and the most values that it may hold.
CHUNK, CHUNK_VALUES = 4096, 1 << 20
#: Scaled components are held within this.
LARGEST = 1 << 24
#: Keys are taken for reached a little early, for rounding.
SLACK = 1e-6


def scaled(vector: Column, scale: int, largest: int = LARGEST) -> Column:
    """floor(scale * x) of each component as long, held within +-largest; null unless all components are finite numbers."""
    x = F.transform(vector, lambda v: F.floor(F.least(F.greatest(v.cast("double") * scale, F.lit(-float(largest))), F.lit(float(largest)))))
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return F.when(fine, x)


@dataclass
class Books:
    """Codebooks (parts x entries x width), and how far each entry has moved so far and each part's heap has lost."""

    entries: np.ndarray
    lost: np.ndarray  # parts x entries: cumulative drift plus the others' largest


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, rows by entries; exact in 64-bit integers."""
    out = np.empty((len(x), len(entries)), np.int64)
    for j, e in enumerate(entries):
        d = x - e
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def _keyed(x: np.ndarray, entries: np.ndarray, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, key): the key is the slack between the second nearest and the nearest, plus what the entry has lost."""
    d = _distances(x, entries)
    code = d.argmin(axis=1)  # of equals the lowest
    if len(entries) == 1:
        return code, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
    return code, two[:, 1] - two[:, 0] + lost[code]


class Heaps:
    """The heaps of one position: for each entry its rows and their keys, ascending (an ascending array is a heap)."""

    def __init__(self, rows: list[np.ndarray], keys: list[np.ndarray]):
        self.rows, self.keys = rows, keys

    @classmethod
    def empty(cls, entries: int) -> Heaps:
        return cls([np.empty(0, np.int32)] * entries, [np.empty(0, np.float64)] * entries)

    def pop(self, lost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their entries) whose keys the loss has reached."""
        rows, codes = [], []
        for e, reached in enumerate(lost):
            n = int(np.searchsorted(self.keys[e], reached + SLACK * (1 + abs(reached)), side="right"))
            rows.append(self.rows[e][:n])
            codes.append(np.full(n, e, np.int64))
            self.rows[e], self.keys[e] = self.rows[e][n:], self.keys[e][n:]
        return np.concatenate(rows), np.concatenate(codes)

    def push(self, rows: np.ndarray, codes: np.ndarray, keys: np.ndarray) -> None:
        for e in np.unique(codes):
            mine = codes == e
            order = np.argsort(keys[mine], kind="stable")
            new_rows, new_keys = rows[mine][order], keys[mine][order]
            at = np.searchsorted(self.keys[e], new_keys)
            self.rows[e], self.keys[e] = np.insert(self.rows[e], at, new_rows), np.insert(self.keys[e], at, new_keys)

    def codes(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.uint8)
        for e, rows in enumerate(self.rows):
            out[rows] = e
        return out


#: A chunk: its ids with labels, vectors, heaps (rows and keys by position and entry, and how many), what its last round
#: moved (sums and counts), how many parts that round measured, and how many rows it has.
CHUNK_TYPES = {"n": pa.int32()} | dict.fromkeys(("ids", "vectors", "rows", "keys", "sizes", "sums", "counts"), pa.binary()) | {"measured": pa.int64()}
CHUNK_SCHEMA = "n int, ids binary, vectors binary, rows binary, keys binary, sizes binary, sums binary, counts binary, measured long"


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _unpack(row: dict, parts: int, entries: int) -> tuple[np.ndarray, list[Heaps]]:
    n = row["n"]
    x = np.frombuffer(row["vectors"], np.int32).reshape(n, parts, -1)
    if row["sizes"] is None:
        return x, [Heaps.empty(entries) for _ in range(parts)]
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int32))
    rows = np.split(np.frombuffer(row["rows"], np.int32), ends)[:-1]
    keys = np.split(np.frombuffer(row["keys"], np.float64), ends)[:-1]
    return x, [Heaps(rows[p * entries : (p + 1) * entries], keys[p * entries : (p + 1) * entries]) for p in range(parts)]


def advance(row: dict, books: Books) -> dict:
    """One round over a chunk: what its heaps give up is measured against all entries and put back."""
    parts, entries, width = books.entries.shape
    x, heaps = _unpack(row, parts, entries)
    first = row["sizes"] is None
    sums, counts, measured = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), 0
    for p, heap in enumerate(heaps):
        rows, old = (np.arange(len(x), dtype=np.int32), None) if first else heap.pop(books.lost[p])
        if not len(rows):
            continue
        part = x[rows, p].astype(np.int64)
        code, key = _keyed(part, books.entries[p], books.lost[p])
        heap.push(rows, code, key)
        measured += len(rows)
        moved = np.ones(len(rows), bool) if first else code != old
        np.add.at(sums[p], code[moved], part[moved])
        np.add.at(counts[p], code[moved], 1)
        if not first:
            np.subtract.at(sums[p], old[moved], part[moved])
            np.subtract.at(counts[p], old[moved], 1)
    flat = lambda name, kind: np.concatenate([a for h in heaps for a in getattr(h, name)]).astype(kind).tobytes()
    sizes = np.array([len(a) for h in heaps for a in h.rows], np.int32).tobytes()
    return row | {"rows": flat("rows", np.int32), "keys": flat("keys", np.float64), "sizes": sizes, "sums": sums.tobytes(), "counts": counts.tobytes(), "measured": measured}


def _chunked(rows: DataFrame, width: int) -> DataFrame:
    """Rows (id, label, v) as chunks, made within each partition."""
    most = max(1, min(CHUNK, CHUNK_VALUES // width))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out(batch: pa.Table) -> pa.RecordBatch:
            v = batch.column("v").combine_chunks()
            x = np.zeros((batch.num_rows, width), np.int32)
            sizes = v.value_lengths().to_numpy(zero_copy_only=False)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x[np.repeat(np.arange(len(sizes)), sizes), at] = v.flatten().to_numpy(zero_copy_only=False)
            sink = pa.BufferOutputStream()
            own = batch.select(["id", "label"])
            with pa.ipc.new_stream(sink, own.schema) as w:
                w.write_table(own)
            empty = [pa.array([None], pa.binary())] * 5
            cells = [pa.array([batch.num_rows], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), *empty, pa.array([0], pa.int64())]
            return pa.RecordBatch.from_arrays(cells, list(CHUNK_TYPES))

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= most:
                all_ = pa.Table.from_batches(held)
                yield out(all_.slice(0, most))
                held, n = all_.slice(most).to_batches(), n - most
        if n:
            yield out(pa.Table.from_batches(held))

    return rows.mapInArrow(pack, CHUNK_SCHEMA)


def _advanced(chunks: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_by_one(batches):
            made = advance(row, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([made[k]], kind) for k, kind in CHUNK_TYPES.items()], list(CHUNK_TYPES))

    return chunks.mapInArrow(run, CHUNK_SCHEMA)


def _moved(chunks: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Changes of sums and counts over all chunks: added up within partitions, then by place. Reads two columns."""
    parts, entries, width = shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(parts * entries * width, np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums += np.frombuffer(s, np.int64)
                counts += np.frombuffer(c, np.int64)
        both = np.concatenate([sums, counts])
        at = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(both[at])], ["place", "value"])

    total = chunks.select("sums", "counts").mapInArrow(add, "place int, value long").groupBy("place").agg(F.sum("value").alias("value")).toArrow()  # parts x entries x (width + 1) rows
    out = np.zeros(parts * entries * (width + 1), np.int64)
    out[total["place"].to_numpy()] = total["value"].to_numpy()
    return out[: parts * entries * width].reshape(shape), out[parts * entries * width :].reshape(parts, entries)


def _start(rows: DataFrame, entries: int, parts: int, width: int) -> np.ndarray:
    """The first codebooks: the vectors of the smallest different ids."""
    ids = [r["id"] for r in rows.filter("id IS NOT NULL").select("id").distinct().orderBy("id").limit(entries).collect()]
    found = rows.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect() if ids else []  # ``entries`` rows
    x = np.zeros((len(found), width), np.int64)
    for i, r in enumerate(found):
        x[i, : len(r["v"])] = r["v"]
    return x.reshape(len(found), parts, width // parts).transpose(1, 0, 2).copy()


@dataclass
class Coded:
    """``rows``: (id, label, code, error), and the final codebooks, parts x entries x width; how many parts each round
    measured."""

    rows: DataFrame
    entries: np.ndarray
    measured: list[int]

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Coded:
    """Codes of all rows with ``parts`` codebooks of up to ``entries`` (256 at most) entries after ``rounds`` rounds."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), scaled(F.col(f"`{vector}`"), scale).alias("v")).filter("v IS NOT NULL")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    width = -(-max(longest, 1) // parts) * parts
    start = _start(rows, entries, parts, width)
    schema = rows.select("id", "label").schema.add("code", "string").add("error", "long")
    if not start.shape[1]:
        return Coded(spark.createDataFrame([], schema), start, [])
    books = Books(start, np.zeros(start.shape[:2]))
    path, chunks = written_at(_chunked(rows, width), "codes")
    sums, counts, measured = np.zeros(start.shape, np.int64), np.zeros(start.shape[:2], np.int64), []
    for turn in range(rounds + 1):
        shared = spark.sparkContext.broadcast(books)
        old, (path, chunks) = path, written_at(_advanced(chunks, shared), "codes")
        deleted(spark, old)
        shared.unpersist()
        measured.append(chunks.agg(F.sum("measured")).first()[0] or 0)
        if turn < rounds:
            more, n = _moved(chunks, start.shape)
            sums, counts = sums + more, counts + n
            books = _updated(books, sums, counts)
    return Coded(_unpacked(chunks, books.entries, schema), books.entries, measured)


def _updated(books: Books, sums: np.ndarray, counts: np.ndarray) -> Books:
    """Entries become the floors of their parts' means, unused ones stay; each heap loses its entry's drift and the
    largest of the others'."""
    used = counts > 0
    new = np.where(used[:, :, None], sums // np.maximum(counts, 1)[:, :, None], books.entries)
    drift = np.sqrt(((new - books.entries) ** 2).sum(axis=2).astype(np.float64))
    others = np.zeros_like(drift)
    if drift.shape[1] > 1:
        order = np.sort(drift, axis=1)
        others[:] = order[:, -1:]
        others[np.arange(len(drift)), drift.argmax(axis=1)] = order[:, -2]
    return Books(new, books.lost + drift + others)


def _unpacked(chunks: DataFrame, entries: np.ndarray, schema) -> DataFrame:
    """A row for each coded vector: the codes from the heaps, the errors measured."""
    parts = len(entries)
    shared = chunks.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for row in _one_by_one(batches):
            x, heaps = _unpack(row, parts, books.shape[1])
            codes = np.stack([h.codes(row["n"]) for h in heaps], axis=1)
            d = x - books[np.arange(parts)[None, :], codes]
            text = codes.tobytes().hex()
            made = pa.ipc.open_stream(row["ids"]).read_all()
            made = made.append_column("code", pa.array([text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)], pa.string()))
            yield from made.append_column("error", pa.array(np.einsum("npw,npw->n", d, d), pa.int64())).to_batches()

    return chunks.select("n", "ids", "vectors", "rows", "keys", "sizes").mapInArrow(run, schema)


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``label_error``: the errors of a label's rows summed up, null labels together. Sums are made before the shuffle and
    met by key, so a frequent label is no hot key of the sum; of the join it is split by adaptive execution."""
    sums = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def op12(spark, sf_dir):
    """All vectors: 8 parts, 16 entries, 6 rounds."""
    made = encode(table(spark, sf_dir, "embeddings"))
    return with_label_error(made.rows).select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(made.digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds as a chain of relations: places (row, part, vector), and each round's codebooks and codes."""
    width = f"len(v) // {PARTS}"
    sq = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [
        f"k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, part, v[part * ({width}) + 1 : (part + 1) * ({width})] AS v FROM k, (SELECT unnest(range({PARTS})) AS part))",
        f"c0 AS MATERIALIZED (SELECT part, e, v FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, part, v, x.e AS e, x.d AS d FROM (SELECT p.vec_id, p.part, any_value(p.v) AS v, min(struct_pack(d := {sq}, e := c.e)) AS x FROM p JOIN c{r} c ON p.part = c.part GROUP BY p.vec_id, p.part))")
        if r < ROUNDS:
            ctes.append(f"m{r} AS MATERIALIZED (SELECT part, e, list(q ORDER BY i) AS v FROM (SELECT part, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS q FROM (SELECT part, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{r}) GROUP BY part, e, i) GROUP BY part, e)")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON c.part = m.part AND c.e = m.e)")
    last = f"a{ROUNDS}"
    return f"""WITH {', '.join(ctes)}, s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{ROUNDS}),
o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY vec_id)
SELECT o.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN k USING (vec_id), s"""


ORACLE_SQL = _oracle()
