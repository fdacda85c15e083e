"""WARC archives: written by Spark's text sink, read back by byte ranges.

Writing: each record is one gzip member. Members are written as raw bytes by the text sink, whose line separator is
the byte 0; a member's last byte (the top byte of its size field) is 0 below 16 MiB and is then left to the separator,
and otherwise the separator is one byte of the padding that gzip readers skip. The sink's commit protocol makes
rewritten tasks safe. Part files are then renamed to ``*.warc.gz``.

Reading: the archives are cut into byte ranges of ``split_bytes``. A task scans its range for the gzip magic,
validates each candidate by inflating its first bytes and decoding the WARC version line, and owns every record that
starts inside, reading past the end of its range where the last one needs it. After a valid record it goes on behind
that record, so magic bytes within compressed data are only met at the start of a range, where they fail validation.

Defined cases: a null html is an empty payload; a null url has no target header; pages with a null id are written
without the id header and read back with a null id, and never serve as the response that others refer to; repeated
rows are records of their own; an empty table gives an empty archive and no rows. Payloads under ``MIN_SHARED`` bytes
are always whole responses. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.shared import bitmap, maybe_in, new_path, table, written

MIN_SHARED = 100
SPLIT_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
LEVEL = 4
READ_SCHEMA = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, file string, offset long"


def _member(page_id, url, html: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member. A revisit has no block, and names the payload's digest and length."""
    block = html if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if page_id is not None:
        head += [f"WARC-Record-ID: <urn:page:{page_id}>", f"X-Page-Id: {page_id}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(html)}", "Content-Type: text/html", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 256):
            rows = batch.slice(part, 256).to_pylist()
            made = [_member(r["page_id"], r["url"], r["html"], r["digest"], r["refers_to"]) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([m[:-1] if m[-1] == 0 else m for m in made], pa.binary())], ["member"])


def write_warc(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write one record for each row of ``pages``; return the folder of the archives. Of records with equal payloads
    of at least MIN_SHARED bytes the one with the smallest id is whole, the others are revisits of it."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("html"), F.sha2(body, 256).alias("digest"))
    firsts = rows.filter(F.octet_length("html") >= MIN_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = written(firsts.filter("n > 1").select("digest", "first", F.xxhash64("digest").alias("mark")), "warc-shared")
    shared = bitmap(firsts, "mark")
    marked = rows.withColumn("met", maybe_in(shared, F.xxhash64("digest")) & (F.octet_length("html") >= MIN_SHARED))
    # Only pages whose payload some other page has too are shuffled with it.
    met = marked.filter("met").join(firsts.select("digest", "first"), "digest", "left").withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first")))
    columns = ["page_id", "url", "html", "digest", "refers_to"]
    marked = marked.filter("NOT met").withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(met.select(columns))
    members = marked.mapInArrow(_members, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\u0000").option("compression", "none").text(path)
    _rename(spark, path)
    return path


def _rename(spark: SparkSession, path: str) -> None:
    """Give part files the archives' usual ending; the rest of their names stays, so no two get the same."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(target):
        name = status.getPath().getName()
        if name.startswith("part-"):
            to = spark._jvm.org.apache.hadoop.fs.Path(target, name.removesuffix(".txt") + ".warc.gz")
            if files.exists(to) or not files.rename(status.getPath(), to):
                raise OSError(f"{status.getPath()} can't be renamed to {to}")


class _Range:
    """Bytes of a file from ``start`` on, fetched as they are needed."""

    def __init__(self, file, start: int, end: int, size: int):
        self.file, self.at, self.size = file, start, size
        self.file.seek(start)
        self.data = bytearray(self.file.read(min(end + len(MAGIC) - 1, size) - start))  # grows in place

    def more(self) -> bool:
        got = self.file.read(1 << 16) if self.at + len(self.data) < self.size else b""
        self.data += got
        return bool(got)


def _record(span: _Range, offset: int) -> tuple[bytes, int] | None:
    """The inflated member that starts at ``offset`` in the range and where it ends; None if it is no WARC record."""
    inflate = zlib.decompressobj(31)
    try:
        out = inflate.decompress(span.data[offset : offset + 512])
        fed = min(len(span.data), offset + 512)
        while not inflate.eof and len(out) < 7:
            if fed == len(span.data) and not span.more():
                return None
            chunk = span.data[fed : fed + 512]
            fed += len(chunk)
            out += inflate.decompress(chunk)
        if not out.startswith(b"WARC/1."):
            return None
        pieces = [out]
        while not inflate.eof:
            if fed == len(span.data) and not span.more():
                return None
            chunk = span.data[fed : fed + (1 << 16)]
            fed += len(chunk)
            pieces.append(inflate.decompress(chunk))
    except zlib.error:
        return None
    return b"".join(pieces), fed - len(inflate.unused_data)


def _parsed(raw: bytes, name: str, offset: int) -> dict | None:
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    length = int(fields.get("Content-Length", len(rest)))
    kind, payload = fields.get("WARC-Type"), rest[:length]
    refers = fields.get("WARC-Refers-To", "").removeprefix("<urn:page:").rstrip(">")
    whole = kind == "response"
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "payload": payload if whole else None,
        "payload_bytes": len(payload) if whole else int(fields.get("X-Payload-Length", 0)),
        "payload_digest": hashlib.sha256(payload).hexdigest() if whole else fields.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
        "refers_to": int(refers) if kind == "revisit" and refers.isdigit() else None,
        "file": name,
        "offset": offset,
    }


def _records(path: str, size: int, start: int, end: int) -> Iterator[dict]:
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_file(inner) as file:
        span, at = _Range(file, start, end, size), 0
        while 0 <= (at := span.data.find(MAGIC, at)) < end - start:
            found = _record(span, at)
            row = _parsed(found[0], path, start + at) if found else None
            if row:
                yield row
            at = found[1] if row else at + 1
            if at > 4 << 20:  # drop what has been read, to keep a task's memory at a few members
                start, span.at, span.data, at = start + at, span.at + at, span.data[at:], 0


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the archives under ``path``, one row each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.filter("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, "length"))
    schema = spark.createDataFrame([], READ_SCHEMA).schema

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for task in batch.to_pylist():
                rows, held = [], 0
                for row in _records(_uri(task["path"]), task["length"], task["start"], task["end"]):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(tasks, "path", "start").mapInArrow(read, READ_SCHEMA)


def _uri(path: str) -> str:
    """Hadoop writes file:/x, Arrow reads file:///x."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def op8(spark, sf_dir):
    path = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_SHARED} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
