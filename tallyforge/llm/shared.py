"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: Bits of a bitmap, a prime.
PLACES = 33_554_393

#: A word: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``, or the folder set by
    ``setCheckpointDir``. Where neither is set, a session on one machine gets a temporary folder of its own, and one on a
    cluster an error, as its executors wouldn't see each other's files there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            folder = known.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            folder = "file://" + tempfile.mkdtemp(prefix="spark-tallyforge-")
            spark.sparkContext.setCheckpointDir(folder)
            folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tallyforge/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs neither repeat its work nor depend on the
    executors that did it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_at(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """As ``written``, with the path for ``deleted``."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later job reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bitmap(df: DataFrame, column: str):
    """A broadcast bitmap of PLACES bits (4 MB) in which each value (a long) of ``column`` has its bit set. However many
    values there are, it only spares work: what it lets through must still be looked up exactly."""
    placed = df.select(F.pmod(F.col(column), F.lit(PLACES)).alias("place")).selectExpr("place div 64 AS word", "shiftleft(1L, cast(place % 64 AS int)) AS bit")
    held = placed.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # a row for each of PLACES / 64 words at most
    words = np.zeros(PLACES // 64 + 1, np.uint64)
    words[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(words)


def in_bitmap(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values % PLACES
    return (words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def maybe_in(shared, value: Column) -> Column:
    """Whether a value's bit is set in a bitmap that ``bitmap`` made."""

    @F.arrow_udf(BooleanType())
    def found(values: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(shared.value, values.to_numpy(zero_copy_only=False)))

    return found(value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
