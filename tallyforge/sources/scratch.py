"""Tables that a job keeps for later ones, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` or what ``setCheckpointDir`` has set; a session on one machine without either gets a
    temporary folder, one on a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context._jsc.sc().getCheckpointDir().isDefined():
            if context.master.split("[")[0] != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-tallyforge-"))
        folder = context._jsc.sc().getCheckpointDir().get()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tallyforge/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: its work isn't repeated, and losing an executor doesn't lose it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
