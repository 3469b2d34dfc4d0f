"""A folder that driver and executors share, for queries that write and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a private folder if this is a local session, and an error on a cluster, where such a folder would be one machine's."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not current.isDefined():
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is unset")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lumenweb-"))
            current = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = current.get()
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: what several branches of a plan use is made once, and each reads only its columns."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
