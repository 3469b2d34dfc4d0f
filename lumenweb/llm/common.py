"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

MIN_LONG = -(2**63)
MAX_LONG = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset: a private one if this is a local session, and an error on a cluster, where such a folder would be one machine's."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lumenweb-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs scan columns, and lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Shuffle files stay until the driver collects the plans that made them; after a large step that is written, it is asked to. The first collection only finds the plans, the second one lets go of them."""
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def _murmur3(x: np.ndarray) -> np.ndarray:
    """Spark's hash of an int, by which rows are dealt to partitions (Murmur3, 32 bits, seed 42)."""
    turn = lambda v, n: (v << np.uint32(n)) | (v >> np.uint32(32 - n))
    h = np.uint32(42) ^ turn(x.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
    h = turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64) ^ np.uint32(4)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def even_keys(each: int, parts: int) -> np.ndarray:
    """each * parts ints of which ``repartition(parts, key)`` deals so many to each partition; by number, one after the other to the partitions in turn."""
    got: list[np.ndarray] = []
    need, at = np.full(parts, each), 0
    while need.any():
        x = np.arange(at, at + 4 * each * parts, dtype=np.int32)
        at += len(x)
        p = _murmur3(x).astype(np.int64) % parts
        order = np.argsort(p, kind="stable")
        x, p = x[order], p[order]
        rank = np.arange(len(p)) - np.searchsorted(p, p)
        good = rank < need[p]
        got.append(np.column_stack((each - need[p[good]] + rank[good], p[good], x[good])))
        need -= np.bincount(p[good], minlength=parts)
    table = np.concatenate(got)
    return table[np.lexsort((table[:, 1], table[:, 0]))][:, 2].astype(np.int32)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
