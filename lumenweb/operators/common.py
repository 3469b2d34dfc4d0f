"""Helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table of at most so many rows may be broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a bounded look at it shows at most rows; else as it is, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(scan: DataFrame) -> DataFrame:
    """scan: a plain scan of files. Dealt to as many tasks as there are slots if it has fewer, since heavy expressions over one file would be one task; a scan of many files stays as it is, without a shuffle."""
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(slots) if scan.rdd.getNumPartitions() < slots else scan


def true(flag: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(flag, F.lit(False))


def put(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def add_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({k: v for k, v in columns.items() if k.lower() not in have})
