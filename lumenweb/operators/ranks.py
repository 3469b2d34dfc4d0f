"""Ranks and running sums over all rows, without a task that sees all of them.

Rows are dealt by ranges of the order and sorted in each range; a table in the shared folder keeps each row's range and
its place there. What lies below a range comes from one count for each range. A key that most rows share is no hot task,
since ranges are of all order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenweb.operators.common import small
from lumenweb.sources.scratch import scratch

#: monotonically_increasing_id has the partition above these bits, and the row's place in it below.
BITS = 33


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """df with _range and _place (from 0), written and read again; ranges and places follow the order, nulls first."""
    spark = df.sparkSession
    path = scratch(spark, "ranged")
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    return rows.withColumns({"_range": F.shiftright("_at", BITS), "_place": F.col("_at").bitwiseAND(F.lit((1 << BITS) - 1))}).drop("_at")


def below(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """rows with the sum of value over all ranges below each one's own."""
    sums = rows.groupBy("_range").agg(F.sum(value).alias("_sum"))  # a row for each range
    under = F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(small(sums.select("_range", under.alias(out))), "_range")


def with_positions(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Each row's place from 0 in the order."""
    rows = below(ranged(df, order), F.lit(1), "_below")
    return rows.withColumn(out, F.col("_below") + F.col("_place")).drop("_below", "_place", "_range")


def with_positions_within(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Each row's place from 0 among the rows of its group."""
    placed = with_positions(df, [group, *order], "_all")
    first = small(placed.groupBy(group).agg(F.min("_all").alias("_first")).withColumnRenamed(group, "_group"))
    return placed.join(first, F.col(group).eqNullSafe(F.col("_group"))).withColumn(out, F.col("_all") - F.col("_first")).drop("_all", "_first", "_group")
