"""Crawl rows as they land: the batch plan on each micro-batch, each (date, url) taken once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenweb import schemas


def landing(spark: SparkSession, path: str, schema=schemas.CRAWL, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def once(stream: DataFrame, time: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """Without repeats that come within the delay; state is dropped beyond it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def visits_by_window(stream: DataFrame, time: str, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Visits and errors in each window, as they are complete."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width)).agg(F.count("*").alias("visits"), F.count_if("is_error").alias("errors"))


def run(stream: DataFrame, plan: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, once_only: bool = True):
    """plan: the batch transforms; sink: gets each result and its number, and must bear being called twice with one number (see writers.append_new)."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: sink(plan(df), n))
    return (query.trigger(availableNow=True) if once_only else query).start()
