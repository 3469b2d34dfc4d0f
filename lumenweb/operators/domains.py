"""Domain lists: normalization, the set to visit, what was visited before, chunks and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions import urls
from lumenweb.functions.fixed import LIMITS
from lumenweb.operators.common import true
from lumenweb.operators.ranks import with_positions, with_positions_within


def normalize(df: DataFrame, url: str = "url") -> DataFrame:
    """url as text without a dot at its end, in IDNA form; ind_non_schema: whether it can be visited. Other columns stay."""
    return df.withColumn(url, urls.to_idna(urls.strip_dot(F.col(url)))).withColumn("ind_non_schema", urls.has_domain(F.col(url)))


def visit_set(df: DataFrame, url: str = "url") -> DataFrame:
    """The distinct urls that can be visited."""
    return df.where(urls.has_domain(F.col(url))).select(url).distinct()


def visit_order(df: DataFrame, seed: int = 0, url: str = "url") -> DataFrame:
    """A shuffled place for each url that is the same in every run: sort by it, or deal by it."""
    return df.withColumn("visit_order", F.xxhash64(F.lit(seed), F.col(url)))


def unvisited(df: DataFrame, visited: DataFrame, url: str = "url") -> DataFrame:
    """Without what was visited before and needs no second visit."""
    done = visited.where(~true(F.col("to_revisit"))).select(url).distinct()
    return df.join(done, url, "left_anti")


def chunk_size(file: Column) -> Column:
    return F.when(F.contains(file, F.lit(".ee.")), LIMITS["chunk_ee"]).otherwise(LIMITS["chunk"])


def with_chunks(df: DataFrame, file: str, order: list[str]) -> DataFrame:
    """The number of each row's chunk in its file. Only where chunks are wanted as data; files of any size are split by Spark itself."""
    placed = with_positions_within(df, file, order, "_place")
    return placed.withColumn("chunk", F.floor(F.col("_place") / chunk_size(F.col(file))).cast("int")).drop("_place")


def with_batches(df: DataFrame, k: int, order: list[str], n: int | None = None) -> DataFrame:
    """Batches of ceil(n / k) rows in order."""
    n = df.count() if n is None else n
    size = max(1, -(-n // k))
    return with_positions(df, order, "_position").withColumn("batch", F.floor(F.col("_position") / size).cast("int")).drop("_position")


def visit_metrics(documents: DataFrame, seconds: float | None = None) -> DataFrame:
    """(achieved, error_rate in percent, visits per minute)."""
    rate = F.floor(F.round(100.0 * F.sum(true(F.col("to_revisit")).cast("int")) / F.count("*"), 1))
    speed = F.round(F.count("*") / F.lit(seconds) * 60).cast("int") if seconds else F.lit(None).cast("int")
    return documents.agg(F.count("*").alias("achieved"), F.when(F.count("*") > 0, rate).otherwise(100).cast("int").alias("error_rate"), speed.alias("visits_per_minute"))


def file_report(files: DataFrame, file: str = "file") -> DataFrame:
    """Rows and files of input lists by kind of their names: covid, idn, gtld, cctld, other."""
    name = F.substring_index(F.col(file), "/", -1)
    kind = F.when(name.rlike(r"\.covid"), "covid").when(name.rlike(r"\.xn--[a-z0-9]+\.") & ~name.contains("p1ai"), "idn").when(name.rlike(r"\.[a-z][a-z][a-z_-]+\."), "gtld").when(name.rlike(r"\.[a-z][a-z]\.|xn--p1ai"), "cctld").otherwise("other")
    return files.groupBy(kind.alias("kind")).agg(F.countDistinct(file).alias("files"), F.count("*").alias("rows"))
