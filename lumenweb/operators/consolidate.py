"""Joins that put a domain's results together: targets and browser pages over originals, stages side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.operators.parking import KEYS


def _side(df: DataFrame, key: Column, taken: list[str]) -> DataFrame:
    """One row for each key, with what is taken as a struct; of several the last by url."""
    rows = df.where(key.isNotNull()).select(key.alias("_key"), "url", F.struct(*[F.col(c) for c in taken]).alias("_new"), (F.col("page_kind") if "page_kind" in df.columns else F.lit("normal")).alias("_kind"))
    return rows.groupBy("_key").agg(F.max_by(F.struct("_new", "_kind", F.col("url").alias("_url")), "url").alias("_r")).select("_key", "_r.*")


def _brought(column: str) -> Column:
    """Whether a row of that kind has the column at all; then it overwrites, with null too."""
    kinds = [k for k, own in KEYS.items() if column not in own]
    return F.col("_new").isNotNull() & ~F.col("_kind").isin(*kinds) if kinds else F.col("_new").isNotNull()


def with_targets(originals: DataFrame, targets: DataFrame, keep: tuple[str, ...] = ("to_sample",)) -> DataFrame:
    """Results of a redirection's target over those of the page that sends there; the target's url becomes target_url."""
    taken = [c for c in targets.columns if c not in ("url", "target_url", "original_url", "page_kind", *keep) and c in originals.columns]
    joined = originals.join(_side(targets, F.col("original_url"), taken), F.col("original_url") == F.col("_key"), "left")
    there = F.col("_new").isNotNull()
    out = {c: F.when(_brought(c), F.col("_new")[c]).otherwise(F.col(c)) for c in taken}
    out |= {"target_url": F.when(there, F.col("_url")).otherwise(F.col("target_url")), "url": F.when(there, F.col("_key")).otherwise(F.col("url"))}
    return joined.withColumns(out).drop("_key", "_new", "_kind", "_url")


def with_browser(results: DataFrame, browser: DataFrame) -> DataFrame:
    """Results of rendered pages over the others, under the original's url if there is one; is_js_rendered_results tells where."""
    taken = [c for c in browser.columns if c not in ("url", "original_url", "page_kind") and c in results.columns]
    side = _side(browser, F.coalesce("original_url", "url"), taken)
    joined = results.join(side, F.coalesce(results["original_url"], results["url"]) == F.col("_key"), "left")
    there = F.col("_new").isNotNull()
    out = {c: F.when(_brought(c), F.col("_new")[c]).otherwise(F.col(c)) for c in taken}
    out |= {"target_url": F.when(there & (F.col("_url") != F.col("_key")), F.col("_url")).otherwise(out.get("target_url", F.col("target_url"))), "url": F.when(there, F.col("_key")).otherwise(F.col("url")), "is_js_rendered_results": there}
    return joined.withColumns(out).drop("_key", "_new", "_kind", "_url")


def stage(out: DataFrame, results: DataFrame, key: str = "url") -> DataFrame:
    """out left joined with a stage's results; columns that are there already stay."""
    fresh = [c for c in results.columns if c != key and c not in out.columns]
    return out.join(results.select(key, *fresh), key, "left")


def crawl_over(out: DataFrame, crawl: DataFrame, key: str = "url") -> DataFrame:
    """The crawl's own columns replace those of the same name; but an error of the target replaces the crawl's error and comment."""
    had = "is_error" in out.columns
    if had:
        out = out.withColumnsRenamed({"is_error": "_error", "comment": "_comment"})
    clash = [c for c in out.columns if c != key and c in crawl.columns]
    joined = out.drop(*clash).join(crawl, key, "left")
    if not had:
        return joined
    told = F.col("_error").isNotNull()
    return joined.withColumns({"is_error": F.when(told, F.col("_error")).otherwise(F.col("is_error")), "comment": F.when(told, F.col("_comment")).otherwise(F.col("comment"))}).drop("_error", "_comment")
