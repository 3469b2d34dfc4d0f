"""Redirections: by HTTP, by a refresh, by a single frame that is the page, by a script. In this order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import BASIC_PARENTS, LIMITS
from lumenweb.functions.text import let
from lumenweb.functions.urls import clean_link, link_to_domain
from lumenweb.operators.common import true


def significance(frames: Column) -> Column:
    return F.coalesce(F.aggregate(frames, F.lit(0), lambda n, f: n + F.coalesce(f["significance"], F.lit(0))), F.lit(0))


def frame_target(frames: Column, n_lines: Column) -> Column:
    """The link of the only frame that matters, if the page is short and the frame isn't a part of a text."""

    def link(frame: Column) -> Column:
        inner = F.filter(frame["frames"], lambda x: x["significance"] == 1)
        return F.when(~frame["parent"].isin(*BASIC_PARENTS), F.when(frame["type"] == "iframe", frame["link"]).otherwise(F.get(inner, F.lit(0))["link"]))

    one = F.get(F.filter(frames, lambda f: f["significance"] == 1), F.lit(0))
    return F.when((significance(frames) == 1) & (n_lines < LIMITS["html_lines"]), let(one, link))


def detect(url: Column, history: Column, url_history: Column, frames: Column, window_loc: Column, meta_refresh: Column, n_lines: Column) -> Column:
    """struct(is_redirected, redirection_type, target_url). target_url may be there without a redirection: the last place that was looked at."""
    own = clean_link(url)
    http = clean_link(F.substring_index(url_history, "___", 1))
    by_http = true((history > 0) & (http != url))
    frame = frame_target(frames, n_lines)
    window = F.when((F.size(window_loc) == 1) & (n_lines < LIMITS["html_lines"]), F.get(window_loc, F.lit(0)))
    parts = F.struct(by_http.alias("is_http"), http.alias("http"), meta_refresh.alias("refresh"), frame.alias("frame"), window.alias("window"), own.alias("own"))

    def conclude(p: Column) -> Column:
        other = lambda k: true(clean_link(p[k]) != p["own"])
        kind = F.when(p["is_http"], "http").when(other("refresh"), "meta_refresh").when(other("frame"), "iframe").when(other("window"), "window_location").otherwise("")
        target = F.when(kind == "http", p["http"]).when(kind == "meta_refresh", p["refresh"]).when(kind == "iframe", p["frame"]).otherwise(F.coalesce(p["window"], p["frame"], p["refresh"]))
        return F.struct((kind != "").alias("is_redirected"), kind.alias("redirection_type"), target.alias("target_url"))

    return let(parts, conclude)


def with_redirection(df: DataFrame, data: str = "html_data") -> DataFrame:
    """is_redirected, redirection_type, target_url, and whether the domain changed (told for targets and HTTP redirections)."""
    d = F.col(data)
    found = detect(F.col("url"), F.col("history"), F.col("URL_history"), d["frames"], d["window_loc"], d["meta_refresh"], d["n_lines_html"])
    out = df.withColumn("_redirect", found).select("*", "_redirect.*").drop("_redirect")
    by_http = F.col("redirection_type") == "http"
    from_ = F.when(by_http, link_to_domain(F.col("url"))).otherwise(link_to_domain(F.col("original_url")))
    to = F.when(by_http, link_to_domain(F.substring_index("URL_history", "___", 1))).otherwise(link_to_domain(F.col("url")))
    return out.withColumn("is_redirected_different_domain", true((by_http | (F.col("source") == "target")) & (from_ != to)))


def settle_same_domain(df: DataFrame) -> DataFrame:
    """A target within the same domain is no redirection; another domain makes target the source. Histories are dropped."""
    there = true(F.col("target_url") != "")
    same = link_to_domain(F.col("target_url")) == link_to_domain(F.col("url"))
    out = df.withColumns({"is_redirected": F.when(there & same, False).otherwise(F.col("is_redirected")), "source": F.when(there & same, "original").when(there, "target").otherwise(F.col("source"))})
    return out.drop("history", "URL_history")


def needs_target_visit(fix_window_location: bool = False) -> Column:
    """An original page that only sends on by a refresh or a frame, and is no registrar's. Script redirections aren't followed unless fixed."""
    kinds = ["iframe", "meta_refresh"] + ["window_location"] * fix_window_location
    return true((F.col("source") == "original") & F.col("redirection_type").isin(*kinds) & ~true(F.col("registrar_found")))
