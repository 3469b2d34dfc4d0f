"""Social accounts that a page links to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import NETWORKS
from lumenweb.functions.text import let
from lumenweb.functions.urls import account_name, account_of, distance_key, name_distance, registered_name


def network_links(links: Column, network: str) -> Column:
    """Of links (array of struct link, path, tag) those to the network, with the account's name."""
    named = F.transform(links, lambda x: F.struct(account_of(x["link"], network).alias("name"), x["path"].alias("path"), x["tag"].alias("tag")))
    return F.filter(named, lambda x: x["name"].isNotNull())


def with_counts(df: DataFrame, links: str = "links") -> DataFrame:
    """Per network: links, different names, and all names, paths and tags joined by two underscores."""
    out = {}
    for n in NETWORKS:
        own = F.coalesce(network_links(F.col(links), n), F.array())
        out |= {f"feat_{n}_cnt": F.size(own), f"feat_{n}_cntunq": F.size(F.array_distinct(F.transform(own, lambda x: x["name"])))}
        out |= {f"feat_{n}_{k}": F.array_join(F.transform(own, lambda x: x[f]), "__") for k, f in (("lks", "name"), ("paths", "path"), ("types", "tag"))}
    return df.withColumns(out)


def best_account(names: Column, network: str, own_name: Column) -> Column:
    """Of an account's names, without scripts and those of two letters and less, the one nearest to the domain's; ties by name. Null if none."""
    usable = F.transform(F.filter(F.array_distinct(names), lambda x: ~x.endswith(".php")), lambda x: account_name(x, F.lit(network)))
    usable = F.array_distinct(F.filter(usable, lambda x: F.length(x) > 2))
    ranked = F.transform(usable, lambda x: F.struct(name_distance(distance_key(x), own_name).alias("d"), x.alias("name")))
    return F.array_min(ranked)["name"]


def with_accounts(df: DataFrame, url: str = "url", links: str = "links") -> DataFrame:
    """has_<network> and feat_<network>_lks: the account that is most likely the domain's own."""
    own = distance_key(registered_name(F.col(url)))
    out = {}
    for n, full in NETWORKS.items():
        names = F.coalesce(F.transform(network_links(F.col(links), n), lambda x: x["name"]), F.array().cast("array<string>"))
        best = let(names, lambda x: best_account(x, n, own))
        out |= {f"has_{full}": best.isNotNull(), f"feat_{n}_lks": F.coalesce(best, F.lit(""))}
    return df.withColumns(out)


def meta_tags(df: DataFrame, data: str = "html_data") -> DataFrame:
    d = F.col(data)
    return df.withColumns({c: F.coalesce(d[c], F.lit(False)) for c in ("has_open_graph", "has_twitter_card", "has_schema_tag")})


def results(pages: DataFrame, data: str = "html_data") -> DataFrame:
    """(url, accounts and flags) of pages that carry html_data; pages in error have none."""
    links = F.when(~F.coalesce(F.col("is_error"), F.lit(False)), F.col(data)["links"])
    out = meta_tags(with_accounts(pages.withColumn("_links", links), links="_links"), data)
    return out.select("url", *[c for n, full in NETWORKS.items() for c in (f"has_{full}", f"feat_{n}_lks")], "has_open_graph", "has_twitter_card", "has_schema_tag")


def with_targets(originals: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets' accounts over those of the page that sends there: all of a target's columns."""
    taken = [c for c in targets.columns if c not in ("url", "original_url", "target_url")]
    side = targets.where("original_url is not null").groupBy(F.col("original_url").alias("url")).agg(F.max_by(F.struct(F.col("url").alias("target_url"), *taken), "url").alias("_t"))
    out = originals.join(side, "url", "left")
    there = F.col("_t").isNotNull()
    old = F.col("target_url") if "target_url" in originals.columns else F.lit(None).cast("string")
    return out.withColumns({c: F.when(there, F.col("_t")[c]).otherwise(F.col(c)) for c in taken if c in originals.columns} | {"target_url": F.when(there, F.col("_t")["target_url"]).otherwise(old)}).drop("_t")
