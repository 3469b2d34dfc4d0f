"""Registrars: reference tables, their upkeep, and links to them on pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.urls import link_to_domain
from lumenweb.operators.common import small, true

# What is a domain in a line of text, and the longest list of services that is told.
DOMAIN = r"(www\.)?([-a-z0-9]+(\.[-0-9a-z]+)?(\.[a-z]+))"
SERVICE_LENGTH = 50


def suffixes(registrars: DataFrame) -> DataFrame:
    """(suffix, name, length) from (hosting_name, tld), tld a list with ``;``. Where a suffix has several names, the last in the alphabet."""
    name = F.regexp_replace("hosting_name", r"^www\.", "")
    rows = registrars.select(name.alias("name"), F.explode(F.split("tld", ";")).alias("tld"))
    return rows.select(F.concat("name", "tld").alias("suffix"), "name").groupBy("suffix").agg(F.max("name").alias("name")).withColumn("length", F.length("suffix"))


def label_suffixes(host: Column) -> Column:
    """The host and all that is behind one of its dots, longest first; the last label alone is none."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def matches(links: DataFrame, known: DataFrame, link: str = "link") -> DataFrame:
    """links with suffix and name of the longest registrar suffix of each one's host. An equi-join on suffixes; a row a match."""
    columns = links.columns
    asked = links.withColumn("_suffix", F.explode(label_suffixes(link_to_domain(F.col(link)))))
    hit = asked.join(small(known.select(F.col("suffix").alias("_suffix"), "name", "length")), "_suffix")
    best = hit.groupBy(*columns).agg(F.max(F.struct("length", F.col("_suffix").alias("suffix"), "name")).alias("_best"))
    return best.select(*columns, "_best.suffix", "_best.name")


def detect(pages: DataFrame, known: DataFrame, links: str = "all_links", target: str = "target_url", key: str = "url") -> DataFrame:
    """pages with park_service, registrar_found, is_redirected_to_registrar.

    The target decides if it is a registrar's; else all links do: one registrar among them is found, several are told but not found.
    """
    to = matches(pages.where(F.col(target).isNotNull()).select(key, F.col(target).alias("link")).distinct(), known).select(key, F.col("suffix").alias("_to"))
    listed = pages.select(key, F.posexplode(links).alias("pos", "link")).groupBy(key, "link").agg(F.min("pos").alias("pos"))
    found = matches(listed, known).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "suffix"))).alias("_found"), F.countDistinct("name").alias("_names"))
    services = F.array_distinct(F.transform("_found", lambda x: x["suffix"]))
    out = pages.join(to, key, "left").join(found, key, "left")
    service = F.when(F.col("_to").isNotNull(), F.col("_to")).when(F.col("_names") == 1, services[0]).when(F.col("_names") > 1, F.substring(F.array_join(services, "__"), 1, SERVICE_LENGTH))
    out = out.withColumns({"park_service": service, "registrar_found": F.col("_to").isNotNull() | true(F.col("_names") == 1), "is_redirected_to_registrar": F.col("_to").isNotNull()})
    return with_lander(out.drop("_to", "_found", "_names"), target, key)


def with_lander(df: DataFrame, target: str = "target_url", url: str = "url") -> DataFrame:
    """A target that is the page's own lander is a service."""
    lander = true(F.lower(target).endswith(F.concat(F.col(url), F.lit("/lander"))))
    return df.withColumns({"park_service": F.when(lander, "GoDaddy").otherwise(F.col("park_service")), "registrar_found": lander | F.col("registrar_found"), "is_redirected_to_registrar": lander | F.col("is_redirected_to_registrar")})


def domain_of_line(line: Column) -> Column:
    """The first domain in a line, without www; null if there is none."""
    low = F.lower(line)
    return F.when(low.rlike(DOMAIN), F.regexp_extract(low, DOMAIN, 2))


def split_domain(domain: Column) -> Column:
    """struct(name, tld): at the first dot."""
    name = F.substring_index(domain, ".", 1)
    return F.struct(name.alias("name"), F.substring(domain, F.length(name) + 1, F.length(domain)).alias("tld"))


def collapse(rows: DataFrame) -> DataFrame:
    """(name, tld list with ``;``) of (name, tld)."""
    return rows.select("name", "tld").distinct().groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("tld")), ";").alias("tld"))


def explode_tlds(collapsed: DataFrame) -> DataFrame:
    return collapsed.select(F.lower("name").alias("name"), F.explode(F.split(F.lower("tld"), ";")).alias("tld"))


def merge(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all of (name, tld), those that are new)."""
    a, b = (x.select("name", "tld").distinct() for x in (old, new))
    return a.union(b).distinct(), b.exceptAll(a)


def counts(collapsed: DataFrame) -> DataFrame:
    """Names and domains that a table holds."""
    return collapsed.agg(F.count("*").alias("names"), F.coalesce(F.sum(F.size(F.split("tld", ";"))), F.lit(0)).alias("domains"))


def duplicates(domains: DataFrame, domain: str = "domain") -> DataFrame:
    return domains.groupBy(domain).count().where("count > 1")


def by_last_label(domains: DataFrame, domain: str = "domain") -> DataFrame:
    """With the column to partition text files by."""
    return domains.withColumn("last_label", F.substring_index(domain, ".", -1))


def extend(names: DataFrame, tlds: DataFrame, existing: DataFrame, limit: int = 10_000) -> DataFrame:
    """Each name under each TLD that isn't known yet. TLDs are a table of a few thousand rows by nature: they become one array in the plan, so that a name's domains are made in its own row; more than limit are an error."""
    found = sorted(r["tld"] for r in tlds.select("tld").where("tld is not null").distinct().limit(limit + 1).collect())
    if len(found) > limit:
        raise ValueError(f"more than {limit} TLDs")
    pairs = names.select("name").distinct().withColumn("tld", F.explode(F.lit(found) if found else F.array().cast("array<string>")))
    return pairs.withColumn("domain", F.concat("name", "tld")).join(existing.select("domain").distinct(), "domain", "left_anti")
