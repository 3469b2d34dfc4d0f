"""Features of a site by clues in its headers, cookies and script libraries; its mail records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import CLUES
from lumenweb.functions.urls import link_to_domain, lower_keys
from lumenweb.operators.common import true


def script_libraries(html: Column) -> Column:
    """The file names of linked scripts, without parameters and versions, distinct: by expressions, for pages that aren't parsed anyway."""
    sources = F.regexp_extract_all(html, F.lit(r"""(?i)<script\b[^>]*?\ssrc\s*=\s*["']?([^"'\s>]+)"""), F.lit(1))
    names = F.transform(F.filter(sources, lambda s: s.contains(".")), lambda s: F.regexp_replace(F.substring_index(F.regexp_replace(s, r"^.*[/\\]", ""), "?", 1), "-[0-9.]+", "."))
    return F.array_distinct(names)


def library_names(libraries: Column) -> Column:
    """Of these the .js files, in lower case, without min, sorted."""
    return F.array_sort(F.transform(F.filter(libraries, lambda x: x.endswith(".js")), lambda x: F.regexp_replace(F.lower(x), r"\.min\.js\z", ".js")))


def features(headers: Column, cookies: Column, libraries: Column) -> dict[str, Column]:
    """A flag for each feature: true if any of its clues is there."""
    h, c, j = lower_keys(headers), lower_keys(cookies), lower_keys(libraries)
    any_ = lambda have, wanted: true(F.arrays_overlap(have, F.array(*[F.lit(w) for w in wanted]))) if wanted else F.lit(False)
    return {f"fx_hcj__{kind}_{name}": any_(c, cookie) | any_(h, header) | any_(j, script) for kind, name, cookie, header, script in CLUES}


def with_features(df: DataFrame, headers: str = "header_keys", cookies: str = "cookie_keys", libraries: Column | None = None, count_scripts: bool = True) -> DataFrame:
    """Flags of pages; pages in error have none. count_scripts: False leaves script libraries out."""
    scripts = libraries if libraries is not None and count_scripts else F.array().cast("array<string>")
    good = ~true(F.col("is_error"))
    return df.withColumns({k: good & v for k, v in features(F.col(headers), F.col(cookies), scripts).items()})


def clue_table(spark) -> DataFrame:
    """(feature, kind, key): the clues as a table, for joins."""
    rows = [(f"fx_hcj__{k}_{n}", what, key) for k, n, cookie, header, script in CLUES for what, keys in (("cookie", cookie), ("header", header), ("library", script)) for key in keys]
    return spark.createDataFrame(rows, "feature string, kind string, key string")


def mail_features(url: Column, record: Column) -> dict[str, Column]:
    """Whether there is a mail record, and whether it is within the domain's own name (no dot is asked for before it)."""
    name = F.regexp_replace(F.lower(record), r"\.\z", "")
    return {"has_mx_record": record.isNotNull(), "has_own_mx_record": true(name.endswith(link_to_domain(F.lower(url))))}


def mail_comment(kind: Column) -> Column:
    """What is said of a query that failed."""
    return F.when(kind.isNull(), "").when(kind == "no_answer", "No answer").when(kind == "no_nameservers", "No name server").when(kind == "timeout", "Timeout").when(kind == "nxdomain", "No existing query name").otherwise(kind)


def with_mail(df: DataFrame, record: str = "mx_record", url: str = "url") -> DataFrame:
    return df.withColumns(mail_features(F.col(url), F.col(record))).withColumn("MXRecord", F.col(record))
