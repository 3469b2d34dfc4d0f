"""Registry of queries, and inputs that are derived alike in Spark and in the oracle: the same SQL expressions of a row's key."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenweb.functions.urls import PREFIXES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lit(text: str) -> str:
    """A SQL string; backslashes must not be in it, since the engines differ on them."""
    return "'" + text.replace("'", "''") + "'"


def derived(spark: SparkSession, d: str, source: str, columns: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns by SQL expressions that mean the same in both engines."""
    return table(spark, d, source).select(*keep, *[F.expr(v).alias(k) for k, v in columns.items()])


def cte(name: str, source: str, columns: dict[str, str], keep: tuple[str, ...] = ()) -> str:
    return f"{name} AS (SELECT {', '.join([*keep, *[f'{v} AS {k}' for k, v in columns.items()]])} FROM {source})"


# The oracle's own way to clean links.
def sql_clean(x: str) -> str:
    x = f"replace({x}, chr(92), '/')"
    for p in PREFIXES:
        x = f"regexp_replace({x}, '^{re.escape(p)}', '')"
    return f"regexp_replace({x}, '/$', '')"


def sql_domain(x: str) -> str:
    return f"split_part(split_part({sql_clean(x)}, '/', 1), '?', 1)"


def case(key: str, n: int, *values: str) -> str:
    """CASE key % n; values are SQL, the last one is for the rest."""
    return f"CASE {key} % {n} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1])) + f" ELSE {values[-1]} END"


HOST = "regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)"
#: A crawl row for each page: every kind of error, category, redirection and flag, by the page's number.
CRAWL = {
    "url": f"concat('p', page_id, '.', lower({HOST}))",
    "is_error": "page_id % 26 < 15",
    "comment": case("page_id", 26, *map(lit, ["Error status code :401: Unauthorized", "Error status code :402: Payment Required", "Error status code :403: Forbidden", "Error status code :404: Not Found", "Error status code :408: Request Timeout", "Error status code :500: Internal Server Error", "Error status code :502: Bad Gateway", "Error status code :504: Gateway Timeout", "Error status code :418: I''m a teapot".replace("''", " "), "DNS resolution error", "Connection error", "ServerDisconnected", "TimeoutError", "SSL error"]), "CAST(NULL AS VARCHAR(99))"),
    "registrar_found": "page_id % 26 IN (15, 16)",
    "is_full_js_parked": "page_id % 26 = 16 OR page_id % 52 = 3",
    "pred_ml_park": "page_id % 26 BETWEEN 16 AND 24",
    **{f"ml_feat_{k}": f"CASE WHEN page_id % 26 = {17 + i} OR page_id % 26 = {18 + i} AND page_id % 4 = 0 THEN 1 ELSE 0 END" for i, k in enumerate(("index_of", "construction", "sale", "starter", "expired", "blocked", "reserved"))},
    "pred_is_empty": "page_id % 3 = 0",
    "flag_js_found": "page_id % 5 = 0",
    "target_url": "CASE WHEN page_id % 7 = 0 THEN concat('http://www.t', page_id, '.org/a') WHEN page_id % 7 = 1 THEN concat('http://www.p', page_id, '.', " + HOST + ", '/b') END",
}


def crawl(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, "pages", CRAWL, ("page_id",))


CRAWL_CTE = cte("crawl", "pages", CRAWL, ("page_id",))
