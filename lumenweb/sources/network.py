"""Pages and mail records from the network, as data sources; how they are fetched is a parameter, so tests need no network.

``spark.dataSource.register(PageSource)``, then ``spark.read.format("lumenweb_pages").option("path", <parquet of urls>)``
visits the urls of a table, a partition by a task; or ``visit`` maps a DataFrame of urls. A page's failure is a row with a
comment, never a failed task.
"""

from __future__ import annotations

import socket
import ssl
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lumenweb.operators import domains
from lumenweb.operators.visits import error_comment, with_status

VISIT = "url string, status int, final_url string, raw_text string, header_keys array<string>, cookie_keys array<string>, hops array<struct<status: int, url: string>>, kind string, message string"
MAX_BYTES = 200 * 1024 * 1024
#: Requests that a task has open at a time.
POOL = 50


def fetch(url: str, timeout: float = 120.0) -> dict:
    """One page by HTTP with the standard library."""
    hops: list[dict] = []

    class Redirects(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, req, fp, code, msg, headers, new):
            hops.append({"status": code, "url": req.full_url})
            return super().redirect_request(req, fp, code, msg, headers, new)

    opener = urllib.request.build_opener(Redirects)
    try:
        with opener.open("http://" + url, timeout=timeout) as page:
            body = page.read(MAX_BYTES + 1)
            if len(body) > MAX_BYTES:
                return {"kind": "page", "message": "Page size too large error"}
            cookies = [c.split("=", 1)[0].strip() for c in page.headers.get_all("Set-Cookie") or []]
            return {"status": page.status, "final_url": page.url, "raw_text": body.decode(page.headers.get_content_charset() or "utf-8", "replace"), "header_keys": [k.lower() for k in page.headers], "cookie_keys": cookies, "hops": hops}
    except urllib.error.HTTPError as e:
        return {"status": e.code, "final_url": e.url, "hops": hops}
    except TimeoutError as e:
        return {"kind": "timeout", "message": str(e)}
    except ssl.SSLError as e:
        return {"kind": "certificate", "message": str(e)}
    except urllib.error.URLError as e:
        inner = e.reason
        kind = "connect" if isinstance(inner, socket.gaierror) else "timeout" if isinstance(inner, TimeoutError) else "certificate" if isinstance(inner, ssl.SSLError) else "connection"
        return {"kind": kind, "message": str(inner)}
    except UnicodeDecodeError as e:
        return {"kind": "decoding", "message": str(e)}
    except OSError as e:
        return {"kind": "os", "message": str(e)}


def _row(url: str, got: dict) -> tuple:
    return (url, *(got.get(k) for k in ("status", "final_url", "raw_text", "header_keys", "cookie_keys")), got.get("hops") or [], got.get("kind"), got.get("message"))


class Pace:
    """Gives each caller the time when it may go: one each period, the first at once."""

    def __init__(self, period: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.period, self.clock, self.sleep = period, clock, sleep
        self.lock, self.next = threading.Lock(), None

    def __call__(self) -> float:
        """Waits, and returns the time of going."""
        with self.lock:
            now = self.clock()
            go = now if self.next is None else max(now, self.next)
            self.next = go + self.period
        if go > now:
            self.sleep(go - now)
        return go


def visit(urls: DataFrame, get: Callable[[str], dict] = fetch, partitions: int | None = None, revisit: bool = True, pool: int = POOL, period: float = 0.0) -> DataFrame:
    """Crawl rows of urls: fetched in parallel by partition, with errors, statuses and histories told. A task has pool requests open at most, and begins one each period seconds at most."""
    columns = [x.split(" ")[0] for x in "url status final_url raw_text header_keys cookie_keys hops kind message".split()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(period) if period else None

        def one(u: str) -> tuple:
            if pace:
                pace()
            return _row(u, get(u))

        with ThreadPoolExecutor(max(1, pool)) as threads:
            for pdf in batches:
                yield pd.DataFrame(list(threads.map(one, pdf["url"])), columns=columns).astype({"status": "Int32"})

    dealt = urls.select("url").repartition(partitions) if partitions else urls.select("url")
    return as_crawl(dealt.mapInPandas(run, VISIT), revisit)


def crawl(urls: DataFrame, visited: DataFrame, get: Callable[[str], dict] = fetch, partitions: int | None = None, pool: int = POOL, period: float = 0.0, seed: int = 0) -> DataFrame:
    """A file's crawl: the distinct urls that can be visited and weren't, in shuffled order, by pools of requests."""
    todo = domains.visit_order(domains.unvisited(domains.visit_set(urls), visited), seed).orderBy("visit_order").drop("visit_order")
    return visit(todo, get, partitions, pool=pool, period=period)


def as_crawl(visits: DataFrame, revisit: bool = True) -> DataFrame:
    failed = visits.withColumn("_e", error_comment(F.col("kind"), F.col("message"), revisit))
    told = with_status(failed)
    return told.withColumns({"is_error": F.col("_e.is_error") | F.coalesce(F.col("is_error"), F.lit(False)), "comment": F.coalesce("_e.comment", "comment"), "to_revisit": F.col("_e.to_revisit")}).drop("_e", "kind", "message", "hops")


class _Part(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split(",") if u]
        self.parts = int(options.get("partitions", 8))

    def partitions(self) -> list[_Part]:
        return [_Part(self.urls[i :: self.parts]) for i in range(min(self.parts, len(self.urls)))] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for u in partition.urls:
            yield _row(u, fetch(u))


class PageSource(DataSource):
    """Options: urls (a list with commas), partitions."""

    @classmethod
    def name(cls) -> str:
        return "lumenweb_pages"

    def schema(self) -> str:
        return VISIT

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def mail_records(urls: DataFrame, query: Callable[[str], tuple[str | None, str | None]]) -> DataFrame:
    """(url, mx_record, mail_kind) by a resolver that is given: url to (first exchange, kind of failure). The standard library has none for MX."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(u, *query(u)) for u in pdf["url"]], columns=["url", "mx_record", "mail_kind"])

    return urls.select("url").mapInPandas(run, "url string, mx_record string, mail_kind string")
