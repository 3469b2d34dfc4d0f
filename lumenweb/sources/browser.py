"""Pages as a browser renders them. The browser is a parameter: a factory that a task calls once, whose result renders one
url and is closed at the end of the task, so that tests and other engines need no browser here.

The url to render is a link's redirection target where its row says so, else its own. A link that can't be rendered at all
leaves no row; one whose page can't be read is an error row. Screenshots come as bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VISIT = "url string, original_url string, raw_text string, is_error boolean, comment string, to_revisit boolean, visit_kind string, screenshot binary"
#: Seconds that a page may take to load.
LOADING_TIME = 15.0


class Browser(Protocol):
    def open(self, url: str, wait: float) -> None:
        """Raises if the page can't be opened."""

    def source(self) -> str:
        """The rendered document; raises if it can't be read."""

    def screenshot(self) -> bytes | None: ...

    def close(self) -> None: ...


def links(rows: DataFrame) -> DataFrame:
    """rows: url, source, target_url, original_url. (visited, original_url, full): what is opened, with a scheme."""
    target = F.col("source") == "target"
    visited = F.when(target, F.col("target_url")).otherwise(F.col("url"))
    full = F.when(visited.rlike("(?i)^https*:"), visited).otherwise(F.concat(F.lit("http://"), visited))
    return rows.where(visited.isNotNull()).select(visited.alias("visited"), F.when(target, F.col("original_url")).alias("original_url"), full.alias("full"))


def one(browser: Browser, visited: str, original: str | None, full: str, shots: bool, wait: float) -> tuple | None:
    """A visit's row, or None if the page can't be opened."""
    try:
        browser.open(full, wait)
        try:
            text, failed = browser.source(), False
        except Exception as e:  # the page is there but can't be read
            text, failed = f"JS CRAWLING ERROR: {e}", True
        return visited, original, text, failed, None, False, "browser", browser.screenshot() if shots and not failed else None
    except Exception:  # a page's failure is not the task's
        return None


def visit(rows: DataFrame, start: Callable[[], Browser], shots: bool = False, wait: float = LOADING_TIME, partitions: int | None = None) -> DataFrame:
    """start: opens a browser, once a task. It must be picklable."""
    asked = links(rows)
    names = [x.split(" ")[0] for x in VISIT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        browser = None
        try:
            for pdf in batches:
                if browser is None and len(pdf):
                    browser = start()
                got = [one(browser, *x, shots, wait) for x in zip(pdf["visited"], pdf["original_url"], pdf["full"], strict=True)]
                yield pd.DataFrame([g for g in got if g is not None], columns=names)
        finally:
            if browser is not None:
                browser.close()

    return (asked.repartition(partitions) if partitions else asked).mapInPandas(run, VISIT)
