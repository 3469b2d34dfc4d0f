"""Samples to a service by its protocol; how a request is made is a parameter.

An image goes first and gives a number, then the sample with that number. Created (201) is done; a sample that is known
already answers 200 with its own address, where it is patched if updates are allowed. Each sample's outcome is a row; a
failure is a message in it and never a failed task.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOME = "url string, outcome string, message string"
#: (method, address, fields) to (status, address that answered, body).
Send = Callable[[str, str, dict], tuple[int, str, str]]


def one(row: dict, send: Send, images: str, samples: str, updates: bool) -> tuple[str, str, str]:
    """row: url, ss_filename, screenshot, html_text, html_raw, and categorisation as JSON. Returns (url, outcome, message)."""
    url = row["url"]
    if not row.get("ss_filename"):
        return url, "skipped", ""
    try:
        shot = base64.b64encode(bytes(row.get("screenshot") or b"")).decode()
        status, _, body = send("POST", images, {"filename": row["ss_filename"].rsplit("/", 1)[-1], "screenshot": shot})
        if status != 200:
            return url, "failed", f"image: {status} {body[:100]}"
        told = {k: v for k, v in row.items() if k in ("url", "ss_filename")}
        data = {"url": url, "html_text": row.get("html_text"), "html_raw": row.get("html_raw"), "categorisation": json.dumps(json.loads(row.get("categorisation") or "{}") | told), "screenshot": int(body)}
        status, address, body = send("POST", samples, data)
        if status == 201:
            return url, "created", ""
        if status != 200:
            return url, "failed", f"sample: {status} {body[:100]}"
        if not updates:
            return url, "known", ""
        status, _, body = send("PATCH", address, data)
        return (url, "updated", "") if status < 300 else (url, "failed", f"update: {status} {body[:100]}")
    except Exception as e:  # one sample's failure is not the others'
        return url, "failed", f"{type(e).__name__}: {e}"


def upload(rows: DataFrame, send: Send, images: str, samples: str, updates: bool = False) -> DataFrame:
    """(url, outcome, message). Writing what comes back makes the requests; a task that is done again finds its samples known."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([one(r, send, images, samples, updates) for r in pdf.to_dict("records")], columns=["url", "outcome", "message"])

    known = [c for c in ("url", "ss_filename", "screenshot", "html_text", "html_raw", "categorisation") if c in rows.columns]
    return rows.select(*[F.col(c) for c in known]).mapInPandas(run, OUTCOME)
