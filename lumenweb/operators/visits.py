"""What a visit gave: errors, status codes, redirect histories, pages that are too long, headers worth keeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import CLUES, LIMITS, STATUS_TEXT
from lumenweb.operators.common import small, true


def error_comment(kind: Column, message: Column, revisit: bool = True) -> Column:
    """struct(is_error, comment, to_revisit) of a visit's failure; kind is null where nothing failed.

    Kinds: connect, timeout, disconnected, os, certificate, connection, decoding, payload; others are told as they are.
    """
    said = F.coalesce(message, F.lit(""))
    told = F.concat(F.lit("error of type "), kind, F.lit(" message: "), said)
    refused, closed, reset, session = (F.contains(said, F.lit(x)) for x in ("Connect call failed", "WinError 10054", "Connection reset by peer", "Session is closed"))
    again = F.lit(revisit)
    comment = (
        F.when((kind == "connect") & refused, "Connection error").when(kind == "connect", "DNS resolution error").when(kind == "timeout", "TimeoutError").when(kind == "disconnected", "ServerDisconnected")
        .when((kind == "os") & closed, "Connection closed").when((kind == "os") & reset, "Connection error").when(kind == "certificate", "SSL error").when(kind == "connection", "Connection error")
        .when(kind == "decoding", "Decoding error").when(kind == "payload", "Payload error").when(kind.isNotNull(), told)
    )
    repeat = kind.isin("connect", "timeout", "disconnected", "connection") | ((kind == "os") & closed) | (~kind.isin("connect", "timeout", "disconnected", "os", "certificate", "connection", "decoding", "payload") & session)
    return F.struct(kind.isNotNull().alias("is_error"), comment.alias("comment"), (true(repeat) & again).alias("to_revisit"))


def status_table(spark) -> DataFrame:
    return spark.createDataFrame(list(STATUS_TEXT.items()), "status int, status_text string")


def status_text(status: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in STATUS_TEXT.items() for x in kv])[status.cast("int")]


def status_comment(status: Column) -> Column:
    """The error that a status outside 200 to 299 is; null for others and for null."""
    return F.when(~status.between(200, 299), F.concat(F.lit("Error status code :"), status.cast("string"), F.coalesce(F.concat(F.lit(": "), status_text(status)), F.lit(""))))


def with_status(df: DataFrame, status: str = "status", hops: str = "hops") -> DataFrame:
    """is_error, comment, and the history's columns. hops: array of struct(status, url), oldest first, without the page itself."""
    error = status_comment(F.col(status))
    codes = F.array_join(F.concat(F.array(F.col(status).cast("string")), F.transform(hops, lambda h: h["status"].cast("string"))), "_")
    places = F.array_join(F.concat(F.array(F.col("final_url")), F.transform(hops, lambda h: h["url"])), "___")
    return df.withColumns({"is_error": error.isNotNull(), "comment": error, "all_status_codes": codes, "history": F.size(hops), "URL_history": places})


def is_html_start(page: Column) -> Column:
    return F.substring(page, 1, 50).rlike(r"(?i)^[ \n\r\t]*<[ \n\r\t]*(html|!doctype)")


def without_long_pages(df: DataFrame, page: str = "raw_text", limit: int = LIMITS["too_long"]) -> DataFrame:
    """Pages that are no HTML and too long become errors without text."""
    long_ = true(~is_html_start(F.col(page)) & (F.length(page) > limit))
    return df.withColumns({"is_error": F.when(long_, True).otherwise(F.col("is_error")), "comment": F.when(long_, "Error: too long").otherwise(F.col("comment")), page: F.when(~long_, F.col(page))})


def allowed_keys(keys: Column, kind: str) -> Column:
    """The headers or cookies that are clues of something."""
    known = sorted({x for _, _, cookies, headers, _ in CLUES for x in (headers if kind == "headers" else cookies)})
    return F.filter(keys, lambda k: F.lower(k).isin(*known))


def describe_status(df: DataFrame, status: str = "status") -> DataFrame:
    """Left join with the table of codes."""
    table = small(status_table(df.sparkSession))
    return df.join(table.withColumnRenamed("status", "_s"), F.col(status) == F.col("_s"), "left").drop("_s")


def revisit_rounds(visit, todo: DataFrame, max_revisit: int = 1) -> DataFrame:
    """Visit, then again what needs it, at most max_revisit times. visit: DataFrame of urls to documents with to_revisit."""
    done = None
    for turn in range(max_revisit + 1):
        got = visit(todo)
        last = turn == max_revisit
        kept = got if last else got.where(~true(F.col("to_revisit")))
        done = kept if done is None else done.unionByName(kept, allowMissingColumns=True)
        if last:
            break
        todo = got.where(true(F.col("to_revisit"))).select("url")
        if not todo.limit(1).count():
            break
    return done
