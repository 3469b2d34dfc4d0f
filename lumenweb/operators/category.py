"""The final category of a domain, in four levels. The lowest is decided by rules; the others are looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import CATEGORIES, CLASS_ORDER
from lumenweb.operators.common import true

# What comments say of an error.
STATUS_RULES = {"HTTP_401": "40[12]", "HTTP_403": "403", "HTTP_404": "404", "HTTP_408": "408", "HTTP_500": "500", "HTTP_502": "502", "HTTP_504": "504"}
COMMENT_RULES = {"No address found": "DNS resolution error", "Refused Connection": "Connection closed|ServerDisconnected|Connection error", "Timeout": "TimeoutError"}
_STATUS = "status code *: *"


def lowest(df_columns: set[str] | None = None) -> Column:
    """category_lv4 from is_error, comment, registrar_found, is_full_js_parked, pred_ml_park, ml_feat_*, pred_is_empty, flag_js_found.

    A when chain takes the first that holds, so the strongest reason stands first: a blank page, then what a parked page
    is for, a registrar, and errors last.
    """
    said = F.coalesce(F.col("comment"), F.lit(""))
    error = true(F.col("is_error"))
    says = lambda p: said.rlike("(?i)" + p)
    registrar = (true(F.col("registrar_found")) | true(F.col("is_full_js_parked"))) & ~error
    ml = true(F.col("pred_ml_park")) & ~registrar
    kind = F.coalesce(*[F.when(F.col(f"ml_feat_{k}") > 0, name) for k, name in CLASS_ORDER.items()], F.lit("Parked Notice Individual Content"))
    empty = true(F.col("pred_is_empty"))
    blank = empty & ((~true(F.col("flag_js_found")) & ~ml & ~registrar & ~error) | (ml & (kind == "Parked Notice Individual Content")))
    status = [(says(_STATUS + p), name) for name, p in STATUS_RULES.items()]
    other = says(_STATUS) & ~says(_STATUS + "(" + "|".join(STATUS_RULES.values()) + ")")
    reasons = [(says(p), name) for name, p in COMMENT_RULES.items()]
    unknown = error & ~says(_STATUS)
    for flag, _ in reasons:
        unknown = unknown & ~flag
    chain = F.when(blank, "Blank Page").when(ml, kind).when(registrar, "Parked Notice Registrar").when(unknown, "No Status Code")
    for flag, name in [*reversed(reasons), (other, "HTTP_other"), *reversed(status)]:
        chain = chain.when(flag, name)
    return chain.otherwise("High content")


def table(spark) -> DataFrame:
    """(category_lv4, category_lv1, category_lv2, category_lv3)."""
    return spark.createDataFrame(CATEGORIES, "category_lv4 string, category_lv1 string, category_lv2 string, category_lv3 string")


def with_categories(df: DataFrame) -> DataFrame:
    """All four levels: the upper ones by a broadcast of the 24 rows."""
    return df.withColumn("category_lv4", lowest()).join(F.broadcast(table(df.sparkSession)), "category_lv4", "left")
