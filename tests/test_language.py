"""Language detection beside plain Python, and its text made once a row."""

import re

from pyspark.sql import functions as F

from lumenweb.functions import language
from lumenweb.plans.catalog.base import table
from tests.test_catalog import DATA, pytestmark  # noqa: F401

ODD = ["", None, "12345", "123 Der Mann und die Frau. Das ist ein Haus!", "og det at og det at", "Привет мир и в не на что я", "漢字 かな 漢字漢字 漢字 漢", "한국어 텍스트 입니다 그리고", "9" * 4000 + " the of and to in is that", "on on on on on on", "the 漢 of and 字 漢字漢字漢字漢", "١٢٣ عربي نص هنا", "for die para en"]


def plain(text):
    if text is None or len(text) <= 10:
        return "other"
    head = re.sub("^[0-9]*", "", text)[:3000]
    head = "".join(s for s in (m[0] for m in re.finditer(r"[^?.!]*(?:[?.!]|\Z)", head)) if len(re.sub(r"[?.!]\Z", "", s)) > 4).lower()
    words = re.findall(r"[^\W\d_]+", head)
    scores = [(sum(w in c.split() for w in words), g) for g, c in language.COMMON.items()]
    scores += [(2 * len(re.findall(s, head)) // 3, g) for g, s in language.SCRIPTS.items()]
    n, g = min(scores, key=lambda x: (-x[0], x[1]))
    return g if n else "other"


def test_detection_beside_plain_python(spark):
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, text string").select("i", "text", language.detect(F.col("text")).alias("g")).collect()
    assert [(r.i, r.g) for r in odd] == [(r.i, plain(r.text)) for r in odd]
    found = table(spark, str(DATA), "documents").select("doc_id", "text", language.detect(F.col("text")).alias("g")).collect()
    assert {r.doc_id: r.g for r in found} == {r.doc_id: plain(r.text) for r in found}


def test_the_text_is_made_once_a_row(spark):
    rows = spark.createDataFrame([("a",)], "text string").select(language.detect(F.col("text")).alias("g"))
    assert rows._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 1
