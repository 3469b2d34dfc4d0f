"""Titles of pages: the query has its SQL's three escapes, the parser has all."""

from html import unescape

from lumenweb.functions.html import extract
from lumenweb.plans.catalog import ORACLES, QUERIES
from lumenweb.plans.catalog.base import table
from tests.test_catalog import DATA, pytestmark  # noqa: F401

TITLES = ["a &lt;b&gt; &amp;amp; c", "token = &quot;73ab", "cut &amp;&amp;&amp", "&eacute;&#233;", " \n x ", "&amp;lt;"]
PAGES = [f"<html><head><title>{t}</title></head></html>" for t in TITLES] + ["<p>none</p>", "<TITLE>x</TITLE>", "<title>a<b>c</b></title>", "", None]


def test_titles_of_odd_pages_equal_their_sql(spark, tmp_path):
    import duckdb

    spark.createDataFrame([(i, "u", h) for i, h in enumerate(PAGES)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted(map(tuple, QUERIES["h04_titles_of_all_pages"](spark, str(tmp_path)).collect()))
    assert got == sorted(con.execute(ORACLES["h04_titles_of_all_pages"]).fetchall())
    assert dict(got)[1] == "token = &quot;73ab" and dict(got)[2] == "cut &&&amp"


def test_the_parser_decodes_all_escapes(spark):
    assert [extract(p, "u")["title"] for p in PAGES[:6]] == [unescape(t).strip() for t in TITLES]
    titles = {r.page_id: r.title for r in QUERIES["h04_titles_of_all_pages"](spark, str(DATA)).collect()}
    for r in table(spark, str(DATA), "pages").collect():
        raw = r.html.split("<title>")[1].split("</title>")[0]
        assert extract(r.html, r.url)["title"] == unescape(raw).strip()
        assert titles[r.page_id] == raw.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&").strip(" ")
