"""The first query: categories of all pages' domains, counted by tld. And the whole plan on planted crawl rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.functions import text, urls
from lumenweb.operators import taxonomy
from lumenweb.operators.category import with_categories
from lumenweb.operators.common import add_missing, spread
from lumenweb.plans import pipeline
from lumenweb.plans.catalog.base import HOST, derived, query, sql_domain, table
from lumenweb.plans.catalog.html import PAGE
from lumenweb.plans.catalog.text import GAP


@query("domain_categories", f"""WITH p AS (SELECT {sql_domain('url')} AS domain, len(list_filter(regexp_split_to_array(regexp_replace(html, '<[^>]*>', ' ', 'g'), '{GAP}'), lambda x: x <> '')) AS words FROM pages WHERE contains(url, '.')),
c AS (SELECT regexp_extract(domain, '[^.]*$') AS tld, CASE WHEN words <= 5 THEN 'Blank Page' ELSE 'High content' END AS category_lv4 FROM p)
SELECT tld, category_lv4, CASE category_lv4 WHEN 'Blank Page' THEN 'Not used' ELSE 'High content' END AS category_lv3, count(*) AS domains FROM c GROUP BY ALL""")
def domain_categories(spark, d):
    words = F.size(F.array_remove(text.split_words(F.regexp_replace("html", "<[^>]*>", " ")), ""))
    pages = table(spark, d, "pages").where(urls.has_domain(F.col("url"))).select(urls.link_to_domain(F.col("url")).alias("domain"), (words <= 5).alias("pred_is_empty"))
    nothing = {"is_error": F.lit(False), "comment": F.lit(None).cast("string"), "registrar_found": F.lit(False), "is_full_js_parked": F.lit(False), "pred_ml_park": F.lit(False), "flag_js_found": F.lit(False)} | {f"ml_feat_{k}": F.lit(0) for k in ("index_of", "construction", "sale", "starter", "expired", "blocked", "reserved")}
    named = with_categories(add_missing(pages, nothing))
    return named.groupBy(urls.tld(F.col("domain")).alias("tld"), "category_lv4", "category_lv3").agg(F.count("*").alias("domains"))


def crawl_rows(spark, d):
    """Planted pages with a visit of each redirection's target, and errors."""
    pages = derived(spark, d, "pages", PAGE | {"is_error": "page_id % 16 = 8", "comment": "CASE WHEN page_id % 16 = 8 THEN 'Error status code :404: Not Found' END", "status": "CASE WHEN page_id % 16 = 8 THEN 404 ELSE 200 END", "history": "0", "URL_history": "concat('https://p', page_id, '.com')", "source": "'original'", "visit_kind": "'original'", "original_url": "CAST(NULL AS VARCHAR(9))", "mx_record": "concat('mx.p', page_id, '.com.')", "header_keys": "array('ETag')", "cookie_keys": "CAST(array() AS array<string>)"}, ("page_id",))
    to = F.expr("CASE page_id % 8 WHEN 1 THEN concat('http://www.t', page_id, '.com/a') WHEN 2 THEN concat('//t', page_id, '.com') WHEN 3 THEN concat('http://f', page_id, '.com/') ELSE concat('http://g', page_id, '.com') END")
    targets = pages.where("page_id % 8 in (1, 2, 3, 5)").withColumns({"original_url": F.col("url"), "url": to, "raw_text": F.lit("<html><body><p>This domain is for sale. Buy the domain now, this domain is for sale here.</p></body></html>"), "source": F.lit("target"), "visit_kind": F.lit("target")})
    return pages.unionByName(targets)


_DONE = "CASE WHEN page_id % 16 = 8 THEN 'HTTP_404' WHEN page_id % 8 IN (1, 2, 3, 5) THEN 'For sale' WHEN page_id % 8 = 7 THEN 'High content' ELSE 'High content' END"


@query("c17_c22_c24_c25_k01_pipeline", f"SELECT concat('p', page_id, '.com') AS input_url, {_DONE} AS category_lv4, CASE WHEN page_id % 16 <> 8 AND page_id % 8 IN (1, 2, 3, 5) THEN 'target' ELSE CASE page_id % 8 WHEN 6 THEN 'target' ELSE 'original' END END AS source, page_id % 8 = 7 AND page_id > 9 AS has_twitter, true AS has_own_mx_record, page_id % 16 <> 8 AS fx_hcj__opti_etag FROM pages")
def whole(spark, d):
    crawl = crawl_rows(spark, d)
    words = taxonomy.own(spark)
    known = spark.createDataFrame([("alpha", ".com")], "hosting_name string, tld string")
    domains = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com')"})
    # A stand-in for the fitted model: two words for sale and more.
    predict = lambda df: df.withColumn("ml_prediction", F.col("ml_feat_sale") > 0)
    out = pipeline.run(domains, crawl, words, known, predict)
    return out.select("input_url", "category_lv4", "source", "has_twitter", "has_own_mx_record", "fx_hcj__opti_etag")


@query("pipeline_on_all_pages")
def all_pages(spark, d):
    """The whole plan on the table of pages as it is."""
    pages = derived(spark, d, "pages", {"url": f"concat('p', page_id, '.', lower({HOST}))", "raw_text": "html", "is_error": "false", "comment": "CAST(NULL AS VARCHAR(9))"}, ("page_id",))
    known = spark.createDataFrame([("alpha", ".com")], "hosting_name string, tld string")
    out = pipeline.run(pages.select("url"), spread(pages.drop("page_id")), taxonomy.own(spark), known)
    return out.select("input_url", "tld", "category_lv1", "category_lv4", "n_words", "n_letter", "flag_js_found", "language")
