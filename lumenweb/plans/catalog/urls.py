"""URL and string functions, domain lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.functions import urls
from lumenweb.functions.fixed import DETECTOR_CODES
from lumenweb.functions.text import trim_stop_words
from lumenweb.operators import domains, output, taxonomy
from lumenweb.plans.catalog.base import HOST, case, crawl, CRAWL_CTE, cte, derived, query, sql_clean, sql_domain, table

LINK = {"link": case("page_id", 8, "url", "concat('http://www.', url)", "concat('/', page_id)", "'#top'", "'mailto:a@b.c'", "concat(url, '/x/blank.html')", "'./x/y'", "''"), "base": case("page_id", 3, f"{HOST}", f"concat({HOST}, '/')", f"concat('http://', {HOST})"), "name": case("page_id", 9, "concat('/Ab_', page_id, '/')", "'company/Acme-Inc'", "'in'", "'r/pics'", "'A-b_C?x=1&y'", "'acme&z=2'", "'acme_inc'", "'x/y'", "'r'"), "kind": case("page_id", 3, "'lk'", "'rd'", "'fb'")}
LINKS = f"WITH {cte('l', 'pages', LINK, ('page_id', 'url'))} "


def links(spark, d):
    return derived(spark, d, "pages", LINK, ("page_id", "url"))


@query("f01_clean_link", f"SELECT page_id, {sql_clean('url')} AS link FROM pages")
def clean_link(spark, d):
    return table(spark, d, "pages").select("page_id", urls.clean_link(F.col("url")).alias("link"))


@query("f02_link_to_domain", f"SELECT page_id, {sql_domain('url')} AS domain FROM pages")
def link_to_domain(spark, d):
    return table(spark, d, "pages").select("page_id", urls.link_to_domain(F.col("url")).alias("domain"))


@query("f05_is_trivial_link", LINKS + "SELECT page_id, link = '' OR link LIKE '#%' OR link LIKE 'mailto%' OR regexp_matches(split_part(link, '/', -1), 'blank|empty|notfound') AS trivial FROM l")
def trivial(spark, d):
    return links(spark, d).select("page_id", urls.is_trivial_link(F.col("link")).alias("trivial"))


@query("f06_relative_to_absolute", LINKS + ", m AS (SELECT page_id, link, regexp_replace(regexp_replace(base, '/$', ''), '^(https?:)?//', '') AS b FROM l) SELECT page_id, CASE WHEN regexp_matches(link, '^https?:', 'i') OR starts_with(link, '//') THEN link WHEN starts_with(link, './') THEN 'http://' || b || substr(link, 2) WHEN starts_with(link, '/') THEN 'http://' || b || link ELSE 'http://' || b || '/' || link END AS link FROM m")
def absolute(spark, d):
    return links(spark, d).select("page_id", urls.absolute(F.col("link"), F.col("base")).alias("link"))


@query("f07_final_url", "SELECT page_id, split_part(concat(url, '___', 'http://first.com', '___', page_id), '___', 1) AS final FROM pages")
def history(spark, d):
    return table(spark, d, "pages").select("page_id", F.substring_index(F.concat("url", F.lit("___http://first.com___"), F.col("page_id").cast("string")), "___", 1).alias("final"))


@query("f09_remove_format_tags", "SELECT page_id, md5(regexp_replace(html, '</?(u|b|em|sub|sup|strong|br)>', '', 'g')) AS digest FROM pages")
def format_tags(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(urls.remove_format_tags(F.col("html"))).alias("digest"))


@query("f10_file_name", "SELECT page_id, regexp_replace(url, '[/:*?\"<>|]', '_', 'g') AS name FROM pages")
def file_name(spark, d):
    return table(spark, d, "pages").select("page_id", urls.file_name(F.col("url")).alias("name"))


@query("f11_without_parameters", LINKS + "SELECT page_id, lower(split_part(split_part(name, '?', 1), '&', 1)) AS name FROM l")
def without_parameters(spark, d):
    return links(spark, d).select("page_id", urls.without_parameters(F.col("name")).alias("name"))


_TWO = ", ".join(f"'{s}'" for s in urls.TWO_LABEL_SUFFIXES)


@query("f12_registered_name", f"WITH h AS (SELECT page_id, string_split(concat('www.', lower({HOST}), CASE WHEN page_id % 4 = 0 THEN '.co.uk' ELSE '' END), '.') AS l FROM pages) SELECT page_id, CASE WHEN concat(l[-2], '.', l[-1]) IN ({_TWO}) THEN l[-3] ELSE l[-2] END AS name FROM h")
def registered(spark, d):
    host = derived(spark, d, "pages", {"h": f"concat('http://www.', 'www.', lower({HOST}), CASE WHEN page_id % 4 = 0 THEN '.co.uk' ELSE '' END, '/x')"}, ("page_id",))
    return host.select("page_id", urls.registered_name(F.col("h")).alias("name"))


@query("f13_account_name", LINKS + ", t AS (SELECT page_id, kind, regexp_replace(regexp_replace(name, '^/', ''), '/$', '') AS n FROM l) SELECT page_id, CASE WHEN kind = 'lk' AND split_part(n, '/', 1) IN ('company', 'in') OR kind = 'rd' AND split_part(n, '/', 1) = 'r' THEN split_part(n, '/', 2) ELSE n END AS name FROM t")
def account(spark, d):
    return links(spark, d).select("page_id", urls.account_name(F.col("name"), F.col("kind")).alias("name"))


@query("f14_distance_key", LINKS + "SELECT page_id, replace(replace(lower(name), '-', ''), '_', '') AS k FROM l")
def distance_key(spark, d):
    return links(spark, d).select("page_id", urls.distance_key(F.col("name")).alias("k"))


@query("f15_name_distance", LINKS + f", t AS (SELECT page_id, name AS a, CASE WHEN page_id % 4 = 0 THEN name ELSE split_part({HOST}, '.', 1) END AS b FROM l) SELECT page_id, CASE WHEN a = b THEN -1 WHEN contains(b, a) OR contains(a, b) THEN 0 ELSE levenshtein(a, b) END AS distance FROM t")
def name_distance(spark, d):
    host = F.when(F.col("page_id") % 4 == 0, F.col("name")).otherwise(F.expr(f"split_part({HOST}, '.', 1)"))
    return links(spark, d).select("page_id", urls.name_distance(F.col("name"), host).cast("long").alias("distance"))


@query("f16_f19_lower_keys", LINKS + "SELECT page_id, len(list_distinct([lower(name), lower(kind), name, upper(kind)])) AS n, lower(kind) AS k FROM l")
def keys(spark, d):
    row = links(spark, d).withColumn("m", F.create_map(F.upper("kind"), F.lit(1), F.col("kind"), F.lit(2)))
    all_ = F.array("name", "kind", F.upper("kind"), F.lower("name"))
    raw = F.array(F.lower("name"), F.lower("kind"), F.col("name"), F.upper("kind"))
    return row.select("page_id", F.size(F.array_distinct(raw)).cast("long").alias("n"), F.map_keys(urls.lower_map_keys(F.col("m")))[0].alias("k"), all_.alias("_a")).drop("_a")


@query("f20_document_name", "SELECT page_id, concat('obj_documents_', 'list', page_id, '.json') AS name FROM pages")
def document_name(spark, d):
    return table(spark, d, "pages").select("page_id", urls.document_name(F.concat(F.lit("list"), F.col("page_id"), F.lit(".csv"))).alias("name"))


@query("f22_replace_known", LINKS + "SELECT page_id, CASE kind WHEN 'lk' THEN 'linkedin' WHEN 'rd' THEN 'reddit' ELSE kind END AS kind FROM l")
def replace_known(spark, d):
    return links(spark, d).select("page_id", urls.replace_known(F.col("kind"), {"lk": "linkedin", "rd": "reddit"}).alias("kind"))


@query("f23_detector_codes", "SELECT doc_id, CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' WHEN 'fr' THEN 'fr' WHEN 'es' THEN 'es' END AS code, CASE doc_id % 3 WHEN 0 THEN 'pt' WHEN 1 THEN 'zh-cn' ELSE 'xx' END AS other FROM documents")
def codes(spark, d):
    other = F.expr("CASE doc_id % 3 WHEN 0 THEN 'pt-br' WHEN 1 THEN 'zh' ELSE 'xx' END")
    return table(spark, d, "documents").select("doc_id", urls.replace_known(F.col("lang"), DETECTOR_CODES).alias("code"), urls.replace_known(other, DETECTOR_CODES).alias("other"))


@query("f25_derived_words", "SELECT r.root, coalesce(f.word, r.root) AS word FROM (SELECT DISTINCT concat('w', page_id % 50) AS root FROM pages) r LEFT JOIN (SELECT DISTINCT concat('w', page_id % 25) AS root, concat('w', page_id % 25, 's') AS word FROM pages) f ON r.root = f.root")
def derived_words(spark, d):
    p = table(spark, d, "pages")
    forms = p.select(F.expr("concat('w', page_id % 25)").alias("root"), F.expr("concat('w', page_id % 25, 's')").alias("word")).distinct()
    return taxonomy.derived(p.select(F.expr("concat('w', page_id % 50)").alias("root")), forms)


@query("f26_f27_trim_stop_words", "SELECT page_id, concat('domain ', page_id, ' of sale') AS phrase FROM pages")
def stop_words(spark, d):
    phrase = F.expr("concat(CASE WHEN page_id % 2 = 0 THEN 'the of the ' ELSE 'a ' END, 'domain ', page_id, ' of sale', CASE WHEN page_id % 3 = 0 THEN ' of the' ELSE '' END)")
    return table(spark, d, "pages").select("page_id", trim_stop_words(phrase, ["the", "of", "a"]).alias("phrase"))


@query("p01_strip_dot", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat(url, CASE WHEN page_id % 4 = 0 THEN '.' ELSE '' END) ELSE url END AS url FROM pages")
def strip_dot(spark, d):
    return table(spark, d, "pages").select("page_id", urls.strip_dot(F.expr("CASE WHEN page_id % 2 = 0 THEN concat(url, CASE WHEN page_id % 4 = 0 THEN '..' ELSE '.' END) ELSE url END")).alias("url"))


NAMES = {"url": case("page_id", 5, "'bücher.example'", "'пример.испытание'", "'nodot'", f"concat({HOST}, '.')", f"{HOST}"), "extra": "page_id * 2"}


@query("p02_p03_normalize_domains", f"WITH {cte('n', 'pages', NAMES, ('page_id',))} SELECT page_id, extra, CASE url WHEN 'bücher.example' THEN 'xn--bcher-kva.example' WHEN 'пример.испытание' THEN 'xn--e1afmkfd.xn--80akhbyknj4f' ELSE regexp_replace(url, '[.]$', '') END AS url, contains(url, '.') AS ind_non_schema FROM n")
def normalize(spark, d):
    return domains.normalize(derived(spark, d, "pages", NAMES, ("page_id",)))


@query("p04_visit_set", f"WITH {cte('n', 'pages', NAMES)} SELECT DISTINCT url FROM n WHERE contains(url, '.')")
def visit_set(spark, d):
    return domains.visit_set(derived(spark, d, "pages", NAMES))


@query("p05_visit_order")
def visit_order(spark, d):
    return domains.visit_order(crawl(spark, d).select("page_id", "url")).orderBy("visit_order", "page_id")


@query("p11_is_digits", "SELECT page_id, regexp_full_match(CASE page_id % 3 WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN concat(page_id, '.0') ELSE '' END, '[0-9]+') AS digits FROM pages")
def digits(spark, d):
    return table(spark, d, "pages").select("page_id", output.is_digits(F.expr("CASE page_id % 3 WHEN 0 THEN string(page_id) WHEN 1 THEN concat(page_id, '.0') ELSE '' END")).alias("digits"))


@query("p15_tld", f"WITH {CRAWL_CTE} SELECT page_id, regexp_extract(url, '[^.]*$') AS tld FROM crawl")
def tld(spark, d):
    return crawl(spark, d).select("page_id", urls.tld(F.col("url")).alias("tld"))


@query("p16_final_url", "SELECT page_id, replace(CASE WHEN page_id % 2 = 0 THEN concat('t,', page_id) ELSE url END, ',', '') AS final_url FROM pages")
def final_url(spark, d):
    return table(spark, d, "pages").select("page_id", urls.final_url(F.col("url"), F.expr("CASE WHEN page_id % 2 = 0 THEN concat('t,', page_id, '\n\t') END")).alias("final_url"))


@query("p25_p26_short_words", "WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'vi' WHEN 1 THEN 'ig' WHEN 2 THEN 'en' ELSE 'ro' END AS lgg, substr('abc', 1, CAST(1 + doc_id % 3 AS INTEGER)) AS trs_direct FROM documents) SELECT doc_id, lgg, trs_direct FROM t WHERE NOT (lgg IN ('vi', 'ro') AND length(trs_direct) <= 2 OR lgg = 'ig' AND length(trs_direct) <= 1)")
def short_words(spark, d):
    return taxonomy.clear(derived(spark, d, "documents", {"lgg": "CASE doc_id % 4 WHEN 0 THEN 'vi' WHEN 1 THEN 'ig' WHEN 2 THEN 'en' ELSE 'ro' END", "trs_direct": "substr('abc', 1, CAST(1 + doc_id % 3 AS INTEGER))"}, ("doc_id",)))


@query("p28_encoding", "SELECT doc_id, md5(text) AS digest FROM documents")
def encoding(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(F.decode(F.encode("text", "UTF-8"), "UTF-8")).alias("digest"))
