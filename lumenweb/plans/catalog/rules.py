"""Visits, redirections, registrars, the page decision, social accounts, technologies, mail, categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.functions import patterns
from lumenweb.functions.fixed import CATEGORIES, NETWORKS, STATUS_TEXT
from lumenweb.functions.html import parse_pages
from lumenweb.operators import category, domains, parking, redirect, registrars, social, technologies, visits
from lumenweb.plans.catalog.base import CRAWL_CTE, case, crawl, derived, lit, query, sql_domain, table
from lumenweb.plans.catalog.html import PAGE

STATUS = "CASE event_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 500 + event_id % 6 WHEN 3 THEN 299 WHEN 4 THEN 777 ELSE 401 END"
KIND = {"kind": case("event_id", 12, *map(lit, "connect connect timeout disconnected os os os certificate connection decoding payload".split()), "CASE WHEN event_id % 24 = 11 THEN 'odd' END"), "message": case("event_id", 12, "'Connect call failed'", "'no name'", "''", "''", "'WinError 10054'", "'Connection reset by peer'", "'other'", *["'Session is closed'"] * 5)}


@query("e01_error_comments", "SELECT event_id, event_id % 24 <> 23 AS is_error, CASE event_id % 12 WHEN 0 THEN 'Connection error' WHEN 1 THEN 'DNS resolution error' WHEN 2 THEN 'TimeoutError' WHEN 3 THEN 'ServerDisconnected' WHEN 4 THEN 'Connection closed' WHEN 5 THEN 'Connection error' WHEN 6 THEN 'error of type os message: other' WHEN 7 THEN 'SSL error' WHEN 8 THEN 'Connection error' WHEN 9 THEN 'Decoding error' WHEN 10 THEN 'Payload error' ELSE CASE WHEN event_id % 24 = 11 THEN 'error of type odd message: Session is closed' ELSE '' END END AS comment, event_id % 12 IN (0, 1, 2, 3, 4, 8) OR event_id % 24 = 11 AS to_revisit FROM events")
def error_comments(spark, d):
    e = derived(spark, d, "events", KIND, ("event_id",)).withColumn("e", visits.error_comment(F.col("kind"), F.col("message")))
    return e.select("event_id", "e.is_error", F.coalesce("e.comment", F.lit("")).alias("comment"), "e.to_revisit")


_CODES = "(VALUES " + ", ".join(f"({k}, {lit(v)})" for k, v in STATUS_TEXT.items()) + ") c(code, said)"


@query("e02_j21_status", f"SELECT event_id, s NOT BETWEEN 200 AND 299 AS is_error, CASE WHEN s BETWEEN 200 AND 299 THEN '' ELSE concat('Error status code :', s, coalesce(': ' || said, '')) END AS comment, concat(s, '_301_302') AS all_status_codes, CAST(2 AS BIGINT) AS history, concat('http://final', event_id, '___http://a___http://b') AS \"URL_history\" FROM (SELECT event_id, {STATUS} AS s FROM events) e LEFT JOIN {_CODES} ON c.code = s")
def status(spark, d):
    hops = F.array(F.struct(F.lit(301).alias("status"), F.lit("http://a").alias("url")), F.struct(F.lit(302).alias("status"), F.lit("http://b").alias("url")))
    e = derived(spark, d, "events", {"status": STATUS, "final_url": "concat('http://final', event_id)"}, ("event_id",)).withColumn("hops", hops)
    out = visits.with_status(e)
    return out.select("event_id", "is_error", F.coalesce("comment", F.lit("")).alias("comment"), "all_status_codes", F.col("history").cast("long").alias("history"), "URL_history")


@query("j21_status_join", f"SELECT event_id, coalesce(said, '') AS status_text FROM (SELECT event_id, {STATUS} AS s FROM events) e LEFT JOIN {_CODES} ON c.code = s")
def status_join(spark, d):
    return visits.describe_status(derived(spark, d, "events", {"status": STATUS}, ("event_id",))).select("event_id", F.coalesce("status_text", F.lit("")).alias("status_text"))


@query("e03_revisit_rounds", f"WITH {CRAWL_CTE} SELECT url, page_id % 3 = 0 AS again FROM crawl")
def rounds(spark, d):
    rows = crawl(spark, d).select("page_id", "url")
    first = [True]

    def visit(todo):
        again = (F.col("page_id") % 3 == 0) if first[0] else F.lit(False)
        got = rows.join(todo.select("url"), "url", "left_semi").select("url", again.alias("to_revisit"), F.lit(not first[0]).alias("again"))
        first[0] = False
        return got

    return visits.revisit_rounds(visit, rows).select("url", "again")


@query("e05_batches", "SELECT event_id, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / ceil((SELECT count(*) FROM events) / 3.0)) AS INTEGER) AS batch FROM events")
def batches(spark, d):
    return domains.with_batches(table(spark, d, "events").select("event_id"), 3, ["event_id"])


@query("w03_s03_chunks", "SELECT page_id, CAST(floor((row_number() OVER (PARTITION BY page_id % 2 ORDER BY page_id) - 1) / CASE WHEN page_id % 2 = 0 THEN 50 ELSE 10000 END) AS INTEGER) AS chunk FROM pages")
def chunks(spark, d):
    rows = derived(spark, d, "pages", {"file": "CASE WHEN page_id % 2 = 0 THEN 'zone.ee.csv' ELSE 'zone.com.csv' END"}, ("page_id",))
    return domains.with_chunks(rows, "file", ["page_id"]).select("page_id", "chunk")


@query("a02_visit_metrics", "SELECT count(*) AS achieved, CAST(floor(round(100.0 * sum(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) / count(*), 1)) AS INTEGER) AS error_rate, CAST(round(count(*) / 120.0 * 60) AS INTEGER) AS visits_per_minute FROM events")
def visit_metrics(spark, d):
    return domains.visit_metrics(derived(spark, d, "events", {"to_revisit": "event_id % 7 = 0"}), 120.0)


@query("s35_file_report", "SELECT kind, count(DISTINCT file) AS files, count(*) AS rows FROM (SELECT CASE page_id % 5 WHEN 0 THEN 'gtld' WHEN 1 THEN 'cctld' WHEN 2 THEN 'idn' WHEN 3 THEN 'covid' ELSE 'other' END AS kind, page_id % 5 AS file FROM pages) GROUP BY kind")
def file_report(spark, d):
    return domains.file_report(derived(spark, d, "pages", {"file": case("page_id", 5, "'in/zone.shop.csv'", "'in/zone.ee.csv'", "'in/zone.xn--abc.csv'", "'in/zone.covid.com.csv'", "'in/list'")}))


@query("m07_allowed_keys", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'ETag' WHEN 1 THEN 'X-Cache' ELSE '' END AS headers, CASE page_id % 3 WHEN 0 THEN 'PHPSESSID' ELSE '' END AS cookies FROM pages")
def allowed(spark, d):
    rows = derived(spark, d, "pages", {"h": "array(CASE page_id % 3 WHEN 0 THEN 'ETag' WHEN 1 THEN 'X-Cache' ELSE 'Server' END, 'Date')", "c": "array(CASE page_id % 3 WHEN 0 THEN 'PHPSESSID' ELSE 'id' END)"}, ("page_id",))
    return rows.select("page_id", F.array_join(visits.allowed_keys(F.col("h"), "headers"), " ").alias("headers"), F.array_join(visits.allowed_keys(F.col("c"), "cookies"), " ").alias("cookies"))


def redirected(spark, d):
    pages = derived(spark, d, "pages", PAGE | {"history": "CASE WHEN page_id % 24 = 0 THEN 1 ELSE 0 END", "URL_history": "CASE WHEN page_id % 24 = 0 THEN concat('https://www.h', page_id, '.net/___http://p', page_id, '.com') ELSE concat('http://p', page_id, '.com') END", "source": "'original'", "original_url": "CAST(NULL AS VARCHAR(9))"}, ("page_id",))
    return redirect.with_redirection(parse_pages(pages))


_TYPE = "CASE WHEN page_id % 24 = 0 THEN 'http' ELSE CASE page_id % 8 WHEN 1 THEN 'meta_refresh' WHEN 2 THEN 'meta_refresh' WHEN 3 THEN 'iframe' WHEN 5 THEN 'iframe' WHEN 6 THEN 'window_location' ELSE '' END END"
_TO = "CASE WHEN page_id % 24 = 0 THEN concat('h', page_id, '.net') ELSE CASE page_id % 8 WHEN 1 THEN concat('http://www.t', page_id, '.com/a') WHEN 2 THEN concat('//t', page_id, '.com') WHEN 3 THEN concat('http://f', page_id, '.com/') WHEN 5 THEN concat('http://g', page_id, '.com') WHEN 6 THEN concat('//w', page_id, '.com/p') ELSE '' END END"


@query("c01_c02_c03_redirection", f"SELECT page_id, {_TYPE} <> '' AS is_redirected, {_TYPE} AS redirection_type, {_TO} AS target_url, page_id % 24 = 0 AS is_redirected_different_domain FROM pages")
def redirection(spark, d):
    return redirected(spark, d).select("page_id", "is_redirected", "redirection_type", F.coalesce("target_url", F.lit("")).alias("target_url"), "is_redirected_different_domain")


@query("c04_c05_same_domain", f"WITH {CRAWL_CTE} SELECT page_id, CASE WHEN target_url IS NULL THEN true WHEN {sql_domain('target_url')} = {sql_domain('url')} THEN false ELSE true END AS is_redirected, CASE WHEN target_url IS NULL THEN 'none' WHEN {sql_domain('target_url')} = {sql_domain('url')} THEN 'original' ELSE 'target' END AS source FROM crawl")
def same_domain(spark, d):
    rows = crawl(spark, d).select("page_id", "url", "target_url", F.lit(True).alias("is_redirected"), F.lit("none").alias("source"))
    return redirect.settle_same_domain(rows).select("page_id", "is_redirected", "source")


@query("c08_target_visit", f"SELECT page_id, ({_TYPE} IN ('meta_refresh', 'iframe')) AND page_id % 5 <> 0 AS visit, ({_TYPE} IN ('meta_refresh', 'iframe', 'window_location')) AND page_id % 5 <> 0 AS visit_fixed FROM pages")
def target_visit(spark, d):
    rows = redirected(spark, d).withColumn("registrar_found", F.col("page_id") % 5 == 0)
    return rows.select("page_id", redirect.needs_target_visit().alias("visit"), redirect.needs_target_visit(True).alias("visit_fixed"))


REGISTRARS = [("alpha", ".com;.net"), ("www.beta", ".org"), ("beta", ".co.uk"), ("gamma.shop", ".com")]
_SUFFIXES = [("alpha.com", "alpha"), ("alpha.net", "alpha"), ("beta.org", "beta"), ("beta.co.uk", "beta"), ("gamma.shop.com", "gamma.shop")]


def known(spark):
    return spark.createDataFrame(REGISTRARS, "hosting_name string, tld string")


@query("s04_registrar_suffixes", "SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{n}', {len(s)})" for s, n in _SUFFIXES) + ") t(suffix, name, length)")
def suffixes(spark, d):
    return registrars.suffixes(known(spark))


LINKED = {"url": "concat('p', page_id, '.com')", "target_url": "CASE page_id % 6 WHEN 0 THEN concat('http://www.x.alpha.net/', page_id) WHEN 1 THEN concat('http://P', page_id, '.com/Lander') END"}
_L1 = "CASE page_id % 6 WHEN 2 THEN 'a.beta.co.uk' WHEN 3 THEN 'alpha.com/x' WHEN 4 THEN 'notalpha.com' ELSE 'other.org' END"
_L2 = "CASE page_id % 6 WHEN 2 THEN 'beta.org' WHEN 3 THEN 'my.gamma.shop.com' ELSE 'z.com' END"


@query("j10_c06_registrar", "SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'alpha.net' WHEN 1 THEN 'GoDaddy' WHEN 2 THEN 'beta.co.uk' WHEN 3 THEN 'alpha.com__gamma.shop.com' ELSE '' END AS park_service, page_id % 6 < 3 AS registrar_found, page_id % 6 < 2 AS is_redirected_to_registrar FROM pages")
def registrar(spark, d):
    pages = derived(spark, d, "pages", LINKED | {"all_links": f"array({_L1}, {_L2}, 'z.com')"}, ("page_id",))
    out = registrars.detect(pages, registrars.suffixes(known(spark)))
    return out.select("page_id", F.coalesce("park_service", F.lit("")).alias("park_service"), "registrar_found", "is_redirected_to_registrar")


@query("s28_domain_of_line", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN concat('shop', page_id, '.co.uk') WHEN 1 THEN 'name.com' ELSE '' END AS domain FROM pages")
def lines(spark, d):
    line = F.expr("CASE page_id % 3 WHEN 0 THEN concat('  WWW.Shop', page_id, '.co.uk and more') WHEN 1 THEN '; name.com' ELSE '---' END")
    return table(spark, d, "pages").select("page_id", F.coalesce(registrars.domain_of_line(line), F.lit("")).alias("domain"))


@query("c07_c26_javascript_need", "SELECT page_id, page_id % 5 <> 4 AND page_id % 4 < 3 AS document_write, page_id % 5 <> 4 AND page_id % 4 < 3 OR page_id % 5 <> 4 AND page_id % 3 = 0 AS to_revisit_with_js FROM pages")
def javascript_need(spark, d):
    p = derived(spark, d, "pages", {"h": case("page_id", 4, "'x Document.Write ('", "'y document.writeln('", "'e.appendChild ('", "'e.APPENDCHILD('"), "n": case("page_id", 3, "'Please ENABLE javascript'", "'require it'", "''"), "s": "CASE WHEN page_id % 5 = 4 THEN 500 ELSE 499 END"}, ("page_id",))
    need = parking.javascript_need(F.col("h"), F.col("n"), F.col("s"))
    return p.withColumn("n", need).select("page_id", F.coalesce("n.document_write", F.lit(False)).alias("document_write"), "n.to_revisit_with_js")


@query("c10_empty_page", "SELECT page_id, page_id % 3 = 0 OR page_id % 4 = 0 AS js_or_iframe_found, page_id % 9 <= 5 AND NOT (page_id % 3 = 0 OR page_id % 4 = 0) AND page_id % 5 = 0 AS pred_is_empty FROM pages")
def empty(spark, d):
    p = derived(spark, d, "pages", {"n_unique_words": "page_id % 9", "html_data": "named_struct('flag_js_found', page_id % 3 = 0, 'flag_iframe', page_id % 4 = 0, 'all_links', CASE WHEN page_id % 5 = 0 THEN CAST(array() AS array<string>) ELSE array('x') END)"}, ("page_id",))
    return parking.empty_page(p).select("page_id", "js_or_iframe_found", "pred_is_empty")


@query("c14_valid_registrar", "SELECT page_id, page_id % 2 = 0 AND (page_id % 3 = 0 OR page_id % 5 = 0 OR page_id % 101 <= 50 AND page_id % 83 <= 40) AS valid FROM pages")
def valid(spark, d):
    c = F.col("page_id")
    return table(spark, d, "pages").select("page_id", parking.valid_registrar(c % 2 == 0, c % 3 == 0, c % 5 == 0, c % 101, c % 83).alias("valid"))


@query("c15_c16_validate_javascript", "SELECT page_id, page_id % 2 = 0 AS is_non_text_park, page_id % 2 = 0 AND page_id % 3 <> 0 AS is_full_js_parked, CASE WHEN page_id % 2 = 0 AND page_id % 3 <> 0 OR page_id % 5 = 0 THEN false WHEN page_id % 7 < 3 AND page_id % 3 <> 0 THEN true ELSE page_id % 11 = 0 END AS to_revisit_with_js FROM pages")
def validate_js(spark, d):
    p = derived(spark, d, "pages", {"non_text": "CASE WHEN page_id % 2 = 0 THEN 'x:PARKing' ELSE 'spark' END", "clean_text": "CASE WHEN page_id % 3 = 0 THEN repeat('a', 500) ELSE 'a' END", "raw_text": "repeat('h', 100)", "html_data": "named_struct('lg_inline_script', CASE WHEN page_id % 7 < 3 THEN 51 ELSE 50 END)", "registrar_found": "page_id % 5 = 0", "pred_ml_park": "false", "pred_is_empty": "false", "to_revisit_with_js": "page_id % 11 = 0"}, ("page_id",))
    return parking.validate_javascript(p).select("page_id", "is_non_text_park", "is_full_js_parked", "to_revisit_with_js")


@query("c09_ml_gate", "SELECT page_id, page_id % 2 > 0 AND page_id % 6 > 3 AND page_id % 5 <> 0 AS pred_ml_park FROM pages")
def gate(spark, d):
    p = derived(spark, d, "pages", {"n_sentences": "page_id % 2", "n_words": "page_id % 6", "p": "page_id % 5 <> 0"}, ("page_id",))
    return p.select("page_id", parking.ml_gate(F.col("p")).alias("pred_ml_park"))


# Planted sentences: language, text, what is found (null: nothing), whether the language has no patterns.
SENTENCES = [
    ("en", "Welcome. This domain is parked here. Bye", "p1", False), ("en", "All rights reserved on this page", None, False), ("en", "The domain was reserved", "p4", False), ("en", "No domain. Parked cars", None, False),
    ("de", "Hallo. Diese domain wird verkauft.", "sale", False), ("de", "Seite. geparkt", "parked", False), ("fr", "Ce domaine est en vente aujourd’hui", "sale", False), ("es", "La página está en mantenimiento", "parked", False),
    ("zh-cn", "欢迎。这个域名在出售。", "parked", False), ("ru", "Этот домен можно купить", "sale", False), ("sv", "En hemsida under uppbyggnad", "construction", False), ("et", "Sinu domeen on suletud lepingu", "expired", False),
    ("it", "Questo sito è disponibile, cookie", "p5", False), ("it", "Questo sito disponibile cookie", None, False), ("da", "Dit websted er lukket", None, False), ("sk", "Táto doména na predaj", "p11", False),
    ("xx", "This domain is for sale", "p3", True), ("sv", "The domain expired", "p9", False), ("en", "p{}.com is for sale", "p3", False), ("en", "", "p37", False),
]


def _pick(i: int, none: str = "CAST(NULL AS VARCHAR(9))") -> str:
    def value(x):
        return none if x is None else str(x).lower() if isinstance(x, bool) else "concat('" + x.replace("'", "''").replace("{}", "', page_id, '") + "')" if "{}" in x else lit(x)

    return case("page_id", len(SENTENCES), *[value(s[i]) for s in SENTENCES])


NOTICE = _pick(2, "''")


@query("c11_c12_c13_parking_pattern", f"SELECT page_id, page_id % 40 <> 20 AND {NOTICE} <> '' AS kw_parked, CASE WHEN page_id % 40 = 20 THEN '' ELSE {NOTICE} END AS kw_park_notice, CASE WHEN page_id % 40 <> 20 AND {_pick(3)} THEN 'xx' ELSE '' END AS missing_language FROM pages")
def pattern(spark, d):
    # Every fortieth page has too many words to be looked at.
    p = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com')", "raw_text": "'<p>this site is under construction</p>'", "clean_text": _pick(1), "language": _pick(0), "n_words": "CASE WHEN page_id % 40 = 20 THEN 1000 ELSE 10 END"}, ("page_id",))
    found = patterns.parking_pattern(F.col("raw_text"), F.col("clean_text"), F.col("language"), F.col("url"), F.col("n_words"))
    return p.withColumn("f", found).select("page_id", "f.kw_parked", *[F.coalesce(f"f.{k}", F.lit("")).alias(k) for k in ("kw_park_notice", "missing_language")])


@query("a01_missing_languages", "SELECT concat('l', doc_id % 7) AS missing_language, count(*) AS count FROM documents WHERE doc_id % 7 > 1 GROUP BY 1")
def missing(spark, d):
    return parking.missing_languages(derived(spark, d, "documents", {"missing_language": "CASE WHEN doc_id % 7 = 1 THEN 'other' WHEN doc_id % 7 > 1 THEN concat('l', doc_id % 7) END"}))


@query("c18_c19_c20_c21_result_rows", "SELECT page_id, k AS page_kind, CASE k WHEN 'redirect' THEN concat('t', page_id) ELSE concat('u', page_id) END AS url, CASE k WHEN 'redirect' THEN concat('u', page_id) ELSE 'none' END AS original_url, CASE k WHEN 'redirect' THEN 'target' ELSE CASE WHEN page_id % 8 < 4 THEN 'original' ELSE 'target' END END AS source, CASE WHEN k IN ('error', 'failed') THEN 1 WHEN k = 'normal' THEN 0 ELSE -1 END AS parked, CASE WHEN k = 'error' AND page_id % 8 >= 4 THEN 'boom' ELSE '' END AS comment FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'redirect' WHEN 2 THEN 'failed' ELSE 'normal' END AS k FROM pages)")
def result_rows(spark, d):
    none = "CAST(NULL AS VARCHAR(9))"
    columns = dict.fromkeys("flag_iframe flag_js_found is_redirected_to_registrar is_redirected_different_domain registrar_found document_write to_revisit_with_js is_full_js_parked is_non_text_park kw_parked js_or_iframe_found pred_is_empty pred_ml_park pred_is_parked is_redirected ssl_enabled to_sample is_error".split(), "false") | dict.fromkeys("n_letter n_words tag_quantity history".split(), "0") | dict.fromkeys("redirection_type park_service kw_park_notice URL_history".split(), none)
    columns |= {"url": "concat('u', page_id)", "original_url": "'none'", "source": "CASE WHEN page_id % 8 < 4 THEN 'original' ELSE 'target' END", "target_url": "concat('t', page_id)", "comment": "'boom'", "page_kind": "CASE page_id % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'redirect' WHEN 2 THEN 'failed' ELSE 'normal' END"}
    out = parking.shape(derived(spark, d, "pages", columns, ("page_id",)))
    return out.select("page_id", "page_kind", "url", "original_url", "source", F.coalesce(F.col("pred_is_parked").cast("int"), F.lit(-1)).alias("parked"), F.coalesce("comment", F.lit("")).alias("comment"))


# The oracle assigns in the order in which later reasons overwrite earlier ones.
_CATEGORY = f"""WITH {CRAWL_CTE}, f AS (SELECT *, (registrar_found OR is_full_js_parked) AND NOT is_error AS reg, lower(coalesce(comment, '')) AS c FROM crawl),
g AS (SELECT *, pred_ml_park AND NOT reg AS ml, regexp_extract(c, 'status code *: *([0-9]+)', 1) AS code, regexp_matches(c, 'status code *:') AS has_code FROM f),
h AS (SELECT *, CASE WHEN ml_feat_index_of > 0 THEN 'Index of' WHEN ml_feat_construction > 0 THEN 'Under construction' WHEN ml_feat_sale > 0 THEN 'For sale' WHEN ml_feat_starter > 0 THEN 'Starter' WHEN ml_feat_expired > 0 THEN 'Expired' WHEN ml_feat_blocked > 0 THEN 'Blocked' WHEN ml_feat_reserved > 0 THEN 'Reserved' ELSE 'Parked Notice Individual Content' END AS kind FROM g),
steps AS (SELECT page_id, [CASE WHEN code IN ('401', '402') THEN 'HTTP_401' END, CASE WHEN code IN ('403', '404', '408', '500', '502', '504') THEN 'HTTP_' || code END, CASE WHEN has_code AND code NOT IN ('401', '402', '403', '404', '408', '500', '502', '504') THEN 'HTTP_other' END,
CASE WHEN c LIKE '%dns resolution error%' THEN 'No address found' END, CASE WHEN c LIKE '%connection closed%' OR c LIKE '%serverdisconnected%' OR c LIKE '%connection error%' THEN 'Refused Connection' END, CASE WHEN c LIKE '%timeouterror%' THEN 'Timeout' END,
CASE WHEN is_error AND NOT has_code AND c NOT LIKE '%dns resolution error%' AND c NOT LIKE '%connection closed%' AND c NOT LIKE '%serverdisconnected%' AND c NOT LIKE '%connection error%' AND c NOT LIKE '%timeouterror%' THEN 'No Status Code' END,
CASE WHEN reg THEN 'Parked Notice Registrar' END, CASE WHEN ml THEN kind END,
CASE WHEN pred_is_empty AND NOT flag_js_found AND NOT ml AND NOT reg AND NOT is_error OR ml AND kind = 'Parked Notice Individual Content' AND pred_is_empty THEN 'Blank Page' END] AS s FROM h),
named AS (SELECT page_id, coalesce(list_filter(s, lambda x: x IS NOT NULL)[-1], 'High content') AS category_lv4 FROM steps)"""
_TREE = "(VALUES " + ", ".join(f"({', '.join(lit(x) for x in row)})" for row in CATEGORIES) + ") t(category_lv4, category_lv1, category_lv2, category_lv3)"


@query("c23_j22_category", _CATEGORY + f" SELECT page_id, named.category_lv4, category_lv1, category_lv2, category_lv3 FROM named LEFT JOIN {_TREE} ON named.category_lv4 = t.category_lv4")
def categories(spark, d):
    return category.with_categories(crawl(spark, d)).select("page_id", "category_lv4", "category_lv1", "category_lv2", "category_lv3")


ACCOUNTS = {"url": "concat('acme', page_id % 10, '.com')"}
_SOCIAL = "array(named_struct('link', concat('twitter.com/Acme', page_id % 10, '?x=1'), 'path', '0_1', 'tag', 'a'), named_struct('link', concat('nottwitter.com/zz', page_id), 'path', '0_2', 'tag', 'a'), named_struct('link', CASE WHEN page_id % 3 = 0 THEN 'facebook.com/share.php' ELSE 'www.Facebook.com/acme_inc/about' END, 'path', '0_3', 'tag', 'area'), named_struct('link', 'linkedin.com/company', 'path', '0_4', 'tag', 'a'))"


@query("a07_m04_social_counts", "SELECT page_id, 2 AS feat_tw_cnt, 2 AS feat_tw_cntunq, concat('acme', page_id % 10, '__zz', page_id) AS feat_tw_lks, '0_1__0_2' AS feat_tw_paths, 'a__a' AS feat_tw_types, CASE WHEN page_id % 3 = 0 THEN 'share.php' ELSE 'acme_inc' END AS feat_fb_lks, 0 AS feat_gh_cnt FROM pages")
def social_counts(spark, d):
    p = derived(spark, d, "pages", ACCOUNTS | {"links": _SOCIAL}, ("page_id",))
    return social.with_counts(p).select("page_id", "feat_tw_cnt", "feat_tw_cntunq", "feat_tw_lks", "feat_tw_paths", "feat_tw_types", "feat_fb_lks", "feat_gh_cnt")


@query("m03_o08_accounts", "SELECT page_id, " + ", ".join(f"{'true' if n == 'tw' else 'page_id % 3 <> 0' if n == 'fb' else 'false'} AS has_{full}" for n, full in NETWORKS.items()) + ", concat('acme', page_id % 10) AS feat_tw_lks, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'acme_inc' END AS feat_fb_lks FROM pages")
def accounts(spark, d):
    p = derived(spark, d, "pages", ACCOUNTS | {"links": _SOCIAL}, ("page_id",))
    return social.with_accounts(p).select("page_id", *[f"has_{x}" for x in NETWORKS.values()], "feat_tw_lks", "feat_fb_lks")


@query("m01_m02_c05_social_stage", "SELECT page_id, page_id % 8 = 7 AND page_id > 9 AS has_twitter, CASE WHEN page_id % 8 = 7 AND page_id > 9 THEN concat('p', page_id) ELSE '' END AS feat_tw_lks, page_id % 8 = 7 AS has_open_graph FROM pages")
def social_stage(spark, d):
    p = parse_pages(derived(spark, d, "pages", PAGE | {"is_error": "false"}, ("page_id",)))
    return p.select("page_id", "url").join(social.results(p), "url").select("page_id", "has_twitter", "feat_tw_lks", "has_open_graph")


_KEYS = {"header_keys": "array(CASE page_id % 3 WHEN 0 THEN 'ETag' WHEN 1 THEN 'X-Wix-Request-Id' ELSE 'Server' END)", "cookie_keys": "array(CASE page_id % 4 WHEN 0 THEN 'PHPSESSID' WHEN 1 THEN 'WordPress_Test_Cookie' ELSE 'a' END)", "libraries": "array(CASE page_id % 5 WHEN 0 THEN 'jquery.js' WHEN 1 THEN 'woocommerce.js' ELSE 'x.js' END)", "is_error": "page_id % 7 = 0"}


@query("m05_m06_features", "SELECT page_id, page_id % 7 <> 0 AND page_id % 3 = 0 AS fx_hcj__opti_etag, page_id % 7 <> 0 AND (page_id % 3 = 1 OR page_id % 4 = 1) AS fx_hcj__service_wix, page_id % 7 <> 0 AND page_id % 4 = 0 AS fx_hcj__techno_PHP, page_id % 7 <> 0 AND page_id % 5 = 0 AS fx_hcj__techno_Jquery, page_id % 7 <> 0 AND page_id % 5 = 1 AS fx_hcj__service_shop, false AS fx_hcj__secu_captcha FROM pages")
def hcj(spark, d):
    out = technologies.with_features(derived(spark, d, "pages", _KEYS, ("page_id",)), libraries=F.col("libraries"))
    return out.select("page_id", *[f"fx_hcj__{x}" for x in ("opti_etag", "service_wix", "techno_PHP", "techno_Jquery", "service_shop", "secu_captcha")])


@query("m05_features_by_join", "SELECT feature, count(*) AS pages FROM (SELECT 'fx_hcj__opti_etag' AS feature FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT 'fx_hcj__service_wix' FROM pages WHERE page_id % 3 = 1) GROUP BY feature")
def hcj_join(spark, d):
    p = derived(spark, d, "pages", _KEYS, ("page_id",)).select("page_id", F.explode(F.transform("header_keys", F.lower)).alias("key"))
    clues = technologies.clue_table(spark).where("kind = 'header'")
    return p.join(F.broadcast(clues), "key").groupBy("feature").agg(F.countDistinct("page_id").alias("pages"))


@query("m08_m09_mail", "SELECT page_id, page_id % 4 <> 3 AS has_mx_record, page_id % 4 IN (0, 1) AS has_own_mx_record, CASE page_id % 4 WHEN 3 THEN 'No answer' ELSE '' END AS mail_comment FROM pages")
def mail(spark, d):
    p = derived(spark, d, "pages", {"url": "concat('Foo', page_id, '.com')", "mx_record": "CASE page_id % 4 WHEN 0 THEN concat('MX.foo', page_id, '.com.') WHEN 1 THEN concat('mx.notfoo', page_id, '.com') WHEN 2 THEN 'mail.other.net.' END", "kind": "CASE WHEN page_id % 4 = 3 THEN 'no_answer' END"}, ("page_id",))
    return technologies.with_mail(p).select("page_id", "has_mx_record", "has_own_mx_record", technologies.mail_comment(F.col("kind")).alias("mail_comment"))
