"""Joins, consolidation, output shaping and the warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.operators import consolidate, domains, output, registrars, social, taxonomy
from lumenweb.plans.catalog.base import CRAWL_CTE, crawl, derived, query, table

# Results of originals, of targets (every third, sometimes an error, which brings few columns), of browser pages (every fifth).
_ORIGINAL = {"url": "concat('p', page_id)", "original_url": "CAST(concat('p', page_id) AS VARCHAR(20))", "n_words": "page_id", "kw_park_notice": "'o'", "pred_is_parked": "false", "to_sample": "true", "target_url": "CAST(NULL AS VARCHAR(20))", "page_kind": "'normal'"}
_TARGET = {"url": "concat('t', page_id)", "original_url": "concat('p', page_id)", "n_words": "CASE WHEN page_id % 9 = 0 THEN CAST(NULL AS BIGINT) ELSE page_id + 1000 END", "kw_park_notice": "CASE WHEN page_id % 2 = 0 THEN 't' END", "pred_is_parked": "true", "to_sample": "false", "target_url": "CAST(NULL AS VARCHAR(20))", "page_kind": "CASE WHEN page_id % 9 = 0 THEN 'error' ELSE 'normal' END"}


def _originals(spark, d):
    return derived(spark, d, "pages", _ORIGINAL)


def _targets(spark, d):
    return derived(spark, d, "pages", _TARGET, ("page_id",)).where("page_id % 3 = 0").drop("page_id")


@query("j07_with_targets", "SELECT concat('p', page_id) AS url, CASE WHEN page_id % 3 = 0 THEN concat('t', page_id) ELSE '' END AS target_url, CASE WHEN page_id % 9 = 0 OR page_id % 3 <> 0 THEN page_id ELSE page_id + 1000 END AS n_words, CASE WHEN page_id % 9 = 0 OR page_id % 3 <> 0 THEN 'o' WHEN page_id % 2 = 0 THEN 't' ELSE '' END AS notice, page_id % 3 = 0 AS pred_is_parked, true AS to_sample FROM pages")
def with_targets(spark, d):
    out = consolidate.with_targets(_originals(spark, d), _targets(spark, d))
    return out.select("url", F.coalesce("target_url", F.lit("")).alias("target_url"), "n_words", F.coalesce("kw_park_notice", F.lit("")).alias("notice"), "pred_is_parked", "to_sample")


@query("j08_with_browser", "SELECT concat('p', page_id) AS url, CASE WHEN page_id % 5 = 0 THEN -page_id ELSE page_id END AS n_words, page_id % 5 <> 0 AS to_sample, page_id % 5 = 0 AS is_js_rendered_results FROM pages")
def with_browser(spark, d):
    browser = derived(spark, d, "pages", _ORIGINAL | {"original_url": "CAST(NULL AS VARCHAR(20))", "n_words": "-page_id", "to_sample": "false"}, ("page_id",)).where("page_id % 5 = 0").drop("page_id")
    originals = _originals(spark, d).withColumn("original_url", F.lit(None).cast("string"))
    return consolidate.with_browser(originals, browser).select("url", "n_words", "to_sample", "is_js_rendered_results")


@query("j09_social_targets", "SELECT concat('p', page_id) AS url, page_id % 3 = 0 AS has_twitter, CASE WHEN page_id % 3 = 0 THEN concat('t', page_id) ELSE '' END AS target_url FROM pages")
def social_targets(spark, d):
    a = derived(spark, d, "pages", {"url": "concat('p', page_id)", "has_twitter": "false"})
    b = derived(spark, d, "pages", {"url": "concat('t', page_id)", "original_url": "concat('p', page_id)", "has_twitter": "true"}, ("page_id",)).where("page_id % 3 = 0").drop("page_id")
    return social.with_targets(a, b).select("url", "has_twitter", F.coalesce("target_url", F.lit("")).alias("target_url"))


@query("j01_j02_j03_j04_p13_p14_stages", f"WITH {CRAWL_CTE} SELECT page_id, url, page_id * 2 AS n_words, CASE WHEN page_id % 2 = 0 THEN page_id END AS extra, 'left' AS side FROM crawl")
def stages(spark, d):
    c = crawl(spark, d)
    left = c.select("page_id", "url", F.lit("left").alias("side"))
    words = c.select("url", (F.col("page_id") * 2).alias("n_words"), F.lit("right").alias("side"))
    return consolidate.stage(consolidate.stage(left, words), c.where("page_id % 2 = 0").select("url", F.col("page_id").alias("extra"))).select("page_id", "url", "n_words", "extra", "side")


@query("j05_crawl_over", f"WITH {CRAWL_CTE} SELECT url, CASE WHEN page_id % 4 = 0 THEN true ELSE is_error END AS is_error, CASE WHEN page_id % 4 = 0 THEN 'target' ELSE coalesce(comment, '') END AS comment, page_id AS n FROM crawl")
def crawl_over(spark, d):
    c = crawl(spark, d)
    out = c.select("url", F.when(F.col("page_id") % 4 == 0, True).alias("is_error"), F.when(F.col("page_id") % 4 == 0, "target").alias("comment"), F.lit(0).alias("n"))
    return consolidate.crawl_over(out, c.select("url", "is_error", "comment", F.col("page_id").alias("n"))).select("url", "is_error", F.coalesce("comment", F.lit("")).alias("comment"), "n")


@query("j06_unvisited", f"WITH {CRAWL_CTE} SELECT page_id, url FROM crawl WHERE NOT (page_id % 2 = 0 AND page_id % 6 <> 0)")
def unvisited(spark, d):
    c = crawl(spark, d)
    seen = c.where("page_id % 2 = 0").select("url", (F.col("page_id") % 6 == 0).alias("to_revisit"))
    return domains.unvisited(c.select("page_id", "url"), seen).select("page_id", "url")


@query("j12_label_merge", "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def label_merge(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")


@query("j13_merge_translations", "SELECT coalesce(a.index, b.index, c.index) AS index, direct, context, double FROM (SELECT page_id AS index, 'd' AS direct FROM pages WHERE page_id % 2 = 0) a FULL JOIN (SELECT page_id AS index, 'c' AS context FROM pages WHERE page_id % 3 = 0) b ON a.index = b.index FULL JOIN (SELECT page_id AS index, 'x' AS double FROM pages WHERE page_id % 5 = 0) c ON coalesce(a.index, b.index) = c.index")
def merge_translations(spark, d):
    part = lambda n, name, v: table(spark, d, "pages").where(f"page_id % {n} = 0").select(F.col("page_id").alias("index"), F.lit(v).alias(name))
    return taxonomy.merge_translations(part(2, "direct", "d"), part(3, "context", "c"), part(5, "double", "x"))


_TAXO = {"lgg": "CASE page_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END", "trs_direct": "concat('W', page_id % 40)", "root": "concat('R', page_id % 40 % 7)", "word_type": "CASE WHEN page_id % 40 % 7 = 0 THEN 'core' ELSE 'attr' END", "end_class": "'sale'"}


@query("s06_j11_taxonomy", "WITH t AS (SELECT CASE page_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END AS lgg, concat('w', page_id % 40) AS word, concat('r', page_id % 40 % 7) AS root FROM pages) SELECT lgg, word, max(root) AS root FROM (SELECT * FROM t UNION ALL SELECT 'other', word, root FROM t) GROUP BY lgg, word")
def taxonomy_words(spark, d):
    return taxonomy.translations(derived(spark, d, "pages", _TAXO))


@query("s06_o06_vocabulary", "SELECT concat('r', i) AS root, CASE i WHEN 0 THEN 'core' ELSE 'attr' END AS word_type FROM (SELECT DISTINCT page_id % 40 % 7 AS i FROM pages) UNION ALL SELECT * FROM (VALUES ('hello', 'other'), ('world', 'other'), ('hello_world', 'other'), ('x_url', 'core'), ('wordpress', 'other'), ('wix', 'other'), ('microsoft', 'other'), ('lorem_ipsum', 'other'), ('index_of', 'other'), ('index', 'other'), ('no_website', 'other')) t")
def vocabulary(spark, d):
    return taxonomy.word_table(derived(spark, d, "pages", _TAXO)).select("root", "word_type")


@query("j11_translate_words", "WITH t AS (SELECT CASE page_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END AS lgg, concat('w', page_id % 40) AS word, concat('r', page_id % 40 % 7) AS root FROM pages), a AS (SELECT lgg, word, max(root) AS root FROM (SELECT * FROM t UNION ALL SELECT 'other', word, root FROM t) GROUP BY lgg, word) SELECT doc_id, d.lgg, d.word, coalesce(a.root, d.word) AS root FROM (SELECT doc_id, lang AS lgg, concat('w', doc_id % 60) AS word FROM documents) d LEFT JOIN a ON a.lgg = CASE WHEN d.lgg IN ('en', 'de', 'fr') THEN d.lgg ELSE 'other' END AND a.word = d.word")
def translate_words(spark, d):
    words = derived(spark, d, "documents", {"lgg": "lang", "word": "concat('w', doc_id % 60)"}, ("doc_id",))
    return taxonomy.translate_words(words, derived(spark, d, "pages", _TAXO))


@query("j14_add_word_features", "SELECT concat('R', i % 7) AS root, i AS n, CASE i % 7 WHEN 0 THEN 'core' ELSE 'attr' END AS word_type FROM (SELECT page_id AS i FROM pages UNION ALL SELECT page_id FROM pages WHERE page_id % 2 = 0)")
def word_features(spark, d):
    p = derived(spark, d, "pages", {"root": "concat('R', page_id % 7)", "n": "page_id"}, ("page_id",))
    roots = derived(spark, d, "pages", {"root": "concat('R', page_id % 7)", "word_type": "CASE WHEN page_id % 7 = 0 THEN 'core' ELSE 'attr' END", "end_class": "'x'"}).distinct()
    return taxonomy.add_word_features(p.drop("page_id"), p.where("page_id % 2 = 0").drop("page_id"), roots).select("root", "n", "word_type")


@query("j15_u06_extend_registrars", "SELECT n.name, t.tld, n.name || t.tld AS domain FROM (SELECT DISTINCT concat('r', page_id % 30) AS name FROM pages) n CROSS JOIN (VALUES ('.com'), ('.net'), ('.org')) t(tld) WHERE n.name || t.tld NOT IN (SELECT concat('r', page_id % 30, '.com') FROM pages WHERE page_id % 2 = 0)")
def extend(spark, d):
    p = table(spark, d, "pages")
    tlds = spark.createDataFrame([(".com",), (".net",), (".org",)], "tld string")
    return registrars.extend(p.select(F.expr("concat('r', page_id % 30)").alias("name")), tlds, p.where("page_id % 2 = 0").select(F.expr("concat('r', page_id % 30, '.com')").alias("domain"))).select("name", "tld", "domain")


_REG = {"name": "concat('r', page_id % 20)", "tld": "CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END", "domain": "concat('r', page_id % 20, CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END)"}
_REG_SQL = "r AS (SELECT page_id, " + ", ".join(f"{v} AS {k}" for k, v in _REG.items()) + " FROM pages)"


def reg(spark, d):
    return derived(spark, d, "pages", _REG, ("page_id",))


@query("a20_a21_a22_k27_collapse", f"WITH {_REG_SQL} SELECT name, string_agg(tld, ';' ORDER BY tld) AS tld FROM (SELECT DISTINCT name, tld FROM r) GROUP BY name")
def collapse(spark, d):
    return registrars.collapse(reg(spark, d))


@query("s29_explode_tlds", f"WITH {_REG_SQL} SELECT DISTINCT name, tld FROM r")
def explode(spark, d):
    return registrars.explode_tlds(registrars.collapse(reg(spark, d)))


@query("a23_registrar_counts", f"WITH {_REG_SQL} SELECT count(DISTINCT name) AS names, count(DISTINCT (name, tld)) AS domains FROM r")
def counts(spark, d):
    return registrars.counts(registrars.collapse(reg(spark, d)))


@query("a24_k34_duplicates", f"WITH {_REG_SQL} SELECT domain, count(*) AS count FROM r GROUP BY domain HAVING count(*) > 1")
def duplicates(spark, d):
    return registrars.duplicates(reg(spark, d))


@query("u03_merge_registrars", f"WITH {_REG_SQL} SELECT name, tld, (name, tld) NOT IN (SELECT (name, tld) FROM r WHERE page_id % 2 = 0) AS added FROM (SELECT DISTINCT name, tld FROM r)")
def merge(spark, d):
    r = reg(spark, d)
    all_, new = registrars.merge(r.where("page_id % 2 = 0"), r.where("page_id % 2 = 1"))
    return all_.join(new.withColumn("added", F.lit(True)), ["name", "tld"], "left").select("name", "tld", F.coalesce("added", F.lit(False)).alias("added"))


@query("j19_semi_filter", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def semi(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi")


@query("p12_column_order", f"WITH {CRAWL_CTE} SELECT url, is_error, pred_is_empty, page_id FROM crawl")
def order(spark, d):
    return output.order_columns(crawl(spark, d)).select("url", "is_error", "pred_is_empty", "page_id")


@query("p06_p07_p08_projections", f"WITH {CRAWL_CTE} SELECT url, CASE WHEN is_error THEN '' ELSE 'x' END AS language, CASE WHEN is_error THEN coalesce(comment, '') ELSE '' END AS comment FROM crawl")
def projections(spark, d):
    c = crawl(spark, d)
    return c.select("url", F.when(F.col("is_error"), "").otherwise("x").alias("language"), F.when(F.col("is_error"), F.coalesce("comment", F.lit(""))).otherwise("").alias("comment"))


@query("p09_fill_defaults", "SELECT page_id, page_id % 2 = 0 AS kw_parked, CASE WHEN page_id % 3 = 0 THEN true ELSE page_id % 2 = 0 END AS ind_non_schema, CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS ml_feat_sale FROM pages")
def fill(spark, d):
    p = derived(spark, d, "pages", {"kw_parked": "CASE WHEN page_id % 2 = 0 THEN true END", "ind_non_schema": "CASE WHEN page_id % 3 <> 0 THEN page_id % 2 = 0 END", "ml_feat_sale": "CASE WHEN page_id % 3 <> 0 THEN 1 END"}, ("page_id",))
    return output.fill_defaults(p)


@query("p10_interpret_flags", "SELECT page_id, page_id % 5 < 2 AS kw_parked, page_id % 5 <> 2 AS ind_non_schema, false AS has_mx_record, CASE WHEN page_id % 2 = 0 THEN 7 ELSE 0 END AS ml_feat_sale FROM pages")
def interpret(spark, d):
    p = derived(spark, d, "pages", {"kw_parked": "CASE page_id % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'False' WHEN 3 THEN 'maybe' END", "ind_non_schema": "CASE page_id % 5 WHEN 2 THEN 'FALSE' END", "ml_feat_sale": "CASE WHEN page_id % 2 = 0 THEN '7' ELSE 'x' END"}, ("page_id",))
    return output.interpret_flags(p).select("page_id", "kw_parked", "ind_non_schema", "has_mx_record", "ml_feat_sale")


@query("k12_empty_to_null", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'null' ELSE 'x' END AS v FROM pages")
def empty_to_null(spark, d):
    return derived(spark, d, "pages", {"v": "CASE WHEN page_id % 2 = 0 THEN '' ELSE 'x' END"}, ("page_id",)).select("page_id", F.coalesce(output.empty_to_null(F.col("v")), F.lit("null")).alias("v"))


@query("k26_sample_files", "SELECT page_id, concat('output/sampling/a_b', page_id, '.ss.2024-01-02.png') AS ss_filename, concat('output/sampling/a_b', page_id, '.resu.2024-01-02.json') AS json_filename FROM pages")
def sample_files(spark, d):
    p = derived(spark, d, "pages", {"url": "concat('a/b', page_id)", "date": "DATE '2024-01-02'"}, ("page_id",))
    return p.withColumns(output.sample_files(F.col("url"), F.col("date"))).select("page_id", "ss_filename", "json_filename")


_FINAL = {"input_url": "concat('p', page_id)", "final_url": "concat('p', page_id)", "comment": "CASE WHEN page_id % 2 = 0 THEN '' ELSE 'c' END", "to_sample": "CASE page_id % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END", "ss_filename": "'s.png'"}


@query("k02_k06_k08_k11_warehouse_rows", "SELECT DATE '2024-01-02' AS date, 'f.csv' AS filename, concat('p', page_id) AS input_url, CASE WHEN page_id % 2 = 0 THEN 'null' ELSE 'c' END AS comment, page_id % 3 = 0 AS to_sample, CASE WHEN page_id % 3 = 0 THEN 's.png' ELSE 'null' END AS ss_filename FROM pages")
def warehouse_rows(spark, d):
    final = derived(spark, d, "pages", _FINAL)
    rows = output.warehouse_rows(final.union(final), "f.csv", F.expr("DATE '2024-01-02'"))
    return rows.select("date", "filename", "input_url", F.coalesce("comment", F.lit("null")).alias("comment"), "to_sample", F.coalesce("ss_filename", F.lit("null")).alias("ss_filename"))


@query("k05_k09_new_rows", "SELECT DATE '2024-01-02' AS date, 'f' AS filename, concat('p', page_id) AS input_url FROM pages WHERE page_id % 3 <> 0")
def new_rows(spark, d):
    rows = derived(spark, d, "pages", {"date": "DATE '2024-01-02'", "filename": "'f'", "input_url": "concat('p', page_id)"}, ("page_id",))
    return output.new_rows(rows.drop("page_id"), rows.where("page_id % 3 = 0"))


@query("k21_k22_j20_update_rows", "SELECT concat('p', page_id) AS input_url, CASE WHEN page_id % 3 = 0 THEN 'new' ELSE 'old' END AS comment, CASE WHEN page_id % 3 = 0 THEN '404' ELSE '200' END AS all_status_codes FROM pages")
def update_rows(spark, d):
    stored = derived(spark, d, "pages", {"filename": "'f'", "input_url": "concat('p', page_id)", "comment": "'old'", "all_status_codes": "'200'"})
    changes = derived(spark, d, "pages", {"filename": "'f'", "input_url": "concat('p', page_id)", "comment": "'new'", "all_status_codes": "'404'"}, ("page_id",)).where("page_id % 3 = 0")
    return output.update_rows(stored, changes).select("input_url", "comment", "all_status_codes")


@query("k23_matching_file", "SELECT min(concat('f', page_id, '_x7.csv')) AS filename FROM pages WHERE page_id % 3 = 0")
def matching_file(spark, d):
    return output.matching_file(derived(spark, d, "pages", {"filename": "CASE WHEN page_id % 3 = 0 THEN concat('f', page_id, '_x7.csv') ELSE 'other.csv' END"}), "_x7.csv")


@query("k13_k15_k20_migrations", "SELECT * FROM (VALUES (1, 28), (2, 50), (3, 59), (4, 61), (5, 66), (6, 87)) t(version, columns)")
def migrations(spark, d):
    old = derived(spark, d, "pages", {"date": "DATE '2024-01-02'", "filename": "'f'", "input_url": "'u'", "final_url": "'u'"})
    return spark.createDataFrame([(v, len(output.migrate(old, v).columns)) for v in range(1, 7)], "version int, columns int")


@query("o09_sample_rate")
def sample_rate(spark, d):
    return crawl(spark, d).where(output.sampled(F.col("url"), 0.2)).select("page_id", "url")


@query("s23_k24_sample_by_date", "SELECT least(count(*), 7) AS n, true AS right_day FROM pages WHERE page_id % 2 = 0")
def sample_by_date(spark, d):
    stored = derived(spark, d, "pages", {"date": "CASE WHEN page_id % 2 = 0 THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END", "filename": "'f'", "input_url": "concat('p', page_id)"})
    return output.sample(stored, "2024-01-02", 7).agg(F.count("*").alias("n"), F.bool_and(F.col("date") == F.expr("DATE '2024-01-02'")).alias("right_day"))


@query("u01_union_by_name", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN page_id END AS a, CASE WHEN page_id % 2 = 1 THEN page_id END AS b FROM pages")
def union_by_name(spark, d):
    p = table(spark, d, "pages")
    return p.where("page_id % 2 = 0").select("page_id", F.col("page_id").alias("a")).unionByName(p.where("page_id % 2 = 1").select("page_id", F.col("page_id").alias("b")), allowMissingColumns=True)


@query("s32_melt", "SELECT page_id, lgg, concat(lgg, page_id) AS trs_direct FROM pages CROSS JOIN (VALUES ('de'), ('en'), ('fr')) t(lgg)")
def melt(spark, d):
    wide = derived(spark, d, "pages", {g: f"concat('{g}', page_id)" for g in ("en", "de", "fr")}, ("page_id",))
    return taxonomy.melt(wide, ["page_id"])
