"""Sources and sinks: written to the shared folder, read again, compared with what went in."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb import schemas
from lumenweb.operators import output, registrars
from lumenweb.plans.catalog.base import CRAWL_CTE, crawl, derived, query, table
from lumenweb.plans.config import Config, infer
from lumenweb.sources import network, readers, writers
from lumenweb.sources.scratch import scratch
from lumenweb.streaming import landing


@query("s01_s02_k32_domain_list", "SELECT concat('p', page_id, '.com') AS url, CAST(page_id AS VARCHAR) AS note, true AS ind_non_schema FROM pages")
def domain_list(spark, d):
    path = scratch(spark, "domains")
    writers.chunks(table(spark, d, "pages").select(F.expr("concat('p', page_id, '.com.')").alias("url"), F.col("page_id").cast("string").alias("note")), path, 100)
    return readers.domain_list(spark, path, "note string").select("url", "note", "ind_non_schema")


@query("s36_separator", "SELECT page_id, concat('u', page_id) AS url FROM pages")
def separator(spark, d):
    path = scratch(spark, "bars")
    writers.csv(table(spark, d, "pages").select(F.expr("concat('u', page_id)").alias("url"), F.col("page_id").cast("string").alias("page_id")), path, "|")
    sep = readers.sniff_separator(spark, path)
    return readers.domain_list(spark, path, "page_id bigint", sep).select("page_id", "url")


@query("s19_s20_s21_s22_k03_k04_documents", f"WITH {CRAWL_CTE} SELECT url, is_error, coalesce(comment, '') AS comment FROM crawl")
def documents(spark, d):
    path = scratch(spark, "documents")
    writers.documents(crawl(spark, d).withColumn("unknown", F.lit(1)), path)
    return readers.documents(spark, path).select("url", "is_error", F.coalesce("comment", F.lit("")).alias("comment"))


@query("s24_s25_samples", "SELECT concat('u', page_id) AS url, 'for_sale' AS label, 'ann' AS who, 'a.png' AS ss_filename, CASE WHEN page_id % 2 = 0 THEN 'High content' ELSE '' END AS lv4 FROM pages UNION ALL SELECT concat('old', page_id), '', '', '', '' FROM pages WHERE page_id % 3 > 0")
def samples(spark, d):
    path = scratch(spark, "samples")
    p = derived(spark, d, "pages", {"url": "concat('u', page_id)", "html_text": "'t'", "user_choices": "array(array('for_sale', 'ann'))", "user_comments": "array(array('ok', 'ann'))", "ss_filename": "'x/y/a.png'", "categorisation": "CASE WHEN page_id % 2 = 0 THEN named_struct('category_lv4', 'High content', 'pred_ml_park', 'false', 'comment', '') END"}, ("page_id",))
    plain, wrapped = p.where("page_id % 2 = 1"), p.where("page_id % 2 = 0")
    plain.drop("page_id").write.json(path + "/plain")
    wrapped.select(F.array(F.struct("url", "html_text", "user_choices", "user_comments", "ss_filename", "categorisation")).alias("results")).write.option("maxRecordsPerFile", 1).json(path + "/wrapped")
    both = readers.samples(spark, path + "/wrapped").unionByName(readers.shape_samples(spark.read.schema(schemas.SAMPLES).json(path + "/plain")))
    legacy = derived(spark, d, "pages", {"url": "concat('old', page_id)", "clean_text": "CASE page_id % 3 WHEN 0 THEN '.' ELSE 'text' END", "target": "CAST(1 AS DOUBLE)"})
    out = readers.all_samples(both, legacy)
    word = lambda c: F.coalesce(F.col(c)[0], F.lit(""))
    return out.select("url", word("user_choices").alias("label"), word("user_name").alias("who"), F.coalesce("ss_filename", F.lit("")).alias("ss_filename"), F.coalesce("category_lv4", F.lit("")).alias("lv4"))


@query("s28_k28_registrar_lines", "SELECT DISTINCT concat('r', page_id % 20, CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END) AS domain FROM pages")
def registrar_lines(spark, d):
    path = scratch(spark, "lines")
    domains = derived(spark, d, "pages", {"domain": "concat('www.R', page_id % 20, CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END)"})
    writers.registrar_lines(domains, path)
    return readers.registrar_lines(spark, path).select("domain").distinct()


@query("s04_s29_k27_registrar_table", "SELECT concat('r', page_id % 20) AS name, CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END AS tld FROM pages GROUP BY ALL")
def registrar_table(spark, d):
    path = scratch(spark, "registrars")
    rows = derived(spark, d, "pages", {"name": "concat('r', page_id % 20)", "tld": "CASE page_id % 3 WHEN 0 THEN '.com' WHEN 1 THEN '.net' ELSE '.org' END"})
    writers.registrar_table(rows, path)
    return registrars.explode_tlds(readers.registrar_table(spark, path).withColumnRenamed("hosting_name", "name"))


@query("s30_s31_settings", "SELECT * FROM (VALUES ('True', 'bool'), ('12', 'int'), ('1.5', 'float'), ('x', 'str')) t(value, kind)")
def settings(spark, d):
    config = Config.read(["# c", "DO_SOCIAL_MEDIA=False", "SAMPLING_RATE=0.5", "NO_SUCH=1"])
    assert (config.do_social_media, config.sampling_rate) == (False, 0.5)
    return spark.createDataFrame([(v, type(infer(v)).__name__) for v in ("True", "12", "1.5", "x")], "value string, kind string")


@query("s34_final_files", "SELECT page_id, page_id % 4 = 0 AS final FROM pages")
def final_files(spark, d):
    names = derived(spark, d, "pages", {"name": "CASE page_id % 4 WHEN 0 THEN 'a_final_b.csv' WHEN 1 THEN 'final_DEBUG.csv' WHEN 2 THEN 'final__tempo.csv' ELSE 'res.csv' END"}, ("page_id",))
    return names.select("page_id", readers.is_final(F.col("name")).alias("final"))


@query("k05_k10_load_twice", "SELECT DATE '2024-01-02' AS date, 'f.csv' AS filename, count(*) AS rows, count(*) AS first_load, CAST(0 AS BIGINT) AS second_load FROM pages")
def load_twice(spark, d):
    path = scratch(spark, "warehouse")
    final = derived(spark, d, "pages", {"input_url": "concat('p', page_id)", "final_url": "concat('p', page_id)"})
    first = writers.load(final, path, "f.csv", F.expr("DATE '2024-01-02'"))
    second = writers.load(final, path, "f.csv", F.expr("DATE '2024-01-02'"))
    stored = readers.stored(spark, path, "2024-01-02")
    return stored.groupBy("date", "filename").agg(F.count("*").alias("rows")).withColumns({"first_load": F.lit(first).cast("long"), "second_load": F.lit(second).cast("long")})


@query("k01_k02_final_table", f"WITH {CRAWL_CTE} SELECT url AS input_url, regexp_extract(url, '[^.]*$') AS tld FROM crawl")
def final_table(spark, d):
    path = scratch(spark, "final")
    writers.final_table(crawl(spark, d), path)
    return spark.read.option("header", True).csv(path).select("input_url", "tld")


@query("k25_sample_artefacts", "SELECT concat('p', page_id) AS url FROM pages WHERE page_id % 3 = 0")
def artefacts(spark, d):
    path = scratch(spark, "samples")
    writers.sample_artefacts(derived(spark, d, "pages", {"url": "concat('p', page_id)", "to_sample": "page_id % 3 = 0"}), path)
    return spark.read.schema("url string, to_sample boolean").json(path).select("url")


@query("s07_s11_s16_network", "SELECT concat('p', page_id, '.com') AS url, page_id % 4 = 0 AS is_error, CASE WHEN page_id % 4 = 0 THEN 'TimeoutError' ELSE '' END AS comment, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'mx' END AS mx FROM pages")
def network_sources(spark, d):
    urls = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com')"})

    def get(url):
        n = int(url[1:-4])
        return {"kind": "timeout", "message": ""} if n % 4 == 0 else {"status": 200, "final_url": "http://" + url, "raw_text": "<html>", "header_keys": ["etag"], "cookie_keys": [], "hops": []}

    pages = network.visit(urls, get)
    mail = network.mail_records(urls, lambda u: (None, "no_answer") if int(u[1:-4]) % 4 == 0 else ("mx", None))
    return pages.join(mail, "url").select("url", "is_error", F.coalesce("comment", F.lit("")).alias("comment"), F.coalesce("mx_record", F.lit("")).alias("mx"))


@query("streaming_landing", f"WITH {CRAWL_CTE} SELECT DISTINCT url, is_error FROM crawl")
def streaming(spark, d):
    source, out, check = (scratch(spark, x) for x in ("landing", "landed", "landing-state"))
    rows = crawl(spark, d).select("url", "is_error")
    rows.write.parquet(source)
    rows.where("is_error").write.mode("append").parquet(source)  # some land twice
    stream = landing.landing(spark, source, rows.schema)

    def sink(df, n):
        writers.append_new(df.withColumns({"date": F.expr("DATE '2024-01-02'"), "filename": F.lit("s"), "input_url": F.col("url")}).dropDuplicates(["url"]), out)

    landing.run(stream, lambda df: df, sink, check).awaitTermination()
    return spark.read.parquet(out).select("url", "is_error")


@query("k14_k16_tables_and_scripts", "SELECT 2 AS statements, 87 AS columns")
def scripts(spark, d):
    n = writers.run_script(spark, "SELECT 1; SELECT 2;")
    return spark.createDataFrame([(n, len(output.warehouse_schema().fields))], "statements int, columns int")
