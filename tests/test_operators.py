"""Operators: golden numbers, precedence, consolidation, idempotent loads, the whole plan."""

import datetime
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lumenweb.functions.fixed import CATEGORIES, WAREHOUSE_COLUMNS
from lumenweb.operators import category, consolidate, domains, labels, metrics, output, redirect, registrars, taxonomy, training, visits
from lumenweb.operators.common import small
from lumenweb.plans import pipeline
from lumenweb.plans.config import Config
from lumenweb.sources import network, readers, writers

ROOT = Path(__file__).resolve().parents[1]


def test_published_metrics(spark):
    """A confusion matrix of 1188, 116, 86 and 675."""
    cells = [(0, 0.1, 1188), (0, 0.9, 116), (1, 0.1, 86), (1, 0.9, 675)]
    df = spark.createDataFrame([(a, p) for a, p, n in cells for _ in range(n)], "actual int, pred double")
    m = metrics.binary(df).first()
    assert (m.n_samples, m.tn, m.fp, m.fn, m.tp) == (2065, 1188, 116, 86, 675)
    assert [round(m[k], 3) for k in ("accuracy", "precision", "recall", "f1")] == [0.902, 0.853, 0.887, 0.870]
    acc = spark.range(1).select(*[metrics.general_accuracy(F.lit(0.90903), k).alias(k) for k in ("cctld", "gtld")]).first()
    assert abs(acc.cctld - 0.94322) < 1e-5 and abs(acc.gtld - 0.96361) < 1e-5


def test_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "actual int, pred double")
    m = metrics.binary(none).first()
    assert (m.n_samples, m.accuracy, m.precision) == (0, 0.0, 0.0)
    assert metrics.auc(none).first().auc is None


BASE = {"is_error": False, "comment": None, "registrar_found": False, "is_full_js_parked": False, "pred_ml_park": False, "pred_is_empty": False, "flag_js_found": False, "ml_feat_index_of": 0, "ml_feat_construction": 0, "ml_feat_sale": 0, "ml_feat_starter": 0, "ml_feat_expired": 0, "ml_feat_blocked": 0, "ml_feat_reserved": 0}
SCHEMA = "is_error boolean, comment string, registrar_found boolean, is_full_js_parked boolean, pred_ml_park boolean, pred_is_empty boolean, flag_js_found boolean, ml_feat_index_of int, ml_feat_construction int, ml_feat_sale int, ml_feat_starter int, ml_feat_expired int, ml_feat_blocked int, ml_feat_reserved int"


@pytest.mark.parametrize(
    ("change", "lv4"),
    [
        ({}, "High content"), ({"pred_is_empty": True}, "Blank Page"), ({"pred_is_empty": True, "flag_js_found": True}, "High content"), ({"registrar_found": True, "pred_ml_park": True}, "Parked Notice Registrar"), ({"is_full_js_parked": True}, "Parked Notice Registrar"),
        ({"pred_ml_park": True, "ml_feat_sale": 2, "ml_feat_expired": 9}, "For sale"), ({"pred_ml_park": True}, "Parked Notice Individual Content"), ({"pred_ml_park": True, "pred_is_empty": True, "flag_js_found": True}, "Blank Page"), ({"is_error": True, "comment": "SSL error"}, "No Status Code"),
        ({"is_error": True, "comment": "Error STATUS code : 402: x"}, "HTTP_401"), ({"is_error": True, "comment": "Error status code :503"}, "HTTP_other"), ({"is_error": True, "comment": "timeouterror"}, "Timeout"), ({"is_error": True, "registrar_found": True, "comment": "DNS resolution error"}, "No address found"),
        ({"comment": "Error status code :404"}, "HTTP_404"), ({"is_error": None, "comment": None, "pred_ml_park": None, "pred_is_empty": None}, "High content"),
    ],
)
def test_categories(spark, change, lv4):
    rows = category.with_categories(spark.createDataFrame([tuple((BASE | change).values())], SCHEMA)).collect()
    assert [r.category_lv4 for r in rows] == [lv4]
    assert (rows[0].category_lv4, rows[0].category_lv1, rows[0].category_lv2, rows[0].category_lv3) in CATEGORIES


def test_consolidation_keeps_rows_and_overwrites_with_null(spark):
    schema = "url string, original_url string, source string, n_words int, kw_park_notice string, to_sample boolean, target_url string, page_kind string"
    a = spark.createDataFrame([("a", "a", "original", 1, "x", True, None, "redirect"), ("b", None, "original", 2, "y", True, None, "normal"), ("c", "c", "original", 3, "z", False, None, "redirect")], schema)
    t = spark.createDataFrame([("ta", "a", "target", None, None, False, None, "normal"), ("tc", "c", "target", None, "q", True, None, "error"), ("ta0", "a", "target", 7, "old", False, None, "normal"), ("lost", None, "target", 9, "n", False, None, "normal")], schema)
    got = {r.url: r for r in consolidate.with_targets(a, t).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].target_url, got["a"].n_words, got["a"].kw_park_notice, got["a"].to_sample) == ("ta0", 7, "old", True)
    assert (got["c"].target_url, got["c"].n_words, got["c"].kw_park_notice, got["c"].source) == ("tc", 3, "z", "target")
    assert got["b"].target_url is None


def test_redirection_order(spark):
    row = "named_struct('frames', array(named_struct('type', 'iframe', 'link', 'http://f.com', 'parent', 'body', 'significance', 1, 'frames', cast(null as array<struct<link: string, type: string, significance: int>>))), 'window_loc', array('http://w.com'), 'meta_refresh', {}, 'n_lines_html', {})"

    def kind(refresh="cast(null as string)", lines=10, history=0, url="a.com"):
        df = spark.range(1).select(F.lit(url).alias("url"), F.lit(history).alias("history"), F.lit("https://www.z.com/___x").alias("URL_history"), F.expr(row.format(refresh, lines)).alias("html_data"), F.lit("original").alias("source"), F.lit(None).cast("string").alias("original_url"))
        r = redirect.with_redirection(df).first()
        return r.redirection_type, r.target_url

    assert kind(history=1) == ("http", "z.com")
    assert kind("'http://r.com'") == ("meta_refresh", "http://r.com")
    assert kind() == ("iframe", "http://f.com")
    assert kind(url="f.com") == ("window_location", "http://w.com")
    assert kind(lines=150) == ("", None)
    assert kind("'http://a.com'", lines=150) == ("", "http://a.com")


def test_registrars_of_pages_without_links(spark):
    known = registrars.suffixes(spark.createDataFrame([("www.reg", ".com;.net")], "hosting_name string, tld string"))
    pages = spark.createDataFrame([("a.com", [], None), ("b.com", None, None), ("c.com", ["x.reg.net/1", "x.reg.net/2"], None), ("d.com", ["com"], "http://d.com/lander")], "url string, all_links array<string>, target_url string")
    got = {r.url: (r.park_service, r.registrar_found) for r in registrars.detect(pages, known).collect()}
    assert got == {"a.com": (None, False), "b.com": (None, False), "c.com": ("reg.net", True), "d.com": ("GoDaddy", True)}


def test_positions_of_strings_and_ties(spark):
    rows = spark.createDataFrame([(f"k{i % 7}" if i % 3 else None, i) for i in range(200)], "k string, i int")
    got = domains.with_positions(rows, ["k", "i"], "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(200))
    assert [(r.k or "", r.i) for r in got] == sorted((r.k or "", r.i) for r in got)


def test_loading_twice_adds_nothing(spark, tmp_path):
    day = F.lit(datetime.date(2024, 1, 2))
    final = spark.createDataFrame([("a", "a", "True"), ("a", "a", "True"), ("b", "b", None)], "input_url string, final_url string, to_sample string")
    path = str(tmp_path / "w")
    assert writers.load(final, path, "f.csv", day) == 2
    assert writers.load(final, path, "f.csv", day) == 0
    assert writers.load(final, path, "g.csv", day) == 2
    stored = readers.stored(spark, path, "2024-01-02")
    assert stored.count() == 4 and {"date", "filename", *WAREHOUSE_COLUMNS} == set(stored.columns)
    assert readers.stored(spark, path, "2024-01-03").count() == 0


def test_tables_are_migrated(spark):
    spark.sql("DROP TABLE IF EXISTS lumenweb_t")
    try:
        writers.create_table(spark, "lumenweb_t", 1)
        assert len(spark.table("lumenweb_t").columns) == 28
        writers.create_table(spark, "lumenweb_t")
        assert len(spark.table("lumenweb_t").columns) == len(output.warehouse_schema().fields)
    finally:
        spark.sql("DROP TABLE IF EXISTS lumenweb_t")


def test_updates_and_sniffing(spark, tmp_path):
    (tmp_path / "l.csv").write_text("url|x\na.com.|1\nnodot|2\n")
    df = readers.domain_list(spark, str(tmp_path / "l.csv"), "x int", readers.sniff_separator(spark, str(tmp_path / "l.csv")))
    assert [(r.url, r.x, r.ind_non_schema) for r in df.collect()] == [("a.com", 1, True), ("nodot", 2, False)]


def test_settings():
    c = Config.read(["DO_HCJ_EXTRACTION=False", "MAX_REVISIT=3", "# DO_SAMPLING=True", "SAMPLING_RATE=1"])
    assert (c.do_hcj_extraction, c.max_revisit, c.do_sampling, c.sampling_rate) == (False, 3, False, 1)


def test_folds_are_even_and_repeatable(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(503)], "id int, target int")
    a, b = (training.with_folds(x, k=7).collect() for x in (df, df.repartition(5)))
    assert {(r.id, r.fold) for r in a} == {(r.id, r.fold) for r in b}
    sizes = {}
    for r in a:
        sizes.setdefault(r.target, [0] * 7)[r.fold] += 1
    assert all(max(v) - min(v) <= 1 for v in sizes.values())


def test_label_ties(spark):
    rows = spark.createDataFrame([(["b", "a"],), (["x", "x", "y"],), ([],), (None,), (["unsure", "a"],)], "c array<string>")
    c = F.col("c")
    got = [tuple(r) for r in rows.select(labels.most_common(c), labels.is_disagreement(c), labels.is_unsure(c), labels.is_labelled(c)).collect()]
    assert got == [("a", True, False, True), ("x", False, False, True), (None, False, False, False), (None, False, False, False), ("a", True, True, True)]


def test_status_and_long_pages(spark):
    df = spark.createDataFrame([(None,), (200,), (404,), (1234,)], "s int")
    assert [r.c for r in df.select(visits.status_comment(F.col("s")).alias("c")).collect()] == [None, None, "Error status code :404: Not Found", "Error status code :1234"]


def test_broadcasts_are_checked(spark):
    df = spark.range(50)
    hinted = lambda x: "ResolvedHint" in x._jdf.queryExecution().analyzed().toString() or "broadcast" in x._jdf.queryExecution().analyzed().toString().lower()
    assert hinted(small(df, 50)) and not hinted(small(df, 49))


def test_network_failures_are_rows(spark):
    def get(url):
        return {"a.com": {"status": 404, "final_url": "http://a.com", "hops": [{"status": 301, "url": "http://a"}]}, "b.com": {"kind": "connect", "message": "x"}}.get(url, {"status": 200, "final_url": url, "raw_text": "<html>", "hops": []})

    got = {r.url: r for r in network.visit(spark.createDataFrame([("a.com",), ("b.com",), ("c.com",)], "url string"), get).collect()}
    assert got["a.com"].comment == "Error status code :404: Not Found" and got["a.com"].all_status_codes == "404_301"
    assert got["b.com"].comment == "DNS resolution error" and got["b.com"].to_revisit
    assert not got["c.com"].is_error and got["c.com"].raw_text == "<html>"
    spark.dataSource.register(network.PageSource)
    assert spark.read.format("lumenweb_pages").load().count() == 0


def test_missing_word_types_are_errors(spark):
    a = spark.createDataFrame([("r1", "w")], "root string, word string")
    roots = spark.createDataFrame([("r2", "core", "sale")], "root string, word_type string, end_class string")
    with pytest.raises(Exception, match="no word type for root r1"):
        taxonomy.add_word_features(a, a, roots).collect()


def test_plan_keeps_every_domain(spark):
    """Domains without a crawl row, errors, empty pages, clashing extra columns."""
    crawl = spark.createDataFrame(
        [("a.com", "<html><body><p>domain for sale, buy this domain now</p></body></html>", False, None), ("b.com", None, True, "TimeoutError"), ("c.com", "<html></html>", False, None), ("e.com", "no letters? 123", False, None)],
        "url string, raw_text string, is_error boolean, comment string",
    )
    wanted = spark.createDataFrame([("a.com", "x", 1), ("b.com", "x", 2), ("c.com", "x", 3), ("d.com", "x", 4), ("e.com", None, 5)], "url string, language string, extra int")
    words = taxonomy.own(spark)
    none = spark.createDataFrame([], "hosting_name string, tld string")
    out = pipeline.run(wanted, crawl, words, none, lambda df: df.withColumn("ml_prediction", F.col("ml_feat_sale") > 0)).collect()
    got = {r.input_url: r for r in out}
    assert len(out) == 5 and {r.extra for r in out} == {1, 2, 3, 4, 5}
    assert {u: r.category_lv4 for u, r in got.items()} == {"a.com": "For sale", "b.com": "Timeout", "c.com": "Blank Page", "d.com": "High content", "e.com": "Blank Page"}
    empty = pipeline.run(wanted.limit(0), crawl.limit(0), words, none)
    assert empty.count() == 0


def test_everything_works_without_the_training_data_part(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = """
import __spark_entry__ as e
q = e.queries()
assert len(q) > 100 and not any(k.startswith('op') for k in q) and not set(e.oracle_sql()) - set(q)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()
pages = [(i, f'https://www.h{i}.com/a', '<p>x</p>') for i in range(30)]
spark.createDataFrame(pages, 'page_id long, url string, html string').write.parquet('tables/pages.parquet')
assert q['domain_categories'](spark, 'tables').count() > 0 and q['f01_clean_link'](spark, 'tables').count() == 30 and q['k07_upload'](spark, 'tables').count() == 30
print('fine')
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(copy), "HOME": str(tmp_path)}, timeout=240)
    assert said.stdout.strip() == "fine", said.stderr[-800:]


def test_retraining_from_samples_to_report(spark, tmp_path):
    from lumenweb.plans import retraining

    rows = []
    for i in range(60):
        parked = i % 2 == 0
        text = f"This domain is for sale. Buy the domain {i} now. The page is parked and registered." if parked else f"We bake bread number {i} every morning. Come and see our old shop near the river."
        rows.append((f"u{i}.com", text, "en", "com" if i % 3 else "ee", [["for_sale" if parked else "high_content", f"w{i % 3}"]] * (2 if i % 4 else 1), [], "x/s.png", None, None, None))
    rows += [("bad.com", "", "en", "com", [["starter", "w1"]], [], "s.png", None, None, None), ("tie.com", "text", "en", "com", [["unsure", "w1"], ["starter", "w2"]], [], "s.png", None, None, None)]
    schema = "url string, html_text string, language string, tld string, user_choices array<array<string>>, user_comments array<array<string>>, ss_filename string, html_raw string, categorisation struct<category_lv4: string>, target double"
    samples = readers.shape_samples(spark.createDataFrame(rows, schema)).drop("target")
    report = retraining.run(samples, taxonomy.own(spark), folds=2, settings={"maxIter": 3, "maxDepth": 3}, ref_time="t")
    told = report.tables["performance"].first()
    assert (told.n_samples, told.accuracy) == (60, 1.0)
    assert report.tables["error_analysis"].count() == 0
    assert {r.step: r.removed for r in report.tables["log"].collect()} == {"final training samples": 60, "no text": 1, "unsure": 1}
    assert report.tables["history"].first().ref_time == "t"
    report.write(str(tmp_path / "report"))
    again = training.PipelineModel.load(str(tmp_path / "report" / "model"))
    assert training.predict(again, retraining.training_rows(samples, taxonomy.own(spark))).where("target <> predicted").count() == 0
