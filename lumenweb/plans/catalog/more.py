"""Sources that are parameters (crawls, browsers, uploads), report sheets, and operators that other queries only touch in passing."""

from __future__ import annotations

import io
import itertools
import re
import zipfile

from pyspark.sql import functions as F

from lumenweb.functions import tokenizers, urls
from lumenweb.operators import common, labels, metrics, output, taxonomy, training
from lumenweb.plans import retraining
from lumenweb.plans.catalog.base import ORACLES, derived, query, sql_clean, table
from lumenweb.plans.catalog.labels import _SQL as SAMPLES
from lumenweb.plans.catalog.labels import binary, predictions, samples
from lumenweb.plans.catalog.learning import rows as training_rows
from lumenweb.plans.timing import Laps
from lumenweb.sources import browser, network, readers, sheets, upload
from lumenweb.sources.scratch import scratch


@query("s08_s09_s10_crawl", "SELECT concat('p', page_id, '.com') AS url, page_id % 4 = 0 AS is_error FROM pages WHERE page_id % 7 <> 0 AND NOT (page_id % 3 = 0 AND page_id % 6 <> 0)")
def file_crawl(spark, d):
    """Some urls can't be visited, all come twice, and a third was visited, half of which needs another visit."""
    wanted = derived(spark, d, "pages", {"url": "CASE WHEN page_id % 7 <> 0 THEN concat('p', page_id, '.com') ELSE 'none' END"})
    visited = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com')", "to_revisit": "page_id % 6 = 0"}, ("page_id",)).where("page_id % 3 = 0").drop("page_id")

    def get(url):
        return {"kind": "timeout", "message": ""} if int(url[1:-4]) % 4 == 0 else {"status": 200, "final_url": "http://" + url, "raw_text": "<html>", "header_keys": [], "cookie_keys": [], "hops": []}

    return network.crawl(wanted.union(wanted), visited, get, partitions=4, pool=8).select("url", "is_error")


@query("e04_request_pace", "SELECT request, CAST(seconds AS DOUBLE) AS seconds FROM (VALUES (0, 0.0), (1, 2.0), (2, 4.0), (3, 9.0), (4, 11.0)) t(request, seconds)")
def pace(spark, d):
    """Requests come at 0, 0.5, 1, 9 and 9.5; one may go each two seconds."""
    clock = iter([0.0, 0.5, 1.0, 9.0, 9.5])
    go = network.Pace(2.0, lambda: next(clock), lambda s: None)
    return spark.createDataFrame([(i, go()) for i in range(5)], "request int, seconds double")


class PlantedBrowser:
    """Knows pages by the number in their url: each fifth can't be opened, each seventh can't be read."""

    def open(self, url: str, wait: float) -> None:
        self.url, self.n = url, int(re.search(r"\d+", url)[0])
        if self.n % 5 == 0:
            raise OSError("no page")

    def source(self) -> str:
        if self.n % 7 == 0:
            raise ValueError("no document")
        return f"<p>{self.url}</p>"

    def screenshot(self) -> bytes:
        return b"shot"

    def close(self) -> None:
        pass


@query("s12_s13_s14_s15_browser", "SELECT CASE WHEN page_id % 2 = 0 THEN concat('https://t', page_id, '.org') ELSE concat('p', page_id, '.com') END AS url, CASE WHEN page_id % 2 = 0 THEN concat('p', page_id, '.com') ELSE '' END AS original_url, CASE WHEN page_id % 7 = 0 THEN 'JS CRAWLING ERROR: no document' WHEN page_id % 2 = 0 THEN concat('<p>https://t', page_id, '.org</p>') ELSE concat('<p>http://p', page_id, '.com</p>') END AS raw_text, page_id % 7 = 0 AS is_error, CASE WHEN page_id % 7 = 0 THEN '' ELSE 'shot' END AS shot, 'browser' AS visit_kind FROM pages WHERE page_id % 5 <> 0")
def browser_visits(spark, d):
    rows = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com')", "source": "CASE WHEN page_id % 2 = 0 THEN 'target' ELSE 'original' END", "target_url": "concat('https://t', page_id, '.org')", "original_url": "concat('p', page_id, '.com')"})
    out = browser.visit(rows, PlantedBrowser, shots=True)
    return out.select("url", F.coalesce("original_url", F.lit("")).alias("original_url"), "raw_text", "is_error", F.coalesce(F.col("screenshot").cast("string"), F.lit("")).alias("shot"), "visit_kind")


def _service(method, address, fields):
    """Samples of each third url are known, each fifth image is refused."""
    if address == "images":
        n = int(re.search(r"\d+", fields["filename"])[0])
        return (500, address, "full") if n % 5 == 0 else (200, address, str(n))
    assert fields["screenshot"] == int(re.search(r"\d+", fields["url"])[0])
    if method == "PATCH":
        return 200, address, ""
    return (200, f"samples/{fields['screenshot']}", "") if fields["screenshot"] % 3 == 0 else (201, address, "")


@query("k07_upload", "SELECT concat('p', page_id) AS url, CASE WHEN page_id % 4 = 0 THEN 'skipped' WHEN page_id % 5 = 0 THEN 'failed' WHEN page_id % 3 = 0 THEN 'updated' ELSE 'created' END AS outcome, CASE WHEN page_id % 4 <> 0 AND page_id % 5 = 0 THEN 'image: 500 full' ELSE '' END AS message FROM pages")
def uploads(spark, d):
    rows = derived(spark, d, "pages", {"url": "concat('p', page_id)", "ss_filename": "CASE WHEN page_id % 4 = 0 THEN '' ELSE concat('a/s', page_id, '.png') END", "screenshot": "CAST('x' AS BINARY)", "html_text": "'t'", "html_raw": "'<p>'", "categorisation": "'{\"category_lv4\": \"High content\"}'"})
    return upload.upload(rows, _service, "images", "samples", updates=True)


@query("k17_k18_k19_added_columns", "SELECT * FROM (VALUES (2, 22), (3, 9), (4, 2), (5, 5), (6, 21)) t(version, added)")
def added_columns(spark, d):
    n = [len(output.warehouse_schema(v).fields) for v in range(1, 7)]
    return spark.createDataFrame([(i + 2, b - a) for i, (a, b) in enumerate(itertools.pairwise(n))], "version int, added int")


@query("k29_m10_saved_model", "SELECT count(*) AS n, true AS same FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL")
def saved_model(spark, d):
    """A model of the classifier's own settings, written and read again, predicts what it did."""
    path, r = scratch(spark, "model"), training_rows(spark, d)
    model = training.fit(r)
    model.write().overwrite().save(path)
    again = training.PipelineModel.load(path)
    both = training.predict(model, r).select("id", F.col("predicted_proba").alias("a")).join(training.predict(again, r).select("id", F.col("predicted_proba").alias("b")), "id")
    return both.agg(F.count("*").alias("n"), F.bool_and(F.col("a") == F.col("b")).alias("same"))


_SHEETS = {"CONFIG": "SELECT * FROM (VALUES (1), (2)) t(x)", "LOG": ORACLES["m13_filter_log"], "Labeller": ORACLES["a12_j18_o03_m27_labellers"], "Agreement": ORACLES["a08_agreement_summary"], "Disagreement": ORACLES["o02_top_disagreements"], "Performance": ORACLES["a13_a14_binary_metrics"], "Groups": ORACLES["a17_by_language_and_tld"]}


@query("k30_k31_m39_report", " UNION ALL ".join(f"SELECT '{n}' AS sheet, count(*) AS rows FROM ({q})" for n, q in _SHEETS.items()))
def report_sheets(spark, d):
    """The workbook of a training report, read again: its sheets and their rows without the header."""
    s, p = samples(spark, d), predictions(spark, d)
    tables = {"CONFIG": metrics.config_table(spark, {"training": {"folds": 20, "classes": 2}}), "LOG": labels.filter_log(s), "Labeller": labels.labeller_summary(s), "Agreement": labels.agreement_summary(s), "Disagreement": labels.top_disagreements(s), "Performance": metrics.binary(p), "Groups": metrics.by_language_and_tld(p, "actual", "pred")}
    with zipfile.ZipFile(io.BytesIO(sheets.of(tables))) as z:
        names = re.findall(r'<sheet name="([^"]*)"', z.read("xl/workbook.xml").decode())
        counts = [z.read(f"xl/worksheets/sheet{i + 1}.xml").decode().count("<row ") - 1 for i in range(len(names))]
    return spark.createDataFrame(list(zip(names, counts, strict=True)), "sheet string, rows long")


@query("s18_s33_k33_mail_tool", "SELECT concat('p', page_id, '.com') AS url, page_id % 10 AS extra, CASE WHEN page_id % 4 = 0 THEN '' ELSE concat('mx.p', page_id, '.com') END AS mx_record, CASE WHEN page_id % 4 = 0 THEN 'no_answer' ELSE '' END AS mail_kind FROM pages")
def mail_tool(spark, d):
    """The mail tool's list (no IDNA form), its records, and its output: the list's columns first."""
    listed = derived(spark, d, "pages", {"url": "concat('p', page_id, '.com.')", "extra": "page_id % 10"}).withColumn("url", urls.strip_dot(F.col("url")))
    mail = network.mail_records(listed, lambda u: (None, "no_answer") if int(u[1:-4]) % 4 == 0 else ("mx." + u, None))
    out = listed.join(mail, "url", "left")
    return out.select("url", "extra", F.coalesce("mx_record", F.lit("")).alias("mx_record"), F.coalesce("mail_kind", F.lit("")).alias("mail_kind"))


@query("k35_lap_times", "SELECT lap, message, CAST(seconds AS DOUBLE) AS seconds, CAST(total AS DOUBLE) AS total, is_error FROM (VALUES (0, 'read', 1.5, 1.5, false), (1, 'parse', 2.5, 4.0, true)) t(lap, message, seconds, total, is_error)")
def lap_times(spark, d):
    clock = iter([10.0, 11.5, 14.0])
    laps = Laps(lambda: next(clock))
    laps("read")
    laps("parse", True)
    return laps.table(spark)


@query("s26_s27_legacy_samples", "SELECT concat('old', page_id) AS url, 'text' AS html_text, CAST(page_id % 2 AS DOUBLE) AS target, CASE WHEN page_id % 2 = 0 THEN 'high_content' ELSE 'parked_notice_individual_content' END AS label FROM pages WHERE page_id % 5 > 3")
def legacy_samples(spark, d):
    """The first labelled set, as its three entries read it."""
    path = scratch(spark, "legacy")
    derived(spark, d, "pages", {"url": "concat('old', page_id)", "clean_text": "CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '.' WHEN 3 THEN '..' ELSE 'text' END", "target": "CAST(page_id % 2 AS DOUBLE)"}).write.json(path)
    raw = spark.read.schema("url string, clean_text string, target double").json(path)
    return readers.legacy_samples(raw).withColumn("label", labels.legacy_label(F.col("target")))


@query("p19_p20_p21_p22_label_filters", SAMPLES + "SELECT count(*) FILTER (kinds > 1 OR most <> 'parked_notice_registrar') AS not_registrar, count(*) FILTER (labels = 1) AS single, count(*) FILTER (labels > 1) AS multi, count(*) FILTER (list_contains(tied, 'unsure')) AS unsure FROM a")
def label_filters(spark, d):
    c = F.col("user_choices")
    s = samples(spark, d)
    counted = {"not_registrar": labels.is_not_registrar(c), "single": labels.is_single(c), "multi": labels.is_multi(c), "unsure": labels.is_unsure(c)}
    return s.agg(*[F.count_if(v).alias(k) for k, v in counted.items()])


@query("f03_f04_f21_links", f"SELECT page_id, {sql_clean('url')} AS link, url AS undotted FROM pages")
def link_copies(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", urls.clean_link(F.col("url")).alias("link"), urls.strip_dot(F.concat("url", F.lit("."))).alias("undotted"))


@query("f17_f18_lower_lists", "SELECT page_id, concat('a', page_id, '|b|b') AS list, 2 AS distinct_values FROM pages")
def lower_lists(spark, d):
    p = derived(spark, d, "pages", {"x": "array(concat('A', page_id), 'B', 'b')"}, ("page_id",))
    low = F.transform("x", lambda v: F.lower(v))
    return p.select("page_id", F.array_join(low, "|").alias("list"), F.size(F.array_distinct(low)).alias("distinct_values"))


@query("u04_missing_fields", "SELECT page_id, 'own' AS a, 0 AS b FROM pages")
def missing_fields(spark, d):
    p = derived(spark, d, "pages", {"a": "'own'"}, ("page_id",))
    return common.add_missing(p, {"A": F.lit("other"), "b": F.lit(0)})


_FORMS = [("sell", "n", "sale"), ("sell", "v", "selling"), ("sell", "v", "sells"), ("park", "v", "parking")]


@query("f24_f28_word_forms_and_translations", "SELECT root, word, lgg, coalesce(CASE WHEN root = 'index of' THEN word WHEN lgg = 'de' AND word = 'sale' THEN 'verkauf' WHEN lgg = 'fr' AND word = 'parking' THEN 'stationnement' END, '') AS trs FROM (VALUES ('sell', 'sale'), ('sell', 'selling'), ('sell', 'sells'), ('park', 'parking'), ('index of', 'index of')) w(root, word), (VALUES ('de'), ('fr')) g(lgg)")
def forms_and_translations(spark, d):
    words = spark.createDataFrame([("sell", "yes", "yes"), ("park", "yes", "yes"), ("rare", "yes", "yes"), ("index of", "no", "no")], "root string, to_derive string, to_translate string")
    derived_ = taxonomy.derive(words, spark.createDataFrame(_FORMS, "root string, form string, word string"))
    found = spark.createDataFrame([("sale", "de", "verkauf"), ("parking", "fr", "stationnement")], "word string, lgg string, trs string")
    return taxonomy.translate_table(derived_, ["de", "fr"], found).select("root", "word", "lgg", F.coalesce("trs", F.lit("")).alias("trs"))


# Planted texts in languages with tokenizers of their own, and what the offline fallbacks make of them.
OWN = {
    "zh-cn": ("网域出售", "网|域|出|售"), "zh-tw": ("網域出售", "網|域|出|售"), "ja": ("ドメイン販売", "ドメイン|販売"), "ko": ("도메인 판매", "도메인|판매"), "th": ("ขาย", "ข|า|ย"), "vi": ("bán tên miền. đóng", "bán|tên|miền;đóng"),
    "fa": ("این صفحه. بسته است", "این|صفحه;بسته|است"), "ar": ("الصفحة مغلقة", "الصفحة|مغلقة"), "he": ("הדף סגור", "הדף|סגור"), "hi": ("यह पेज। बंद है", "यह|पेज;बंद|है"), "gu": ("આ પાનું બંધ છે", "આ|પાનું|બંધ|છે"), "kn": ("ಈ ಪುಟ ಮುಚ್ಚಿದೆ", "ಈ|ಪುಟ|ಮುಚ್ಚಿದೆ"),
    "ml": ("ഈ പേജ് അടച്ചു", "ഈ|പേജ്|അടച്ചു"), "mr": ("हे पान। बंद आहे", "हे|पान;बंद|आहे"), "bn": ("এই পাতা। বন্ধ আছে", "এই|পাতা;বন্ধ|আছে"), "ta": ("இந்த பக்கம் மூடியது", "இந்த|பக்கம்|மூடியது"), "ur": ("یہ صفحہ بند ہے", "یہ|صفحہ|بند|ہے"), "ne": ("यो पृष्ठ बन्द छ", "यो|पृष्ठ|बन्द|छ"), "te": ("ఈ పేజీ। మూసి ఉంది", "ఈ|పేజీ;మూసి|ఉంది"),
}


def _own(i: int) -> str:
    return f"CASE doc_id % {len(OWN)} " + " ".join(f"WHEN {n} THEN '{v[i] if i < 2 else k}'" for n, (k, v) in enumerate(OWN.items())) + " END"


@query("l06_l07_l08_l09_l10_l11_l12_l13_l14_l15_l16_l17_l31_l32_l33_l34_l35_l36_l37_l38_l39_l40_tokenizers", f"SELECT doc_id, {_own(1)} AS tokens FROM documents")
def own_tokenizers(spark, d):
    matrix = tokenizers.tokenize(F.expr(_own(0)), F.expr(_own(2)))
    return table(spark, d, "documents").select("doc_id", F.array_join(F.transform(matrix, lambda s: F.array_join(s, "|")), ";").alias("tokens"))


@query("s05_tokenizer_map", "SELECT word_tokenizer, count(*) AS languages FROM (" + ORACLES["l05_tokenizer_table"] + ") GROUP BY word_tokenizer")
def tokenizer_map(spark, d):
    return taxonomy.tokenizer_table(spark).groupBy("word_tokenizer").agg(F.count("*").alias("languages"))


@query("m23_m28_prediction_metrics", ORACLES["a13_a14_binary_metrics"])
def prediction_metrics(spark, d):
    return binary(spark, d)


_TEXT = "CASE WHEN page_id % 2 = 0 THEN concat('This domain is for sale. Buy the domain ', page_id, ' now. The page is parked.') ELSE concat('We bake bread number ', page_id, ' every morning. Come and see our shop.') END"


@query("m12_m14_retraining", "SELECT count(*) FILTER (page_id % 9 <> 0) AS usable, count(*) FILTER (page_id % 9 = 0) AS unsure, count(*) FILTER (page_id % 9 <> 0) AS n_samples, CAST(1 AS DOUBLE) AS accuracy, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS errors_of_the_model, 'performance,summary_agreement' AS tables FROM pages")
def retrained(spark, d):
    """Training from samples to report and model, the classifier's own settings but three folds: texts of two kinds that can be told apart."""
    label = "CASE WHEN page_id % 9 = 0 THEN 'unsure' WHEN page_id % 2 = 0 THEN 'for_sale' ELSE 'high_content' END"
    s = derived(spark, d, "pages", {"url": "concat('u', page_id)", "html_text": _TEXT, "language": "'en'", "tld": "'com'", "user_choices": f"array({label})", "user_name": "array('ann')", "ss_filename": "'s.png'", "html_raw": "''"}, ("page_id",)).drop("page_id")
    words = taxonomy.own(spark)
    report = retraining.run(s, words, folds=3, ref_time="t")
    told, log = report.tables["performance"], {r["step"]: r["removed"] for r in report.tables["log"].collect()}
    wrong = training.predict(report.model, retraining.training_rows(s, words)).where("target <> predicted").count()
    n = told.first()
    names = ",".join(sorted(set(report.tables) & {"performance", "summary_agreement"}))
    return spark.createDataFrame([(log.get("final training samples", 0), log.get("unsure", 0), n["n_samples"], float(n["accuracy"]), report.tables["error_analysis"].count(), wrong, names)], "usable long, unsure long, n_samples long, accuracy double, errors long, errors_of_the_model long, tables string")
