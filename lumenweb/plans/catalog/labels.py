"""Labelled samples, and metrics of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.operators import labels, metrics
from lumenweb.plans.catalog.base import derived, query, table

_NAMES = ["high_content", "for_sale", "blocked", "unsure", "parked_notice_registrar", "starter", "expired"]
# Samples: the events of a bucket label it, each by one of five users.
_LABEL = "CASE WHEN event_id % 11 < 5 THEN 'high_content' ELSE CASE event_id % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END END"
_EVENT = {"url": "concat('u', (event_id * 7919) % 3001)", "label": _LABEL, "labeller": "concat('w', user_id % 5)"}
_SQL = "WITH e AS (SELECT event_id, " + ", ".join(f"{v} AS {k}" for k, v in _EVENT.items()) + " FROM events), c AS (SELECT url, label, count(*) AS n FROM e GROUP BY url, label), s AS (SELECT url, count(*) AS labels, count(DISTINCT label) AS kinds FROM e GROUP BY url), m AS (SELECT url, max(n) AS top, min(label) FILTER (n = mx) AS most, list(label ORDER BY label) FILTER (n = mx) AS tied FROM (SELECT *, max(n) OVER (PARTITION BY url) AS mx FROM c) GROUP BY url), a AS (SELECT s.*, m.top, m.most, m.tied FROM s JOIN m ON s.url = m.url) "


def samples(spark, d):
    e = derived(spark, d, "events", _EVENT, ("event_id",))
    rows = e.groupBy("url").agg(F.sort_array(F.collect_list(F.struct("event_id", "label", "labeller"))).alias("x"))
    return rows.select("url", F.transform("x", lambda x: x["label"]).alias("user_choices"), F.transform("x", lambda x: x["labeller"]).alias("user_name"), F.when(F.hash("url").isNotNull(), "text").alias("html_text"), F.concat("url", F.lit(".png")).alias("ss_filename"))


@query("a09_label_counts", _SQL + "SELECT a.url, kinds AS n_labels, string_agg(label || ':' || n, ' , ' ORDER BY n DESC, label) AS counts FROM a JOIN c ON a.url = c.url GROUP BY a.url, kinds")
def label_counts(spark, d):
    c = labels.label_counts(F.col("user_choices"))
    return samples(spark, d).select("url", F.size(c).cast("long").alias("n_labels"), F.array_join(F.transform(c, lambda x: F.concat(x["label"], F.lit(":"), x["n"].cast("string"))), " , ").alias("counts"))


@query("a10_a11_most_common", _SQL + "SELECT url, most, array_to_string(tied, ',') AS prevailing FROM a")
def most_common(spark, d):
    c = F.col("user_choices")
    return samples(spark, d).select("url", labels.most_common(c).alias("most"), F.array_join(labels.prevailing(c), ",").alias("prevailing"))


@query("p17_p23_m26_predicates", _SQL + "SELECT url, labels > 0 AS labelled, labels = 1 AS single, labels > 1 AS multi, kinds > 1 OR most <> 'parked_notice_registrar' AS not_registrar, list_contains(tied, 'unsure') AS unsure, kinds > 2 OR kinds = 2 AND top * 1.0 / labels < 0.51 AS disagreement, kinds = 1 AS full_agreement FROM a")
def predicates(spark, d):
    c = F.col("user_choices")
    return samples(spark, d).select("url", labels.is_labelled(c).alias("labelled"), labels.is_single(c).alias("single"), labels.is_multi(c).alias("multi"), labels.is_not_registrar(c).alias("not_registrar"), labels.is_unsure(c).alias("unsure"), labels.is_disagreement(c).alias("disagreement"), labels.is_full_agreement(c).alias("full_agreement"))


@query("p18_p24_texts", "SELECT doc_id, length(trim(CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '.' ELSE text END)) > 0 AS has_text, true AS compat, doc_id % 5 < 3 AS trivial FROM documents WHERE length(text) > 5")
def texts(spark, d):
    t = F.expr("CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '.' ELSE text END")
    return table(spark, d, "documents").where("length(text) > 5").select("doc_id", labels.has_text(t).alias("has_text"), labels.has_text(t, True).alias("compat"), labels.is_trivial_text(t).alias("trivial"))


@query("a08_agreement_summary", _SQL + "SELECT metric, value FROM (SELECT 'N_single_label' AS metric, CAST(count(*) FILTER (labels = 1) AS DOUBLE) AS value FROM a UNION ALL SELECT 'N_multi_label', count(*) FILTER (labels > 1) FROM a UNION ALL SELECT 'Ratio_agreement', count(*) FILTER (labels > 1 AND kinds = 1) / nullif(count(*) FILTER (labels > 1), 0) FROM a UNION ALL SELECT 'N_disagreement', count(*) FILTER (labels > 1 AND kinds > 1) FROM a)")
def agreement(spark, d):
    return labels.agreement_summary(samples(spark, d))


@query("o02_top_disagreements", _SQL + "SELECT a.url, a.url || '.png' AS ss_filename, kinds AS n_labels, string_agg(label || ':' || n, ' , ' ORDER BY n DESC, label) AS label_counts FROM a JOIN c ON a.url = c.url WHERE kinds > 1 GROUP BY a.url, kinds ORDER BY kinds DESC, a.url LIMIT 10000")
def disagreements(spark, d):
    return labels.top_disagreements(samples(spark, d)).withColumn("n_labels", F.col("n_labels").cast("long"))


@query("a12_j18_o03_m27_labellers", _SQL + ", f AS (SELECT e.*, a.labels, a.kinds, c.n FROM e JOIN a ON e.url = a.url JOIN c ON c.url = e.url AND c.label = e.label) SELECT labeller, count(*) FILTER (labels > 1 AND kinds = 1) AS is_full_agreement, count(*) FILTER (labels > 1 AND n > 1) AS has_one_agreement, count(*) FILTER (labels > 1) AS \"QTY_labels_with_multi_lbls\", count(*) AS \"QTY_labels\", count(*) FILTER (labels > 1 AND kinds = 1) / count(*) FILTER (labels > 1) AS ratio_full_agreement, count(*) FILTER (labels > 1 AND n > 1) / count(*) FILTER (labels > 1) AS ratio_one_agreement FROM f GROUP BY labeller HAVING count(*) FILTER (labels > 1) > 0")
def labellers(spark, d):
    return labels.labeller_summary(samples(spark, d))


@query("m13_usable_samples", _SQL + "SELECT url, most AS target_label FROM a WHERE (kinds > 1 OR most <> 'parked_notice_registrar') AND NOT list_contains(tied, 'unsure') AND NOT (kinds > 2 OR kinds = 2 AND top * 1.0 / labels < 0.51)")
def usable(spark, d):
    return labels.usable(samples(spark, d)).select("url", "target_label")


@query("m13_filter_log", _SQL + "SELECT CASE WHEN NOT (kinds > 1 OR most <> 'parked_notice_registrar') THEN 'registrar' WHEN list_contains(tied, 'unsure') THEN 'unsure' WHEN kinds > 2 OR kinds = 2 AND top * 1.0 / labels < 0.51 THEN 'disagreement' ELSE 'final training samples' END AS step, count(*) AS removed FROM a GROUP BY 1")
def log(spark, d):
    return labels.filter_log(samples(spark, d))


@query("a25_label_percentages", "WITH p AS (SELECT page_id, 1 + page_id % 5 AS a, 1 + page_id % 3 AS b FROM pages), q AS (SELECT *, CAST(floor(floor(100 * a / (a + b)) / 10) * 10 AS INTEGER) AS pa, CAST(floor(floor(100 * b / (a + b)) / 10) * 10 AS INTEGER) AS pb FROM p) SELECT page_id, pa + CASE WHEN pa + pb <> 100 THEN 10 ELSE 0 END AS first, pb AS second FROM q")
def percentages(spark, d):
    p = derived(spark, d, "pages", {"c": "array(named_struct('label', 'a', 'n', 1 + page_id % 5), named_struct('label', 'b', 'n', 1 + page_id % 3))"}, ("page_id",))
    r = p.withColumn("r", labels.label_percentages(F.transform("c", lambda x: F.struct(x["label"].alias("label"), x["n"].cast("int").alias("n")))))
    return r.select("page_id", F.col("r")[0]["percent"].alias("first"), F.col("r")[1]["percent"].alias("second"))


@query("m15_m16_targets", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 0 WHEN 3 THEN -1 ELSE 1 END AS lv2, CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE -1 END AS lv3, CASE WHEN doc_id % 2 = 0 THEN 'parked_notice_individual_content' ELSE 'high_content' END AS legacy FROM documents")
def targets(spark, d):
    label = F.expr("CASE doc_id % 4 WHEN 0 THEN 'high_content' WHEN 1 THEN 'starter' WHEN 2 THEN 'index_of' ELSE 'odd' END")
    return table(spark, d, "documents").select("doc_id", *[F.coalesce(labels.target_of(label, c), F.lit(-1)).alias(n) for n, c in (("lv2", False), ("lv3", True))], labels.legacy_label(F.expr("CASE WHEN doc_id % 2 = 0 THEN 1.0 ELSE 0.0 END")).alias("legacy"))


_PRED = {"actual": "toxic", "pred": "((doc_id * 37) % 101) / 100.0", "predicted": "CASE WHEN ((doc_id * 37) % 101) / 100.0 > 0.5 THEN 1 ELSE 0 END", "language": "concat('l', doc_id % 3)", "tld": "concat('t', doc_id % 5)", "n_words": "doc_id % 200"}
_PSQL = "WITH p AS (SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in _PRED.items()) + " FROM labels WHERE toxic IS NOT NULL) "


def predictions(spark, d):
    return derived(spark, d, "labels", _PRED, ("doc_id",)).withColumn("pred", F.col("pred").cast("double")).where("actual is not null")


_CELLS = "count(*) FILTER (actual = 0 AND predicted = 0) AS tn, count(*) FILTER (actual = 0 AND predicted = 1) AS fp, count(*) FILTER (actual = 1 AND predicted = 0) AS fn, count(*) FILTER (actual = 1 AND predicted = 1) AS tp"
_RATES = "round((tp + tn) / n, 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1"
_ROUNDED = ["accuracy", "precision", "recall", "f1"]


def rounded(df, columns=_ROUNDED):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("a13_a14_binary_metrics", _PSQL + f"SELECT n AS n_samples, tn, fp, fn, tp, {_RATES} FROM (SELECT count(*) AS n, {_CELLS} FROM p)")
def binary(spark, d):
    return rounded(metrics.binary(predictions(spark, d)))


@query("a13_auc", _PSQL + "SELECT round(sum(CASE WHEN a.pred > b.pred THEN 1.0 WHEN a.pred = b.pred THEN 0.5 ELSE 0 END) / count(*), 9) AS auc FROM p a, p b WHERE a.actual = 1 AND b.actual = 0")
def auc(spark, d):
    return rounded(metrics.auc(predictions(spark, d)), ["auc"])


@query("a15_multiclass", _PSQL + "SELECT count(*) AS n_samples, round(count(*) FILTER (actual = predicted) / count(*), 9) AS accuracy FROM p")
def multiclass(spark, d):
    return rounded(metrics.multiclass(predictions(spark, d)).select("n_samples", "accuracy"), ["accuracy"])


@query("a16_one_against_rest", _PSQL + f"SELECT 1 AS class, {_CELLS} FROM p UNION ALL SELECT 0, count(*) FILTER (actual <> 0 AND predicted <> 0), count(*) FILTER (actual <> 0 AND predicted = 0), count(*) FILTER (actual = 0 AND predicted <> 0), count(*) FILTER (actual = 0 AND predicted = 0) FROM p")
def one_against_rest(spark, d):
    return metrics.one_against_rest(predictions(spark, d), [0, 1])


@query("a17_by_language_and_tld", _PSQL + f", g AS (SELECT 'language' AS kind, language AS name, * FROM p UNION ALL SELECT 'tld', tld, * FROM p), h AS (SELECT kind, name, count(*) AS n, {_CELLS} FROM g GROUP BY kind, name HAVING count(*) > 1) SELECT kind, name, n AS count, tn, fp, fn, tp, {_RATES} FROM h")
def by_group(spark, d):
    return rounded(metrics.by_language_and_tld(predictions(spark, d), "actual", "pred"))


@query("a18_m32_m33_history", _PSQL + ", a AS (SELECT count(*) AS n, count(*) FILTER (actual = predicted) / count(*) AS acc FROM p) SELECT round(acc, 9) AS \"Accuracy\", n AS n_samples, 'r1' AS ref_time, round(0.56 * acc + 0.29 * 0.9902 + 0.15 * 0.98, 9) AS \"Accuracy_CCTLD\", round(0.31 * acc + 0.55 * 0.9902 + 0.14 * 0.98, 9) AS \"Accuracy_GTLD\" FROM a UNION ALL SELECT 0.5, 10, 'r0', 0.5, 0.5")
def history(spark, d):
    record = metrics.history_record(metrics.binary(predictions(spark, d)), "r1")
    old = spark.createDataFrame([(0.5, 10, "r0", 0.5, 0.5)], record.schema)
    return rounded(metrics.append_history(old, record), ["Accuracy", "Accuracy_CCTLD", "Accuracy_GTLD"])


@query("a19_confusion", _PSQL + "SELECT actual, predicted, count(*) AS n FROM p GROUP BY actual, predicted")
def confusion(spark, d):
    return metrics.confusion(predictions(spark, d))


@query("a26_class_weight", _PSQL + "SELECT round((count(*) - sum(actual)) / sum(actual), 9) AS weight FROM p")
def class_weight(spark, d):
    return rounded(metrics.class_weight(predictions(spark, d), "actual"), ["weight"])


@query("m34_thresholds", _PSQL + "SELECT doc_id, CAST(pred > 0.5 AS INTEGER) AS above, CAST(pred >= 0.5 AS INTEGER) AS from_on FROM p")
def thresholds(spark, d):
    return predictions(spark, d).select("doc_id", metrics.to_class(F.col("pred")).alias("above"), metrics.to_class(F.col("pred"), inclusive=True).alias("from_on"))


@query("p31_m24_m25_suggested_errors", _PSQL + ", e AS (SELECT doc_id, actual, predicted, n_words, doc_id % 4 AS attr FROM p WHERE actual <> predicted) SELECT doc_id, array_to_string(list_filter([CASE WHEN n_words <= 1 THEN 'TOK' END, CASE WHEN n_words > 1 AND actual = 1 AND attr = 0 THEN 'TOK_or_TRANS_or_REF' END, CASE WHEN actual = 1 AND attr > 0 AND predicted = 0 THEN 'ML' END, CASE WHEN actual = 0 AND attr > 0 AND predicted = 1 THEN 'LblFN' END, CASE WHEN actual = 1 AND attr = 0 AND predicted = 0 AND n_words > 100 THEN 'LblFP' END], lambda x: x IS NOT NULL), ' - ') AS suggested_error FROM e")
def suggested(spark, d):
    wrong = metrics.errors(predictions(spark, d), "actual").withColumns({"target": F.col("actual"), "pred_ml_park": F.col("predicted") == 1})
    return metrics.suggested_errors(wrong, F.col("doc_id") % 4).select("doc_id", "suggested_error")


@query("m31_feature_text", "SELECT doc_id, concat(CASE WHEN doc_id % 2 > 0 THEN 'sale:1.0_' ELSE '' END, CASE WHEN doc_id % 3 > 0 THEN concat('domain:', doc_id % 3, '.0_') ELSE '' END) AS words FROM documents")
def feature_text(spark, d):
    return table(spark, d, "documents").select("doc_id", metrics.feature_text(F.array(F.col("doc_id") % 2, F.col("doc_id") % 3), ["sale", "domain"]).alias("words"))


@query("m35_m36_m37_m38_tables", "SELECT 'a' AS section, 'k' AS parameter, '2' AS value UNION ALL SELECT 'a', 'z', '1' UNION ALL SELECT 'b', 'q', 'x'")
def tables(spark, d):
    return metrics.config_table(spark, {"a": {"z": 1, "k": 2}, "b": {"q": "x"}})


@query("u02_positive_negative", "SELECT doc_id, 1 AS target FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 0 FROM labels WHERE quality = 0")
def positive_negative(spark, d):
    rows = table(spark, d, "labels")
    return rows.where("quality = 1").select("doc_id", F.lit(1).alias("target")).unionByName(rows.where("quality = 0").select("doc_id", F.lit(0).alias("target")))


@query("p32_p33_label_subset", "SELECT doc_id, CASE WHEN doc_id % 6 IN (2, 3) THEN 1 ELSE 0 END AS target FROM labels WHERE doc_id % 6 IN (2, 3, 5)")
def subset(spark, d):
    sub = F.col("doc_id") % 6
    return table(spark, d, "labels").where(sub.isin(2, 3, 5)).select("doc_id", F.when(sub.isin(2, 3), 1).otherwise(0).alias("target"))


@query("p27_text_filters", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> 'None' AND len(list_filter(regexp_split_to_array(text, ' '), lambda x: x <> '')) >= 3")
def text_filters(spark, d):
    return table(spark, d, "documents").where(F.col("text").isNotNull() & (F.col("text") != "None") & (F.size(F.array_remove(F.split("text", " "), "")) >= 3)).select("doc_id")
