"""Folds, fitting, grids, and neighbours of wrong predictions. Labels are those of documents; features are of their texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenweb.operators import training
from lumenweb.plans.catalog.base import query, table
from lumenweb.plans.catalog.labels import predictions
from lumenweb.sources.scratch import written

_SMALL = {"maxIter": 3, "maxDepth": 3}


def rows(spark, d):
    """(id, target, features) of labelled documents: cheap counts in the places of the classifier's own."""
    text = F.coalesce("text", F.lit(""))
    words = F.size(F.split(text, " "))
    docs = table(spark, d, "documents").join(table(spark, d, "labels").where("quality is not null"), "doc_id")
    counted = docs.select(F.col("doc_id").alias("id"), F.col("quality").alias("target"), F.array(*[F.length(F.regexp_replace(text, f"[^{c}]+", "")) for c in ("%", "#", "\\n", "*")]).alias("text_feat"), F.size(F.split(text, r"\.")).alias("n_sentences"), words.alias("n_words"), *[F.lit(0).alias(c) for c in ("n_pair_same", "n_pair_successive")], *[F.lit(1000).alias(c) for c in ("min_sent_size_same", "min_sent_size_successive")])
    return training.prepare(counted)


@query("w02_folds", "WITH n AS (SELECT doc_id, quality, count(*) OVER (PARTITION BY quality) AS n FROM labels), f AS (SELECT quality, n, i, CAST(ceil((i + 1) * n / 20.0) AS BIGINT) - CAST(ceil(i * n / 20.0) AS BIGINT) AS rows FROM (SELECT DISTINCT quality, n FROM n), range(0, 20) t(i)) SELECT quality, CAST(i AS INTEGER) AS fold, rows FROM f WHERE rows > 0")
def folds(spark, d):
    out = training.with_folds(table(spark, d, "labels"), "quality", "doc_id")
    return out.groupBy("quality", "fold").agg(F.count("*").alias("rows"))


@query("w02_ordered_folds", "SELECT doc_id, quality, CAST(ntile(20) OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM labels")
def ordered_folds(spark, d):
    return training.ordered_folds(table(spark, d, "labels"), "quality", "doc_id").select("doc_id", "quality", "fold")


@query("o10_split", "SELECT count(*) AS n, true AS disjoint FROM labels")
def split(spark, d):
    train, test = training.split(table(spark, d, "labels"), 0.25, key="doc_id")
    both = train.select("doc_id", F.lit(0).alias("t")).union(test.select("doc_id", F.lit(1).alias("t")))
    return both.agg(F.count("*").alias("n"), (F.count("*") == F.countDistinct("doc_id")).alias("disjoint"))


@query("m17_m20_u05_cross_validation")
def cross_validation(spark, d):
    out = training.cross_validate(rows(spark, d), k=3, settings=_SMALL)
    return out.select("id", "target", "fold", "predicted", F.round("predicted_proba", 6).alias("proba"))


@query("m19_m11_fit_and_predict")
def fit_and_predict(spark, d):
    r = rows(spark, d)
    return training.predict(training.fit(r, settings=_SMALL), r).select("id", "target", "predicted")


@query("m18_m29_other_classifiers")
def other_classifiers(spark, d):
    r = rows(spark, d)
    forest = training.fit_classes(r.withColumn("target", (F.col("id") % 3).cast("int"))).transform(r).select("id", F.col("prediction").cast("int").alias("forest"))
    sparse = training.fit_sparse(r).transform(r).select("id", F.col("prediction").cast("int").alias("sparse"))
    return forest.join(sparse, "id")


@query("m21_scenarios", "SELECT '{''a'': ' || a || ', ''b'': ' || b || '}' AS s FROM (VALUES (1), (2)) x(a), (VALUES (3), (4), (5)) y(b)")
def scenarios(spark, d):
    return spark.createDataFrame([(str(s),) for s in training.scenarios({"a": [1, 2], "b": [3, 4, 5]})], "s string")


@query("m22_m30_grid_search")
def grid(spark, d):
    return training.grid_search(rows(spark, d), {"maxDepth": [2, 3], "maxIter": 2}, k=2)


@query("a29_importance")
def importance(spark, d):
    model = training.fit(rows(spark, d), settings=_SMALL)
    names = ["percent", "hash", "lines", "stars", *training.NUMBERS]
    return training.importance(model, names, spark).select("feature", F.round("importance", 6).alias("importance"))


@query("a30_permutation_importance")
def permutation(spark, d):
    r = written(rows(spark, d), "permuted")
    return training.permutation_importance(training.fit(r, settings=_SMALL), r, ["percent", "hash"])


_NEAREST = "WITH p AS (SELECT doc_id, toxic AS actual, CASE WHEN ((doc_id * 37) % 101) / 100.0 > 0.5 THEN 1 ELSE 0 END AS predicted, concat('l', doc_id % 3) AS language, doc_id % 7 AS f0, doc_id % 11 AS f1, doc_id % 200 AS nw, doc_id % 13 AS ns FROM labels WHERE toxic IS NOT NULL), x AS (SELECT CAST(a.doc_id AS VARCHAR) AS url, CAST(b.doc_id AS VARCHAR) AS url_close, abs(a.f0 - b.f0) + abs(a.f1 - b.f1) + abs(a.nw - b.nw) / 100 + abs(a.ns - b.ns) / 5 AS dist FROM p a JOIN p b ON a.actual <> a.predicted AND b.actual <> a.actual), r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY round(dist, 9), url_close) AS k FROM x) "


def _pages(spark, d):
    return predictions(spark, d).withColumns({"url": F.col("doc_id").cast("string"), "text_feat": F.array(F.col("doc_id") % 7, F.col("doc_id") % 11), "n_pair_same": F.lit(0), "n_pair_successive": F.lit(0), "n_sentences": F.col("doc_id") % 13})


@query("j16_j17_nearest_right", _NEAREST + "SELECT url, round(dist, 6) AS dist FROM r WHERE k = 1")
def nearest_right(spark, d):
    return training.nearest_right(_pages(spark, d)).select("url", F.round("dist", 6).alias("dist"))


@query("o04_error_analysis", _NEAREST + "SELECT r.url, round(dist, 6) AS dist, a.actual, a.language, a.nw AS n_words, a.ns AS n_sentences, b.actual <> a.actual AS other_class FROM r JOIN p a ON CAST(a.doc_id AS VARCHAR) = r.url JOIN p b ON CAST(b.doc_id AS VARCHAR) = r.url_close WHERE k = 1")
def error_analysis(spark, d):
    out = training.error_analysis(_pages(spark, d))
    return out.select("url", F.round("dist", 6).alias("dist"), "actual", "language", "n_words", "n_sentences", (F.col("actual_close") != F.col("actual")).alias("other_class"))


@query("o01_o05_first_files", "SELECT name FROM (SELECT concat('f', page_id) AS name FROM pages) ORDER BY name LIMIT 5")
def first_files(spark, d):
    return table(spark, d, "pages").select(F.concat(F.lit("f"), F.col("page_id")).alias("name")).orderBy("name").limit(5)
