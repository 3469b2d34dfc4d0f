"""Copies and rare classes don't take the trees' sample."""

import random

from pyspark.sql import functions as F

from lumenweb.llm import urlfilter


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(urlfilter.fit, "__defaults__", (20,))
    urls = [f"https://a.shop{i}.com/{i}" for i in range(40)] + [f"http://b.shop{i}.net/es/{i}/x" for i in range(40)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls * 30)], "page_id long, url string")
    out = urlfilter.judge(pages).select("verdict", "margin").distinct().collect()
    assert all((r.margin > 0) == (r.verdict == "block") for r in out) and {r.verdict for r in out} == {"allow", "block"}


def test_trees_on_hosts_that_they_have_not_seen(spark):
    """Labels depend on the path's shape and the suffix; hosts of every fifth number are held out of the fit."""
    rng = random.Random(3)
    rows = []
    for i in range(2500):
        spam = rng.random() < 0.4
        path = "-".join(str(rng.randint(100, 9999)) for _ in range(rng.randint(3, 6))) if spam else rng.choice(["about", "news/today", "team/contact"])
        rows.append((f"http://h{i % 500}.{rng.choice(['shop', 'club']) if spam and rng.random() < 0.7 else rng.choice(['com', 'org', 'shop'])}/{path}", int(spam), i % 5 == 0))
    df = spark.createDataFrame(rows, "url string, label int, out boolean")
    sql, rates, mean = urlfilter.fit(df.where("not out").select("url", "label"))
    host, path = urlfilter.split_url(F.col("url"))
    scored = urlfilter.with_rate(urlfilter.features(df.where("out").withColumns({"host": host, "path": path})), rates, mean).withColumn("margin", F.expr(sql)).collect()
    assert len(scored) == 500
    assert sum((r.margin > 0) == (r.label == 1) for r in scored) / len(scored) > 0.97


def test_no_label_is_in_its_own_features(spark):
    """Every suffix has one host: its own fold holds all of it, so the rate of training rows is the common one and can't tell the classes."""
    rows = [(f"http://a.s{i}/x{j}", i % 2) for i in range(80) for j in range(5)]
    sql, _, mean = urlfilter.fit(spark.createDataFrame(rows, "url string, label int"))
    assert mean == 0.5
    assert "suffix_rate" not in sql
