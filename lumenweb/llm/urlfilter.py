"""URL filter: rules first, then gradient-boosted trees on lexical features. DataFrame and SQL functions only.

Rules name a host (and its subdomains) and the beginning of a path; the longest that fits decides. URLs that a rule
decides are the labelled URLs from which the trees learn (at most ``TRAIN_ROWS`` distinct ones of each class, those with the
smallest hash); the trees then judge the URLs that no rule fits. Features: lengths, depth, digit ratio, entropy of the characters, counts of
parameters, hyphens and labels, and two statistics of the host's suffix among all distinct labelled URLs: how many there
are, and the smoothed share of blocked ones. A training URL gets the share that the other folds' labels give (``FOLDS``
folds by the hash of its host), so no URL's own label, nor one of its host, is in its features.
Fitted trees become one SQL expression, so scoring is a projection of the scan.

Edge cases: host and path are empty for a null url or one without ``://``; such URLs have features too (all zero for
null); with labels of one class only, that class is the verdict of all, and without any, allow; repeated rows are judged
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.common import materialize

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
TRAIN_ROWS, TREES, DEPTH, STEP, SMOOTHING, FOLDS = 8000, 20, 4, 0.2, 20.0, 5


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(the rule's text, its verdict); null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Of the characters, in bits: runs of equal characters in sorted order are their counts."""
    runs = F.regexp_extract_all(F.array_join(F.array_sort(F.split(text, "")), ""), F.lit(r"(?s)(.)\1*"), F.lit(0))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.aggregate(runs, F.lit(0.0), lambda a, x: a - F.length(x) / n * F.log2(F.length(x) / n))


FEATURES = ("url_len", "host_len", "path_len", "query_len", "depth", "labels", "digit_ratio", "hyphens", "params", "segment_len", "entropy", "secure", "fragment", "suffix_seen", "suffix_rate")


def features(df: DataFrame) -> DataFrame:
    """Adds all of FEATURES but those of the suffix, and suffix."""
    url, count = F.coalesce(F.col("url"), F.lit("")), lambda c, chars: F.length(F.regexp_replace(c, f"[^{chars}]+", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    out = {
        "url_len": F.length(url), "host_len": F.length("host"), "path_len": F.length("path"), "query_len": F.length(query), "depth": count(F.col("path"), "/"), "labels": count(F.col("host"), "."),
        "digit_ratio": count(url, "0-9") / F.greatest(F.length(url), F.lit(1)), "hyphens": count(url, "-"), "params": F.when(query == "", 0).otherwise(count(query, "&") + 1), "segment_len": F.length(F.regexp_extract("path", r"^/([^/]*)", 1)),
        "entropy": _entropy(url), "secure": url.startswith("https://").cast("int"), "fragment": F.contains(url, F.lit("#")).cast("int"),
    }
    return df.withColumns({k: v.cast("double") for k, v in out.items()}).withColumn("suffix", F.element_at(F.split("host", r"\."), -1))


def _tree_sql(text: str, names: tuple[str, ...]) -> str:
    """Spark's description of one tree as a SQL expression."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(i: int) -> tuple[str, int]:
        if m := re.match(r"Predict: (\S+)", lines[i]):
            return f"{float(m[1])!r}D", i + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[i])
        yes, i = node(i + 1)
        no, i = node(i + 1)
        return f"(CASE WHEN {names[int(m[1])]} <= {float(m[2])!r}D THEN {yes} ELSE {no} END)", i

    return node(0)[0]


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[str, DataFrame | None, float]:
    """labelled: url, label (1: block). Returns the margin as SQL, the suffixes' statistics (suffix, suffix_seen, suffix_rate), and the common share."""
    host, path = split_url(F.col("url"))
    known = labelled.groupBy("url").agg(F.first("label").cast("double").alias("label")).withColumns({"host": host, "path": path})
    known = known.withColumns({"suffix": F.element_at(F.split("host", r"\."), -1), "fold": F.pmod(F.xxhash64("host"), F.lit(FOLDS))})
    cells = materialize(known.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("s")), "url-suffixes")
    total, blocks = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("s"), F.lit(0.0))).first()
    mean = blocks / total if total else 0.0
    if not 0 < blocks < total:
        return ("1.0D" if mean == 1 else "-1.0D"), None, mean
    some = [known.where(F.col("label") == y).orderBy(F.xxhash64("url"), "url").limit(train_rows) for y in (0, 1)]
    train = materialize(features(some[0].union(some[1])), "url-train")
    n, blocked = train.agg(F.count("*"), F.sum("label")).first()
    seen, rate = F.log1p(F.col("n")), (F.col("s") + SMOOTHING * mean) / (F.col("n") + SMOOTHING)
    sums = cells.groupBy("suffix").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    # What the other folds say of a suffix; a fold that holds all of one leaves nothing but the common share.
    others = sums.withColumn("fold", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(FOLDS - 1).cast("long")))).join(cells, ["suffix", "fold"], "left")
    others = others.select("suffix", "fold", (F.col("all_n") - F.coalesce("n", F.lit(0))).alias("n"), (F.col("all_s") - F.coalesce("s", F.lit(0.0))).alias("s"))
    fair = train.join(others.select("suffix", "fold", seen.alias("suffix_seen"), rate.alias("suffix_rate")), ["suffix", "fold"])
    # Rules name what they block more often than what they allow; both classes weigh the same.
    weighed = fair.withColumn("weight", F.when(F.col("label") == 1, n / (2 * blocked)).otherwise(n / (2 * (n - blocked))))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(weighed).select("features", "label", "weight")
    model = GBTClassifier(weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=32, seed=42).fit(vectors)
    parts = [f"{w!r}D * {_tree_sql(t.toDebugString, FEATURES)}" for w, t in zip(model.treeWeights, model.trees, strict=True)]
    rates = sums.select("suffix", F.col("all_n").alias("n"), F.col("all_s").alias("s")).select("suffix", seen.alias("suffix_seen"), rate.alias("suffix_rate"))
    return " + ".join(parts), rates, mean


def with_rate(df: DataFrame, rates: DataFrame | None, mean: float) -> DataFrame:
    """Adds the suffix's statistics; their table is as large as there are suffixes, so Spark chooses how it is joined."""
    if rates is None:
        return df.withColumns({"suffix_seen": F.lit(0.0), "suffix_rate": F.lit(mean)})
    return df.join(rates, "suffix", "left").withColumns({"suffix_seen": F.coalesce("suffix_seen", F.lit(0.0)), "suffix_rate": F.coalesce("suffix_rate", F.lit(mean))})


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url) with host, path, rule, verdict and the trees' margin (above zero: block)."""
    host, path = split_url(F.col("url"))
    base = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": name, "ruled": verdict})
    sql, rates, mean = fit(base.where("ruled is not null").select("url", (F.col("ruled") == "block").cast("int").alias("label")))
    scored = with_rate(features(base), rates, mean).withColumn("margin", F.expr(sql))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("margin") > 0, "block").otherwise("allow")).alias("verdict"), "margin")
