"""Labelled samples: which can be used, how far labellers agree, what the target is. Samples hold arrays, so a sample's own questions need no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.functions.fixed import LABELS
from lumenweb.functions.text import let
from lumenweb.operators.common import true

UNSURE, REGISTRAR = "unsure", "parked_notice_registrar"
MAX_LABELS, SHARE, TOP = 2, 0.51, 10_000


def label_counts(labels: Column) -> Column:
    """array of struct(label, n), most frequent first, ties by label."""
    counted = F.transform(F.array_distinct(labels), lambda x: F.struct((-F.size(F.filter(labels, lambda y: y == x))).alias("k"), x.alias("label")))
    return F.transform(F.array_sort(counted), lambda x: F.struct(x["label"].alias("label"), (-x["k"]).alias("n")))


def shared_labels(labels: Column) -> Column:
    """The labels that occur more than once. As label_counts, one pass for each different label."""
    return F.filter(F.array_distinct(labels), lambda x: F.size(F.filter(labels, lambda y: y == x)) > 1)


def most_common(labels: Column) -> Column:
    return F.get(label_counts(labels), F.lit(0))["label"]


def prevailing(labels: Column) -> Column:
    """All labels that are as frequent as the most frequent one."""
    return let(label_counts(labels), lambda c: F.transform(F.filter(c, lambda x: x["n"] == F.get(c, F.lit(0))["n"]), lambda x: x["label"]))


def is_labelled(choices: Column, target: Column | None = None) -> Column:
    own = true(F.size(choices) > 0)
    return own if target is None else own | true(target.isin(0.0, 1.0))


def has_text(text: Column, compat: bool = False) -> Column:
    """compat: an empty text counts as one too."""
    return text.isNotNull() if compat else true(F.length(F.trim(text)) > 0)


def is_not_registrar(choices: Column) -> Column:
    kinds = F.array_distinct(choices)
    return F.coalesce((F.size(kinds) > 1) | (F.get(kinds, F.lit(0)) != REGISTRAR), F.lit(True))


def is_single(choices: Column) -> Column:
    return true(F.size(choices) == 1)


def is_multi(choices: Column) -> Column:
    return true(F.size(choices) > 1)


def is_unsure(choices: Column) -> Column:
    return true(F.array_contains(prevailing(choices), UNSURE))


def is_disagreement(choices: Column) -> Column:
    """More than two labels, or two of which none prevails."""
    n = F.size(F.array_distinct(choices))
    top = F.get(label_counts(choices), F.lit(0))["n"]
    return true(F.when(n <= 1, False).when(n > MAX_LABELS, True).otherwise(top / F.size(choices) < SHARE))


def is_full_agreement(choices: Column) -> Column:
    return true(F.size(F.array_distinct(choices)) == 1)


def has_one_agreement(label: Column, choices: Column) -> Column:
    return true(F.size(F.filter(choices, lambda x: x == label)) > 1)


def is_trivial_text(text: Column) -> Column:
    return text.isin("", " ", ".", "..")


def legacy_label(target: Column) -> Column:
    return F.when(target == 1.0, "parked_notice_individual_content").when(target == 0.0, "high_content")


def target_of(label: Column, classes: bool = False) -> Column:
    """The training target: parked or not, or one of six classes; null for labels that aren't known."""
    return F.create_map(*[F.lit(x) for k, v in LABELS.items() for x in (k, v[1] if classes else v[0])])[label]


def agreement_summary(samples: DataFrame, choices: str = "user_choices") -> DataFrame:
    """(metric, value): single and multiple labels, the share of agreement (null without multiple ones), disagreements."""
    c = F.col(choices)
    n = samples.agg(F.count_if(is_single(c)).alias("single"), F.count_if(is_multi(c)).alias("multi"), F.count_if(is_multi(c) & is_full_agreement(c)).alias("agreed"))
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in (("N_single_label", F.col("single")), ("N_multi_label", F.col("multi")), ("Ratio_agreement", F.try_divide(F.col("agreed"), F.col("multi"))), ("N_disagreement", F.col("multi") - F.col("agreed")))])
    return n.select(F.inline(rows))


def top_disagreements(samples: DataFrame, top: int = TOP, choices: str = "user_choices") -> DataFrame:
    """(url, ss_filename, n_labels, label_counts) of samples with several labels, most different ones first; a top-k report."""
    c = F.col(choices)
    told = F.array_join(F.transform(label_counts(c), lambda x: F.concat(x["label"], F.lit(":"), x["n"].cast("string"))), " , ")
    rows = samples.where(is_multi(c)).select("url", "ss_filename", F.size(F.array_distinct(c)).alias("n_labels"), told.alias("label_counts"))
    return rows.where("n_labels > 1").orderBy(F.desc("n_labels"), "url").limit(top)


def label_percentages(counts: Column) -> Column:
    """array of struct(label, percent): shares cut to tens; what is left to 100 goes to the first label. counts: from label_counts."""
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x["n"])
    cut = F.transform(counts, lambda x: F.struct(x["label"].alias("label"), (F.floor(F.floor(100 * x["n"] / total) / 10) * 10).cast("int").alias("percent")))
    short = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["percent"]) != 100
    return let(cut, lambda c: F.transform(c, lambda x, i: F.struct(x["label"].alias("label"), (x["percent"] + F.when((i == 0) & short(c), 10).otherwise(0)).alias("percent"))))


def labeller_summary(samples: DataFrame, choices: str = "user_choices", names: str = "user_name") -> DataFrame:
    """Per labeller: labels on samples of several, how many agree with all or with one other, ratios, and all labels given. Worst first."""
    c = F.col(choices)
    # All that a label needs of its sample is found once a sample and goes into the label's own struct: a row that carried its sample's labels beside it would make the rows' size the square of a sample's.
    sample = F.struct(shared_labels(c).alias("often"), is_single(c).alias("single"), is_full_agreement(c).alias("full"))
    pairs = F.arrays_zip(c.alias("label"), F.col(names).alias("labeller"))
    told = let(sample, lambda s: F.transform(pairs, lambda x: F.struct(x["labeller"].alias("labeller"), s["single"].alias("single"), s["full"].alias("full"), true(F.array_contains(s["often"], x["label"])).alias("one"))))
    flat = samples.where(F.size(c) > 0).select(F.explode(told).alias("x")).select("x.*")
    several = ~F.col("single")
    out = flat.groupBy("labeller").agg(F.count_if(several & F.col("full")).alias("is_full_agreement"), F.count_if(several & F.col("one")).alias("has_one_agreement"), F.count_if(several).alias("QTY_labels_with_multi_lbls"), F.count("*").alias("QTY_labels"))
    out = out.where("QTY_labels_with_multi_lbls > 0")
    ratio = lambda k: F.col(k) / F.col("QTY_labels_with_multi_lbls")
    return out.withColumns({"ratio_full_agreement": ratio("is_full_agreement"), "ratio_one_agreement": ratio("has_one_agreement")}).orderBy("ratio_full_agreement", "ratio_one_agreement", "labeller")


def usable(samples: DataFrame, choices: str = "user_choices", text: str = "html_text", target: str | None = None, compat: bool = False) -> DataFrame:
    """Samples to train on, with target_label: labelled, with text, not a registrar's, sure, and without disagreement."""
    c = F.col(choices)
    legacy = F.col(target) if target else None
    out = samples.where(is_labelled(c, legacy) & has_text(F.col(text), compat) & is_not_registrar(c) & ~is_unsure(c) & ~is_disagreement(c))
    label = most_common(c)
    return out.withColumn("target_label", F.coalesce(label, legacy_label(legacy)) if target else label)


def filter_log(samples: DataFrame, choices: str = "user_choices", text: str = "html_text") -> DataFrame:
    """(step, removed): how many samples each filter takes out, in one pass."""
    c = F.col(choices)
    flags = {"no label": ~is_labelled(c), "no text": ~has_text(F.col(text)), "registrar": ~is_not_registrar(c), "unsure": is_unsure(c), "disagreement": is_disagreement(c)}
    first = F.coalesce(*[F.when(v, k) for k, v in flags.items()], F.lit("final training samples"))
    return samples.groupBy(first.alias("step")).agg(F.count("*").alias("removed"))
