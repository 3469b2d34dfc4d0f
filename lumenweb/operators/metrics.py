"""Quality of predictions. Every metric is a partial aggregation; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenweb.functions.fixed import ERROR_ACCURACY, LABELS, PREVALENCE, REGISTRAR_ACCURACY
from lumenweb.operators.common import true
from lumenweb.operators.ranks import below, ranged


def to_class(probability: Column, threshold: float = 0.5, inclusive: bool = False) -> Column:
    """1 above the threshold; inclusive: also at it."""
    return ((probability >= threshold) if inclusive else (probability > threshold)).cast("int")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary(df: DataFrame, actual: str = "actual", probability: str = "pred", threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """n_samples, the confusion matrix (tn, fp, fn, tp), accuracy, precision, recall and f1, for all or for each group."""
    y, p = F.col(actual) == 1, to_class(F.col(probability), threshold) == 1
    cells = {"tn": ~y & ~p, "fp": ~y & p, "fn": y & ~p, "tp": y & p}
    out = df.groupBy(*(by or [])).agg(F.count("*").alias("n_samples"), *[F.count_if(v).alias(k) for k, v in cells.items()])
    tp, fp, fn = (F.col(k) for k in ("tp", "fp", "fn"))
    return out.withColumns({"accuracy": _ratio(tp + F.col("tn"), F.col("n_samples")), "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _ratio(2 * tp, 2 * tp + fp + fn)})


def auc(df: DataFrame, actual: str = "actual", probability: str = "pred") -> DataFrame:
    """(auc): from the counts of each distinct probability, so ties count half; null if a class is missing."""
    counts = df.groupBy(F.col(probability).alias("p")).agg(F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))
    inside = F.coalesce(F.sum("neg").over(Window.partitionBy("_range").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = below(ranged(counts, ["p"]), F.col("neg"), "_base").withColumn("_in", inside)
    wins = F.sum(F.col("pos").cast("double") * (F.col("_base") + F.col("_in") + F.col("neg") / 2))
    return parts.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def multiclass(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(n_samples, accuracy, precision, recall, f1) in micro average: with one label a row they are all the share that is right."""
    right = F.count_if(F.col(actual) == F.col(predicted)) / F.count("*")
    return df.agg(F.count("*").alias("n_samples"), *[right.alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def one_against_rest(df: DataFrame, classes: list[int], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """(class, tn, fp, fn, tp) of each class, from one pass."""
    found = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    each = found.withColumn("class", F.explode(F.array(*[F.lit(c) for c in classes])))
    cell = lambda a, p: F.coalesce(F.sum(F.when(a & p, F.col("n"))), F.lit(0))
    a, p = F.col("a") == F.col("class"), F.col("p") == F.col("class")
    return each.groupBy("class").agg(cell(~a, ~p).alias("tn"), cell(~a, p).alias("fp"), cell(a, ~p).alias("fn"), cell(a, p).alias("tp"))


def by_language_and_tld(df: DataFrame, actual: str = "target", probability: str = "predicted_proba", threshold: float = 0.5) -> DataFrame:
    """Metrics of each language and each tld with more than one row, from one pass with grouping sets; largest first."""
    y, p = F.col(actual) == 1, to_class(F.col(probability), threshold) == 1
    cells = {"tn": ~y & ~p, "fp": ~y & p, "fn": y & ~p, "tp": y & p}
    marked = df.withColumns({f"_{k}": v.cast("int") for k, v in cells.items()})
    both = marked.groupingSets([["language"], ["tld"]], "language", "tld").agg(F.grouping_id().alias("_g"), F.count("*").alias("count"), *[F.sum(f"_{k}").alias(k) for k in cells])
    kind = F.when(F.col("_g") == 1, "language").otherwise("tld")
    rows = both.select(kind.alias("kind"), F.when(F.col("_g") == 1, F.col("language")).otherwise(F.col("tld")).alias("name"), "count", *cells).where("count > 1 and name is not null")
    tp = F.col("tp")
    return rows.withColumns({"accuracy": _ratio(tp + F.col("tn"), F.col("count")), "precision": _ratio(tp, tp + F.col("fp")), "recall": _ratio(tp, tp + F.col("fn")), "f1": _ratio(2 * tp, 2 * tp + F.col("fp") + F.col("fn"))}).orderBy("kind", F.desc("count"), "name")


def general_accuracy(accuracy: Column, kind: str) -> Column:
    """Of all domains of a kind of tld (cctld, gtld): the classifier's accuracy, and that of errors and registrars, by their shares."""
    errors, registrars = PREVALENCE[kind]
    return (1 - errors - registrars) * accuracy + errors * ERROR_ACCURACY + registrars * REGISTRAR_ACCURACY


def history_record(metrics: DataFrame, ref_time: str) -> DataFrame:
    """A row of the performance history."""
    a = F.col("accuracy")
    return metrics.select(a.alias("Accuracy"), "n_samples", F.lit(ref_time).alias("ref_time"), general_accuracy(a, "cctld").alias("Accuracy_CCTLD"), general_accuracy(a, "gtld").alias("Accuracy_GTLD"))


def append_history(history: DataFrame, record: DataFrame) -> DataFrame:
    return history.unionByName(record, allowMissingColumns=True)


def class_weight(df: DataFrame, target: str = "target") -> DataFrame:
    """(weight): what a positive row counts against a negative one."""
    positive = F.sum(F.col(target))
    return df.agg(F.try_divide((F.count(target) - positive).cast("double"), positive.cast("double")).alias("weight"))


def errors(df: DataFrame, actual: str = "target", predicted: str = "predicted") -> DataFrame:
    return df.where(F.col(actual) != F.col(predicted))


def is_token_error(n_words: Column) -> Column:
    return true(n_words <= 1)


def suggested_errors(df: DataFrame, attributes: Column) -> DataFrame:
    """Where to look for the reason of a wrong prediction. df: target, n_words, pred_ml_park; attributes: how many attribute words the page has."""
    parked, said = F.col("target") == 1, true(F.col("pred_ml_park"))
    tok = is_token_error(F.col("n_words"))
    flags = {"n_words_attrib": attributes, "err_is_tok_or_trans": ~tok & parked & (attributes == 0), "err_is_ml": parked & (attributes > 0) & ~said, "err_is_lbl_fn": ~parked & (attributes > 0) & said, "err_is_lbl_fp": parked & (attributes == 0) & ~said & (F.col("n_words") > 100)}
    names = {"TOK": tok, "TOK_or_TRANS_or_REF": flags["err_is_tok_or_trans"], "ML": flags["err_is_ml"], "LblFN": flags["err_is_lbl_fn"], "LblFP": flags["err_is_lbl_fp"]}
    return df.withColumns(flags | {"suggested_error": F.array_join(F.array_compact(F.array(*[F.when(v, k) for k, v in names.items()])), " - ")})


def word_class_of(label: Column) -> Column:
    """The vocabulary class that a label's pages should show; empty for labels without."""
    return F.coalesce(F.create_map(*[F.lit(x) for k, v in LABELS.items() for x in (k, v[2])])[label], F.lit(""))


def feature_text(counts: Column, vocabulary: list[str]) -> Column:
    """Words that occur, each with its count and an underscore behind it."""
    names = F.array(*[F.lit(w) for w in vocabulary])
    some = F.filter(F.zip_with(names, counts, lambda w, n: F.struct(w.alias("w"), n.alias("n"))), lambda x: x["n"] > 0)
    return F.array_join(F.transform(some, lambda x: F.concat(x["w"], F.lit(":"), x["n"].cast("double").cast("string"), F.lit("_"))), "")


def detail_table(df: DataFrame, first: list[str], drop: tuple[str, ...] = ("html_text", "html_raw")) -> DataFrame:
    """A report's table: the named columns first, pages' sources left out."""
    rest = [c for c in df.columns if c not in first and c not in drop]
    return df.select(*[c for c in first if c in df.columns], *rest)


def config_table(spark, settings: dict[str, dict]) -> DataFrame:
    """(section, parameter, value), sorted within each section."""
    rows = [(s, k, str(v)) for s, d in settings.items() for k, v in sorted(d.items())]
    return spark.createDataFrame(rows, "section string, parameter string, value string")
