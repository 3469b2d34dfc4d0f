"""From labelled samples to a model and its report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenweb.operators import labels, metrics, training
from lumenweb.plans.pipeline import with_text_features


@dataclass
class Report:
    """Tables of a training run; each is a DataFrame."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    model: PipelineModel | None = None

    def write(self, folder: str) -> None:
        for name, df in self.tables.items():
            df.write.mode("overwrite").json(f"{folder}/{name}")
        if self.model is not None:
            self.model.write().overwrite().save(f"{folder}/model")


def training_rows(samples: DataFrame, words: DataFrame) -> DataFrame:
    """Usable samples with text features and target."""
    rows = labels.usable(samples).withColumn("target", labels.target_of(F.col("target_label")))
    rows = with_text_features(rows.withColumn("clean_text", F.col("html_text")), words)
    return training.prepare(rows).withColumn("id", F.xxhash64("url"))


def run(samples: DataFrame, words: DataFrame, folds: int = training.FOLDS, settings: dict | None = None, ref_time: str = "", history: DataFrame | None = None) -> Report:
    """Agreement of labellers, cross-validated metrics, errors with suggestions, and a model of all rows."""
    report = Report({"summary_agreement": labels.agreement_summary(samples), "top_disagreement": labels.top_disagreements(samples), "labeller_view": labels.labeller_summary(samples), "log": labels.filter_log(samples)})
    rows = training_rows(samples, words).cache()
    predicted = training.cross_validate(rows, k=folds, settings=settings)
    told = metrics.binary(predicted, "target", "predicted_proba")
    record = metrics.history_record(told, ref_time)
    wrong = metrics.errors(predicted)
    attributes = F.aggregate("text_feat", F.lit(0), lambda a, x: a + x)
    report.tables |= {
        "performance": told, "history": metrics.append_history(history, record) if history is not None else record,
        "performance_by_group": metrics.by_language_and_tld(predicted), "error_analysis": metrics.detail_table(metrics.suggested_errors(wrong.withColumn("pred_ml_park", F.col("predicted") == 1), attributes), ["url", "target", "predicted", "suggested_error"], ("html_text", "html_raw", "features", "tokens")),
    }
    report.model = training.fit(rows, settings=settings)
    return report
