"""The page classifier: folds, fitting, grids, importance, and the neighbours of pages that it gets wrong."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenweb.operators.common import small
from lumenweb.operators.metrics import binary
from lumenweb.operators.ranks import with_positions_within
from lumenweb.sources.scratch import written

# Settings of the two classifiers, and the grid.
BINARY = {"stepSize": 0.5, "maxIter": 25, "maxDepth": 9, "minInstancesPerNode": 2}
CLASSES = {"numTrees": 10, "maxDepth": 5}
GRID = {"stepSize": [0.03, 0.1, 0.3, 0.5], "maxIter": [10, 25, 50, 75, 100, 150, 200], "maxDepth": [5, 7, 9, 11], "minInstancesPerNode": [1, 2]}
FOLDS = 20
NUMBERS = ["n_sentences", "n_words", "n_pair_same", "n_pair_successive", "min_sent_size_same", "min_sent_size_successive"]


def with_folds(df: DataFrame, target: str = "target", order: str = "id", k: int = FOLDS) -> DataFrame:
    """fold: each class dealt to k folds of sizes at most one apart, by runs of the order. Ranks are taken within buckets of a class, so a class of any size is many tasks."""
    bucket = F.pmod(F.xxhash64(order), F.lit(512)).cast("int")
    rows = df.withColumn("_b", bucket)
    sizes = rows.groupBy(target, "_b").count()
    below = F.coalesce(F.sum("count").over(Window.partitionBy(target).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(target, "_b", below.alias("_below"), F.sum("count").over(Window.partitionBy(target)).alias("_n"))
    place = F.row_number().over(Window.partitionBy(target, "_b").orderBy(order)) - 1
    ranked = rows.withColumn("_place", place).join(small(sizes), [target, "_b"])
    return ranked.withColumn("fold", F.floor((F.col("_below") + F.col("_place")) * k / F.col("_n")).cast("int")).drop("_b", "_place", "_below", "_n")


def ordered_folds(df: DataFrame, target: str = "target", order: str = "id", k: int = FOLDS) -> DataFrame:
    """fold as an unshuffled stratified split has it: the members of a class in order, in k runs, the first ones longer by one."""
    placed = with_positions_within(df, target, [order], "_place")
    sizes = small(df.groupBy(target).agg(F.count("*").alias("_n")).withColumnRenamed(target, "_class"))
    n, at = F.col("_n"), F.col("_place")
    short, longer = F.floor(n / k), n % k
    fold = F.when(at < longer * (short + 1), F.floor(at / (short + 1))).otherwise(longer + F.floor((at - longer * (short + 1)) / F.greatest(short, F.lit(1))))
    return placed.join(sizes, F.col(target).eqNullSafe(F.col("_class"))).withColumn("fold", fold.cast("int")).drop("_place", "_n", "_class")


def split(df: DataFrame, test_share: float, seed: int = 123, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(train, test): by a hash of the key, the same rows in every run."""
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000))
    cut = int(test_share * 1_000_000)
    return df.where(at >= cut), df.where(at < cut)


def prepare(df: DataFrame, counts: str = "text_feat") -> DataFrame:
    """df with the vector features: vocabulary counts, then the six numbers."""
    return VectorAssembler(inputCols=["_counts", *NUMBERS], outputCol="features").transform(df.withColumn("_counts", array_to_vector(F.col(counts).cast("array<double>")))).drop("_counts")


def weighted(df: DataFrame, target: str = "target") -> DataFrame:
    """weight: negative over positive rows for a positive one, 1 for others."""
    n, pos = df.agg(F.count("*"), F.coalesce(F.sum(target), F.lit(0))).first()
    return df.withColumn("weight", F.when(F.col(target) == 1, F.lit(float(n - pos) / pos if pos else 1.0)).otherwise(1.0))


def fit(df: DataFrame, target: str = "target", settings: dict | None = None, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees on features, classes weighed."""
    model = GBTClassifier(labelCol=target, featuresCol="features", weightCol="weight", seed=seed, **(BINARY | (settings or {})))
    return Pipeline(stages=[model]).fit(weighted(df, target))


def fit_classes(df: DataFrame, target: str = "target", settings: dict | None = None, seed: int = 42) -> PipelineModel:
    return Pipeline(stages=[RandomForestClassifier(labelCol=target, featuresCol="features", seed=seed, **(CLASSES | (settings or {})))]).fit(df)


def fit_sparse(df: DataFrame, target: str = "target", strength: float = 0.01) -> PipelineModel:
    """L1 logistic regression."""
    return Pipeline(stages=[LogisticRegression(labelCol=target, featuresCol="features", elasticNetParam=1.0, regParam=strength)]).fit(df)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """df with predicted_proba, and predicted: 1 from one half on."""
    out = model.transform(df).withColumn("predicted_proba", vector_to_array("probability")[1])
    return out.withColumn("predicted", (F.col("predicted_proba") >= 0.5).cast("int")).drop("rawPrediction", "probability", "prediction")


def cross_validate(df: DataFrame, target: str = "target", k: int = FOLDS, settings: dict | None = None, order: str = "id") -> DataFrame:
    """Predictions for every row, by a model that didn't see its fold."""
    folded = written(with_folds(df, target, order, k), "folds")
    out = None
    for i in range(k):
        part = predict(fit(folded.where(F.col("fold") != i), target, settings), folded.where(F.col("fold") == i))
        out = part if out is None else out.unionByName(part)
    return out


def scenarios(grid: dict) -> list[dict]:
    """All combinations of a grid whose values are lists or single ones."""
    lists = {k: v if isinstance(v, list) else [v] for k, v in grid.items()}
    return [dict(zip(lists, values, strict=True)) for values in itertools.product(*lists.values())]


def grid_search(df: DataFrame, grid: dict, target: str = "target", k: int = 5, order: str = "id") -> DataFrame:
    """A row of settings and metrics for each scenario, best first."""
    rows = []
    for s in scenarios(grid):
        m = binary(cross_validate(df, target, k, s, order), target, "predicted_proba").first()
        rows.append((str(s), float(m["accuracy"]), float(m["precision"]), float(m["recall"]), float(m["f1"])))
    return df.sparkSession.createDataFrame(rows, "settings string, accuracy double, precision double, recall double, f1 double").orderBy(F.desc("accuracy"), "settings")


def importance(model: PipelineModel, names: list[str], spark, top: int = 10) -> DataFrame:
    """(feature, importance): the most and the least important ones."""
    ranked = sorted(zip(names, model.stages[-1].featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))
    chosen = ranked if len(ranked) <= 2 * top else ranked[:top] + ranked[-top:]
    return spark.createDataFrame([(n, float(v)) for n, v in chosen], "feature string, importance double")


def permutation_importance(model: PipelineModel, df: DataFrame, names: list[str], target: str = "target", seed: int = 1) -> DataFrame:
    """(feature, drop): what accuracy loses if a feature's values are exchanged between rows (by a shift in a hash order within blocks)."""
    base = binary(predict(model, df), target, "predicted_proba").first()["accuracy"]
    rows = []
    for i, name in enumerate(names):
        w = Window.partitionBy(F.pmod(F.xxhash64(F.lit(seed), "features"), F.lit(64))).orderBy(F.xxhash64(F.lit(i), "features"))
        a = vector_to_array("features")
        other = F.coalesce(F.lead(a[i]).over(w), a[i])
        mixed = df.withColumn("_v", other).withColumn("features", array_to_vector(F.transform(a, lambda x, j: F.when(j == i, F.col("_v")).otherwise(x))))
        rows.append((name, float(base - binary(predict(model, mixed), target, "predicted_proba").first()["accuracy"])))
    return df.sparkSession.createDataFrame(rows, "feature string, drop double").orderBy(F.desc("drop"), "feature")


def distance(a: Column, b: Column, counts: str = "text_feat") -> Column:
    """L1 over word counts and pairs, a hundred words and five sentences counting as one."""
    words = F.aggregate(F.zip_with(a[counts], b[counts], lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    part = lambda k, unit: F.abs(a[k] - b[k]) / unit
    return words + part("n_pair_same", 1) + part("n_pair_successive", 1) + part("n_words", 100) + part("n_sentences", 5)


def nearest_right(df: DataFrame, key: str = "url", actual: str = "actual", predicted: str = "predicted", counts: str = "text_feat", band: int = 20_000) -> DataFrame:
    """(url, url_close, dist): for each wrong prediction the nearest row of the class that was predicted; ties by url. Exact.

    The sum of a row's coordinates differs between two rows by their distance at most, so rows are cut in bands of that
    sum (about ``band`` rows each, a fuller one in slices). A wrong row is compared with its own band first, and then with
    those bands only that what it found there doesn't rule out. Bands and wrong rows meet by a shuffle; a task holds one
    slice.
    """
    unit = {"n_pair_same": 1.0, "n_pair_successive": 1.0, "n_words": 100.0, "n_sentences": 5.0}
    x = F.concat(F.col(counts).cast("array<double>"), F.array(*[F.col(k).cast("double") / v for k, v in unit.items()]))
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(actual).cast("int").alias("a"), F.col(predicted).cast("int").alias("p"), x.alias("x"))
    rows = written(rows.withColumn("s", F.aggregate("x", F.lit(0.0), lambda t, v: t + v)), "nearest-rows")
    n = rows.count()
    some = max(1, -(-n // band))
    cuts = sorted(set(rows.approxQuantile("s", [i / some for i in range(1, some)], 0.1 / some))) if some > 1 else []
    number = F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<double>"), lambda c: c <= F.col("s")))
    sizes = {r["b"]: r for r in rows.groupBy(number.alias("b")).agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).collect()}  # a row for each band
    bands = sorted(sizes)
    slices = {b: -(-sizes[b]["n"] // (2 * band)) for b in bands}
    low, high = (np.array([sizes[b][c] for b in bands]) for c in ("low", "high"))
    schema = "b int, slice int, kind int, k string, a int, x array<double>, s double, known double"

    def ask(own: bool):
        def run(batches):
            for pdf in batches:
                out = []
                for k, a, v, s, b, known in pdf.itertuples(index=False, name=None):
                    near = [b] if own else [bands[i] for i in np.flatnonzero((low <= s + known) & (high >= s - known)) if bands[i] != b]
                    out += [(c, i, 1, k, a, v, s, known) for c in near for i in range(slices[c])]
                yield pd.DataFrame(out, columns=["b", "slice", "kind", "k", "a", "x", "s", "known"])

        return run

    def search(batches):
        now, held, index = None, [], None
        for pdf in batches:
            for (b, i, kind), part in pdf.groupby(["b", "slice", "kind"], sort=True):
                if (b, i) != now:
                    now, held, index = (b, i), [], None
                if kind == 0:
                    held.append(part)
                    continue
                if index is None:
                    all_ = pd.concat(held).sort_values("k") if held else part.iloc[:0]
                    index = all_["k"].to_numpy(), all_["a"].to_numpy(), np.array(all_["x"].tolist(), float).reshape(len(all_), -1)
                keys, classes, vectors = index
                found = []
                for k, a, v, known in zip(part["k"], part["a"], part["x"], part["known"], strict=True):
                    at = np.flatnonzero(classes != a)
                    if len(at):
                        d = np.abs(vectors[at] - np.array(v, float)).sum(1)
                        j = int(d.argmin())  # keys are in order, so the first of equals has the smallest one
                        if d[j] <= known:
                            found.append((k, keys[at[j]], float(d[j])))
                if found:
                    yield pd.DataFrame(found, columns=["url", "url_close", "dist"])

    placed = rows.withColumn("b", number)
    slice_ = F.pmod(F.xxhash64("k"), F.element_at(F.create_map(*[F.lit(v) for kv in slices.items() for v in kv]), F.col("b"))) if bands else F.lit(0)
    kept = placed.select("b", slice_.cast("int").alias("slice"), F.lit(0).alias("kind"), "k", "a", "x", "s", F.lit(0.0).alias("known"))
    wrong = placed.where("a <> p").select("k", "a", "x", "s", "b")

    def searched(asked: DataFrame, own: bool) -> DataFrame:
        both = kept.union(asked.select("k", "a", "x", "s", "b", "known").mapInPandas(ask(own), schema))
        return both.repartition("b", "slice").sortWithinPartitions("b", "slice", "kind").mapInPandas(search, "url string, url_close string, dist double")

    best = lambda f: f.groupBy("url").agg(F.min(F.struct("dist", "url_close")).alias("m")).select("url", "m.url_close", "m.dist")
    found = searched(wrong.withColumn("known", F.lit(float("inf"))), True)
    if len(bands) > 1:
        found = written(best(found), "nearest-own").select("url", "url_close", "dist")
        rest = wrong.join(found.select(F.col("url").alias("k"), F.col("dist").alias("known")), "k", "left").fillna(float("inf"), ["known"])
        found = found.union(searched(rest, False))
    return best(found)


def error_analysis(df: DataFrame, key: str = "url", actual: str = "actual", predicted: str = "predicted", carry: tuple[str, ...] = ("language", "n_words", "n_sentences")) -> DataFrame:
    """Wrong predictions beside the nearest row that is otherwise, nearest first."""
    near = small(nearest_right(df, key, actual, predicted))
    here = df.select(F.col(key).cast("string").alias("url"), F.col(actual).alias("actual"), *carry)
    there = df.select(F.col(key).cast("string").alias("url_close"), F.col(actual).alias("actual_close"), *[F.col(c).alias(f"{c}_close") for c in carry])
    return here.join(near, "url").join(there, "url_close").orderBy("dist", "url")
