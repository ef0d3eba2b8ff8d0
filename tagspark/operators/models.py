"""One binary classifier per label on a shared feature vector.

Labels are independent, so their Spark ML fits are submitted from a few
threads at once; each fit is a distributed job over the same feature table,
which is written to the checkpoint folder first.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import cut_lineage
from . import logistic, metrics

MODEL_CLASSES = {
    "logistic": LogisticRegressionModel, "forest": RandomForestClassificationModel, "boosted": GBTClassificationModel,
}


@dataclass
class LabelModels:
    """Fitted models with the label order they were trained in."""

    kind: str
    labels: list[str]
    models: dict[str, object]
    features: str = "features"
    blocks: dict[str, tuple[int, int]] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, prefix: str = "proba_") -> DataFrame:
        """Add one probability column per label."""
        for i, label in enumerate(self.labels):
            # The column names carry the position: labels may hold spaces.
            model = self.models[label].copy()
            model = model.setFeaturesCol(self.features).setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setPredictionCol(f"_y{i}")
            df = model.transform(df).withColumn(prefix + label, vector_to_array(f"_p{i}")[1]).drop(f"_p{i}", f"_r{i}", f"_y{i}")
        return df

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        for i, label in enumerate(self.labels):
            self.models[label].write().overwrite().save(f"{path}/model_{i}")
        meta = {"kind": self.kind, "labels": self.labels, "features": self.features,
                "blocks": {k: list(v) for k, v in self.blocks.items()}, "names": self.names}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, path: str) -> "LabelModels":
        spark = SparkSession.active()
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        loader = MODEL_CLASSES[meta["kind"]]
        models = {label: loader.load(f"{path}/model_{i}") for i, label in enumerate(meta["labels"])}
        blocks = {k: tuple(v) for k, v in meta["blocks"].items()}
        return cls(meta["kind"], meta["labels"], models, meta["features"], blocks, meta["names"])


def assemble(df: DataFrame, blocks: list[str], output: str = "features") -> DataFrame:
    """Concatenate vector and number columns in the given order."""
    return VectorAssembler(inputCols=blocks, outputCol=output, handleInvalid="error").transform(df)


def balanced_weight(label: str, n: int, n_pos: int) -> Column:
    """``n / (2 n_class)`` for the class of the row."""
    n_neg = n - n_pos
    return F.when(F.col(label) == 1, F.lit(n / (2.0 * n_pos) if n_pos else 0.0)).otherwise(F.lit(n / (2.0 * n_neg) if n_neg else 0.0))


def class_sizes(df: DataFrame, labels: list[str]) -> dict[str, tuple[int, int]]:
    """Rows and positives per label: one aggregate row on the driver."""
    row = df.agg(F.count("*").alias("_n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in labels]).first()
    return {c: (row["_n"], row[c] or 0) for c in labels}


def _estimator(kind: str, params: dict, total_weight: float, features: str, label: str):
    common = {"featuresCol": features, "labelCol": label, "weightCol": "_w"}
    if kind == "logistic":
        # The summed loss is scaled by C there, the mean loss by 1 here.
        c, l1 = params.get("C", 2.0), params.get("l1_ratio", 0.0)
        return LogisticRegression(regParam=1.0 / (c * total_weight), elasticNetParam=l1, standardization=False,
                                  maxIter=params.get("max_iter", 100), tol=params.get("tol", 1e-5),
                                  family="binomial", **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=params.get("trees", 100), maxDepth=params.get("depth", 5),
                                      featureSubsetStrategy="sqrt", minInstancesPerNode=params.get("min_leaf", 5),
                                      seed=params.get("seed", 42), **common)
    if kind == "boosted":
        return GBTClassifier(maxIter=params.get("trees", 100), maxDepth=params.get("depth", 5),
                             stepSize=params.get("rate", 0.1), seed=params.get("seed", 42), **common)
    raise ValueError(f"unknown model kind {kind}")


def released(model):
    """The model without its training summary, which holds the session and with it
    whatever the session observes; that does not go to executors."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def fit_labels(df: DataFrame, labels: list[str], kind: str = "logistic", features: str = "features", balanced: bool = True,
               parallelism: int = 4, materialise: bool = True, partitions: int | None = None, together: bool = False, **params) -> LabelModels:
    """One classifier per 0/1 label column. A label with a single class gets a
    model too, its probability being constant. ``partitions`` merges the table's
    partitions; without it they stay as they are. ``together`` fits logistic models
    with an L2 penalty side by side, one pass over the table an iteration for all."""
    data = df.select(features, *labels)
    if materialise:
        data = cut_lineage(data)
    if partitions is not None:
        data = data.coalesce(partitions)
    sizes = class_sizes(data, labels)

    def fit(label: str):
        n, pos = sizes[label]
        weight = balanced_weight(label, n, pos) if balanced else F.lit(1.0)
        both = balanced and 0 < pos < n
        total = float(n) if both or not balanced else n / 2.0
        rows = data.select(features, F.col(label).cast("double").alias("_label"), weight.alias("_w"))
        return released(_estimator(kind, params, total, features, "_label").fit(rows))

    shared = [c for c in labels if 0 < sizes[c][1] < sizes[c][0]] if together and kind == "logistic" and not params.get("l1_ratio") else []
    options = {k: params[k] for k in ("C", "max_iter", "tol") if k in params}
    fitted = logistic.fit(data, shared, sizes, balanced, features, **options) if shared else {}
    alone = [c for c in labels if c not in fitted]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(alone)))) as pool:
        fitted.update(zip(alone, pool.map(inheritable_thread_target(data.sparkSession)(fit), alone)))
    return LabelModels(kind, list(labels), {c: fitted[c] for c in labels}, features)


def predictions(models: LabelModels, df: DataFrame, row_id: str, thresholds: dict[str, float] | None = None,
                keep: list[str] = ()) -> DataFrame:
    """Long ``(row_id, label, y, p, pred)``; without thresholds 0.5 is used."""
    scored = models.transform(df)
    long = metrics.long_predictions(scored, row_id, {c: c for c in models.labels}, {c: f"proba_{c}" for c in models.labels}, keep)
    if thresholds:
        cut = F.lit(0.5)
        for label, t in thresholds.items():
            cut = F.when(F.col("label") == label, F.lit(t)).otherwise(cut)
        return metrics.predict(long, cut)
    return metrics.predict(long, 0.5, strict=True)


#: Parameter points of the search: L2 and elastic net, with and without weights.
GRID = [
    {"C": c, "l1_ratio": 0.0, "balanced": b} for c in (0.1, 0.5, 1.0, 2.0) for b in (False, True)
] + [
    {"C": c, "l1_ratio": l1, "balanced": b} for l1 in (0.1, 0.5) for c in (0.1, 0.5, 1.0) for b in (False, True)
]


#: Rows of a part of the searched table. An iteration is a job of its own, and with
#: smaller parts starting its tasks takes longer than what they compute.
ROWS_A_PART = 100_000


def dealt(df: DataFrame, rows_a_part: int) -> DataFrame:
    """``df`` in even parts of at most about ``rows_a_part`` rows."""
    parts = -(-df.count() // rows_a_part)
    return df.repartition(parts) if parts > 1 else df.coalesce(1)


def grid_search(df: DataFrame, labels: list[str], row_id: str, fold: str = "fold", grid: list[dict] | None = None,
                kind: str = "logistic", features: str = "features", parallelism: int = 4, partitions: int | None = None,
                most_folds: int = 100, prepare=None, **params) -> DataFrame:
    """Macro-F1 per parameter point and fold, train and held-out.

    ``prepare(train)`` may return a function that turns rows into feature rows; it
    is called once per fold with the training side only. A fold column with more
    than ``most_folds`` values is an error. ``partitions`` merges the table's
    partitions; without it they are dealt anew, with up to ``ROWS_A_PART`` rows each.

    The multi-label score of a point needs all its labels, so points and folds
    are independent units; they are submitted from a small thread pool while
    every fit runs distributed.
    """
    grid = GRID if grid is None else grid
    data = cut_lineage(df if prepare else df.select(row_id, features, fold, *labels))
    data = data.coalesce(partitions) if partitions is not None else dealt(data, ROWS_A_PART)
    folds = sorted(r[0] for r in data.select(fold).distinct().limit(most_folds + 1).collect())
    if len(folds) > most_folds:
        raise ValueError(f"{fold} has more than {most_folds} values")
    sides = {}
    for held_out in folds:
        apply = prepare(data.where(F.col(fold) != held_out)) if prepare else None
        sides[held_out] = cut_lineage(apply(data).select(row_id, features, fold, *labels)) if apply else data

    def run(job: tuple[int, int]) -> tuple:
        index, held_out = job
        point = dict(grid[index])
        balanced = point.pop("balanced", True)
        data = sides[held_out]
        train = data.where(F.col(fold) != held_out)
        fitted = fit_labels(train, labels, kind, features, balanced, parallelism=1, materialise=False, **{**params, **point})
        scored = predictions(fitted, data, row_id, keep=[fold])
        marked = scored.withColumn("label", F.concat(F.when(F.col(fold) == held_out, "test:").otherwise("train:"), "label"))
        side = F.split_part("label", F.lit(":"), F.lit(1))
        f1 = metrics.per_label(metrics.confusion(marked)).groupBy(side.alias("side")).agg(F.avg("f1").alias("f1"))
        scores = {r["side"]: r["f1"] for r in f1.collect()}
        return (index, point.get("C"), point.get("l1_ratio"), balanced, int(held_out), scores.get("train"), scores.get("test"))

    jobs = [(i, f) for i in range(len(grid)) for f in folds]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(data.sparkSession)(run), jobs))
    schema = "point int, c double, l1_ratio double, balanced boolean, fold int, train_macro_f1 double, test_macro_f1 double"
    return data.sparkSession.createDataFrame(rows, schema)


def search_summary(results: DataFrame) -> DataFrame:
    """Mean scores per point, best held-out score first."""
    means = results.groupBy("point", "c", "l1_ratio", "balanced").agg(
        F.avg("train_macro_f1").alias("train_macro_f1"), F.avg("test_macro_f1").alias("test_macro_f1"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("test_macro_f1"), "point")
    return means.withColumn("rank", F.row_number().over(order))


def coefficient_table(models: LabelModels) -> DataFrame:
    """``(label, position, feature, block, coefficient)`` of logistic models."""
    spark = SparkSession.active()
    rows = []
    for label in models.labels:
        for i, v in enumerate(models.models[label].coefficients.toArray()):
            block = next((b for b, (lo, hi) in models.blocks.items() if lo <= i < hi), "all")
            rows.append((label, i, models.names[i] if models.names else str(i), block, float(v)))
    return spark.createDataFrame(rows, "label string, position int, feature string, block string, coefficient double")


def block_norms(coefficients: DataFrame) -> DataFrame:
    """Mean over features of the coefficient norm across labels, per block."""
    square = F.sum(F.col("coefficient") * F.col("coefficient"))
    per = coefficients.groupBy("block", "position").agg(F.sqrt(square).alias("norm"))
    return per.groupBy("block").agg(F.count("*").alias("features"), F.avg("norm").alias("mean_norm"))


def top_coefficients(coefficients: DataFrame, block: str = "dense", per_label: int = 10) -> DataFrame:
    rows = coefficients.where(F.col("block") == block)
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc(F.abs("coefficient")), "feature"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= per_label).select("label", "rank", "feature", "coefficient")


def top_mean_coefficients(coefficients: DataFrame, block: str = "dense", n: int = 15) -> DataFrame:
    means = coefficients.where(F.col("block") == block).groupBy("feature").agg(F.avg(F.abs("coefficient")).alias("mean_abs"))
    return means.orderBy(F.desc("mean_abs"), "feature").limit(n)
