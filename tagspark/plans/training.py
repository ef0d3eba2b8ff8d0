"""Training run: split, fit state, fit one model per label, tune, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import duplicates, metrics, models, splits
from . import prepare

#: Rows of a merged partition of the feature table.
ROWS_A_PART = 10_000


@dataclass
class TrainedPipeline:
    state: prepare.FittedState
    models: models.LabelModels
    thresholds: dict[str, float]

    def save(self, path: str) -> None:
        self.state.save(f"{path}/state")
        self.models.save(f"{path}/models")
        spark = self.state.vocabulary.sparkSession
        spark.createDataFrame(list(self.thresholds.items()), "label string, threshold double").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/thresholds")

    @classmethod
    def load(cls, spark, path: str) -> "TrainedPipeline":
        rows = spark.read.parquet(f"{path}/thresholds").collect()
        return cls(prepare.FittedState.load(spark, f"{path}/state"), models.LabelModels.load(f"{path}/models"),
                   {r["label"]: r["threshold"] for r in rows})


def prepare_split(df: DataFrame, o: prepare.Options, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Deduplicate, add targets, and mark the test rows."""
    hashed = duplicates.with_hash(df, o.description, hash_column="_hash")
    unique = duplicates.keep_first(hashed, "_hash", o.key).drop("_hash")
    rows = prepare.with_targets(unique, o)
    return splits.stratified_split(rows, prepare.target_names(o.labels), o.key, test_size, seed)


def train(rows: DataFrame, o: prepare.Options, state_path: str, kind: str = "logistic", embedding: str | None = None,
          tune: bool = True, partitions: int | None = None, **params) -> TrainedPipeline:
    """``rows`` are training rows with targets; ``partitions`` merges those of the feature table, each of
    which gets no more than about ``ROWS_A_PART`` rows."""
    labels = prepare.target_names(o.labels)
    keep = labels + ([embedding] if embedding else [])
    base = prepare.stored_base(rows, o, keep)
    state = prepare.fit(base, o, state_path)
    data = models.cut_lineage(prepare.features_of_base(base, state, embedding).select(o.key, "features", *labels))
    if partitions is not None:
        data = data.coalesce(max(partitions, -(-data.count() // ROWS_A_PART)))
    fitted = models.fit_labels(data, labels, kind, materialise=False, together=True, **params)
    fitted.blocks = prepare.feature_blocks(state)
    thresholds = {}
    if tune:
        long = models.predictions(fitted, data, o.key)
        thresholds = {r["label"]: r["threshold"] for r in metrics.best_thresholds(long).collect()}
    return TrainedPipeline(state, fitted, thresholds)


def evaluate(pipeline: TrainedPipeline, rows: DataFrame, tuned: bool = False, embedding: str | None = None) -> DataFrame:
    """Confusion counts per label on rows with targets."""
    o = pipeline.state.options
    data = prepare.features(rows, pipeline.state, embedding)
    long = models.predictions(pipeline.models, data, o.key, pipeline.thresholds if tuned else None)
    return metrics.confusion(long)
