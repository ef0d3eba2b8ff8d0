"""Multi-label evaluation on long predictions ``(row id, label, y, p)``.

Everything derives from one grouped confusion count, a handful of rows per
label, however many predictions there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .profile import long_rows

#: Thresholds tried per label: 0.10, 0.15, ... 0.85.
THRESHOLDS = [0.1 + 0.05 * i for i in range(16)]


def long_predictions(df: DataFrame, row_id: str, truth: dict[str, str], score: dict[str, str],
                     keep: list[str] = ()) -> DataFrame:
    """Wide label and score columns to ``(row_id, label, y, p)``."""
    entries = F.array(*[
        F.struct(F.lit(k).alias("label"), F.col(truth[k]).cast("int").alias("y"), F.col(score[k]).cast("double").alias("p")) for k in truth])
    return df.select(row_id, *keep, F.explode(entries).alias("e")).select(row_id, *keep, "e.*")


def predict(df: DataFrame, threshold: float | Column = 0.5, strict: bool = False) -> DataFrame:
    t = F.lit(threshold) if isinstance(threshold, float) else threshold
    hit = F.col("p") > t if strict else F.col("p") >= t
    return df.withColumn("pred", hit.cast("int"))


def confusion(df: DataFrame) -> DataFrame:
    y, q = F.col("y") == 1, F.col("pred") == 1
    return df.groupBy("label").agg(
        F.count_if(y & q).alias("tp"), F.count_if(~y & q).alias("fp"),
        F.count_if(y & ~q).alias("fn"), F.count_if(~y & ~q).alias("tn"))


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def per_label(conf: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return conf.select(
        "label", _f1(tp, fp, fn).alias("f1"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), (tp + fn).alias("support"))


def overall(conf: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.sum(c) for c in ("tp", "fp", "fn", "tn"))
    return conf.agg(
        _f1(tp, fp, fn).alias("micro_f1"),
        F.avg(_f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("macro_f1"),
        ratio(tp, tp + fp).alias("micro_precision"), ratio(tp, tp + fn).alias("micro_recall"),
        ratio(fp + fn, tp + fp + fn + tn).alias("hamming_loss"))


METRICS = ["micro_f1", "macro_f1", "micro_precision", "micro_recall", "hamming_loss"]


def compare_labels(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per-label scores of two runs side by side with the gain in F1."""
    b = before.select("label", *[F.col(c).alias(f"{c}_before") for c in ("f1", "precision", "recall")], "support")
    a = after.select("label", *[F.col(c).alias(f"{c}_after") for c in ("f1", "precision", "recall")])
    return b.join(a, "label").withColumn("gain_f1", F.col("f1_after") - F.col("f1_before"))


def compare_overall(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(metric, before, after, gain, gain_pct)``."""

    def melted(df: DataFrame, name: str) -> DataFrame:
        return df.unpivot([], METRICS, "metric", name)

    joined = melted(before, "before").join(melted(after, "after"), "metric")
    gain = F.col("after") - F.col("before")
    return joined.select("*", gain.alias("gain"), F.try_divide(gain * 100.0, F.col("before")).alias("gain_pct"))


def sample_scores(df: DataFrame, row_id: str) -> DataFrame:
    """Subset accuracy and sample-averaged Jaccard (0 for two empty sets)."""
    y, q = F.col("y") == 1, F.col("pred") == 1
    docs = df.groupBy(row_id).agg(
        F.count_if(y & q).alias("both"), F.count_if(y | q).alias("either"), F.count_if(y != q).alias("wrong"))
    return docs.agg(F.avg((F.col("wrong") == 0).cast("double")).alias("subset_accuracy"),
                    F.avg(ratio(F.col("both"), F.col("either"))).alias("jaccard"))


def compare_models(runs: dict[str, DataFrame]) -> DataFrame:
    """Overall scores of several models, best macro-F1 first."""
    rows = [df.withColumn("model", F.lit(name)) for name, df in runs.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("macro_f1"), "model")


def class_weights(df: DataFrame, labels: list[str]) -> DataFrame:
    """Balanced weights ``n / (2 n_class)`` of both classes of each label."""
    n = F.count("*")

    def side(c: str, value: int) -> Column:
        return F.try_divide(n.cast("double"), 2 * F.count_if(F.col(c) == value))

    return long_rows([(c, {"weight_0": side(c, 0), "weight_1": side(c, 1)}) for c in labels], "label", df)


def threshold_scores(df: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """F1 per label and threshold.

    Each prediction is counted once, under the number of thresholds it
    reaches; cumulating those few counts gives every confusion table.
    """
    reached = sum((F.col("p") >= t).cast("int") for t in thresholds)
    counts = df.groupBy("label", reached.alias("k")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    totals = counts.groupBy("label").agg(F.sum("pos").alias("all_pos"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    per = counts.select("*", F.explode(steps).alias("s")).groupBy("label", F.col("s.i").alias("i"), F.col("s.threshold").alias("threshold")).agg(
        F.sum(F.when(F.col("k") > F.col("s.i"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("k") > F.col("s.i"), F.col("neg")).otherwise(0)).alias("fp"))
    return per.join(totals, "label").select(
        "label", "threshold", _f1(F.col("tp"), F.col("fp"), F.col("all_pos") - F.col("tp")).alias("f1"))


def best_thresholds(df: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """Per label the lowest threshold with the best F1; 0.5 if F1 stays 0."""
    scores = threshold_scores(df, thresholds)
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("t")))
    return scores.groupBy("label").agg(best.alias("b")).select(
        "label", F.when(F.col("b.f1") > 0, -F.col("b.t")).otherwise(F.lit(0.5)).alias("threshold"), F.col("b.f1").alias("f1"))


def predict_with(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Apply a threshold per label; the table has one row per label."""
    joined = df.join(F.broadcast(thresholds.select("label", "threshold")), "label")
    return predict(joined, F.col("threshold")).drop("threshold")


def rank_labels(scores: DataFrame, by: str = "f1") -> DataFrame:
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round(by, 9)), "label")
    return scores.withColumn("rank", F.row_number().over(order))
