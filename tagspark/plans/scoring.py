"""Batch scoring: fitted pipeline, predictions, decoded labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def decode(df: DataFrame, key: str, labels: list[str], predictions: list[str]) -> DataFrame:
    """``(key, predicted_tags, num_tags)`` from 0/1 prediction columns, which
    are in the order of ``labels``."""
    hits = F.array_compact(F.array(*[F.when(F.col(p) == 1, F.lit(t)) for t, p in zip(labels, predictions)]))
    return df.select(key, hits.alias("predicted_tags")).withColumn("num_tags", F.size("predicted_tags"))


def sample_key(df: DataFrame, column: str = "src_uid") -> Column:
    """The record key, or one made from the content of the record where there is
    none: the same in every attempt, equal for equal records."""
    content = [c for c, kind in df.dtypes if "map<" not in kind]
    made = F.concat(F.lit("sample_"), F.lower(F.hex(F.xxhash64(*content))))
    return F.coalesce(F.col(column), made) if column in df.columns else made


def probabilities(pipeline, df: DataFrame, embedding: str | None = None, check: bool = True) -> DataFrame:
    """Key and one probability column per label, in the trained order; one row per input row.

    ``check`` raises for an input without text; single blank rows are scored."""
    from . import prepare

    o = pipeline.state.options
    if check:
        prepare.check_input(df, o)
    df = df.withColumn(o.key, sample_key(df, o.key))
    scored = pipeline.models.transform(prepare.features(df, pipeline.state, embedding).select(o.key, "features"))
    return scored.select(o.key, *[f"proba_{c}" for c in pipeline.models.labels])


def predict(pipeline, df: DataFrame, embedding: str | None = None, tuned: bool = False, check: bool = True) -> DataFrame:
    """Key and one 0/1 column per label."""
    p = probabilities(pipeline, df, embedding, check)
    key = pipeline.state.options.key
    out = []
    for c in pipeline.models.labels:
        t = pipeline.thresholds.get(c) if tuned else None
        hit = F.col(f"proba_{c}") >= t if t is not None else F.col(f"proba_{c}") > 0.5
        out.append(hit.cast("int").alias(f"pred_{c}"))
    return p.select(key, *out)


def predict_with_labels(pipeline, df: DataFrame, embedding: str | None = None, tuned: bool = False, check: bool = True) -> DataFrame:
    """``(key, predicted_tags, num_tags)``. Names come from the label order
    stored with the models, never from a list given here."""
    o = pipeline.state.options
    names = {f"target_{t.replace(' ', '_')}": t for t in o.labels}
    columns = [f"pred_{c}" for c in pipeline.models.labels]
    return decode(predict(pipeline, df, embedding, tuned, check), o.key, [names.get(c, c) for c in pipeline.models.labels], columns)
