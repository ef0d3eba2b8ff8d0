"""The stateless chain on a stream of record files.

Feature expressions hold no state between rows, so the same functions run on a
streaming DataFrame. The fitted tables are static.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..plans import prepare
from ..sources.readers import RECORD_SCHEMA


def read_stream(spark: SparkSession, folder: str, schema: T.StructType = RECORD_SCHEMA, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).json(folder)


def base_feature_stream(rows: DataFrame, options: prepare.Options) -> DataFrame:
    """Row-wise features of arriving records."""
    return prepare.base_columns(rows, options).drop("_text")


def score_stream(rows: DataFrame, pipeline, output: str, checkpoint: str, available_now: bool = True):
    """Score each micro-batch with the batch code and append JSON results."""
    from ..plans.scoring import predict_with_labels

    def write(batch: DataFrame, epoch: int) -> None:
        # One folder per epoch: a batch that is repeated overwrites itself.
        predict_with_labels(pipeline, batch, check=False).write.mode("overwrite").json(f"{output}/epoch={epoch}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
