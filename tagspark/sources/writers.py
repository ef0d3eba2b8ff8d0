"""Sinks: parquet tables, JSON results, and reports as long rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; one file per partition, never a single task."""
    df.write.mode(mode).json(path)


def report_rows(section: str, df: DataFrame, key: str, metrics: list[str]) -> DataFrame:
    """A result table as ``(section, key, metric, value)`` rows."""
    pairs = [x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]
    return df.select(
        F.lit(section).alias("section"),
        F.col(key).cast("string").alias("key"),
        F.explode(F.create_map(*pairs)).alias("metric", "value"),
    )


def nested_report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
