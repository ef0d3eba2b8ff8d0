"""Duplicates in a stream: keyed state with a time limit.

A row belongs to the tumbling window of its time. Groups are the rows of one
hash in one window, and all state is one partial aggregate per open group, so a
hash that a third of all rows share is combined before it is shuffled. A window
closes when the watermark, the latest time seen less ``delay``, has passed its
end; its state goes then, and rows that come later still are dropped. On rows
that arrive within the delay a stream gives what the same call gives on a
static table for the windows that have closed, however the rows are cut into
batches and however often the query is restarted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _windowed(rows: DataFrame, time: str, within: str, delay: str) -> tuple[DataFrame, Column]:
    return rows.where(F.col(time).isNotNull()).withWatermark(time, delay), F.window(time, within)


def keep_first(rows: DataFrame, hash_column: str, row_id: str, time: str, within: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """One row of every hash and window: the earliest, of those the one with the smallest id (NULL last).

    All columns are kept. A NULL hash is a hash like any other; rows without a
    time belong to no window and are dropped.
    """
    timed, window = _windowed(rows, time, within, delay)
    order = F.struct(F.col(time), F.col(row_id).isNull(), F.col(row_id), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), order).alias("row")
    return timed.groupBy(window, hash_column).agg(first).select("row.*")


def duplicate_groups(rows: DataFrame, hash_column: str, row_id: str, time: str, within: str = "1 hour", delay: str = "10 minutes",
                     min_group_size: int = 2) -> DataFrame:
    """``start, hash, count, first_id``: the groups of at least ``min_group_size`` rows of every window."""
    timed, window = _windowed(rows, time, within, delay)
    groups = timed.groupBy(window.alias("window"), F.col(hash_column).alias("hash")).agg(F.count("*").alias("count"), F.min(row_id).alias("first_id"))
    return groups.where(F.col("count") >= min_group_size).select(F.col("window.start").alias("start"), "hash", "count", "first_id")


def drop_repeats(rows: DataFrame, hash_column: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Rows as they arrive, without those whose hash was seen up to ``delay`` before.

    The first to arrive passes at once; which one that is depends on the arrival.
    A hash is forgotten once the watermark has passed its first row by ``delay``.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([hash_column])


def append_parquet(rows: DataFrame, output: str, checkpoint: str):
    """Everything that is there now, appended to ``output``; a later call goes on behind it."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", output).trigger(availableNow=True).start()
