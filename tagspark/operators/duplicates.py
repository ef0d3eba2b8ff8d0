"""Duplicate groups by the hash of the normal form.

A hash may be shared by a large part of the rows (every blank text has the
same one), so groups are only ever counted; members stay one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import duplicate_form, truncate_chars
from .joins import balanced_join


def with_hash(df: DataFrame, column: str, inline_math: bool = True, ignore_blank: bool = False,
              hash_column: str | None = None, row_id: str | None = None) -> DataFrame:
    """Add ``{column}_hash``. With ``ignore_blank`` texts without letters are
    unique instead of equal to each other."""
    form = duplicate_form(F.col(column), inline_math)
    h = F.md5(form)
    if ignore_blank:
        if row_id is None:
            raise ValueError("ignore_blank needs the row id")
        h = F.when(form == "", F.concat(F.lit("blank-"), F.col(row_id).cast("string"))).otherwise(h)
    return df.withColumn(hash_column or f"{column}_hash", h)


def duplicate_groups(df: DataFrame, hash_column: str, row_id: str, min_group_size: int = 2,
                     tags: str | None = "tags") -> DataFrame:
    """One row per group: ``hash, count, first_id, tags_variety``.

    Tag sets are counted per (hash, set) first, so a large group is already
    small when its sets are counted.
    """
    variety = F.array_join(F.array_sort(tags), "|") if tags else F.lit("")
    parts = df.groupBy(F.col(hash_column).alias("hash"), variety.alias("set")).agg(
        F.count("*").alias("n"), F.min(row_id).alias("first"))
    groups = parts.groupBy("hash").agg(
        F.sum("n").alias("count"), F.min("first").alias("first_id"), F.count("*").alias("tags_variety"))
    groups = groups.where(F.col("count") >= min_group_size)
    return groups if tags else groups.drop("tags_variety")


def duplicate_members(df: DataFrame, groups: DataFrame, hash_column: str, row_id: str) -> DataFrame:
    """All members of all groups, one row each."""
    rows = df.select(F.col(hash_column).alias("hash"), row_id)
    return balanced_join(rows, groups.select("hash", "count"), "hash", row_id, "inner")


def duplicate_summary(df: DataFrame, hash_column: str, min_group_size: int = 2) -> DataFrame:
    counts = df.groupBy(hash_column).agg(F.count("*").alias("n"))
    dup = F.col("n") >= min_group_size
    return counts.agg(
        F.sum("n").alias("total"), F.count("*").alias("distinct_texts"), F.count_if(dup).alias("groups"),
        F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).alias("rows_in_groups"))


def keep_first(df: DataFrame, hash_column: str, row_id: str) -> DataFrame:
    """One row of every hash: that with the smallest id; singles are kept.

    NULL ids come last, rows with equal ids in the order of their content. Every
    task keeps one row of a hash before anything is shuffled.
    """
    order = Window.partitionBy(hash_column).orderBy(F.col(row_id).asc_nulls_last(), F.xxhash64(*df.columns))
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def remove_duplicate_rows(df: DataFrame, group_column: str = "duplicate_group", row_id: str = "p_id") -> DataFrame:
    """Rows marked -1 are unique; of each other group the first is kept."""
    if group_column not in df.columns:
        return df
    unique = df.where(F.col(group_column) == -1)
    return unique.unionByName(keep_first(df.where(F.col(group_column) != -1), group_column, row_id))


def top_group_rows(df: DataFrame, groups: DataFrame, hash_column: str, columns: list[str], text: str,
                   n_groups: int = 3, max_length: int = 300) -> DataFrame:
    """Rows of the ``n_groups`` largest groups with the text cut for display."""
    top = groups.orderBy(F.desc("count"), "hash").limit(n_groups).select("hash", "count")
    return df.join(F.broadcast(top), F.col(hash_column) == F.col("hash")).select(
        "hash", "count", *columns, truncate_chars(F.col(text), max_length).alias(text))
