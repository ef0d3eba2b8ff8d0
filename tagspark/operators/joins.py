"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import squeeze


def balanced_join(left: DataFrame, right: DataFrame, key: str, row_id: str, how: str = "left") -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key.

    Both sides are shuffled by key once. A task that would get too many bytes, whatever
    share of the table a key holds, is split by adaptive execution: its match is one row and is
    read again by every part. Rows without a key match nothing and are spread by
    their row id. ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    payload = [c for c in right.columns if c != key]
    packed = right.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_spread"), F.struct(F.lit(True).alias("_hit"), *payload).alias("_match"))
    spread = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\x00"), F.coalesce(F.col(row_id).cast("string"), F.lit(""))))
    rows = left.withColumn("_spread", spread)
    if how in ("left_semi", "left_anti"):
        return rows.join(packed, "_spread", how).select(*left.columns)
    joined = rows.join(packed, "_spread", how)
    return joined.select(*left.columns, *[F.col(f"_match.{c}").alias(c) for c in payload])


def apply_translations(
    df: DataFrame,
    column: str,
    translations: DataFrame,
    row_id: str,
    target_lang: str = "en",
    new_column: str | None = "_translated",
    detected_lang: str | None = None,
) -> DataFrame:
    """Replace a text by its supplied translation.

    ``translations`` holds ``text_key`` (md5 of the text), ``lang`` and
    ``translated``, one row per key. Texts under ten characters keep language
    ``unknown`` and status ``original``; a text already in the target language
    is ``original``; one without a translation is kept with status ``error``.
    ``detected_lang`` names a column with the language where it is known.
    """
    if column not in df.columns:
        return df
    long_enough = F.length(squeeze(F.col(column))) >= 10
    keyed = df.withColumn("_text_key", F.when(long_enough, F.md5(F.col(column))))
    supplied = translations.select(
        F.col("text_key").alias("_text_key"), F.col("lang").alias("_lang"), F.col("translated").alias("_text"))
    out = balanced_join(keyed, supplied, "_text_key", row_id)
    lang = F.col("_lang")
    if detected_lang is not None:
        lang = F.coalesce(F.col(detected_lang), lang)
    lang = F.when(~F.coalesce(long_enough, F.lit(False)), F.lit("unknown")).otherwise(F.coalesce(lang, F.lit("unknown")))
    out = out.withColumn("_found", lang)
    short = ~F.coalesce(long_enough, F.lit(False))
    status = (
        F.when(short | (F.col("_found") == target_lang), "original")
        .when(F.col("_text").isNotNull(), "translated")
        .otherwise("error")
    )
    out = out.withColumn(f"{column}_status", status).withColumn(f"{column}_lang", F.col("_found"))
    text = F.when(F.col(f"{column}_status") == "translated", F.col("_text")).otherwise(F.col(column))
    target = column if not new_column else f"{column}{new_column}"
    return out.withColumn(target, text).drop("_text_key", "_lang", "_text", "_found")


def status_counts(df: DataFrame, status: str) -> DataFrame:
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("count")).select(
        "*", F.try_divide(F.col("count") * F.lit(100.0), total).alias("percentage"))


#: Rows of a table that may be sent to every executor.
BROADCAST_ROWS = 200_000


def broadcast_if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table marked for broadcast if it has no more than ``rows`` rows; it is counted up to there.

    Store a table that is costly to make before: counting makes it once more.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def with_doc_counts(terms: DataFrame, vocabulary: DataFrame, on: str) -> DataFrame:
    """Look terms up in a vocabulary."""
    return terms.join(broadcast_if_small(vocabulary), on)
