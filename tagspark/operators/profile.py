"""Column profiles, distributions, correlations and fill statistics."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..constants import PRIORITY_TAGS, TAG_KEYWORDS
from ..functions import text
from ..functions.numeric import not_nan, pct
from ..functions.quantiles import exact_quantiles
from .tags import explode_tags, row_total


def is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def long_rows(metrics: list[tuple[str, dict[str, Column]]], key: str, df: DataFrame) -> DataFrame:
    """One aggregate over ``df`` turned into one row per ``key`` entry."""
    structs = [F.struct(F.lit(name).alias(key), *[c.alias(k) for k, c in ms.items()]) for name, ms in metrics]
    return df.agg(F.array(*structs).alias("_rows")).select(F.explode("_rows").alias("_r")).select("_r.*")


def missing_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and share of every column, in one pass."""
    n = F.count("*")
    rows = [
        (c, {"missing_count": F.count_if(is_missing(df, c)),
             "missing_percentage": F.coalesce(pct(F.count_if(is_missing(df, c)), n), F.lit(0.0))})
        for c in df.columns
    ]
    out = long_rows(rows, "column", df)
    return out.where("missing_count > 0") if only_missing else out


def dataset_summary(df: DataFrame, target_prefix: str = "target_") -> DataFrame:
    """Rows, columns, missing counts and target counts as long rows."""
    n = F.count("*")
    rows = [
        ("rows", {"section": F.lit("table"), "count": n, "percentage": F.lit(None).cast("double")}),
        ("columns", {"section": F.lit("table"), "count": F.lit(len(df.columns)).cast("bigint"),
                     "percentage": F.lit(None).cast("double")}),
    ]
    for c in df.columns:
        m = F.count_if(is_missing(df, c))
        rows.append((c, {"section": F.lit("missing"), "count": m, "percentage": pct(m, n)}))
    for c in sorted(x for x in df.columns if x.startswith(target_prefix)):
        m = F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        name = c[len(target_prefix):].replace("_", " ")
        rows.append((name, {"section": F.lit("target"), "count": m, "percentage": pct(m, n)}))
    return long_rows(rows, "name", df).where("section <> 'missing' OR count > 0").select(
        "section", "name", "count", "percentage")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, count)`` over several columns in one shuffle. Values
    are compared in their printed form; numbers keep a numeric copy."""

    def entry(c: str) -> Column:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        return F.struct(
            F.lit(c).alias("column"),
            F.when(~is_missing(df, c), F.col(c)).cast("string").alias("value"),
            (not_nan(F.col(c).cast("double")) if numeric else F.lit(None).cast("double")).alias("number"),
        )

    return (
        df.select(F.explode(F.array(*[entry(c) for c in columns])).alias("e")).select("e.*")
        .groupBy("column", "value", "number").agg(F.count("*").alias("count"))
    )


def databook(df: DataFrame, categories: dict[str, str] | None = None,
             imputed: dict[str, float] | None = None) -> DataFrame:
    """One row per column: totals, missing, unique values, mean, median, and
    the most common value with its count (smallest value on ties)."""
    categories, imputed = categories or {}, imputed or {}
    counts = value_counts(df, df.columns)
    numeric = [c for c in df.columns if isinstance(df.schema[c].dataType, T.NumericType)]
    c, v, x = F.col("count"), F.col("value"), F.col("number")
    best = F.max(F.when(v.isNotNull(), c))
    stats = counts.groupBy("column").agg(
        F.sum(c).alias("n_total"),
        F.coalesce(F.sum(F.when(v.isNull(), c)), F.lit(0)).alias("n_missing"),
        F.count_if(v.isNotNull()).alias("n_unique"),
        F.try_divide(F.sum(x * c), F.sum(F.when(x.isNotNull(), c))).alias("mean"),
        best.alias("most_common_count"),
    )
    top = (
        counts.where(v.isNotNull())
        .join(F.broadcast(stats.select("column", F.col("most_common_count").alias("_top"))), "column")
        .where(c == F.col("_top"))
        .groupBy("column").agg(F.min(v).alias("_text"), F.min(x).alias("_number"))
    )
    out = stats.join(top, "column", "left")
    out = out.withColumn("most_common", F.when(F.col("_number").isNotNull(), F.col("_number").cast("string")).otherwise(F.col("_text")))
    if numeric:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("column"), F.col(n).cast("double").alias("v")) for n in numeric
        ])).alias("e")).select("e.*")
        medians = exact_quantiles(long, "v", [0.5], by="column", groups=numeric)
        out = out.join(medians.select("column", F.col("q")[0].alias("median")), "column", "left")
    else:
        out = out.withColumn("median", F.lit(None).cast("double"))

    def pick(mapping: dict[str, str], default: str) -> Column:
        e = F.lit(default)
        for k, val in mapping.items():
            e = F.when(F.col("column") == k, F.lit(val)).otherwise(e)
        return e

    rules = {k: f"Median from TRAIN: {val}" for k, val in imputed.items()}
    no_rule = F.when(F.col("n_missing") == 0, F.lit("No missing values")).otherwise(F.lit("Not imputed"))
    return out.select(
        "column", pick(categories, "Original").alias("category"), "n_total", "n_missing",
        pct(F.col("n_missing"), F.col("n_total")).alias("pct_missing"),
        F.coalesce(F.nullif(pick(rules, ""), F.lit("")), no_rule).alias("imputation_rule"),
        "n_unique", "mean", "median", "most_common", "most_common_count",
    )


def databook_categories(book: DataFrame) -> DataFrame:
    return book.groupBy("category").agg(
        F.count("*").alias("n_variables"), F.sum("n_missing").alias("total_missing"))


def category_distribution(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    share = pct(F.col("count"), row_total(df))
    if digits is not None:
        share = F.round(share, digits)
    return df.groupBy(column).agg(F.count("*").alias("count")).select("*", share.alias("percentage"))


def missing_by_difficulty(df: DataFrame, flag: Column, bins: Column) -> DataFrame:
    return df.select(bins.alias("difficulty_bin"), flag.cast("double").alias("m")).where(
        "difficulty_bin IS NOT NULL"
    ).groupBy("difficulty_bin").agg(F.count("*").alias("count"), F.avg("m").alias("missing_rate"))


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and keys that occur more than once."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    present = F.col(key).isNotNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(present).alias("distinct_keys"),
        F.count_if(present & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(present & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("rows_with_repeated_key"),
    ).select("*", (F.col("distinct_keys") == F.col("rows")).alias("is_unique"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("count")).where("count > 1")


# Fill statistics -----------------------------------------------------------

def fill_statistics(df: DataFrame, columns: list[str], strategy: str = "median") -> DataFrame:
    """``(column, value)`` table of fill values learned from ``df``.

    ``mode`` takes the smallest of the most frequent values.
    """
    if strategy not in ("median", "mean", "mode"):
        raise ValueError(f"{strategy} is no fill strategy")
    columns = [c for c in columns if c in df.columns]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), not_nan(F.col(c).cast("double")).alias("v")) for c in columns
    ])).alias("e")).select("e.*").where("v IS NOT NULL")
    if strategy == "mean":
        return long.groupBy("column").agg(F.avg("v").alias("value"))
    if strategy == "median":
        return exact_quantiles(long, "v", [0.5], by="column", groups=columns).select("column", F.col("q")[0].alias("value"))
    counts = long.groupBy("column", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.max(F.struct("n", (-F.col("v")).alias("neg"))).alias("best"))
    return best.select("column", (-F.col("best.neg")).alias("value"))


def mode_of_text(df: DataFrame, column: str) -> Column:
    """Most frequent text (smallest on ties) as a scalar."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(1).select(column).scalar()


def fill_missing(df: DataFrame, fills: DataFrame | dict[str, float], columns: list[str] | None = None) -> DataFrame:
    """Fill from a learned table (scalar look-ups, no join) or a dict."""
    if isinstance(fills, dict):
        columns, values = list(fills), {c: F.lit(v) for c, v in fills.items()}
    else:
        values = {c: fills.where(F.col("column") == c).select("value").scalar() for c in columns}
    return df.withColumns({
        c: F.coalesce(not_nan(F.col(c).cast("double")), values[c]) for c in columns if c in df.columns
    })


# Correlations ---------------------------------------------------------------

def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either
    is constant (the built-in ``corr`` divides by zero there)."""
    x, y = not_nan(a.cast("double")), not_nan(b.cast("double"))
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair, one pass.
    A constant column gives NULL."""
    columns = [c for c in columns if c in df.columns]
    rows = [(f"{a}|{b}", {"r": correlation(F.col(a), F.col(b))})
            for a, b in combinations(columns, 2)]
    if not rows:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")
    out = long_rows(rows, "pair", df)
    parts = F.split("pair", r"\|")
    return out.select(parts[0].alias("column_a"), parts[1].alias("column_b"), "r")


def strong_pairs(pairs: DataFrame, threshold: float = 0.3) -> DataFrame:
    return pairs.where(F.abs("r") > threshold).orderBy(F.desc(F.abs("r")), "column_a", "column_b")


def feature_label_correlation(df: DataFrame, features: list[str], labels: list[str],
                              constant_as_zero: bool = False) -> DataFrame:
    """``(feature, label, r)`` of all features with all labels, one pass."""
    rows = [(f"{f}|{y}", {"r": correlation(F.col(f), F.col(y))})
            for f in features for y in labels]
    parts = F.split("pair", r"\|")
    r = F.col("r")
    if constant_as_zero:
        r = F.coalesce(r, F.lit(0.0))
    return long_rows(rows, "pair", df).select(parts[0].alias("feature"), parts[1].alias("label"), r.alias("r"))


# Distributions --------------------------------------------------------------

def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last is closed."""
    v = F.col(column).cast("double")
    rows = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = rows.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    placed = rows.select("v", bounds.alias("b")).select(
        F.col("b.lo").alias("lo"), ((F.col("b.hi") - F.col("b.lo")) / bins).alias("w"), "v")
    slot = F.when(F.col("w") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.col("w")), F.lit(bins - 1))).otherwise(0)
    return placed.groupBy(slot.cast("int").alias("bin")).agg(
        F.count("*").alias("count"), F.min("lo").alias("_lo"), F.min("w").alias("_w")
    ).select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"),
             (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("high"), "count")


def five_numbers(df: DataFrame, column: str, by: str | None = None, groups: list | None = None) -> DataFrame:
    q = exact_quantiles(df, column, [0.0, 0.25, 0.5, 0.75, 1.0], by, groups)
    names = ["min", "q1", "median", "q3", "max"]
    group = [] if by is None else [by]
    return q.select(*group, "n", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def length_summary(df: DataFrame, column: str, short: int = 50) -> DataFrame:
    """Distribution of a length column and the share of short texts."""
    q = exact_quantiles(df, column, [0.25, 0.5, 0.75, 0.95]).select("q").scalar()
    v = F.col(column)
    return df.agg(
        F.count("*").alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"), F.count_if(v < short).alias("short"),
        pct(F.count_if(v < short), F.count("*")).alias("short_pct"), q.alias("q"),
    ).select("n", "min", "max", "mean", "std", "short", "short_pct",
             F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), F.col("q")[3].alias("p95"))


def code_summary(df: DataFrame, code: str) -> DataFrame:
    c = F.col(code)
    rows = df.select(F.length(c).alias("chars"), text.line_count(c).alias("lines"))
    both = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("of"), F.col(n).alias("v")) for n in ("chars", "lines")])).alias("e")).select("e.*")
    medians = exact_quantiles(both, "v", [0.5], "of", ["chars", "lines"])
    chars, lines = (medians.where(F.col("of") == n).select(F.col("q")[0]).scalar() for n in ("chars", "lines"))
    return rows.agg(
        F.avg("chars").alias("avg_length_chars"), chars.alias("median_length_chars"),
        F.avg("lines").alias("avg_length_lines"), lines.alias("median_length_lines"))


# Keywords and outliers --------------------------------------------------------

def _own_keywords(column: Column, keywords: dict[str, list[str]]) -> Column:
    """Whether the text holds a keyword of the row's ``tag``."""
    low, out = F.lower(column), F.lit(False)
    for tag, words in keywords.items():
        hit = reduce(lambda a, b: a | b, [low.contains(w) for w in words])
        out = F.when(F.col("tag") == tag, hit).otherwise(out)
    return F.coalesce(out, F.lit(False))


def _keyword_flags(df: DataFrame, columns: list[str], keywords: dict[str, list[str]], tags: str) -> DataFrame:
    """Flags are computed once per (row, own tag) before the text is dropped."""
    long = explode_tags(df, *columns, tags=tags, allowed=list(keywords))
    return long.select("tag", *[_own_keywords(F.col(c), keywords).alias(c) for c in columns])


def keyword_coverage(df: DataFrame, description: str, code: str, tags: str = "tags",
                     keywords: dict[str, list[str]] = TAG_KEYWORDS) -> DataFrame:
    flags = _keyword_flags(df, [description, code], keywords, tags)
    d, c = F.col(description), F.col(code)
    return flags.groupBy("tag").agg(
        F.count("*").alias("total"), F.avg(d.cast("double")).alias("desc_coverage"),
        F.avg(c.cast("double")).alias("code_coverage"), F.avg((d | c).cast("double")).alias("either_coverage"))


def length_outliers(df: DataFrame, length: Column, description: str, tags: str = "tags",
                    keywords: dict[str, list[str]] = TAG_KEYWORDS, share: float = 0.05) -> DataFrame:
    """Per tag: rows shorter than the 5th percentile, rows without keyword."""
    groups = list(keywords)
    long = explode_tags(df, length.alias("len"), description, tags=tags, allowed=groups)
    flags = long.select("tag", "len", _own_keywords(F.col(description), keywords).alias("kw"))
    cut = exact_quantiles(flags.select("tag", "len"), "len", [share], by="tag", groups=groups)
    cut = cut.select("tag", F.col("q")[0].alias("cut"))
    return flags.join(F.broadcast(cut), "tag", "left").groupBy("tag").agg(
        F.count("*").alias("total"), F.count_if(F.col("len") < F.col("cut")).alias("very_short"),
        F.count_if(~F.col("kw")).alias("no_keywords"))


def flag_rates_by_tag(df: DataFrame, flags: dict[str, Column], tags: str = "tags",
                      allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Mean of each 0/1 flag per tag as ``(tag, flag, rate)``."""
    long = explode_tags(df, *[c.alias(n) for n, c in flags.items()], tags=tags, allowed=allowed)
    means = long.groupBy("tag").agg(*[F.avg(n).alias(n) for n in flags])
    entries = F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("rate")) for n in flags])
    return means.select("tag", F.explode(entries).alias("e")).select("tag", "e.*")


def ascii_summary(df: DataFrame, column: str, threshold: float = 0.95) -> DataFrame:
    ratio = text.ascii_ratio(F.col(column))
    return df.select(ratio.alias("r")).agg(
        F.count("*").alias("total"), F.count_if(F.col("r") < threshold).alias("non_ascii"),
        pct(F.count_if(F.col("r") < threshold), F.count("*")).alias("non_ascii_pct"),
        F.avg(F.when(F.col("r") < threshold, F.col("r"))).alias("mean_ratio_non_ascii"))


