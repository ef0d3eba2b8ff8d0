"""Tag lists: projections, counts, co-occurrence, lift and combinations.

Lists are exploded once and counted with map-side partial aggregation, so a
tag carried by a third of all rows costs no more than any other.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import PRIORITY_TAGS
from ..functions.quantiles import describe
from ..session import cut_lineage
from .joins import BROADCAST_ROWS, broadcast_if_small


def _list(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.array().cast("array<string>"))


def literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def keep_tags(column: str, allowed: list[str] = PRIORITY_TAGS) -> Column:
    """Allowed items in their order, repeats kept; NULL gives an empty list."""
    return F.filter(_list(column), lambda t: t.isin(allowed))


def with_priority_tags(df: DataFrame, column: str = "tags", allowed: list[str] = PRIORITY_TAGS,
                       new_column: str = "tags_priority") -> DataFrame:
    return df.withColumn(new_column, keep_tags(column, allowed))


def has_tag(column: str, tag: str) -> Column:
    return F.array_contains(_list(column), tag)


def has_any_tag(column: str, tags: list[str] = PRIORITY_TAGS) -> Column:
    return F.arrays_overlap(_list(column), literal_array(tags))


def target_columns(column: str, tags: list[str] = PRIORITY_TAGS, prefix: str = "target_",
                   alphabetical: bool = False, underscore: bool = True) -> list[Column]:
    """0/1 columns. The binarizer variant sorts the classes and keeps spaces."""
    names = sorted(tags) if alphabetical else tags
    return [
        has_tag(column, t).cast("int").alias(prefix + (t.replace(" ", "_") if underscore else t)) for t in names
    ]


def pair_flag(column: str, a: str, b: str) -> Column:
    return (has_tag(column, a) & has_tag(column, b)).cast("int")


def tag_examples(df: DataFrame, tag: str, n: int, columns: list[str], order_by: str, tags: str = "tags") -> DataFrame:
    """First ``n`` rows with the tag, in key order (top-n per task)."""
    return df.where(has_tag(tags, tag)).orderBy(order_by).select(*columns).limit(n)


def explode_tags(df: DataFrame, *keep: str | Column, tags: str = "tags", allowed: list[str] | None = None,
                 distinct: bool = True) -> DataFrame:
    """One row per (row, tag)."""
    items = _list(tags) if allowed is None else keep_tags(tags, allowed)
    if distinct:
        items = F.array_distinct(items)
    return df.select(*keep, F.explode(items).alias("tag"))


def row_total(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def tag_statistics(df: DataFrame, tags: str = "tags", priority: list[str] = PRIORITY_TAGS) -> DataFrame:
    counts = explode_tags(df, tags=tags, distinct=False).groupBy("tag").agg(F.count("*").alias("count"))
    return counts.select(
        "tag", "count",
        (F.col("count") / row_total(df)).alias("frequency"),
        F.col("tag").isin(priority).alias("is_priority"),
    )


def priority_coverage(df: DataFrame, tags: str = "tags", priority: list[str] = PRIORITY_TAGS) -> DataFrame:
    hit = has_any_tag(tags, priority)
    return df.agg(
        F.count("*").alias("total_samples"),
        F.count_if(hit).alias("samples_with_priority_tag"),
        F.try_divide(F.count_if(hit) * 100.0, F.count("*")).alias("coverage_percentage"),
        F.count_if(~hit).alias("samples_without_priority_tag"),
    )


def cooccurrence(df: DataFrame, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Ordered pairs incl. the diagonal. Pairs arise within one row's list,
    which the allow-list bounds."""
    own = F.array_distinct(keep_tags(tags, allowed))
    pairs = (
        df.select(own.alias("l"))
        .select("l", F.explode("l").alias("tag_a"))
        .select("tag_a", F.explode("l").alias("tag_b"))
    )
    return pairs.groupBy("tag_a", "tag_b").agg(F.count("*").alias("count"))


def cooccurrence_matrix(df: DataFrame, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """All cells of the matrix, zeros included, in long form."""
    spark = df.sparkSession
    grid = spark.range(0, 1, 1, 1).select(F.explode(literal_array(allowed)).alias("tag_a")).select(
        "tag_a", F.explode(literal_array(allowed)).alias("tag_b")
    )
    return grid.join(cooccurrence(df, tags, allowed), ["tag_a", "tag_b"], "left").fillna(0, ["count"])


def cooccurrence_normalised(df: DataFrame, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Off-diagonal cells divided by the row's diagonal; the diagonal stays."""
    cells = cooccurrence_matrix(df, tags, allowed)
    own = cells.where("tag_a = tag_b").select("tag_a", F.col("count").alias("own"))
    rate = F.when(
        (F.col("tag_a") != F.col("tag_b")) & (F.col("own") > 0), F.col("count") / F.col("own")
    ).otherwise(F.col("count").cast("double"))
    return cells.join(own, "tag_a").select("tag_a", "tag_b", rate.alias("value"))


def _sorted_pairs(items: Column) -> Column:
    """Every 2-combination of a sorted list, repeats included."""
    indexed = F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("t")))
    return F.flatten(
        F.transform(
            indexed,
            lambda a: F.transform(
                F.filter(indexed, lambda b: b["i"] > a["i"]),
                lambda b: F.struct(a["t"].alias("tag_a"), b["t"].alias("tag_b")),
            ),
        )
    )


def pair_counts(df: DataFrame, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Unordered pairs among the row's allowed tags."""
    rows = df.select(F.array_sort(keep_tags(tags, allowed)).alias("l")).where(F.size("l") >= 2)
    return (
        rows.select(F.explode(_sorted_pairs(F.col("l"))).alias("p"))
        .select("p.tag_a", "p.tag_b")
        .groupBy("tag_a", "tag_b")
        .agg(F.count("*").alias("count"))
    )


def pair_grid(df: DataFrame, tags: str, allowed: list[str] | None) -> DataFrame:
    """Every pair ``tag_a < tag_b``, occurring or not.

    With a list the grid is literal. Without one it is spread from the tag
    vocabulary, pack by pack; ``frequent_pairs`` needs no grid.
    """
    if allowed is not None:
        pairs = [F.struct(F.lit(a).alias("tag_a"), F.lit(b).alias("tag_b"))
                 for a, b in combinations(sorted(set(allowed)), 2)]
        return df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    vocabulary = cut_lineage(explode_tags(df, tags=tags).distinct())
    return beside_every(vocabulary.withColumnRenamed("tag", "tag_a"), vocabulary.withColumnRenamed("tag", "tag_b")).where("tag_a < tag_b")


#: Items a row meets at once.
PACK = 512


def beside_every(rows: DataFrame, items: DataFrame, pack: int = PACK) -> DataFrame:
    """Every row beside every row of ``items``, for tables whose product is the result.

    Items come in packs of about ``pack``, each found by its number, so no array
    grows with the table; packs are sent to every executor up to ``BROADCAST_ROWS`` items.
    """
    items = cut_lineage(items)
    packs = max(1, -(-items.count() // pack))
    number = F.pmod(F.xxhash64(*items.columns), F.lit(packs)).cast("int").alias("_pack")
    packed = items.select(number, F.struct(*items.columns).alias("_item")).groupBy("_pack").agg(F.collect_list("_item").alias("_items"))
    spread = rows.withColumn("_pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    joined = spread.join(F.broadcast(packed) if packs * pack <= BROADCAST_ROWS else packed, "_pack")
    return joined.select(*rows.columns, F.explode("_items").alias("_item")).select(*rows.columns, "_item.*")


def lift_pmi(df: DataFrame, tags: str = "tags", allowed: list[str] | None = PRIORITY_TAGS,
             membership: bool = False) -> DataFrame:
    """Lift, PMI, count and conditional probabilities of every tag pair.

    ``membership=False`` counts a repeated tag twice in P(tag) (not in the
    joint count); ``membership=True`` counts rows in both. Only tags that
    occur take part.
    """
    exploded = explode_tags(df, tags=tags, allowed=allowed, distinct=membership)
    singles = exploded.groupBy("tag").agg(F.count("*").alias("n"))
    if allowed is not None:
        joint = cooccurrence(df, tags, allowed)
    else:
        own = F.array_distinct(_list(tags))
        joint = (
            df.select(own.alias("l")).select("l", F.explode("l").alias("tag_a"))
            .select("tag_a", F.explode("l").alias("tag_b"))
            .groupBy("tag_a", "tag_b").agg(F.count("*").alias("count"))
        )
    total = row_total(df)
    grid = (
        pair_grid(df, tags, allowed)
        .join(singles.select(F.col("tag").alias("tag_a"), F.col("n").alias("n_a")), "tag_a")
        .join(singles.select(F.col("tag").alias("tag_b"), F.col("n").alias("n_b")), "tag_b")
        .join(joint, ["tag_a", "tag_b"], "left")
        .select("tag_a", "tag_b", "n_a", "n_b", F.coalesce("count", F.lit(0)).alias("count"),
                total.alias("total"))
    )
    p_a, p_b = F.col("n_a") / F.col("total"), F.col("n_b") / F.col("total")
    lift = F.coalesce(F.try_divide(F.col("count") / F.col("total"), p_a * p_b), F.lit(0.0))
    return grid.withColumn("lift", lift).select(
        "tag_a", "tag_b", "count", "lift",
        F.when(F.col("lift") > 0, F.ln("lift")).otherwise(F.lit(0.0)).alias("pmi"),
        F.coalesce(F.try_divide(F.col("count"), F.col("n_a")), F.lit(0.0)).alias("p_b_given_a"),
        F.coalesce(F.try_divide(F.col("count"), F.col("n_b")), F.lit(0.0)).alias("p_a_given_b"),
    )


def frequent_pairs(df: DataFrame, tags: str = "tags", min_count: int = 2) -> DataFrame:
    """``lift_pmi`` over an open vocabulary for the pairs that at least ``min_count`` rows hold.

    Two passes: tags are counted first, and only tags that are frequent themselves
    can be in a frequent pair, so rare ones leave their rows before pairs are made.
    A row's tags are unfolded pair by pair, there is no grid of all tags and no
    array of a row's pairs. Every row is a basket of its own; a repeated tag counts
    once, NULL lists and tags are left out.
    """
    own = F.array_distinct(F.array_compact(_list(tags)))
    rows = cut_lineage(df.select(own.alias("l")).where(F.size("l") >= 1).withColumn("row", F.monotonically_increasing_id()))
    singles = cut_lineage(rows.select(F.explode("l").alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))
    small = broadcast_if_small(singles)
    kept = rows.where(F.size("l") >= 2).select("row", F.explode("l").alias("tag")).join(small.select("tag"), "tag", "left_semi")
    baskets = kept.groupBy("row").agg(F.sort_array(F.collect_list("tag")).alias("l")).where(F.size("l") >= 2)
    first = baskets.select("l", F.posexplode("l").alias("i", "tag_a")).where(F.col("i") < F.size("l") - 1)
    pairs = first.select("tag_a", F.explode(F.slice("l", F.col("i") + 2, F.size("l"))).alias("tag_b"))
    counts = pairs.groupBy("tag_a", "tag_b").agg(F.count("*").alias("count")).where(F.col("count") >= min_count)
    named = counts.join(small.select(F.col("tag").alias("tag_a"), F.col("n").alias("n_a")), "tag_a")
    named = named.join(small.select(F.col("tag").alias("tag_b"), F.col("n").alias("n_b")), "tag_b").withColumn("total", row_total(df))
    lift = F.col("count") * F.col("total") / (F.col("n_a") * F.col("n_b"))
    return named.select("tag_a", "tag_b", "count", lift.alias("lift"), F.ln(lift).alias("pmi"),
                        (F.col("count") / F.col("n_a")).alias("p_b_given_a"), (F.col("count") / F.col("n_b")).alias("p_a_given_b"))


def lift_matrix(lift: DataFrame, tags: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Symmetric long matrix; 1.0 on the diagonal and for unknown cells."""
    grid = lift.sparkSession.range(0, 1, 1, 1).select(F.explode(literal_array(tags)).alias("row_tag")).select(
        "row_tag", F.explode(literal_array(tags)).alias("col_tag")
    )
    both = F.array(
        F.struct(F.col("tag_a").alias("row_tag"), F.col("tag_b").alias("col_tag")),
        F.struct(F.col("tag_b").alias("row_tag"), F.col("tag_a").alias("col_tag")),
    )
    cells = lift.select("lift", F.explode(both).alias("p")).select("p.*", "lift")
    return grid.join(cells, ["row_tag", "col_tag"], "left").select(
        "row_tag", "col_tag", F.coalesce("lift", F.lit(1.0)).alias("lift")
    )


def tag_distribution(df: DataFrame, tags: str = "tags", priority: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Tags-per-row statistics for all tags and for the priority tags of rows
    that have one: two rows, one per scope."""
    n_all = F.size(_list(tags))
    n_priority = F.size(keep_tags(tags, priority))
    scopes = F.array(
        F.struct(F.lit("all").alias("scope"), n_all.alias("n")),
        F.struct(F.lit("priority").alias("scope"), F.nullif(n_priority, F.lit(0)).alias("n")),
    )
    long = df.select(F.explode(scopes).alias("s")).select("s.*").where("n IS NOT NULL")
    per_count = long.groupBy("scope", "n").agg(F.count("*").alias("rows"))
    # Tag counts per row take few values, so the statistics run on their histogram.
    n, rows = F.col("n"), F.col("rows")
    total = F.sum(rows)
    mean = F.sum(n * rows) / total
    stats = per_count.groupBy("scope").agg(
        total.alias("samples"),
        F.min(n).alias("min_tags"),
        F.max(n).alias("max_tags"),
        mean.alias("mean_tags"),
        F.percentile(n, 0.5, rows).alias("median_tags"),
        F.sqrt(F.try_divide(F.sum(n * n * rows) - F.sum(n * rows) * mean, total - 1)).alias("std_tags"),
        F.sum(F.when(n == 1, rows).otherwise(0)).alias("mono"),
    )
    return stats.select(
        "*",
        (F.col("samples") - F.col("mono")).alias("multi"),
        (F.col("mono") * 100.0 / F.col("samples")).alias("mono_pct"),
        ((F.col("samples") - F.col("mono")) * 100.0 / F.col("samples")).alias("multi_pct"),
    )


def unique_tag_count(df: DataFrame, tags: str = "tags") -> Column:
    return explode_tags(df, tags=tags).agg(F.count_distinct("tag")).scalar()


def label_density(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Tags per row over the number of distinct tags."""
    density = F.size(_list(tags)) / F.col("n_unique")
    return df.select(tags, unique_tag_count(df, tags).alias("n_unique")).agg(
        F.max("n_unique").alias("unique_tags"),
        F.avg(density).alias("mean_density"), F.min(density).alias("min_density"), F.max(density).alias("max_density")
    )


def tag_combinations(df: DataFrame, tags: str = "tags") -> DataFrame:
    combo = F.array_join(F.array_sort(_list(tags)), "|")
    return df.groupBy(combo.alias("combination")).agg(F.count("*").alias("count"))


def raw_forms(df: DataFrame, tags: str = "tags") -> DataFrame:
    """``(normal_form, raw_form, occurrences)``, one row per raw form, however many a normal form has."""
    raw = explode_tags(df, tags=tags, distinct=False).groupBy(F.col("tag").alias("raw_form")).agg(F.count("*").alias("occurrences"))
    return raw.select(F.lower(F.trim("raw_form")).alias("normal_form"), "raw_form", "occurrences")


def normalisation_audit(df: DataFrame, tags: str = "tags") -> DataFrame:
    """Normal form, raw variants and occurrences of every tag, the variants in one text for
    display; ``raw_forms`` gives them as rows."""
    raw = explode_tags(df, tags=tags, distinct=False).groupBy("tag").agg(F.count("*").alias("n"))
    return raw.groupBy(F.lower(F.trim("tag")).alias("normal_form")).agg(
        F.count("*").alias("variants"),
        F.array_join(F.sort_array(F.collect_list("tag")), "|").alias("raw_forms"),
        F.sum("n").alias("occurrences"),
    )


def means_by_tag(df: DataFrame, values: dict[str, Column], tags: str = "tags",
                 allowed: list[str] | None = PRIORITY_TAGS) -> DataFrame:
    """Row count and mean of each value per tag, in one pass."""
    cols = [v.alias(k) for k, v in values.items()]
    long = explode_tags(df, *cols, tags=tags, allowed=allowed)
    return long.groupBy("tag").agg(F.count("*").alias("count"), *[F.avg(k).alias(k) for k in values])


def tags_per_row_summary(df: DataFrame, tags: str = "tags", priority: list[str] = PRIORITY_TAGS) -> DataFrame:
    per_row = df.select(F.size(_list(tags)).alias("n"), F.size(keep_tags(tags, priority)).alias("np"))
    counts = per_row.groupBy("n", "np").agg(F.count("*").alias("rows"))
    rows = F.sum("rows")
    return counts.agg(
        (F.sum(F.col("n") * F.col("rows")) / rows).alias("avg_total_tags"),
        F.percentile("n", 0.5, F.col("rows")).alias("median_total_tags"),
        (F.sum(F.col("np") * F.col("rows")) / rows).alias("avg_priority_tags"),
        F.sum(F.when(F.col("np") > 0, F.col("rows")).otherwise(0)).alias("samples_with_priority"),
        (F.sum(F.when(F.col("np") > 0, F.col("rows")).otherwise(0)) * 100.0 / rows).alias("coverage_percentage"),
    )


def numeric_by_tag(df: DataFrame, value: str, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS,
                   probs: list[float] = (0.5,)) -> DataFrame:
    long = explode_tags(df, F.col(value).alias("value"), tags=tags, allowed=allowed)
    return describe(long, "value", "tag", allowed, list(probs))


