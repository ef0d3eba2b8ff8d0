"""LaTeX symbols: presence, selection and enrichment by tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import latex
from ..session import cut_lineage
from .joins import balanced_join, broadcast_if_small
from .tags import beside_every, explode_tags, row_total


def symbol_presence(df: DataFrame, column: str, doc_id: str, exact: bool = False) -> DataFrame:
    """Long ``(doc_id, symbol)`` table over all commands in the column.

    By default a symbol is also present where a longer command starts with it.
    Such symbols are found through the prefixes of each distinct command, so
    the text is scanned once and no text is compared with every symbol.
    """
    found = df.select(doc_id, F.explode(latex.commands(F.col(column))).alias("symbol"))
    if exact:
        return found
    # From here on only this short table is read, several times.
    found = cut_lineage(found)
    known = found.select("symbol").distinct()
    prefixes = known.select(
        "symbol",
        F.explode(F.transform(F.sequence(F.lit(2), F.length("symbol")), lambda n: F.substring("symbol", F.lit(1), n))).alias("prefix"),
    )
    covers = (
        prefixes.join(known.withColumnRenamed("symbol", "prefix"), "prefix")
        .groupBy("symbol").agg(F.collect_set("prefix").alias("all"))
    )
    spread = balanced_join(found, covers, "symbol", doc_id, "inner")
    return spread.select(doc_id, F.explode("all").alias("symbol")).distinct()


def symbol_counts(presence: DataFrame) -> DataFrame:
    """Documents per symbol."""
    return presence.groupBy("symbol").agg(F.count("*").alias("n_docs"))


def select_symbols(presence: DataFrame, top_n: int = 30, min_frequency: int = 10) -> DataFrame:
    """The most frequent symbols in at least ``min_frequency`` documents."""
    counts = symbol_counts(presence).where((F.col("n_docs") >= min_frequency) & (F.length("symbol") > 1))
    return counts.orderBy(F.desc("n_docs"), "symbol").limit(top_n)


def selected_list(selection: DataFrame, top_n: int = 30) -> list[str]:
    """Selected symbols on the driver: at most ``top_n`` short strings."""
    return [r["symbol"] for r in selection.orderBy(F.desc("n_docs"), "symbol").limit(top_n).collect()]


def symbol_features(column: str | Column, symbols: list[str], prefix: str = "has_", exact: bool = False) -> list[Column]:
    """0/1 feature columns for a fitted symbol list; absent symbols give 0."""
    c = F.col(column) if isinstance(column, str) else column
    return [latex.has_symbol(c, s, exact).alias(latex.feature_name(s, prefix)) for s in symbols]


def enrichment(df: DataFrame, presence: DataFrame, doc_id: str, tags: str = "tags",
               min_docs: int = 5, allowed: list[str] | None = None) -> DataFrame:
    """``(symbol, tag, lift)`` with ``P(symbol | tag) / P(symbol)``, zero cells
    included, for symbols in at least ``min_docs`` documents."""
    membership = explode_tags(df, doc_id, tags=tags, allowed=allowed)
    tag_sizes = membership.groupBy("tag").agg(F.count("*").alias("n_tag"))
    valid = symbol_counts(presence).where(F.col("n_docs") >= min_docs)
    joint = presence.join(membership, doc_id).groupBy("symbol", "tag").agg(F.count("*").alias("n"))
    total = row_total(df)
    grid = beside_every(valid.select("symbol", "n_docs"), tag_sizes)
    cells = grid.join(joint, ["symbol", "tag"], "left").select(
        "symbol", "tag", "n_docs", "n_tag", F.coalesce("n", F.lit(0)).alias("n"), total.alias("total"))
    return cells.select(
        "symbol", "tag", "n_docs",
        ((F.col("n") / F.col("n_tag")) / (F.col("n_docs") / F.col("total"))).alias("lift"))


def _rank(lift: DataFrame, *order: Column | str) -> DataFrame:
    return lift.withColumn("rank", F.row_number().over(Window.partitionBy("tag").orderBy(*order)))


def enriched_and_depleted(lift: DataFrame, top_n: int = 10, threshold: float = 1.5,
                          depleted_below: float = 0.5, depleted_n: int = 5) -> DataFrame:
    """Per tag the most over- and the most under-represented symbols."""
    value = F.round("lift", 9)
    up = _rank(lift.where(value >= threshold), F.desc(value), "symbol").where(F.col("rank") <= top_n)
    down = _rank(lift.where(value <= depleted_below), value, "symbol").where(F.col("rank") <= depleted_n)
    cols = ["tag", "kind", "rank", "symbol", "lift"]
    return up.withColumn("kind", F.lit("enriched")).select(*cols).unionByName(
        down.withColumn("kind", F.lit("depleted")).select(*cols))


def top_symbols(lift: DataFrame, top_n: int = 10, digits: int = 2) -> DataFrame:
    ranked = _rank(lift, F.desc(F.round("lift", 9)), "symbol").where(F.col("rank") <= top_n)
    return ranked.select("tag", "rank", "symbol", F.round("lift", digits).alias("lift"))


def most_variable(lift: DataFrame, top_n: int = 30) -> DataFrame:
    variance = lift.groupBy("symbol").agg(F.var_samp("lift").alias("variance"))
    return variance.orderBy(F.desc(F.round("variance", 9)), "symbol").limit(top_n)


def compare_tags(lift: DataFrame, tag_a: str, tag_b: str, top_n: int = 15) -> DataFrame:
    """Symbols whose lift differs most between two tags, both directions."""
    diff = lift.where(F.col("tag").isin(tag_a, tag_b)).groupBy("symbol").agg(
        (F.max(F.when(F.col("tag") == tag_a, F.col("lift"))) - F.max(F.when(F.col("tag") == tag_b, F.col("lift")))).alias("difference"))
    value = F.round("difference", 9)
    largest = diff.orderBy(F.desc(value), "symbol").limit(top_n).withColumn("side", F.lit(tag_a))
    smallest = diff.orderBy(value, "symbol").limit(top_n).withColumn("side", F.lit(tag_b))
    return largest.unionByName(smallest).select("side", "symbol", "difference")


def summed_lift(df: DataFrame, presence: DataFrame, lift: DataFrame, doc_id: str) -> DataFrame:
    """Per document and tag the summed lift of the document's symbols.

    A table of lifts that is too large to send is joined by a shuffle, in which
    adaptive execution splits the symbols that many documents hold.
    """
    lifts = broadcast_if_small(cut_lineage(lift.select("symbol", "tag", "lift")))
    return presence.join(lifts, "symbol").groupBy(doc_id, "tag").agg(F.sum("lift").alias("score"))
