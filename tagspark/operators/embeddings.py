"""Embedding tables: class centroids, similarities, separation statistics.

Vectors are ``array<float|double>`` columns, labels an array of names. The
label list is given, so centroid tables have a known number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import pct
from ..functions.quantiles import exact_quantiles
from ..functions.vectors import dot, unit
from ..session import cut_lineage
from .profile import long_rows
from .tags import has_tag, keep_tags, literal_array

#: One row per label and side: proven small up to so many labels.
PROVEN_LABELS = 2000


def _small(df: DataFrame, labels: list[str]) -> DataFrame:
    """A table of at most two rows per given label."""
    return F.broadcast(df) if len(labels) <= PROVEN_LABELS else df


def label_rows(spark, labels: list[str]) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(literal_array(labels)).alias("tag"))


def class_centroids(df: DataFrame, vector: str, tags: str, labels: list[str]) -> DataFrame:
    """``(tag, n_pos, centroid)``: unit-length mean of the positives, zeros for
    a label without any. Means are partial sums per task."""
    long = df.select(F.explode(F.array_distinct(keep_tags(tags, labels))).alias("tag"), array_to_vector(vector).alias("v"))
    means = long.groupBy("tag").agg(F.count("*").alias("n_pos"), Summarizer.mean(F.col("v")).alias("m"))
    means = means.select("tag", "n_pos", unit(vector_to_array("m")).alias("c"))
    size = df.agg(F.max(F.size(vector))).scalar()
    grid = label_rows(df.sparkSession, labels).withColumn("zeros", F.array_repeat(F.lit(0.0), size))
    return grid.join(means, "tag", "left").select(
        "tag", F.coalesce("n_pos", F.lit(0)).alias("n_pos"), F.coalesce("c", "zeros").alias("centroid"))


def similarities(df: DataFrame, centroids: DataFrame, vector: str, row_id: str, tags: str, labels: list[str]) -> DataFrame:
    """``(row_id, tag, is_pos, similarity)`` of every row with every centroid.

    A row is unfolded over the label list and meets its centroid in an
    equi-join with the small centroid table; nothing is shuffled.
    """
    flags = F.array(*[F.struct(F.lit(t).alias("tag"), has_tag(tags, t).alias("is_pos")) for t in labels])
    long = df.select(row_id, vector, F.explode(flags).alias("l")).select(row_id, vector, "l.*")
    joined = long.join(_small(centroids.select("tag", "centroid"), labels), "tag")
    return joined.select(row_id, "tag", "is_pos", dot(F.col(vector), F.col("centroid")).alias("similarity"))


def centroid_similarity(centroids: DataFrame, labels: list[str]) -> DataFrame:
    """Cosine of every centroid pair, long form, diagonal included."""
    rows = centroids.select(F.col("tag").alias("tag_a"), F.col("centroid").alias("a"), F.explode(literal_array(labels)).alias("tag_b"))
    other = centroids.select(F.col("tag").alias("tag_b"), F.col("centroid").alias("b"))
    return rows.join(_small(other, labels), "tag_b").select("tag_a", "tag_b", dot(F.col("a"), F.col("b")).alias("similarity"))


def off_diagonal_mean(cells: DataFrame) -> DataFrame:
    off = cells.where("tag_a <> tag_b")
    return off.agg(F.min("similarity").alias("min"), F.avg("similarity").alias("mean"),
                   F.percentile("similarity", 0.5).alias("median"), F.max("similarity").alias("max"))


def top_centroid_pairs(cells: DataFrame, n: int = 5) -> DataFrame:
    return cells.where("tag_a < tag_b").orderBy(F.desc(F.round("similarity", 9)), "tag_a", "tag_b").limit(n)


def separation(sims: DataFrame, labels: list[str], medians: bool = True) -> DataFrame:
    """Per label: size, mean, median and population std of positive and
    negative similarities, and the difference of the means."""
    s, pos = F.col("similarity"), F.col("is_pos")

    def when(side: Column) -> Column:
        return F.when(side, s)

    stats = sims.groupBy("tag").agg(
        F.count_if(pos).alias("n_pos"), F.count_if(~pos).alias("n_neg"),
        F.avg(when(pos)).alias("mean_pos"), F.avg(when(~pos)).alias("mean_neg"),
        F.stddev_pop(when(pos)).alias("std_pos"), F.stddev_pop(when(~pos)).alias("std_neg"),
    ).withColumn("delta_mean", F.col("mean_pos") - F.col("mean_neg"))
    if not medians:
        return stats
    side = F.concat("tag", F.when(pos, "+").otherwise("-"))
    q = exact_quantiles(sims.select(side.alias("g"), "similarity"), "similarity", [0.5], "g", [t + x for t in labels for x in "+-"])
    q = q.select(F.expr("substring(g, 1, length(g) - 1)").alias("tag"), F.right("g", F.lit(1)).alias("side"), F.col("q")[0].alias("m"))
    wide = q.groupBy("tag").agg(F.max(F.when(F.col("side") == "+", F.col("m"))).alias("median_pos"),
                                F.max(F.when(F.col("side") == "-", F.col("m"))).alias("median_neg"))
    return stats.join(wide, "tag", "left")


def similarity_density(sims: DataFrame, edges: int = 50) -> DataFrame:
    """Density histogram per (label, side) between ``edges`` equally spaced
    points of the label's range."""
    bins = edges - 1
    bounds = sims.groupBy("tag").agg(F.min("similarity").alias("lo"), F.max("similarity").alias("hi"))
    sizes = sims.groupBy("tag", "is_pos").agg(F.count("*").alias("n")).join(bounds, "tag")
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width > 0, F.least(F.floor((F.col("similarity") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    placed = sims.join(F.broadcast(sizes), ["tag", "is_pos"])
    return placed.groupBy("tag", "is_pos", slot.cast("int").alias("bin")).agg(
        F.count("*").alias("count"), F.min("n").alias("n"), F.min(width).alias("w")
    ).select("tag", "is_pos", "bin", "count", F.try_divide(F.col("count").cast("double"), F.col("n") * F.col("w")).alias("density"))


def closest_documents(sims: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    """Most similar positives and most similar negatives per label."""
    rank = F.row_number().over(Window.partitionBy("tag", "is_pos").orderBy(F.desc(F.round("similarity", 9)), row_id))
    return sims.withColumn("rank", rank).where(F.col("rank") <= n)


def evaluate(df: DataFrame, vector: str, row_id: str, tags: str, labels: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Separation per label, and a one-row summary, of one embedding column."""
    cents = class_centroids(df, vector, tags, labels)
    stats = separation(similarities(df, cents, vector, row_id, tags, labels), labels).withColumn("column", F.lit(name))
    off = off_diagonal_mean(centroid_similarity(cents, labels)).select("mean").scalar()
    best = F.max(F.struct(F.round("delta_mean", 9).alias("d"), F.col("tag").alias("t")))
    summary = stats.groupBy("column").agg(
        F.avg("delta_mean").alias("mean_delta"),
        F.try_divide(F.sum(F.col("delta_mean") * F.col("n_pos")), F.sum(F.when(F.col("delta_mean").isNotNull(), F.col("n_pos")))).alias("weighted_delta"),
        best.alias("best"),
    ).select("column", "mean_delta", "weighted_delta", off.alias("centroid_similarity"),
             F.col("best.t").alias("best_tag"), F.col("best.d").alias("best_delta"))
    return stats, summary


def text_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of non-blank texts and their mean length, per column."""
    def filled(c: str) -> Column:
        return F.length(F.trim(F.col(c))) > 0

    rows = [(c, {"coverage": pct(F.count_if(filled(c)), F.count("*")),
                 "avg_length": F.avg(F.when(filled(c), F.length(c)))}) for c in columns]
    return long_rows(rows, "column", df)


def compare_columns(df: DataFrame, vectors: dict[str, str], row_id: str, tags: str, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """Evaluate several embedding columns; summaries and label x column cells."""
    results = [evaluate(df, v, row_id, tags, labels, name) for name, v in vectors.items()]
    summary = reduce(DataFrame.unionByName, [r[1] for r in results])
    cells = reduce(DataFrame.unionByName, [r[0].select("tag", "column", "delta_mean") for r in results])
    return summary, cells.groupBy("tag").pivot("column", list(vectors)).agg(F.max("delta_mean"))


# Embedding sources ------------------------------------------------------------

#: Words of a part that one task trains on.
WORDS_A_PART = 1 << 20


def word2vec_embeddings(df: DataFrame, column: str, row_id: str, size: int = 64, min_count: int = 5, seed: int = 42,
                        partitions: int = 4) -> DataFrame:
    """Unit-length document vectors from a Word2Vec model trained on whole texts.

    ``partitions`` is the least number of parts trained on side by side; it grows with the
    words, so that no part has many more than ``WORDS_A_PART``. The vectors depend on it.
    Texts are cleaned once and stored: the vocabulary, the training and the vectors read them.
    """
    from pyspark.ml.feature import Word2Vec

    from ..functions import text

    tokens = cut_lineage(df.select(row_id, text.words(text.clean_for_embeddings(F.col(column))).alias("tokens")))
    words = tokens.agg(F.sum(F.size("tokens"))).first()[0] or 0
    partitions = max(partitions, -(-words // WORDS_A_PART))
    model = Word2Vec(vectorSize=size, minCount=min_count, seed=seed, inputCol="tokens", outputCol="v", maxIter=1, numPartitions=partitions).fit(tokens)
    return model.transform(tokens).select(row_id, unit(vector_to_array("v")).alias("embedding"))


def projected_embeddings(cells: DataFrame, doc_id: str, size: int = 64, seed: int = 42) -> DataFrame:
    """Unit-length random projections of TF-IDF cells. A term's signs are the
    bits of its md5, 32 to a digest, so no projection matrix is stored, joined or sent. A
    document whose only cell has no weight gets the zero vector."""
    digests = (size + 31) // 32
    bits = [F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|{i}|"), F.coalesce("term", F.lit("")))), 1, 8), 16, 10).cast("bigint").alias(f"_h{i}")
            for i in range(digests)]
    known = F.col("weight").isNotNull()
    hashed = cells.select(doc_id, F.when(known, F.col("weight")).otherwise(F.lit(0.0)).alias("weight"), *bits)
    # One plain sum per dimension, so no cell becomes a vector.
    sums = hashed.groupBy(doc_id).agg(*[
        F.sum(F.when(F.col(f"_h{i // 32}").bitwiseAND(F.lit(1 << (i % 32))) != 0, F.col("weight")).otherwise(-F.col("weight"))).alias(f"_s{i}")
        for i in range(size)])
    return sums.select(doc_id, unit(F.array(*[F.col(f"_s{i}") for i in range(size)])).alias("embedding"))
