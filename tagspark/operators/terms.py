"""Frequent and discriminant words and n-grams.

Counts are partially aggregated per task before the shuffle, and every top-n
is a ``row_number`` filter, which Spark applies per task before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..constants import CONTEXT_STOP_WORDS, ENGLISH_STOP_WORDS, NUMBER_TOKENS, PRIORITY_TAGS, SPARK_STOP_WORDS
from ..functions import latex, text
from ..functions.counting import count_char_ngrams, count_tokens
from ..session import cut_lineage
from .joins import broadcast_if_small
from .tags import keep_tags


def stop_words(*extra: list[str]) -> list[str]:
    """Union of the English and the context list with any further lists."""
    out = set(ENGLISH_STOP_WORDS) | set(CONTEXT_STOP_WORDS)
    for words in extra:
        out |= set(words)
    return sorted(out)


def stop_word_table(spark: SparkSession, words: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "word string")


def without_stop_words(df: DataFrame, words: list[str], column: str = "word") -> DataFrame:
    """Anti-join with the (literal, hence small) stop-word table."""
    table = stop_word_table(df.sparkSession, words).withColumnRenamed("word", column)
    return df.join(F.broadcast(table), column, "left_anti")


def top_per(df: DataFrame, group: str, order: list, n: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(rank) <= n)


def counts_by_tag(df: DataFrame, items: Column, name: str, tags: str = "tags",
                  allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """``(tag, name, count)``, and under an empty tag the counts of all rows.

    Items are counted per combination of the row's tags, one row each, and
    the few combinations are unfolded into tags afterwards.
    """
    rows = df.select(_combination(tags, allowed).alias("_tags"), items.alias("_items"))
    counts = rows.select("_tags", F.explode("_items").alias(name)).groupBy("_tags", name).agg(F.count("*").alias("_n"))
    return _unfolded(counts, name)


def _combination(tags: str, allowed: list[str]) -> Column:
    return F.array_join(F.array_distinct(F.concat(F.array(F.lit("")), keep_tags(tags, allowed))), "\x01")


def _unfolded(counts: DataFrame, name: str) -> DataFrame:
    """Counts per combination of tags, to those per tag."""
    return counts.select(name, "_n", F.explode(F.split("_tags", "\x01")).alias("tag")).groupBy("tag", name).agg(F.sum("_n").alias("count"))


def top_words_by_tag(df: DataFrame, column: str, top_n: int = 15, pool: int = 500, remove_latex: bool = True,
                     words: list[str] | None = None, tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """The ``pool`` most common words per tag are taken first; stop words and
    words of up to two letters are dropped from those; then the top ``n``."""
    c = F.col(column)
    source = latex.plain_text(c) if remove_latex else F.lower(c)
    items = F.coalesce(text.words(source), F.array().cast("array<string>"))
    counts = counts_by_tag(df, items, "word", tags, allowed).where("tag <> ''")
    common = top_per(counts, "tag", [F.desc("count"), "word"], pool).drop("rank")
    kept = without_stop_words(common.where(F.length("word") > 2), words or stop_words())
    return top_per(kept, "tag", [F.desc("count"), "word"], top_n).select("tag", "rank", "word", "count")


def top_vector_words_by_tag(df: DataFrame, column: str, top_n: int = 10, words: list[str] | None = None,
                            tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Most frequent vectoriser tokens (two or more characters) per tag, by default without the
    vectoriser's English stop words and Spark's own."""
    items = text.word_tokens(text.letters_only(F.col(column)), 2)
    stop = sorted({*ENGLISH_STOP_WORDS, *SPARK_STOP_WORDS}) if words is None else list(words)
    counts = without_stop_words(counts_by_tag(df, items, "word", tags, allowed).where("tag <> ''"), stop)
    return top_per(counts, "tag", [F.desc("count"), "word"], top_n).select("tag", "rank", "word", "count")


def grams_by_group(df: DataFrame, group: Column, column: str, n: int) -> DataFrame:
    """``(group, gram, count)`` of the overlapping n-grams of the lower-cased text, counted batch by batch in each task."""
    return df.select(group.alias("group"), F.lower(F.col(column)).alias("_t")).mapInArrow(
        lambda batches: count_char_ngrams(batches, n), "group string, gram string, count long"
    ).groupBy("group", "gram").agg(F.sum("count").alias("count"))


def char_ngram_counts(df: DataFrame, column: str, sizes: list[int]) -> DataFrame:
    """``(n, gram, count)`` over all sizes.

    Each text position yields one window of the largest size (shorter at the
    end). Windows are counted first; the smaller n-grams are their prefixes.
    """
    windows = text.char_windows(F.col(column), max(sizes))
    counts = df.select(F.explode(windows).alias("w")).groupBy("w").agg(F.count("*").alias("_n"))
    per_size = counts.select("w", "_n", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("n")).where(F.length("w") >= F.col("n"))
    gram = F.substring(F.col("w"), F.lit(1), F.col("n"))
    return per_size.groupBy("n", gram.alias("gram")).agg(F.sum("_n").alias("count"))


def top_char_ngrams(df: DataFrame, column: str, sizes: tuple[int, int] = (3, 5), top_n: int = 30) -> DataFrame:
    counts = char_ngram_counts(df, column, list(range(sizes[0], sizes[1] + 1)))
    return top_per(counts, "n", [F.desc("count"), "gram"], top_n).select("n", "rank", "gram", "count")


def discriminant_ngrams(df: DataFrame, column: str, n: int = 3, top_n: int = 20, pool: int = 100, min_count: int = 5,
                        tags: str = "tags", allowed: list[str] = PRIORITY_TAGS) -> DataFrame:
    """Log-ratio of a tag's n-gram frequency to the overall frequency, among
    the ``pool`` most common n-grams of the tag."""
    grams = grams_by_group(df, _combination(tags, allowed), column, n)
    # Several results are made of these counts, so they are stored.
    counts = cut_lineage(_unfolded(grams.withColumnsRenamed({"group": "_tags", "count": "_n"}), "gram"))
    overall = counts.where("tag = ''").select("gram", F.col("count").alias("n_all"))
    by_tag = counts.where("tag <> ''")
    tag_totals = by_tag.groupBy("tag").agg(F.sum("count").alias("tag_total"))
    pooled = top_per(by_tag, "tag", [F.desc("count"), "gram"], pool).drop("rank")
    # At most len(allowed) * pool rows: safe to broadcast against all n-grams.
    scored = (
        overall.join(F.broadcast(pooled), "gram").where(F.col("n_all") >= min_count)
        .join(F.broadcast(tag_totals), "tag")
        .withColumn("total", overall.agg(F.sum("n_all")).scalar())
    )
    ratio = (F.col("count") / F.col("tag_total") + 1e-10) / (F.col("n_all") / F.col("total") + 1e-10)
    scored = scored.withColumn("score", F.log2(ratio))
    return top_per(scored, "tag", [F.desc(F.round("score", 9)), "gram"], top_n).select("tag", "rank", "gram", "count", "score")


def token_counts(df: DataFrame, tokens: Column, ngrams: tuple[int, int] = (1, 1)) -> DataFrame:
    """Occurrences and documents per token of a list, or per n-gram of its tokens: counted batch by batch
    in each task, so the shuffle carries one row per batch and token."""
    least, most = ngrams
    counted = df.select(tokens.alias("_t")).mapInArrow(
        lambda batches: count_tokens(batches, least, most), "token string, count long, n_docs long")
    return counted.groupBy("token").agg(F.sum("count").alias("count"), F.sum("n_docs").alias("n_docs"))


def top_tokens(df: DataFrame, clean: str, top_n: int = 30) -> DataFrame:
    counts = token_counts(df, text.word_tokens(F.lower(F.col(clean)), 1))
    return counts.select("token", "count").orderBy(F.desc("count"), "token").limit(top_n)


#: Items a sketch follows at first and at most.
TRACKED = 1 << 14
MOST_TRACKED = 1 << 20


def top_items(items: DataFrame, column: str, top_n: int, tracked: int = TRACKED) -> DataFrame:
    """The ``top_n`` most frequent values with exact counts, ties by value, without shuffling every value.

    A frequent-items sketch per task, merged into one, follows the heavy values of
    an open vocabulary. Its candidates are counted exactly in a second pass. What it
    does not follow occurs at most ``3.5 / tracked`` of all times; while the last
    of the top values is not above that, the sketch grows fourfold, and beyond
    ``MOST_TRACKED`` everything is counted. NULLs are no values.
    """
    values = items.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull())
    exact = None
    while exact is None and tracked <= MOST_TRACKED:
        sketch = cut_lineage(values.agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate(_v, {tracked})").alias("s")))
        n = sketch.first()["n"]
        # Up to ``tracked`` rows, so they may be broadcast.
        near = cut_lineage(sketch.select(F.explode(F.expr(f"approx_top_k_estimate(s, {tracked})")).alias("e")).select("e.item", "e.count"))
        followed, least = near.agg(F.count("*"), F.min("count")).first()
        counts = values.join(F.broadcast(near.select(F.col("item").alias("_v"))), "_v").groupBy("_v").agg(F.count("*").alias("count"))
        top = counts.orderBy(F.desc("count"), "_v").limit(top_n)
        best = cut_lineage(top)
        last, found = best.agg(F.min("count"), F.count("*")).first()
        bound = 3.5 * n / tracked
        # Complete when nothing was ever forgotten, or when the last one stands above all that may have been.
        if n == 0 or bound < 1 or (found == top_n and last > bound and (followed < tracked or least < last)):
            exact = best
        tracked *= 4
    if exact is None:
        exact = values.groupBy("_v").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "_v").limit(top_n)
    return exact.select(F.col("_v").alias(column), "count")


def number_token_counts(df: DataFrame, clean: str) -> DataFrame:
    tokens = F.filter(text.word_tokens(F.lower(F.col(clean)), 1), lambda t: t.isin(NUMBER_TOKENS))
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("count"))


def bigram_counts(df: DataFrame, clean: str, min_df: int = 2) -> DataFrame:
    """Bigrams of vectoriser tokens in at least ``min_df`` documents."""
    tokens = df.select(text.word_tokens(F.col(clean), 2).alias("_k"))
    return token_counts(tokens, F.col("_k"), (2, 2)).where(F.col("n_docs") >= min_df).withColumnRenamed("token", "bigram")


# Language identification ----------------------------------------------------

def language_profile(df: DataFrame, column: str, lang: str, languages: list[str], n: int = 3) -> DataFrame:
    """``(gram, scores)``: smoothed log-probability of every n-gram in every
    language. The row with the NULL n-gram holds those of unseen ones. Stored,
    because applying it needs its size."""
    rows = df.where(F.col(lang).isin(languages) & F.col(column).isNotNull())
    counts = cut_lineage(grams_by_group(rows, F.col(lang), column, n).withColumnRenamed("group", "language"))
    totals = counts.groupBy("language").agg(F.sum("count").alias("total"), F.count("*").alias("types"))
    # One row per language; the counts of a gram in those it occurs in meet in one small map.
    known = F.array(*[F.struct(F.lit(r["language"]).alias("language"), F.lit(r["total"] + r["types"]).alias("size")) for r in totals.collect()])
    of_gram = counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("language", "count"))).alias("seen"))
    unseen = df.sparkSession.range(0, 1, 1, 1).select(F.lit(None).cast("string").alias("gram"), F.create_map().cast("map<string,bigint>").alias("seen"))
    logp = F.transform(known, lambda k: F.struct(
        k["language"].alias("language"), F.ln((F.coalesce(F.element_at(F.col("seen"), k["language"]), F.lit(0)) + 1) / k["size"]).alias("logp")))
    return cut_lineage(of_gram.unionByName(unseen).select("gram", logp.alias("scores")))


def identify_language(df: DataFrame, column: str, row_id: str, profile: DataFrame, n: int = 3) -> DataFrame:
    """``(row_id, language)``, one result per row; texts under ten characters are ``unknown``.

    Every row gets a key of its own before its n-grams are unfolded, so rows
    without an id or with the same one stay apart. Scores of one text are summed
    inside its task, in one column per language: an n-gram stays one row.
    """
    long_enough = F.length(text.squeeze(F.col(column))) >= 10
    rows = cut_lineage(df.select(F.col(row_id), F.when(long_enough, F.col(column)).alias("_t")).withColumn("_row", F.monotonically_increasing_id()))
    grams = rows.select("_row", F.explode(text.char_ngrams(F.col("_t"), n)).alias("gram"))
    unseen = profile.where("gram IS NULL").select("scores").first()["scores"]
    if not unseen:
        return rows.select(row_id, F.lit("unknown").alias("language"))
    found = grams.join(broadcast_if_small(profile.where("gram IS NOT NULL")), "gram", "left")
    sums = found.groupBy("_row").agg(*[
        F.sum(F.coalesce(F.col("scores")[i]["logp"], F.lit(s["logp"]))).alias(f"_s{i}") for i, s in enumerate(unseen)])
    # The highest sum; of equal ones the first language by name.
    ranked = F.array(*[F.struct((-F.round(f"_s{i}", 6)).alias("s"), F.lit(s["language"]).alias("language")) for i, s in enumerate(unseen)])
    joined = rows.select(row_id, "_row").join(sums.select("_row", F.array_min(ranked)["language"].alias("language")), "_row", "left")
    return joined.select(row_id, F.coalesce("language", F.lit("unknown")).alias("language"))
