"""TF-IDF as DataFrames: vocabulary table, long weights, sparse vectors."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text
from ..functions.vectors import sparse_vector
from ..session import cut_lineage
from .joins import BROADCAST_ROWS
from .tags import row_total
from .terms import token_counts


def tokenised(df: DataFrame, column: str, *keep: str, lowercase: bool = False) -> DataFrame:
    """``keep`` and the token list ``_k``. Tokens are a column of their own
    because n-grams refer to them several times."""
    c = F.col(column)
    return df.select(*keep, text.word_tokens(F.lower(c) if lowercase else c, 2).alias("_k"))


def terms_of(tokens: str = "_k", ngrams: tuple[int, int] = (1, 2)) -> Column:
    """Vectoriser terms: tokens of two or more word characters and their
    n-grams."""
    parts = [text.word_ngrams(F.col(tokens), n) for n in range(ngrams[0], ngrams[1] + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def fit_vocabulary(df: DataFrame, column: str, ngrams: tuple[int, int] = (1, 2), min_df: int = 2, max_df: float = 0.95,
                   max_features: int | None = 5000, lowercase: bool = False) -> DataFrame:
    """``(term, count, n_docs, idf)`` of the kept terms.

    Document-frequency limits come first, then the ``max_features`` most
    frequent terms (by term on ties). Smoothed idf: ``ln((1+N)/(1+df)) + 1``.
    """
    counts = token_counts(tokenised(df, column, lowercase=lowercase), F.col("_k"), ngrams).withColumnRenamed("token", "term")
    sized = counts.withColumn("total", row_total(df))
    kept = sized.where((F.col("n_docs") >= min_df) & (F.col("n_docs") <= max_df * F.col("total")))
    idf = F.ln((F.lit(1.0) + F.col("total")) / (F.lit(1.0) + F.col("n_docs"))) + 1
    kept = kept.select("term", "count", "n_docs", idf.alias("idf"))
    if max_features is not None:
        kept = kept.orderBy(F.desc("count"), "term").limit(max_features)
    return kept


def with_index(vocabulary: DataFrame) -> DataFrame:
    """Number the terms of a size-limited vocabulary alphabetically."""
    return vocabulary.withColumn("index", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1).cast("int"))


def _counted(df: DataFrame, column: str, terms: list[str], ngrams: tuple[int, int], lowercase: bool) -> DataFrame:
    """``df`` with ``_i`` and ``_n``: the indices of the terms in each row's text and their counts."""
    c = F.col(column)
    rows = df.withColumn("_k", text.word_tokens(F.lower(c) if lowercase else c, 2))
    rows = rows.withColumn("_terms", F.coalesce(terms_of("_k", ngrams), F.array().cast("array<string>"))).drop("_k")
    counted = CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_tf").transform(rows)
    counts = F.unwrap_udt("_tf")
    return counted.select(*df.columns, counts["indices"].alias("_i"), counts["values"].alias("_n"))


def _weighted(counted: DataFrame, idf: list[float], sublinear: bool) -> DataFrame:
    """``_n`` becomes ``_w``, the L2-normalised weights."""
    table = F.split(F.lit(",".join(map(repr, idf))), ",").cast("array<double>")
    raw = F.zip_with("_i", "_n", lambda i, n: (F.ln(n) + 1 if sublinear else n) * F.get(table, i))
    rows = counted.withColumn("_w", raw)
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("_norm", norm)
    # As an array the norm is taken once a row; inside a lambda it would be taken again for every cell.
    norms = F.array_repeat(F.col("_norm"), F.size("_w"))
    return rows.withColumn("_w", F.zip_with("_w", norms, F.try_divide)).drop("_n", "_norm")


def weights(df: DataFrame, column: str, doc_id: str, vocabulary: DataFrame, ngrams: tuple[int, int] = (1, 2),
            sublinear: bool = True, lowercase: bool = False) -> DataFrame:
    """Long ``(doc_id, term, weight)`` rows, L2-normalised per document; one with NULLs
    for a document without a known term.

    A vocabulary of at most ``BROADCAST_ROWS`` terms is counted inside each row, so
    nothing is shuffled. A larger one is joined with the counts of each row, never with
    texts. Either way equal or missing ids do not matter.
    """
    known = vocabulary.select("term", "idf").limit(BROADCAST_ROWS + 1).collect()
    if 0 < len(known) <= BROADCAST_ROWS:
        known.sort(key=lambda r: r["term"])
        rows = _weighted(_counted(df.select(doc_id, column), column, [r["term"] for r in known], ngrams, lowercase),
                         [r["idf"] for r in known], sublinear)
        # Tokens are words and single spaces, so a line break parts the terms.
        names = F.split(F.lit("\n".join(r["term"] for r in known)), "\n")
        cells = rows.select(doc_id, F.explode_outer(F.arrays_zip(F.col("_i").alias("i"), F.col("_w").alias("w"))).alias("c"))
        return cells.select(doc_id, F.get(names, F.col("c.i")).alias("term"), F.col("c.w").alias("weight"))
    rows = cut_lineage(tokenised(df, column, doc_id, lowercase=lowercase).withColumn("_row", F.monotonically_increasing_id()))
    cells = _joined(rows, vocabulary, "term", ngrams, sublinear)
    return rows.select(doc_id, "_row").join(cells, "_row", "left").select(doc_id, "term", F.col("w").alias("weight"))


def _joined(rows: DataFrame, vocabulary: DataFrame, name: str, ngrams: tuple[int, int], sublinear: bool) -> DataFrame:
    """``(_row, name, w)``: weights of the known terms of each row by a join with the vocabulary, for any size of it.

    ``rows`` have a stored key ``_row`` and the tokens ``_k``, so rows without an id or with the same one stay apart.
    """
    raw = rows.select("_row", F.explode(terms_of("_k", ngrams)).alias("term")).groupBy("_row", "term").agg(F.count("*").alias("tf"))
    tf = (F.ln(F.col("tf").cast("double")) + 1) if sublinear else F.col("tf").cast("double")
    counts = raw.join(vocabulary, "term").select("_row", name, (tf * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("_row")))
    return counts.select("_row", name, F.try_divide("w", norm).alias("w"))


def transform(df: DataFrame, column: str, doc_id: str, vocabulary: DataFrame, **options) -> DataFrame:
    """Non-zero TF-IDF cells as ``(doc_id, term, weight)``."""
    return weights(df, column, doc_id, vocabulary, **options).where("weight IS NOT NULL")


def vectors(df: DataFrame, column: str, indexed: DataFrame, size: int, output: str = "tfidf", ngrams: tuple[int, int] = (1, 2),
            sublinear: bool = True, lowercase: bool = False) -> DataFrame:
    """``df`` with one sparse vector per row, empty without a known term.

    Up to ``BROADCAST_ROWS`` terms the vector is made inside the row: no key, join or
    exchange. A larger ``indexed`` is joined with the counts of each row, and a row's
    cells come back to it by a key of its own.
    """
    known = sorted(indexed.select("index", "term", "idf").limit(BROADCAST_ROWS + 1).collect())
    if len(known) > BROADCAST_ROWS:
        c = F.col(column)
        keyed = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        tokens = keyed.select("_row", text.word_tokens(F.lower(c) if lowercase else c, 2).alias("_k"))
        cells = _joined(tokens, indexed.select("term", "index", "idf"), "index", ngrams, sublinear)
        packed = cells.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("index", "w"))).alias("_cells"))
        rows = keyed.join(packed, "_row", "left")
        indices = F.coalesce(F.col("_cells.index"), F.array().cast("array<int>"))
        values = F.coalesce(F.col("_cells.w"), F.array().cast("array<double>"))
        return rows.withColumn(output, sparse_vector(F.lit(size), indices, values)).drop("_row", "_cells")
    if not known:
        return df.withColumn(output, sparse_vector(F.lit(size), F.array().cast("array<int>"), F.array().cast("array<double>")))
    rows = _weighted(_counted(df, column, [r["term"] for r in known], ngrams, lowercase), [r["idf"] for r in known], sublinear)
    return rows.withColumn(output, sparse_vector(F.lit(size), F.col("_i"), F.col("_w"))).drop("_i", "_w")


def matrix_statistics(df: DataFrame, cells: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Documents, vocabulary size, stored cells and density."""
    return cells.agg(F.count("*").alias("nnz")).select(
        row_total(df).alias("n_docs"), row_total(vocabulary).alias("vocabulary"), "nnz",
    ).select("*", F.try_divide(F.col("nnz").cast("double"), F.col("n_docs") * F.col("vocabulary")).alias("density"))


def extreme_idf(vocabulary: DataFrame, n: int = 30) -> DataFrame:
    """Rarest and most common terms by idf."""
    high = vocabulary.orderBy(F.desc("idf"), "term").limit(n).withColumn("side", F.lit("highest"))
    low = vocabulary.orderBy("idf", "term").limit(n).withColumn("side", F.lit("lowest"))
    return high.unionByName(low).select("side", "term", "n_docs", "idf")


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, mean, std)`` with the population standard deviation; a
    constant column gets 1."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e")).select("e.*")
    stats = long.groupBy("column").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    return stats.select("column", "mean", F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0)).alias("std"))


def apply_scaler(df: DataFrame, scaler: DataFrame | dict[str, tuple[float, float]], columns: list[str]) -> DataFrame:
    """Standardise with a fitted table (scalar look-ups) or plain numbers."""
    out = {}
    for c in columns:
        if isinstance(scaler, dict):
            mean, std = (F.lit(x) for x in scaler[c])
        else:
            row = scaler.where(F.col("column") == c)
            mean, std = row.select("mean").scalar(), row.select("std").scalar()
        out[c] = (F.col(c).cast("double") - mean) / std
    return df.withColumns(out)
