"""Document fingerprints from closed syncmers, with DataFrame functions only.

A k-mer is ``K`` consecutive words, its inner substrings are the pairs of
neighbouring words in it. It is an anchor when the smallest pair by hash is its
first or its last one, which depends on the k-mer alone: a passage has the same
anchors wherever it stands. A fingerprint is the anchors' hashes in text order.

Neighbouring documents are brought together by range buckets of the id. The
first document of a bucket also visits the bucket before, so no window ever
spans more than one bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 8
S = 2
#: Documents in a range bucket, as long as there are no more than MOST_BUCKETS.
BUCKET_ROWS = 500
MOST_BUCKETS = 1 << 16


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _short(value: Column) -> Column:
    """The upper 32 bits, unsigned."""
    return F.shiftrightunsigned(value, 32)


def anchors(text: Column, k: int = K) -> Column:
    """``array<struct<position, hash>>`` of the closed syncmers of a text, in order.

    Positions count words from 1. A text without an anchor has one at 1 made of
    all its words; a text without words has none.
    """

    def of_words(w: Column) -> Column:
        n = F.size(w)
        pairs = F.transform(F.slice(w, 2, F.greatest(n - 1, F.lit(0))), lambda x, i: F.xxhash64(w[i], x))
        whole = F.array(F.struct(F.lit(1).alias("position"), _short(F.xxhash64(w)).alias("hash")))

        def of_pairs(h: Column) -> Column:
            last = k - S

            def closed(i: Column) -> Column:
                least = F.array_min(F.slice(h, i, last + 1))
                return (least == h[i - 1]) | (least == h[i - 1 + last])

            places = F.filter(F.sequence(F.lit(1), n - k + 1), closed)
            return F.transform(places, lambda i: F.struct(
                i.alias("position"), _short(F.xxhash64(*[h[i - 1 + j] for j in range(0, last + 1, S)])).alias("hash")))

        found = F.when(n >= k, _let(pairs, of_pairs))
        return F.when(n == 0, F.slice(whole, 1, 0)).otherwise(
            _let(found, lambda x: F.when(F.coalesce(F.size(x), F.lit(0)) > 0, x).otherwise(whole)))

    return _let(words(text), of_words)


def hashes(text: Column, k: int = K) -> Column:
    """Hashes of the anchors, in order."""
    return anchors(text, k)["hash"]


def written(values: Column) -> Column:
    """Eight hex digits per anchor."""
    return F.array_join(F.transform(values, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over all anchors of two fingerprints; 1 if neither has any."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _bounds(docs: DataFrame, id_column: str, bucket_rows: int) -> list[int]:
    """Ids that part the documents into buckets of like size; at most ``MOST_BUCKETS``."""
    n = min(MOST_BUCKETS, docs.count() // bucket_rows)
    if n < 2:
        return []
    at = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx(id_column, at, max(10_000, 8 * n)).alias("b")).first()["b"]
    return sorted(set(found or []))


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds do not exceed the value, by bisection; NULL counts as below all."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]

    def step(at: Column, size: Column) -> Column:
        to = at + size
        inside = to <= F.lit(len(bounds))
        below = F.element_at(table, F.when(inside, to).otherwise(F.lit(1))) <= value
        return F.when(inside & F.coalesce(below, F.lit(False)), to).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, Window]:
    """``doc_id, text, guest, bucket, tie`` and the window in which the next row is the next document.

    Documents go by descending id, NULL last, equal ids by the hash of the
    text; after the last comes the first. Guests are copies that only lend
    their text to the bucket before and are to be dropped after the window.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn(
        "bucket", _bucket(F.col("doc_id"), _bounds(docs.select(id_column), id_column, bucket_rows)))
    # One row per bucket: its first document, and the bucket it visits.
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("tie")))
    heads = rows.groupBy("bucket").agg(first.alias("head"))
    everywhere = Window.partitionBy()
    above = F.min("bucket").over(Window.orderBy("bucket").rowsBetween(1, 1))
    heads = heads.select("head", F.coalesce(above, F.min("bucket").over(everywhere)).alias("visits")).select(
        F.col("head.doc_id").alias("head_id"), F.col("head.tie").alias("head_tie"), "visits")
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    spots = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")))
    visit = F.array(F.struct(F.col("visits").alias("bucket"), F.lit(True).alias("guest")))
    placed = rows.join(F.broadcast(heads), same, "left").select(
        "doc_id", "text", "tie", F.explode(F.when(F.col("visits").isNull(), spots).otherwise(F.concat(spots, visit))).alias("spot"))
    placed = placed.select("doc_id", "text", "tie", "spot.bucket", "spot.guest")
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return placed, order


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. In the edited form the last third of the text is replaced by as
    many first characters of the next document. NULL texts count as empty; repeated
    rows are documents of their own; other columns are not read.
    """
    placed, order = with_next(docs, id_column, text, bucket_rows)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    rows = placed.withColumn("next", F.lead("text").over(order)).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.coalesce("next", F.lit("")), F.lit(1), third)))
    rows = rows.select("doc_id", "bucket", "guest", "tie", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       hashes(F.col("text")).alias("a"), hashes(F.col("edited")).alias("e"))
    rows = rows.withColumn("b", F.lead("a").over(order)).where("NOT guest")
    return rows.select("doc_id", "n_chars", "edited_sha256", written(F.col("a")).alias("fingerprint"),
                       written(F.col("e")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("e")).alias("near_edited"),
                       likeness(F.col("a"), F.col("b")).alias("near_next"))
