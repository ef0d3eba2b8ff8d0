"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits; two texts are near when theirs differ in at most
``radius`` bits. Every bit position gets a non-zero vector of ``radius + 1``
bits. Table v of the ``2**(radius + 1) - 1`` tables keeps the positions whose
vector has an odd product with v. For up to ``radius`` differing positions some
v is orthogonal to all their vectors: that table masks every difference out, so
the pair shares a bucket there for certain.

A bucket with more than ``BUCKET`` distinct fingerprints is dealt again by the
same rule over the positions its mask left out. Three levels leave at most
eight free positions, so no bucket compared holds more than 256 fingerprints,
whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .components import connected_components
from .rows import content_hash, whole

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SHINGLE = 3
RADIUS = 3
#: Distinct fingerprints a bucket may hold before it is dealt again.
BUCKET = 128
LEVELS = 3
#: Shingles whose bits are counted at once, which bounds memory for any text.
BLOCK = 1 << 16


def shingle_hashes(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of every shingle, repeats included."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, 42)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-width])).tolist()
    stops = (ends[width - 1:] - 1).tolist()
    return np.fromiter((digest(joined[i:j], 42) for i, j in zip(starts, stops)), dtype=np.uint64, count=len(stops))


def simhash(hashes: np.ndarray) -> int:
    """A bit is set when it is set in over half of the hashes; signed 64 bits."""
    n = len(hashes)
    if n == 0:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, BLOCK):
        part = hashes[i:i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([simhash(shingle_hashes(t)) for t in batch], dtype="int64")


def fingerprint(text: Column) -> Column:
    """64-bit fingerprint of a text; NULL and texts without words give zero."""
    return _fingerprint(text.cast("binary"))


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them escape some mask together."""
    vectors = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = 0
        for j, position in enumerate(positions):
            if bin((j % vectors + 1) & v).count("1") % 2:
                mask |= 1 << position
        masks.append(mask)
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_levels(radius: int = RADIUS, levels: int = LEVELS) -> list[list[tuple[int, int, int]]]:
    """Per level ``(parent number, number, mask)``; the masks of a child contain its parent's."""
    out, parents = [], [(0, 0)]
    for _ in range(levels):
        rows: list[tuple[int, int, int]] = []
        for parent, mask in parents:
            free = [p for p in range(64) if not mask >> p & 1]
            rows += [(parent, 0, mask | m) for m in covering_masks(free, radius)]
        rows = [(p, i, m) for i, (p, _, m) in enumerate(rows)]
        out.append(rows)
        parents = [(i, m) for _, i, m in rows]
    return out


def _compare(radius: int):
    """Buckets (arrays of distinct fingerprints) to a spanning forest of their links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out_a, out_b = [], []
            for bucket in batch["fps"]:
                x = np.sort(np.asarray(bucket, dtype=np.int64))
                near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= radius
                todo = np.ones(len(x), dtype=bool)
                while todo.any():
                    front = [int(np.argmax(todo))]
                    todo[front[0]] = False
                    while front:
                        i = front.pop()
                        new = np.flatnonzero(near[i] & todo)
                        todo[new] = False
                        front += new.tolist()
                        out_a += [x[i]] * len(new)
                        out_b += x[new].tolist()
            yield pd.DataFrame({"a": np.array(out_a, dtype=np.int64), "b": np.array(out_b, dtype=np.int64)})

    return run


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between the distinct values of ``fp`` that connect all near fingerprints.

    Every link joins two fingerprints within the radius, and any two within
    it are connected by links. A bucket yields a spanning forest, never all pairs.
    """
    spark = fps.sparkSession
    levels = mask_levels(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(_signed(m)).alias("m")) for _, i, m in levels[0]])
    rows = fps.select("fp", F.explode(tables).alias("x")).select(
        F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp")
    links = None
    for level in range(LEVELS):
        sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
        hit = cut_lineage(rows.join(sizes, ["t", "key"]))
        last = level == LEVELS - 1
        small = hit if last else hit.where(F.col("n") <= bucket)
        found = small.groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select("fps").mapInPandas(
            _compare(radius), "a long, b long")
        links = found if links is None else links.union(found)
        hot = hit.where(F.col("n") > bucket)
        if last or hot.isEmpty():
            break
        children = spark.createDataFrame(
            [(p, i, _signed(m)) for p, i, m in levels[level + 1]], "t int, child int, mask long")
        rows = hot.join(F.broadcast(children), "t").select(
            F.col("child").alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    return links


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, row_hash, fp, component_id, representative``, one row per input row.

    ``component_id`` is the smallest id reachable over links. A NULL text has
    fingerprint zero, which links like any other; rows with a NULL id belong to
    their component but never name it while it has another id. ``row_hash`` tells
    rows with the same id apart: (id, row_hash) of one row of every component
    equals its ``representative``; identical rows share it. Other columns are not read.
    """
    prints = cut_lineage(docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text)).alias("row_hash"), fingerprint(F.col(text)).alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")
    fps = cut_lineage(prints.groupBy("fp").agg(F.min(order).alias("first")))
    labels = connected_components(near_links(fps.select("fp"), radius, bucket))
    named = fps.join(labels, fps["fp"] == labels["node"], "left").select(
        fps["fp"], "first", F.coalesce("component", fps["fp"]).alias("component"))
    named = cut_lineage(named)
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    of_print = named.select("fp", "component").join(heads, "component").select("fp", "head")
    return prints.join(of_print, "fp").select(
        "doc_id", "row_hash", "fp", F.col("head.doc_id").alias("component_id"),
        F.struct("head.doc_id", "head.row_hash").alias("representative"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of every near-duplicate group, all columns kept, whatever their names and types.

    The row with the smallest id stays (NULL ids last, then the smaller text
    hash); of identical rows one stays.
    """
    groups = near_duplicates(docs, id_column, text, radius)
    kept = groups.groupBy("representative").agg(F.lit(1).alias("one")).select(
        F.col("representative.doc_id").alias("kept_id"), F.col("representative.row_hash").alias("kept_hash"))
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("hash"), content_hash(docs).alias("content"), whole(docs))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    order = Window.partitionBy("id", "hash").orderBy("content")
    return rows.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
