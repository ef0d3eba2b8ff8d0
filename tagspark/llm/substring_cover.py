"""Substring de-duplication with difference-cover anchors.

Two equal passages of ``length`` words at positions p and q need not be aligned
to anything, but for any q - p the cover has two members with that difference
modulo ``PERIOD``: shifted by less than a period, both positions fall on the cover.
So words are hashed ``length - PERIOD + 1`` at a time at cover positions only (5 of
21), and every repeated passage contains an anchor that is repeated.

1. Anchors are counted by hash. A batch of documents sends each hash once and marks
   the others as repeated, so a hash in a third of all documents stays small.
2. Around repeated anchors the match is extended: every window of ``length`` words
   that contains one is hashed whole, and windows are counted.
3. A window that contains a repeated anchor and is not unique is repeated. Only the
   few unique ones travel back; the words the others cover are removed.

Hashes have 64 bits; anchors and windows use different ones. Texts meet what was found
about them under a 64-bit hash of id and text, and travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

LENGTH = 35
PERIOD = 21
#: A perfect difference set: every difference modulo 21 occurs.
COVER = (3, 6, 7, 12, 14)
#: Words worked on at once (one longer text alone).
BLOCK = 1 << 20
#: Distinct words a task remembers at most; then it starts anew.
MEMO = 1_000_000
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _rolling(hashes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``hash * base**i`` before every position, and the inverse powers."""
    n = len(hashes)
    power = np.full(n + 1, base, dtype=np.uint64)
    power[0] = 1
    inverse = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * np.cumprod(power)[:n], out=sums[1:])
    return sums, np.cumprod(inverse)


def _windows(rolling: tuple[np.ndarray, np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    sums, inverse = rolling
    return (sums[at + length] - sums[at]) * inverse[at]


def _groups(texts: list[bytes | None], memo: _Hashes) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """``rows, hashes, sizes``: batches of whole documents of about ``BLOCK`` words."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        hashes = memo.of(text.split()) if text else np.empty(0, dtype=np.uint64)
        if size and size + len(hashes) > BLOCK:
            yield rows, np.concatenate(parts), np.array([len(p) for p in parts])
            rows, parts, size = [], [], 0
        rows.append(i)
        parts.append(hashes)
        size += len(hashes)
    if rows:
        yield rows, np.concatenate(parts), np.array([len(p) for p in parts])


def _firsts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal keys: places of the first ones, whether more follow, places of the others."""
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[order][1:] != key[order][:-1]
    more = np.append(~new[1:], False)[:len(new)]
    return order[new], more[new], order[~new]


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and position of every word."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return doc, np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _cover(pos: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Places of the anchors: cover positions with enough words behind them."""
    return np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[pos % PERIOD] & (pos + length - PERIOD + 1 <= size))


def _anchors(length: int):
    """Rows ``key, row, x``. A hash goes out once per batch as its own key, x telling whether it
    repeats there; its other rows go anywhere, with the hash in x: they are repeated for certain."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _Hashes()
        for pdf in batches:
            ids = pdf["row"].to_numpy()
            for rows, hashes, sizes in _groups(pdf["text"].tolist(), memo):
                doc, pos = _places(sizes)
                at = _cover(pos, sizes[doc], length)
                h = _windows(_rolling(hashes, BASES[0]), at, length - PERIOD + 1)
                row = ids[np.array(rows)[doc[at]]]
                first, more, others = _firsts(h)
                spread = (h[others] ^ row[others].view(np.uint64)) * np.uint64(BASES[1]) + at[others].astype(np.uint64)
                yield pd.DataFrame({"key": np.concatenate([h[first], spread]).view(np.int64), "row": row[np.concatenate([first, others])],
                                    "x": np.concatenate([more.astype(np.int64), h[others].view(np.int64)])})

    return run


def _candidates(hashes: np.ndarray, repeated: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of one text that contain a repeated anchor, and their hashes."""
    n = len(hashes)
    pos = np.arange(n)
    at = _cover(pos, n, length)
    at = at[np.isin(_windows(_rolling(hashes, BASES[0]), at, length - PERIOD + 1), repeated)]
    step = np.zeros(max(n - length + 1, 0) + 1, dtype=np.int64)
    lo, hi = np.maximum(at - PERIOD + 1, 0), np.minimum(at, n - length) + 1
    fit = lo < hi
    np.add.at(step, lo[fit], 1)
    np.add.at(step, hi[fit], -1)
    starts = np.flatnonzero(np.cumsum(step)[:-1] > 0)
    return starts, _windows(_rolling(hashes, BASES[1]), starts, length)


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, dtype=np.int64).view(np.uint64)


def _extend(length: int):
    """Rows ``h, row, more``: the window hashes of a batch, each once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _Hashes()
        unpack = zstandard.ZstdDecompressor().decompress
        for pdf in batches:
            parts, sizes = [np.empty(0, dtype=np.uint64)], [0]
            ids = pdf["row"].to_numpy()

            def flush():
                h = np.concatenate(parts)
                first, more, _ = _firsts(h)
                return pd.DataFrame({"h": h[first].view(np.int64), "row": np.repeat(owners, sizes)[first], "more": more})

            owners = [0]
            for row, packed, anchors in zip(ids.tolist(), pdf["packed"], pdf["anchors"]):
                _, found = _candidates(memo.of(unpack(packed).split()), _unsigned(anchors), length)
                parts.append(found)
                sizes.append(len(found))
                owners.append(row)
                if sum(sizes) > BLOCK:
                    yield flush()
                    parts, sizes, owners = [np.empty(0, dtype=np.uint64)], [0], [0]
            yield flush()

    return run


def _remove(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _Hashes()
        unpack = zstandard.ZstdDecompressor().decompress
        for pdf in batches:
            total, removed, kept = [], [], []
            for packed, anchors, unique in zip(pdf["packed"], pdf["anchors"], pdf["uniques"]):
                text = unpack(packed)
                words = text.split()
                gone = 0
                if anchors is not None:
                    at, h = _candidates(memo.of(words), _unsigned(anchors), length)
                    if unique is not None:
                        at = at[~np.isin(h, _unsigned(unique))]
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    step[at] += 1
                    step[at + length] -= 1
                    stay = np.cumsum(step)[:-1] == 0
                    gone = len(words) - int(stay.sum())
                    if gone:
                        text = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
                total.append(len(words))
                removed.append(gone)
                kept.append(text.decode("utf-8", "replace"))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": total, "n_removed": removed, "kept": kept})

    return run


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for pdf in batches:
        pdf["packed"] = [pack(b" ".join(t.split()) if t else b"") for t in pdf.pop("text")]
        yield pdf


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without its repeated passages.

    Words are runs of other than ASCII white space. A word goes if some window of ``length``
    words over it starts anywhere else as well, in the same text or another; all windows are
    judged on the input. ``kept`` is what stays, joined by one space. NULL and empty texts have
    no words. Rows with equal ids, or none, are documents of their own unless their
    texts are equal too: then all have the same result. Other columns are not read.
    """
    if length < PERIOD:
        raise ValueError(f"length must be at least {PERIOD}")
    # As text an id survives pandas even where others are NULL.
    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.xxhash64(id_column, text, F.col(id_column).isNull()).alias("row"),
                       F.col(text).cast("binary").alias("text"))

    anchors = rows.select("row", "text").mapInPandas(_anchors(length), "key long, row long, x long")
    times = F.sum(F.when(F.col("x") == 0, 1).otherwise(2)).over(Window.partitionBy("key"))
    h = F.when(F.col("x").isin(0, 1), F.col("key")).otherwise(F.col("x"))
    repeated = anchors.withColumn("n", times).where("n > 1").select("row", h.alias("h"))
    repeated = cut_lineage(repeated.groupBy("row").agg(F.collect_set("h").alias("anchors")))

    packed = rows.mapInPandas(_pack, "doc_id string, row long, packed binary")
    near = packed.select("row", "packed").join(repeated, "row")
    windows = near.mapInPandas(_extend(length), "h long, row long, more boolean")
    times = F.sum(F.when(F.col("more"), 2).otherwise(1)).over(Window.partitionBy("h"))
    unique = windows.withColumn("n", times).where("n = 1").groupBy("row").agg(F.collect_list("h").alias("uniques"))

    found = packed.join(repeated, "row", "left").join(unique, "row", "left").select("doc_id", "packed", "anchors", "uniques").mapInPandas(
        _remove(length), "doc_id string, n_words long, n_removed long, kept string")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_column].dataType))
