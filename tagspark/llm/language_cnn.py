"""Language identification by a byte convolutional network.

Filters of several widths slide over windows of ``WINDOW`` bytes; the largest
answer of each filter goes through a rectifier into a softmax over the
languages. A filter is a sum of one table row per byte, so a convolution is a
few table look-ups. The network is trained in numpy on the driver, on a sample
whose size is bounded by ``per_language`` documents of ``pieces`` windows each;
it is applied to every window of every text, and the windows' probabilities
are averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.joins import broadcast_if_small
from ..session import cut_lineage
from .rows import whole

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
UNKNOWN = "und"
#: Windows scored at once; their answers stay in the cache.
BLOCK = 64
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as rows of bytes, and how many each text has.

    Windows tile the text; the last one ends with it. A text shorter than a
    window is filled up with zero bytes.
    """
    padded = [t if len(t) >= WINDOW else t.ljust(WINDOW, b"\0") for t in texts]
    sizes = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    counts = -(-sizes // WINDOW)
    buffer = np.frombuffer(b"".join(padded), dtype=np.uint8)
    of = np.repeat(np.arange(len(padded)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    offset = np.minimum(nth * WINDOW, sizes[of] - WINDOW) + (np.cumsum(sizes) - sizes)[of]
    return np.lib.stride_tricks.sliding_window_view(buffer, WINDOW)[offset], counts


class ByteNet:
    """``tables``: weight of a byte at each place of each filter; then bias and output layer."""

    def __init__(self, languages: list[str], tables: np.ndarray, bias: np.ndarray, out: np.ndarray, out_bias: np.ndarray):
        self.languages, self.tables, self.bias, self.out, self.out_bias = languages, tables, bias, out, out_bias

    def answers(self, rows: np.ndarray) -> np.ndarray:
        """Filter answers at every position: (windows, positions, filters)."""
        reach = rows.shape[1] - len(self.tables) + 1
        index = rows.astype(np.intp)
        total = self.tables[0].take(index[:, :reach], axis=0)
        for k in range(1, len(self.tables)):
            total += self.tables[k].take(index[:, k:k + reach], axis=0)
        return total

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        found = np.empty((len(rows), len(self.languages)), dtype=np.float64)
        for i in range(0, len(rows), BLOCK):
            pooled = np.maximum(self.answers(rows[i:i + BLOCK]).max(axis=1) + self.bias, 0)
            z = (pooled @ self.out + self.out_bias).astype(np.float64)
            z = np.exp(z - z.max(axis=1, keepdims=True))
            found[i:i + BLOCK] = z / z.sum(axis=1, keepdims=True)
        return found


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 12, rate: float = 0.01,
          batch: int = 64, seed: int = 7) -> ByteNet:
    """Cross-entropy by Adam. Gradients reach only the positions that won the pooling."""
    rng = np.random.default_rng(seed)
    n, reach, f = max(WIDTHS), WINDOW - max(WIDTHS) + 1, FILTERS * len(WIDTHS)
    used = np.zeros((n, 1, f), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        used[:width, :, i * FILTERS:(i + 1) * FILTERS] = 1
    net = ByteNet(languages, (rng.normal(0, 0.3, (n, 256, f)) * used).astype(np.float32), np.zeros(f, dtype=np.float32),
                  rng.normal(0, 0.1, (f, len(languages))).astype(np.float32), np.zeros(len(languages), dtype=np.float32))
    parts = [net.tables, net.bias, net.out, net.out_bias]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    step = 0
    filters = np.arange(f)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            take = order[at:at + batch]
            x = rows[take]
            answers = net.answers(x)
            place = answers.argmax(axis=1)
            top = np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0] + net.bias
            pooled = np.maximum(top, 0)
            z = pooled @ net.out + net.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(take)), labels[take]] -= 1
            error /= len(take)
            back = (error @ net.out.T) * (top > 0)
            grad = np.zeros_like(net.tables)
            for k in range(n):
                byte = np.take_along_axis(x, place + k, axis=1)
                np.add.at(grad[k], (byte, np.broadcast_to(filters, byte.shape)), back)
            step += 1
            for p, g, (m, v) in zip(parts, (grad * used, back.sum(0), pooled.T @ error, error.sum(0)), state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def training_sample(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 400,
                    pieces: int = 4) -> DataFrame:
    """``lang, piece``: windows from anywhere in at most ``per_language`` documents a language.

    Documents are chosen by the hash of their text. How many a language has per
    range of hashes is counted first, so only those up to the range that holds the last
    one wanted are ever dealt out by language, and of them only pieces.
    """
    h = F.xxhash64(text)
    last = F.greatest(F.length(text) - F.lit(WINDOW), F.lit(0)) + 1
    cut = [F.substring(F.col(text), (F.pmod(F.xxhash64(F.col(text), F.lit(i)), last) + 1).cast("int"), F.lit(WINDOW)) for i in range(pieces)]
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), h.alias("h"), F.array(*cut).alias("pieces"))
    known = rows.select("lang", F.shiftright("h", 48).alias("range"))
    upto = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # At most 65,536 counts a language, one bound each.
    ranges = known.groupBy("lang", "range").agg(F.count("*").alias("held"))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0))).where(F.col("before") < per_language)
    bounds = cut_lineage(ranges.groupBy("lang").agg(F.max("range").alias("bound")))
    rows = rows.join(broadcast_if_small(bounds), "lang").where(F.shiftright("h", 48) <= F.col("bound")).drop("bound")
    first = Window.partitionBy("lang").orderBy("h", "pieces")
    rows = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    return rows.select("lang", "h", F.explode("pieces").alias("piece"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = 400, pieces: int = 4,
        **options) -> ByteNet | None:
    """A network for the languages of ``docs``; None without labelled texts that have a letter."""
    sample = training_sample(docs, text, lang, per_language, pieces).toPandas().sort_values(["lang", "h", "piece"])
    pieces_ = [p.encode()[:WINDOW] for p in sample["piece"]]
    keep = [i for i, p in enumerate(pieces_) if has_letter(p)]
    if not keep:
        return None
    langs = sample["lang"].to_numpy()[keep]
    languages = sorted(set(langs))
    rows, _ = windows([pieces_[i] for i in keep])
    return train(rows, np.array([languages.index(x) for x in langs]), languages, **options)


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
#: Bytes of text whose windows are made at once.
BATCH_BYTES = 1 << 22


def predict(text: Column, net: ByteNet | None) -> Column:
    """Struct of the likeliest language and its mean probability over all windows.

    NULL and texts without a letter are ``und`` with score 0, and so is every text
    if there is no network. Of equal languages the first by name is taken.
    """

    def score(texts: list[bytes | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
        at = 0
        while at < len(known):
            group, size = [], 0
            while at < len(known) and (not group or size + len(texts[known[at]]) <= BATCH_BYTES):
                group.append(known[at])
                size += len(texts[known[at]])
                at += 1
            rows, counts = windows([texts[i] for i in group])
            mean = np.add.reduceat(net.probabilities(rows), np.cumsum(counts) - counts, axis=0) / counts[:, None]
            best = mean.argmax(axis=1)
            for i, b, p in zip(group, best, mean.max(axis=1)):
                out[i] = (net.languages[b], min(float(p), 1.0))
        return out

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(score(batch.tolist()), columns=RESULT.names)

    return run(text.cast("binary"))


def remainder(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 3


def identify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    The network learns from the text and non-NULL language of rows whose id's
    CRC-32 leaves no remainder 1; rows with a NULL id are neither learned from
    nor held out. Repeated rows get equal results; other columns are not read.
    """
    net = fit(docs.where(remainder(id_column) != 1), text, lang)
    found = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(remainder(id_column) == 1, F.lit(False)).alias("held_out"),
                        predict(F.col(text), net).alias("r"))
    return found.select("doc_id", "held_out", "r.lang_pred", "r.score")


def keep_identified(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
                    min_score: float = 0.34) -> DataFrame:
    """Rows whose language is known with at least ``min_score``; all columns kept, whatever their names and types."""
    net = fit(docs.where(remainder(id_column) != 1), text, lang)
    r = predict(F.col(text), net)
    rows = docs.select(whole(docs), r.alias("r"))
    return rows.where((F.col("r.lang_pred") != UNKNOWN) & (F.col("r.score") >= min_score)).select("row.*")
