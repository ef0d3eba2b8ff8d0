"""Quality rules: fixed base rules and gradient-boosted trees over document statistics.

One pass over the texts gives every document a row of counts. Trees are fitted
to a bounded sample of labelled rows by second-order boosting over histograms:
a split on a constrained feature is allowed only where both sides keep to the
stated direction, and the middle of their values bounds everything below, so a
score never rises as such a feature grows. The fitted trees are flattened into
node arrays; scoring walks all trees of a batch at once, one level a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage

SYMBOLS = b"#*$%&|<>"
#: Base rules: fewer words fail, and so does a larger share (percent) of words in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: Words in a window that counts as repeated.
WINDOW = 3
#: Labelled rows the trees are fitted to at most, the smallest by a hash of the id.
TRAIN_ROWS = 20_000
#: Bytes counted at once, which bounds memory for any text.
BLOCK = 1 << 20

TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 64
#: Smoothing of a leaf's value, and the least second-order weight of a leaf.
SMOOTH, LEAST_WEIGHT = 1.0, 1.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower", "n_digits", "n_marks"]
#: Features of the trees and the direction a score may take as the feature grows (0: any).
FEATURES = {"log_words": 0, "word_length": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
            "distinct_share": 0, "words_per_line": 0, "upper_share": 0, "digit_share": 0, "mark_share": 0}


def _classes() -> np.ndarray:
    """256 x 6: white space, symbols, upper, lower, digits, other ASCII marks; continuation bytes are in none."""
    table = np.zeros((256, 6), dtype=np.int64)
    for code in range(128):
        c = bytes([code])
        kind = 0 if c.isspace() else 1 if c in SYMBOLS else 2 if c.isupper() else 3 if c.islower() else 4 if c.isdigit() else 5
        table[code, kind] = 1
    return table


CLASSES = _classes()


def repeated_words(ids: np.ndarray) -> int:
    """How many positions lie in a window of ``WINDOW`` words that occurs at least twice."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    key = ids[:n - WINDOW + 1]
    for j in range(1, WINDOW):
        # Names stay below n, so their products fit 64 bits for any text in memory.
        key = np.unique(key, return_inverse=True)[1] * np.int64(n) + ids[j:n - WINDOW + 1 + j]
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[name] > 1
    covered = np.zeros(n, dtype=bool)
    for j in range(WINDOW):
        covered[j:n - WINDOW + 1 + j] |= again
    return int(covered.sum())


def counts(text: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    data = np.frombuffer(text, dtype=np.uint8)
    histogram = np.zeros(256, dtype=np.int64)
    for i in range(0, len(data), BLOCK):
        histogram += np.bincount(data[i:i + BLOCK], minlength=256)
    space, symbols, upper, lower, digits, marks = (histogram @ CLASSES).tolist()
    characters = len(data) - int(histogram[0x80:0xC0].sum())
    words = text.split()
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), characters - space, symbols, len(lines) - len(set(lines)), repeated_words(ids), len(lines), len(names),
            upper, lower, digits, marks)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame(np.array([counts(t) for t in batch], dtype=np.int64).reshape(-1, len(COUNTS)), columns=COUNTS)


def document_counts(text: Column) -> Column:
    return _counts(text.cast("binary"))


def features(table: pd.DataFrame) -> np.ndarray:
    """Rows x ``FEATURES`` from columns ``COUNTS``; a share of nothing is 0."""
    c = {name: table[name].to_numpy(dtype=np.float64) for name in COUNTS}

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1.0)

    return np.column_stack([
        np.log1p(c["n_words"]), share(c["word_chars"], c["n_words"]), share(c["n_symbols"], c["n_words"]),
        share(c["n_dup_lines"], c["n_lines"]), share(c["n_repeat_words"], c["n_words"]), share(c["n_distinct"], c["n_words"]),
        share(c["n_words"], c["n_lines"]), share(c["n_upper"], c["n_upper"] + c["n_lower"]),
        share(c["n_digits"], c["word_chars"]), share(c["n_marks"], c["word_chars"])])


@dataclass(frozen=True)
class Forest:
    """All trees in one set of node arrays; a leaf is its own child on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the base and of one leaf per tree."""
        if not len(self.roots):
            return np.full(len(x), self.base)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.below[at], self.above[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


class _Grower:
    """Grows one tree after the other over binned features into shared node lists."""

    def __init__(self, bins: np.ndarray, edges: list[np.ndarray], directions: np.ndarray):
        self.bins, self.edges, self.directions = bins, edges, directions
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.below: list[int] = []
        self.above: list[int] = []
        self.value: list[float] = []

    def _node(self) -> int:
        i = len(self.feature)
        self.feature.append(0)
        self.threshold.append(np.inf)
        self.below.append(i)
        self.above.append(i)
        self.value.append(0.0)
        return i

    def _split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """The best allowed ``gain, feature, bin, value below, value above`` or None."""
        best = None
        whole_g, whole_h = g[rows].sum(), h[rows].sum()

        def gain(a, b, v):
            # The second-order loss at a value that the bounds may have moved off its optimum.
            return -(a * v + 0.5 * (b + SMOOTH) * v * v)

        stay = gain(whole_g, whole_h, np.clip(-whole_g / (whole_h + SMOOTH), low, high))
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = self.bins[rows, f]
            left_g = np.cumsum(np.bincount(b, g[rows], len(edges) + 1))[:-1]
            left_h = np.cumsum(np.bincount(b, h[rows], len(edges) + 1))[:-1]
            right_g, right_h = whole_g - left_g, whole_h - left_h
            left = np.clip(-left_g / (left_h + SMOOTH), low, high)
            right = np.clip(-right_g / (right_h + SMOOTH), low, high)
            allowed = (left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT) & (self.directions[f] * (right - left) >= 0)
            won = np.where(allowed, gain(left_g, left_h, left) + gain(right_g, right_h, right) - stay, -np.inf)
            i = int(np.argmax(won))
            if won[i] > 1e-9 and (best is None or won[i] > best[0]):
                best = (won[i], f, i, left[i], right[i])
        return best

    def grow(self, g: np.ndarray, h: np.ndarray) -> tuple[int, np.ndarray]:
        """The root of a new tree, and its value for every row."""
        root, fitted = self._node(), np.zeros(len(g))
        todo = [(root, np.arange(len(g)), 0, -np.inf, np.inf)]
        while todo:
            node, rows, depth, low, high = todo.pop()
            split = self._split(rows, g, h, low, high) if depth < DEPTH else None
            if split is None:
                value = float(np.clip(-g[rows].sum() / (h[rows].sum() + SMOOTH), low, high)) * RATE
                self.value[node] = value
                fitted[rows] = value
                continue
            _, f, i, left, right = split
            self.feature[node], self.threshold[node] = f, float(self.edges[f][i])
            self.below[node], self.above[node] = self._node(), self._node()
            inside = self.bins[rows, f] <= i
            middle = (left + right) / 2
            bounds = [(low, high), (low, high)]
            if self.directions[f] > 0:
                bounds = [(low, middle), (middle, high)]
            elif self.directions[f] < 0:
                bounds = [(middle, high), (low, middle)]
            todo.append((self.below[node], rows[inside], depth + 1, *bounds[0]))
            todo.append((self.above[node], rows[~inside], depth + 1, *bounds[1]))
        return root, fitted


def fit(x: np.ndarray, good: np.ndarray, trees: int = TREES, directions: list[int] | None = None) -> Forest:
    """Boosted trees of a 0/1 target. Without both classes the score is a constant."""
    directions = np.array(list(FEATURES.values()) if directions is None else directions)
    y = good.astype(np.float64)
    rate = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 1 - 1e-6
    base = float(np.log(rate / (1 - rate)))
    edges, bins = [], np.zeros(x.shape, dtype=np.int64)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        cut = (values[1:] + values[:-1]) / 2 if len(values) <= BINS else np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS))
        edges.append(cut)
        bins[:, f] = np.searchsorted(cut, x[:, f], side="left")
    grower, roots = _Grower(bins, edges, directions), []
    if 0 < y.sum() < len(y):
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-margin))
            root, fitted = grower.grow(p - y, p * (1 - p))
            roots.append(root)
            margin += fitted
    return Forest(np.array(roots, dtype=np.int64), np.array(grower.feature, dtype=np.int64), np.array(grower.threshold, dtype=np.float64),
                  np.array(grower.below, dtype=np.int64), np.array(grower.above, dtype=np.int64), np.array(grower.value, dtype=np.float64), base)


def measure(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row; a NULL text counts as empty."""
    rows = docs.select(F.col(id_column).alias("doc_id"), document_counts(F.col(text)).alias("c"))
    return rows.select("doc_id", "c.*")


def train(measured: DataFrame, labels: DataFrame, most_rows: int = TRAIN_ROWS) -> Forest:
    """Trees for ``quality`` of ``labels`` (1 good, 0 bad; the lesser of several), fitted to at most ``most_rows`` rows."""
    named = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = measured.join(named, "doc_id").withColumn("order", F.xxhash64("doc_id"))
    n = rows.count()
    if n > 2 * most_rows:
        # Each task would hand its own `most_rows` smallest to the driver. Most lie above a bound that leaves enough.
        bound = rows.agg(F.percentile_approx("order", 1.5 * most_rows / n, 10_000)).first()[0]
        below = rows.where(F.col("order") <= bound)
        rows = below if below.count() >= most_rows else rows
    rows = rows.orderBy("order", *COUNTS).limit(most_rows).toPandas()
    return fit(features(rows), rows["quality"].to_numpy(dtype=np.float64) > 0)


def scored(measured: DataFrame, forest: Forest) -> DataFrame:
    """``measured`` with ``score``, the probability of good quality."""

    @F.pandas_udf(T.DoubleType())
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.score(features(pd.DataFrame(dict(zip(COUNTS, columns))))))

    return measured.withColumn("score", score(*[F.col(c) for c in COUNTS]))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``score``, ``base_failed`` and ``kept``, one row per input row.

    Kept are rows that pass the base rules and score at least ``threshold``.
    NULL and empty texts and texts of white space have no words and fail; equal
    texts get equal rows. Without labels of both classes every score is the same,
    and is that of good quality where there are none at all. An empty table gives
    no rows; further columns are not read.
    """
    measured = cut_lineage(measure(docs))
    rows = scored(measured, train(measured, labels)).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
