"""Logistic regressions of several labels, fitted side by side over the same table.

Spark ML takes one label at a time: a fit standardises the table, stores a copy of it
and reads that copy in every iteration. Here the table is stored once, as blocks, and
one job an iteration gives loss and gradient of all labels that haven't ended. The
objective, its scaling and the steps (L-BFGS with 10 corrections, line search by the
strong Wolfe conditions, the ends of the search) are those of Spark ML's estimator with
an L2 penalty on unscaled features; sums come in another order.
"""

from __future__ import annotations

import pickle
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

#: Rows of a block; places of rows take two bytes.
BLOCK_ROWS = 2048
#: Columns with a value in more than this share of a block's rows are kept whole.
FULL = 0.5
#: Partitions from which on results of tasks are added before they reach the driver.
TREE_PARTS = 32
CORRECTIONS = 10

#: Columns by cell: their numbers, where each starts, places of rows and values.
Cells = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Rows, whole columns and their values by row, the other columns by cell, 0/1 by label and row.
Block = tuple[int, np.ndarray, np.ndarray, Cells, np.ndarray]
Search = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def _block(columns: np.ndarray, rows: np.ndarray, values: np.ndarray, y: np.ndarray) -> Block:
    n = y.shape[1]
    held = values != 0
    columns, rows, values = columns[held], rows[held], values[held]
    order = np.argsort(columns, kind="stable")
    rows, values = rows[order], values[order]
    names, counts = np.unique(columns, return_counts=True)

    def part(some: np.ndarray) -> Cells:
        cells = np.repeat(some, counts)
        return names[some], np.concatenate([[0], np.cumsum(counts[some])]), rows[cells].astype(np.uint16), values[cells]

    full = counts > FULL * n
    at, _, places, cells = part(full)
    whole = np.zeros((n, len(at)))
    whole[places, np.repeat(np.arange(len(at)), counts[full])] = cells
    return n, at, whole, part(~full), y


def _blocked(labels: int):
    """Arrow batches of vectors and labels to one pickled block a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                indices, values = part.column(0), part.column(1)
                sizes = values.value_lengths().to_numpy(zero_copy_only=False)
                flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                # A dense vector has no indices: its values stand at their places.
                within = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                sparse = np.repeat(indices.is_valid().to_numpy(zero_copy_only=False), sizes)
                columns = within
                columns[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
                y = np.array([part.column(2 + i).to_numpy(zero_copy_only=False) for i in range(labels)], dtype=np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_block(columns, rows, flat, y), protocol=5)], pa.binary())], names=["block"])

    return run


def _stored(data: DataFrame, labels: list[str], features: str) -> RDD:
    """The table as blocks, kept by the executors in memory and beyond that on disk."""
    v = F.unwrap_udt(features)
    rows = data.select(v["indices"].alias("i"), v["values"].alias("v"), *[
        F.col(c).cast("int").alias(f"_y{i}") for i, c in enumerate(labels)])
    blocks = rows.mapInArrow(_blocked(len(labels)), "block binary").rdd.map(lambda r: bytes(r[0]))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def _times(block: Block, by_row: np.ndarray, out: np.ndarray, square: bool = False) -> None:
    """Adds to ``out`` (label, column) the sums over rows of ``by_row`` (label, row) times the values."""
    _, full, whole, (names, starts, rows, values), _ = block
    out[:, full] += by_row @ (whole * whole if square else whole)
    if len(names):
        rows = rows.astype(np.intp)
        values = values * values if square else values
        for i in range(len(by_row)):
            out[i, names] += np.add.reduceat(values * by_row[i][rows], starts[:-1])


def _margins(block: Block, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n, full, whole, (names, starts, rows, values), _ = block
    out = weights[:, full] @ whole.T + offsets[:, None]
    if len(names):
        rows, counts = rows.astype(np.intp), np.diff(starts)
        for i in range(len(weights)):
            out[i] += np.bincount(rows, values * np.repeat(weights[i, names], counts), n)
    return out


def _added(a: list[np.ndarray] | None, b: list[np.ndarray] | None) -> list[np.ndarray] | None:
    return b if a is None else a if b is None else [x + y for x, y in zip(a, b)]


def _summed(blocks: RDD, each) -> list[np.ndarray]:
    """The sums over all blocks of the arrays ``each(block)`` gives."""

    def run(part: Iterator[bytes]) -> Iterator[list[np.ndarray] | None]:
        total = None
        for block in part:
            total = _added(total, each(pickle.loads(block)))
        yield total

    sums = blocks.mapPartitions(run)
    return sums.treeReduce(_added) if sums.getNumPartitions() > TREE_PARTS else sums.reduce(_added)


def _moments(blocks: RDD, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and sums of squares by column, over all rows and over each label's, and which columns are constant."""

    def each(block: Block) -> list[np.ndarray]:
        by_row = np.concatenate([np.ones((1, block[0])), block[-1]])
        sums, squares = np.zeros((2, len(by_row), size))
        _times(block, by_row, sums)
        _times(block, by_row, squares, square=True)
        return [sums, squares]

    def ends(part: Iterator[bytes]) -> Iterator[np.ndarray]:
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        for block in part:
            n, full, whole, (names, starts, _, values), _ = pickle.loads(block)
            least, most = np.zeros((2, size))
            least[full], most[full] = whole.min(axis=0, initial=np.inf), whole.max(axis=0, initial=-np.inf)
            if len(names):
                some = np.diff(starts) < n
                least[names], most[names] = np.minimum.reduceat(values, starts[:-1]), np.maximum.reduceat(values, starts[:-1])
                least[names[some]], most[names[some]] = np.minimum(least[names[some]], 0), np.maximum(most[names[some]], 0)
            low, high = np.minimum(low, least), np.maximum(high, most)
        yield np.array([low, -high])

    sums, squares = _summed(blocks, each)
    low, high = blocks.mapPartitions(ends).reduce(np.minimum)
    return sums, squares, low == -high


def _losses(blocks: RDD, at: list[int], weights: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
    """For the labels with the numbers ``at``: summed weighted loss, sum of its slopes in the margin, its gradient."""
    sent = blocks.context.broadcast((weights, offsets, classes))

    def each(block: Block) -> list[np.ndarray]:
        weights, offsets, classes = sent.value
        y = block[-1][at]
        margin = _margins(block, weights, offsets)
        row = np.where(y, classes[:, 1:], classes[:, :1])
        loss = (row * np.logaddexp(0.0, np.where(y, -margin, margin))).sum(axis=1)
        with np.errstate(over="ignore"):
            slope = row * (1.0 / (1.0 + np.exp(-margin)) - y)
        gradient = np.zeros_like(weights)
        _times(block, slope, gradient)
        return [loss, slope.sum(axis=1), gradient]

    try:
        return _summed(blocks, each)
    finally:
        sent.destroy()


class _Failed(Exception):
    """A step of the search that can't be taken."""


def _between(low: tuple[float, float, float], high: tuple[float, float, float]) -> float:
    """The minimum of the cubic through two ``(t, value, slope)``, kept off both ends."""
    (a, fa, da), (b, fb, db) = low, high
    d1 = da + db - 3 * (fa - fb) / (a - b)
    with np.errstate(invalid="ignore"):
        d2 = np.sqrt(np.float64(d1 * d1 - da * db))
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2)
    lowest, highest = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return lowest if t < lowest else highest if t > highest else float(t)


def _step(x: np.ndarray, value: float, gradient: np.ndarray, way: np.ndarray, t: float):
    """A step length by the strong Wolfe conditions; yields points, ends with ``(length, value, gradient)``."""
    begin = (0.0, value, float(gradient @ way))
    if begin[2] > 0:
        raise _Failed
    found = None

    def at(t: float):
        nonlocal found
        found = yield x + way * t
        return t, found[0], float(found[1] @ way)

    def zoom(low, high):
        for _ in range(10):
            c = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + 1e-4 * c[0] * begin[2] or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(begin[2]):
                    return c[0], *found
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Failed

    low = begin
    for i in range(10):
        c = yield from at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * begin[2] or c[1] >= low[1] and i > 0:
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(begin[2]):
            return c[0], *found
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low = c
        t *= 1.5
    raise _Failed


def _way(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The direction of L-BFGS; ``history`` has steps and changes of the gradient, the last first."""
    way, scale = gradient.copy(), 1.0
    if history:
        s, g = history[0]
        scale = (s @ g) / (g @ g)
        if not scale >= 0:
            raise _Failed
    parts = []
    for s, g in history:
        rho = s @ g
        part = (s @ way) / rho
        if np.isnan(part):
            raise _Failed
        parts.append((part, rho))
        way -= part * g
    way *= scale
    for (s, g), (part, rho) in reversed(list(zip(history, parts))):
        way += (part - (g @ way) / rho) * s
    return -way


def _search(x: np.ndarray, max_iter: int, tol: float) -> Search:
    """Yields points, takes their value and gradient, ends with the last point it reached."""
    value, gradient = yield x
    first, iteration, failed, history, seen = value, 0, False, [], [np.inf]
    while iteration < max_iter and not (
            len(seen) >= 2 and abs(value - max(seen)) <= tol * first or np.linalg.norm(gradient) <= max(tol * value, 1e-8)):
        try:
            with np.errstate(divide="ignore", invalid="ignore"):
                way = _way(gradient, history)
            t, new_value, new_gradient = yield from _step(x, value, gradient, way, 1.0 / np.linalg.norm(way) if iteration == 0 else 1.0)
            if t * np.linalg.norm(gradient) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            failed, history = True, []
            continue
        new = x + way * t
        history = [(new - x, new_gradient - gradient), *history][:CORRECTIONS]
        x, value, gradient, iteration, failed = new, new_value, new_gradient, iteration + 1, False
        seen = [*seen, value][-20:]
    return x


def fit(data: DataFrame, labels: list[str], sizes: dict[str, tuple[int, int]], balanced: bool, features: str = "features", C: float = 2.0,
        max_iter: int = 100, tol: float = 1e-5) -> dict[str, LogisticRegressionModel]:
    """A model for each of ``labels``, 0/1 columns that hold both. ``sizes`` has rows and positives of each.

    Deviations come from sums of squares, so a column's mean shouldn't be many
    orders above its deviation."""
    size = data.select(F.coalesce(F.unwrap_udt(features)["size"], F.size(F.unwrap_udt(features)["values"]))).first()[0]
    blocks = _stored(data, labels, features)
    try:
        sums, squares, constant = _moments(blocks, size)
        n = np.array([sizes[c] for c in labels], dtype=float)
        counts = np.stack([n[:, 0] - n[:, 1], n[:, 1]], axis=1)
        classes = n[:, :1] / (2.0 * counts) if balanced else np.ones_like(counts)
        total = (classes * counts).sum(axis=1)

        def weighted(by_label: np.ndarray) -> np.ndarray:
            return classes[:, :1] * (by_label[:1] - by_label[1:]) + classes[:, 1:] * by_label[1:]

        mean = weighted(sums) / total[:, None]
        free = total - (classes ** 2 * counts).sum(axis=1) / total
        spread = np.maximum(weighted(squares) - total[:, None] * mean ** 2, 0.0)
        variance = np.where(constant, 0.0, spread / np.where(free > 0, free, np.inf)[:, None])
        scale = np.divide(1.0, np.sqrt(variance), out=np.zeros_like(variance), where=variance > 0)
        penalty = scale ** 2 / (C * total)[:, None]

        def evaluated(at: list[int], points: np.ndarray) -> list[tuple[float, np.ndarray]]:
            inner, centre = points[:, :-1], scale[at] * mean[at]
            loss, slope, gradient = _losses(blocks, at, inner * scale[at], points[:, -1] - (inner * centre).sum(axis=1), classes[at])
            gradient = gradient * scale[at] - slope[:, None] * centre
            value = loss / total[at] + 0.5 * (penalty[at] * inner ** 2).sum(axis=1)
            both = np.concatenate([gradient / total[at][:, None] + penalty[at] * inner, (slope / total[at])[:, None]], axis=1)
            return list(zip(value.tolist(), both))

        searches = [_search(np.append(np.zeros(size), np.log(w[1] * c[1] / (w[0] * c[0]))), max_iter, tol) for w, c in zip(classes, counts)]
        asked, ended = {i: next(s) for i, s in enumerate(searches)}, {}
        while asked:
            at = list(asked)
            for i, answer in zip(at, evaluated(at, np.array([asked[i] for i in at]))):
                try:
                    asked[i] = searches[i].send(answer)
                except StopIteration as end:
                    ended[i] = end.value
                    del asked[i]
    finally:
        blocks.unpersist()
    return {c: _model(data, ended[i][:-1] * scale[i], float(ended[i][-1] - ended[i][:-1] @ (scale[i] * mean[i])), features)
            for i, c in enumerate(labels)}


def _model(data: DataFrame, coefficients: np.ndarray, intercept: float, features: str) -> LogisticRegressionModel:
    jvm = data.sparkSession._jvm
    kind = jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    name = jvm.org.apache.spark.ml.util.Identifiable.randomUID("logreg")
    made = kind(name, _py2java(data.sparkSession.sparkContext, Vectors.dense(coefficients)), intercept)
    return LogisticRegressionModel._from_java(made).setFeaturesCol(features)
