"""Embedding near-duplicates by product quantisation over inverted lists.

Equal vectors are one class from the start. Coarse centroids and, per subspace,
codewords of the residuals are fitted on a bounded sample; every class is then put
into the list of its nearest centroid as a code of one byte per subspace. Each
class searches the nearest lists: a table of distances to the
codewords gives the distance to a code by look-ups. ``PROBES`` grows with the
lists, whose number grows with the input: beyond ``MOST_LISTS`` coarse cells, all that
the bounded sample can fit, every cell is cut by one shared set of residual centres. How far a code lies from its vector is
stored, so by the triangle inequality a code that is too far rules its vector out for
certain; the others are compared by exact cosine in double precision. Only a pair
whose lists do not probe each other can be missed.

Lists are cut into blocks, and a list with many vectors into many, so a work item
is always one block of queries against one block of a list. It returns what it
counted per vector and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .components import connected_components

THRESHOLD = 0.9
#: Lists searched up to 64 lists, and how many more for every doubling.
PROBES, MORE_PROBES = 16, 4
#: Vectors per list aimed at, coarse cells at most, parts of a cell at most, vectors fitted on at most.
PER_LIST, MOST_LISTS, MOST_PARTS, SAMPLE = 200, 4096, 256, 65536
SUBSPACES, CODEWORDS = 8, 256
#: Vectors of a block.
BLOCK = 1024
#: Candidate pairs compared at once, and distances to parts of cells worked out at once.
PAIRS = 1 << 16
DISTANCES = 1 << 22


def probes_for(lists: int, probes: int = PROBES) -> int:
    """How many of ``lists`` are searched: the share of a neighbourhood that one list holds shrinks as lists get smaller."""
    return min(lists, probes + MORE_PROBES * max(0, math.ceil(math.log2(max(1, lists) / 64))))


@dataclass
class Index:
    """``cells`` (cells, dimension), ``shifts`` (parts, dimension) that cut every cell, ``codebooks`` one (codewords, width) per subspace.

    List ``cell * parts + part`` has its centre at the cell's plus the part's shift.
    """

    cells: np.ndarray
    shifts: np.ndarray
    codebooks: list[np.ndarray]

    @property
    def lists(self) -> int:
        return len(self.cells) * len(self.shifts)

    def centre(self, i):
        return self.cells[i // len(self.shifts)] + self.shifts[i % len(self.shifts)]

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` nearest lists of every row, the nearest first, among the parts of its ``probes`` nearest cells."""
        parts = len(self.shifts)
        step = max(1, DISTANCES // (min(probes, len(self.cells)) * parts))
        return np.concatenate([self._nearest(x[i:i + step], probes) for i in range(0, len(x), step)])

    def _nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        parts = len(self.shifts)
        cells = _smallest(_distances(x, self.cells), min(probes, len(self.cells)))
        if parts == 1:
            return cells
        residual = (x[:, None, :] - self.cells[cells]).reshape(-1, x.shape[1])
        far = _distances(residual, self.shifts).reshape(len(x), -1)
        best = _smallest(far, min(probes, far.shape[1]))
        return np.take_along_axis(cells, best // parts, axis=1) * parts + best % parts

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, np.cumsum([c.shape[1] for c in self.codebooks])[:-1], axis=1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1), 0)


def _smallest(far: np.ndarray, n: int) -> np.ndarray:
    """Columns of the ``n`` smallest values of every row, in their order."""
    near = np.argpartition(far, n - 1, axis=1)[:, :n]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm; an emptied cluster keeps its centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        counts = np.bincount(near, minlength=len(centres))
        order = np.argsort(near, kind="stable")
        used = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[used]
        centres[used] = np.add.reduceat(x[order], starts, axis=0) / counts[used, None]
    return centres


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codewords: int = CODEWORDS, most_cells: int = MOST_LISTS) -> Index:
    """Index of about ``lists`` lists from unit vectors (sample, dimension)."""
    x = sample.astype(np.float32)
    cells = kmeans(x, min(lists, most_cells))
    residual = x - cells[np.concatenate([_distances(x[i:i + 4096], cells).argmin(1) for i in range(0, len(x), 4096)])]
    parts = min(MOST_PARTS, -(-lists // most_cells))
    shifts = kmeans(residual, parts) if parts > 1 else np.zeros((1, x.shape[1]), dtype=np.float32)
    few = residual[:16384]
    few = few - shifts[_distances(few, shifts).argmin(1)]
    return Index(cells, shifts, [kmeans(p, codewords) for p in np.array_split(few, min(subspaces, x.shape[1]), axis=1)])


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by the largest component so that nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _encode(index: Index, probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = _unit(_matrix(pdf["v"])).astype(np.float32)
            near = index.nearest(x, probes)
            residual = x - index.centre(near[:, 0])
            codes = [_distances(r, c).argmin(1) for r, c in zip(index.parts(residual), index.codebooks)]
            quantised = np.concatenate([c[i] for c, i in zip(index.codebooks, codes)], axis=1)
            off = np.sqrt(((residual - quantised).astype(np.float64) ** 2).sum(1))
            packed = np.stack(codes, axis=1).astype(np.uint8)
            yield pd.DataFrame({"node": pdf["node"], "weight": pdf["weight"], "v": pdf["v"], "list": near[:, 0].astype(np.int32),
                                "probes": list(near.astype(np.int32)), "code": [c.tobytes() for c in packed], "off": off})

    return run


def _search(index_of, threshold: float):
    """Work items (a block of queries, a block of a list) to ``node, label, n``."""
    reach = np.sqrt(2 - 2 * threshold) + 1e-6

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = index_of.value
        for pdf in batches:
            for p, queries, base in zip(pdf["list"], pdf["queries"], pdf["base"]):
                x, y = _unit(_matrix(q["v"] for q in queries)), _unit(_matrix(b["v"] for b in base))
                codes = np.stack([np.frombuffer(b["code"], dtype=np.uint8) for b in base])
                limit = (reach + np.array([b["off"] for b in base])) ** 2
                total = np.zeros((len(x), len(y)), dtype=np.float32)
                for k, (r, c) in enumerate(zip(index.parts((x - index.centre(p)).astype(np.float32)), index.codebooks)):
                    total += _distances(r, c)[:, codes[:, k]]
                i, j = np.nonzero(total <= limit[None, :].astype(np.float32) + 1e-4)
                keep = np.concatenate([np.zeros(0, dtype=bool), *(
                    np.einsum("ij,ij->i", x[i[s:s + PAIRS]], y[j[s:s + PAIRS]]) >= threshold for s in range(0, len(i), PAIRS))])
                qn, bn = np.array([q["node"] for q in queries]), np.array([b["node"] for b in base])
                i, j = i[keep], j[keep]
                other = qn[i] != bn[j]
                i, j = i[other], j[other]
                if not len(i):
                    continue
                qw, bw = np.array([q["weight"] for q in queries]), np.array([b["weight"] for b in base])
                found = np.bincount(i, weights=bw[j], minlength=len(x))
                # The other end counts this link itself if it probes this end's list.
                home = np.array([q["home"] for q in queries])
                probes = np.stack([np.asarray(b["probes"]) for b in base])
                back = (probes[j] == home[i][:, None]).any(axis=1)
                met = np.bincount(j[~back], weights=qw[i[~back]], minlength=len(y))
                left, right = qn.copy(), bn.copy()
                while True:
                    least = np.minimum(left[i], right[j])
                    new_left, new_right = left.copy(), right.copy()
                    np.minimum.at(new_left, i, least)
                    np.minimum.at(new_right, j, least)
                    if (new_left == left).all() and (new_right == right).all():
                        break
                    left, right = new_left, new_right
                a, b = np.unique(i), np.unique(j)
                yield pd.DataFrame({"node": np.concatenate([qn[a], bn[b]]), "label": np.concatenate([left[a], right[b]]),
                                    "n": np.concatenate([found[a], met[b]]).astype(np.int64)})

    return run


def _links(classes: DataFrame, threshold: float, probes: int, per_list: int, block: int) -> DataFrame:
    """``node, label, n``: links counted at a node by some work item, and a node of the same component."""
    spark = classes.sparkSession
    lists = int(max(1, classes.count() // per_list))
    sample = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(min(SAMPLE, 64 * max(lists, CODEWORDS))).toPandas()
    index = fit(_unit(_matrix(sample["v"])), lists)
    probes = probes_for(index.lists, probes)
    kind = dict(classes.dtypes)["v"]
    coded = cut_lineage(classes.select("node", "weight", "v").mapInPandas(
        _encode(index, probes), f"node long, weight long, v {kind}, list int, probes array<int>, code binary, off double"))
    # One row per list: at most MOST_LISTS * MOST_PARTS, about a million.
    sizes = F.broadcast(coded.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    base = coded.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    base = base.groupBy("list", "block").agg(F.collect_list(F.struct("node", "weight", "v", "probes", "code", "off")).alias("base"))
    probing = coded.select("node", "weight", "v", F.col("list").alias("home"), F.explode("probes").alias("list"))
    asked = F.broadcast(coded.select(F.explode("probes").alias("list")).groupBy("list").agg(
        F.ceil(F.count("*") / block).cast("int").alias("parts")))
    queries = probing.join(asked, "list").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    queries = queries.groupBy("list", "part").agg(F.collect_list(F.struct("node", "weight", "v", "home")).alias("queries"))
    queries = queries.join(sizes, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    items = queries.join(base, ["list", "block"]).select("list", "queries", "base")
    shared = spark.sparkContext.broadcast(index)
    return items.mapInPandas(_search(shared, threshold), "node long, label long, n long")


def near_duplicates(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    probes: int = PROBES, per_list: int = PER_LIST, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows with a NULL or empty vector, one of only zeros, or one with a component that is
    NULL, NaN or infinite link with nothing. Vectors of different lengths do not link. Equal
    vectors link with each other; repeated rows are vectors of their own. NULL ids never name a
    component that has another id. Labels and other columns are not read.
    """
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = table.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("v"))
    rows = rows.withColumn("ok", v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda c: c != 0))
    rows = rows.withColumn("ok", F.coalesce("ok", F.lit(False)))
    classes = rows.where("ok").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    links = None
    for row in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect():
        found = _links(classes.where(F.size("v") == row["d"]), threshold, probes, per_list, block)
        links = found if links is None else links.union(found)
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if links is None:
        return alone.withColumn("kept", F.lit(True))
    links = cut_lineage(links)
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    labels = connected_components(links, "node", "label").select("node", F.col("component").alias("c"))
    known = classes.join(counts, "node", "left").join(labels, "node", "left").select(
        "v", "first", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("c", "node").alias("c"))
    known = cut_lineage(known)
    named = known.groupBy("c").agg(F.min("first").alias("component_id"))
    known = known.join(named, "c").select("v", "n_links", "component_id")
    linked = rows.where("ok").join(known, "v").select("vec_id", "n_links", "component_id")
    found = linked.union(alone)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
