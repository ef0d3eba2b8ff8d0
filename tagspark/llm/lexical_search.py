"""Ranked lexical search: MaxScore over blocks of documents, tightened by bounds on pairs of terms.

The index is cut by documents. A block holds whole documents, inverted into one
list per term. Beside the lists stand intersection lists of stated term pairs:
the block's documents that hold both terms, and the greatest sum of impacts
among them. The greatest score that a pair's two terms can add in a block is
then the larger of either term alone and both together, often far below the sum
of their maxima, as rare terms seldom meet.

Queries run against every block. An item's terms are taken as units, pairs where
one is stored, and ordered by bound; while the bounds of the least units add up
to less than the score to beat, their lists open no candidates. Candidates are
dropped as soon as what is open can't lift them to it. The score to beat starts
from the pair lists of all blocks: the k-th largest joint maximum of an item's
pair over the blocks belongs to k different documents. Nothing is dropped that
could reach the first k, equal scores included.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from ..session import cut_lineage, shared_path

K = 20
#: Documents and postings of a block at most (a single document may exceed the latter).
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
#: Items answered by one index, and bytes of their texts unless a single one has more.
BATCH_ITEMS = 1024
BATCH_BYTES = 4 << 20

#: White space for every byte outside terms, small letters for A-Z, all other bytes as they are.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

#: A block: ids and lengths of its documents, per term where its list starts, places of documents and counts.
BLOCK = pa.schema([("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
                   ("starts", pa.list_(pa.int32())), ("places", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
#: Its pair lists: numbers of the pairs that meet, their joint maxima, where their lists start, places of documents.
PAIRED = pa.schema([*BLOCK, ("pairs", pa.list_(pa.int32())), ("joint", pa.list_(pa.int64())),
                    ("meets", pa.list_(pa.int32())), ("met", pa.list_(pa.int32()))])
DDL = {pa.list_(pa.int64()): "array<long>", pa.list_(pa.int32()): "array<int>"}
Batches = Iterator[pa.RecordBatch]
#: Two terms and how often an item repeats each.
Pair = tuple[int, int, int, int]
Lists = dict[int, tuple[np.ndarray, np.ndarray]]


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {DDL[f.type]}" for f in schema)


def _one(schema: pa.Schema, values: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values[f.name]], type=f.type) for f in schema], schema=schema)


def _stored(blocks: DataFrame, name: str, schema: pa.Schema) -> DataFrame:
    """Blocks written one to a file and read again. A file's rows are decoded together, up to thousands
    at once, so a task over many blocks in one file would hold all of them in memory."""
    spark = blocks.sparkSession
    path = shared_path(spark, name)
    blocks.write.option("maxRecordsPerFile", 1).parquet(path)
    return spark.read.schema(_ddl(schema)).parquet(path)


def _blocks(batches: Batches) -> Iterator[dict[str, np.ndarray]]:
    """The rows of stored blocks, all but the ids as numpy arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].values if name == "docs" else column[i].values.to_numpy(zero_copy_only=False)
                   for name, column in zip(batch.schema.names, batch.columns)}


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a whole text in order: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What occurrences add before the term's weight, in 64-bit integers."""
    m = 75 + (25 * length * n_docs) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass(frozen=True)
class Statistics:
    n_docs: int
    total: int
    #: By term number.
    weights: np.ndarray


def _inverted(rows: list[tuple[int | None, int, list[int], list[int]]]) -> pa.RecordBatch:
    """One block from documents ``(id, length, term numbers, counts)``; lists ascend by place."""
    term = np.array([t for r in rows for t in r[2]], dtype=np.int32)
    tf = np.array([c for r in rows for c in r[3]], dtype=np.int32)
    place = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
    order = np.argsort(term, kind="stable")
    names, starts = np.unique(term[order], return_index=True)
    return _one(BLOCK, {"docs": [r[0] for r in rows], "lengths": [r[1] for r in rows], "terms": names,
                        "starts": np.append(starts, len(term)), "places": place[order], "tfs": tf[order]})


def _invert(vocabulary: dict[bytes, int], most_docs: int) -> Callable[[Batches], Batches]:
    """Documents to blocks. A document without a term of the vocabulary still counts with its length."""

    def run(batches: Batches) -> Batches:
        held: list[tuple[int | None, int, list[int], list[int]]] = []
        postings = 0
        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text")):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = {vocabulary[w]: c for w, c in Counter(words).items() if w in vocabulary}
                held.append((key.as_py(), len(words), list(found), list(found.values())))
                postings += len(found)
                if len(held) >= most_docs or postings >= BLOCK_POSTINGS:
                    yield _inverted(held)
                    held, postings = [], 0
        if held:
            yield _inverted(held)

    return run


def _lists(block: dict[str, np.ndarray], known: Statistics) -> Lists:
    """Per term the places of its documents and their impacts times the term's weight."""
    places = block["places"].astype(np.int64)
    score = impacts(block["tfs"].astype(np.int64), block["lengths"][places], known.n_docs, known.total)
    ends = block["starts"].tolist()
    return {t: (places[a:b], score[a:b] * known.weights[t]) for t, a, b in zip(block["terms"].tolist(), ends, ends[1:])}


def _intersect(pairs: list[Pair], known: Statistics) -> Callable[[Batches], Batches]:
    """Adds to every block the intersection lists of ``pairs``."""

    def run(batches: Batches) -> Batches:
        for block in _blocks(batches):
            lists = _lists(block, known)
            names, joint, met, meets = [], [], [], [0]
            for number, (a, b, times_a, times_b) in enumerate(pairs):
                if a not in lists or b not in lists:
                    continue
                both, at_a, at_b = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
                if len(both):
                    names.append(number)
                    joint.append((times_a * lists[a][1][at_a] + times_b * lists[b][1][at_b]).max())
                    met.append(both)
                    meets.append(meets[-1] + len(both))
            yield _one(PAIRED, {**block, "pairs": names, "joint": joint, "meets": meets,
                                "met": np.concatenate(met) if met else np.empty(0, dtype=np.int32)})

    return run


@dataclass(frozen=True)
class Item:
    """A query: its key, its terms with their repeats, its pairs by number, and the terms in no pair."""

    key: str
    times: dict[int, int]
    pairs: list[tuple[int, int, int]]
    single: list[int]


def choose_pairs(times: dict[int, int], weights: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """Neighbours by falling weight, so that the rarest, which seldom meet, are paired; what is left over stays single."""
    order = sorted(times, key=lambda t: (-times[t] * int(weights[t]), t))
    even = len(order) // 2 * 2
    return list(zip(order[0:even:2], order[1:even:2])), order[even:]


def search_block(item: Item, lists: Lists, top: dict[int, int], pair_lists: dict[int, tuple[int, np.ndarray]], size: int,
                 to_beat: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the block's documents that score at least ``to_beat`` and above 0.

    ``top`` has a term's greatest weighted impact, ``pair_lists`` a pair's joint maximum and documents.
    """
    to_beat = max(to_beat, 1)
    units = []
    for t in item.single:
        alone = item.times[t] * top.get(t, 0)
        units.append((alone, alone, (t,), -1, 0))
    for number, a, b in item.pairs:
        alone = max(item.times[a] * top.get(a, 0), item.times[b] * top.get(b, 0))
        joint = pair_lists[number][0] if number in pair_lists else 0
        units.append((max(alone, joint), alone, (a, b), number, joint - alone if joint else 0))
    units = sorted(u for u in units if u[0] > 0)
    bounds = np.cumsum([u[0] for u in units], dtype=np.int64)
    # Units before `first` don't reach the score together: they open no candidates.
    first = int(np.searchsorted(bounds, to_beat))
    if first == len(units):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    score = np.zeros(size, dtype=np.int64)
    for _, _, terms, _, _ in units[first:]:
        for t in terms:
            if t in lists:
                score[lists[t][0]] += item.times[t] * lists[t][1]
    # What the closed units may add to a document: a pair's joint maximum where both terms meet, else the larger one alone.
    rest = sum(u[1] for u in units[:first])
    more = np.zeros(size, dtype=np.int64)
    for _, _, _, number, gain in units[:first]:
        if gain:
            more[pair_lists[number][1]] += gain
    alive = np.flatnonzero(score)
    for _, alone, terms, number, gain in reversed(units[:first]):
        alive = alive[score[alive] + more[alive] + rest >= to_beat]
        if not len(alive):
            break
        rest -= alone
        if gain:
            more[pair_lists[number][1]] -= gain
        for t in terms:
            if t in lists:
                places, value = lists[t]
                at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
                hit = places[at] == alive
                score[alive[hit]] += item.times[t] * value[at[hit]]
    alive = alive[score[alive] >= to_beat]
    return alive, score[alive]


def _search(items: list[Item], known: Statistics, beat: dict[str, int], k: int) -> Callable[[Batches], Batches]:
    """The best ``k`` of a task's blocks for every item, as ``key, doc_id, score``."""

    def run(batches: Batches) -> Batches:
        best: dict[str, list[tuple[int, bool, int]]] = {item.key: [] for item in items}
        bar = dict(beat)
        for block in _blocks(batches):
            lists = _lists(block, known)
            top = {t: int(value.max()) for t, (_, value) in lists.items()}
            ends = block["meets"].tolist()
            pair_lists = {number: (joint, block["met"][a:b]) for number, joint, a, b in zip(
                block["pairs"].tolist(), block["joint"].tolist(), ends, ends[1:])}
            docs = block["docs"]
            for item in items:
                places, scores = search_block(item, lists, top, pair_lists, len(docs), bar.get(item.key, 0))
                if not len(places):
                    continue
                ids = docs.take(pa.array(places)).to_pylist()
                held = best[item.key] + [(-s, d is None, d or 0) for s, d in zip(scores.tolist(), ids)]
                best[item.key] = held = sorted(held)[:k]
                if len(held) == k:
                    bar[item.key] = max(bar.get(item.key, 0), -held[-1][0])
        rows = [(key, None if none else doc, -minus) for key, held in best.items() for minus, none, doc in held]
        if rows:
            keys, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                                             names=["key", "doc_id", "score"])

    return run


def _statistics(blocks: DataFrame, n_terms: int) -> Statistics:
    sums = blocks.agg(F.sum(F.size("docs").cast("long")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_docs, total = int(sums[0] or 0), int(sums[1] or 0)
    starts = F.col("starts")
    held = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (starts[i + 1] - starts[i]).cast("long").alias("df")))
    counted = blocks.select(F.inline(held)).groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = np.zeros(n_terms, dtype=np.int64)
    for term, df in counted:
        weights[term] = weight(n_docs, df)
    return Statistics(n_docs, total, weights)


def _answer(rows: DataFrame, texts: list[Row], k: int, block_docs: int) -> DataFrame | None:
    """``key, doc_id, score`` for a batch of queries ``key, text``, at least the best ``k`` of each."""
    terms = {key: Counter(terms_of(bytes(text))) for key, text in texts}
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
    if not vocabulary:
        return None
    blocks = _stored(rows.mapInArrow(_invert(vocabulary, block_docs), _ddl(BLOCK)), "search-blocks", BLOCK)
    known = _statistics(blocks, len(vocabulary))

    numbers: dict[Pair, int] = {}
    items = []
    for key, words in terms.items():
        times = {vocabulary[w]: c for w, c in words.items()}
        pairs, single = choose_pairs(times, known.weights)
        named = [(numbers.setdefault((a, b, times[a], times[b]), len(numbers)), a, b) for a, b in pairs]
        items.append(Item(key, times, named, single))

    index = _stored(blocks.mapInArrow(_intersect(list(numbers), known), _ddl(PAIRED)), "search-index", PAIRED)
    # Joint maxima of different blocks are scores of different documents: the k-th largest is a score to beat.
    joint = index.select(F.inline(F.arrays_zip("pairs", "joint")))
    ranked = joint.withColumn("nth", F.row_number().over(Window.partitionBy("pairs").orderBy(F.desc("joint")))).where(F.col("nth") == k)
    floor = {r["pairs"]: r["joint"] for r in ranked.collect()}
    beat = {item.key: max((floor.get(number, 0) for number, _, _ in item.pairs), default=0) for item in items}
    return index.mapInArrow(_search(items, known, beat, k), "key string, doc_id long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_column: str = "doc_id", text: str = "text",
           query_id: str = "item_id", query_text: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best rows of ``docs`` for every row of ``queries``.

    Scores are above 0; equal ones rank by ascending id, NULL ids last. Every row
    is a document of its own, repeated rows and ids too. Texts that are NULL or
    hold no term are found by nothing and ask for nothing; an empty table on
    either side gives no rows. Ids are integers. Equal queries are answered once.
    Further columns are not read. Queries are taken in batches of about
    ``BATCH_ITEMS`` different texts or ``BATCH_BYTES``, each with an index of its own terms.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    asked = queries.select(F.col(query_id).alias("item_id"), F.col(query_text).alias("text")).where("text IS NOT NULL")
    asked = cut_lineage(asked.withColumn("key", F.sha2("text", 256)))
    different = asked.groupBy("key").agg(F.first("text").cast("binary").alias("text"))
    size = different.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n_batches = max(1, -(-size[0] // BATCH_ITEMS), -(-(size[1] or 0) // BATCH_BYTES))
    found = None
    for i in range(n_batches):
        texts = different.where(F.pmod(F.xxhash64("key"), F.lit(n_batches)) == i).collect()
        part = _answer(rows, texts, k, block_docs) if texts else None
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "key string, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return asked.join(best, "key").select("item_id", "rank", "doc_id", "score")
