"""The Merkle manifest, ranked search and quality rules against plain versions."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagspark.llm import lexical_search, merkle_windows, quality_trees
from helpers import CLASHING, ROWS, SCHEMA, empty, odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    text = text.translate(LOWER) if lower and text is not None else text
    values = [doc_id, source, lang, n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(leaves):
    """Root and, per leaf, the (left, right) siblings of every level."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, place in enumerate(at):
            start = place // 8 * 8
            paths[i].append(("".join(level[start:place]), "".join(level[place + 1:start + 8])))
            at[i] = place // 8
        level = [sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = (members, *climb([plain_leaf(r) for r in members]))
    root, above = climb([trees[n][1] for n in names])
    out = []
    for name, over in zip(names, above):
        members, subroot, paths = trees[name]
        for row, path in zip(members, paths):
            path = path + over
            doc_id = row[0]
            h = plain_leaf(row, doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0)
            for left, right in path:
                h = sha(left + h + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((doc_id, plain_leaf(row), subroot, root, proof, h, h == root))
    return sorted(map(str, out))


def manifest_rows(df):
    return sorted(str(tuple(r)) for r in verify(df).collect())


def verify(df):
    return merkle_windows.verify_against_tampering(df)


def test_manifest_of_odd_rows(spark):
    assert manifest_rows(odd(spark)) == plain_manifest(ROWS)
    assert verify(empty(spark)).collect() == []
    assert manifest_rows(spark.createDataFrame(ROWS[:1], SCHEMA)) == plain_manifest(ROWS[:1])


@pytest.mark.parametrize("n", [8, 9, 64, 65, 513, 4105])
def test_manifest_levels(spark, n):
    """Tree sizes around powers of the fan-out and of a chunk; two thirds of the rows in one group, copies included."""
    rows = [(i // 3 if i % 5 else None, f"Text {i % 7}", "en" if i % 3 else ["de", None, "é", "z"][i % 4], "s", i % 7) for i in range(n)]
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def test_manifest_many_groups(spark):
    rows = [(i, "Ab", f"lang{i % 700}", "s", 2) for i in range(1500)]
    assert manifest_rows(spark.createDataFrame(rows, SCHEMA)) == plain_manifest(rows)


def plain_search(docs, items, k):
    words = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        asked, scored = Counter(TERM.findall((text or "").translate(LOWER))), []
        for doc, w in words:
            tf, m = Counter(w), 75 + 25 * len(w) * n_docs // total
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t, c in asked.items() if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, n, None if none else doc, -s) for n, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def found(spark, docs, items, k, block):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = lexical_search.search(docs, items, k, block_docs=block).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(str(tuple(r)) for r in rows)


def test_search_stores_one_block_to_a_file(spark, monkeypatch):
    """A file's rows are decoded together, so memory must not follow the blocks of a task."""
    import pyarrow.parquet as pq

    paths, at = [], lexical_search.shared_path
    monkeypatch.setattr(lexical_search, "shared_path", lambda s, name: paths.append(at(s, name)) or paths[-1])
    docs = [(i, f"word{i % 5} and word{i % 3}") for i in range(60)]
    items = [(1, "word1 word2")]
    assert found(spark, docs, items, 3, 4) == plain_search(docs, items, 3)
    for path in paths:
        files = [f"{path.removeprefix('file:')}/{f}" for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
        assert sum(pq.read_metadata(f).num_rows for f in files) >= 15 and max(pq.read_metadata(f).num_rows for f in files) == 1


@pytest.mark.parametrize("block", [4, 37, 4096])
def test_search_equals_brute_force(spark, block):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "日本", "ÉTÉ"]
    docs = [(int(i) if i % 11 else None, " ".join(rng.choice(vocabulary, rng.zipf(1.6) % 40, p=None))) for i in range(400)]
    docs += [(7, "w1 w2, W3-w4"), (7, "w1 w2, W3-w4"), (9, None), (10, ""), (11, "...")] + [(1000 + i, "w5 w6 w7") for i in range(50)]
    items = [(i, " ".join(rng.choice(vocabulary, 9))) for i in range(25)]
    items += [(100, "w5 w6 W7 w7"), (101, None), (102, ""), (103, "unseen words"), (104, items[0][1]), (None, "w1"), (105, "W1 w1 w1")]
    assert found(spark, docs, items, 20, block) == plain_search(docs, items, 20)


def test_search_of_odd_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "cat moon word3")], "item_id long, text string").withColumns({c: F.lit(1) for c in CLASHING})
    rows = lexical_search.search(odd(spark), items).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(str(tuple(r)) for r in rows) == plain_search([r[:2] for r in ROWS], [(1, "cat moon word3")], 20)
    assert lexical_search.search(empty(spark), items).collect() == []
    assert lexical_search.search(odd(spark), items.limit(0)).collect() == []


def test_search_in_batches(spark, monkeypatch):
    docs = [(i, f"a{i % 5} b{i % 7} c") for i in range(60)]
    items = [(i, f"a{i % 5} b{i % 4}") for i in range(20)]
    monkeypatch.setattr(lexical_search, "BATCH_ITEMS", 3)
    assert found(spark, docs, items, 4, 8) == plain_search(docs, items, 4)


def test_pairs_skip_what_single_terms_would_open():
    """Two rare terms that never meet: together they stay under a score that the sum of their maxima exceeds."""
    lists = {0: (np.array([0, 1]), np.array([60, 60])), 1: (np.array([2, 3]), np.array([60, 60])), 2: (np.array([4]), np.array([100]))}
    top = {0: 60, 1: 60, 2: 100}
    item = lexical_search.Item("q", {0: 1, 1: 1, 2: 1}, [(0, 0, 1)], [2])
    opened = []

    class Spy(dict):
        def __getitem__(self, key):
            opened.append(key)
            return super().__getitem__(key)

    places, scores = lexical_search.search_block(item, Spy(lists), top, {}, 5, 90)
    assert places.tolist() == [4] and scores.tolist() == [100]
    # Terms 0 and 1 are only looked up for the candidate of term 2.
    assert opened[0] == 2


def plain_counts(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x x x x", "é# ü| <b>\né# ü| <b>\n \né# ü| <b>", "日本 語\x0b\x0cq",
         "l1\nl1 \nl1\n\n\n", "\x1c \x85 \xa0 a", " ".join(f"w{i % 50}" for i in range(400)), "same " * 5000]


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:6] for r in quality_trees.measure(df).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(TEXTS)}




def test_trees_are_monotone_and_learn():
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(quality_trees.FEATURES)))
    # The target wobbles in feature 2, which may only lower a score, and rises with feature 0.
    good = (x[:, 0] + 0.3 * np.sin(9 * x[:, 2]) - 0.5 * x[:, 2] + 0.1 * rng.standard_normal(3000)) > 0.4
    forest = quality_trees.fit(x, good)
    assert ((forest.score(x) > 0.5) == good).mean() > 0.85
    for f, direction in enumerate(quality_trees.FEATURES.values()):
        if direction:
            grid = np.repeat(x[:200, None, :], 60, axis=1)
            grid[:, :, f] = np.linspace(-0.1, 1.1, 60)
            margin = forest.margin(grid.reshape(-1, x.shape[1])).reshape(200, 60)
            assert (np.diff(margin, axis=1) * direction >= -1e-9).all()


def test_flat_arrays_equal_a_walk():
    rng = np.random.default_rng(4)
    x = rng.random((500, 10))
    forest = quality_trees.fit(x, x[:, 1] * x[:, 5] > 0.3, trees=7)

    def walk(node, row):
        while forest.below[node] != node:
            node = forest.below[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.above[node]
        return forest.value[node]

    want = [forest.base + sum(walk(r, row) for r in forest.roots) for row in x]
    assert np.allclose(forest.margin(x), want)


def test_quality_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('0.001', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{folder.replace('0.001', '0.1')}/labels.parquet")
    side = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    measured = quality_trees.measure(docs).cache()
    forest = quality_trees.train(measured, labels.where(~side))
    rows = quality_trees.scored(measured, forest).join(labels.where(side), "doc_id").toPandas()
    assert len(rows) > 1000 and ((rows["score"] > 0.5) == (rows["quality"] == 1)).mean() > 0.97
    measured.unpersist()


def test_bounded_training_rows(spark):
    """The bound on the hash leaves the same rows as no bound; one id holds a third of the rows."""
    docs = spark.createDataFrame([(i if i % 3 else 0, f"w{i} a b {i % 9}") for i in range(900)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id long, quality int")
    measured = quality_trees.measure(docs).cache()
    for most in (5, 40, 500, 5000):
        seen = []
        original, quality_trees.fit = quality_trees.fit, lambda x, good: seen.append((x, good))
        try:
            quality_trees.train(measured, labels, most)
        finally:
            quality_trees.fit = original
        want = measured.join(labels, "doc_id").orderBy(F.xxhash64("doc_id"), *quality_trees.COUNTS).limit(most).toPandas()
        assert np.array_equal(seen[0][0], quality_trees.features(want)) and len(want) == min(most, 900)
    measured.unpersist()


def test_judge_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, 1), (None, 0), (8, None)], "doc_id long, quality int")
    rows = quality_trees.judge(odd(spark), labels).collect()
    assert len(rows) == len(ROWS)
    for r, text in [(r, t) for r in rows for i, t, *_ in ROWS if (i, len(WORD.findall(t or ""))) == (r["doc_id"], r["n_words"])]:
        n, repeated = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert not (r["kept"] and r["base_failed"])
    assert quality_trees.judge(empty(spark), labels).collect() == []
    good = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(80)))], "doc_id long, text string")
    assert quality_trees.judge(good, labels.limit(0)).first()["kept"]
