"""SimHash, substring and embedding duplicates, fingerprints and components against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import ROWS, Sets, empty, odd
from tagspark.llm import components, embedding_pq, queries, simhash_covering, substring_cover, syncmers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, folder):
    return dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)]
    sets = Sets()
    for a, b in pairs:
        if a != b:
            sets.join(a, b)
    df = spark.createDataFrame([*pairs, (None, 5), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {x: sets.find(x) for x in sets.up}
    assert components.connected_components(df.limit(0)).count() == 0


def test_masks_cover_every_difference():
    masks = simhash_covering.covering_masks(list(range(64)))
    assert len(masks) == 15
    rng = random.Random(2)
    for _ in range(3000):
        bits = rng.sample(range(64), 3)
        assert any(not any(m >> b & 1 for b in bits) for m in masks)
    levels = simhash_covering.mask_levels()
    assert max(64 - bin(m).count("1") for _, _, m in levels[2]) <= 8


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    sets, distinct = Sets(), sorted(set(prints))
    for i, a in enumerate(distinct):
        for b in distinct[i:]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    least = {}
    for i, p in zip(ids, prints):
        least[sets.find(p)] = min(least.get(sets.find(p), i), i)
    return {i: least[sets.find(p)] for i, p in zip(ids, prints)}


def test_simhash_query(spark, folder, texts):
    rows = queries.QUERIES["op6_simhash_near_dedup"](spark, folder).collect()
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(list(prints), list(prints.values()))


def test_simhash_links_in_full_buckets(spark):
    """Fingerprints around few centres, with buckets dealt again at every level."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = set()
    for _ in range(600):
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(6)):
            x ^= 1 << b
        prints.add(x)
    prints = sorted(prints)
    signed = [simhash_covering._signed(x) for x in prints]
    links = simhash_covering.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket=2).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    want = Sets()
    for i, a in enumerate(signed):
        for b in signed[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                want.join(a, b)
    assert {x: sets.find(x) for x in signed} == {x: want.find(x) for x in signed}


def test_simhash_odd_rows(spark):
    df = odd(spark)
    rows = simhash_covering.near_duplicates(df).collect()
    assert len(rows) == len(ROWS)
    zero = {r["doc_id"] for r in rows if r["fp"] == 0}
    assert zero == {2, 3, 4} and {r["component_id"] for r in rows if r["fp"] == 0} == {2}
    kept = simhash_covering.keep_one(df)
    assert kept.columns == df.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id IN (2, 3, 4)").count() == 1
    assert kept.where("doc_id IS NULL").count() == 1
    assert simhash_covering.near_duplicates(empty(spark)).count() == 0 and simhash_covering.keep_one(empty(spark)).count() == 0


def brute_repeats(texts):
    words = [t.encode().split() if t else [] for t in texts]
    times = Counter(tuple(w[i:i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for w in words:
        stay = [True] * len(w)
        for i in range(len(w) - 34):
            if times[tuple(w[i:i + 35])] > 1:
                stay[i:i + 35] = [False] * 35
        out.append((len(w), stay.count(False), hashlib.sha256(b" ".join(x for x, s in zip(w, stay) if s)).hexdigest()))
    return out


def test_substring_query(spark, folder, texts):
    rows = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op5_substring_dedup"](spark, folder).collect()}
    assert rows == dict(zip(texts, brute_repeats(texts.values())))
    assert any(r[1] for r in rows.values())


def test_substring_passages_at_any_shift(spark):
    rng = random.Random(4)

    def some(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    passages = [some(n) for n in (34, 35, 36, 60)]
    texts = [" ".join(some(rng.randrange(45)) + rng.choice(passages) + some(rng.randrange(45))) for _ in range(60)]
    texts += [" ".join(["again"] * 80), " ".join(some(20) * 4), texts[0], None, "", " \n "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in substring_cover.remove_repeats(df).collect()}
    assert got == dict(enumerate(brute_repeats(texts)))


def test_substring_odd_rows(spark):
    rows = substring_cover.remove_repeats(odd(spark)).collect()
    want = dict(zip(((r[0], r[1]) for r in ROWS), brute_repeats([r[1] for r in ROWS])))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in rows) == Counter((i, *want[i, t][:2]) for i, t, *_ in ROWS)
    assert substring_cover.remove_repeats(empty(spark)).count() == 0


def near(x, y):
    return float(x @ y / np.sqrt(x @ x) / np.sqrt(y @ y)) >= 0.9


def test_embedding_links(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    vectors = [*base, *(base[i % 8] * 3 + rng.normal(size=16) * 0.6 for i in range(160)), base[0], base[0] * 2]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    n = len(rows)
    bad = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [1.0] * 15]
    rows += [(n + i, v, None) for i, v in enumerate(bad)] + [(n + 10, [1.0, 2.0], 1), (n + 11, [2.0, 4.0], 1), (None, [9.0, -1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("v", F.lit(2))
    got = {r["vec_id"]: r for r in embedding_pq.near_duplicates(df, per_list=20, block=16).collect()}
    assert len(got) == len(rows)
    sets, links = Sets(), Counter()
    for i, a in enumerate(vectors):
        sets.find(i)
        for j in range(i):
            if near(np.asarray(a), np.asarray(vectors[j])):
                sets.join(i, j)
                links.update((i, j))
    assert sum(got[i]["n_links"] for i in range(n)) >= 0.9 * links.total()
    assert all(got[i]["n_links"] <= links[i] for i in range(n))
    assert sum(got[i]["component_id"] == sets.find(i) for i in range(n)) >= 0.95 * n
    assert all(got[n + i]["n_links"] == 0 and got[n + i]["kept"] for i in range(len(bad)))
    assert got[n + 11]["component_id"] == n + 10 and got[n + 10]["n_links"] == 1 and got[None]["n_links"] == 0
    assert embedding_pq.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("lists, cells", [(51, 4096), (1024, 4096), (4096, 4096), (4096, 128)])
def test_probes_find_close_pairs_at_any_number_of_lists(lists, cells):
    """Pairs of unseen vectors between cosine 0.90 and 0.92, in lists of the whole sphere."""
    rng = np.random.default_rng(lists + cells)
    index = embedding_pq.fit(embedding_pq._unit(rng.standard_normal((min(embedding_pq.SAMPLE, 16 * max(lists, 256)), 64))), lists, most_cells=cells)
    assert index.lists == lists
    x = embedding_pq._unit(rng.standard_normal((1500, 64)))
    aside = rng.standard_normal(x.shape)
    aside = embedding_pq._unit(aside - (aside * x).sum(1, keepdims=True) * x)
    cosine = rng.uniform(0.9, 0.92, (len(x), 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * aside
    a, b = (index.nearest(v.astype(np.float32), embedding_pq.probes_for(lists)) for v in (x, y))
    met = (a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)
    assert met.mean() > 0.97


def test_embedding_query(spark, folder, tmp_path):
    """The given vectors, which hold no links, and for half of them one or two shifted copies around the threshold."""
    rng = np.random.default_rng(11)
    given = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.1')}/embeddings.parquet").select("vec_id", "embedding").collect()
    table, size = list(map(tuple, given)), np.mean([np.linalg.norm(r["embedding"]) for r in given])
    for n, (i, v) in enumerate(map(tuple, given[::2])):
        for k in range(1 + n % 2):
            noise = rng.standard_normal(len(v))
            table.append((10**6 + 2 * i + k, [float(x) for x in np.array(v) + noise / np.linalg.norm(noise) * size * rng.uniform(0.1, 0.5)]))
    spark.createDataFrame(table, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = {r["vec_id"]: r for r in queries.QUERIES["op4_embedding_near_dedup"](spark, str(tmp_path)).collect()}
    assert len(rows) == len(table)
    ids, x = [i for i, _ in table], embedding_pq._unit(np.array([v for _, v in table], dtype=float))
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = dict(zip(ids, near.sum(1).tolist()))
    # Recall of links, each counted at both ends; none may be too many.
    assert all(r["n_links"] <= want.get(i, 0) for i, r in rows.items())
    assert sum(r["n_links"] for r in rows.values()) >= 0.99 * sum(want.values()) > 0


def brute_anchors(text, k=syncmers.K):
    def signed(v):
        return v - (1 << 64) if v >> 63 else v

    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest(v, h)
        return h

    words = (text or "").encode().split()
    if not words:
        return []
    pairs = [signed(chain(p)) for p in zip(words, words[1:])]
    out = []
    for i in range(len(words) - k + 1):
        least = min(pairs[i:i + k - 1])
        if least in (pairs[i], pairs[i + k - 2]):
            out.append((i + 1, chain(p.to_bytes(8, "little", signed=True) for p in pairs[i:i + k - 1:2]) >> 32))
    return out or [(1, chain(words) >> 32)]


def test_syncmers(spark):
    for r in odd(spark).select("text", syncmers.anchors(F.col("text")).alias("a")).collect():
        assert [tuple(x) for x in r["a"] or []] == brute_anchors(r["text"])


def brute_edits(rows):
    """``rows`` in document order."""
    out = []
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, e, b = (brute_anchors(t) for t in (text, edited, after))

        def like(x, y):
            x, y = {v for _, v in x}, {v for _, v in y}
            return len(x & y) / len(x | y) if x | y else 1.0

        hexed = ["".join(f"{v:08x}" for _, v in x) for x in (a, e)]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), *hexed, like(a, e), like(a, b)))
    return out


def test_fingerprint_query(spark, folder, texts):
    rows = [tuple(r) for r in queries.QUERIES["op7_fingerprints"](spark, folder).collect()]
    assert sorted(rows) == sorted(brute_edits(sorted(texts.items(), reverse=True)))


def test_fingerprint_buckets_and_odd_rows(spark):
    rows = [(i, f"text number {i} " + "and so on it goes " * (i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in syncmers.fingerprint_edits(df, bucket_rows=6).collect())
    assert got == sorted(brute_edits(sorted(rows, reverse=True)))
    many = syncmers.fingerprint_edits(odd(spark), bucket_rows=2).collect()
    assert len(many) == len(ROWS)
    one = syncmers.fingerprint_edits(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert one["fingerprint"] == "" and one["near_edited"] == one["near_next"] == 1.0
    assert syncmers.fingerprint_edits(empty(spark)).count() == 0
    plan = syncmers.fingerprint_edits(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
