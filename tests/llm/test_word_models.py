"""Word models against brute force, and what byte models of order 4 could not tell apart."""

import math
import re
from collections import Counter

from helpers import LONG, ROWS, empty, odd
from tagspark.llm import lm_words, queries

SCHEMA = "doc_id long, text string"


def split(text):
    return [*re.findall(r"[a-z0-9à-ÿά-ώа-я]+|[^\sa-z0-9à-ÿά-ώа-я]", (text or "").lower()), None] if (text or "").strip() else []


def brute(texts, targets):
    one, two, total = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for i, t in texts.items():
        k, w = int(i in targets), split(t)
        one[k].update(w)
        two[k].update(zip([None, *w], w))
        total[k] += len(w)
    v, out = len(one[0] | one[1]), {}
    for i, t in texts.items():
        w, h = split(t), []
        for k in (0, 1):
            s = total[1] / total[0] if k == 0 and all(total) else 1.0
            p1 = [(one[k][x] * s + lm_words.EXTRA) / (total[k] * s + lm_words.EXTRA * v) for x in w]
            p2 = [(two[k][a, b] * s + lm_words.PRIOR * p) / (one[k][a] * s + lm_words.PRIOR) for a, b, p in zip([None, *w], w, p1)]
            h.append(-sum(map(math.log, p2)) / max(len(w), 1))
        out[i] = (len(w), h[1], h[0])
    return out


def test_word_scores(spark):
    texts = {i: f"The {'quick' if i % 3 else 'slow'} fox, number {i}: é jumps 日本語で" for i in range(40)}
    texts |= {50: None, 51: "", 52: " \n", 53: LONG[:5000], 54: "Привет, мир! Καλημέρα κόσμε"}
    ids = [0, 3, 6, 53]
    want = brute(texts, ids)
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    for size in (None, 300):
        got = lm_words.score_against(df, spark.createDataFrame([(i,) for i in [*ids, 3, None]], "doc_id long"), batch_bytes=size).collect()
        assert len(got) == len(texts)
        for r in got:
            n, t, b = want[r["doc_id"]]
            assert r["n_symbols"] == n and math.isclose(r["h_target"], t, abs_tol=1e-9) and math.isclose(r["h_background"], b, abs_tol=1e-9)
            assert math.isclose(r["score"], b - t, abs_tol=1e-9)


def test_query_sees_words_and_phrases(spark, tmp_path):
    """Same 4-byte n-grams, other words: Greek letters that are equal mod 8, and long words in another order."""
    a, b = "αααα ιιιι " * 3, "ιιιι αααα " * 3
    good, bad = "blackbird waterfall mountains ", "waterfall blackbird mountains "
    texts = [good * 3, bad * 3] * 10 + [a + good, b + bad] * 5
    spark.createDataFrame(list(enumerate(texts)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1 - i % 2) for i in range(30)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in queries.QUERIES["op9_lm_scoring"](spark, str(tmp_path)).collect()}
    assert min(s for i, s in got.items() if i % 2 == 0) > 0.3 and max(s for i, s in got.items() if i % 2) < -0.3


def test_long_texts_and_odd_rows(spark, monkeypatch):
    text = "some words, é日本 " * 400
    whole = [x.tolist() for x in lm_words.words([text, None, "a"])]
    monkeypatch.setattr(lm_words, "PIECE", 100)
    assert [x.tolist() for x in lm_words.words([text, None, "a"])] == whole
    monkeypatch.undo()
    none = spark.createDataFrame([], "doc_id long")
    assert lm_words.score_against(odd(spark), none).count() == len(ROWS)
    assert lm_words.score_against(empty(spark), none).count() == 0
