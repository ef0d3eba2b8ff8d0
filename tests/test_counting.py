"""Counts made inside tasks, and the steps of queries that grew faster than their input."""

from __future__ import annotations

import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagspark.functions import counting
from tagspark.operators import embeddings, terms, tfidf
from tagspark.plans.catalog import QUERIES
from tagspark.sources import readers


def test_tokens_and_ngrams_across_parts_and_missing_lists(monkeypatch):
    monkeypatch.setattr(counting, "PART", 4)
    lists = [["a", "b", "a", "b"], None, [], ["b"], ["a", "b", "é"], ["c"] * 9]
    found, docs = Counter(), Counter()
    for batch in counting.count_tokens([pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["t"])], 1, 3):
        for r in batch.to_pylist():
            found[r["token"]] += r["count"]
            docs[r["token"]] += r["n_docs"]
    grams = [[" ".join(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)] for t in lists if t]
    assert found == Counter(g for t in grams for g in t)
    assert docs == Counter(g for t in grams for g in set(t))


@pytest.mark.parametrize("n", [1, 3, 30])
def test_characters_from_every_place(n):
    texts, groups = ["aab𝄞aab", None, "", "ab", "aab", "x" * 40], ["p", "p", "q", "q", None, "q"]
    batch = pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(texts, pa.string())], ["g", "t"])
    found = Counter()
    for b in counting.count_char_ngrams([batch], n):
        for r in b.to_pylist():
            found[r["group"], r["gram"]] += r["count"]
    assert found == Counter((g, t[i:i + n]) for g, t in zip(groups, texts) if t for i in range(len(t) - n + 1))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_norm_is_taken_once_a_row(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "aa bb"), (3, None)], "id int, t string")
    vocabulary = spark.createDataFrame([("aa", 1.0), ("bb", 2.0)], "term string, idf double")
    cells = tfidf.weights(df, "t", "id", vocabulary)
    assert "/ SQRT(" not in _plan(cells)
    got = {(r["id"], r["term"]): r["weight"] for r in cells.collect()}
    assert got[2, "aa"] == pytest.approx(1 / 5 ** 0.5) and got[2, "bb"] == pytest.approx(2 / 5 ** 0.5) and got[3, None] is None


def test_projection_sums_plain_columns(spark):
    cells = spark.createDataFrame([(1, "aa", 0.6), (1, "bb", 0.8), (2, None, None)], "id int, term string, weight double")
    out = embeddings.projected_embeddings(cells, "id")
    assert "UDF" not in _plan(out)
    got = {r["id"]: r["embedding"] for r in out.collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1) and got[2] == [0.0] * 64


def test_word2vec_parts_grow_with_the_words(spark, monkeypatch):
    from pyspark.ml.feature import Word2Vec

    asked, fit = [], Word2Vec.fit
    monkeypatch.setattr(Word2Vec, "fit", lambda self, df: asked.append(self.getNumPartitions()) or fit(self, df))
    monkeypatch.setattr(embeddings, "WORDS_A_PART", 10)
    df = spark.createDataFrame([(i, "one two three four five") for i in range(20)], "id int, t string")
    assert embeddings.word2vec_embeddings(df, "t", "id", size=4).count() == 20
    assert asked == [10]


def test_records_are_stored_many_to_a_file(spark, folder, monkeypatch):
    written = []
    whole = readers._json_files
    monkeypatch.setattr(readers, "_json_files", lambda s, path: written.append(path) or whole(s, path))
    for name in ("src1_scan_json_directory", "src1_union_of_keys"):
        rows = QUERIES[name](spark, folder).count()
        assert rows > 100 > len([f for f in os.listdir(written.pop().removeprefix("file:")) if f.endswith(".json")])


def test_language_of_a_tie_is_the_first_by_name(spark):
    profile = spark.createDataFrame(
        [("abc", [("fr", -1.0), ("de", -1.0)]), (None, [("fr", -9.0), ("de", -9.0)])], "gram string, scores array<struct<language string, logp double>>")
    df = spark.createDataFrame([(1, "abcabcabcabc"), (1, "short"), (None, None)], "id int, t string")
    got = sorted(map(tuple, terms.identify_language(df, "t", "id", profile).collect()), key=str)
    assert got == [(1, "de"), (1, "unknown"), (None, "unknown")]
