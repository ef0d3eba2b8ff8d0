"""Invariants and brute-force comparisons on small fixtures."""

import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tagspark.functions.hashing import order_key
from tagspark.functions.quantiles import exact_quantiles
from tagspark.operators import duplicates, embeddings, joins, metrics, profile, splits, symbols, tags, terms, tfidf, validation


def test_quantiles_beyond_the_sketch_size(spark):
    n = 30000
    rng = np.random.default_rng(1)
    values = np.where(rng.random(n) < 0.4, 7.0, rng.lognormal(3, 2, n))
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, "a", "b"), "v": values})
    df = spark.createDataFrame(pdf)
    probs = [0.95, 0.0, 0.25, 0.5, 1.0, 0.05]
    got = exact_quantiles(df, "v", probs).first()
    assert got["n"] == n
    assert np.allclose(got["q"], np.quantile(values, probs), rtol=1e-12)
    for row in exact_quantiles(df, "v", probs, "g", ["a", "b"]).collect():
        assert np.allclose(row["q"], np.quantile(pdf.v[pdf.g == row["g"]], probs), rtol=1e-12)


@pytest.mark.parametrize("shape", ["heavy", "ties", "close", "tiny", "wide"])
def test_quantiles_of_any_distribution(spark, shape):
    rng = np.random.default_rng(2)
    n, inf = 5000, float("inf")
    values = {
        "heavy": np.append(rng.standard_normal(n), [1e300, -1e308, inf, -inf]),
        "ties": rng.choice([-0.0, 0.0, 1.5, -2.0], n),
        # Values that share their first 40 bits and more.
        "close": 1e15 + rng.integers(0, 1000, n) / 8,
        "tiny": np.append(rng.integers(-50, 50, n) * 5e-324, rng.random(100) * 2.0**-1022),
        "wide": rng.choice([-1, 1], n) * 2.0 ** rng.integers(-1074, 1023, n) * (1 + rng.random(n)),
    }[shape]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(3)
    ordered = np.sort(values)
    m = len(values) - 1
    probs = [0.0, 1.0] + [i / m for i in (1, 7, m // 3, m // 2, m - 1)]
    got = exact_quantiles(df, "v", probs).first()
    want = [ordered[round(p * m)] for p in probs]
    assert got["n"] == len(values)
    if shape == "heavy":
        assert [x for x in got["q"] if abs(x) != inf] == pytest.approx([x for x in want if abs(x) != inf], rel=1e-9)
    else:
        assert np.allclose(got["q"], want, rtol=1e-9, atol=0)


def test_ordered_keys_order(spark):
    from tagspark.functions.quantiles import ordered_key

    rng = np.random.default_rng(6)
    bits = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) | (rng.integers(0, 2, 3000, dtype=np.uint64) << np.uint64(63))
    values = np.concatenate((bits.view(np.float64), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1020, 1023), 0), [0.0, np.inf, -np.inf]))
    values = np.unique(values[~np.isnan(values)])
    keys = [r["k"] for r in spark.createDataFrame(pd.DataFrame({"v": values})).select("v", ordered_key(F.col("v")).alias("k")).orderBy("v").collect()]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    patterns = values.view(np.int64)
    assert keys == [int(p) if p >= 0 else -int(p & 0x7FFFFFFFFFFFFFFF) - 1 for p in patterns]


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (4.0,)], "v double")
    row = exact_quantiles(df, "v", [0.5]).first()
    assert row["n"] == 2 and row["q"] == [2.5]
    assert exact_quantiles(df.where("v > 100 AND NOT isnan(v)"), "v", [0.5]).collect() == []


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_balanced_join_equals_plain_join(spark, how):
    keys = ["hot"] * 400 + [None] * 50 + ["cold hot"] * 300 + [f"k{i % 100}" for i in range(300)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 150, 2)], "k string, x int")
    got = joins.balanced_join(left, right, "k", "id", how)
    want = left.join(right, "k", how).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_translations(spark):
    rows = spark.createDataFrame(
        [(1, "trouvez la somme", "fr"), (2, "find the sum of", "en"), (3, "kurz", "de"), (4, None, None), (5, "etwas ganz anderes", "de")],
        "id int, t string, l string")
    known = spark.createDataFrame([("trouvez la somme", "fr", "find the sum")], "t string, lang string, translated string")
    known = known.select(F.md5("t").alias("text_key"), "lang", "translated")
    got = {r["id"]: r for r in joins.apply_translations(rows, "t", known, "id", detected_lang="l").collect()}
    assert [got[i]["t_status"] for i in range(1, 6)] == ["translated", "original", "original", "original", "error"]
    assert [got[i]["t_lang"] for i in range(1, 6)] == ["fr", "en", "unknown", "unknown", "de"]
    assert got[1]["t_translated"] == "find the sum" and got[5]["t_translated"] == "etwas ganz anderes"
    in_place = joins.apply_translations(rows, "t", known, "id", new_column=None, detected_lang="l")
    assert {r["id"]: r["t"] for r in in_place.collect()}[1] == "find the sum"
    assert joins.apply_translations(rows, "absent", known, "id") is rows


def test_nth_hash_is_exact(spark):
    df = spark.range(5000)
    hashes = sorted(r[0] for r in df.select(order_key(F.col("id"))).collect())
    keys = df.select(order_key(F.col("id")).alias("h"))
    for k in (1, 777, 5000):
        assert spark.range(1).select(splits.nth_hash(keys, F.lit(k))).first()[0] == hashes[k - 1]
    assert splits.seeded_sample(df, "id", 123).count() == 123
    assert splits.seeded_sample(df, "id", 9999).count() == 5000


def test_grouped_split_keeps_groups_together(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 400, 0).otherwise(F.col("id") % 50))
    for fix in (False, True):
        out = splits.grouped_split(df, "g", 0.3, fix=fix)
        per = out.groupBy("g").agg(F.count_distinct("is_test").alias("sides"), F.max("is_test").alias("t")).collect()
        assert all(r["sides"] == 1 for r in per)
        assert sum(r["t"] for r in per) == int(50 * 0.3)


def _labelled(spark, n=2000):
    return spark.range(n).select(
        "id", (F.col("id") % 3 == 0).cast("int").alias("a"), (F.col("id") % 7 == 0).cast("int").alias("b"))


def test_stratified_split_shares(spark):
    df = _labelled(spark)
    out = splits.stratified_split(df, ["a", "b"], "id", 0.2)
    assert out.count() == 2000 and out.where("is_test").count() == 400
    for r in out.groupBy("a", "b").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert abs(r["t"] - 0.2 * r["n"]) < 1
    report = {r["label"]: r["diff"] for r in splits.split_report(out, ["a", "b"]).collect()}
    assert max(report.values()) < 0.5


def test_stratified_folds_are_balanced(spark):
    out = splits.stratified_folds(_labelled(spark), ["a", "b"], "id", 4)
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert len(sizes) == 4 and sum(sizes) == 2000 and max(sizes) - min(sizes) <= 4
    for r in out.groupBy("a", "b").pivot("fold", [0, 1, 2, 3]).count().collect():
        assert max(r[2:]) - min(r[2:]) <= 1


def test_duplicates_are_idempotent_and_blank_aware(spark):
    df = spark.createDataFrame([(1, "Same, text"), (2, "same text!"), (3, None), (4, "$x$"), (5, "other")], "p_id int, t string")
    h = duplicates.with_hash(df, "t")
    once = duplicates.keep_first(h, "t_hash", "p_id")
    assert sorted(r["p_id"] for r in once.collect()) == [1, 3, 5]
    assert sorted(r["p_id"] for r in duplicates.keep_first(once, "t_hash", "p_id").collect()) == [1, 3, 5]
    loose = duplicates.with_hash(df, "t", ignore_blank=True, row_id="p_id")
    assert duplicates.keep_first(loose, "t_hash", "p_id").count() == 4


def test_lift_counts_repeats_only_without_membership(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["a"],), (["c"],), (None,)], "tags array<string>")
    plain = tags.lift_pmi(df, allowed=None).where("tag_a = 'a' AND tag_b = 'b'").first()
    member = tags.lift_pmi(df, allowed=None, membership=True).where("tag_a = 'a' AND tag_b = 'b'").first()
    assert plain["count"] == member["count"] == 1
    assert math.isclose(plain["lift"], (1 / 4) / (3 / 4 * 1 / 4)) and math.isclose(member["lift"], (1 / 4) / (2 / 4 * 1 / 4))
    zero = tags.lift_pmi(df, allowed=None).where("tag_a = 'a' AND tag_b = 'c'").first()
    assert zero["lift"] == 0.0 and zero["pmi"] == 0.0
    assert [r[0] for r in df.select(tags.keep_tags("tags", ["a"])).collect()] == [["a", "a"], ["a"], [], []]


def test_substring_symbols(spark):
    df = spark.createDataFrame([(1, "\\le x"), (2, "\\leq \\leqslant"), (3, "none")], "id int, t string")
    loose = {tuple(r) for r in symbols.symbol_presence(df, "t", "id").collect()}
    assert loose == {(1, "\\le"), (2, "\\le"), (2, "\\leq"), (2, "\\leqslant")}
    exact = {tuple(r) for r in symbols.symbol_presence(df, "t", "id", exact=True).collect()}
    assert exact == {(1, "\\le"), (2, "\\leq"), (2, "\\leqslant")}


TEXTS = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "the the the", "x"]


def test_tfidf_equals_its_definition(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    vocab = tfidf.fit_vocabulary(df, "t", (1, 2), 2, 0.95, 100)
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.transform(df, "t", "id", vocab).collect()}
    tokens = [re.findall(r"\b\w\w+\b", t) for t in TEXTS]
    docs = [Counter(t + [" ".join(p) for p in zip(t, t[1:])]) for t in tokens]
    df_count = Counter(term for d in docs for term in d)
    keep = {t for t, c in df_count.items() if 2 <= c <= 0.95 * len(TEXTS)}
    want = {}
    for i, d in enumerate(docs):
        w = {t: (1 + math.log(c)) * (math.log((1 + len(TEXTS)) / (1 + df_count[t])) + 1) for t, c in d.items() if t in keep}
        size = math.sqrt(sum(x * x for x in w.values()))
        want.update({(i, t): x / size for t, x in w.items()})
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in got)
    indexed = tfidf.with_index(vocab)
    vectors = {r["id"]: r["tfidf"] for r in tfidf.vectors(df, "t", indexed, len(keep)).collect()}
    assert len(vectors) == 5 and vectors[4].numNonzeros() == 0
    assert math.isclose(vectors[0].norm(2), 1.0)
    unlimited = tfidf.transform(df, "t", "id", tfidf.fit_vocabulary(df, "t", max_features=None))
    assert {(r["id"], r["term"]) for r in unlimited.collect()} == got.keys()


def test_tfidf_joins_a_vocabulary_too_large_to_send(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    vocab = tfidf.fit_vocabulary(df, "t", (1, 2), 2, 0.95, 100)
    want = {(r["id"], r["term"]): r["weight"] for r in tfidf.weights(df, "t", "id", vocab).collect()}
    monkeypatch.setattr(tfidf, "BROADCAST_ROWS", 1)
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.weights(df, "t", "id", vocab).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] is want[k] is None or math.isclose(got[k], want[k], rel_tol=1e-12) for k in got)


def test_both_vocabulary_sizes_give_one_result_per_row(spark, monkeypatch):
    rows = [(None, TEXTS[0]), (None, TEXTS[2]), (None, TEXTS[0]), (1, TEXTS[0]), (1, TEXTS[1]), (1, TEXTS[1]), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    vocab = tfidf.with_index(tfidf.fit_vocabulary(df, "t", (1, 2), 1, 1.0, 100)).cache()

    def both():
        weights = tfidf.weights(df, "t", "id", vocab).select("id", "term", F.round("weight", 12)).collect()
        vectors = tfidf.vectors(df, "t", vocab, vocab.count()).collect()
        return sorted(map(str, weights)), sorted((str(r["id"]), str(r["t"]), str(list(r["tfidf"].indices)), str([round(x, 12) for x in r["tfidf"].values])) for r in vectors)

    small = both()
    monkeypatch.setattr(tfidf, "BROADCAST_ROWS", 1)
    large = both()
    assert small == large and len(small[1]) == len(rows)
    vocab.unpersist()


def test_vectors_need_no_key(spark):
    rows = [(None, TEXTS[0]), (None, TEXTS[2]), (1, TEXTS[0]), (1, TEXTS[1]), (2, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    vocab = tfidf.with_index(tfidf.fit_vocabulary(df, "t", (1, 1), 1, 1.0, 100))
    out = tfidf.vectors(df, "t", vocab, vocab.count()).collect()
    assert len(out) == 5 and "Exchange" not in tfidf.vectors(df, "t", vocab, 9)._jdf.queryExecution().executedPlan().toString()
    by_text = {r["t"]: r["tfidf"] for r in out}
    assert by_text[TEXTS[0]] != by_text[TEXTS[1]] and by_text[None].numNonzeros() == 0


def test_keep_first_with_missing_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "b"), (3, "b"), (4, "c"), (4, "c"), (5, "c"), (None, None), (6, None)]
    df = spark.createDataFrame(rows, "id int, h string")
    assert sorted(map(str, duplicates.keep_first(df, "h", "id").collect())) == sorted(
        map(str, spark.createDataFrame([(None, "a"), (3, "b"), (4, "c"), (6, None)], "id int, h string").collect()))


def test_more_labels_than_a_proven_broadcast(spark):
    labels = [f"l{i}" for i in range(13)]
    df = spark.range(400).select("id", *[((F.col("id") % (i + 2)) == 0).cast("int").alias(c) for i, c in enumerate(labels)])
    out = splits.stratified_split(df, labels, "id", 0.25)
    assert out.count() == 400 and out.where("is_test").count() == 100


def test_labels_keep_their_share_where_combinations_are_rare(spark):
    """30 labels of 2 to 12 %: most combinations have one row, which no rule per combination can share out."""
    n, labels = 6000, [f"l{i}" for i in range(30)]
    flag = [F.conv(F.substring(F.md5(F.concat(F.lit(f"{i}-"), F.col("id").cast("string"))), 1, 4), 16, 10).cast("int") < 65536 * (i + 6) / 300
            for i in range(30)]
    df = spark.range(n).select("id", *[f.cast("int").alias(c) for f, c in zip(flag, labels)])
    assert df.select(splits.label_combination(labels)).distinct().count() > 0.25 * n
    out = splits.stratified_split(df, labels, "id", 0.2).cache()
    assert abs(out.where("is_test").count() - n / 5) <= 3
    diffs = [r["diff"] for r in splits.split_report(out, labels).collect()]
    by_hash = splits.split_report(df.withColumn("is_test", splits.order_key(F.col("id"), 42) < "33333333"), labels).collect()
    # Only the most frequent labels, shared out with the rarer ones, may drift.
    assert sorted(diffs)[24] < 0.1 and max(diffs) < 1 and sum(diffs) < sum(r["diff"] for r in by_hash) / 4
    out.unpersist()


def test_sides_of_odd_rows(spark):
    rows = [(i % 40 if i % 7 else None, i % 2 if i % 5 else None, int(i < 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    out = splits.assign_sides(df, ["a", "b"], "id", [0.5, 0.25, 0.25])
    assert sorted(map(str, out.drop("side").collect())) == sorted(map(str, df.collect()))
    assert out.where("side IS NULL OR side NOT IN (0, 1, 2)").count() == 0
    assert splits.assign_sides(df.limit(0), ["a", "b"], "id", [0.5, 0.5]).collect() == []
    per_id = out.groupBy("id", "a", "b").agg(F.countDistinct("side").alias("n"))
    assert per_id.where("id IS NOT NULL AND n > 1").count() == 0


def test_frequent_pairs_of_an_open_vocabulary(spark):
    """A vocabulary of 100,000 tags: only pairs that occur often enough are ever put together."""
    rng = np.random.default_rng(8)
    baskets = [[f"t{min(int(x), 99_999)}" for x in rng.zipf(1.3, 12)] for _ in range(3000)] + [[f"t{i}", f"t{i + 1}"] for i in range(0, 100_000, 2)]
    baskets += [None, [], ["t1"], ["t1", "t1"], ["t2", None, "t1"]]
    df = spark.createDataFrame([(b,) for b in baskets], "tags array<string>")
    singles, pairs = Counter(), Counter()
    for b in baskets:
        own = sorted({t for t in b or [] if t is not None})
        singles.update(own)
        pairs.update(combinations(own, 2))
    got = {(r["tag_a"], r["tag_b"]): r for r in tags.frequent_pairs(df, min_count=5).collect()}
    assert {k: r["count"] for k, r in got.items()} == {k: n for k, n in pairs.items() if n >= 5} and len(got) > 20
    for (a, b), r in got.items():
        lift = pairs[a, b] * len(baskets) / (singles[a] * singles[b])
        assert math.isclose(r["lift"], lift) and math.isclose(r["pmi"], math.log(lift)) and math.isclose(r["p_b_given_a"], pairs[a, b] / singles[a])
    assert tags.frequent_pairs(df.limit(0)).collect() == []


@pytest.mark.parametrize("tracked", [64, 1 << 14])
def test_top_items_are_exact(spark, tracked):
    """Also where the sketch is far smaller than the vocabulary, and where the last place is tied."""
    rng = np.random.default_rng(9)
    for values in (rng.zipf(1.2, 20_000) % 10**6, rng.integers(0, 5000, 20_000), np.repeat(np.arange(40), 3)):
        words = [f"w{v}" for v in values]
        df = spark.createDataFrame([(w,) for w in words] + [(None,)], "t string").repartition(5)
        got = [tuple(r) for r in terms.top_items(df, "t", 25, tracked).collect()]
        assert sorted(got, key=lambda r: (-r[1], r[0])) == sorted(Counter(words).items(), key=lambda r: (-r[1], r[0]))[:25]
    assert terms.top_items(df.limit(0), "t", 5).collect() == []


def test_every_row_gets_its_language(spark):
    """Rows without an id and rows with the same one are rows of their own."""
    known = [("the cat sat on the mat with the other cats", "en"), ("der hund lag auf der matte mit den anderen hunden", "de")]
    profile = terms.language_profile(spark.createDataFrame(known, "t string, l string"), "t", "l", ["de", "en"])
    rows = [(None, "the other cat sat there"), (None, "der andere hund lag da"), (1, "the mat and the cat"), (1, "kurz"), (1, None), (2, "die matte der hunde"), (2, "die matte der hunde")]
    got = terms.identify_language(spark.createDataFrame(rows, "id int, t string"), "t", "id", profile).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (None, "en"), (None, "de"), (1, "en"), (1, "unknown"), (1, "unknown"), (2, "de"), (2, "de")]))


@pytest.mark.parametrize("pack, send", [(512, 200_000), (7, 200_000), (7, 1)])
def test_every_row_beside_every_item(spark, monkeypatch, pack, send):
    monkeypatch.setattr(tags, "BROADCAST_ROWS", send)
    rows, items = spark.range(5).withColumnRenamed("id", "a"), spark.range(60).select((F.col("id") % 40).alias("b"), F.lit("x").alias("c"))
    got = tags.beside_every(rows, items, pack).collect()
    assert sorted(map(tuple, got)) == sorted((a, b % 40, "x") for a in range(5) for b in range(60))
    assert tags.beside_every(rows, items.limit(0), pack).collect() == []


def test_folds_are_never_dropped(spark):
    from pyspark.ml.functions import array_to_vector

    from tagspark.operators import models

    df = spark.range(303).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
                                 (F.col("id") % 101).cast("int").alias("fold"), (F.col("id") % 2).cast("int").alias("y"))
    with pytest.raises(ValueError, match="more than 100"):
        models.grid_search(df, ["y"], "id", grid=[{"C": 1.0}])
    out = models.grid_search(df.where("fold < 3"), ["y"], "id", grid=[{"C": 1.0}], max_iter=2)
    assert sorted(r["fold"] for r in out.collect()) == [0, 1, 2]


def test_parts_of_a_search_follow_its_rows(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector

    from tagspark.operators import models

    df = spark.range(0, 300, 1, 7).select("id", array_to_vector(F.array((F.col("id") % 11).cast("double"))).alias("features"),
                                          (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 11 > 6).cast("int").alias("y"))
    seen, fit = [], models.fit_labels
    monkeypatch.setattr(models, "fit_labels", lambda rows, *a, **k: seen.append(rows.rdd.glom().map(len).collect()) or fit(rows, *a, **k))

    def scores(**options):
        seen.clear()
        rows = models.grid_search(df, ["y"], "id", grid=[{"C": 1.0}], **options).collect()
        return {r["fold"]: (round(r["train_macro_f1"], 9), round(r["test_macro_f1"], 9)) for r in rows}

    whole = scores()
    assert seen == [[200]] * 3
    monkeypatch.setattr(models, "ROWS_A_PART", 100)
    assert scores() == whole and sorted(whole) == [0, 1, 2]
    assert [len(parts) for parts in seen] == [3] * 3 and all(sum(parts) == 200 and min(parts) > 0 for parts in seen)
    assert scores(partitions=2) == whole and [len(parts) for parts in seen] == [2] * 3


def test_only_labelled_texts_are_counted(spark, monkeypatch, tmp_path):
    from pyspark.ml.functions import vector_to_array

    from tagspark.functions import text
    from tagspark.plans.catalog import model_queries

    tables = {"documents": ([(1, "one two"), (2, None), (3, "none asks"), (3, "none asks"), (None, "none asks"), (4, "7"), (4, "a b c")], "doc_id long, text string"),
              "labels": ([(1, 1, 0), (2, 0, 1), (4, 1, 1), (4, 0, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
              "embeddings": ([(1, [0.5, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    count = text.word_count
    monkeypatch.setattr(text, "word_count", lambda c: F.when(c == "none asks", F.raise_error(F.lit("counted"))).otherwise(count(c)))
    got = model_queries.labelled_rows(spark, str(tmp_path)).select(
        "doc_id", vector_to_array("e").alias("e"), "no_vector", "words", "numeric_ratio", "quality", "toxic").collect()
    zero = [0.0, 0.0]
    expected = [(1, [0.5, 2.0], 0.0, 2.0, 0.0, 1, 0), (2, zero, 1.0, 0.0, 0.0, 0, 1), (5, zero, 1.0, 0.0, 0.0, 0, 0), (None, zero, 1.0, 0.0, 0.0, 1, 1)]
    expected += [(4, zero, 1.0, words, numeric, *y) for words, numeric in ((1.0, 1.0), (3.0, 0.0)) for y in ((1, 1), (0, 0))]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_feature_names_differ_beyond_case():
    from tagspark.functions import latex

    names = [latex.feature_name(s) for s in ("\\Sigma", "\\sigma", "\\SIGMA", "\\le")]
    assert len({n.lower() for n in names}) == 4 and names[3] == "has_le"


def test_thresholds_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 500), rng.random(500)
    df = spark.createDataFrame(pd.DataFrame({"id": range(500), "label": "a", "y": y, "p": p}))
    best_t, best_f = 0.5, 0.0
    for t in np.arange(0.1, 0.9, 0.05):
        q = p >= t
        f1 = 2 * (q & (y == 1)).sum() / (q.sum() + (y == 1).sum())
        if f1 > best_f:
            best_t, best_f = t, f1
    got = metrics.best_thresholds(df).first()
    assert got["threshold"] == best_t and math.isclose(got["f1"], best_f)
    never = df.withColumn("y", F.lit(0))
    assert metrics.best_thresholds(never).first()["threshold"] == 0.5


def test_hamming_example(spark):
    truth, pred = [[1, 0, 1], [0, 1, 0], [1, 1, 0]], [[1, 0, 0], [0, 1, 0], [1, 0, 1]]
    rows = [(i, f"l{j}", truth[i][j], pred[i][j]) for i in range(3) for j in range(3)]
    conf = metrics.confusion(spark.createDataFrame(rows, "id int, label string, y int, pred int"))
    assert math.isclose(metrics.overall(conf).first()["hamming_loss"], 3 / 9)
    total = conf.select(F.sum(F.expr("tp + fp + fn + tn"))).first()[0]
    assert total == 9


def test_centroid_of_a_label_without_rows(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], ["a"]), (2, [0.0, 2.0], ["b"])], "id int, v array<double>, tags array<string>")
    got = {r["tag"]: r for r in embeddings.class_centroids(df, "v", "tags", ["a", "b", "c"]).collect()}
    assert np.allclose(got["a"]["centroid"], [0.6, 0.8]) and got["c"]["centroid"] == [0.0, 0.0] and got["c"]["n_pos"] == 0


def test_language_profile_finds_its_own_texts(spark):
    rows = [(1, "the quick brown fox and the lazy dog", "en"), (2, "le renard brun et le chien paresseux", "fr"), (3, "court", "fr")]
    df = spark.createDataFrame(rows, "id int, t string, l string")
    profile_table = terms.language_profile(df, "t", "l", ["en", "fr"])
    got = {r["id"]: r["language"] for r in terms.identify_language(df, "t", "id", profile_table).collect()}
    assert got == {1: "en", 2: "fr", 3: "unknown"}


def test_fill_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (1.0,), (9.0,), (None,), (float("nan"),)], "x double")
    values = {s: profile.fill_statistics(df, ["x", "absent"], s).first()["value"] for s in ("median", "mean", "mode")}
    assert values == {"median": 2.0, "mean": 3.0, "mode": 1.0}
    with pytest.raises(ValueError):
        profile.fill_statistics(df, ["x"], "other")
    filled = profile.fill_missing(df, profile.fill_statistics(df, ["x"]), ["x"])
    assert filled.where("x = 2.0").count() == 4


def test_constant_column_has_no_correlation(spark):
    df = spark.range(10).select(F.lit(1.0).alias("c"), F.col("id").cast("double").alias("x"))
    assert profile.correlation_pairs(df, ["c", "x"]).first()["r"] is None
    assert profile.feature_label_correlation(df, ["c"], ["x"], constant_as_zero=True).first()["r"] == 0.0
    assert profile.correlation_pairs(df, ["x"]).count() == 0


def test_required_text(spark):
    df = spark.createDataFrame([(None,), ("",)], "t string")
    with pytest.raises(ValueError, match="no text"):
        validation.require_text(df, "t")
    with pytest.raises(ValueError, match="no column"):
        validation.require_text(df, "u")
    validation.require_text(df.union(spark.createDataFrame([("x",)], "t string")), "t")
    with pytest.raises(ValueError):
        validation.require_same_columns(df, df.withColumn("y", F.lit(1)))
    flow, seen = validation.observed(df, "load")
    flow.collect()
    assert seen.get["rows"] == 2
