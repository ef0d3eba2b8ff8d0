"""Sources, fit/apply leakage, training, scoring, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from tagspark.operators import metrics, models, splits, validation
from tagspark.plans import prepare, scoring, training
from tagspark.session import cut_lineage, shared_path
from tagspark.sources import readers, stored, writers
from tagspark.sources.problems import problems
from tagspark.streaming import dedup_stream, score_stream

RECORDS = [
    {"src_uid": "r1", "tags": "['math']", "prob_desc_description": "Sum of $$$n$$$ numbers", "difficulty": 1400,
     "prob_desc_notes": "NoteIn the test", "prob_desc_time_limit": "3 seconds"},
    {"src_uid": "r2", "tags": ["graphs", "trees"], "prob_desc_description": "Walk the tree \\le 5", "difficulty": -1},
    {"tags": [], "prob_desc_description": "Nothing here"},
]


@pytest.fixture(scope="module")
def records(tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    for i, r in enumerate(RECORDS):
        (folder / f"{i}.json").write_text(json.dumps(r))
    return str(folder)


def test_read_records(spark, records, tmp_path):
    df = readers.extract_tags_list(readers.read_records(spark, records))
    got = {r["prob_desc_description"][:3]: r for r in df.collect()}
    assert got["Sum"]["tags"] == ["math"] and got["Wal"]["tags"] == ["graphs", "trees"] and got["Not"]["tags"] == []
    assert readers.read_records(spark, records + "/0.json").count() == 1
    with pytest.raises(ValueError, match="no .json"):
        readers.read_records(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no file or folder"):
        readers.read_records(spark, str(tmp_path / "absent"))
    assert readers.extract_tags_list(df) is df


def test_read_all_keys(spark, tmp_path):
    files = {
        "a": {"src_uid": "a", "tags": ["x", "y"], "difficulty": 800, "extra": 1, "we.ird`k\"'": "q", "Note": "N", "only": None},
        "b": {"src_uid": "b", "tags": "['x']", "difficulty": 1.5, "extra": "s", "nest": {"p": 1}, "note": 2},
        "c": {"src_uid": 3, "tags": None, "extra": [1, {"k": "v"}], "lst": [1, 2.5], "nest": {"p": 7, "q": "z"}, "empty": {}, "src_UID": "other"},
        "d": {},
    }
    for name, record in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(record, indent=1), encoding="utf-8")
    (tmp_path / "broken.json").write_text('{"src_uid": ', encoding="utf-8")
    (tmp_path / "other.txt").write_text("not read", encoding="utf-8")
    df = readers.read_all_keys(spark, str(tmp_path))
    assert df.columns[:len(readers.RECORD_SCHEMA)] == readers.RECORD_SCHEMA.names
    assert set(df.columns[len(readers.RECORD_SCHEMA):]) == {"Note", "empty", "extra", "lst", "nest", "note_2", "only", "src_UID_2", "we.ird`k\"'"}
    rows = {r["src_uid"]: r.asDict(recursive=True) for r in df.collect() if r["src_uid"]}
    assert df.count() == 5 and set(rows) == {"a", "b", "3"}
    assert [rows[k]["extra"] for k in ("a", "b", "3")] == ["1", "s", '[1,{"k":"v"}]']
    assert rows["a"]["we.ird`k\"'"] == "q" and (rows["a"]["Note"], rows["b"]["note_2"]) == ("N", 2)
    assert rows["3"]["lst"] == [1.0, 2.5] and rows["b"]["nest"] == {"p": 1, "q": None} and rows["3"]["nest"] == {"p": 7, "q": "z"}
    assert rows["3"]["src_UID_2"] == "other" and rows["a"]["only"] is None and rows["a"]["difficulty"] == 800.0
    tags = readers.extract_tags_list(df).where("src_uid = 'a'").first()["tags"]
    assert tags == ["x", "y"]
    with pytest.raises(ValueError):
        readers.read_all_keys(spark, str(tmp_path / "absent"))


def test_sinks(spark, tmp_path):
    df = spark.range(5).withColumn("has_x", F.lit(1))
    writers.write_table(df, str(tmp_path / "t"))
    assert readers.feature_names(spark, str(tmp_path / "t")) == ["has_x"]
    writers.write_predictions(df, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 5


@pytest.fixture(scope="module")
def parts(spark, folder):
    o = prepare.Options(max_features=200, min_symbol_docs=2)
    rows = training.prepare_split(problems(spark, folder), o)
    return o, *splits.train_test(cut_lineage(rows))


@pytest.fixture(scope="module")
def pipeline(spark, parts):
    o, train, _ = parts
    # A session that has observed something holds what can't go to executors.
    flow, seen = validation.observed(spark.range(3), "before training")
    flow.collect()
    assert seen.get["rows"] == 3
    return training.train(train, o, shared_path(spark, "state"), max_iter=15)


def test_state_depends_on_training_rows_only(spark, parts):
    o, train, test = parts
    a = prepare.fit(prepare.stored_base(train, o), o, shared_path(spark, "a"))
    changed = test.withColumn("description", F.lit("something else entirely \\newsymbol"))
    all_rows = train.withColumn("side", F.lit(0)).unionByName(changed.withColumn("side", F.lit(1)))
    b = prepare.fit(prepare.stored_base(all_rows.where("side = 0").drop("side"), o), o, shared_path(spark, "b"))
    assert (a.symbols, a.fills, a.scaler) == (b.symbols, b.fills, b.scaler)
    assert sorted(a.vocabulary.collect()) == sorted(b.vocabulary.collect())
    vectors = prepare.features(test, a)
    assert vectors.count() == test.count()
    assert vectors.first()["features"].size == a.vocabulary_size + len(a.dense)
    assert prepare.feature_blocks(a)["dense"][1] == a.vocabulary_size + len(a.dense)


def test_training_and_scoring(spark, parts, pipeline):
    o, train, test = parts
    path = shared_path(spark, "pipeline")
    pipeline.save(path)
    loaded = training.TrainedPipeline.load(spark, path)
    assert loaded.models.labels == pipeline.models.labels == prepare.target_names(o.labels)
    assert loaded.thresholds == pipeline.thresholds
    p = scoring.probabilities(loaded, test).orderBy(o.key).collect()
    q = scoring.probabilities(pipeline, test).orderBy(o.key).collect()
    assert p == q and len(p) == test.count()
    assert all(0 <= v <= 1 for r in p for v in r[1:])
    decoded = scoring.predict_with_labels(loaded, test, tuned=True)
    assert all(r["num_tags"] == len(r["predicted_tags"]) and set(r["predicted_tags"]) <= set(o.labels) for r in decoded.collect())
    conf = training.evaluate(loaded, train)
    scores = {r["label"]: r["f1"] for r in metrics.per_label(conf).collect()}
    assert len(scores) == 8 and scores["target_graphs"] >= 0.0
    coefficients = models.coefficient_table(pipeline.models)
    assert {r["block"] for r in models.block_norms(coefficients).collect()} == {"tfidf", "dense"}


def test_one_result_per_record(spark, parts, pipeline):
    o, _, test = parts
    few = test.orderBy(o.key).limit(20)
    key = F.when(F.col(o.key) % 3 == 0, F.lit(None)).otherwise(F.col(o.key) % 4)
    mixed = few.withColumn(o.key, key.cast("string"))
    p = scoring.probabilities(pipeline, mixed)
    assert p.count() == 20 and p.where(F.col(o.key).isNull()).count() == 0
    columns = [c for c in p.columns if c != o.key]
    want = scoring.probabilities(pipeline, few).select(*columns)
    assert sorted(map(tuple, p.select(*columns).collect())) == sorted(map(tuple, want.collect()))
    blank = few.withColumn(o.description, F.lit("")).limit(2)
    assert scoring.predict_with_labels(pipeline, blank, check=False).count() == 2
    with pytest.raises(ValueError, match="no text"):
        scoring.predict(pipeline, blank)


def test_balanced_logistic_matches_gradient(spark):
    """At the optimum the gradient of the summed, weighted objective is zero."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(0)
    x = rng.normal(size=(120, 2))
    y = (x[:, 0] + rng.normal(size=120) > 0.8).astype(int)
    rows = [(int(i), [float(a) for a in x[i]], int(y[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, v array<double>, y int").select("id", array_to_vector("v").alias("features"), "y")
    m = models.fit_labels(df, ["y"], C=2.0, tol=1e-10, max_iter=500).models["y"]
    w = np.where(y == 1, 120 / (2 * y.sum()), 120 / (2 * (120 - y.sum())))
    p = 1 / (1 + np.exp(-(x @ m.coefficients.toArray() + m.intercept)))
    gradient = 2.0 * (x.T @ (w * (p - y))) + m.coefficients.toArray()
    assert np.abs(gradient).max() < 1e-2


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_join_without_an_exchange(spark, tmp_path):
    left = spark.createDataFrame([(i % 50 if i % 7 else None, f"l{i}") for i in range(200)], "k long, a string")
    right = spark.createDataFrame([(i if i % 5 else None, f"r{i}") for i in range(20, 80)], "k long, `b.c` string")
    stored.write_stored(left, str(tmp_path / "l"), "k", 4)
    stored.write_stored(right, str(tmp_path / "r"), "k", 4)
    l, r = stored.open_stored(spark, str(tmp_path / "l")), stored.open_stored(spark, str(tmp_path / "r"))
    assert sorted(map(str, l.rows().collect())) == sorted(map(str, left.collect()))
    for how in ("inner", "left", "left_semi", "left_anti"):
        out = stored.stored_join(l, r, how)
        assert "Exchange" not in plan_of(out) and "SortMergeJoin" in plan_of(out), how
        want = left.join(right, "k", how)
        names = [f"`{c}`" for c in want.columns]
        assert sorted(map(str, out.select(names).collect())) == sorted(map(str, want.select(names).collect())), how
    assert "Exchange" not in plan_of(l.keyed.groupBy("k").count())
    assert len(list((tmp_path / "l" / "keyed").glob("*.parquet"))) <= 4
    with pytest.raises(ValueError, match="at most 3"):
        stored.write_stored(left, str(tmp_path / "x"), "k", 4, most_per_key=3)
    stored.write_stored(left.limit(0), str(tmp_path / "none"), "k", 4)
    assert stored.stored_join(stored.open_stored(spark, str(tmp_path / "none")), r, "left").collect() == []
    with pytest.raises(ValueError, match="different"):
        stored.write_stored(right, str(tmp_path / "r8"), "k", 8)
        stored.stored_join(l, stored.open_stored(spark, str(tmp_path / "r8")))


def test_stream_and_batch_deduplicate_alike(spark, tmp_path):
    rows = [(i, f"h{i % 5 if i % 3 else 0}", f"2024-01-01 {i // 6:02d}:{i % 6}0:00") for i in range(100)]
    rows += [(None, None, "2024-01-01 03:00:00"), (7, "h9", None), (500, "h0", "2024-01-01 04:00:00"), (500, "h0", "2024-01-01 04:00:00")]
    df = spark.createDataFrame(rows, "id long, hash string, t string").withColumn("t", F.col("t").cast("timestamp"))
    for fn, columns in ((dedup_stream.keep_first, ["id", "hash", "t"]), (dedup_stream.duplicate_groups, ["start", "hash", "count", "first_id"])):
        out, state, source = (str(tmp_path / f"{fn.__name__}-{x}") for x in ("out", "state", "in"))
        for low, high in ((0, 5), (5, 11), (11, 24)):
            # Each part is a run of its own that takes up the state of the last; the rows without a time come with the first.
            hour = F.coalesce(F.hour("t"), F.lit(0))
            df.where((hour >= low) & (hour < high)).write.mode("append").parquet(source)
            stream = fn(spark.readStream.schema(df.schema).parquet(source), "hash", "id", "t", "2 hours", "10 minutes")
            dedup_stream.append_parquet(stream, out, state).awaitTermination()
        got = spark.read.parquet(out).select(columns)
        batch = fn(df, "hash", "id", "t", "2 hours", "10 minutes").select(columns)
        # The watermark stands at 16:20: windows that end at 16:00 or before are closed.
        start = F.col(columns[2] if fn is dedup_stream.keep_first else "start")
        closed = batch.where(start < F.lit("2024-01-01 16:00:00").cast("timestamp"))
        assert sorted(map(str, got.collect())) == sorted(map(str, closed.collect())) and got.count() > 5
    # A row behind the watermark is late: its window is closed, and it is dropped.
    before = spark.read.parquet(out).count()
    spark.createDataFrame([(900, "h1", "2024-01-01 01:00:00"), (901, "h1", "2024-01-01 01:01:00")], "id long, hash string, t string").withColumn(
        "t", F.col("t").cast("timestamp")).write.mode("append").parquet(source)
    dedup_stream.append_parquet(dedup_stream.duplicate_groups(
        spark.readStream.schema(df.schema).parquet(source), "hash", "id", "t", "2 hours", "10 minutes"), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == before


def test_repeats_are_dropped_as_they_arrive(spark, tmp_path):
    rows = [(i, f"h{i % 10}", f"2024-01-01 00:{i % 60:02d}:00") for i in range(50)]
    df = spark.createDataFrame(rows, "id long, hash string, t string").withColumn("t", F.col("t").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = dedup_stream.drop_repeats(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "hash", "t", "1 hour")
    dedup_stream.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r["hash"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(f"h{i}" for i in range(10))


def test_stream_gives_batch_features(spark, records, tmp_path):
    o = prepare.Options(**prepare.RECORD_OPTIONS)
    columns = ["prob_desc_description", "prob_desc_notes", "time_limit_seconds", "difficulty", "nb_latex_blocks", "unified_document"]
    batch = prepare.base_columns(readers.read_records(spark, records), o).select(*columns)
    stream = score_stream.base_feature_stream(score_stream.read_stream(spark, records), o).select(*columns)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(map(str, spark.read.schema(batch.schema).parquet(out).collect())) == sorted(map(str, batch.collect()))


def test_score_stream(spark, pipeline, parts, tmp_path):
    o, _, test = parts
    test.write.json(str(tmp_path / "in"))
    rows = spark.readStream.schema(test.schema).json(str(tmp_path / "in"))
    q = score_stream.score_stream(rows, pipeline, str(tmp_path / "out"), str(tmp_path / "state"))
    assert q.awaitTermination(240)
    assert spark.read.json(str(tmp_path / "out")).count() == test.count()


def _sparse_rows(spark, n=400):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        at = np.unique(rng.zipf(1.4, 12) % 60)
        x = rng.normal(size=2)
        y, z = int(x[0] + (5 in at) + rng.normal() > 0.6), int(rng.random() < 0.1 + 0.4 * (7 in at))
        values = [*(1.0 / (1 + at)).tolist(), *x.tolist(), 3.3]
        # Column 62 is the same everywhere, 63 is never set; one vector is dense.
        v = Vectors.sparse(64, [*at.tolist(), 60, 61, 62], values)
        rows.append((Vectors.dense(v.toArray()) if i == 5 else v, y, z, 0))
    return spark.createDataFrame(rows, ["features", "y", "z", "none"]).repartition(3)


@pytest.mark.parametrize("options", [{}, {"balanced": False}, {"max_iter": 4}, {"C": 0.2, "max_iter": 12}])
def test_labels_fitted_together_get_the_same_models(spark, options):
    """Coefficients of Spark ML's own estimator, label by label, and from one pass for all labels."""
    import numpy as np

    df, labels = _sparse_rows(spark), ["y", "z", "none"]
    alone, together = models.fit_labels(df, labels, **options), models.fit_labels(df, labels, together=True, **options)
    for c in labels:
        a, b = alone.models[c], together.models[c]
        assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-6)
        assert a.intercept == pytest.approx(b.intercept, abs=1e-6)


def test_an_iteration_passes_the_table_once_for_all_labels(spark, monkeypatch):
    from tagspark.operators import logistic

    passes, losses = [], logistic._losses
    monkeypatch.setattr(logistic, "_losses", lambda blocks, at, *a: passes.append(len(at)) or losses(blocks, at, *a))
    models.fit_labels(_sparse_rows(spark), ["y", "z"], together=True, max_iter=5)
    assert passes[:6] == [2] * 6 and len(passes) < 10


def test_training_fits_its_labels_together(spark, parts, monkeypatch):
    o, train, _ = parts
    asked, fit = [], models.fit_labels
    monkeypatch.setattr(models, "fit_labels", lambda *a, **k: asked.append(k.get("together")) or fit(*a, **k))
    training.train(train, o, shared_path(spark, "state"), tune=False, max_iter=2)
    assert asked == [True]
