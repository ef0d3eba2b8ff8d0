"""The pipeline's stages on the small tables and on odd rows."""

from pyspark.sql import functions as F

import corpus_pipeline
from helpers import ROWS, odd
from tagspark.llm import pii_crf

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_turn(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], folder).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(d.columns == DOCUMENTS for d in seen[:-1]) and seen[-1].columns[:5] == DOCUMENTS
    language, deduplicated, redacted, mixed, coded = seen[1:]
    assert language.count() >= 0.99 * docs.count()
    assert deduplicated.count() == deduplicated.select("doc_id").distinct().count() < language.count()
    assert redacted.count() == deduplicated.count()
    model = pii_crf.train()
    assert all(not b for b, _ in pii_crf.find([r["text"] for r in redacted.collect()], model))
    assert redacted.where(F.col("n_chars") != F.char_length("text")).count() == 0
    assert set(mixed.select("doc_id").distinct().collect()) <= set(redacted.select("doc_id").collect())
    assert coded.count() == mixed.count() and coded.where("n_pieces = 0 AND text <> ''").count() == 0
    total = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, total.select("doc_id", "n_pieces").collect())) == sorted(map(str, coded.select("doc_id", "n_pieces").collect()))


def test_stages_take_odd_rows(spark, tmp_path):
    # Names the stages use inside, a dot, a quote, and a column that has no hash.
    names = ["row", "key", "id", "hash", "content", "n", "take", "__r", "__row", "__n", "__id", "a.b", "tick`s"]
    docs = odd(spark).select(*DOCUMENTS).withColumns({n: F.lit(f"kept {n}") for n in names}).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for rows, name in ((docs, "all"), (docs.limit(0), "none")):
            stage(spark, rows, "").write.parquet(str(tmp_path / f"{name}{i}"))
        assert spark.read.parquet(str(tmp_path / f"none{i}")).count() == 0
        docs = spark.read.parquet(str(tmp_path / f"all{i}"))
        assert docs.columns[:19] == [*DOCUMENTS, *names, "m"]
        for r in docs.collect():
            assert all(r[n] == f"kept {n}" for n in names) and r["m"] == {"k": r["doc_id"]}
    assert 0 < docs.count() and len(ROWS) > docs.select("doc_id").distinct().count()
