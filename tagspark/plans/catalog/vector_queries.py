"""TF-IDF, scaling, embeddings and evaluation."""

from __future__ import annotations

from ...operators import embeddings as emb, metrics as met, tags as tag_ops, tfidf
from ...session import cut_lineage
from .base import *  # noqa: F403
from .profile_queries import DENSE, DENSE_SQL, dense

# TF-IDF ---------------------------------------------------------------------------

VOCAB_SQL = f"""WITH k AS (SELECT doc_id, regexp_extract_all(text, '[{WORD}]{{2,}}') AS k FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(k, list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]))) AS term FROM k),
dt AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
vocab AS (SELECT term, sum(tf)::BIGINT AS count, count(*) AS n_docs, ln((1 + n.n) / (1 + count(*))) + 1 AS idf
  FROM dt, n GROUP BY term, n.n HAVING count(*) >= 2 AND count(*) <= 0.95 * n.n
  ORDER BY sum(tf) DESC, term LIMIT 5000),
raw AS (SELECT doc_id, term, (1 + ln(tf::DOUBLE)) * idf AS w FROM dt JOIN vocab USING (term)),
cells AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
"""


def vocab_of(spark, folder):
    return tfidf.fit_vocabulary(documents(spark, folder), "text")


@query("vec1_tfidf_vocabulary", VOCAB_SQL + "SELECT term, count, n_docs, round(idf, 6) AS idf FROM vocab")
def vec1_vocab(spark, folder):
    return rounded(vocab_of(spark, folder), "idf")


@query("vec1_tfidf_weights", VOCAB_SQL + "SELECT doc_id, term, round(weight, 6) AS weight FROM cells")
def vec1(spark, folder):
    d = documents(spark, folder)
    return rounded(tfidf.transform(d, "text", "doc_id", vocab_of(spark, folder)), "weight")


@query("vec1_unit_norm", VOCAB_SQL + "SELECT doc_id, round(sum(weight * weight), 6) AS squared_norm, count(*) AS n_terms FROM cells GROUP BY 1")
def vec1_norm(spark, folder):
    d = documents(spark, folder)
    cells = tfidf.transform(d, "text", "doc_id", vocab_of(spark, folder))
    return cells.groupBy("doc_id").agg(
        rnd(F.sum(F.col("weight") * F.col("weight"))).alias("squared_norm"), F.count("*").alias("n_terms"))


@query("jn5_idf_lookup", VOCAB_SQL + "SELECT doc_id, round(sum(tf * idf), 4) AS score FROM dt JOIN vocab USING (term) GROUP BY 1")
def jn5(spark, folder):
    from ...operators.joins import with_doc_counts

    d = documents(spark, folder)
    terms = tfidf.tokenised(d, "text", "doc_id").select("doc_id", F.explode(tfidf.terms_of()).alias("term"))
    looked_up = with_doc_counts(terms, cut_lineage(vocab_of(spark, folder).select("term", "idf")), "term")
    return looked_up.groupBy("doc_id").agg(rnd(F.sum("idf"), 4).alias("score"))


@query("agg37_matrix_statistics", VOCAB_SQL + """
SELECT (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM vocab) AS vocabulary, count(*) AS nnz,
       round(count(*) / ((SELECT count(*) FROM documents) * (SELECT count(*) FROM vocab))::DOUBLE, 6) AS density FROM cells""")
def agg37(spark, folder):
    d, v = documents(spark, folder), vocab_of(spark, folder)
    return rounded(tfidf.matrix_statistics(d, tfidf.transform(d, "text", "doc_id", v), v), "density")


@query("top9_extreme_idf", VOCAB_SQL + """
(SELECT 'highest' AS side, term, n_docs, round(idf, 6) AS idf FROM vocab ORDER BY vocab.idf DESC, term LIMIT 30)
UNION ALL (SELECT 'lowest', term, n_docs, round(idf, 6) FROM vocab ORDER BY vocab.idf, term LIMIT 30)""")
def top9_idf(spark, folder):
    return rounded(tfidf.extreme_idf(vocab_of(spark, folder)), "idf")


@query("vec3_fit_scaler", CTE + DENSE_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END, 6) AS std FROM dense" for c in DENSE))
def vec3_fit(spark, folder):
    return rounded(tfidf.fit_scaler(dense(problems(spark, folder)), DENSE), "mean", "std")


@query("vec3_standardise", CTE + DENSE_SQL + "SELECT p_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM dense)) / (SELECT stddev_pop({c}) FROM dense), 6) AS {c}" for c in DENSE) + " FROM dense")
def vec3(spark, folder):
    d = dense(problems(spark, folder))
    out = tfidf.apply_scaler(d, tfidf.fit_scaler(d, DENSE), DENSE)
    return rounded(out.select("p_id", *DENSE), *DENSE)


# Embeddings -------------------------------------------------------------------------

LABELS = [str(i) for i in range(10)]
SIM_SQL = """WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) AS label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
names AS (SELECT unnest(['0','1','2','3','4','5','6','7','8','9']) AS tag),
u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e),
m AS (SELECT label AS tag, list(x ORDER BY pos) AS m FROM (SELECT label, pos, avg(x) AS x FROM u GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT tag, list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS c FROM m),
s AS (SELECT e.vec_id, n.tag, e.label = n.tag AS is_pos, coalesce(list_dot_product(e.v, c.c), 0) AS similarity FROM e CROSS JOIN names n LEFT JOIN c USING (tag))
"""


def vectors_of(spark, folder, cut=None):
    e = read_table(spark, folder, "embeddings")
    if cut is not None:
        e = e.withColumn("embedding", F.slice("embedding", *cut))
    return e.select("vec_id", "embedding", F.array(F.col("label").cast("string")).alias("tags"))


def sims_of(spark, folder):
    e = vectors_of(spark, folder)
    return emb.similarities(e, emb.class_centroids(e, "embedding", "tags", LABELS), "embedding", "vec_id", "tags", LABELS)


@query("emb2_class_centroids", SIM_SQL + """
SELECT n.tag, coalesce(k.n, 0) AS n_pos, p.pos AS position, round(coalesce(c.c[p.pos + 1], 0), 6) AS value
FROM names n LEFT JOIN c USING (tag) LEFT JOIN (SELECT label AS tag, count(*) AS n FROM e GROUP BY 1) k USING (tag)
CROSS JOIN (SELECT CAST(unnest(range(0, (SELECT max(len(v)) FROM e))) AS INTEGER) AS pos) p""")
def emb2(spark, folder):
    c = emb.class_centroids(vectors_of(spark, folder), "embedding", "tags", LABELS)
    return rounded(c.select("tag", "n_pos", F.posexplode("centroid").alias("position", "value")), "value")


@query("emb3_centroid_similarity", SIM_SQL + "SELECT vec_id, tag, is_pos, round(similarity, 6) AS similarity FROM s")
def emb3(spark, folder):
    return rounded(sims_of(spark, folder), "similarity")


@query("jn7_best_centroid", SIM_SQL + """
SELECT vec_id, tag AS best_tag, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, tag) AS k FROM s) WHERE k = 1""")
def jn7(spark, folder):
    best = F.max(F.struct(F.round("similarity", 9).alias("s"), (-F.col("tag").cast("int")).alias("t"), F.col("similarity").alias("v")))
    out = sims_of(spark, folder).groupBy("vec_id").agg(best.alias("b"))
    return out.select("vec_id", (-F.col("b.t")).cast("string").alias("best_tag"), rnd("b.v").alias("similarity"))


PAIR_SQL = SIM_SQL + ", pairs AS (SELECT a.tag AS tag_a, b.tag AS tag_b, list_dot_product(a.c, b.c) AS similarity FROM c a CROSS JOIN c b)\n"


def pairs_of(spark, folder):
    e = vectors_of(spark, folder)
    return emb.centroid_similarity(emb.class_centroids(e, "embedding", "tags", LABELS), LABELS)


@query("emb4_centroid_matrix", PAIR_SQL + "SELECT tag_a, tag_b, round(similarity, 6) AS similarity FROM pairs")
def emb4(spark, folder):
    return rounded(pairs_of(spark, folder), "similarity")


@query("emb4_off_diagonal", PAIR_SQL + """
SELECT round(min(similarity), 6) AS min, round(avg(similarity), 6) AS mean, round(quantile_cont(similarity, 0.5), 6) AS median,
       round(max(similarity), 6) AS max FROM pairs WHERE tag_a <> tag_b""")
def emb4_off(spark, folder):
    return rounded(emb.off_diagonal_mean(pairs_of(spark, folder)), "min", "mean", "median", "max")


@query("emb4_top_pairs", PAIR_SQL + """
SELECT tag_a, tag_b, round(similarity, 6) AS similarity FROM pairs WHERE tag_a < tag_b ORDER BY round(pairs.similarity, 9) DESC, tag_a, tag_b LIMIT 5""")
def emb4_top(spark, folder):
    return rounded(emb.top_centroid_pairs(pairs_of(spark, folder)), "similarity")


SEPARATION = ["mean_pos", "mean_neg", "median_pos", "median_neg", "std_pos", "std_neg", "delta_mean"]
SEPARATION_SQL = """SELECT tag, count(*) FILTER (is_pos) AS n_pos, count(*) FILTER (NOT is_pos) AS n_neg,
 avg(similarity) FILTER (is_pos) AS mean_pos, avg(similarity) FILTER (NOT is_pos) AS mean_neg,
 quantile_cont(similarity, 0.5) FILTER (is_pos) AS median_pos, quantile_cont(similarity, 0.5) FILTER (NOT is_pos) AS median_neg,
 stddev_pop(similarity) FILTER (is_pos) AS std_pos, stddev_pop(similarity) FILTER (NOT is_pos) AS std_neg,
 avg(similarity) FILTER (is_pos) - avg(similarity) FILTER (NOT is_pos) AS delta_mean FROM s GROUP BY tag"""


@query("emb5_separation", SIM_SQL + "SELECT tag, n_pos, n_neg, " + ", ".join(f"round({c}, 6) AS {c}" for c in SEPARATION) + f" FROM ({SEPARATION_SQL})")
def emb5(spark, folder):
    out = emb.separation(sims_of(spark, folder), LABELS)
    return rounded(out.select("tag", "n_pos", "n_neg", *SEPARATION), *SEPARATION)


@query("emb5_density", SIM_SQL + """
, b AS (SELECT tag, min(similarity) AS lo, (max(similarity) - min(similarity)) / 49 AS w FROM s GROUP BY 1),
z AS (SELECT tag, is_pos, count(*) AS n FROM s GROUP BY 1, 2)
SELECT s.tag, s.is_pos, CAST(least(floor((similarity - lo) / w), 48) AS INTEGER) AS bin, count(*) AS count,
       round(count(*) / (any_value(z.n) * any_value(w)), 6) AS density
FROM s JOIN b USING (tag) JOIN z ON z.tag = s.tag AND z.is_pos = s.is_pos GROUP BY 1, 2, 3""")
def emb5_density(spark, folder):
    return rounded(emb.similarity_density(sims_of(spark, folder)), "density")


@query("top8_closest_documents", SIM_SQL + """
SELECT vec_id, tag, is_pos, rank, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY tag, is_pos ORDER BY round(similarity, 9) DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def top8(spark, folder):
    return rounded(emb.closest_documents(sims_of(spark, folder), "vec_id"), "similarity")


@query("top11_rank_labels", SIM_SQL + f"""
SELECT tag, round(delta_mean, 6) AS delta_mean, row_number() OVER (ORDER BY round(delta_mean, 9) DESC, tag) AS rank FROM ({SEPARATION_SQL})""")
def top11(spark, folder):
    stats = emb.separation(sims_of(spark, folder), LABELS, medians=False).select(F.col("tag").alias("label"), "delta_mean")
    ranked = met.rank_labels(stats, "delta_mean").withColumnRenamed("label", "tag")
    return rounded(ranked, "delta_mean")


def embedder_sql(a, b, name):
    """CTEs of one embedding column, each name suffixed."""
    sql = SIM_SQL.replace("WITH e AS", f"e_{name} AS").replace("lambda x: x::DOUBLE) AS v", f"lambda x: x::DOUBLE)[{a}:{b}] AS v")
    for t in ("names", "u", "m", "c", "s"):
        sql = sql.replace(f"\n{t} AS", f"\n{t}_{name} AS")
    sql = sql.replace("FROM e)", f"FROM e_{name})").replace("FROM e CROSS JOIN names n LEFT JOIN c USING", f"FROM e_{name} e CROSS JOIN names_{name} n LEFT JOIN c_{name} c USING")
    sql = sql.replace("FROM u GROUP", f"FROM u_{name} GROUP").replace("AS c FROM m)", f"AS c FROM m_{name})")
    return sql.strip()


TWO_SQL = "WITH " + embedder_sql(1, 32, "head") + ",\n" + embedder_sql(33, 64, "tail") + "".join(f"""
, st_{n} AS ({SEPARATION_SQL.replace('FROM s ', f'FROM s_{n} ')}),
off_{n} AS (SELECT avg(list_dot_product(a.c, b.c)) AS m FROM c_{n} a CROSS JOIN c_{n} b WHERE a.tag <> b.tag)""" for n in ("head", "tail")) + "\n"


def embedder_summary_sql(n):
    return f"""SELECT '{n}' AS "column", round(avg(delta_mean), 6) AS mean_delta, round(sum(delta_mean * n_pos) / sum(n_pos), 6) AS weighted_delta,
 round((SELECT m FROM off_{n}), 6) AS centroid_similarity,
 (SELECT tag FROM st_{n} ORDER BY round(delta_mean, 9) DESC, tag DESC LIMIT 1) AS best_tag, round(max(delta_mean), 6) AS best_delta FROM st_{n}"""


def halves(spark, folder):
    e = vectors_of(spark, folder)
    return e.select("vec_id", "tags", F.slice("embedding", 1, 32).alias("head"), F.slice("embedding", 33, 32).alias("tail"))


@query("emb6_evaluate_embedder", TWO_SQL + embedder_summary_sql("head"))
def emb6(spark, folder):
    _, summary = emb.evaluate(halves(spark, folder), "head", "vec_id", "tags", LABELS, "head")
    return rounded(summary, "mean_delta", "weighted_delta", "centroid_similarity", "best_delta")


@query("emb7_compare_columns", TWO_SQL + embedder_summary_sql("head") + " UNION ALL " + embedder_summary_sql("tail"))
def emb7(spark, folder):
    summary, _ = emb.compare_columns(halves(spark, folder), {"head": "head", "tail": "tail"}, "vec_id", "tags", LABELS)
    return rounded(summary, "mean_delta", "weighted_delta", "centroid_similarity", "best_delta")


@query("emb7_delta_matrix", TWO_SQL + "SELECT tag, round(h.delta_mean, 6) AS head, round(t.delta_mean, 6) AS tail FROM st_head h JOIN st_tail t USING (tag)")
def emb7_matrix(spark, folder):
    _, cells = emb.compare_columns(halves(spark, folder), {"head": "head", "tail": "tail"}, "vec_id", "tags", LABELS)
    return rounded(cells, "head", "tail")


@query("emb7_text_coverage", CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(count(*) FILTER (length(trim({c})) > 0) * 100.0::DOUBLE / count(*), 6) AS coverage, round(avg(length({c})) FILTER (length(trim({c})) > 0), 6) AS avg_length FROM problems"
    for c in ["description", "input_spec", "output_spec", "notes"]))
def emb7_coverage(spark, folder):
    out = emb.text_coverage(problems(spark, folder), ["description", "input_spec", "output_spec", "notes"])
    return rounded(out, "coverage", "avg_length")


@query("emb1_word2vec")
def emb1(spark, folder):
    return emb.word2vec_embeddings(documents(spark, folder), "text", "doc_id", size=32)


@query("emb1_word2vec_shape", "SELECT doc_id, 32::BIGINT AS size, TRUE AS unit FROM documents")
def emb1_shape(spark, folder):
    """Every document has one vector, of length 1 or, without a known word, 0."""
    vectors = emb1(spark, folder)
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return vectors.select("doc_id", F.size("embedding").cast("bigint").alias("size"), ((norm == 0) | (F.abs(norm - 1) < 1e-6)).alias("unit"))


@query("emb1_random_projection", VOCAB_SQL + """, signs AS (SELECT term, i AS dim,
    CASE WHEN ((('0x' || substr(md5('42|' || (i // 32) || '|' || term), 1, 8))::BIGINT >> (i % 32)) & 1) = 1 THEN 1 ELSE -1 END AS s
  FROM vocab, range(64) AS r(i)),
sums AS (SELECT doc_id, dim, sum(weight * s) AS x FROM cells JOIN signs USING (term) GROUP BY 1, 2),
sized AS (SELECT doc_id, dim, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM sums)
SELECT d.doc_id, i AS dim, round(coalesce(x, 0), 6) AS value FROM documents d CROSS JOIN range(64) AS r(i)
LEFT JOIN sized z ON z.doc_id = d.doc_id AND z.dim = i""")
def emb1_projection(spark, folder):
    d = documents(spark, folder)
    projected = emb.projected_embeddings(tfidf.weights(d, "text", "doc_id", vocab_of(spark, folder)), "doc_id")
    cells = projected.select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return rounded(longs(cells, "dim"), "value")


# Evaluation ----------------------------------------------------------------------------

PRED_SQL = SIM_SQL + ", p AS (SELECT vec_id, tag AS label, CAST(is_pos AS INTEGER) AS y, (similarity + 1) / 2 AS p FROM s)\n"
CUT = 0.62


def scored(spark, folder):
    """Nearest-centroid scores of the labelled vectors."""
    return sims_of(spark, folder).select(
        "vec_id", F.col("tag").alias("label"), F.col("is_pos").cast("int").alias("y"), ((F.col("similarity") + 1) / 2).alias("p"))


def conf_sql(name, pred, source="p"):
    return f""", {name} AS (SELECT label, count(*) FILTER (y = 1 AND {pred}) AS tp, count(*) FILTER (y = 0 AND {pred}) AS fp,
 count(*) FILTER (y = 1 AND NOT {pred}) AS fn, count(*) FILTER (y = 0 AND NOT {pred}) AS tn FROM {source} GROUP BY 1)
"""


def overall_sql(conf):
    return f"""SELECT 2 * sum(tp) / nullif(2 * sum(tp) + sum(fp) + sum(fn), 0)::DOUBLE AS micro_f1,
 avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)) AS macro_f1,
 coalesce(sum(tp) / nullif(sum(tp) + sum(fp), 0)::DOUBLE, 0) AS micro_precision, sum(tp) / (sum(tp) + sum(fn))::DOUBLE AS micro_recall,
 (sum(fp) + sum(fn)) / sum(tp + fp + fn + tn)::DOUBLE AS hamming_loss FROM {conf}"""


def label_sql(conf):
    return f"""SELECT label, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
 coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall, tp + fn AS support FROM {conf}"""


BASE_SQL = PRED_SQL + conf_sql("c0", f"p >= {CUT}")


@query("met1_overall", BASE_SQL + "SELECT " + ", ".join(f"round({m}, 6) AS {m}" for m in met.METRICS) + f" FROM ({overall_sql('c0')})")
def met1(spark, folder):
    return rounded(met.overall(met.confusion(met.predict(scored(spark, folder), CUT))), *met.METRICS)


@query("met2_per_label", BASE_SQL + f"SELECT label, round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall, support FROM ({label_sql('c0')})")
def met2(spark, folder):
    out = met.per_label(met.confusion(met.predict(scored(spark, folder), CUT)))
    return rounded(out, "f1", "precision", "recall").orderBy(F.desc("f1"), "label")


THRESHOLD_SQL = ", g AS (SELECT unnest([" + ", ".join(f"{t!r}::DOUBLE" for t in met.THRESHOLDS) + """]) AS t),
tf AS (SELECT label, t, coalesce(2 * count(*) FILTER (y = 1 AND p >= t) / nullif(count(*) FILTER (y = 1) + count(*) FILTER (p >= t), 0)::DOUBLE, 0) AS f1 FROM p, g GROUP BY 1, 2),
best AS (SELECT label, CASE WHEN f1 > 0 THEN t ELSE 0.5 END AS t, f1 FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, t) AS k FROM tf) WHERE k = 1),
po AS (SELECT p.*, best.t FROM p JOIN best USING (label))
"""


@query("mod6_best_thresholds", PRED_SQL + THRESHOLD_SQL + "SELECT label, round(t, 6) AS threshold, round(f1, 6) AS f1 FROM best")
def mod6(spark, folder):
    return rounded(met.best_thresholds(scored(spark, folder)), "threshold", "f1")


BOTH_SQL = PRED_SQL + THRESHOLD_SQL + conf_sql("c0", f"p >= {CUT}") + conf_sql("c1", "p >= t", "po")


def before_after(spark, folder):
    p = scored(spark, folder)
    return met.confusion(met.predict(p, CUT)), met.confusion(met.predict_with(p, met.best_thresholds(p)))


@query("met3_compare_labels", BOTH_SQL + f"""
SELECT b.label, round(b.f1, 6) AS f1_before, round(a.f1, 6) AS f1_after, round(a.f1 - b.f1, 6) AS gain_f1, round(b.precision, 6) AS precision_before,
 round(a.precision, 6) AS precision_after, round(b.recall, 6) AS recall_before, round(a.recall, 6) AS recall_after, b.support
FROM ({label_sql('c0')}) b JOIN ({label_sql('c1')}) a USING (label)""")
def met3(spark, folder):
    before, after = before_after(spark, folder)
    out = met.compare_labels(met.per_label(before), met.per_label(after))
    return rounded(out, *[c for c in out.columns if c not in ("label", "support")])


@query("met3_compare_overall", BOTH_SQL + f", o0 AS ({overall_sql('c0')}), o1 AS ({overall_sql('c1')})" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(o0.{m}, 6) AS before, round(o1.{m}, 6) AS after, round(o1.{m} - o0.{m}, 6) AS gain, round((o1.{m} - o0.{m}) * 100 / nullif(o0.{m}, 0), 6) AS gain_pct FROM o0, o1" for m in met.METRICS))
def met3_overall(spark, folder):
    before, after = before_after(spark, folder)
    return rounded(met.compare_overall(met.overall(before), met.overall(after)), "before", "after", "gain", "gain_pct")


@query("met4_sample_scores", PRED_SQL + f"""
, d AS (SELECT vec_id, count(*) FILTER (y = 1 AND p >= {CUT}) AS inter, count(*) FILTER (y = 1 OR p >= {CUT}) AS uni,
  count(*) FILTER ((y = 1) <> (p >= {CUT})) AS wrong FROM p GROUP BY 1)
SELECT round(avg((wrong = 0)::INTEGER), 6) AS subset_accuracy, round(avg(coalesce(inter / nullif(uni, 0)::DOUBLE, 0)), 6) AS jaccard FROM d""")
def met4(spark, folder):
    return rounded(met.sample_scores(met.predict(scored(spark, folder), CUT), "vec_id"), "subset_accuracy", "jaccard")


CUTS = {"loose": 0.55, "middle": 0.62, "tight": 0.7}


@query("met5_compare_models", PRED_SQL + "".join(conf_sql(f"m_{n}", f"p >= {t}") for n, t in CUTS.items()) + " UNION ALL ".join(
    f"SELECT '{n}' AS model, " + ", ".join(f"round({m}, 6) AS {m}" for m in met.METRICS) + f" FROM ({overall_sql(f'm_{n}')})" for n in CUTS))
def met5(spark, folder):
    p = scored(spark, folder)
    return rounded(met.compare_models({n: met.overall(met.confusion(met.predict(p, t))) for n, t in CUTS.items()}), *met.METRICS)


@query("mod4_class_weights", " UNION ALL ".join(
    f"SELECT '{c}' AS label, round(count(*) / (2.0::DOUBLE * count(*) FILTER ({c} = 0)), 6) AS weight_0, round(count(*) / (2.0::DOUBLE * count(*) FILTER ({c} = 1)), 6) AS weight_1 FROM labels"
    for c in ("quality", "toxic")))
def mod4(spark, folder):
    return rounded(met.class_weights(read_table(spark, folder, "labels"), ["quality", "toxic"]), "weight_0", "weight_1")


@query("sco3_decode_labels", PRED_SQL + f"""
SELECT vec_id, coalesce(string_agg(label, '|' ORDER BY label) FILTER (p >= {CUT}), '') AS predicted_tags, count(*) FILTER (p >= {CUT}) AS num_tags FROM p GROUP BY 1""")
def sco3(spark, folder):
    from ..scoring import decode

    p = met.predict(scored(spark, folder), CUT)
    wide = p.groupBy("vec_id").agg(*[F.max(F.when(F.col("label") == t, F.col("pred"))).alias(f"pred_{t}") for t in LABELS])
    out = decode(wide, "vec_id", LABELS, [f"pred_{t}" for t in LABELS])
    return longs(out.withColumn("predicted_tags", F.array_join("predicted_tags", "|")).select("vec_id", "predicted_tags", "num_tags"), "num_tags")


@query("agg27_feature_probability_correlation", PRED_SQL + ", f AS (SELECT vec_id, " + ", ".join(f"v[{i + 1}] AS f{i}" for i in range(6)) + ", 1.0::DOUBLE AS constant FROM e), w AS (SELECT p.vec_id, label, p, f.* EXCLUDE (vec_id) FROM p JOIN f USING (vec_id))\n" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, label, round(coalesce(CASE WHEN isnan(corr({f}, p)) THEN 0 ELSE corr({f}, p) END, 0), 6) AS r FROM w GROUP BY label" for f in [f"f{i}" for i in range(6)] + ["constant"]))
def agg27(spark, folder):
    from ...operators.profile import feature_label_correlation

    features = [f"f{i}" for i in range(6)] + ["constant"]
    e = vectors_of(spark, folder).select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(6)], F.lit(1.0).alias("constant"))
    p = scored(spark, folder).groupBy("vec_id").agg(*[F.max(F.when(F.col("label") == t, F.col("p"))).alias(f"p{t}") for t in LABELS])
    out = feature_label_correlation(e.join(p, "vec_id"), features, [f"p{t}" for t in LABELS], constant_as_zero=True)
    return rounded(out.withColumn("label", F.substring("label", 2, 10)), "r")
