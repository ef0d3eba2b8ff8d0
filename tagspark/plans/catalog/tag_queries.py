"""Tag projections, counts and associations over the problems view."""

from __future__ import annotations

from ...operators import tags as ops
from .base import *  # noqa: F403

PAIRS_SQL = f"""singles AS (SELECT tag, count(*) AS n FROM priority GROUP BY tag),
joint AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n
          FROM priority a JOIN priority b ON a.p_id = b.p_id GROUP BY 1, 2),
lift AS (
  SELECT a.tag AS tag_a, b.tag AS tag_b, coalesce(j.n, 0) AS cnt, a.n AS n_a, b.n AS n_b,
         (coalesce(j.n, 0) / t.total) / ((a.n / t.total) * (b.n / t.total)) AS lift
  FROM singles a JOIN singles b ON a.tag < b.tag
  LEFT JOIN joint j ON j.tag_a = a.tag AND j.tag_b = b.tag
  CROSS JOIN (SELECT count(*)::DOUBLE AS total FROM problems) t)
"""


@query("prj6_priority_tags", CTE + f"""
SELECT p_id, coalesce(array_to_string(list_filter(string_split(tags_csv, ','), lambda t: t IN ({PRIORITY_SQL})), '|'), '') AS tags_priority
FROM problems""")
def prj6(spark, folder):
    return problems(spark, folder).select(
        "p_id", F.array_join(ops.keep_tags("tags"), "|").alias("tags_priority"))


def _targets_sql(order, underscore):
    return ",\n".join(
        f"CAST(coalesce(list_contains(string_split(tags_csv, ','), '{t}'), false) AS INTEGER) AS "
        f"\"target_{t.replace(' ', '_') if underscore else t}\"" for t in order)


@query("prj7_multilabel_target", CTE + f"SELECT p_id, {_targets_sql(PRIORITY_TAGS, True)} FROM problems")
def prj7(spark, folder):
    return problems(spark, folder).select("p_id", *ops.target_columns("tags"))


@query("prj7_label_binarizer", CTE + f"SELECT p_id, {_targets_sql(sorted(PRIORITY_TAGS), False)} FROM problems")
def prj7_binarizer(spark, folder):
    return problems(spark, folder).select("p_id", *ops.target_columns("tags", alphabetical=True, underscore=False))


@query("prj8_tag_examples", CTE + """
SELECT p_id, description, source_code, tags_csv, difficulty FROM problems
WHERE list_contains(string_split(tags_csv, ','), 'graphs') ORDER BY p_id LIMIT 3""")
def prj8(spark, folder):
    return ops.tag_examples(
        problems(spark, folder), "graphs", 3,
        ["p_id", "description", "source_code", "tags_csv", "difficulty"], "p_id")


@query("prj9_any_priority", CTE + """
SELECT p.p_id, p.p_id IN (SELECT p_id FROM priority) AS has_priority FROM problems p""")
def prj9(spark, folder):
    return problems(spark, folder).select("p_id", ops.has_any_tag("tags").alias("has_priority"))


@query("prj15_pair_flags", CTE + """
SELECT p_id,
  CAST(coalesce(list_contains(string_split(tags_csv, ','), 'graphs') AND list_contains(string_split(tags_csv, ','), 'trees'), false) AS INTEGER) AS has_graphs_and_trees,
  CAST(coalesce(list_contains(string_split(tags_csv, ','), 'math') AND list_contains(string_split(tags_csv, ','), 'number theory'), false) AS INTEGER) AS has_math_and_number_theory
FROM problems""")
def prj15(spark, folder):
    return problems(spark, folder).select(
        "p_id",
        ops.pair_flag("tags", "graphs", "trees").alias("has_graphs_and_trees"),
        ops.pair_flag("tags", "math", "number theory").alias("has_math_and_number_theory"))


@query("agg1_tag_statistics", CTE + f"""
SELECT tag, count(*) AS count, round(count(*) / (SELECT count(*) FROM problems)::DOUBLE, 6) AS frequency,
       tag IN ({PRIORITY_SQL}) AS is_priority
FROM tagged GROUP BY tag""")
def agg1(spark, folder):
    return rounded(ops.tag_statistics(problems(spark, folder)), "frequency").orderBy(F.desc("count"), "tag")


@query("agg2_priority_coverage", CTE + """
SELECT count(*) AS total_samples, count(q.p_id) AS samples_with_priority_tag,
       round(count(q.p_id) * 100.0::DOUBLE / count(*), 6) AS coverage_percentage,
       count(*) - count(q.p_id) AS samples_without_priority_tag
FROM problems p LEFT JOIN (SELECT DISTINCT p_id FROM priority) q USING (p_id)""")
def agg2(spark, folder):
    return rounded(ops.priority_coverage(problems(spark, folder)), "coverage_percentage")


@query("agg3_cooccurrence", CTE + """
SELECT a.tag AS tag_a, b.tag AS tag_b, count(j.tag_a) AS count
FROM ptags a CROSS JOIN ptags b
LEFT JOIN (SELECT x.tag AS tag_a, y.tag AS tag_b FROM priority x JOIN priority y USING (p_id)) j
  ON j.tag_a = a.tag AND j.tag_b = b.tag
GROUP BY 1, 2""")
def agg3(spark, folder):
    return ops.cooccurrence_matrix(problems(spark, folder))


@query("agg4_cooccurrence_normalised", CTE + """
, j AS (SELECT x.tag AS tag_a, y.tag AS tag_b, count(*) AS n FROM priority x JOIN priority y USING (p_id) GROUP BY 1, 2)
SELECT a.tag AS tag_a, b.tag AS tag_b,
       round(CASE WHEN a.tag <> b.tag AND coalesce(d.n, 0) > 0 THEN coalesce(j.n, 0) / d.n::DOUBLE
                  ELSE coalesce(j.n, 0)::DOUBLE END, 6) AS value
FROM ptags a CROSS JOIN ptags b
LEFT JOIN j ON j.tag_a = a.tag AND j.tag_b = b.tag
LEFT JOIN j d ON d.tag_a = a.tag AND d.tag_b = a.tag""")
def agg4(spark, folder):
    return rounded(ops.cooccurrence_normalised(problems(spark, folder)), "value")


@query("agg5_top_pairs", CTE + """
SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS count
FROM priority a JOIN priority b ON a.p_id = b.p_id AND a.tag < b.tag
GROUP BY 1, 2 ORDER BY count DESC, tag_a, tag_b LIMIT 5""")
def agg5(spark, folder):
    return ops.pair_counts(problems(spark, folder)).orderBy(F.desc("count"), "tag_a", "tag_b").limit(5)


LIFT_COLUMNS = ["lift", "pmi", "p_b_given_a", "p_a_given_b"]


@query("agg6_lift_pmi", CTE + "," + PAIRS_SQL + """
SELECT tag_a, tag_b, cnt AS count, round(lift, 6) AS lift,
       round(CASE WHEN lift > 0 THEN ln(lift) ELSE 0 END, 6) AS pmi
FROM lift""")
def agg6(spark, folder):
    pairs = ops.lift_pmi(problems(spark, folder)).select("tag_a", "tag_b", "count", "lift", "pmi")
    return rounded(pairs, "lift", "pmi").orderBy(F.desc("lift"), "tag_a", "tag_b")


@query("agg6_lift_pmi_all_tags", CTE + "," + PAIRS_SQL.replace("priority", "tagged") + """
SELECT tag_a, tag_b, cnt AS count, round(lift, 6) AS lift,
       round(CASE WHEN lift > 0 THEN ln(lift) ELSE 0 END, 6) AS pmi
FROM lift""")
def agg6_all(spark, folder):
    pairs = ops.lift_pmi(problems(spark, folder), allowed=None).select("tag_a", "tag_b", "count", "lift", "pmi")
    return rounded(pairs, "lift", "pmi")


@query("agg7_lift_conditional", CTE + "," + PAIRS_SQL + """
SELECT tag_a, tag_b, cnt AS count, round(lift, 6) AS lift,
       round(CASE WHEN lift > 0 THEN ln(lift) ELSE 0 END, 6) AS pmi,
       round(cnt / n_a::DOUBLE, 6) AS p_b_given_a, round(cnt / n_b::DOUBLE, 6) AS p_a_given_b
FROM lift""")
def agg7(spark, folder):
    return rounded(ops.lift_pmi(problems(spark, folder), membership=True), *LIFT_COLUMNS)


@query("agg8_lift_matrix", CTE + "," + PAIRS_SQL + """
SELECT a.tag AS row_tag, b.tag AS col_tag, round(coalesce(l.lift, 1.0), 6) AS lift
FROM ptags a CROSS JOIN ptags b
LEFT JOIN lift l ON l.tag_a = least(a.tag, b.tag) AND l.tag_b = greatest(a.tag, b.tag)""")
def agg8(spark, folder):
    return rounded(ops.lift_matrix(ops.lift_pmi(problems(spark, folder))), "lift")


@query("agg9_tag_distribution", CTE + """
, per AS (
  SELECT 'all' AS scope, count(t.tag) AS n FROM problems p LEFT JOIN tagged t USING (p_id) GROUP BY p.p_id
  UNION ALL SELECT 'priority', count(*) FROM priority GROUP BY p_id)
SELECT scope, count(*) AS samples, min(n)::BIGINT AS min_tags, max(n)::BIGINT AS max_tags,
       round(avg(n), 6) AS mean_tags, round(quantile_cont(n, 0.5), 6)::DOUBLE AS median_tags,
       round(stddev_samp(n), 6) AS std_tags,
       count(*) FILTER (n = 1) AS mono, count(*) FILTER (n <> 1) AS multi,
       round(count(*) FILTER (n = 1) * 100.0::DOUBLE / count(*), 6) AS mono_pct,
       round(count(*) FILTER (n <> 1) * 100.0::DOUBLE / count(*), 6) AS multi_pct
FROM per GROUP BY scope""")
def agg9(spark, folder):
    stats = ops.tag_distribution(problems(spark, folder))
    stats = longs(stats, "min_tags", "max_tags")
    return rounded(stats, "mean_tags", "median_tags", "std_tags", "mono_pct", "multi_pct")


@query("agg10_label_density", CTE + """
SELECT max(u.n) AS unique_tags, round(avg(c.n / u.n::DOUBLE), 6) AS mean_density,
       round(min(c.n / u.n::DOUBLE), 6) AS min_density, round(max(c.n / u.n::DOUBLE), 6) AS max_density
FROM (SELECT count(t.tag) AS n FROM problems p LEFT JOIN tagged t USING (p_id) GROUP BY p.p_id) c
CROSS JOIN (SELECT count(DISTINCT tag) AS n FROM tagged) u""")
def agg10(spark, folder):
    return rounded(ops.label_density(problems(spark, folder)), "mean_density", "min_density", "max_density")


@query("agg10_tag_combinations", CTE + """
, combos AS (
  SELECT p.p_id, coalesce(string_agg(t.tag, '|' ORDER BY t.tag), '') AS combination
  FROM problems p LEFT JOIN tagged t USING (p_id) GROUP BY p.p_id)
SELECT combination, count(*) AS count FROM combos GROUP BY 1 ORDER BY count DESC, combination LIMIT 10""")
def agg10_combos(spark, folder):
    return ops.tag_combinations(problems(spark, folder)).orderBy(F.desc("count"), "combination").limit(10)


@query("agg11_means_by_tag", CTE + """
SELECT tag, count(*) AS count, round(avg(difficulty), 6) AS avg_difficulty,
       round(avg(length(source_code)), 6) AS avg_code_length, round(avg(length(description)), 6) AS avg_desc_length
FROM priority JOIN problems USING (p_id) GROUP BY tag""")
def agg11(spark, folder):
    values = {"avg_difficulty": F.col("difficulty"), "avg_code_length": F.length("source_code"),
              "avg_desc_length": F.length("description")}
    return rounded(ops.means_by_tag(problems(spark, folder), values), *values)


@query("agg12_numeric_stats_by_tag", CTE + """
SELECT tag, count(difficulty) AS count, round(avg(difficulty), 6) AS mean,
       round(quantile_cont(difficulty, 0.5), 6) AS median, round(stddev_samp(difficulty), 6) AS std,
       round(min(difficulty), 6) AS min, round(max(difficulty), 6) AS max
FROM priority JOIN problems USING (p_id) WHERE difficulty IS NOT NULL GROUP BY tag""")
def agg12(spark, folder):
    stats = ops.numeric_by_tag(problems(spark, folder), "difficulty")
    stats = stats.select("tag", "count", "mean", F.col("q")[0].alias("median"), "std", "min", "max")
    return rounded(stats, "mean", "median", "std", "min", "max")


@query("agg13_rates_by_tag", CTE + """
SELECT tag, count(*) AS count,
       round(avg(CASE WHEN exec_outcome = 'PASSED' THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS passed_rate,
       round(avg(CASE WHEN notes IS NULL THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS notes_missing_rate,
       round(avg(length(array_to_string(regexp_extract_all(description, '\\$\\$\\$[^\\n]*?\\$\\$\\$'), '')) / length(description)::DOUBLE), 6) AS latex_density
FROM priority JOIN problems USING (p_id) GROUP BY tag""")
def agg13(spark, folder):
    from ...functions import latex

    values = {
        "passed_rate": (F.col("exec_outcome") == "PASSED").cast("double"),
        "notes_missing_rate": F.col("notes").isNull().cast("double"),
        "latex_density": latex.profile(F.col("description"))["latex_density"],
    }
    return rounded(ops.means_by_tag(problems(spark, folder), values), *values)


RAW_SQL = CTE + """
, raw AS (
  SELECT CASE WHEN p_id % 3 = 0 THEN upper(tag) WHEN p_id % 3 = 1 THEN ' ' || tag ELSE tag END AS tag FROM tagged),
variants AS (SELECT tag, count(*) AS n FROM raw GROUP BY tag)
"""


def dirty(spark, folder):
    i = F.col("p_id")
    return problems(spark, folder).withColumn(
        "tags",
        F.transform("tags", lambda t: F.when(i % 3 == 0, F.upper(t)).when(i % 3 == 1, F.concat(F.lit(" "), t)).otherwise(t)))


@query("agg20_normalisation_audit", RAW_SQL + """
SELECT lower(trim(tag)) AS normal_form, count(*) AS variants, string_agg(tag, '|' ORDER BY tag) AS raw_forms,
       sum(n)::BIGINT AS occurrences
FROM variants GROUP BY 1 HAVING count(*) > 1""")
def agg20(spark, folder):
    return ops.normalisation_audit(dirty(spark, folder)).where("variants > 1")


@query("agg20_raw_forms", RAW_SQL + "SELECT lower(trim(tag)) AS normal_form, tag AS raw_form, n AS occurrences FROM variants")
def agg20_rows(spark, folder):
    return ops.raw_forms(dirty(spark, folder))


@query("agg30_tags_per_sample", CTE + """
, per AS (SELECT count(t.tag) AS n, count(q.tag) AS np FROM problems p
          LEFT JOIN tagged t USING (p_id) LEFT JOIN priority q ON q.p_id = p.p_id AND q.tag = t.tag GROUP BY p.p_id)
SELECT round(avg(n), 6) AS avg_total_tags, round(quantile_cont(n, 0.5), 6)::DOUBLE AS median_total_tags,
       round(avg(np), 6) AS avg_priority_tags, count(*) FILTER (np > 0) AS samples_with_priority,
       round(count(*) FILTER (np > 0) * 100.0::DOUBLE / count(*), 6) AS coverage_percentage
FROM per""")
def agg30_tags(spark, folder):
    return rounded(ops.tags_per_row_summary(problems(spark, folder)),
                   "avg_total_tags", "median_total_tags", "avg_priority_tags", "coverage_percentage")


@query("agg6_order_baskets", """
WITH baskets AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
singles AS (SELECT p_brand AS tag, count(*) AS n FROM baskets GROUP BY 1),
joint AS (SELECT a.p_brand AS tag_a, b.p_brand AS tag_b, count(*) AS n FROM baskets a JOIN baskets b USING (l_orderkey) GROUP BY 1, 2)
SELECT a.tag AS tag_a, b.tag AS tag_b, coalesce(j.n, 0) AS count,
       round((coalesce(j.n, 0) / t.total) / ((a.n / t.total) * (b.n / t.total)), 6) AS lift
FROM singles a JOIN singles b ON a.tag < b.tag
LEFT JOIN joint j ON j.tag_a = a.tag AND j.tag_b = b.tag
CROSS JOIN (SELECT count(DISTINCT l_orderkey)::DOUBLE AS total FROM baskets) t""")
def agg6_baskets(spark, folder):
    items = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = read_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    baskets = items.join(parts, "l_partkey").groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("tags"))
    pairs = ops.lift_pmi(baskets, allowed=None, membership=True)
    return rounded(pairs.select("tag_a", "tag_b", "count", "lift"), "lift")


@query("agg6_frequent_pairs", r"""WITH words AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS tag FROM conversations),
singles AS (SELECT tag, count(*) AS n FROM words GROUP BY tag),
pairs AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS count FROM words a JOIN words b USING (conv_id, turn) WHERE a.tag < b.tag GROUP BY 1, 2 HAVING count(*) >= 10)
SELECT tag_a, tag_b, count, round(count * t.n / (a.n * b.n)::DOUBLE, 6) AS lift, round(ln(count * t.n / (a.n * b.n)::DOUBLE), 6) AS pmi
FROM pairs JOIN singles a ON a.tag = tag_a JOIN singles b ON b.tag = tag_b CROSS JOIN (SELECT count(*) AS n FROM conversations) t""")
def agg6_frequent(spark, folder):
    """Words of a turn as an open vocabulary of tags."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    pairs = ops.frequent_pairs(read_table(spark, folder, "conversations").select(words.alias("tags")), min_count=10)
    return rounded(pairs.select("tag_a", "tag_b", "count", "lift", "pmi"), "lift", "pmi")
