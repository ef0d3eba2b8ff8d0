"""Validation, profiles, distributions, correlations and fill statistics."""

from __future__ import annotations

from ...constants import IMPORT_MODULES, TAG_KEYWORDS
from ...functions import code, latex, numeric, text
from ...operators import keywords, profile as ops, splits, tags as tag_ops, validation
from .base import *  # noqa: F403
from .text_queries import BLOCKS_RE, KEYWORD_TABLE, PATTERN_SQL, SECONDS_SQL, keyword_table

RECORD = ["p_id", "src_uid", "lang", "description", "notes", "time_limit", "difficulty", "tags_csv", "source_code", "exec_outcome"]
WITH_MISSING = ["notes", "time_limit", "difficulty", "tags_csv"]


def missing_sql(columns, source="problems"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_percentage FROM {source}" for c in columns)


@query("val1_validate", CTE + """
SELECT 'stat' AS severity, NULL AS "column", 'n_features' AS message, 10::BIGINT AS n
UNION ALL SELECT 'error', 'unified_document', 'no such column', NULL
UNION ALL SELECT 'error', 'time_limit', 'holds string, not numbers', NULL
UNION ALL SELECT 'stat', NULL, 'n_samples', count(*) FROM problems
UNION ALL SELECT 'warning', 'difficulty', 'some values are missing', count(*) FILTER (difficulty IS NULL) FROM problems
UNION ALL SELECT 'warning', 'time_limit', 'some values are missing', count(*) FILTER (time_limit IS NULL) FROM problems
UNION ALL SELECT 'warning', 'notes', 'some values are missing', count(*) FILTER (notes IS NULL) FROM problems""")
def val1(spark, folder):
    p = problems(spark, folder).select(*RECORD)
    return validation.validate(p, ["tags_csv", "unified_document"], ["difficulty", "time_limit"], ["description", "notes"])


@query("val2_require_text", CTE + "SELECT p_id, length(description) AS n FROM problems WHERE description <> ''")
def val2(spark, folder):
    p = problems(spark, folder)
    validation.require_text(p, "description")
    return p.where("description <> ''").select("p_id", F.length("description").cast("bigint").alias("n"))


@query("val3_step_audit", CTE + """
SELECT 'drop untagged' AS step, count(*) AS rows_before, count(tags_csv) AS rows_after,
       count(tags_csv) - count(*) AS change, round((count(tags_csv) - count(*)) * 100.0::DOUBLE / count(*), 6) AS change_pct FROM problems""")
def val3(spark, folder):
    p = problems(spark, folder)
    return rounded(validation.step_audit("drop untagged", p, p.where("tags_csv IS NOT NULL")), "change_pct")


@query("agg14_missing_by_difficulty", CTE + """
, b AS (SELECT CASE WHEN difficulty > 0 AND difficulty <= 1200 THEN 'Easy' WHEN difficulty > 1200 AND difficulty <= 1600 THEN 'Medium'
  WHEN difficulty > 1600 AND difficulty <= 2000 THEN 'Hard' WHEN difficulty > 2000 AND difficulty <= 3500 THEN 'Very Hard' END AS difficulty_bin,
  CASE WHEN notes IS NULL THEN 1.0::DOUBLE ELSE 0.0 END AS m FROM problems)
SELECT difficulty_bin, count(*) AS count, round(avg(m), 6) AS missing_rate FROM b WHERE difficulty_bin IS NOT NULL GROUP BY 1""")
def agg14(spark, folder):
    out = ops.missing_by_difficulty(problems(spark, folder), F.col("notes").isNull(), numeric.difficulty_bin(F.col("difficulty")))
    return rounded(out, "missing_rate")


@query("agg15_language_distribution", """
SELECT lang, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS percentage
FROM documents GROUP BY 1""")
def agg15(spark, folder):
    return ops.category_distribution(documents(spark, folder), "lang", digits=2)


@query("agg15_exec_outcome_distribution", CTE + """
SELECT exec_outcome, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM problems), 6) AS percentage
FROM problems GROUP BY 1""")
def agg15_exec(spark, folder):
    return rounded(ops.category_distribution(problems(spark, folder), "exec_outcome"), "percentage")


@query("agg16_missing_profile", CTE + missing_sql(RECORD))
def agg16(spark, folder):
    return rounded(ops.missing_profile(problems(spark, folder).select(*RECORD)), "missing_percentage").orderBy(
        F.desc("missing_count"), "column")


@query("agg17_dataset_summary", CTE + f"""
SELECT 'table' AS section, 'rows' AS name, count(*) AS count, NULL::DOUBLE AS percentage FROM problems
UNION ALL SELECT 'table', 'columns', {len(RECORD) + len(PRIORITY_TAGS)}, NULL
UNION ALL SELECT 'missing', "column", missing_count, missing_percentage FROM ({missing_sql(WITH_MISSING)}) WHERE missing_count > 0
UNION ALL SELECT 'target', t.tag, count(p.p_id), round(count(p.p_id) * 100.0::DOUBLE / (SELECT count(*) FROM problems), 6)
FROM ptags t LEFT JOIN priority p USING (tag) GROUP BY t.tag""")
def agg17(spark, folder):
    p = problems(spark, folder).select(*RECORD, *tag_ops.target_columns("tags"))
    return rounded(ops.dataset_summary(p), "percentage")


BOOK = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
BOOK_NUMERIC = ["p_partkey", "p_size", "p_retailprice"]


def databook_sql():
    parts = []
    for c in BOOK:
        num = c in BOOK_NUMERIC
        mean = f"round(avg({c}), 6)" if num else "NULL::DOUBLE"
        median = f"round(quantile_cont({c}::DOUBLE, 0.5), 6)" if num else "NULL::DOUBLE"
        common = f"CAST(round({c}::DOUBLE, 6) AS VARCHAR)" if num else c
        parts.append(f"""SELECT '{c}' AS "column", 'Original' AS category, count(*) AS n_total, count(*) - count({c}) AS n_missing,
          0.0::DOUBLE AS pct_missing, 'No missing values' AS imputation_rule, count(DISTINCT {c}) AS n_unique,
          {mean} AS mean, {median} AS median,
          (SELECT n FROM (SELECT {c} AS v, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) AS most_common_count,
          (SELECT {common.replace(c, 'v')} FROM (SELECT {c} AS v, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) AS most_common
          FROM part""")
    return " UNION ALL ".join(parts)


@query("agg18_databook", databook_sql())
def agg18(spark, folder):
    book = ops.databook(read_table(spark, folder, "part").select(*BOOK))
    return rounded(book, "pct_missing", "mean", "median")


@query("agg18_databook_categories", CTE + """
SELECT CASE WHEN "column" IN ('p_id', 'tags_csv') THEN 'Key' ELSE 'Original' END AS category,
       count(*) AS n_variables, sum(missing_count)::BIGINT AS total_missing
FROM (""" + missing_sql(RECORD) + ") GROUP BY 1")
def agg18_categories(spark, folder):
    book = ops.databook(problems(spark, folder).select(*RECORD), {"p_id": "Key", "tags_csv": "Key"})
    return ops.databook_categories(book)


@query("agg19_uniqueness", """
WITH c AS (SELECT url, count(*) AS n FROM pages GROUP BY 1)
SELECT (SELECT count(*) FROM pages) AS rows, count(url) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
       coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_with_repeated_key, count(url) = (SELECT count(*) FROM pages) AS is_unique FROM c""")
def agg19(spark, folder):
    return ops.uniqueness(read_table(spark, folder, "pages"), "url")


@query("agg19_repeated_keys", "SELECT user_id, count(*) AS count FROM events GROUP BY 1 HAVING count(*) > 1")
def agg19_keys(spark, folder):
    return ops.repeated_keys(read_table(spark, folder, "events"), "user_id")


DENSE_SQL = f""", dense AS (SELECT p_id, tags_csv, nullif(difficulty, -1) AS difficulty, {SECONDS_SQL} AS time_limit_seconds,
  len(regexp_extract_all(description, '{BLOCKS_RE}'))::DOUBLE AS nb_latex_blocks, length(description)::DOUBLE AS char_length FROM problems)
"""
DENSE = ["difficulty", "time_limit_seconds", "nb_latex_blocks", "char_length"]


def dense(p):
    d = F.col("description")
    return p.select(
        "p_id", "tags", numeric.sentinel_to_null(F.col("difficulty")).alias("difficulty"),
        numeric.parse_time_limit(F.col("time_limit")).alias("time_limit_seconds"),
        F.size(latex.blocks(d)).cast("double").alias("nb_latex_blocks"), F.length(d).cast("double").alias("char_length"))


def fill_sql(strategy):
    def one(c):
        if strategy == "median":
            return f"quantile_cont({c}, 0.5)"
        if strategy == "mean":
            return f"avg({c})"
        return f"(SELECT {c} FROM dense WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"
    return CTE + DENSE_SQL + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round({one(c)}, 6) AS value" + (" FROM dense" if strategy != "mode" else "") for c in DENSE)


@query("agg24_fill_median", fill_sql("median"))
def agg24_median(spark, folder):
    return rounded(ops.fill_statistics(dense(problems(spark, folder)), DENSE, "median"), "value")


@query("agg24_fill_mean", fill_sql("mean"))
def agg24_mean(spark, folder):
    return rounded(ops.fill_statistics(dense(problems(spark, folder)), DENSE, "mean"), "value")


@query("agg24_fill_mode", fill_sql("mode"))
def agg24_mode(spark, folder):
    return rounded(ops.fill_statistics(dense(problems(spark, folder)), DENSE, "mode"), "value")


@query("agg24_impute", CTE + DENSE_SQL + """
SELECT p_id, round(coalesce(difficulty, (SELECT quantile_cont(difficulty, 0.5) FROM dense)), 6) AS difficulty,
       round(coalesce(time_limit_seconds, (SELECT quantile_cont(time_limit_seconds, 0.5) FROM dense)), 6) AS time_limit_seconds FROM dense""")
def agg24_impute(spark, folder):
    d = dense(problems(spark, folder))
    columns = ["difficulty", "time_limit_seconds"]
    out = ops.fill_missing(d, ops.fill_statistics(d, columns), columns)
    return rounded(out.select("p_id", *columns), *columns)


@query("agg24_mode_of_text", CTE + """
SELECT p_id, coalesce(notes, (SELECT notes FROM problems WHERE notes IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, notes LIMIT 1)) AS notes FROM problems""")
def agg24_text(spark, folder):
    p = problems(spark, folder)
    return p.select("p_id", F.coalesce("notes", ops.mode_of_text(p, "notes")).alias("notes"))


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def corr_sql(columns, table, a_name="column_a", b_name="column_b"):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS {a_name}, '{b}' AS {b_name}, round(corr({a}, {b}), 6) AS r FROM {table}"
        for i, a in enumerate(columns) for b in columns[i + 1:])


@query("agg25_correlation_matrix", corr_sql(LINE_COLUMNS, "lineitem"))
def agg25(spark, folder):
    return rounded(ops.correlation_pairs(read_table(spark, folder, "lineitem"), LINE_COLUMNS), "r")


CHARGE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "charge"]


@query("agg25_strong_pairs", "WITH charged AS (SELECT *, l_extendedprice * (1 - l_discount) AS charge FROM lineitem) "
       + f"SELECT * FROM ({corr_sql(CHARGE_COLUMNS, 'charged')}) WHERE abs(r) > 0.3")
def agg25_strong(spark, folder):
    charged = read_table(spark, folder, "lineitem").withColumn("charge", F.expr("l_extendedprice * (1 - l_discount)"))
    return rounded(ops.strong_pairs(ops.correlation_pairs(charged, CHARGE_COLUMNS)), "r")


def target_sql(t):
    return f"CAST(coalesce(list_contains(string_split(tags_csv, ','), '{t}'), false) AS INTEGER)"


def _feature_label_sql():
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, '{t}' AS label, round(corr({f}, {target_sql(t)}), 6) AS r FROM dense"
        for f in DENSE for t in PRIORITY_TAGS)


def _feature_label(spark, folder):
    d = dense(problems(spark, folder))
    wide = d.select(*DENSE, *tag_ops.target_columns("tags", prefix="", underscore=False))
    return ops.feature_label_correlation(wide, DENSE, [f"`{t}`" for t in PRIORITY_TAGS]).withColumn(
        "label", F.replace("label", F.lit("`"), F.lit("")))


@query("agg26_feature_label_correlation", CTE + DENSE_SQL + _feature_label_sql())
def agg26(spark, folder):
    return rounded(_feature_label(spark, folder), "r")


@query("agg26_mean_abs_correlation", CTE + DENSE_SQL + f"SELECT feature, round(avg(abs(r)), 4) AS mean_abs FROM ({_feature_label_sql()}) GROUP BY 1")
def agg26_mean(spark, folder):
    return _feature_label(spark, folder).groupBy("feature").agg(rnd(F.avg(F.abs("r")), 4).alias("mean_abs"))


@query("agg26_top_features_per_label", CTE + DENSE_SQL + f"""
, r AS ({_feature_label_sql()})
SELECT label, feature, r FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY abs(r) DESC, feature) AS k FROM r) WHERE k <= 5""")
def agg26_top(spark, folder):
    from pyspark.sql import Window

    r = rounded(_feature_label(spark, folder), "r")
    k = F.row_number().over(Window.partitionBy("label").orderBy(F.desc(F.abs("r")), "feature"))
    return r.withColumn("k", k).where("k <= 5").select("label", "feature", "r")


@query("agg28_histogram", """
WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events),
h AS (SELECT CAST(least(floor((value - lo) / w), 29) AS INTEGER) AS bin, count(*) AS count FROM events, b GROUP BY 1)
SELECT bin, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, count FROM h, b""")
def agg28(spark, folder):
    return rounded(ops.histogram(read_table(spark, folder, "events"), "value"), "low", "high")


FIVE = {"min": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1}


def five_sql(c):
    return ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {n}" for n, p in FIVE.items())


@query("agg28_five_numbers", f"SELECT count(value) AS n, {five_sql('value')} FROM events")
def agg28_five(spark, folder):
    return rounded(ops.five_numbers(read_table(spark, folder, "events"), "value"), *FIVE)


@query("agg28_five_numbers_by_tag", CTE + f"""
SELECT tag, count(difficulty) AS n, {five_sql('difficulty')} FROM priority JOIN problems USING (p_id) WHERE difficulty IS NOT NULL GROUP BY tag""")
def agg28_by_tag(spark, folder):
    long = tag_ops.explode_tags(problems(spark, folder), "difficulty", allowed=PRIORITY_TAGS)
    return rounded(ops.five_numbers(long, "difficulty", "tag", PRIORITY_TAGS), *FIVE)


def length_sql(expr, table):
    return f"""WITH l AS (SELECT {expr} AS v FROM {table})
SELECT count(*) AS n, min(v)::BIGINT AS min, max(v)::BIGINT AS max, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       count(*) FILTER (v < 50) AS short, round(count(*) FILTER (v < 50) * 100.0::DOUBLE / count(*), 6) AS short_pct,
       round(quantile_cont(v::DOUBLE, 0.25), 6) AS p25, round(quantile_cont(v::DOUBLE, 0.5), 6) AS p50,
       round(quantile_cont(v::DOUBLE, 0.75), 6) AS p75, round(quantile_cont(v::DOUBLE, 0.95), 6) AS p95 FROM l"""


LENGTH_STATS = ["mean", "std", "short_pct", "p25", "p50", "p75", "p95"]


@query("agg29_length_percentiles", length_sql("length(text)", "documents"))
def agg29(spark, folder):
    d = documents(spark, folder).select(F.length("text").cast("bigint").alias("v"))
    return rounded(ops.length_summary(d, "v"), *LENGTH_STATS)


@query("agg29_word_percentiles", length_sql(f"len(regexp_extract_all(text, '[^{WS}]+'))", "documents"))
def agg29_words(spark, folder):
    d = documents(spark, folder).select(text.word_count(F.col("text")).cast("bigint").alias("v"))
    return rounded(ops.length_summary(d, "v"), *LENGTH_STATS)


@query("agg30_code_lengths", CTE + """
SELECT round(avg(length(source_code)), 6) AS avg_length_chars, round(quantile_cont(length(source_code)::DOUBLE, 0.5), 6) AS median_length_chars,
       round(avg(len(string_split(source_code, chr(10)))), 6) AS avg_length_lines,
       round(quantile_cont(len(string_split(source_code, chr(10)))::DOUBLE, 0.5), 6) AS median_length_lines FROM problems""")
def agg30(spark, folder):
    out = ops.code_summary(problems(spark, folder), "source_code")
    return rounded(out, *out.columns)


def keywords_case(column):
    return "CASE tag " + " ".join(
        f"WHEN '{t}' THEN " + " OR ".join(f"contains(lower({column}), '{k}')" for k in ks) for t, ks in TAG_KEYWORDS.items()) + " END"


FLAGS_SQL = f""", flags AS (SELECT tag, {keywords_case('description')} AS d, {keywords_case('source_code')} AS c, length(source_code) AS len
  FROM priority JOIN problems USING (p_id))
"""


@query("agg31_length_outliers", CTE + FLAGS_SQL + """
, cut AS (SELECT tag, quantile_cont(len::DOUBLE, 0.05) AS cut FROM flags GROUP BY 1)
SELECT tag, count(*) AS total, count(*) FILTER (len < cut) AS very_short, count(*) FILTER (NOT d) AS no_keywords
FROM flags JOIN cut USING (tag) GROUP BY tag""")
def agg31(spark, folder):
    return ops.length_outliers(problems(spark, folder), F.length("source_code"), "description")


@query("agg31_description_outliers", CTE + FLAGS_SQL.replace("length(source_code)", "length(description)") + """
, cut AS (SELECT tag, quantile_cont(len::DOUBLE, 0.05) AS cut FROM flags GROUP BY 1)
SELECT tag, count(*) AS total, count(*) FILTER (len < cut) AS very_short, count(*) FILTER (NOT d) AS no_keywords
FROM flags JOIN cut USING (tag) GROUP BY tag""")
def agg31_description(spark, folder):
    return ops.length_outliers(problems(spark, folder), F.length("description"), "description")


@query("agg32_keyword_coverage", CTE + FLAGS_SQL + """
SELECT tag, count(*) AS total, round(avg(d::INTEGER), 6) AS desc_coverage, round(avg(c::INTEGER), 6) AS code_coverage,
       round(avg((d OR c)::INTEGER), 6) AS either_coverage FROM flags GROUP BY tag""")
def agg32(spark, folder):
    out = ops.keyword_coverage(problems(spark, folder), "description", "source_code")
    return rounded(out, "desc_coverage", "code_coverage", "either_coverage")


@query("agg32_keyword_table_coverage", CTE.replace("WITH ", f"WITH {KEYWORD_TABLE},\n", 1) + """
, rows AS (SELECT tag, EXISTS (SELECT 1 FROM keywords k WHERE k.tag = p.tag AND contains(lower(description), keyword)) AS d,
  EXISTS (SELECT 1 FROM keywords k WHERE k.tag = p.tag AND contains(lower(source_code), keyword)) AS c FROM priority p JOIN problems USING (p_id))
SELECT tag, count(*) AS total, round(avg(coalesce(d, FALSE)::INTEGER), 6) AS desc_coverage, round(avg(coalesce(c, FALSE)::INTEGER), 6) AS code_coverage,
       round(avg((coalesce(d, FALSE) OR coalesce(c, FALSE))::INTEGER), 6) AS either_coverage FROM rows GROUP BY tag""")
def agg32_table(spark, folder):
    out = keywords.keyword_coverage(problems(spark, folder), "description", "source_code", keyword_table(spark, folder))
    return rounded(out, "desc_coverage", "code_coverage", "either_coverage")


SAMPLE_SQL = """, sampled AS (SELECT * FROM problems ORDER BY md5('42|' || CAST(p_id AS VARCHAR)) LIMIT 1000)
"""
IMPORT_SQL = {f"import_{m}": rf"regexp_matches(source_code, '\b(import\s+{m}|from\s+{m}\s+import)\b')" for m in IMPORT_MODULES}


def flag_rates_sql(flags, extra=""):
    per = " UNION ALL ".join(f"SELECT tag, '{n}' AS flag, avg(({r})::INTEGER) AS rate FROM sampled JOIN priority USING (p_id) GROUP BY tag" for n, r in flags.items())
    return CTE + SAMPLE_SQL + f""", rates AS ({per})
SELECT tag, flag, round(rate, 6) AS rate FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY rate DESC, flag) AS k FROM rates {extra}) WHERE k <= 3"""


def _top_flags(rates, extra=None):
    from pyspark.sql import Window

    if extra is not None:
        rates = rates.where(extra)
    k = F.row_number().over(Window.partitionBy("tag").orderBy(F.desc("rate"), "flag"))
    return rounded(rates.withColumn("k", k).where("k <= 3").drop("k"), "rate")


@query("agg33_imports_by_tag", flag_rates_sql(IMPORT_SQL))
def agg33(spark, folder):
    sample = splits.seeded_sample(problems(spark, folder), "p_id", 1000)
    return _top_flags(ops.flag_rates_by_tag(sample, code.import_flags(F.col("source_code"))))


@query("agg33_patterns_by_tag", flag_rates_sql(PATTERN_SQL, "WHERE rate > 0.1"))
def agg33_patterns(spark, folder):
    sample = splits.seeded_sample(problems(spark, folder), "p_id", 1000)
    return _top_flags(ops.flag_rates_by_tag(sample, code.pattern_flags(F.col("source_code"))), "rate > 0.1")


@query("agg36_ascii_summary", """
WITH r AS (SELECT coalesce(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / nullif(length(text), 0)::DOUBLE, 0) AS r FROM documents)
SELECT count(*) AS total, count(*) FILTER (r < 0.95) AS non_ascii, round(count(*) FILTER (r < 0.95) * 100.0::DOUBLE / count(*), 6) AS non_ascii_pct,
       round(avg(r) FILTER (r < 0.95), 6) AS mean_ratio_non_ascii FROM r""")
def agg36(spark, folder):
    return rounded(ops.ascii_summary(documents(spark, folder), "text"), "non_ascii_pct", "mean_ratio_non_ascii")


@query("snk2_report_rows", CTE + """
, t AS (SELECT tag, count(*)::DOUBLE AS count, count(*) / (SELECT count(*) FROM problems)::DOUBLE AS frequency FROM tagged GROUP BY 1),
l AS (SELECT lang, count(*)::DOUBLE AS count FROM documents GROUP BY 1)
SELECT 'tags' AS section, tag AS key, 'count' AS metric, count AS value FROM t
UNION ALL SELECT 'tags', tag, 'frequency', round(frequency, 6) FROM t
UNION ALL SELECT 'languages', lang, 'count', count FROM l""")
def snk2_rows(spark, folder):
    from ...sources.writers import nested_report, report_rows

    tags = tag_ops.tag_statistics(problems(spark, folder))
    langs = ops.category_distribution(documents(spark, folder), "lang")
    return rounded(nested_report(report_rows("tags", tags, "tag", ["count", "frequency"]),
                                 report_rows("languages", langs, "lang", ["count"])), "value")
