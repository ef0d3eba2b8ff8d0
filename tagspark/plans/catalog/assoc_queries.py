"""Joins, duplicates, symbols, frequent terms, splits and samples."""

from __future__ import annotations

from ...constants import CONTEXT_STOP_WORDS, ENGLISH_STOP_WORDS, NUMBER_TOKENS, SPARK_STOP_WORDS
from ...functions import latex, text
from ...operators import duplicates as dups, joins, splits, symbols as sym, tags as tag_ops, terms
from ...session import cut_lineage
from .base import *  # noqa: F403
from .text_queries import LETTERS_SQL, PLAIN_SQL, clean_for_model_sql, duplicate_form_sql

# Duplicates and the joins on their keys ----------------------------------------

HASHED_SQL = f"WITH hashed AS (SELECT doc_id, lang, text, md5({duplicate_form_sql('text')}) AS hash FROM documents)\n"


def hashed(spark, folder):
    d = documents(spark, folder)
    return dups.with_hash(d, "text", hash_column="hash").withColumn("tags", F.array("lang"))


@query("agg21_duplicate_groups", HASHED_SQL + """
SELECT hash, count(*) AS count, min(doc_id) AS first_id, count(DISTINCT lang) AS tags_variety FROM hashed GROUP BY 1 HAVING count(*) >= 2""")
def agg21(spark, folder):
    return dups.duplicate_groups(hashed(spark, folder), "hash", "doc_id").orderBy(F.desc("count"), "hash")


@query("agg21_duplicate_members", HASHED_SQL + """
SELECT h.hash, h.doc_id, g.n AS count FROM hashed h JOIN (SELECT hash, count(*) AS n FROM hashed GROUP BY 1 HAVING count(*) >= 2) g USING (hash)""")
def agg21_members(spark, folder):
    h = hashed(spark, folder)
    return dups.duplicate_members(h, dups.duplicate_groups(h, "hash", "doc_id"), "hash", "doc_id")


@query("agg21_duplicate_summary", HASHED_SQL + """
, c AS (SELECT hash, count(*) AS n FROM hashed GROUP BY 1)
SELECT sum(n)::BIGINT AS total, count(*) AS distinct_texts, count(*) FILTER (n >= 2) AS groups,
       coalesce(sum(n) FILTER (n >= 2), 0)::BIGINT AS rows_in_groups FROM c""")
def agg21_summary(spark, folder):
    return dups.duplicate_summary(hashed(spark, folder), "hash")


@query("agg22_keep_first", HASHED_SQL + "SELECT doc_id, lang FROM hashed WHERE doc_id IN (SELECT min(doc_id) FROM hashed GROUP BY hash)")
def agg22(spark, folder):
    return dups.keep_first(hashed(spark, folder), "hash", "doc_id").select("doc_id", "lang")


@query("agg22_remove_marked_duplicates", """
WITH marked AS (SELECT doc_id, CASE WHEN count(*) OVER (PARTITION BY length(text)) = 1 THEN -1 ELSE length(text) END AS g FROM documents)
SELECT doc_id FROM marked WHERE g = -1 UNION ALL SELECT min(doc_id) FROM marked WHERE g <> -1 GROUP BY g""")
def agg22_marked(spark, folder):
    d = documents(spark, folder).select("doc_id", F.length("text").alias("n"))
    sizes = d.groupBy("n").agg(F.count("*").alias("rows"))
    marked = joins.balanced_join(d, sizes, "n", "doc_id").withColumn(
        "duplicate_group", F.when(F.col("rows") == 1, -1).otherwise(F.col("n")))
    return dups.remove_duplicate_rows(marked, row_id="doc_id").select("doc_id")


@query("agg23_duplicate_examples", HASHED_SQL + """
, top AS (SELECT hash, count(*) AS count FROM hashed GROUP BY 1 HAVING count(*) >= 2 ORDER BY count DESC, hash LIMIT 3)
SELECT hash, count, doc_id, lang, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS text FROM hashed JOIN top USING (hash)""")
def agg23(spark, folder):
    h = hashed(spark, folder)
    return dups.top_group_rows(h.withColumnRenamed("hash", "h"), dups.duplicate_groups(h, "hash", "doc_id"), "h", ["doc_id", "lang"], "text")


@query("jn1_rows_with_duplicate_key", HASHED_SQL + """
SELECT doc_id FROM hashed WHERE hash IN (SELECT hash FROM hashed GROUP BY 1 HAVING count(*) > 1)""")
def jn1(spark, folder):
    h = hashed(spark, folder)
    keys = dups.duplicate_groups(h, "hash", "doc_id", tags=None).select("hash")
    return joins.balanced_join(h.select("doc_id", "hash"), keys, "hash", "doc_id", "left_semi").select("doc_id")


@query("jn2_rows_without_duplicate_key", HASHED_SQL + """
SELECT doc_id FROM hashed WHERE hash NOT IN (SELECT hash FROM hashed GROUP BY 1 HAVING count(*) > 1)""")
def jn2(spark, folder):
    h = hashed(spark, folder)
    keys = dups.duplicate_groups(h, "hash", "doc_id", tags=None).select("hash")
    return joins.balanced_join(h.select("doc_id", "hash"), keys, "hash", "doc_id", "left_anti").select("doc_id")


@query("jn3_aligned_columns", "SELECT page_id, length(url) AS url_chars, length(html) AS html_chars FROM pages")
def jn3(spark, folder):
    return longs(read_table(spark, folder, "pages").withColumns(
        {"url_chars": F.length("url"), "html_chars": F.length("html")}).select("page_id", "url_chars", "html_chars"), "url_chars", "html_chars")


COMMANDS_SQL = r""", commands AS (SELECT DISTINCT p_id, unnest(regexp_extract_all(description, '\\[a-zA-Z]+')) AS symbol FROM problems),
universe AS (SELECT DISTINCT symbol FROM commands),
presence AS (SELECT p.p_id, u.symbol FROM problems p JOIN universe u ON contains(p.description, u.symbol))
"""


@query("jn4_tag_symbol_lookup", CTE + COMMANDS_SQL + """
SELECT tag, symbol, count(*) AS count FROM tagged JOIN presence USING (p_id) GROUP BY 1, 2""")
def jn4(spark, folder):
    p = problems(spark, folder)
    presence = sym.symbol_presence(p, "description", "p_id")
    return presence.join(tag_ops.explode_tags(p, "p_id"), "p_id").groupBy("tag", "symbol").agg(F.count("*").alias("count"))


@query("jn6_pair_grid", CTE + """
SELECT a.tag AS tag_a, b.tag AS tag_b FROM (SELECT DISTINCT tag FROM tagged) a JOIN (SELECT DISTINCT tag FROM tagged) b ON a.tag < b.tag""")
def jn6(spark, folder):
    return tag_ops.pair_grid(problems(spark, folder), "tags", None)


TRANSLATED_SQL = """WITH t AS (SELECT md5(text) AS text_key, min(lang) AS lang, min('[EN] ' || text) AS translated FROM documents
  WHERE lang IN ('fr', 'de', 'en') GROUP BY 1),
j AS (SELECT d.doc_id, d.text, d.lang AS doc_lang, t.translated, length(trim(regexp_replace(d.text, '[\\t-\\r\\x1c-\\x1f\\x{85}\\p{Z}]+', ' ', 'g'))) >= 10 AS ok
  FROM documents d LEFT JOIN t ON md5(d.text) = t.text_key),
s AS (SELECT *, CASE WHEN NOT ok THEN 'unknown' ELSE doc_lang END AS lang,
  CASE WHEN NOT ok OR doc_lang = 'en' THEN 'original' WHEN translated IS NOT NULL THEN 'translated' ELSE 'error' END AS status FROM j)
"""


def translated(spark, folder):
    d = documents(spark, folder).select("doc_id", "text", F.col("lang").alias("doc_lang"))
    known = d.where(F.col("doc_lang").isin("fr", "de", "en")).groupBy(F.md5("text").alias("text_key")).agg(
        F.min("doc_lang").alias("lang"), F.min(F.concat(F.lit("[EN] "), "text")).alias("translated"))
    return joins.apply_translations(d, "text", known, "doc_id", detected_lang="doc_lang")


@query("jn8_apply_translations", TRANSLATED_SQL + """
SELECT doc_id, lang, status, md5(CASE WHEN status = 'translated' THEN translated ELSE text END) AS text_hash FROM s""")
def jn8(spark, folder):
    return translated(spark, folder).select(
        "doc_id", F.col("text_lang").alias("lang"), F.col("text_status").alias("status"), F.md5("text_translated").alias("text_hash"))


@query("jn8_translation_status", TRANSLATED_SQL + """
SELECT status, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM s), 6) AS percentage FROM s GROUP BY 1""")
def jn8_status(spark, folder):
    return rounded(joins.status_counts(translated(spark, folder), "text_status"), "percentage")


# Symbols -------------------------------------------------------------------------

@query("ltx4_symbol_presence", CTE + COMMANDS_SQL + "SELECT p_id, symbol FROM presence")
def ltx4(spark, folder):
    return sym.symbol_presence(problems(spark, folder), "description", "p_id")


@query("ltx4_symbol_presence_exact", CTE + COMMANDS_SQL + "SELECT p_id, symbol FROM commands")
def ltx4_exact(spark, folder):
    return sym.symbol_presence(problems(spark, folder), "description", "p_id", exact=True)


@query("ltx4_html_entities_exact", r"""
WITH c AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(replace(html, '&', chr(92)), '\\[a-zA-Z]+')) AS symbol FROM pages)
SELECT symbol, count(*) AS n_docs FROM c GROUP BY 1""")
def ltx4_pages(spark, folder):
    pages = read_table(spark, folder, "pages").select("page_id", F.replace("html", F.lit("&"), F.lit("\\")).alias("html"))
    return sym.symbol_counts(sym.symbol_presence(pages, "html", "page_id", exact=True))


@query("top10_symbol_selection", CTE + COMMANDS_SQL + """
SELECT symbol, count(*) AS n_docs FROM presence GROUP BY 1 HAVING count(*) >= 10 ORDER BY n_docs DESC, symbol LIMIT 30""")
def top10(spark, folder):
    return sym.select_symbols(sym.symbol_presence(problems(spark, folder), "description", "p_id"))


IS_TEST_SQL = "p_id IN (SELECT p_id FROM problems ORDER BY md5('42|' || CAST(p_id AS VARCHAR)) LIMIT (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM problems))"
FEATURE_SYMBOLS = ["\\le", "\\leq", "\\gcd", "\\frac", "\\sum", "\\binom"]


@query("ltx6_apply_fitted_list", CTE + COMMANDS_SQL + f""",
fitted AS (SELECT symbol FROM presence WHERE NOT {IS_TEST_SQL} GROUP BY 1 HAVING count(*) >= 10 ORDER BY count(*) DESC, symbol LIMIT 30)
SELECT p_id, symbol, CAST(contains(description, symbol) AS INTEGER) AS present FROM problems CROSS JOIN fitted WHERE {IS_TEST_SQL}""")
def ltx6_fitted(spark, folder):
    train, test = splits.train_test(splits.grouped_split(problems(spark, folder), "p_id", fix=True))
    fitted = sym.selected_list(sym.select_symbols(sym.symbol_presence(train, "description", "p_id")))
    flags = F.array(*[F.struct(F.lit(s).alias("symbol"), latex.has_symbol(F.col("description"), s).alias("present")) for s in fitted])
    return test.select("p_id", F.explode(flags).alias("f")).select("p_id", "f.symbol", "f.present")


@query("ltx6_apply_symbol_list", CTE + "SELECT p_id, " + ", ".join(
    f"CAST(contains(description, '{s}') AS INTEGER) AS {latex.feature_name(s)}" for s in FEATURE_SYMBOLS) + f" FROM problems WHERE {IS_TEST_SQL}")
def ltx6(spark, folder):
    train, test = splits.train_test(splits.grouped_split(problems(spark, folder), "p_id", fix=True))
    fitted = sym.selected_list(sym.select_symbols(sym.symbol_presence(train, "description", "p_id")))
    # \\binom is in no text: a symbol without occurrences gives a column of zeros.
    names = [s for s in FEATURE_SYMBOLS if s in fitted or s == "\\binom"]
    return test.select("p_id", *sym.symbol_features("description", names))


ENRICH_SQL = COMMANDS_SQL + """, nsym AS (SELECT symbol, count(*) AS n_docs FROM presence GROUP BY 1 HAVING count(*) >= 5),
ntag AS (SELECT tag, count(*) AS n_tag FROM tagged GROUP BY 1),
joint AS (SELECT symbol, tag, count(*) AS n FROM presence JOIN tagged USING (p_id) GROUP BY 1, 2),
lift AS (SELECT s.symbol, t.tag, (coalesce(j.n, 0) / t.n_tag::DOUBLE) / (s.n_docs / (SELECT count(*) FROM problems)::DOUBLE) AS lift
  FROM nsym s CROSS JOIN ntag t LEFT JOIN joint j ON j.symbol = s.symbol AND j.tag = t.tag)
"""


def lift_of(spark, folder):
    p = problems(spark, folder)
    return sym.enrichment(p, sym.symbol_presence(p, "description", "p_id"), "p_id")


@query("agg34_symbol_enrichment", CTE + ENRICH_SQL + "SELECT symbol, tag, round(lift, 6) AS lift FROM lift")
def agg34(spark, folder):
    return rounded(lift_of(spark, folder).select("symbol", "tag", "lift"), "lift")


@query("agg35_most_variable_symbols", CTE + ENRICH_SQL + """
SELECT symbol, round(var_samp(lift), 6) AS variance FROM lift GROUP BY 1 ORDER BY round(var_samp(lift), 9) DESC, symbol LIMIT 30""")
def agg35(spark, folder):
    return rounded(sym.most_variable(lift_of(spark, folder)), "variance")


@query("top2_enriched_symbols", CTE + ENRICH_SQL + """
SELECT tag, 'enriched' AS kind, rank, symbol, round(lift, 6) AS lift FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY round(lift, 9) DESC, symbol) AS rank FROM lift WHERE round(lift, 9) >= 1.5) WHERE rank <= 10
UNION ALL SELECT tag, 'depleted', rank, symbol, round(lift, 6) FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY round(lift, 9), symbol) AS rank FROM lift WHERE round(lift, 9) <= 0.5) WHERE rank <= 5""")
def top2(spark, folder):
    return rounded(sym.enriched_and_depleted(lift_of(spark, folder), threshold=1.5, depleted_below=0.5), "lift")


@query("top3_top_symbols_per_tag", CTE + ENRICH_SQL + """
SELECT tag, rank, symbol, round(lift, 2) AS lift FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY round(lift, 9) DESC, symbol) AS rank FROM lift) WHERE rank <= 10""")
def top3(spark, folder):
    return sym.top_symbols(lift_of(spark, folder))


@query("top4_compare_tags", CTE + ENRICH_SQL + """
, d AS (SELECT a.symbol, a.lift - b.lift AS difference FROM lift a JOIN lift b USING (symbol) WHERE a.tag = 'math' AND b.tag = 'graphs')
(SELECT 'math' AS side, symbol, round(difference, 6) AS difference FROM d ORDER BY round(d.difference, 9) DESC, symbol LIMIT 15)
UNION ALL (SELECT 'graphs', symbol, round(difference, 6) FROM d ORDER BY round(d.difference, 9), symbol LIMIT 15)""")
def top4(spark, folder):
    return rounded(sym.compare_tags(lift_of(spark, folder), "math", "graphs", 15), "difference")


@query("ltx7_summed_lift", CTE + ENRICH_SQL + """
SELECT p_id, tag, round(sum(lift), 6) AS score FROM presence JOIN lift USING (symbol) GROUP BY 1, 2""")
def ltx7_lift(spark, folder):
    p = problems(spark, folder)
    presence = sym.symbol_presence(p, "description", "p_id")
    return rounded(sym.summed_lift(p, presence, sym.enrichment(p, presence, "p_id"), "p_id"), "score")


# Terms -----------------------------------------------------------------------------

STOP_SQL = sql_list(terms.stop_words())


@query("top1_top_words_by_tag", CTE + f"""
, w AS (SELECT p_id, unnest(string_split({PLAIN_SQL}, ' ')) AS word FROM problems),
c AS (SELECT tag, word, count(*) AS count FROM w JOIN priority USING (p_id) WHERE word <> '' GROUP BY 1, 2),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY count DESC, word) AS k FROM c) WHERE k <= 500),
kept AS (SELECT tag, word, count, row_number() OVER (PARTITION BY tag ORDER BY count DESC, word) AS rank FROM pool
         WHERE length(word) > 2 AND word NOT IN ({STOP_SQL}))
SELECT tag, rank, word, count FROM kept WHERE rank <= 15""")
def top1(spark, folder):
    return terms.top_words_by_tag(problems(spark, folder), "description")


@query("top7_vector_words_by_tag", CTE + f"""
, w AS (SELECT p_id, unnest(regexp_extract_all({LETTERS_SQL}, '[{WORD}]{{2,}}')) AS word FROM problems),
c AS (SELECT tag, word, count(*) AS count FROM w JOIN priority USING (p_id)
  WHERE word NOT IN ({sql_list(sorted({*ENGLISH_STOP_WORDS, *SPARK_STOP_WORDS}))}) GROUP BY 1, 2)
SELECT tag, rank, word, count FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY count DESC, word) AS rank FROM c) WHERE rank <= 10""")
def top7(spark, folder):
    return terms.top_vector_words_by_tag(problems(spark, folder), "description")


def ngram_cte(source, key, column, sizes):
    parts = " UNION ALL ".join(
        f"SELECT {key}, {n} AS n, unnest(list_transform(range(1, len(c) - {n} + 2), lambda i: {' || '.join(f'c[i + {k}]' for k in range(n))})) AS gram FROM chars"
        for n in sizes)
    return f"chars AS (SELECT {key}, string_split(lower({column}), '') AS c FROM {source}), grams AS ({parts})"


@query("top5_char_ngrams", f"WITH {ngram_cte('documents', 'doc_id', 'text', [3, 4, 5])}" + """,
c AS (SELECT n, gram, count(*) AS count FROM grams GROUP BY 1, 2)
SELECT n, rank, gram, count FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY count DESC, gram) AS rank FROM c) WHERE rank <= 30""")
def top5(spark, folder):
    return terms.top_char_ngrams(documents(spark, folder), "text")


@query("top6_discriminant_ngrams", CTE + f", {ngram_cte('problems', 'p_id', 'description', [3])}" + """,
g AS (SELECT gram, count(*) AS n_all FROM grams GROUP BY 1),
t AS (SELECT tag, gram, count(*) AS count FROM grams JOIN priority USING (p_id) GROUP BY 1, 2),
tt AS (SELECT tag, sum(count) AS tag_total FROM t GROUP BY 1),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY count DESC, gram) AS k FROM t) WHERE k <= 100),
s AS (SELECT tag, gram, count, log2((count / tag_total + 1e-10) / (n_all / (SELECT sum(n_all) FROM g) + 1e-10)) AS score
      FROM pool JOIN g USING (gram) JOIN tt USING (tag) WHERE n_all >= 5)
SELECT tag, rank, gram, count, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY round(score, 9) DESC, gram) AS rank FROM s) WHERE rank <= 20""")
def top6(spark, folder):
    return rounded(terms.discriminant_ngrams(problems(spark, folder), "description"), "score")


CLEAN_SQL = f", clean AS (SELECT p_id, {clean_for_model_sql('description')} AS t FROM problems)\n"


def cleaned(spark, folder):
    return problems(spark, folder).select("p_id", text.clean_for_model(F.col("description")).alias("t"))


@query("top9_top_tokens", CTE + CLEAN_SQL + f"""
, k AS (SELECT unnest(regexp_extract_all(lower(t), '[{WORD}]+')) AS token FROM clean)
SELECT token, count(*) AS count FROM k GROUP BY 1 ORDER BY count DESC, token LIMIT 30""")
def top9_tokens(spark, folder):
    return terms.top_tokens(cleaned(spark, folder), "t")


@query("top9_number_tokens", CTE + CLEAN_SQL + f"""
, k AS (SELECT unnest(regexp_extract_all(lower(t), '[{WORD}]+')) AS token FROM clean)
SELECT token, count(*) AS count FROM k WHERE token IN ({sql_list(NUMBER_TOKENS)}) GROUP BY 1""")
def top9_numbers(spark, folder):
    return terms.number_token_counts(cleaned(spark, folder), "t")


BIGRAM_SQL = CTE + CLEAN_SQL + f"""
, k AS (SELECT p_id, regexp_extract_all(t, '[{WORD}]{{2,}}') AS k FROM clean),
b AS (SELECT p_id, unnest(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS bigram FROM k),
c AS (SELECT bigram, count(*) AS count, count(DISTINCT p_id) AS n_docs FROM b GROUP BY 1 HAVING count(DISTINCT p_id) >= 2)
"""


@query("vec2_bigram_counts", BIGRAM_SQL + "SELECT bigram, count, n_docs FROM c")
def vec2(spark, folder):
    return terms.bigram_counts(cleaned(spark, folder), "t")


@query("top9_top_bigrams", BIGRAM_SQL + "SELECT bigram, count FROM c ORDER BY count DESC, bigram LIMIT 30")
def top9_bigrams(spark, folder):
    return terms.bigram_counts(cleaned(spark, folder), "t").orderBy(F.desc("count"), "bigram").limit(30).select("bigram", "count")


@query("top9_followed_tokens", CTE + CLEAN_SQL + f"""
, k AS (SELECT unnest(regexp_extract_all(lower(t), '[{WORD}]+')) AS token FROM clean)
SELECT token, count(*) AS count FROM k GROUP BY 1 ORDER BY count DESC, token LIMIT 30""")
def top9_followed(spark, folder):
    # Following and counting read the texts several times; they are cleaned once.
    tokens = cut_lineage(cleaned(spark, folder).select("t")).select(F.explode(text.word_tokens(F.lower("t"), 1)).alias("token"))
    return terms.top_items(tokens, "token", 30)


@query("set2_stop_words", f"""
WITH s AS (SELECT unnest([{sql_list(ENGLISH_STOP_WORDS)}]) AS word UNION SELECT unnest([{sql_list(CONTEXT_STOP_WORDS)}])),
w AS (SELECT unnest(regexp_extract_all(lower(text), '[{WORD}]+')) AS word FROM documents)
SELECT word, count(*) AS count FROM w WHERE word NOT IN (SELECT word FROM s) GROUP BY 1""")
def set2(spark, folder):
    d = documents(spark, folder)
    words = d.select(F.explode(text.word_tokens(F.lower("text"), 1)).alias("word")).groupBy("word").agg(F.count("*").alias("count"))
    return terms.without_stop_words(words, terms.stop_words())


@query("set1_union_of_kept_rows", HASHED_SQL + """
, g AS (SELECT hash, count(*) AS n, min(doc_id) AS first_id FROM hashed GROUP BY 1)
SELECT doc_id, 'single' AS kind FROM hashed JOIN g USING (hash) WHERE n = 1
UNION ALL SELECT first_id, 'representative' FROM g WHERE n > 1""")
def set1(spark, folder):
    h = hashed(spark, folder)
    groups = dups.duplicate_groups(h, "hash", "doc_id", tags=None)
    single = joins.balanced_join(h.select("doc_id", "hash"), groups.select("hash"), "hash", "doc_id", "left_anti")
    return single.select("doc_id", F.lit("single").alias("kind")).unionByName(
        groups.select(F.col("first_id").alias("doc_id"), F.lit("representative").alias("kind")))


@query("set3_features_missing_in_test", CTE + f"""
, w AS (SELECT p_id, unnest(regexp_extract_all(lower(description), '[{WORD}]+')) AS word FROM problems)
SELECT word FROM w WHERE NOT ({IS_TEST_SQL}) EXCEPT SELECT word FROM w WHERE {IS_TEST_SQL}""")
def set3(spark, folder):
    rows = splits.grouped_split(problems(spark, folder).select("p_id", "description"), "p_id")
    words = rows.select("is_test", F.explode(text.word_tokens(F.lower("description"), 1)).alias("word")).distinct()
    return words.where("NOT is_test").select("word").subtract(words.where("is_test").select("word"))


@query("val4_train_test_columns", CTE + COMMANDS_SQL + f""", counted AS (SELECT {IS_TEST_SQL} AS is_test, symbol, count(*) AS n FROM presence
  GROUP BY ALL HAVING count(*) >= 10 AND length(symbol) > 1),
top AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY is_test ORDER BY n DESC, symbol) <= 30),
names AS (SELECT * FROM (VALUES {", ".join(f"('{s}', '{latex.feature_name(s)}')" for s in FEATURE_SYMBOLS)}) v(symbol, feature))
SELECT feature, bool_or(NOT is_test) AS in_train, bool_or(is_test) AS in_test FROM top JOIN names USING (symbol) GROUP BY feature""")
def val4(spark, folder):
    from ...operators.validation import compare_columns

    train, test = splits.train_test(splits.grouped_split(problems(spark, folder), "p_id", fix=True))

    def features(rows):
        names = sym.selected_list(sym.select_symbols(sym.symbol_presence(rows, "description", "p_id")))
        return rows.select("p_id", *sym.symbol_features("description", names))

    return compare_columns(features(train), features(test))


# Language --------------------------------------------------------------------------

LANGS = ["de", "en", "es", "fr"]
LANG_SQL = f"WITH {ngram_cte('documents', 'doc_id', 'text', [3])}" + f""",
c AS (SELECT lang AS language, gram, count(*) AS n FROM grams JOIN documents USING (doc_id) GROUP BY 1, 2),
tot AS (SELECT language, sum(n) AS total, count(*) AS types FROM c GROUP BY 1),
common AS (SELECT DISTINCT gram FROM c),
prof AS (SELECT m.gram, t.language, ln((coalesce(c.n, 0) + 1) / (t.total + t.types)) AS logp FROM common m CROSS JOIN tot t
         LEFT JOIN c ON c.gram = m.gram AND c.language = t.language),
ok AS (SELECT doc_id, length(trim(regexp_replace(text, '[{WS}]+', ' ', 'g'))) >= 10 AS ok FROM documents),
sc AS (SELECT doc_id, language, sum(logp) AS score FROM grams JOIN prof USING (gram) JOIN ok USING (doc_id) WHERE ok GROUP BY 1, 2),
best AS (SELECT doc_id, language FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, language) AS k FROM sc) WHERE k = 1),
found AS (SELECT d.doc_id, coalesce(b.language, 'unknown') AS language FROM documents d LEFT JOIN best b USING (doc_id))
"""


def identified(spark, folder):
    d = documents(spark, folder)
    profile = terms.language_profile(d, "text", "lang", LANGS)
    return terms.identify_language(d, "text", "doc_id", profile)


@query("txt12_identify_language", LANG_SQL + "SELECT doc_id, language FROM found")
def txt12(spark, folder):
    return identified(spark, folder)


@query("txt12_language_distribution", LANG_SQL + """
SELECT language, count(*) AS count, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM found), 2) AS percentage FROM found GROUP BY 1""")
def txt12_distribution(spark, folder):
    from ...operators.profile import category_distribution

    return category_distribution(identified(spark, folder), "language", digits=2)


# Splits and samples ------------------------------------------------------------------

@query("spl1_grouped_split", """
WITH g AS (SELECT user_id, row_number() OVER (ORDER BY md5('42|' || CAST(user_id AS VARCHAR))) AS k FROM (SELECT DISTINCT user_id FROM events)),
n AS (SELECT floor(count(*) * 0.2) AS n FROM g)
SELECT event_id, g.k <= n.n AS is_test FROM events JOIN g USING (user_id) CROSS JOIN n""")
def spl1(spark, folder):
    return splits.grouped_split(read_table(spark, folder, "events"), "user_id").select("event_id", "is_test")


@query("spl1_conversation_split", """
WITH g AS (SELECT conv_id, row_number() OVER (ORDER BY md5('7|' || CAST(conv_id AS VARCHAR))) AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
n AS (SELECT floor(count(*) * 0.3) AS n FROM g)
SELECT conv_id, turn, g.k <= n.n AS is_test FROM conversations JOIN g USING (conv_id) CROSS JOIN n""")
def spl1_conv(spark, folder):
    return splits.grouped_split(read_table(spark, folder, "conversations"), "conv_id", 0.3, seed=7).select("conv_id", "turn", "is_test")


def combo_sql():
    flags = " || ".join(f"CAST(CAST(coalesce(list_contains(string_split(tags_csv, ','), '{t}'), false) AS INTEGER) AS VARCHAR)" for t in PRIORITY_TAGS)
    return CTE + f", combos AS (SELECT p_id, {flags} AS combo, md5('42|' || CAST(p_id AS VARCHAR)) AS h FROM problems)\n"


def quota_sql(take, source="combos"):
    return f""", sz AS (SELECT combo, count(*) AS n, (SELECT count(*) FROM {source}) AS total FROM {source} GROUP BY 1),
sh AS (SELECT combo, n, {take} AS take, floor(n * {take} / total::DOUBLE) AS base, round(n * {take} / total::DOUBLE - floor(n * {take} / total::DOUBLE), 9) AS rest FROM sz),
q AS (SELECT combo, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, combo) <= take - (SELECT sum(base) FROM sh) THEN 1 ELSE 0 END AS k FROM sh),
r AS (SELECT p_id, combo, row_number() OVER (PARTITION BY combo ORDER BY h) AS k FROM {source}),
split AS (SELECT r.p_id, r.combo, r.k <= q.k AS is_test FROM r JOIN q USING (combo))
"""


def sides_sql(shares, combos=None, n_labels=len(PRIORITY_TAGS)):
    """CTEs up to ``sides(p_id, combo, side)``: whole parts per combination, then one round per label and one for all rows.

    ``combos`` are CTEs up to ``combos(p_id, combo, h)``, by default of the priority tags.
    """
    n_sides = len(shares)
    holds = "(l.label = {n} OR substr({t}.combo, l.label + 1, 1) = '1')"
    upto = [" + ".join(f"floor(round(n * {s!r}::DOUBLE, 9))" for s in shares[:i + 1]) for i in range(n_sides)]
    first = " ".join(f"WHEN k <= {u} THEN {j}" for j, u in enumerate(upto))
    sql = f"""{combos or combo_sql()}, labels AS (SELECT unnest(range({n_labels + 1})) AS label),
shares AS (SELECT * FROM (VALUES {", ".join(f"({j}, {s!r}::DOUBLE)" for j, s in enumerate(shares))}) v(j, share)),
ranked AS (SELECT p_id, combo, row_number() OVER (PARTITION BY combo ORDER BY h) AS k, count(*) OVER (PARTITION BY combo) AS n FROM combos),
a0 AS (SELECT p_id, combo, md5('43|' || CAST(p_id AS VARCHAR)) AS h, CASE WHEN combo = '{"0" * n_labels}' THEN NULL {first} END AS side FROM ranked)"""
    for r in range(n_labels + 1):
        t = f"a{r}"
        on = holds.format(n=n_labels, t=t)
        sql += f""",
c{r} AS (SELECT label, count(*) FILTER (side IS NULL) AS m FROM labels l JOIN {t} ON {on} GROUP BY label),
p{r} AS (SELECT label, m, m = (SELECT m FROM c{r} WHERE label = {n_labels}) AS last FROM c{r} WHERE m > 0 ORDER BY label = {n_labels}, m, label LIMIT 1),
d{r} AS (SELECT label, j, count(*) * share - count(*) FILTER (side = j) AS lack FROM labels l JOIN {t} ON {on}, shares GROUP BY label, j, share),
e{r} AS (SELECT p.label, p.m, x.j, greatest(x.lack, 0.0) AS lack, y.lack AS behind FROM p{r} p JOIN d{r} x ON x.label = CASE WHEN last THEN {n_labels} ELSE p.label END
  JOIN d{r} y ON y.label = {n_labels} AND y.j = x.j),
x{r} AS (SELECT *, CASE WHEN sum(lack) OVER () = 0 THEN m / {n_sides}.0::DOUBLE ELSE m * lack / sum(lack) OVER () END AS exact FROM e{r}),
f{r} AS (SELECT *, floor(round(exact, 9)) AS base FROM x{r}),
q{r} AS (SELECT label, j, base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, round(behind, 9) DESC, j) <= m - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f{r}),
u{r} AS (SELECT label, j, sum(quota) OVER (ORDER BY j) AS upto FROM q{r}),
o{r} AS (SELECT p_id, row_number() OVER (ORDER BY h) AS k FROM {t} JOIN p{r} l ON {on} WHERE side IS NULL),
a{r + 1} AS (SELECT {t}.p_id, combo, h, coalesce(side, (SELECT count(*) FROM u{r} WHERE upto < o.k) + 0 * o.k)::INTEGER AS side FROM {t} LEFT JOIN o{r} o ON o.p_id = {t}.p_id)"""
    return sql + f""", sides AS (SELECT p_id, combo, side FROM a{n_labels + 1})
"""


def with_targets(spark, folder):
    p = problems(spark, folder)
    return p.select("p_id", *tag_ops.target_columns("tags")), ["target_" + t.replace(" ", "_") for t in PRIORITY_TAGS]


@query("spl2_stratified_split", sides_sql([0.2, 0.8]) + "SELECT p_id, side = 0 AS is_test FROM sides")
def spl2(spark, folder):
    rows, labels = with_targets(spark, folder)
    return splits.stratified_split(rows, labels, "p_id").select("p_id", "is_test")


@query("spl2_split_report", sides_sql([0.2, 0.8]) + " UNION ALL ".join(
    f"""SELECT 'target_{t.replace(' ', '_')}' AS label, round(avg(x) FILTER (side > 0), 6) AS train_pct, round(avg(x) FILTER (side = 0), 6) AS test_pct,
    round(abs(avg(x) FILTER (side > 0) - avg(x) FILTER (side = 0)), 6) AS diff
    FROM (SELECT side, 100.0::DOUBLE * CAST(substr(combo, {i + 1}, 1) AS INTEGER) AS x FROM sides)""" for i, t in enumerate(PRIORITY_TAGS)))
def spl2_report(spark, folder):
    rows, labels = with_targets(spark, folder)
    return rounded(splits.split_report(splits.stratified_split(rows, labels, "p_id"), labels), "train_pct", "test_pct", "diff")


@query("spl3_stratified_sample", combo_sql() + ", labelled AS (SELECT * FROM combos WHERE combo <> '00000000')"
       + quota_sql("least(200, total)", "labelled") + "SELECT p_id FROM split WHERE is_test")
def spl3(spark, folder):
    rows, labels = with_targets(spark, folder)
    return splits.stratified_sample(rows, labels, "p_id", 200).select("p_id")


@query("spl4_stratified_folds", sides_sql([1 / 3] * 3) + "SELECT p_id, side AS fold FROM sides")
def spl4(spark, folder):
    rows, labels = with_targets(spark, folder)
    return splits.stratified_folds(rows, labels, "p_id").select("p_id", "fold")


@query("smp1_seeded_sample", "SELECT doc_id, lang FROM documents ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)) LIMIT 100")
def smp1(spark, folder):
    return splits.seeded_sample(documents(spark, folder), "doc_id", 100).select("doc_id", "lang")
