"""Text, LaTeX, code and number expressions, one row per record."""

from __future__ import annotations

from ...constants import (
    IMPORT_MODULES, LATEX_COMMAND_TOKENS, LATEX_COMMAND_TOKENS_EMBEDDING, LATEX_PROFILE_SYMBOLS,
    LATEX_SYMBOLS, NOTE_PATTERNS, TAG_KEYWORDS,
)
from ...functions import code, latex, numeric, text
from ...functions.text import squeeze
from ...operators import tags as tag_ops
from ...operators.keywords import Keywords
from .base import *  # noqa: F403


def rx(c: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', '{flags}')"


def squeeze_sql(c: str) -> str:
    return f"trim({rx(c, f'[{WS}]+', ' ')})"


LINE_BLOCK3 = r"\$\$\$[^\n]*?\$\$\$"
LINE_BLOCK1 = r"\$[^\n]*?\$"


def _notes_sql() -> str:
    c = "notes"
    for pattern, to in NOTE_PATTERNS:
        c = rx(c, pattern, to)
    return c


@query("prj1_clean_text_patterns", CTE + f"SELECT p_id, {_notes_sql()} AS notes FROM problems")
def prj1(spark, folder):
    return problems(spark, folder).select("p_id", text.replace_patterns(F.col("notes")).alias("notes"))


FIX_NOTES_SQL = rx("notes", "Note([A-Z][a-z]+)", r"Note: \1")


@query("prj2_fix_notes", CTE + f"SELECT p_id, notes, {FIX_NOTES_SQL} AS notes_cleaned FROM problems")
def prj2(spark, folder):
    return problems(spark, folder).select("p_id", "notes", text.fix_notes(F.col("notes")).alias("notes_cleaned"))


@query("prj2_changed_rows", CTE + f"""
SELECT count(*) AS total, count(*) FILTER (notes <> {FIX_NOTES_SQL}) AS changed,
       round(count(*) FILTER (notes <> {FIX_NOTES_SQL}) * 100.0::DOUBLE / count(*), 6) AS changed_pct FROM problems""")
def prj2_changed(spark, folder):
    changed = F.count_if(~F.col("notes").eqNullSafe(text.fix_notes(F.col("notes"))))
    return problems(spark, folder).agg(
        F.count("*").alias("total"), changed.alias("changed"),
        rnd(numeric.pct(changed, F.count("*"))).alias("changed_pct"))


@query("prj3_sentinel_to_null", CTE + "SELECT p_id, nullif(difficulty, -1) AS difficulty FROM problems")
def prj3(spark, folder):
    return problems(spark, folder).select("p_id", numeric.sentinel_to_null(F.col("difficulty")).alias("difficulty"))


SECONDS_SQL = r"CAST(nullif(regexp_extract(lower(trim(time_limit)), '([0-9]+\.?[0-9]*)', 1), '') AS DOUBLE)"


@query("prj4_time_limit_seconds", CTE + f"SELECT p_id, {SECONDS_SQL} AS time_limit_seconds FROM problems")
def prj4(spark, folder):
    return problems(spark, folder).select(
        "p_id", numeric.parse_time_limit(F.col("time_limit")).alias("time_limit_seconds"))


@query("prj4_time_limit_report", CTE + f"""
SELECT {SECONDS_SQL} AS time_limit_seconds, count(*) AS count,
       round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM problems), 6) AS percentage
FROM problems GROUP BY 1""")
def prj4_report(spark, folder):
    p = problems(spark, folder)
    return p.groupBy(numeric.parse_time_limit(F.col("time_limit")).alias("time_limit_seconds")).agg(
        F.count("*").alias("count")
    ).select("*", rnd(numeric.pct(F.col("count"), tag_ops.row_total(p))).alias("percentage"))


@query("prj5_difficulty_bins", CTE + """
SELECT p_id, CASE WHEN difficulty > 0 AND difficulty <= 1200 THEN 'Easy' WHEN difficulty > 1200 AND difficulty <= 1600 THEN 'Medium'
  WHEN difficulty > 1600 AND difficulty <= 2000 THEN 'Hard' WHEN difficulty > 2000 AND difficulty <= 3500 THEN 'Very Hard' END AS difficulty_bin
FROM problems""")
def prj5(spark, folder):
    return problems(spark, folder).select("p_id", numeric.difficulty_bin(F.col("difficulty")).alias("difficulty_bin"))


@query("prj10_notes_missing", CTE + "SELECT p_id, CAST(notes IS NULL AS INTEGER) AS notes_is_missing FROM problems")
def prj10(spark, folder):
    return problems(spark, folder).select("p_id", F.col("notes").isNull().cast("int").alias("notes_is_missing"))


UNIFIED_SQL = """concat_ws(' ', '[DESC] ' || description, '[IN] ' || input_spec, '[OUT] ' || output_spec,
    coalesce('[NOTES] ' || notes, '[NOTES_MISSING]'), '[SAMPLE_IN] ' || substr(sample_inputs, 1, 500),
    '[SAMPLE_OUT] ' || substr(sample_outputs, 1, 500))"""


def with_unified(p):
    names = ["description", "input_spec", "output_spec", "notes", "sample_inputs", "sample_outputs"]
    return p.withColumn("unified_document", text.unified_document(*[F.col(n) for n in names]))


@query("prj11_unified_document", CTE + f"SELECT p_id, {UNIFIED_SQL} AS unified_document FROM problems")
def prj11(spark, folder):
    return with_unified(problems(spark, folder)).select("p_id", "unified_document")


@query("prj12_truncate_words", f"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[^{WS}]+') AS words FROM documents)
SELECT doc_id, CASE WHEN len(words) > 400 THEN array_to_string(words[1:400], ' ') ELSE text END AS truncated FROM w""")
def prj12(spark, folder):
    return documents(spark, folder).select("doc_id", text.truncate_words(F.col("text")).alias("truncated"))


@query("prj13_truncate_chars", """
SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS shown FROM documents""")
def prj13(spark, folder):
    return documents(spark, folder).select("doc_id", text.truncate_chars(F.col("text"), 300).alias("shown"))


@query("prj14_slug", "SELECT p_partkey, lower(replace(replace(p_type, ' ', '_'), '-', '_')) AS slug FROM part")
def prj14(spark, folder):
    return read_table(spark, folder, "part").select("p_partkey", text.slug(F.col("p_type")).alias("slug"))


@query("txt1_length_features", CTE + f"""
SELECT p_id, length(description) AS char_length, len(regexp_extract_all(description, '[^{WS}]+')) AS word_count,
       round(len(regexp_extract_all(description, '\\p{{Nd}}')) / length(description)::DOUBLE, 6) AS numeric_ratio
FROM problems""")
def txt1(spark, folder):
    c = F.col("description")
    return longs(problems(spark, folder).select(
        "p_id", text.char_length(c).alias("char_length"), text.word_count(c).alias("word_count"),
        rnd(text.numeric_ratio(c)).alias("numeric_ratio")), "char_length", "word_count")


@query("txt1_length_features_notes", CTE + f"""
SELECT p_id, coalesce(length(notes), 0) AS char_length,
       coalesce(len(regexp_extract_all(notes, '[^{WS}]+')), 0) AS word_count,
       coalesce(round(len(regexp_extract_all(notes, '\\p{{Nd}}')) / length(notes)::DOUBLE, 6), 0) AS numeric_ratio
FROM problems""")
def txt1_notes(spark, folder):
    c = F.col("notes")
    return longs(problems(spark, folder).select(
        "p_id", text.char_length(c).alias("char_length"), text.word_count(c).alias("word_count"),
        rnd(text.numeric_ratio(c)).alias("numeric_ratio")), "char_length", "word_count")


@query("txt2_latex_ratios", CTE + r"""
SELECT p_id, round(length(array_to_string(regexp_extract_all(description, '(?s)\$\$\$.*?\$\$\$'), '')) / length(description)::DOUBLE, 6) AS latex_ratio,
       round(length(array_to_string(regexp_extract_all(description, '\\[a-zA-Z]+'), '')) / length(description)::DOUBLE, 6) AS latex_symbols_ratio
FROM problems""")
def txt2(spark, folder):
    c = F.col("description")
    return problems(spark, folder).select(
        "p_id", rnd(latex.estimated_latex_ratio(c)).alias("latex_ratio"),
        rnd(latex.estimated_symbols_ratio(c)).alias("latex_symbols_ratio"))


@query("txt3_text_statistics", f"""
SELECT page_id, length(html) AS length_chars, len(regexp_extract_all(html, '[^{WS}]+')) AS length_words,
       len(string_split(html, chr(10))) AS length_lines FROM pages""")
def txt3(spark, folder):
    c = F.col("html")
    return longs(read_table(spark, folder, "pages").select(
        "page_id", F.length(c).alias("length_chars"), text.word_count(c).alias("length_words"),
        text.line_count(c).alias("length_lines")), "length_chars", "length_words", "length_lines")


KEYWORDS = sorted({k for ks in TAG_KEYWORDS.values() for k in ks} | {"print", "test", "the", "one", "and"})


@query("txt4_keywords", CTE + f"""
SELECT p_id, array_to_string(list_filter([{sql_list(KEYWORDS)}], lambda k: contains(lower(description), k)), '|') AS keywords
FROM problems""")
def txt4(spark, folder):
    return problems(spark, folder).select(
        "p_id", F.array_join(text.find_keywords(F.col("description"), KEYWORDS), "|").alias("keywords"))


#: The words of the benchmark items as a keyword table, each under a tag.
KEYWORD_TABLE = f"""words AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\r.,]+')) AS keyword FROM benchmark),
keywords AS (SELECT DISTINCT [{PRIORITY_SQL}][item_id % {len(PRIORITY_TAGS)} + 1] AS tag, keyword FROM words WHERE length(keyword) >= 5)"""


def keyword_table(spark, folder):
    tag = F.element_at(F.array(*[F.lit(t) for t in PRIORITY_TAGS]), (F.col("item_id") % len(PRIORITY_TAGS) + 1).cast("int"))
    words = read_table(spark, folder, "benchmark").select(
        tag.alias("tag"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[^ \t\n\r.,]+"), F.lit(0))).alias("keyword"))
    return words.where(F.length("keyword") >= 5).distinct()


@query("txt4_keyword_table", f"""WITH {KEYWORD_TABLE}
SELECT doc_id, count(keyword) AS n_found, coalesce(string_agg(keyword, '|' ORDER BY keyword), '') AS keywords
FROM documents LEFT JOIN (SELECT DISTINCT keyword FROM keywords) ON contains(lower(text), keyword) GROUP BY doc_id""")
def txt4_table(spark, folder):
    found = Keywords.from_table(keyword_table(spark, folder)).found(F.col("text"))
    rows = documents(spark, folder).select("doc_id", found.alias("found"))
    return rows.select("doc_id", F.size("found").cast("bigint").alias("n_found"), F.array_join("found", "|").alias("keywords"))


def duplicate_form_sql(c: str, inline: bool = True) -> str:
    c = rx(f"coalesce({c}, '')", LINE_BLOCK3, "")
    if inline:
        c = rx(c, LINE_BLOCK1, "")
    return squeeze_sql(rx(f"lower({c})", f"[^a-z{WS}]", ""))


@query("txt5_duplicate_form", CTE + f"""
SELECT p_id, md5({duplicate_form_sql('description')}) AS hash, md5({duplicate_form_sql('description', False)}) AS hash_blocks_only,
       {duplicate_form_sql('notes')} AS notes_form FROM problems""")
def txt5(spark, folder):
    c = F.col("description")
    return problems(spark, folder).select(
        "p_id", text.duplicate_hash(c).alias("hash"), text.duplicate_hash(c, False).alias("hash_blocks_only"),
        text.duplicate_form(F.col("notes")).alias("notes_form"))


LETTERS_SQL = squeeze_sql("lower(" + rx(rx("description", LINE_BLOCK3, ""), f"[^a-zA-Z{WS}]", " ") + ")")


@query("txt6_letters_only", CTE + f"SELECT p_id, {LETTERS_SQL} AS letters FROM problems")
def txt6(spark, folder):
    return problems(spark, folder).select("p_id", text.letters_only(F.col("description")).alias("letters"))


NUMBER_STEPS = [
    (r"(?i)\b[0-9]+e[+-]?[0-9]+\b", " NUM_EXP "), (r"\b[0-9]+\^[0-9]+\b", " NUM_EXP "),
    (r"\b[0-9]+\*\*[0-9]+\b", " NUM_EXP "), (r"\b[0-9]+\.[0-9]+\b", " NUM_FLOAT "),
    (r"\b[01]{5,}\b", " NUM_BIN "), (r"\b[0-9]+\b", " NUM_INT "),
]


def numbers_sql(c: str) -> str:
    for pattern, to in NUMBER_STEPS:
        c = rx(c, pattern, to)
    return squeeze_sql(c)


def commands_sql(c: str, commands) -> str:
    for name, token in commands:
        c = rx(c, rf"(?i)\\{name}", f" {token} ")
    return c


def clean_for_model_sql(c: str) -> str:
    c = f"coalesce({c}, '')"
    for block in (r"(?s)\$\$\$.*?\$\$\$", r"(?s)\$\$.*?\$\$", LINE_BLOCK1, r"(?s)\\\[.*?\\\]", r"\\\([^\n]*?\\\)"):
        c = rx(c, block, " MATHBLOCK ")
    return numbers_sql(f"lower({squeeze_sql(commands_sql(c, LATEX_COMMAND_TOKENS))})")


@query("txt7_clean_for_model", CTE + f"SELECT p_id, {clean_for_model_sql('description')} AS clean FROM problems")
def txt7(spark, folder):
    return problems(spark, folder).select("p_id", text.clean_for_model(F.col("description")).alias("clean"))


@query("txt8_number_tokens", f"SELECT doc_id, {numbers_sql('text')} AS tokens FROM documents")
def txt8(spark, folder):
    return documents(spark, folder).select("doc_id", text.tokenize_numbers(F.col("text")).alias("tokens"))


@query("txt9_char_ngrams", """
WITH c AS (SELECT item_id, string_split(lower(text), '') AS c FROM benchmark),
g AS (SELECT item_id, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM c)
SELECT item_id, gram, count(*) AS count FROM g GROUP BY 1, 2""")
def txt9(spark, folder):
    grams = read_table(spark, folder, "benchmark").select(
        "item_id", F.explode(text.char_ngrams(F.col("text"), 3)).alias("gram"))
    return grams.groupBy("item_id", "gram").agg(F.count("*").alias("count"))


@query("txt10_word_tokens", f"""
SELECT doc_id, len(regexp_extract_all(lower(text), '[{WORD}]+')) AS n_tokens,
       len(regexp_extract_all(text, '[{WORD}]{{2,}}')) AS n_terms,
       md5(array_to_string(regexp_extract_all(lower(text), '[{WORD}]+'), ' ')) AS token_hash FROM documents""")
def txt10(spark, folder):
    c = F.col("text")
    tokens = text.word_tokens(F.lower(c))
    return longs(documents(spark, folder).select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.size(text.word_tokens(c, 2)).alias("n_terms"),
        F.md5(F.array_join(tokens, " ")).alias("token_hash")), "n_tokens", "n_terms")


def clean_for_embeddings_sql(c: str) -> str:
    c = f"coalesce({c}, '')"
    for block in (r"\$\$\$.*?\$\$\$", r"\$\$.*?\$\$", r"\$.*?\$", r"\\\[.*?\\\]", r"\\\(.*?\\\)"):
        c = rx(c, "(?s)" + block, " MATHBLOCK ")
    return f"lower({squeeze_sql(commands_sql(c, LATEX_COMMAND_TOKENS_EMBEDDING))})"


@query("txt11_clean_for_embeddings", CTE + f"""
SELECT p_id, {clean_for_embeddings_sql('description')} AS clean, lower({squeeze_sql('description')}) AS clean_raw_latex FROM problems""")
def txt11(spark, folder):
    c = F.col("description")
    return problems(spark, folder).select(
        "p_id", text.clean_for_embeddings(c).alias("clean"),
        text.clean_for_embeddings(c, replace_latex=False).alias("clean_raw_latex"))


@query("txt13_mathblock_counts", CTE + f"""
, n AS (SELECT len(regexp_extract_all({clean_for_model_sql('description')}, 'mathblock')) AS n FROM problems)
SELECT n AS n_mathblocks, count(*) AS documents, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM n), 6) AS percentage
FROM n GROUP BY 1""")
def txt13(spark, folder):
    p = problems(spark, folder)
    n = text.mathblock_count(text.clean_for_model(F.col("description")))
    return p.groupBy(n.cast("bigint").alias("n_mathblocks")).agg(F.count("*").alias("documents")).select(
        "*", rnd(numeric.pct(F.col("documents"), tag_ops.row_total(p))).alias("percentage"))


@query("txt14_sentence_features", f"""
SELECT doc_id, len(regexp_extract_all(text, '[.!?]+([{WS}]|$)')) AS sentences,
       coalesce(round(length({rx('text', f'[{WS}]+', '')}) / nullif(len(regexp_extract_all(text, '[^{WS}]+')), 0)::DOUBLE, 6), 0) AS mean_word_length
FROM documents""")
def txt14(spark, folder):
    c = F.col("text")
    return longs(documents(spark, folder).select(
        "doc_id", text.sentence_count(c).alias("sentences"), rnd(text.mean_word_length(c)).alias("mean_word_length")),
        "sentences")


SYMBOLS_RE = r"\\(?:" + "|".join(LATEX_SYMBOLS) + ")"
BLOCKS_RE = r"\$\$\$[^\n]*?\$\$\$|\$[^\n]*?\$"
PLAIN_SQL = squeeze_sql(rx(f"lower({rx(rx('description', LINE_BLOCK3, ' '), LINE_BLOCK1, ' ')})", f"[^a-z0-9{WS}-]", " "))


@query("ltx1_split_text_latex", CTE + f"""
, x AS (SELECT *, regexp_extract_all(description, '{BLOCKS_RE}') AS b, regexp_extract_all(description, '{SYMBOLS_RE}') AS s FROM problems)
SELECT p_id, {PLAIN_SQL} AS clean_description, array_to_string(b, '|') AS latex_blocks, array_to_string(s, '|') AS latex_symbols,
       len(b) AS nb_latex_blocks, len(s) AS nb_latex_symbols,
       round(length(array_to_string(b, '')) / length(description)::DOUBLE, 6) AS latex_density,
       round(len(s) / length(description)::DOUBLE, 6) AS latex_symbols_density
FROM x""")
def ltx1(spark, folder):
    parts = latex.split_text_latex(F.col("description"))
    out = problems(spark, folder).select("p_id", *[c.alias(n) for n, c in parts.items()])
    out = out.withColumns({n: F.array_join(n, "|") for n in ("latex_blocks", "latex_symbols")})
    return rounded(longs(out, "nb_latex_blocks", "nb_latex_symbols"), "latex_density", "latex_symbols_density")


@query("ltx1_symbol_counts", CTE + f"""
, s AS (SELECT p_id, unnest(regexp_extract_all(description, '{SYMBOLS_RE}')) AS symbol FROM problems)
SELECT p_id, symbol, count(*) AS count FROM s GROUP BY 1, 2""")
def ltx1_counts(spark, folder):
    counts = latex.symbol_counts(latex.symbols(F.col("description")))
    return longs(problems(spark, folder).select("p_id", F.explode(counts).alias("symbol", "count")), "count")


TOKEN_SQL = squeeze_sql(rx(rx(rx(rx("description", LINE_BLOCK3, "[LATEX]"), r"\\[a-zA-Z]+\{[^}]*\}", "[LATEX]"),
                              r"\\[a-zA-Z]+", "[LATEX]"), rf"\[LATEX\]([{WS}]*\[LATEX\])+", "[LATEX]"))


@query("ltx2_latex_to_token", CTE + f"SELECT p_id, {TOKEN_SQL} AS without_latex FROM problems")
def ltx2(spark, folder):
    return problems(spark, folder).select("p_id", latex.latex_to_token(F.col("description")).alias("without_latex"))


PROFILE_RE = r"\\(?:" + "|".join(LATEX_PROFILE_SYMBOLS) + ")"


@query("ltx3_latex_profile", CTE + f"""
, x AS (SELECT *, regexp_extract_all(description, '{LINE_BLOCK3}') AS b FROM problems)
SELECT p_id, len(b) AS nb_latex_blocks, len(regexp_extract_all(description, '{PROFILE_RE}')) AS nb_latex_symbols,
       length(array_to_string(b, '')) AS total_latex_chars,
       round(length(array_to_string(b, '')) / length(description)::DOUBLE, 6) AS latex_density FROM x""")
def ltx3(spark, folder):
    parts = latex.profile(F.col("description"))
    out = problems(spark, folder).select("p_id", *[c.alias(n) for n, c in parts.items()])
    return rounded(longs(out, "nb_latex_blocks", "nb_latex_symbols", "total_latex_chars"), "latex_density")


@query("ltx5_single_dollar", CTE + """
SELECT p_id, replace(CASE WHEN length(description) > 200 THEN substr(description, 1, 200) || '...' ELSE description END, '$$$', '$') AS cut,
       replace(description, '$$$', '$') AS whole FROM problems""")
def ltx5(spark, folder):
    c = F.col("description")
    return problems(spark, folder).select(
        "p_id", latex.single_dollar(c, 200).alias("cut"), latex.single_dollar(c).alias("whole"))


@query("ltx7_symbol_features", CTE + "SELECT p_id, " + ", ".join(
    f"len(regexp_extract_all(description, '\\\\{s}([^a-zA-Z]|$)')) AS latex_{s}_count" for s in ["gcd", "bmod", "frac", "sum", "le", "leq"]
) + " FROM problems")
def ltx7(spark, folder):
    names = ["gcd", "bmod", "frac", "sum", "le", "leq"]
    counts = [F.regexp_count("description", F.lit(rf"\\{s}(?![a-zA-Z])")).cast("bigint").alias(f"latex_{s}_count") for s in names]
    return problems(spark, folder).select("p_id", *counts)


@query("cod1_import_flags", CTE + "SELECT p_id, " + ", ".join(
    rf"CAST(regexp_matches(source_code, '\b(import\s+{m}|from\s+{m}\s+import)\b') AS INTEGER) AS import_{m}" for m in IMPORT_MODULES
) + " FROM problems")
def cod1(spark, folder):
    flags = code.import_flags(F.col("source_code"))
    return problems(spark, folder).select("p_id", *[c.alias(n) for n, c in flags.items()])


@query("cod1_import_table", CTE.replace("WITH ", f"WITH {KEYWORD_TABLE},\n", 1) + rf"""
, modules AS (SELECT DISTINCT keyword AS module FROM keywords UNION SELECT unnest([{sql_list(IMPORT_MODULES)}]))
SELECT p_id, coalesce(string_agg(module, '|' ORDER BY module), '') AS modules FROM problems LEFT JOIN modules
  ON contains(source_code, module) AND regexp_matches(source_code, '\b(import\s+' || module || '|from\s+' || module || '\s+import)\b') GROUP BY p_id""")
def cod1_table(spark, folder):
    modules = keyword_table(spark, folder).select("keyword").union(spark.createDataFrame([(m,) for m in IMPORT_MODULES], "keyword string"))
    found = Keywords.from_table(modules, fold=False).imported(F.col("source_code"))
    return problems(spark, folder).select("p_id", F.array_join(found, "|").alias("modules"))


def _has(s, low=False):
    return f"contains({'lower(source_code)' if low else 'source_code'}, '{s}')"


PATTERN_SQL = {
    "has_deque": _has("deque"),
    "has_queue": f"{_has('Queue')} OR {_has('deque')}",
    "has_stack": f"{_has('stack', True)} OR ({_has('append')} AND {_has('pop')})",
    "has_dsu": f"({_has('parent')} AND {_has('find')}) OR {_has('union', True)}",
    "has_recursion": _has("setrecursionlimit"),
    "has_dp": f"{_has('dp[')} OR {_has('memo', True)}",
    "has_adjacency": f"{_has('adj', True)} OR {_has('graph[')} OR {_has('edges')}",
    "has_sort": f"{_has('.sort')} OR {_has('sorted(')}",
    "has_bisect": _has("bisect"),
}


@query("cod2_pattern_flags", CTE + "SELECT p_id, " + ", ".join(
    f"CAST({rule} AS INTEGER) AS {name}" for name, rule in PATTERN_SQL.items()) + " FROM problems")
def cod2(spark, folder):
    flags = code.pattern_flags(F.col("source_code"))
    return problems(spark, folder).select("p_id", *[c.alias(n) for n, c in flags.items()])


STRUCTURE_SQL = CTE + r"""
SELECT p_id, len(regexp_extract_all(source_code, '(?m)^[ \t]*def ')) AS num_functions,
       len(regexp_extract_all(source_code, '(?m)^[ \t]*class ')) AS num_classes,
       len(regexp_extract_all(source_code, '(?m)^[ \t]*for[^a-zA-Z0-9_]')) AS num_for_loops,
       len(regexp_extract_all(source_code, '(?m)^[ \t]*while[^a-zA-Z0-9_]')) AS num_while_loops,
       len(regexp_extract_all(source_code, '(?m)^[ \t]*(if|elif)[^a-zA-Z0-9_]')) AS num_if_statements,
       CAST(floor(list_max(list_transform(string_split(source_code, chr(10)), lambda l: length(l) - length(ltrim(l)))) / 4) AS BIGINT) AS max_depth
FROM problems"""


@query("cod3_code_structure", STRUCTURE_SQL)
def cod3(spark, folder):
    counts = code.structure_counts(F.col("source_code")).alias("s")
    return problems(spark, folder).select("p_id", counts).select("p_id", "s.*")


@query("cod3_code_around_text", STRUCTURE_SQL)
def cod3_text(spark, folder):
    """The same counts with a text in a string above the code and each of its lines in a comment below."""
    words = F.regexp_replace(F.coalesce("description", F.lit("")), r"[\\\\']", " ")
    around = F.concat(F.lit("'''for "), words, F.lit("\ndef'''\n"), F.col("source_code"), F.lit("\n# if "), F.regexp_replace(words, r"\r\n?|\n", "\n  # while "))
    counts = code.structure_counts(around).alias("s")
    return problems(spark, folder).select("p_id", counts).select("p_id", "s.*")


@query("src4_parse_tags", CTE + """
SELECT p_id, coalesce(tags_csv, '') AS tags, count(t.tag) AS n_tags
FROM problems LEFT JOIN tagged t USING (p_id) GROUP BY p_id, tags_csv""")
def src4(spark, folder):
    from ...sources.readers import extract_tags_list

    printed = F.concat(F.lit("['"), F.replace("tags_csv", F.lit(","), F.lit("', '")), F.lit("']"))
    p = problems(spark, folder).select("p_id", F.coalesce(printed, F.lit("[]")).alias("tags"))
    p = extract_tags_list(p)
    return p.select("p_id", F.array_join("tags", ",").alias("tags"), F.size("tags").cast("bigint").alias("n_tags"))
