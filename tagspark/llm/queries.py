"""One query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import embedding_pq, html_blocks, language_cnn, lexical_search, lm_words, merkle_windows, mixing, pii_crf, quality_trees, sentencepiece_unigram, simhash_covering, substring_cover, syncmers
from .registry import ORACLES, QUERIES, query, table


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by the byte network."""
    return language_cnn.identify(table(spark, folder, "documents"))


MIX_SQL = r"""WITH RECURSIVE sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
named AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight FROM totals),
stated AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER w, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS heavy
  FROM named WINDOW w AS (ORDER BY source_size / weight::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, left_over * weight > 3 * source_size * heavy AS over_cap FROM stated),
level AS (SELECT max(left_over::DOUBLE / heavy::DOUBLE) AS level FROM filled WHERE NOT over_cap),
targets AS (SELECT source, source_size, CASE WHEN over_cap THEN (3 * source_size)::DOUBLE ELSE level * weight END AS target FROM filled, level),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN floor(round(target / source_size, 9)) ELSE 0 END AS whole FROM targets),
ranked AS (SELECT doc_id, s.source, h, size, source_size, target, whole, target - whole * source_size AS extra,
    sum(size) OVER (PARTITION BY s.source ORDER BY h, size ROWS UNBOUNDED PRECEDING) <= target - whole * source_size AS more
  FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
gaps AS (SELECT source, any_value(extra) - sum(CASE WHEN more THEN size ELSE 0 END) AS gap FROM ranked GROUP BY source),
fits AS (SELECT r.source, doc_id, size, gap, row_number() OVER (PARTITION BY r.source ORDER BY h, size) AS n
  FROM ranked r JOIN gaps g ON r.source IS NOT DISTINCT FROM g.source WHERE NOT more AND size > 0 AND size <= gap),
fill AS (SELECT source, doc_id, n, CASE WHEN size <= gap THEN gap - size ELSE gap END AS gap, size <= gap AS took FROM fits WHERE n = 1
  UNION ALL SELECT f.source, f.doc_id, f.n, CASE WHEN f.size <= p.gap THEN p.gap - f.size ELSE p.gap END, f.size <= p.gap
  FROM fill p JOIN fits f ON f.source IS NOT DISTINCT FROM p.source AND f.n = p.n + 1)
SELECT r.doc_id, size, source_size, target,
  (least(whole + CASE WHEN more OR coalesce(f.took, FALSE) THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM ranked r LEFT JOIN fill f ON r.doc_id = f.doc_id"""


@query("op2_mix_sources", MIX_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_sentencepiece")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    return sentencepiece_unigram.round_trip(table(spark, folder, "documents"))


@query("op4_embedding_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_pq.near_duplicates(table(spark, folder, "embeddings"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses to repeated passages, and a digest of the rest."""
    kept = substring_cover.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash_covering.near_duplicates(table(spark, folder, "documents"))
    return groups.select("doc_id", simhash_covering.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query("op7_fingerprints")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited form."""
    return syncmers.fingerprint_edits(table(spark, folder, "documents"))


@query("op8_html_extraction")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract_pages(table(spark, folder, "pages"))


@query("op9_lm_scoring")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document by word models of the documents labelled as good and of all others."""
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return lm_words.score_against(table(spark, folder, "documents"), good)


@query("op10_pii")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: pattern spans and what the CRF adds."""
    return pii_crf.find_personal_data(table(spark, folder, "documents"))


MERKLE_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, text,
    concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(range(len(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::UBIGINT)),
        lambda a, z: xor(a >> 1, 3988292384::UBIGINT * (a & 1::UBIGINT))))) AS crc
  FROM documents),
leaves AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || strlen(low) || ':' || low) END AS tampered FROM d),
placed AS (SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)),
nodes AS (SELECT tree, 0 AS level, place, n, leaf AS h FROM placed
  UNION ALL SELECT tree, any_value(level) + 1, place // 8 AS place, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY tree, place // 8),
subroots AS (SELECT tree, h AS subroot FROM nodes WHERE n = 1),
langs AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS lang_place, count(*) OVER () AS langs FROM subroots),
tops AS (SELECT 0 AS level, lang_place AS place, langs AS n, subroot AS h FROM langs
  UNION ALL SELECT any_value(level) + 1, place // 8 AS place, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY place // 8),
siblings AS (SELECT tree, level, place,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, place // 8 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, place // 8 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, level, place, n, h FROM nodes UNION ALL SELECT '', level, place, n, h FROM tops) WHERE n > 1),
climb AS (SELECT doc_id, leaf, tree, place, place AS pos, 0 AS level, coalesce(tampered, leaf) AS h, '' AS proof FROM placed
  UNION ALL SELECT doc_id, leaf, c.tree, c.place, pos // 8, c.level + 1, sha256(l || h || r), proof || l || r
  FROM climb c JOIN siblings s ON s.tree = c.tree AND s.level = c.level AND s.place = c.pos),
inner_end AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) AS k FROM climb) WHERE k = 1),
climb2 AS (SELECT doc_id, leaf, c.tree, c.place, lang_place AS pos, 0 AS level, h, proof, subroot FROM inner_end c JOIN langs USING (tree)
  UNION ALL SELECT doc_id, leaf, c.tree, c.place, pos // 8, c.level + 1, sha256(l || h || r), proof || l || r, subroot
  FROM climb2 c JOIN siblings s ON s.tree = '' AND s.level = c.level AND s.place = c.pos),
ended AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) AS k FROM climb2) WHERE k = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM ended, (SELECT h AS root FROM tops WHERE n = 1)"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The Merkle manifest of the documents, and which leaves still verify after tampering."""
    return merkle_windows.verify_against_tampering(table(spark, folder, "documents"))


SEARCH_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
counted AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS total FROM d WHERE len(words) > 0),
tf AS (SELECT r, doc_id, len(words)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM d, unnest(words) AS u(term) GROUP BY ALL),
asked AS (SELECT q, item_id, term, count(*)::BIGINT AS times
  FROM (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM benchmark), unnest(words) AS u(term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, counted GROUP BY term, n_docs),
scored AS (SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // total))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), counted GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20"""


@query("op12_ranked_search", SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_quality_rules")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and the boosted trees' verdict on every document."""
    judged = quality_trees.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


__all__ = ["ORACLES", "QUERIES"]
