"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Each query is run to completion into a sink that discards
the rows; the session is warmed with one query that is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: One or more queries of every family of the inventory.
HEADLINE = """
    agg6_lift_pmi agg6_order_baskets agg3_cooccurrence agg9_tag_distribution agg12_numeric_stats_by_tag
    agg16_missing_profile agg18_databook agg21_duplicate_groups agg22_keep_first agg24_fill_median
    agg25_correlation_matrix agg28_five_numbers agg29_length_percentiles agg32_keyword_coverage
    agg34_symbol_enrichment jn1_rows_with_duplicate_key jn8_apply_translations
    txt1_length_features txt7_clean_for_model txt12_identify_language ltx1_split_text_latex ltx2_latex_to_token
    cod2_pattern_flags top1_top_words_by_tag top5_char_ngrams top6_discriminant_ngrams
    spl1_grouped_split spl2_stratified_split vec1_tfidf_vocabulary vec1_tfidf_weights vec2_bigram_counts
    emb3_centroid_similarity emb5_separation met1_overall mod6_best_thresholds src3_parquet_scan mod1_logistic
""".split()


def main() -> None:
    from tagspark.plans.catalog import QUERIES
    from tagspark.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["agg1_tag_statistics"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder.rstrip("/")).replace("sf", ""), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
