"""The ``problems`` view: the record table derived from the driver tables.

The stock tables have no LaTeX, tags or code, so those columns are derived
from ``documents`` and ``labels``. The catalog's SQL holds the same view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .readers import read_table, spread


def problems(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    labels = read_table(spark, folder, "labels")
    return derive(docs, labels)


def derive(docs: DataFrame, labels: DataFrame) -> DataFrame:
    d = docs.select(F.col("doc_id").alias("p_id"), "text", "lang", "source")
    lab = labels.select(F.col("doc_id").alias("p_id"), "quality", "toxic")
    joined = d.join(lab, "p_id", "left")
    i, text = F.col("p_id"), F.col("text")

    description = (
        F.when(i % 4 == 0, text)
        .when(i % 4 == 1, F.concat(text, F.lit(" Let $$$n$$$ and $$$1 \\le n \\leq 10^5$$$ hold.")))
        .when(i % 4 == 2, F.concat(text, F.lit(" Find $\\gcd(a,b)$ and $$$\\frac{a}{b}$$$ mod 1000000007.")))
        .otherwise(F.concat(text, F.lit(" Print $$$\\sum_{i=1}^{n} a_i$$$ with error 0.001, up to 1e9 or 10101.")))
    )
    notes = (
        F.when(i % 5 == 0, F.lit(None).cast("string"))
        .when(i % 5 == 1, "NoteIn the first test the answer is 1.")
        .when(i % 5 == 2, "NoteIN the first test the answer is 2.")
        .when(i % 5 == 3, "NoteThe second test has no answer.")
        .otherwise("No remarks.")
    )
    time_limit = (
        F.when(i % 6 == 0, "1 second").when(i % 6 == 1, "2 seconds").when(i % 6 == 2, "0.5 seconds")
        .when(i % 6 == 3, "3.0 s").when(i % 6 == 4, "unlimited")
    )
    difficulty = (
        F.when(i % 13 == 0, F.lit(None).cast("double"))
        .when(i % 11 == 0, F.lit(-1.0))
        .otherwise((800 + 100 * (i % 28)).cast("double"))
    )
    tags_csv = F.nullif(
        F.concat_ws(
            ",",
            F.when((i % 4 == 0) | (i % 7 == 0), "math"),
            F.when(i % 5 == 1, "graphs"),
            F.when((F.col("lang") == "en") & (i % 3 == 0), "strings"),
            F.when(i % 7 == 0, "number theory"),
            F.when((i % 10 == 1) | (i % 11 == 0), "trees"),
            F.when(i % 17 == 0, "geometry"),
            F.when(F.col("toxic") == 1, "games"),
            F.when(i % 23 == 0, "probabilities"),
            F.when(F.col("quality") == 1, "dp"),
        ),
        F.lit(""),
    )
    source_code = (
        F.when(i % 3 == 0, "import math\nfor i in range(3):\n    if i:\n        print(math.gcd(i, 6))")
        .when(i % 3 == 1, "from collections import deque\ndef bfs(adj):\n    q = deque()\n    while q:\n        q.pop()")
        .otherwise("a = sorted(input())\ndp[0] = 1")
    )
    return joined.select(
        "p_id",
        F.md5(i.cast("string")).alias("src_uid"),
        "lang",
        "source",
        description.alias("description"),
        notes.alias("notes"),
        F.when(i % 8 != 0, F.concat(F.lit("Line "), i.cast("string"), F.lit(" holds $$$n$$$."))).alias("input_spec"),
        F.when(i % 9 != 0, F.lit("Print one integer.")).alias("output_spec"),
        text.alias("sample_inputs"),
        F.when(i % 2 == 0, i.cast("string")).alias("sample_outputs"),
        time_limit.alias("time_limit"),
        difficulty.alias("difficulty"),
        tags_csv.alias("tags_csv"),
        F.coalesce(F.split(tags_csv, ","), F.array().cast("array<string>")).alias("tags"),
        source_code.alias("source_code"),
        F.when(i % 9 == 0, "FAILED").otherwise("PASSED").alias("exec_outcome"),
    )


#: The same view in SQL both engines run.
PROBLEMS_SQL = """
SELECT d.doc_id AS p_id,
       md5(CAST(d.doc_id AS STRING)) AS src_uid,
       d.lang, d.source,
       CASE d.doc_id % 4
         WHEN 0 THEN d.text
         WHEN 1 THEN d.text || ' Let $$$n$$$ and $$$1 ' || chr(92) || 'le n ' || chr(92) || 'leq 10^5$$$ hold.'
         WHEN 2 THEN d.text || ' Find $' || chr(92) || 'gcd(a,b)$ and $$$' || chr(92) || 'frac{a}{b}$$$ mod 1000000007.'
         ELSE d.text || ' Print $$$' || chr(92) || 'sum_{i=1}^{n} a_i$$$ with error 0.001, up to 1e9 or 10101.'
       END AS description,
       CASE d.doc_id % 5
         WHEN 0 THEN NULL
         WHEN 1 THEN 'NoteIn the first test the answer is 1.'
         WHEN 2 THEN 'NoteIN the first test the answer is 2.'
         WHEN 3 THEN 'NoteThe second test has no answer.'
         ELSE 'No remarks.'
       END AS notes,
       CASE WHEN d.doc_id % 8 <> 0 THEN 'Line ' || CAST(d.doc_id AS STRING) || ' holds $$$n$$$.' END AS input_spec,
       CASE WHEN d.doc_id % 9 <> 0 THEN 'Print one integer.' END AS output_spec,
       d.text AS sample_inputs,
       CASE WHEN d.doc_id % 2 = 0 THEN CAST(d.doc_id AS STRING) END AS sample_outputs,
       CASE d.doc_id % 6
         WHEN 0 THEN '1 second' WHEN 1 THEN '2 seconds' WHEN 2 THEN '0.5 seconds'
         WHEN 3 THEN '3.0 s' WHEN 4 THEN 'unlimited' ELSE NULL
       END AS time_limit,
       CAST(CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN d.doc_id % 11 = 0 THEN -1
                 ELSE 800 + 100 * (d.doc_id % 28) END AS DOUBLE) AS difficulty,
       nullif(concat_ws(',',
         CASE WHEN d.doc_id % 4 = 0 OR d.doc_id % 7 = 0 THEN 'math' END,
         CASE WHEN d.doc_id % 5 = 1 THEN 'graphs' END,
         CASE WHEN d.lang = 'en' AND d.doc_id % 3 = 0 THEN 'strings' END,
         CASE WHEN d.doc_id % 7 = 0 THEN 'number theory' END,
         CASE WHEN d.doc_id % 10 = 1 OR d.doc_id % 11 = 0 THEN 'trees' END,
         CASE WHEN d.doc_id % 17 = 0 THEN 'geometry' END,
         CASE WHEN l.toxic = 1 THEN 'games' END,
         CASE WHEN d.doc_id % 23 = 0 THEN 'probabilities' END,
         CASE WHEN l.quality = 1 THEN 'dp' END), '') AS tags_csv,
       CASE d.doc_id % 3
         WHEN 0 THEN 'import math' || chr(10) || 'for i in range(3):' || chr(10) || '    if i:' || chr(10) || '        print(math.gcd(i, 6))'
         WHEN 1 THEN 'from collections import deque' || chr(10) || 'def bfs(adj):' || chr(10) || '    q = deque()' || chr(10) || '    while q:' || chr(10) || '        q.pop()'
         ELSE 'a = sorted(input())' || chr(10) || 'dp[0] = 1'
       END AS source_code,
       CASE WHEN d.doc_id % 9 = 0 THEN 'FAILED' ELSE 'PASSED' END AS exec_outcome
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
