"""Keyword tables against plain substring and regular expression searches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagspark.functions import code, text
from tagspark.operators import keywords as kw

TEXTS = [None, "", "abc", "ABCabc", "the cat\nsat", "ÉTÉ 日本語", "aaaaab", "x" * 50_000 + "needle", "no match here"]


@pytest.mark.parametrize("part", [3, kw.PART])
def test_found_equals_substring_search(spark, monkeypatch, part):
    monkeypatch.setattr(kw, "PART", part)
    rng = random.Random(3)
    words = ["a", "aa", "ab", "abc", "ABC", "cat\nsat", "été", "本", "needle", "missing", "a"]
    texts = TEXTS + ["".join(rng.choice("abc ") for _ in range(rng.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = kw.Keywords.listed(words)
    rows = df.select("id", table.found(F.col("t")).alias("k"), text.find_keywords(F.col("t"), list(dict.fromkeys(words))).alias("plain")).collect()
    for r in rows:
        assert r["k"] == r["plain"]
        assert r["k"] == [w for w in dict.fromkeys(words) if texts[r["id"]] is not None and w.lower() in texts[r["id"]].lower()]


def test_ten_thousand_keywords(spark):
    words = [f"key{i}" for i in range(10_000)]
    df = spark.createDataFrame([(i, f"some key{i * 7} and key{i}9, ") for i in range(300)], "id int, t string")
    table = kw.Keywords.from_table(spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "keyword string"))
    assert table.words == sorted(words)
    for r in df.select("id", "t", table.found(F.col("t")).alias("k")).collect():
        # Numbers start with one another: key1, key14, key140 are all in "key1407".
        numbers = re.findall(r"key(\d+)", r["t"])
        assert r["k"] == sorted({f"key{n[:j]}" for n in numbers for j in range(1, len(n) + 1) if n[:j] == str(int(n[:j])) and int(n[:j]) < 10_000})


def test_odd_tables(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Some text"), (2, None), (3, "")], "id int, t string")
    none = kw.Keywords.from_table(spark.createDataFrame([], "keyword string"))
    assert [r["k"] for r in df.orderBy("id").select(none.found(F.col("t")).alias("k")).collect()] == [[], [], []]
    table = spark.createDataFrame([("", "all"), ("TEXT", "b"), ("text", "a"), ("text", "b"), (None, "c"), ("x", None)], "keyword string, tag string")
    named = kw.Keywords.from_table(table, "keyword", "tag")
    assert [r["k"] for r in df.orderBy("id").select(named.found(F.col("t")).alias("k")).collect()] == [["a", "all", "b"], [], ["all"]]
    monkeypatch.setattr(kw, "MOST_BYTES", 5)
    with pytest.raises(ValueError, match="at most 5"):
        kw.Keywords.from_table(table)


def test_imports_equal_the_patterns(spark):
    rng = random.Random(4)
    modules = ["math", "os", "os.path", "collections", "ma", "th"]
    bits = ["import", "from", "math", "os", "os.path", "collections", "ma", "th", " ", "  ", "\n", "\t", ",", ".", "_", "é", "ximport", "imports"]
    sources = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    sources += [None, "", "import math", "from  os\timport path", "from os.path import x", "import " + " " * 100_000 + "os"]
    df = spark.createDataFrame(list(enumerate(sources)), "id int, c string")
    table = kw.Keywords.of([(m, m) for m in modules])
    flags = code.import_flags(F.col("c"), [re.escape(m) for m in modules])
    rows = df.select("id", table.imported(F.col("c")).alias("k"), F.array(*flags.values()).alias("flags")).collect()
    for r in rows:
        assert r["k"] == [m for m, f in zip(modules, r["flags"]) if f], sources[r["id"]]


def test_coverage_of_a_table(spark):
    df = spark.createDataFrame([(["a", "b"], "one two", "x"), (["a"], None, "one"), (["c"], "one", None), (None, "one", "one"), (["b", "b"], "", "")],
                               "tags array<string>, d string, c string")
    table = spark.createDataFrame([("a", "One"), ("a", "two"), ("b", "two"), ("z", "one")], "tag string, keyword string")
    rows = {r["tag"]: tuple(r)[1:] for r in kw.keyword_coverage(df, "d", "c", table).collect()}
    assert rows == {"a": (2, 0.5, 0.5, 1.0), "b": (2, 0.5, 0.0, 0.5)}
