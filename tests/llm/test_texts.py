"""Language, tokens, pages, models, personal data and mixing."""

import math
import random
import re
import time
from collections import Counter

import pytest
from check import compare
from pyspark.sql import functions as F

from helpers import LONG, ROWS, empty, odd
from tagspark.llm import html_blocks, language_cnn, mixing, pii_crf, queries, sentencepiece_unigram as sp


def test_queries_and_the_pipeline(spark):
    import __spark_entry__ as entry

    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


# Language --------------------------------------------------------------------------

def test_language_of_held_out_documents(spark, folder):
    rows = queries.QUERIES["op1_language_id"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    joined = rows.join(truth, "doc_id").where("held_out")
    assert joined.where("lang_pred = lang").count() >= 0.95 * joined.count() > 0
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows.collect())


def test_language_odd_rows(spark):
    rows = language_cnn.identify(odd(spark)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert Counter(r["lang_pred"] for r in rows)["und"] == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in ROWS)
    unlabelled = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_cnn.identify(unlabelled).collect()} == {"und"}
    assert language_cnn.identify(empty(spark)).count() == 0
    kept = language_cnn.keep_identified(odd(spark))
    assert kept.columns == odd(spark).columns and kept.where("text IS NULL OR trim(text) = ''").count() == 0


@pytest.mark.parametrize("most", [1, 7, 100])
def test_training_sample_is_the_smallest_hashes(spark, most):
    rows = [(f"text number {i // 2 if i < 40 else i}", ["de", "en", None, "x"][i % 4 if i % 5 else 1]) for i in range(600)] + [("", "en"), (None, "en")]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("h", F.xxhash64("text"))
    got = language_cnn.training_sample(df, per_language=most, pieces=1).collect()
    assert len(got) == sum(min(most, n) for lang, n in Counter(l for t, l in rows if t).items() if lang)
    for lang in ("de", "en", "x"):
        hashes = sorted(r["h"] for r in df.collect() if r["lang"] == lang and r["text"])
        assert sorted(r["h"] for r in got if r["lang"] == lang) == hashes[:most]


def test_windows_tile_texts():
    text = bytes(range(1, 200)) * 3
    rows, counts = language_cnn.windows([b"ab", text])
    assert counts.tolist() == [1, 5] and bytes(rows[0]) == b"ab".ljust(128, b"\0")
    assert bytes(rows[1]) == text[:128] and bytes(rows[5]) == text[-128:]


# Mixing ----------------------------------------------------------------------------

def test_mix_matches_sql(spark, con, folder):
    message, _ = compare(con, spark, folder, queries.QUERIES["op2_mix_sources"], queries.ORACLES["op2_mix_sources"])
    assert message is None, message


def test_mix_of_odd_rows(spark):
    df = odd(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == len(ROWS)
    sizes = Counter()
    for _, t, _, s, _ in ROWS:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(r["size"] for r in rows) == sizes.total()
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in rows)
    assert math.isclose(sum({r["source_size"]: r["target"] for r in rows}.values()), sizes.total())
    repeated = mixing.repeat_rows(df)
    assert repeated.columns == df.columns and repeated.count() == sum(r["copies"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert mixing.mix(empty(spark)).count() == 0 and mixing.repeat_rows(empty(spark)).count() == 0


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(1, 60), "abcd"[min(3, int(rng.expovariate(1)))]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("target").agg(
        F.sum("taken").alias("taken")).collect()
    assert len(got) == 4 and all(r["target"] - 60 <= r["taken"] <= r["target"] + 1e-6 for r in got)


def test_mix_tries_every_document(spark):
    """First fit through the whole order: one long text at the cut, more than 256 short ones, some rows twice."""
    import hashlib

    for seed, lengths, long_at in ((1, [1, 2, 3], 500), (2, [2, 5, 17, 40, 90], 100), (3, [20], 2000)):
        rng = random.Random(seed)
        order = sorted(range(1500), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        # Of source a the third document of the order is long enough to be the one at the cut.
        sizes = {i: rng.choice(lengths) for i in order}
        sizes[order[2]] = sum(sizes.values()) + long_at
        rows = [(i, "w " * sizes[i], "a") for i in order] + [(order[9], "w " * sizes[order[9]], "a")] * 3
        rows += [(5000 + i, "w " * 30, "b") for i in range(sum(sizes.values()) // 100)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = mixing.mix(df).where("source_size > 0").collect()
        for total in {r["source_size"] for r in got}:
            mine = sorted((hashlib.md5(str(r["doc_id"]).encode()).hexdigest(), r["size"], r["taken"]) for r in got if r["source_size"] == total)
            target = next(r["target"] for r in got if r["source_size"] == total)
            whole = math.floor(round(target / total, 9))
            gap, want = target - whole * total, []
            for h, size, _ in mine:
                fits = size <= gap
                gap -= size if fits else 0
                want.append((h, size, (whole + fits) * size))
            assert sorted(mine) == sorted(want)


# SentencePiece ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(sp.load())


def brute_score(v, data):
    """Best sum of scores over all segmentations of the bytes, characters without a piece at the penalty."""
    by_piece = {v.pieces[i]: s for i, s in v.scores.items()}
    best = {0: 0.0}
    text = data.decode()
    ends = [len(text[:i].encode()) for i in range(len(text) + 1)]
    for k, end in enumerate(ends[1:], 1):
        options = []
        for start in ends[:k]:
            if data[start:end] in by_piece:
                options.append(best[start] + by_piece[data[start:end]])
        if data[ends[k - 1]:end] not in by_piece:
            options.append(best[ends[k - 1]] + v.unknown)
        best[end] = max(options)
    return best[len(data)]


def test_viterbi_is_optimal_and_exact(encoder):
    v, rng = encoder.v, random.Random(7)
    texts = ["".join(rng.choice("abthe  \n.,▁é日𝄞½x'1") for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["", " ", "  a", "\n\n", "▁▁", "a ▁b", "x" * 200, "Hello world, it's me."]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert encoder.decode(ids.tolist()) == text
        if text:
            # A character spelled in bytes counts once, at its first byte.
            scores = [v.scores[i] if i in v.scores else v.unknown if v.pieces[i][0] & 0xC0 != 0x80 else 0 for i in ids.tolist()]
            assert math.isclose(sum(scores), brute_score(v, (" " + text).encode()), abs_tol=1e-6), text
    singles = [i for c in v.chunks.findall(" " + texts[-1]) for i in encoder.best(c.encode())]
    assert singles == encoder.encode([texts[-1]])[0].tolist()


def test_double_array_holds_exactly_its_keys():
    rng = random.Random(8)
    keys = sorted({bytes(rng.choice(b"abc\xff") for _ in range(rng.randrange(1, 6))) for _ in range(300)})
    base, check = sp.double_array([(k, i) for i, k in enumerate(keys)])

    def find(key):
        state = 0
        for b in key:
            to = base[state] + b + 1
            if check[to] != state:
                return None
            state = to
        end = base[state]
        return -1 - base[end] if check[end] == state and base[end] < 0 else None

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert all(find(k + b"z") is None for k in keys)


def test_round_trip_query(spark, folder):
    rows = queries.QUERIES["op3_sentencepiece"](spark, folder)
    assert rows.where("exact").count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    coded = sp.round_trip(odd(spark)).collect()
    assert len(coded) == len(ROWS) and all(r["exact"] for r in coded) and max(r["doc_id"] or 0 for r in coded) == 1 << 60
    assert [r["piece_ids"] for r in coded if r["doc_id"] == 2] == [None]
    whole = sp.tokenize(odd(spark))
    shared = sp.share(spark)
    back = whole.select("text", sp.decode(F.col("piece_ids"), shared).alias("again"))
    assert back.where("NOT text <=> again").count() == 0
    assert sp.round_trip(empty(spark)).count() == 0 and sp.tokenize(empty(spark)).count() == 0


# Pages -----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now please, it is cheap</div>
<article><h1>A &amp; B</h1><p>First   <b>part</b> of
the text<br><p>Second&nbsp;part, a &lt; b.</p></article><div id="comments"><p>I like it very much, thank you all</p></div>
<form>Your name <input></form><footer>&copy; us</footer></body></html>"""


def test_main_text(spark):
    tree = html_blocks.train()
    x, y = html_blocks.labelled()
    assert (html_blocks.classify(tree, x) == y).mean() >= 0.97
    assert html_blocks.main_text(PAGE, tree) == "A & B\nFirst part of the text\nSecond part, a < b."
    plain = "<body><div><a href=x>one</a></div><p>" + "word " * 40 + "</p><p>&copy; 2020</p>"
    assert html_blocks.main_text(plain, tree) == ("word " * 40).strip()
    for broken in (None, "", "<", "</", "<p", "<a href=\"x", "<script>never closed", "<!-- open", "&am", "<p><p><p>", "a<b>c</i></b"):
        html_blocks.main_text(broken, tree)
    long = "<article>" + "<p>some words here</p>" * 20000
    assert html_blocks.main_text(long, tree).count("\n") == 19999
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")], "page_id long, url string, html string")
    rows = html_blocks.extract_pages(pages.withColumn("text", F.lit(1))).collect()
    assert sorted(r["n_chars"] for r in rows) == [0, 0, 48, 48] and len(rows) == 4
    assert html_blocks.extract_pages(pages.limit(0)).count() == 0


def test_pages_query(spark, folder):
    """Of these pages the article is all there is to keep."""
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        parts = [" ".join(re.sub(r"</?b>|<br>", "", p).replace("&amp;", "&").replace("&quot;", '"').split()) for p in re.split(r"</?p>|</?h1>", article)]
        want[r["page_id"]] = "\n".join(p for p in parts if p)
    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op8_html_extraction"](spark, folder).collect()}
    assert sum(got[i] == t for i, t in want.items()) >= 0.98 * len(want)


def test_model_query_tells_good_from_bad(spark, folder):
    rows = queries.QUERIES["op9_lm_scoring"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    means = {r["quality"]: r["m"] for r in rows.groupBy("quality").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > means[0]


# Personal data ---------------------------------------------------------------------

def brute_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and pii_crf.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


LOREM = "The river rose through the night and by morning the lower fields stood under water, so the farmers moved their cattle uphill."
MORE = "Nobody had seen it this high since the bridge was built, and the old men argued about the year while they watched the barges."
LAYOUTS = {
    "table": (f"""<table><tr><td class="sidebar"><a href="/">Home</a> <a href="/b">News</a></td>
        <td class="content"><h1>High water</h1><p>{LOREM}</p><p>{MORE}</p></td></tr><tr><td class="footer">© 2020 Somebody</td></tr></table>""",
              ["High water", LOREM, MORE]),
    "wrapper": (f"""<div class="content has-sidebar"><h2>High water</h2><p>{LOREM}</p><p>{MORE}</p></div>
        <div class="sidebar"><ul><li><a href="/1">One more story</a></li><li><a href="/2">Another one</a></li></ul></div>""",
                ["High water", LOREM, MORE]),
    "comments": (f"""<main><p>{LOREM}</p><p>{MORE}</p><ol><li class="comment">I remember that year, it was worse than they say here.
        <li class="comment">Great story, thank you!</ol><p class="cookie-notice">We use cookies to make this site better for you.</p></main>""",
                 [LOREM, MORE]),
    "broken": (f"""<article><p>{LOREM}<p>{MORE} <svg><path d="M0 0"></article><aside>Read this next <b>now</b></aside><article><p>{LOREM}</p>""",
               [LOREM, MORE, LOREM]),
    "formulas": (f"""<nav><a href="/">Start</a> | <a href="/m">Mathematics</a></nav><article><p>{LOREM} It rose by
        <math><mi>h</mi><mo>=</mo><mn>3</mn></math> metres.</p><p>{MORE}</p></article><form>Name <input name="n"> <button>Send</button></form>""",
                 [f"{LOREM} It rose by h=3 metres.", MORE]),
    "definitions": (f"""<body><header><a href="/">A paper</a></header><div id="main"><dl><dt>Flood<dd>{LOREM}<dt>Bridge<dd>{MORE}</dl></div>
        <div class="share"><a href="/s">Share</a></div><footer>All rights reserved</footer></body>""", [LOREM, MORE]),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_pages_of_other_layouts(layout):
    page, want = LAYOUTS[layout]
    got = html_blocks.main_text(page, html_blocks.train()).split("\n")
    # Terms of a definition are single words that a block rule may take or leave.
    assert [t for t in got if t not in ("Flood", "Bridge")] == want


def test_html_reading_is_linear():
    for piece in ("<div>a", "<svg>a", "<p>a</i></b></div>", "<li>a<td>", "</div>", "<select><option>a", "<script>", "<a href='"):
        start = time.time()
        html_blocks.blocks(piece * 100_000)
        assert time.time() - start < 5, piece
    deep = html_blocks.blocks("<div class='sidebar'>" + "<div>a" * 50_000 + "</div>" * 50_001 + "<p>b")
    assert all(b.other for b in deep[:-1]) and not deep[-1].other


def test_base_spans_are_the_patterns():
    rng = random.Random(9)
    for _ in range(30000):
        text = "".join(rng.choice("a@@..-+%0123 19 ()\n٣é") for _ in range(rng.randrange(40)))
        assert pii_crf.base_spans(text) == brute_base(text), text
    for text in ("a" * 50000, "1" * 50000, "a@" * 20000, "1." * 20000, "+1" * 20000):
        pii_crf.base_spans(text)
    # Zero-filled numbers of any length are numbers still.
    zeros = "0" * 5000
    assert pii_crf.base_spans(zeros + ".1.1.1") == [(0, 1, 5006)]
    assert pii_crf.base_spans(f"1.{zeros}255.1.1") == [(0, 1, 5009)]
    assert pii_crf.base_spans(f"1.{zeros}256.1.1") == []
    assert pii_crf.base_spans("9" * 5000 + ".1.1.1") == []


def test_memo_forgets_everything(crf):
    memo = pii_crf._Memo(crf)
    words = [f"x{i}-{i * 7919 % 1000}y" for i in range(3000)]
    first = pii_crf.decode([words], crf, memo)[0]
    assert len(memo) == len(words) and len(memo.table) > 1
    memo.clear()
    assert len(memo) == 0 and len(memo.table) == 0 and len(memo.room) == 256
    assert (pii_crf.decode([words], crf, memo)[0] == first).all()


@pytest.fixture(scope="module")
def crf():
    return pii_crf.train()


def test_viterbi_equals_brute_force(crf):
    import itertools

    import numpy as np

    for sentence in pii_crf.SENTENCES[:12]:
        words, labels = pii_crf.labelled(sentence)
        words = words[:5]
        x = [crf.scores(w) for w in words]
        own = [x[t][0] + (x[t - 1][1] if t else 0) + (x[t + 1][2] if t + 1 < len(x) else 0) for t in range(len(x))]
        best = max(itertools.product(range(pii_crf.K), repeat=len(x)), key=lambda y: sum(o[k] for o, k in zip(own, y)) + sum(crf.moves[a, b] for a, b in zip(y, y[1:])))
        assert pii_crf.decode([words, ["other"], []], crf)[0].tolist() == list(best)
    assert np.array_equal(crf.own, pii_crf.train().own)


def test_crf_learns_its_table_and_leaves_prose_alone(crf, spark, folder):
    right = total = 0
    for words, labels in map(pii_crf.labelled, pii_crf.SENTENCES):
        found = pii_crf.decode([words], crf)[0].tolist()
        right, total = right + sum(a == b for a, b in zip(found, labels)), total + len(labels)
    assert right >= 0.98 * total
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    spans = pii_crf.find(texts, crf)
    assert all(base == brute_base(t) and set(base) <= set(every) for t, (base, every) in zip(texts, spans))
    assert sum(len(e) - len(b) for b, e in spans) <= 0.01 * len(texts)


def test_personal_data_odd_rows(spark, crf):
    rows = pii_crf.find_personal_data(odd(spark), model=crf).collect()
    assert len(rows) == len(ROWS)
    mine = next(r for r in rows if r["doc_id"] is None)
    assert (mine["n_email"], mine["n_phone"]) == (1, 1) and mine["spans"].startswith("email:32:")
    clean = odd(spark).select(pii_crf.redact(F.col("text"), crf).alias("t")).collect()
    assert any("mail me at [EMAIL] or [PHONE]." in (r["t"] or "") for r in clean) and sum(r["t"] is None for r in clean) == 1
    assert pii_crf.find_personal_data(empty(spark), model=crf).count() == 0
    assert pii_crf.redacted("abcdef", [(1, 0, 4), (2, 2, 5)]) == "a[EMAIL]f"
