"""Literal examples and the traps of the text expressions."""

import ast
import glob
import io
import os
import re
import time
import tokenize

import pytest
from pyspark.sql import functions as F

from tagspark.functions import code, latex, numeric, text, vectors
from tagspark.sources.readers import parse_tags


@pytest.fixture(scope="module")
def value(spark):
    def run(fn, *inputs):
        names = [f"c{i}" for i in range(len(inputs))]
        schema = ", ".join(f"{n} string" for n in names)
        row = spark.createDataFrame([inputs], schema).select(fn(*[F.col(n) for n in names]).alias("v")).first()
        return row["v"]

    return run


@pytest.mark.parametrize("given, wanted", [
    ("NoteIN the first", "Note: In the first"),
    ("NoteIn the first", "NoteIn the first"),
    ("NoteThe end. NoteFor x", "Note: The end. Note: For x"),
    ("KeyNoteThe end", "KeyNoteThe end"),
    ("éNoteThe end", "éNoteThe end"),
    (None, None),
])
def test_note_patterns(value, given, wanted):
    assert value(text.replace_patterns, given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("NoteThe answer is...", "Note: The answer is..."),
    ("NoteIN the example", "NoteIN the example"),
    ("NoteA case", "NoteA case"),
    (None, None),
])
def test_fix_notes(value, given, wanted):
    assert value(text.fix_notes, given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("0.5 seconds", 0.5), ("2 seconds", 2.0), ("3.0 s", 3.0), ("1 секунда", 1.0), ("x", None), (None, None), ("5.", 5.0)])
def test_time_limit(value, given, wanted):
    assert value(numeric.parse_time_limit, given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("find sum from 1 to 1000", "find sum from NUM_INT to NUM_INT"),
    ("modulo 1000000007", "modulo NUM_INT"),
    ("complexity up to 1e9", "complexity up to NUM_EXP"),
    ("probability 0.5 or 3.14", "probability NUM_FLOAT or NUM_FLOAT"),
    ("binary 101010", "binary NUM_BIN"),
    ("round 100000", "round NUM_BIN"),
    ("calculate 2^10 + 10^9", "calculate NUM_EXP + NUM_EXP"),
    ("2**10", "NUM_EXP"),
    ("n1 and n2 inputs", "n1 and n2 inputs"),
    ("é5 5é 5", "é5 5é NUM_INT"),
])
def test_number_tokens(value, given, wanted):
    assert value(text.tokenize_numbers, given) == wanted


def test_model_clean_up_keeps_text_between_blocks(value):
    assert value(text.clean_for_model, "$$$a$$$ hello $$$b$$$") == "mathblock hello mathblock"
    assert value(text.clean_for_model, "\\prod x") == "latex_pr od x"
    assert value(text.clean_for_model, None) == ""


def test_embedding_clean_up_keeps_numbers(value):
    given = "Take $\\gcd$ of 10 and \\max x"
    assert value(text.clean_for_embeddings, given) == "take mathblock of 10 and latex_max x"
    assert value(lambda c: text.clean_for_embeddings(c, replace_latex=False), given) == given.lower()


def test_split_text_latex(value):
    given = "Find $$$n$$$ such that $$$\\gcd(n, m) = 1$$$"
    assert value(latex.plain_text, given) == "find such that"
    assert len(value(latex.blocks, given)) == 2
    assert value(latex.symbols, given) == ["\\gcd"]
    assert value(lambda c: latex.symbol_counts(latex.symbols(c)), "\\le \\leq \\sum") == {"\\le": 2, "\\sum": 1}
    assert value(latex.latex_density, None) == 0.0
    assert value(latex.plain_text, None) == ""


def test_first_symbol_name_wins(value):
    assert value(latex.symbols, "\\leq \\left \\infty \\sinh \\bmod") == ["\\le", "\\le", "\\inf", "\\sin", "\\bmod"]


def test_latex_token(value):
    assert value(latex.latex_to_token, "This is $$$x^2$$$ a formula") == "This is [LATEX] a formula"
    assert value(latex.latex_to_token, "a \\frac{1} \\le $$$x$$$ b") == "a [LATEX] b"
    assert value(latex.latex_to_token, "\\le " * 30000) == "[LATEX]"


def test_char_ngrams(value):
    assert value(text.char_ngrams, "Graph") == ["gra", "rap", "aph"]
    assert value(text.char_ngrams, "ab") == []
    assert value(text.char_ngrams, None) == []
    assert value(text.char_ngrams, "a😀\nb") == ["a😀\n", "😀\nb"]


def test_words_and_white_space(value):
    assert value(text.word_count, " a\u00a0b\u2003c\x1c d ") == 4
    assert value(text.squeeze, "\u00a0a \t b\u2028") == "a b"
    assert value(text.word_count, None) == 0
    assert value(lambda c: text.truncate_words(c, 2), "a  b") == "a  b"
    assert value(lambda c: text.truncate_words(c, 2), "a  b c") == "a b"
    assert value(lambda c: text.word_tokens(c, 2), "a bb été_1 c") == ["bb", "été_1"]
    assert value(lambda c: text.word_ngrams(text.word_tokens(c, 1), 2), "a b c") == ["a b", "b c"]
    assert value(lambda c: text.word_ngrams(text.word_tokens(c, 1), 2), "a") == []


def test_unified_document(value):
    built = value(text.unified_document, "d", None, "o", None, "x" * 600, None)
    assert built == "[DESC] d [OUT] o [NOTES_MISSING] [SAMPLE_IN] " + "x" * 500


def test_duplicate_form(value):
    assert value(text.duplicate_form, "Sum $x$ of\n 3 N!") == "sum of n"
    assert value(text.duplicate_form, None) == "" == value(text.duplicate_form, "$$$x$$$")


def test_parse_tags(value):
    assert value(parse_tags, "['math', 'number theory']") == ["math", "number theory"]
    assert value(parse_tags, '["a", "b"]') == ["a", "b"]
    assert value(parse_tags, "[\"it's\", 'b']") == ["it's", "b"]
    assert value(parse_tags, "[]") == []
    assert value(parse_tags, None) is None


def test_keywords(value):
    assert value(lambda c: text.find_keywords(c, ["Tree", "root"]), "SUBTREES") == ["Tree"]
    assert value(lambda c: text.has_keyword(c, ["x"]), None) is False


def test_code_flags(spark):
    rows = spark.createDataFrame([("import  math\nstack=[]",), ("x.append(1)\nx.pop()",), ("parent=1",), (None,)], "c string")
    flags = {**code.import_flags(F.col("c")), **code.pattern_flags(F.col("c"))}
    got = rows.select(*[c.alias(n) for n, c in flags.items()]).collect()
    assert [r["import_math"] for r in got] == [1, 0, 0, 0]
    assert [r["has_stack"] for r in got] == [1, 1, 0, 0]
    assert [r["has_dsu"] for r in got] == [0, 0, 0, 0]


def test_code_structure(spark):
    source = "def f():\n    for i in x:\n        if i:\n            pass\nclass A:\n    pass\nwhile 1:\n    format(1)"
    rows = spark.createDataFrame([(source,), (None,), ("",), ("def f(:",)], "c string")
    row, *none = [r["s"] for r in rows.select(code.structure_counts(F.col("c")).alias("s")).collect()]
    assert all(set(r) == {0} for r in none)
    assert row.asDict() == {"num_functions": 1, "num_classes": 1, "num_for_loops": 1, "num_while_loops": 1,
                            "num_if_statements": 1, "max_depth": 3}


def parsed(source):
    """The same counts from Python's own parser and tokenizer."""
    nodes = list(ast.walk(ast.parse(source)))
    depth = most = 0
    for t in tokenize.generate_tokens(io.StringIO(source).readline):
        depth += (t.type == tokenize.INDENT) - (t.type == tokenize.DEDENT)
        most = max(most, depth)
    return (*[sum(isinstance(n, kind) for n in nodes) for kind in (ast.FunctionDef, ast.ClassDef, ast.For, ast.While, ast.If)], most)


def test_code_structure_equals_the_parser():
    files = sorted(p for folder in ("", "json", "email", "asyncio", "unittest") for p in glob.glob(f"{os.path.dirname(os.__file__)}/{folder}/*.py"))
    assert len(files) > 150
    for path in files:
        with open(path, encoding="utf-8") as f:
            source = f.read()
        # Quotes of the same kind inside the braces of an f-string are newer than the rule for strings here.
        if not re.search(r"""\bf(["']).*\{[^}]*\1[^}]*\}.*\1""", source):
            assert code.code_structure(source) == parsed(source), path


@pytest.mark.parametrize("source", [
    "x = 'for\\\n if'\nif x:\n\tpass\n",
    "if x: y = [z for z in\nrange(3) if z]; k = 1\nelif y:\n  pass",
    "# if\n\n   # while\nfor i in x:\n\n  # class\n  pass",
    'def f():\n  """def\nclass """\n  return """a\\""" if""" if 1 else 2',
    "class A:\n  def g(self): pass\n\n  async def h(self):\n    async for i in x: pass\n",
    "x = (1,\n  2)\nwhile x \\\n  and y:\n        pass\nformat = 1\nif_ = 2",
    "def f():\r\n    pass\r\nif 1:\r\n    x = 'é'\r\n",
    "if 1:\n  if 2:\n    x\n  else:\n    y\nz",
])
def test_code_structure_of_small_sources(source):
    assert code.code_structure(source) == parsed(source)


@pytest.mark.parametrize("source", [
    "x = 'a", 'x = """a\nif b:\n  c', "f(", "f)", "f(]", "if x:\npass", "  x", "if x:\n    y\n  z", "x\n  y", "if x:", "a = $b",
    "if x:\n  # only a comment\n", "x = a ? b", "\\ x",
])
def test_code_that_does_not_close_gives_zeros(source):
    with pytest.raises(SyntaxError):
        ast.parse(source)
    assert set(code.code_structure(source)) == {0}


def test_code_structure_is_linear():
    for piece in ('"', "'", '"""', "\\", "(", " ", "\t", "if ", "'\\'", "#", "\n", "r'''", '"""\\'):
        start = time.time()
        code.code_structure(piece * 200_000)
        assert time.time() - start < 3, piece


def test_difficulty_bins_are_right_closed(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 1200.0, 1200.5, 2000.0, 3500.0, 3501.0, None)], "d double")
    got = [r[0] for r in rows.select(numeric.difficulty_bin(F.col("d"))).collect()]
    assert got == [None, "Easy", "Medium", "Hard", "Very Hard", None, None]


def test_sparse_vector(spark):
    v = vectors.sparse_vector(F.lit(5), F.array(F.lit(1), F.lit(3)), F.array(F.lit(0.1), F.lit(-2.5)))
    got = spark.range(1).select(v.alias("v")).first()["v"]
    assert got.size == 5 and list(got.indices) == [1, 3] and list(got.values) == [0.1, -2.5]
