"""Source-code expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from ..constants import IMPORT_MODULES


def import_flags(c: Column, modules: list[str] = IMPORT_MODULES) -> dict[str, Column]:
    """``import_<module>`` 0/1 columns: ``import m`` or ``from m import``."""
    out = {}
    for m in modules:
        pattern = rf"(?U)\b(?:import\s+{m}|from\s+{m}\s+import)\b"
        out[f"import_{m}"] = F.coalesce(c.rlike(pattern), F.lit(False)).cast("int")
    return out


def pattern_flags(c: Column) -> dict[str, Column]:
    """Nine algorithm hints as 0/1 columns."""
    low = F.lower(c)
    has, low_has = c.contains, low.contains
    rules = {
        "has_deque": has("deque"),
        "has_queue": has("Queue") | has("deque"),
        "has_stack": low_has("stack") | (has("append") & has("pop")),
        "has_dsu": (has("parent") & has("find")) | low_has("union"),
        "has_recursion": has("setrecursionlimit"),
        "has_dp": has("dp[") | low_has("memo"),
        "has_adjacency": low_has("adj") | has("graph[") | has("edges"),
        "has_sort": has(".sort") | has("sorted("),
        "has_bisect": has("bisect"),
    }
    return {name: F.coalesce(rule, F.lit(False)).cast("int") for name, rule in rules.items()}


#: Tokens of Python source. A string that does not end shows up as ``bad``.
TOKEN = re.compile(
    r"""(?P<string>\b[rbuft]{0,2}(?:\"{3}(?:[^\\]|\\.)*?\"{3}|'{3}(?:[^\\]|\\.)*?'{3})|(?:\"{3}(?:[^\\]|\\.)*?\"{3}|'{3}(?:[^\\]|\\.)*?'{3}))"""
    r"""|(?P<unended>\"{3}|'{3})"""
    r"""|(?P<short>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')"""
    r"""|(?P<comment>\#[^\n]*)|(?P<joined>\\\n)|(?P<newline>\n)|(?P<space>[ \t\f]+)|(?P<name>\w+)"""
    r"""|(?P<opening>[(\[{])|(?P<closing>[)\]}])|(?P<bad>["'\\$?!`](?!=))|(?P<other>.)""", re.S | re.I)
CLOSES = {")": "(", "]": "[", "}": "{"}
#: Leading keyword of a statement to the count it adds to.
STATEMENTS = {"def": 0, "class": 1, "for": 2, "while": 3, "if": 4, "elif": 4}
STRUCTURE = ["num_functions", "num_classes", "num_for_loops", "num_while_loops", "num_if_statements", "max_depth"]
NOTHING = (0,) * len(STRUCTURE)


def code_structure(source: str | None) -> tuple[int, ...]:
    """The values of ``STRUCTURE`` for Python source, in one pass over its tokens.

    Statements are counted by the word a logical line starts with, so strings,
    comments and what stands in brackets or after a line's first word count for
    nothing. ``max_depth`` is the largest number of open blocks. Source whose
    strings, brackets or blocks do not close, or whose indentation fits no open
    block, gives zeros; other syntax errors are not seen.
    """
    if not source:
        return NOTHING
    counts, depth = [0] * (len(STRUCTURE) - 1), 0
    indents, brackets = [0], []
    # Of the logical line: is nothing seen yet, how far it is indented, does it end in a colon.
    fresh, indent, opens, opened = True, 0, False, False
    for m in TOKEN.finditer(source.replace("\r\n", "\n").replace("\r", "\n") + "\n"):
        kind = m.lastgroup
        if kind == "newline":
            if brackets:
                continue
            if not fresh:
                opened = opens
            fresh, indent, opens = True, 0, False
        elif kind == "space":
            if fresh and not brackets:
                for c in m[0]:
                    indent = indent // 8 * 8 + 8 if c == "\t" else 0 if c == "\f" else indent + 1
        elif kind == "comment" or kind == "joined":
            continue
        elif kind == "bad" or kind == "unended":
            return NOTHING
        else:
            if fresh:
                fresh = False
                if opened:
                    if indent <= indents[-1]:
                        return NOTHING
                    indents.append(indent)
                    depth = max(depth, len(indents) - 1)
                else:
                    while indents[-1] > indent:
                        indents.pop()
                    if indents[-1] != indent:
                        return NOTHING
                opened = False
                if kind == "name" and m[0] in STATEMENTS:
                    counts[STATEMENTS[m[0]]] += 1
            opens = m[0] == ":" and not brackets
            if kind == "opening":
                brackets.append(m[0])
            elif kind == "closing":
                if not brackets or brackets.pop() != CLOSES[m[0]]:
                    return NOTHING
    return NOTHING if brackets or opened else (*counts, depth)


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in STRUCTURE]))
def _structure(sources: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in sources:
        yield pd.DataFrame([code_structure(s) for s in batch], columns=STRUCTURE)


def structure_counts(c: Column) -> Column:
    """``struct`` of ``STRUCTURE``: statements by kind and the depth of blocks; NULL source gives zeros."""
    return _structure(c)
