"""Keyword tables of any length, found in one pass over each text.

The table becomes an Aho-Corasick automaton on every executor; a text goes
through it once, however many keywords there are. For a handful of literal
keywords ``functions.text.find_keywords`` stays inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .tags import explode_tags

#: UTF-8 bytes of a table that is sent to every executor; a larger one is refused.
MOST_BYTES = 256 << 20
#: Characters of keywords in one automaton. A larger table is worked through in parts, one automaton at a time.
PART = 2_000_000

Automata = Callable[[], Iterator["ahocorasick.Automaton"]]


def _automaton(words: list[str], first: int) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for i, word in enumerate(words, first):
        out.add_word(word, i)
    out.make_automaton()
    return out


@dataclass(frozen=True)
class Keywords:
    """Keywords in lower case and what each is reported as.

    ``words`` are distinct and not empty; ``names[i]`` are the names of word
    ``i``, in the order in which they are reported. An empty keyword is in every text.
    """

    words: list[str]
    names: list[list[str]]
    order: list[str]
    always: list[str]

    @staticmethod
    def of(pairs: list[tuple[str, str]]) -> Keywords:
        """From ``(keyword in lower case, name)``; names are reported in the order of their first pair."""
        named: dict[str, dict[str, None]] = {}
        for word, name in pairs:
            named.setdefault(word, {})[name] = None
        always = list(named.pop("", {}))
        return Keywords(list(named), [list(n) for n in named.values()], list(dict.fromkeys(n for _, n in pairs)), always)

    @staticmethod
    def listed(keywords: list[str]) -> Keywords:
        return Keywords.of([(k.lower(), k) for k in keywords])

    @staticmethod
    def from_table(table: DataFrame, keyword: str = "keyword", name: str | None = None, fold: bool = True) -> Keywords:
        """Distinct keywords of a table, sorted; ``name`` is a column to report instead. NULLs are left out.

        The size is checked before anything is collected: up to ``MOST_BYTES`` go to every executor.
        """
        word = F.col(keyword).cast("string")
        told = F.col(name).cast("string") if name else word
        pairs = table.select((F.lower(word) if fold else word).alias("word"), told.alias("name")).dropna().distinct()
        size = pairs.agg(F.sum(F.octet_length("word") + F.octet_length("name"))).first()[0] or 0
        if size > MOST_BYTES:
            raise ValueError(f"{size} bytes of keywords, at most {MOST_BYTES} are sent to every executor")
        return Keywords.of(sorted(((r["word"], r["name"]) for r in pairs.collect()), key=lambda p: (p[1], p[0])))

    def _parts(self) -> list[tuple[int, list[str]]]:
        parts, start, size = [], 0, 0
        for i, word in enumerate(self.words):
            if size + len(word) > PART and i > start:
                parts.append((start, self.words[start:i]))
                start, size = i, 0
            size += len(word)
        return [*parts, (start, self.words[start:])] if start < len(self.words) else parts

    def automata(self) -> Automata:
        """Calls for the automata one after the other; a single one is built once and kept."""
        parts = self._parts()
        if len(parts) != 1:
            return lambda: (_automaton(words, first) for first, words in parts)
        kept = [_automaton(parts[0][1], 0)]
        return lambda: iter(kept)

    def found(self, text: Column) -> Column:
        """``array<string>``: the names whose keywords occur anywhere in the text, ignoring case.

        Each name once, in the table's order. A NULL text has none, not even the empty keyword.
        """
        table = self

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            automata, place = table.automata(), {n: i for i, n in enumerate(table.order)}
            for batch in batches:
                texts = batch.tolist()
                hits: list[set[str]] = [set(table.always) if t is not None else set() for t in texts]
                for automaton in automata():
                    for hit, text in zip(hits, texts):
                        if text:
                            for i in {i for _, i in automaton.iter(text)}:
                                hit.update(table.names[i])
                yield pd.Series([sorted(hit, key=place.__getitem__) for hit in hits], dtype=object)

        return run(F.lower(text))

    def imported(self, source: Column) -> Column:
        """``array<string>``: the names that Python source imports, ``import m`` or ``from m import``.

        Keywords are module names and compared with case.
        """
        table = self

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            automata, place = table.automata(), {n: i for i, n in enumerate(table.order)}
            for batch in batches:
                texts = batch.tolist()
                hits: list[set[str]] = [set() for _ in texts]
                for automaton in automata():
                    for hit, text in zip(hits, texts):
                        if text and "import" in text:
                            for end, i in automaton.iter(text):
                                if is_import(text, end + 1 - len(table.words[i]), end + 1):
                                    hit.update(table.names[i])
                yield pd.Series([sorted(hit, key=place.__getitem__) for hit in hits], dtype=object)

        return run(source)


IMPORT_BEHIND = re.compile(r"\s+import\b")
WORD = re.compile(r"\w")


def is_import(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` stands as a whole word behind ``import`` or between ``from`` and ``import``."""
    if WORD.match(text, end):
        return False
    at = start
    while at and text[at - 1].isspace():
        at -= 1
    if at == start:
        return False
    for word, behind in (("import", None), ("from", IMPORT_BEHIND)):
        before = at - len(word)
        if text.endswith(word, 0, at) and (before == 0 or not WORD.match(text, before - 1)):
            return behind is None or behind.match(text, end) is not None
    return False


def keyword_coverage(df: DataFrame, description: str, code: str, table: DataFrame, tags: str = "tags") -> DataFrame:
    """``profile.keyword_coverage`` for a table ``tag, keyword``: per tag of the table, the share of its
    rows with one of its own keywords in the text, in the code, in either."""
    keywords = Keywords.from_table(table, "keyword", "tag")
    rows = df.select(tags, keywords.found(F.col(description)).alias("_d"), keywords.found(F.col(code)).alias("_c"))
    long = explode_tags(rows, "_d", "_c", tags=tags).join(table.select("tag").distinct(), "tag", "left_semi")
    d, c = (F.array_contains(x, F.col("tag")).cast("double") for x in ("_d", "_c"))
    return long.groupBy("tag").agg(F.count("*").alias("total"), F.avg(d).alias("desc_coverage"), F.avg(c).alias("code_coverage"),
                                   F.avg(F.greatest(d, c)).alias("either_coverage"))
