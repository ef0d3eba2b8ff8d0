"""Text expressions. Every function maps a column to a column, so the whole
chain stays inside one JVM projection."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from ..constants import LATEX_COMMAND_TOKENS, LATEX_COMMAND_TOKENS_EMBEDDING, NOTE_PATTERNS, WORD, WS

MATHBLOCK = " MATHBLOCK "


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def replace_patterns(c: Column, patterns: list[tuple[str, str]] | None = None) -> Column:
    """Apply ``(regex, replacement)`` pairs in order; NULL stays NULL.

    Classes are Unicode-aware. Groups in replacements are written ``$1``.
    """
    for pattern, replacement in NOTE_PATTERNS if patterns is None else patterns:
        c = F.regexp_replace(c, "(?U)" + pattern, replacement)
    return c


def fix_notes(c: Column) -> Column:
    """``NoteThe`` becomes ``Note: The``: glued capitalised words only."""
    return F.regexp_replace(c, "Note([A-Z][a-z]+)", "Note: $1")


def char_length(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"[^{WS}]+"), F.lit(0))


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(f"[^{WS}]+")), F.lit(0))


def line_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1


def share_of(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 for NULL and for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def numeric_ratio(c: Column) -> Column:
    return share_of(F.regexp_count(c, F.lit(r"\p{Nd}")), F.length(c))


def sentence_count(c: Column) -> Column:
    """Runs of ``.``, ``!`` or ``?`` that end a sentence."""
    return F.coalesce(F.regexp_count(c, F.lit(f"[.!?]+([{WS}]|$)")), F.lit(0))


def mean_word_length(c: Column) -> Column:
    letters = F.length(F.regexp_replace(c, f"[{WS}]+", ""))
    return share_of(letters, word_count(c))


def ascii_ratio(c: Column) -> Column:
    return share_of(F.length(F.regexp_replace(c, r"[^\x00-\x7F]", "")), F.length(c))


def find_keywords(c: Column, keywords: list[str]) -> Column:
    """Keywords that occur anywhere in the text, in list order, ignoring case."""
    text = F.lower(c)
    hits = [F.when(text.contains(k.lower()), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*hits))


def has_keyword(c: Column, keywords: list[str]) -> Column:
    text = F.lower(c)
    return F.coalesce(reduce(or_, [text.contains(k.lower()) for k in keywords]), F.lit(False))


def duplicate_form(c: Column, inline_math: bool = True) -> Column:
    """Letters-only form in which near duplicates are equal."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"\$\$\$[^\n]*?\$\$\$", "")
    if inline_math:
        c = F.regexp_replace(c, r"\$[^\n]*?\$", "")
    return squeeze(F.regexp_replace(F.lower(c), f"[^a-z{WS}]", ""))


def duplicate_hash(c: Column, inline_math: bool = True) -> Column:
    return F.md5(duplicate_form(c, inline_math))


def letters_only(c: Column) -> Column:
    """Text without ``$$$`` blocks; everything but letters becomes a space."""
    c = F.regexp_replace(c, r"\$\$\$[^\n]*?\$\$\$", "")
    return squeeze(F.lower(F.regexp_replace(c, f"[^a-zA-Z{WS}]", " ")))


def tokenize_numbers(c: Column) -> Column:
    """Numbers become tokens by kind; digits glued to letters (``n1``) stay."""
    # The look-ahead comes first: most positions hold no digit and stop there.
    start, end = rf"(?=\p{{Nd}})(?<![{WORD}])", f"(?![{WORD}])"
    digits = r"\p{Nd}+"
    steps = [
        (f"(?i){start}{digits}e[+-]?{digits}{end}", " NUM_EXP "),
        (rf"{start}{digits}\^{digits}{end}", " NUM_EXP "),
        (rf"{start}{digits}\*\*{digits}{end}", " NUM_EXP "),
        (rf"{start}{digits}\.{digits}{end}", " NUM_FLOAT "),
        (f"{start}[01]{{5,}}{end}", " NUM_BIN "),
        (f"{start}{digits}{end}", " NUM_INT "),
    ]
    for pattern, token in steps:
        c = F.regexp_replace(c, pattern, token)
    return squeeze(c)


def _command_tokens(c: Column, commands: list[tuple[str, str]]) -> Column:
    for name, token in commands:
        c = F.regexp_replace(c, rf"(?i)\\{re.escape(name)}", f" {token} ")
    return c


def clean_for_model(c: Column, commands: list[tuple[str, str]] | None = None) -> Column:
    """Vectoriser input: math blocks, commands and numbers become tokens.

    ``$$$`` blocks are taken before ``$$`` blocks, so text between two of them
    is kept.
    """
    c = F.coalesce(c, F.lit(""))
    c = F.regexp_replace(c, r"(?s)\$\$\$.*?\$\$\$", MATHBLOCK)
    c = F.regexp_replace(c, r"(?s)\$\$.*?\$\$", MATHBLOCK)
    c = F.regexp_replace(c, r"\$[^\n]*?\$", MATHBLOCK)
    c = F.regexp_replace(c, r"(?s)\\\[.*?\\\]", MATHBLOCK)
    c = F.regexp_replace(c, r"\\\([^\n]*?\\\)", MATHBLOCK)
    c = _command_tokens(c, LATEX_COMMAND_TOKENS if commands is None else commands)
    return tokenize_numbers(F.lower(squeeze(c)))


def clean_for_embeddings(
    c: Column, replace_latex: bool = True, commands: list[tuple[str, str]] | None = None
) -> Column:
    """Embedding input: like the model clean-up, but numbers are kept."""
    c = F.coalesce(c, F.lit(""))
    if replace_latex:
        for block in (r"\$\$\$.*?\$\$\$", r"\$\$.*?\$\$", r"\$.*?\$", r"\\\[.*?\\\]", r"\\\(.*?\\\)"):
            c = F.regexp_replace(c, "(?s)" + block, MATHBLOCK)
        c = _command_tokens(c, LATEX_COMMAND_TOKENS_EMBEDDING if commands is None else commands)
    return F.lower(squeeze(c))


def mathblock_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit("mathblock")), F.lit(0))


def truncate_words(c: Column, max_words: int = 400) -> Column:
    """First ``max_words`` words; a text that short is returned unchanged."""
    ws = words(c)
    return F.coalesce(
        F.when(F.size(ws) > max_words, F.array_join(F.slice(ws, 1, max_words), " ")).otherwise(c), F.lit("")
    )


def truncate_chars(c: Column, max_length: int) -> Column:
    return F.when(F.length(c) > max_length, F.concat(F.substring(c, 1, max_length), F.lit("..."))).otherwise(c)


def slug(c: Column) -> Column:
    return F.lower(F.translate(c, " -", "__"))


def shifted_concat(items: Column, tail: Column, shift: int, separator: str = "") -> Column:
    """Join item ``i`` with item ``i + shift`` of ``tail``; linear in length."""
    n = F.size(tail)
    rest = F.slice(tail, F.lit(shift + 1), F.greatest(n - shift, F.lit(0)))
    glued = F.zip_with(items, rest, lambda a, b: F.concat(a, F.lit(separator), b) if separator else F.concat(a, b))
    return F.slice(glued, F.lit(1), F.greatest(n - shift, F.lit(0)))


def _windows(c: Column, least: int, most: int) -> Column:
    """One window per text position, from a single regex pass with an empty
    match per position (``substring(text, i, n)`` per position would be
    quadratic). No window starts inside a surrogate pair."""
    pattern = rf"(?s)(?=([^\x{{DC00}}-\x{{DFFF}}].{{{least - 1},{most - 1}}}))"
    found = F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def char_windows(c: Column, size: int) -> Column:
    """Up to ``size`` characters from each position, shorter at the end."""
    return _windows(c, 1, size)


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Overlapping character n-grams of the lower-cased text."""
    return _windows(c, n, n)


def word_tokens(c: Column, min_length: int = 1) -> Column:
    """Maximal runs of word characters of at least ``min_length``."""
    return F.coalesce(
        F.regexp_extract_all(c, F.lit(f"[{WORD}]{{{min_length},}}"), F.lit(0)), F.array().cast("array<string>")
    )


def word_ngrams(tokens: Column, n: int) -> Column:
    grams = tokens
    for shift in range(1, n):
        grams = shifted_concat(grams, tokens, shift, " ")
    return grams


def unified_document(
    description: Column,
    input_spec: Column,
    output_spec: Column,
    notes: Column,
    sample_inputs: Column | None = None,
    sample_outputs: Column | None = None,
    sample_chars: int = 500,
) -> Column:
    """Section-tagged concatenation; absent parts are skipped."""

    def part(tag: str, c: Column) -> Column:
        return F.concat(F.lit(f"[{tag}] "), c)

    parts = [
        part("DESC", description),
        part("IN", input_spec),
        part("OUT", output_spec),
        F.coalesce(part("NOTES", notes), F.lit("[NOTES_MISSING]")),
    ]
    if sample_inputs is not None:
        parts.append(part("SAMPLE_IN", F.substring(sample_inputs, 1, sample_chars)))
    if sample_outputs is not None:
        parts.append(part("SAMPLE_OUT", F.substring(sample_outputs, 1, sample_chars)))
    return F.concat_ws(" ", *parts)
