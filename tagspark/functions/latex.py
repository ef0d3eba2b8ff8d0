"""LaTeX expressions. The block patterns differ on purpose between the
operators below; each keeps its own."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..constants import LATEX_PROFILE_SYMBOLS, LATEX_SYMBOLS, WS
from .text import share_of, squeeze

COMMAND = r"\\[a-zA-Z]+"


def _total_length(items: Column) -> Column:
    return F.length(F.array_join(items, ""))


def blocks(c: Column) -> Column:
    """``$$$…$$$`` and ``$…$`` blocks on one line, in text order."""
    return F.coalesce(
        F.regexp_extract_all(c, F.lit(r"\$\$\$[^\n]*?\$\$\$|\$[^\n]*?\$"), F.lit(0)),
        F.array().cast("array<string>"),
    )


def symbol_pattern(symbols: list[str] = LATEX_SYMBOLS) -> str:
    return r"\\(?:" + "|".join(symbols) + ")"


def symbols(c: Column, names: list[str] = LATEX_SYMBOLS) -> Column:
    """Known commands in text order; the first name that fits wins."""
    return F.coalesce(
        F.regexp_extract_all(c, F.lit(symbol_pattern(names)), F.lit(0)), F.array().cast("array<string>")
    )


def plain_text(c: Column) -> Column:
    """Lower-case text with the LaTeX blocks and punctuation removed."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"\$\$\$[^\n]*?\$\$\$", " ")
    c = F.lower(F.regexp_replace(c, r"\$[^\n]*?\$", " "))
    return squeeze(F.regexp_replace(c, f"[^a-z0-9{WS}-]", " "))


def latex_density(c: Column) -> Column:
    return share_of(_total_length(blocks(c)), F.length(c))


def symbols_density(c: Column) -> Column:
    return share_of(F.size(symbols(c)), F.length(c))


def symbol_counts(found: Column) -> Column:
    """Map symbol -> occurrences for one row's symbol list (bounded by the
    list of known commands)."""
    distinct = F.array_distinct(found)
    counts = F.transform(distinct, lambda s: F.size(F.filter(found, lambda x: x == s)))
    return F.map_from_arrays(distinct, counts)


def split_text_latex(c: Column) -> dict[str, Column]:
    """The text/LaTeX split as named columns."""
    b, s = blocks(c), symbols(c)
    return {
        "clean_description": plain_text(c),
        "latex_blocks": b,
        "latex_symbols": s,
        "nb_latex_blocks": F.size(b),
        "nb_latex_symbols": F.size(s),
        "latex_density": latex_density(c),
        "latex_symbols_density": symbols_density(c),
    }


def latex_to_token(c: Column, token: str = "[LATEX]") -> Column:
    """Blocks and commands become ``token``; neighbouring tokens collapse.

    A token is dropped when another one stands directly before it. Looking
    back needs no repeated group, so long runs cannot exhaust the stack.
    """
    literal, insert = re.escape(token), token.replace("\\", "\\\\").replace("$", "\\$")
    c = F.coalesce(c, F.lit(""))
    c = F.regexp_replace(c, r"\$\$\$[^\n]*?\$\$\$", insert)
    c = F.regexp_replace(c, COMMAND + r"\{[^}]*\}", insert)
    c = F.regexp_replace(c, COMMAND, insert)
    c = F.regexp_replace(c, f"(?<={literal})[{WS}]*{literal}", "")
    return squeeze(c)


def profile(c: Column) -> dict[str, Column]:
    """``$$$`` blocks only, with the short symbol list."""
    b = F.coalesce(
        F.regexp_extract_all(c, F.lit(r"\$\$\$[^\n]*?\$\$\$"), F.lit(0)), F.array().cast("array<string>")
    )
    chars = _total_length(b)
    return {
        "nb_latex_blocks": F.size(b),
        "nb_latex_symbols": F.coalesce(
            F.regexp_count(c, F.lit(symbol_pattern(LATEX_PROFILE_SYMBOLS))), F.lit(0)
        ),
        "total_latex_chars": chars,
        "latex_density": share_of(chars, F.length(c)),
    }


def estimated_latex_ratio(c: Column) -> Column:
    """Share of characters inside ``$$$`` blocks, which may span lines."""
    found = F.regexp_extract_all(c, F.lit(r"(?s)\$\$\$.*?\$\$\$"), F.lit(0))
    return share_of(_total_length(found), F.length(c))


def estimated_symbols_ratio(c: Column) -> Column:
    found = F.regexp_extract_all(c, F.lit(COMMAND), F.lit(0))
    return share_of(_total_length(found), F.length(c))


def commands(c: Column) -> Column:
    """Distinct ``\\name`` commands of one text."""
    return F.array_distinct(
        F.coalesce(F.regexp_extract_all(c, F.lit(COMMAND), F.lit(0)), F.array().cast("array<string>"))
    )


def has_symbol(c: Column, symbol: str, exact: bool = False) -> Column:
    """0/1 presence. By default a longer command counts too (``\\le`` is seen
    in ``\\leq``), as the stored feature tables have it."""
    if exact:
        found = c.rlike(re.escape(symbol) + "(?![a-zA-Z])")
    else:
        found = c.contains(symbol)
    return F.coalesce(found, F.lit(False)).cast("int")


def feature_name(symbol: str, prefix: str = "has_") -> str:
    """Column name of a symbol. Column names are compared without case, so a name
    with capitals ends with their places: ``has_Sigma_c0`` and ``has_sigma``."""
    name = symbol.replace("\\", "").replace("{", "").replace("}", "")
    capitals = [str(i) for i, c in enumerate(name) if c.isupper()]
    return prefix + name + ("_c" + "_".join(capitals) if capitals else "")


def single_dollar(c: Column, max_length: int | None = None) -> Column:
    """Optional cut, then ``$$$`` becomes ``$``."""
    if max_length:
        c = F.when(F.length(c) > max_length, F.concat(F.substring(c, 1, max_length), F.lit("..."))).otherwise(c)
    return F.replace(c, F.lit("$$$"), F.lit("$"))
