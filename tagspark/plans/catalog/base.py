"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ...constants import PRIORITY_TAGS
from ...sources.problems import PROBLEMS_SQL, problems
from ...sources.readers import read_table, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)``; ``sql`` is its DuckDB equivalent."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def sql_list(values: list[str]) -> str:
    """``'a', 'b'`` for IN lists and array literals."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PRIORITY_SQL = sql_list(PRIORITY_TAGS)

#: CTEs the SQL texts start with: the view, its tags one per row, and the
#: membership table restricted to the priority tags.
CTE = f"""WITH problems AS ({PROBLEMS_SQL}),
tagged AS (SELECT p_id, unnest(string_split(tags_csv, ',')) AS tag FROM problems WHERE tags_csv IS NOT NULL),
priority AS (SELECT p_id, tag FROM tagged WHERE tag IN ({PRIORITY_SQL})),
ptags AS (SELECT unnest([{PRIORITY_SQL}]) AS tag)
"""

#: Characters of Python's and Unicode's white space, for RE2 classes.
WS = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"


def rnd(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round the named double columns for comparison across engines."""
    return df.select(*[rnd(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def longs(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in columns else F.col(c) for c in df.columns])


__all__ = [
    "CTE", "ORACLES", "PRIORITY_SQL", "QUERIES", "WORD", "WS", "F", "PRIORITY_TAGS", "documents",
    "longs", "problems", "query", "read_table", "rnd", "rounded", "sql_list",
]
