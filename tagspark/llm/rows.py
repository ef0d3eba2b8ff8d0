"""Whole rows carried through an operator, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def column(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col(f"`{name.replace('`', '``')}`")


def whole(df: DataFrame, *without: str) -> Column:
    """All columns as one struct; ``select("row.*")`` brings them back under their names."""
    return F.struct(*[column(c) for c in df.columns if c not in without]).alias("row")


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_hashable(f.dataType) for f in t)
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps and variants, which have none, count by their JSON."""
    return F.xxhash64(*[column(f.name) if _hashable(f.dataType) else F.to_json(F.struct(column(f.name))) for f in df.schema])
