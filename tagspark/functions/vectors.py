"""Vector expressions on ``array<double>`` columns, and the ML vector edge."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, functions as F, types as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """L2-normalised copy; a zero vector stays zero."""
    length = norm(a)
    scale = F.when(length > 0, length).otherwise(F.lit(1.0))
    return F.zip_with(a, F.array_repeat(scale, F.size(a)), lambda x, s: x.cast("double") / s)


def cosine(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """ML sparse vector from index and value arrays.

    Built by the JSON reader in the JVM, whose target schema may hold the
    vector type; indices must be ascending.
    """
    struct = F.struct(
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            size.cast("int").alias("size"),
            indices.alias("indices"),
            values.alias("values"),
        ).alias("v")
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(struct), schema)["v"]


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)
