"""Exact quantiles by radix selection.

``percentile`` keeps every distinct value of a group in one buffer. Here values
are counted once, map-side first, and every distinct value gets a 64-bit key that
sorts like it. The rank wanted is found 16 bits at a time: the values are counted
by the next 16 bits of their keys, and those that share the bits of a rank so far
are the candidates for the next count. Four counts end at a single key, whatever
the distribution; most columns need two. No task ever holds more than 65,536
counts of a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage

#: Bits of a key, and how many of them a count tells apart.
BITS, DIGIT = 64, 16


def ordered_key(v: Column) -> Column:
    """A 64-bit integer that orders doubles as their values do; both zeros share one.

    It is the IEEE pattern put together by exact steps: scaling by a power of two
    rounds nothing, and the exponent from the logarithm is corrected by comparison.
    """
    a = F.abs(v)
    guess = F.floor(F.log2(a))
    e = F.when(a < F.pow(F.lit(2.0), guess), guess - 1).when(a >= F.pow(F.lit(2.0), guess + 1), guess + 1).otherwise(guess)
    one = F.lit(1 << 52)
    normal = (e + 1023).cast("long") * one + ((a * F.pow(F.lit(2.0), -e) - 1.0) * one.cast("double")).cast("long")
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    infinite = F.lit(2047 << 52)
    size = F.when(a == 0, F.lit(0)).when(a < F.lit(2.0**-1022), tiny).when(a == F.lit(math.inf), infinite).otherwise(normal)
    return F.when(v < 0, -size - 1).otherwise(size)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: str | None = None,
    groups: list | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value``: one row per group with
    ``n`` and ``q`` (array in the order of ``probs``).

    With ``by``, ``groups`` lists the group values; the result has at most a row
    for each and is worked out at once. NULL and NaN are left out, a group without
    values has no row.
    """
    if by is not None and groups is None:
        raise ValueError("grouped quantiles need the list of groups")
    spark = df.sparkSession
    rows = df.select((F.lit(0) if by is None else F.col(by)).alias("_g"), F.col(value).cast("double").alias("_v"))
    rows = rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if by is not None:
        rows = rows.where(F.col("_g").isin(groups))
    counted = rows.groupBy("_g", "_v").agg(F.count("*").alias("_c"))
    values = cut_lineage(counted.withColumn("_k", ordered_key(F.col("_v"))))
    totals = {r["_g"]: r["n"] for r in values.groupBy("_g").agg(F.sum("_c").alias("n")).collect()}

    picked: dict[tuple[object, int], float] = {}
    group_type = values.schema["_g"].dataType
    schema = T.StructType([T.StructField("_g", group_type), T.StructField("_p", T.LongType()), T.StructField("_r", T.ArrayType(T.LongType()))])
    # What is still open: per group and bits so far, the ranks wanted among the rows that share them.
    places = {g: sorted({f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}) for g, n in totals.items()}
    still = {(g, None): [(r, r) for r in ranks] for g, ranks in places.items()}
    level = 0
    while still:
        prefix = F.shiftright("_k", BITS - DIGIT * (level + 1))
        parent = F.shiftright("_k", BITS - DIGIT * level) if level else F.lit(0).cast("long")
        asked = spark.createDataFrame([(g, p or 0, sorted({inside for inside, _ in ranks})) for (g, p), ranks in still.items()], schema)
        near = values.withColumn("_p", parent).join(F.broadcast(asked), ["_g", "_p"])
        sums = near.groupBy("_g", "_p", prefix.alias("_b")).agg(
            F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_r").alias("_r"))
        upto = Window.partitionBy("_g", "_p").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("_end", F.sum("_n").over(upto))
        found = sums.where(F.exists("_r", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_n"))))
        following: dict[tuple[object, int], list[tuple[int, int]]] = {}
        for row in found.collect():
            start = row["_end"] - row["_n"]
            for inside, rank in still[row["_g"], row["_p"] if level else None]:
                if start <= inside < row["_end"]:
                    if row["_lo"] == row["_hi"]:
                        picked[row["_g"], rank] = row["_lo"]
                    else:
                        following.setdefault((row["_g"], row["_b"]), []).append((inside - start, rank))
        still, level = following, level + 1

    def quantile(g: object, p: float) -> float:
        place = p * (totals[g] - 1)
        low, high = picked[g, math.floor(place)], picked[g, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    name = by or "_g"
    out = T.StructType([T.StructField(name, group_type), T.StructField("n", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))])
    result = spark.createDataFrame([(g, n, [quantile(g, float(p)) for p in probs]) for g, n in totals.items()], out)
    return result if by is not None else result.drop("_g")


def exact_median(df: DataFrame, value: str) -> Column:
    """Median of a whole column as a scalar subquery."""
    return exact_quantiles(df, value, [0.5]).select(F.col("q")[0]).scalar()


def describe(
    df: DataFrame, value: str, by: str, groups: list, probs: list[float] = (0.5,)
) -> DataFrame:
    """Count, mean, sample std, min, max and quantiles per listed group."""
    rows = df.where(F.col(by).isin(list(groups)) & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    moments = rows.groupBy(by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(F.col(value).cast("double")).alias("min"),
        F.max(F.col(value).cast("double")).alias("max"),
    )
    return moments.join(exact_quantiles(df, value, list(probs), by, list(groups)).drop("n"), by)
