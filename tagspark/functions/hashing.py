"""Seeded, engine-independent ordering keys.

``md5(seed|key)`` orders rows in a way that looks random, survives task
retries and is the same in any engine. Its first 16 bits give a bucket, which
turns "the k-th smallest key" into counting: no sort of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BUCKETS = 65536


def order_key(key: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def bucket(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 4), 16, 10).cast("int")
