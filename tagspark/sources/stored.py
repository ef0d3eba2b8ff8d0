"""Tables stored by key, so that joins and groupings on the key need no exchange.

``write_stored`` cuts a table into buckets by the hash of its key, one sorted file
per bucket. Two tables with the same number of buckets join bucket by bucket.
Rows without a key can't match; they are kept beside the buckets.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .writers import write_table

#: Rows a key may have: a bucket is one task, and its keys can't be split.
MOST_PER_KEY = 100_000


@dataclass(frozen=True)
class Stored:
    """``keyed`` is read by bucket; ``loose`` holds the rows whose key is NULL."""

    keyed: DataFrame
    loose: DataFrame
    key: str
    buckets: int

    def rows(self) -> DataFrame:
        """The whole table."""
        return self.keyed.unionByName(self.loose)


def write_stored(df: DataFrame, path: str, key: str, buckets: int, most_per_key: int = MOST_PER_KEY) -> None:
    """Store ``df`` under ``path``, cut into ``buckets`` by ``key``.

    A key with more than ``most_per_key`` rows raises ``ValueError`` before anything
    is written: such tables are joined by ``operators.joins.balanced_join``.
    """
    spark = df.sparkSession
    known = F.col(key).isNotNull()
    # The largest group is all that leaves the executors.
    largest = df.where(known).groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest > most_per_key:
        raise ValueError(f"a key of {key} has {largest} rows, at most {most_per_key} can share a bucket")
    name = f"stored_{uuid.uuid4().hex}"
    # Dealt by the hash that names the buckets: each task writes one file of one bucket.
    keyed = df.where(known).repartition(buckets, key).sortWithinPartitions(key)
    keyed.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/keyed").mode("overwrite").format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    write_table(df.where(~known), f"{path}/loose")
    layout = spark.createDataFrame([(key, buckets, df.schema.json())], "key string, buckets int, schema string")
    write_table(layout.coalesce(1), f"{path}/layout")


def open_stored(spark: SparkSession, path: str) -> Stored:
    """A stored table, read with its buckets whichever session wrote it."""
    layout = spark.read.parquet(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    name = f"stored_{uuid.uuid4().hex}"
    quoted = layout["key"].replace("`", "``")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{quoted}`) SORTED BY (`{quoted}`) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/keyed'")
    return Stored(spark.table(name), spark.read.schema(schema).parquet(f"{path}/loose"), layout["key"], layout["buckets"])


def stored_join(left: Stored, right: Stored, how: str = "inner") -> DataFrame:
    """Join on the common key without an exchange; ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    Rows of ``left`` without a key match nothing: ``left`` and ``left_anti`` keep them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if left.key != right.key or left.buckets != right.buckets:
        raise ValueError("the tables are stored by different keys or numbers of buckets")
    # A broadcast would save nothing: no side moves.
    joined = left.keyed.join(right.keyed.hint("merge"), left.key, how)
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(left.loose, allowMissingColumns=True)
