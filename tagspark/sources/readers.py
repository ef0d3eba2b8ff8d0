"""Scans: JSON records, parquet tables, and the tag list column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

STRING_FIELDS = [
    "src_uid", "code_uid", "prob_desc_title", "prob_desc_description",
    "prob_desc_input_spec", "prob_desc_output_spec", "prob_desc_sample_inputs",
    "prob_desc_sample_outputs", "prob_desc_notes", "prob_desc_time_limit",
    "prob_desc_memory_limit", "prob_desc_input_from", "prob_desc_output_to",
    "source_code", "lang", "exec_outcome", "file_name",
]

#: Schema of one record. ``tags`` is read as text because files hold either a
#: JSON list or the printed form of a Python list; ``parse_tags`` reads both.
RECORD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in STRING_FIELDS]
    + [
        T.StructField("tags", T.StringType()),
        T.StructField("difficulty", T.DoubleType()),
        T.StructField("prob_desc_created_at", T.StringType()),
    ]
)


def _json_files(spark: SparkSession, path: str) -> str:
    """``path`` itself, or the pattern of the JSON files in the folder; only the listing is read, up to the first match."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        raise ValueError(f"no file or folder at {path}")
    if fs.getFileStatus(hadoop).isDirectory():
        listed = fs.listStatusIterator(hadoop)
        while listed.hasNext():
            if listed.next().getPath().getName().endswith(".json"):
                return jvm.org.apache.hadoop.fs.Path(hadoop, "*.json").toString()
        raise ValueError(f"{path} holds no .json file")
    return path


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA, whole_files: bool = True) -> DataFrame:
    """One JSON object per file, or per line if not ``whole_files``; ``path`` is a file or a folder of ``*.json``.

    Many records are stored one to a line: opening a file costs more than reading a record.
    A missing path or a folder without JSON files raises ``ValueError``. Keys
    outside the schema are dropped; ``read_all_keys`` keeps them.
    """
    return spark.read.schema(schema).option("multiLine", whole_files).json(_json_files(spark, path))


def _settled(merged: T.DataType) -> T.DataType:
    """The type a column gets for what its values have in common: fractions are
    doubles; what has nothing in common, and what is never filled, is text."""
    if isinstance(merged, T.StructType) and len(merged):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in merged])
    if isinstance(merged, T.ArrayType):
        return T.ArrayType(_settled(merged.elementType))
    if isinstance(merged, T.DecimalType) and merged.scale > 0:
        return T.DoubleType()
    if isinstance(merged, (T.VariantType, T.NullType, T.StructType)):
        return T.StringType()
    return merged


def _ddl(t: T.DataType) -> str:
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in t) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def merged_schema(records: DataFrame, known: T.StructType = RECORD_SCHEMA) -> T.StructType:
    """``known`` and, by name, all further keys of the VARIANT column ``record`` with the type their values share.

    One aggregation whose state is a schema, merged per task; only that reaches the driver.
    """
    found = records.agg(F.schema_of_variant_agg("record")).first()[0]
    merged = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")) if found else None
    keys = merged.fields if isinstance(merged, T.StructType) else []
    names = set(known.names)
    return T.StructType([*known.fields, *[T.StructField(f.name, _settled(f.dataType)) for f in keys if f.name not in names]])


def read_all_keys(spark: SparkSession, path: str, known: T.StructType = RECORD_SCHEMA, whole_files: bool = True) -> DataFrame:
    """Records as ``read_records`` gives them, and a column for every other key that any file has.

    The union of keys comes from the data: records are read as VARIANT, their
    schemas merged, and the columns cut out. A file without a key has NULL
    there; a value that does not fit the type is NULL, nested objects are structs
    with the union of their keys. Lists and objects under a key of type text are
    its JSON. A key that differs from an earlier one in case alone gets ``_2``,
    ``_3``, … behind its name. A file that is no JSON gives a row of NULLs.
    """
    files = _json_files(spark, path)
    records = spark.read.option("singleVariantColumn", "record").option("multiLine", whole_files).json(files)
    schema = merged_schema(records, known)
    seen: dict[str, int] = {}
    fields = []
    for f in schema:
        n = seen[f.name.lower()] = seen.get(f.name.lower(), 0) + 1
        fields.append(T.StructField(f.name if n == 1 else f"{f.name}_{n}", f.dataType))
    whole = F.try_variant_get("record", "$", _ddl(schema)).cast(T.StructType(fields))
    return records.select(whole.alias("record")).select("record.*")


def parse_tags(tags: Column) -> Column:
    """Printed list (``['a', 'b']`` or JSON) to ``array<string>``.

    Each quoted item is taken as a whole, so an apostrophe inside a
    double-quoted item (and the reverse) survives.
    """
    quoted = r"""'([^'\\]*)'|"([^"\\]*)\""""
    single = F.regexp_extract_all(tags, F.lit(quoted), F.lit(0))
    return F.transform(single, lambda item: F.substring(item, F.lit(2), F.length(item) - 2))


def extract_tags_list(df: DataFrame, column: str = "tags") -> DataFrame:
    """Parse the tag column where it is text; leave arrays alone."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, parse_tags(F.col(column)))
    return df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Session setting: deal scanned tables to this many partitions. For tables that
#: are stored in fewer row groups than there are cores; unset, scans stay as they are.
SCAN_PARTITIONS = "tagspark.scanPartitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a scan by ``key`` if the session asks for it."""
    partitions = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(partitions), key) if partitions else df


def feature_names(spark: SparkSession, path: str, prefix: str = "has_") -> list[str]:
    """Names of the stored features, from the table's schema alone."""
    return [n for n in spark.read.parquet(path).schema.names if n.startswith(prefix)]
