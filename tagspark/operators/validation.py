"""Quality checks and step audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from .profile import is_missing, long_rows

REPORT = "severity string, column string, message string, n bigint"


def validate(df: DataFrame, required: list[str] = (), numeric: list[str] = (), text: list[str] = ()) -> DataFrame:
    """Errors, warnings and statistics as ``(severity, column, message, n)``.

    Schema checks need no data; all missing counts come from one aggregate.
    """
    spark = df.sparkSession
    static = [("stat", None, "n_features", len(df.columns))]
    static += [("error", c, "no such column", None) for c in required if c not in df.columns]
    for c in numeric:
        if c in df.columns and not isinstance(df.schema[c].dataType, T.NumericType):
            kind = df.schema[c].dataType.simpleString()
            static.append(("error", c, f"holds {kind}, not numbers", None))
    checked = [c for c in dict.fromkeys([*numeric, *text]) if c in df.columns]
    rows = [("", {"severity": F.lit("stat"), "message": F.lit("n_samples"), "n": F.count("*")})]
    rows += [(c, {"severity": F.lit("warning"), "message": F.lit("some values are missing"),
                  "n": F.count_if(is_missing(df, c))}) for c in checked]
    counted = long_rows(rows, "column", df).where("severity = 'stat' OR n > 0").select(
        "severity", F.nullif("column", F.lit("")).alias("column"), "message", "n")
    return spark.createDataFrame(static, REPORT).unionByName(counted)


def require_text(df: DataFrame, column: str) -> None:
    """Raise unless the column exists and holds text somewhere. Stops at the
    first non-empty row."""
    if column not in df.columns:
        raise ValueError(f"the input has no column '{column}'")
    if df.where(F.col(column).isNotNull() & (F.col(column) != "")).select(F.lit(1)).isEmpty():
        raise ValueError(f"'{column}' holds no text in any row")


def step_audit(step: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after one step."""
    b, a = before.agg(F.count("*")).scalar(), after.agg(F.count("*")).scalar()
    spark = before.sparkSession
    row = spark.range(0, 1, 1, 1).select(F.lit(step).alias("step"), b.alias("rows_before"), a.alias("rows_after"))
    delta = F.col("rows_after") - F.col("rows_before")
    return row.select("*", delta.alias("change"),
                      F.when(F.col("rows_before") > 0, delta * 100.0 / F.col("rows_before")).otherwise(0.0).alias("change_pct"))


def observed(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count the rows that flow through a step of a pipeline that runs anyway."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def compare_columns(train: DataFrame, test: DataFrame, prefix: str = "has_") -> DataFrame:
    """Feature names of train and test with where they occur; schema only."""
    a = {c for c in train.columns if c.startswith(prefix)}
    b = {c for c in test.columns if c.startswith(prefix)}
    rows = [(c, c in a, c in b) for c in sorted(a | b)]
    return train.sparkSession.createDataFrame(rows, "feature string, in_train boolean, in_test boolean")


def require_same_columns(train: DataFrame, test: DataFrame) -> None:
    if set(train.columns) != set(test.columns):
        raise ValueError(f"train and test columns differ: {sorted(set(train.columns) ^ set(test.columns))}")
