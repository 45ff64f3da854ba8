"""Quality checks. Each returns issue rows (rule, column, n_rows, detail); no issue, no row.

All checks of one table run as one aggregation: counts are computed side by side and turned
into rows afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from .flatten import string_columns
from .profile import LONG_VALUE, distinct_counts

ISSUE_SCHEMA = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("detail", T.StringType()),
])

MISSING = "null, empty, blank or '-'"


def no_issues(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)


def _missing(df: DataFrame, rule: str, column: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(rule, column, None, "column is missing")], ISSUE_SCHEMA)


def _count_issues(df: DataFrame, checks: Sequence[tuple[str, str, Column, str]]) -> DataFrame:
    """Issue rows from ``(rule, column, bad-row predicate, detail)`` in one aggregation."""
    if not checks:
        return no_issues(df)
    counted = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad, _) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"),
                 F.col(f"n{i}").alias("n_rows"), F.lit(detail).alias("detail"))
        for i, (rule, column, _, detail) in enumerate(checks)])
    return counted.select(F.inline(rows)).where("n_rows > 0")


def check_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    strings = set(string_columns(df))
    checks = [("required", c, text.is_missing_value(F.col(c), c in strings), MISSING)
              for c in columns if c in df.columns]
    out = _count_issues(df, checks)
    for c in columns:
        if c not in df.columns:
            out = out.unionAll(_missing(df, "required", c))
    return out


def bad_required(columns: Sequence[str]) -> Column:
    bad = F.lit(False)
    for c in columns:
        bad = bad | text.is_blank_or_dashes(F.col(c))
    return bad


def present(df: DataFrame, columns: Sequence[str]) -> Sequence[str]:
    """The same columns; an absent one is an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    return columns


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows by the required columns."""
    bad = bad_required(present(df, columns))
    return df.where(~bad), df.where(bad)


def count_duplicates(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Number of rows that share their key with another row (all of them, not the surplus).

    Keys of text travel as digests, so long texts are not shuffled; null keys group together.
    """
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    keys = [F.when(F.length(c) > LONG_VALUE, F.concat(F.lit("#"), F.sha2(F.col(c), 256))).otherwise(F.col(c)).alias(f"k{i}") if c in strings
            else F.col(c).alias(f"k{i}") for i, c in enumerate(subset)]
    return (df.select(*keys).groupBy(*[f"k{i}" for i in range(len(keys))]).count().where("count > 1")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows")))


def check_duplicates(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return (count_duplicates(df, subset).where("n_rows > 0")
            .select(F.lit("duplicate").alias("rule"), F.lit(",".join(subset)).alias("column"),
                    F.col("n_rows").cast("bigint").alias("n_rows"), F.lit("rows share a key").alias("detail")))


def check_domain(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """One row per distinct value outside the allowed list."""
    if column not in df.columns:
        return _missing(df, "domain", column)
    c = F.col(column)
    return (df.where(c.isNotNull() & ~c.isin(list(allowed)))
            .groupBy(c.cast("string").alias("detail")).agg(F.count("*").alias("n_rows"))
            .select(F.lit("domain").alias("rule"), F.lit(column).alias("column"), "n_rows", "detail"))


def check_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Values whose start does not match; nulls are not counted."""
    if column not in df.columns:
        return _missing(df, "regex", column)
    return _count_issues(df, [("regex", column, ~F.col(column).cast("string").rlike(rf"\A(?:{pattern})"), pattern)])


def check_range(df: DataFrame, column: str, minimum: float, maximum: float) -> DataFrame:
    if column not in df.columns:
        return _missing(df, "range", column)
    c = F.col(column)
    return _count_issues(df, [("range", column, c < minimum, f"below {minimum}"),
                              ("range", column, c > maximum, f"above {maximum}")])


def check_cardinality(df: DataFrame, column: str, threshold: int = 1000, exact: bool = True) -> DataFrame:
    if column not in df.columns:
        return _missing(df, "cardinality", column)
    return (distinct_counts(df, [column], exact).where(F.col("n_unique") > threshold)
            .select(F.lit("cardinality").alias("rule"), "column", F.col("n_unique").alias("n_rows"),
                    F.lit(f"more than {threshold} distinct values").alias("detail")))


def structure_errors(df: DataFrame, expected: T.StructType) -> list[tuple]:
    """(None, column, error) of missing and wrongly typed columns; reads no row."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in expected.fields:
        if f.name not in actual:
            out.append((None, f.name, "missing column"))
        elif actual[f.name] != f.dataType:
            out.append((None, f.name, f"expected {f.dataType.simpleString()}, found {actual[f.name].simpleString()}"))
    return out


def assert_structure(df: DataFrame, expected: T.StructType, label: str) -> None:
    """Raise on missing and wrongly typed columns."""
    errors = structure_errors(df, expected)
    if errors:
        raise ValueError(f"[{label}] schema check failed: {len(errors)} errors; " + "; ".join(f"{c}: {e}" for _, c, e in errors))


def schema_errors(df: DataFrame, expected: T.StructType, id_field: str) -> DataFrame:
    """All contract violations as (id, column, error).

    A missing or wrongly typed column is one row without id; a null in a non-nullable field is
    one row per record.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    shape = "id string, column string, error string"
    out = df.sparkSession.createDataFrame(structure_errors(df, expected), shape)
    required = [f.name for f in expected.fields if not f.nullable and f.name in actual]
    if required:
        found = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())
        row_id = F.col(id_field).cast("string") if id_field in actual else F.lit(None).cast("string")
        out = out.unionAll(df.select(row_id.alias("id"), F.explode(found).alias("column"),
                                     F.lit("null in a required field").alias("error")))
    return out


def assert_schema(df: DataFrame, expected: T.StructType, label: str, id_field: str, errors_path: str | None = None) -> None:
    """Raise if the contract is violated.

    With ``errors_path`` every error is appended there (label, id, column, error); the message tells their
    number, the place, and one error as an example.
    """
    errors = schema_errors(df, expected, id_field)
    if errors.isEmpty():
        return
    if errors_path:
        errors.select(F.lit(label).alias("label"), "*").write.mode("append").parquet(errors_path)
    count, e = errors.count(), errors.first()
    place = f", all in {errors_path}" if errors_path else ""
    raise ValueError(f"[{label}] schema check failed: {count} errors{place}; id={e['id']} {e['column']}: {e['error']}")


def issue_text(df: DataFrame) -> DataFrame:
    """Add a one-line message to issue rows."""
    counted = F.concat(F.lit(": "), F.col("n_rows").cast("string"), F.lit(" rows"))
    message = F.concat(F.lit("["), F.upper("rule"), F.lit("] "), F.col("column"),
                       F.coalesce(counted, F.lit("")), F.lit(", "), F.col("detail"))
    return df.withColumn("message", F.trim(message))
