"""Joins of the three entities and the id-set joins.

No join here carries a broadcast hint: Catalyst broadcasts a side by its measured size and
adaptive execution splits hot keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, store

#: Joined rows are stored in so many parts of the jobs at most, each of so many bytes of prospects at least.
PARTS, PART_BYTES = 8, 64 << 20


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Put ``prefix`` before every column name except the ones to keep."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


def add_if_absent(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, value)


def join_entities(prospects: DataFrame, applicants: DataFrame, jobs: DataFrame) -> DataFrame:
    """Prospects with their candidate (``app_``) and job (``job_``) columns; unmatched rows drop out."""
    return (prospects.withColumnRenamed("p_codigo", "codigo_candidato")
            .join(prefix_columns(applicants, "app_", ["codigo_candidato"]), "codigo_candidato")
            .join(prefix_columns(jobs, "job_", ["codigo_vaga"]), "codigo_vaga"))


def store_in_parts(spark: SparkSession, label: str, prospects: DataFrame, jobs: DataFrame,
                   build: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``build(prospects, jobs)`` stored part by part of the jobs, so that the shuffles of its joins hold one part at a time.

    Each part scans both tables again; small prospects are one part. Shuffle files of a part go with it under
    :func:`freed_shuffles`.
    """
    path = scratch_path(spark, label)
    size = int(prospects._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(1, min(PARTS, math.ceil(size / PART_BYTES)))
    for part in range(parts):
        mine = F.pmod(F.xxhash64("codigo_vaga"), F.lit(parts)) == part
        rows = build(prospects.where(mine), jobs.where(mine)) if parts > 1 else build(prospects, jobs)
        rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def join_renamed(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equi join on differently named keys; the right key is dropped."""
    return left.join(right, left[left_key] == right[right_key], how).drop(right[right_key])


def attach(df: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on a composite key; duplicate keys on the right fan out."""
    return df.join(scores, list(keys), "left")


def enrich(df: DataFrame, job_fields: DataFrame, candidate_fields: DataFrame) -> DataFrame:
    """Attach extracted fields of both sides; rows lacking either are dropped."""
    return df.join(job_fields, "codigo_vaga").join(candidate_fields, "codigo_candidato")


def not_in(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``done``. A null key counts as not done."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def new_ids(current: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    return current.select(key).subtract(processed.select(key))


def has_new_ids(current: DataFrame, processed: DataFrame, key: str) -> bool:
    return not new_ids(current, processed, key).isEmpty()


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def group_rare(df: DataFrame, column: str, output: str, minimum: int = 10, others: str = "Outros",
               missing: str | None = None) -> DataFrame:
    """Replace values seen fewer than ``minimum`` times by ``others``.

    Counts are pre-aggregated and joined back; a window over the value would put a hot value
    into one task. Only common values are joined, so the joined side has at most
    rows / minimum entries. They are stored, so that a small side is planned by its size and the
    rows stay where they are. Without ``missing`` a null stays null.
    """
    value = F.col(column) if missing is None else F.coalesce(F.col(column), F.lit(missing))
    df = df.withColumn(output, value)
    common = (df.groupBy(output).count()
              .where((F.col("count") >= minimum) & F.col(output).isNotNull())
              .select(F.col(output).alias("_common")))
    common = store(common, "common")
    kept = df.join(common, F.col(output) == F.col("_common"), "left")
    return (kept.withColumn(output, F.when(F.col(output).isNull() | F.col("_common").isNotNull(), F.col(output))
                            .otherwise(F.lit(others)))
            .drop("_common"))


def union_relaxed(first: DataFrame, second: DataFrame) -> DataFrame:
    """Vertical concat by name; differing column types widen to their common type."""
    return first.unionByName(second)


def latest_value(df: DataFrame, column: str) -> Column:
    """Global maximum of a column as a scalar subquery, usable in any expression."""
    return df.agg(F.max(column)).scalar()
