"""Tables on shared storage: Parquet, JSONL and CSV, issue logs and small state tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import issue_text


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def file_system(spark: SparkSession, path: str):
    """(file system, path) on Spark's side."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_path(spark: SparkSession, path: str) -> None:
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def rename_path(spark: SparkSession, old: str, new: str) -> bool:
    """Move a folder; False if the new name is taken. Atomic where the file system's rename is."""
    files, source = file_system(spark, old)
    _, target = file_system(spark, new)
    return not files.exists(target) and files.rename(source, target)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of ``target``. The earlier one steps aside first, so a crash loses neither."""
    earlier = f"{target}.earlier-{uuid.uuid4().hex}"
    if path_exists(spark, target) and not rename_path(spark, target, earlier):
        raise OSError(f"{target} could not be moved")
    if not rename_path(spark, staged, target):
        raise OSError(f"{staged} could not be published as {target}")
    delete_path(spark, earlier)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The table, or an empty one of that schema if nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, skip_bad: bool = False) -> DataFrame:
    """JSON lines; a missing path is an empty table. Broken lines fail the read or are skipped."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    mode = "DROPMALFORMED" if skip_bad else "FAILFAST"
    return spark.read.schema(schema).option("mode", mode).json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines in UTF-8, non-ASCII kept, nulls kept."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("escape", '"').csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Values may hold line breaks, so a file is read by one task: write many files."""
    return spark.read.schema(schema).option("escape", '"').option("multiLine", "true").csv(path, header=True)


def save_issues(issues: DataFrame, label: str, path: str, at: Column | None = None) -> None:
    """Append quality issues, one message per row, partitioned by label and time."""
    stamp = F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd_HHmmss")
    (issue_text(issues).withColumns({"label": F.lit(label), "written": stamp})
     .write.mode("append").partitionBy("label", "written").parquet(path))


def rows_table(spark: SparkSession, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(f.name) for f in _struct(schema).fields) for r in rows], schema)


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def recent_rows(df: DataFrame, time: str, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days, counted back from the latest one."""
    latest = df.agg(F.max(time)).scalar()
    return df.where(F.col(time) >= latest - F.expr(f"INTERVAL {int(days)} DAYS"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions of a state table, ascending."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def processed_ids(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The ids of the last finished version, none before the first."""
    versions = _versions(spark, path)
    return read_or_empty(spark, f"{path}/{versions[-1]}" if versions else f"{path}/0", f"{key} string")


def save_processed_ids(current: DataFrame, path: str, key: str) -> None:
    """Make the current ids the state: a new version, so a crash while writing leaves the old one."""
    spark = current.sparkSession
    number = (_versions(spark, path) or [-1])[-1] + 1
    current.select(F.col(key).cast("string").alias(key)).distinct().write.mode("overwrite").parquet(f"{path}/{number}")


