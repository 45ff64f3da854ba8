"""Files that hold one JSON object keyed by record id, or a list of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import with_id


def explode_keyed(texts: DataFrame, id_field: str, record: T.StructType, column: str = "value") -> DataFrame:
    """Rows of keyed objects held as text: the key becomes ``id_field``. A broken text ends the job."""
    entries = F.from_json(F.col(column), T.MapType(T.StringType(), record), {"mode": "FAILFAST"})
    return (texts.select(F.explode(entries).alias("_id", "_record"))
            .select(F.col("_id").alias(id_field), "_record.*"))


def read_keyed_json(spark: SparkSession, path: str, id_field: str, record: T.StructType,
                    layout: str = "lines") -> DataFrame:
    """Records as rows; a broken or cut file ends the job instead of losing its rows.

    ``lines`` (the layout to use at scale): one record per line, files split. ``object_per_line``: each
    line is a keyed object. ``object_per_file``: each file is one keyed object, read by one task as one
    string of at most 2 GB, so a large extract must come as many files. ``list``: each file is a JSON list
    of records that carry their id; such a file is read by one task too. Only ``lines`` and ``list``
    column-prune while parsing.
    """
    if layout == "object_per_file":
        return explode_keyed(spark.read.text(path, wholetext=True), id_field, record)
    if layout == "object_per_line":
        return explode_keyed(spark.read.text(path), id_field, record)
    if layout == "list":
        return spark.read.schema(with_id(record, id_field)).json(path, multiLine=True, mode="FAILFAST")
    if layout == "lines":
        return spark.read.schema(with_id(record, id_field)).json(path, mode="FAILFAST")
    raise ValueError(f"unknown layout {layout!r}")
