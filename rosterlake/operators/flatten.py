"""Nested columns to flat tables, and the curated text/date normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import temporal, text
from ..functions.naming import initials, tidy_name  # noqa: F401


def _field_columns(name: str, struct: T.StructType, prefix: str):
    return [F.col(f"`{name}`").getField(f.name).alias(f"{prefix}_{f.name}") for f in struct.fields]


def flatten_nested(df: DataFrame, prefixes: Mapping[str, str] | None = None) -> DataFrame:
    """Structs become prefixed columns; lists of structs become rows first.

    The prefix is the initials of the column name unless ``prefixes`` names one. A null or
    empty list keeps its parent as one row of nulls. All names are tidied at the end.
    """
    prefixes = prefixes or {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            others = [F.col(f"`{c}`") if c != field.name else F.explode_outer(f"`{c}`").alias(c) for c in df.columns]
            df = df.select(*others)
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += _field_columns(field.name, field.dataType, prefixes.get(field.name, initials(field.name)))
        else:
            columns.append(F.col(f"`{field.name}`"))
    flat = df.select(*columns)
    return flat.toDF(*[tidy_name(c) for c in flat.columns])


def flatten_entities(jobs: DataFrame, prospects: DataFrame, applicants: DataFrame):
    """The exploration variant: prospects take the prefix ``pr_`` and a candidate key."""
    flat = flatten_nested(prospects, {"prospects": "pr"})
    return (flatten_nested(jobs),
            flat.withColumnRenamed("pr_codigo", "pr_codigo_candidato"),
            flatten_nested(applicants))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize(df: DataFrame, dates: Sequence[str] = (), datetimes: Sequence[str] = (), cleaned: Mapping[str, str] | None = None,
              leave_out: Sequence[str] = ()) -> DataFrame:
    """Clean every string column, then parse the named date and datetime columns if present.

    ``cleaned`` names the columns that hold the cleaned text of others already, ``leave_out`` what the result does without.
    """
    strings, cleaned = set(string_columns(df)), cleaned or {}

    def expression(name: str):
        c = F.col(f"`{cleaned.get(name, name)}`")
        if name in strings and name not in cleaned:
            c = text.clean_text(c)
        if name in dates:
            c = temporal.parse_date(c)
        elif name in datetimes:
            c = temporal.parse_datetime(c)
        return c.alias(name)

    return df.select(*[expression(c) for c in df.columns if c not in leave_out])


def schema_tree(dtype: T.DataType):
    """Schema as nested dicts: struct -> {field: ...}, array -> {"list_of": ...}, else the type name."""
    if isinstance(dtype, T.StructType):
        return {f.name: schema_tree(f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.ArrayType):
        return {"list_of": schema_tree(dtype.elementType)}
    return dtype.simpleString()


def schema_leaves(dtype: T.DataType, path: str = "") -> list[tuple[str, T.DataType]]:
    """Path and type of every leaf of a nested type; fields are parted by ``.``, elements of a list are ``[]``."""
    if isinstance(dtype, T.StructType):
        return [leaf for f in dtype.fields for leaf in schema_leaves(f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(dtype, T.ArrayType):
        return schema_leaves(dtype.elementType, f"{path}[]")
    return [(path, dtype)]


def _filled(value: Column, dtype: T.DataType) -> list[Column]:
    """Numbers of values in one row, leaf by leaf as in :func:`schema_leaves`."""
    if isinstance(dtype, T.StructType):
        return [c for f in dtype.fields for c in _filled(value.getField(f.name), f.dataType)]
    if isinstance(dtype, T.ArrayType):
        def total(number: int) -> Column:
            return F.aggregate(value, F.lit(0).cast("long"), lambda s, x: s + _filled(x, dtype.elementType)[number])

        return [F.coalesce(total(i), F.lit(0).cast("long")) for i in range(len(schema_leaves(dtype)))]
    return [F.when(value.isNotNull(), 1).otherwise(0).cast("long")]


def schema_profile(df: DataFrame) -> DataFrame:
    """The nested schema as a table with what is in it: ``path``, ``type``, ``n_values`` (values that are not null).

    One pass over the rows without unnesting them; an empty table has zeros, a null list or struct no values.
    """
    leaves = schema_leaves(df.schema)
    counts = [c for f in df.schema.fields for c in _filled(F.col(f"`{f.name}`"), f.dataType)]
    totals = df.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(f"n{i}") for i, c in enumerate(counts)])
    rows = [F.struct(F.lit(path).alias("path"), F.lit(dtype.simpleString()).alias("type"), F.col(f"n{i}").alias("n_values"))
            for i, (path, dtype) in enumerate(leaves)]
    return totals.select(F.inline(F.array(*rows)))


def pick_existing(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def split_types(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and string column names; arrays and other types are left out."""
    fields = [f for f in df.schema.fields if f.name not in leave_out]
    return ([f.name for f in fields if isinstance(f.dataType, T.NumericType)],
            [f.name for f in fields if isinstance(f.dataType, T.StringType)])
