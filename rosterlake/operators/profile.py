"""Column profiles.

Counts, lengths and moments of all columns come from one aggregation. Distinct values and
quantiles need a shuffle: values are grouped per (column, value) with map-side combine, so a
value that fills a third of a column travels as one row per task, and the quantiles of :mod:`ordered`
sort only the values near the wanted ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, over_all_cores
from .ordered import ACCURACY, column_quantiles, probes, quantiles, unpivot

LONG_VALUE = 64

QUARTERS = {"q25": 0.25, "median": 0.5, "q75": 0.75}
NUMERIC_STATS = ["mean", "std", "min", "q25", "median", "q75", "max", "iqr", "outlier_count", "skewness"]


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, callable]) -> DataFrame:
    """One aggregation, then one row per column with the named statistics."""
    measures = [f(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in stats.items()]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in stats])
        for i, c in enumerate(columns)])
    return df.agg(*measures).select(F.inline(rows))


def _value_key(c: Column) -> Column:
    """The value as text; long text is replaced by its digest so that free text shuffles small."""
    value = c.cast("string")
    return F.when(F.length(value) > LONG_VALUE, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(value)


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column, n_unique); null counts as one value."""
    if not exact:
        return _per_column(df, columns, {
            "n_unique": lambda c: F.approx_count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))})
    keyed = df.select(*[_value_key(F.col(f"`{c}`")).alias(c) for c in columns])
    values = unpivot(keyed, columns, dtype="string").groupBy("column", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("column").agg(F.count("*").alias("n_unique"))


def qualitative_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Nulls, distinct values and text lengths per column, most nulls first. The table is a scan, or a stored one."""
    df = over_all_cores(df)  # the distinct values of a task are held in its memory
    types = {f.name: f.dataType for f in df.schema.fields}

    def length(measure, empty):
        def build(c: str) -> Column:
            if isinstance(types[c], T.StringType):
                return F.coalesce(measure(F.char_length(F.col(c))), F.lit(empty))
            return F.max(F.lit(None).cast("double" if isinstance(empty, float) else "int"))
        return build

    counted = _per_column(df, df.columns, {
        "null_count": lambda c: F.count_if(F.col(c).isNull()),
        "rows": lambda c: F.count("*"),
        "min_len": length(F.min, 0), "max_len": length(F.max, 0), "avg_len": length(F.avg, 0.0),
    })
    kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c].simpleString())])
    return (counted.join(distinct_counts(df, df.columns, exact), "column")
            .select("column", F.try_element_at(kinds, F.col("column")).alias("dtype"), "null_count",
                    F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("rows")), F.lit(0.0)).alias("null_percent"),
                    "n_unique", "min_len", "max_len", "avg_len")
            .orderBy(F.desc("null_percent"), "column"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def number_groups(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type in which their values are compared: bigint, decimal of their scale, or double."""
    groups: dict[str, list[str]] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in columns:
        kind = types[c]
        exact = "bigint" if isinstance(kind, T.IntegralType) else f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "double"
        groups.setdefault(exact, []).append(c)
    return groups


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Moments, quartiles, 1.5 IQR outliers and population skewness per numeric column.

    Exact quartiles come from sketches and the values around them, outliers from a count, and only distinct counts
    shuffle all distinct values. Without ``exact`` nothing but one row per task is shuffled. The table is read several
    times, its numeric columns only; give a stored one if it is costly to compute.
    """
    columns = list(columns or numeric_columns(df))
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields if f.name in columns for x in (f.name, f.dataType.simpleString())])
    stats = {
        "null_count": lambda c: F.count_if(F.col(c).isNull()),
        "rows": lambda c: F.count("*"),
        "mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
        "skewness": lambda c: F.skewness(c),
    }
    if not exact:
        stats["n_values"] = lambda c: F.approx_count_distinct(c)
        stats["_q"] = lambda c: F.percentile_approx(F.col(c).cast("double"), list(QUARTERS.values()))
        basic = _per_column(df, columns, stats)
        quarters = basic.select("column", "n_values", *[F.col("_q")[i].alias(q) for i, q in enumerate(QUARTERS)])
        basic = basic.drop("n_values", "_q")
        outliers = _outliers(unpivot(df, columns).where("value IS NOT NULL").withColumn("n", F.lit(1)), quarters)
    else:
        stats["_q"] = lambda c: F.percentile_approx(F.col(c).cast("double"), probes(QUARTERS), ACCURACY)
        basic = cut_lineage(_per_column(df, columns, stats))  # one row per column
        sketches = {r["column"]: (r["rows"] - r["null_count"], r["_q"]) for r in basic.collect()}
        basic, groups = basic.drop("_q"), number_groups(df, columns)
        found = column_quantiles(df, groups, sketches, QUARTERS)
        quarters = df.sparkSession.createDataFrame(
            [(c, *[q[name] for name in QUARTERS]) for c, q in found.items()], f"column string, {', '.join(f'{q} double' for q in QUARTERS)}")
        values = None
        for dtype, group in groups.items():
            own = unpivot(df, group, dtype=dtype).where("value IS NOT NULL").groupBy("column", "value").agg(F.lit(1).alias("one"))
            own = own.groupBy("column").agg(F.count("*").alias("n_values"))
            values = own if values is None else values.unionByName(own)
        quarters = quarters.join(values, "column", "left")
        outliers = _per_column(df, columns, {"outlier_count": lambda c: F.count_if(_beyond(F.col(c).cast("double"), found[c]["q25"], found[c]["q75"]))})
        outliers = outliers.join(basic.where("rows > null_count").select("column"), "column", "left_semi")
    quarters = quarters.withColumn("iqr", F.col("q75") - F.col("q25"))
    return (basic.join(quarters, "column", "left").join(outliers, "column", "left")
            .withColumn("n_unique", F.coalesce("n_values", F.lit(0)) + (F.col("null_count") > 0).cast("int"))
            .select("column", F.try_element_at(kinds, F.col("column")).alias("dtype"), "null_count",
                    F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("rows")), F.lit(0.0)).alias("null_percent"),
                    "n_unique", *NUMERIC_STATS))


def _beyond(c: Column, q25: float | None, q75: float | None) -> Column:
    """Outside 1.5 IQR; nothing is where a column has no values."""
    if q25 is None or q75 is None:
        return F.lit(False)
    spread = 1.5 * (q75 - q25)
    return (c < q25 - spread) | (c > q75 + spread)


def _outliers(counted: DataFrame, quarters: DataFrame) -> DataFrame:
    """(column, outlier_count) beyond 1.5 IQR; the bound side has one row per column, as small as the schema."""
    spread = 1.5 * (F.col("q75") - F.col("q25"))
    fences = quarters.select("column", (F.col("q25") - spread).alias("low"), (F.col("q75") + spread).alias("high"))
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return (counted.join(F.broadcast(fences), "column").groupBy("column")
            .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outlier_count")))


def empty_share(df: DataFrame, columns: Sequence[str] | None = None, above: float = 20.0) -> DataFrame:
    """String columns whose share of empty strings exceeds ``above`` percent, highest first."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    counted = _per_column(df, columns, {"n_empty": lambda c: F.count_if(F.col(c) == ""), "rows": lambda c: F.count("*")})
    return (counted.withColumn("empty_percent", F.try_divide(F.col("n_empty") * 100.0, F.col("rows")))
            .where(F.col("empty_percent") > above)
            .select("column", "n_empty", "empty_percent")
            .orderBy(F.desc("empty_percent"), "column"))


def distinct_when(df: DataFrame, key: str, conditions: dict[str, Column]) -> DataFrame:
    """Distinct keys under each condition, side by side.

    Null keys count as one value. Rows are first reduced to one per key.
    """
    per_key = df.groupBy(key).agg(*[F.max(cond.cast("int")).alias(name) for name, cond in conditions.items()])
    return per_key.agg(*[F.count_if(F.col(name) == 1).alias(name) for name in conditions])


def cap_at_quantile(df: DataFrame, column: str, share: float = 0.85) -> DataFrame:
    """Rows whose value is at most the given quantile; nulls drop out."""
    bound = quantiles(df.select(F.col(column).cast("double").alias("v")), "v", {"cap": share}).select("cap").scalar()
    return df.where(F.col(column) <= bound)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the minimum and maximum; the maximum falls into the last bin."""
    value = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    low, high = value.agg(F.min("v")).scalar(), value.agg(F.max("v")).scalar()
    width = F.coalesce(F.nullif(high - low, F.lit(0.0)), F.lit(1.0)) / bins
    placed = value.select(F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counted = placed.groupBy("bin").agg(F.count("*").alias("n_rows"))
    return counted.select("bin", (low + F.col("bin") * width).alias("bin_start"), "n_rows")


def free_text_columns(profile: DataFrame, over: float = 40) -> DataFrame:
    return profile.where(F.col("avg_len") > over).select("column", "avg_len", "max_len", "n_unique")


def selection_columns(profile: DataFrame, low: int = 0, high: int = 100) -> DataFrame:
    """Columns with more than ``low`` and at most ``high`` distinct values."""
    return profile.where((F.col("n_unique") > low) & (F.col("n_unique") <= high)).select("column", "n_unique")
