"""Data drift between a reference and a current table, all columns in one plan.

Both tables are put under each other with 0/1 side counters and reduced to one row per
(column, value) before anything is ordered or joined, so the cost follows the distinct values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_with_tasks
from .flatten import split_types
from .ordered import quantiles_of, running_totals, unpivot, value_sums
from .profile import _per_column, number_groups, numeric_profile, qualitative_profile

# --- fixed values: thresholds ---------------------------------------------
P_VALUE = 0.05
DISTANCE = 0.1
MIN_STD = 0.001
ZERO_SHARE = 0.0001
DATASET_SHARE = 0.5
ALERT_SHARE = 0.15
PSI_ALERT = 0.15
PSI_BINS = 10
# -----------------------------------------------------------------------------------------------


# ------------------------------------------------------------------------------------ p-values
def _ks_p(d: float, n: float, m: float) -> float:
    """Two-sample Kolmogorov-Smirnov p-value by the asymptotic series."""
    root = math.sqrt(n * m / (n + m))
    x = (root + 0.12 + 0.11 / root) * d
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return min(max(2.0 * total, 0.0), 1.0)


def _chi2_p(x: float, dof: float) -> float:
    """Upper tail of the chi-square distribution: series below the mean, continued fraction above."""
    if math.isinf(x):
        return 0.0
    if x <= 0 or dof <= 0:
        return 1.0
    a, x = dof / 2.0, x / 2.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return max(1.0 - total * scale, 0.0)
    b = x + 1.0 - a
    c, d = 1e300, 1.0 / b
    out = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2.0
        d = 1.0 / (step * d + b)
        c = b + step / c
        out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return min(scale * out, 1.0)


def _normal_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _p_value(name: str, function, *columns: Column) -> Column:
    """Apply a p-value formula to a metric table, which has one row per column of the data."""
    @F.arrow_udf("double")
    def apply(*values: pa.Array) -> pa.Array:
        rows = zip(*[v.to_pylist() for v in values])
        return pa.array([None if None in row else function(*row) for row in rows], pa.float64())

    return apply(*[c.cast("double") for c in columns]).alias(name)


# -------------------------------------------------------------------------------------- counts
def _both_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, ref: int) -> DataFrame:
        return df.select(*[F.col(c) for c in columns], F.lit(ref).alias("ref"), F.lit(1 - ref).alias("cur"))

    return side(reference, 1).unionByName(side(current, 0))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_values, n_ref, n_cur, ks, wasserstein): KS statistic and normed Wasserstein distance.

    The Wasserstein distance is divided by the population standard deviation of the reference,
    at least 0.001. Nulls, NaN and infinities are left out.
    """
    parts = []
    # Whole numbers and decimals keep their type: as doubles, ids above 2^53 would run together.
    for dtype, group in number_groups(reference, columns).items():
        long = unpivot(_both_sides(reference, current, group), group, ["ref", "cur"], dtype)
        if dtype == "double":
            long = long.where(~F.isnan("value") & (F.abs("value") < float("inf")))
        parts.append(_numeric_drift(running_totals(long, "value", ["ref", "cur"], ["column"]), reference, group))
    return reduce(DataFrame.unionByName, parts)


def _numeric_drift(totals: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    gap = F.abs(F.try_divide(F.col("ref_upto").cast("double"), F.col("ref_total"))
                - F.try_divide(F.col("cur_upto").cast("double"), F.col("cur_total")))
    width = F.coalesce((F.col("next_value") - F.col("value")).cast("double"), F.lit(0.0))
    measured = totals.groupBy("column").agg(
        F.count("*").alias("n_values"), F.max("ref_total").alias("n_ref"), F.max("cur_total").alias("n_cur"),
        F.max(gap).alias("ks"), F.sum(gap * width).alias("_distance"))

    def spread(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.stddev_pop(F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v))

    # One row per column on both sides.
    deviation = _per_column(reference, list(columns), {"_std": spread})
    return measured.join(F.broadcast(deviation), "column").select(
        "column", "n_values", "n_ref", "n_cur", "ks",
        (F.col("_distance") / F.greatest("_std", F.lit(MIN_STD))).alias("wasserstein"))


def category_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, ref, cur) counts, stored because they are read several times; nulls are left out."""
    long = unpivot(_both_sides(reference, current, columns), columns, ["ref", "cur"], "string")
    return value_sums(long, "value", ["ref", "cur"], ["column"])


def _with_column_totals(counts: DataFrame) -> DataFrame:
    """Add per-column totals and smallest non-zero shares; one row per column is broadcast."""
    sums = counts.groupBy("column").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.count("*").alias("n_values"),
        F.min(F.when(F.col("ref") > 0, F.col("ref"))).alias("_min_ref"),
        F.min(F.when(F.col("cur") > 0, F.col("cur"))).alias("_min_cur"),
        F.min("value").alias("_first"))
    return counts.join(F.broadcast(sums), "column")


def _filled_share(count: str, total: str, smallest: str) -> Column:
    """Share of a category; an empty one gets 0.0001, or less if real shares are that small."""
    least = F.try_divide(F.col(smallest).cast("double"), F.col(total))
    fill = F.when(least <= ZERO_SHARE, least / 1e6).otherwise(ZERO_SHARE)
    share = F.try_divide(F.col(count).cast("double"), F.col(total))
    return F.when(F.col(count) > 0, share).otherwise(fill)


def category_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_values, n_ref, n_cur, chi2, jensen_shannon, z): three category statistics.

    chi2 compares the current counts with the reference counts scaled to the same size and is
    infinite for a new category; jensen_shannon is the distance (square root, natural log);
    z is the two-proportion statistic, only for two values. If one side has no value at all, chi2 and
    z are null; a column without a value on either side has no row.
    """
    counts = _with_column_totals(category_counts(reference, current, columns))
    expected = F.try_divide(F.col("ref") * F.col("n_cur").cast("double"), F.col("n_ref"))
    surprise = F.when(F.col("ref") > 0, F.try_divide(F.pow(F.col("cur") - expected, F.lit(2.0)), expected)).otherwise(float("inf"))
    shares = counts.withColumns({"_p": _filled_share("ref", "n_ref", "_min_ref"),
                                 "_q": _filled_share("cur", "n_cur", "_min_cur"), "_chi": surprise})
    # Filled shares no longer sum to 1; the distance normalises them.
    sums = shares.groupBy("column").agg(F.sum("_p").alias("_sp"), F.sum("_q").alias("_sq"))
    p, q = F.col("_p") / F.col("_sp"), F.col("_q") / F.col("_sq")
    middle = (p + q) / 2
    divergence = (p * F.log(p / middle) + q * F.log(q / middle)) / 2
    first = F.col("value") == F.col("_first")
    measured = (shares.join(F.broadcast(sums), "column")
                .groupBy("column").agg(
                    F.max("n_values").alias("n_values"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"),
                    F.sum("_chi").alias("chi2"),
                    F.sqrt(F.greatest(F.sum(divergence), F.lit(0.0))).alias("jensen_shannon"),
                    F.max(F.when(first, F.col("ref"))).alias("_a"), F.max(F.when(first, F.col("cur"))).alias("_b")))
    pooled = (F.col("_a") + F.col("_b")) / (F.col("n_ref") + F.col("n_cur"))
    one = F.lit(1.0)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, F.col("n_ref")) + F.try_divide(one, F.col("n_cur"))))
    share = lambda part, whole: F.try_divide(F.col(part).cast("double"), F.col(whole))
    z = F.try_divide(share("_a", "n_ref") - share("_b", "n_cur"), error)
    return measured.select("column", "n_values", "n_ref", "n_cur", "chi2", "jensen_shannon",
                           F.when(F.col("n_values") == 2, z).alias("z"))


# ------------------------------------------------------------------------------ column decision
def _listed(measured: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row for every column asked for: one without values on either side has counts of 0."""
    names = measured.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    counts = ("n_values", "n_ref", "n_cur")
    return names.join(measured, "column", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def column_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
                 test: str = "distance", categorical: Sequence[str] = ()) -> DataFrame:
    """(column, kind, test, statistic, score, threshold, drifted, status), one row per column.

    ``test="distance"``: normed Wasserstein for numbers, Jensen-Shannon for categories, drift from 0.1.
    ``test="p_value"``: KS for numbers, chi-square for categories, a z-test for two values, drift below
    0.05. The same test is used whatever the size of the tables, so reports can be compared.
    ``categorical`` names numeric columns to treat as categories.
    ``status`` is ``ok``, ``one_sided`` (values on one side only, which is drift) or ``no_values``
    (on neither side, which is none); the last two have no score.
    """
    if test not in ("distance", "p_value"):
        raise ValueError(f"unknown test {test!r}")
    chosen = reference.select(*columns) if columns else reference
    numbers, categories = split_types(chosen)
    categories = [*categories, *[c for c in numbers if c in categorical]]
    numbers = [c for c in numbers if c not in categorical]
    parts = []
    sides = ("n_ref", "n_cur")
    if numbers:
        measured = _listed(numeric_drift(reference, current, numbers), numbers)
        name, score = (("wasserstein", F.col("wasserstein")) if test == "distance"
                       else ("ks", _p_value("score", _ks_p, F.col("ks"), F.col("n_ref"), F.col("n_cur"))))
        parts.append(measured.select("column", F.lit("num").alias("kind"), F.lit(name).alias("test"),
                                     F.col(name).alias("statistic"), score.alias("score"), *sides))
    if categories:
        counted = _listed(category_drift(reference, current, categories), categories)
        kind = F.when(F.col("column").isin(list(categorical)), "num").otherwise("cat").alias("kind")
        if test == "distance":
            parts.append(counted.select("column", kind, F.lit("jensen_shannon").alias("test"),
                                        F.col("jensen_shannon").alias("statistic"),
                                        F.col("jensen_shannon").alias("score"), *sides))
        else:
            two = F.col("n_values") <= 2
            counted = counted.select(
                "*", _p_value("_chi_p", _chi2_p, F.col("chi2"), F.col("n_values") - 1),
                _p_value("_z_p", _normal_p, F.coalesce(F.col("z"), F.lit(0.0))))
            parts.append(counted.select(
                "column", kind, F.when(two, "z").otherwise("chi2").alias("test"),
                F.when(two, F.coalesce("z", F.lit(0.0))).otherwise(F.col("chi2")).alias("statistic"),
                F.when(two, F.col("_z_p")).otherwise(F.col("_chi_p")).alias("score"), *sides))
    if not parts:
        return reference.sparkSession.createDataFrame([], COLUMN_DRIFT_SCHEMA)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    status = (F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), "ok")
              .when((F.col("n_ref") > 0) | (F.col("n_cur") > 0), "one_sided").otherwise("no_values"))
    rows = rows.withColumn("status", status)
    both = F.col("status") == "ok"
    beyond = F.col("score") < P_VALUE if test == "p_value" else F.col("score") >= DISTANCE
    return rows.select("column", "kind", "test", F.when(both, F.col("statistic")).alias("statistic"),
                       F.when(both, F.col("score")).alias("score"),
                       F.lit(P_VALUE if test == "p_value" else DISTANCE).alias("threshold"),
                       F.when(both, beyond).otherwise(F.col("status") == "one_sided").alias("drifted"), "status")


COLUMN_DRIFT_SCHEMA = ("column string, kind string, test string, statistic double, score double, "
                       "threshold double, drifted boolean, status string")


def dataset_drift(column_rows: DataFrame, share: float = DATASET_SHARE, alert: float = ALERT_SHARE) -> DataFrame:
    """One row: number and share of drifted columns, dataset drift, and the alert on the share."""
    counted = column_rows.agg(F.count_if("drifted").alias("number_of_drifted_columns"),
                              F.count("*").alias("number_of_columns"))
    part = F.coalesce(F.try_divide(F.col("number_of_drifted_columns"), F.col("number_of_columns")), F.lit(0.0))
    return counted.select("number_of_drifted_columns", "number_of_columns", part.alias("drift_share"),
                          (part >= share).alias("dataset_drift"), (part > alert).alias("alert"))


# --------------------------------------------------------------------------------------- others
def population_stability(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                         bins: int = PSI_BINS, alert: float = PSI_ALERT) -> DataFrame:
    """(column, psi, alert) over bins cut at the reference quantiles; an empty bin counts as 0.0001."""
    long = unpivot(_both_sides(reference, current, columns), columns, ["ref", "cur"])
    # Equal values share a bin, so they are summed before the bin is looked up.
    per_value = value_sums(long, "value", ["ref", "cur"], ["column"])
    shares = {f"q{i}": i / bins for i in range(1, bins)}
    in_reference = per_value.where("ref > 0").select("column", "value", F.col("ref").alias("n"))
    cuts = quantiles_of(in_reference, "value", shares, ["column"])
    cuts = cuts.select("column", F.array_distinct(F.array(*shares)).alias("_cuts"))
    binned = (per_value.join(F.broadcast(cuts), "column")
              .withColumn("bin", F.size(F.filter("_cuts", lambda c: c < F.col("value"))))
              .groupBy("column", "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))
    totals = binned.groupBy("column").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(part) > 0, F.col(part) / F.col(whole)).otherwise(ZERO_SHARE)

    p, q = share("ref", "n_ref"), share("cur", "n_cur")
    # One row per column.
    return (binned.join(F.broadcast(totals), "column")
            .groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))
            .select("column", "psi", (F.col("psi") > alert).alias("alert")))


def embedding_drift(reference: DataFrame, current: DataFrame, vector: str) -> DataFrame:
    """One row: Euclidean and cosine distance of the two mean vectors."""
    def mean(df: DataFrame, name: str) -> DataFrame:
        return (df.select(F.posexplode(vector).alias("pos", "x"))
                .groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias(name)))

    a, b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    both = mean(reference, "a").join(mean(current, "b"), "pos", "full")
    return both.agg(
        F.sqrt(F.sum((a - b) * (a - b))).alias("euclidean"),
        (1 - F.try_divide(F.sum(a * b), F.sqrt(F.sum(a * a)) * F.sqrt(F.sum(b * b)))).alias("cosine_distance"))


def quality_summary(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Column profiles of both tables side by side, ``ref_`` and ``cur_``."""
    def profile(df: DataFrame, prefix: str) -> DataFrame:
        text = qualitative_profile(df)
        numbers, _ = split_types(df)
        if numbers:
            extra = numeric_profile(df, numbers).drop("dtype", "null_count", "null_percent", "n_unique")
            text = text.join(extra, "column", "left")
        return text.withColumnsRenamed({c: f"{prefix}{c}" for c in text.columns if c != "column"})

    return profile(reference, "ref_").join(profile(current, "cur_"), "column", "full")


ship_with_tasks(sys.modules[__name__])
