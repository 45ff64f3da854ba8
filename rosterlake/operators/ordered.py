"""Cumulative sums and exact quantiles without a single-task window.

A window ordered over a whole column puts all its rows into one task. Here equal values
are summed first, the distinct values are spread over buckets of about equal size, and
the running sum inside a bucket is shifted by the total of the buckets before it. The number
of buckets follows the number of distinct values.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, store

#: Distinct values that one task sorts, and the most buckets that one key is cut into.
BUCKET_ROWS = 200_000
MAX_BUCKETS = 16_384
#: Ranks of a sketch are right to one in so many.
ACCURACY = 10_000


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Rows ``(keep..., column, value)``, one per listed column."""
    cast = df.select(*keep, *[F.col(f"`{c}`").cast(dtype).alias(c) for c in columns])
    return cast.unpivot(list(keep), list(columns), "column", "value")


def value_sums(df: DataFrame, order: str, sums: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One stored row per distinct ``(keys, order)``; rows with a null order are left out.

    The raw rows are read once, with map-side combine; everything after reads this table.
    """
    present = df.where(F.col(order).isNotNull())
    return store(present.groupBy(*keys, order).agg(*[F.sum(s).alias(s) for s in sums]), "values")


def _bucket_cuts(values: DataFrame, keys: list[str], order: str, buckets: int) -> DataFrame:
    """Cut points per key that spread the distinct values evenly, however often a value occurs."""
    step = math.isqrt(buckets) + 1
    shares = [i / buckets for i in range(1, buckets)]
    cuts = F.array_distinct(F.percentile_approx(order, shares, buckets * 20))
    grouped = values.groupBy(*keys) if keys else values
    # Sketches may differ between two evaluations; both uses below must see the same cuts.
    return cut_lineage(grouped.agg(cuts.alias("_cuts"))).withColumn(
        "_coarse", F.filter("_cuts", lambda c, i: i % step == step - 1))


def _bucket(order: str, buckets: int) -> Column:
    """Number of cuts up to the value: every n-th cut first, then the cuts after the last of these.

    Never null: a null check of this expression would be pushed below the aggregation.
    """
    step = math.isqrt(buckets) + 1

    def upto(cuts) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= F.col(order)))

    passed = upto("_coarse") * step
    return F.coalesce(passed + upto(F.slice("_cuts", passed + 1, F.lit(step))), F.lit(0))


def _tagged(values: DataFrame, keys: list[str], order: str, buckets: int | None) -> DataFrame:
    """The values with the number of their bucket; as many buckets as the stored rows need."""
    if buckets is None:
        buckets = min(MAX_BUCKETS, -(-values.count() // BUCKET_ROWS))
    if buckets <= 1:
        return values.withColumn("_bucket", F.lit(0))
    cuts = _bucket_cuts(values, keys, order, buckets)
    tagged = values.join(cuts, keys) if keys else values.withColumns({c: cuts.select(c).scalar() for c in ("_cuts", "_coarse")})
    return tagged.withColumn("_bucket", _bucket(order, buckets)).drop("_cuts", "_coarse")


def running_totals(df: DataFrame, order: str, sums: Sequence[str], keys: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """One row per distinct ``(keys, order)`` with sums, running and overall totals.

    Columns: keys, ``order``, each sum ``s``, ``s_upto`` (including this value), ``s_total``
    and ``next_value`` (the following distinct value). Rows with a null order are left out.
    ``keys`` should have few distinct values (table columns, classes).
    """
    return running_totals_of(value_sums(df, order, sums, keys), order, sums, keys, buckets)


def running_totals_of(values: DataFrame, order: str, sums: Sequence[str], keys: Sequence[str] = (),
                      buckets: int | None = None) -> DataFrame:
    """:func:`running_totals` of a table from :func:`value_sums`."""
    keys = list(keys)
    tagged = _tagged(values, keys, order, buckets)
    place = [*keys, "_bucket"]
    per_bucket = tagged.groupBy(*place).agg(
        F.min(order).alias("_first"), *[F.sum(s).alias(f"_{s}") for s in sums])
    in_key = Window.partitionBy(*keys).orderBy("_bucket")
    before = in_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *place,
        F.lead("_first").over(in_key).alias("_next_first"),
        *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}_before") for s in sums],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_total") for s in sums])

    in_bucket = Window.partitionBy(*place).orderBy(order)
    upto = in_bucket.rowsBetween(Window.unboundedPreceding, 0)
    shifted = tagged.select(
        *place, order, *sums,
        F.lead(order).over(in_bucket).alias("_next"),
        *[F.sum(s).over(upto).alias(f"_{s}_upto") for s in sums])
    return shifted.join(offsets, place).select(
        *keys, order, *sums,
        *[(F.col(f"_{s}_upto") + F.col(f"_{s}_before")).alias(f"{s}_upto") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
        F.coalesce("_next", "_next_first").alias("next_value"))


def quantiles(df: DataFrame, order: str, shares: dict[str, float], keys: Sequence[str] = (),
              accuracy: int = ACCURACY) -> DataFrame:
    """Exact, linearly interpolated quantiles; ``shares`` maps output name to share. Null values are left out.

    A mergeable sketch per key brackets every wanted rank; what lies below a bracket is only counted, and nothing but
    the values inside (about 4 / ``accuracy`` of the rows per share) is shuffled and sorted. The counts prove that the
    ranks are inside; should a bracket miss one, all brackets are opened. ``keys`` should have few distinct values. The
    rows are read three times; give a stored table if they are costly to compute.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(order).alias("_value"), F.col(order).cast("double").alias("_number")).where("_value IS NOT NULL")
    around = probes(shares, accuracy)
    sketch = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx("_number", around, accuracy).alias("_probes"))
    ends = [F.lit(None).cast("double") if p in (0.0, 1.0) else F.col("_probes")[i] for i, p in enumerate(around)]
    brackets = cut_lineage(sketch.select(*keys, "_n", F.array(*ends[::2]).alias("_low"), F.array(*ends[1::2]).alias("_high")))
    found, missed = _in_brackets(rows, brackets, shares, keys)
    if missed:
        none = F.array(*[F.lit(None).cast("double")] * len(shares))
        found, _ = _in_brackets(rows, brackets.withColumns({"_low": none, "_high": none}), shares, keys)
    return found


def _in_brackets(rows: DataFrame, brackets: DataFrame, shares: dict[str, float], keys: list[str]) -> tuple[DataFrame, bool]:
    """The quantiles from the values inside the brackets, and whether a wanted rank is outside its bracket."""
    # one row per key
    joined = rows.join(F.broadcast(brackets), keys) if keys else rows.crossJoin(F.broadcast(brackets))
    number = F.col("_number")
    below = [F.coalesce(number < F.col("_low")[i], F.lit(False)) for i in range(len(shares))]
    inside = [~b & F.coalesce(number <= F.col("_high")[i], F.lit(True)) for i, b in enumerate(below)]
    position = [(F.col("_n") - 1) * F.lit(float(share)) for share in shares.values()]
    counts = cut_lineage(joined.groupBy(*keys).agg(F.first("_n").alias("_n"), *[F.count_if(x).alias(f"_{name}_{i}") for i in range(len(shares))
                                                                               for name, x in (("below", below[i]), ("inside", inside[i]))]))
    out_of = F.lit(False)
    for i, p in enumerate(position):
        out_of |= (F.floor(p) < F.col(f"_below_{i}")) | (F.ceil(p) >= F.col(f"_below_{i}") + F.col(f"_inside_{i}"))
    missed = not counts.where((F.col("_n") > 0) & out_of).isEmpty()
    hits = F.array_compact(F.array(*[F.when(x, F.lit(i)) for i, x in enumerate(inside)]))
    values = joined.select(*keys, "_value", F.explode(hits).alias("_share")).groupBy(*keys, "_share", "_value").agg(F.count("*").alias("n"))
    ranked = running_totals_of(store(values, "brackets"), "_value", ["n"], [*keys, "_share"])
    ranked = ranked.join(F.broadcast(counts), keys) if keys else ranked.crossJoin(F.broadcast(counts))
    measures, outputs = [], []
    for i, (name, p) in enumerate(zip(shares, position)):
        def value_at(rank: Column, i: int = i) -> Column:
            place = rank - F.col(f"_below_{i}")
            return F.max(F.when((F.col("_share") == i) & (F.col("n_upto") - F.col("n") <= place) & (place < F.col("n_upto")), F.col("_value")))

        measures += [value_at(F.floor(p)).alias(f"_low_{i}"), value_at(F.ceil(p)).alias(f"_high_{i}"), F.max(p - F.floor(p)).alias(f"_part_{i}")]
        outputs.append((F.col(f"_low_{i}") + (F.col(f"_high_{i}") - F.col(f"_low_{i}")) * F.col(f"_part_{i}")).alias(name))
    return ranked.groupBy(*keys).agg(*measures).select(*keys, *outputs), missed


def column_quantiles(df: DataFrame, groups: Mapping[str, Sequence[str]], sketches: Mapping[str, tuple[int, Sequence[float] | None]],
                     shares: Mapping[str, float], accuracy: int = ACCURACY) -> dict[str, dict[str, float | None]]:
    """Exact quantiles of many columns in one scan: column -> share name -> value.

    ``groups`` maps a type to the columns that are compared in it, ``sketches`` a column to its number of values and the
    sketched values at :func:`probes`. The brackets are literals, so the scan counts what is below them and writes what
    is inside; a bracket that missed its rank is opened and scanned again.
    """
    spark = df.sparkSession
    items = [(c, name, share) for c, (n, _) in sketches.items() if n for name, share in shares.items()]
    ends = {(c, name): tuple(None if p in (0.0, 1.0) else v for p, v in zip(pair, values))
            for c, (n, found) in sketches.items() if n
            for name, pair, values in zip(shares, _pairs(probes(shares, accuracy)), _pairs(found))}
    out: dict[str, dict[str, float | None]] = {c: dict.fromkeys(shares) for c in sketches}
    while items:
        below, inside, structs = [], [], []
        for j, (c, name, _) in enumerate(items):
            low, high = ends[c, name]
            number = F.col(f"`{c}`").cast("double")
            below.append(F.lit(False) if low is None else F.coalesce(number < F.lit(low), F.lit(False)))
            inside.append(number.isNotNull() & ~below[-1] & (F.lit(True) if high is None else number <= F.lit(high)))
            typed = [(F.col(f"`{c}`") if c in columns else F.lit(None)).cast(kind).alias(f"v{k}") for k, (kind, columns) in enumerate(groups.items())]
            structs.append(F.when(inside[-1], F.struct(F.lit(j).alias("item"), *typed)))
        seen = Observation()
        counted = df.observe(seen, *[F.count_if(x).alias(f"{kind}{j}") for kind, xs in (("b", below), ("i", inside)) for j, x in enumerate(xs)])
        rows = counted.select(F.explode(F.array_compact(F.array(*structs))).alias("x")).select("x.*")
        values = store(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "brackets")
        counts, wanted, missed = seen.get, [], []
        for j, (c, name, share) in enumerate(items):
            position = (sketches[c][0] - 1) * share
            first, last = math.floor(position) - counts[f"b{j}"], math.ceil(position) - counts[f"b{j}"]
            if first < 0 or last >= counts[f"i{j}"]:
                missed.append((c, name, share))
                ends[c, name] = (None, None)
            else:
                wanted.append((j, first, last, position - math.floor(position)))
        if wanted:
            # one row per column and share
            ranks = F.broadcast(spark.createDataFrame(wanted, "item int, _first bigint, _last bigint, _part double"))
            for k in range(len(groups)):
                own = values.where(F.col(f"v{k}").isNotNull()).select("item", F.col(f"v{k}").alias("value"), "n")
                at = lambda rank: F.max(F.when((F.col("n_upto") - F.col("n") <= rank) & (rank < F.col("n_upto")), F.col("value")))
                found = running_totals_of(own, "value", ["n"], ["item"]).join(ranks, "item").groupBy("item").agg(
                    at(F.col("_first")).alias("low"), at(F.col("_last")).alias("high"), F.max("_part").alias("part"))
                for r in found.select("item", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).cast("double").alias("value")).collect():
                    out[items[r["item"]][0]][items[r["item"]][1]] = r["value"]
        items = missed
    return out


def probes(shares: Mapping[str, float], accuracy: int = ACCURACY) -> list[float]:
    """The shares that bracket each wanted share, two each."""
    return [min(max(s + d, 0.0), 1.0) for s in shares.values() for d in (-2 / accuracy, 2 / accuracy)]


def _pairs(values: Sequence) -> list[tuple]:
    return list(zip(values[::2], values[1::2]))


def quantiles_of(values: DataFrame, order: str, shares: dict[str, float], keys: Sequence[str] = (),
                 buckets: int | None = None) -> DataFrame:
    """:func:`quantiles` of a table from :func:`value_sums` with the count ``n``.

    Buckets are counted first; only those that hold a wanted rank are sorted.
    """
    keys = list(keys)
    place = [*keys, "_bucket"]
    tagged = _tagged(values, keys, order, buckets)
    per_bucket = tagged.groupBy(*place).agg(F.sum("n").alias("_n"), F.count("*").alias("_values"))
    in_key, whole = Window.partitionBy(*keys).orderBy("_bucket"), Window.partitionBy(*keys)
    counted = per_bucket.select(
        *place, "_n", F.coalesce(F.sum("_n").over(in_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("n_total"), F.sum("_values").over(whole).alias("n_values"))
    position = {name: (F.col("n_total") - 1) * F.lit(float(share)) for name, share in shares.items()}
    ranks = F.array(*[side(p) for p in position.values() for side in (F.floor, F.ceil)])
    holds = F.exists(ranks, lambda k: (F.col("_before") <= k) & (k < F.col("_before") + F.col("_n")))
    sorted_in = Window.partitionBy(*place).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (tagged.join(counted.where(holds).drop("_n"), place)
              .withColumn("n_upto", F.sum("n").over(sorted_in) + F.col("_before")))

    def value_at(rank: Column) -> Column:
        inside = (F.col("n_upto") - F.col("n") <= rank) & (rank < F.col("n_upto"))
        return F.max(F.when(inside, F.col(order)))

    measures, outputs = [F.max("n_values").alias("n_values")], []
    for name, p in position.items():
        measures += [value_at(F.floor(p)).alias(f"_{name}_lo"), value_at(F.ceil(p)).alias(f"_{name}_hi"),
                     F.max(p - F.floor(p)).alias(f"_{name}_part")]
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outputs.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    return ranked.groupBy(*keys).agg(*measures).select(*keys, *outputs, "n_values")
