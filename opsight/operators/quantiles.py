"""Exact linear-interpolated quantiles without sorting a whole group in one task.

``percentile`` keeps every distinct value of a group in one buffer. Here a bounded sketch
first gives approximate split points, rows are counted per split range, and only the ranges
that contain a wanted rank are ordered. The sketch decides where to look, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.session import materialise

SPLITS = 256


def count_below(sorted_array: Column, v: Column, size: int) -> Column:
    """How many elements of an ascending array are smaller than ``v``: a binary search."""
    steps = []
    step = 1
    while step <= size:
        steps.insert(0, step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.coalesce(F.get(sorted_array, at + s - 1) < v, F.lit(False)), at + s).otherwise(at),
    )


#: Rows that a range is meant to have, and the bounds on the number of ranges.
RANGE_ROWS, LEAST_SPLITS, MOST_SPLITS = 100_000, 16, 4096


def splits_for(rows: int) -> int:
    """How many ranges so many rows are cut into."""
    return max(LEAST_SPLITS, min(MOST_SPLITS, -(-rows // RANGE_ROWS)))


def value_ranges(df: DataFrame, keys: Sequence[str], value: str, out: str, splits: int = SPLITS, few: bool = False) -> DataFrame:
    """Add the number of the split range each value falls in; ranges are ordered like values.

    Equal values always share a range. The split table has one row per key; it is broadcast where
    the caller knows the keys to be ``few``, as names of columns are.
    """
    grid = F.array(*[F.lit(i / splits) for i in range(1, splits)])
    v = F.col(value)
    if keys:
        table = df.groupBy(*keys).agg(F.percentile_approx(v, grid, F.lit(min(10_000, 40 * splits))).alias("_splits"))
        joined = df.join(F.broadcast(table) if few else table, list(keys))
    else:
        joined = df.withColumn("_splits", df.agg(F.percentile_approx(v, grid, F.lit(10_000)).alias("s")).scalar())
    return joined.withColumn(out, count_below(F.col("_splits"), v, splits)).drop("_splits")


def distinct_counts(df: DataFrame, keys: Sequence[str], value: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per key and distinct value with its count (combined on the map side)."""
    aggs = {"_n": F.count(F.lit(1)), **(extra or {})}
    return df.groupBy(*keys, value).agg(*[c.alias(n) for n, c in aggs.items()])


def cumulate(counts: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str], splits: int = SPLITS,
             few: bool = False) -> DataFrame:
    """Running totals of ``sums`` in value order, per key, as ``cum_<name>`` (current row included).

    Ordered inside each split range, plus the totals of the ranges before it.
    """
    ranged = value_ranges(counts, keys, value, "_range", splits, few)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_range", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_l_{s}": F.sum(s).over(inside) for s in sums})
    joined = local.join(F.broadcast(offsets) if few else offsets, [*keys, "_range"])
    return joined.withColumns({f"cum_{s}": F.col(f"_l_{s}") + F.col(f"_o_{s}") for s in sums}).drop(
        "_range", *[f"_l_{s}" for s in sums], *[f"_o_{s}" for s in sums]
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """One row per key with ``quantiles``: an array in the order of ``qs``."""
    known = df.select(*keys, F.col(value).cast("double").alias("_x")).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x")
    )
    # Read three times below: split points, ranks and totals.
    return quantiles_of_counts(materialise(distinct_counts(known, keys, "_x")), keys, qs)


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """The same from a table of distinct values ``_x`` and their counts ``_n``."""
    ranked = cumulate(counts, keys, "_x", ["_n"])
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total")) if keys else None
    sized = (
        ranked.join(totals, list(keys))
        if keys
        else ranked.withColumn("_total", counts.agg(F.sum("_n").alias("t")).scalar())
    )
    return quantiles_of_ranks(sized, keys, qs)


def quantiles_of_ranks(sized: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """The same where the running counts ``cum__n`` and the group's size ``_total`` are known."""
    # Ranks are 0-based; the value v covers ranks (cum - n) .. (cum - 1).
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("i"), (F.lit(float(q)) * (F.col("_total") - 1)).alias("at"))
            for i, q in enumerate(qs)
        ]
    )
    first, last = F.col("cum__n") - F.col("_n"), F.col("cum__n") - 1

    def covers(rank: Column) -> Column:
        return (rank >= first) & (rank <= last)

    hits = sized.withColumn(
        "_w", F.explode(F.filter(wanted, lambda w: covers(F.floor(w["at"])) | covers(F.ceil(w["at"]))))
    )
    lo = F.max(F.when(covers(F.floor("_w.at")), F.col("_x")))
    hi = F.max(F.when(covers(F.ceil("_w.at")), F.col("_x")))
    part = F.max(F.col("_w.at") - F.floor("_w.at"))
    per_q = hits.groupBy(*keys, F.col("_w.i").alias("_i")).agg((lo + (hi - lo) * part).alias("_q"))
    ordered = F.array_sort(F.collect_list(F.struct("_i", "_q")))
    return per_q.groupBy(*keys).agg(F.transform(ordered, lambda s: s["_q"]).alias("quantiles"))


def discrete_quantiles(counts: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row per key: the smallest value that at least that share of its rows does not exceed, by name.

    From a table of distinct values and their counts ``_n``. NULL values are left out, NULL keys are keys like others
    and come back in the one column ``_key``, a struct of the keys.
    """
    known = counts.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("_key"), value, "_n")
    totals = known.groupBy("_key").agg(F.sum("_n").alias("_total"))
    ranked = cumulate(known, ["_key"], value, ["_n"]).join(totals, "_key")

    def covers(q: float) -> Column:
        # Decimal arithmetic: 0.95 of 20 rows is rank 19, not one more.
        rank = F.greatest(F.lit(1), F.ceil(F.col("_total").cast("decimal(20,0)") * F.lit(Decimal(repr(q)))))
        return (rank <= F.col("cum__n")) & (rank > F.col("cum__n") - F.col("_n"))

    return ranked.groupBy("_key").agg(*[F.max(F.when(covers(q), F.col(value))).alias(n) for n, q in quantiles.items()])
