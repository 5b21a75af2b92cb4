"""Feature, prediction and performance drift."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.functions.scalar import case_ladder, col
from opsight.operators.quantiles import cumulate, distinct_counts, quantiles_of_ranks, splits_for
from opsight.session import materialise

PSI_WARNING, PSI_CRITICAL, MAE_FACTOR, EPSILON = 0.10, 0.25, 1.5, 0.0001


def long_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) rows; unknown values are left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def psi_level(psi: Column | str) -> Column:
    p = col(psi)
    return case_ladder([(p.isNull(), "unknown"), (p >= PSI_CRITICAL, "critical"), (p >= PSI_WARNING, "warning")], "ok")


def feature_counts(base: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each feature with their counts on both sides, written once.

    Means, bin edges, bin counts and distribution distances all come from this table, so the
    two inputs are read and shuffled a single time.
    """
    sides = long_features(base, columns).withColumn("side", F.lit("b")).unionByName(
        long_features(cur, columns).withColumn("side", F.lit("c"))
    )
    return materialise(
        distinct_counts(
            sides, ["feature"], "value",
            {"nb": F.count_if(F.col("side") == "b"), "nc": F.count_if(F.col("side") == "c")},
        ).drop("_n")
    )


def feature_ranks(base: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each feature with counts, running counts and totals of both sides, written once.

    Values are dealt to as many ranges as their number asks for and moved by (feature, range) once.
    Features are columns of the caller, so tables with some rows for each of them are broadcast.
    """
    counts = feature_counts(base, cur, columns)
    totals = counts.groupBy("feature").agg(F.sum("nb").alias("tb"), F.sum("nc").alias("tc"))
    ranked = cumulate(counts, ["feature"], "value", ["nb", "nc"], splits_for(counts.count() // max(1, len(columns))), few=True)
    return materialise(ranked.join(F.broadcast(totals), "feature"))


def psi(base: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per feature on baseline quantile bins.

    The last bin is closed. Current values outside the baseline range fall in no bin but stay
    in the denominator. Fewer than three distinct edges give 0, an empty side gives NULL.
    """
    return psi_of_ranks(feature_ranks(base, cur, columns), bins)


def psi_of_ranks(counts: DataFrame, bins: int = 10) -> DataFrame:
    baseline = counts.filter(F.col("nb") > 0).select(
        "feature", F.col("value").alias("_x"), F.col("nb").alias("_n"), F.col("cum_nb").alias("cum__n"), F.col("tb").alias("_total"))
    edges = quantiles_of_ranks(baseline, ["feature"], [i / bins for i in range(bins + 1)]).select(
        "feature", F.array_sort(F.array_distinct("quantiles")).alias("edges")
    )
    # One edge row per feature, at most as many as there are columns.
    placed = counts.join(F.broadcast(edges), "feature", "left")
    v, last = F.col("value"), F.element_at("edges", -1)
    below = F.size(F.filter("edges", lambda e: e <= v)) - 1
    bin_no = F.when(v == last, F.size("edges") - 2).when((below >= 0) & (v < last), below)
    binned = placed.withColumn("bin", bin_no).groupBy("feature", "bin").agg(
        F.sum("nb").alias("nb"), F.sum("nc").alias("nc"), F.max(F.size("edges")).alias("n_edges")
    )
    # At most one row per bin and feature from here on; the row without a bin holds the
    # values outside the baseline range. A bin empty on both sides would add nothing.
    whole = Window.partitionBy("feature")
    share = lambda n: F.when(F.col(n) == 0, F.lit(EPSILON)).otherwise(
        F.try_divide(F.col(n), F.sum(n).over(whole))
    )
    terms = binned.withColumns({"pb": share("nb"), "pc": share("nc")})
    summed = F.sum(F.when(F.col("bin").isNotNull(), (F.col("pc") - F.col("pb")) * F.log(F.col("pc") / F.col("pb"))))
    return terms.groupBy("feature").agg(
        F.when((F.sum("nb") == 0) | (F.sum("nc") == 0), F.lit(None).cast("double"))
        .when(F.max("n_edges") < 3, F.lit(0.0))
        .otherwise(summed)
        .alias("psi")
    )


#: Rows of the larger side up to which the p-value is exact.
EXACT = 10_000


def ks_2samp(base: DataFrame, cur: DataFrame, columns: Sequence[str], exact: int = EXACT) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature with its two-sided p-value.

    The p-value is exact where neither side has more than ``exact`` rows, asymptotic otherwise.
    """
    return ks_of_ranks(feature_ranks(base, cur, columns), exact)


def paths_beyond(n: int, m: int, reach: int) -> float:
    """Share of the orders of n and m values in which some |i m - j n| reaches ``reach``: P(D >= reach / (n m)).

    Orders are lattice paths from (0, 0) to (n, m). Diagonal by diagonal, each point has the chance
    that a random path passes it without having left the band; what steps out of the band adds up
    to the answer, so small chances keep their digits.
    """
    i = np.arange(n + 1)
    at, out = np.zeros(n + 1), 0.0
    at[0] = 1.0 if reach > 0 else 0.0
    out = 1.0 - at[0]
    for k in range(1, n + m + 1):
        # The paths at (i, k - 1 - i) go on to i + 1 or stay at i, as many values of each side are left.
        left = n + m - k + 1
        new = at * np.clip(m - (k - 1 - i), 0, None) / left
        new[1:] += at[:-1] * (n - i[:-1]) / left
        beyond = np.abs(i * m - (k - i) * n) >= reach
        out += float(new[beyond].sum())
        new[beyond] = 0.0
        at = new
    return min(1.0, out)


def ks_of_ranks(ranked: DataFrame, exact: int = EXACT) -> DataFrame:
    gap = F.abs(F.try_divide("cum_nb", "tb") - F.try_divide("cum_nc", "tc"))
    # The same gap in whole numbers, for the path count; it is used for small sides only.
    apart = F.abs(F.col("cum_nb") * F.col("tc") - F.col("cum_nc") * F.col("tb"))
    small = F.greatest("tb", "tc") <= exact
    stats = ranked.groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"), F.max("tb").alias("tb"), F.max("tc").alias("tc"),
        F.max(F.when(small, apart)).alias("reach")
    )
    if exact > 0:
        # One row for each feature.
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist()
                p = [paths_beyond(r["tb"], r["tc"], r["reach"]) if r["reach"] is not None and min(r["tb"], r["tc"]) > 0 else None
                     for r in rows]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, "exact_p"])

        stats = stats.mapInArrow(count, "feature string, ks_statistic double, tb long, tc long, reach long, exact_p double")
    else:
        stats = stats.withColumn("exact_p", F.lit(None).cast("double"))
    tb, tc = F.col("tb").cast("double"), F.col("tc").cast("double")
    lam = F.sqrt(F.try_divide(tb * tc, tb + tc)) * F.col("ks_statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * F.col("_l") * F.col("_l")),
    )
    p = F.when(F.col("_l") < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return stats.withColumn("_l", lam).withColumn("ks_pvalue", F.coalesce("exact_p", p)) \
        .select("feature", "ks_statistic", "ks_pvalue")


def drift_report(base: DataFrame, cur: DataFrame, columns: Sequence[str], exact: int = EXACT) -> DataFrame:
    """Means, PSI and KS of each feature, all from one table of running counts."""
    ranked = feature_ranks(base, cur, columns)
    mean = lambda n: F.try_divide(F.sum(F.col("value") * F.col(n)), F.sum(n))
    means = ranked.groupBy("feature").agg(mean("nb").alias("baseline_mean"), mean("nc").alias("current_mean"))
    joined = means.join(psi_of_ranks(ranked), "feature").join(ks_of_ranks(ranked, exact), "feature")
    return joined.withColumn("mean_diff", F.col("current_mean") - F.col("baseline_mean")).withColumn(
        "psi_level", psi_level("psi")
    )


def drift_action(
    features: DataFrame,
    base: DataFrame,
    cur: DataFrame,
    y: str,
    yhat: str,
) -> DataFrame:
    """One row: prediction drift, error growth and what to do about them."""
    pred = psi(base, cur, [yhat]).select("psi").scalar()
    mae = lambda df: df.agg(F.avg(F.abs(F.col(y) - F.col(yhat))).alias("m")).scalar()
    critical = F.sort_array(F.collect_list(F.when(F.col("psi_level") == "critical", F.col("feature"))))
    warning = F.sort_array(F.collect_list(F.when(F.col("psi_level") == "warning", F.col("feature"))))
    row = features.agg(
        F.array_join(critical, ",").alias("critical_features"), F.array_join(warning, ",").alias("warning_features")
    ).withColumns({"prediction_psi": pred, "baseline_mae": mae(base), "current_mae": mae(cur)})
    row = row.withColumn(
        "mae_degradation_factor", F.col("current_mae") / F.greatest(F.col("baseline_mae"), F.lit(0.0001))
    ).withColumn("_p", psi_level("prediction_psi"))
    broken = F.col("mae_degradation_factor") >= MAE_FACTOR
    strong = (F.col("critical_features") != "") | (F.col("_p") == "critical")
    mild = (F.col("warning_features") != "") | (F.col("_p") == "warning")
    pick = lambda a, b, c, d: case_ladder([(broken, a), (strong, b), (mild, c)], d)
    return row.withColumns(
        {
            "severity": pick("critical", "high", "medium", "low"),
            "action": pick("retrain_required", "review_and_prepare_retraining", "increase_monitoring",
                           "continue_monitoring"),
        }
    ).drop("_p")
