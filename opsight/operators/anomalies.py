"""Metric anomaly detection on rolling statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from opsight.functions.scalar import case_ladder, clamp, finite_or_null, is_true, safe_ratio
from opsight.operators.ordered import over_chunks, over_frames
from opsight.operators.drift import long_features
from opsight.operators.quantiles import exact_quantiles
from opsight.operators.windows import guarded, rolling, rolling_zscore, sliding_quantiles, trailing


def detect_band(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str = "latency_ms",
    n: int = 24,
    factor: float = 2.5,
    **frames,
) -> DataFrame:
    """Outside mean +/- factor deviations of the trailing window; never before it is full."""
    out = rolling(df, keys, order, value, n, n, ("mean", "std"), prefix="_b", **frames)
    mean, std = F.col("_b_rolling_mean"), F.col("_b_rolling_std")
    return out.withColumns(
        {
            "rolling_mean": mean,
            "rolling_std": std,
            "upper_limit": mean + factor * std,
            "lower_limit": mean - factor * std,
            "is_anomaly": is_true((F.col(value) > mean + factor * std) | (F.col(value) < mean - factor * std)),
        }
    ).drop("_b_rolling_mean", "_b_rolling_std")


def signal_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    latency: str = "latency_ms",
    errors: str = "error_rate_pct",
    traffic: str = "request_count",
    minutes_since_change: str | None = "minutes_since_change",
    **frames,
) -> DataFrame:
    """z-score flags of three signals, their count, and whether a change is recent."""
    out = rolling_zscore(df, keys, order, [latency, errors, traffic], **frames)
    flags = {
        "latency_anomaly": is_true(F.col(f"{latency}_zscore") > 2.5),
        "error_anomaly": is_true(F.col(f"{errors}_zscore") > 2.5),
        "traffic_anomaly": is_true(F.abs(F.col(f"{traffic}_zscore")) > 2.8),
    }
    out = out.withColumns(flags).withColumn("signals_count", sum((F.col(f).cast("int") for f in flags), F.lit(0)))
    if minutes_since_change:
        out = out.withColumn("recent_change", is_true(F.col(minutes_since_change).between(0, 60)))
    return out


def dynamic_thresholds(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    latency: str = "latency_ms",
    errors: str = "error_rate",
    traffic: str = "request_count",
    short: int = 24,
    long: int = 288,
    **frames,
) -> DataFrame:
    """Thresholds per row from the last 2 and 24 hours of a 5-minute series, and the flags.

    Short and long frames share one chunk pass, hence one shuffle.
    """

    def exprs(w: WindowSpec) -> dict[str, Column]:
        s, lat = trailing(w, short), F.col(latency)

        return {
            "latency_mean_short": guarded(F.avg(lat), lat, s, short),
            "latency_std_short": guarded(F.stddev_samp(lat), lat, s, short),
        }

    quantiles = {
        "latency_p95_long": (latency, 0.95),
        "traffic_p05_long": (traffic, 0.05),
        "error_rate_p95_long": (errors, 0.95),
    }
    schema = ", ".join(f"{name} double" for name in quantiles)
    out = over_chunks(
        df, keys, order, sliding_quantiles(quantiles, long, long), schema, before=long - 1, exprs=exprs, **frames
    )
    # A float column comes back from pandas with NaN where there is no value.
    out = out.withColumns({name: finite_or_null(name) for name in quantiles})
    out = out.withColumn("latency_upper_std", F.col("latency_mean_short") + 3 * F.col("latency_std_short"))
    flags = {
        "latency_anomaly_std": F.col(latency) > F.col("latency_upper_std"),
        "latency_anomaly_p95": F.col(latency) > F.col("latency_p95_long") * 1.20,
        "traffic_drop_anomaly": F.col(traffic) < F.col("traffic_p05_long") * 0.70,
        "error_rate_anomaly": F.col(errors) > F.col("error_rate_p95_long") * 2.0,
    }
    out = out.withColumns({k: is_true(v) for k, v in flags.items()})
    score = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    return out.withColumn("anomaly_score", score).withColumn("is_anomaly", F.col("anomaly_score") > 0)


def anomaly_severity(df: DataFrame, environment: str = "environment") -> DataFrame:
    """Severity and action from the threshold flags; earlier rules win."""
    err, drop = F.col("error_rate_anomaly"), F.col("traffic_drop_anomaly")
    slow = F.col("latency_anomaly_std") | F.col("latency_anomaly_p95")
    quiet = ~F.col("is_anomaly")
    return df.withColumns(
        {
            "severity": case_ladder(
                [
                    (quiet, "NORMAL"),
                    (F.col("anomaly_score") >= 3, "HIGH"),
                    (err & (F.col(environment) == "prod"), "HIGH"),
                    (F.col("anomaly_score") == 2, "MEDIUM"),
                ],
                "LOW",
            ),
            "recommended_action": case_ladder(
                [
                    (quiet, ""),
                    (err & slow, "escalate_errors_with_latency"),
                    (drop, "check_traffic_entry"),
                    (err, "check_logs_and_deployments"),
                    (slow, "check_traces_and_dependencies"),
                ],
                "check_operational_behaviour",
            ),
        }
    )


def anomaly_score(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    latency: str = "latency_ms",
    errors: str = "error_rate",
    n: int = 24,
    **frames,
) -> DataFrame:
    """Score 0..100: relative excess over mean + 3 deviations, plus 60 for an error burst."""

    def exprs(w: WindowSpec) -> dict[str, Column]:
        f = trailing(w, n)
        lat, err = F.col(latency), F.col(errors)
        upper = F.avg(lat).over(f) + 3 * F.stddev_samp(lat).over(f)
        return {
            "_threshold": F.when(F.count(lat).over(f) >= n, upper),
            "error_rate_threshold": guarded(F.percentile(err, F.lit(0.95)), err, f, n) * 2,
        }

    out = over_frames(df, keys, order, exprs, before=n - 1, **frames)
    over = is_true(F.col(latency) > F.col("_threshold"))
    excess = safe_ratio(F.col(latency) - F.col("_threshold"), "_threshold") * 100
    latency_score = F.when(over, excess).otherwise(0.0)
    error_score = F.when(is_true(F.col(errors) > F.col("error_rate_threshold")), 60.0).otherwise(0.0)
    score = F.coalesce(clamp(latency_score + error_score, 0, 100), F.lit(0.0))
    return out.withColumns(
        {
            "anomaly_score": score,
            "is_anomaly": score >= 80,
            "latency_threshold": F.coalesce("_threshold", F.col(latency)),
        }
    ).drop("_threshold")


# Fixed values: (reason code, column role, quantile, side), in reporting order.
REASONS = (
    ("high_latency", "latency", 0.95, "high"),
    ("high_error_rate", "errors", 0.95, "high"),
    ("traffic_drop", "traffic", 0.05, "low"),
    ("high_cpu", "cpu", 0.95, "high"),
    ("high_memory", "memory", 0.95, "high"),
)


def explain_anomalies(
    df: DataFrame, flag: str, columns: dict[str, str], odd: str = "odd_combination"
) -> DataFrame:
    """Reasons and action of flagged rows, from quantiles of the whole input.

    ``columns`` maps the roles latency, errors, traffic, cpu and memory to column names. The
    quantiles come back as scalar subqueries, so the rows are read without any shuffle.
    """
    levels = sorted({q for _, _, q, _ in REASONS})
    table = exact_quantiles(long_features(df, list(columns.values())), ["feature"], "value", levels)
    # One row per role: a map of at most five entries.
    limits = table.agg(F.map_from_entries(F.collect_list(F.struct("feature", "quantiles"))).alias("m")).scalar()
    reasons = []
    for code, role, q, side in REASONS:
        limit = F.try_element_at("_limits", F.lit(columns[role]))[levels.index(q)]
        c = F.col(columns[role])
        hit = c >= limit if side == "high" else c <= limit
        reasons.append(F.when(is_true(hit), F.lit(code)))
    listed = F.array_compact(F.array(*reasons))
    out = df.withColumn("_limits", limits).withColumn("_reasons", F.when(F.col(flag), listed).otherwise(F.array().cast("array<string>")))

    def has(code: str) -> Column:
        return F.array_contains("_reasons", code)

    return out.withColumns(
        {
            "anomaly_reason": case_ladder(
                [(~F.col(flag), ""), (F.size("_reasons") == 0, odd)], F.array_join("_reasons", ", ")
            ),
            "recommended_action": case_ladder(
                [
                    (~F.col(flag), ""),
                    (has("high_error_rate"), "check_logs_and_deployments"),
                    (has("traffic_drop"), "check_traffic_entry"),
                    (has("high_cpu") | has("high_memory"), "check_saturation_and_scaling"),
                    (has("high_latency"), "check_dependencies_and_traces"),
                ],
                "correlate_with_events",
            ),
        }
    ).drop("_reasons", "_limits")


def anomaly_summary(df: DataFrame, flag: str = "is_anomaly", dims: Sequence[str] = ("service", "severity")) -> DataFrame:
    """Anomaly counts along each dimension, from one pass."""
    hits = df.filter(F.col(flag)).select(*dims)
    sets = hits.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("anomalies"), F.grouping_id().alias("_g")
    )
    names = {2 ** len(dims) - 1 - 2 ** (len(dims) - 1 - i): d for i, d in enumerate(dims)}
    dimension = case_ladder([(F.col("_g") == g, d) for g, d in names.items()], None)
    member = case_ladder([(F.col("_g") == g, F.col(d)) for g, d in names.items()], None)
    return sets.select(dimension.alias("dimension"), member.alias("member"), "anomalies")
