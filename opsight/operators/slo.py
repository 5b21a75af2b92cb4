"""Service level objectives and error budgets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from opsight.functions.scalar import case_ladder, safe_ratio
from opsight.operators.quantiles import discrete_quantiles, distinct_counts
from opsight.session import materialise


@dataclass(frozen=True)
class Objectives:
    """Fixed values of the request service levels."""

    availability: float = 0.995
    latency: float = 0.950
    combined: float = 0.990
    slow_ms: int = 500
    warning_at: float = 0.75


def latency_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles: the smallest value that at least that share of the rows does not exceed."""
    # Read several times: groups, split points, ranks and totals.
    counts = materialise(distinct_counts(df, keys, value))
    return _with_quantiles(counts.select(*keys).distinct(), counts, keys, value, quantiles)


def _with_quantiles(groups: DataFrame, counts: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """The groups and their quantiles; a group without a value has none."""
    found = discrete_quantiles(counts, keys, value, quantiles)
    return groups.withColumn("_key", F.struct(*keys)).join(found, "_key", "left").drop("_key")


def daily_slo(
    df: DataFrame,
    slo: Objectives = Objectives(),
    ts: str = "event_ts",
    service: str = "service_name",
    status: str = "status_code",
    latency: str = "latency_ms",
) -> DataFrame:
    """Daily indicators with exact latency quantiles, error budget and status per service, from counts per latency."""
    up, fast, keys = F.col(status) < 500, F.col(latency) <= slo.slow_ms, ["event_date", service]
    counted = {
        "availability_good_requests": F.count_if(up),
        "latency_good_requests": F.count_if(fast),
        "combined_good_requests": F.count_if(up & fast),
        "server_errors": F.count_if(F.col(status) >= 500),
        "slow_requests": F.count_if(F.col(latency) > slo.slow_ms),
    }
    counts = materialise(distinct_counts(df.withColumn("event_date", F.to_date(ts)), keys, latency, counted))
    sums = counts.groupBy(*keys).agg(F.sum("_n").alias("total_requests"), *[F.sum(c).alias(c) for c in counted])
    base = _with_quantiles(sums, counts, keys, latency, {"latency_p95_ms": 0.95, "latency_p99_ms": 0.99})
    total = F.col("total_requests")
    calculated = base.withColumns(
        {
            "availability_sli": safe_ratio("availability_good_requests", total),
            "latency_sli": safe_ratio("latency_good_requests", total),
            "combined_sli": safe_ratio("combined_good_requests", total),
            "availability_slo": F.lit(slo.availability),
            "latency_slo": F.lit(slo.latency),
            "combined_slo": F.lit(slo.combined),
            # Scaled before subtracting so that the allowed share is an exact decimal.
            "error_budget_allowed": total * F.lit(round(1 - slo.combined, 12)),
            "bad_events": total - F.col("combined_good_requests"),
        }
    )
    used = safe_ratio("bad_events", "error_budget_allowed")
    return calculated.withColumn("budget_consumed_ratio", used).withColumn(
        "slo_status",
        case_ladder(
            [(F.col("combined_sli") < slo.combined, "VIOLATION"), (used >= slo.warning_at, "WARNING")], "OK"
        ),
    )
