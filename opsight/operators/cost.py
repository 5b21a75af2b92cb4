"""Cloud cost: roll-ups, shares, spikes, profiles and month projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.scalar import array_sum, case_ladder, is_true, safe_ratio
from opsight.operators.windows import prior_rolling


def billing_rollup(
    df: DataFrame,
    date: str = "usage_date",
    dims: Sequence[str] = ("source_project", "service", "sku"),
    cost: str = "cost",
    credits: str = "credits",
) -> DataFrame:
    """Gross cost, credits and net cost per day and dimension; credits are nested per row."""
    lines = df.withColumn("_credit", array_sum(credits, "amount"))
    if "source_project" in dims:
        lines = lines.withColumn("source_project", F.coalesce("source_project", F.lit("no_project")))
    return lines.groupBy(date, *dims).agg(
        F.sum(cost).alias("gross_cost"),
        F.sum("_credit").alias("credits"),
        (F.sum(cost) + F.sum("_credit")).alias("net_cost"),
    )


def service_share(df: DataFrame, date: str = "usage_date", cost: str = "net_cost") -> DataFrame:
    """Each row's share of its day. Days are few rows each once costs are rolled up."""
    total = df.groupBy(date).agg(F.sum(cost).alias("total_cost"))
    return df.join(total, date).withColumn("service_share", safe_ratio(cost, "total_cost"))


def daily_service_cost(df: DataFrame, date: str = "usage_date", service: str = "service") -> DataFrame:
    daily = df.groupBy(date, service).agg(
        F.sum("gross_cost").alias("gross_cost"),
        F.sum("credits").alias("credits"),
        F.sum("net_cost").alias("net_cost"),
    )
    return service_share(daily, date, "net_cost")


def cost_by_service(daily: DataFrame, service: str = "service") -> DataFrame:
    return daily.groupBy(service).agg(
        F.sum("net_cost").alias("total_cost"), F.avg("service_share").alias("avg_daily_share")
    )


def cost_by_day(daily: DataFrame, date: str = "usage_date") -> DataFrame:
    return daily.groupBy(date).agg(F.sum("net_cost").alias("total_cost"))


def cost_spikes(daily: DataFrame, date: str = "usage_date", days: int = 7, factor: float = 3.0) -> DataFrame:
    """Days whose total exceeds the mean of the prior week by three deviations.

    One row per day, so the single series is as long as the calendar.
    """
    totals = cost_by_day(daily, date).withColumns({"_all": F.lit(1), "_day": F.col(date).cast("timestamp")})
    out = prior_rolling(totals, ["_all"], ["_day"], "total_cost", days, days, prefix="cost", bucket="30 days")
    return (
        out.withColumn("threshold_high", F.col("cost_prior_mean") + factor * F.col("cost_prior_std"))
        .withColumn("is_spike", is_true(F.col("total_cost") > F.col("threshold_high")))
        .drop("_all", "_day")
    )


def training_series(
    df: DataFrame, date: str = "usage_date", service: str = "service", cost: str = "net_cost"
) -> DataFrame:
    known = df.filter(F.col(date).isNotNull() & F.col(service).isNotNull() & F.col(cost).isNotNull())
    return known.groupBy(date, service).agg(F.sum(cost).alias(cost)).filter(F.col(cost) >= 0)


def series_profile(
    df: DataFrame, key: str = "service", date: str = "usage_date", value: str = "net_cost", short: int = 30
) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
        F.sum(value).alias("total_cost"),
        F.avg(value).alias("avg_daily_cost"),
    ).withColumn("is_short", F.col("n_days") < short)


def month_to_date(df: DataFrame, date: str = "usage_date", cost: str = "net_cost") -> DataFrame:
    """Last day with data and the cost of its month so far."""
    latest = df.agg(F.max(date).alias("d")).scalar()
    in_month = F.col(date) >= F.trunc(latest, "MM")
    return df.agg(
        F.max(date).alias("last_actual_day"),
        F.sum(F.when(in_month, F.col(cost)).otherwise(F.lit(0.0))).alias("actual_month_cost"),
    )


def month_projection(
    actual: DataFrame,
    forecast: DataFrame,
    budget: float,
    date: str = "usage_date",
    cost: str = "net_cost",
    forecast_date: str = "forecast_date",
    forecast_cost: str = "forecast_cost",
    upper_cost: str = "upper_bound_cost",
    horizon: int = 14,
) -> DataFrame:
    """Month-end projection and its budget risk.

    The remaining days come from the forecast when its horizon reaches the month end, else
    from its daily mean. The upper bound decides the high risk, the estimate the medium one.
    """
    month = month_to_date(actual, date, cost).withColumn(
        "remaining_days", F.datediff(F.last_day("last_actual_day"), "last_actual_day")
    )
    last = actual.agg(F.max(date).alias("d")).scalar()
    daily = forecast.groupBy(F.col(forecast_date).alias("_d")).agg(
        F.sum(forecast_cost).alias("_f"), F.sum(upper_cost).alias("_u")
    )
    within = F.col("_d") <= F.last_day(last)
    ahead = daily.agg(
        F.coalesce(F.sum(F.when(within, F.col("_f"))), F.lit(0.0)).alias("f_sum"),
        F.coalesce(F.sum(F.when(within, F.col("_u"))), F.lit(0.0)).alias("u_sum"),
        F.avg("_f").alias("f_avg"),
        F.avg("_u").alias("u_avg"),
    )
    ahead_row = ahead.select(F.struct("*").alias("s")).scalar()

    def remaining(total: str, mean: str) -> Column:
        return case_ladder(
            [
                (F.col("remaining_days") <= 0, 0.0),
                (F.col("remaining_days") <= horizon, F.col(f"_a.{total}")),
            ],
            F.col(f"_a.{mean}") * F.col("remaining_days"),
        )

    projected = (
        month.withColumn("_a", ahead_row)
        .withColumn("forecast_remaining", remaining("f_sum", "f_avg"))
        .withColumn("_upper_remaining", remaining("u_sum", "u_avg"))
        .withColumn("projected_month_end", F.col("actual_month_cost") + F.col("forecast_remaining"))
        .withColumn("projected_month_end_upper", F.col("actual_month_cost") + F.col("_upper_remaining"))
        .drop("_a", "_upper_remaining")
    )
    return projected.withColumn("monthly_budget", F.lit(float(budget))).withColumn(
        "risk",
        case_ladder(
            [
                (F.col("projected_month_end_upper") >= budget * 1.10, "HIGH"),
                (F.col("projected_month_end") >= budget, "MEDIUM"),
            ],
            "LOW",
        ),
    )
