"""Incident KPIs, savings and executive reporting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from opsight.functions.scalar import as_int, case_ladder, minutes_between, safe_ratio
from opsight.operators.quality import long_rows


def incident_kpis(df: DataFrame, by: Sequence[str] = ("service", "severity", "environment")) -> DataFrame:
    """Mean detection, acknowledgement and resolution times, rates and a review score."""
    total = lambda c: F.sum(as_int(F.col(c)))
    kpis = df.groupBy(*by).agg(
        F.count("incident_id").alias("incidents"),
        F.avg(minutes_between("detected_at", "started_at")).alias("mttd_min"),
        F.avg(minutes_between("acknowledged_at", "detected_at")).alias("mtta_min"),
        F.avg(minutes_between("resolved_at", "started_at")).alias("mttr_min"),
        total("alert_generated").alias("alerts_generated"),
        total("alert_actionable").alias("actionable_alerts"),
        total("predicted").alias("predicted_incidents"),
        total("auto_remediation_attempted").alias("auto_attempts"),
        total("auto_remediation_success").alias("auto_successes"),
    ).withColumns(
        {
            "actionable_alert_rate": safe_ratio("actionable_alerts", "alerts_generated", 0.0),
            "prediction_coverage": safe_ratio("predicted_incidents", "incidents"),
            "auto_remediation_success_rate": safe_ratio("auto_successes", "auto_attempts", 0.0),
        }
    )
    score = (
        F.col("incidents") * 0.25
        + F.col("mttd_min") * 0.20
        + F.col("mtta_min") * 0.15
        + F.col("mttr_min") * 0.30
        + (1 - F.col("actionable_alert_rate")) * 20
    )
    return kpis.withColumn("operational_risk_score", score)


@dataclass(frozen=True)
class EconomicAssumptions:
    """Fixed values of the savings model (currency units per month or hour)."""

    hourly_cost: float = 65.0
    alert_review_minutes: float = 4.0
    manual_minutes_saved: float = 18.0
    platform_cost: float = 5200.0
    operations_cost: float = 3800.0
    initial_investment: float = 28000.0

    @property
    def monthly_cost(self) -> float:
        return self.platform_cost + self.operations_cost


def savings(df: DataFrame, a: EconomicAssumptions = EconomicAssumptions()) -> DataFrame:
    """Savings per service; the platform cost is shared by each one's part of the gross total."""
    c = F.col
    out = df.withColumns(
        {
            "incidents_avoided": c("baseline_incidents") - c("current_incidents"),
            "baseline_downtime_min": c("baseline_incidents") * c("baseline_avg_mttr_min"),
            "current_downtime_min": c("current_incidents") * c("current_avg_mttr_min"),
            "alerts_reduced": c("baseline_alerts") - c("current_alerts"),
            "automation_savings": c("automation_executions") * a.manual_minutes_saved * a.hourly_cost / 60,
            "cloud_savings": c("baseline_cloud_spend") - c("current_cloud_spend"),
        }
    )
    out = out.withColumn("downtime_min_reduced", c("baseline_downtime_min") - c("current_downtime_min")).withColumns(
        {
            "downtime_savings": c("downtime_min_reduced") * c("cost_per_downtime_min"),
            "alert_noise_savings": c("alerts_reduced") * a.alert_review_minutes * a.hourly_cost / 60,
        }
    )
    out = out.withColumn(
        "gross_savings",
        c("downtime_savings") + c("alert_noise_savings") + c("automation_savings") + c("cloud_savings"),
    )
    totals = out.agg(F.struct(F.sum("gross_savings").alias("g"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    shared = out.withColumn("_s", totals).withColumn(
        "allocated_cost",
        F.when(c("_s.g") > 0, c("gross_savings") / c("_s.g") * a.monthly_cost).otherwise(a.monthly_cost / c("_s.n")),
    )
    return (
        shared.withColumn("net_savings", c("gross_savings") - c("allocated_cost"))
        .withColumn("roi", F.when(c("allocated_cost") > 0, c("net_savings") / c("allocated_cost")))
        .drop("_s")
    )


def executive_summary(saved: DataFrame, a: EconomicAssumptions = EconomicAssumptions()) -> DataFrame:
    """Gross, cost, net, ROI and payback in long format."""
    cost = a.monthly_cost
    wide = saved.agg(F.sum("gross_savings").alias("g")).withColumn("net", F.col("g") - cost)
    roi = F.try_divide(F.col("net"), F.lit(cost if cost > 0 else None))
    payback = F.when(F.col("net") > 0, a.initial_investment / F.col("net"))
    rows = [
        ("gross_savings", F.col("g"), "%,.2f"),
        ("platform_cost", F.lit(cost), "%,.2f"),
        ("net_savings", F.col("net"), "%,.2f"),
        ("roi", roi, "%.2fx"),
        ("payback_months", payback, "%.2f months"),
    ]
    return long_rows(
        wide,
        [
            F.struct(F.lit(n).alias("metric"), F.round(v, 2).alias("value"), F.format_string(f, v).alias("value_text"))
            for n, v, f in rows
        ],
    )


BREAKDOWN = ("downtime_savings", "alert_noise_savings", "automation_savings", "cloud_savings")


def savings_breakdown(saved: DataFrame) -> DataFrame:
    wide = saved.agg(*[F.round(F.sum(c), 2).alias(c) for c in BREAKDOWN])
    total = sum((F.col(c) for c in BREAKDOWN), F.lit(0.0))
    return long_rows(
        wide,
        [
            F.struct(F.lit(c).alias("category"), F.col(c).alias("amount"),
                     F.round(safe_ratio(F.col(c), total) * 100, 2).alias("percent_of_gross"))
            for c in BREAKDOWN
        ],
    )


def savings_governance(saved: DataFrame, critical: Sequence[str] = ("high",)) -> DataFrame:
    n = F.col("baseline_incidents")
    return saved.withColumns(
        {
            "confidence_level": case_ladder(
                [(F.col("criticality").isin(*critical) & (n >= 15), "HIGH"), (n >= 10, "MEDIUM")], "LOW"
            ),
            "executive_note": case_ladder(
                [(F.col("net_savings") > 50000, "EXPAND"), (F.col("net_savings") > 15000, "CONSOLIDATE")], "REVIEW"
            ),
        }
    )
