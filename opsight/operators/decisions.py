"""Decision policies: pure projections that run unchanged on batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.scalar import (
    ACTION_SEVERITY,
    EVENT_SEVERITY,
    TIER_SCORE,
    as_int,
    case_ladder,
    col,
    is_true,
    lookup,
    normalize_severity,
    safe_ratio,
    severity_rank,
    to_float_or,
    to_int_or,
)


def observation_severity(metric: Column | str, value: Column | str) -> Column:
    """Severity of a metric observation; each metric has its own limits."""
    m, v = col(metric), col(value)

    def ladder(critical: float, warning: float) -> Column:
        return case_ladder([(v >= critical, "critical"), (v >= warning, "warning")], "info")

    return case_ladder(
        [(m == "latency_ms", ladder(1500, 800)), (m == "error_rate", ladder(0.15, 0.05))], ladder(90, 75)
    )


def classify_event(df: DataFrame) -> DataFrame:
    """Incident type of a normalised log event."""
    slow, failing = F.col("latency_ms") > 4000, F.col("error_rate") > 0.20
    kind = case_ladder(
        [
            (slow & failing, "major_incident"),
            (slow, "performance_incident"),
            (failing, "reliability_incident"),
            (F.col("severity").isin("ERROR", "CRITICAL", "ALERT", "EMERGENCY"), "technical_incident"),
        ],
        "operational_event",
    )
    return df.withColumn("incident_type", kind).withColumn(
        "requires_attention", F.col("incident_type") != "operational_event"
    )


def event_features(df: DataFrame) -> DataFrame:
    """Numeric features of an enriched event; text fields are parsed tolerantly."""
    severity = normalize_severity("severity")
    latency, expected = to_int_or("latency_ms"), to_int_or("expected_latency_ms")
    errors, limit = to_float_or("error_rate"), to_float_or("max_error_rate")
    ratio = lambda n, d: F.bround(safe_ratio(n, d, 0.0), 4)
    return df.withColumns(
        {
            "severity_norm": severity,
            "severity_score": lookup(severity, EVENT_SEVERITY, 0),
            "is_prod": as_int(F.lower("environment") == "prod"),
            "service_tier_score": lookup(F.lower("service_tier"), TIER_SCORE, 1),
            "customer_facing_flag": as_int(F.col("customer_facing")),
            "maintenance_flag": as_int(F.col("maintenance_window")),
            "latency_value": latency,
            "error_value": errors,
            "latency_ratio": ratio(latency, expected),
            "error_ratio": ratio(errors, limit),
        }
    )


def gate() -> Column:
    """Whether an event with features is worth scoring."""
    return (
        F.col("severity_norm").isin("WARN", "ERROR", "CRITICAL")
        | (F.col("is_prod") == 1)
        | (F.col("service_tier_score") >= 3)
        | (F.col("latency_ratio") >= 2)
        | (F.col("error_ratio") >= 2)
    )


# Action of each priority.
PRIORITY_ACTION = {
    "P1": "page_owner_immediately",
    "P2": "create_incident_and_notify_owner",
    "P3": "monitor_and_group",
    "P4": "store_only",
}


def risk_rules(df: DataFrame) -> DataFrame:
    """Additive rule score, its priority, and the maintenance-window demotion."""
    step = lambda c, at, points: F.when(F.col(c) >= at, points).otherwise(0)
    score = (
        F.col("severity_score") * 12
        + F.col("is_prod") * 15
        + F.col("service_tier_score") * 8
        + F.col("customer_facing_flag") * 10
        + step("latency_ratio", 2, 15)
        + step("latency_ratio", 4, 20)
        + step("error_ratio", 2, 15)
        + step("error_ratio", 4, 20)
    )
    p = F.col("incident_probability")
    base, quiet = F.col("_base"), F.col("maintenance_flag") == 1
    return (
        df.withColumn("incident_probability", F.least(score / 100, F.lit(0.99)))
        .withColumn("_base", case_ladder([(p >= 0.90, "P1"), (p >= 0.75, "P2"), (p >= 0.55, "P3")], "P4"))
        .withColumns(
            {
                "predicted_incident_type": lookup(
                    "_base",
                    {"P1": "major_incident", "P2": "incident_candidate", "P3": "degradation_candidate"},
                    "operational_event",
                ),
                "predicted_priority": case_ladder([(quiet & (base == "P1"), "P2"), (quiet & (base == "P2"), "P3")], base),
                "priority_adjusted_reason": case_ladder(
                    [(quiet & base.isin("P1", "P2"), "maintenance_window_active")], "none"
                ),
            }
        )
        .withColumn("recommended_action", lookup("predicted_priority", PRIORITY_ACTION))
        .withColumn("incident_probability", F.bround(p, 4))
        .drop("_base")
    )


def score_events(df: DataFrame) -> DataFrame:
    """Gate, score and apply the non-production policy; one output record per event."""
    scored = risk_rules(event_features(df)).withColumn("_run", is_true(gate()))

    def gated(name: str, bypass: object) -> Column:
        return F.when(F.col("_run"), F.col(name)).otherwise(F.lit(bypass))

    decided = scored.withColumns(
        {
            "incident_probability": gated("incident_probability", 0.0),
            "predicted_priority": gated("predicted_priority", "P4"),
            "predicted_incident_type": gated("predicted_incident_type", "bypass"),
            "recommended_action": gated("recommended_action", "store_only"),
            "priority_adjusted_reason": gated("priority_adjusted_reason", "bypass_gating"),
            "prediction_source": F.when(F.col("_run"), "rules").otherwise("gating"),
            "prediction_status": F.when(F.col("_run"), "ok").otherwise("bypassed"),
        }
    )
    demote = (F.coalesce("environment", F.lit("")) != "prod") & (F.col("predicted_priority") == "P1")
    return decided.withColumns(
        {
            "final_priority": F.when(demote, "P2").otherwise(F.col("predicted_priority")),
            "final_action": F.when(demote, PRIORITY_ACTION["P2"]).otherwise(F.col("recommended_action")),
        }
    ).drop("_run")


def mitigation(df: DataFrame) -> DataFrame:
    """Mitigation decision of an anomaly; only the last rule may execute on its own."""
    kind = F.upper(F.coalesce("anomaly_type", F.lit("UNKNOWN")))
    severity = F.upper(F.coalesce("severity", F.lit("LOW")))
    rank = severity_rank(severity, ACTION_SEVERITY)
    score, errors = F.coalesce("anomaly_score", F.lit(0.0)), F.coalesce("error_rate", F.lit(0.0))
    latency = F.coalesce("latency_ms", F.lit(0.0))
    decision = lambda action, reason, nxt, execute=False: F.struct(
        F.lit(action).alias("action"),
        F.lit(execute).alias("allowed_to_execute"),
        F.lit(reason).alias("reason"),
        F.lit(nxt).alias("recommended_next_step"),
    )
    default_next = "review_dashboard_and_logs"
    rules = [
        (F.coalesce("environment", F.lit("unknown")) != "prod",
         decision("LOG_ONLY", "non_production_log_only", default_next)),
        ((kind == "ERROR_SPIKE") & (rank >= 3),
         decision("CREATE_INCIDENT_AND_RECOMMEND_ROLLBACK", "high_errors_rollback_needs_approval",
                  "review_deployment_and_prepare_rollback")),
        ((kind == "RESOURCE_SATURATION") & (rank >= 3),
         decision("RECOMMEND_SCALE_OUT", "saturation_no_automatic_scaling", "check_cost_limits_and_add_capacity")),
        ((kind == "TRAFFIC_DROP") & (score >= 75),
         decision("CHECK_TRAFFIC_ENTRYPOINTS", "traffic_drop_do_not_restart_backend", "check_entry_points")),
        ((kind == "LATENCY_DEGRADATION") & (latency > 0),
         decision("INVESTIGATE_LATENCY", "high_latency_needs_traces", "check_traces_and_dependencies")),
        ((score >= 90) & (errors >= 0.03),
         decision("CREATE_ALERT", "high_score_and_errors", "escalate_to_review", True)),
    ]
    picked = case_ladder(rules, decision("LOG_ONLY", "recorded_without_action", default_next))
    return df.withColumns({"anomaly_type": kind, "severity": severity, "_d": picked}).select(
        "*", "_d.*"
    ).drop("_d")


REQUIRED_DECISION = ("event_id", "correlation_id", "severity", "service")


def route_operation(df: DataFrame, required: Sequence[str] = REQUIRED_DECISION) -> DataFrame:
    """Operation for a decision by severity; an incomplete decision keeps its error instead."""
    error = case_ladder([(F.col(c).isNull(), f"missing {c}") for c in required], F.lit(None).cast("string"))
    critical, warning = F.col("severity") == "critical", F.col("severity") == "warning"
    path = lambda a, b, c: case_ladder([(critical, a), (warning, b)], c)
    return df.withColumn("error", error).withColumns(
        {
            "operation_id": F.concat(F.lit("op-"), F.col("event_id")),
            "environment": F.coalesce("environment", F.lit("unknown")),
            "recommended_operation": path("create_incident_candidate", "notify_team", "store_only"),
            "requires_human_review": path(True, False, False),
            "priority": path("P1", "P3", "P5"),
            "reason": F.concat(path("critical event in ", "warning event in ", "informative event in "), F.col("service")),
            "operation_status": F.lit("created"),
        }
    )


def critical_candidate(df: DataFrame) -> DataFrame:
    """Incident candidate of a critical observation."""
    return df.withColumns(
        {
            "action": F.lit("create_incident_candidate"),
            "requires_human_review": F.lit(True),
            "reason": F.concat(
                F.lit("critical event in "), F.coalesce("service", F.lit("unknown")), F.lit(": "),
                F.coalesce("metric", F.lit("unknown")), F.lit("="),
                F.coalesce(F.col("value").cast("string"), F.lit("unknown")),
            ),
        }
    )


def risk_band(p: Column | str, threshold: float = 0.70) -> dict[str, Column]:
    """Failure-risk band and its action."""
    c = col(p)
    ladder = lambda a, b, m, z: case_ladder([(c >= 0.85, a), (c >= threshold, b), (c >= 0.45, m)], z)
    return {
        "risk_level": ladder("CRITICAL", "HIGH", "MEDIUM", "LOW"),
        "recommended_action": ladder("open_preventive_incident", "notify_sre", "show_on_dashboard", "record_only"),
    }


def predictive_action(risk: str = "risk", impact: str = "impact", recent: str = "recent_deploy") -> Column:
    r = F.col(risk)
    return case_ladder(
        [
            ((r >= 0.80) & (F.col(impact) >= 5), "open_incident_and_diagnose"),
            ((r >= 0.70) & (F.col(recent) == 1), "review_change_and_create_ticket"),
            (r >= 0.50, "create_ticket_with_evidence"),
            (r >= 0.35, "watch_for_recurrence"),
        ],
        "no_action",
    )


def forecast_risk(value: str, upper: str, limit: float = 1000.0) -> Column:
    return case_ladder([(F.col(value) >= limit, "HIGH"), (F.col(upper) >= limit, "MEDIUM")], "LOW")


def review_flag(severity: str = "severity", confidence: str = "confidence", flag: str | None = None) -> Column:
    """Low confidence or a P1/P2 severity forces human review."""
    forced = is_true(F.col(severity).isin("P1", "P2")) | (F.coalesce(F.col(confidence), F.lit(0.0)) < 0.65)
    return forced if flag is None else forced | is_true(F.col(flag))


def top_risk(df: DataFrame, score: str, tiebreak: str, k: int, minimum: Column | None = None) -> DataFrame:
    """Highest scores first; planned as a per-task top-k."""
    rows = df if minimum is None else df.filter(minimum)
    return rows.orderBy(F.col(score).desc(), F.col(tiebreak)).limit(k)
