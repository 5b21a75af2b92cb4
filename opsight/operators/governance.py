"""Operating scorecard, change control, documentation checks and rightsizing plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.audit import classify_environment
from opsight.functions.nested import is_missing, map_diff, missing_paths
from opsight.functions.scalar import case_ladder, clamp, is_true, lookup, stable_id

# Weight of each subscore in the health score.
SCORE_WEIGHTS = {
    "reliability_score": 0.20,
    "recovery_score": 0.15,
    "response_score": 0.10,
    "alert_quality_score": 0.15,
    "change_governance_score": 0.15,
    "remediation_score": 0.10,
    "learning_score": 0.10,
    "improvement_debt_score": 0.05,
}

# Improvement areas in order of precedence, with the score below which each applies.
AREA_LIMITS = (
    ("reliability_score", 97, "SLO_REVIEW"),
    ("change_governance_score", 70, "CHANGE_GOVERNANCE"),
    ("alert_quality_score", 70, "REDUCE_ALERT_NOISE"),
    ("recovery_score", 60, "MTTR_REDUCTION"),
    ("remediation_score", 70, "REMEDIATION_REVIEW"),
    ("learning_score", 60, "IMPROVE_FEEDBACK_LOOP"),
    ("improvement_debt_score", 60, "REDUCE_OPERATIONAL_DEBT"),
)
AREA_ACTION = {
    "SLO_REVIEW": "review_slo_and_error_budget",
    "CHANGE_GOVERNANCE": "review_risky_changes_and_approvals",
    "REDUCE_ALERT_NOISE": "tune_thresholds_and_rules",
    "MTTR_REDUCTION": "review_detection_and_runbooks",
    "REMEDIATION_REVIEW": "check_remediation_effect",
    "IMPROVE_FEEDBACK_LOOP": "raise_feedback_coverage",
    "REDUCE_OPERATIONAL_DEBT": "prioritise_open_improvements",
}


def scorecard(df: DataFrame) -> DataFrame:
    """Eight subscores 0..100, their weighted sum, status, main area and action."""
    c = F.col
    scored = df.withColumns(
        {
            "reliability_score": clamp("slo_compliance_pct", 0, 100),
            "recovery_score": clamp(100 - c("avg_mttr_minutes"), 0, 100),
            "response_score": clamp(100 - c("avg_mtta_minutes") * 4, 0, 100),
            "alert_quality_score": clamp(100 - c("false_positive_pct") * 2, 0, 100),
            "change_governance_score": clamp(
                100 - c("high_risk_changes_30d") * 8 - c("changes_without_approval_30d") * 15, 0, 100
            ),
            "remediation_score": clamp("remediation_success_pct", 0, 100),
            "learning_score": clamp("feedback_coverage_pct", 0, 100),
            "improvement_debt_score": clamp(100 - c("open_improvement_items") * 5, 0, 100),
        }
    )
    health = sum((c(name) * w for name, w in SCORE_WEIGHTS.items()), F.lit(0.0))
    h = c("operational_health_score")
    return (
        scored.withColumn("operational_health_score", F.round(health, 2))
        .withColumn("operational_status", case_ladder([(h >= 85, "HEALTHY"), (h >= 70, "WATCH"), (h >= 55, "AT_RISK")],
                                                      "CRITICAL_ATTENTION"))
        .withColumn("primary_improvement_area",
                    case_ladder([(c(s) < lim, area) for s, lim, area in AREA_LIMITS], "CONTINUE_MONITORING"))
        .withColumn("recommended_action", lookup("primary_improvement_area", AREA_ACTION, "keep_monitoring"))
    )


DECISION_EVIDENCE = (
    "operational_health_score",
    "operational_status",
    "primary_improvement_area",
    "slo_compliance_pct",
    "avg_mttr_minutes",
    "false_positive_pct",
    "high_risk_changes_30d",
    "changes_without_approval_30d",
    "remediation_success_pct",
    "feedback_coverage_pct",
    "open_improvement_items",
)


def decision_log(card: DataFrame, as_of: Column) -> DataFrame:
    """Log rows for services that need attention."""
    return card.filter(F.col("operational_status").isin("AT_RISK", "CRITICAL_ATTENTION")).select(
        F.concat(F.lit("DEC-"), F.upper(stable_id("service_name", as_of.cast("string"), length=12))).alias("decision_id"),
        as_of.alias("decision_ts"),
        "service_name",
        "owner_team",
        F.lit("OPERATING_REVIEW_ACTION").alias("decision_type"),
        F.concat(
            F.lit("Prioritise "), "primary_improvement_area", F.lit(" for "), "service_name",
            F.lit(" at health score "), F.format_string("%.2f", "operational_health_score"),
        ).alias("decision_summary"),
        F.to_json(F.struct(*DECISION_EVIDENCE)).alias("evidence_json"),
        F.lit("OPEN").alias("status"),
    )


def rightsizing_plan(
    df: DataFrame,
    as_of: Column | None = None,
    min_saving: float = 5.0,
    approve_prod: bool = True,
    allow_auto_dev: bool = True,
    auto_limit: float = 100.0,
) -> DataFrame:
    """Action plan of recommendations worth at least ``min_saving``."""
    saving = F.coalesce(F.col("estimated_monthly_saving"), F.lit(0.0))
    env, risk = F.col("environment"), F.col("risk")
    who = F.coalesce(F.col("recommender_id"), F.lit(""))
    plan = df.filter(saving >= min_saving).withColumn("environment", classify_environment("target_resource")).withColumn(
        "risk",
        case_ladder(
            [
                (env == "prod", "HIGH"),
                (who.contains("IdleResourceRecommender"), "MEDIUM"),
                (who.contains("MachineTypeRecommender"), "MEDIUM"),
                (who.contains("OverprovisionedRecommender"), "HIGH"),
                (is_true(F.upper("subtype").contains("ENDPOINT")), "HIGH"),
            ],
            "MEDIUM",
        ),
    )
    mode = case_ladder(
        [
            ((env == "prod") & F.lit(approve_prod), "MANUAL_APPROVAL"),
            ((env == "dev") & F.lit(allow_auto_dev) & risk.isin("LOW", "MEDIUM") & (saving <= auto_limit),
             "AUTO_ELIGIBLE_DRY_RUN"),
            (risk == "HIGH", "MANUAL_APPROVAL"),
        ],
        "SEMI_AUTOMATIC",
    )
    out = plan.withColumn("automation_mode", mode).withColumns(
        {
            "estimated_monthly_saving": F.bround(saving, 4),
            "approval_required": F.col("automation_mode").isin("MANUAL_APPROVAL", "SEMI_AUTOMATIC"),
            "status": F.when(F.col("automation_mode") == "AUTO_ELIGIBLE_DRY_RUN", "DRY_RUN_ONLY").otherwise("PROPOSED"),
            "apply_changes": F.lit(False),
            "rollback_required": F.lit(True),
        }
    )
    if as_of is None:
        return out
    return out.withColumns({"plan_id": stable_id("recommendation_name", as_of.cast("string"), length=32), "created_at": as_of})


CHANGE_FIELDS = (
    "change_id", "title", "environment", "change_type", "requested_by", "owner_functional", "owner_technical", "reason",
    "affected_resources", "before", "after", "test_plan", "rollback_plan",
)
CRITICAL_TYPES = ("model_deployment", "automation", "iam", "workflow")
TICKET_ACTIONS = ("create_ticket", "automatic_remediation")
# Risk points of a changed setting.
CHANGE_POINTS = {"model_version": 2, "threshold": 2, "action": 3, "service_account_role": 3}


def change_control(
    df: DataFrame,
    required: Sequence[str] = CHANGE_FIELDS,
    functional: str = "owner_functional",
    operations: str = "sre_operations",
    security: str = "security",
) -> DataFrame:
    """Risk, differences, blockers, warnings and decision of a change request.

    ``before`` and ``after`` are string maps; approvals, rollback plan and evidence are arrays.
    """
    env, kind = F.lower(F.coalesce("environment", F.lit(""))), F.lower(F.coalesce("change_type", F.lit("")))
    none = F.array().cast("array<string>")
    array = lambda c: F.coalesce(F.col(c), none)
    old = lambda k: F.try_element_at("before", F.lit(k))
    new = lambda k: F.try_element_at("after", F.lit(k))
    action = new("action")
    tickets, automatic = is_true(action.isin(*TICKET_ACTIONS)), is_true(action == "automatic_remediation")
    points = lambda cond, n: F.when(is_true(cond), n).otherwise(0)
    score = (
        points(env == "prod", 3)
        + points(kind.isin(*CRITICAL_TYPES), 2)
        + sum((points(~old(k).eqNullSafe(new(k)), n) for k, n in CHANGE_POINTS.items()), F.lit(0))
        + points(tickets, 3)
        + points(automatic, 4)
    )
    risk = F.col("calculated_risk")
    text = lambda cond, message: F.when(is_true(cond), F.lit(message))
    approved = lambda who: F.array_contains(array("approvals"), who)
    # Every difference that mentions a watched setting adds its own entry.
    mentions = lambda item, word, message: F.when(F.contains(item, F.lit(word)), F.lit(message))
    prod = env == "prod"
    listed = df.withColumns(
        {
            "risk_points": score,
            "calculated_risk": case_ladder([(score <= 2, "low"), (score <= 5, "medium"), (score <= 9, "high")], "critical"),
            "diff_summary": map_diff("before", "after"),
            "_missing": F.transform(missing_paths(df, required), lambda p: F.concat(F.lit("missing field: "), p)),
        }
    )
    blockers = F.array_compact(
        F.array(
            text(risk.isin("high", "critical") & (F.size(array("rollback_plan")) == 0), "rollback plan required"),
            text(prod & (F.size(array("evidence")) == 0), "production change needs evidence"),
            text(prod & ~approved(functional), "functional owner approval required"),
            text(tickets & ~approved(operations), "operations approval required"),
            text(automatic & ~approved(security), "security approval required"),
        )
    )
    role = F.array_compact(
        F.transform("diff_summary", lambda i: mentions(i, "service_account_role", "role change needs security review"))
    )
    warnings = F.array_compact(
        F.concat(
            F.array(text(automatic & (risk != "critical"), "automatic remediation is normally critical")),
            F.flatten(
                F.transform(
                    "diff_summary",
                    lambda i: F.array(
                        mentions(i, "threshold", "threshold change: check alert volume"),
                        mentions(i, "model_version", "model change: check metrics and rollback"),
                    ),
                )
            ),
        )
    )
    return (
        listed.withColumns({"blockers": F.concat("_missing", blockers, role), "warnings": warnings})
        .withColumn("decision", F.when(F.size("blockers") == 0, "ready_for_approval").otherwise("blocked"))
        .drop("_missing")
    )


DOCUMENT_PATHS = (
    "system.name", "system.environment", "system.criticality", "system.objective", "owners.functional",
    "owners.technical", "architecture.components", "data.dataset_uri", "data.label", "data.features", "model.id",
    "model.version", "model.metrics.precision", "model.metrics.recall", "operation.rollback",
    "governance.approval_status", "governance.next_review_date",
)


def doc_findings(
    df: DataFrame, paths: Sequence[str] = DOCUMENT_PATHS, critical: Sequence[str] = ("high", "critical")
) -> DataFrame:
    """Findings of a system document; an empty list means it passes."""
    size = lambda p: F.when(is_missing(df, p), 0).otherwise(F.size(p)) if not _absent(df, p) else F.lit(0)
    text = lambda p: F.lower(F.coalesce(F.col(p), F.lit(""))) if not _absent(df, p) else F.lit("")
    status = text("governance.approval_status")
    approved = status.isin("approved", "approved_for_review")
    checks = [
        (text("system.criticality").isin(*critical) & (size("governance.approved_by") < 2), "needs two approvers"),
        (approved & (F.length(F.trim(text("operation.rollback"))) < 20), "rollback not described"),
        (size("data.features") < 3, "few documented features"),
        (approved & (size("governance.evidence") == 0), "approved without evidence"),
    ]
    missing = F.transform(missing_paths(df, paths), lambda p: F.concat(F.lit("missing field: "), p))
    extra = F.array_compact(F.array(*[F.when(is_true(c), F.lit(m)) for c, m in checks]))
    return df.withColumn("findings", F.concat(missing, extra))


def _absent(df: DataFrame, path: str) -> bool:
    dtype = df.schema
    for part in path.split("."):
        if part not in getattr(dtype, "names", []):
            return True
        dtype = dtype[part].dataType
    return False
