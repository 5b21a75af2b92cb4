"""Operational risk, incident correlation and the notification queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.nested import json_pick
from opsight.functions.scalar import QUEUE_SEVERITY, as_int, case_ladder, is_true, severity_rank, stable_id
from opsight.operators.joins import suppress_recent
from opsight.operators.windows import sessionize
from opsight.session import materialise


def operational_risk(
    df: DataFrame, signals: str = "signals_count", impact: str = "business_impact_score", recent: str = "recent_change"
) -> DataFrame:
    score = 2 * F.col(signals) + F.col(impact) + 2 * as_int(F.col(recent))
    return df.withColumn("risk_score", score).withColumn("is_candidate", is_true(F.col("risk_score") >= 7))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def candidate_sessions(
    scored: DataFrame, ts: str = "ts", gap_minutes: float = 10, bucket: str = "1 hour"
) -> DataFrame:
    """Candidates with their incident number.

    Candidates are a small share of the rows but the end of a long derivation, and session
    numbering reads them twice, so they are written once.
    """
    require_columns(scored, ["risk_score", "is_candidate"])
    candidates = materialise(scored.filter("is_candidate"))
    return sessionize(candidates, ts, gap_minutes, out="incident_number", bucket=bucket)


def correlate_incidents(
    sessions: DataFrame,
    ts: str = "ts",
    tiebreak: str = "tiebreak",
    service: str = "service",
    errors: str = "error_rate_pct",
    change_id: str = "last_change_id",
    owner: str = "owner_team",
) -> DataFrame:
    """One row per incident: root service, affected services, severity, evidence and action.

    Every aggregate combines on the map side. Affected services are bounded by the service
    catalogue. Change ids are not, so the incident carries their number and
    :func:`incident_changes` lists them one per row.
    """
    first = F.struct(F.col(ts), F.col(tiebreak))
    per_change = sessions.filter(F.col(change_id).isNotNull()).groupBy("incident_number", change_id).agg(
        F.lit(1).alias("_one")
    )
    changes = per_change.groupBy("incident_number").agg(F.count("_one").alias("change_count"))
    grouped = sessions.groupBy("incident_number").agg(
        F.min(ts).alias("start_ts"),
        F.max(ts).alias("end_ts"),
        F.min_by(F.struct(F.col(service).alias("s"), F.col(owner).alias("o")), first).alias("_root"),
        F.array_join(F.array_sort(F.collect_set(service)), ", ").alias("affected_services"),
        F.max("risk_score").alias("risk_score_max"),
        F.max(errors).alias("_max_error"),
    )
    joined = grouped.join(changes, "incident_number", "left").withColumn(
        "change_count", F.coalesce("change_count", F.lit(0))
    )
    severity = case_ladder(
        [
            ((F.col("risk_score_max") >= 10) | is_true(F.col("_max_error") >= 4), "P1"),
            (F.col("risk_score_max") >= 8, "P2"),
        ],
        "P3",
    )
    with_severity = joined.withColumn("severity", severity)
    evidence = F.concat_ws(
        "; ",
        F.concat(F.lit("first signal in "), F.col("_root.s")),
        F.concat(F.lit("affected services: "), F.col("affected_services")),
        F.concat(F.lit("risk_score_max="), F.col("risk_score_max").cast("string")),
        F.concat(F.lit("max_error_rate="), F.format_string("%.2f", F.col("_max_error")), F.lit("%")),
        F.when(F.col("change_count") > 0, F.concat(F.lit("recent changes: "), F.col("change_count").cast("string"))),
    )
    return with_severity.select(
        F.format_string("INC-%04d", F.col("incident_number")).alias("incident_id"),
        "start_ts",
        "end_ts",
        F.col("_root.s").alias("probable_root_service"),
        "affected_services",
        F.col("_root.o").alias("owner_team"),
        "severity",
        "risk_score_max",
        "change_count",
        evidence.alias("evidence"),
        case_ladder(
            [
                (F.col("severity") == "P1", "open_p1_incident_and_diagnose"),
                (F.col("severity") == "P2", "create_ticket_with_evidence"),
            ],
            "watch_for_recurrence",
        ).alias("recommended_action"),
    )


def incident_changes(sessions: DataFrame, change_id: str = "last_change_id") -> DataFrame:
    """Distinct recent changes of each incident, one per row."""
    return (
        sessions.filter(F.col(change_id).isNotNull())
        .select(F.format_string("INC-%04d", F.col("incident_number")).alias("incident_id"), F.col(change_id))
        .distinct()
    )


def open_incidents(
    df: DataFrame,
    k: int = 10,
    status: str = "status",
    severity: str = "severity",
    updated: str = "updated_ts",
    tiebreak: str = "incident_id",
    open_states: Sequence[str] = ("OPEN", "INVESTIGATING", "MITIGATING"),
) -> DataFrame:
    """Most urgent open incidents; planned as a per-task top-k, not a global sort."""
    rank = severity_rank(severity, QUEUE_SEVERITY, 1)
    return (
        df.filter(F.col(status).isin(*open_states))
        .orderBy(rank.desc(), F.col(updated).desc(), F.col(tiebreak))
        .limit(k)
    )


# Evidence keys shown in a notification.
EVIDENCE_KEYS = ("metric_name", "current_value", "predicted_value", "threshold", "confidence")
# One mark per severity.
SEVERITY_MARK = {"CRITICAL": "🚨", "HIGH": "⚠️", "WARNING": "🟠"}


def render_message(df: DataFrame, out: str = "message_text", evidence: str | None = None) -> DataFrame:
    """Notification text of an incident."""
    mark = case_ladder([(F.upper("severity") == s, m) for s, m in SEVERITY_MARK.items()], "ℹ️")
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    lines = [
        F.concat(mark, F.lit(" Incident "), show("severity"), F.lit(": "), show("alert_type"), F.lit(" in "),
                 show("service_name")),
        F.lit(""),
        F.concat(F.lit("Incident: "), show("incident_id")),
        F.concat(F.lit("Status: "), show("status")),
        F.concat(F.lit("Owner: "), show("owner_team")),
        F.concat(F.lit("Runbook: "), show("runbook")),
        F.lit(""),
        F.lit("Suggested commands:"),
        F.concat(F.lit("ack "), show("incident_id")),
        F.concat(F.lit("escalate "), show("incident_id")),
        F.concat(F.lit("block-deploys "), show("service_name")),
    ]
    if evidence:
        picked = json_pick(evidence, EVIDENCE_KEYS)
        lines.append(F.when(picked != "{}", F.concat(F.lit("\nEvidence:\n"), picked)))
    return df.withColumn(out, F.concat_ws("\n", *lines))


def notify_queue(
    incidents: DataFrame,
    log: DataFrame,
    as_of: Column,
    k: int = 10,
    minutes: int = 60,
    channel: str = "chat",
    log_ts: str = "created_ts",
) -> DataFrame:
    """Log rows to write for the open incidents not notified recently (dry run)."""
    picked = open_incidents(incidents, k)
    due = suppress_recent(picked, log, "incident_id", log_ts, "status", minutes, as_of)
    text = render_message(due)
    return text.select(
        F.concat(F.lit("NOTIF-"), F.upper(stable_id("incident_id", as_of.cast("string"), length=12))).alias(
            "notification_id"
        ),
        as_of.alias("created_ts"),
        "incident_id",
        "service_name",
        F.lit(channel).alias("channel"),
        F.lit("DRY_RUN").alias("status"),
        F.lit(True).alias("dry_run"),
        F.lit(None).cast("int").alias("response_code"),
        F.lit("dry run or no webhook").alias("error_message"),
        "message_text",
    )
