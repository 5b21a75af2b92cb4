"""Decision policy queries."""

from pyspark.sql import functions as F

from opsight.operators import decisions as D
from opsight.plans.registry import query
from opsight.plans.scalars import NORMAL



def events_sql() -> str:
    return """
j AS (SELECT event_id, raw, CASE WHEN json_valid(raw) THEN raw END AS d FROM messages),
n AS (SELECT event_id, raw, d IS NULL AS bad, json_extract_string(d, '$.jsonPayload.service_name') AS service_name,
        json_extract_string(d, '$.jsonPayload.event_type') AS event_type,
        coalesce(json_extract_string(d, '$.severity'), 'DEFAULT') AS severity,
        json_extract_string(d, '$.resource.labels.project_id') AS project_id,
        coalesce(json_extract_string(d, '$.jsonPayload.environment'), 'unknown') AS environment,
        coalesce(TRY_CAST(json_extract_string(d, '$.jsonPayload.latency_ms') AS BIGINT), 0) AS latency_ms,
        coalesce(TRY_CAST(json_extract_string(d, '$.jsonPayload.error_rate') AS DOUBLE), 0.0) AS error_rate,
        coalesce(json_extract_string(d, '$.jsonPayload.aiops_candidate') = 'true', false) AS aiops_candidate FROM j)"""


GOOD = "NOT bad AND service_name IS NOT NULL AND event_type IS NOT NULL"


@query("parse_stream", f"""
WITH {events_sql().strip()}
SELECT event_id, service_name, event_type, severity, project_id, environment, latency_ms, error_rate, aiops_candidate
FROM n WHERE {GOOD}""")
def parse_events(t):
    from opsight.streaming.parse import normalised, parse_messages

    df = normalised(parse_messages(t.messages, "raw"))
    return df.select("event_id", "service_name", "event_type", "severity", "project_id", "environment", "latency_ms",
                     "error_rate", "aiops_candidate")


@query("dead_letters", f"""
WITH {events_sql().strip()}
SELECT event_id, raw AS raw_message, CASE WHEN bad THEN 'invalid JSON'
  ELSE 'missing mandatory field: service_name or event_type' END AS error_message FROM n WHERE NOT ({GOOD})""")
def dead_letters(t):
    from opsight.streaming.parse import dead_letters as dead, parse_messages

    return dead(parse_messages(t.messages, "raw")).select("event_id", "raw_message", "error_message")


@query("classify_event", f"""
WITH {events_sql().strip()},
c AS (SELECT event_id, CASE WHEN latency_ms > 4000 AND error_rate > 0.2 THEN 'major_incident'
        WHEN latency_ms > 4000 THEN 'performance_incident' WHEN error_rate > 0.2 THEN 'reliability_incident'
        WHEN severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY') THEN 'technical_incident'
        ELSE 'operational_event' END AS incident_type FROM n WHERE {GOOD})
SELECT event_id, incident_type, incident_type <> 'operational_event' AS requires_attention FROM c""")
def classify_event(t):
    from opsight.streaming.parse import normalised, parse_messages

    return D.classify_event(normalised(parse_messages(t.messages, "raw"))).select(
        "event_id", "incident_type", "requires_attention")


FEATURES = f"""
f0 AS (SELECT *, {NORMAL} AS sev, coalesce(CAST(trunc(TRY_CAST(latency_ms AS DOUBLE)) AS BIGINT), 0) AS lat,
         coalesce(TRY_CAST(error_rate AS DOUBLE), 0.0) AS err,
         coalesce(CAST(trunc(TRY_CAST(expected_latency_ms AS DOUBLE)) AS BIGINT), 0) AS exp_lat,
         coalesce(TRY_CAST(max_error_rate AS DOUBLE), 0.0) AS max_err FROM enriched),
f AS (SELECT event_id, environment, sev,
        CASE sev WHEN 'WARN' THEN 1 WHEN 'ERROR' THEN 3 WHEN 'CRITICAL' THEN 5 ELSE 0 END AS severity_score,
        CASE WHEN lower(environment) = 'prod' THEN 1 ELSE 0 END AS is_prod,
        CASE lower(service_tier) WHEN 'standard' THEN 2 WHEN 'critical' THEN 3 ELSE 1 END AS service_tier_score,
        CAST(customer_facing AS INTEGER) AS customer_facing_flag, CAST(maintenance_window AS INTEGER) AS maintenance_flag,
        round_even(CASE WHEN exp_lat = 0 THEN 0 ELSE lat / exp_lat END, 4) AS latency_ratio,
        round_even(CASE WHEN max_err = 0 THEN 0 ELSE err / max_err END, 4) AS error_ratio FROM f0),
g AS (SELECT *, sev IN ('WARN', 'ERROR', 'CRITICAL') OR is_prod = 1 OR service_tier_score >= 3 OR latency_ratio >= 2
        OR error_ratio >= 2 AS run,
        least((severity_score * 12 + is_prod * 15 + service_tier_score * 8 + customer_facing_flag * 10
          + CASE WHEN latency_ratio >= 2 THEN 15 ELSE 0 END + CASE WHEN latency_ratio >= 4 THEN 20 ELSE 0 END
          + CASE WHEN error_ratio >= 2 THEN 15 ELSE 0 END + CASE WHEN error_ratio >= 4 THEN 20 ELSE 0 END)
          / CAST(100 AS DOUBLE), CAST(0.99 AS DOUBLE)) AS p FROM f),
b AS (SELECT *, CASE WHEN p >= 0.9 THEN 'P1' WHEN p >= 0.75 THEN 'P2' WHEN p >= 0.55 THEN 'P3' ELSE 'P4' END AS base FROM g),
r AS (SELECT *, CASE WHEN maintenance_flag = 1 AND base = 'P1' THEN 'P2' WHEN maintenance_flag = 1 AND base = 'P2'
        THEN 'P3' ELSE base END AS pri FROM b)"""
ACTION = """CASE {p} WHEN 'P1' THEN 'page_owner_immediately' WHEN 'P2' THEN 'create_incident_and_notify_owner'
 WHEN 'P3' THEN 'monitor_and_group' ELSE 'store_only' END"""


@query("event_features", f"""
WITH {FEATURES.strip()}
SELECT event_id, severity_score, is_prod, service_tier_score, latency_ratio, error_ratio FROM f""")
def event_features(t):
    return D.event_features(t.enriched).select(
        "event_id", "severity_score", "is_prod", "service_tier_score", "latency_ratio", "error_ratio")


@query("gate", f"""
WITH {FEATURES.strip()}
SELECT event_id, run AS should_score FROM g""")
def gate(t):
    return D.event_features(t.enriched).select("event_id", D.gate().alias("should_score"))


@query("risk_rules", f"""
WITH {FEATURES.strip()}
SELECT event_id, round_even(p, 4) AS incident_probability, pri AS predicted_priority,
  CASE base WHEN 'P1' THEN 'major_incident' WHEN 'P2' THEN 'incident_candidate' WHEN 'P3' THEN 'degradation_candidate'
    ELSE 'operational_event' END AS predicted_incident_type,
  CASE WHEN maintenance_flag = 1 AND base IN ('P1', 'P2') THEN 'maintenance_window_active' ELSE 'none' END
    AS priority_adjusted_reason, {ACTION.format(p='pri')} AS recommended_action FROM r""")
def risk_rules(t):
    return D.risk_rules(D.event_features(t.enriched)).select(
        "event_id", "incident_probability", "predicted_priority", "predicted_incident_type", "priority_adjusted_reason",
        "recommended_action")


SCORE_SQL = f"""
WITH {FEATURES.strip()},
q AS (SELECT *, CASE WHEN run THEN pri ELSE 'P4' END AS pp FROM r)
SELECT event_id, CASE WHEN run THEN round_even(p, 4) ELSE 0.0 END AS incident_probability,
  CASE WHEN environment <> 'prod' AND pp = 'P1' THEN 'P2' ELSE pp END AS final_priority,
  CASE WHEN environment <> 'prod' AND pp = 'P1' THEN 'create_incident_and_notify_owner' WHEN NOT run THEN 'store_only'
    ELSE {ACTION.format(p='pri')} END AS final_action,
  CASE WHEN run THEN 'ok' ELSE 'bypassed' END AS prediction_status FROM q"""


@query("score_events", SCORE_SQL)
def score_events(t):
    return D.score_events(t.enriched).select(
        "event_id", "incident_probability", "final_priority", "final_action", "prediction_status")


MITIGATION_SQL = """
WITH a AS (SELECT *, CASE upper(severity) WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL'
   THEN 4 ELSE 0 END AS n FROM anomalies_in),
 d AS (SELECT *, CASE WHEN environment <> 'prod' THEN 'LOG_ONLY'
   WHEN anomaly_type = 'ERROR_SPIKE' AND n >= 3 THEN 'CREATE_INCIDENT_AND_RECOMMEND_ROLLBACK'
   WHEN anomaly_type = 'RESOURCE_SATURATION' AND n >= 3 THEN 'RECOMMEND_SCALE_OUT'
   WHEN anomaly_type = 'TRAFFIC_DROP' AND anomaly_score >= 75 THEN 'CHECK_TRAFFIC_ENTRYPOINTS'
   WHEN anomaly_type = 'LATENCY_DEGRADATION' AND latency_ms > 0 THEN 'INVESTIGATE_LATENCY'
   WHEN anomaly_score >= 90 AND error_rate >= 0.03 THEN 'CREATE_ALERT' ELSE 'LOG_ONLY' END AS action FROM a)
SELECT event_id, action, action = 'CREATE_ALERT' AS allowed_to_execute,
  CASE WHEN environment <> 'prod' THEN 'non_production_log_only'
   WHEN action = 'CREATE_INCIDENT_AND_RECOMMEND_ROLLBACK' THEN 'high_errors_rollback_needs_approval'
   WHEN action = 'RECOMMEND_SCALE_OUT' THEN 'saturation_no_automatic_scaling'
   WHEN action = 'CHECK_TRAFFIC_ENTRYPOINTS' THEN 'traffic_drop_do_not_restart_backend'
   WHEN action = 'INVESTIGATE_LATENCY' THEN 'high_latency_needs_traces'
   WHEN action = 'CREATE_ALERT' THEN 'high_score_and_errors' ELSE 'recorded_without_action' END AS reason FROM d"""


@query("mitigation", MITIGATION_SQL)
def mitigation(t):
    return D.mitigation(t.anomalies_in).select("event_id", "action", "allowed_to_execute", "reason")


OBS_SEVERITY = """CASE WHEN metric = 'latency_ms' THEN
   CASE WHEN value >= 1500 THEN 'critical' WHEN value >= 800 THEN 'warning' ELSE 'info' END
 WHEN metric = 'error_rate' THEN
   CASE WHEN value >= 0.15 THEN 'critical' WHEN value >= 0.05 THEN 'warning' ELSE 'info' END
 ELSE CASE WHEN value >= 90 THEN 'critical' WHEN value >= 75 THEN 'warning' ELSE 'info' END END"""
ROUTE_SQL = f"""
WITH o AS (SELECT *, {OBS_SEVERITY} AS severity FROM observations)
SELECT observation_no, 'op-' || event_id AS operation_id, coalesce(environment, 'unknown') AS environment,
  CASE WHEN event_id IS NULL THEN 'missing event_id' WHEN service IS NULL THEN 'missing service' END AS error,
  CASE severity WHEN 'critical' THEN 'create_incident_candidate' WHEN 'warning' THEN 'notify_team' ELSE 'store_only' END
    AS recommended_operation, severity = 'critical' AS requires_human_review,
  CASE severity WHEN 'critical' THEN 'P1' WHEN 'warning' THEN 'P3' ELSE 'P5' END AS priority,
  CASE severity WHEN 'critical' THEN 'critical event in ' WHEN 'warning' THEN 'warning event in '
    ELSE 'informative event in ' END || service AS reason FROM o"""


def observed(t):
    return t.observations.withColumn("severity", D.observation_severity("metric", "value"))


@query("route_operation", ROUTE_SQL)
def route_operation(t):
    return D.route_operation(observed(t)).select(
        "observation_no", "operation_id", "environment", "error", "recommended_operation", "requires_human_review",
        "priority", "reason")


@query("risk_band", """
SELECT event_no, CASE WHEN score >= 0.85 THEN 'CRITICAL' WHEN score >= 0.7 THEN 'HIGH' WHEN score >= 0.45 THEN 'MEDIUM'
   ELSE 'LOW' END AS risk_level,
  CASE WHEN score >= 0.85 THEN 'open_preventive_incident' WHEN score >= 0.7 THEN 'notify_sre'
   WHEN score >= 0.45 THEN 'show_on_dashboard' ELSE 'record_only' END AS recommended_action FROM predictions""")
def risk_band(t):
    return t.predictions.withColumns(D.risk_band("score")).select("event_no", "risk_level", "recommended_action")


@query("predictive_action", """
SELECT tiebreak, CASE WHEN r >= 0.8 AND i >= 5 THEN 'open_incident_and_diagnose'
   WHEN r >= 0.7 AND d = 1 THEN 'review_change_and_create_ticket' WHEN r >= 0.5 THEN 'create_ticket_with_evidence'
   WHEN r >= 0.35 THEN 'watch_for_recurrence' ELSE 'no_action' END AS action
FROM (SELECT tiebreak, CAST(tiebreak % 100 AS DOUBLE) / 100 AS r, tiebreak % 7 AS i, tiebreak % 2 AS d FROM metrics)""")
def predictive_action(t):
    m = t.metrics.select("tiebreak", ((F.col("tiebreak") % 100).cast("double") / 100).alias("risk"),
                         (F.col("tiebreak") % 7).alias("impact"), (F.col("tiebreak") % 2).alias("recent_deploy"))
    return m.select("tiebreak", D.predictive_action().alias("action"))


@query("review_flag", """
SELECT result_no, coalesce(json_extract_string(result_json, '$.severity') IN ('P1', 'P2'), false)
   OR coalesce(CAST(json_extract_string(result_json, '$.confidence') AS DOUBLE), 0) < 0.65 AS needs_human_review
FROM assistant_results""")
def review_flag(t):
    r = t.assistant_results.withColumn("r", F.from_json("result_json", "severity string, confidence double"))
    r = r.select("result_no", "r.*")
    return r.select("result_no", D.review_flag().alias("needs_human_review"))


@query("top_risk", """
SELECT event_no, service, score FROM predictions WHERE score >= 0.7 ORDER BY score DESC, event_no LIMIT 20""")
def top_risk(t):
    return D.top_risk(t.predictions, "score", "event_no", 20, F.col("score") >= 0.7).select("event_no", "service", "score")
