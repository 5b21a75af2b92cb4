"""Anomaly detection and incident correlation queries."""

from pyspark.sql import functions as F

from opsight.functions.scalar import minutes_between
from opsight.operators import anomalies as A, incidents as I, joins as J
from opsight.plans.joins import CATALOG, catalog_case
from opsight.plans.registry import query

KEYS, ORDER = ["service"], ["ts", "tiebreak"]
OVER = "PARTITION BY service ORDER BY ts, tiebreak"


def trail(n: int) -> str:
    return f"({OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query("detect_band", f"""
WITH r AS (SELECT tiebreak, latency_ms, count(*) OVER w AS n, avg(latency_ms) OVER w AS m, stddev_samp(latency_ms) OVER w AS s
           FROM metrics WINDOW w AS {trail(24)})
SELECT tiebreak, CASE WHEN n >= 24 THEN round(m + 2.5 * s, 6) END AS upper_limit,
       CASE WHEN n >= 24 THEN round(m - 2.5 * s, 6) END AS lower_limit,
       n >= 24 AND (latency_ms > m + 2.5 * s OR latency_ms < m - 2.5 * s) AS is_anomaly FROM r""")
def detect_band(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms")
    df = A.detect_band(m, KEYS, ORDER)
    return df.select("tiebreak", F.round("upper_limit", 6).alias("upper_limit"),
                     F.round("lower_limit", 6).alias("lower_limit"), "is_anomaly")


ZS = ", ".join(
    f"CASE WHEN count({c}) OVER w >= 20 THEN ({c} - avg({c}) OVER w) / nullif(stddev_samp({c}) OVER w, 0) END AS z_{a}"
    for c, a in (("latency_ms", "lat"), ("error_rate_pct", "err"), ("request_count", "req"))
)
SCORED = f"""
z AS (SELECT tiebreak, user_id, ts, service, error_rate_pct, {ZS} FROM metrics WINDOW w AS {trail(45)}),
x AS (SELECT z.*, c.change_id, date_diff('microsecond', c.change_ts, z.ts) / 6e7 AS mins
      FROM z ASOF LEFT JOIN changes c ON z.user_id = c.user_id AND z.ts >= c.change_ts),
s AS (SELECT *, CAST(coalesce(z_lat > 2.5, false) AS INTEGER) + CAST(coalesce(z_err > 2.5, false) AS INTEGER)
             + CAST(coalesce(abs(z_req) > 2.8, false) AS INTEGER) AS signals_count,
             coalesce(mins BETWEEN 0 AND 60, false) AS recent_change,
             {catalog_case('business_impact_score')} AS impact, {catalog_case('owner_team')} AS owner_team FROM x),
scored AS (SELECT *, 2 * signals_count + impact + 2 * CAST(recent_change AS INTEGER) AS risk_score,
                  coalesce(2 * signals_count + impact + 2 * CAST(recent_change AS INTEGER) >= 7, false) AS is_candidate
           FROM s)"""


def scored_metrics(t):
    m = t.metrics.select("user_id", "ts", "tiebreak", "service", "latency_ms", "error_rate_pct", "request_count")
    features = A.signal_features(m, KEYS, ORDER, minutes_since_change=None)
    joined = J.asof_join(features.select("user_id", "ts", "tiebreak", "service", "error_rate_pct", "signals_count"),
                         t.changes, ["user_id"], "ts", "change_ts", ["change_id"], "tiebreak", "change_no", bucket="1 day", index=m)
    recent = joined.withColumn("mins", minutes_between("ts", "change_ts")).withColumn(
        "recent_change", F.coalesce(F.col("mins").between(0, 60), F.lit(False))
    ).withColumnRenamed("change_id", "last_change_id")
    return I.operational_risk(J.enrich_catalog(recent, "service", CATALOG))


@query("signal_features", f"""
WITH {SCORED.strip()}
SELECT tiebreak, signals_count, recent_change FROM scored""")
def signal_features(t):
    return scored_metrics(t).select("tiebreak", "signals_count", "recent_change")


@query("operational_risk", f"""
WITH {SCORED.strip()}
SELECT tiebreak, risk_score, is_candidate FROM scored""")
def operational_risk(t):
    return scored_metrics(t).select("tiebreak", "risk_score", "is_candidate")


SESSIONS = f"""{SCORED.strip()},
times AS (SELECT DISTINCT ts FROM scored WHERE is_candidate),
marked AS (SELECT ts, CASE WHEN date_diff('microsecond', lag(ts) OVER (ORDER BY ts), ts) > 600000000
                           THEN 1 ELSE 0 END AS starts FROM times),
numbered AS (SELECT ts, CAST(1 + sum(starts) OVER (ORDER BY ts) AS BIGINT) AS incident_number FROM marked),
sess AS (SELECT scored.*, incident_number FROM scored JOIN numbered USING (ts) WHERE is_candidate),
inc AS (SELECT incident_number, min(ts) AS start_ts, max(ts) AS end_ts, arg_min(service, (ts, tiebreak)) AS root,
               arg_min(owner_team, (ts, tiebreak)) AS owner_team,
               array_to_string(list_sort(list(DISTINCT service)), ', ') AS affected_services,
               max(risk_score) AS risk_score_max, max(error_rate_pct) AS max_error,
               count(DISTINCT change_id) AS change_count FROM sess GROUP BY incident_number),
sev AS (SELECT *, CASE WHEN risk_score_max >= 10 OR max_error >= 4 THEN 'P1' WHEN risk_score_max >= 8 THEN 'P2'
                       ELSE 'P3' END AS severity FROM inc)"""


@query("correlate_incidents", f"""
WITH {SESSIONS}
SELECT printf('INC-%04d', incident_number) AS incident_id, start_ts, end_ts, root AS probable_root_service,
       affected_services, owner_team, severity, risk_score_max, change_count,
       'first signal in ' || root || '; affected services: ' || affected_services || '; risk_score_max='
         || risk_score_max || '; max_error_rate=' || printf('%.2f', max_error) || '%'
         || CASE WHEN change_count > 0 THEN '; recent changes: ' || change_count ELSE '' END AS evidence,
       CASE severity WHEN 'P1' THEN 'open_p1_incident_and_diagnose' WHEN 'P2' THEN 'create_ticket_with_evidence'
                     ELSE 'watch_for_recurrence' END AS recommended_action
FROM sev""")
def correlate_incidents(t):
    return I.correlate_incidents(I.candidate_sessions(scored_metrics(t)))


@query("incident_changes", f"""
WITH {SESSIONS}
SELECT DISTINCT printf('INC-%04d', incident_number) AS incident_id, change_id AS last_change_id
FROM sess WHERE change_id IS NOT NULL""")
def incident_changes(t):
    return I.incident_changes(I.candidate_sessions(scored_metrics(t)))


THRESHOLDS = f"""
r AS (SELECT tiebreak, service, environment, latency_ms, error_rate, request_count,
        count(*) OVER s AS ns, count(*) OVER l AS nl, avg(latency_ms) OVER s AS m, stddev_samp(latency_ms) OVER s AS sd,
        quantile_cont(latency_ms, 0.95) OVER l AS p95, quantile_cont(request_count, 0.05) OVER l AS p05,
        quantile_cont(error_rate, 0.95) OVER l AS e95
      FROM metrics WINDOW s AS {trail(24)}, l AS {trail(288)}),
f AS (SELECT *, ns >= 24 AND latency_ms > m + 3 * sd AS latency_anomaly_std,
             nl >= 288 AND latency_ms > p95 * CAST(1.2 AS DOUBLE) AS latency_anomaly_p95,
             nl >= 288 AND request_count < p05 * CAST(0.7 AS DOUBLE) AS traffic_drop_anomaly,
             nl >= 288 AND error_rate > e95 * 2 AS error_rate_anomaly FROM r),
g AS (SELECT *, CAST(latency_anomaly_std AS INTEGER) + CAST(latency_anomaly_p95 AS INTEGER)
             + CAST(traffic_drop_anomaly AS INTEGER) + CAST(error_rate_anomaly AS INTEGER) AS anomaly_score FROM f),
h AS (SELECT *, anomaly_score > 0 AS is_anomaly,
             CASE WHEN anomaly_score = 0 THEN 'NORMAL' WHEN anomaly_score >= 3 THEN 'HIGH'
                  WHEN error_rate_anomaly AND environment = 'prod' THEN 'HIGH' WHEN anomaly_score = 2 THEN 'MEDIUM'
                  ELSE 'LOW' END AS severity,
             CASE WHEN anomaly_score = 0 THEN ''
                  WHEN error_rate_anomaly AND (latency_anomaly_std OR latency_anomaly_p95)
                    THEN 'escalate_errors_with_latency'
                  WHEN traffic_drop_anomaly THEN 'check_traffic_entry'
                  WHEN error_rate_anomaly THEN 'check_logs_and_deployments'
                  WHEN latency_anomaly_std OR latency_anomaly_p95 THEN 'check_traces_and_dependencies'
                  ELSE 'check_operational_behaviour' END AS recommended_action FROM g)"""


def thresholds(t):
    m = t.metrics.select("service", "environment", "ts", "tiebreak", "latency_ms", "error_rate", "request_count")
    return A.dynamic_thresholds(m, KEYS, ORDER)


@query("dynamic_thresholds", f"""
WITH {THRESHOLDS.strip()}
SELECT tiebreak, latency_anomaly_std, latency_anomaly_p95, traffic_drop_anomaly, error_rate_anomaly, anomaly_score,
       is_anomaly, CASE WHEN nl >= 288 THEN round(p95, 6) END AS latency_p95_long FROM h""")
def dynamic_thresholds(t):
    return thresholds(t).select(
        "tiebreak", "latency_anomaly_std", "latency_anomaly_p95", "traffic_drop_anomaly", "error_rate_anomaly",
        "anomaly_score", "is_anomaly", F.round("latency_p95_long", 6).alias("latency_p95_long"),
    )


@query("anomaly_severity", f"""
WITH {THRESHOLDS.strip()}
SELECT tiebreak, severity, recommended_action FROM h""")
def anomaly_severity(t):
    return A.anomaly_severity(thresholds(t)).select("tiebreak", "severity", "recommended_action")


@query("anomaly_summary", f"""
WITH {THRESHOLDS.strip()}
SELECT 'service' AS dimension, service AS member, count(*) AS anomalies FROM h WHERE is_anomaly GROUP BY service
UNION ALL SELECT 'severity', severity, count(*) FROM h WHERE is_anomaly GROUP BY severity""")
def anomaly_summary(t):
    return A.anomaly_summary(A.anomaly_severity(thresholds(t)))


@query("anomaly_score", f"""
WITH r AS (SELECT tiebreak, latency_ms, error_rate, count(*) OVER w AS n,
             avg(latency_ms) OVER w + 3 * stddev_samp(latency_ms) OVER w AS th,
             2 * quantile_cont(error_rate, 0.95) OVER w AS eth FROM metrics WINDOW w AS {trail(24)}),
     g AS (SELECT *, CASE WHEN n >= 24 THEN th END AS thr, CASE WHEN n >= 24 THEN eth END AS ethr FROM r),
     s AS (SELECT *, least(100, greatest(0,
             CASE WHEN latency_ms > thr THEN (latency_ms - thr) / thr * 100 ELSE 0 END
             + CASE WHEN error_rate > ethr THEN 60 ELSE 0 END)) AS sc FROM g)
SELECT tiebreak, round(sc, 6) AS anomaly_score, sc >= 80 AS is_anomaly,
       round(coalesce(thr, latency_ms), 6) AS latency_threshold FROM s""")
def anomaly_score(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms", "error_rate")
    df = A.anomaly_score(m, KEYS, ORDER)
    return df.select("tiebreak", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly",
                     F.round("latency_threshold", 6).alias("latency_threshold"))


ROLES = {"latency": "latency_ms", "errors": "error_rate", "traffic": "request_count", "cpu": "cpu", "memory": "memory"}


@query("explain_anomalies", """
WITH q AS (SELECT quantile_cont(latency_ms, 0.95) AS l, quantile_cont(error_rate, 0.95) AS e,
                  quantile_cont(request_count, 0.05) AS r, quantile_cont(cpu, 0.95) AS c,
                  quantile_cont(memory, 0.95) AS m FROM metrics),
     x AS (SELECT tiebreak, latency_ms > 100 OR tiebreak % 9 = 0 AS flag,
             list_filter([CASE WHEN latency_ms >= l THEN 'high_latency' END,
              CASE WHEN error_rate >= e THEN 'high_error_rate' END, CASE WHEN request_count <= r THEN 'traffic_drop' END,
              CASE WHEN cpu >= c THEN 'high_cpu' END, CASE WHEN memory >= m THEN 'high_memory' END],
              lambda v: v IS NOT NULL) AS rs FROM metrics, q)
SELECT tiebreak, CASE WHEN NOT flag THEN '' WHEN len(rs) = 0 THEN 'odd_combination'
                      ELSE array_to_string(rs, ', ') END AS anomaly_reason,
       CASE WHEN NOT flag THEN '' WHEN list_contains(rs, 'high_error_rate') THEN 'check_logs_and_deployments'
            WHEN list_contains(rs, 'traffic_drop') THEN 'check_traffic_entry'
            WHEN list_contains(rs, 'high_cpu') OR list_contains(rs, 'high_memory') THEN 'check_saturation_and_scaling'
            WHEN list_contains(rs, 'high_latency') THEN 'check_dependencies_and_traces'
            ELSE 'correlate_with_events' END AS recommended_action FROM x""")
def explain_anomalies(t):
    m = t.metrics.select("tiebreak", *ROLES.values()).withColumn(
        "flag", (F.col("latency_ms") > 100) | (F.col("tiebreak") % 9 == 0)
    )
    return A.explain_anomalies(m, "flag", ROLES).select("tiebreak", "anomaly_reason", "recommended_action")


@query("global_quantiles", """
SELECT event_type AS service, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type""")
def global_quantiles(t):
    from opsight.operators.quantiles import exact_quantiles

    q = exact_quantiles(t.metrics.select("service", "latency_ms"), ["service"], "latency_ms", [0.05, 0.5, 0.95])
    return q.select("service", *[F.round(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(("p05", "p50", "p95"))])


QUEUE_ORDER = """CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'WARNING' THEN 2 ELSE 1 END DESC,
updated_ts DESC, incident_id"""
OPEN = f"""SELECT * FROM incident_queue WHERE status IN ('OPEN', 'INVESTIGATING', 'MITIGATING')
ORDER BY {QUEUE_ORDER} LIMIT 10"""


@query("open_incidents", OPEN)
def open_incidents(t):
    return I.open_incidents(t.incident_queue)


MESSAGE = """CASE severity WHEN 'CRITICAL' THEN '🚨' WHEN 'HIGH' THEN '⚠️' WHEN 'WARNING' THEN '🟠' ELSE 'ℹ️' END
  || ' Incident ' || severity || ': ' || alert_type || ' in ' || service_name || chr(10) || chr(10)
  || 'Incident: ' || incident_id || chr(10) || 'Status: ' || status || chr(10) || 'Owner: ' || owner_team || chr(10)
  || 'Runbook: ' || runbook || chr(10) || chr(10) || 'Suggested commands:' || chr(10) || 'ack ' || incident_id
  || chr(10) || 'escalate ' || incident_id || chr(10) || 'block-deploys ' || service_name"""


@query("render_message", f"SELECT incident_no, {MESSAGE} AS message_text FROM incident_queue")
def render_message(t):
    return I.render_message(t.incident_queue).select("incident_no", "message_text")


@query("notify_queue", f"""
WITH o AS ({OPEN})
SELECT 'NOTIF-' || upper(substr(sha256(incident_id || '-2002-01-01 00:00:00'), 1, 12)) AS notification_id,
       TIMESTAMP '2002-01-01 00:00:00' AS created_ts, incident_id, service_name, 'chat' AS channel,
       'DRY_RUN' AS status, true AS dry_run, CAST(NULL AS INTEGER) AS response_code,
       'dry run or no webhook' AS error_message, {MESSAGE} AS message_text
FROM o WHERE NOT EXISTS (SELECT 1 FROM notification_log l WHERE l.incident_id = o.incident_id
  AND l.status IN ('SENT', 'DRY_RUN') AND l.created_ts >= TIMESTAMP '2002-01-01 00:00:00' - INTERVAL 60 MINUTE)""")
def notify_queue(t):
    return I.notify_queue(t.incident_queue, t.notification_log, F.lit("2002-01-01 00:00:00").cast("timestamp"))
