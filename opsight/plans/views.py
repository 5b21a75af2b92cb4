"""Adapter views: the driver tables seen as operations data.

Each view is one SELECT that Spark SQL and DuckDB both accept, so a query and its SQL twin
start from the same relation. Integer arithmetic keeps derived columns bit-identical.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from opsight.sources.files import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    # Service metrics, one row per event.
    "metrics": """
        SELECT event_id AS tiebreak, CAST(ts AS TIMESTAMP) AS ts, event_type AS service, user_id,
               CASE WHEN user_id % 4 = 0 THEN 'pre' ELSE 'prod' END AS environment,
               'r' || CAST(user_id % 3 AS STRING) AS region,
               value AS latency_ms,
               CAST((event_id * 37) % 100 AS DOUBLE) / 20 AS error_rate_pct,
               CAST((event_id * 37) % 100 AS DOUBLE) / 1000 AS error_rate,
               CAST(100 + (event_id * 7919) % 1000 AS DOUBLE) AS request_count,
               CAST((event_id * 31) % 100 AS DOUBLE) AS cpu,
               CAST((event_id * 17) % 100 AS DOUBLE) AS memory,
               CASE WHEN event_id % 211 = 0 THEN 1 ELSE 0 END AS deployment_event,
               CASE WHEN event_id % 503 < 6 THEN 1 ELSE 0 END AS incident_active
        FROM {events}""",
    # Change events: sign-ups by user.
    "changes": """
        SELECT event_id AS change_no, 'CHG-' || CAST(event_id AS STRING) AS change_id, user_id,
               CAST(ts AS TIMESTAMP) AS change_ts,
               CASE WHEN event_id % 2 = 0 THEN 'deploy' ELSE 'config' END AS change_type,
               'v' || CAST(event_id % 50 AS STRING) AS deployment_version
        FROM {events} WHERE event_type = 'signup'""",
    # HTTP requests.
    "requests": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS event_ts, 'svc' || CAST(user_id % 3 AS STRING) AS service_name,
               CASE WHEN event_type = 'error' AND event_id % 37 = 0 THEN 500 ELSE 200 END AS status_code,
               CAST(floor(value * 3) AS BIGINT) AS latency_ms
        FROM {events}""",
    # Access events with principals and methods.
    "access": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS event_ts,
               CASE WHEN user_id % 5 = 0 THEN 'serviceAccount:sa-aiops-training-' || CAST(user_id AS STRING)
                    WHEN user_id % 5 = 1 THEN 'serviceAccount:legacy-' || CAST(user_id AS STRING)
                    ELSE 'user' || CAST(user_id AS STRING) || '@example.com' END AS principal,
               CASE event_type
                    WHEN 'click' THEN 'google.iam.admin.v1.SetIamPolicy'
                    WHEN 'signup' THEN 'google.iam.admin.v1.CreateServiceAccountKey'
                    WHEN 'purchase' THEN 'google.cloud.aiplatform.v1.Endpoint.Predict'
                    WHEN 'error' THEN 'google.cloud.functions.v2.UpdateFunction'
                    ELSE 'storage.objects.get' END AS method_name,
               CASE event_id % 4 WHEN 0 THEN 'projects/x/PROD-raw/' || CAST(event_id % 13 AS STRING)
                    WHEN 1 THEN 'projects/x/secrets/s' WHEN 2 THEN 'projects/x/dev/t'
                    ELSE 'projects/x/other' END AS resource_name,
               CASE WHEN event_type = 'error' OR event_id % 3 = 0 THEN '7' ELSE '0' END AS status_code
        FROM {events}""",
    # Billing export: one row per usage line with an array of credits.
    "billing": """
        SELECT CAST(l_shipdate AS DATE) AS usage_date, l_linestatus AS source_project, l_returnflag AS service,
               CAST(l_linenumber AS STRING) AS sku, l_extendedprice AS cost, l_discount AS discount
        FROM {lineitem}""",
    # Daily net cost per service.
    "daily_cost": """
        SELECT usage_date, service, sum(cost) AS gross_cost, sum(0 - cost * discount) AS credits,
               sum(cost - cost * discount) AS net_cost
        FROM {billing} GROUP BY usage_date, service""",
    # Incident life cycle.
    "incidents": """
        SELECT o_orderkey AS incident_no, 'INC-' || CAST(o_orderkey AS STRING) AS incident_id,
               c_mktsegment AS service, o_orderpriority AS severity, o_orderstatus AS environment,
               o_totalprice AS impact_value,
               CAST(o_orderdate AS TIMESTAMP) AS started_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' MINUTE * CAST(o_orderkey % 17 AS INT) AS detected_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' MINUTE * CAST(o_orderkey % 17 + o_orderkey % 23 AS INT)
                   AS acknowledged_at,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' MINUTE
                   * CAST(o_orderkey % 17 + o_orderkey % 23 + o_orderkey % 101 AS INT) AS resolved_at,
               o_orderkey % 10 < 8 AS alert_generated, o_orderkey % 10 < 5 AS alert_actionable,
               o_orderkey % 7 < 3 AS predicted, o_orderkey % 5 = 0 AS auto_remediation_attempted,
               o_orderkey % 15 = 0 AS auto_remediation_success
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Incident queue of the notifier.
    "incident_queue": """
        SELECT o_orderkey AS incident_no, 'INC-' || CAST(o_orderkey AS STRING) AS incident_id,
               'svc' || CAST(o_custkey % 20 AS STRING) AS service_name,
               'A' || CAST(o_orderkey % 4 AS STRING) AS alert_type,
               CASE o_orderkey % 5 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'WARNING' ELSE 'INFO' END
                   AS severity,
               CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'INVESTIGATING' ELSE 'CLOSED' END AS status,
               'team' || CAST(o_custkey % 7 AS STRING) AS owner_team,
               'RB-' || CAST(o_orderkey % 9 AS STRING) AS runbook,
               CAST(o_orderdate AS TIMESTAMP) AS updated_ts, o_totalprice AS current_value
        FROM {orders}""",
    # Notification log: one delivery attempt for each incident, some failed and some long ago.
    "notification_log": """
        SELECT 'INC-' || CAST(o_orderkey AS STRING) AS incident_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'SENT' WHEN 1 THEN 'DRY_RUN' ELSE 'FAILED' END AS status,
               TIMESTAMP '2002-01-01 00:00:00' - INTERVAL '1' MINUTE * CAST(o_orderkey % 180 AS INT) AS created_ts
        FROM {orders}""",
    # Model predictions with ground truth.
    "predictions": """
        SELECT d.doc_id AS event_no, d.source AS service, l.quality AS y,
               CAST((d.doc_id * 37 + l.quality * 211) % 1000 AS DOUBLE) / 1000 AS score
        FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
    # Regression scores: predicted against true price.
    "regression": """
        SELECT l_orderkey, l_linenumber, l_returnflag AS service, l_extendedprice AS y,
               l_quantity * 1500 + l_tax * 1000 AS yhat
        FROM {lineitem}""",
    # Log lines.
    "logs": """
        SELECT doc_id AS log_no, 'd' AS kind, text AS message, source AS log_name,
               CASE doc_id % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'WARNING' ELSE 'INFO' END
                   AS severity,
               TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * CAST(doc_id % 43200 AS INT) AS ts
        FROM {documents}
        UNION ALL
        SELECT conv_id * 1000 + turn AS log_no, 'c' AS kind, text AS message, role AS log_name,
               CASE conv_id % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'ALERT' ELSE 'WARNING' END AS severity,
               TIMESTAMP '2024-02-01 00:00:00' + INTERVAL '1' MINUTE * CAST(conv_id % 10000 AS INT) AS ts
        FROM {conversations}""",
    # Application log lines with ids, times and latencies.
    "app_logs": """
        SELECT event_id AS log_no, CAST(ts AS TIMESTAMP) AS ts,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
               'POST /' || event_type || ' failed status=' || CAST(500 + event_id % 4 AS STRING)
                   || ' latency_ms=' || CAST(CAST(floor(value) AS BIGINT) AS STRING)
                   || ' trace_id=abc' || CAST(event_id AS STRING)
                   || ' Request-ID:r.' || CAST(user_id AS STRING)
                   || ' at 2024-01-0' || CAST(1 + event_id % 9 AS STRING) || 'T10:00:00Z'
                   || ' account ' || CAST(1000000 + user_id AS STRING)
                   || ' mail u' || CAST(user_id AS STRING) || '@ex.com password=p' || CAST(event_id AS STRING)
                   AS message
        FROM {events}""",
    # Messages on the event topic; some malformed, some without mandatory fields.
    "messages": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts,
               CASE WHEN event_id % 17 = 0 THEN 'not json ' || CAST(event_id AS STRING)
                    WHEN event_id % 23 = 0 THEN
                      '{{"timestamp":"2024-01-01T00:00:00Z","jsonPayload":{{"event_type":"x"}}}}'
                    ELSE '{{"timestamp":"2024-01-01T00:00:00Z","logName":"projects/p/logs/app","severity":"'
                      || CASE event_id % 3 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'INFO' ELSE 'CRITICAL' END
                      || '","resource":{{"type":"gce","labels":{{"project_id":"p' || CAST(user_id % 4 AS STRING)
                      || '"}}}},"jsonPayload":{{"service_name":"svc' || CAST(user_id % 9 AS STRING)
                      || '","event_type":"' || event_type
                      || '","environment":"' || CASE WHEN user_id % 4 = 0 THEN 'pre' ELSE 'prod' END
                      || '","latency_ms":' || CAST(CAST(floor(value * 40) AS BIGINT) AS STRING)
                      || ',"error_rate":0.' || CAST(10 + event_id % 90 AS STRING)
                      || ',"correlation_id":"c' || CAST(event_id AS STRING)
                      || '","aiops_candidate":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
                      || '}}}}' END AS raw
        FROM {events}""",
    # Enriched events for the real-time scorer (fields as text, some blank).
    "enriched": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type AS service_name,
               CASE user_id % 4 WHEN 0 THEN 'pre' WHEN 1 THEN 'dev' ELSE 'prod' END AS environment,
               CASE event_id % 6 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'error' WHEN 2 THEN 'ALERT' WHEN 3 THEN 'DEBUG'
                    WHEN 4 THEN 'INFO' ELSE NULL END AS severity,
               CASE user_id % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'standard' ELSE 'internal' END AS service_tier,
               event_id % 2 = 0 AS customer_facing, event_id % 5 = 0 AS maintenance_window,
               CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS STRING) END
                   AS latency_ms,
               CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE '0.' || CAST(100 + event_id % 900 AS STRING) END
                   AS error_rate,
               CAST(200 * (event_id % 3) AS STRING) AS expected_latency_ms,
               CASE WHEN event_id % 7 = 0 THEN '0' ELSE '0.25' END AS max_error_rate
        FROM {events}""",
    # Detected anomalies for the mitigation policy.
    "anomalies_in": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, 'INC-' || CAST(event_id AS STRING) AS incident_id,
               'svc' || CAST(user_id % 9 AS STRING) AS service,
               CASE WHEN user_id % 4 = 0 THEN 'pre' ELSE 'prod' END AS environment,
               CASE event_type WHEN 'error' THEN 'ERROR_SPIKE' WHEN 'click' THEN 'RESOURCE_SATURATION'
                    WHEN 'view' THEN 'TRAFFIC_DROP' WHEN 'purchase' THEN 'LATENCY_DEGRADATION'
                    ELSE 'UNKNOWN' END AS anomaly_type,
               CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH' ELSE 'CRITICAL' END
                   AS severity,
               CAST(event_id % 101 AS DOUBLE) AS anomaly_score, value AS latency_ms,
               CAST(event_id % 100 AS DOUBLE) / 1000 AS error_rate
        FROM {events}""",
    # Metric observations routed by severity; some lack a mandatory field.
    "observations": """
        SELECT event_id AS observation_no, CAST(ts AS TIMESTAMP) AS ts,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'evt-' || CAST(event_id AS STRING) END AS event_id,
               'corr-' || CAST(user_id AS STRING) AS correlation_id,
               CASE WHEN event_id % 31 = 0 THEN NULL ELSE event_type END AS service,
               CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'prod' END AS environment,
               CASE event_id % 3 WHEN 0 THEN 'latency_ms' WHEN 1 THEN 'error_rate' ELSE 'cpu' END AS metric,
               CASE event_id % 3 WHEN 0 THEN value * 30 WHEN 1 THEN CAST(event_id % 25 AS DOUBLE) / 100
                    ELSE CAST(event_id % 100 AS DOUBLE) END AS value
        FROM {events}""",
    # Operating signals per service (one per supplier).
    "signals": """
        SELECT s_suppkey, s_name AS service_name, 'team' || CAST(s_nationkey AS STRING) AS owner_team,
               CASE s_suppkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS criticality,
               CAST(90 + (s_suppkey * 7) % 100 AS DOUBLE) / CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 2 END
                   AS slo_compliance_pct,
               CAST((s_suppkey * 13) % 120 AS DOUBLE) AS avg_mttr_minutes,
               CAST((s_suppkey * 5) % 40 AS DOUBLE) AS avg_mtta_minutes,
               CAST((s_suppkey * 11) % 60 AS DOUBLE) AS false_positive_pct,
               s_suppkey % 9 AS high_risk_changes_30d, s_suppkey % 4 AS changes_without_approval_30d,
               CAST((s_suppkey * 17) % 101 AS DOUBLE) AS remediation_success_pct,
               CAST((s_suppkey * 19) % 101 AS DOUBLE) AS feedback_coverage_pct,
               s_suppkey % 12 AS open_improvement_items
        FROM {supplier}""",
    # Monthly economics per service.
    "economics": """
        SELECT s_suppkey, s_name AS service, CASE WHEN s_suppkey % 2 = 0 THEN 'high' ELSE 'medium' END AS criticality,
               CAST(10 + s_suppkey % 90 AS DOUBLE) AS cost_per_downtime_min,
               8 + s_suppkey % 20 AS baseline_incidents, 4 + s_suppkey % 15 AS current_incidents,
               CAST(50 + s_suppkey % 80 AS DOUBLE) AS baseline_avg_mttr_min,
               CAST(30 + s_suppkey % 60 AS DOUBLE) AS current_avg_mttr_min,
               600 + s_suppkey % 1000 AS baseline_alerts, 400 + s_suppkey % 700 AS current_alerts,
               20 + s_suppkey % 140 AS automation_executions,
               s_acctbal + 10000 AS baseline_cloud_spend, s_acctbal * 0.5 + 9000 AS current_cloud_spend
        FROM {supplier}""",
    # Rightsizing recommendations.
    "recommendations": """
        SELECT p_partkey, 'projects/p/recommendations/' || CAST(p_partkey AS STRING) AS recommendation_name,
               CASE p_partkey % 4 WHEN 0 THEN 'google.compute.instance.IdleResourceRecommender'
                    WHEN 1 THEN 'google.compute.instance.MachineTypeRecommender'
                    WHEN 2 THEN 'google.cloudsql.instance.OverprovisionedRecommender'
                    ELSE 'synthetic.rightsizing' END AS recommender_id,
               CASE WHEN p_partkey % 5 = 0 THEN 'vertex_endpoint_resize' ELSE p_type END AS subtype,
               CASE p_size % 5 WHEN 0 THEN '//compute/projects/PROD/vm' WHEN 1 THEN '//compute/projects/sandbox/vm'
                    WHEN 2 THEN '//compute/projects/uat/vm' WHEN 3 THEN '//compute/projects/x/vm'
                    ELSE NULL END AS target_resource,
               CAST(p_partkey % 200 AS DOUBLE) AS estimated_monthly_saving
        FROM {part}""",
    # Tickets of the support assistant and the runbooks they look up.
    "tickets": """
        SELECT c_custkey AS request_id, 'Brand#' || CAST(c_custkey % 25 + 1 AS STRING) AS service_guess,
               CASE c_custkey % 5 WHEN 0 THEN 'ring' WHEN 1 THEN 'Widget' WHEN 2 THEN 'gear'
                    WHEN 3 THEN CASE c_custkey % 4 WHEN 0 THEN 'nothing_known' WHEN 1 THEN 'small_ring'
                                WHEN 2 THEN 'G_ar%' ELSE '%' END
                    ELSE 'bolt' END AS category
        FROM {customer}""",
    "runbooks": """
        SELECT p_partkey AS runbook_id, p_brand AS service_name, p_name AS symptoms FROM {part}""",
    "reports": """
        SELECT o_orderkey AS report_no, 'Brand#' || CAST(o_custkey % 25 + 1 AS STRING) AS service_name,
               CAST(o_orderdate AS TIMESTAMP) AS created_at, o_orderpriority AS severity
        FROM {orders}""",
    # Structured results of an assistant, as JSON text with optional fields.
    "assistant_results": """
        SELECT c_custkey AS result_no,
               '{{"incident_title":"T' || CAST(c_custkey AS STRING) || '"'
               || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ',"severity":"P' || CAST(c_custkey % 4 + 1 AS STRING) || '"'
                  END
               || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE ',"confidence":0.' || CAST(10 + c_custkey % 90 AS STRING)
                  END
               || ',"affected_services":["a' || CAST(c_custkey % 5 AS STRING) || '","b"]}}' AS result_json
        FROM {customer}""",
    # Change requests: prior and new settings of a service.
    "change_requests": """
        SELECT o_orderkey, 'CHG-' || CAST(o_orderkey AS STRING) AS change_id,
               CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE 'Change ' || CAST(o_orderkey AS STRING) END AS title,
               CASE WHEN o_orderkey % 3 = 0 THEN 'prod' ELSE 'dev' END AS environment,
               CASE o_orderkey % 4 WHEN 0 THEN 'model_deployment' WHEN 1 THEN 'iam' WHEN 2 THEN 'automation'
                    ELSE 'docs' END AS change_type,
               'v1.' || CAST(o_orderkey % 3 AS STRING) AS old_version,
               'v1.' || CAST(o_orderkey % 2 AS STRING) AS new_version,
               '0.' || CAST(80 + o_orderkey % 4 AS STRING) AS old_threshold,
               '0.' || CAST(80 + o_orderkey % 5 AS STRING) AS new_threshold,
               CASE o_orderkey % 3 WHEN 0 THEN 'alert_only' WHEN 1 THEN 'create_ticket'
                    ELSE 'automatic_remediation' END AS new_action,
               CASE WHEN o_orderkey % 11 = 0 THEN 'admin' ELSE 'viewer' END AS new_role,
               o_orderkey % 7 AS approval_mask, o_orderkey % 5 <> 0 AS has_rollback, o_orderkey % 6 <> 0 AS has_evidence
        FROM {orders}""",
}


class Tables:
    """The driver tables of one folder and the adapter views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread_scans: bool = False):
        self.spark, self.sf_dir, self.spread_scans = spark, str(sf_dir).rstrip("/"), spread_scans

    def table(self, name: str) -> DataFrame:
        scan = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return spread(scan) if self.spread_scans else scan

    def spread(self) -> Tables:
        """The same tables for work that is heavy per row."""
        return Tables(self.spark, self.sf_dir, spread_scans=True)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in VIEWS:
            text = VIEWS[name]
            used = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text))
            return self.spark.sql(text, **{u: getattr(self, u) for u in used})
        raise AttributeError(name)
