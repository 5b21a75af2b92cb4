"""Security and governance queries."""

from pyspark.sql import functions as F

from opsight.functions import audit as U
from opsight.operators import governance as G, security as Z
from opsight.plans.registry import query
from opsight.plans.scalars import score_sql

CUT = "(SELECT date_trunc('hour', max(event_ts)) FROM access)"


def cut(t):
    return t.access.agg(F.date_trunc("hour", F.max("event_ts")).alias("c")).scalar()


@query("hourly_baseline", f"""
SELECT principal, quantile_cont(n, 0.5) AS baseline_event_count FROM (
  SELECT principal, date_trunc('hour', event_ts) AS h, count(*) AS n FROM access WHERE event_ts < {CUT} GROUP BY ALL)
GROUP BY principal""")
def hourly_baseline(t):
    return Z.hourly_baseline(t.access, cut(t))


METHODS = "CASE method_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in Z.SENSITIVE_METHODS.items()) + " ELSE 0 END"
RESOURCES = " OR ".join(f"contains(lower(resource_name), '{r}')" for r in Z.SENSITIVE_RESOURCES)
KNOWN = " OR ".join(f"contains(principal, '{p}')" for p in Z.KNOWN_ACCOUNTS)
PROFILE = f"""
ev AS (SELECT *, status_code = '7' AS denied, {METHODS} AS mp, {RESOURCES} AS sr, NOT hour(event_ts) BETWEEN 8 AND 19 AS off,
        starts_with(principal, 'serviceAccount:') AND NOT ({KNOWN}) AS unk FROM access),
cu AS (SELECT ev.*, kn.principal IS NULL AS novel FROM ev LEFT JOIN (SELECT DISTINCT principal, method_name FROM ev
        WHERE event_ts < {CUT}) kn USING (principal, method_name) WHERE event_ts >= {CUT}),
pf AS (SELECT principal, count(*) AS event_count, count(*) FILTER (denied) AS denied_count, count(*) FILTER (mp > 0)
        AS sensitive_method_count, count(*) FILTER (sr) AS sensitive_resource_count, count(*) FILTER (off) AS off_hours_count,
        count(*) FILTER (novel) AS novelty_count, sum(mp) AS mp, bool_or(unk) AS unknown_account FROM cu GROUP BY principal)"""


@query("principal_window", f"""
WITH {PROFILE.strip()}
SELECT principal, event_count, denied_count, sensitive_method_count, sensitive_resource_count, off_hours_count, novelty_count,
  unknown_account FROM pf""")
def principal_window(t):
    from opsight.operators.joins import novelty_flag

    events, c = Z.access_features(t.access), cut(t)
    flagged = novelty_flag(events.filter(F.col("event_ts") >= c), events.filter(F.col("event_ts") < c),
                           ["principal", "method_name"], "is_novel_method")
    return Z.principal_window(flagged).drop("method_points")


@query("behavior_anomalies", f"""
WITH {PROFILE.strip()},
 b AS (SELECT principal, quantile_cont(n, 0.5) AS bl FROM (SELECT principal, date_trunc('hour', event_ts) AS h, count(*) AS n
        FROM access WHERE event_ts < {CUT} GROUP BY ALL) GROUP BY principal),
 j AS (SELECT pf.*, coalesce(bl, 1) AS bl, event_count / greatest(coalesce(bl, 1), 1) AS vr FROM pf LEFT JOIN b USING (principal)),
 s AS (SELECT *, CAST(CASE WHEN vr >= 5 THEN 20 ELSE 0 END + CASE WHEN denied_count >= 10 THEN least(30, denied_count) ELSE 0 END
   + CASE WHEN sensitive_method_count > 0 THEN mp ELSE 0 END
   + CASE WHEN sensitive_resource_count > 0 THEN least(20, sensitive_resource_count * 4) ELSE 0 END
   + CASE WHEN off_hours_count > 0 THEN least(10, off_hours_count * 2) ELSE 0 END
   + CASE WHEN novelty_count > 0 THEN least(15, novelty_count * 3) ELSE 0 END
   + CASE WHEN unknown_account THEN 25 ELSE 0 END AS BIGINT) AS risk_score FROM j)
SELECT principal, event_count, denied_count, novelty_count, CAST(bl AS DOUBLE) AS baseline_event_count,
  round(vr, 6) AS volume_ratio, risk_score, CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 35 THEN 'MEDIUM'
  ELSE 'LOW' END AS severity, concat_ws('; ', CASE WHEN vr >= 5 THEN 'volume ' || printf('%.1f', vr) || 'x' END,
   CASE WHEN denied_count >= 10 THEN denied_count || ' denied' END,
   CASE WHEN sensitive_method_count > 0 THEN sensitive_method_count || ' sensitive methods' END,
   CASE WHEN sensitive_resource_count > 0 THEN sensitive_resource_count || ' sensitive resources' END,
   CASE WHEN off_hours_count > 0 THEN off_hours_count || ' off hours' END,
   CASE WHEN novelty_count > 0 THEN novelty_count || ' new methods' END,
   CASE WHEN unknown_account THEN 'unregistered service account' END) AS reasons
FROM s WHERE risk_score >= 15""")
def behavior_anomalies(t):
    df = Z.behavior_anomalies(t.access).withColumn("volume_ratio", F.round("volume_ratio", 6))
    return df.select("principal", "event_count", "denied_count", "novelty_count", "baseline_event_count", "volume_ratio",
                     "risk_score", "severity", "reasons")


def nested_audit(t):
    """The access events in the nested audit-log shape."""
    e = F.col("event_id")
    permission = lambda name, granted: F.struct(F.lit(name).alias("permission"), granted.alias("granted"))
    service = F.when(e % 5 == 0, "iam.googleapis.com").when(e % 5 == 1, "aiplatform.googleapis.com").when(
        e % 5 == 2, "storage.googleapis.com").otherwise("custom.example.com")
    principal = F.when(e % 6 == 0, "bot@p.iam.gserviceaccount.com").when(e % 6 == 1, F.lit(None)).otherwise(F.col("principal"))
    return t.spread().access.select(
        "event_id", "event_ts",
        F.struct(
            F.struct(principal.alias("principalEmail")).alias("authenticationInfo"),
            F.struct(F.lit("10.0.0.1").alias("callerIp"), F.lit("cli").alias("callerSuppliedUserAgent")).alias("requestMetadata"),
            F.when(e % 7 != 0, F.struct(F.col("status_code").cast("int").alias("code"), F.lit("m").alias("message"))).alias("status"),
            service.alias("serviceName"), F.col("method_name").alias("methodName"), F.col("resource_name").alias("resourceName"),
            F.when(e % 4 != 0, F.array(permission("b.read", e % 2 == 0), permission("a.write", e % 3 == 0),
                                       permission("b.read", e % 2 == 0), permission("", F.lit(False)))).alias("authorizationInfo"),
        ).alias("protoPayload"))


AUDIT = f"""
a0 AS (SELECT event_id, event_ts, lower(method_name) AS lm, lower(resource_name) AS lr,
   CASE event_id % 5 WHEN 0 THEN 'iam.googleapis.com' WHEN 1 THEN 'aiplatform.googleapis.com' WHEN 2 THEN 'storage.googleapis.com'
     ELSE 'custom.example.com' END AS sn,
   CASE event_id % 6 WHEN 0 THEN 'bot@p.iam.gserviceaccount.com' WHEN 1 THEN '' ELSE principal END AS p,
   CASE WHEN event_id % 7 = 0 THEN 0 ELSE CAST(status_code AS INTEGER) END AS status_code,
   CASE WHEN event_id % 4 = 0 THEN 0 ELSE CAST(event_id % 2 <> 0 AS INTEGER) + CAST(event_id % 3 <> 0 AS INTEGER) END AS nd,
   {score_sql('method_name', U.METHOD_KEYWORDS)} AS ms, {score_sql('resource_name', U.RESOURCE_TOKENS)} AS rs FROM access),
au AS (SELECT *, least(100, CASE WHEN status_code = 7 THEN 25 ELSE 0 END + ms + rs + least(20, nd * 5)
   + CASE WHEN ends_with(p, '.gserviceaccount.com') AND (contains(lm, 'iam') OR contains(lm, 'setiampolicy')) THEN 25 ELSE 0 END
   + CASE WHEN sn = 'iam.googleapis.com' THEN 10 ELSE 0 END
   + CASE WHEN sn = 'aiplatform.googleapis.com' AND contains(lm, 'delete') THEN 20 ELSE 0 END) AS risk_score FROM a0),
al AS (SELECT *, CASE WHEN risk_score >= 75 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM' WHEN risk_score >= 15 THEN 'LOW'
   ELSE 'INFO' END AS risk_level, CASE WHEN p = '' THEN 'UNKNOWN' ELSE p END AS principal,
   CASE sn WHEN 'iam.googleapis.com' THEN 'IAM' WHEN 'aiplatform.googleapis.com' THEN 'VERTEX_AI'
     WHEN 'storage.googleapis.com' THEN 'STORAGE' ELSE 'OTHER' END AS service_domain FROM au)"""


@query("audit_risk", f"""
WITH {AUDIT.strip()}
SELECT event_id, principal, service_domain, status_code, risk_score, risk_level,
  array_to_string(list_filter([CASE WHEN nd > 0 AND event_id % 3 <> 0 THEN 'a.write' END,
    CASE WHEN nd > 0 AND event_id % 2 <> 0 THEN 'b.read' END], lambda v: v IS NOT NULL), ';') AS denied_permissions FROM al""")
def audit_risk(t):
    return Z.audit_risk(nested_audit(t)).select("event_id", "principal", "service_domain", "status_code", "risk_score",
                                                "risk_level", "denied_permissions")


@query("audit_report", f"""
WITH {AUDIT.strip()}
SELECT 'risk_level' AS dimension, risk_level AS member, count(*) AS events FROM al GROUP BY risk_level
UNION ALL SELECT 'service_domain', service_domain, count(*) FROM al GROUP BY service_domain
UNION ALL SELECT 'principal', principal, count(*) FROM al GROUP BY principal""")
def audit_report(t):
    return Z.audit_report(Z.audit_risk(nested_audit(t)))


@query("riskiest_events", f"""
WITH {AUDIT.strip()}
SELECT event_id, principal, risk_score FROM al WHERE risk_level IN ('HIGH', 'MEDIUM') ORDER BY risk_score DESC, event_id LIMIT 25""")
def riskiest_events(t):
    return Z.riskiest_events(Z.audit_risk(nested_audit(t)), "event_id").select("event_id", "principal", "risk_score")


@query("denied_events", f"""
WITH {AUDIT.strip()}
SELECT event_id, principal, service_domain FROM al WHERE status_code = 7 ORDER BY event_ts DESC, event_id LIMIT 20""")
def denied_events(t):
    return Z.denied_events(Z.audit_risk(nested_audit(t)), "event_ts", "event_id").select("event_id", "principal", "service_domain")


CARD = """
c0 AS (SELECT *, least(100, greatest(0, slo_compliance_pct)) AS a, least(100, greatest(0, 100 - avg_mttr_minutes)) AS b,
  least(100, greatest(0, 100 - avg_mtta_minutes * 4)) AS c, least(100, greatest(0, 100 - false_positive_pct * 2)) AS d,
  least(100, greatest(0, 100 - high_risk_changes_30d * 8 - changes_without_approval_30d * 15)) AS e,
  least(100, greatest(0, remediation_success_pct)) AS f, least(100, greatest(0, feedback_coverage_pct)) AS g,
  least(100, greatest(0, 100 - open_improvement_items * 5)) AS h FROM signals),
c1 AS (SELECT *, round(0.0::DOUBLE + a * 0.2::DOUBLE + b * 0.15::DOUBLE + c * 0.1::DOUBLE + d * 0.15::DOUBLE
  + e * 0.15::DOUBLE + f * 0.1::DOUBLE + g * 0.1::DOUBLE + h * 0.05::DOUBLE, 2) AS hs FROM c0),
c2 AS (SELECT *, CASE WHEN hs >= 85 THEN 'HEALTHY' WHEN hs >= 70 THEN 'WATCH' WHEN hs >= 55 THEN 'AT_RISK'
   ELSE 'CRITICAL_ATTENTION' END AS os,
  CASE WHEN a < 97 THEN 'SLO_REVIEW' WHEN e < 70 THEN 'CHANGE_GOVERNANCE' WHEN d < 70 THEN 'REDUCE_ALERT_NOISE'
   WHEN b < 60 THEN 'MTTR_REDUCTION' WHEN f < 70 THEN 'REMEDIATION_REVIEW' WHEN g < 60 THEN 'IMPROVE_FEEDBACK_LOOP'
   WHEN h < 60 THEN 'REDUCE_OPERATIONAL_DEBT' ELSE 'CONTINUE_MONITORING' END AS area FROM c1)"""


@query("scorecard", f"""
WITH {CARD.strip()}
SELECT service_name, owner_team, criticality, hs AS operational_health_score, os AS operational_status,
  area AS primary_improvement_area FROM c2""")
def scorecard(t):
    return G.scorecard(t.signals).select("service_name", "owner_team", "criticality", "operational_health_score",
                                         "operational_status", "primary_improvement_area")


@query("decision_log", f"""
WITH {CARD.strip()}
SELECT 'DEC-' || upper(substr(sha256(service_name || '-2024-01-01 00:00:00'), 1, 12)) AS decision_id, service_name, owner_team,
  'Prioritise ' || area || ' for ' || service_name || ' at health score ' || printf('%.2f', hs) AS decision_summary,
  os AS evidence_status, CAST(high_risk_changes_30d AS BIGINT) AS evidence_changes, 'OPEN' AS status
FROM c2 WHERE os IN ('AT_RISK', 'CRITICAL_ATTENTION')""")
def decision_log(t):
    log = G.decision_log(G.scorecard(t.signals), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    e = F.from_json("evidence_json", "operational_status string, high_risk_changes_30d bigint")
    return log.select("decision_id", "service_name", "owner_team", "decision_summary",
                      e["operational_status"].alias("evidence_status"), e["high_risk_changes_30d"].alias("evidence_changes"),
                      "status")


@query("rightsizing_plan", """
WITH e AS (SELECT *, CASE WHEN target_resource IS NULL THEN 'unknown' WHEN contains(lower(target_resource), 'prod') THEN 'prod'
   WHEN regexp_matches(lower(target_resource), 'dev|test|uat|lab|sandbox') THEN 'dev' ELSE 'unknown' END AS env
   FROM recommendations WHERE estimated_monthly_saving >= 5),
 r AS (SELECT *, CASE WHEN env = 'prod' THEN 'HIGH' WHEN contains(recommender_id, 'IdleResourceRecommender') THEN 'MEDIUM'
   WHEN contains(recommender_id, 'MachineTypeRecommender') THEN 'MEDIUM'
   WHEN contains(recommender_id, 'OverprovisionedRecommender') THEN 'HIGH'
   WHEN contains(upper(subtype), 'ENDPOINT') THEN 'HIGH' ELSE 'MEDIUM' END AS risk FROM e),
 m AS (SELECT *, CASE WHEN env = 'prod' THEN 'MANUAL_APPROVAL' WHEN env = 'dev' AND risk IN ('LOW', 'MEDIUM')
   AND estimated_monthly_saving <= 100 THEN 'AUTO_ELIGIBLE_DRY_RUN' WHEN risk = 'HIGH' THEN 'MANUAL_APPROVAL'
   ELSE 'SEMI_AUTOMATIC' END AS automation_mode FROM r)
SELECT p_partkey, env AS environment, risk, automation_mode, automation_mode <> 'AUTO_ELIGIBLE_DRY_RUN' AS approval_required,
  CASE WHEN automation_mode = 'AUTO_ELIGIBLE_DRY_RUN' THEN 'DRY_RUN_ONLY' ELSE 'PROPOSED' END AS status FROM m""")
def rightsizing_plan(t):
    return G.rightsizing_plan(t.recommendations).select("p_partkey", "environment", "risk", "automation_mode",
                                                        "approval_required", "status")


def change_docs(t):
    c = t.spread().change_requests
    some = lambda cond, *v: F.when(cond, F.array(*[F.lit(x) for x in v])).otherwise(F.array().cast("array<string>"))
    before = F.create_map(F.lit("model_version"), "old_version", F.lit("threshold"), "old_threshold", F.lit("action"),
                          F.lit("alert_only"), F.lit("service_account_role"), F.lit("viewer"))
    after = F.create_map(F.lit("model_version"), "new_version", F.lit("threshold"), "new_threshold", F.lit("action"),
                         "new_action", F.lit("service_account_role"), "new_role")
    mask = F.col("approval_mask").cast("int")
    approvals = F.array_compact(F.array(
        F.when(mask.bitwiseAND(F.lit(1)) > 0, "owner_functional"), F.when(mask.bitwiseAND(F.lit(2)) > 0, "sre_operations"),
        F.when(mask.bitwiseAND(F.lit(4)) > 0, "security")))
    return c.select("o_orderkey", "change_id", "title", "environment", "change_type", F.lit("x").alias("requested_by"),
                    F.lit("f").alias("owner_functional"), F.lit("t").alias("owner_technical"), F.lit("r").alias("reason"),
                    some(F.lit(True), "res").alias("affected_resources"), before.alias("before"), after.alias("after"),
                    some(F.lit(True), "plan").alias("test_plan"), some(F.col("has_rollback"), "back").alias("rollback_plan"),
                    approvals.alias("approvals"), some(F.col("has_evidence"), "e").alias("evidence"))


@query("change_control", """
WITH p AS (SELECT *, new_action <> 'alert_only' AS tk, new_action = 'automatic_remediation' AS am,
   CASE WHEN environment = 'prod' THEN 3 ELSE 0 END + CASE WHEN change_type IN ('model_deployment', 'automation', 'iam') THEN 2 ELSE 0 END
   + CASE WHEN old_version <> new_version THEN 2 ELSE 0 END + CASE WHEN old_threshold <> new_threshold THEN 2 ELSE 0 END
   + CASE WHEN new_action <> 'alert_only' THEN 6 ELSE 0 END + CASE WHEN new_role <> 'viewer' THEN 3 ELSE 0 END
   + CASE WHEN new_action = 'automatic_remediation' THEN 4 ELSE 0 END AS s FROM change_requests),
 q AS (SELECT *, CASE WHEN s <= 2 THEN 'low' WHEN s <= 5 THEN 'medium' WHEN s <= 9 THEN 'high' ELSE 'critical' END AS risk FROM p),
 r AS (SELECT o_orderkey, s AS risk_points, risk AS calculated_risk, list_filter([
    CASE WHEN title = '' THEN 'missing field: title' END, CASE WHEN NOT has_rollback THEN 'missing field: rollback_plan' END,
    CASE WHEN risk IN ('high', 'critical') AND NOT has_rollback THEN 'rollback plan required' END,
    CASE WHEN environment = 'prod' AND NOT has_evidence THEN 'production change needs evidence' END,
    CASE WHEN environment = 'prod' AND approval_mask & 1 = 0 THEN 'functional owner approval required' END,
    CASE WHEN tk AND approval_mask & 2 = 0 THEN 'operations approval required' END,
    CASE WHEN am AND approval_mask & 4 = 0 THEN 'security approval required' END,
    CASE WHEN new_role <> 'viewer' THEN 'role change needs security review' END], lambda v: v IS NOT NULL) AS b,
   list_filter([CASE WHEN am AND risk <> 'critical' THEN 'automatic remediation is normally critical' END,
    CASE WHEN old_version <> new_version THEN 'model change: check metrics and rollback' END,
    CASE WHEN old_threshold <> new_threshold THEN 'threshold change: check alert volume' END], lambda v: v IS NOT NULL) AS w FROM q)
SELECT o_orderkey, risk_points, calculated_risk, array_to_string(b, '; ') AS blockers, array_to_string(w, '; ') AS warnings,
  CASE WHEN len(b) = 0 THEN 'ready_for_approval' ELSE 'blocked' END AS decision FROM r""")
def change_control(t):
    df = G.change_control(change_docs(t))
    return df.select("o_orderkey", "risk_points", "calculated_risk", F.array_join("blockers", "; ").alias("blockers"),
                     F.array_join("warnings", "; ").alias("warnings"), "decision")


def system_docs(t):
    """A nested system description per customer; some parts are missing."""
    k = F.col("c_custkey")
    word = lambda n: F.when(k % n == 0, F.lit(None)).otherwise(F.lit("x"))
    many = lambda n: F.slice(F.array(*[F.lit(c) for c in "abcde"]), F.lit(1), (k % n).cast("int"))
    return t.customer.select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.lit("prod").alias("environment"),
                 F.when(k % 2 == 0, "High").otherwise("low").alias("criticality"), word(5).alias("objective")).alias("system"),
        F.struct(F.lit("f").alias("functional"), F.when(k % 7 == 0, "").otherwise("t").alias("technical")).alias("owners"),
        F.struct(many(3).alias("components")).alias("architecture"),
        F.struct(F.lit("u").alias("dataset_uri"), F.lit("l").alias("label"), many(5).alias("features")).alias("data"),
        F.struct(F.lit("i").alias("id"), F.lit("v").alias("version"),
                 F.struct(F.lit(0.9).alias("precision"), F.lit(0.8).alias("recall")).alias("metrics")).alias("model"),
        F.struct(F.when(k % 3 == 0, "short").otherwise("restore the previous version").alias("rollback")).alias("operation"),
        F.struct(F.when(k % 4 == 0, "draft").otherwise("approved").alias("approval_status"), F.lit("d").alias("next_review_date"),
                 many(4).alias("approved_by"), many(2).alias("evidence")).alias("governance"))


@query("doc_findings", """
SELECT c_custkey, array_to_string(list_filter([
  CASE WHEN c_custkey % 5 = 0 THEN 'missing field: system.objective' END,
  CASE WHEN c_custkey % 7 = 0 THEN 'missing field: owners.technical' END,
  CASE WHEN c_custkey % 3 = 0 THEN 'missing field: architecture.components' END,
  CASE WHEN c_custkey % 5 = 0 THEN 'missing field: data.features' END,
  CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 < 2 THEN 'needs two approvers' END,
  CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 3 = 0 THEN 'rollback not described' END,
  CASE WHEN c_custkey % 5 < 3 THEN 'few documented features' END,
  CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 2 = 0 THEN 'approved without evidence' END], lambda v: v IS NOT NULL), '; ')
  AS findings FROM customer""")
def doc_findings(t):
    return G.doc_findings(system_docs(t)).select("c_custkey", F.array_join("findings", "; ").alias("findings"))


@query("missing_paths", """
SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_custkey % 5 = 0 THEN 'system.objective' END,
  CASE WHEN c_custkey % 7 = 0 THEN 'owners.technical' END, CASE WHEN c_custkey % 3 = 0 THEN 'architecture.components' END,
  'owners.absent'], lambda v: v IS NOT NULL), ';') AS missing FROM customer""")
def missing_paths(t):
    from opsight.functions.nested import missing_paths as missing

    d = system_docs(t)
    paths = ["system.name", "system.objective", "owners.technical", "architecture.components", "owners.absent"]
    return d.select("c_custkey", F.array_join(missing(d, paths), ";").alias("missing"))
