"""Join queries."""

from pyspark.sql import functions as F

from opsight.functions.scalar import minutes_between
from opsight.operators import joins as J
from opsight.plans.registry import query

CATALOG = {
    "click": {"owner_team": "web", "dependency": "cdn", "business_impact": "high", "business_impact_score": 4},
    "purchase": {"owner_team": "pay", "dependency": "ledger", "business_impact": "critical", "business_impact_score": 5},
    "error": {"owner_team": "sre", "dependency": "logs", "business_impact": "critical", "business_impact_score": 5},
    "signup": {"owner_team": "growth", "dependency": "mail", "business_impact": "medium", "business_impact_score": 3},
}


def catalog_case(field: str) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    arms = " ".join(f"WHEN '{k}' THEN {quote(v[field])}" for k, v in CATALOG.items())
    return f"CASE service {arms} END"


@query("enrich_catalog", f"""
SELECT tiebreak, service, {catalog_case('owner_team')} AS owner_team, {catalog_case('dependency')} AS dependency,
       {catalog_case('business_impact')} AS business_impact,
       {catalog_case('business_impact_score')} AS business_impact_score FROM metrics""")
def enrich_catalog(t):
    return J.enrich_catalog(t.metrics.select("tiebreak", "service"), "service", CATALOG)


@query("asof_join", """
SELECT m.tiebreak, c.change_id, c.change_type, coalesce(c.deployment_version, 'v0') AS deployment_version,
       date_diff('microsecond', c.change_ts, m.ts) / 6e7 AS minutes_since_change
FROM metrics m ASOF LEFT JOIN changes c ON m.user_id = c.user_id AND m.ts >= c.change_ts""")
def asof_join(t):
    left = t.metrics.select("user_id", "ts", "tiebreak")
    joined = J.asof_join(left, t.changes, ["user_id"], "ts", "change_ts",
                         ["change_id", "change_type", "deployment_version"], "tiebreak", "change_no", bucket="1 day")
    return joined.select(
        "tiebreak", "change_id", "change_type",
        F.coalesce("deployment_version", F.lit("v0")).alias("deployment_version"),
        minutes_between("ts", "change_ts").alias("minutes_since_change"),
    )


@query("service_share", """
SELECT usage_date, service, round(net_cost, 6) AS net_cost,
       round(sum(net_cost) OVER (PARTITION BY usage_date), 6) AS total_cost,
       round(net_cost / nullif(sum(net_cost) OVER (PARTITION BY usage_date), 0), 6) AS service_share
FROM daily_cost""")
def service_share(t):
    from opsight.operators.cost import service_share as share

    df = share(t.daily_cost, "usage_date", "net_cost")
    return df.select("usage_date", "service", *[F.round(c, 6).alias(c) for c in ("net_cost", "total_cost", "service_share")])


CUTOFF = "(SELECT date_trunc('hour', max(event_ts)) FROM access)"


def cutoff(t):
    return t.access.agg(F.date_trunc("hour", F.max("event_ts")).alias("c")).scalar()


@query("join_baseline", f"""
WITH b AS (SELECT principal, count(*) * 1.0 AS baseline FROM access WHERE event_ts < {CUTOFF} GROUP BY principal),
     c AS (SELECT principal, count(*) AS events FROM access WHERE event_ts >= {CUTOFF} GROUP BY principal)
SELECT principal, events, CAST(coalesce(baseline, 1.0) AS DOUBLE) AS baseline FROM c LEFT JOIN b USING (principal)""")
def join_baseline(t):
    a, cut = t.access, cutoff(t)
    base = a.filter(F.col("event_ts") < cut).groupBy("principal").agg(F.count("*").cast("double").alias("baseline"))
    cur = a.filter(F.col("event_ts") >= cut).groupBy("principal").agg(F.count("*").alias("events"))
    return J.join_baseline(cur, base, ["principal"], "baseline")


@query("novel_pairs", f"""
SELECT DISTINCT principal, resource_name FROM access WHERE event_ts >= {CUTOFF}
EXCEPT SELECT principal, resource_name FROM access WHERE event_ts < {CUTOFF}""")
def novel_pairs(t):
    a, cut = t.access, cutoff(t)
    return J.novel_pairs(a.filter(F.col("event_ts") >= cut), a.filter(F.col("event_ts") < cut),
                         ["principal", "resource_name"])


@query("suppress_recent", """
SELECT incident_no, incident_id FROM incident_queue q
WHERE status = 'OPEN' AND NOT EXISTS (
  SELECT 1 FROM notification_log l WHERE l.incident_id = q.incident_id AND l.status IN ('SENT', 'DRY_RUN')
     AND l.created_ts >= TIMESTAMP '2002-01-01 00:00:00' - INTERVAL 60 MINUTE)""")
def suppress_recent(t):
    q = t.incident_queue.filter("status = 'OPEN'").select("incident_no", "incident_id")
    return J.suppress_recent(q, t.notification_log, "incident_id", "created_ts", "status", 60,
                             F.lit("2002-01-01 00:00:00").cast("timestamp"))




@query("match_runbooks", """
WITH books AS (SELECT runbook_id, lower(service_name) AS s, lower(symptoms) AS y FROM runbooks),
     pairs AS (SELECT DISTINCT lower(service_guess) AS s, lower(category) AS c FROM tickets),
     hits AS (SELECT p.s, p.c, b.runbook_id, row_number() OVER (PARTITION BY p.s, p.c ORDER BY b.runbook_id) AS rn
              FROM pairs p JOIN books b ON p.s = b.s OR b.y LIKE '%' || p.c || '%')
SELECT request_id, runbook_id, CAST(rn AS INTEGER) AS runbook_rank
FROM tickets JOIN hits ON lower(service_guess) = s AND lower(category) = c WHERE rn <= 5""")
def match_runbooks(t):
    return J.match_runbooks(t.tickets, t.runbooks)


@query("latest_n", """
SELECT service_name, report_no, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY service_name ORDER BY created_at DESC, report_no DESC) AS rank FROM reports)
WHERE rank <= 3""")
def latest_n(t):
    return J.latest_n(t.reports, ["service_name"], [F.desc("created_at"), F.desc("report_no")], 3).select(
        "service_name", "report_no", "rank"
    )


@query("union_all", """
SELECT 'metrics' AS origin, service, count(*) AS n FROM metrics GROUP BY service
UNION ALL SELECT 'incidents', service, count(*) FROM incidents GROUP BY service""")
def union_all(t):
    a = t.metrics.groupBy("service").count().withColumnRenamed("count", "n").withColumn("origin", F.lit("metrics"))
    b = t.incidents.groupBy("service").count().withColumnRenamed("count", "n").withColumn("origin", F.lit("incidents"))
    return J.union_all(a, b)


@query("dedup", """
SELECT user_id, service, tiebreak, latency_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, service ORDER BY ts, tiebreak) AS rn FROM metrics) WHERE rn = 1""")
def dedup(t):
    m = t.metrics.select("user_id", "service", "ts", "tiebreak", "latency_ms")
    return J.dedup(m, ["user_id", "service"], ["ts", "tiebreak"]).drop("ts")


@query("key_diff", """
(SELECT id, 'left' AS side FROM (SELECT runbook_id AS id FROM runbooks EXCEPT SELECT request_id + 700 FROM tickets))
UNION ALL
(SELECT id, 'right' AS side FROM (SELECT request_id + 700 AS id FROM tickets EXCEPT SELECT runbook_id FROM runbooks))""")
def key_diff(t):
    return J.key_diff(t.runbooks.select(F.col("runbook_id").alias("id")), t.tickets.select((F.col("request_id") + 700).alias("id")))
