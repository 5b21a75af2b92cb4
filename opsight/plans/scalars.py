"""Projection, scalar function and predicate queries."""

from pyspark.sql import functions as F

from opsight.functions import audit as U, nested as N, scalar as S
from opsight.operators.windows import tail_per_key
from opsight.plans.registry import query


@query("latest_points", """
SELECT service, environment, region, tiebreak, latency_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY service, environment, region ORDER BY ts DESC, tiebreak DESC) AS rn
  FROM metrics WHERE ts >= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 600 MINUTE
    AND ts <= TIMESTAMP '2024-01-30 23:00:00') WHERE rn = 1""")
def latest_points(t):
    from opsight.sources.gauges import latest_points as latest

    df = latest(t.metrics, ["service", "environment", "region"], "ts", 600,
                F.lit("2024-01-30 23:00:00").cast("timestamp"), "tiebreak")
    return df.select("service", "environment", "region", "tiebreak", "latency_ms")


@query("case_ladder", """
SELECT observation_no, CASE WHEN metric = 'latency_ms' THEN
           CASE WHEN value >= 1500 THEN 'critical' WHEN value >= 800 THEN 'warning' ELSE 'info' END
         WHEN metric = 'error_rate' THEN
           CASE WHEN value >= 0.15 THEN 'critical' WHEN value >= 0.05 THEN 'warning' ELSE 'info' END
         ELSE CASE WHEN value >= 90 THEN 'critical' WHEN value >= 75 THEN 'warning' ELSE 'info' END END AS severity
FROM observations""")
def case_ladder(t):
    from opsight.operators.decisions import observation_severity

    return t.observations.select("observation_no", observation_severity("metric", "value").alias("severity"))


@query("bin_label", """
SELECT tiebreak, CASE WHEN r > -0.01 AND r <= 0.35 THEN 'low' WHEN r > 0.35 AND r <= 0.7 THEN 'medium'
                      WHEN r > 0.7 AND r <= 1.01 THEN 'high' END AS risk_level,
       CASE WHEN latency_ms >= 0 AND latency_ms < 30 THEN 'low' WHEN latency_ms >= 30 AND latency_ms < 70 THEN 'medium'
            WHEN latency_ms >= 70 THEN 'high' END AS latency_level
FROM (SELECT tiebreak, latency_ms, latency_ms / 100 AS r FROM metrics)""")
def bin_label(t):
    return t.metrics.select(
        "tiebreak",
        S.bin_label(F.col("latency_ms") / 100, [-0.01, 0.35, 0.70, 1.01], ["low", "medium", "high"]).alias("risk_level"),
        S.bin_label("latency_ms", [0, 30, 70, float("inf")], ["low", "medium", "high"], right=False).alias(
            "latency_level"
        ),
    )


@query("calendar_features", """
SELECT tiebreak, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month, month(ts) AS month,
       CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(hour(ts) BETWEEN 9 AND 18 AS INTEGER) AS is_business_hours,
       date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM metrics), CAST(ts AS DATE)) AS trend_index FROM metrics""")
def calendar_features(t):
    return S.calendar_features(t.metrics.select("tiebreak", "ts"), "ts").drop("ts")


@query("minutes_between", """
SELECT incident_no, date_diff('microsecond', started_at, resolved_at) / 6e7 AS mttr_min FROM incidents""")
def minutes_between(t):
    return t.incidents.select("incident_no", S.minutes_between("resolved_at", "started_at").alias("mttr_min"))


@query("clamp", """
SELECT service_name, least(100, greatest(0, 100 - avg_mtta_minutes * 4)) AS response_score FROM signals""")
def clamp(t):
    return t.signals.select("service_name", S.clamp(100 - F.col("avg_mtta_minutes") * 4, 0, 100).alias("response_score"))


@query("safe_ratio", """
SELECT event_id, CASE WHEN expected = 0 THEN NULL ELSE latency / expected END AS ratio,
       CASE WHEN expected = 0 THEN 0 ELSE latency / expected END AS ratio_or_zero
FROM (SELECT event_id, value AS latency, CAST(user_id % 4 AS DOUBLE) AS expected FROM events)""")
def safe_ratio(t):
    e = t.events.select("event_id", "value", (F.col("user_id") % 4).alias("expected"))
    return e.select("event_id", S.safe_ratio("value", "expected").alias("ratio"),
                    S.safe_ratio("value", "expected", 0).alias("ratio_or_zero"))


@query("parse_numbers", """
SELECT event_id, coalesce(CAST(trunc(TRY_CAST(latency_ms AS DOUBLE)) AS BIGINT), 0) AS latency_int,
       coalesce(TRY_CAST(error_rate AS DOUBLE), 0.0) AS error_float FROM enriched""")
def parse_numbers(t):
    return t.enriched.select("event_id", S.to_int_or("latency_ms").alias("latency_int"),
                             S.to_float_or("error_rate").alias("error_float"))


NORMAL = """CASE WHEN severity IS NULL OR severity = '' THEN 'INFO' WHEN upper(severity) = 'WARNING' THEN 'WARN'
WHEN upper(severity) IN ('ALERT', 'EMERGENCY', 'FATAL') THEN 'CRITICAL' ELSE upper(severity) END"""


@query("normalize_severity", f"SELECT event_id, {NORMAL} AS severity FROM enriched")
def normalize_severity(t):
    return t.enriched.select("event_id", S.normalize_severity("severity").alias("severity"))


@query("severity_rank", """
SELECT event_id, CASE upper(severity) WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4
       ELSE 0 END AS rank FROM anomalies_in""")
def severity_rank(t):
    return t.anomalies_in.select("event_id", S.severity_rank("severity", S.ACTION_SEVERITY).alias("rank"))


@query("message_codec", """
SELECT event_id, service, anomaly_score FROM anomalies_in""")
def message_codec(t):
    wire = t.anomalies_in.select("event_id", N.encode_message("service", "anomaly_score").alias("data"))
    return wire.withColumn("m", N.decode_message("data", "service string, anomaly_score double")).select(
        "event_id", "m.service", "m.anomaly_score"
    )


@query("json_pick", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN json_extract_string(props, '$.k') IS NULL
  THEN '{}' ELSE '{"k":"' || json_extract_string(props, '$.k') || '"}' END AS picked FROM events""")
def json_pick(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                           N.json_pick("props", ["k", "absent"]).alias("picked"))


@query("money_to_double", """
SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS DOUBLE)
       + CAST(o_orderkey % 1000000000 AS DOUBLE) / 1000000000 AS saving FROM orders""")
def money_to_double(t):
    money = F.struct(F.floor("o_totalprice").cast("string").alias("units"),
                     (F.col("o_orderkey") % 1_000_000_000).alias("nanos"))
    return t.orders.select("o_orderkey", S.money_to_double(money).alias("saving"))


def operation_groups():
    """A recommendation's operation groups built from a part: an empty group, then two operations."""
    operation = lambda action, path, value, resource: F.struct(
        F.lit(action).alias("action"), F.lit(path).alias("path"), value.alias("value"), resource.alias("resource"))
    return F.array(
        F.struct(F.array().cast("array<struct<action:string,path:string,value:string,resource:string>>").alias("operations")),
        F.struct(F.array(
            operation("test", "/size", F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name"))),
            operation("replace", "/type", F.col("p_type"), F.col("p_brand")),
        ).alias("operations")),
    )


@query("nested_operations", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS target_resource,
       '[{"action":"test","path":"/size","value":"' || CAST(p_size AS VARCHAR)
         || '"},{"action":"replace","path":"/type","value":"' || p_type || '"}]' AS operations_summary FROM part""")
def nested_operations(t):
    g = t.part.withColumn("groups", operation_groups())
    return g.select("p_partkey", N.first_target_resource("groups").alias("target_resource"),
                    N.operations_summary("groups").alias("operations_summary"))


@query("array_sum", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 0 - l_extendedprice * l_discount - l_tax END AS credit FROM lineitem""")
def array_sum(t):
    credits = F.when(F.col("l_linenumber") % 3 != 0, F.array(
        F.struct((0 - F.col("l_extendedprice") * F.col("l_discount")).alias("amount")),
        F.struct((0 - F.col("l_tax")).alias("amount"))))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             S.array_sum(credits, "amount").alias("credit"))


@query("prob_of_label", """
SELECT event_no, score AS failure_probability FROM predictions""")
def prob_of_label(t):
    probs = F.array(F.struct(F.lit(0).alias("label"), (1 - F.col("score")).alias("prob")),
                    F.struct(F.lit(1).alias("label"), F.col("score").alias("prob")))
    return t.predictions.select("event_no", S.prob_of_label(probs, 1).alias("failure_probability"))


@query("contains_any", """
SELECT event_id, lower(resource_name) LIKE '%prod%' OR lower(resource_name) LIKE '%security%'
  OR lower(resource_name) LIKE '%raw%' OR lower(resource_name) LIKE '%iam%' OR lower(resource_name) LIKE '%secrets%'
  AS is_sensitive_resource FROM access""")
def contains_any(t):
    tokens = ["prod", "security", "raw", "iam", "secrets"]
    return t.access.select("event_id", S.contains_any("resource_name", tokens).alias("is_sensitive_resource"))


def score_sql(column: str, weights: dict) -> str:
    return " + ".join(f"CASE WHEN contains(lower({column}), '{k}') THEN {p} ELSE 0 END" for k, p in weights.items())


@query("keyword_score", f"""
SELECT event_id, {score_sql('method_name', U.METHOD_KEYWORDS)} AS method_score,
       {score_sql('resource_name', U.RESOURCE_TOKENS)} AS resource_score,
       array_to_string(list_filter([{', '.join(f"CASE WHEN contains(lower(resource_name), '{k}') THEN 'resource: {k}' END" for k in U.RESOURCE_TOKENS)}],
         lambda v: v IS NOT NULL), '; ') AS reasons FROM access""")
def keyword_score(t):
    return t.access.select(
        "event_id", U.keyword_score("method_name", U.METHOD_KEYWORDS).alias("method_score"),
        U.keyword_score("resource_name", U.RESOURCE_TOKENS).alias("resource_score"),
        F.array_join(U.keyword_reasons("resource_name", U.RESOURCE_TOKENS, "resource: "), "; ").alias("reasons"))


@query("classify_environment", """
SELECT p_partkey, CASE WHEN target_resource IS NULL OR target_resource = '' THEN 'unknown'
  WHEN contains(lower(target_resource), 'prod') THEN 'prod'
  WHEN contains(lower(target_resource), 'dev') OR contains(lower(target_resource), 'test')
    OR contains(lower(target_resource), 'uat') OR contains(lower(target_resource), 'lab')
    OR contains(lower(target_resource), 'sandbox') THEN 'dev' ELSE 'unknown' END AS environment FROM recommendations""")
def classify_environment(t):
    return t.recommendations.select("p_partkey", U.classify_environment("target_resource").alias("environment"))


PRINCIPALS = """CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'service-1@gcp-sa-x.iam.gserviceaccount.com'
 WHEN 2 THEN 'robot@p.iam.gserviceaccount.com' WHEN 3 THEN c_name || '@example.com' WHEN 4 THEN 'principal://pool/x'
 WHEN 5 THEN 'principalSet://pool/y' ELSE c_name END"""


@query("classify_principal", f"""
SELECT c_custkey, CASE WHEN p = '' THEN 'UNKNOWN' WHEN starts_with(p, 'service-') AND contains(p, 'gcp-sa-')
  THEN 'SERVICE_AGENT' WHEN ends_with(p, '.gserviceaccount.com') THEN 'SERVICE_ACCOUNT' WHEN contains(p, '@') THEN 'USER'
  WHEN starts_with(p, 'principal://') OR starts_with(p, 'principalSet://') THEN 'FEDERATED' ELSE 'OTHER' END
  AS principal_type FROM (SELECT c_custkey, {PRINCIPALS} AS p FROM customer)""")
def classify_principal(t):
    c = t.customer.select("c_custkey", F.expr(PRINCIPALS).alias("p"))
    return c.select("c_custkey", U.classify_principal("p").alias("principal_type"))


@query("slugify", r"""
SELECT event_no, regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(x, '^\s+|\s+$', '', 'g')),
   '[^a-z0-9-]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS slug
FROM (SELECT c_custkey AS event_no, ' --' || c_name || ' / ' || c_mktsegment || '!_ ' AS x FROM customer)""")
def slugify(t):
    x = F.concat(F.lit(" --"), "c_name", F.lit(" / "), "c_mktsegment", F.lit("!_ "))
    return t.customer.select(F.col("c_custkey").alias("event_no"), S.slugify(x).alias("slug"))


@query("stable_id", """
SELECT doc_id, substr(sha256(CAST(doc_id AS VARCHAR) || '-' || source || '-' || text), 1, 20) AS chunk_id FROM documents""")
def stable_id(t):
    return t.documents.select("doc_id", S.stable_id("doc_id", "source", "text", length=20).alias("chunk_id"))


SETTINGS = {"version": ("old_version", "new_version"), "threshold": ("old_threshold", "new_threshold")}


@query("map_diff", """
SELECT o_orderkey, array_to_string(list_filter([
   CASE WHEN new_action <> 'alert_only' THEN 'action: <undefined> -> ' || new_action END,
   CASE WHEN old_threshold <> new_threshold THEN 'threshold: ' || old_threshold || ' -> ' || new_threshold END,
   CASE WHEN old_version <> new_version THEN 'version: ' || old_version || ' -> ' || new_version END],
   lambda v: v IS NOT NULL), '; ') AS diff FROM change_requests""")
def map_diff(t):
    before = F.create_map(F.lit("version"), "old_version", F.lit("threshold"), "old_threshold")
    after = F.create_map(F.lit("version"), "new_version", F.lit("threshold"), "new_threshold")
    after = F.when(F.col("new_action") == "alert_only", after).otherwise(
        F.map_concat(after, F.create_map(F.lit("action"), "new_action")))
    return t.change_requests.select("o_orderkey", F.array_join(N.map_diff(before, after), "; ").alias("diff"))


@query("finite_or_null", """
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN NULL ELSE value / (user_id % 10) END AS ratio
FROM events WHERE user_id % 10 <> 0""")
def finite_or_null(t):
    d = (F.col("user_id") % 10).cast("double")
    raw = F.when(d == 0, F.lit(float("nan"))).otherwise(F.col("value") / d)
    return t.events.select("event_id", S.finite_or_null(raw).alias("ratio")).na.drop(subset=["ratio"])


@query("lookback", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 3 DAY""")
def lookback(t):
    return S.lookback(t.events, "ts", "3 DAYS", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).select("event_id", "ts")


@query("filter", """
SELECT event_id, value FROM events WHERE event_type IN ('error', 'signup') AND value >= 50""")
def filter_rows(t):
    return t.events.filter(F.col("event_type").isin("error", "signup") & (F.col("value") >= 50)).select("event_id", "value")
