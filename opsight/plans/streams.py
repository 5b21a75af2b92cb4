"""Streaming and source queries: the driver tables read as streams or written and read back."""

import re

from pyspark.sql import DataFrame, functions as F

from opsight.functions import text as X
from opsight.functions.nested import encode_message
from opsight.operators import decisions as D, security as Z
from opsight.plans.decisions import GOOD, MITIGATION_SQL, OBS_SEVERITY, ROUTE_SQL, SCORE_SQL, events_sql
from opsight.plans.registry import REGISTRY, query
from opsight.plans.text import replace_sql
from opsight.plans.views import VIEWS
from opsight.session import materialise
from opsight.sources import files as FS, messages as M, tables as T
from opsight.streaming import pipelines as S
from opsight.streaming.parse import dead_letters, normalised, parse_messages


def stream(t, view: str) -> DataFrame:
    """An adapter view over its table read as a stream of files."""
    (table,) = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", VIEWS[view]))
    source = M.read_stream(t.spark, t.sf_dir, t.table(table).schema, "parquet", glob=f"{table}.parquet")
    return t.spark.sql(VIEWS[view], **{table: source})


@query("write_split", f"""
WITH {events_sql().strip()}
SELECT event_id, 'events' AS sink FROM n WHERE {GOOD} UNION ALL SELECT event_id, 'dead' FROM n WHERE NOT ({GOOD})""")
def write_split(t):
    folder = S.run_split(lambda f, c: S.parse_split(stream(t, "messages"), f, c), t.spark, "split")
    parts = [t.spark.read.parquet(f"{folder}/{s}").select("event_id", F.lit(s).alias("sink")) for s in ("events", "dead")]
    return parts[0].union(parts[1])


@query("restart_split", f"""
WITH {events_sql().strip()},
rows AS (SELECT event_id, 'events' AS sink FROM n WHERE {GOOD} UNION ALL SELECT event_id, 'dead' FROM n WHERE NOT ({GOOD}))
SELECT event_id, sink, 1 AS restarts, CAST(count(*) AS BIGINT) AS n FROM rows GROUP BY event_id, sink""")
def restart_split(t):
    """The split whose second write fails once after the first was done, then goes on from its checkpoint."""
    folder, failures = S.scratch(t.spark, "restart"), []

    def dead(batch: DataFrame) -> DataFrame:
        if not failures:
            failures.append("the sink is gone")
            raise ConnectionError(failures[0])
        return dead_letters(batch)

    def start():
        rows = parse_messages(stream(t, "messages"), "raw")
        return M.write_split(rows, {"events": normalised, "dead": dead}, folder, f"{folder}/checkpoint")

    restarts = S.run_restarting(start)
    parts = [t.spark.read.parquet(f"{folder}/{s}").select("event_id", F.lit(s).alias("sink")) for s in ("events", "dead")]
    return parts[0].union(parts[1]).groupBy("event_id", "sink").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "restarts", F.lit(restarts))


@query("classify_stream", REGISTRY["classify_event"].sql)
def classify_stream(t):
    return S.run_to_end(S.classify_stream(stream(t, "messages")), "classify").select(
        "event_id", "incident_type", "requires_attention")


@query("score_stream", SCORE_SQL)
def score_stream(t):
    return S.run_to_end(S.score_stream(stream(t, "enriched")), "score").select(
        "event_id", "incident_probability", "final_priority", "final_action", "prediction_status")


@query("fan_out", f"""
SELECT 'audit' AS sink, observation_no FROM observations
UNION ALL SELECT 'critical', observation_no FROM observations WHERE {OBS_SEVERITY} = 'critical'""")
def fan_out(t):
    folder = S.run_split(lambda f, c: S.fan_out(stream(t, "observations"), f, c), t.spark, "fan")
    parts = [t.spark.read.parquet(f"{folder}/{s}").select(F.lit(s).alias("sink"), "observation_no")
             for s in ("audit", "critical")]
    return parts[0].union(parts[1])


@query("mitigate_stream", MITIGATION_SQL)
def mitigate_stream(t):
    fields = ["event_id", "incident_id", "service", "environment", "anomaly_type", "severity", "anomaly_score", "latency_ms",
              "error_rate"]
    wire = stream(t, "anomalies_in").select(encode_message(*fields).alias("data"))
    return S.run_to_end(S.mitigate_stream(wire), "mitigate").select("event_id", "action", "allowed_to_execute", "reason")


@query("route_stream", f"SELECT * EXCLUDE (error) FROM ({ROUTE_SQL.strip()}) WHERE error IS NULL")
def route_stream(t):
    return S.run_to_end(S.route_stream(stream(t, "observations")), "route").select(
        "observation_no", "operation_id", "environment", "recommended_operation", "requires_human_review", "priority", "reason")


@query("to_messages", f"""
WITH r AS ({ROUTE_SQL.strip()})
SELECT r.observation_no, o.event_id AS key, o.service || '|' || r.recommended_operation || '|' || r.priority AS attributes
FROM r JOIN observations o USING (observation_no) WHERE error IS NULL""")
def to_messages(t):
    sent = S.run_to_end(S.operation_messages(S.route_stream(stream(t, "observations"))), "messages")
    no = F.get_json_object("value", "$.observation_no").cast("bigint")
    named = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return sent.withColumn("a", named).select(
        no.alias("observation_no"), "key",
        F.concat_ws("|", *[F.col("a")[k] for k in ("service", "recommended_operation", "priority")]).alias("attributes"))


@query("suppress_stream", """
WITH RECURSIVE d AS MATERIALIZED (SELECT DISTINCT service, ts FROM anomalies_in),
 n AS MATERIALIZED (SELECT a.service, a.ts, b.ts AS later FROM d a ASOF JOIN d b
   ON a.service = b.service AND a.ts + INTERVAL 60 MINUTE < b.ts),
 sent AS (SELECT service, min(ts) AS ts FROM d GROUP BY service
   UNION ALL SELECT n.service, n.later FROM sent JOIN n ON sent.service = n.service AND sent.ts = n.ts)
SELECT service, ts FROM sent""")
def suppress_stream(t):
    return S.run_to_end(S.suppress_stream(stream(t, "anomalies_in").select("service", "ts"), ["service"], "ts"), "suppress")


@query("tumbling_alert", """
WITH w AS (SELECT service, time_bucket(INTERVAL 1 MINUTE, ts) AS period_start, avg(latency_ms) AS m FROM metrics GROUP BY 1, 2)
SELECT service, period_start, round(m, 6) AS mean_value, m > 100 AS is_alert FROM w
WHERE period_start + INTERVAL 1 MINUTE <= date_trunc('millisecond', (SELECT max(ts) FROM metrics)) - INTERVAL 10 MINUTE""")
def tumbling_alert(t):
    df = S.run_to_end(S.tumbling_alert(stream(t, "metrics"), ["service"], "ts", "latency_ms", 100.0), "tumbling")
    return df.withColumn("mean_value", F.round("mean_value", 6))


@query("sliding_volume", """
WITH w AS (SELECT principal, time_bucket(INTERVAL 5 MINUTE, event_ts) - INTERVAL 5 MINUTE * i AS window_start
    FROM access, range(12) r(i)),
 c AS (SELECT principal, window_start, count(*) AS event_count FROM w
   WHERE window_start + INTERVAL 1 HOUR <= date_trunc('millisecond', (SELECT max(event_ts) FROM access)) - INTERVAL 10 MINUTE
   GROUP BY ALL),
 b AS (SELECT principal, quantile_cont(n, 0.5) AS bl FROM (SELECT principal, date_trunc('hour', event_ts) AS h, count(*) AS n
   FROM access WHERE event_ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL) GROUP BY principal)
SELECT principal, window_start, event_count, round(event_count / greatest(coalesce(bl, 1), 1), 6) AS volume_ratio,
  event_count / greatest(coalesce(bl, 1), 1) >= 2 AS is_anomaly FROM c LEFT JOIN b USING (principal)""")
def sliding_volume(t):
    # Read by every batch of the stream.
    base = materialise(Z.hourly_baseline(t.access, F.lit("2024-01-15 00:00:00").cast("timestamp")))
    df = S.run_to_end(S.sliding_volume(stream(t, "access"), base, ratio=2.0), "sliding")
    return df.withColumn("volume_ratio", F.round("volume_ratio", 6))


@query("session_incidents", """
WITH c AS (SELECT service, ts, CAST(floor(latency_ms) AS BIGINT) AS risk_score FROM metrics WHERE latency_ms > 100),
 m AS (SELECT *, CASE WHEN date_diff('microsecond', lag(ts) OVER w, ts) > 600000000 THEN 1 ELSE 0 END AS s FROM c
       WINDOW w AS (PARTITION BY service ORDER BY ts)),
 n AS (SELECT *, sum(s) OVER (PARTITION BY service ORDER BY ts) AS g FROM m)
SELECT service, min(ts) AS start_ts, count(*) AS candidates, max(risk_score) AS risk_score_max FROM n GROUP BY service, g
HAVING max(ts) + INTERVAL 10 MINUTE <= date_trunc('millisecond', (SELECT max(ts) FROM c)) - INTERVAL 30 MINUTE""")
def session_incidents(t):
    c = stream(t, "metrics").filter("latency_ms > 100").select(
        "service", "ts", F.floor("latency_ms").alias("risk_score"))
    return S.run_to_end(S.session_incidents(c, ["service"], "ts"), "sessions")


# ---------------------------------------------------------------- sources and sinks, written and read back

@query("read_events_csv", "SELECT event_id, principal, method_name, CAST(status_code AS INTEGER) AS status_code FROM access")
def read_events_csv(t):
    path = S.scratch(t.spark, "csv")
    FS.write_stage(t.access.select("event_id", "principal", "method_name", "status_code"), path, "csv")
    return FS.read_events_csv(t.spark, path, "event_id bigint, principal string, method_name string, status_code int",
                              ["principal", "method_name"])


@query("write_stage", "SELECT usage_date, service, round(net_cost, 4) AS net_cost FROM daily_cost")
def write_stage(t):
    path = S.scratch(t.spark, "stage")
    FS.write_stage(t.daily_cost.select("usage_date", "service", "net_cost"), path, "parquet")
    return t.spark.read.parquet(path).withColumn("net_cost", F.round("net_cost", 4))


@query("append_jsonl", "SELECT event_id, service FROM anomalies_in UNION ALL SELECT event_id, service FROM anomalies_in")
def append_jsonl(t):
    path = S.scratch(t.spark, "jsonl")
    rows = t.anomalies_in.select("event_id", "service")
    FS.append_jsonl(rows, path)
    FS.append_jsonl(rows, path)
    return t.spark.read.schema("event_id bigint, service string").json(path)


@query("read_documents", f"""
SELECT doc_id, length(content) AS n_chars, md5(content) AS digest
FROM (SELECT doc_id, {replace_sql("coalesce(text, '') || chr(10)", X.REDACTIONS)} AS content FROM documents)""")
def read_documents(t):
    """Every document written as a file of its own and read back, redacted."""
    path = S.scratch(t.spark, "docs")
    FS.write_documents(t.spread().documents.select("doc_id", "text"), path)
    docs = FS.read_documents(t.spark, path)
    return docs.select(F.regexp_extract("source_path", r"/doc=(-?\d+)[./]", 1).try_cast("bigint").alias("doc_id"),
                       F.length("content").alias("n_chars"), F.md5("content").alias("digest"))


@query("read_audit_json", REGISTRY["audit_risk"].sql if "audit_risk" in REGISTRY else None)
def read_audit_json(t):
    from opsight.plans.governance import nested_audit

    path = S.scratch(t.spark, "audit")
    # The entry's log name carries the event number through the nested shape.
    nested_audit(t).select(F.col("event_ts").cast("string").alias("timestamp"),
                           F.col("event_id").cast("string").alias("logName"), "protoPayload").write.json(path)
    scored = Z.audit_risk(FS.read_audit_json(t.spark, path))
    return scored.select(F.col("logName").cast("bigint").alias("event_id"), "principal", "service_domain", "status_code",
                         "risk_score", "risk_level", "denied_permissions")


@query("table_sinks", """
SELECT 'overwrite' AS step, count(*) AS n FROM requests UNION ALL SELECT 'append', 2 * count(*) FROM requests
UNION ALL SELECT 'refresh', count(*) FROM requests WHERE status_code = 500
UNION ALL SELECT 'materialize', count(DISTINCT service_name) FROM requests""")
def table_sinks(t):
    spark = t.spark
    path = S.scratch(spark, "tables")
    tag = path.rsplit("-", 1)[1]
    schema = "event_id bigint not null, event_ts timestamp, service_name string, status_code int, latency_ms bigint"
    main, log, roll = (f"{n}_{tag}" for n in ("requests", "log", "rollup"))
    steps = []

    def note(step, name):
        # The counts must be read before the next step changes the table.
        n = spark.table(name).count()
        steps.append(spark.range(1).select(F.lit(step).alias("step"), F.lit(n).cast("bigint").alias("n")))

    try:
        T.overwrite_table(t.requests, main, schema, f"{path}/main")
        note("overwrite", main)
        T.append_table(t.requests, main)
        note("append", main)
        T.ensure_table(spark, log, schema, f"{path}/log")
        T.refresh_table(t.requests.filter("status_code = 500"), log)
        note("refresh", log)
        T.materialize(t.requests.groupBy("service_name").count(), roll, f"{path}/roll")
        note("materialize", roll)
    finally:
        for name in (main, log, roll):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = steps[0]
    for s in steps[1:]:
        out = out.union(s)
    return out
