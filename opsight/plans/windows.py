"""Window queries over the service metrics."""

from pyspark.sql import functions as F

from opsight.functions.scalar import as_int
from opsight.operators import windows as W
from opsight.operators.ordered import running_sum
from opsight.plans.registry import query

KEYS, ORDER = ["service"], ["ts", "tiebreak"]
OVER = "PARTITION BY service ORDER BY ts, tiebreak"


@query("rolling", f"""
SELECT tiebreak,
       CASE WHEN count(latency_ms) OVER w >= 24 THEN round(avg(latency_ms) OVER w, 6) END AS latency_ms_rolling_mean,
       CASE WHEN count(latency_ms) OVER w >= 24 THEN round(stddev_samp(latency_ms) OVER w, 6) END
         AS latency_ms_rolling_std
FROM metrics WINDOW w AS ({OVER} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def rolling(t):
    df = W.rolling(t.metrics.select("service", "ts", "tiebreak", "latency_ms"), KEYS, ORDER, "latency_ms", 24)
    return df.select("tiebreak", *[F.round(c, 6).alias(c) for c in df.columns if "rolling" in c])


@query("rolling_zscore", f"""
SELECT tiebreak,
       CASE WHEN count(latency_ms) OVER w >= 20
            THEN round((latency_ms - avg(latency_ms) OVER w) / nullif(stddev_samp(latency_ms) OVER w, 0), 6) END
         AS latency_ms_zscore,
       CASE WHEN count(request_count) OVER w >= 20
            THEN round((request_count - avg(request_count) OVER w) / nullif(stddev_samp(request_count) OVER w, 0), 6)
       END AS request_count_zscore
FROM metrics WINDOW w AS ({OVER} ROWS BETWEEN 44 PRECEDING AND CURRENT ROW)""")
def rolling_zscore(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms", "request_count")
    df = W.rolling_zscore(m, KEYS, ORDER, ["latency_ms", "request_count"])
    return df.select("tiebreak", *[F.round(c, 6).alias(c) for c in df.columns if c.endswith("zscore")])


@query("rolling_quantile", f"""
SELECT tiebreak,
       CASE WHEN count(*) OVER w >= 288 THEN round(quantile_cont(latency_ms, 0.95) OVER w, 6) END AS latency_p95,
       CASE WHEN count(*) OVER w >= 288 THEN round(quantile_cont(request_count, 0.05) OVER w, 6) END AS traffic_p05
FROM metrics WINDOW w AS ({OVER} ROWS BETWEEN 287 PRECEDING AND CURRENT ROW)""")
def rolling_quantile(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms", "request_count")
    df = W.rolling_quantile(
        m, KEYS, ORDER, {"latency_p95": ("latency_ms", 0.95), "traffic_p05": ("request_count", 0.05)}, 288
    )
    return df.select("tiebreak", F.round("latency_p95", 6).alias("latency_p95"),
                     F.round("traffic_p05", 6).alias("traffic_p05"))


@query("prior_rolling", f"""
SELECT tiebreak,
       CASE WHEN count(latency_ms) OVER w >= 3 THEN round(avg(latency_ms) OVER w, 6) END AS latency_ms_prior_mean,
       CASE WHEN count(latency_ms) OVER w >= 3 THEN round(stddev_samp(latency_ms) OVER w, 6) END
         AS latency_ms_prior_std
FROM metrics WINDOW w AS ({OVER} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def prior_rolling(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms")
    df = W.prior_rolling(m, KEYS, ORDER, "latency_ms", 7, 3)
    return df.select("tiebreak", *[F.round(c, 6).alias(c) for c in df.columns if "prior" in c])


@query("lags", f"""
SELECT tiebreak, lag(latency_ms, 1) OVER w AS latency_ms_lag_1, lag(latency_ms, 2) OVER w AS latency_ms_lag_2,
       lag(latency_ms, 7) OVER w AS latency_ms_lag_7
FROM metrics WINDOW w AS ({OVER})""")
def lags(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms")
    return W.lags(m, KEYS, ORDER, "latency_ms", [1, 2, 7]).drop("service", "ts", "latency_ms")


@query("lead_target", f"""
SELECT tiebreak, lead(latency_ms) OVER ({OVER}) AS target_next FROM metrics""")
def lead_target(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms")
    return W.lead_target(m, KEYS, ORDER, "latency_ms", "target_next").select("tiebreak", "target_next")


@query("lag_features", f"""
WITH f AS (
  SELECT tiebreak, lag(latency_ms, 1) OVER w AS latency_ms_lag_1, lag(latency_ms, 2) OVER w AS latency_ms_lag_2,
         lag(latency_ms, 3) OVER w AS latency_ms_lag_3, lag(latency_ms, 6) OVER w AS latency_ms_lag_6,
         avg(latency_ms) OVER w3 AS latency_ms_roll_mean_3, avg(latency_ms) OVER w6 AS latency_ms_roll_mean_6,
         max(latency_ms) OVER w6 AS latency_ms_roll_max_6, avg(error_rate) OVER w3 AS error_rate_roll_mean_3,
         avg(cpu) OVER w3 AS cpu_roll_mean_3, lead(latency_ms) OVER w AS target_next
  FROM metrics
  WINDOW w AS ({OVER}), w3 AS ({OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
         w6 AS ({OVER} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT * REPLACE (round(latency_ms_roll_mean_3, 6) AS latency_ms_roll_mean_3,
                  round(latency_ms_roll_mean_6, 6) AS latency_ms_roll_mean_6,
                  round(error_rate_roll_mean_3, 6) AS error_rate_roll_mean_3,
                  round(cpu_roll_mean_3, 6) AS cpu_roll_mean_3)
FROM f WHERE latency_ms_lag_6 IS NOT NULL AND target_next IS NOT NULL""")
def lag_features(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms", "error_rate", "cpu")
    df = W.lag_features(
        m, KEYS, ORDER, "latency_ms",
        means={"latency_ms": [3, 6], "error_rate": [3], "cpu": [3]}, maxima={"latency_ms": [6]},
    )
    return df.select(
        "tiebreak",
        *[F.round(c, 6).alias(c) if "mean" in c else F.col(c)
          for c in df.columns if "_lag_" in c or "_roll_" in c or c == "target_next"],
    )


@query("future_label", f"""
SELECT tiebreak, CASE WHEN lead(1, 9) OVER ({OVER}) IS NULL THEN 0
       ELSE max(incident_active) OVER ({OVER} ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) END AS future_label
FROM metrics""")
def future_label(t):
    m = t.metrics.select("service", "ts", "tiebreak", "incident_active")
    return W.future_label(m, KEYS, ORDER, "incident_active", 10).select("tiebreak", "future_label")


@query("since_last_event", f"""
WITH c AS (
  SELECT tiebreak, ts, last_value(CASE WHEN deployment_event = 1 THEN ts END IGNORE NULLS)
           OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_event_ts
  FROM metrics)
SELECT tiebreak, last_event_ts,
       coalesce(date_diff('microsecond', last_event_ts, ts) / 6e7, 9999.0) AS minutes_since_event,
       CASE WHEN coalesce(date_diff('microsecond', last_event_ts, ts) / 6e7, 9999.0) BETWEEN 0 AND 60
            THEN 1 ELSE 0 END AS recent_event
FROM c""")
def since_last_event(t):
    m = t.metrics.select("service", "ts", "tiebreak", "deployment_event")
    df = W.since_last_event(m, KEYS, ORDER, F.col("deployment_event") == 1)
    return df.select("tiebreak", "last_event_ts",
                     "minutes_since_event", "recent_event")


@query("deployment_group", f"""
SELECT tiebreak, CAST(sum(deployment_event) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS deployment_group
FROM metrics""")
def deployment_group(t):
    m = t.metrics.select("service", "ts", "tiebreak", "deployment_event")
    return running_sum(m, KEYS, ORDER, F.col("deployment_event"), "deployment_group").select(
        "tiebreak", "deployment_group"
    )


@query("sessionize", """
WITH times AS (SELECT DISTINCT ts FROM metrics WHERE latency_ms > 150),
     marked AS (SELECT ts, CASE WHEN date_diff('microsecond', lag(ts) OVER (ORDER BY ts), ts) > 600000000
                                THEN 1 ELSE 0 END AS starts FROM times),
     numbered AS (SELECT ts, CAST(1 + sum(starts) OVER (ORDER BY ts) AS BIGINT) AS session_id FROM marked)
SELECT tiebreak, session_id FROM metrics JOIN numbered USING (ts) WHERE latency_ms > 150""")
def sessionize(t):
    m = t.metrics.filter("latency_ms > 150").select("ts", "tiebreak")
    return W.sessionize(m, "ts", 10).select("tiebreak", "session_id")


@query("tail_per_key", f"""
SELECT service, tiebreak, latency_ms, CAST(recency AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY service ORDER BY ts DESC, tiebreak DESC) AS recency FROM metrics)
WHERE recency <= 3""")
def tail_per_key(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms")
    return W.tail_per_key(m, ["service"], [F.desc("ts"), F.desc("tiebreak")], 3).drop("ts")


@query("temporal_split", """
WITH r AS (SELECT tiebreak, row_number() OVER (ORDER BY ts, tiebreak) AS rn, count(*) OVER () AS n FROM metrics)
SELECT tiebreak, CASE WHEN rn <= CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'training'
                      WHEN rn <= CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT) THEN 'validation'
                      ELSE 'test' END AS split FROM r""")
def temporal_split(t):
    return W.temporal_split(t.metrics.select("ts", "tiebreak"), "ts", "tiebreak").select("tiebreak", "split")


@query("date_split", """
SELECT usage_date, service, CASE WHEN usage_date > (SELECT max(usage_date) FROM daily_cost) - INTERVAL 14 DAY
       THEN 'test' ELSE 'train' END AS split FROM daily_cost""")
def date_split(t):
    return W.date_split(t.daily_cost.select("usage_date", "service"), "usage_date", 14)


@query("sustained_alert", """
WITH w AS (SELECT service, time_bucket(INTERVAL 1 MINUTE, ts) AS p, avg(latency_ms) AS mean_value
           FROM metrics GROUP BY ALL HAVING avg(latency_ms) > 20),
     i AS (SELECT *, CAST(date_diff('minute', TIMESTAMP '2020-01-01', p) AS BIGINT)
                     - row_number() OVER (PARTITION BY service ORDER BY p) AS island FROM w)
SELECT service, min(p) AS alert_start, count(*) AS periods, round(max(mean_value), 6) AS peak_mean,
       max(p) + INTERVAL 1 MINUTE AS alert_end
FROM i GROUP BY service, island HAVING count(*) >= 2""")
def sustained_alert(t):
    m = t.metrics.select("service", "ts", "latency_ms")
    return W.sustained_alert(m, ["service"], "ts", "latency_ms", 20.0, consecutive=2).withColumn(
        "peak_mean", F.round("peak_mean", 6)
    )
