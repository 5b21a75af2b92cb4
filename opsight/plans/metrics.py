"""Aggregation queries: SLO, cost, KPI, quality, model metrics, drift and forecast."""

from pyspark.sql import functions as F

from opsight.functions.scalar import bin_label
from opsight.operators import cost as C, drift as R, forecast as P, joins as J, kpi as K, metrics as M, quality as Q, slo as L
from opsight.plans.registry import query
from opsight.session import materialise


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- service levels and KPIs

@query("daily_slo", """
WITH b AS (SELECT CAST(event_ts AS DATE) AS event_date, service_name, count(*) AS total_requests,
    count(*) FILTER (status_code < 500) AS ag, count(*) FILTER (latency_ms <= 500) AS lg,
    count(*) FILTER (status_code < 500 AND latency_ms <= 500) AS cg,
    count(*) FILTER (status_code >= 500) AS server_errors, count(*) FILTER (latency_ms > 500) AS slow_requests,
    quantile_disc(latency_ms, 0.95) AS latency_p95_ms, quantile_disc(latency_ms, 0.99) AS latency_p99_ms
  FROM requests GROUP BY ALL),
 c AS (SELECT *, total_requests * CAST(0.01 AS DOUBLE) AS budget, total_requests - cg AS bad_events FROM b)
SELECT event_date, service_name, total_requests, server_errors, slow_requests, latency_p95_ms, latency_p99_ms, bad_events,
  round(ag / total_requests, 6) AS availability_sli, round(lg / total_requests, 6) AS latency_sli,
  round(cg / total_requests, 6) AS combined_sli, round(bad_events / budget, 6) AS budget_consumed_ratio,
  CASE WHEN cg / total_requests < 0.99 THEN 'VIOLATION' WHEN bad_events / budget >= 0.75 THEN 'WARNING' ELSE 'OK' END
    AS slo_status FROM c""")
def daily_slo(t):
    df = L.daily_slo(t.requests)
    df = rounded(df, "availability_sli", "latency_sli", "combined_sli", "budget_consumed_ratio")
    return df.select("event_date", "service_name", "total_requests", "server_errors", "slow_requests", "latency_p95_ms",
                     "latency_p99_ms", "bad_events", "availability_sli", "latency_sli", "combined_sli",
                     "budget_consumed_ratio", "slo_status")


@query("latency_quantiles", """
SELECT service_name, CAST(event_ts AS DATE) AS event_date, quantile_disc(latency_ms, 0.95) AS p95,
  quantile_disc(latency_ms, 0.99) AS p99 FROM requests GROUP BY ALL""")
def latency_quantiles(t):
    r = t.requests.withColumn("event_date", F.to_date("event_ts"))
    return L.latency_quantiles(r, ["service_name", "event_date"], "latency_ms", {"p95": 0.95, "p99": 0.99})


@query("incident_kpis", """
WITH k AS (SELECT service, severity, environment, count(*) AS incidents,
   avg(date_diff('microsecond', started_at, detected_at) / 6e7) AS mttd,
   avg(date_diff('microsecond', detected_at, acknowledged_at) / 6e7) AS mtta,
   avg(date_diff('microsecond', started_at, resolved_at) / 6e7) AS mttr,
   CAST(sum(CAST(alert_generated AS INT)) AS BIGINT) AS ag, CAST(sum(CAST(alert_actionable AS INT)) AS BIGINT) AS aa,
   CAST(sum(CAST(predicted AS INT)) AS BIGINT) AS pr, CAST(sum(CAST(auto_remediation_attempted AS INT)) AS BIGINT) AS att,
   CAST(sum(CAST(auto_remediation_success AS INT)) AS BIGINT) AS asu FROM incidents GROUP BY ALL)
SELECT service, severity, environment, incidents, round(mttd, 6) AS mttd_min, round(mtta, 6) AS mtta_min,
   round(mttr, 6) AS mttr_min, ag AS alerts_generated, aa AS actionable_alerts,
   round(coalesce(aa / nullif(ag, 0), 0), 6) AS actionable_alert_rate, round(pr / incidents, 6) AS prediction_coverage,
   round(coalesce(asu / nullif(att, 0), 0), 6) AS auto_remediation_success_rate,
   round(incidents * 0.25 + mttd * 0.2 + mtta * 0.15 + mttr * 0.3 + (1 - coalesce(aa / nullif(ag, 0), 0)) * 20, 6)
     AS operational_risk_score FROM k""")
def incident_kpis(t):
    df = K.incident_kpis(t.incidents).drop("predicted_incidents", "auto_attempts", "auto_successes")
    return rounded(df, "mttd_min", "mtta_min", "mttr_min", "actionable_alert_rate", "prediction_coverage",
                   "auto_remediation_success_rate", "operational_risk_score")


SAVINGS = """
s0 AS (SELECT *, (baseline_incidents * baseline_avg_mttr_min - current_incidents * current_avg_mttr_min)
         * cost_per_downtime_min AS downtime_savings,
       (baseline_alerts - current_alerts) * CAST(4 AS DOUBLE) * 65 / 60 AS alert_noise_savings,
       automation_executions * CAST(18 AS DOUBLE) * 65 / 60 AS automation_savings,
       baseline_cloud_spend - current_cloud_spend AS cloud_savings FROM economics),
s1 AS (SELECT *, downtime_savings + alert_noise_savings + automation_savings + cloud_savings AS gross_savings FROM s0),
s2 AS (SELECT *, sum(gross_savings) OVER () AS g, count(*) OVER () AS n FROM s1),
s3 AS (SELECT *, CASE WHEN g > 0 THEN gross_savings / g * 9000 ELSE 9000.0 / n END AS allocated_cost FROM s2),
s AS (SELECT *, gross_savings - allocated_cost AS net_savings,
        CASE WHEN allocated_cost > 0 THEN (gross_savings - allocated_cost) / allocated_cost END AS roi FROM s3)"""


@query("savings", f"""
WITH {SAVINGS.strip()}
SELECT service, round(downtime_savings, 4) AS downtime_savings, round(alert_noise_savings, 4) AS alert_noise_savings,
  round(automation_savings, 4) AS automation_savings, round(cloud_savings, 4) AS cloud_savings,
  round(gross_savings, 4) AS gross_savings, round(allocated_cost, 4) AS allocated_cost,
  round(net_savings, 4) AS net_savings, round(roi, 4) AS roi FROM s""")
def savings(t):
    cols = ["downtime_savings", "alert_noise_savings", "automation_savings", "cloud_savings", "gross_savings",
            "allocated_cost", "net_savings", "roi"]
    return rounded(K.savings(t.economics), *cols, digits=4).select("service", *cols)


@query("executive_summary", f"""
WITH {SAVINGS.strip()},
 t AS (SELECT sum(gross_savings) AS g, sum(gross_savings) - 9000 AS net FROM s)
SELECT 'gross_savings' AS metric, round(g, 2) AS value FROM t UNION ALL SELECT 'platform_cost', 9000.0 FROM t
UNION ALL SELECT 'net_savings', round(net, 2) FROM t UNION ALL SELECT 'roi', round(net / 9000, 2) FROM t
UNION ALL SELECT 'payback_months', CASE WHEN net > 0 THEN round(28000 / net, 2) END FROM t""")
def executive_summary(t):
    return K.executive_summary(K.savings(t.economics)).select("metric", "value")


@query("savings_breakdown", f"""
WITH {SAVINGS.strip()},
 u AS (SELECT 'downtime_savings' AS category, round(sum(downtime_savings), 2) AS amount FROM s
  UNION ALL SELECT 'alert_noise_savings', round(sum(alert_noise_savings), 2) FROM s
  UNION ALL SELECT 'automation_savings', round(sum(automation_savings), 2) FROM s
  UNION ALL SELECT 'cloud_savings', round(sum(cloud_savings), 2) FROM s)
SELECT category, amount, round(amount / sum(amount) OVER () * 100, 2) AS percent_of_gross FROM u""")
def savings_breakdown(t):
    return K.savings_breakdown(K.savings(t.economics))


@query("savings_governance", f"""
WITH {SAVINGS.strip()}
SELECT service, CASE WHEN criticality = 'high' AND baseline_incidents >= 15 THEN 'HIGH'
   WHEN baseline_incidents >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level,
  CASE WHEN net_savings > 50000 THEN 'EXPAND' WHEN net_savings > 15000 THEN 'CONSOLIDATE' ELSE 'REVIEW' END
   AS executive_note FROM s""")
def savings_governance(t):
    return K.savings_governance(K.savings(t.economics)).select("service", "confidence_level", "executive_note")


# ---------------------------------------------------------------- cost

def nested_billing(t):
    amount = 0 - F.col("cost") * F.col("discount")
    return t.billing.withColumn("credits", F.array(F.struct(amount.alias("amount"))))


@query("billing_rollup", """
SELECT usage_date, source_project, service, sku, round(sum(cost), 4) AS gross_cost,
  round(sum(0 - cost * discount), 4) AS credits, round(sum(cost) + sum(0 - cost * discount), 4) AS net_cost
FROM billing GROUP BY ALL""")
def billing_rollup(t):
    return rounded(C.billing_rollup(nested_billing(t)), "gross_cost", "credits", "net_cost", digits=4)


DAILY = """
d AS (SELECT usage_date, service, gross_cost, credits, net_cost, sum(net_cost) OVER (PARTITION BY usage_date) AS total_cost,
        net_cost / nullif(sum(net_cost) OVER (PARTITION BY usage_date), 0) AS service_share FROM daily_cost)"""


@query("daily_service_cost", f"""
WITH {DAILY.strip()}
SELECT usage_date, service, round(gross_cost, 4) AS gross_cost, round(credits, 4) AS credits, round(net_cost, 4) AS net_cost,
  round(total_cost, 4) AS total_cost, round(service_share, 8) AS service_share FROM d""")
def daily_service_cost(t):
    df = C.daily_service_cost(C.billing_rollup(nested_billing(t)))
    return rounded(rounded(df, "gross_cost", "credits", "net_cost", "total_cost", digits=4), "service_share", digits=8)


@query("cost_by_service", f"""
WITH {DAILY.strip()}
SELECT service, round(sum(net_cost), 2) AS total_cost, round(avg(service_share), 8) AS avg_daily_share FROM d GROUP BY service""")
def cost_by_service(t):
    df = C.cost_by_service(C.daily_service_cost(t.daily_cost))
    return rounded(rounded(df, "total_cost", digits=2), "avg_daily_share", digits=8)


@query("cost_by_day", "SELECT usage_date, round(sum(net_cost), 4) AS total_cost FROM daily_cost GROUP BY usage_date")
def cost_by_day(t):
    return rounded(C.cost_by_day(t.daily_cost), "total_cost", digits=4)


@query("cost_spikes", """
WITH d AS (SELECT usage_date, sum(net_cost) AS total_cost FROM daily_cost GROUP BY usage_date),
 w AS (SELECT *, count(*) OVER w AS n, avg(total_cost) OVER w AS m, stddev_samp(total_cost) OVER w AS s FROM d
       WINDOW w AS (ORDER BY usage_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT usage_date, CASE WHEN n >= 7 THEN round(m + 3 * s, 4) END AS threshold_high,
  n >= 7 AND total_cost > m + 3 * s AS is_spike FROM w""")
def cost_spikes(t):
    return rounded(C.cost_spikes(t.daily_cost).select("usage_date", "threshold_high", "is_spike"), "threshold_high", digits=4)


@query("training_series", """
SELECT usage_date, service, round(sum(cost - cost * discount), 4) AS net_cost FROM billing
WHERE usage_date IS NOT NULL AND service IS NOT NULL GROUP BY ALL HAVING sum(cost - cost * discount) >= 0""")
def training_series(t):
    lines = t.billing.select("usage_date", "service", (F.col("cost") - F.col("cost") * F.col("discount")).alias("net_cost"))
    return rounded(C.training_series(lines), "net_cost", digits=4)


@query("series_profile", """
SELECT service, count(*) AS n_days, min(usage_date) AS first_day, max(usage_date) AS last_day,
  round(sum(net_cost), 2) AS total_cost, round(avg(net_cost), 4) AS avg_daily_cost, count(*) < 30 AS is_short
FROM daily_cost GROUP BY service""")
def series_profile(t):
    return rounded(rounded(C.series_profile(t.daily_cost), "total_cost", digits=2), "avg_daily_cost", digits=4)


@query("month_to_date", """
SELECT max(usage_date) AS last_actual_day, round(sum(CASE WHEN usage_date >= (SELECT date_trunc('month', max(usage_date))
  FROM daily_cost) THEN net_cost ELSE 0 END), 2) AS actual_month_cost FROM daily_cost""")
def month_to_date(t):
    return rounded(C.month_to_date(t.daily_cost), "actual_month_cost", digits=2)


# ---------------------------------------------------------------- forecast

def fit_sql(source: str, key: str, ts: str, y: str, step: str) -> str:
    seconds = {"day": 86400, "hour": 3600}[step]
    season = "isodow({}) - 1" if step == "day" else "hour({})"
    steps = f"CAST(floor(epoch(CAST({ts} AS TIMESTAMP)) / {seconds}) AS BIGINT)"
    return f"""
pts AS (SELECT {key} AS k, {y} AS y, {season.format(ts)} AS season, {steps} AS a,
          CAST({steps} - (SELECT min({steps}) FROM {source}) AS DOUBLE) AS x FROM {source}),
tr AS (SELECT k, regr_slope(y, x) AS slope, regr_intercept(y, x) AS icept, max(x) AS lst, max(a) AS lasta FROM pts GROUP BY k),
rs AS (SELECT pts.*, y - (icept + slope * x) AS r FROM pts JOIN tr USING (k)),
pr AS (SELECT k, season, avg(r) AS s FROM rs GROUP BY k, season),
sg AS (SELECT k, stddev_samp(r - s) AS se FROM rs JOIN pr USING (k, season) GROUP BY k)"""


def horizon_sql(h: int, step: str) -> str:
    unit = {"day": 86400, "hour": 3600}[step]
    season = "isodow(fts) - 1" if step == "day" else "hour(fts)"
    return f"""
ah AS (SELECT tr.*, se, i, make_timestamp((lasta + i) * {unit}000000) AS fts FROM tr JOIN sg USING (k), range(1, {h + 1}) r(i)),
fc AS (SELECT ah.*, icept + slope * (lst + i) + coalesce(s, 0) AS v FROM ah LEFT JOIN pr
        ON ah.k = pr.k AND pr.season = {season})"""


Z90 = "1.6448536269514715"
FC_COLS = f"""round(greatest(0, v), 4) AS forecast_value, round(greatest(0, v - {Z90} * se), 4) AS lower_bound,
  round(greatest(0, v + {Z90} * se), 4) AS upper_bound, round(se, 4) AS standard_error"""


def forecast_cols(df):
    return rounded(df.drop("raw_forecast_value"), "forecast_value", "lower_bound", "upper_bound", "standard_error", digits=4)


@query("forecast", f"""
WITH {fit_sql('daily_cost', 'service', 'usage_date', 'net_cost', 'day').strip()}, {horizon_sql(14, 'day').strip()}
SELECT k AS service, fts AS forecast_ts, {FC_COLS} FROM fc""")
def forecast(t):
    return forecast_cols(P.forecast(t.daily_cost, "service", "usage_date", "net_cost", 14, 0.90))


HOURLY = "h AS (SELECT service, date_trunc('hour', ts) AS hr, avg(latency_ms) AS latency FROM metrics GROUP BY ALL)"


def hourly_latency(t):
    return t.metrics.groupBy("service", F.date_trunc("hour", "ts").alias("hr")).agg(F.avg("latency_ms").alias("latency"))


@query("forecast_hourly", f"""
WITH {HOURLY}, {fit_sql('h', 'service', 'hr', 'latency', 'hour').strip()}, {horizon_sql(24, 'hour').strip()}
SELECT k AS service, fts AS forecast_ts, round(greatest(0, v), 4) AS forecast_value,
  round(greatest(0, v - 1.2815515655446004 * se), 4) AS lower_bound,
  round(greatest(0, v + 1.2815515655446004 * se), 4) AS upper_bound, round(se, 4) AS standard_error FROM fc""")
def forecast_hourly(t):
    return forecast_cols(P.forecast(hourly_latency(t), "service", "hr", "latency", 24, 0.80, "hour"))


@query("forecast_risk", f"""
WITH {fit_sql('daily_cost', 'service', 'usage_date', 'net_cost', 'day').strip()}, {horizon_sql(14, 'day').strip()}
SELECT k AS service, fts AS forecast_ts, CASE WHEN greatest(0, v) >= 200000 THEN 'HIGH'
  WHEN greatest(0, v + {Z90} * se) >= 200000 THEN 'MEDIUM' ELSE 'LOW' END AS operational_risk FROM fc
ORDER BY operational_risk DESC, k, fts LIMIT 50""")
def forecast_risk(t):
    from opsight.operators.decisions import forecast_risk as risk

    f = P.forecast(t.daily_cost, "service", "usage_date", "net_cost", 14, 0.90)
    f = f.withColumn("operational_risk", risk("forecast_value", "upper_bound", 200000.0))
    # The report goes by the label itself, from MEDIUM over LOW to HIGH.
    return f.orderBy(F.desc("operational_risk"), "service", "forecast_ts").limit(50).select("service", "forecast_ts", "operational_risk")


@query("clean_spikes", """
WITH m AS (SELECT service, quantile_cont(net_cost, 0.5) AS m FROM daily_cost GROUP BY service),
 d AS (SELECT service, m, quantile_cont(abs(net_cost - m), 0.5) AS mad FROM daily_cost JOIN m USING (service) GROUP BY ALL)
SELECT usage_date, service, round(CASE WHEN mad > 0 THEN least(m + 3 * CAST(1.4826 AS DOUBLE) * mad,
  greatest(m - 3 * CAST(1.4826 AS DOUBLE) * mad, net_cost)) ELSE net_cost END, 4) AS net_cost
FROM daily_cost JOIN d USING (service)""")
def clean_spikes(t):
    return rounded(P.clean_spikes(t.daily_cost.select("usage_date", "service", "net_cost"), "service", "net_cost"),
                   "net_cost", digits=4)


MOVED = """
src AS (SELECT service, usage_date, sum(net_cost)
    + CASE WHEN usage_date >= DATE '1997-05-01' THEN 400000 ELSE 0 END
    - CASE WHEN usage_date >= DATE '1999-09-15' AND service < 'O' THEN 900000 ELSE 0 END AS y
  FROM daily_cost GROUP BY service, usage_date)"""


@query("step_changes", f"""
WITH RECURSIVE {MOVED.strip()},
p AS (SELECT service, usage_date, y, row_number() OVER w - 1 AS i, sum(y) OVER w AS s, y - lag(y) OVER w AS d
      FROM src WINDOW w AS (PARTITION BY service ORDER BY usage_date)),
lim AS (SELECT service, 4 * ln(count(*)) * avg(d * d) / 2 AS most, max(i) AS last FROM p GROUP BY service),
seg AS (SELECT service, CAST(0 AS BIGINT) AS lo, last AS hi FROM lim
  UNION ALL
  SELECT service, unnest([lo, cut + 1]) AS lo, unnest([cut, hi]) AS hi FROM (
    SELECT service, lo, hi, max(g) AS g, -max({{'g': g, 'i': -i}}).i AS cut FROM (
      SELECT seg.service, lo, hi, p.i, round((p.i - lo + 1.0) * (hi - p.i) / (hi - lo + 1)
          * pow((p.s - a.s + a.y) / (p.i - lo + 1) - (b.s - p.s) / (hi - p.i), 2), 6) AS g
      FROM seg JOIN p ON p.service = seg.service AND p.i BETWEEN lo + 4 AND hi - 5
        JOIN p a ON a.service = seg.service AND a.i = lo JOIN p b ON b.service = seg.service AND b.i = hi)
    GROUP BY service, lo, hi) JOIN lim USING (service) WHERE g > most),
leaf AS (SELECT * FROM seg x WHERE NOT EXISTS (
  SELECT 1 FROM seg z WHERE z.service = x.service AND z.lo >= x.lo AND z.hi <= x.hi AND (z.lo, z.hi) <> (x.lo, x.hi))),
lv AS (SELECT leaf.service, lo, min(usage_date) AS changed_at, avg(y) AS after FROM leaf JOIN p ON p.service = leaf.service
  AND i BETWEEN lo AND hi GROUP BY leaf.service, lo)
SELECT service, changed_at, round(before, 4) AS level_before, round(after, 4) AS level_after FROM (
  SELECT *, lag(after) OVER (PARTITION BY service ORDER BY lo) AS before FROM lv) WHERE before IS NOT NULL""")
def step_changes(t):
    """Daily costs, moved up for all services on one day and down for some on another."""
    day, some = F.col("usage_date"), F.col("service") < "O"
    cost = t.daily_cost.groupBy("service", "usage_date").agg(F.sum("net_cost").alias("y")).withColumn(
        "y", F.col("y") + F.when(day >= "1997-05-01", 400000).otherwise(0)
        - F.when((day >= "1999-09-15") & some, 900000).otherwise(0))
    found = P.step_changes(cost, "service", "usage_date", "y")
    return rounded(found, "level_before", "level_after", digits=4)


@query("forecast_eval", f"""
WITH src AS (SELECT * FROM daily_cost WHERE usage_date <= (SELECT max(usage_date) FROM daily_cost) - INTERVAL 14 DAY),
 {fit_sql('src', 'service', 'usage_date', 'net_cost', 'day').strip()},
 tst AS (SELECT service AS k, usage_date, CAST(floor(epoch(CAST(usage_date AS TIMESTAMP)) / 86400) AS BIGINT) AS a, net_cost
   FROM daily_cost WHERE usage_date > (SELECT max(usage_date) FROM daily_cost) - INTERVAL 14 DAY),
 j AS (SELECT tst.k, net_cost AS y, greatest(0, icept + slope * (lst + (tst.a - lasta)) + coalesce(s, 0)) AS p
   FROM tst JOIN tr USING (k) LEFT JOIN pr ON pr.k = tst.k AND pr.season = isodow(usage_date) - 1)
SELECT k AS service, count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM j GROUP BY k""")
def forecast_eval(t):
    return rounded(rounded(P.forecast_eval(t.daily_cost, "service", "usage_date", "net_cost", 14), "mae", "rmse", digits=4),
                   "r2")


@query("forecast_summary", f"""
WITH {fit_sql('daily_cost', 'service', 'usage_date', 'net_cost', 'day').strip()}, {horizon_sql(14, 'day').strip()}
SELECT k AS service, round(sum(greatest(0, v)), 4) AS total_forecast, round(avg(greatest(0, v)), 4) AS mean_forecast
FROM fc GROUP BY k""")
def forecast_summary(t):
    f = P.forecast(t.daily_cost, "service", "usage_date", "net_cost", 14, 0.90)
    return rounded(P.forecast_summary(f, "service", "forecast_value"), "total_forecast", "mean_forecast", digits=4)


BUDGET = 5000000.0


@query("month_projection", f"""
WITH {fit_sql('daily_cost', 'service', 'usage_date', 'net_cost', 'day').strip()}, {horizon_sql(14, 'day').strip()},
 m AS (SELECT max(usage_date) AS l, last_day(max(usage_date)) AS e FROM daily_cost),
 a AS (SELECT sum(net_cost) AS c FROM daily_cost, m WHERE usage_date >= date_trunc('month', l)),
 d AS (SELECT CAST(fts AS DATE) AS d, sum(greatest(0, v)) AS f, sum(greatest(0, v + {Z90} * se)) AS u FROM fc GROUP BY 1),
 g AS (SELECT coalesce(sum(f) FILTER (d <= e), 0) AS fs, coalesce(sum(u) FILTER (d <= e), 0) AS us, avg(f) AS fa, avg(u) AS ua
       FROM d, m),
 p AS (SELECT l, date_diff('day', l, e) AS rem, c, CASE WHEN date_diff('day', l, e) <= 0 THEN 0
         WHEN date_diff('day', l, e) <= 14 THEN fs ELSE fa * date_diff('day', l, e) END AS fr,
         CASE WHEN date_diff('day', l, e) <= 0 THEN 0 WHEN date_diff('day', l, e) <= 14 THEN us
         ELSE ua * date_diff('day', l, e) END AS ur FROM m, a, g)
SELECT l AS last_actual_day, round(c, 2) AS actual_month_cost, CAST(rem AS INTEGER) AS remaining_days,
  round(fr, 2) AS forecast_remaining, round(c + fr, 2) AS projected_month_end,
  round(c + ur, 2) AS projected_month_end_upper, CAST({BUDGET} AS DOUBLE) AS monthly_budget,
  CASE WHEN c + ur >= {BUDGET} * 1.1 THEN 'HIGH' WHEN c + fr >= {BUDGET} THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM p""")
def month_projection(t):
    daily = materialise(t.daily_cost)
    f = P.forecast(daily, "service", "usage_date", "net_cost", 14, 0.90)
    f = f.withColumn("forecast_date", F.to_date("forecast_ts"))
    df = C.month_projection(daily, f, BUDGET, forecast_cost="forecast_value", upper_cost="upper_bound")
    return rounded(df, "actual_month_cost", "forecast_remaining", "projected_month_end", "projected_month_end_upper", digits=2)


@query("future_rows", f"""
WITH RECURSIVE {DAILY.strip()},
 r AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY usage_date DESC) AS rn,
         count(*) OVER (PARTITION BY service) AS n FROM d),
 l AS (SELECT service, list(net_cost ORDER BY usage_date) FILTER (rn <= 14) AS vals,
         avg(service_share) FILTER (rn <= 7) AS share FROM r WHERE n >= 14 GROUP BY service),
 roll AS (SELECT service, share, 1 AS i, vals FROM l
   UNION ALL SELECT service, share, i + 1, list_append(vals, list_avg(vals[-7:])) FROM roll WHERE i < 7),
 f AS (SELECT *, (SELECT max(usage_date) FROM daily_cost) + i AS nd FROM roll)
SELECT service, CAST(nd AS DATE) AS usage_date, CAST(isodow(nd) - 1 AS INTEGER) AS day_of_week,
  date_diff('day', (SELECT min(usage_date) FROM daily_cost), CAST(nd AS DATE)) AS trend_index,
  round(vals[-1], 4) AS cost_lag_1, round(vals[-7], 4) AS cost_lag_7, round(list_avg(vals[-7:]), 4) AS rolling_mean_7,
  round(list_stddev_pop(vals[-7:]), 4) AS rolling_std_7, round(share, 8) AS service_share FROM f""")
def future_rows(t):
    df = P.future_rows(C.daily_service_cost(t.daily_cost))
    df = rounded(rounded(df, "cost_lag_1", "cost_lag_7", "rolling_mean_7", "rolling_std_7", digits=4), "service_share", digits=8)
    return df.select("service", "usage_date", "day_of_week", "trend_index", "cost_lag_1", "cost_lag_7", "rolling_mean_7",
                     "rolling_std_7", "service_share")


# ---------------------------------------------------------------- data quality

@query("value_counts", """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20""")
def value_counts(t):
    return Q.value_counts(t.events, "user_id", 20)


@query("first_by", "SELECT service, arg_min(tiebreak, (ts, tiebreak)) AS first_event FROM metrics GROUP BY service")
def first_by(t):
    return Q.first_by(t.metrics, "service", "tiebreak", ["ts", "tiebreak"], "first_event")


@query("distinct_csv", """
SELECT user_id, array_to_string(list_sort(list(DISTINCT service)), ', ') AS services FROM metrics GROUP BY user_id""")
def distinct_csv(t):
    return Q.distinct_csv(t.metrics, "user_id", "service", "services")


FIELDS = ["event_id", "service", "environment", "metric", "value"]


@query("completeness", " UNION ALL ".join(f"""
SELECT '{f}' AS field, count(*) - count({f}) AS missing_values, count(*) AS total_rows,
  round_even(count({f}) / count(*) * 100, 2) AS completeness_pct,
  CASE WHEN count({f}) / count(*) >= 0.99 THEN 'OK' ELSE 'REVIEW' END AS status FROM observations""" for f in FIELDS))
def completeness(t):
    return Q.completeness(t.observations, FIELDS)


@query("quality_report", """
WITH o AS (SELECT event_id, service, environment, metric, value, CASE WHEN value > 90 THEN 1 ELSE 0 END AS target,
                  CASE WHEN observation_no % 50 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS stamp FROM observations),
 a AS (SELECT count(*) AS n, avg(target) AS rate, count(*) FILTER (TRY_CAST(stamp AS TIMESTAMP) IS NULL) AS bad,
        count(*) FILTER (value < 0 OR value > 100) AS oor FROM o),
 d AS (SELECT sum(c - 1) AS dups FROM (SELECT count(*) AS c FROM o GROUP BY service, metric)),
 r AS (SELECT 'row_count' AS c, '*' AS col, n AS v, NULL AS p FROM a
  UNION ALL SELECT 'column_count', '*', 7, NULL UNION ALL SELECT 'missing_column', 'region', 1, false
  UNION ALL SELECT 'unexpected_column', 'stamp', 1, NULL UNION ALL SELECT 'leakage_column', 'environment', 1, false
  UNION ALL SELECT 'nulls', 'event_id', count(*) - count(event_id), count(*) = count(event_id) FROM o
  UNION ALL SELECT 'nulls', 'service', count(*) - count(service), count(*) = count(service) FROM o
  UNION ALL SELECT 'nulls', 'environment', count(*) - count(environment), count(*) = count(environment) FROM o
  UNION ALL SELECT 'nulls', 'metric', 0, true UNION ALL SELECT 'nulls', 'value', 0, true
  UNION ALL SELECT 'nulls', 'target', 0, true UNION ALL SELECT 'nulls', 'stamp', 0, true
  UNION ALL SELECT 'invalid_timestamps', 'stamp', bad, bad = 0 FROM a
  UNION ALL SELECT 'duplicate_keys', 'service,metric', dups, dups = 0 FROM d
  UNION ALL SELECT 'positive_rate', 'target', round(rate, 6), NULL FROM a
  UNION ALL SELECT 'target_balance_warning', 'target', CASE WHEN rate < 0.01 OR rate > 0.8 THEN 1 ELSE 0 END, NULL FROM a
  UNION ALL SELECT 'out_of_range', 'value', oor, oor = 0 FROM a UNION ALL SELECT 'passed', '*', 0, false)
SELECT c AS "check", col AS "column", CAST(v AS DOUBLE) AS value, CAST(p AS BOOLEAN) AS passed FROM r""")
def quality_report(t):
    o = t.observations.select(
        "event_id", "service", "environment", "metric", "value", (F.col("value") > 90).cast("int").alias("target"),
        F.when(F.col("observation_no") % 50 == 0, "bad").otherwise(F.col("ts").cast("string")).alias("stamp"))
    spec = Q.DatasetSpec(
        expected=["event_id", "service", "environment", "metric", "value", "target", "region"], target="target",
        timestamp="stamp", keys=["service", "metric"], leakage=["environment"], ranges={"value": (0, 100)})
    return rounded(Q.quality_report(o, spec), "value")


@query("class_weights", """
SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels)
  * CAST(count(*) AS DOUBLE)), 8) AS class_weight FROM labels GROUP BY quality""")
def class_weights(t):
    return rounded(Q.class_weights(t.labels, "quality"), "class_weight", digits=8)


@query("dummy_columns", """
SELECT tiebreak, CAST(environment = 'pre' AS INTEGER) AS environment_pre, CAST(environment = 'prod' AS INTEGER)
 AS environment_prod, CAST(region = 'r0' AS INTEGER) AS region_r0, CAST(region = 'r1' AS INTEGER) AS region_r1,
 CAST(region = 'r2' AS INTEGER) AS region_r2 FROM metrics""")
def dummy_columns(t):
    m = t.metrics.select("tiebreak", "environment", "region")
    return Q.dummy_columns(m, ["environment", "region"]).drop("environment", "region")


# ---------------------------------------------------------------- model metrics

def rates_sql(tp="tp", fp="fp", fn="fn") -> str:
    return f"""round(coalesce({tp} / nullif({tp} + {fp}, 0), 0), 6) AS precision,
 round(coalesce({tp} / nullif({tp} + {fn}, 0), 0), 6) AS recall,
 round(coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0), 6) AS f1"""


CONF = """count(*) FILTER (y = 1 AND score >= {t}) AS tp, count(*) FILTER (y = 0 AND score >= {t}) AS fp,
 count(*) FILTER (y = 1 AND score < {t}) AS fn, count(*) FILTER (y = 0 AND score < {t}) AS tn"""


@query("binary_metrics", f"""
WITH c AS (SELECT count(*) AS events, avg(y) AS pr, {CONF.format(t='0.5')} FROM predictions)
SELECT events, round(pr, 6) AS positive_rate, tp, fp, fn, tn, {rates_sql()}, round((tp + tn) / events, 6) AS accuracy,
  round(coalesce(fp / nullif(fp + tn, 0), 0), 6) AS false_positive_rate,
  round(coalesce(fn / nullif(fn + tp, 0), 0), 6) AS false_negative_rate FROM c""")
def binary_metrics(t):
    return rounded(M.binary_metrics(t.predictions), "positive_rate", "precision", "recall", "f1", "accuracy",
                   "false_positive_rate", "false_negative_rate")


SWEEP = f"""
g AS (SELECT CAST(0.1 AS DOUBLE) + i * CAST(0.05 AS DOUBLE) AS th FROM range(17) r(i)),
c AS (SELECT th, {CONF.format(t='th')} FROM predictions, g GROUP BY th),
sw AS (SELECT round(th, 2) AS threshold, tp, fp, fn, tn, {rates_sql()}, fp * 6.5 AS false_positive_cost,
   fn * 4500.0 AS false_negative_cost, tp * 1800.0 AS true_positive_value,
   tp * 1800.0 - fp * 6.5 - fn * 4500.0 AS net_value FROM c)"""


@query("threshold_sweep", f"""
WITH {SWEEP.strip()}
SELECT threshold, tp, fp, fn, tn, precision, recall, f1, CAST(false_positive_cost AS DOUBLE) AS false_positive_cost,
  CAST(false_negative_cost AS DOUBLE) AS false_negative_cost, CAST(true_positive_value AS DOUBLE) AS true_positive_value,
  CAST(net_value AS DOUBLE) AS net_value FROM sw""")
def threshold_sweep(t):
    return rounded(M.threshold_sweep(t.predictions), "precision", "recall", "f1")


@query("best_by", f"""
WITH {SWEEP.strip()}
SELECT threshold, tp, fp, CAST(net_value AS DOUBLE) AS net_value FROM sw ORDER BY net_value DESC, threshold LIMIT 1""")
def best_by(t):
    return M.best_by(M.threshold_sweep(t.predictions), "net_value", "threshold").select("threshold", "tp", "fp", "net_value")


def ranking_sql(by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    cols = f"{by}, " if by else ""
    return f"""
k AS (SELECT {cols}score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM predictions GROUP BY {cols}score),
a AS (SELECT *, sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS q,
        coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(neg) OVER ({part} ORDER BY score DESC) AS fp FROM k),
rk AS (SELECT {cols}CASE WHEN max(p) > 0 AND max(q) > 0 THEN round(sum(pos * (below + neg / 2) / (CAST(p AS DOUBLE) * q)), 6) END AS roc_auc,
        CASE WHEN max(p) > 0 AND max(q) > 0 THEN round(sum(CAST(pos AS DOUBLE) / p * tp / (tp + fp)), 6) END AS pr_auc
       FROM a {'GROUP BY ' + by if by else ''})"""


@query("roc_auc", f"WITH {ranking_sql().strip()} SELECT roc_auc FROM rk")
def roc_auc(t):
    return rounded(M.ranking_metrics(t.predictions).select("roc_auc"), "roc_auc")


@query("average_precision", f"WITH {ranking_sql('service').strip()} SELECT service, pr_auc FROM rk")
def average_precision(t):
    return rounded(M.ranking_metrics(t.predictions, by=["service"]).select("service", "pr_auc"), "pr_auc")


BY_SERVICE = f"""
{ranking_sql('service').strip()},
c AS (SELECT service, count(*) AS events, avg(y) AS ir, {CONF.format(t='0.5')} FROM predictions GROUP BY service),
ms AS (SELECT service, events, round(ir, 6) AS incident_rate, tp, fp, fn, tn, {rates_sql()}, roc_auc, pr_auc
       FROM c JOIN rk USING (service))"""


@query("metrics_by_service", f"WITH {BY_SERVICE.strip()} SELECT * FROM ms")
def metrics_by_service(t):
    return rounded(M.metrics_by_group(t.predictions, ["service"]), "incident_rate", "precision", "recall", "f1", "roc_auc",
                   "pr_auc")


@query("model_quality", f"""
WITH {BY_SERVICE.strip()}
SELECT service, CASE WHEN recall < 0.6 THEN 'raise_recall' WHEN precision < 0.5 THEN 'reduce_false_positives'
  WHEN f1 < 0.55 THEN 'rebalance_model' WHEN pr_auc < 0.5 THEN 'improve_features_and_sampling'
  ELSE 'acceptable_monitor_drift' END AS recommendation,
 CASE WHEN precision >= 0.6 AND recall >= 0.7 THEN 'GOOD' WHEN precision >= 0.45 AND recall >= 0.55 THEN 'REVIEW'
  ELSE 'CRITICAL' END AS quality_status FROM ms""")
def model_quality(t):
    return M.model_quality(M.metrics_by_group(t.predictions, ["service"])).select(
        "service", "recommendation", "quality_status")


CLASSES = """cls AS (SELECT doc_id, lang AS y, CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN doc_id % 7 = 0 THEN 'de' ELSE lang END
 AS yhat FROM documents)"""


def classes(t):
    d = F.col("doc_id")
    guess = F.when(d % 3 == 0, "en").when(d % 7 == 0, "de").otherwise(F.col("lang"))
    return t.documents.select("doc_id", F.col("lang").alias("y"), guess.alias("yhat"))


@query("confusion_matrix", f"WITH {CLASSES} SELECT y AS actual, yhat AS predicted, count(*) AS n FROM cls GROUP BY ALL")
def confusion_matrix(t):
    return M.confusion_matrix(classes(t), "y", "yhat")


@query("classification_report", f"""
WITH {CLASSES}, l AS (SELECT y AS label FROM cls UNION SELECT yhat FROM cls),
 c AS (SELECT label, count(*) FILTER (y = label) AS support, count(*) FILTER (yhat = label) AS pn,
   count(*) FILTER (y = label AND yhat = label) AS tp FROM l, cls GROUP BY label)
SELECT label, round(coalesce(tp / nullif(pn, 0), 0), 6) AS precision, round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(support + pn, 0), 0), 6) AS f1, support FROM c""")
def classification_report(t):
    return rounded(M.classification_report(classes(t), "y", "yhat"), "precision", "recall", "f1")


@query("regression_metrics", """
SELECT service, count(*) AS n, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
  round(1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)), 6) AS r2 FROM regression GROUP BY service""")
def regression_metrics(t):
    return rounded(rounded(M.regression_metrics(t.regression, "y", "yhat", ["service"]), "mae", "rmse", digits=4), "r2")


@query("absolute_error", """
SELECT l_orderkey, l_linenumber, y, round(abs(y - yhat), 6) AS abs_error FROM regression""")
def absolute_error(t):
    return rounded(M.with_abs_error(t.regression, "y", "yhat").select("l_orderkey", "l_linenumber", "y", "abs_error"), "abs_error")


@query("promotion_gate", f"""
WITH {ranking_sql('service').strip()}
SELECT service, coalesce(roc_auc >= 0.75, false) AS accepted, CASE WHEN roc_auc >= 0.75 THEN 'register_candidate_model'
  ELSE 'review_features_or_training_data' END AS next_step FROM rk""")
def promotion_gate(t):
    m = M.ranking_metrics(t.predictions, by=["service"])
    return M.promotion_gate(m, "roc_auc", 0.75).select("service", "accepted", "next_step")


# ---------------------------------------------------------------- drift

DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SPLIT_AT = "1998-06-01 00:00:00"


def drift_sides(t):
    line = t.spread().lineitem.withColumn("yhat", F.col("l_quantity") * 1500 + F.col("l_tax") * 1000)
    at = F.lit(SPLIT_AT).cast("timestamp_ntz")
    return line.filter(F.col("l_shipdate") < at), line.filter(F.col("l_shipdate") >= at)


def long_sql(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {e} AS v, l_shipdate < TIMESTAMP '{SPLIT_AT}' AS base FROM lineitem"
        for c, e in columns.items())


def psi_sql(columns, tag="") -> str:
    return f"""
lg{tag} AS ({long_sql(columns)}),
e{tag} AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{', '.join(str(i / 10) for i in range(11))}])
        FILTER (base))) AS e, count(*) FILTER (base) AS tb, count(*) FILTER (NOT base) AS tc FROM lg{tag} GROUP BY feature),
b{tag} AS (SELECT feature, CASE WHEN v = e[-1] THEN len(e) - 1 WHEN v >= e[1] AND v < e[-1]
        THEN len(list_filter(e, lambda x: x <= v)) END AS bin, count(*) FILTER (base) AS nb, count(*) FILTER (NOT base) AS nc
      FROM lg{tag} JOIN e{tag} USING (feature) GROUP BY ALL),
gr{tag} AS (SELECT feature, e, tb, tc, unnest(range(1, len(e))) AS bin FROM e{tag}),
tm{tag} AS (SELECT feature, e, CASE WHEN coalesce(nb, 0) = 0 THEN 0.0001 ELSE nb / tb END AS pb,
        CASE WHEN coalesce(nc, 0) = 0 THEN 0.0001 ELSE nc / tc END AS pc FROM gr{tag} LEFT JOIN b{tag} USING (feature, bin)),
ps{tag} AS (SELECT feature, CASE WHEN len(any_value(e)) < 3 THEN 0 ELSE sum((pc - pb) * ln(pc / pb)) END AS psi
      FROM tm{tag} GROUP BY feature)"""


IDENTITY = {c: c for c in DRIFT_COLS}
KS = """
kd AS (SELECT feature, v, count(*) FILTER (base) AS nb, count(*) FILTER (NOT base) AS nc FROM lg GROUP BY feature, v),
kc AS (SELECT feature, sum(nb) OVER (PARTITION BY feature ORDER BY v) / CAST(sum(nb) OVER (PARTITION BY feature) AS DOUBLE)
        - sum(nc) OVER (PARTITION BY feature ORDER BY v) / CAST(sum(nc) OVER (PARTITION BY feature) AS DOUBLE) AS g FROM kd),
ks AS (SELECT feature, max(abs(g)) AS ks_statistic FROM kc GROUP BY feature),
kp AS (SELECT feature, ks_statistic, sqrt(CAST(tb AS DOUBLE) * tc / (tb + tc)) * ks_statistic AS l FROM ks JOIN e USING (feature)),
kq AS (SELECT feature, ks_statistic, CASE WHEN l < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101),
        lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * l * l))))) END AS ks_pvalue FROM kp)"""


@query("psi", f"""
WITH {psi_sql(IDENTITY).strip()} SELECT feature, round(psi, 6) AS psi, CASE WHEN psi >= 0.25 THEN 'critical'
 WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END AS psi_level FROM ps""")
def psi(t):
    base, cur = drift_sides(t)
    return rounded(R.psi(base, cur, DRIFT_COLS).withColumn("psi_level", R.psi_level("psi")), "psi")


@query("ks_2samp", f"""
WITH {psi_sql(IDENTITY).strip()}, {KS.strip()}
SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue FROM kq""")
def ks_2samp(t):
    base, cur = drift_sides(t)
    return rounded(R.ks_2samp(base, cur, DRIFT_COLS, exact=0), "ks_statistic", "ks_pvalue")


@query("drift_report", f"""
WITH {psi_sql(IDENTITY).strip()}, {KS.strip()},
 mn AS (SELECT feature, avg(v) FILTER (base) AS bm, avg(v) FILTER (NOT base) AS cm FROM lg GROUP BY feature)
SELECT feature, round(bm, 4) AS baseline_mean, round(cm, 4) AS current_mean, round(cm - bm, 4) AS mean_diff,
  round(psi, 4) AS psi, CASE WHEN psi >= 0.25 THEN 'critical' WHEN psi >= 0.1 THEN 'warning' ELSE 'ok' END AS psi_level,
  round(ks_statistic, 4) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue
FROM mn JOIN ps USING (feature) JOIN kq USING (feature)""")
def drift_report(t):
    base, cur = drift_sides(t)
    df = R.drift_report(base, cur, DRIFT_COLS, exact=0)
    return rounded(rounded(df, "baseline_mean", "current_mean", "mean_diff", "psi", "ks_statistic", digits=4), "ks_pvalue")


@query("drift_action", f"""
WITH {psi_sql(IDENTITY).strip()}, {psi_sql({'yhat': 'l_quantity * 1500 + l_tax * 1000'}, '_p').strip()},
 m AS (SELECT avg(abs(l_extendedprice - (l_quantity * 1500 + l_tax * 1000))) FILTER (l_shipdate < TIMESTAMP '{SPLIT_AT}') AS bm,
   avg(abs(l_extendedprice - (l_quantity * 1500 + l_tax * 1000))) FILTER (l_shipdate >= TIMESTAMP '{SPLIT_AT}') AS cm FROM lineitem),
 f AS (SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (psi >= 0.25), '') AS critical_features,
   coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (psi >= 0.1 AND psi < 0.25), '') AS warning_features FROM ps),
 r AS (SELECT f.*, (SELECT psi FROM ps_p) AS pp, bm, cm, cm / greatest(bm, 0.0001) AS mf FROM f, m)
SELECT critical_features, warning_features, round(pp, 6) AS prediction_psi, round(bm, 4) AS baseline_mae,
  round(cm, 4) AS current_mae, round(mf, 6) AS mae_degradation_factor,
  CASE WHEN mf >= 1.5 THEN 'critical' WHEN critical_features <> '' OR pp >= 0.25 THEN 'high'
    WHEN warning_features <> '' OR pp >= 0.1 THEN 'medium' ELSE 'low' END AS severity,
  CASE WHEN mf >= 1.5 THEN 'retrain_required' WHEN critical_features <> '' OR pp >= 0.25 THEN 'review_and_prepare_retraining'
    WHEN warning_features <> '' OR pp >= 0.1 THEN 'increase_monitoring' ELSE 'continue_monitoring' END AS action FROM r""")
def drift_action(t):
    base, cur = drift_sides(t)
    features = R.psi(base, cur, DRIFT_COLS).withColumn("psi_level", R.psi_level("psi"))
    df = R.drift_action(features, base, cur, "l_extendedprice", "yhat")
    return rounded(rounded(df, "baseline_mae", "current_mae", digits=4), "prediction_psi", "mae_degradation_factor")
