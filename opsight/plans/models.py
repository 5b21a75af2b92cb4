"""Model queries. Results depend on the optimiser, so they have no SQL twin."""

from pyspark.sql import functions as F

from opsight.operators import models as M, windows as W
from opsight.operators.cost import daily_service_cost
from opsight.operators.decisions import risk_band
from opsight.operators.forecast import future_rows as build_future_rows
from opsight.operators.isolation import isolation_forest as detect
from opsight.plans.registry import query

KEYS, ORDER = ["service"], ["ts", "tiebreak"]


def labelled(t):
    """Metrics with a failure label that follows load and latency."""
    risk = F.col("latency_ms") / 60 + F.col("cpu") / 100 + F.col("error_rate") * 8
    return t.spread().metrics.select("tiebreak", "ts", "service", "environment", "region", "latency_ms", "error_rate", "request_count",
                            "cpu", "memory", (risk > 2.2).cast("int").alias("failure"))


TABULAR = M.Features(numeric=["latency_ms", "error_rate", "request_count", "cpu", "memory"],
                     categorical=["service", "environment", "region"], label="failure")


@query("train_classifier")
def train_classifier(t):
    rows = M.stratified_split(labelled(t), "failure", "tiebreak", 0.30)
    model = M.train_classifier(rows.filter("split = 'train'"), TABULAR)
    return M.score_risk(model, rows.filter("split = 'test'")).select("tiebreak", "failure", "prediction",
                                                                     "failure_probability")


@query("feature_importance")
def feature_importance(t):
    rows = labelled(t)
    return M.feature_importance(M.train_classifier(rows, TABULAR), rows)


@query("score_risk")
def score_risk(t):
    rows = W.date_split(labelled(t), "ts", 3)
    model = M.train_logistic(rows.filter("split = 'train'"), TABULAR)
    recent = M.score_risk(model, rows.filter("split = 'test'"))
    return recent.withColumns(risk_band("failure_probability")).select(
        "tiebreak", "failure", "failure_probability", "risk_level", "recommended_action")


@query("stratified_split", """
SELECT split, failure, count(*) AS n FROM (SELECT CASE WHEN row_number() OVER (PARTITION BY failure ORDER BY tiebreak)
  <= round(count(*) OVER (PARTITION BY failure) * 0.3) THEN 'test' ELSE 'train' END AS split, failure FROM (
  SELECT tiebreak, CAST(latency_ms / 60 + cpu / 100 + error_rate * 8 > CAST(2.2 AS DOUBLE) AS INTEGER) AS failure FROM metrics))
GROUP BY ALL""")
def stratified_split(t):
    return M.stratified_split(labelled(t), "failure", "tiebreak", 0.30).groupBy("split", "failure").agg(
        F.count("*").alias("n"))


@query("isolation_forest")
def isolation_forest(t):
    m = t.spread().metrics.select("tiebreak", "latency_ms", "error_rate", "request_count", "cpu", "memory")
    return detect(m, ["latency_ms", "error_rate", "request_count", "cpu", "memory"], "tiebreak", trees=200).select(
        "tiebreak", "anomaly_score", "is_anomaly")


TEXT = M.Features(numeric=["n_chars"], categorical=["source"], text="text", label="lang")
ROUTING = {"en": "team-en", "de": "team-de", "fr": "team-fr", "es": "team-es"}


def documents(t):
    return t.spread().documents.select("doc_id", "text", "source", F.col("n_chars").cast("double").alias("n_chars"), "lang")


@query("train_text_classifier")
def train_text_classifier(t):
    rows = M.stratified_split(documents(t), "lang", "doc_id", 0.25)
    model = M.train_text_classifier(rows.filter("split = 'train'"), TEXT)
    return M.classify_text(model, rows.filter("split = 'test'"), ROUTING).select(
        "doc_id", "lang", "predicted_label", "confidence", "routing_team")


CLUSTERS = M.Features(numeric=["n_chars"], categorical=["source", "lang"], text="text", min_df=1, stop_words="english", terms=1 << 16)


@query("cluster_sweep")
def cluster_sweep(t):
    return M.cluster_sweep(documents(t), CLUSTERS)


@query("cluster_events")
def cluster_events(t):
    rows = documents(t)
    return M.assign_clusters(M.train_clusters(rows, CLUSTERS, 5), rows).select("doc_id", "cluster_id")


@query("reduce_2d")
def reduce_2d(t):
    return M.reduce_2d(documents(t), CLUSTERS, "doc_id")


LAGGED = M.Features(
    numeric=["request_count", "error_rate", "cpu", "latency_ms_lag_1", "latency_ms_lag_2", "latency_ms_lag_3",
             "latency_ms_lag_6", "latency_ms_roll_mean_3", "latency_ms_roll_mean_6", "latency_ms_roll_max_6",
             "error_rate_roll_mean_3", "cpu_roll_mean_3"],
    label="target_next")


def lagged(t):
    m = t.metrics.select("service", "ts", "tiebreak", "latency_ms", "error_rate", "request_count", "cpu")
    return W.lag_features(m, KEYS, ORDER, "latency_ms", means={"latency_ms": [3, 6], "error_rate": [3], "cpu": [3]},
                          maxima={"latency_ms": [6]})


EDGES = (0, 40, 60, float("inf"))


@query("train_regressor")
def train_regressor(t):
    rows = W.temporal_split(lagged(t), "ts", "tiebreak", ratios=(0.75,), names=("train", "test"))
    model = M.train_regressor(rows.filter("split = 'train'"), LAGGED, "random_forest")
    return M.predict_regression(model, rows.filter("split = 'test'"), "target_next", EDGES).select(
        "tiebreak", "target_next", "prediction", "absolute_error", "risk_level", "recommended_action")


@query("forecast_next")
def forecast_next(t):
    rows = lagged(t)
    model = M.train_regressor(rows, LAGGED, "random_forest")
    return M.forecast_next(model, rows, KEYS, "ts", "tiebreak", edges=EDGES).select(
        "service", "tiebreak", "forecast_for", "prediction", "risk_level")


COST = M.Features(
    numeric=["day_of_week", "day_of_month", "month", "is_weekend", "trend_index", "cost_lag_1", "cost_lag_2", "cost_lag_7",
             "rolling_mean_7", "rolling_std_7", "service_share"],
    categorical=["service"], label="net_cost")


@query("cost_prediction")
def cost_prediction(t):
    """Daily cost per service predicted for the next seven days from lag features."""
    from opsight.functions.scalar import calendar_features
    from opsight.operators.ordered import over_frames
    from opsight.operators.windows import guarded

    daily = daily_service_cost(t.daily_cost).withColumn("_day", F.col("usage_date").cast("timestamp"))

    def exprs(w):
        week, c = w.rowsBetween(-7, -1), F.col("net_cost")
        return {
            "cost_lag_1": F.lag(c, 1).over(w), "cost_lag_2": F.lag(c, 2).over(w), "cost_lag_7": F.lag(c, 7).over(w),
            "rolling_mean_7": guarded(F.avg(c), c, week, 3),
            "rolling_std_7": F.coalesce(guarded(F.stddev_samp(c), c, week, 3), F.lit(0.0)),
        }

    framed = over_frames(daily, ["service"], ["_day"], exprs, before=7, bucket="30 days")
    rows = calendar_features(framed, "usage_date").na.drop(
        subset=["cost_lag_1", "cost_lag_2", "cost_lag_7", "rolling_mean_7"])
    train = W.date_split(rows, "usage_date", 14).filter("split = 'train'")
    model = M.train_regressor(train, COST, "random_forest")
    return M.tidy(model.transform(build_future_rows(daily.drop("_day")))).select(
        "service", "usage_date", F.col("prediction").alias("predicted_cost"))


@query("experiment_grid")
def experiment_grid(t):
    rows = W.temporal_split(lagged(t), "ts", "tiebreak", ratios=(0.75,), names=("train", "test"))
    return M.experiment_grid(rows.filter("split = 'train'"), rows.filter("split = 'test'"), LAGGED)
