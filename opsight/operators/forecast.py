"""Per-series forecasts: linear trend, seasonal profile and residual band.

Series are roll-ups at a fixed step (hour or day), so their length is bounded by the
calendar; the raw rows behind them are aggregated first.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.operators.metrics import regression_metrics
from opsight.operators.ordered import over_frames, positions, running_sum
from opsight.operators.windows import date_split
from opsight.session import materialise

SEASON = {
    "day": lambda ts: F.weekday(ts),
    "hour": lambda ts: F.hour(ts),
}
STEP_SECONDS = {"day": 86400, "hour": 3600}
MAD_TO_SIGMA = 1.4826


def clean_spikes(df: DataFrame, key: str, y: str, width: float = 3.0) -> DataFrame:
    """Clip values further than ``width`` robust deviations from the series median."""
    half, df = F.lit(0.5), materialise(df)
    medians = df.groupBy(key).agg(F.percentile(y, half).alias("_m"))
    centred = df.join(medians, key)
    spread = centred.groupBy(key).agg(F.percentile(F.abs(F.col(y) - F.col("_m")), half).alias("_mad"))
    reach = width * MAD_TO_SIGMA * F.col("_mad")
    clipped = F.least(F.col("_m") + reach, F.greatest(F.col("_m") - reach, F.col(y)))
    return centred.join(spread, key).withColumn(
        y, F.when(F.col("_mad") > 0, clipped).otherwise(F.col(y))
    ).drop("_m", "_mad")


#: A split is kept where it explains more than this many noise variances times the log of the series' length.
PENALTY, LEAST = 4.0, 5


def level_segments(
    df: DataFrame, key: str, ts: str, y: str, penalty: float = PENALTY, least: int = LEAST, bucket: str = "30 days"
) -> DataFrame:
    """The rows with the segment of their series (0, 1, ...) between level shifts, found by binary segmentation.

    Rounds run over all series at once. From prefix sums, the gain of a cut is known at every row:
    ``n1 n2 / (n1 + n2) * (mean1 - mean2)^2``. The best cut of each open segment, with at least
    ``least`` rows on both sides, splits it if the gain exceeds ``penalty * log(n) * noise``, where
    noise is half the mean square of the series' first differences; only split segments go on.
    Equal gains go to the earlier row. Rows whose key, time or value is NULL are left out.
    """
    points = materialise(df.select(key, ts, F.col(y).cast("double").alias("_y")).na.drop())
    step = over_frames(points, [key], [ts], lambda w: {"_d": F.col("_y") - F.lag("_y").over(w)}, before=1, bucket=bucket)
    bounds = step.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), (F.avg(F.col("_d") * F.col("_d")) / 2).alias("_noise"))
    placed = materialise(positions(points, [key], [ts], bucket))
    rows = materialise(running_sum(placed, [key], [ts], F.col("_y"), "_sum", bucket))
    limits = materialise(bounds).select(key, (penalty * F.log(F.col("_n")) * F.coalesce("_noise", F.lit(0.0))).alias("_limit"))
    active = rows.select(key, "_pos", "_y", "_sum", F.lit(0).cast("bigint").alias("_seg"))
    cuts = None
    while True:
        ends = active.groupBy(key, "_seg").agg(
            F.min("_pos").alias("_lo"), F.max("_pos").alias("_hi"), F.max_by("_sum", "_pos").alias("_top"),
            F.min_by(F.col("_sum") - F.col("_y"), "_pos").alias("_base")).filter(F.col("_hi") - F.col("_lo") + 1 >= 2 * least)
        n1, n2 = F.col("_pos") - F.col("_lo") + 1, F.col("_hi") - F.col("_pos")
        first, second = (F.col("_sum") - F.col("_base")) / n1, (F.col("_top") - F.col("_sum")) / n2
        gain = F.round(n1 * n2 / (n1 + n2) * (first - second) * (first - second), 6)
        tried = active.join(ends, [key, "_seg"]).filter((n1 >= least) & (n2 >= least)).withColumn("_gain", gain)
        best = tried.groupBy(key, "_seg").agg(
            F.max("_gain").alias("_gain"), F.max_by("_pos", F.struct("_gain", -F.col("_pos"))).alias("_cut"))
        split = materialise(best.join(limits, key).filter(F.col("_gain") > F.col("_limit")).select(key, "_seg", "_cut"))
        if split.limit(1).count() == 0:
            break
        found = split.select(key, "_cut")
        cuts = found if cuts is None else cuts.unionByName(found)
        active = materialise(active.join(split, [key, "_seg"]).select(
            key, "_pos", "_y", "_sum", (F.col("_seg") * 2 + (F.col("_pos") > F.col("_cut")).cast("int")).alias("_seg")))
    out = rows.select(key, ts, "_pos", F.col("_y").alias(y))
    if cuts is None:
        return out.withColumn("segment", F.lit(0)).drop("_pos")
    listed = cuts.groupBy(key).agg(F.collect_list("_cut").alias("_cuts"))
    number = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_pos"))), F.lit(0))
    return out.join(listed, key, "left").withColumn("segment", F.when(F.col("_cuts").isNull(), 0).otherwise(number)) \
        .drop("_cuts", "_pos")


def step_changes(df: DataFrame, key: str, ts: str, y: str, **params) -> DataFrame:
    """Level shifts of each series: when the new level begins, and the means before and after."""
    levels = level_segments(df, key, ts, y, **params).groupBy(key, "segment").agg(
        F.min(ts).alias("changed_at"), F.avg(y).alias("level_after"))
    series = Window.partitionBy(key).orderBy("segment")
    return levels.withColumn("level_before", F.lag("level_after").over(series)).filter("segment > 0").select(
        key, "changed_at", "level_before", "level_after")


def adjust_steps(df: DataFrame, key: str, ts: str, y: str, **params) -> DataFrame:
    """The series with every level moved to that of its last segment, so that a trend is not fitted to a shift."""
    rows = materialise(level_segments(df, key, ts, y, **params))
    levels = rows.groupBy(key, "segment").agg(F.avg(y).alias("_level"))
    last = levels.groupBy(key).agg(F.max_by("_level", "segment").alias("_last"))
    return rows.join(levels, [key, "segment"]).join(last, key).withColumn(y, F.col(y) - F.col("_level") + F.col("_last")) \
        .drop("_level", "_last", "segment")


def _steps(ts: Column, step: str) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / STEP_SECONDS[step])


def _fit(df: DataFrame, key: str, ts: str, y: str, step: str) -> tuple[DataFrame, DataFrame]:
    """Trend and band per series, and the seasonal profile of its residuals."""
    origin = df.agg(F.min(_steps(F.col(ts), step)).alias("o")).scalar()
    points = df.select(
        key, F.col(y).cast("double").alias("_y"), SEASON[step](F.col(ts)).alias("_season"),
        _steps(F.col(ts), step).alias("_abs"),
    ).withColumn("_t", (F.col("_abs") - origin).cast("double"))
    trend = points.groupBy(key).agg(
        F.regr_slope("_y", "_t").alias("_slope"),
        F.regr_intercept("_y", "_t").alias("_icept"),
        F.max("_t").alias("_last"),
        F.max("_abs").alias("_last_abs"),
    )
    residual = points.join(trend, key).withColumn("_r", F.col("_y") - (F.col("_icept") + F.col("_slope") * F.col("_t")))
    profile = residual.groupBy(key, "_season").agg(F.avg("_r").alias("_s"))
    sigma = residual.join(profile, [key, "_season"]).groupBy(key).agg(
        F.stddev_samp(F.col("_r") - F.col("_s")).alias("standard_error")
    )
    return trend.join(sigma, key), profile


def forecast(
    df: DataFrame,
    key: str,
    ts: str,
    y: str,
    horizon: int,
    level: float = 0.90,
    step: str = "day",
    out_ts: str = "forecast_ts",
) -> DataFrame:
    """``horizon`` steps ahead per series with an interval; costs never go below zero.

    The fit reads its series several times, so the roll-up is written once and the raw rows
    behind it are read once.
    """
    df = materialise(df.select(key, ts, y))
    trend, profile = _fit(df, key, ts, y, step)
    ahead = trend.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        out_ts, F.timestamp_seconds((F.col("_last_abs") + F.col("_i")) * STEP_SECONDS[step])
    ).withColumn("_season", SEASON[step](F.col(out_ts)))
    z = NormalDist().inv_cdf(0.5 + level / 2)
    value = F.col("_icept") + F.col("_slope") * (F.col("_last") + F.col("_i")) + F.coalesce("_s", F.lit(0.0))
    positive = lambda c: F.greatest(F.lit(0.0), c)
    return ahead.join(profile, [key, "_season"], "left").select(
        key,
        out_ts,
        value.alias("raw_forecast_value"),
        positive(value).alias("forecast_value"),
        positive(value - z * F.col("standard_error")).alias("lower_bound"),
        positive(value + z * F.col("standard_error")).alias("upper_bound"),
        "standard_error",
    )


def forecast_eval(
    df: DataFrame, key: str, ts: str, y: str, holdout_days: int = 14, step: str = "day"
) -> DataFrame:
    """Errors of a forecast fitted without the last days, per series."""
    parts = date_split(materialise(df.select(key, ts, y)), ts, holdout_days)
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    per_day = 86400 // STEP_SECONDS[step]
    # Series end on different days; enough steps to cover the whole holdout for each of them.
    gap = F.datediff(F.to_date(test.agg(F.max(ts).alias("m")).scalar()), F.to_date(F.col("_end")))
    trend, profile = _fit(train, key, ts, y, step)
    ends = trend.withColumn("_end", F.timestamp_seconds(F.col("_last_abs") * STEP_SECONDS[step]))
    ahead = ends.withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), (gap + 1) * per_day)))
    ).withColumn("_abs", F.col("_last_abs") + F.col("_i"))
    seasoned = ahead.withColumn("_season", SEASON[step](F.timestamp_seconds(F.col("_abs") * STEP_SECONDS[step])))
    value = F.col("_icept") + F.col("_slope") * (F.col("_last") + F.col("_i")) + F.coalesce("_s", F.lit(0.0))
    predicted = seasoned.join(profile, [key, "_season"], "left").select(
        key, "_abs", F.greatest(F.lit(0.0), value).alias("predicted")
    )
    actual = test.select(key, _steps(F.col(ts), step).alias("_abs"), F.col(y).alias("actual"))
    return regression_metrics(actual.join(predicted, [key, "_abs"]), "actual", "predicted", [key])


def forecast_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.sum(value).alias("total_forecast"), F.avg(value).alias("mean_forecast"))


def future_rows(
    df: DataFrame,
    key: str = "service",
    date: str = "usage_date",
    cost: str = "net_cost",
    share: str = "service_share",
    days: int = 7,
    history: int = 14,
) -> DataFrame:
    """Feature rows of the next days of each series, rolled forward with the mean of the last week.

    Only the last ``history`` points of a series are gathered; shorter series are skipped.
    """
    df = materialise(df.select(key, date, cost, share))
    span = df.agg(F.struct(F.max(date).alias("last"), F.min(date).alias("first")).alias("s")).scalar()
    w = Window.partitionBy(key).orderBy(F.col(date).desc())
    tail = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= history)
    series = tail.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(cost).alias("v")))), lambda s: s["v"]
        ).alias("_values"),
        F.avg(F.when(F.col("_rn") <= 7, F.col(share))).alias("service_share"),
        F.count(F.lit(1)).alias("_n"),
    ).filter(F.col("_n") >= history)

    def mean(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)

    rolled = F.aggregate(
        F.sequence(F.lit(1), F.lit(days)),
        F.col("_values"),
        lambda acc, _i: F.concat(acc, F.array(mean(F.slice(acc, -7, 7)))),
    )
    rows = (
        series.withColumn("_all", rolled)
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .withColumn("_seen", F.slice("_all", 1, history + F.col("_i") - 1))
        .withColumn("_week", F.slice("_seen", -7, 7))
        .withColumn("_m", mean(F.col("_week")))
        .withColumn("_span", span)
        .withColumn(date, F.date_add(F.col("_span.last"), F.col("_i")))
    )
    squares = F.transform("_week", lambda x: (x - F.col("_m")) * (x - F.col("_m")))
    at = lambda k: F.element_at("_seen", -k)
    return rows.select(
        key,
        date,
        F.weekday(date).alias("day_of_week"),
        F.dayofmonth(date).alias("day_of_month"),
        F.month(date).alias("month"),
        (F.weekday(date) >= 5).cast("int").alias("is_weekend"),
        F.datediff(F.col(date), F.col("_span.first")).alias("trend_index"),
        at(1).alias("cost_lag_1"),
        at(2).alias("cost_lag_2"),
        at(7).alias("cost_lag_7"),
        F.col("_m").alias("rolling_mean_7"),
        F.sqrt(mean(squares)).alias("rolling_std_7"),
        "service_share",
    )
