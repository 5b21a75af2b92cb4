"""Model and forecast quality metrics as one-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.scalar import case_ladder, safe_ratio
from opsight.operators.quantiles import cumulate, distinct_counts
from opsight.session import materialise


@dataclass(frozen=True)
class CostAssumptions:
    """Fixed values of the alert cost model."""

    false_positive_review_minutes: float = 6.0
    hourly_cost: float = 65.0
    false_negative_impact: float = 4500.0
    true_positive_value: float = 1800.0


def _confusion(y: Column, positive: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((y == 1) & positive),
        "fp": F.count_if((y == 0) & positive),
        "fn": F.count_if((y == 1) & ~positive),
        "tn": F.count_if((y == 0) & ~positive),
    }


def _rates(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumns(
        {
            "precision": safe_ratio(tp, tp + fp, 0.0),
            "recall": safe_ratio(tp, tp + fn, 0.0),
            "f1": safe_ratio(2 * tp, 2 * tp + fp + fn, 0.0),
        }
    )


def binary_metrics(
    df: DataFrame, y: str = "y", score: str = "score", threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and rates at one threshold; empty denominators give 0."""
    label, positive = F.col(y), F.col(score) >= F.lit(float(threshold))
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(label.cast("double")).alias("positive_rate"),
        *[c.alias(n) for n, c in _confusion(label, positive).items()],
    )
    return _rates(counts).withColumns(
        {
            "accuracy": safe_ratio(F.col("tp") + F.col("tn"), F.col("events"), 0.0),
            "false_positive_rate": safe_ratio(F.col("fp"), F.col("fp") + F.col("tn"), 0.0),
            "false_negative_rate": safe_ratio(F.col("fn"), F.col("fn") + F.col("tp"), 0.0),
        }
    )


def sweep_grid(start: float = 0.10, step: float = 0.05, n: int = 17) -> list[float]:
    """The grid as doubles of ``start + i * step``."""
    return [start + i * step for i in range(n)]


def threshold_sweep(
    df: DataFrame,
    y: str = "y",
    score: str = "score",
    grid: Sequence[float] | None = None,
    costs: CostAssumptions = CostAssumptions(),
) -> DataFrame:
    """Metrics and net value at every threshold.

    Rows are counted once by how many thresholds their score reaches; the sweep then runs
    over that table of at most two rows per threshold.
    """
    grid = list(grid or sweep_grid())
    levels = F.array(*[F.lit(t) for t in grid])
    reached = F.size(F.filter(levels, lambda t: t <= F.col(score)))
    tally = df.groupBy(reached.alias("_k"), F.col(y).alias("_y")).agg(F.count(F.lit(1)).alias("_n"))
    wide = tally.select("*", F.posexplode(levels).alias("_i", "_t"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
    hit = F.col("_k") > F.col("_i")
    swept = wide.groupBy("_t").agg(
        n(hit & (F.col("_y") == 1)).alias("tp"),
        n(hit & (F.col("_y") == 0)).alias("fp"),
        n(~hit & (F.col("_y") == 1)).alias("fn"),
        n(~hit & (F.col("_y") == 0)).alias("tn"),
    )
    valued = _rates(swept).withColumns(
        {
            "false_positive_cost": F.col("fp") * (costs.false_positive_review_minutes * costs.hourly_cost / 60),
            "false_negative_cost": F.col("fn") * costs.false_negative_impact,
            "true_positive_value": F.col("tp") * costs.true_positive_value,
        }
    )
    net = F.col("true_positive_value") - F.col("false_positive_cost") - F.col("false_negative_cost")
    return valued.withColumn("net_value", net).withColumn("threshold", F.round("_t", 2)).drop("_t")


def best_by(df: DataFrame, score: str, tiebreak: str, largest: bool = True) -> DataFrame:
    """The single best row; ties go to the smallest ``tiebreak``."""
    order = F.col(score).desc() if largest else F.col(score).asc()
    return df.orderBy(order, F.col(tiebreak)).limit(1)


def ranking_metrics(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision; NULL where a group has one class only.

    Both come from the same cumulative table of distinct scores.
    """
    counts = materialise(
        distinct_counts(
            df.select(*by, y, score), by, score, {"pos": F.count_if(F.col(y) == 1), "neg": F.count_if(F.col(y) == 0)}
        )
    )
    ranked = cumulate(counts, by, score, ["pos", "neg"])
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_q"))
    if by:
        full = ranked.join(totals, list(by))
    else:
        row = totals.select(F.struct("_p", "_q").alias("s")).scalar()
        full = ranked.withColumn("_s", row).select("*", "_s.*").drop("_s")
    d = lambda c: F.col(c).cast("double")
    below = d("cum_neg") - d("neg")
    tp = d("_p") - (d("cum_pos") - d("pos"))
    fp = d("_q") - below
    both = F.min((F.col("_p") > 0) & (F.col("_q") > 0))
    auc = F.sum(F.try_divide(d("pos") * (below + d("neg") / 2), d("_p") * d("_q")))
    ap = F.sum(F.try_divide(d("pos"), d("_p")) * F.try_divide(tp, tp + fp))
    return full.groupBy(*by).agg(
        F.when(both, auc).alias("roc_auc"),
        F.when(both, ap).alias("pr_auc"),
    )


def metrics_by_group(
    df: DataFrame, by: Sequence[str], y: str = "y", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """Threshold metrics and ranking metrics per group."""
    flat = binary_metrics(df, y, score, threshold, by).select(
        *by, "events", F.col("positive_rate").alias("incident_rate"), "tp", "fp", "fn", "tn", "precision", "recall", "f1"
    )
    return flat.join(ranking_metrics(df, y, score, by), list(by))


def model_quality(report: DataFrame) -> DataFrame:
    """Status and recommendation from the metrics of a group."""
    p, r = F.col("precision"), F.col("recall")
    return report.withColumns(
        {
            "recommendation": case_ladder(
                [
                    (r < 0.60, "raise_recall"),
                    (p < 0.50, "reduce_false_positives"),
                    (F.col("f1") < 0.55, "rebalance_model"),
                    (F.col("pr_auc") < 0.50, "improve_features_and_sampling"),
                ],
                "acceptable_monitor_drift",
            ),
            "quality_status": case_ladder(
                [((p >= 0.60) & (r >= 0.70), "GOOD"), ((p >= 0.45) & (r >= 0.55), "REVIEW")], "CRITICAL"
            ),
        }
    )


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    cells = confusion_matrix(df, y, yhat)
    hit = F.col("actual") == F.col("predicted")
    # Each cell counts once for its actual and once for its predicted class.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted_n"),
                         F.when(hit, F.col("n")).otherwise(0).alias("tp")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"),
                         F.col("n").alias("predicted_n"), F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("c")
    ).select("c.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted_n", "tp")])
    return sums.select(
        "label",
        safe_ratio("tp", "predicted_n", 0.0).alias("precision"),
        safe_ratio("tp", "support", 0.0).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("support") + F.col("predicted_n"), 0.0).alias("f1"),
        "support",
    )


def with_abs_error(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.withColumn("abs_error", F.abs(F.col(y) - F.col(yhat)))


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    e = F.col(y) - F.col(yhat)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def promotion_gate(metrics: DataFrame, metric: str, limit: float, at_least: bool = True) -> DataFrame:
    """Accept a candidate model by one metric."""
    ok = F.col(metric) >= limit if at_least else F.col(metric) <= limit
    sign = F.when(ok, ">=" if at_least else "<=").otherwise("<" if at_least else ">")
    verdict = F.when(ok, "accepted").otherwise("rejected")
    return metrics.withColumns(
        {
            "accepted": F.coalesce(ok, F.lit(False)),
            "reason": F.concat(F.lit("model "), verdict, F.format_string(": %.4f ", F.col(metric)), sign,
                               F.lit(f" {limit:.4f}")),
            "next_step": F.when(ok, "register_candidate_model").otherwise("review_features_or_training_data"),
        }
    )
