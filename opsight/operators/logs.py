"""Log templates and their roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from opsight.functions.scalar import severity_rank
from opsight.functions.text import log_template, redact
from opsight.session import materialise

# Order of log severities.
LOG_SEVERITY = {"DEFAULT": 0, "DEBUG": 1, "INFO": 2, "NOTICE": 3, "WARNING": 4, "ERROR": 5, "CRITICAL": 6, "ALERT": 7,
                "EMERGENCY": 8}


def pattern_rollup(
    df: DataFrame, message: str, ts: str, severity: str, tiebreak: str, examples: int = 3, pattern: str = "message_pattern"
) -> DataFrame:
    """Count, first and last time, highest severity and the newest examples per template.

    Templates are worked out once and written, as two passes read them. Counts combine on the map side. Examples are ranked apart: the window group limit keeps
    at most ``examples`` rows per template and task, so a template holding most of the log
    never gathers in one place.
    """
    keyed = materialise(df.select(message, ts, severity, tiebreak, log_template(message).alias(pattern)))
    rank = severity_rank(severity, LOG_SEVERITY)
    totals = keyed.groupBy(pattern).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.max_by(severity, rank).alias("max_severity"),
    )
    newest = Window.partitionBy(pattern).orderBy(F.desc(ts), F.col(tiebreak))
    shown = (
        keyed.select(pattern, message, ts, tiebreak)
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= examples)
        .groupBy(pattern)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", message))), lambda s: s[message]).alias("examples"))
    )
    return totals.join(shown, pattern)


def log_patterns(
    df: DataFrame, message: str, ts: str, severity: str, tiebreak: str, top: int = 20, minimum: str = "ERROR"
) -> DataFrame:
    """Redacted templates of severe lines, most frequent first (a top-k report)."""
    severe = df.filter(severity_rank(severity, LOG_SEVERITY) >= LOG_SEVERITY[minimum])
    clean = severe.withColumn(message, redact(message))
    return (
        pattern_rollup(clean, message, ts, severity, tiebreak)
        .orderBy(F.desc("count"), F.col("message_pattern"))
        .limit(top)
    )
