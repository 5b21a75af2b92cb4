"""Context of a support request."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsight.operators.joins import latest_n


def nested(df: DataFrame, key: str, order: str, fields: list[str], out: str) -> DataFrame:
    """Rows of a key as an ordered array of structs; callers bound the rows per key."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), *[F.col(f) for f in fields if f != order])))
    return df.groupBy(key).agg(rows.alias(out))


def assemble_context(
    requests: DataFrame,
    matches: DataFrame,
    runbooks: DataFrame,
    reports: DataFrame,
    n_reports: int = 3,
) -> DataFrame:
    """Each request with its runbooks and the latest reports of its service.

    Reports are cut to ``n_reports`` per service (the feature) before they are nested and
    joined, so neither side of the join can explode.
    """
    books = nested(
        matches.join(runbooks, "runbook_id"), "request_id", "runbook_rank", ["runbook_id", "symptoms"], "runbooks"
    )
    recent = latest_n(
        reports.withColumn("_service", F.lower("service_name")),
        ["_service"], [F.desc("created_at"), F.desc("report_no")], n_reports,
    )
    latest = nested(recent, "_service", "rank", ["report_no", "severity"], "recent_reports")
    empty = lambda c: F.coalesce(F.col(c), F.array())
    return (
        requests.withColumn("_service", F.lower(F.coalesce("service_guess", F.lit(""))))
        .join(books, "request_id", "left")
        .join(latest, "_service", "left")
        .withColumns({"runbooks": empty("runbooks"), "recent_reports": empty("recent_reports")})
        .drop("_service")
    )
