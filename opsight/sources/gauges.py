"""Labelled gauge series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_points(
    df: DataFrame, keys: Sequence[str], ts: str, minutes: int, as_of: Column, tiebreak: str
) -> DataFrame:
    """Newest point of each labelled series within the last ``minutes``.

    The time range reaches the scan; ``max_by`` keeps one row per series and task.
    """
    recent = df.filter((F.col(ts) >= as_of - F.expr(f"INTERVAL {minutes} MINUTES")) & (F.col(ts) <= as_of))
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(ts, tiebreak))
    return recent.groupBy(*keys).agg(newest.alias("_p")).select(*keys, "_p.*")
