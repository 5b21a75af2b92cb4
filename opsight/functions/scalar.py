"""Scalar column helpers shared by every operator.

All of them are native expressions, so they stay inside whole-stage codegen.
Comparisons follow pandas: an unknown value never satisfies a predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c: ColumnOrName) -> Column:
    """NaN and infinities become NULL."""
    c = col(c).cast("double")
    bad = F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(~bad, c)


def is_true(cond: Column) -> Column:
    """Three-valued logic collapsed to False, as a comparison with NaN is in pandas."""
    return F.coalesce(cond, F.lit(False))


def as_int(cond: Column) -> Column:
    return is_true(cond).cast("int")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, default: float | None = None) -> Column:
    ratio = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(float(default)))


def clamp(c: ColumnOrName, lo: float, hi: float) -> Column:
    c = col(c).cast("double")
    return F.when(c.isNotNull(), F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), c)))


def minutes_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    micros = F.unix_micros(col(later).cast("timestamp")) - F.unix_micros(col(earlier).cast("timestamp"))
    return micros / F.lit(60_000_000.0)


def case_ladder(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First rule whose condition holds wins."""
    expr = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if expr is None else expr.otherwise(default)


def lookup(key: ColumnOrName, mapping: dict[str, object], default: object = None) -> Column:
    """Policy table given as a Python dict, turned into a CASE over literals."""
    key = col(key)
    return case_ladder([(key == F.lit(k), v) for k, v in mapping.items()], default)


def bin_label(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Interval label; values outside every interval give NULL."""
    c = col(c)
    rules = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        inside = (c > lo) & (c <= hi) if right else (c >= lo) & (c < hi)
        rules.append((inside, label))
    return case_ladder(rules, F.lit(None).cast("string"))


def to_float_or(c: ColumnOrName, default: float = 0.0) -> Column:
    return F.coalesce(F.expr("try_cast(null as double)") if c is None else col(c).try_cast("double"),
                      F.lit(float(default)))


def to_int_or(c: ColumnOrName, default: int = 0) -> Column:
    """Parse through double and truncate toward zero."""
    number = finite_or_null(col(c).try_cast("double"))
    return F.coalesce(number.try_cast("bigint"), F.lit(default).cast("bigint"))


def strip(c: ColumnOrName) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+\z", "")


def normalize_severity(c: ColumnOrName) -> Column:
    text = F.upper(F.when(col(c) == "", F.lit(None)).otherwise(col(c)))
    return case_ladder(
        [
            (text.isNull(), "INFO"),
            (text == "WARNING", "WARN"),
            (text.isin("ALERT", "EMERGENCY", "FATAL"), "CRITICAL"),
        ],
        text,
    )


# Ordinal of each severity name, by consumer.
ACTION_SEVERITY = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
QUEUE_SEVERITY = {"CRITICAL": 4, "HIGH": 3, "WARNING": 2}
EVENT_SEVERITY = {"DEBUG": 0, "INFO": 0, "WARN": 1, "WARNING": 1, "ERROR": 3, "CRITICAL": 5}
TIER_SCORE = {"internal": 1, "standard": 2, "critical": 3}


def severity_rank(c: ColumnOrName, ranks: dict[str, int], default: int = 0) -> Column:
    return lookup(F.upper(col(c)), ranks, default)


def slugify(c: ColumnOrName) -> Column:
    text = F.lower(strip(c))
    text = F.regexp_replace(text, "[^a-z0-9-]+", "-")
    text = F.regexp_replace(text, "-+", "-")
    return F.regexp_replace(text, "^-|-$", "")


def stable_id(*parts: ColumnOrName, length: int = 16, sep: str = "-") -> Column:
    """Content hash: same row, same id, whatever the partitioning or a retry did."""
    text = F.concat_ws(sep, *[col(p).cast("string") for p in parts])
    return F.substring(F.sha2(text, 256), 1, length)


def contains_any(c: ColumnOrName, tokens: Sequence[str]) -> Column:
    text = F.lower(col(c))
    cond = F.lit(False)
    for token in tokens:
        cond = cond | text.contains(token.lower())
    return is_true(cond)


def array_sum(arr: ColumnOrName, field: str) -> Column:
    """Sum of one field over an array of structs; 0 for a missing or empty array."""
    total = F.aggregate(
        col(arr), F.lit(0.0), lambda acc, x: acc + F.coalesce(x[field].cast("double"), F.lit(0.0))
    )
    return F.coalesce(total, F.lit(0.0))


def prob_of_label(arr: ColumnOrName, label: int, label_field: str = "label", prob_field: str = "prob") -> Column:
    hits = F.filter(col(arr), lambda x: x[label_field] == F.lit(label))
    return F.get(hits, F.lit(0))[prob_field]


def money_to_double(money: ColumnOrName) -> Column:
    """Units plus nanos of a money struct; absent parts count as zero."""
    money = col(money)
    units = F.coalesce(money["units"].try_cast("double"), F.lit(0.0))
    nanos = F.coalesce(money["nanos"].try_cast("double"), F.lit(0.0))
    return units + nanos / F.lit(1_000_000_000.0)


def calendar_features(
    df: DataFrame,
    ts: str,
    trend: bool = True,
    business: tuple[int, int] = (9, 18),
) -> DataFrame:
    """Hour, weekday (Monday 0), day of month, month, weekend and business-hour flags.

    ``trend_index`` counts days since the first day of the whole input; the first day
    is a scalar subquery, not a window over all rows.
    """
    t = F.col(ts)
    out = df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": F.weekday(t),
            "day_of_month": F.dayofmonth(t),
            "month": F.month(t),
            "is_weekend": (F.weekday(t) >= 5).cast("int"),
            "is_business_hours": F.hour(t).between(*business).cast("int"),
        }
    )
    if trend:
        first_day = df.agg(F.min(F.to_date(t)).alias("d")).scalar()
        out = out.withColumn("trend_index", F.datediff(F.to_date(t), first_day))
    return out


def lookback(df: DataFrame, ts: str, interval: str, as_of: Column) -> DataFrame:
    """Rows not older than ``interval`` before ``as_of``; a plain range filter that pushes down."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {interval}"))
