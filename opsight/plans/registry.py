"""Registry of named queries, each with its SQL twin where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsight.plans.views import VIEWS, TABLES, Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the input tables have them."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select([F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns]) \
        if zoned else df


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(q.build(Tables(spark, sf_dir)))

    run.__name__ = q.name
    return run


def views_used(sql: str) -> list[str]:
    """Adapter views a statement reads, dependencies first."""
    found: list[str] = []

    def add(name: str) -> None:
        for inner in re.findall(r"\{(\w+)\}", VIEWS[name]):
            if inner in VIEWS:
                add(inner)
        if name not in found:
            found.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            add(name)
    return found


def full_sql(sql: str) -> str:
    ctes = [f"{v} AS ({VIEWS[v].format(**{t: t for t in TABLES}, **{n: n for n in VIEWS})})" for v in views_used(sql)]
    body = sql.strip()
    head = "WITH "
    if body[:15].upper() == "WITH RECURSIVE ":
        head, body = "WITH RECURSIVE ", "WITH " + body[15:]
    if not ctes:
        return head + body[5:] if body[:5].upper() == "WITH " else body
    if body[:5].upper() == "WITH ":
        return head + ",\n".join(ctes) + ",\n" + body[5:]
    return head + ",\n".join(ctes) + "\n" + body
