"""Joins of the analytics layer. Strategy and skew handling are left to Catalyst and AQE."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.functions.scalar import lookup
from opsight.operators.ordered import carry_last


def enrich_catalog(df: DataFrame, key: str, catalog: dict[str, dict[str, object]]) -> DataFrame:
    """Attach catalogue attributes given as a small policy dict (one CASE per attribute)."""
    fields = list(dict.fromkeys(f for entry in catalog.values() for f in entry))
    return df.withColumns(
        {f: lookup(key, {k: entry.get(f) for k, entry in catalog.items()}) for f in fields}
    )


def enrich_from_table(df: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """The same from a catalogue table.

    No broadcast hint: a small catalogue is broadcast by its measured size, a large one is
    joined by hash, and AQE splits a hot key.
    """
    return df.join(catalog, key, "left")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    take: Sequence[str],
    left_tie: str,
    right_tie: str,
    bucket: str = "1 hour",
    index: DataFrame | None = None,
) -> DataFrame:
    """Latest right row at or before each left row, by key (backward, inclusive).

    Both sides go into one ordered stream in which a right row sorts before a left row of the
    same instant, and the last right row seen is carried forward. The stream is split by
    time, so the only unsplit work is one summary row per key and bucket. ``index`` may name
    a shorter relation with the keys and times of ``left``, such as the scan it derives from.
    A left row without a time matches nothing; a right row without one is never matched.
    """
    payload = F.struct(F.col(right_ts).alias(right_ts), *[F.col(c) for c in take])
    r = right.select(
        *by,
        F.col(right_ts).cast("timestamp").alias("_t"),
        F.lit(0).alias("_side"),
        F.col(right_tie).cast("bigint").alias("_tie"),
        payload.alias("_hit"),
    )
    l = left.select(
        *by,
        F.col(left_ts).cast("timestamp").alias("_t"),
        F.lit(1).alias("_side"),
        F.col(left_tie).cast("bigint").alias("_tie"),
        F.struct(*[F.col(c) for c in left.columns if c not in by]).alias("_row"),
    )
    stream = l.unionByName(r, allowMissingColumns=True)
    short = None
    if index is not None:
        times = index.select(
            *by, F.col(left_ts).cast("timestamp").alias("_t"), F.lit(1).alias("_side"), F.lit(0).cast("bigint").alias("_tie")
        )
        short = times.unionByName(r, allowMissingColumns=True)
    joined = carry_last(stream, by, ["_t", "_side", "_tie"], F.col("_hit"), "_match", bucket, short)
    timed = F.when(F.col("_t").isNotNull(), F.col("_match"))
    return joined.filter(F.col("_side") == 1).withColumn("_match", timed).select(
        *by, "_row.*", F.col(f"_match.{right_ts}").alias(right_ts), *[F.col(f"_match.{c}").alias(c) for c in take]
    )


def join_baseline(
    df: DataFrame, baseline: DataFrame, keys: Sequence[str], value: str, default: float = 1.0
) -> DataFrame:
    return df.join(baseline, list(keys), "left").withColumn(value, F.coalesce(value, F.lit(default)))


def novelty_flag(
    current: DataFrame, history: DataFrame, keys: Sequence[str], out: str = "is_novel"
) -> DataFrame:
    """True where the key combination never occurs in the history."""
    known = history.select(*keys).distinct().withColumn("_known", F.lit(True))
    return current.join(known, list(keys), "left").withColumn(out, F.col("_known").isNull()).drop("_known")


def novel_pairs(current: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return current.select(*keys).distinct().join(history.select(*keys), list(keys), "left_anti")


def suppress_recent(
    items: DataFrame,
    log: DataFrame,
    key: str,
    log_ts: str,
    status: str,
    minutes: int,
    as_of: Column,
    counted: Sequence[str] = ("SENT", "DRY_RUN"),
) -> DataFrame:
    """Items without a delivered notification in the last ``minutes``: one anti join."""
    recent = log.filter(
        (F.col(log_ts) >= as_of - F.expr(f"INTERVAL {minutes} MINUTES")) & F.col(status).isin(*counted)
    ).select(key)
    return items.join(recent, key, "left_anti")


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def match_runbooks(
    requests: DataFrame,
    runbooks: DataFrame,
    request_id: str = "request_id",
    service: str = "service_guess",
    category: str = "category",
    runbook_id: str = "runbook_id",
    runbook_service: str = "service_name",
    symptoms: str = "symptoms",
    n: int = 5,
) -> DataFrame:
    """Runbooks of the same service or whose symptoms mention the category, first ``n`` by id.

    A category is mentioned where ``symptoms LIKE '%category%'`` holds, with its wildcards ``_``
    and ``%``, in any case. The OR is split: services by an equi-join, categories by
    :func:`first_mentions`. Each side keeps only its first ``n`` runbooks per service or category
    before the join: a request can use no more than that, so the join output is bounded by
    ``2 n`` rows per request.
    """
    books = runbooks.select(
        F.col(runbook_id),
        F.lower(F.col(runbook_service)).alias("_service"),
        F.lower(F.col(symptoms)).alias("_symptoms"),
    )
    asked = requests.select(
        F.col(request_id),
        F.lower(F.coalesce(F.col(service), F.lit(""))).alias("_service"),
        F.lower(F.coalesce(F.col(category), F.lit(""))).alias("_category"),
    )
    first = [F.col(runbook_id)]
    by_service = latest_n(books, ["_service"], first, n).select("_service", runbook_id)

    mentioned = first_mentions(books.select(F.col(runbook_id).alias("id"), F.col("_symptoms").alias("text")),
                               asked.select(F.col("_category").alias("pattern")).distinct(), n) \
        .select(F.col("pattern").alias("_category"), F.col("id").alias(runbook_id))
    by_category = latest_n(mentioned, ["_category"], first, n).select("_category", runbook_id)

    hits = (
        asked.join(by_service, "_service").select(request_id, runbook_id)
        .union(asked.join(by_category, "_category").select(request_id, runbook_id))
        .distinct()
    )
    return latest_n(hits, [request_id], first, n, out="runbook_rank")


#: Texts of a block, in characters, and patterns of a block that meets it.
BLOCK_CHARS, BLOCK_PATTERNS = 8_000_000, 20_000


class LikePattern:
    """``LIKE '%pattern%'`` as fixed parts in order; ``needle`` is the longest of them, empty where all is wildcards."""

    def __init__(self, pattern: str):
        runs = [run for run in pattern.split("%") if run]
        self.needle = max((part for run in runs for part in run.split("_")), key=len, default="")
        self.plain = len(runs) == 1 and runs[0] == self.needle
        # Taken leftmost one after the other, the runs between percent signs are found wherever LIKE finds them.
        self.runs = [re.compile("".join("." if c == "_" else re.escape(c) for c in run), re.DOTALL) for run in runs]

    def found_in(self, text: str) -> bool:
        at = 0
        for run in self.runs:
            hit = run.search(text, at)
            if hit is None:
                return False
            at = hit.end()
        return True


def first_mentions(texts: DataFrame, patterns: DataFrame, n: int, block_chars: int = BLOCK_CHARS,
                   block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """(pattern, id): the ``n`` smallest ids of the texts in which each pattern occurs, by ``LIKE '%pattern%'``.

    ``texts`` has id and text, ``patterns`` one pattern per row. Blocks of texts meet blocks of
    patterns through a keyed join. Such a meeting builds one automaton over the longest fixed part
    of each pattern and reads every text once; a hit is checked for the rest of its pattern. A
    pattern without a fixed part is checked with every text. Each meeting keeps ``n`` ids per
    pattern, so what is ranked at the end does not grow with the number of mentions. A NULL text
    holds nothing; an id whose text repeats counts once per row.
    """
    chars, count = texts.agg(F.sum(F.length("text"))).first()[0] or 0, patterns.count()
    parts, shards = (max(1, -(-a // b)) for a, b in ((chars, block_chars), (count, block_patterns)))
    held = texts.filter("text IS NOT NULL").withColumn("_row", F.monotonically_increasing_id()) \
        .withColumn("part", F.pmod(F.xxhash64("id", "_row"), F.lit(parts)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).drop("_row")
    wanted = patterns.withColumn("of_shard", F.pmod(F.xxhash64("pattern"), F.lit(shards)).cast("int")) \
        .withColumn("of_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    kind = dict(texts.dtypes)["id"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        best: dict[str, list] = defaultdict(list)
        known = {p: LikePattern(p) for p in right.column("pattern").to_pylist()}
        everywhere = [p for p, like in known.items() if not like.needle]
        needles: dict[str, list[str]] = defaultdict(list)
        for p, like in known.items():
            if like.needle:
                needles[like.needle].append(p)
        automaton = ahocorasick.Automaton()
        for needle in needles:
            automaton.add_word(needle, needle)
        if needles:
            automaton.make_automaton()
        # In the order of ids, so that a pattern that has n of them need not be looked for again.
        left = left.sort_by("id") if left.num_rows else left
        for i, text in zip(left.column("id").to_pylist(), left.column("text").to_pylist()):
            seen = {needle for _, needle in automaton.iter(text)} if needles else ()
            for p in (*everywhere, *(p for needle in seen for p in needles[needle])):
                if len(best[p]) < n and (known[p].plain or known[p].found_in(text)):
                    best[p].append(i)
        rows = [(p, i) for p, ids in best.items() for i in ids]
        return pa.table({"pattern": pa.array([p for p, _ in rows], pa.string()),
                         "id": pa.array([i for _, i in rows], left.schema.field("id").type)})

    return held.groupBy("part", "shard").cogroup(wanted.groupBy("of_part", "of_shard")) \
        .applyInArrow(search, f"pattern string, id {kind}")


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; a deterministic ``dropDuplicates``.

    ``min_by`` keeps one candidate per key on the map side, so a key with many copies
    shuffles one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


def key_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys found on one side only."""
    only_left = left.distinct().exceptAll(right.distinct()).withColumn("side", F.lit("left"))
    only_right = right.distinct().exceptAll(left.distinct()).withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right)
