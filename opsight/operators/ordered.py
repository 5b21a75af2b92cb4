"""Order-dependent work over keys that may be arbitrarily large.

A plain ``Window.partitionBy(service)`` sends one service to one task. With a handful of
services that is a handful of tasks, and a service holding a third of the rows never
finishes. Everything here therefore splits a series by time first:

* ``positions``   - the row number of each row in its series, from per-bucket counts
* ``over_frames`` - ROWS frames over equal chunks of a series, with the neighbouring rows
                    each chunk needs copied in (the halo) and dropped again afterwards
* ``carry_last``  - last non-null value so far, from per-bucket summaries
* ``running_sum`` - cumulative sum, from per-bucket summaries
* ``session_numbers`` - gap sessions, from per-bucket summaries

Every one is exact. The per-bucket summaries have one row per key and bucket, so the only
window that spans a whole series runs over ``time range / bucket`` rows. A bucket with more
than ``DENSE`` rows is cut again, at quantiles of the whole order (see :func:`_placer`), so one
instant, or the rows without a time, may hold any share of the rows as long as the further
columns of the order tell them apart. Rows whose key is NULL form no series and are dropped, as
grouping by that key does in pandas. Rows whose time is NULL come last in their series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

BUCKET, PIECE, POS, CHUNK, HALO = "_bucket", "_piece", "_pos", "_chunk", "_halo"
#: Rows above which a bucket is cut into pieces of about that many, and the number of pieces that
#: all buckets together may have: beyond it pieces grow, so that their edges stay small enough to
#: be broadcast.
DENSE, PIECES = 1_000_000, 10_000
#: Rows of a bucket's sample between two edges.
SAMPLES = 32
#: Bucket of the rows without a time.
UNTIMED = 1 << 62

UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(width: str) -> int:
    n, unit = width.split()
    return int(n) * UNITS[unit.rstrip("s")]


def time_bucket(ts: str | Column, width: str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.floor(micros / F.lit(seconds_of(width) * 1_000_000)).cast("bigint")


def suggest_bucket(df: DataFrame, keys: Sequence[str], ts: str, rows: int = 1_000_000) -> str:
    """Bucket width that gives the densest series about ``rows`` rows per bucket.

    One aggregation over keys and times. The defaults suit up to some hundred rows a second
    and series; ask here when a hot series is denser than that.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    span = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), (F.max(micros) - F.min(micros)).alias("span"))
    rate = span.agg(F.max(F.col("n") / F.greatest(F.col("span") / 1e6, F.lit(1.0))).alias("r")).collect()[0]["r"] or 0
    for width in ("1 day", "1 hour", "10 minutes", "1 minute", "10 seconds"):
        if rate * seconds_of(width) <= rows:
            return width
    return "1 second"


def _before(keys: Sequence[str]) -> WindowSpec:
    """All earlier pieces of the same series, over the small table of pieces."""
    return Window.partitionBy(*keys).orderBy(BUCKET, PIECE).rowsBetween(Window.unboundedPreceding, -1)


def _inside(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BUCKET, PIECE).orderBy(*order)


def _attach(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-piece values; the big side is already hashed on (keys, bucket, piece)."""
    return df.join(summary, [*keys, BUCKET, PIECE], "inner")


def _placer(
    source: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: str | Column
) -> tuple[Callable[..., DataFrame], Callable[..., DataFrame]]:
    """Two functions: one adds bucket and piece, which never decrease along the order, to rows;
    one aggregates rows per piece.

    ``source`` has the keys and the order of the rows to come. Buckets of more than ``DENSE``
    rows get edges: a sample by hash of their distinct places in the order is sorted, and every
    ``SAMPLES``-th is an edge. A row's piece is the number of edges at or before it. Where no
    bucket is dense, the edges are an empty table, and the adaptive planner drops all that joins
    with them; what is left is one count per bucket.
    """
    place = _bucket_of(order, bucket)
    short = source.select(*keys, *[c for c in order if c not in keys], place.alias(BUCKET))
    counts = short.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    most = F.greatest(F.lit(float(DENSE)), counts.agg(F.sum("_n") / PIECES).scalar())
    dense = counts.filter(F.col("_n") > DENSE).filter(F.col("_n") > most) \
        .select(*keys, BUCKET, F.greatest(F.lit(1), F.floor(most / SAMPLES)).cast("bigint").alias("_step"))
    along = F.struct(*[F.col(c) for c in order])
    chosen = short.join(F.broadcast(dense), [*keys, BUCKET]) \
        .filter(F.pmod(F.xxhash64(*order, F.lit("edge")), F.col("_step")) == 0)
    sample = F.sort_array(F.collect_set(along))
    edges = chosen.groupBy(*keys, BUCKET).agg(sample.alias("_sample")).filter(F.size("_sample") > SAMPLES).select(
        *keys, BUCKET, F.transform(F.sequence(F.lit(SAMPLES), F.size("_sample") - 1, F.lit(SAMPLES)),
                                   lambda i: F.get("_sample", i)).alias("_edges"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        right = F.get("_edges", middle) <= along
        open_ = at["lo"] < at["hi"]
        return F.struct(F.when(open_ & right, middle + 1).otherwise(at["lo"]).alias("lo"),
                        F.when(open_ & ~right, middle).otherwise(at["hi"]).alias("hi"))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size("_edges") + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size("_edges").alias("hi"))
    piece = F.when(F.col("_edges").isNull(), 0).otherwise(F.aggregate(rounds, start, halve, lambda at: at["lo"]))

    def placed(df: DataFrame, how: str = "left") -> DataFrame:
        return df.withColumn(BUCKET, place).join(F.broadcast(edges), [*keys, BUCKET], how) \
            .withColumn(PIECE, piece).drop("_edges")

    def per_piece(df: DataFrame, agg: Column) -> DataFrame:
        whole = df.withColumn(BUCKET, place).groupBy(*keys, BUCKET).agg(agg) \
            .join(F.broadcast(edges.drop("_edges")), [*keys, BUCKET], "left_anti").withColumn(PIECE, F.lit(0))
        return whole.unionByName(placed(df, "inner").groupBy(*keys, BUCKET, PIECE).agg(agg))

    return placed, per_piece


def _bucket_of(order: Sequence[str], bucket: str | Column) -> Column:
    return F.coalesce(time_bucket(order[0], bucket), F.lit(UNTIMED)) if isinstance(bucket, str) else bucket


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: str | Column = "1 hour",
    index: DataFrame | None = None,
) -> DataFrame:
    """Add ``_pos``: the 0-based place of each row in its series, ``order[0]`` being the time.

    ``bucket`` is a time width, or a column that never decreases along ``order``.
    ``index`` is any relation with the same keys and times, row for row. Passing the base
    scan keeps the count pass to two columns when ``df`` is a long derivation of it.
    """
    source = df if index is None else index
    place, per_piece = _placer(source, keys, order, bucket)
    counts = per_piece(source.select(*keys, *[c for c in order if c not in keys]), F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        *keys, BUCKET, PIECE, F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)).alias("_offset")
    )
    numbered = place(df).withColumn("_rn", F.row_number().over(_inside(keys, order)))
    placed = _attach(numbered, offsets, keys)
    return placed.withColumn(POS, F.col("_offset") + F.col("_rn") - 1).drop(BUCKET, PIECE, "_rn", "_offset")


def over_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    exprs: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    bucket: str = "1 hour",
    chunk: int = 20_000,
    index: DataFrame | None = None,
    then: Sequence[Callable[[WindowSpec], dict[str, Column]]] = (),
) -> DataFrame:
    """Columns computed over frames reaching ``before`` rows back and ``after`` rows ahead.

    ``exprs`` receives the ordered window of one chunk and returns named columns whose frames
    stay within that reach; ``then`` holds further rounds that read earlier columns of the
    same row. Chunks have equal size, so a hot series is as parallel as the data is long.
    """
    spread = _chunked(df, keys, order, before, after, bucket, chunk, index)
    window = Window.partitionBy(*keys, CHUNK).orderBy(POS)
    out = spread.withColumns(exprs(window))
    for more in then:
        out = out.withColumns(more(window))
    return out.filter(~F.col(HALO)).drop(CHUNK, HALO, POS)


def over_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    compute: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    before: int,
    exprs: Callable[[WindowSpec], dict[str, Column]] | None = None,
    bucket: str = "1 hour",
    chunk: int = 20_000,
    index: DataFrame | None = None,
) -> DataFrame:
    """Trailing frames computed by pandas, one bounded chunk of a series at a time.

    For statistics whose native form recomputes every frame from scratch. ``compute`` gets a
    chunk in order, at most ``max(chunk, 2 * before) + before`` rows, and returns the columns of ``schema``.
    ``exprs`` adds native frame columns from the same shuffle.
    """
    spread = _chunked(df, keys, order, before, 0, bucket, chunk, index)
    if exprs:
        spread = spread.withColumns(exprs(Window.partitionBy(*keys, CHUNK).orderBy(POS)))
    added = T._parse_datatype_string(schema)
    names = spread.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS, ignore_index=True)
        new = compute(pdf)
        return pd.concat([pdf[names], new], axis=1)[~pdf[HALO]]

    full = T.StructType([*spread.schema.fields, *added.fields])
    return spread.groupBy(*keys, CHUNK).applyInPandas(run, full).drop(CHUNK, HALO, POS)


def _chunked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    bucket: str,
    chunk: int,
    index: DataFrame | None,
) -> DataFrame:
    """Rows with their chunk, plus the copies neighbouring chunks need."""
    # A wide frame makes wide chunks, so that the copies stay below the rows themselves.
    chunk = max(chunk, 2 * before, 2 * after)
    placed = positions(df, keys, order, bucket, index)
    home = F.floor(F.col(POS) / chunk).cast("bigint")
    inside = F.pmod(F.col(POS), F.lit(chunk))
    copies = [F.struct(home.alias("c"), F.lit(False).alias("h"))]
    if before:
        copies.append(
            F.when(inside >= chunk - before, F.struct((home + 1).alias("c"), F.lit(True).alias("h")))
        )
    if after:
        copies.append(
            F.when((inside < after) & (home > 0), F.struct((home - 1).alias("c"), F.lit(True).alias("h")))
        )
    return (
        placed.withColumn("_to", F.explode(F.array_compact(F.array(*copies))))
        .withColumns({CHUNK: F.col("_to.c"), HALO: F.col("_to.h")})
        .drop("_to")
    )


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    bucket: str = "1 hour",
    index: DataFrame | None = None,
) -> DataFrame:
    """Last non-null ``value`` at or before each row of its series.

    ``index`` is any relation with the same keys, times and values as ``df``; the per-bucket
    pass reads it instead, which spares a long derivation of ``df`` a second evaluation.
    """
    source = df if index is None else index
    place, per_piece = _placer(source, keys, order, bucket)
    base, short = place(df).withColumn("_v", value), source.withColumn("_v", value)
    seen = F.when(F.col("_v").isNotNull(), F.struct(*[F.col(c) for c in order]))
    earlier = per_piece(short, F.max_by("_v", seen).alias("_last")).select(
        *keys, BUCKET, PIECE, F.last("_last", ignorenulls=True).over(_before(keys)).alias("_earlier")
    )
    frame = _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumn("_local", F.last("_v", ignorenulls=True).over(frame))
    return (
        _attach(local, earlier, keys)
        .withColumn(out, F.coalesce("_local", "_earlier"))
        .drop(BUCKET, PIECE, "_v", "_local", "_earlier")
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    bucket: str = "1 hour",
) -> DataFrame:
    """Cumulative sum including the current row."""
    place, per_piece = _placer(df, keys, order, bucket)
    rows = df.withColumn("_v", F.coalesce(value, F.lit(0)))
    base = place(rows)
    earlier = per_piece(rows, F.sum("_v").alias("_sum")).select(
        *keys, BUCKET, PIECE, F.coalesce(F.sum("_sum").over(_before(keys)), F.lit(0)).alias("_earlier")
    )
    frame = _inside(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumn("_local", F.sum("_v").over(frame))
    return (
        _attach(local, earlier, keys)
        .withColumn(out, F.col("_local") + F.col("_earlier"))
        .drop(BUCKET, PIECE, "_v", "_local", "_earlier")
    )


def session_numbers(
    df: DataFrame,
    ts: str,
    gap_minutes: float,
    out: str,
    keys: Sequence[str] = (),
    bucket: str = "1 hour",
) -> DataFrame:
    """Number sessions 1, 2, ... per key; a new one starts after a gap longer than the limit.

    Works on the distinct times of each bucket, so a million rows at one instant cost one.
    """
    gap = int(gap_minutes * 60_000_000)
    times = (
        df.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"),
                  time_bucket(ts, bucket).alias(BUCKET), F.lit(0).alias(PIECE))
        .distinct()
    )
    inside = _inside(keys, ["_t"])
    marked = times.withColumn(
        "_new", F.coalesce((F.col("_t") - F.lag("_t").over(inside) > gap).cast("int"), F.lit(0))
    ).withColumn("_in", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    per_bucket = marked.groupBy(*keys, BUCKET, PIECE).agg(
        F.max("_in").alias("_breaks"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi")
    )
    series = Window.partitionBy(*keys).orderBy(BUCKET)
    opened = per_bucket.withColumn(
        "_open", F.coalesce((F.col("_lo") - F.lag("_hi").over(series) > gap).cast("int"), F.lit(0))
    )
    earlier = opened.select(
        *keys,
        BUCKET,
        PIECE,
        (
            F.coalesce(F.sum(F.col("_breaks") + F.col("_open")).over(_before(keys)), F.lit(0))
            + F.col("_open")
            + 1
        ).alias("_base"),
    )
    numbered = _attach(marked, earlier, keys).select(
        *keys, BUCKET, "_t", (F.col("_base") + F.col("_in")).cast("bigint").alias(out)
    )
    keyed = df.withColumns(
        {BUCKET: time_bucket(ts, bucket), "_t": F.unix_micros(F.col(ts).cast("timestamp"))}
    )
    return keyed.join(numbered, [*keys, BUCKET, "_t"], "inner").drop(BUCKET, "_t")
