"""Streaming pipelines: the batch operators on unbounded frames, plus event-time forms."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsight.functions.nested import decode_message
from opsight.operators import decisions as D
from opsight.session import ensure_checkpoint_dir
from opsight.sources.messages import to_messages, write_split
from opsight.streaming.parse import dead_letters, normalised, parse_messages

# Schema of an anomaly message.
ANOMALY = (
    "event_id bigint, incident_id string, service string, environment string, anomaly_type string, severity string, "
    "anomaly_score double, latency_ms double, error_rate double"
)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def parse_split(messages: DataFrame, folder: str, checkpoint: str, raw: str = "raw"):
    """Normalised events to one sink, failures with their raw text to another."""
    return write_split(
        parse_messages(messages, raw), {"events": normalised, "dead": dead_letters}, folder, checkpoint
    )


def classify_stream(messages: DataFrame, raw: str = "raw") -> DataFrame:
    return D.classify_event(normalised(parse_messages(messages, raw)))


def score_stream(events: DataFrame) -> DataFrame:
    return D.score_events(events)


def fan_out(observations: DataFrame, folder: str, checkpoint: str):
    """All observations to the audit sink, critical ones as incident candidates to another."""
    return write_split(
        observations.withColumn("severity", D.observation_severity("metric", "value")),
        {
            "audit": lambda df: df,
            "critical": lambda df: D.critical_candidate(df.filter(F.col("severity") == "critical")),
        },
        folder,
        checkpoint,
    )


def mitigate_stream(messages: DataFrame, data: str = "data") -> DataFrame:
    """Decode base64 anomaly messages, decide, and emit routed decision messages."""
    events = messages.select(decode_message(data, ANOMALY).alias("m")).filter(F.col("m").isNotNull()).select("m.*")
    decided = D.mitigation(events)
    return decided


def decision_messages(decided: DataFrame) -> DataFrame:
    return to_messages(decided, ["service", "environment", "severity", "action"], key="incident_id")


def route_stream(observations: DataFrame) -> DataFrame:
    """Operation messages of complete decisions; incomplete ones are left to :func:`routing_errors`."""
    routed = D.route_operation(observations.withColumn("severity", D.observation_severity("metric", "value")))
    return routed.filter(F.col("error").isNull())


def operation_messages(routed: DataFrame) -> DataFrame:
    return to_messages(routed.drop("error"), ["severity", "service", "recommended_operation", "priority"], key="event_id")


def suppress_stream(
    items: DataFrame, keys: Sequence[str], ts: str, minutes: int = 60, tie: Sequence[str] = ()
) -> DataFrame:
    """Items to notify: those more than ``minutes`` after the last notification of their key.

    State holds the time of the last notification per key and expires with the interval, so the
    result does not depend on how input in time order is cut into batches. Of items at one instant the
    first by ``tie`` counts; an item older than the last notification is dropped; items without a
    time are passed on. A task holds the items one key has in one batch: limit batches at the source
    and select the columns needed first.
    """
    gap = minutes * 60_000_000

    def decide(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True)
        timed = rows[rows[ts].notna()].sort_values([ts, *tie], kind="stable", ignore_index=True)
        if len(timed) < len(rows):
            yield rows[rows[ts].isna()]
        times = timed[ts].to_numpy("datetime64[us]").astype("int64")
        last = state.get[0] if state.exists else None
        at, sent = 0 if last is None else int(np.searchsorted(times, last + gap, "right")), []
        while at < len(times):
            sent.append(at)
            last = int(times[at])
            at = int(np.searchsorted(times, last + gap, "right"))
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(max((last + gap) // 1000, state.getCurrentWatermarkMs()) + 1)
        if sent:
            yield timed.iloc[sent]

    return items.withWatermark(ts, f"{minutes} minutes").groupBy(*keys).applyInPandasWithState(
        decide, items.schema, "last bigint", "append", "EventTimeTimeout")


def tumbling_alert(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, threshold: float, period: str = "60 seconds",
    delay: str = "10 minutes",
) -> DataFrame:
    """Mean of each aligned period and whether it is above the threshold."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(*keys, F.window(ts, period))
        .agg(F.avg(value).alias("mean_value"))
        .select(*keys, F.col("window.start").alias("period_start"), "mean_value",
                (F.col("mean_value") > threshold).alias("is_alert"))
    )


#: Microseconds of a window of the sliding volume and of its step.
WINDOW, STEP = 3_600_000_000, 300_000_000


def sliding_volume(
    events: DataFrame, baseline: DataFrame, ts: str = "event_ts", delay: str = "10 minutes", ratio: float = 5.0
) -> DataFrame:
    """Hourly event counts sliding by five minutes against each principal's usual hour.

    State holds a principal's counts per five minutes while a window that reads them is open, not a
    row for each of the twelve windows of an event. Counts are added up before the shuffle, so a
    task gets a busy principal as counts. A window is written once the watermark has passed its end;
    an event counts in those of its windows that were still open, and is dropped if there is none.
    """
    schema = "principal string, _from bigint, _last bigint, _n bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["principal", "_from"]).aggregate([("_last", "max"), ("_n", "sum")])
            yield from found.select(["principal", "_from", "_last_max", "_n_sum"]).rename_columns(
                ["principal", "_from", "_last", "_n"]).to_batches()

    at = F.unix_micros(F.col(ts).cast("timestamp"))
    counted = events.filter(F.col(ts).isNotNull()).select(
        "principal", (at - F.pmod(at, F.lit(STEP))).alias("_from"),
        at.alias("_last"), F.lit(1).cast("bigint").alias("_n"),
    ).mapInArrow(count, schema).select("principal", "_from", F.timestamp_micros(F.col("_last") + WINDOW).alias("_latest"), "_n")
    # Rows are dropped by the watermark only where all their windows have ended: it runs on the time plus a window.
    counts = counted.withWatermark("_latest", f"1 hour {delay}").groupBy("principal").applyInPandasWithState(
        _slide, "principal string, _start bigint, event_count bigint",
        "starts array<bigint>, counts array<bigint>, closed bigint", "append", "EventTimeTimeout",
    ).select("principal", F.timestamp_micros("_start").alias("window_start"), "event_count")
    usual = F.greatest(F.coalesce("baseline_event_count", F.lit(1.0)), F.lit(1.0))
    return counts.join(baseline, "principal", "left").select(
        "principal", "window_start", "event_count",
        (F.col("event_count") / usual).alias("volume_ratio"),
        (F.col("event_count") / usual >= ratio).alias("is_anomaly"),
    )


def _slide(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The windows of a principal that the watermark has passed since the last call; the counts still needed are kept."""
    passed = state.getCurrentWatermarkMs() * 1000
    starts, counts, closed = state.get if state.exists else ((), (), passed)
    starts, counts = np.array(starts, np.int64), np.array(counts, np.int64)
    if not state.hasTimedOut:
        for rows in frames:
            both = np.concatenate([starts, rows["_from"].to_numpy(np.int64)])
            starts, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, rows["_n"].to_numpy(np.int64)]), len(starts)).astype(np.int64)
    windows = np.unique(starts[:, None] - STEP * np.arange(WINDOW // STEP))
    windows = windows[(windows + WINDOW > closed) & (windows + WINDOW <= passed)]
    if len(windows):
        upto = np.concatenate([[0], counts.cumsum()])
        found = upto[np.searchsorted(starts, windows + WINDOW)] - upto[np.searchsorted(starts, windows)]
        yield pd.DataFrame({"principal": key[0], "_start": windows, "event_count": found})
    closed = max(closed, passed)
    needed = starts + WINDOW > closed
    if not needed.any():
        if state.exists:
            state.remove()
        return
    starts, counts = starts[needed], counts[needed]
    state.update((starts.tolist(), counts.tolist(), int(closed)))
    # The end of the first window still open; a timeout must lie after the watermark and fires once that is beyond it.
    end = max(int(starts[0]) + STEP, closed // STEP * STEP + STEP)
    state.setTimeoutTimestamp(max(end // 1000 - 1, passed // 1000 + 1))


def session_incidents(
    candidates: DataFrame, keys: Sequence[str], ts: str, gap: str = "10 minutes", delay: str = "30 minutes"
) -> DataFrame:
    """Gap sessions of candidates per key; rows later than the watermark are dropped."""
    return (
        candidates.withWatermark(ts, delay)
        .groupBy(*keys, F.session_window(ts, gap))
        .agg(F.count(F.lit(1)).alias("candidates"), F.max("risk_score").alias("risk_score_max"))
        .select(*keys, F.col("session_window.start").alias("start_ts"), "candidates", "risk_score_max")
    )


def run_to_end(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available in append mode and return what was written."""
    spark = stream.sparkSession
    out, checkpoint = scratch(spark, name), scratch(spark, f"{name}-ckpt")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_restarting(start: Callable[[], StreamingQuery], restarts: int = 3) -> int:
    """Runs a query to its end, starting it again from its checkpoint after a failure; the number of restarts.

    Unacknowledged input is what the checkpoint has not committed: the batch that failed is given to the sink again under
    its old number, and a sink that owns a folder per number replaces what it had written of it.
    """
    for tried in range(restarts + 1):
        try:
            start().awaitTermination()
            return tried
        except StreamingQueryException:
            if tried == restarts:
                raise
    return restarts


def run_split(start: Callable[[str, str], object], spark: SparkSession, name: str) -> str:
    """Run a several-sink query to its end and return its folder."""
    folder = scratch(spark, name)
    start(folder, scratch(spark, f"{name}-ckpt")).awaitTermination()
    return folder
