"""Parsing of log entries into normalised events or dead letters.

The same projection serves a batch frame, a stream and a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsight.functions.scalar import case_ladder

LOG_ENTRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("logName", T.StringType()),
        T.StructField(
            "resource",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("labels", T.StructType([T.StructField("project_id", T.StringType())])),
                ]
            ),
        ),
        T.StructField(
            "jsonPayload",
            T.StructType(
                [
                    T.StructField(n, T.StringType())
                    for n in ("service_name", "event_type", "environment", "latency_ms", "error_rate", "region",
                              "correlation_id", "aiops_candidate")
                ]
            ),
        ),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def parse_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the normalised fields and ``error_message`` (NULL for a good event)."""
    e = df.withColumn("_e", F.from_json(F.col(raw), LOG_ENTRY, {"columnNameOfCorruptRecord": "_corrupt"}))
    payload = lambda name: F.col(f"_e.jsonPayload.{name}")
    filled = lambda c, default: F.when(c.isNotNull() & (c != ""), c).otherwise(F.lit(default))
    absent = lambda c: c.isNull() | (c == "")
    blank_or = lambda name, kind: F.when(
        ~absent(payload(name)), payload(name).try_cast(kind)
    )
    bad_number = (~absent(payload("latency_ms")) & payload("latency_ms").try_cast("double").isNull()) | (
        ~absent(payload("error_rate")) & payload("error_rate").try_cast("double").isNull()
    )
    error = case_ladder(
        [
            (F.col("_e").isNull() | F.col("_e._corrupt").isNotNull(), "invalid JSON"),
            (absent(payload("service_name")) | absent(payload("event_type")),
             "missing mandatory field: service_name or event_type"),
            (bad_number, "invalid number: latency_ms or error_rate"),
        ],
        F.lit(None).cast("string"),
    )
    return e.withColumns(
        {
            "error_message": error,
            "raw_message": F.col(raw),
            "event_timestamp": F.col("_e.timestamp"),
            "severity": F.coalesce("_e.severity", F.lit("DEFAULT")),
            "log_name": F.col("_e.logName"),
            "resource_type": F.col("_e.resource.type"),
            "project_id": F.col("_e.resource.labels.project_id"),
            "service_name": payload("service_name"),
            "environment": filled(payload("environment"), "unknown"),
            "event_type": payload("event_type"),
            "latency_ms": F.coalesce(blank_or("latency_ms", "double").try_cast("bigint"), F.lit(0)).cast("bigint"),
            "error_rate": F.coalesce(blank_or("error_rate", "double"), F.lit(0.0)),
            "region": filled(payload("region"), "unknown"),
            "correlation_id": F.coalesce(payload("correlation_id"), F.lit("")),
            # Strict boolean: the text "false" is false.
            "aiops_candidate": F.coalesce(payload("aiops_candidate").try_cast("boolean"), F.lit(False)),
        }
    ).drop("_e", *([raw] if raw != "raw_message" else []))


def normalised(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_message").isNull()).drop("error_message", "raw_message")


def dead_letters(parsed: DataFrame) -> DataFrame:
    kept = [c for c in ("event_id", "error_message", "raw_message") if c in parsed.columns]
    return parsed.filter(F.col("error_message").isNotNull()).select(*kept)
