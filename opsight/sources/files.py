"""File sources and sinks."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsight.functions.scalar import stable_id
from opsight.functions.text import redact
from opsight.operators.security import AUDIT_ENTRY
from opsight.session import file_system


def read_events_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, required: Sequence[str], header: bool = True
) -> DataFrame:
    """CSV scan with an explicit schema; refuses a file whose header lacks required columns."""
    found = spark.read.option("header", header).csv(path).columns
    missing = sorted(set(required) - set(found))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    known = {f.name: f for f in typed.fields}
    # CSV columns are positional: keep the order of the file, types from the schema.
    ordered = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in found])
    return spark.read.schema(ordered).option("header", header).option("enforceSchema", False).csv(path)


def spread(scan: DataFrame) -> DataFrame:
    """More partitions for a scan with fewer splits than the cluster has cores.

    Work that is heavy per row (text, models) starves on a small file. A large scan already
    has more splits than cores and is returned as it is, so no shuffle is added at scale.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.partitionBy(*partition_by).save(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append-only evidence log, one JSON object per line."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


#: Files of a folder: many folders are listed by many tasks.
FOLDER_FILES = 1_000


def write_documents(docs: DataFrame, folder: str) -> None:
    """A text file ``doc=<key>...`` of its own for each row of (key, text), a missing text being empty.

    On a file system that workers see as files, each task writes a folder and renames it when it is whole, so a
    second attempt adds nothing: Spark's writer starts a process or two for the mode of every file and folder.
    """
    key, text = docs.columns
    path, fs = file_system(docs.sparkSession, folder)
    fs.mkdirs(path)
    if fs.getUri().getScheme() != "file":
        (docs.select(F.col(key).alias("doc"), F.coalesce(text, F.lit("")).alias("value")).write.mode("append").partitionBy("doc")
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder))
        return
    root = path.toUri().getPath()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, written = f"{task.partitionId():05d}", 0
        held = f"{root}/_attempt-{part}-{task.taskAttemptId()}"
        os.makedirs(held)
        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns)):
                if written % FOLDER_FILES == 0:
                    os.mkdir(inside := f"{held}/{written // FOLDER_FILES:05d}")
                with open(f"{inside}/doc={name}.{written}.txt", "wb") as file:
                    file.write(f"{value or ''}\n".encode())
                written += 1
        try:
            os.rename(held, f"{root}/{part}")
        except OSError:
            # An attempt before has written the folder, which holds the same rows.
            if not os.path.isdir(f"{root}/{part}"):
                raise
        yield pa.RecordBatch.from_pydict({"n": pa.array([written], pa.int64())})

    docs.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown and text files under a folder, redacted, with id, title and path."""
    # As bytes: the text source copies the whole configuration for every file.
    raw = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{md,MD,txt,TXT}")
        .load(folder)
        .select(F.col("_metadata.file_path").alias("source_path"), F.col("content").cast("string").alias("value"))
    )
    # A split takes 32 files at most, however small: some splits a task.
    splits, cores = raw.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    raw = raw.coalesce(max(splits // 16, min(splits, 4 * cores), 1))
    content = redact("value")
    stem = F.regexp_replace(F.element_at(F.split("source_path", "/"), -1), r"\.[^.]*$", "")
    fallback = F.initcap(F.replace(stem, F.lit("_"), F.lit(" ")))
    docs = raw.withColumn("content", content)
    # The first heading line; its text may be empty, which counts as no title.
    heading = F.regexp_extract("content", r"(?m)^\s*#+(.*)$", 1)
    title = F.trim(F.regexp_replace(heading, r"^#+", ""))
    return docs.select(
        stable_id("source_path", length=12).alias("doc_id"),
        F.when(title != "", title).otherwise(fallback).alias("title"),
        "source_path",
        "content",
    )


def read_audit_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested audit-log entries, one JSON object per line."""
    return spark.read.schema(AUDIT_ENTRY).json(path)
