"""Message streams: source, routed output and the two-way sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "json",
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Unbounded source of files; a broker source has the same shape after its value is cast to text."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def to_messages(df: DataFrame, attributes: Sequence[str], key: Column | str | None = None) -> DataFrame:
    """Rows as JSON messages with routing attributes, in the shape a broker sink takes."""
    headers = F.array(
        *[
            F.struct(
                F.lit(a).alias("key"),
                F.coalesce(F.col(a).cast("string"), F.lit("unknown")).cast("binary").alias("value"),
            )
            for a in attributes
        ]
    )
    key = F.lit(None) if key is None else (F.col(key) if isinstance(key, str) else key)
    return df.select(
        key.cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"),
        headers.alias("headers"),
    )


def split_writer(
    branches: dict[str, Callable[[DataFrame], DataFrame]], folder: str
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body writing several projections of one micro-batch.

    The batch is kept while the branches read it, so its source is read once. Each branch
    owns one folder per batch id and overwrites it, so a retried batch leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, project in branches.items():
                project(batch).write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def write_split(
    stream: DataFrame, branches: dict[str, Callable[[DataFrame], DataFrame]], folder: str, checkpoint: str
):
    """Main and dead-letter (or any number of) sinks behind one checkpointed query."""
    return (
        stream.writeStream.foreachBatch(split_writer(branches, folder))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
