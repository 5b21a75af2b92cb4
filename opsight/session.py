"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(app: str = "opsight", cpus: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; only a local master gets a temporary one where none is named."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if not known.isEmpty():
        return configured or known.get()
    if not configured:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        configured = tempfile.mkdtemp(prefix="opsight-ckpt-")
    context.setCheckpointDir(configured)
    return configured


_FOLDERS: set[str] = set()
_OPEN: list[list[str]] = []


def _stage_folder(spark: SparkSession) -> str:
    """The folder of this application's stages; the JVM deletes it when it ends, also after the session was stopped."""
    folder = f"{ensure_checkpoint_dir(spark)}/opsight-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        path, fs = file_system(spark, folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _FOLDERS.add(folder)
    return folder


def file_system(spark: SparkSession, folder: str):
    """The path of a folder and the file system it is in, as Hadoop has them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Cut lineage of a stage that several branches or iterations read.

    The stage is written as a table in the shared checkpoint folder, so a lost executor costs
    nothing, no branch recomputes it, and readers fetch only the columns they use. The stages of a
    session lie in one folder, which is deleted when the application ends; :func:`collecting` and
    :func:`discard` free them earlier. Rows with values of megabytes are better written with
    ``zstd``, whose buffers lie in the heap, than with ``snappy``, whose grow outside of it.
    """
    spark = df.sparkSession
    path = f"{_stage_folder(spark)}/stage-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def collecting(paths: list[str]) -> Iterator[None]:
    """Notes the tables that :func:`materialise` writes meanwhile."""
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.pop()


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete noted tables once nothing reads them any more."""
    while paths:
        path, fs = file_system(spark, paths.pop())
        fs.delete(path, True)
