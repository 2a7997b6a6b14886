"""What a session needs to run this package's Python functions."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_ROWS, TEXT_ROWS = "10000", "1000"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the place the driver has it.

    Rows can hold long texts, so where the session has Spark's default, batches are made
    smaller: a worker then holds some megabytes of text at a time.
    """
    if spark.conf.get(BATCH_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_ROWS, TEXT_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares; a private one only where none is named and
    driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="fathom-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once: whoever reads them several times doesn't compute them again."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/fathom_{name}_{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory back to the system.

    Workers outlive their tasks, and allocators keep what a task has freed; an executor
    that runs one operator after another would hold the peaks of all.
    """
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over an iterator of batches that gives its memory back at the end."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run
