"""Intermediate tables that survive the loss of executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripworks.sources import hadoop

SETTING = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared folder the cluster names.

    Only a local session, whose one process sees all its files, may go without that setting; its
    folder is removed when the process ends.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None)
    if root:
        return f"{root.rstrip('/')}/tripworks-{context.applicationId}"
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="tripworks-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[context.applicationId] = folder
    return _local_roots[context.applicationId]


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Executions started in here drop their shuffle files when they end, not when the driver next collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def materialise(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once and read it back: later uses share one computation, and lineage ends here."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def materialise_parts(df: DataFrame, by: str, label: str) -> DataFrame:
    """Like ``materialise``, in a folder per value of ``by``, so that a filter on it reads those folders only."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.repartition(by).write.partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove what ``materialise`` wrote for these frames. Whatever else reads them is void from then on."""
    for df in frames:
        root = scratch_root(df.sparkSession)
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if not re.sub("^file:/+", "/", path).startswith(re.sub("^file:/+", "/", root)):
                raise ValueError(f"not a scratch table: {path}")
            hadoop.delete_folder(df.sparkSession, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables this application has materialised. Frames that read them are void from then on."""
    hadoop.delete_folder(spark, scratch_root(spark))
