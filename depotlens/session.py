"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_RECORDED: ContextVar[list[str] | None] = ContextVar("recorded_scratch", default=None)


def build_session(app_name: str = "depotlens", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; on a cluster the master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only where none is named."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="depotlens-checkpoint-")
    context.setCheckpointDir(local)
    return local


def materialize(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write a frame that several consumers read to the shared checkpoint folder and read it back.

    ``options`` are those of the Parquet writer.

    Unlike a cache it survives the loss of executors, and unlike an RDD checkpoint its readers keep
    column pruning, filter pushdown and known sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared checkpoint folder; noted where scratch is recorded."""
    path = f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"
    recorded = _RECORDED.get()
    if recorded is not None:
        recorded.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The scratch paths given out inside the block, for ``drop_paths`` once nothing reads them any more."""
    paths: list[str] = []
    token = _RECORDED.set(paths)
    try:
        yield paths
    finally:
        _RECORDED.reset(token)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/depotlens-{spark.sparkContext.applicationId}"


def drop_materialized(spark: SparkSession) -> None:
    """Remove what this application materialized; frames that still read it must be finished."""
    drop_paths(spark, [_scratch(spark)])
