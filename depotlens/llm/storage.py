"""Giving back the space of steps that are done."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now; it does so when the driver collects garbage.

    Listeners may still hold the last step the first time.
    """
    for pause in (0.5, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def drop_written(df: DataFrame) -> None:
    """Delete the folder of a frame that ``materialize`` wrote and that no other frame reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
