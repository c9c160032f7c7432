"""What the regressors of this library share: rows in blocks, exact sums over them, and models that can be stored.

Rows that are equal are one row with a weight, and a row's block follows from its values. So the blocks, and with
them every sum, are the same however the input was partitioned; a value that a third of the rows share is one row.
Blocks are written once and kept as an RDD of arrays: fitting runs hundreds of small jobs over them, and planning
a query for each would cost more than the job. A lost executor's blocks are read again from the written table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.session import materialize

Block = tuple[np.ndarray, np.ndarray, np.ndarray]  # features by row, labels, weights


def training_blocks(rows: DataFrame, features: str, label: str, block_rows: int = 1 << 14) -> RDD:
    """The rows as blocks of about ``block_rows`` distinct rows, each in the order of a hash of its rows."""
    given = rows.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    weighed = given.groupBy("x", "y").agg(F.count("*").alias("w"))
    weighed = materialize(weighed.withColumn("h", F.xxhash64("x", "y")), "training-rows")
    count = max(1, math.ceil(weighed.count() / block_rows))
    names = ["x", "y", "w"]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            columns = [np.concatenate(c).astype("<f8").tobytes() for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=names)

        current = None
        for batch in batches:
            block = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and block[a] != current:
                    yield close()
                    held.clear()
                current, part = block[a], batch.slice(a, b - a)
                held.append((part.column(1).flatten().to_numpy(), part.column(2).to_numpy(), part.column(3).to_numpy()))
        if held:
            yield close()

    dealt = weighed.withColumn("block", F.pmod("h", F.lit(count)))
    dealt = dealt.repartition("block").sortWithinPartitions("block", "h", "x", "y").select("block", "x", "y", "w")
    blocks = materialize(dealt.mapInArrow(pack, "x binary, y binary, w binary"), "training-blocks")

    def read(row) -> Block:
        y, w = (np.frombuffer(bytes(row[n]), "<f8") for n in ("y", "w"))
        return np.frombuffer(bytes(row["x"]), "<f8").reshape(len(y), -1), y, w

    return blocks.rdd.map(read).persist(StorageLevel.MEMORY_AND_DISK)


class SpreadRows:
    """Blocks over many partitions: every sum is a job. Many partitions add up in a tree."""

    def __init__(self, blocks: RDD, few: int = 32):
        self.blocks, self.few = blocks, few

    def reduce(self, part: Callable[[Any], np.ndarray], combine: Callable = np.add) -> np.ndarray:
        def inside(held: Iterable) -> Iterator[np.ndarray]:
            parts = [part(block) for block in held]
            if parts:
                yield reduce(combine, parts)

        parts = self.blocks.mapPartitions(inside)
        if self.blocks.getNumPartitions() <= self.few:
            return reduce(combine, parts.collect())
        return parts.treeReduce(combine)

    def map(self, change: Callable[[Any], Any]) -> SpreadRows:
        """The changed blocks, kept until they are dropped; a lost one is made again from where these come from."""
        return SpreadRows(self.blocks.map(change).persist(StorageLevel.MEMORY_AND_DISK), self.few)

    def drop(self) -> None:
        self.blocks.unpersist()


class HeldRows:
    """The blocks of a single partition, inside its task: the same sums without a job for each."""

    def __init__(self, blocks: list):
        self.blocks = blocks

    def reduce(self, part: Callable[[Any], np.ndarray], combine: Callable = np.add) -> np.ndarray:
        return reduce(combine, [part(block) for block in self.blocks])

    def map(self, change: Callable[[Any], Any]) -> HeldRows:
        return HeldRows([change(block) for block in self.blocks])

    def drop(self) -> None:
        self.blocks = []


Rows = SpreadRows | HeldRows


def run_on(blocks: RDD, work: Callable[[Rows], Any], most_blocks: int = 16) -> Any:
    """``work`` over the rows: inside one task where they are few blocks, else with a job for every sum."""
    many = blocks.count()
    if many <= most_blocks:
        return blocks.coalesce(1).mapPartitions(lambda held: [work(HeldRows(list(held)))]).collect()[0]
    parts = min(many, 2 * blocks.context.defaultParallelism)
    if blocks.getNumPartitions() >= parts:
        return work(SpreadRows(blocks))
    dealt = SpreadRows(blocks.repartition(parts)).map(lambda block: block)
    try:
        return work(dealt)
    finally:
        dealt.drop()


class ArrayModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """A fitted model that predicts from an array of features; ``values`` are plain lists and numbers."""

    def __init__(self, values: dict | None = None, features: str = "features", prediction: str = "prediction"):
        super().__init__()
        self.values = values or {}
        self._set(featuresCol=features, predictionCol=prediction)

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        predict_rows = self.predict_rows

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd

            return pd.Series(predict_rows(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(F.col(self.getFeaturesCol()))))

    def __getstate__(self):  # tasks need the numbers only
        return {"values": self.values}

    def write(self) -> MLWriter:
        return _ArrayModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ArrayModelReader(cls)


class _ArrayModelWriter(MLWriter):
    def __init__(self, model: ArrayModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"values": self.model.values})


class _ArrayModelReader(MLReader):
    def __init__(self, cls: type[ArrayModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ArrayModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(metadata["values"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
