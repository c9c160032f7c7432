"""Near-duplicate vectors by an exact metric range join.

Vectors link when their cosine is at least ``cosine``, that is, when their unit vectors are at most
r = sqrt(2 - 2 * cosine) apart. Pivots partition the unit vectors: each is at home with its nearest pivot. By
the triangle inequality a vector can have a partner at home with another pivot only if it is within r of the
plane between the two pivots and within r of that cell's shell (the least and largest distance of its
residents to the pivot); there it is a visitor. So every partner of a resident is a resident or a visitor of
its cell, cells join independently, and each vector's links are counted once, in its home cell. No link is
lost and none is found twice. Large cells are cut into blocks of residents times blocks of residents and
visitors, so no task holds a cell.

Equal vectors are one class with a multiplicity and are joined once. A block returns counts and a spanning
forest of its links, never the pairs. Pivots are the mutually farthest of a sample of twice as many vectors (one
for every ``block`` vectors, at most ``most_pivots``); any pivots give the same result.

Null vectors, zero vectors and vectors with a null or non-finite component link with nothing, vectors of
different lengths never link, a null vec_id counts as a partner but names a component only if all are null,
repeated rows are partners of each other, other columns are left out, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.components import connected_components
from depotlens.session import materialize

SLACK = 1e-9


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values as doubles with NaN for null, first, end) of a list column; a null list is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    return values, offsets[:-1], np.where(there, offsets[1:], offsets[:-1])


def unit_rows(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors of a list column whose lists all have ``size`` usable components."""
    values, first, _ = list_values(column)
    rows = values[first[:, None] + np.arange(size)] if len(first) else np.zeros((0, size))
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if len(rows) else rows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) if len(rows) else rows


def keyed(vectors: DataFrame) -> DataFrame:
    """The vectors with a content key and length; both null where a vector cannot link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import md5

        for batch in batches:
            values, first, end = list_values(batch.column(1))
            keys = []
            for a, b in zip(first.tolist(), end.tolist()):
                x = values[a:b] + 0.0  # one zero
                usable = b > a and np.isfinite(x).all() and x.any()
                keys.append(md5(x.tobytes()).digest() if usable else None)
            size = pa.array((end - first).astype(np.int32))
            columns = [*batch.columns, pa.array(keys, pa.binary()), size]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "embedding", "_key", "_size"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    picked = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind))
    return picked.mapInArrow(run, f"vec_id long, embedding {kind}, _key binary, _size int")


def assign(classes: DataFrame, pivots: np.ndarray, shells: np.ndarray | None, radius: float) -> DataFrame:
    """(cell, resident, node, many, embedding): residents, and with ``shells`` given (least and largest
    distance per cell) the visitors too; without, (cell, distance) of the residents."""
    gaps = np.linalg.norm(pivots[:, None, :] - pivots[None, :, :], axis=2) if shells is not None else None
    size = pivots.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(16, (1 << 15) // len(pivots))  # a row may visit every cell
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                rows = unit_rows(batch.column(2), size)
                squared = np.maximum(0.0, 2.0 - 2.0 * rows @ pivots.T)
                home = squared.argmin(axis=1)
                own = squared[np.arange(len(rows)), home]
                if shells is None:
                    yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(np.sqrt(own))], names=["cell", "distance"])
                    continue
                # Distance to the plane between the home pivot and every other one.
                between = gaps[home]
                plane = (squared - own[:, None]) / np.where(between > 0, 2.0 * between, np.inf)
                distance = np.sqrt(squared)
                visit = (plane <= radius + SLACK) & (distance <= shells[:, 1] + radius + SLACK)
                visit &= distance >= shells[:, 0] - radius - SLACK
                visit[np.arange(len(rows)), home] = True
                row, cell = np.nonzero(visit)
                taken = pa.array(row)
                columns = [pa.array(cell), pa.array(home[row] == cell), *(batch.column(i).take(taken) for i in range(3))]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "resident", "node", "many", "embedding"])

    if shells is None:
        return classes.mapInArrow(run, "cell long, distance double")
    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.mapInArrow(run, f"cell long, resident boolean, node long, many long, embedding {kind}")


def spanning_labels(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A label per row and per column of a block of links; linked ones share the smallest label."""
    n, m = linked.shape
    row, column = np.arange(n), np.arange(n, n + m)
    while True:
        met = np.where(linked, row[:, None], n + m).min(axis=0) if n else column
        column_next = np.minimum(column, met)
        met = np.where(linked, column_next[None, :], n + m).min(axis=1) if m else row
        row_next = np.minimum(row, met)
        if (row_next == row).all() and (column_next == column).all():
            return row, column
        row, column = row_next, column_next


def _block_links(size: int, cosine: float, step: int = 256):
    def join(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, many = table.column("node").to_numpy(), table.column("many").to_numpy()
        rows = unit_rows(table.column("embedding"), size)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        found: list[tuple] = []
        for at in range(0, len(left), step):
            part = left[at : at + step]
            linked = rows[part] @ rows[right].T >= cosine
            linked &= node[part][:, None] != node[right][None, :]
            links = linked @ many[right]
            some, met = np.flatnonzero(links), np.flatnonzero(linked.any(axis=0))
            a, b = spanning_labels(linked[some][:, met])
            labels = np.concatenate([node[part][some], node[right][met]])
            root = labels[np.concatenate([a, b])]
            edge = np.flatnonzero(labels != root)
            found.append((node[part][some], links[some], np.full(len(some), -1)))
            found.append((labels[edge], np.zeros(len(edge), dtype=np.int64), root[edge]))
        none = np.zeros(0, dtype=np.int64)
        columns = [np.concatenate([none, *parts]) for parts in zip(*found)] if found else [none] * 3
        return pa.table(columns, names=["node", "links", "other"])

    return join


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` vectors of the sample, each the farthest from those before, so cells follow the data's groups."""
    chosen, near = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        near = np.minimum(near, 2.0 - 2.0 * sample @ sample[chosen[-1]])
        chosen.append(int(near.argmax()))
    return np.unique(sample[chosen], axis=0)


def range_join(classes: DataFrame, size: int, cosine: float, most_pivots: int, block: int) -> DataFrame:
    """(node, links, other): partial link counts (other is -1) and edges of a spanning forest (links is 0)."""
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * cosine))
    n = classes.count()
    count = min(most_pivots, max(1, math.ceil(n / block)))
    sample = classes.orderBy(F.xxhash64("_key")).limit(2 * count).select("embedding").toArrow()
    pivots = spread_pivots(unit_rows(sample.column(0), size), count)
    rows = classes.select("node", "many", "embedding")
    shells = np.tile([np.inf, -np.inf], (len(pivots), 1))
    found = assign(rows, pivots, None, radius).groupBy("cell").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"))
    for r in found.collect():  # one row per pivot
        shells[r["cell"]] = r["lo"], r["hi"]
    placed = materialize(assign(rows, pivots, shells, radius), "cells")
    sizes = placed.groupBy("cell").agg(F.count_if("resident").alias("residents"), F.count("*").alias("all"))
    parts = lambda c: F.ceil(F.col(c) / F.lit(block)).cast("long")
    sizes = sizes.where("residents > 0").select("cell", parts("residents").alias("n_i"), parts("all").alias("n_j"))
    placed = placed.join(F.broadcast(sizes), "cell")  # one row per pivot
    spread = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    body = ["cell", "node", "many", "embedding"]
    left = placed.where("resident").select(*body, spread("n_i", 1).alias("i"), upto("n_j").alias("j"), F.lit(0).alias("side"))
    right = placed.select(*body, spread("n_j", 2).alias("j"), upto("n_i").alias("i"), F.lit(1).alias("side"))
    both = left.unionByName(right)
    return both.groupBy("cell", "i", "j").applyInArrow(_block_links(size, cosine), "node long, links long, other long")


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = 0.9, most_pivots: int = 4096, block: int = 4096
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = materialize(keyed(vectors), "vectors")
    usable = rows.where(F.col("_key").isNotNull()).groupBy("_key", "_size")
    classes = usable.agg(F.count("*").alias("many"), F.min("vec_id").alias("first"), F.min("embedding").alias("embedding"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "node long, links long, other long")
    for r in classes.select("_size").distinct().orderBy("_size").collect():  # lengths that occur: as a rule one
        same = classes.where(F.col("_size") == r["_size"])
        found = found.unionByName(range_join(same, r["_size"], cosine, most_pivots, block))
    found = materialize(found, "vector-links")
    counts = found.where("other = -1").groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other <> -1").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    component = connected_components(edges)
    named = classes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").join(counts, "node", "left")
    total = F.coalesce("links", F.lit(0).cast("long")) + F.col("many") - 1
    named = named.select("_key", "_size", total.alias("n_links"), "component_id")
    out = rows.select("vec_id", "_key", "_size").join(named, ["_key", "_size"], "left")
    smallest = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        smallest.alias("component_id"),
        F.coalesce(F.col("vec_id") == smallest, F.isnull(smallest)).alias("kept"),
    )
