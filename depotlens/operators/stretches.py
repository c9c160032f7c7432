"""The stock replay of long series, cut into stretches that are replayed side by side.

What a stretch of days does to a stock is a function: from the stock before it, 1 up to the refill level, to the stock
behind it and the number of refills on the way. It is a table of one entry per level, and such functions can be put
one behind another, so the stock before every stretch follows from the tables alone, without its days:

1. Rows are sorted by series and day over range partitions, which cut a long series, and cut again after ``most_rows``.
2. Each stretch makes its table. From a refill on the future is the same, whatever came before; so the outcome of a
   refill on each day is worked out from the last day back, and a level's outcome is that of the first refill it meets,
   which a binary search over the running demand finds.
3. A series' tables, a few numbers per level and stretch, are put one behind another.
4. Each stretch is replayed from the stock before it.

The result is that of ``panel.replay_balance`` for one opening stock and refill level. The demand may not be negative.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.session import materialize


def stretch_table(demand: np.ndarray, refill: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(stock behind the stretch, refills in it) for every stock 1 .. ``levels`` before it."""
    total = np.cumsum(demand)
    n, whole = len(demand), int(total[-1]) if len(demand) else 0
    before = np.concatenate(([0], total)).astype(np.int64)
    # Day of the next refill if the stock was filled up just before day i.
    following = np.searchsorted(total, before + refill, "left").tolist()
    stock, refills = [refill] * (n + 1), [0] * (n + 1)
    left = (refill - (whole - before)).tolist()
    for i in range(n - 1, -1, -1):
        at = following[i]
        if at < n:
            stock[i], refills[i] = stock[at + 1], refills[at + 1] + 1
        else:
            stock[i] = left[i]
    start = np.arange(1, levels + 1)
    first = np.searchsorted(total, start, "left")
    met = first < n
    behind = np.minimum(first + 1, n)
    return np.where(met, np.array(stock)[behind], start - whole), np.where(met, np.array(refills)[behind] + 1, 0)


def compose(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The table of stretch ``one`` followed by stretch ``other``."""
    at = one[0] - 1
    return other[0][at], one[1] + other[1][at]


def replay_stretches(
    df: DataFrame, keys: Sequence[str], order_by: str, demand: str, opening: int, refill: int, most_rows: int = 100_000
) -> DataFrame:
    """The rows with ``stock_on_hand`` and ``restocked``; a series may lie in any number of tasks."""
    if opening <= 0 or refill <= 0:
        raise ValueError("the opening stock and the refill level have to be above zero")
    keys, levels = list(keys), max(opening, refill)
    given = df.columns

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, rows, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            series = batch.column(len(given)).to_numpy()
            out = np.empty(len(series), dtype=np.int64)
            edges = [0, *(np.flatnonzero(np.diff(series)) + 1).tolist(), len(series)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if series[a] != last:
                    number, rows, last = number + 1, 0, series[a]
                place = rows + np.arange(b - a)
                out[a:b] = number + place // most_rows
                number, rows = int(out[b - 1]), int(place[-1]) % most_rows + 1
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(given)], pa.array(out)], names=[*given, "_stretch"])

    ordered = df.withColumn("_series", F.xxhash64(*keys)).repartitionByRange(*keys, order_by).sortWithinPartitions(*keys, order_by)
    schema = T.StructType([*df.schema.fields, T.StructField("_stretch", T.LongType())])
    # A stretch's number grows along its series, so it orders the tables.
    rows = materialize(ordered.mapInArrow(cut, schema), "stretches")
    fields = [df.schema[k] for k in keys]
    lists = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("_stock", "_refills")]

    def tables(group: pa.Table) -> pa.Table:
        group = group.sort_by(order_by)
        stock, refills = stretch_table(group.column("_demand").to_numpy(), refill, levels)
        one = group.select([*keys, "_stretch"]).slice(0, 1)
        return one.append_column("_stock", pa.array([stock])).append_column("_refills", pa.array([refills]))

    def starts(group: pa.Table) -> pa.Table:
        group = group.sort_by("_stretch")
        stock, found = opening, []
        for table in group.column("_stock"):
            found.append(stock)
            stock = table[stock - 1].as_py()
        return group.select([*keys, "_stretch"]).append_column("_before", pa.array(found, pa.int64()))

    def replay(group: pa.Table) -> pa.Table:
        group = group.sort_by(order_by)
        stock, levels_out, events = group.column("_before")[0].as_py(), [], []
        for taken in group.column("_demand").to_pylist():
            stock -= taken
            event = stock <= 0
            stock = refill if event else stock
            levels_out.append(stock)
            events.append(event)
        group = group.select(given).append_column("stock_on_hand", pa.array(levels_out, pa.int64()))
        return group.append_column("restocked", pa.array(events, pa.bool_()))

    taken = rows.withColumn("_demand", F.col(demand).cast("bigint"))
    stretch = T.StructField("_stretch", T.LongType())
    made = taken.select(*dict.fromkeys([*keys, order_by]), "_stretch", "_demand").groupBy(*keys, "_stretch")
    made = made.applyInArrow(tables, T.StructType([*fields, stretch, *lists]))
    begun = made.groupBy(*keys).applyInArrow(starts, T.StructType([*fields, stretch, T.StructField("_before", T.LongType())]))
    known = taken.join(begun, [*keys, "_stretch"]).groupBy(*keys, "_stretch")
    added = [T.StructField("stock_on_hand", T.LongType()), T.StructField("restocked", T.BooleanType())]
    return known.applyInArrow(replay, T.StructType([*df.schema.fields, *added]))
