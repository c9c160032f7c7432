"""Removal of word passages that occur more than once, with a count-min prefilter.

A window is ``size`` consecutive words of one document. Every word under a window whose words also start
anywhere else is removed; windows are judged on the input.

1. Each window is counted under its anchor: the leftmost smallest-hash run of ``gram`` words inside it. Equal
   windows have equal anchors, and neighbouring windows share theirs, so there are about fourteen times
   fewer anchors than windows. Tasks sketch their anchors with a two-row count-min sketch whose counters stop
   at two; the partial sketches travel as sparse cells, are merged slice by slice, and the merged one, a bit
   per cell (``2 * cells / 8`` bytes at any input size), is broadcast. It never underestimates: anchors
   estimated at one occur once, and no window under them is repeated.
2. Windows under the other anchors are grouped exactly. Consecutive windows with one anchor form a block.
   Blocks with equal words are counted first: all windows of a block that occurs twice are repeated. Only
   where one anchor has blocks with different words are windows grouped one by one, once per distinct block.

With more anchors than cells the sketch lets more through and the second pass groups more; the result is the
same. Keys are 64-bit hashes: n distinct candidate windows collide with probability n^2 / 2^65.

Null texts have no words, an empty table gives no rows, repeated rows are documents of their own (so they
remove each other), a null ``doc_id`` is no obstacle, columns named like a result are replaced, all others
are kept as they are. A text that loses words has its kept words joined by one space, any other is unchanged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.llm.kernels import Words, mix, ranges, split_words, text_chunks
from depotlens.llm.names import keeps_columns
from depotlens.session import materialize

SLICE = 1 << 20


class Anchors:
    """Blocks of windows of text chunks."""

    def __init__(self, size: int, gram: int):
        self.size, self.gram, self.words = size, gram, Words(lower=False)

    def blocks(self, data: np.ndarray, offsets: np.ndarray):
        """(word hashes, words before each text, first window, windows, anchor) of all blocks of the chunk."""
        starts, ends, first = split_words(data, offsets)
        hashes = self.words.hashes(data, starts, ends)
        none = np.zeros(0, dtype=np.int64)
        n = len(hashes) - self.size + 1
        if n <= 0:
            return hashes, first, none, none, none.astype(np.uint64)
        value = self.words.windows(hashes, np.arange(len(hashes) - self.gram + 1), self.gram)
        place = np.arange(len(value))
        reach, want = 1, self.size - self.gram + 1
        while reach < want:
            step = min(reach, want - reach)
            right = value[step:] < value[:-step]
            value = np.where(right, value[step:], value[:-step])
            place = np.where(right, place[step:], place[:-step])
            reach += step
        inside = np.zeros(n + 1, dtype=np.int64)  # windows that start where `size` words of one text are left
        begin, stop = first[:-1], first[1:] - self.size + 1
        full = stop > begin
        np.add.at(inside, begin[full], 1)
        np.add.at(inside, stop[full], -1)
        valid = np.cumsum(inside)[:n] > 0
        fresh = valid.copy()
        fresh[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        fresh[begin[full]] = True
        head = np.flatnonzero(fresh)
        last = valid.copy()
        last[:-1] &= fresh[1:] | ~valid[1:]
        return hashes, first, head, np.flatnonzero(last) + 1 - head, value[head]

    def cells(self, anchor: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        wide = np.uint64(cells)
        low = (mix(anchor ^ np.uint64(0x5851F42D4C957F2D)) % wide).astype(np.int64)
        return low, (mix(anchor ^ np.uint64(0x14057B7EF767814F)) % wide).astype(np.int64) + cells


def sketch_anchors(docs: DataFrame, size: int, gram: int, cells: int) -> bytes:
    """The merged sketch: one bit per cell, set where the cell counted two anchors or more."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, held, count = Anchors(size, gram), [], 0

        def flush() -> pa.RecordBatch:
            cell, times = np.unique(np.concatenate(held), return_counts=True)
            part = cell // SLICE
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            cell = (cell % SLICE).astype("<u4")
            once, twice = [], []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(cell)]):
                more = times[a:b] > 1
                once.append(cell[a:b][~more].tobytes())
                twice.append(cell[a:b][more].tobytes())
            columns = [pa.array(part[edges], pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "once", "twice"])

        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                anchor = anchors.blocks(data, offsets)[4]
                held.extend(anchors.cells(anchor, cells))
                count += len(anchor)
                if count > 1 << 20:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts = dense.setdefault(part, np.zeros(SLICE, dtype=np.uint8))
                once = np.frombuffer(once, dtype="<u4")
                counts[once] = np.minimum(counts[once] + 1, 2)
                counts[np.frombuffer(twice, dtype="<u4")] = 2
        for part, counts in dense.items():
            bits = np.packbits(counts > 1, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits], pa.binary())], names=["slice", "bits"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(partial, "slice int, once binary, twice binary")
    merged = parts.repartition("slice").mapInArrow(merge, "slice int, bits binary")
    bits = bytearray(2 * cells // 8)
    for row in merged.toLocalIterator():
        at = row["slice"] * (SLICE // 8)
        piece = row["bits"][: len(bits) - at]
        bits[at : at + len(piece)] = piece
    return bytes(bits)


def candidate_blocks(docs: DataFrame, bits, size: int, gram: int, cells: int) -> DataFrame:
    """The documents with their word count and the blocks whose anchor is estimated to occur twice or more."""
    names = docs.columns
    at = names.index("text")

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        anchors, sketch = Anchors(size, gram), np.frombuffer(bits.value, dtype=np.uint8)
        made = TaskContext.get().partitionId() << 40
        seen = lambda cell: (sketch[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(at)):
                hashes, first, head, windows, anchor = anchors.blocks(data, offsets)
                low, high = anchors.cells(anchor, cells)
                kept = (seen(low) & seen(high)).astype(bool)
                head, windows, anchor = head[kept], windows[kept], anchor[kept]
                keys = anchors.words.windows(hashes, ranges(head, windows), size)
                whole = mix(anchors.words.runs.sums(hashes, head, head + windows + size - 1) ^ windows.astype(np.uint64))
                rows = len(offsets) - 1
                doc = np.searchsorted(first, head, "right") - 1
                here = np.searchsorted(head, first).astype(np.int32)
                inner = np.concatenate(([0], np.cumsum(windows))).astype(np.int32)
                lists = lambda values: pa.ListArray.from_arrays(here, values)
                columns = [
                    *batch.slice(row, rows).columns,
                    pa.array(made + np.arange(rows)),
                    pa.array(np.diff(first)),
                    lists(pa.array(anchor.view(np.int64))),
                    lists(pa.array(whole.view(np.int64))),
                    lists(pa.array((head - first[doc]).astype(np.int32))),
                    lists(pa.ListArray.from_arrays(inner, pa.array(keys.view(np.int64)))),
                ]
                made += rows
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "_uid", "n_words", "_anchor", "_block", "_first", "_keys"])

    extra = T._parse_datatype_string(
        "_uid long, n_words long, _anchor array<long>, _block array<long>, _first array<int>, _keys array<array<long>>"
    )
    return docs.mapInArrow(find, T.StructType([*docs.schema.fields, *extra.fields]))


def repeated_spans(table: DataFrame) -> DataFrame:
    """(uid, first, last window) of runs of windows that are repeated, from a written table of candidate blocks."""
    zipped = F.explode(F.arrays_zip("_anchor", "_block", "_first", F.transform("_keys", lambda k: F.size(k)).alias("_n")))
    blocks = table.where(F.size("_anchor") > 0).select("_uid", zipped.alias("b")).select("_uid", "b.*")
    one = F.min(F.struct("_uid", "_first")).alias("one")
    kinds = materialize(blocks.groupBy("_anchor", "_block").agg(F.count("*").alias("times"), one), "blocks")

    # Blocks that occur twice or more: all their windows are repeated.
    often = kinds.where("times > 1").select("_anchor", "_block")
    whole = blocks.join(often, ["_anchor", "_block"]).select("_uid", "_first", (F.col("_first") + F.col("_n") - 1).alias("_last"))

    # Anchors with different blocks: group the windows of one block of each kind.
    mixed = kinds.groupBy("_anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("_anchor")
    chosen = kinds.join(mixed, "_anchor", "left_semi").select("one.*", F.least("times", F.lit(2)).alias("times"))
    both = F.explode(F.arrays_zip("_first", "_keys"))
    keyed = table.where(F.size("_anchor") > 0).select("_uid", both.alias("b")).select("_uid", "b.*")
    windows = keyed.join(chosen, ["_uid", "_first"]).select("_uid", "_first", "times", F.posexplode("_keys").alias("i", "key"))
    windows = materialize(windows, "windows")
    again = windows.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    start = (F.col("_first") + F.col("i")).alias("_first")
    single = windows.where("times = 1").join(again, "key", "left_semi").select("_uid", start, start.alias("_last"))
    return whole.unionByName(single)


@keeps_columns(("text",), ("n_words", "n_removed"))
def remove_repeats(docs: DataFrame, size: int = 35, gram: int = 8, cells: int = 1 << 26) -> DataFrame:
    """The documents without their repeated passages, with ``n_words`` before and ``n_removed``."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    names = docs.columns
    context = docs.sparkSession.sparkContext
    bits = context.broadcast(sketch_anchors(docs, size, gram, cells))
    table = materialize(candidate_blocks(docs, bits, size, gram, cells), "candidates")
    spans = repeated_spans(table).groupBy("_uid").agg(F.collect_list(F.struct("_first", "_last")).alias("_spans"))
    at = names.index("text")

    def drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = batch.column(len(names) + 1)
            for row, data, offsets in text_chunks(batch.column(at)):
                starts, ends, first = split_words(data, offsets)
                rows = len(offsets) - 1
                part = marked.slice(row, rows)
                count = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
                flat = part.flatten()
                low = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
                high = flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64)
                base = np.repeat(first[:-1], count)
                edge = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(edge, base + low, 1)
                np.add.at(edge, base + high + size, -1)
                gone = np.cumsum(edge)[:-1] > 0
                removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[first])
                raw = data.tobytes()
                texts = batch.column(at).slice(row, rows).to_pylist()
                for d in np.flatnonzero(removed).tolist():
                    a, b = first[d], first[d + 1]
                    kept = np.flatnonzero(~gone[a:b]) + a
                    texts[d] = b" ".join([raw[x:y] for x, y in zip(starts[kept].tolist(), ends[kept].tolist())]).decode("utf-8")
                columns = [*batch.slice(row, rows).columns[: len(names) + 1], pa.array(removed)]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "n_removed"])

    out = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    some = F.size("_anchor") > 0
    touched = table.where(some).join(spans, "_uid", "left").select(*names, "n_words", "_spans")
    clean = table.where(~some).select(*names, "n_words", F.lit(0).cast("long").alias("n_removed"))
    return clean.unionByName(touched.mapInArrow(drop, out))
