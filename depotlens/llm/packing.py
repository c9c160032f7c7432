"""Packing of token sequences: first-fit decreasing with a tournament tree, in randomised groups.

Documents are encoded whole, closed with an end id and cut at multiples of the capacity, so every piece but
a document's last fills a sequence alone. The last pieces are dealt into random groups of about
``group_size`` pieces, and each group is packed by itself: longest piece first, into the first open sequence
with room, which a tournament tree over the sequences' free room finds in logarithmic time. Groups are small
and equal by construction, whatever one key or source holds.

Null texts count as empty (a document is then its end id alone), repeated rows are packed once per row, a
null ``doc_id`` stays null, an empty table gives no rows, and other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.llm.kernels import TokenIds, ranges, text_chunks
from depotlens.session import materialize

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece_id long"


def cut_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, keep_ids: bool = False
) -> DataFrame:
    """The pieces of all documents: place, length, checksum and, if asked for, the ids themselves.

    ``piece_id`` is unique within one evaluation; write the frame before using it twice.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        encoder = TokenIds(tokenizer)
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids = batch.column(0)
            for row, data, offsets in text_chunks(batch.column(1)):
                ids, first = encoder.encode(data, offsets)
                size = np.diff(first) + 1
                begin = np.concatenate(([0], np.cumsum(size)))
                full = np.empty(begin[-1], dtype="<u4")
                full[begin[1:] - 1] = end_id
                full[ranges(begin[:-1], size - 1)] = ids
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), pieces)
                start = ranges(np.zeros(len(size), dtype=np.int64), pieces) * capacity
                length = np.minimum(size[doc] - start, capacity)
                at = begin[doc] + start
                view = memoryview(full.view(np.uint8))
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                columns = [
                    doc_ids.take(pa.array(doc + row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(size[doc]),
                    pa.array(made + np.arange(len(doc))),
                ]
                names = [field.split()[0] for field in PIECE.split(", ")]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(at, begin[-1]).astype(np.int32), full.astype(np.int32)))
                    names.append("ids")
                made += len(doc)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECE + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


class Tournament:
    """Free room of the open sequences; the inner nodes hold the most room below them."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Take ``size`` from the first sequence with room for it; (its number, its room before)."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = room[node]
        room[node] = before - size
        chosen = node - self.leaves
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
        return chosen, before


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each size, given longest first; no size exceeds the capacity."""
    tree = Tournament(len(sizes), capacity)
    placed = [tree.place(size) for size in sizes]
    return [(chosen, capacity - before) for chosen, before in placed]


def pack(pieces: DataFrame, capacity: int = 2048, group_size: int = 8192, seed: int = 0) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` is a written frame with ``piece_id`` and ``length``."""
    partial = pieces.where(F.col("length") < capacity)
    groups = max(1, math.ceil(partial.count() / group_size))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("piece_id", "ascending")])
        placed = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        # Group numbers stay below 2^30 and a group's sequences below 2^32; whole pieces use negative numbers.
        base = table.column("_group")[0].as_py() << 32
        chosen = pa.array([base + p[0] for p in placed], pa.int64())
        offset = pa.array([p[1] for p in placed], pa.int64())
        return table.drop_columns("_group").append_column("sequence_id", chosen).append_column("offset", offset)

    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    dealt = partial.withColumn("_group", F.pmod(F.xxhash64("piece_id", F.lit(seed)), F.lit(groups)))
    packed = dealt.groupBy("_group").applyInArrow(place, out)
    whole = pieces.where(F.col("length") == capacity)
    whole = whole.withColumns({"sequence_id": -1 - F.col("piece_id"), "offset": F.lit(0).cast("long")})
    return whole.unionByName(packed)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ids in order, at most the capacity each, and where each document starts."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("documents"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, seed: int = 0) -> DataFrame:
    """Encode, cut and pack; the pieces are written once between the two halves."""
    pieces = materialize(cut_documents(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, seed=seed).drop("piece_id")
