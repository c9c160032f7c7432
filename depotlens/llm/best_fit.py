"""Best-fit packing of token sequences, improved by exchanging documents between underfull sequences.

Documents are encoded whole and closed with an end id. One that is longer than the capacity is cut into pieces of the
capacity, of which all but the last fill a sequence alone; every other document stays in one piece.

1. The pieces are dealt into random groups of about ``group_size``. A group is packed best-fit decreasing: longest
   first, into the sequence with the least room that is enough.
2. Local search within the group: the least filled sequence gives tokens to other underfull ones, by moving a
   piece, by exchanging one for one, two for one, or one for two. Each step is the exchange that fills its
   receiver by most tokens, and has to increase the sum of squared fills; steps go on until the
   sequence is empty or no exchange helps, then the next one gives. Pairs are formed among the ``PAIRED`` longest
   pieces of a sequence; one for two is tried with the ``PAIRED`` roomiest sequences. A group makes at most
   ``effort`` exchanges and changes of the giver; the packing is complete after each.
3. Sequences that are still filled below ``carry`` are opened, and their pieces of all groups are dealt and packed
   again, level by level, until they fit one group or a level opens more than half of its pieces. So the few
   underfull sequences per group do not add up over many groups.

Groups are small and equal by construction, whatever one key or source holds. Null texts count as empty (such a
document is its end id alone), repeated rows are packed once per row, a null ``doc_id`` stays null, an empty table
gives no rows, and other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlens.llm.kernels import Words, ranges, split_words, text_chunks
from depotlens.session import materialize

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, doc_tokens long, piece_id long"
PAIRED = 48
#: What the pre-tokenizer keeps of a text (fixed value of this family of tokenizer files); white space is in no piece.
KEPT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds:
    """Ids of whole texts by a tokenizer whose pieces hold no white space, each distinct run of text encoded once.

    Texts are cut at white space, and words of plain ASCII letters, digits and signs also where the tokenizer cuts them:
    between kinds, and around every digit. New runs are encoded many at a time with blanks between them, and a token's
    place in that text tells its run. The memory of met runs is dropped when it holds ``most`` runs, which changes nothing
    but the time. A file of another kind encodes whole texts.
    """

    def __init__(self, path: str, most: int = 600_000):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings inside a text are ordinary text
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.cuts = split.get("pattern") == {"Regex": KEPT} and split.get("invert") and split.get("behavior") == "Removed"
        lower = any(n.get("type") == "Lowercase" for n in (spec["normalizer"] or {}).get("normalizers", []))
        self.words, self.most = Words(lower=bool(self.cuts and lower)), most
        # Kinds of bytes: 1 letter, 2 digit, 3 sign; words with an apostrophe or beyond ASCII (4) are left whole.
        self.kind = np.full(256, 3, dtype=np.uint8)
        self.kind[[*range(65, 91), *range(97, 123)]] = 1
        self.kind[48:58] = 2
        self.kind[39] = 4
        self.kind[128:] = 4
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.place, self.count = (np.zeros(0, dtype=np.int64) for _ in range(2))
        self.ids = np.zeros(0, dtype=np.uint32)

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the runs start and end."""
        if not self.cuts:
            some = np.diff(offsets) > 0
            return offsets[:-1][some], offsets[1:][some]
        starts, ends, _ = split_words(data, offsets)
        kind = self.kind[data]
        odd = np.concatenate(([0], np.cumsum(kind == 4)))
        plain = odd[starts] == odd[ends]
        inside = np.zeros(len(data) + 1, dtype=np.int8)  # bytes of plain words behind their first
        inside[starts[plain] + 1] += 1
        inside[ends[plain]] -= 1
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (np.cumsum(inside[:-1], dtype=np.int8)[1:] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
        begin, end = cut.copy(), np.append(cut, False)
        begin[starts] = True
        end[ends] = True
        return np.flatnonzero(begin), np.flatnonzero(end)

    def _encode_runs(self, texts: list[str], together: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs, ids per run)."""
        sizes = np.array([len(t) for t in texts])
        places = np.cumsum(sizes + 1)
        flat, counts = [np.zeros(0, dtype=np.uint32)], []
        edges = np.unique(np.append(np.searchsorted(places, np.arange(0, places[-1], together)), len(texts))).tolist()
        for a, b in zip(edges, edges[1:]):
            coded = self.tokenizer.encode(" ".join(texts[a:b]), add_special_tokens=False)
            at = np.fromiter((o[0] for o in coded.offsets), dtype=np.int64, count=len(coded.ids))
            run = np.searchsorted(places[a:b] - places[a] + sizes[a] + 1, at, "right")
            flat.append(np.array(coded.ids, dtype=np.uint32))
            counts.append(np.bincount(run, minlength=b - a))
        return np.concatenate(flat), np.concatenate(counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts, and the number of ids before each text."""
        starts, ends = self.runs(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        keys, first, which = np.unique(self.words.hashes(data, starts, ends), return_index=True, return_inverse=True)
        known = self._known(keys)
        if not known.all():
            if len(self.keys) + len(keys) > self.most:
                self._forget()
                known[:] = False
            new, raw = first[~known], data.tobytes()
            texts = [raw[a:b].decode("utf-8") for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            if self.cuts:
                flat, count = self._encode_runs(texts)
            else:
                coded = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.uint32) for t in texts]
                flat, count = np.concatenate(coded), np.array([len(ids) for ids in coded], dtype=np.int64)
            merged = np.concatenate([self.keys, keys[~known]])
            order = np.argsort(merged, kind="stable")
            self.place = np.concatenate([self.place, len(self.ids) + np.cumsum(count) - count])[order]
            self.count = np.concatenate([self.count, count])[order]
            self.keys, self.ids = merged[order], np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)[which]
        place, count = self.place[at], self.count[at]
        before = np.concatenate(([0], np.cumsum(count)))
        return self.ids[ranges(place, count)], before[np.searchsorted(starts, offsets)]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 1) -> DataFrame:
    """The pieces of all documents. ``piece_id`` is unique within one evaluation; write the frame before using it twice."""
    names = [field.split()[0] for field in PIECE.split(", ")]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        encoder = WordIds(tokenizer)
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(1)):
                ids, first = encoder.encode(data, offsets)
                size = np.diff(first) + 1
                begin = np.concatenate(([0], np.cumsum(size)))
                closed = np.full(begin[-1], end_id, dtype="<u4")
                closed[ranges(begin[:-1], size - 1)] = ids
                parts = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), parts)
                piece = ranges(np.zeros(len(size), dtype=np.int64), parts)
                length = np.minimum(size[doc] - piece * capacity, capacity)
                at = begin[doc] + piece * capacity
                view = memoryview(closed.view(np.uint8))
                columns = [
                    batch.column(0).take(pa.array(doc + row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(piece * capacity),
                    pa.array(length),
                    pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())], pa.int64()),
                    pa.array(size[doc]),
                    pa.array(made + np.arange(len(doc))),
                ]
                made += len(doc)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE)


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The sequence of each size; sizes come longest first and none exceeds the capacity."""
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened, chosen = 0, 0, []  # bit r of ``rooms``: a sequence with room r is open
    for size in sizes:
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            taken = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms ^= 1 << room
        else:
            room, taken = capacity, opened
            opened += 1
        if room > size:
            open_by_room[room - size].append(taken)
            rooms |= 1 << room - size
        chosen.append(taken)
    return chosen


def _pairs(members: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, one, other) of all pairs of the longest members."""
    members = members[np.argsort(-sizes[members], kind="stable")[:PAIRED]]
    one, other = np.triu_indices(len(members), 1)
    return sizes[members[one]] + sizes[members[other]], members[one], members[other]


def _best(offers: np.ndarray, wanted: np.ndarray, room: np.ndarray) -> tuple[int, int, int]:
    """(gain, offer, receiver): the largest offer[i] - wanted[j] that fits room[j]; a gain of 0 is none."""
    if not len(offers) or not len(wanted):
        return 0, -1, -1
    order = np.argsort(offers, kind="stable")
    at = np.searchsorted(offers[order], wanted + room, "right") - 1
    gain = np.where(at >= 0, offers[order[np.maximum(at, 0)]] - wanted, 0)
    j = int(gain.argmax())
    return max(0, int(gain[j])), int(order[max(at[j], 0)]), j


def exchange(sizes: np.ndarray, bin_of: np.ndarray, capacity: int, effort: int = 2000) -> np.ndarray:
    """The sequence of each piece after the local search; every step increases the sum of squared fills."""
    bin_of = bin_of.copy()
    fill = np.bincount(bin_of, weights=sizes).astype(np.int64)
    fewest = -(-int(sizes.sum()) // capacity)
    tried = np.zeros(len(fill), dtype=bool)
    while effort:
        under = (fill > 0) & (fill < capacity)
        givers = np.flatnonzero(under & ~tried)
        in_use = int((fill > 0).sum())
        # With as few sequences as can be, one more giver brings all the room together.
        if not len(givers) or (in_use == fewest and tried.any()):
            break
        giver = int(givers[fill[givers].argmin()])
        tried[giver] = True
        effort -= 1
        while effort and fill[giver]:
            under[giver] = False
            bins = np.flatnonzero(under)
            room = capacity - fill
            own = np.flatnonzero(bin_of == giver)
            theirs = np.flatnonzero(under[bin_of])
            wanted, their_room = sizes[theirs], room[bin_of[theirs]]
            sums, one, other = _pairs(own, sizes)
            tries = []
            gain, i, j = _best(sizes[own], np.zeros(len(bins), dtype=np.int64), room[bins])
            if gain:
                tries.append((gain, [own[i]], [], bins[j]))
            gain, i, j = _best(sizes[own], wanted, their_room)
            if gain:
                tries.append((gain, [own[i]], [theirs[j]], bin_of[theirs[j]]))
            gain, i, j = _best(sums, wanted, their_room)
            if gain:
                tries.append((gain, [one[i], other[i]], [theirs[j]], bin_of[theirs[j]]))
            if not tries:  # one piece for two: the pairs of all receivers are only made where nothing else helps
                several = bins[np.bincount(bin_of[theirs], minlength=len(fill))[bins] > 1]
                for b in several[np.argsort(-room[several], kind="stable")][:PAIRED].tolist():
                    sums, one, other = _pairs(np.flatnonzero(bin_of == b), sizes)
                    gain, i, j = _best(sizes[own], sums, np.full(len(sums), room[b]))
                    if gain:
                        tries.append((gain, [own[i]], [one[j], other[j]], b))
                        break
            # A receiver may be less filled than the giver: the sum of squares has to grow all the same.
            tries = [t for t in tries if fill[t[3]] + t[0] > fill[giver]]
            if not tries:
                break
            gain, give, take, receiver = max(tries, key=lambda t: t[0])
            bin_of[give] = receiver
            bin_of[take] = giver
            fill[receiver] += gain
            fill[giver] -= gain
            under[receiver] = fill[receiver] < capacity
            effort -= 1
    return bin_of


def pack(
    pieces: DataFrame, capacity: int = 4096, group_size: int = 8192, carry: float = 0.97, effort: int = 2000, seed: int = 0
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` is a written frame with ``piece_id`` and ``length``."""
    added = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "_fill")]
    out = T.StructType([*pieces.schema.fields, *added])
    whole = pieces.where(F.col("length") == capacity)
    done = whole.withColumns({"sequence_id": -1 - F.col("piece_id"), "offset": F.lit(0).cast("long")})

    def place(level: int):
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by([("length", "descending"), ("piece_id", "ascending")])
            sizes = table.column("length").to_numpy()
            first = np.array(best_fit_decreasing(sizes.tolist(), capacity), dtype=np.int64)
            bin_of = exchange(sizes, first, capacity, effort)
            order = np.argsort(bin_of, kind="stable")
            before = np.cumsum(sizes[order]) - sizes[order]
            fresh = np.concatenate(([True], np.diff(bin_of[order]) > 0))
            offset = np.empty(len(sizes), dtype=np.int64)
            offset[order] = before - np.repeat(before[fresh], np.diff(np.append(np.flatnonzero(fresh), len(sizes))))
            fill = np.bincount(bin_of, weights=sizes).astype(np.int64)[bin_of]
            # Levels stay below 2^6, groups below 2^32 and a group's sequences below 2^24; whole pieces use negative numbers.
            group = (level << 56) + (table.column("_group")[0].as_py() << 24)
            made = [("sequence_id", group + bin_of), ("offset", offset), ("_fill", fill)]
            table = table.drop_columns("_group")
            for name, values in made:
                table = table.append_column(name, pa.array(values))
            return table

        return run

    todo, n = pieces.where(F.col("length") < capacity), None
    for level in range(64):
        n = todo.count() if n is None else n
        groups = max(1, math.ceil(n / group_size))
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("piece_id", F.lit(seed + level)), F.lit(groups)))
        packed = dealt.groupBy("_group").applyInArrow(place(level), out)
        if groups == 1:
            return done.unionByName(packed.drop("_fill"))
        packed = materialize(packed, f"packed-{level}")
        low = F.col("_fill") < carry * capacity
        rest = packed.where(low).count()
        if rest > n / 2:
            break
        done = done.unionByName(packed.where(~low).drop("_fill"))
        todo, n = packed.where(low).select(*pieces.columns), rest
    return done.unionByName(packed.drop("_fill"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, seed: int = 0) -> DataFrame:
    """Encode, cut and pack; the pieces are written once between the two halves."""
    pieces = materialize(cut_documents(docs, tokenizer, capacity, end_id), "best-fit-pieces")
    return pack(pieces, capacity, seed=seed).drop("piece_id")
