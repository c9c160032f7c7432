"""Phrase collocations per language, from mergeable Misra-Gries summaries and an exact second count.

A text is lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and pieces into words at blanks
and tabs. A candidate is a phrase of 2 to ``max_words`` words that occurs at least ``least`` times inside
pieces. Cutting it after k words gives a score a * a / (l * r) from its own count and those of its two parts;
the lowest-scoring cut counts. A candidate inside a longer one that has at least ``inside`` percent of its count is
dropped, and each language's ``top`` best remain.

1. Tasks reduce blocks of texts to distinct n-gram keys with counts and deal them by ranges of the key to hash
   partitions. A partition merges its blocks into one Misra-Gries summary. Its capacity exceeds the partition's
   mass (the n-gram occurrences in it) divided by ``least``: what all reductions together take from a counter then
   stays below ``least``, so every frequent n-gram is among the survivors. N-grams that one block or one counter
   shows ``least`` times are settled at once and need no counter, so hot ones do not use up the capacity. If a
   partition has more mass than its share, its capacity doubles instead of a reduction too many.
2. The texts are read again and survivors are counted exactly, by their words and not by keys. The survivors reach
   the tasks as a bit table of at most ``filter_bytes``; where they are too many for that, they are joined by key.

A capacity is about ``counters`` keys, so memory does not follow the input: more input makes more partitions. Keys of 64
bits that collide only let a phrase through to the exact count, where blocks tell phrases apart by key, too: n
distinct n-grams in a block collide with probability n^2 / 2^65.

Null texts count as empty, a null language is ``und``, repeated rows count as often as they occur, an empty table
gives no rows, ``doc_id`` and all other columns are not read. Scores are exact below 10^15 occurrences.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from depotlens.llm.kernels import Words, mix, ranges, text_chunks
from depotlens.session import materialize

CHUNK = 1 << 22
BITS_PER_KEY = 12


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first, joined): places of words, words before each text, and whether the next word is in the same piece."""
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[[32, 9]] = 1
    kinds[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = 2
    kind = kinds[data]
    word = np.concatenate(([False], kind == 0, [False]))
    begins, stops = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = word[1:-1][cuts]
    stops[cuts - 1] = word[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    breaks = np.concatenate(([0], np.cumsum(kind == 2)))
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = breaks[ends[:-1]] == breaks[starts[1:]]
    joined[first[1:][first[1:] > 0] - 1] = False
    return starts, ends, first, joined


class Grams:
    """Keys of all n-grams of text chunks."""

    def __init__(self, max_words: int):
        self.max_words, self.words = max_words, Words(lower=True)

    def keys(self, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray):
        """(word starts, word ends, [(places, keys) of n-grams of 1, 2, ... words]); ``salts``: one per text."""
        starts, ends, first, joined = split_pieces(data, offsets)
        hashes = self.words.hashes(data, starts, ends)
        salt = np.repeat(salts, np.diff(first))
        found, at = [], np.arange(len(starts))
        for n in range(1, self.max_words + 1):
            found.append((at, mix(self.words.windows(hashes, at, n) ^ salt[at])))
            at = at[joined[at + n - 1]]
        return starts, ends, found


def tally(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[fresh], np.add.reduceat(counts[order], fresh) if len(keys) else counts


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition of a key: partitions are ranges of keys, so sorted keys have sorted partitions."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


class Summary:
    """A Misra-Gries summary that blocks are merged into.

    A key's count lies between its counter and its counter plus ``lost``. Keys whose counter reaches ``least``
    are settled: they leave the counters, and later occurrences are not summed any more.
    """

    def __init__(self, least: int, capacity: int):
        self.least, self.capacity, self.lost = least, capacity, 0
        self.keys = self.settled = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, settled: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge a block in; blocks are taken together until they are about as many as the counters."""
        self.waiting.append((settled, keys, counts))
        self.held += len(settled) + len(keys)
        if self.held > self.capacity:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        settled, keys, counts = (list(c) for c in zip(*self.waiting))
        self.waiting, self.held = [], 0
        keys, counts = tally(np.concatenate([self.keys, *keys]), np.concatenate([self.counts, *counts]))
        enough = counts >= self.least
        self.settled = np.unique(np.concatenate([self.settled, *settled, keys[enough]]))
        rest = ~among(keys, self.settled)
        self.keys, self.counts = keys[rest], counts[rest]
        while len(self.keys) > self.capacity:
            over = len(self.keys) - self.capacity - 1
            take = int(np.partition(self.counts, over)[over])
            if self.lost + take >= self.least:
                self.capacity *= 2  # more mass than planned: a further reduction could lose a frequent key
                continue
            self.lost += take
            stay = self.counts > take
            self.keys, self.counts = self.keys[stay], self.counts[stay] - take

    def survivors(self) -> np.ndarray:
        """All keys that may have occurred ``least`` times, in order."""
        self.merge()
        return np.sort(np.concatenate([self.settled, self.keys[self.counts + self.lost >= self.least]]))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [split_pieces(data, offsets)[2] for _, data, offsets in text_chunks(batch.column(2), CHUNK)]
            sizes = np.concatenate([np.zeros(0, dtype=np.int64), *(np.diff(c) for c in counts)])
            table = pa.table({"lang": batch.column(0), "n": sizes}).group_by("lang").aggregate([("n", "sum")])
            yield from table.select(["lang", "n_sum"]).rename_columns(["lang", "n"]).to_batches()

    return texts.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def survivors(texts: DataFrame, max_words: int, least: int, parts: int, capacity: int, block: int = 1 << 22) -> DataFrame:
    """(part, keys): the sorted keys of all n-grams that may be frequent, one row per hash partition."""
    small = "<u1" if least <= 256 else "<u4"  # counts in a block that are not settled are below ``least``
    names = ["part", "settled", "keys", "counts"]

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held, size = Grams(max_words), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.sort(np.concatenate(held))
            held.clear()
            fresh = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            counts = np.diff(np.append(fresh, len(keys)))
            keys = keys[fresh]
            enough = counts >= least
            sure, keys, counts = keys[enough], keys[~enough], counts[~enough].astype(small)
            edges = [np.searchsorted(part_of(k, parts), np.arange(parts + 1)).tolist() for k in (sure, keys)]
            some = [p for p in range(parts) if any(e[p] < e[p + 1] for e in edges)]
            cut = lambda values, e, p: values[e[p] : e[p + 1]].tobytes()
            for at in range(0, len(some), 256):
                rows = some[at : at + 256]
                columns = [
                    pa.array(rows, pa.int32()),
                    pa.array([cut(sure, edges[0], p) for p in rows], pa.binary()),
                    pa.array([cut(keys, edges[1], p) for p in rows], pa.binary()),
                    pa.array([cut(counts, edges[1], p) for p in rows], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            salts = batch.column(1).to_numpy().view(np.uint64)
            for row, data, offsets in text_chunks(batch.column(2), CHUNK):
                for _, keys in grams.keys(data, offsets, salts[row : row + len(offsets) - 1])[2]:
                    held.append(keys)
                    size += len(keys)
                if size > block:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, summary = None, None

        def close() -> pa.RecordBatch:
            keys = pa.array([summary.survivors().tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), keys], names=["part", "keys"])

        for batch in batches:
            for part, sure, keys, counts in zip(*(batch.column(i) for i in range(4))):
                if part.as_py() != current:
                    if summary:
                        yield close()
                    current, summary = part.as_py(), Summary(least, capacity)
                read = lambda value, kind: np.frombuffer(value.as_buffer(), dtype=kind)
                # Copies, so that the batch can go.
                summary.add(read(sure, "<u8").copy(), read(keys, "<u8").copy(), read(counts, small).astype(np.int64))
        if summary:
            yield close()

    blocks = texts.mapInArrow(partial, "part int, settled binary, keys binary, counts binary")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, keys binary")


class KeyFilter:
    """A bit table of keys in one stretch per hash partition; it lets all its keys pass, and few others."""

    def __init__(self, parts: int, keys: int):
        self.parts, self.width = parts, 8 * max(8, math.ceil(BITS_PER_KEY * keys / parts / 8))

    def size(self) -> int:
        """Bytes of the whole table."""
        return self.parts * self.width // 8

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        """Two places of each key in its partition's stretch."""
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
            yield (mix(keys ^ np.uint64(salt)) % np.uint64(self.width)).astype(np.int64)

    def stretch(self, keys: np.ndarray) -> bytes:
        bits = np.zeros(self.width, dtype=bool)
        for place in self.places(keys):
            bits[place] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def passes(self, table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        base, out = part_of(keys, self.parts) * self.width, np.ones(len(keys), dtype=bool)
        for place in self.places(keys):
            at = base + place
            out &= (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def gather_filter(found: DataFrame, shape: KeyFilter) -> bytes:
    """The bit table of written survivors; at most ``shape.size()`` bytes come to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, keys in zip(batch.column(0), batch.column(1)):
                bits = pa.array([shape.stretch(np.frombuffer(keys.as_buffer(), "<u8"))], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), bits], names=["part", "bits"])

    table, step = bytearray(shape.size()), shape.width // 8
    for row in found.mapInArrow(run, "part int, bits binary").toLocalIterator():
        table[row["part"] * step : (row["part"] + 1) * step] = row["bits"]
    return bytes(table)


def phrases_of(texts: DataFrame, max_words: int, shape: KeyFilter | None, bits) -> DataFrame:
    """(lang, words, phrase, key, a): the n-grams of each chunk that pass the filter (all without one), with counts."""
    names = ["lang", "words", "phrase", "key", "a"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(max_words)
        table = np.frombuffer(bits.value, dtype=np.uint8) if bits else None
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        for batch in batches:
            salts = batch.column(1).to_numpy().view(np.uint64)
            for row, data, offsets in text_chunks(batch.column(2), CHUNK):
                starts, ends, found = grams.keys(data, offsets, salts[row : row + len(offsets) - 1])
                if not len(starts):
                    continue
                # The words with one blank after each: a phrase is one stretch of them.
                size = ends - starts + 1
                begin = np.cumsum(size) - size
                line = np.full(int(size.sum()), 32, dtype=np.uint8)
                line[ranges(begin, size - 1)] = lower[data[ranges(starts, size - 1)]]
                for n, (at, keys) in enumerate(found, 1):
                    if table is not None:
                        passed = shape.passes(table, keys)
                        at, keys = at[passed], keys[passed]
                    keys, one, counts = np.unique(keys, return_index=True, return_counts=True)
                    at = at[one]
                    low, high = begin[at], begin[at + n - 1] + size[at + n - 1] - 1
                    for a in range(0, len(at), 1 << 17):
                        b = min(a + (1 << 17), len(at))
                        wide = high[a:b] - low[a:b]
                        ends_at = np.concatenate(([0], np.cumsum(wide))).astype(np.int32)
                        texts_at = line[ranges(low[a:b], wide)]
                        phrase = pa.StringArray.from_buffers(b - a, pa.py_buffer(ends_at), pa.py_buffer(texts_at))
                        doc = np.searchsorted(offsets, starts[at[a:b]], "right") - 1
                        columns = [
                            batch.column(0).take(pa.array(doc + row)),
                            pa.array(np.full(b - a, n, dtype=np.int32)),
                            phrase,
                            pa.array(keys[a:b].view(np.int64)),
                            pa.array(counts[a:b]),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.mapInArrow(run, "lang string, words int, phrase string, key long, a long")


def frequent_phrases(
    docs: DataFrame, max_words: int = 3, least: int = 10, counters: int = 1 << 19, filter_bytes: int = 1 << 26
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, a) of all n-grams that occur ``least`` times, written; and (lang, n) of all words."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("salt"), F.col("text").cast("string").alias("text"))
    totals = materialize(count_words(texts), "phrase-totals")
    mass = max_words * (totals.agg(F.sum("n")).first()[0] or 0)
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(mass / least / counters))
    # A tenth more than a partition's even share of the mass.
    capacity = max(1024, math.ceil(1.1 * mass / least / parts) + 1)
    found = materialize(survivors(texts, max_words, least, parts, capacity), "phrase-survivors")
    many = found.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    shape = KeyFilter(parts, int(many))
    if shape.size() <= filter_bytes:
        bits = spark.sparkContext.broadcast(gather_filter(found, shape))
        seen = phrases_of(texts, max_words, shape, bits)
    else:
        seen = phrases_of(texts, max_words, None, None).join(key_rows(found), "key", "left_semi")
    counted = seen.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return materialize(counted, "phrases"), totals


def key_rows(found: DataFrame) -> DataFrame:
    """One row per surviving key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys in batch.column(0):
                values = np.frombuffer(keys.as_buffer(), "<i8")
                for a in range(0, len(values), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(values[a : a + (1 << 18)])], names=["key"])

    return found.select("keys").mapInArrow(run, "key long")


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    least: int = 10,
    inside: int = 50,
    top: int = 2000,
    counters: int = 1 << 19,
    filter_bytes: int = 1 << 26,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases; the score is in millionths."""
    return rank_phrases(*frequent_phrases(docs, max_words, least, counters, filter_bytes), inside, top)


def rank_phrases(counted: DataFrame, totals: DataFrame, inside: int = 50, top: int = 2000) -> DataFrame:
    """The best phrases by the exact counts (lang, words, phrase, a) of all frequent n-grams, and the words per language."""
    phrases = counted.where("words > 1")

    # Every part of a frequent phrase is frequent, so its count is in the same table.
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    square, product = "cast(a AS decimal(15)) * cast(a AS decimal(15))", "cast(l AS decimal(18)) * cast(r AS decimal(18))"
    cuts = cuts.withColumn("score", F.expr(f"cast(1000000 AS decimal(7)) * {square} div ({product})"))
    lowest = F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")
    scored = cuts.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "cut.*")

    # The largest count of a longer phrase around each candidate.
    pieces = "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' '))))"
    longer = phrases.where("words > 2").withColumn("w", F.split("phrase", " "))
    longer = longer.select("lang", F.explode(F.expr(pieces)).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < inside * F.col("a"), F.lit(True)))

    # Ranked within shares of a language first, so no task sorts a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    best = kept.withColumn("share", share)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
