"""Language-model scores by Katz backoff: bigrams back off to unigrams, unigrams to one unknown word.

Counts are discounted by Good-Turing: a count r up to ``largest`` is worth r* = (r + 1) n[r+1] / n[r] (n: counts
of counts over the whole training part), and all larger counts share the factor that the rest of the estimate
leaves them, 1 - (largest + 1) n[largest+1] / (their total). So seen words lose exactly the mass that
Good-Turing gives to unseen ones; where an estimate is no proper discount (small tables), half a count is
taken off instead. The lost mass of a history goes to the words not seen after it, in proportion to their
unigram probabilities, by its backoff weight

    alpha(h) = (1 - sum of p*(w | h) over seen w) / (1 - sum of p(w) over the same w),

which normalises p(. | h) exactly over the training words, the end token and the unknown word; an unseen
history backs off with weight 1.

Tables. Bigrams are dealt to cells by a range of their second word's hash. The texts are read twice. First, tasks
count the distinct bigrams of blocks of training documents, and the counts of a cell are added up into a stored
table, which has the counts of counts. Then, the discounts being known, blocks of all documents are exchanged by cell
with the documents each bigram stands in; now the bigrams of very frequent words are dealt by history. A task gets a
cell's counts first and streams the blocks past them: seen bigrams and unigram terms are evaluated there, unseen
bigrams of held-out documents in a further exchange by history, where the table's histories come first with their
backoff weights and the bigrams are streamed past them. So a task holds the counts of one cell and one block's part
of it, never all places of a word or bigram. Nothing but the counts of counts (a dozen numbers) and the frequent words
(fewer than half as many as there are cells) reaches the driver.

``buckets``, the number of cells, should grow with the input; it defaults to a multiple of the shuffle partitions.
Words are known by 64-bit hashes, histories by 48 bits of them (histories that collide share a distribution).

Null and empty texts are an end token alone, a null ``doc_id`` is trained on as if it were an empty id,
repeated rows count as often as they occur, an empty table gives no rows, other columns are left out. Without
any training document every token is unknown and has probability 1 / (1 + words), words being 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm.kernels import Words, split_words, text_chunks
from depotlens.llm.storage import drop_written, release_shuffles
from depotlens.session import materialize

END, START = np.uint64(0x27220A95FE1D83D1), np.uint64(0x9FB21C651E98DF25)
SHORT = np.uint64((1 << 48) - 1)
LARGEST = 5
#: Rows in a row group of the stored table, and in a batch that the fit gets of it.
GROUP_ROWS = 1
#: Distinct bigrams in a row of the stored table, and bytes in a batch of rows that are parts of cells.
PIECE, BATCH_BYTES = 1 << 18, 4 << 20
#: In place of a block's number: counts of the cell.
COUNTS = -1


# -- blocks of documents --------------------------------------------------------------------------


def _six(values: np.ndarray) -> bytes:
    """48-bit numbers as six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


NO_WORDS = np.zeros(0, dtype=np.uint64)


@dataclass
class Cells:
    """How bigrams are dealt: by a range of the word's hash, or of the history's if the word is ``frequent`` (sorted)."""

    number: int
    frequent: np.ndarray = field(default_factory=lambda: NO_WORDS)

    def of(self, w: np.ndarray, h: np.ndarray) -> np.ndarray:
        high = w >> np.uint64(32)
        if len(self.frequent):
            near = np.minimum(np.searchsorted(self.frequent, w), len(self.frequent) - 1)
            high = np.where(self.frequent[near] == w, h >> np.uint64(16), high)
        return (high * np.uint64(self.number) >> np.uint64(32)).astype(np.uint16 if self.number <= 1 << 16 else np.uint32)


BLOCK = "cell long, block long, words binary, spread binary, hists binary, shared binary, docs binary, times binary"


def count_blocks(docs: DataFrame, cells: Cells) -> DataFrame:
    """Rows of (cell, block): words; histories per word; histories; counts per bigram."""
    return _blocks(docs, cells, 3 << 19, 1 << 15, False).select("cell", "words", "spread", "hists", "times")


def exchange_blocks(docs: DataFrame, cells: Cells, tokens: int = 3 << 19, most_docs: int = 1 << 15) -> DataFrame:
    """Rows of (cell, block): words; histories per word; histories; documents per bigram; documents; counts.

    A document is its number in the block, doubled, plus one if it is held out. Rows of a cell of their own (-1 -
    block) carry what is per document: id, held out, tokens.
    """
    return _blocks(docs, cells, tokens, most_docs, True)


def _blocks(docs: DataFrame, cells: Cells, tokens: int, most_docs: int, places: bool) -> DataFrame:
    schema = BLOCK + ", ids array<long>, held array<boolean>, sizes array<long>"
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = Words(lower=True)
        block = TaskContext.get().partitionId() << 32
        parts: list[tuple] = []
        ids, held, sizes, count = [], [], [], 0

        def rows(kinds: dict) -> pa.RecordBatch:
            n = len(kinds["cell"])
            columns = [pa.array(kinds.get(f.name, [None] * n), f.type) for f in arrow]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            w, h, d = (np.concatenate(c) for c in zip(*parts))
            parts.clear()
            cell = cells.of(w, h)
            order = np.lexsort((h, w, cell))  # stable: the documents stay in order
            cell = cell[order]
            w = w[order]
            h = h[order]
            d = d[order]
            del order
            triple = _runs(cell, w, h, d)
            times = np.diff(np.append(triple, len(w))).astype("<u4")
            cell, w, h, d = cell[triple], w[triple], h[triple], d[triple].astype("<u2")
            entry = _runs(cell, w, h)
            shared = np.diff(np.append(entry, len(w))).astype("<u2")
            hists, ew, cell = h[entry], w[entry], cell[entry]
            word = _runs(cell, ew)
            spread = np.diff(np.append(word, len(ew))).astype("<u4")
            unique, cell = ew[word], cell[word]
            first = _runs(cell)
            edges = np.append(first, len(unique))
            entries = np.append(word, len(ew))[edges]
            triples = np.append(entry, len(w))[entries]
            if not places:
                times, triples = np.add.reduceat(times, entry, dtype=np.int64), entries
            for at in range(0, len(first), 64):
                part = range(at, min(at + 64, len(first)))
                cut = lambda values, e, size: [values[e[i] : e[i + 1]].astype(size).tobytes() for i in part]
                made = {
                    "cell": [int(cell[first[i]]) for i in part],
                    "block": [block] * len(part),
                    "words": cut(unique, edges, "<u8"),
                    "spread": cut(spread, edges, "<u4"),
                    "hists": [_six(hists[entries[i] : entries[i + 1]]) for i in part],
                    "times": cut(times, triples, "<u4" if places else "<u8"),
                }
                yield rows(made | {"shared": cut(shared, entries, "<u2"), "docs": cut(d, triples, "<u2")} if places else made)
            if places:
                yield rows({"cell": [-1 - block], "block": [block], "ids": [ids], "held": [held], "sizes": [sizes]})

        arrow = pa.schema(
            [("cell", pa.int64()), ("block", pa.int64()), *((n, pa.binary()) for n in names[2:8])]
            + [("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))]
        )
        for batch in batches:
            for row, data, offsets in text_chunks(batch.column(2)):
                n = len(offsets) - 1
                if parts and (count + len(data) // 4 > tokens or len(ids) + n > most_docs):
                    yield from flush()
                    block += 1
                    parts, ids, held, sizes, count = [], [], [], [], 0
                # More rows than document numbers: empty texts. They are cut into several parts.
                for a in range(0, n, most_docs):
                    b = min(a + most_docs, n)
                    if len(ids) + b - a > most_docs:
                        yield from flush()
                        block += 1
                        parts, ids, held, sizes, count = [], [], [], [], 0
                    piece, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                    starts, ends, first = split_words(piece, at)
                    size = np.diff(first) + 1
                    stop = np.cumsum(size) - 1
                    w = np.full(int(size.sum()), END)
                    inner = np.ones(len(w), dtype=bool)
                    inner[stop] = False
                    w[inner] = words.hashes(piece, starts, ends)
                    h = np.empty_like(w)
                    h[1:] = w[:-1]
                    h[stop + 1 - size] = START
                    out = batch.column(1).slice(row + a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                    code = (len(ids) + np.arange(b - a)) * 2 + out
                    parts.append((w, h & SHORT, np.repeat(code.astype(np.uint16), size)))
                    ids.extend(batch.column(0).slice(row + a, b - a).to_pylist())
                    held.extend(out.astype(bool).tolist())
                    sizes.extend(size.tolist())
                    count += len(w)
        if parts:
            yield from flush()
        # The worker serves other tasks after this one.
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


# -- counts ---------------------------------------------------------------------------------------


def _added(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys, sorted by the first, the second, ..., with their counts added up."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = _runs(*keys)
    return [k[first] for k in keys], np.add.reduceat(counts[order], first) if len(first) else counts


def _bigrams(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    words = np.repeat(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["spread"], "<u4"))
    return [words, _from_six(row["hists"])], np.frombuffer(row["times"], "<u8").astype(np.int64)


class Sum:
    """Counts by key that are added up as they come, so that it holds twice the distinct keys and a piece at most."""

    def __init__(self) -> None:
        self.parts: list[tuple[list[np.ndarray], np.ndarray]] = []
        self.size, self.limit = 0, 4 * PIECE

    def add(self, keys: list[np.ndarray], counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(counts)
        if self.size > self.limit:
            self.limit = max(4 * PIECE, 2 * len(self.result()[1]))

    def result(self) -> tuple[list[np.ndarray], np.ndarray]:
        if len(self.parts) != 1:
            keys = [np.concatenate(k) for k in zip(*(k for k, _ in self.parts))]
            self.parts = [_added(keys, np.concatenate([c for _, c in self.parts]))]
            self.size = len(self.parts[0][1])
        return self.parts[0]


TABLE = "cell long, continued int, words binary, totals binary, spread binary, hists binary, times binary"


def add_counts(counted: DataFrame, piece: int = PIECE) -> DataFrame:
    """The stored table: a cell's bigrams with their counts, in rows of a piece each, and the counts of their words.

    ``continued`` is 1 if a row's first word has bigrams in the row before, too, 0 otherwise.
    """
    names = [part.split()[0] for part in TABLE.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(cell: int, total: Sum) -> Iterator[pa.RecordBatch]:
            (words, hists), counts = total.result()
            start = _runs(words)
            of_word = np.add.reduceat(counts, start)
            for a in range(0, len(counts), piece):
                b = min(a + piece, len(counts))
                first, last = np.searchsorted(start, a, "right") - 1, np.searchsorted(start, b)
                edges = np.append(np.maximum(start[first:last], a), b)
                data = (
                    words[start[first:last]].astype("<u8").tobytes(),
                    of_word[first:last].astype("<u8").tobytes(),
                    np.diff(edges).astype("<u4").tobytes(),
                    _six(hists[a:b]),
                    counts[a:b].astype("<u8").tobytes(),
                )
                fields = [pa.array([cell], pa.int64()), pa.array([int(start[first] < a)], pa.int32()), *(pa.array([x], pa.binary()) for x in data)]
                yield pa.RecordBatch.from_arrays(fields, names=names)

        cell, total = None, Sum()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if cell is not None and row["cell"] != cell:
                    yield from pieces(cell, total)
                    total = Sum()
                cell = row["cell"]
                total.add(*_bigrams(row))
        if cell is not None:
            yield from pieces(cell, total)
        pa.default_memory_pool().release_unused()

    return counted.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, TABLE)


def frequent_words(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The words, sorted, that occur more than ``most`` times, and their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for continued, words, totals in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words, totals = (np.frombuffer(x, "<i8")[continued:] for x in (words, totals))
                at = totals > most
                yield pa.RecordBatch.from_arrays([pa.array(words[at]), pa.array(totals[at])], names=["word", "total"])

    found = table.select("continued", "words", "totals").mapInArrow(run, "word long, total long").collect()
    words, totals = (np.array([r[i] for r in found], dtype=np.int64) for i in range(2))
    order = np.argsort(words.view(np.uint64))
    return words.view(np.uint64)[order], totals[order]


def deal_counts(table: DataFrame, cells: Cells) -> DataFrame:
    """The rows of the table, those of bigrams that end in frequent words dealt to cells by history."""
    names = [part.split()[0] for part in TABLE.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                row = own.to_pylist()[0]
                of = np.frombuffer(row["words"], "<u8")
                if not np.isin(of, cells.frequent).any():
                    yield own
                    continue
                (words, hists), counts = _bigrams(row)
                spread = np.frombuffer(row["spread"], "<u4")
                totals = np.repeat(np.frombuffer(row["totals"], "<u8"), spread)
                begins = np.ones(len(of), dtype=bool)
                begins[: row["continued"]] = False
                begins = np.repeat(begins, spread)
                cell = cells.of(words, hists)
                order = np.argsort(cell, kind="stable")
                edge = _runs(cell[order])
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
                    at = order[a:b]
                    word = _runs(words[at])
                    data = (
                        words[at][word].tobytes(),
                        totals[at][word].tobytes(),
                        np.diff(np.append(word, len(at))).astype("<u4").tobytes(),
                        _six(hists[at]),
                        counts[at].astype("<u8").tobytes(),
                    )
                    fields = [pa.array([int(cell[at[0]])], pa.int64()), pa.array([int(not begins[at[0]])], pa.int32())]
                    yield pa.RecordBatch.from_arrays([*fields, *(pa.array([x], pa.binary()) for x in data)], names=names)

    return table.select(*names).mapInArrow(run, TABLE)


# -- discounts ------------------------------------------------------------------------------------


def discounts(ranks: list[int], tail_kinds: int, tail_total: int) -> list[float]:
    """Factors of the counts 1 to LARGEST and of all larger ones; ``ranks`` are the counts of counts 1 to LARGEST + 1."""
    factors = []
    for r in range(1, LARGEST + 1):
        better = (r + 1) * ranks[r] / (r * ranks[r - 1]) if ranks[r - 1] else 1.0
        factors.append(better if 0 < better < 1 else (r - 0.5) / r)
    rest = 1 - (LARGEST + 1) * ranks[LARGEST] / tail_total if tail_total else 0.5
    factors.append(rest if 0 < rest < 1 else 1 - 0.5 * tail_kinds / tail_total)
    return factors


@dataclass
class Model:
    """What a cell has to know of the whole training part."""

    tokens: int
    words: int
    documents: int
    unigram: list[float]
    bigram: list[float]
    unknown: float

    def weight(self, count: np.ndarray, factors: list[float]) -> np.ndarray:
        """Discounted counts; 0 stays 0."""
        table = np.array([0.0, *factors])
        return table[np.minimum(count, LARGEST + 1)] * count


def fit(table: DataFrame) -> Model:
    """The model's global figures: one reading of the table, a few numbers per task."""
    width = 2 * (LARGEST + 3) + 3

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for continued, words, totals, times in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words, total = np.frombuffer(words, "<u8")[continued:], np.frombuffer(totals, "<i8")[continued:]
                at = 0
                for count in (total, np.frombuffer(times, "<i8")):
                    ranks = np.bincount(np.minimum(count, LARGEST + 2), minlength=LARGEST + 3)
                    sums[at : at + LARGEST + 1] += ranks[1 : LARGEST + 2]
                    large = count[count > LARGEST]
                    sums[at + LARGEST + 1] += len(large)
                    sums[at + LARGEST + 2] += large.sum()
                    at += LARGEST + 3
                sums[at:] += (total.sum(), len(total), total[words == END].sum())
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["sums"])

    parts = table.select("continued", "words", "totals", "times").mapInArrow(run, "sums array<long>")
    row = parts.agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    sums = [int(v or 0) for v in row]
    half = LARGEST + 3
    one, two = sums[:half], sums[half : 2 * half]
    tokens, words, ends = sums[2 * half :]
    unigram = discounts(one[: LARGEST + 1], one[-2], one[-1])
    bigram = discounts(two[: LARGEST + 1], two[-2], two[-1])
    kept = sum(f * r * n for r, (f, n) in enumerate(zip(unigram, one), 1) if r <= LARGEST) + unigram[-1] * one[-1]
    unknown = 1 - kept / tokens if tokens else 1.0
    return Model(tokens, words, ends, unigram, bigram, unknown)


# -- evaluation -----------------------------------------------------------------------------------


class Cell:
    """The counts of a cell: words, sorted, and its bigrams, sorted by word and history."""

    def __init__(self, words: list[tuple[np.ndarray, np.ndarray]], bigrams: Sum):
        self.words, self.total = (np.concatenate(c) for c in zip(*words))
        order = np.argsort(self.words)
        self.words, self.total = self.words[order], self.total[order]
        (of, self.hists), self.seen = bigrams.result() if bigrams.parts else ([NO_WORDS] * 2, np.zeros(0, dtype=np.int64))
        #: Per word: where its bigrams begin and end.
        self.begin, self.end = np.searchsorted(of, self.words), np.searchsorted(of, self.words, "right")

    def words_at(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word: its count and the range of its bigrams; nothing for other words."""
        if not len(self.words):
            return (np.zeros(len(words), dtype=np.int64),) * 3
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        there = self.words[at] == words
        return tuple(np.where(there, v[at], 0) for v in (self.total, self.begin, self.end))

    def seen_at(self, begin: np.ndarray, end: np.ndarray, hists: np.ndarray) -> np.ndarray:
        """Per bigram: its count, by binary search for its history among the bigrams of its word."""
        if not len(self.hists):
            return np.zeros(len(hists), dtype=np.int64)
        low, high = begin.copy(), end.copy()
        for _ in range(int((end - begin).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            less = (low < high) & (self.hists[np.minimum(middle, len(self.hists) - 1)] < hists)
            high = np.where(less, high, middle)
            low = np.where(less, middle + 1, low)
        at = np.minimum(low, len(self.hists) - 1)
        return np.where((low < end) & (self.hists[at] == hists), self.seen[at], 0)


@dataclass
class Later:
    """Columns that are to be settled by history; kept until they are many."""

    kind: int
    types: tuple[str, ...]
    parts: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    size: int = 0

    def add(self, hist: np.ndarray, *columns: np.ndarray) -> bool:
        if len(hist):
            self.parts.append((hist, *(c.astype(t) for c, t in zip(columns, self.types))))
            self.size += len(hist)
        return self.size > 2 * PIECE

    def rows(self, parts: int) -> Iterator[list]:
        if self.parts:
            hist, *columns = (np.concatenate(c) for c in zip(*self.parts))
            self.parts, self.size = [], 0
            for part, at in _by_part(hist, parts):
                yield _sums_row(self.kind, part, _six(hist[at]), *(c[at].tobytes() for c in columns))


class PerDocument:
    """Figures of documents by block, added up over what a task reads."""

    def __init__(self, figures: int):
        self.figures, self.blocks = figures, {}

    def add(self, block: int, doc: np.ndarray, *figures: np.ndarray) -> None:
        size = int(doc.max()) + 1
        kept = self.blocks.setdefault(block, np.zeros((self.figures + 1, size)))
        if size > kept.shape[1]:
            kept = self.blocks[block] = np.pad(kept, ((0, 0), (0, size - kept.shape[1])))
        kept[0, :size] += np.bincount(doc, minlength=size)
        for at, values in enumerate(figures, 1):
            kept[at, :size] += np.bincount(doc, weights=values, minlength=size)

    def nbytes(self) -> int:
        return sum(v.nbytes for v in self.blocks.values())

    def take(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(block, documents, their figures), which are forgotten."""
        while self.blocks:
            block, kept = self.blocks.popitem()
            doc = np.flatnonzero(kept[0])
            yield block, doc.astype("<u2"), kept[1:, doc]


def _sums_row(kind: int, key: int, *data: bytes) -> list:
    return [kind, key, *data, *[None] * (4 - len(data))]


SUMS = "kind int, key long, a binary, b binary, c binary, d binary, ids array<long>, held array<boolean>, sizes array<long>"


def evaluate(rows: DataFrame, model: Model, frequent: tuple[np.ndarray, np.ndarray], parts: int, most: int = 1 << 25) -> DataFrame:
    """Sums per document and what is to be settled by history, of the counts and blocks of all cells.

    kind 0: key block, per document: tokens known, base, and score without backoff weights.
    kind 2: key part, per unseen bigram of a document whose history may be known.
    kind 3: key block, what is per document.
    """
    names = [part.split()[0] for part in SUMS.split(", ")]
    log = lambda x: np.log10(np.where(x > 0, x, 1.0))

    def settle(cell: Cell, row: dict, documents: PerDocument, unseen: Later) -> bool:
        read = lambda name, kind: np.frombuffer(row[name], kind)
        spread, hists, shared = read("spread", "<u4"), _from_six(row["hists"]), read("shared", "<u2")
        doc, times = read("docs", "<u2") >> 1, read("times", "<u4")
        total, begin, end = cell.words_at(read("words", "<u8"))
        seen = cell.seen_at(np.repeat(begin, spread), np.repeat(end, spread), hists)
        p_word = model.weight(total, model.unigram) / max(1, model.tokens)
        log_word = np.where(total > 0, log(p_word), math.log10(model.unknown))
        base = np.log10((total + 1) / (model.tokens + model.words + 1))
        # A seen bigram is worth its discounted count over the history's count; each token's history is the
        # word before, so the latter is taken off where that word stands, here.
        follows = np.where((total > 0) & (read("words", "<u8") != END), log(total.astype(float)), 0.0)
        direct = np.where(seen > 0, log(model.weight(seen, model.bigram)), np.repeat(log_word, spread))
        figures = np.repeat((total > 0).astype(float), spread), np.repeat(base, spread), direct - np.repeat(follows, spread)
        documents.add(row["block"], doc, *(np.repeat(f, shared) * times for f in figures))
        at = np.flatnonzero(np.repeat(seen == 0, shared))
        return unseen.add(np.repeat(hists, shared)[at], np.full(len(at), row["block"]), doc[at], times[at])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())
        kinds = pa.int32(), pa.int64(), *[pa.binary()] * 4, *lists
        documents, unseen = PerDocument(3), Later(2, ("<i8", "<u2", "<u4"))

        def made(rows: list[list]) -> pa.RecordBatch:
            rows = [r + [None] * (len(kinds) - len(r)) for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        def sums_so_far() -> Iterator[pa.RecordBatch]:
            for block, doc, (known, base, score) in documents.take():
                yield made([_sums_row(0, block, *(x.tobytes() for x in (doc, known.astype("<u4"), base, score)))])

        def settle_unseen() -> Iterator[pa.RecordBatch]:
            found = list(unseen.rows(parts))
            if found:
                yield made(found)

        number, words, bigrams, cell = None, [frequent], Sum(), None
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                if own.column("ids").null_count == 0:
                    none = [pa.nulls(1, pa.binary())] * 4
                    yield pa.RecordBatch.from_arrays([pa.array([3], pa.int32()), own.column("block"), *none, *(own.column(n) for n in names[6:])], names=names)
                    continue
                row = own.to_pylist()[0]
                if row["cell"] != number:
                    # The counts of a cell come before its blocks.
                    number, words, bigrams, cell = row["cell"], [frequent], Sum(), None
                if row["block"] == COUNTS:
                    of, total = (np.frombuffer(row[n], kind)[row["continued"] :] for n, kind in (("words", "<u8"), ("totals", "<i8")))
                    other = ~np.isin(of, frequent[0])
                    words.append((of[other], total[other]))
                    bigrams.add(*_bigrams(row))
                else:
                    if cell is None:
                        cell, words, bigrams = Cell(words, bigrams), [], None
                    if settle(cell, row, documents, unseen):
                        yield from settle_unseen()
                    if documents.nbytes() > most:
                        yield from sums_so_far()
        yield from settle_unseen()
        yield from sums_so_far()
        pa.default_memory_pool().release_unused()

    return rows.repartition("cell").sortWithinPartitions("cell", "block").mapInArrow(run, SUMS)


def histories(table: DataFrame, model: Model, parts: int) -> DataFrame:
    """kind 1: key part, per history: what its seen words lose of it, and their unigram probability."""
    names, schema = ["kind", "key", "a", "b", "c", "d"], "kind int, key long, a binary, b binary, c binary, d binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.int32(), pa.int64(), *[pa.binary()] * 4
        lost = Later(1, ("<f8", "<f8"))

        def settle() -> Iterator[pa.RecordBatch]:
            found = list(lost.rows(parts))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                hist, seen = _from_six(row["hists"]), np.frombuffer(row["times"], "<i8")
                p_word = model.weight(np.frombuffer(row["totals"], "<i8"), model.unigram) / max(1, model.tokens)
                order = np.argsort(hist, kind="stable")
                first = _runs(hist[order])
                add = lambda values: np.add.reduceat(values[order], first)
                mass = add(np.repeat(p_word, np.frombuffer(row["spread"], "<u4")))
                if lost.add(hist[order][first], add(seen - model.weight(seen, model.bigram)), mass):
                    yield from settle()
        yield from settle()
        pa.default_memory_pool().release_unused()

    return table.select("totals", "spread", "hists", "times").mapInArrow(run, schema)


def _by_part(hist: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    part = (hist % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edge = _runs(part[order]) if len(part) else np.zeros(0, dtype=np.int64)
    for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(part)]):
        yield int(part[order[a]]), order[a:b]


def back_off(sums: DataFrame, most: int = 1 << 25) -> DataFrame:
    """Per block and document: the logarithms of the backoff weights of its unseen bigrams."""

    def weights(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        hist = np.concatenate([_from_six(r["a"]) for r in rows])
        order = np.argsort(hist, kind="stable")
        hist = hist[order]
        first = _runs(hist)
        lost, mass = (np.add.reduceat(np.concatenate([np.frombuffer(r[c], "<f8") for r in rows])[order], first) for c in "bc")
        # alpha(h) * count(h): the histories' counts were taken off every token before.
        return hist[first], np.log10(lost) - np.log10(1 - mass)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = PerDocument(1)

        def sums_so_far() -> Iterator[pa.RecordBatch]:
            for block, doc, (value,) in documents.take():
                fields = [pa.array([block], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in (doc, value))]
                yield pa.RecordBatch.from_arrays(fields, names=["key", "a", "d"])

        key, one, alpha = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["key"] != key:
                    # The histories of a part come before its bigrams.
                    key, one, alpha = row["key"], [], None
                if row["kind"] == 1:
                    one.append(row)
                    continue
                if alpha is None:
                    hist, alpha = weights(one) if one else (np.zeros(1, dtype=np.uint64), np.zeros(1))
                    one = []
                want = _from_six(row["a"])
                near = np.minimum(np.searchsorted(hist, want), len(hist) - 1)
                value = np.where(hist[near] == want, alpha[near], 0.0) * np.frombuffer(row["d"], "<u4")
                block, doc = np.frombuffer(row["b"], "<i8"), np.frombuffer(row["c"], "<u2")
                order = np.argsort(block, kind="stable")
                edge = _runs(block[order])
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(block)]):
                    at = order[a:b]
                    documents.add(int(block[at[0]]), doc[at], value[at])
                if documents.nbytes() > most:
                    yield from sums_so_far()
        yield from sums_so_far()
        pa.default_memory_pool().release_unused()

    chosen = sums.where("kind in (1, 2)").select("kind", "key", "a", "b", "c", "d")
    return chosen.repartition("key").sortWithinPartitions("key", "kind").mapInArrow(run, "key long, a binary, d binary")


def collect_documents(sums: DataFrame, backoff: DataFrame, model: Model) -> DataFrame:
    """One row per document of every block: its parts are added up."""
    none = F.lit(None).cast("binary")
    direct = sums.where("kind = 0").select("key", "a", "b", "c", "d")
    later = backoff.select("key", "a", none.alias("b"), none.alias("c"), "d")
    parts = direct.unionByName(later).withColumns({n: F.lit(None).cast(k) for n, k in (("ids", "array<long>"), ("held", "array<boolean>"), ("sizes", "array<long>"))})
    known = sums.where("kind = 3").select("key", *(none.alias(c) for c in "abcd"), "ids", "held", "sizes")
    start = math.log10(model.documents) if model.documents else 0.0
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        own = next(r for r in rows if r["ids"] is not None)
        n = len(own["ids"])
        known, base, score = np.zeros(n, dtype=np.int64), np.zeros(n), np.full(n, -start)
        for r in rows:
            if r["a"] is not None:
                doc = np.frombuffer(r["a"], "<u2")
                score[doc] += np.frombuffer(r["d"], "<f8")
                if r["b"] is not None:
                    known[doc] += np.frombuffer(r["b"], "<u4")
                    base[doc] += np.frombuffer(r["c"], "<f8")
        return pa.table(
            {
                "doc_id": pa.array(own["ids"], pa.int64()),
                "held_out": pa.array(own["held"], pa.bool_()),
                "n_tokens": pa.array(own["sizes"], pa.int64()),
                "n_known": known,
                "train_tokens": np.full(n, model.tokens),
                "base_score": base,
                "score": score,
            }
        )

    return parts.unionByName(known).groupBy("key").applyInArrow(add, schema)


@contextmanager
def batches_of(spark: SparkSession, **limits: int) -> Iterator[None]:
    """Inside the block a task gets the rows it maps in batches of at most so many records or bytes."""
    names = {f"spark.sql.execution.arrow.{name}": limit for name, limit in limits.items()}
    before = {name: spark.conf.get(name) for name in names}
    for name, limit in names.items():
        spark.conf.set(name, limit)
    try:
        yield
    finally:
        for name, limit in before.items():
            spark.conf.set(name, limit)


def score_documents(docs: DataFrame, held_out, buckets: int | None = None, keep_table: bool = False) -> DataFrame:
    """Scores of all documents by the model of those for which the condition ``held_out`` is false.

    The table of n-grams is deleted once all tokens are evaluated, unless ``keep_table`` is set.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); logarithms to base 10.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 2 * partitions
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col("text").cast("string"))
    # Writers and readers hold a row group, which is to be a piece and not a whole file.
    few = {"parquet.block.row.count.limit": GROUP_ROWS}
    with batches_of(spark, maxBytesPerBatch=BATCH_BYTES):
        table = materialize(add_counts(count_blocks(rows.where("not held"), Cells(buckets))), "ngram-table", **few)
        with batches_of(spark, maxRecordsPerBatch=GROUP_ROWS):
            model = fit(table)
        frequent = frequent_words(table, 2 * model.tokens // buckets)
        release_shuffles(spark)
        cells = Cells(buckets, frequent[0])
        counts = deal_counts(table, cells).withColumn("block", F.lit(COUNTS).cast("long"))
        blocks = exchange_blocks(rows, cells).unionByName(counts, allowMissingColumns=True)
        sums = materialize(evaluate(blocks, model, frequent, partitions), "ngram-sums")
        release_shuffles(spark)
        unseen = sums.where("kind = 2").select("kind", "key", "a", "b", "c", "d")
        backoff = materialize(back_off(histories(table, model, partitions).unionByName(unseen)), "ngram-backoff")
    if not keep_table:
        drop_written(table)
    release_shuffles(spark)
    return collect_documents(sums, backoff, model)
