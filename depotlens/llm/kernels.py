"""Array helpers that run inside tasks: words, hashes and token ids of Arrow text batches.

Words are ``[^\\x20\\x09-\\x0D]+``. Their separators are single ASCII bytes, so UTF-8 texts are cut
byte-wise and whole batches are handled with a few numpy passes. Texts are never shortened; a batch is cut
between texts, so memory follows the larger of ``limit`` and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64((STEP * (2 * seed + 1)) & MASK)) | np.uint64(1)


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            grown = []
            for base in (self.base, self.inverse):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                grown.append(np.cumprod(steps, dtype=np.uint64))
            self.up, self.down = grown
        return self.up[:n], self.down[:n]

    def sums(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sum of values[i] * base^(i - start) for start <= i < end, modulo 2^64."""
        up, _ = self.upto(len(values) + 1)
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return (total[ends] - total[starts]) * self.down[starts]


class Words:
    """Word places and hashes of text chunks; one object serves a whole task."""

    def __init__(self, lower: bool):
        self.table = seeds(256, 7)
        if lower:
            self.table[65:91] = self.table[97:123]
        self.bytes, self.runs = Powers(0xD6E8FEB86659FD93), Powers(0xA0761D6478BD642F)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash per word."""
        return mix(self.bytes.sums(self.table[data], starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit hash of the ``size`` words from each start on; the caller keeps windows inside texts."""
        return mix(self.runs.sums(hashes, starts, starts + size) ^ np.uint64(size))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of at most ``limit`` bytes; a longer text stands alone.

    A null text has no bytes. Offsets have one more entry than the run has rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:  # bytes below a null: read the texts without them
            column = column.fill_null("")
            yield from text_chunks(column, limit)
            return
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte places of all words, and the number of words before each text."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    word = ~((data == 32) | ((data - np.uint8(9)) < 5))
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = word[cuts]
    last[cuts - 1] = word[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, ... of every range, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift


#: The split pattern of the byte-level pre-tokenizer (fixed value of this family of tokenizer files).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked_encoder(path: str, vocabulary: dict[str, int]):
    """An encoder over the file's own vocabulary that gives the same ids eight times as fast, or None.

    It merges by rank, so it stands in only where the ids of the file are the ranks of its merges and nothing
    else (normalizer, other splitting, dropout) has a say.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    pairs = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    same = (
        spec["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and all(vocabulary.get(pair.replace(" ", "")) == 256 + i for i, pair in enumerate(pairs))
    )
    if not same:
        return None
    # The byte alphabet: printable bytes stand for themselves, the others follow from code point 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


class TokenIds:
    """Ids of whole texts of a byte-level BPE tokenizer file, each distinct run of text encoded once.

    The file's pre-tokenizer never joins a character with a white space that follows it, and a single space
    or line feed between two other characters starts a new piece. Texts are therefore cut there without
    changing any id; runs are looked up by hash among those met before, and only new ones are encoded. The
    memory of met runs is dropped when it holds ``most`` runs, which changes nothing but the time.
    """

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings inside a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.width = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in vocabulary.items():  # byte-level tokens are written with one character per byte
            self.width[i] = len(token)
        self.ranked = _ranked_encoder(path, vocabulary)
        self.words, self.most = Words(lower=False), most
        plain = np.zeros(256, dtype=bool)
        plain[0x21:0x7F] = True
        self.plain, self.lead = plain, plain.copy()
        self.lead[0xC3:0xE0] = True  # first bytes of two-byte characters none of which is white space
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.place = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the runs start."""
        n = len(data)
        cut = np.zeros(n, dtype=bool)
        if n > 2:
            gap = (data == 32) | (data == 10)
            before = self.plain[data[:-2]].copy()
            before[1:] |= (data[1:-2] >= 0x80) & (data[:-3] >= 0xC3) & (data[:-3] < 0xE0)
            cut[1:-1] = gap[1:-1] & before & self.lead[data[2:]]
            edge = offsets[(offsets > 0) & (offsets < n)]
            cut[edge - 1] = False  # the last byte of a text has nothing after it
            cut[edge] = False
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(cut)

    def _encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        if self.ranked:
            return [np.array(self.ranked.encode_ordinary(t), dtype=np.uint32) for t in texts]
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_runs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, edge: np.ndarray):
        """(ids of all runs, ids per run). Runs that stand between two cuts are encoded joined, in long pieces:

        each of them starts a new piece of the pre-tokenizer after any other, so the ids are the same and
        only their widths in bytes tell the runs apart. Runs at the edge of a text are encoded alone.
        """
        size = ends - starts
        raw = data.tobytes()
        alone = [raw[a:b].decode("utf-8") for a, b in zip(starts[edge].tolist(), ends[edge].tolist())]
        group = np.flatnonzero(~edge)
        stops = np.cumsum(size[group])
        joined = data[ranges(starts[group], size[group])].tobytes()
        bounds = np.unique(np.append(np.searchsorted(stops, np.arange(0, len(joined), 1 << 15), "right"), len(group)))
        marks = np.concatenate(([0], stops))[bounds].tolist() if len(group) else []
        pieces = [joined[a:b].decode("utf-8") for a, b in zip(marks, marks[1:])]
        coded = self._encode_texts(alone + pieces)
        single, inner = coded[: len(alone)], np.concatenate([np.zeros(0, np.uint32), *coded[len(alone) :]])
        place = np.searchsorted(np.cumsum(self.width[inner]), stops) + 1
        count = np.zeros(len(starts), dtype=np.int64)
        count[group] = np.diff(place, prepend=0)
        at = np.flatnonzero(edge)
        count[at] = [len(ids) for ids in single]
        flat = np.empty(int(count.sum()), dtype=np.uint32)
        before = np.cumsum(count) - count
        flat[ranges(before[group], count[group])] = inner
        flat[ranges(before[at], count[at])] = np.concatenate([np.zeros(0, np.uint32), *single])
        return flat, count

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts, and the number of ids before each text."""
        starts = self.runs(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        cut = np.isin(starts, offsets, invert=True)
        edge = ~(cut & np.append(cut[1:], False))
        keys, first, which = np.unique(self.words.hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            near = np.minimum(at, len(self.keys) - 1)
            known = self.keys[near] == keys
        if not known.all():
            if len(self.keys) + len(keys) > self.most:
                self._forget()
                known[:] = False
            new = first[~known]
            flat, count = self._encode_runs(data, starts[new], ends[new], edge[new])
            place = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, flat])
            all_keys = np.concatenate([self.keys, keys[~known]])
            order = np.argsort(all_keys, kind="stable")
            self.keys = all_keys[order]
            self.place = np.concatenate([self.place, place])[order]
            self.count = np.concatenate([self.count, count])[order]
            at = np.searchsorted(self.keys, keys)
        place, count = self.place[at][which], self.count[at][which]
        before = np.concatenate(([0], np.cumsum(count)))
        return self.ids[ranges(place, count)], before[np.searchsorted(starts, offsets)]
