import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depotlens.llm import best_fit, kernels, queries
from depotlens.session import materialize

PATH = queries.tokenizer_path("word_bpe_49k.json")
CAPACITY = 4096


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def held(rows, capacity):
    """The sequences by id; each is gapless from 0 and within the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_ids_are_those_of_the_tokenizer(tokenizer, texts):
    import pyarrow as pa

    odd = ["Å B", "x ́y", "İstanbul ΣΑΣ a", " a b　c", "it's 'S 12ab", "  lead", "trail \n", "\x1c a\x85b", "a!\x1c!b", "don't 'tis !'s rock'n'roll", "x1y22z_A-B", "Ünï-12.5%'s", "\u0301 \u0301a"]
    encoder = best_fit.WordIds(PATH, most=40)
    assert encoder.cuts
    whole = best_fit.WordIds(PATH)
    whole.cuts = False
    given = texts + odd
    for coder in (encoder, whole):
        for row, data, offsets in kernels.text_chunks(pa.array(given), 600):
            ids, first = coder.encode(data, offsets)
            for i in range(len(offsets) - 1):
                assert [*ids[first[i] : first[i + 1]].tolist(), 1] == ids_of(tokenizer, given[row + i])


def test_query(spark, sf_dir, tokenizer):
    rows = queries.op12_best_fit_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids = np.array(ids_of(tokenizer, texts[doc_id]), dtype="<u4")
        parts.sort(key=lambda r: r["piece"])
        assert len(parts) == -(-len(ids) // CAPACITY)
        for i, r in enumerate(parts):
            want = ids[i * CAPACITY : (i + 1) * CAPACITY]
            assert (r["piece"], r["start"], r["length"]) == (i, i * CAPACITY, len(want))
            assert r["ids_crc32"] == zlib.crc32(want.tobytes())
    # No packing needs fewer sequences than the tokens fill.
    assert len(held(rows, CAPACITY)) == -(-sum(r["length"] for r in rows) // CAPACITY)


def test_best_fit_equals_plain_search():
    sizes = sorted((int(x) for x in np.random.default_rng(1).integers(1, 100, 300)), reverse=True)
    rooms = []
    for size, chosen in zip(sizes, best_fit.best_fit_decreasing(sizes, 100)):
        fits = [r for r in rooms if r >= size]
        if fits:
            assert rooms[chosen] == min(fits)
        else:
            assert chosen == len(rooms)
            rooms.append(100)
        rooms[chosen] -= size


@pytest.mark.parametrize("seed", range(12))
def test_exchanges_only_raise_the_squared_fills(seed):
    rng = np.random.default_rng(seed)
    high = (40, 60, 101)[seed % 3]
    sizes = np.sort(rng.integers(1, high, 60))[::-1].astype(np.int64)
    # A poor start: next fit, so there is something to gain.
    start, room, b = np.empty(len(sizes), dtype=np.int64), 100, 0
    for i in rng.permutation(len(sizes)):
        if sizes[i] > room:
            room, b = 100, b + 1
        start[i], room = b, room - sizes[i]
    squares = []
    for effort in range(0, 60, 6):
        after = best_fit.exchange(sizes, start, 100, effort)
        fill = np.bincount(after, weights=sizes)
        assert fill.max() <= 100
        squares.append((fill**2).sum())
    assert squares == sorted(squares)
    after = best_fit.exchange(sizes, start, 100)
    assert len(np.unique(after)) < len(np.unique(start))


def test_exchanges_empty_a_sequence():
    # 6+4, 7, 3 and two for one: 5 against 2+2 with room.
    sizes = np.array([7, 5, 4, 3, 1], dtype=np.int64)
    after = best_fit.exchange(sizes, np.array([0, 1, 1, 2, 2]), 10)
    assert len(np.unique(after)) == 2
    # One for one: 6 and 5 change places, then 4 fills up.
    sizes = np.array([6, 5, 5, 4], dtype=np.int64)
    after = best_fit.exchange(sizes, np.array([0, 0, 1, 1]), 11)
    assert np.bincount(after, weights=sizes).max() <= 11


def test_levels_open_underfull_sequences(spark):
    sizes = np.random.default_rng(3).integers(5, 60, 4000).tolist()
    rows = [(i, 0, 0, int(n), 0, int(n), i) for i, n in enumerate(sizes)]
    pieces = materialize(spark.createDataFrame(rows, best_fit.PIECE), "test-pieces")
    packed = best_fit.pack(pieces, 100, group_size=64).collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(4000))
    sequences = held(packed, 100)
    one_level = sum(-(-sum(sizes[i] for i in range(4000) if i % 62 == g) // 100) for g in range(62))
    assert len(sequences) <= -(-sum(sizes) // 100) + 20 < one_level
    # Pieces of which no two fit one sequence are left as they are.
    alone = materialize(spark.createDataFrame([(i, 0, 0, 60, 0, 60, i) for i in range(300)], best_fit.PIECE), "test-alone")
    assert len(held(best_fit.pack(alone, 100, group_size=64).collect(), 100)) == 300


def test_awkward_and_empty_tables(spark, awkward, tokenizer, nothing):
    given = awkward.withColumns({n: F.lit(1) for n in ("piece", "length", "sequence_id", "offset", "_fill", "_group", "piece_id")})
    rows = best_fit.pack_documents(given, PATH, 64).collect()
    held(rows, 64)
    want = sorted(len(ids_of(tokenizer, r["text"])) for r in given.collect())
    assert sorted(r["doc_tokens"] for r in rows if r["piece"] == 0) == want
    assert sum(r["length"] for r in rows) == sum(want)
    assert best_fit.pack_documents(nothing, PATH).count() == 0
