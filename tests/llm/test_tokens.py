import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depotlens.llm import kernels, packing, queries
from depotlens.llm.token_counts import count_by_section

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("ranked", [True, False])
def test_ids_are_those_of_the_tokenizer(tokenizer, texts, ranked):
    odd = ["a  b", "a \n b", " x  y", "a b  c", "x\x1c y \x85 z", "ü ö", "\n\nA\nB", " a", "a ", "'s 're"]
    encoder = kernels.TokenIds(PATH, most=40)
    assert encoder.ranked
    if not ranked:
        encoder.ranked = None
    for column in (pa.array(texts + odd), pa.array(odd + texts, pa.large_string())):
        given = column.to_pylist()
        for row, data, offsets in kernels.text_chunks(column, 600):
            ids, first = encoder.encode(data, offsets)
            for i in range(len(offsets) - 1):
                assert ids[first[i] : first[i + 1]].tolist() == ids_of(tokenizer, given[row + i])


def test_pieces_are_packed_whole(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op5_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, parts in pieces.items():
        ids = np.array([*ids_of(tokenizer, texts[doc_id]), 1], dtype="<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    filled = sum(r["length"] for r in rows)
    assert filled > 0.95 * 2048 * len(sequences)


def test_first_fit_equals_plain_search():
    sizes = sorted((int(x) for x in np.random.default_rng(1).integers(1, 100, 300)), reverse=True)
    room, want = [], []
    for size in sizes:
        at = next((i for i, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(100)
        want.append((at, 100 - room[at]))
        room[at] -= size
    assert packing.first_fit_decreasing(sizes, 100) == want


def test_awkward_pieces_and_sequences(spark, awkward, texts, tokenizer, nothing):
    from depotlens.session import materialize

    cut = materialize(packing.cut_documents(awkward, PATH, 64, keep_ids=True), "test-pieces")
    packed = packing.pack(cut, 64, group_size=16)
    made = packing.sequences(packed).collect()
    assert all(0 < len(r["ids"]) <= 64 for r in made)
    given = [r["text"] for r in awkward.collect()]
    assert sum(len(r["ids"]) for r in made) == sum(len(ids_of(tokenizer, t)) + 1 for t in given)
    for r in made:
        at = 0
        for part in r["documents"]:
            assert part["offset"] == at
            at = next((p["offset"] for p in r["documents"] if p["offset"] > at), len(r["ids"]))
    assert packing.pack_documents(nothing, PATH).count() == 0


def sections_of(text, kind):
    """Places where sections begin, by characters."""
    starts = {0}
    for i in range(1, len(text)):
        if text[i - 1] == "\n" and (kind != "paragraphs" or (i > 1 and text[i - 2] == "\n" and text[i] != "\n")):
            starts.add(i)
        if kind == "sentences" and i > 1 and text[i - 1] in " \n" and text[i - 2] in ".!?":
            starts.add(i)
    return sorted(starts)


@pytest.mark.parametrize("kind,rule", [("lines", "first"), ("sentences", "last"), ("sentences", "most"), ("paragraphs", "first")])
def test_counts_by_section(spark, awkward, texts, tokenizer, kind, rule):
    got = {}
    for r in count_by_section(awkward.where("doc_id is not null").dropDuplicates(["doc_id"]), PATH, kind, rule).collect():
        got.setdefault(r["doc_id"], []).append((r["section"], r["start_char"], r["end_char"], r["n_tokens"], r["doc_tokens"]))
    assert set(got) == set(range(len(texts)))
    for i, text in enumerate(texts):
        text = text or ""
        data = text.encode()
        begin = sections_of(text, kind)
        edges = [len(text[:b].encode()) for b in begin] + [max(len(data), 1)]
        ids = ids_of(tokenizer, text)
        counts, at = [0] * len(begin), 0
        for token in ids:
            width = len(tokenizer.id_to_token(token))
            share = [max(0, min(at + width, b) - max(at, a)) for a, b in zip(edges, edges[1:])]
            inside = [s for s, n in enumerate(share) if n]
            counts[{"first": inside[0], "last": inside[-1], "most": share.index(max(share))}[rule]] += 1
            at += width
        want = [(s, b, e, c, len(ids)) for s, (b, e, c) in enumerate(zip(begin, [*begin[1:], len(text)], counts))]
        assert sorted(got[i]) == want, (i, text[:50])


def test_token_count_query(spark, sf_dir, tokenizer, nothing):
    rows = queries.op10_token_counts(spark, sf_dir)
    totals = {r["doc_id"]: (r["n"], r["t"]) for r in rows.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        n = len(ids_of(tokenizer, r["text"]))
        assert totals[r["doc_id"]] == (n, n)
    assert rows.where("n_crossing > 0").count() > 0
    assert count_by_section(nothing, PATH).count() == 0
