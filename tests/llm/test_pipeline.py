import zlib

import corpus_pipeline
import pytest
from conftest_llm import words
from test_near_duplicates import broadcast_explodes, watch_broadcasts
from test_near_duplicates import brute as near_brute
from test_substrings import brute as window_brute
from tokenizers import Tokenizer

from depotlens.llm import queries


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows of documents and of every stage, each stage run on what the one before returned."""
    docs = queries.documents(spark, sf_dir)
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.materialize(stage(spark, frames[-1], sf_dir), "test-stage"))
    return frames


def test_stages(stages, spark, sf_dir):
    given, good, single, cut, mixed, packed = ([r.asDict() for r in f.collect()] for f in stages)
    assert all(f.columns == stages[0].columns for f in stages[:5])
    verdict = {r["doc_id"] for r in queries.op4_quality_rules(spark, sf_dir).where("kept").collect()}
    assert {r["doc_id"] for r in good} == verdict
    classes = near_brute([(r["doc_id"], r["text"]) for r in good], 5)
    assert {r["doc_id"] for r in single} == {c for _, c in classes.values()}
    single.sort(key=lambda r: r["doc_id"])
    kept = {r["doc_id"]: (removed, w) for r, (_, removed, w) in zip(single, window_brute([r["text"] for r in single], 35))}
    assert {r["doc_id"] for r in cut} == set(kept)
    for r in cut:
        assert words(r["text"]) == kept[r["doc_id"]][1] and r["n_chars"] == len(r["text"])
    sizes = {r["doc_id"]: len(words(r["text"])) for r in cut}
    taken = {}
    for r in mixed:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(words(r["text"]))
    assert all(n <= 2 * sizes[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len({r["source"] for r in cut})
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in mixed)
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in packed if r["start"] == 0) == want
    ends = zlib.crc32(b"\1\0\0\0")
    assert all(r["length"] > 0 and (r["length"] > 1 or r["ids_crc32"] == ends or r["start"]) for r in packed)


def test_run(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r["ids_crc32"] for r in found.collect()) == sorted(r["ids_crc32"] for r in stages[-1].collect())


def test_one_row_of_each_group_of_near_duplicates_goes_through(spark):
    """Repeated rows, ids used twice and rows without id: each text stays once, as a whole, up to the mix."""
    text = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    rows = [
        (1, text("a")), (1, text("a")), (1, text("a")),  # a repeated row
        (None, text("b")), (None, text("b")),  # equal texts without id
        (None, text("c")),  # another group without id
        (4, text("d")), (4, text("d") + " more"),  # one id, near texts
        (4, text("e")),  # the same id, another text
        (9, text("f")), (6, text("f")), (None, text("f")),  # the smallest id stays
        (7, ""), (7, ""), (None, None),  # no words, no group
    ]
    rows = [(i, t, "en", "src", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    single = corpus_pipeline.materialize(corpus_pipeline.drop_near_duplicates(spark, docs, ""), "test-single")
    assert single.columns == docs.columns
    got = sorted(((r["doc_id"], (r["text"] or " ").split(" ")[0]) for r in single.collect()), key=repr)
    want = [(1, "a0"), (None, "b0"), (None, "c0"), (4, "d0"), (4, "e0"), (6, "f0"), (7, ""), (7, ""), (None, "")]
    assert got == sorted(want, key=repr)
    cut = corpus_pipeline.drop_repeated_passages(spark, single, "").collect()
    assert sorted(len(words(r["text"])) for r in cut if r["text"])[:6] in ([60] * 6, [60] * 5 + [61])
    assert corpus_pipeline.drop_near_duplicates(spark, docs.where("false"), "").count() == 0


def test_near_duplicates_broadcast_no_exploded_rows(spark, monkeypatch):
    """Spark sizes exploded rows like the rows before: band keys broadcast by that outgrew the driver over 0.5 GB."""
    text = lambda i: " ".join(f"w{i % 10}x{k}" for k in range(60 - i // 10))
    rows = [(i, text(i), "en", "src", len(text(i))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    seen = watch_broadcasts(monkeypatch)
    single = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert seen["members"] == [] and not any(seen.values()) and broadcast_explodes(single) == []
    assert sorted(r["doc_id"] for r in single.collect()) == list(range(10))
