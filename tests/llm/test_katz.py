import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import words
from pyspark.sql import functions as F

from depotlens.llm import katz, queries
from depotlens.session import materialize

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, held):
    """Scores per row number, and the conditional probability function."""
    tokens = [words((t or "").translate(LOWER)) + ["</s>"] for t in rows]
    uni = Counter(w for t, out in zip(tokens, held) if not out for w in t)
    pairs = Counter(p for t, out in zip(tokens, held) if not out for p in zip(["<s>", *t], t))

    def discounted(counts):
        kinds = Counter(counts.values())
        large = [c for c in counts.values() if c > 5]
        factors = katz.discounts([kinds[r] for r in range(1, 7)], len(large), sum(large))
        return {k: c * factors[min(c, 6) - 1] for k, c in counts.items()}

    n, v = sum(uni.values()), len(uni)
    word = {w: c / n for w, c in discounted(uni).items()}
    unknown = 1 - sum(word.values())
    kept, total, after = discounted(pairs), Counter(), defaultdict(list)
    for (h, w), c in pairs.items():
        total[h] += c
        after[h].append(w)
    alpha = {h: (1 - sum(kept[h, w] for w in ws) / total[h]) / (1 - sum(word[w] for w in ws)) for h, ws in after.items()}

    def p(h, w):
        return kept[h, w] / total[h] if (h, w) in pairs else alpha.get(h, 1.0) * word.get(w, unknown)

    scores = [
        (
            len(t),
            sum(w in uni for w in t),
            n,
            sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t),
            sum(math.log10(p(h, w)) for h, w in zip(["<s>", *t], t)),
        )
        for t in tokens
    ]
    for h in ["<s>", "no such word", *list(after)[:50]]:
        assert sum(p(h, w) for w in [*uni, "unknown word"]) == pytest.approx(1)
    return scores


def same(row, want):
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == want[:3]
    assert row["base_score"] == pytest.approx(want[3], abs=1e-6)
    assert row["score"] == pytest.approx(want[4], abs=1e-6)


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows]
    want = dict(zip((r["doc_id"] for r in rows), zip(held, brute([r["text"] for r in rows], held))))
    got = queries.op3_katz_scores(spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["held_out"] == want[r["doc_id"]][0]
        same(r, want[r["doc_id"]][1])
    outside = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in outside) > sum(r["base_score"] for r in outside)


def test_small_blocks_and_awkward_rows(spark, awkward, texts, monkeypatch):
    whole = katz.exchange_blocks
    monkeypatch.setattr(katz, "exchange_blocks", lambda docs, buckets: whole(docs, buckets, tokens=50, most_docs=4))
    held_out = F.col("doc_id") % 3 == 1
    got = katz.score_documents(awkward, held_out, buckets=5).collect()
    rows = awkward.collect()
    scores = brute([r["text"] for r in rows], [r["doc_id"] is not None and r["doc_id"] % 3 == 1 for r in rows])
    want = {r["doc_id"]: s for r, s in zip(rows, scores)}
    assert len(got) == len(rows)
    for r in got:
        same(r, want[r["doc_id"]])


def test_nothing_to_train_on(spark, nothing):
    assert katz.score_documents(nothing, F.lit(False)).count() == 0
    rows = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (only,) = katz.score_documents(rows, F.lit(True)).collect()
    assert (only["n_tokens"], only["n_known"], only["train_tokens"], only["base_score"], only["score"]) == (3, 0, 0, 0.0, 0.0)


def test_a_bucket_is_a_row_group_and_a_batch_of_its_own(spark, sf_dir, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    paths, batches = [], []

    def noted(df, name, **options):
        written = materialize(df, name, **options)
        if name == "ngram-table":
            paths.extend(f.removeprefix("file:") for f in written.inputFiles())
        return written

    def fitted(table):
        batches.append(table.sparkSession.conf.get(key))
        return fit(table)

    key, fit = "spark.sql.execution.arrow.maxRecordsPerBatch", katz.fit
    before = spark.conf.get(key)
    monkeypatch.setattr(katz, "materialize", noted)
    monkeypatch.setattr(katz, "fit", fitted)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    katz.score_documents(docs, F.lit(False), keep_table=True)
    files = [pq.ParquetFile(p).metadata for path in paths for p in glob.glob(path)]
    assert max(m.num_rows for m in files) > 1
    assert all(m.row_group(i).num_rows == 1 for m in files for i in range(m.num_row_groups))
    assert batches == ["1"] and spark.conf.get(key) == before


def test_backoff_gives_one_row_per_part_and_block(spark):
    def row(kind, *data):
        return (kind, 0, *map(bytearray, data), *[None] * (4 - len(data)))

    import numpy as np

    six, number = (lambda *v: katz._six(np.array(v, dtype=np.uint64))), (lambda kind, *v: np.array(v, kind).tobytes())
    rows = [row(1, six(5, 9), number("<f8", 10.0, 100.0), number("<f8", 0.9, 0.0))] + [
        row(2, six(5, 9, 7), number("<i8", 3, 3, 4), number("<u2", 1, 0, 2), number("<u4", 1, 2, 1)) for _ in range(20)
    ]
    sums = spark.createDataFrame(rows, "kind int, key long, a binary, b binary, c binary, d binary")
    found = {r["key"]: (np.frombuffer(r["a"], "<u2").tolist(), np.frombuffer(r["d"], "<f8").tolist()) for r in katz.back_off(sums).collect()}
    assert katz.back_off(sums).count() == 2
    assert found == {3: ([0, 1], pytest.approx([80.0, 40.0])), 4: ([2], [0.0])}


def decoded(rows):
    """(cell, word, history) of the bigrams of stored or exchanged rows."""
    found = []
    for r in rows:
        of, spread = np.frombuffer(r["words"], "<u8"), np.frombuffer(r["spread"], "<u4")
        found += [(r["cell"], w, h) for w, h in zip(np.repeat(of, spread).tolist(), katz._from_six(r["hists"]).tolist())]
    return found


@pytest.fixture
def one_frequent_word(spark):
    """Documents in which one word stands between words that are all different, some of them held out."""
    texts = [" ".join(f"a{i}x{j} so" for j in range(20)) for i in range(40)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_stored_rows_are_pieces_of_counts_without_places(spark, one_frequent_word):
    docs = one_frequent_word.select("doc_id", F.lit(False).alias("held"), "text")
    table = katz.add_counts(katz.count_blocks(docs.unionByName(docs), katz.Cells(3)), piece=7)
    rows = table.collect()
    bigrams = decoded(rows)
    assert set(table.columns) == {"cell", "continued", "words", "totals", "spread", "hists", "times"}
    assert max(len(r["hists"]) // 6 for r in rows) == 7 and any(r["continued"] for r in rows)
    assert len(bigrams) == len(set(bigrams)) == 40 * 20 * 2 + 1
    assert sum(np.frombuffer(r["times"], "<u8").sum() for r in rows) == 2 * 40 * 41
    assert katz.fit(table) == katz.fit(katz.add_counts(katz.count_blocks(docs.unionByName(docs), katz.Cells(5))))
    (of,), (total,) = katz.frequent_words(table, 81)
    assert total == 2 * 40 * 20 and any(of in np.frombuffer(r["words"], "<u8") for r in rows)


@pytest.mark.parametrize("held", ["false", "doc_id % 3 = 1"])
def test_a_frequent_words_bigrams_are_spread_over_cells(spark, one_frequent_word, monkeypatch, held):
    exchanged, evaluate, add_counts, back_off = [], katz.evaluate, katz.add_counts, katz.back_off

    def noted(rows, model, frequent, parts):
        exchanged.extend(rows.where("ids is null").select("cell", "block", "words", "spread", "hists").collect())
        assert len(frequent[0]) == 1
        word.append(int(frequent[0][0]))
        return evaluate(rows, model, frequent, parts, most=0)

    word = []
    monkeypatch.setattr(katz, "evaluate", noted)
    monkeypatch.setattr(katz, "add_counts", lambda counted: add_counts(counted, piece=7))
    monkeypatch.setattr(katz, "back_off", lambda sums: back_off(sums, most=0))
    got = katz.score_documents(one_frequent_word, F.expr(held), buckets=30).collect()
    for kind in (lambda block: block == katz.COUNTS, lambda block: block >= 0):
        cells = Counter(cell for cell, w, _ in decoded(r for r in exchanged if kind(r["block"])) if w == word[0])
        assert len(cells) > 20 and max(cells.values()) < sum(cells.values()) / 5
    rows = one_frequent_word.collect()
    out = [r["held_out"] for r in sorted(got, key=lambda r: r["doc_id"])]
    want = dict(zip((r["doc_id"] for r in rows), brute([r["text"] for r in rows], out)))
    assert len(got) == len(want)
    for r in got:
        same(r, want[r["doc_id"]])


def test_sums_hold_distinct_keys_only():
    total = katz.Sum()
    total.limit = 4
    for _ in range(2 * katz.PIECE):
        total.add([np.array([5, 3], dtype=np.uint64)], np.array([1, 2]))
        assert total.size <= 4 * katz.PIECE + 2
    (keys,), counts = total.result()
    assert (keys.tolist(), counts.tolist()) == ([3, 5], [4 * katz.PIECE, 2 * katz.PIECE])
