import hashlib
import random
from collections import Counter

from conftest_llm import words

from depotlens.llm import queries
from depotlens.llm.substrings import remove_repeats


def brute(texts, size):
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    kept = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return kept


def compare(rows, texts, size, **options):
    got = {r["doc_id"]: r for r in remove_repeats(rows, size, **options).collect()}
    assert len(got) == len(texts)
    for i, (n, removed, kept) in enumerate(brute(texts, size)):
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, removed), (i, texts[i])
        assert words(got[i]["text"]) == kept
        if not removed:
            assert got[i]["text"] == texts[i]


def test_random_texts(spark):
    rng = random.Random(5)
    for alphabet, size, gram, cells in (("ab", 6, 3, 1 << 12), ("abcdefgh", 5, 2, 1 << 4), ([f"w{i}" for i in range(40)], 4, 4, 1 << 20)):
        texts = [" ".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(60)]
        texts += [t + " " + texts[0] for t in texts[:5]] + texts[:3]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        compare(frame, texts, size, gram=gram, cells=cells)


def test_awkward_rows(spark, awkward, texts):
    done = remove_repeats(awkward, 35)
    assert done.columns == [*awkward.columns, "n_words", "n_removed"]
    got = {r["doc_id"]: r for r in done.collect()}
    for i, (n, removed, _) in enumerate(brute(texts, 35)):
        assert (got[i]["n_words"], got[i]["n_removed"]) == (n, removed)
    assert got[None]["text"] == "no id here at all"
    assert done.count() == awkward.count()


def test_empty_table(nothing):
    assert remove_repeats(nothing).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    want = {
        r["doc_id"]: (n, removed, hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for r, (n, removed, kept) in zip(rows, brute([r["text"] for r in rows], 35))
    }
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op7_substring_dedup(spark, sf_dir).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 0
