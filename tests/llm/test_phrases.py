import re
from collections import Counter

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from depotlens.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, max_words=3, least=10, inside=50, top=2000):
    """The contract over (lang, text), by dictionaries."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, max_words + 1):
                own.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        around = Counter()
        for q, a in found.items():
            for n in range(2, len(q)):
                for i in range(len(q) - n + 1):
                    around[q[i : i + n]] = max(around[q[i : i + n]], a)
        kept = []
        for p, a in found.items():
            if p in around and 100 * around[p] >= inside * a:
                continue
            score, _, l, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, docs=60, vocabulary=40):
    """Zipf-like texts of several languages with fixed phrases, odd separators and words in both cases."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" if i % 3 else f"É{i}X" for i in range(vocabulary)]
    rows = []
    for d in range(docs):
        picked = [words[min(int(rng.zipf(1.4)) - 1, vocabulary - 1)] for _ in range(int(rng.integers(0, 120)))]
        text = "".join(w + [" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"][min(7, int(rng.zipf(1.7)) - 1)] for w in picked)
        if d % 2:
            text += " New York City" + " of new  york" * int(rng.integers(1, 3))
        rows.append((["en", "de", None, "und"][d % 4], text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, text string, doc_id long").repartition(3)


@pytest.mark.parametrize("max_words,least,top,filter_bytes", [(3, 10, 2000, 1 << 26), (3, 3, 7, 0), (4, 2, 50, 1 << 26), (2, 5, 2000, 0)])
def test_equals_plain_counts(spark, max_words, least, top, filter_bytes):
    rows = corpus(max_words)
    got = phrases.collocations(frame(spark, rows), max_words, least, top=top, counters=64, filter_bytes=filter_bytes)
    want = plain(rows, max_words, least, top=top)
    assert want and found(got) == want


def test_query_equals_its_sql(spark, sf_dir):
    assert oracle.difference(queries.op11_collocations(spark, sf_dir), oracle.connect(sf_dir), queries.OP11_SQL) is None


def test_awkward_and_empty_tables(spark, awkward, nothing):
    given = awkward.withColumns({n: F.lit(1) for n in ("salt", "words", "phrase", "key", "a", "l", "r", "n", "rank", "score", "share", "k")})
    want = plain([(r["lang"], r["text"]) for r in given.collect()], least=2)
    assert found(phrases.collocations(given, least=2)) == want
    assert phrases.collocations(nothing).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_summaries_keep_every_frequent_key(seed):
    rng = np.random.default_rng(seed)
    least, blocks = 8, []
    # Many rare keys, some at the threshold, and a hot one.
    keys = np.concatenate([rng.integers(0, 1 << 62, 20_000), np.repeat(rng.integers(0, 1 << 62, 50), least), np.full(9000, 7)]).astype(np.uint64)
    rng.shuffle(keys)
    for part in np.array_split(keys, 80):
        blocks.append(phrases.tally(part, np.ones(len(part), dtype=np.int64)))
    mass = sum(int(c[c < least].sum()) for _, c in blocks)
    summary = phrases.Summary(least, mass // least + 1)
    planned = summary.capacity
    for k, c in blocks:
        enough = c >= least
        summary.add(k[enough], k[~enough], c[~enough])
    kept = summary.survivors()
    true, counts = np.unique(keys, return_counts=True)
    assert np.isin(true[counts >= least], kept).all()
    assert summary.lost > 0 and summary.capacity == planned  # rare keys were reduced away, and the capacity was enough
    assert len(kept) < len(true)
    # Far too small a capacity grows instead of losing a key.
    tight = phrases.Summary(least, 16)
    for k, c in blocks:
        tight.add(np.zeros(0, dtype=np.uint64), k, c)
    assert np.isin(true[counts >= least], tight.survivors()).all() and tight.capacity > 16


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_007, 3_000_000_011, 999_999_999_989
    counted = spark.createDataFrame([("x", 2, "p q", a), ("x", 1, "p", l), ("x", 1, "q", r)], "lang string, words int, phrase string, a long")
    totals = spark.createDataFrame([("x", 10**13)], "lang string, n long")
    row = phrases.rank_phrases(counted, totals).first()
    assert (row["a"], row["l"], row["r"], row["score"]) == (a, l, r, 1000000 * a * a // (l * r))
