"""Given columns whose names the operators use inside: they stay as they are, and the results are the same."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from depotlens.llm import mixing, near_duplicates, quality, substrings

INSIDE = [
    "_id", "_key", "_text", "_print", "_left", "_right", "node", "component", "first", "one", "size_", "members", "rank",
    "before", "words", "flow", "_pattern", "_bucket", "_within", "_copy", "_row", "_named", "_words", "_group", "_lengths", "_hits",
    "_found", "_chars", "_common", "ref_chars", "ref_common", "refs", "chars", "common", "name", "_uid", "_anchor", "_block",
    "_first", "_keys", "_spans", "b", "times", "key", "a.b", "_given_0",
]

OPERATORS = {
    "near_duplicates": (near_duplicates.near_duplicates, near_duplicates.RESULTS),
    "mix": (lambda docs: mixing.mix(docs)[0], ("size", "taken")),
    "judge": (quality.judge, quality.RESULTS),
    "remove_repeats": (substrings.remove_repeats, ("n_words", "n_removed")),
}


def clashing(docs):
    return docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in INSIDE})


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_keep_any_column(spark, sf_dir, name):
    operator, results = OPERATORS[name]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60)
    plain = {r["doc_id"]: tuple(r[c] for c in ("text", *results)) for r in operator(docs).collect()}
    given = clashing(docs).withColumns({n: F.lit("replaced") for n in results})
    out = operator(given)
    assert out.columns == [*docs.columns, *INSIDE, *results]
    rows = out.collect()
    assert {r["doc_id"]: tuple(r[c] for c in ("text", *results)) for r in rows} == plain
    assert all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in INSIDE)


def test_sources_of_a_mix_may_be_any_column(spark):
    docs = spark.createDataFrame([(1, "a b", ["x"], 7), (2, "c", ["x", "y"], 8)], "doc_id long, text string, words array<string>, size int")
    mixed, plan = mixing.mix(docs, sources=F.col("words"))
    assert mixed.columns == ["doc_id", "text", "words", "size", "taken"] and [s[0] for s in plan.sources] == ["x", "y"]
    assert {r["doc_id"]: r["words"] for r in mixed.collect()} == {1: ["x"], 2: ["x", "y"]}


def test_stages_keep_any_column(spark, sf_dir):
    docs = clashing(spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60))
    for _, work in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.materialize(work(spark, docs, sf_dir), "test-stage")
        rows = docs.collect()
        assert rows and all(r[n] == f"{n}:{r['doc_id']}" for r in rows for n in INSIDE)
