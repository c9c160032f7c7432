import random

import pyarrow as pa
from conftest_llm import words
from pyspark.sql import functions as F

from depotlens.llm import near_duplicates as module
from depotlens.llm import queries
from depotlens.llm.near_duplicates import near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent=80):
    """(set size, smallest reachable id) per id."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids, holders = sorted(sets), {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i in ids:
        for j in sorted({j for s in sets[i] for j in holders[s] if j > i}):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def compare(df, rows, size):
    found = near_duplicates(df, shingle=size)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    want = brute(rows, size)
    assert got == want
    return found


def broadcast_explodes(df):
    """The parts of a frame's plan that are broadcast although they explode rows: Spark sizes them like the rows before."""

    def walk(node):
        if node.nodeName() in ("BroadcastHashJoin", "BroadcastNestedLoopJoin"):
            build = node.left() if node.buildSide().toString() == "BuildLeft" else node.right()
            if "Generate " in build.toString():
                yield build.toString()
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return list(walk(df._jdf.queryExecution().sparkPlan()))


def watch_broadcasts(monkeypatch):
    """The names of what is written from now on, and the exploded rows broadcast for it."""
    seen, write = {}, module.materialize

    def watched(df, name, **options):
        seen.setdefault(name, []).extend(broadcast_explodes(df))
        return write(df, name, **options)

    monkeypatch.setattr(module, "materialize", watched)
    return seen


def test_table_keys_are_not_broadcast(spark, monkeypatch):
    """A class has 144 table keys, but Spark takes them for one: 33,994,944 keys were broadcast over 0.5 GB."""
    rng = random.Random(5)
    base = [rng.choices([f"w{i}" for i in range(300)], k=40) for _ in range(20)]
    rows = [(i, " ".join(base[i % 20][: 40 - i // 20])) for i in range(60)]
    seen = watch_broadcasts(monkeypatch)
    found = compare(spark.createDataFrame(rows, "doc_id long, text string"), rows, 2)
    assert len({r["component_id"] for r in found.collect()}) == 20
    assert seen["members"] == [] and not any(seen.values()) and broadcast_explodes(found) == []


def test_chains_copies_and_clusters(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(20, 90))
        for _ in range(rng.randrange(1, 25)):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                base = text  # chains: the ends are linked only through what lies between
            rows.append((len(rows) * 7 % 1009, " ".join(text).upper() if rng.random() < 0.1 else " ".join(text)))
    compare(spark.createDataFrame(rows, "doc_id long, text string"), rows, 2)


def test_awkward_rows(awkward, texts):
    found = near_duplicates(awkward, shingle=5)
    assert found.columns == [*awkward.columns, "n_shingles", "component_id", "kept"]
    rows = found.collect()
    assert len(rows) == awkward.count()
    want = brute(list(enumerate(texts)), 5)
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert [(r["n_shingles"], r["kept"]) for r in rows if r["doc_id"] is None] == [(1, True)]


def test_empty_table(nothing):
    assert near_duplicates(nothing).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op1_minhash_dedup(spark, sf_dir)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    want = brute(rows, 2)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_blocks_of_short_texts_are_bounded_by_documents(spark, monkeypatch):
    """A family of many tiny sets: blocks hold few documents a side, and every pair of them meets once."""

    def sizes(percent):
        def count(table):
            side = table.column("side").to_pylist()
            return pa.table({"a": [side.count(0)], "b": [side.count(1)]})

        return count

    n = 10_000
    nodes = spark.range(n).select(F.col("id").alias("node"), F.lit(2).cast("long").alias("size"), F.col("id").alias("comp"), F.lit(0).cast("long").alias("family"))
    sets = nodes.select("node", F.array(F.lit(-1).cast("long"), "node").alias("items"))
    monkeypatch.setattr(module, "_compare_blocks", sizes)
    blocks = module.family_links(nodes, sets, 80).collect()
    assert all(r["a"] <= 4096 and r["b"] <= 4096 for r in blocks)
    assert sum(r["a"] * r["b"] for r in blocks) == (n - 1) * n
