import zlib
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from depotlens.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows, family=100, most=6):
    """{conv_id: [(role, text), ...]} by plain lists."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (c % family if c >= 0 else -(-c % family))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved, rows = Counter(), Counter(), set()
    for path, inside in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(inside) - 1) * len(path[-1][1]) if path else 0
    for path, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(path))
        rows.add((
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), len(children.get(path, [])),
            leaves[path],
            saved[path],
            sha256(ends.encode()).hexdigest(),
        ))
    return rows


def found(df):
    rows = df.select(COLUMNS).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed, n=260):
    """Conversations that share starts, are alike, are missing, or are nothing but a start."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-5, n):
        if c == 100 or rng.random() < 0.15:
            continue
        alike = rng.random() < 0.4
        for t in range(3 if alike else rng.integers(1, 9)):
            text = "same" if alike else str(rng.integers(0, 2)) * int(rng.integers(0, 3))
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


@pytest.mark.parametrize("seed,block_turns", [(1, 1 << 18), (2, 9), (3, 1)])
def test_equals_plain_trie(spark, seed, block_turns):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    convs = rebuilt(rows)
    assert any(not t for t in convs.values())
    assert found(prefix_trie.prefix_trie(prefix_trie.shared_starts(df), block_turns)) == plain_trie(convs)


@pytest.mark.parametrize("block_turns", [1 << 18, 3])
def test_awkward_rows(spark, block_turns):
    rows = [
        (0, None, "user", "first"), (0, 1, None, "b"), (0, 1, "user", None), (0, 1, None, "b"), (0, 2, "user", "\U0001f600é"),
        (1, 1, "user", "tie"), (1, 1, "assistant", "tie"), (1, 1, "a", "b"), (1, 1, "", "ab"), (2, 5, None, None),
        (None, 0, "user", "no id"), (None, 1, "user", "no id"), (3, 0, "user", ""), (250, 0, "user", "x" * 100_000),
        (-3, 0, "user", "negative"), (101, 0, "user", "no base"), (2**40, 0, "user", "first"),
    ]
    rows += [(400, t, "user", f"turn {t % 7}") for t in range(900)]
    names = ("x", "y", "chars", "base", "head", "key", "name", "many", "least", "ends", "block", "depth", "turns", "h")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in names}).repartition(2)
    got = found(prefix_trie.prefix_trie(prefix_trie.shared_starts(df), block_turns))
    assert got == plain_trie(rebuilt(rows))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.shared_starts(none)).count() == 0


def test_extents_equal_scans():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64):
        shared = rng.integers(0, 5, n - 1)
        table = prefix_trie.sparse_table(shared)
        at, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = prefix_trie.extents(table, n, at, depth)
        for i, d, low, high in zip(at, depth, left, right):
            a = b = i
            while a and shared[a - 1] >= d:
                a -= 1
            while b < n - 1 and shared[b] >= d:
                b += 1
            assert (low, high) == (a, b)
        values = rng.integers(0, 100, n)
        low, high = np.triu_indices(n)
        least = prefix_trie.range_minimum(prefix_trie.sparse_table(values), low, high)
        assert least.tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]


def test_digest_of_many_ids(spark):
    convs = spark.range(5000).selectExpr("cast(id % 3 as string) as k", "id * 7 - 900 as conv_id").selectExpr("cast(k as binary) as key", "conv_id")
    got = {bytes(r["key"]): r["ends"] for r in prefix_trie.ends_digests(convs, chunk=800).collect()}
    for k in range(3):
        ids = sorted(i * 7 - 900 for i in range(5000) if i % 3 == k)
        assert got[str(k).encode()] == sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_query_equals_its_sql(spark, sf_dir):
    assert oracle.difference(queries.op13_prefix_trie(spark, sf_dir), oracle.connect(sf_dir), queries.OP13_SQL) is None
