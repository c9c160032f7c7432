import bisect
import hashlib
import struct
import zlib

import pytest
import xxhash

from depotlens.llm import queries
from depotlens.llm.sharding import assign_shards, ring, settle, shares


def checked(rows, shards, slack=0.0):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    most = shares(len(rows), shards, slack)
    assert all(len(by.get(s, ())) <= m for s, m in enumerate(most))
    if not slack:
        assert [len(by.get(s, ())) for s in range(shards)] == most
    return {r["doc_id"]: r["shard"] for r in rows}


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op9_shards(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) for r in rows} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for i, t in docs.items()
    }
    checked(rows, 8)


def test_a_new_shard_moves_little(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'t' as text")
    before = checked(assign_shards(docs, 8, slack=0.25).collect(), 8, 0.25)
    after = checked(assign_shards(docs, 9, slack=0.25).collect(), 9, 0.25)
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 3000 / 9 * 1.6
    again = {r["doc_id"]: r["shard"] for r in assign_shards(docs.repartition(5), 8, slack=0.25).collect()}
    assert again == before


def plain_ring(keys, shards, vnodes, most):
    """Rows one arc at a time, overflow one point further at a time."""
    points = ring(shards, vnodes)
    counts = [0] * len(points)
    for k in keys:
        counts[next((i for i, (p, _) in enumerate(points) if p >= k), 0)] += 1
    return points, counts, settle(counts, [s for _, s in points], most)


def test_overflow_goes_to_the_next_point_with_room():
    points, counts, segments = plain_ring([0] * 10, 3, 2, [4, 4, 4])
    arc = next(a for a, n in enumerate(counts) if n)
    order = list(dict.fromkeys(points[(arc + i) % len(points)][1] for i in range(len(points))))
    assert [(hi - lo, shard) for lo, hi, shard, _ in segments[arc]] == [(4, order[0]), (4, order[1]), (2, order[2])]


def test_awkward_and_empty_tables(awkward, nothing):
    rows = assign_shards(awkward, 3).collect()
    assert len(rows) == awkward.count()
    checked(rows, 3)
    assert assign_shards(nothing).count() == 0
    one = assign_shards(awkward.limit(1), 8).collect()
    assert [r["slot"] for r in one] == [0]


def walk(docs, shards, vnodes=128, slack=0.0):
    """{doc_id: shard} by a walk round the ring in plain Python: own hashes, own limits, one row at a time."""
    number = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    points = sorted((number(f"shard {s} point {v}"), s) for s in range(shards) for v in range(vnodes))
    places = [p for p, _ in points]
    waiting = {}
    for doc_id, text in docs:
        size, crc, part = len(text.encode()) + 1, zlib.crc32(text.encode()), 42
        for value in (doc_id, size, crc):
            part = xxhash.xxh64(struct.pack("<q", value), seed=part).intdigest()
        part = part - (1 << 64) if part >> 63 else part
        arc = bisect.bisect_left(places, number(str(doc_id))) % len(points)
        waiting.setdefault(arc, []).append((part % 16, doc_id, crc, size))
    n = len(docs)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    if slack:
        room = [max(-(-n // shards), int((1 + slack) * n / shards))] * shards
    found = {}
    for step in range(len(points)):
        for arc in sorted(waiting):
            shard = points[(arc + step) % len(points)][1]
            rows = sorted(waiting[arc])
            taken = rows[: room[shard]]
            room[shard] -= len(taken)
            found |= {doc_id: shard for _, doc_id, _, _ in taken}
            waiting[arc] = rows[len(taken) :]
    return found


@pytest.mark.parametrize("shards,slack", [(8, 0.0), (9, 0.0), (5, 0.25)])
def test_every_document_is_where_a_plain_walk_puts_it(spark, sf_dir, shards, slack):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert checked(assign_shards(docs, shards, slack=slack).collect(), shards, slack) == walk(given, shards, slack=slack)


def test_a_new_shard_moves_little_without_slack_too():
    docs = [(i, "t") for i in range(20_000)]
    before, after = walk(docs, 8), walk(docs, 9)
    moved = sum(before[i] != after[i] for i in before) / len(docs)
    new = sum(shard == 8 for shard in after.values()) / len(docs)
    assert new == pytest.approx(1 / 9, abs=1e-3) and moved < 1.6 / 9
