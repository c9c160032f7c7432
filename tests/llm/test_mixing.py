import itertools
import random

from conftest_llm import words
from pyspark.sql import functions as F

from depotlens.llm.mixing import min_cost_flow, mix, repeat_taken, targets


def test_targets_share_the_excess():
    assert targets([100, 100, 100], [5.0, 2.0, 1.0], 450.0, 2) == [200.0, 500 / 3, 250 / 3]
    assert targets([10, 1000], [5.0, 2.0], 1515.0, 2) == [20.0, 1495.0]
    assert targets([0, 0], [5.0, 2.0], 0.0, 2) == [0.0, 0.0]


def best_by_search(patterns, quotas, repeats):
    """(words routed, least cost) by trying all splits of small capacities."""
    choices = []
    for size, members in patterns:
        amounts = itertools.product(range(repeats * size + 1), repeat=len(members))
        choices.append([a for a in amounts if sum(a) <= repeats * size])
    best = (0, 0)
    for chosen in itertools.product(*choices):
        into = [0] * len(quotas)
        cost = 0
        for (size, members), amounts in zip(patterns, chosen):
            for s, a in zip(members, amounts):
                into[s] += a
            total = sum(amounts)
            cost += sum(max(0, total - r * size) - max(0, total - (r + 1) * size) for r in range(repeats) for _ in range(r))
        if all(x <= q for x, q in zip(into, quotas)):
            best = max(best, (sum(into), -cost))
    return best[0], -best[1]


def test_flow_routes_most_words_at_least_repetition():
    rng = random.Random(2)
    for _ in range(25):
        patterns = [(rng.randrange(1, 4), m) for m in ([0], [0, 1], [1])]
        quotas, repeats = [rng.randrange(7), rng.randrange(7)], 2
        flow = min_cost_flow(patterns, quotas, repeats)
        into = [sum(f[m.index(s)] for f, (_, m) in zip(flow, patterns) if s in m) for s in range(2)]
        cost = sum(max(0, sum(f) - size) for f, (size, _) in zip(flow, patterns))
        assert all(sum(f) <= repeats * size for f, (size, _) in zip(flow, patterns))
        assert all(i <= q for i, q in zip(into, quotas))
        assert (sum(into), cost) == best_by_search(patterns, quotas, repeats)


def test_overlapping_sources_reach_their_targets(spark):
    rng = random.Random(4)
    kinds = [["a"], ["a", "b"], ["b"], ["c"], [None]]
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(kinds)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, many array<string>")
    mixed, plan = mix(frame, sources=F.col("many"))
    got = {r["doc_id"]: (r["size"], r["taken"], r["many"]) for r in mixed.collect()}
    assert len(got) == 400 and all(0 <= t <= 2 * s for s, t, _ in got.values())
    assert [s[0] for s in plan.sources] == ["a", "b", "c", None]
    assert sum(t for _, t, _ in got.values()) == sum(f for _, f in plan.patterns.values())
    for source, _, target in plan.sources[2:]:
        assert sum(t for _, t, m in got.values() if m == [source]) == int(target)
    again, _ = mix(frame.repartition(7), sources=F.col("many"))
    assert {r["doc_id"]: r["taken"] for r in again.collect()} == {i: t for i, (_, t, _) in got.items()}
    copies = repeat_taken(mixed).groupBy("doc_id").agg(F.collect_list("text").alias("texts")).collect()
    assert {r["doc_id"]: sum(len(words(t)) for t in r["texts"]) for r in copies} == {i: t for i, (_, t, _) in got.items() if t}


def test_awkward_and_empty_tables(awkward, texts, nothing):
    mixed, plan = mix(awkward)
    assert mixed.columns == [*awkward.columns, "size", "taken"]
    rows = mixed.collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if r["doc_id"] is not None:
            assert r["size"] == len(words(texts[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
    assert plan.sources[-1][0] is None
    for source, _, target in plan.sources:
        assert sum(r["taken"] for r in rows if r["source"] == source) == int(target)
    assert mix(nothing)[0].count() == 0
    assert repeat_taken(mix(nothing)[0]).count() == 0
