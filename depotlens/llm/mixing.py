"""Mixing of overlapping sources to target weights by min-cost flow.

Documents that belong to the same set of sources form a pattern. Only the patterns' sizes reach the driver:
a flow network routes each pattern's words to the sources' quotas, where every further repetition of a
pattern's words costs one more than the one before (convex costs), so no word is repeated while a word that
would also do is unused. Within a pattern documents stand in a seeded random order on a line of as many words
as the pattern has; the flow takes the line from its beginning, round after round, so a document is taken a
whole number of times, but for the one under the end of the flow, of which the first words are taken.

Shares follow weights; a share above ``repeats`` times the source's words is cut there and the excess is
shared again by weight. Null texts have no words and are not taken; a null source is a source of its own, the
last one; repeated rows are documents of their own; an empty table gives no rows. Columns named like a result
are replaced, all others kept.
"""

from __future__ import annotations

import json
import math
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from depotlens.llm.literals import WORD, literal_table, word_count
from depotlens.llm.names import keeps_columns
from depotlens.session import materialize


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the rest is shared by weight again."""
    caps = [most * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i])
    left, weight, level = total, float(sum(weights)), 0.0
    for i in order:
        level = left / weight
        if caps[i] / weights[i] >= level:
            break
        left -= caps[i]
        weight -= weights[i]
    return [min(c, level * w) for c, w in zip(caps, weights)]


def min_cost_flow(patterns: list[tuple[int, list[int]]], quotas: list[int], repeats: int) -> list[list[int]]:
    """Words routed from each pattern (size, sources) to each of its sources; successive shortest paths."""
    n, m = len(patterns), len(quotas)
    source, sink = n + m, n + m + 1
    graph: list[list[int]] = [[] for _ in range(n + m + 2)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, most: int, price: int) -> int:
        for x, y, r, p in ((a, b, most, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(p)
        return len(to) - 2

    routes = []
    for p, (size, members) in enumerate(patterns):
        for again in range(repeats):
            arc(source, p, size, again)
        routes.append([arc(p, n + s, repeats * size, 0) for s in members])
    for s, quota in enumerate(quotas):
        arc(n + s, sink, quota, 0)
    while True:
        best, via, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in graph[x]:
                if room[e] and best[x] + cost[e] < best.get(to[e], math.inf):
                    best[to[e]], via[to[e]] = best[x] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if sink not in best:
            return [[room[e ^ 1] for e in arcs] for arcs in routes]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


@dataclass
class MixPlan:
    """Sources as (name, words, target), and the words taken of each pattern."""

    sources: list[tuple[str | None, int, float]]
    patterns: dict[str, tuple[int, int]]


def plan_mix(sized: DataFrame, weights: list[float], factor: float, repeats: int, most_patterns: int = 100_000) -> MixPlan:
    """The plan for documents with ``_pattern`` and ``size``. Weights repeat over the sources in code point order."""
    rows = sized.groupBy("_pattern").agg(F.sum("size").alias("size")).limit(most_patterns + 1).collect()
    if len(rows) > most_patterns:
        raise ValueError(f"more than {most_patterns} sets of sources; the flow is planned on the driver")
    members = {r["_pattern"]: json.loads(r["_pattern"]) for r in rows}
    names = sorted({s for m in members.values() for s in m}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    sizes = [sum(r["size"] for r in rows if s in members[r["_pattern"]]) for s in names]
    share = [float(weights[i % len(weights)]) for i in range(len(names))]
    wanted = targets(sizes, share, factor * sum(r["size"] for r in rows), repeats) if names else []
    rows.sort(key=lambda r: r["_pattern"])
    flow = min_cost_flow([(r["size"], [place[s] for s in members[r["_pattern"]]]) for r in rows], [int(w) for w in wanted], repeats)
    return MixPlan(
        list(zip(names, sizes, wanted)), {r["_pattern"]: (r["size"], sum(f)) for r, f in zip(rows, flow)}
    )


def mix(
    docs: DataFrame,
    weights: list[float] = (5, 2, 1),
    factor: float = 1.5,
    repeats: int = 2,
    seed: int = 0,
    sources: Column | None = None,
) -> tuple[DataFrame, MixPlan]:
    """The documents with ``size`` and ``taken`` words, and the plan. ``sources`` is an array; default: the source."""
    member = F.array(F.col("source").cast("string")) if sources is None else sources
    mixed, plan = _mix(docs.withColumn(MEMBER, member), list(weights), factor, repeats, seed)
    return mixed.drop(MEMBER), plan


MEMBER = "_member_of"


@keeps_columns(("doc_id", "text", MEMBER), ("size", "taken"))
def _mix(docs: DataFrame, weights: list[float], factor: float, repeats: int, seed: int) -> tuple[DataFrame, MixPlan]:
    member = F.col(MEMBER)
    pattern = F.to_json(F.sort_array(F.array_distinct(member)), {"ignoreNullFields": "false"})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)))
    sized = docs.withColumns({"size": word_count(F.col("text").cast("string")), "_pattern": pattern, "_key": key})

    # Buckets of the random order, of some thousand documents each: their sums give every bucket's place on
    # the line, and a document's place is found within its bucket.
    places = materialize(sized.select("_pattern", "_key", "size"), "mix-sizes")
    plan = plan_mix(places, weights, factor, repeats)
    bits = min(28, max(0, math.ceil(math.log2(max(1, places.count()) / 4096))))
    number = F.conv(F.substring("_key", 1, 7), 16, 10).cast("long")
    bucket = F.shiftright(number, 28 - bits).cast("int")
    sums = places.withColumn("_bucket", bucket).groupBy("_pattern", "_bucket").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("_pattern").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_pattern", "_bucket", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("_pattern", "_bucket").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_bucket", bucket).withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    table = [{"_pattern": p, "words": s, "flow": f} for p, (s, f) in plan.patterns.items()]
    flows = literal_table(docs.sparkSession, table, "_pattern string, words long, flow long")
    placed = placed.join(sums, ["_pattern", "_bucket"]).join(F.broadcast(flows), "_pattern")
    at = F.col("before") + F.col("_within")
    rounds = [F.greatest(F.lit(0), F.least(F.col("size"), F.col("flow") - at - F.lit(r) * F.col("words"))) for r in range(repeats)]
    taken = rounds[0]
    for more in rounds[1:]:
        taken = taken + more
    return placed.select(*docs.columns, "size", taken.cast("long").alias("taken")), plan


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """One row per taken copy; the copy of which only the first words are taken has those, joined by one space."""
    return _copies(mixed).drop("size", "taken")


@keeps_columns(("text", "size", "taken"), ())
def _copies(mixed: DataFrame) -> DataFrame:
    copies = F.expr("explode(sequence(1L, (taken + size - 1) div size))")
    rows = mixed.where("taken > 0").withColumn("_copy", copies)
    words = F.least("size", F.col("taken") - (F.col("_copy") - 1) * F.col("size"))
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), words.cast("int")), " ")
    return rows.withColumn("text", F.when(words < F.col("size"), first).otherwise(F.col("text")))
