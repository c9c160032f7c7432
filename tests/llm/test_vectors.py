import numpy as np
import pytest

from depotlens.llm.vectors import near_duplicate_vectors


def brute(rows, cosine=0.9):
    """(links, smallest reachable id) per row."""
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if u else None for (_, v), u in zip(rows, usable)]
    near = [[j for j in range(len(rows)) if i != j and usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def compare(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, component_id string").repartition(3)
    got = near_duplicate_vectors(frame, **options).collect()
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute(single)
    for r in got:
        assert r["kept"] == (r["vec_id"] == r["component_id"])


@pytest.mark.parametrize("pivots,block", [(4096, 1024), (5, 7), (1, 3)])
def test_clusters(spark, pivots, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * rng.uniform(0.5, 2) + rng.normal(size=8) * rng.choice([0.05, 0.3, 0.6])).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(15)]
    compare(spark, rows, most_pivots=pivots, block=block)


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
        (7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (None, [3.0, 0.1]), (10, [1e30, 0.0]), (11, [-1.0, -0.0]),
    ]
    compare(spark, rows)


def test_empty_table(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
