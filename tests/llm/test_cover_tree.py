import math

import numpy as np
import pytest

from twinsieve.llm import cover_tree as tree
from twinsieve.llm.queries import ORACLES  # noqa: F401


def brute(rows, cosine=0.93):
    good = [(k, i, label, np.array(v, float)) for k, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    linked, ids = {k: 0 for k in range(len(rows))}, {}
    component = {i: i for i, _, _ in rows}
    edges = []
    for x, (k, i, label, v) in enumerate(good):
        for l, j, other, w in good[:x]:
            if label == other and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= cosine:
                linked[k] += 1
                linked[l] += 1
                edges.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            low = min(component[i], component[j])
            if component[i] != low or component[j] != low:
                component[i] = component[j] = low
                changed = True
    return sorted((i, linked[k], component[i], component[i] == i) for k, (i, _, _) in enumerate(rows))


def clustered(n, seed):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n // 8 + 1, 8))
    rows = []
    for k in range(n):
        v = base[draw.integers(0, len(base))] + draw.normal(size=8) * draw.choice([0.01, 0.12, 0.3])
        rows.append((k, [float(np.float32(x)) for x in v * draw.choice([0.1, 1, 50])], int(draw.integers(0, 3))))
    for k in range(30):                                 # a hot vector
        rows.append((n + k, rows[5][1], rows[5][2]))
    return rows


def _run(spark, rows):
    df = spark.createDataFrame([(i, v, label, "z", 1.0) for i, v, label in rows],
                               "vec_id long, embedding array<float>, label int, node string, radius double")
    return sorted(map(tuple, tree.near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()))


@pytest.mark.parametrize("node_rows, fan_out, levels", [(1024, 32, 12), (20, 3, 12), (15, 4, 1)])
def test_links_equal_brute_force(spark, monkeypatch, node_rows, fan_out, levels):
    for name, value in (("NODE_ROWS", node_rows), ("FAN_OUT", fan_out), ("MOST_LEVELS", levels)):
        monkeypatch.setattr(tree, name, value)
    rows = clustered(260, node_rows)
    assert _run(spark, rows) == brute(rows)


def test_dual_traversal_misses_nothing():
    draw = np.random.default_rng(1)
    for _ in range(20):
        base = draw.normal(size=(15, 6))
        x, y = (base[draw.integers(0, 15, draw.integers(1, 200))] for _ in range(2))
        x, y = (v + draw.normal(size=v.shape) * draw.choice([0.001, 0.1, 0.4]) for v in (x, y))
        x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
        found = set(zip(*(k.tolist() for k in tree.dual_pairs(x, y, 0.93))))
        assert set(zip(*(k.tolist() for k in np.nonzero(x @ y.T >= 0.93)))) <= found


def test_levels_are_nested_and_halve():
    points = np.random.default_rng(2).normal(size=(300, 4))
    levels = tree.halving_levels(points)
    for above, below in zip(levels, levels[1:]):
        assert set(above[0].tolist()) <= set(below[0].tolist())
        assert (below[2] <= levels[0][2][0]).all()
    assert len(levels[-1][0]) == 300


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0),
            (7, [float("nan"), 1.0], 0), (8, [float("inf"), 1.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [], 0), (11, [1.0, 0.0], 1), (2, [2.0, 0.0], 0)]
    found = _run(spark, rows)
    assert [r for r in found if r[0] in (1, 2)] == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)]
    assert all(r[1:] == (0, r[0], True) for r in found if r[0] not in (1, 2)) and len(found) == 12
    assert _run(spark, []) == []
