"""Cover trees and dual-tree clustering against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from clickloom.llm import cover_tree
from clickloom.llm import op13_dual_tree as op13

RNG = np.random.default_rng(13)
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance double, n int, v string"


def nearest(x, y):
    return ((x[:, None].astype(np.int64) - y[None]) ** 2).sum(2).argmin(1)


@pytest.mark.parametrize(("n", "k", "dim", "clusters"), [(1, 1, 2, 1), (40, 1, 3, 2), (300, 40, 2, 5), (900, 40, 16, 0), (700, 200, 4, 40)])
def test_nearest_by_two_trees(n, k, dim, clusters):
    x = RNG.integers(-200, 200, (clusters, dim))[RNG.integers(0, clusters, n)] + RNG.integers(-4, 5, (n, dim)) if clusters else RNG.integers(-99, 99, (n, dim))
    x[n // 2 : n // 2 + n // 4] = x[0]  # a hot vector
    y = x[RNG.integers(0, n, k)]  # with equal ones: ties go to the smaller number
    tree = cover_tree.build(x)
    found, cost = cover_tree.nearest(tree, cover_tree.build(y, 1))
    assert (found == nearest(x, y)[tree.order]).all() and sorted(tree.order) == list(range(n))
    if clusters >= 5:
        assert cost < 0.5 * n * k  # pairs of nodes are pruned


def test_the_tree_covers_and_separates():
    x = RNG.integers(-50, 50, (600, 3))
    t = cover_tree.build(x, 4)
    for node in range(len(t.start)):
        own = t.points[t.start[node] : t.stop[node]]
        assert np.sqrt(((own - own[0]) ** 2).sum(1)).max() <= t.radius[node] + 1e-6
        below = range(t.child[node], t.last[node])
        if below:
            assert t.start[below[0]] == t.start[node] and t.stop[below[-1]] == t.stop[node]
            centres = t.points[t.start[list(below)]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))[~np.eye(len(centres), dtype=bool)]
            assert apart.min() > max(t.radius[list(below)]) - 1e-6
        else:
            assert len(own) <= 4 or t.radius[node] == 0


def plain(rows, k, rounds, dim, seed=2):
    """Every vector against every centroid, in whole numbers."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    good = [(i, v) for i, v in good if sum(c * c for c in v) < 2**50]
    first = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centres, x = np.array([v for _, v in first]), np.array([v for _, v in good])
    for _ in range(rounds):
        at = nearest(x, centres)
        centres = np.array([[sum(map(int, col)) // int((at == c).sum()) for col in x[at == c].T] if (at == c).any() else centres[c] for c in range(len(centres))])
    at = nearest(x, centres)
    d = ((x - centres[at]) ** 2).sum(1)
    return sorted(str((i, int(c), int(s), int(d[at == c].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest())) for (i, _), c, s in zip(good, at, d, strict=True))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 0.5, 1, "v") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(("k", "block"), [(7, 2048), (40, 50), (500, 64)])
def test_against_plain_rounds(spark, k, block):
    rows = [(i, RNG.normal(size=6).tolist()) for i in range(250)] + [(500 + i, [0.25] * 6) for i in range(120)]
    rows += [(1000, None), (1001, [1.0] * 5), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1003, [math.nan] * 6), (1004, [-math.inf] * 6), (1005, [3e38] * 6), (1006, []), (None, [0.5] * 6), (3, [0.1] * 6), (3, [0.1] * 6)]
    found = op13.cluster(table(spark, rows), k, 5, 6, block=block)
    assert sorted(str(tuple(r)) for r in found.collect()) == plain(rows, k, 5, 6)


def test_small_and_empty_tables(spark):
    assert op13.cluster(table(spark, []), 3, 2, 6).count() == 0
    assert op13.cluster(table(spark, [(1, None)]), 3, 2, 6).count() == 0
    one = [(1, [0.5] * 6)]
    assert sorted(str(tuple(r)) for r in op13.cluster(table(spark, one), 3, 2, 6).collect()) == plain(one, 3, 2, 6)
