"""Distance keys and hard negatives against all pairs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.llm import distance_keys as keys
from clickloom.llm import op12_hard_negatives as op12

SCHEMA = "vec_id long, embedding array<float>, label int, id string, data int, shelf double, rank string, score string"
RNG = np.random.default_rng(12)


def vectors():
    """Clusters, copies, a hot vector, lengths of 6 and 3, bad values, an id that repeats."""
    centres = RNG.normal(size=(9, 6))
    out = [(i, (centres[i % 9] + 0.2 * RNG.normal(size=6)).tolist(), i % 3) for i in range(300)]
    out += [(1000 + i, [0.5] * 6, i % 2) for i in range(150)]
    out += [(2000 + i, RNG.normal(size=3).tolist(), i % 2) for i in range(20)]
    out += [(3000, None, 1), (3001, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (3002, [math.nan] * 6, 1), (3003, [math.inf] * 6, 1), (3004, [1.0] * 6, None), (None, [1.0] * 6, 1), (3005, [], 1), (3006, [3e38] * 6, 1)]
    return out + [(100, [0.4] * 6, 2), (7, [1.0] * 6, 1), (7, [1.0] * 6, 1), (5000, [0.1] * 5, 1)]


def plain(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """All pairs in plain Python."""
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(256 * float(np.float32(x))) for x in v]
            if sum(x * x for x in ints) < 2**50:
                good.append((i, label, ints))
    anchors = {}
    for i, label, v in good:
        if is_anchor(i):
            anchors.setdefault(i, []).append((label, np.array(v, "<i2").tobytes(), v))
    out = []
    for a, same_id in anchors.items():
        label, _, q = min(same_id)
        scored = [(-sum(x * y for x, y in zip(q, v, strict=True)), i, other) for i, other, v in good if i != a and len(v) == len(q)]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fit = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "i", 1, 0.5, "r", "s") for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("sizes", [{}, {"shelf_rows": 16, "least_rows": 4, "pivots": 3, "rings": 5}])
def test_against_all_pairs(spark, sizes):
    rows = vectors()
    found = op12.hard_negatives(table(spark, rows), F.col("id") % 25 == 0, **sizes)
    assert sorted(map(tuple, found.collect())) == plain(rows, lambda i: i % 25 == 0)


def test_small_and_empty_tables(spark):
    assert op12.hard_negatives(table(spark, []), F.lit(True)).count() == 0
    assert op12.hard_negatives(table(spark, [(1, None, 1)]), F.lit(True)).count() == 0
    one = [(1, [1.0, 0.0], 1)]
    assert op12.hard_negatives(table(spark, one), F.lit(True)).count() == 0
    few = [*one, (2, [1.0, 0.0], 1), (3, [0.5, 0.5], 2), (4, [-1.0, 0.0], 1), (5, [-0.5, 0.0], 2)]
    assert sorted(map(tuple, op12.hard_negatives(table(spark, few), F.lit(True)).collect())) == plain(few, lambda _: True)


def test_rounds_tighten_bounds(spark, monkeypatch):
    """On clustered vectors most rows are never scanned, whatever the budget of the first round."""
    centres = RNG.normal(size=(40, 8)) * 4
    rows = [(i, (centres[i % 40] + 0.05 * RNG.normal(size=8)).tolist(), 0) for i in range(4000)]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    index = keys.build(keys.integer_vectors(table_, 256, F.col("label")), shelf_rows=64, least_rows=64)
    asked = index.rows.filter("id % 100 = 0").select(F.col("id").alias("query_id"), "label", "data", *[F.array(F.lit(x).cast("long")).alias(n) for n, x in zip(("lo", "hi"), keys.ANY, strict=True)])
    saved, save = [], keys.save
    monkeypatch.setattr(keys, "save", lambda df, name: saved.append((name, out := save(df, name))) or out)
    found = keys.search(index, asked, 5, first=64)
    last = {r.query_id: r.rows for n, df in saved if n == "visits" for r in df.filter("shelf < 0").collect()}
    assert found.count() == 200 and np.mean(list(last.values())) < 0.3 * 4000
    m = {i: np.array([math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows}
    ids, every = np.array(list(m)), np.array(list(m.values()))
    for q in (0, 1300, 3900):
        score = np.where(ids == q, -(2**60), every @ m[q])
        order = np.lexsort((ids, -score))[:5]
        assert [(r.id, r.score) for r in found.filter(F.col("query_id") == q).orderBy("rank").collect()] == [(ids[k], score[k]) for k in order]


def test_shelves_hold_what_they_should():
    t = pd.DataFrame({"of": [3, 3, 3, 3, 5], "pivot": [0, 0, 1, 1, 0], "ring": [0, 1, 0, 1, 0], "n": [4, 5, 25, 2, 1]})
    out = keys.shelves(t, 10)
    assert out["shelf"].tolist() == [0, 0, 1, 4, 5] and out["cuts"].tolist() == [1, 1, 3, 1, 1]


def test_relations_of_labels(spark):
    with pytest.raises(ValueError):
        keys.search(None, None, 1, "other")
