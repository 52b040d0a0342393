"""Isolation forests: one for each brand, over standardised features."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import stored

#: Those of them that the rows have are used.
FEATURES = ("conversion_rate", "views", "purchases", "revenue", "hour_of_day", "day_of_week", "rolling_7d_avg_conversion_rate", "rolling_30d_avg_conversion_rate")
FIELDS = "isolation_forest_anomaly_score double, isolation_forest_is_anomaly boolean, isolation_forest_decision_score double"
NOTHING = {"isolation_forest_anomaly_score": 0.0, "isolation_forest_is_anomaly": False, "isolation_forest_decision_score": 0.0}


def grow(x: np.ndarray, depth: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (feature or -1, cut, left, right, rows) of a random tree, the root first."""
    nodes: list[tuple] = [()]
    todo = [(0, x, depth)]
    while todo:
        at, part, deep = todo.pop()
        low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(x.shape[1]),) * 2
        usable = np.flatnonzero(high > low)
        if not deep or len(part) <= 1 or not len(usable):
            nodes[at] = (-1, 0.0, 0, 0, len(part))
            continue
        k = int(rng.choice(usable))
        cut = rng.uniform(low[k], high[k])
        nodes[at] = (k, cut, len(nodes), len(nodes) + 1, len(part))
        for side in (part[:, k] < cut, part[:, k] >= cut):
            todo.append((len(nodes), part[side], deep - 1))
            nodes.append(())
    return nodes


def usual_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe, (n == 2).astype(float))


def learn(x: np.ndarray, contamination: float, trees: int = 100, sample: int = 256, seed: int = 42) -> dict[str, np.ndarray]:
    rng, n = np.random.default_rng(seed), min(sample, len(x))
    mean, std = x.mean(0), x.std(0)
    std = np.where(std > 0, std, 1)
    z = (x - mean) / std
    depth = int(np.ceil(np.log2(max(n, 2))))
    forest = [grow(z[rng.choice(len(z), n, replace=False)], depth, rng) for _ in range(trees)]
    roots = np.cumsum([0, *map(len, forest)])[:-1]
    feature, cut, left, right, rows = (np.array(c) for c in zip(*[node for tree in forest for node in tree], strict=True))
    of = np.repeat(roots, [len(t) for t in forest])
    model = {"mean": mean, "std": std, "roots": roots, "feature": feature, "cut": cut, "left": left + of, "right": right + of, "rows": rows, "usual": usual_depth(n)}
    return model | {"threshold": np.quantile(raw_scores(model, x), 1 - contamination)}


def raw_scores(model: dict, x: np.ndarray) -> np.ndarray:
    """From 0 to 1; short paths to isolation score high. All trees are walked a level at a time."""
    z = (x - model["mean"]) / model["std"]
    at = np.tile(model["roots"], (len(z), 1))
    depth = np.zeros(at.shape)
    while True:
        feature = model["feature"][at]
        inner = feature >= 0
        if not inner.any():
            break
        low = np.take_along_axis(z, np.maximum(feature, 0), 1) < model["cut"][at]
        at = np.where(inner, np.where(low, model["left"][at], model["right"][at]), at)
        depth += inner
    depth += usual_depth(model["rows"][at])
    return 2.0 ** (-depth.mean(1) / max(float(model["usual"]), 1e-9))


def usable(df: DataFrame) -> tuple[str, ...]:
    found = tuple(c for c in FEATURES if c in df.columns)
    if not found:
        raise ValueError(f"none of the features is there: {', '.join(FEATURES)}")
    return found


def fit(df: DataFrame, min_rows: int = 100, contamination: float = 0.1) -> DataFrame:
    """Models of the brands of min_rows rows or more."""
    columns = usable(df)
    return stored.fit(df, "isolation_forest", columns, lambda pdf: learn(stored.numbers(pdf, columns), contamination) if len(pdf) >= min_rows else None)


def score(df: DataFrame, models: DataFrame) -> DataFrame:
    """Adds score (0 to 1 within the brand), flag and decision (below 0: anomalous); brands without a model get 0 and false."""
    columns = usable(df)

    def say(pdf: pd.DataFrame, model: dict) -> dict:
        decision = model["threshold"] - raw_scores(model, stored.numbers(pdf, columns))
        over = np.clip(-decision, 0, 1)
        return {"isolation_forest_anomaly_score": over / over.max() if over.max() > 0 else over, "isolation_forest_is_anomaly": decision < 0, "isolation_forest_decision_score": decision}

    return stored.score(df, models, "isolation_forest", columns, FIELDS, say, NOTHING)


def update(df: DataFrame, models: DataFrame, **options) -> DataFrame:
    """Refits the brands of df; the other models stay."""
    return stored.update(models, fit(df, **options))
