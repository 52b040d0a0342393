"""The models against brute force, closed forms and numeric slopes."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.operators import changepoints, forest, seasonal, sequences, stored

RNG = np.random.default_rng(4)


@pytest.fixture(scope="module")
def table(spark):
    times = pd.date_range("2024-01-01", periods=240, freq="h")
    parts = []
    for name, n in (("a", 240), ("b", 240), ("short", 20)):
        wave = 0.3 + 0.1 * np.sin(2 * np.pi * np.arange(n) / 24) + RNG.normal(0, 0.01, n)
        parts.append(pd.DataFrame({"brand": name, "window_start": times[:n], "conversion_rate": wave, "views": RNG.integers(20, 60, n), "purchases": RNG.integers(0, 20, n), "revenue": RNG.random(n)}))
    parts[0].loc[100, "conversion_rate"] = 0.95
    rows = pd.concat(parts).sample(frac=1, random_state=1)
    rows.loc[rows.brand == "b", "revenue"] = None
    return spark.createDataFrame(rows).union(spark.createDataFrame([(None, times[0].to_pydatetime(), 0.1, 1, 1, 1.0)], "brand string, window_start timestamp, conversion_rate double, views long, purchases long, revenue double"))


def all_segmentations(n, least):
    for k in range(n // least):
        for cut in itertools.combinations(range(least, n - least + 1), k):
            if all(b - a >= least for a, b in zip((0, *cut), (*cut, n), strict=True)):
                yield cut


@pytest.mark.parametrize("cost", ["l2", "rbf"])
def test_pelt_is_the_best_of_all_segmentations(cost):
    for _ in range(8):
        x = np.concatenate([RNG.normal(m, 0.3, n) for m, n in ((0, 5), (3, 4), (-1, 4))])
        made, penalty = changepoints.COSTS[cost](x), 0.8

        def total(cut, made=made, penalty=penalty, n=len(x)):
            return sum(made.beginning(a, b)[-1] for a, b in zip((0, *cut), (*cut, n), strict=True)) + penalty * len(cut)

        found = tuple(changepoints.segment_ends(x, penalty, 2, "pelt", cost))
        assert total(found) <= min(map(total, all_segmentations(len(x), 2))) + 1e-9


@pytest.mark.parametrize("cost", ["l2", "rbf"])
@pytest.mark.parametrize("search", ["pelt", "binseg", "bottomup"])
def test_every_search_finds_clear_steps(search, cost):
    x = np.concatenate([RNG.normal(m, 0.05, 40) for m in (0.2, 0.8, 0.4)])
    assert changepoints.segment_ends(x if cost == "rbf" else (x - x.mean()) / x.std(), 3.0, 10, search, cost) == [40, 80]
    assert changepoints.segment_ends(x[:15], 3.0, 10, search, cost) == []


def test_costs_against_their_definition():
    x = RNG.normal(0, 1, 12)
    for name, made in (("l2", changepoints.Squares(x)), ("rbf", changepoints.Kernel(x))):
        for a, b in ((0, 12), (3, 9), (5, 6)):
            part = x[a:b]
            gram = np.exp(-np.clip((part[:, None] - part[None]) ** 2 * getattr(made, "gamma", 0), 1e-2, 1e2))
            np.fill_diagonal(gram, 1)
            want = ((part - part.mean()) ** 2).sum() if name == "l2" else len(part) - gram.sum() / len(part)
            assert np.isclose(made.beginning(a, b)[-1], want) and np.isclose(made.ending(a, b)[0], want)


def test_unknown_search_is_refused(table):
    with pytest.raises(ValueError):
        changepoints.changepoints(table, search="guess")


def walked(model, row, root):
    z, at, depth = (row - model["mean"]) / model["std"], root, 0
    while model["feature"][at] >= 0:
        at = model["left" if z[model["feature"][at]] < model["cut"][at] else "right"][at]
        depth += 1
    return depth + float(forest.usual_depth(model["rows"][at]))


def test_forest_against_single_walks():
    x = RNG.normal(0, 1, (200, 3))
    x[17] = 9
    model = forest.learn(x, 0.1, trees=30)
    got = forest.raw_scores(model, x)
    want = [2 ** (-np.mean([walked(model, row, r) for r in model["roots"]]) / float(model["usual"])) for row in x]
    assert np.allclose(got, want) and got.argmax() == 17
    assert (got > model["threshold"]).sum() == 20


def test_forest_models_are_kept_and_updated(spark, table, tmp_path):
    made = forest.fit(table)
    stored.write(made, str(tmp_path / "m"))
    kept = stored.read(spark, str(tmp_path / "m"))
    assert {(r.brand, r.kind, r.rows) for r in kept.collect()} == {("a", "isolation_forest", 240), ("b", "isolation_forest", 240)}
    first, again = (forest.score(table, m).orderBy("brand", "window_start").toPandas() for m in (made, kept))
    assert first.isolation_forest_anomaly_score.equals(again.isolation_forest_anomaly_score) and len(first) == 501
    assert first.isolation_forest_anomaly_score.between(0, 1).all()
    untrained = first[~first.brand.isin(["a", "b"])]
    assert not untrained.isolation_forest_is_anomaly.any() and (untrained.isolation_forest_anomaly_score == 0).all()
    newer = forest.update(table.filter("brand = 'a' AND window_start < '2024-01-08'"), kept)
    assert {(r.brand, r.rows) for r in newer.collect()} == {("a", 168), ("b", 240)}
    with pytest.raises(ValueError):
        forest.fit(table.select("brand", "window_start"))


@pytest.mark.parametrize("multiplicative", [True, False])
def test_seasons_are_recovered(multiplicative):
    t = np.arange(24 * 28, dtype=float)
    trend = 0.2 + t / 2000
    daily, weekly = 0.3 * np.sin(2 * np.pi * t / 24), 0.1 * np.cos(2 * np.pi * t / 168)
    y = trend * (1 + daily + weekly) if multiplicative else trend + daily + weekly
    model = seasonal.learn(t, y, multiplicative)
    found = seasonal.parts(t, model)
    assert np.abs(found["expected"] - y).max() < 5e-3 and np.abs(found["daily"] - daily).max() < 2e-2 and np.abs(found["trend"] - trend).max() < 1e-2
    later = np.arange(24 * 28, 24 * 35, dtype=float)
    want = 0.2 + later / 2000
    swing = 0.3 * np.sin(2 * np.pi * later / 24) + 0.1 * np.cos(2 * np.pi * later / 168)
    assert np.abs(seasonal.parts(later, model)["expected"] - (want * (1 + swing) if multiplicative else want + swing)).max() < 3e-2


def test_seasonal_scores_and_forecasts(table):
    models = seasonal.fit(table)
    out = seasonal.score(table, models).toPandas()
    worst = out.loc[out.prophet_anomaly_score.idxmax()]
    assert worst.conversion_rate == 0.95 and worst.prophet_is_anomaly
    short = out[out.brand == "short"]
    assert (short.prophet_expected == short.conversion_rate).all() and not short.prophet_is_anomaly.any() and len(out) == 501
    ahead = seasonal.forecast(models, 24).toPandas()
    assert len(ahead) == 48 and ahead.window_start.min() == pd.Timestamp("2024-01-11") and (ahead.lower <= ahead.expected).all()
    assert seasonal.components(models, 24).columns == ["brand", "window_start", "trend", "daily", "weekly"]


def test_autoencoder_slopes_are_right():
    plan = sequences.Plan(steps=5, units=(4, 3), code=3, dropout=0.0)
    x, p = RNG.normal(0, 1, (2, 5, 2)), sequences.begin(plan, 2)
    p["code.b"] += 0.5  # away from the kink
    _, slopes = sequences.slopes(p, plan, x)
    assert set(slopes) == set(p)
    for name, value in p.items():
        for at in RNG.integers(0, value.size, 4):
            keep, step = value.flat[at], 1e-6
            value.flat[at] = keep + step
            up, _ = sequences.slopes(p, plan, x)
            value.flat[at] = keep - step
            down, _ = sequences.slopes(p, plan, x)
            value.flat[at] = keep
            assert np.isclose((up - down) / (2 * step), slopes[name].flat[at], atol=1e-6), name


def test_autoencoder_learns_and_flags(table):
    plan = sequences.Plan(steps=12, units=(8, 6), code=4, epochs=12, rate=0.01)
    values = table.filter("brand = 'a'").orderBy("window_start").select(*sequences.COLUMNS).toPandas().to_numpy(float)
    model = sequences.learn(values, plan)
    z = sequences.sequences((values - model["mean"]) / model["std"], plan.steps)
    assert sequences.errors(model, plan, z).mean() < sequences.errors(sequences.begin(plan, 3), plan, z).mean()
    out = sequences.score(table, sequences.fit(table, plan), plan).filter("brand = 'a'").orderBy("window_start").toPandas()
    assert (out.lstm_reconstruction_error[:11] == 0).all() and (out.lstm_reconstruction_error[11:] > 0).all()
    assert (out.lstm_is_anomaly == (out.lstm_reconstruction_error > float(model["threshold"]))).all() and out.lstm_anomaly_score.between(0, 1).all()
    assert sequences.score(table, sequences.fit(table, plan), plan).filter((F.col("brand") == "short") & F.col("lstm_is_anomaly")).count() == 0
