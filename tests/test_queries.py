import pytest
from conftest import DATA, same

from clickloom.plans import registry


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_against_sql(spark, duck, name):
    same(registry.QUERIES[name](spark, DATA).toPandas(), duck.execute(registry.ORACLES[name]).df())


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in registry.ORACLES])
def test_without_sql(spark, name):
    """Fitted models: what they say is tested elsewhere; here that whole routes run and keep their rows."""
    found = registry.QUERIES[name](spark, DATA)
    if name == "advanced_scores":
        rows = found.toPandas()
        score = 0.3 * rows.lstm_anomaly_score + 0.3 * rows.prophet_anomaly_score + 0.25 * rows.isolation_forest_anomaly_score + 0.15 * rows.changepoint_anomaly_score
        assert len(rows) and (score - rows.ensemble_score).abs().max() < 1e-5
        return
    rows = found.toPandas()
    # A month of a few events an hour need not shift anywhere.
    assert len(rows) or name.startswith("changepoints_")
    for column in [c for c in rows.columns if c.endswith("_anomaly_score")]:
        assert rows[column].between(0, 1).all(), column
    if name in ("seasonal_scores", "seasonal_forecast"):
        low, high = rows.filter(regex="lower$").iloc[:, 0], rows.filter(regex="upper$").iloc[:, 0]
        assert (low.dropna() <= high.dropna()).all()
    if name == "described_quantiles":
        assert (rows[["least", "p25", "p50", "p75", "greatest"]].diff(axis=1).iloc[:, 1:] >= 0).all(axis=None)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
