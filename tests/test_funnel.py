import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.functions import expr
from clickloom.operators import anomaly, changepoints, ensemble, funnel, rca, reports
from clickloom.settings import Ensemble, ZScore, get_config
from clickloom.sources import events, scratch, sinks
from clickloom.streaming import funnel as streaming

T0 = dt.datetime(2024, 1, 1, 10)
SCHEMA = "event_time timestamp, event_type string, product_id long, category_id long, category_code string, brand string, price double, user_id long, user_session string"


def event(price=5.0, kind="view", brand="B", code="A.b", at=T0, session="s", user=1):
    return (at, kind, 1, 1, code, brand, price, user, session)


def test_clean_keeps_rows_with_missing_labels(spark):
    rows = [event(None), event(0.0), event(-1.0), event(float("nan")), event(at=None), event(kind=None), event(brand=None, code=None, session=None), event(code="Foo Bar.baz-1")]
    out = funnel.clean(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 3
    assert sum(r.dq_missing_brand and r.dq_missing_category and r.dq_missing_session for r in out) == 1
    assert "foo_bar.baz_1" in {r.category_code_norm for r in out}


def test_dedup_keeps_the_cheapest(spark):
    rows = [event(2.0), event(1.0), event(3.0), event(user=2)]
    out = funnel.dedup(funnel.clean(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert sorted((r.user_id, r.price) for r in out.collect()) == [(1, 1.0), (2, 5.0)] and out.columns == funnel.clean(spark.createDataFrame(rows, SCHEMA)).columns


def test_dedup_makes_again_what_cleaning_added(spark):
    raw = spark.createDataFrame([event(2.0, brand="Big", code="X Y"), event(1.0, brand=None, code="Q R")], SCHEMA)
    row = funnel.dedup(funnel.clean(raw)).first()
    assert (row.price, row.brand, row.brand_norm, row.dq_missing_brand, row.category_code_norm, row.dq_missing_session) == (1.0, None, None, True, "q_r", False)
    plain = funnel.dedup(raw).first()
    assert funnel.dedup(raw).columns == raw.columns and (plain.price, plain.category_code) == (1.0, "Q R")
    narrow = funnel.dedup(funnel.clean(raw).drop("category_code")).first()  # what it was made from is gone: carried along
    assert (narrow.price, narrow.category_code_norm) == (1.0, "q_r")


def test_a_missing_metric_is_no_cause(spark):
    """Without a purchase there is no order value, and so no deviation of it."""
    fields = "brand string, window_start timestamp, views long, conversion_rate double, carts long, revenue double, avg_order_value double"
    history = spark.createDataFrame([("b", T0, 10, 0.5, 4, 50.0, 10.0)] * 3, fields)
    row = rca.root_causes(spark.createDataFrame([("b", T0, 20, 0.0, 5, 0.0, None)], fields), history).first()
    assert row.avg_order_value_deviation is None and row.conversion_rate_deviation == -100
    assert row.top_metrics == "conversion_rate,revenue,views" and row.summary == "Conversion Rate down; Revenue down; Views up"


def test_price_bands_are_half_open(spark):
    rows = spark.createDataFrame([(p,) for p in (9.99, 10.0, 29.99, 30.0, 59.99, 60.0, None)], "price double").select(expr.price_band().alias("b")).collect()
    assert [r.b for r in rows] == ["<10", "10-30", "10-30", "30-60", "30-60", "60_plus", "60_plus"]


def test_rates_are_null_without_a_denominator_and_may_exceed_one(spark):
    rows = [event(kind="purchase", brand="x"), event(kind="view", brand="y"), event(kind="purchase", brand="y", user=2), event(kind="purchase", brand="y", user=3)]
    out = {r.brand: r for r in funnel.hourly_brand(funnel.clean(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert out["x"].conversion_rate is None and out["y"].conversion_rate == 2.0 and out["y"].revenue == 10.0


def test_empty_events_give_zero_totals(spark):
    row = reports.overall_funnel(funnel.daily_brand(funnel.clean(spark.createDataFrame([], SCHEMA)))).first()
    assert row.views == 0 and row.conversion_pct is None


def test_drop_wins_over_spike_and_views_gate(spark):
    rows = spark.createDataFrame([(50, -2.0, 2.0), (49, -3.0, 0.0), (50, 2.0, 0.0)], "views long, z_brand double, z_brand_hour double")
    assert [r.anomaly_type for r in anomaly.flag(rows).collect()] == ["drop", None, "spike"]


def test_severity_edges_and_missing_models(spark):
    df = spark.createDataFrame([(0.95,), (0.85,), (0.7,), (0.5,), (0.49,), (None,)], "prophet_anomaly_score double")
    out = ensemble.severity(ensemble.combine(df)).collect()
    assert [r.severity for r in out] == ["critical", "high", "medium", "low", "normal", "normal"]
    with pytest.raises(ValueError):
        ensemble.at_least(ensemble.severity(ensemble.combine(df)), "worst")
    with pytest.raises(ValueError):
        Ensemble(weights={"prophet": 0.5})
    assert Ensemble().weights == {"lstm": 0.30, "prophet": 0.30, "isolation_forest": 0.25, "changepoint": 0.15}
    assert get_config("nothing") == {} and get_config("zscore")["threshold"] == ZScore().threshold


def test_step_is_found_and_flagged(spark):
    times = pd.date_range("2024-01-01", periods=96, freq="h")
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"brand": "b", "window_start": times, "conversion_rate": np.where(np.arange(96) < 48, 0.2, 0.6) + rng.normal(0, 0.01, 96)})
    df = spark.createDataFrame(pdf)
    points = changepoints.changepoints(df)
    assert [r.changepoint_time for r in points.collect()] == [times[48].to_pydatetime()]
    marked = changepoints.flag_changepoints(df, points).filter("is_at_changepoint")
    assert marked.count() == 5 and marked.first().changepoint_anomaly_score == 1.0


def test_json_and_producer(spark):
    made = events.synthetic(spark)
    back = events.parse_messages(events.to_messages(made))
    assert back.filter("event_type = 'purchase'").agg(F.sum("price")).first()[0] == 3340.0
    with pytest.raises(ValueError):
        events.require_columns(made, "nope")


def test_ingest_twice_duplicates_nothing(spark, tmp_path):
    rows = events.synthetic(spark).withColumn("event_date", F.to_date("event_time"))
    for _ in range(2):
        sinks.ingest(rows, str(tmp_path / "bronze"))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 1000
    assert events.safe_parquet(spark, str(tmp_path / "none")) is None


def test_unknown_sink_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        streaming.start_pipeline(spark, "file", "paper", path=str(tmp_path))


def test_watching_and_stopping_streams(spark, tmp_path):
    at = str(tmp_path)
    for _ in range(3):
        events.synthetic(spark, 50).coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = events.file_stream(spark, f"{at}/in", events.schema_of(spark, f"{at}/in"), 1)
    query = sinks.start_parquet(stream.select("event_time", "price"), f"{at}/out", f"{at}/c", {"processingTime": "0 seconds"})
    assert streaming.run_batches(query, 3, 60, 0.2) >= 3 and not query.isActive
    console = sinks.start_console(stream.select("price"))
    assert console.isActive
    assert streaming.progress(query)["rows"] >= 0
    streaming.stop_all(spark)
    assert not spark.streams.active


def test_scratch_is_cleared(spark):
    kept = scratch.save(spark.range(3), "three")
    assert kept.count() == 3
    path = kept.inputFiles()[0]
    scratch.clear(spark)
    assert events.safe_parquet(spark, path) is None
