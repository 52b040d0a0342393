"""Registered queries of tables that are built again, of exact ranks and splits, of summaries kept by day, and of ensembles over deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, ensemble, features, ranks, summary
from ..settings import Ensemble, ZScore
from ..sources import events, manifest, scratch, sinks
from . import lakehouse
from .registry import BASE, CFG, FUNNEL, HOURLY, SERIES, Z, ZSQL, _gold, add, funnel_rows, hourly_brand, raw, series, written
from .routes import as_csv

GATE = ZScore(min_baseline_views=1, min_flag_views=2, threshold=1.1)
LOOSE = ZScore(min_baseline_views=1, min_flag_views=1, threshold=0.5)
#: Of the final state: one day has vanished, another holds no valid row, a third has other prices.
FINAL_STATE = BASE.replace("FROM events)", "FROM (SELECT * REPLACE (CASE WHEN ts::DATE = '2024-01-12' THEN -1 WHEN ts::DATE = '2024-01-05' THEN value + 1 ELSE value END AS value) FROM events WHERE ts::DATE <> '2024-01-20'))")


TABLES = ",\n" + ",\n".join((_gold("gold", "hour_start", "brand_norm", "brand"), _gold("db", None, "brand_norm", "brand"), _gold("dc", None, "category_root", "category_root"), _gold("pb", "hour_start", "price_band", "price_band"))) + "," + Z + """,
lake AS (SELECT 'bronze' AS table_name, event_date AS day, count(*) AS n_rows, sum(price) AS amount FROM raw GROUP BY 2 UNION ALL SELECT 'silver', event_date, count(*), sum(price) FROM silver GROUP BY 2
  UNION ALL SELECT 'hourly_brand', window_date, count(*), sum(views + 2 * carts + 3 * purchases) + sum(revenue) FROM gold GROUP BY 2 UNION ALL SELECT 'hourly_price_band', window_date, count(*), sum(views + 2 * carts + 3 * purchases) + sum(revenue) FROM pb GROUP BY 2
  UNION ALL SELECT 'daily_brand', date, count(*), sum(views + 2 * carts + 3 * purchases) + sum(revenue) FROM db GROUP BY 2 UNION ALL SELECT 'daily_category', date, count(*), sum(views + 2 * carts + 3 * purchases) + sum(revenue) FROM dc GROUP BY 2
  UNION ALL SELECT 'anomalies', window_date, count(*), sum(views + 2 * carts + 3 * purchases) + sum(revenue) FROM a GROUP BY 2)"""


def lake(s: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and amounts of each day of each table; tables without files have none."""
    out = None
    for name, path in paths.items():
        df = events.safe_parquet(s, path)
        if df is None:
            continue
        amount = F.sum("price") if name in ("bronze", "silver") else F.sum(F.col("views") + 2 * F.col("carts") + 3 * F.col("purchases")) + F.sum("revenue")
        one = df.groupBy(F.col(lakehouse.BY[name]).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), amount.alias("amount")).select(F.lit(name).alias("table_name"), "day", "n_rows", "amount")
        out = one if out is None else out.unionByName(one)
    return out


def csv(s: SparkSession, df: DataFrame, name: str) -> str:
    return f"{as_csv(s, df, name)}/month=*/*.csv"


def final_state(s: SparkSession, d: str) -> DataFrame:
    day = F.col("event_date").cast("string")
    price = F.when(day == "2024-01-12", -1.0).when(day == "2024-01-05", F.col("price") + 1).otherwise(F.col("price"))
    return raw(s, d).filter(day != "2024-01-20").withColumn("price", price)


def rebuilt(s: SparkSession, d: str) -> DataFrame:
    """Built from other rows and a looser gate, then from the final ones, then once more with nothing changed."""
    root, last = scratch.path(s, "lake"), csv(s, final_state(s, d), "last")
    lakehouse.build(s, csv(s, raw(s, d).filter("event_date <> DATE '2024-01-03'"), "first"), root, LOOSE)
    for _ in range(2):
        paths = lakehouse.build(s, last, root, GATE)
    return lake(s, paths)


def added(s: SparkSession, d: str) -> DataFrame:
    """The month in three parts, one of which is added twice, and a last build from bronze alone."""
    root, rows = scratch.path(s, "lake"), final_state(s, d)
    parts = [csv(s, rows.filter(F.dayofmonth("event_date").between(a, b)), "part") for a, b in ((1, 10), (11, 20), (21, 31))]
    for k in (1, 0, 2, 0):
        lakehouse.build(s, parts[k], root, GATE, whole=False)
    return lake(s, lakehouse.build(s, f"{root}/no-such-folder/*.csv", root, GATE))


def broken_off(s: SparkSession, d: str) -> DataFrame:
    """A build that died after the manifest was marked and silver had lost its days; the next one adds other days."""
    root, rows = scratch.path(s, "lake"), final_state(s, d)
    early, late = (csv(s, rows.filter(F.dayofmonth("event_date").between(a, b)), "part") for a, b in ((1, 15), (16, 31)))
    paths = lakehouse.build(s, early, root, GATE)
    book = manifest.Manifest(s, f"{root}/manifest")
    torn = {day for day in book.read() if day and day.day > 9}
    book.write({day: mark for day, mark in book.read().items() if day not in torn})
    manifest.drop_days(s, paths["silver"], "event_date", torn)
    manifest.drop_days(s, paths["daily_brand"], "date", {day for day in torn if day.day > 12})
    return lake(s, lakehouse.build(s, late, root, GATE, whole=False))


for _name, _make in (("lakehouse_rebuilt", rebuilt), ("lakehouse_days_added", added), ("lakehouse_broken_off", broken_off)):
    add(_name, _make, FINAL_STATE + TABLES + "\nFINAL SELECT * FROM lake", ("amount",))

# Exact ranks and splits.
add("true_percentiles", lambda s, d: ranks.percent_ranks(funnel_rows(s, d), "brand", "conversion_rate", "percentile").select("brand", "window_start", "conversion_rate", "percentile"), f"{SERIES},\n{FUNNEL}\nFINAL SELECT brand, window_start, conversion_rate, percent_rank() OVER (PARTITION BY brand ORDER BY conversion_rate) AS percentile FROM fu", ("conversion_rate", "percentile"))
add("price_percentiles", lambda s, d: ranks.percent_ranks(raw(s, d), "event_type", "price", "percentile").select("event_time", "user_id", "event_type", "price", "percentile"), BASE + "\nFINAL SELECT event_time, user_id, event_type, price, CASE WHEN price IS NOT NULL THEN percent_rank() OVER (PARTITION BY event_type, price IS NULL ORDER BY price) END AS percentile FROM raw", ("price", "percentile"))
add("train_rows", lambda s, d: features.train_rows(hourly_brand(s, d)).select("brand", "window_start", "is_train"), HOURLY + ", n AS (SELECT *, row_number() OVER (ORDER BY window_start, brand NULLS FIRST) AS k, count(*) OVER () AS n FROM gold)\nFINAL SELECT brand, window_start, k <= floor(0.8 * n) AS is_train FROM n")
add("numbered_events", lambda s, d: ranks.row_numbers(raw(s, d), [F.col("event_time"), F.col("user_id"), F.col("product_id")]).select("event_time", "user_id", "product_id", "row_number"), BASE + "\nFINAL SELECT event_time, user_id, product_id, row_number() OVER (ORDER BY event_time, user_id, product_id) AS row_number FROM raw")

# Summaries kept by day.
MEASURES = ("views", "revenue", "conversion_rate")


def kept_days(s: SparkSession, d: str) -> DataFrame:
    """A table of one row a day and column, written day by day as a lake would."""
    at = scratch.path(s, "summaries")
    sinks.write_partitioned(summary.daily(hourly_brand(s, d), MEASURES), at, "day")
    return s.read.parquet(at)


def exact(column: str) -> str:
    return f"SELECT '{column}' AS column_name, count({column}) AS n, avg({column}) AS mean, stddev_samp({column}) AS stddev, min({column})::DOUBLE AS least, max({column})::DOUBLE AS greatest FROM w"


EXACT = " UNION ALL ".join(map(exact, MEASURES))
add("described_columns", lambda s, d: summary.described(kept_days(s, d)).select("column_name", "n", "mean", "stddev", "least", "greatest"), HOURLY + f", w AS (SELECT * FROM gold)\nFINAL {EXACT}", ("mean", "stddev", "least", "greatest"))
add("described_range", lambda s, d: summary.described(kept_days(s, d), "2024-01-08", "2024-01-14").select("column_name", "n", "mean", "stddev", "least", "greatest"), HOURLY + f", w AS (SELECT * FROM gold WHERE window_date BETWEEN '2024-01-08' AND '2024-01-14')\nFINAL {EXACT}", ("mean", "stddev", "least", "greatest"))
add("described_quantiles", lambda s, d: summary.described(kept_days(s, d)))

# Ensembles of scores that the data gives: deviations from the brand, and from the brand at that hour.
TWO = Ensemble(weights={"brand": 0.6, "brand_hour": 0.4}, threshold=0.25, severity=(("critical", 0.5), ("high", 0.4), ("medium", 0.3), ("low", 0.2)))


def deviations(s: SparkSession, d: str) -> DataFrame:
    rows = written(anomaly.as_models(anomaly.with_zscores(written(series(s, d), "series"), CFG), CFG), "models")
    return ensemble.kind(ensemble.severity(ensemble.impact(ensemble.combine(rows, TWO)), TWO))


DEVIATIONS = ZSQL + """, t AS (SELECT *, least(abs(z_brand) / 4, 1) AS p, least(abs(z_brand_hour) / 4, 1) AS i, conv_mean_brand AS expected_conversion FROM z),
e AS (SELECT *, p * 0.6::DOUBLE + i * 0.4::DOUBLE AS ensemble_score, ((abs(z_brand) >= 1.1)::INTEGER + (abs(z_brand_hour) >= 1.1)::INTEGER)::INTEGER AS n_models_flagged FROM t),
g AS (SELECT *, n_models_flagged / 2.0::DOUBLE AS confidence, ensemble_score > 0.25 AS is_anomaly FROM e),
s AS (SELECT *, CASE WHEN ensemble_score >= 0.5 THEN 'critical' WHEN ensemble_score >= 0.4 THEN 'high' WHEN ensemble_score >= 0.3 THEN 'medium' WHEN ensemble_score >= 0.2 THEN 'low' ELSE 'normal' END AS severity,
  CASE WHEN is_anomaly AND conversion_rate > 1.2 * expected_conversion THEN 'spike' WHEN is_anomaly AND conversion_rate < 0.8 * expected_conversion THEN 'drop' WHEN is_anomaly THEN 'anomaly' ELSE 'none' END AS anomaly_type,
  (purchases - views * expected_conversion) * coalesce(CASE WHEN purchases > 0 THEN revenue / purchases END, CASE WHEN views > 0 THEN revenue / views END, 0) AS revenue_impact, views * expected_conversion - purchases AS conversion_loss FROM g)"""
add("deviation_ensemble", lambda s, d: deviations(s, d).select("brand", "window_start", "ensemble_score", "n_models_flagged", "confidence", "is_anomaly", "severity", "anomaly_type", "revenue_impact", "conversion_loss"), DEVIATIONS + "\nFINAL SELECT brand, window_start, ensemble_score, n_models_flagged, confidence, is_anomaly, severity, anomaly_type, revenue_impact, conversion_loss FROM s", ("ensemble_score", "revenue_impact", "conversion_loss"))
add("deviation_dashboard", lambda s, d: ensemble.dashboard(deviations(s, d)), DEVIATIONS + ", w AS (SELECT brand, window_start FROM s WHERE is_anomaly ORDER BY abs(revenue_impact) DESC, brand, window_start LIMIT 1)\nFINAL SELECT count(*) AS anomalies, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high, sum(revenue_impact) AS revenue_impact, (SELECT brand FROM w) AS worst_brand, (SELECT window_start FROM w) AS worst_window FROM s WHERE is_anomaly", ("revenue_impact",))
for _by in ("severity", "anomaly_type"):
    add(f"deviation_impact_by_{_by}", lambda s, d, by=_by: ensemble.assessment(deviations(s, d), by), DEVIATIONS + f"\nFINAL SELECT {_by}, count(*) AS n, sum(revenue_impact) AS revenue_impact, avg(revenue_impact) AS mean_revenue_impact, sum(conversion_loss) AS conversion_loss FROM s WHERE is_anomaly GROUP BY 1", ("revenue_impact", "mean_revenue_impact", "conversion_loss"))
add("deviation_correlation", lambda s, d: ensemble.score_correlations(deviations(s, d), "brand_anomaly_score", "brand_hour_anomaly_score"), DEVIATIONS + "\nFINAL SELECT corr(p, i) AS brand_anomaly_score__brand_hour_anomaly_score FROM s", ("brand_anomaly_score__brand_hour_anomaly_score",))
