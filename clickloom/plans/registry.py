"""The registered queries over the test tables, and their SQL.

Doubles are rounded to six places on both sides. Anomaly queries run on six-hour windows by category with low
thresholds, because the test tables never reach the production ones at an hourly grain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, ensemble, features, funnel, rca, reports
from ..settings import Features, ZScore
from ..sources import events, scratch, sinks
from ..streaming import funnel as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CFG = ZScore(min_baseline_views=1, min_flag_views=2, threshold=1.1)
FEATURES = Features(rolling_hours=(168,), lag_rows=(1, 4))
RATES = ("view_to_cart_rate", "cart_to_purchase_rate", "conversion_rate")
GOLD = ("revenue", *RATES)


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n, t in df.dtypes if t == "double"})


def add(name: str, plan: Callable[[SparkSession, str], DataFrame], sql: str | None = None, floats: tuple[str, ...] = ()) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(plan(spark, sf_dir))
    if sql:
        body = sql.strip().removeprefix("WITH ")
        head, _, last = body.rpartition("\nFINAL ")
        replace = f" REPLACE ({', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in floats)})" if floats else ""
        ORACLES[name] = f"WITH {head}\nSELECT *{replace} FROM ({last})"


def raw(s: SparkSession, d: str) -> DataFrame:
    return events.from_test_tables(s, d)


def silver(s: SparkSession, d: str) -> DataFrame:
    return funnel.dedup(funnel.clean(raw(s, d)))


def hourly_brand(s: SparkSession, d: str) -> DataFrame:
    return funnel.hourly_brand(silver(s, d))


def daily_brand(s: SparkSession, d: str) -> DataFrame:
    return funnel.daily_brand(silver(s, d))


def daily_category(s: SparkSession, d: str) -> DataFrame:
    return funnel.daily_category(silver(s, d))


def price_bands(s: SparkSession, d: str) -> DataFrame:
    return funnel.hourly_price_band(silver(s, d))


def series(s: SparkSession, d: str) -> DataFrame:
    return funnel.windowed(funnel.enrich(silver(s, d)), F.col("category_root").alias("brand"), "6 hours")


def written(df: DataFrame, name: str) -> DataFrame:
    """As a table: what reads a gold table several times reads it there, and not its events again."""
    return scratch.save(df, name)


def scores(s: SparkSession, d: str) -> DataFrame:
    """The series with made-up model scores, the same in SQL."""
    rows = series(s, d).filter("brand IS NOT NULL")
    made = rows.withColumns({
        "prophet_anomaly_score": ((F.col("views") * 37) % 101) / 100, "isolation_forest_anomaly_score": ((F.col("carts") * 53 + F.col("views") * 7) % 101) / 100,
        "changepoint_anomaly_score": F.when(F.col("purchases") % 3 != 0, ((F.col("purchases") * 71) % 101) / 100),
        "is_at_changepoint": F.col("purchases") % 7 == 0, "brand_avg_conversion": F.lit(0.9),
    })
    flags = {f"{m}_is_anomaly": F.col(f"{m}_anomaly_score") > 0.6 for m in ("prophet", "isolation_forest", "changepoint")}
    return ensemble.kind(ensemble.severity(ensemble.impact(ensemble.combine(made.withColumns(flags)))))


BASE = r"""
WITH raw AS (
  SELECT ts AS event_time, CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart' WHEN 'error' THEN 'remove_from_cart' ELSE event_type END AS event_type,
    k AS product_id, k % 6 AS category_id, value AS price, user_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS user_session, CAST(ts AS DATE) AS event_date,
    CASE WHEN k % 10 <> 0 THEN p_brand END AS brand, lower(p_type) AS category_code
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) LEFT JOIN part ON p_partkey = k),
cleaned AS (
  SELECT *, lower(brand) AS brand_norm, regexp_replace(lower(category_code), '[^a-z0-9\.]', '_', 'g') AS category_code_norm,
    user_session IS NULL AS dq_missing_session, brand IS NULL AS dq_missing_brand, category_code IS NULL AS dq_missing_category
  FROM raw WHERE price > 0 AND event_time IS NOT NULL AND event_type IS NOT NULL),
silver AS (SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY event_time, user_id, user_session, product_id, event_type ORDER BY price) = 1),
enriched AS (
  SELECT *, split_part(category_code_norm, '.', 1) AS category_root,
    CASE WHEN price < 10 THEN '<10' WHEN price < 30 THEN '10-30' WHEN price < 60 THEN '30-60' ELSE '60_plus' END AS price_band,
    time_bucket(INTERVAL 1 HOUR, event_time) AS hour_start, time_bucket(INTERVAL 6 HOUR, event_time) AS six_start FROM silver)"""


def _rates(scale: str = "") -> str:
    return f"""CASE WHEN views > 0 THEN carts{scale} / views END AS view_to_cart_rate, CASE WHEN carts > 0 THEN purchases{scale} / carts END AS cart_to_purchase_rate,
    CASE WHEN views > 0 THEN purchases{scale} / views END AS conversion_rate"""


def _gold(name: str, start: str | None, dim: str, alias: str, width: str = "1 HOUR") -> str:
    times = f"{start} AS window_start, {start} + INTERVAL {width} AS window_end, CAST({start} AS DATE) AS window_date" if start else "event_date AS date"
    return f"""{name} AS (SELECT *, {_rates()} FROM (
  SELECT {times}, {dim} AS {alias}, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS carts,
    count(*) FILTER (event_type = 'purchase') AS purchases, sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue FROM enriched GROUP BY ALL))"""


HOURLY = BASE + ",\n" + _gold("gold", "hour_start", "brand_norm", "brand")
DAILY_BRAND = BASE + ",\n" + _gold("gold", None, "brand_norm", "brand")
DAILY_CATEGORY = BASE + ",\n" + _gold("gold", None, "category_root", "category_root")
BANDS = BASE + ",\n" + _gold("gold", "hour_start", "price_band", "price_band")
SERIES = BASE + ",\n" + _gold("gold", "six_start", "category_root", "brand", "6 HOUR")
SUMS = "sum(views)::BIGINT AS views, sum(carts)::BIGINT AS carts, sum(purchases)::BIGINT AS purchases, sum(revenue) AS revenue"

# Bronze to gold.
EVENT = "event_time, event_type, product_id, category_id, price, user_id, user_session, event_date, brand, category_code"
add("silver_clean", lambda s, d: funnel.clean(raw(s, d)), BASE + f"\nFINAL SELECT {EVENT}, brand_norm, category_code_norm, dq_missing_session, dq_missing_brand, dq_missing_category FROM cleaned", ("price",))
add("silver_dedup", lambda s, d: funnel.dedup(funnel.clean(raw(s, d).withColumn("price", F.col("price") + 1.0).filter("product_id < 10 AND price > 1").union(raw(s, d)).union(raw(s, d).filter("product_id < 5")))).select(*funnel.DEDUP_KEY, "price", "brand_norm"), BASE + "\nFINAL SELECT event_time, user_id, user_session, product_id, event_type, price, brand_norm FROM silver", ("price",))
add("silver_enriched", lambda s, d: funnel.enrich(silver(s, d)).select("event_time", "user_id", "event_type", "category_root", "price_band"), BASE + "\nFINAL SELECT event_time, user_id, event_type, category_root, price_band FROM enriched")
add("gold_hourly_brand", hourly_brand, HOURLY + "\nFINAL SELECT * FROM gold", GOLD)
add("gold_daily_brand", daily_brand, DAILY_BRAND + "\nFINAL SELECT * FROM gold", GOLD)
add("gold_daily_category", daily_category, DAILY_CATEGORY + "\nFINAL SELECT * FROM gold", GOLD)
add("gold_hourly_price_band", price_bands, BANDS + "\nFINAL SELECT * FROM gold", GOLD)
add("json_roundtrip", lambda s, d: events.parse_messages(events.to_messages(silver(s, d))).select("event_type", "user_id", "user_session", "product_id", "category_id", "category_code", "brand", "price", "event_date"), BASE + "\nFINAL SELECT event_type, user_id, user_session, product_id, category_id, category_code, brand, price, event_date FROM silver", ("price",))
add("synthetic_events", lambda s, d: reports.event_type_counts(events.synthetic(s)), "WITH g AS (SELECT range AS i FROM range(1000))\nFINAL SELECT CASE WHEN i % 3 <> 0 THEN 'view' ELSE 'purchase' END AS event_type, count(*) AS n FROM g GROUP BY 1")
add("date_slice", lambda s, d: events.between_dates(silver(s, d), "2024-01-05", "2024-01-09").filter(F.col("event_type").isin("view", "purchase")).groupBy("event_date").agg(F.count(F.lit(1)).alias("n")), BASE + "\nFINAL SELECT event_date, count(*) AS n FROM silver WHERE event_date BETWEEN '2024-01-05' AND '2024-01-09' AND event_type IN ('view', 'purchase') GROUP BY 1")

# Reports.
PCT = "CASE WHEN views > 0 THEN carts * 100.0 / views END AS view_to_cart_pct, CASE WHEN carts > 0 THEN purchases * 100.0 / carts END AS cart_to_purchase_pct, CASE WHEN views > 0 THEN purchases * 100.0 / views END AS conversion_pct"
PCTS = ("view_to_cart_pct", "cart_to_purchase_pct", "conversion_pct")
KPI = f"""kpi AS (SELECT *, {PCT}, CASE WHEN purchases > 0 THEN revenue / purchases END AS avg_order_value FROM (SELECT brand, {SUMS} FROM gold WHERE brand IS NOT NULL GROUP BY 1))"""
ALL = f"one AS (SELECT *, {PCT} FROM (SELECT {SUMS} FROM gold))"
add("overall_funnel", lambda s, d: reports.overall_funnel(daily_brand(s, d)), f"{DAILY_BRAND},\n{ALL}\nFINAL SELECT * FROM one", ("revenue", *PCTS))
add("event_type_counts", lambda s, d: reports.event_type_counts(silver(s, d)), BASE + "\nFINAL SELECT event_type, count(*) AS n FROM silver GROUP BY 1")
add("date_range", lambda s, d: reports.date_range(hourly_brand(s, d)), HOURLY + "\nFINAL SELECT min(window_date) AS first_date, max(window_date) AS last_date, count(*) AS windows FROM gold")
add("table_stats", lambda s, d: reports.table_stats({"silver": silver(s, d), "daily_brand": daily_brand(s, d)}), DAILY_BRAND + "\nFINAL SELECT 'silver' AS table_name, count(*) AS n_rows, 15 AS n_columns FROM silver UNION ALL SELECT 'daily_brand', count(*), 9 FROM gold")
add("top_brands", lambda s, d: reports.top_brands(daily_brand(s, d)), DAILY_BRAND + "\nFINAL SELECT brand, sum(revenue) AS revenue, sum(views)::BIGINT AS views, sum(purchases)::BIGINT AS purchases FROM gold WHERE brand IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", ("revenue",))
add("category_performance", lambda s, d: reports.category_performance(daily_category(s, d)), f"{DAILY_CATEGORY},\nt AS (SELECT coalesce(category_root, 'Unknown') AS category_root, {SUMS} FROM gold GROUP BY 1)\nFINAL SELECT *, CASE WHEN views > 0 THEN purchases * 100.0 / views END AS conversion_pct FROM t", ("revenue", "conversion_pct"))
BAND = f"t AS (SELECT price_band, {SUMS} FROM gold GROUP BY 1), band AS (SELECT *, CASE WHEN views > 0 THEN purchases * 100.0 / views END AS conversion_pct, (list_position(['<10', '10-30', '30-60', '60_plus'], price_band) - 1)::INTEGER AS band_order FROM t)"
add("price_band_performance", lambda s, d: reports.price_band_performance(price_bands(s, d)), f"{BANDS},\n{BAND}\nFINAL SELECT * FROM band", ("revenue", "conversion_pct"))
add("price_band_ordered", lambda s, d: reports.price_band_performance(price_bands(s, d)).orderBy("band_order").select("price_band", "band_order"), f"{BANDS},\n{BAND}\nFINAL SELECT price_band, band_order FROM band ORDER BY band_order")
add("daily_price_ratio_of_sums", lambda s, d: reports.daily_price_ratio_of_sums(price_bands(s, d)), BANDS + "\nFINAL SELECT window_date, price_band, CASE WHEN sum(views) > 0 THEN sum(purchases)::DOUBLE / sum(views) END AS conversion_rate FROM gold GROUP BY 1, 2", ("conversion_rate",))
add("daily_price_mean_of_rates", lambda s, d: reports.daily_price_mean_of_rates(price_bands(s, d)), BANDS + "\nFINAL SELECT window_date, price_band, avg(conversion_rate) AS conversion_rate FROM gold GROUP BY 1, 2", ("conversion_rate",))
add("brand_kpis", lambda s, d: reports.brand_kpis(daily_brand(s, d)), f"{DAILY_BRAND},\n{KPI}\nFINAL SELECT * FROM kpi", ("revenue", *PCTS, "avg_order_value"))
add("revenue_concentration", lambda s, d: reports.revenue_concentration(daily_brand(s, d)), f"{DAILY_BRAND},\n{KPI}, t AS (SELECT revenue FROM kpi ORDER BY revenue DESC LIMIT 10), u AS (SELECT (SELECT sum(revenue) FROM t) AS top_revenue, (SELECT sum(revenue) FROM kpi) AS total_revenue)\nFINAL SELECT *, top_revenue * 100.0 / total_revenue AS top_share_pct FROM u", ("top_revenue", "total_revenue", "top_share_pct"))
add("brand_quadrants", lambda s, d: reports.brand_quadrants(daily_brand(s, d)), f"{DAILY_BRAND},\n{KPI}, m AS (SELECT avg(views) AS mv, avg(conversion_pct) AS mc FROM kpi), t AS (SELECT brand, views, conversion_pct, CASE WHEN views > mv AND conversion_pct < mc THEN 'fix_conversion' WHEN views < mv AND conversion_pct > mc THEN 'grow_traffic' END AS quadrant FROM kpi, m)\nFINAL SELECT * FROM t WHERE quadrant IS NOT NULL", ("conversion_pct",))
add("underperforming_brands", lambda s, d: reports.underperforming(daily_brand(s, d), 10), f"{DAILY_BRAND},\n{KPI}, k AS (SELECT brand, views, carts, purchases, revenue, conversion_pct FROM kpi WHERE views >= 10 AND conversion_pct IS NOT NULL), c AS (SELECT quantile_disc(conversion_pct, 0.25) AS cut FROM k)\nFINAL SELECT k.* FROM k, c WHERE conversion_pct < cut", ("revenue", "conversion_pct"))
add("revenue_impact", lambda s, d: reports.revenue_impact(daily_brand(s, d)), f"{DAILY_BRAND},\n{ALL}, t AS (SELECT *, conversion_pct * 1.1::DOUBLE AS target_pct FROM one), u AS (SELECT *, views * target_pct / 100 - purchases AS additional_purchases FROM t)\nFINAL SELECT conversion_pct, target_pct, additional_purchases, additional_purchases * (revenue / purchases) AS potential_revenue FROM u", ("conversion_pct", "target_pct", "additional_purchases", "potential_revenue"))
add("funnel_drop", lambda s, d: reports.funnel_drop(daily_brand(s, d)), f"{DAILY_BRAND},\n{ALL}\nFINAL SELECT *, views - carts AS view_to_cart_loss, carts - purchases AS cart_to_purchase_loss, CASE WHEN views - carts > carts - purchases THEN 'view_to_cart' ELSE 'cart_to_purchase' END AS biggest_drop FROM one", ("revenue", *PCTS))
BEST = "(SELECT {n} FROM {t} ORDER BY coalesce(conversion_pct, -1) DESC, {n} LIMIT 1) AS best_conversion, (SELECT {n} FROM {t} ORDER BY revenue DESC, {n} LIMIT 1) AS top_revenue, (SELECT count(*) FROM {t}) AS n"
add("category_insights", lambda s, d: reports.best_of(reports.category_performance(daily_category(s, d)), "category_root"), f"{DAILY_CATEGORY},\nt AS (SELECT coalesce(category_root, 'Unknown') AS category_root, {SUMS} FROM gold GROUP BY 1), c AS (SELECT *, CASE WHEN views > 0 THEN purchases * 100.0 / views END AS conversion_pct FROM t)\nFINAL SELECT {BEST.format(n='category_root', t='c')}")
add("price_band_insights", lambda s, d: reports.best_of(reports.price_band_performance(price_bands(s, d)), "price_band"), f"{BANDS},\n{BAND}\nFINAL SELECT {BEST.format(n='price_band', t='band')}")
add("pivot_daily_revenue", lambda s, d: reports.pivot_daily_revenue(price_bands(s, d)), BANDS + "\nFINAL SELECT window_date, " + ", ".join(f"coalesce(sum(revenue) FILTER (price_band = '{b}'), 0) AS {n}" for b, n in (("<10", "under_10"), ("10-30", "from_10_to_30"), ("30-60", "from_30_to_60"), ("60_plus", "from_60"))) + " FROM gold GROUP BY 1", ("under_10", "from_10_to_30", "from_30_to_60", "from_60"))
add("top_brand_trend", lambda s, d: reports.top_brand_trend(daily_brand(s, d)), f"{DAILY_BRAND},\n{KPI}, t AS (SELECT brand FROM kpi ORDER BY revenue DESC, brand LIMIT 5)\nFINAL SELECT date, brand, sum(revenue) AS revenue FROM gold SEMI JOIN t USING (brand) GROUP BY 1, 2", ("revenue",))
add("brand_list", lambda s, d: hourly_brand(s, d).filter("brand IS NOT NULL").select("brand").distinct().orderBy("brand"), HOURLY + "\nFINAL SELECT DISTINCT brand FROM gold WHERE brand IS NOT NULL ORDER BY 1")

# Z-score anomalies.
Z = """
r AS (SELECT *, hour(window_start)::INTEGER AS hour_of_day FROM gold WHERE views >= 1 AND brand IS NOT NULL),
b AS (SELECT *, avg(conversion_rate) OVER x AS conv_mean_brand, stddev_samp(conversion_rate) OVER x AS conv_std_brand, avg(conversion_rate) OVER y AS conv_mean_brand_hour, stddev_samp(conversion_rate) OVER y AS conv_std_brand_hour
  FROM r WINDOW x AS (PARTITION BY brand), y AS (PARTITION BY brand, hour_of_day)),
z AS (SELECT *, coalesce(CASE WHEN conv_std_brand IS NULL OR conv_std_brand = 0 THEN 0 ELSE round((conversion_rate - conv_mean_brand) / conv_std_brand, 9) END, 0) AS z_brand,
  coalesce(CASE WHEN conv_std_brand_hour IS NULL OR conv_std_brand_hour = 0 THEN 0 ELSE round((conversion_rate - conv_mean_brand_hour) / conv_std_brand_hour, 9) END, 0) AS z_brand_hour FROM b),
f AS (SELECT *, views >= 2 AND (z_brand <= -1.1 OR z_brand_hour <= -1.1) AS is_drop_anomaly, views >= 2 AND (z_brand >= 1.1 OR z_brand_hour >= 1.1) AS is_spike_anomaly FROM z),
a AS (SELECT *, CASE WHEN is_drop_anomaly THEN 'drop' ELSE 'spike' END AS anomaly_type FROM f WHERE is_drop_anomaly OR is_spike_anomaly)"""
ZS = ("conv_mean_brand", "conv_std_brand", "conv_mean_brand_hour", "conv_std_brand_hour", "z_brand", "z_brand_hour")


def found(s: SparkSession, d: str) -> DataFrame:
    return anomaly.zscore_anomalies(written(series(s, d), "series"), CFG)


def overlaid(s: SparkSession, d: str) -> DataFrame:
    gold = written(series(s, d), "series")
    return anomaly.overlay(gold, anomaly.zscore_anomalies(gold, CFG))


ZSQL = f"{SERIES},{Z}"
COUNTS = "count(*) AS n, count(*) FILTER (anomaly_type = 'drop') AS drops, count(*) FILTER (anomaly_type = 'spike') AS spikes"
SHOW = "brand, window_start, views, conversion_rate, z_brand"
add("anomaly_baselines", lambda s, d: anomaly.with_zscores(written(series(s, d), "series"), CFG), ZSQL + "\nFINAL SELECT * FROM z", (*GOLD, *ZS))
add("anomalies_zscore", found, ZSQL + "\nFINAL SELECT * FROM a", (*GOLD, *ZS))
add("top_drops", lambda s, d: anomaly.worst_drops(found(s, d)).select(*SHOW.split(", ")), ZSQL + f"\nFINAL SELECT {SHOW} FROM a WHERE anomaly_type = 'drop' ORDER BY z_brand, brand, window_start LIMIT 10", ("conversion_rate", "z_brand"))
add("top_spikes", lambda s, d: anomaly.top_spikes(found(s, d)).select(*SHOW.split(", ")), ZSQL + f"\nFINAL SELECT {SHOW} FROM a WHERE anomaly_type = 'spike' ORDER BY z_brand DESC, brand, window_start LIMIT 10", ("conversion_rate", "z_brand"))
for _name, _by in (("type", "anomaly_type"), ("brand", "brand"), ("day", "window_date"), ("hour", "hour_of_day")):
    add(f"anomalies_by_{_name}", lambda s, d, by=_by: anomaly.count_by(found(s, d), by), f"{ZSQL}\nFINAL SELECT {_by}, {COUNTS} FROM a GROUP BY 1")
add("anomaly_pattern", lambda s, d: anomaly.pattern(found(s, d)), f"{ZSQL}, o AS (SELECT {COUNTS}, avg(abs(z_brand)) AS mean_abs_z, count(DISTINCT coalesce(brand, '')) AS brands FROM a)\nFINAL SELECT *, (SELECT hour_of_day FROM a GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour, drops * 100.0 / n AS drop_pct, spikes * 100.0 / n AS spike_pct FROM o", ("mean_abs_z", "drop_pct", "spike_pct"))
add("severity_labels", lambda s, d: anomaly.severity_label(found(s, d)).select("brand", "window_start", "severity"), ZSQL + "\nFINAL SELECT brand, window_start, CASE WHEN abs(z_brand) > 3 THEN 'High' WHEN abs(z_brand) > 2.5 THEN 'Medium' ELSE 'Low' END AS severity FROM a")
add("overlay_brand_anomalies", lambda s, d: overlaid(s, d), ZSQL + "\nFINAL SELECT gold.brand, gold.window_start, gold.conversion_rate, a.anomaly_type FROM gold LEFT JOIN a ON gold.brand = a.brand AND gold.window_start = a.window_start", ("conversion_rate",))
NATIVE = """, n AS (SELECT *, z_brand AS z_score, abs(z_brand) AS size FROM z)"""
add("native_anomalies", lambda s, d: anomaly.native(written(series(s, d), "series"), CFG).select("brand", "window_start", "z_score", "ensemble_score", "anomaly_type", "severity", "is_anomaly", "confidence", "expected_conversion", "deviation_pct", "conversion_loss", "revenue_impact"), ZSQL + NATIVE + """
FINAL SELECT brand, window_start, z_score, (CASE WHEN size > 3 THEN 1.0 WHEN size > 2.5 THEN 0.8 WHEN size > 2 THEN 0.6 WHEN size > 1.5 THEN 0.4 ELSE 0 END)::DOUBLE AS ensemble_score,
  CASE WHEN z_score <= -1.1 THEN 'drop' WHEN z_score >= 1.1 THEN 'spike' ELSE 'none' END AS anomaly_type, CASE WHEN size >= 3 THEN 'critical' WHEN size >= 2.5 THEN 'high' WHEN size >= 2 THEN 'medium' WHEN size >= 1.5 THEN 'low' ELSE 'normal' END AS severity,
  views >= 2 AND size >= 1.1 AS is_anomaly, (CASE WHEN views >= 200 THEN 0.9 WHEN views >= 100 THEN 0.7 WHEN views >= 50 THEN 0.5 ELSE 0.3 END)::DOUBLE AS confidence, conv_mean_brand AS expected_conversion,
  CASE WHEN conv_mean_brand > 0 THEN (conversion_rate - conv_mean_brand) / conv_mean_brand * 100 ELSE 0 END AS deviation_pct, (conv_mean_brand - conversion_rate) * views AS conversion_loss, (conv_mean_brand - conversion_rate) * views * 50 AS revenue_impact FROM n""", ("z_score", "expected_conversion", "deviation_pct", "conversion_loss", "revenue_impact"))

# Features.
TIME = "hour(window_start)::INTEGER AS hour_of_day, (dayofweek(window_start) + 1)::INTEGER AS day_of_week, (dayofweek(window_start) IN (0, 6))::INTEGER AS is_weekend, day(window_start)::INTEGER AS day_of_month, month(window_start)::INTEGER AS month, (hour(window_start) BETWEEN 9 AND 16)::INTEGER AS is_business_hours"
add("features_time", lambda s, d: features.time_features(series(s, d)).select("brand", "window_start", "hour_of_day", "day_of_week", "is_weekend", "day_of_month", "month", "is_business_hours"), f"{SERIES}\nFINAL SELECT brand, window_start, {TIME} FROM gold")
FUNNEL = "fu AS (SELECT brand, window_start, views, purchases, revenue, coalesce(view_to_cart_rate, 0) AS view_to_cart_rate, coalesce(cart_to_purchase_rate, 0) AS cart_to_purchase_rate, coalesce(conversion_rate, 0) AS conversion_rate, CASE WHEN views > 0 THEN revenue / views ELSE 0 END AS revenue_per_view, CASE WHEN purchases > 0 THEN revenue / purchases ELSE 0 END AS avg_order_value FROM gold)"
FUNNELS = ("revenue", *RATES, "revenue_per_view", "avg_order_value")
FEATURE_COLUMNS = ("brand", "window_start", "views", "purchases", *FUNNELS)


def funnel_rows(s: SparkSession, d: str) -> DataFrame:
    return features.funnel_features(series(s, d)).select(*FEATURE_COLUMNS)


add("features_funnel", funnel_rows, f"{SERIES},\n{FUNNEL}\nFINAL SELECT * FROM fu", FUNNELS)
ROLL = tuple(f"rolling_7d_avg_{c}" for c in ("conversion_rate", "views", "purchases", "revenue"))
add("features_rolling", lambda s, d: features.rolling_features(funnel_rows(s, d), FEATURES).select("brand", "window_start", *ROLL, "rolling_7d_std_conversion_rate"), f"{SERIES},\n{FUNNEL}\nFINAL SELECT brand, window_start, " + ", ".join(f"avg({c.removeprefix('rolling_7d_avg_')}) OVER w AS {c}" for c in ROLL) + ", stddev_samp(conversion_rate) OVER w AS rolling_7d_std_conversion_rate FROM fu WINDOW w AS (PARTITION BY brand ORDER BY window_start RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND CURRENT ROW)", (*ROLL, "rolling_7d_std_conversion_rate"))
LAGS = [f"{c}_lag_{n}h" for n in (1, 4) for c in ("conversion_rate", "views", "purchases")]
CHANGES = ("conversion_change_1h", "conversion_change_4h")
add("features_lag", lambda s, d: features.lag_features(funnel_rows(s, d), FEATURES).select("brand", "window_start", *LAGS, *CHANGES), f"{SERIES},\n{FUNNEL}, l AS (SELECT *, " + ", ".join(f"lag({c}, {n}) OVER w AS {c}_lag_{n}h" for n in (1, 4) for c in ("conversion_rate", "views", "purchases")) + f" FROM fu WINDOW w AS (PARTITION BY brand ORDER BY window_start))\nFINAL SELECT brand, window_start, {', '.join(LAGS)}, " + ", ".join(f"CASE WHEN conversion_rate_lag_{n}h <> 0 THEN (conversion_rate - conversion_rate_lag_{n}h) / conversion_rate_lag_{n}h ELSE 0 END AS conversion_change_{n}h" for n in (1, 4)) + " FROM l", ("conversion_rate_lag_1h", "conversion_rate_lag_4h", *CHANGES))
STAT = "st AS (SELECT *, avg(conversion_rate) OVER w AS brand_avg_conversion, stddev_samp(conversion_rate) OVER w AS brand_std_conversion, min(conversion_rate) OVER w AS brand_min_conversion, max(conversion_rate) OVER w AS brand_max_conversion FROM fu WINDOW w AS (PARTITION BY brand)), sz AS (SELECT *, CASE WHEN brand_std_conversion IS NULL OR brand_std_conversion = 0 THEN 0 ELSE round((conversion_rate - brand_avg_conversion) / brand_std_conversion, 9) END AS conversion_zscore FROM st WHERE brand IS NOT NULL)"
STATS = ("brand_avg_conversion", "brand_std_conversion", "brand_min_conversion", "brand_max_conversion", "conversion_zscore", "conversion_percentile")
add("features_stat", lambda s, d: features.statistical_features(funnel_rows(s, d)).select("brand", "window_start", *STATS), f"{SERIES},\n{FUNNEL}, {STAT}\nFINAL SELECT brand, window_start, {', '.join(STATS[:-1])}, (conversion_zscore + 3) / 6 AS conversion_percentile FROM sz", STATS)
INTER = ("view_velocity", "weekend_conversion_effect", "business_hours_conversion_effect")
add("features_interaction", lambda s, d: features.interaction_features(features.time_features(funnel_rows(s, d))).select("brand", "window_start", *INTER), f"{SERIES},\n{FUNNEL}, t AS (SELECT *, {TIME} FROM fu)\nFINAL SELECT brand, window_start, views * 24.0 / (hour_of_day + 1) AS view_velocity, conversion_rate * is_weekend AS weekend_conversion_effect, conversion_rate * is_business_hours AS business_hours_conversion_effect FROM t", INTER)
add("train_split", lambda s, d: features.train_split(series(s, d)).select("brand", "window_start", "is_train"), f"{SERIES}, c AS (SELECT quantile_disc(window_start, 0.8) AS cut FROM gold)\nFINAL SELECT brand, window_start, window_start <= cut AS is_train FROM gold, c")

# Ensemble.
ENS = """,
m AS (SELECT *, ((views * 37) % 101) / 100.0::DOUBLE AS p, ((carts * 53 + views * 7) % 101) / 100.0::DOUBLE AS i, CASE WHEN purchases % 3 <> 0 THEN ((purchases * 71) % 101) / 100.0::DOUBLE END AS c, purchases % 7 = 0 AS at_point FROM gold WHERE brand IS NOT NULL),
e AS (SELECT *, p * (0.3::DOUBLE / 0.7::DOUBLE) + i * (0.25::DOUBLE / 0.7::DOUBLE) + coalesce(c, 0) * (0.15::DOUBLE / 0.7::DOUBLE) AS ensemble_score, ((p > 0.6)::INTEGER + (i > 0.6)::INTEGER + coalesce((c > 0.6)::INTEGER, 0))::INTEGER AS n_models_flagged FROM m),
g AS (SELECT *, n_models_flagged / 3.0::DOUBLE AS confidence, round(ensemble_score, 9) > 0.5 AS is_anomaly, 0.9::DOUBLE AS expected_conversion FROM e),
s AS (SELECT *, CASE WHEN ensemble_score >= 0.95 THEN 'critical' WHEN ensemble_score >= 0.85 THEN 'high' WHEN ensemble_score >= 0.7 THEN 'medium' WHEN ensemble_score >= 0.5 THEN 'low' ELSE 'normal' END AS severity,
  CASE WHEN is_anomaly AND conversion_rate > 1.2 * expected_conversion THEN 'spike' WHEN is_anomaly AND conversion_rate < 0.8 * expected_conversion THEN 'drop' WHEN at_point THEN 'changepoint' WHEN is_anomaly THEN 'anomaly' ELSE 'none' END AS anomaly_type,
  CASE WHEN expected_conversion > 0 THEN (conversion_rate - expected_conversion) / expected_conversion * 100 ELSE 0 END AS deviation_pct,
  (purchases - views * expected_conversion) * coalesce(CASE WHEN purchases > 0 THEN revenue / purchases END, CASE WHEN views > 0 THEN revenue / views END, 0) AS revenue_impact, views * expected_conversion - purchases AS conversion_loss FROM g)"""
ESQL = SERIES + ENS
add("ensemble_scores", lambda s, d: scores(s, d).select("brand", "window_start", "ensemble_score", "n_models_flagged", "confidence", "is_anomaly"), ESQL + "\nFINAL SELECT brand, window_start, ensemble_score, n_models_flagged, confidence, is_anomaly FROM s", ("ensemble_score", "confidence"))
add("ensemble_severity_type", lambda s, d: scores(s, d).select("brand", "window_start", "severity", "anomaly_type"), ESQL + "\nFINAL SELECT brand, window_start, severity, anomaly_type FROM s")
add("impact_metrics", lambda s, d: scores(s, d).select("brand", "window_start", "expected_conversion", "deviation_pct", "revenue_impact", "conversion_loss"), ESQL + "\nFINAL SELECT brand, window_start, expected_conversion, deviation_pct, revenue_impact, conversion_loss FROM s", ("deviation_pct", "revenue_impact", "conversion_loss"))
_SEV = ", ".join(f"count(*) FILTER (severity = '{x}') AS n_{x}" for x in ("normal", "low", "medium", "high", "critical"))
_TYP = ", ".join(f"count(*) FILTER (is_anomaly AND anomaly_type = '{x}') AS n_{x}" for x in ("drop", "spike", "changepoint", "anomaly"))
add("ensemble_summary", lambda s, d: ensemble.summary(scores(s, d)), ESQL + f"\nFINAL SELECT count(*) AS n, count(*) FILTER (is_anomaly) AS anomalies, {_SEV}, {_TYP}, avg(ensemble_score) AS mean_score, max(ensemble_score) AS max_score, avg(confidence) FILTER (is_anomaly) AS mean_confidence, sum(revenue_impact) FILTER (is_anomaly) AS revenue_impact, sum(conversion_loss) FILTER (is_anomaly) AS conversion_loss, count(*) FILTER (is_anomaly)::DOUBLE / count(*) AS anomaly_rate FROM s", ("mean_score", "max_score", "mean_confidence", "revenue_impact", "conversion_loss", "anomaly_rate"))
for _by in ("severity", "anomaly_type", "brand"):
    add(f"impact_by_{_by}", lambda s, d, by=_by: ensemble.assessment(scores(s, d), by), ESQL + f"\nFINAL SELECT {_by}, count(*) AS n, sum(revenue_impact) AS revenue_impact, avg(revenue_impact) AS mean_revenue_impact, sum(conversion_loss) AS conversion_loss FROM s WHERE is_anomaly GROUP BY 1", ("revenue_impact", "mean_revenue_impact", "conversion_loss"))
add("dashboard_summary", lambda s, d: ensemble.dashboard(scores(s, d)), ESQL + ", w AS (SELECT brand, window_start FROM s WHERE is_anomaly ORDER BY abs(revenue_impact) DESC, brand, window_start LIMIT 1)\nFINAL SELECT count(*) AS anomalies, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high, sum(revenue_impact) AS revenue_impact, (SELECT brand FROM w) AS worst_brand, (SELECT window_start FROM w) AS worst_window FROM s WHERE is_anomaly", ("revenue_impact",))
add("severity_filter", lambda s, d: ensemble.at_least(scores(s, d), "medium").select("brand", "window_start", "severity"), ESQL + "\nFINAL SELECT brand, window_start, severity FROM s WHERE severity IN ('medium', 'high', 'critical')")
add("top_anomalies", lambda s, d: ensemble.top(scores(s, d)).select("brand", "window_start", "revenue_impact"), ESQL + "\nFINAL SELECT brand, window_start, revenue_impact FROM s WHERE is_anomaly ORDER BY revenue_impact DESC, brand, window_start LIMIT 10", ("revenue_impact",))
add("report_export", lambda s, d: rca.export(scores(s, d).filter("is_anomaly"), "summary"), ESQL + "\nFINAL SELECT severity, count(*) AS n, sum(revenue_impact) AS revenue_impact FROM s WHERE is_anomaly GROUP BY 1", ("revenue_impact",))
add("model_score_corr", lambda s, d: ensemble.score_correlations(scores(s, d), "prophet_anomaly_score", "isolation_forest_anomaly_score"), ESQL + "\nFINAL SELECT corr(p, i) AS prophet_anomaly_score__isolation_forest_anomaly_score FROM s", ("prophet_anomaly_score__isolation_forest_anomaly_score",))


def causes(s: SparkSession, d: str) -> DataFrame:
    history = written(scores(s, d), "scores").withColumn("avg_order_value", F.when(F.col("purchases") > 0, F.col("revenue") / F.col("purchases")))
    return rca.priority(rca.root_causes(history.filter("is_anomaly"), history))


_METRICS = ("views", "conversion_rate", "carts", "revenue", "avg_order_value")
RCA = (
    ESQL
    + ", h AS (SELECT *, CASE WHEN purchases > 0 THEN revenue / purchases END AS avg_order_value FROM s), md AS (SELECT brand, "
    + ", ".join(f"median({m}) AS median_{m}" for m in _METRICS)
    + " FROM h GROUP BY 1), dv AS (SELECT h.*, "
    + ", ".join(f"CASE WHEN median_{m} > 0 THEN round(({m} - median_{m}) / median_{m} * 100, 6) ELSE 0 END AS {m}_deviation" for m in _METRICS)
    + " FROM h JOIN md USING (brand) WHERE is_anomaly), rk AS (SELECT *, list_sort(["
    + ", ".join(f"CASE WHEN {m}_deviation IS NOT NULL THEN {{'x': -abs({m}_deviation), 'metric': '{m}', 'd': {m}_deviation}} END" for m in _METRICS)
    + "]) AS every, list_filter(every, lambda x: x IS NOT NULL) AS o FROM dv)"
)
add("rca_report", lambda s, d: causes(s, d).select("brand", "window_start", *[f"{m}_deviation" for m in _METRICS], "is_off_peak", "is_business_hours", "is_weekend"), RCA + "\nFINAL SELECT brand, window_start, " + ", ".join(f"{m}_deviation" for m in _METRICS) + ", hour(window_start) < 6 OR hour(window_start) > 22 AS is_off_peak, hour(window_start) BETWEEN 9 AND 17 AS is_business_hours, dayofweek(window_start) IN (0, 6) AS is_weekend FROM dv", tuple(f"{m}_deviation" for m in _METRICS))
add("alert_report", lambda s, d: causes(s, d).select("brand", "window_start", "severity", "priority", "top_metrics"), RCA + "\nFINAL SELECT brand, window_start, severity, CASE WHEN severity = 'critical' OR abs(revenue_impact) > 10000 THEN 'high' WHEN severity = 'high' OR abs(revenue_impact) > 1000 THEN 'medium' ELSE 'low' END AS priority, array_to_string(list_transform(o[1:3], lambda x: x.metric), ',') AS top_metrics FROM rk")

# Streams, run over everything there is and compared with the batch result.
CLOSED = "window_start < (SELECT max(event_time) FROM silver) - INTERVAL 3 HOUR"


def stream_input(s: SparkSession, d: str, at: str, files: int = 4) -> None:
    """The events as files in order of time."""
    sinks.write_stream_input(raw(s, d).withColumn("event_time", F.col("event_time").cast("timestamp")), f"{at}/in", files)


def plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def streamed(s: SparkSession, d: str, make: Callable[[DataFrame], DataFrame], files_per_trigger: int | None = None) -> DataFrame:
    """make() over the events as a stream of files in order of time."""
    at = scratch.path(s, "stream")
    stream_input(s, d, at)
    schema = events.schema_of(s, f"{at}/in")
    streaming.run_available(make(events.file_stream(s, f"{at}/in", schema, files_per_trigger)), f"{at}/out", f"{at}/checkpoint")
    return plain_times(s.read.parquet(f"{at}/out"))


def closed(df: DataFrame, s: SparkSession, d: str, hours: int = 3) -> DataFrame:
    """Windows that the watermark has surely passed."""
    last = funnel.clean(raw(s, d)).agg(F.max("event_time").alias("last"))  # copies change no maximum
    return df.join(F.broadcast(last)).filter(F.col("window_start") < F.col("last") - F.expr(f"INTERVAL {hours} HOUR")).drop("last")


add("stream_tumbling_funnel", lambda s, d: closed(streamed(s, d, streaming.tumbling), s, d), HOURLY + f"\nFINAL SELECT * FROM gold WHERE {CLOSED}", GOLD)
add("stream_sliding", lambda s, d: closed(streamed(s, d, lambda x: streaming.sliding(x)), s, d), BASE + """, k AS (SELECT unnest(range(0, 12)) AS k), w AS (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * k) AS window_start, brand, price FROM raw, k)
FINAL SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, brand, count(*) AS views, sum(price) AS revenue FROM w WHERE window_start < (SELECT max(event_time) FROM silver) - INTERVAL 3 HOUR GROUP BY ALL""", ("revenue",))
add("batch_stream_parity", lambda s, d: reports.parity(closed(hourly_brand(s, d), s, d), closed(streamed(s, d, streaming.tumbling), s, d)).agg(F.count(F.lit(1)).alias("windows"), F.count_if(F.abs("views_diff") + F.abs("carts_diff") + F.abs("purchases_diff") + F.abs("revenue_diff") > 0).alias("differences")), HOURLY + f"\nFINAL SELECT count(*) AS windows, 0::BIGINT AS differences FROM gold WHERE {CLOSED}")
add("stream_batch_zscores", lambda s, d: streaming.batch_zscores(hourly_brand(s, d).select("brand", "window_start", "views"), 2.0).select("brand", "window_start", "views", "z_score"), HOURLY + ", t AS (SELECT brand, window_start, views, avg(views) OVER w AS m, stddev_samp(views) OVER w AS sd FROM gold WINDOW w AS (PARTITION BY brand)), u AS (SELECT brand, window_start, views, CASE WHEN sd IS NULL OR sd = 0 THEN 0 ELSE round((views - m) / sd, 9) END AS z_score FROM t)\nFINAL SELECT * FROM u WHERE abs(z_score) > 2", ("z_score",))

from . import rebuilds, routes, stateful  # noqa: E402, F401  registers the routes, streams and models
