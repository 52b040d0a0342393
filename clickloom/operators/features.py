"""Feature stages over a brand's hourly series, composed with DataFrame.transform.

Windows are by brand and time: the rolling and lag stages share one sort of each brand's series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr
from ..settings import Features
from ..sources.events import require_columns, with_columns_or
from . import ranks


def time_features(df: DataFrame) -> DataFrame:
    t, hour, day = F.col("window_start"), F.hour("window_start"), F.dayofweek("window_start")
    return df.withColumns({"hour_of_day": hour, "day_of_week": day, "is_weekend": day.isin(1, 7).cast("int"), "day_of_month": F.dayofmonth(t), "month": F.month(t), "is_business_hours": ((hour >= 9) & (hour < 17)).cast("int")})


def funnel_features(df: DataFrame) -> DataFrame:
    """0, not null, where there is nothing to divide by."""
    def zero(a, b):
        return F.coalesce(expr.ratio(a, b), F.lit(0.0))

    return df.withColumns({"view_to_cart_rate": zero("carts", "views"), "cart_to_purchase_rate": zero("purchases", "carts"), "conversion_rate": zero("purchases", "views"), "revenue_per_view": zero("revenue", "views"), "avg_order_value": zero("revenue", "purchases")})


def rolling_features(df: DataFrame, cfg: Features = Features()) -> DataFrame:
    """Means (and the deviation of the conversion) over the last hours, both ends included."""
    out = {}
    for hours in cfg.rolling_hours:
        w = Window.partitionBy("brand").orderBy(F.unix_timestamp("window_start")).rangeBetween(-hours * 3600, 0)
        name = f"rolling_{hours // 24}d"
        out |= {f"{name}_avg_{c}": F.avg(c).over(w) for c in ("conversion_rate", "views", "purchases", "revenue")}
        out[f"{name}_std_conversion_rate"] = F.stddev_samp("conversion_rate").over(w)
    return df.withColumns(out)


def lag_features(df: DataFrame, cfg: Features = Features()) -> DataFrame:
    """Values so many rows (not hours) back, and the relative change of the conversion."""
    w = Window.partitionBy("brand").orderBy("window_start")
    out = df.withColumns({f"{c}_lag_{n}h": F.lag(c, n).over(w) for n in cfg.lag_rows for c in ("conversion_rate", "views", "purchases")})
    change = {}
    for n in cfg.lag_rows:
        before = F.col(f"conversion_rate_lag_{n}h")
        change[f"conversion_change_{n}h"] = F.when(before.isNotNull() & (before != 0), (F.col("conversion_rate") - before) / before).otherwise(0.0)
    return out.withColumns(change)


def statistical_features(df: DataFrame) -> DataFrame:
    stats = df.groupBy("brand").agg(F.avg("conversion_rate").alias("brand_avg_conversion"), F.stddev_samp("conversion_rate").alias("brand_std_conversion"), F.min("conversion_rate").alias("brand_min_conversion"), F.max("conversion_rate").alias("brand_max_conversion"))
    out = df.join(stats, "brand").withColumn("conversion_zscore", expr.zscore(F.col("conversion_rate"), F.col("brand_avg_conversion"), F.col("brand_std_conversion")))
    return out.withColumn("conversion_percentile", (F.col("conversion_zscore") + 3) / 6)


def interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"view_velocity": F.col("views") * 24 / (F.col("hour_of_day") + 1), "weekend_conversion_effect": F.col("conversion_rate") * F.col("is_weekend"), "business_hours_conversion_effect": F.col("conversion_rate") * F.col("is_business_hours")})


def all_features(df: DataFrame, cfg: Features = Features()) -> DataFrame:
    rows = with_columns_or(require_columns(df, "brand", "window_start", "views", "purchases"), carts=0, revenue=0.0)
    return rows.transform(time_features).transform(funnel_features).transform(rolling_features, cfg).transform(lag_features, cfg).transform(statistical_features).transform(interaction_features)


def train_split(df: DataFrame, share: float = 0.8) -> DataFrame:
    """is_train: the earliest share of all windows.

    The cut is a quantile of time (a grouped count of distinct windows), so no task sorts the whole table.
    """
    cut = df.agg(F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY unix_timestamp(window_start))").alias("cut"))
    return df.join(F.broadcast(cut)).withColumn("is_train", F.unix_timestamp("window_start") <= F.col("cut")).drop("cut")


def train_rows(df: DataFrame, share: float = 0.8) -> DataFrame:
    """is_train: exactly floor(share * n) rows, the first ones by window and brand, whatever windows they cut."""
    return ranks.first_share(df, [F.col("window_start"), F.col("brand")], share)
