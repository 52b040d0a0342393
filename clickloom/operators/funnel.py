"""Cleaning, de-duplication and funnel aggregates; the same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr

DEDUP_KEY = ("event_time", "user_id", "user_session", "product_id", "event_type")


#: What cleaning adds, and the columns that each is made from.
DERIVED = {"brand_norm": "brand", "category_code_norm": "category_code", "dq_missing_session": "user_session", "dq_missing_brand": "brand", "dq_missing_category": "category_code"}


def derive(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "brand_norm": F.lower("brand"), "category_code_norm": expr.category_norm(F.col("category_code")),
        "dq_missing_session": F.col("user_session").isNull(), "dq_missing_brand": F.col("brand").isNull(), "dq_missing_category": F.col("category_code").isNull(),
    })


def clean(raw: DataFrame) -> DataFrame:
    out = derive(raw.filter(expr.is_valid()))
    return out if "event_date" in out.columns else out.withColumn("event_date", F.to_date("event_time"))


def dedup(silver: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """One event for each key: of a batch the cheapest (then the least of the other columns), so that runs agree.

    What cleaning has added is not carried along but made again of the row that stays. A stream keeps the first that
    comes, needs a watermark and forgets keys beyond it.

    within: columns that follow from the key; a batch that lies by them already is not moved again.
    """
    if silver.isStreaming:
        return silver.dropDuplicatesWithinWatermark(list(DEDUP_KEY))
    cleaned = set(DERIVED) | set(DERIVED.values()) <= set(silver.columns)
    base = silver.drop(*DERIVED) if cleaned else silver
    key = (*within, *DEDUP_KEY)
    rest = sorted((c for c in base.columns if c not in key), key=lambda c: c != "price")
    least = base.groupBy(*key).agg(F.min(F.struct(*rest)).alias("least"))
    kept = least.select(*[F.col(f"least.{c}").alias(c) if c in rest else c for c in base.columns])
    return (derive(kept) if cleaned else kept).select(*silver.columns)


def enrich(silver: DataFrame) -> DataFrame:
    code = F.col("category_code_norm" if "category_code_norm" in silver.columns else "category_code")
    return silver.withColumns({"category_root": expr.category_root(code), "price_band": expr.price_band()})


def aggregate(events: DataFrame, *by: Column) -> DataFrame:
    return events.groupBy(*by).agg(*expr.funnel_sums()).withColumns(expr.rates())


def windowed(events: DataFrame, dim: Column, grain: str = "1 hour") -> DataFrame:
    """window_start, window_end, window_date, the dimension, counts and rates."""
    found = aggregate(events, F.window("event_time", grain).alias("w"), dim)
    times = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.to_date("w.start").alias("window_date")]
    return found.select(*times, *[c for c in found.columns if c != "w"])


def daily(events: DataFrame, dim: Column) -> DataFrame:
    return aggregate(events, F.col("event_date").alias("date"), dim)


def hourly_brand(silver: DataFrame) -> DataFrame:
    return windowed(silver, F.col("brand_norm").alias("brand"))


def daily_brand(silver: DataFrame) -> DataFrame:
    return daily(silver, F.col("brand_norm").alias("brand"))


def daily_category(silver: DataFrame) -> DataFrame:
    return daily(enrich(silver), F.col("category_root"))


def hourly_price_band(silver: DataFrame) -> DataFrame:
    return windowed(enrich(silver), F.col("price_band"))
