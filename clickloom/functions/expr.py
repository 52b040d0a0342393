"""Column expressions of the funnel domain; all of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_BANDS = (("<10", 10), ("10-30", 30), ("30-60", 60))
SEVERITIES = ("normal", "low", "medium", "high", "critical")


def is_valid() -> Column:
    """A price above 0, a time and a type. NaN counts as above 0, as in Spark's order of doubles."""
    return F.col("price").isNotNull() & (F.col("price") > 0) & F.col("event_time").isNotNull() & F.col("event_type").isNotNull()


def category_norm(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^a-z0-9\.]", "_")


def category_root(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def price_band(price: Column = None) -> Column:
    price = F.col("price") if price is None else price
    out = F.when(price < PRICE_BANDS[0][1], PRICE_BANDS[0][0])
    for name, below in PRICE_BANDS[1:]:
        out = out.when(price < below, name)
    return out.otherwise("60_plus")


def price_band_rank(band: Column) -> Column:
    out = F.lit(99)
    for k, name in enumerate(("<10", "10-30", "30-60", "60_plus")):
        out = F.when(band == name, k).otherwise(out)
    return out


def funnel_sums() -> list[Column]:
    kinds = (("view", "views"), ("cart", "carts"), ("purchase", "purchases"))
    return [*(F.count_if(F.col("event_type") == kind).alias(name) for kind, name in kinds), F.sum(F.when(F.col("event_type") == "purchase", F.col("price")).otherwise(0.0)).alias("revenue")]


def ratio(a: str, b: str, scale: float = 1.0) -> Column:
    """Null where the denominator is not above 0."""
    return F.when(F.col(b) > 0, F.col(a) * scale / F.col(b))


def rates(scale: float = 1.0) -> dict[str, Column]:
    return {"view_to_cart_rate": ratio("carts", "views", scale), "cart_to_purchase_rate": ratio("purchases", "carts", scale), "conversion_rate": ratio("purchases", "views", scale)}


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """0 where the deviation is missing or 0; nine decimals, so that thresholds do not hang on the last bit."""
    return F.round(F.coalesce(F.when(std.isNull() | (std == 0), 0.0).otherwise((value - mean) / std), F.lit(0.0)), 9)


def ladder(value: Column, steps: Sequence[tuple[str | float, float]], default, strict: bool = False) -> Column:
    """The label of the first step that value reaches (or exceeds)."""
    out = None
    for label, least in steps:
        hit = value > least if strict else value >= least
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def severity_rank(c: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), c)


def title(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
