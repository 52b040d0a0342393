"""Business reports over the funnel tables. Each is one declarative plan; ties are broken by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr

SUMS = ("views", "carts", "purchases", "revenue")


def totals(gold: DataFrame, *by: str) -> DataFrame:
    return gold.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])


def labelled(c: str, unknown: str = "Unknown") -> Column:
    return F.coalesce(F.col(c), F.lit(unknown)).alias(c)


def overall_funnel(gold: DataFrame) -> DataFrame:
    """One row; zeros and null rates without events."""
    one = gold.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    return one.withColumns({k.replace("_rate", "_pct"): v for k, v in expr.rates(100.0).items()})


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def date_range(gold: DataFrame) -> DataFrame:
    return gold.agg(F.min("window_date").alias("first_date"), F.max("window_date").alias("last_date"), F.count(F.lit(1)).alias("windows"))


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out


def top_brands(gold: DataFrame, n: int = 10) -> DataFrame:
    found = gold.filter(F.col("brand").isNotNull()).groupBy("brand").agg(F.sum("revenue").alias("revenue"), F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))
    return found.orderBy(F.desc("revenue"), "brand").limit(n)


def category_performance(gold: DataFrame) -> DataFrame:
    return totals(gold.withColumn("category_root", labelled("category_root")), "category_root").withColumn("conversion_pct", expr.ratio("purchases", "views", 100.0))


def price_band_performance(gold: DataFrame) -> DataFrame:
    return totals(gold, "price_band").withColumns({"conversion_pct": expr.ratio("purchases", "views", 100.0), "band_order": expr.price_band_rank(F.col("price_band"))})


def daily_price_ratio_of_sums(gold: DataFrame) -> DataFrame:
    return totals(gold, "window_date", "price_band").select("window_date", "price_band", expr.ratio("purchases", "views").alias("conversion_rate"))


def daily_price_mean_of_rates(gold: DataFrame) -> DataFrame:
    return gold.groupBy("window_date", "price_band").agg(F.avg("conversion_rate").alias("conversion_rate"))


def brand_kpis(gold: DataFrame) -> DataFrame:
    found = totals(gold.filter(F.col("brand").isNotNull()), "brand").withColumns({k.replace("_rate", "_pct"): v for k, v in expr.rates(100.0).items()})
    return found.withColumn("avg_order_value", expr.ratio("revenue", "purchases"))


def revenue_concentration(gold: DataFrame, n: int = 10) -> DataFrame:
    """The top brands' share of all revenue: two aggregates of one row, joined."""
    top = top_brands(gold, n).agg(F.sum("revenue").alias("top_revenue"))
    every = gold.filter(F.col("brand").isNotNull()).agg(F.sum("revenue").alias("total_revenue"))
    return top.join(F.broadcast(every)).withColumn("top_share_pct", expr.ratio("top_revenue", "total_revenue", 100.0))


def _with_means(kpis: DataFrame) -> DataFrame:
    means = kpis.agg(F.avg("views").alias("mean_views"), F.avg("conversion_pct").alias("mean_conversion"))
    return kpis.join(F.broadcast(means))


def brand_quadrants(gold: DataFrame) -> DataFrame:
    """Busy brands that convert badly, and quiet ones that convert well."""
    many, good = F.col("views") > F.col("mean_views"), F.col("conversion_pct") > F.col("mean_conversion")
    quadrant = F.when(many & (F.col("conversion_pct") < F.col("mean_conversion")), "fix_conversion").when((F.col("views") < F.col("mean_views")) & good, "grow_traffic")
    return _with_means(brand_kpis(gold)).withColumn("quadrant", quadrant).filter("quadrant IS NOT NULL").select("brand", "views", "conversion_pct", "quadrant")


def underperforming(gold: DataFrame, min_views: int = 1000, quantile: float = 0.25) -> DataFrame:
    """Brands of enough views that convert below the quantile (a value that occurs, not an interpolated one)."""
    kpis = brand_kpis(gold).filter((F.col("views") >= min_views) & F.col("conversion_pct").isNotNull()).select("brand", *SUMS, "conversion_pct")
    cut = kpis.agg(F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY conversion_pct)").alias("cut"))
    return kpis.join(F.broadcast(cut)).filter(F.col("conversion_pct") < F.col("cut")).drop("cut")


def revenue_impact(gold: DataFrame, uplift: float = 1.1) -> DataFrame:
    one = overall_funnel(gold).withColumn("target_pct", F.col("conversion_pct") * uplift)
    extra = F.col("views") * F.col("target_pct") / 100 - F.col("purchases")
    return one.select("conversion_pct", "target_pct", extra.alias("additional_purchases"), (extra * expr.ratio("revenue", "purchases")).alias("potential_revenue"))


def funnel_drop(gold: DataFrame) -> DataFrame:
    one = overall_funnel(gold).withColumns({"view_to_cart_loss": F.col("views") - F.col("carts"), "cart_to_purchase_loss": F.col("carts") - F.col("purchases")})
    return one.withColumn("biggest_drop", F.when(F.col("view_to_cart_loss") > F.col("cart_to_purchase_loss"), "view_to_cart").otherwise("cart_to_purchase"))


def best_of(performance: DataFrame, name: str) -> DataFrame:
    """One row: the best converter, the largest earner and the count; ties to the smaller name."""
    by_rate = F.min(F.struct((-F.coalesce("conversion_pct", F.lit(-1.0))).alias("x"), F.col(name).alias("name")))
    by_revenue = F.min(F.struct((-F.col("revenue")).alias("x"), F.col(name).alias("name")))
    return performance.agg(by_rate.getField("name").alias("best_conversion"), by_revenue.getField("name").alias("top_revenue"), F.count(F.lit(1)).alias("n"))


def pivot(gold: DataFrame, by: str, column: str, values: list[str], measure: Column) -> DataFrame:
    """A row for each `by`, a column for each given value; 0 where there is nothing."""
    return gold.groupBy(by).pivot(column, values).agg(measure).fillna(0)


def extremes(performance: DataFrame, name: str, measure: str, n: int = 1) -> DataFrame:
    """The n best and the n worst by a measure, ties to the smaller name."""
    ends = [performance.orderBy(order, name).limit(n).withColumn("end", F.lit(label)) for label, order in (("best", F.desc_nulls_last(measure)), ("worst", F.asc_nulls_last(measure)))]
    return ends[0].unionByName(ends[1])


def described(df: DataFrame) -> DataFrame:
    """Names and types of the columns, in order."""
    return df.sparkSession.createDataFrame([(k, n, t) for k, (n, t) in enumerate(df.dtypes)], "position int, column_name string, column_type string")


def listing(gold: DataFrame, n: int = 20) -> DataFrame:
    """The first windows, in order of time and brand."""
    return gold.filter("brand IS NOT NULL").orderBy("window_start", "brand").limit(n)


def pivot_daily_revenue(gold: DataFrame, bands: tuple[str, ...] = ("<10", "10-30", "30-60", "60_plus")) -> DataFrame:
    """The values are given, so no extra job looks for them."""
    names = {"<10": "under_10", "10-30": "from_10_to_30", "30-60": "from_30_to_60", "60_plus": "from_60"}
    found = gold.groupBy("window_date").pivot("price_band", list(bands)).agg(F.sum("revenue"))
    return found.fillna(0.0).withColumnsRenamed({k: v for k, v in names.items() if k in bands})


def top_brand_trend(gold: DataFrame, n: int = 5) -> DataFrame:
    """Daily revenue of the top brands, by a semi-join."""
    return gold.join(top_brands(gold, n).select("brand"), "brand", "left_semi").groupBy("date", "brand").agg(F.sum("revenue").alias("revenue"))


def parity(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Windows of either side with the difference of each measure."""
    key = ["window_start", "brand"]
    left, right = (df.select(*key, *SUMS) for df in (batch, stream))
    on = [left[k].eqNullSafe(right[k]) for k in key]
    found = left.alias("b").join(right.alias("s"), on, "full_outer")
    # Sums of prices may differ in their last bits.
    diff = [F.round(F.coalesce(f"b.{c}", F.lit(0)) - F.coalesce(f"s.{c}", F.lit(0)), 6).alias(f"{c}_diff") for c in SUMS]
    return found.select(*[F.coalesce(f"b.{k}", f"s.{k}").alias(k) for k in key], *diff)


def parity_totals(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """All totals of both sides, a row each."""
    sides = [df.agg(F.count(F.lit(1)).alias("windows"), *[F.sum(c).alias(c) for c in SUMS]).withColumn("side", F.lit(name)) for name, df in (("batch", batch), ("stream", stream))]
    return sides[0].unionByName(sides[1])
