"""Combining model scores into decisions, severities and money, and reporting them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..settings import Ensemble


def combine(df: DataFrame, cfg: Ensemble = Ensemble()) -> DataFrame:
    """Weighted score over the models whose columns there are, and how many of them flag the row."""
    models = [m for m in cfg.weights if f"{m}_anomaly_score" in df.columns]
    if not models:
        return df.withColumns({"ensemble_score": F.lit(0.0), "n_models_flagged": F.lit(0), "confidence": F.lit(0.0), "is_anomaly": F.lit(False)})
    total = sum(cfg.weights[m] for m in models)
    score = reduce(lambda a, b: a + b, [F.coalesce(f"{m}_anomaly_score", F.lit(0.0)) * (cfg.weights[m] / total) for m in models])
    flags = [F.coalesce(F.col(f"{m}_is_anomaly").cast("int"), F.lit(0)) for m in models if f"{m}_is_anomaly" in df.columns]
    votes = reduce(lambda a, b: a + b, flags, F.lit(0))
    out = df.withColumns({"ensemble_score": score, "n_models_flagged": votes, "confidence": votes / len(models)})
    decided = F.col("n_models_flagged") >= cfg.min_votes if cfg.voting == "majority" else F.col("ensemble_score") > cfg.threshold
    return out.withColumn("is_anomaly", decided)


def severity(df: DataFrame, cfg: Ensemble = Ensemble()) -> DataFrame:
    return df.withColumn("severity", expr.ladder(F.col("ensemble_score"), cfg.severity, "normal"))


def kind(df: DataFrame) -> DataFrame:
    """spike over drop over changepoint over anomaly over none."""
    at = F.coalesce(F.col("is_at_changepoint"), F.lit(False)) if "is_at_changepoint" in df.columns else F.lit(False)
    conv, want = F.col("conversion_rate"), F.col("expected_conversion")
    return df.withColumn("anomaly_type", F.when(F.col("is_anomaly") & (conv > 1.2 * want), "spike").when(F.col("is_anomaly") & (conv < 0.8 * want), "drop").when(at, "changepoint").when(F.col("is_anomaly"), "anomaly").otherwise("none"))


def expected(df: DataFrame) -> DataFrame:
    """The first of: the forecast, the weekly mean, the brand's mean as given, the brand's mean over the rows."""
    for name in ("prophet_expected", "rolling_7d_avg_conversion_rate", "brand_avg_conversion"):
        if name in df.columns:
            return df.withColumn("expected_conversion", F.col(name))
    means = df.groupBy("brand").agg(F.avg("conversion_rate").alias("expected_conversion"))
    return df.join(means, "brand", "left")


def impact(df: DataFrame) -> DataFrame:
    """Deviation, money (negative is a loss) and lost purchases."""
    out = df if "expected_conversion" in df.columns else expected(df)
    want, sold = F.col("expected_conversion"), F.col("purchases")
    value = expr.ratio("revenue", "purchases") if "avg_order_value" not in df.columns else F.col("avg_order_value")
    fallback = F.coalesce(expr.ratio("revenue", "views"), F.lit(0.0))
    return out.withColumns({"deviation_pct": F.when(want > 0, (F.col("conversion_rate") - want) / want * 100).otherwise(0.0), "revenue_impact": (sold - F.col("views") * want) * F.coalesce(value, fallback), "conversion_loss": F.col("views") * want - sold})


def at_least(df: DataFrame, least: str) -> DataFrame:
    if least not in expr.SEVERITIES:
        raise ValueError(f"unknown severity: {least}")
    return df.filter(expr.severity_rank(F.col("severity")) > expr.SEVERITIES.index(least))


def top(df: DataFrame, n: int = 10, by: str = "revenue_impact") -> DataFrame:
    return df.filter("is_anomaly").orderBy(F.desc(by if by in df.columns else "ensemble_score"), "brand", "window_start").limit(n)


def summary(df: DataFrame) -> DataFrame:
    hit = F.col("is_anomaly")
    by_severity = [F.count_if(F.col("severity") == s).alias(f"n_{s}") for s in expr.SEVERITIES]
    by_type = [F.count_if(hit & (F.col("anomaly_type") == t)).alias(f"n_{t}") for t in ("drop", "spike", "changepoint", "anomaly")]
    one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("anomalies"), *by_severity, *by_type, F.avg("ensemble_score").alias("mean_score"), F.max("ensemble_score").alias("max_score"), F.avg(F.when(hit, F.col("confidence"))).alias("mean_confidence"), F.sum(F.when(hit, F.col("revenue_impact"))).alias("revenue_impact"), F.sum(F.when(hit, F.col("conversion_loss"))).alias("conversion_loss"))
    return one.withColumn("anomaly_rate", expr.ratio("anomalies", "n"))


def assessment(df: DataFrame, *by: str) -> DataFrame:
    """Counts and money of the anomalies by severity, type, brand or hour."""
    return df.filter("is_anomaly").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("revenue_impact").alias("revenue_impact"), F.avg("revenue_impact").alias("mean_revenue_impact"), F.sum("conversion_loss").alias("conversion_loss"))


def dashboard(df: DataFrame) -> DataFrame:
    """One row: totals, urgent counts, money, and the anomaly of the greatest absolute impact."""
    worst = F.min(F.struct((-F.abs("revenue_impact")).alias("x"), "brand", "window_start"))
    return df.filter("is_anomaly").agg(F.count(F.lit(1)).alias("anomalies"), F.count_if(F.col("severity") == "critical").alias("critical"), F.count_if(F.col("severity") == "high").alias("high"), F.sum("revenue_impact").alias("revenue_impact"), worst.getField("brand").alias("worst_brand"), worst.getField("window_start").alias("worst_window"))


def most_affected(df: DataFrame, n: int = 5) -> DataFrame:
    """Brands of the most anomalies."""
    return df.filter("is_anomaly").groupBy("brand").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "brand").limit(n)


def error_limit(df: DataFrame, error: str, share: float = 0.95, factor: float = 1.5) -> DataFrame:
    """One row: from which error on a row is anomalous."""
    return df.agg((F.percentile(error, share) * factor).alias("error_limit"))


def score_correlations(df: DataFrame, *columns: str) -> DataFrame:
    pairs = [(a, b) for k, a in enumerate(columns) for b in columns[k + 1 :]]
    return df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
