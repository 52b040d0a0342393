"""Z-score anomalies of a brand's conversion rate, native scores, and reports over them.

Baselines are grouped aggregates joined back to the rows, not windows over whole brands: the aggregate is combined
before its shuffle, so a brand with a third of all rows is no longer one task's sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..settings import ZScore


def reliable(gold: DataFrame, cfg: ZScore = ZScore()) -> DataFrame:
    return gold.filter((F.col("views") >= cfg.min_baseline_views) & F.col("brand").isNotNull()).withColumn("hour_of_day", F.hour("window_start"))


def baselines(rows: DataFrame, *by: str, suffix: str = "brand") -> DataFrame:
    return rows.groupBy(*by).agg(F.avg("conversion_rate").alias(f"conv_mean_{suffix}"), F.stddev_samp("conversion_rate").alias(f"conv_std_{suffix}"))


def with_zscores(gold: DataFrame, cfg: ZScore = ZScore()) -> DataFrame:
    rows = reliable(gold, cfg)
    found = rows.join(baselines(rows, "brand"), "brand").join(baselines(rows, "brand", "hour_of_day", suffix="brand_hour"), ["brand", "hour_of_day"])
    return found.withColumns({f"z_{s}": expr.zscore(F.col("conversion_rate"), F.col(f"conv_mean_{s}"), F.col(f"conv_std_{s}")) for s in ("brand", "brand_hour")})


def flag(rows: DataFrame, cfg: ZScore = ZScore()) -> DataFrame:
    """A drop wins over a spike."""
    busy, t = F.col("views") >= cfg.min_flag_views, cfg.threshold
    drop = busy & ((F.col("z_brand") <= -t) | (F.col("z_brand_hour") <= -t))
    spike = busy & ((F.col("z_brand") >= t) | (F.col("z_brand_hour") >= t))
    out = rows.withColumns({"is_drop_anomaly": drop, "is_spike_anomaly": spike})
    return out.withColumn("anomaly_type", F.when(F.col("is_drop_anomaly"), "drop").when(F.col("is_spike_anomaly"), "spike"))


def zscore_anomalies(gold: DataFrame, cfg: ZScore = ZScore()) -> DataFrame:
    return flag(with_zscores(gold, cfg), cfg).filter("anomaly_type IS NOT NULL")


def worst_drops(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return anomalies.filter("anomaly_type = 'drop'").orderBy("z_brand", "brand", "window_start").limit(n)


def top_spikes(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return anomalies.filter("anomaly_type = 'spike'").orderBy(F.desc("z_brand"), "brand", "window_start").limit(n)


def count_by(anomalies: DataFrame, *by: Column | str) -> DataFrame:
    return anomalies.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_type") == "drop").alias("drops"), F.count_if(F.col("anomaly_type") == "spike").alias("spikes"))


def most_anomalous(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return count_by(anomalies, "brand").orderBy(F.desc("n"), "brand").limit(n)


def pattern(anomalies: DataFrame) -> DataFrame:
    """Totals, shares, mean absolute z, affected brands and the peak hour, in one pass and one small one."""
    one = anomalies.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_type") == "drop").alias("drops"), F.count_if(F.col("anomaly_type") == "spike").alias("spikes"), F.avg(F.abs("z_brand")).alias("mean_abs_z"), F.count_distinct(F.coalesce("brand", F.lit(""))).alias("brands"))
    # At most 24 rows.
    peak = anomalies.groupBy("hour_of_day").count().agg(F.min(F.struct((-F.col("count")).alias("x"), "hour_of_day")).getField("hour_of_day").alias("peak_hour"))
    return one.join(F.broadcast(peak)).withColumns({"drop_pct": expr.ratio("drops", "n", 100.0), "spike_pct": expr.ratio("spikes", "n", 100.0)})


def severity_label(anomalies: DataFrame) -> DataFrame:
    return anomalies.withColumn("severity", expr.ladder(F.abs("z_brand"), (("High", 3.0), ("Medium", 2.5)), "Low", strict=True))


def native(gold: DataFrame, cfg: ZScore = ZScore()) -> DataFrame:
    """Scores, types, severities and money from the brand's z-score alone; a positive impact is a loss."""
    rows = reliable(gold, cfg)
    rows = rows.join(baselines(rows, "brand"), "brand").withColumn("z_score", expr.zscore(F.col("conversion_rate"), F.col("conv_mean_brand"), F.col("conv_std_brand")))
    size, expected = F.abs("z_score"), F.col("conv_mean_brand")
    loss = (expected - F.col("conversion_rate")) * F.col("views")
    return rows.withColumns({
        "ensemble_score": expr.ladder(size, ((1.0, 3.0), (0.8, 2.5), (0.6, 2.0), (0.4, 1.5)), 0.0, strict=True),
        "anomaly_type": F.when(F.col("z_score") <= -cfg.threshold, "drop").when(F.col("z_score") >= cfg.threshold, "spike").otherwise("none"),
        "severity": expr.ladder(size, (("critical", 3.0), ("high", 2.5), ("medium", 2.0), ("low", 1.5)), "normal"),
        "is_anomaly": (F.col("views") >= cfg.min_flag_views) & (size >= cfg.threshold),
        "confidence": expr.ladder(F.col("views"), ((0.9, 200), (0.7, 100), (0.5, 50)), 0.3),
        "expected_conversion": expected,
        "deviation_pct": F.when(expected > 0, (F.col("conversion_rate") - expected) / expected * 100).otherwise(0.0),
        "conversion_loss": loss, "revenue_impact": loss * 50,
    })


def as_models(rows: DataFrame, cfg: ZScore = ZScore(), full: float = 4.0) -> DataFrame:
    """z-scores as two models for the ensemble, `brand` and `brand_hour`: a score of 1 from `full` deviations on, a flag from the threshold on; the brand's mean is what is expected."""
    size = {m: F.abs(f"z_{m}") for m in ("brand", "brand_hour")}
    scores = {f"{m}_anomaly_score": F.least(z / full, F.lit(1.0)) for m, z in size.items()}
    return rows.withColumns(scores | {f"{m}_is_anomaly": z >= cfg.threshold for m, z in size.items()} | {"brand_avg_conversion": F.col("conv_mean_brand")})


def overlay(gold: DataFrame, anomalies: DataFrame) -> DataFrame:
    """The series with its anomaly markers."""
    marks = anomalies.select("brand", "window_start", "anomaly_type")
    return gold.join(marks, ["brand", "window_start"], "left").select("brand", "window_start", "conversion_rate", "anomaly_type")
