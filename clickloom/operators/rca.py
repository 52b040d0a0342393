"""Root causes, alerts and exports, for all anomalies at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr

METRICS = ("views", "conversion_rate", "carts", "revenue", "avg_order_value")


def root_causes(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Deviations of each anomaly from its brand's medians, the three largest, and when it happened.

    A metric that the anomaly lacks (no order value without a purchase) has no deviation and is no cause.
    """
    medians = history.groupBy("brand").agg(*[F.median(m).alias(f"median_{m}") for m in METRICS])
    out = rows.join(medians, "brand", "left")
    for m in METRICS:
        base = F.col(f"median_{m}")
        out = out.withColumn(f"{m}_deviation", F.when(base > 0, F.round((F.col(m) - base) / base * 100, 6)).otherwise(0.0))
    known = F.filter(F.array(*[F.struct((-F.abs(f"{m}_deviation")).alias("x"), F.lit(m).alias("metric"), F.col(f"{m}_deviation").alias("deviation")) for m in METRICS]), lambda e: e["deviation"].isNotNull())
    hour, day = F.hour("window_start"), F.dayofweek("window_start")
    out = out.withColumn("causes", F.slice(F.array_sort(known), 1, 3)).withColumns({
        "is_off_peak": (hour < 6) | (hour > 22), "is_business_hours": hour.between(9, 17), "is_weekend": day.isin(1, 7),
    })
    text = F.transform("causes", lambda c: F.concat(expr.title(c["metric"]), F.lit(" "), F.when(c["deviation"] >= 0, "up").otherwise("down")))
    return out.withColumns({"top_metrics": F.array_join(F.transform("causes", lambda c: c["metric"]), ","), "summary": F.array_join(text, "; ")})


def priority(df: DataFrame) -> DataFrame:
    size = F.abs("revenue_impact")
    return df.withColumn("priority", F.when((F.col("severity") == "critical") | (size > 10_000), "high").when((F.col("severity") == "high") | (size > 1_000), "medium").otherwise("low"))


def alerts(anomalies: DataFrame, history: DataFrame) -> DataFrame:
    """What is to be told of each anomaly: what, where, how sure, how much, and why."""
    found = priority(root_causes(anomalies, history))
    told = ("anomaly_type", "severity", "confidence", "ensemble_score", "conversion_rate", "expected_conversion", "deviation_pct", "views", "purchases", "revenue", "revenue_impact", "conversion_loss", "priority", "top_metrics")
    scores = [c for c in found.columns if c.endswith("_anomaly_score")]
    return found.select(
        F.concat_ws("_", "brand", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")).alias("alert_id"), "brand", "window_start", *[c for c in told if c in found.columns], F.struct(*scores).alias("model_scores"),
        F.struct("is_off_peak", "is_business_hours", "is_weekend").alias("when"), F.concat(F.upper("severity"), F.lit(": "), "brand", F.lit(" - "), "summary").alias("text"),
    )


def latest(found: DataFrame, n: int = 20) -> DataFrame:
    """The last alerts first."""
    return found.orderBy(F.desc("window_start"), "brand").limit(n)


def first_of_severity(anomalies: DataFrame, severity: str = "critical", n: int = 5) -> DataFrame:
    """The earliest anomalies of a severity, to be explained one by one."""
    return anomalies.filter((F.col("severity") == severity) & F.col("is_anomaly")).orderBy("window_start", "brand").limit(n)


def export(df: DataFrame, mode: str = "dataframe") -> DataFrame:
    """dataframe: the report's columns; summary: counts by severity; json (and any other mode): df as it is, nested fields and all, for `sinks.export_json`."""
    if mode == "dataframe":
        wanted = ("window_start", "brand", "anomaly_type", "severity", "conversion_rate", "expected_conversion", "deviation_pct", "views", "purchases", "revenue", "revenue_impact", "conversion_loss", "ensemble_score", "confidence")
        return df.select(*[c for c in wanted if c in df.columns])
    return df.groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.sum("revenue_impact").alias("revenue_impact")) if mode == "summary" else df
