"""Streaming funnels: the batch functions behind a watermark, and what a stream alone needs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import funnel
from ..settings import Streaming
from ..sources import events, sinks


def _timed(df: DataFrame) -> DataFrame:
    """Watermarks need a timestamp with a zone."""
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def tumbling(raw: DataFrame, cfg: Streaming = Streaming(), distinct: bool = False) -> DataFrame:
    """Hourly funnel by brand; distinct drops repeated events within the watermark, as a batch does."""
    silver = funnel.clean(_timed(raw)).withWatermark("event_time", cfg.watermark)
    return funnel.windowed(funnel.dedup(silver) if distinct else silver, F.col("brand_norm").alias("brand"), cfg.window)


def sliding(raw: DataFrame, cfg: Streaming = Streaming()) -> DataFrame:
    """Events and prices of all types, by brand, in overlapping windows."""
    rows = _timed(raw).withWatermark("event_time", cfg.realtime_watermark)
    found = rows.groupBy(F.window("event_time", cfg.window, cfg.slide).alias("w"), "brand").agg(F.count(F.lit(1)).alias("views"), F.sum("price").alias("revenue"))
    return found.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "brand", "views", "revenue")


def batch_zscores(batch: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Within one micro-batch: brands of two rows or more whose views deviate. Baselines are aggregates joined back, so a hot brand is no single task."""
    stats = batch.groupBy("brand").agg(F.avg("views").alias("mean"), F.stddev_samp("views").alias("std")).withColumnRenamed("brand", "of")
    scored = batch.join(stats, F.col("brand").eqNullSafe(F.col("of"))).withColumn("z_score", expr.zscore(F.col("views"), F.col("mean"), F.col("std")))
    return scored.filter(F.abs("z_score") > threshold).drop("of", "mean", "std")


def start_zscores(stream: DataFrame, path: str, checkpoint: str, threshold: float = 2.0, trigger: dict | None = None):
    def each(batch: DataFrame, number: int) -> None:
        # The batch's number is its folder: a batch that is run again after a failure replaces what it wrote.
        batch_zscores(batch, threshold).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": Streaming().trigger})).start()


def start_pipeline(spark: SparkSession, source: str, sink: str, **at):
    """source: broker or file; sink: broker, parquet or console. Unknown names are refused."""
    if source == "broker":
        raw = events.parse_messages(events.broker_stream(spark, at["servers"], at["topic"], "latest"), events.REALTIME_SCHEMA)
    elif source == "file":
        raw = events.file_stream(spark, at["path"], at.get("schema", events.REALTIME_SCHEMA), None)
    else:
        raise ValueError(f"unknown source: {source}")
    found = sliding(raw)
    starts: dict[str, Callable] = {
        "broker": lambda: sinks.start_broker(found, at["servers"], at["out_topic"], at["checkpoint"]),
        "parquet": lambda: sinks.start_parquet(found, at["out"], at["checkpoint"], at.get("trigger")),
        "console": lambda: sinks.start_console(found),
    }
    if sink not in starts:
        raise ValueError(f"unknown sink: {sink}")
    return starts[sink]()


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Everything there is now, then stop."""
    sinks.start_parquet(stream, path, checkpoint, {"availableNow": True}).awaitTermination()


def progress(query) -> dict:
    """Of the last micro-batch: its number, input rows and rows dropped as late."""
    last = query.lastProgress
    return {} if not last else {"batch": last["batchId"], "rows": last["numInputRows"], "late": sum(s["numRowsDroppedByWatermark"] for s in last["stateOperators"])}


def late_rows(query) -> int:
    """Rows that the watermark has left behind in the batches that are still reported."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def run_batches(query, n: int = 3, seconds: float = 600.0, poll: float = 1.0) -> int:
    """Watches a stream until it has run n batches or the time is up, then stops it; returns the batches seen."""
    end = time.monotonic() + seconds
    while query.isActive and time.monotonic() < end and len(query.recentProgress) < n:
        time.sleep(poll)
    query.stop()
    return len(query.recentProgress)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
