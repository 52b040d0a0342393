"""What a stream must remember: thresholds of the last week, baselines of all batches, late rows, sessions, pairs of events, progress.

Everything written by a micro-batch lies in a folder named by the batch's number, so a batch that is run again after a
failure replaces what it wrote.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQueryListener

from ..functions import expr
from ..operators import funnel, moments
from ..settings import Adaptive, Streaming
from ..sources import events

# Thresholds of the last hours.

LIMITS = "brand string, window_start timestamp, value double, history int, lower double, upper double, anomaly_type string"
_STATE = "times array<bigint>, values array<double>"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries with timers must be started in here: their state lives in the RocksDB store only. Other queries keep theirs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LastHours(StatefulProcessor):
    """Judges each hour of a brand by quantiles of the hours before it, and remembers only those: one value an hour, as many as the period has."""

    def __init__(self, cfg: Adaptive):
        self.cfg, self.reach = cfg, cfg.lookback_hours * 3_600_000_000

    def init(self, handle) -> None:
        self.handle, self.hours = handle, handle.getValueState("hours", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))  # a brand's closed hours of one batch
        at, value = new["window_start"].to_numpy("datetime64[us]").astype(np.int64), new["value"].to_numpy(float)
        known = self.hours.get() if self.hours.exists() else ([], [])
        times, values = np.concatenate([np.array(known[0], np.int64), at]), np.concatenate([np.array(known[1], float), value])
        order = np.argsort(times, kind="stable")
        times, values = times[order], values[order]
        lower, upper, history = [], [], []
        for t in at.tolist():
            past = values[np.searchsorted(times, t - self.reach) : np.searchsorted(times, t)]
            enough = len(past) >= self.cfg.min_history
            history.append(len(past))
            lower.append(np.quantile(past, self.cfg.low).round(9) if enough else None)
            upper.append(np.quantile(past, self.cfg.high).round(9) if enough else None)
        keep = times >= times[-1] - self.reach
        self.hours.update((times[keep].tolist(), values[keep].tolist()))
        # A brand that stays silent for the whole period is forgotten.
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((int(times[-1]) + self.reach) // 1000)
        out = pd.DataFrame({"brand": key[0], "window_start": new["window_start"].to_numpy(), "value": value, "history": history, "lower": lower, "upper": upper}).astype({"lower": float, "upper": float, "history": "int32"})
        out["anomaly_type"] = np.where(out["value"] < out["lower"], "drop", np.where(out["value"] > out["upper"], "spike", None))
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.hours.clear()
        return iter(())

    def close(self) -> None:
        pass


def closed_hours(raw: DataFrame, cfg: Streaming = Streaming()) -> DataFrame:
    """The hourly funnel of a stream, with the time at which each window closes for what comes after."""
    silver = funnel.clean(raw.withColumn("event_time", F.col("event_time").cast("timestamp"))).withWatermark("event_time", cfg.watermark)
    found = funnel.aggregate(silver, F.window("event_time", cfg.window).alias("w"), F.col("brand_norm").alias("brand"))
    return found.select(F.window_time("w").alias("closed_at"), F.col("w.start").alias("window_start"), *[c for c in found.columns if c != "w"])


def adaptive_stream(hours: DataFrame, value: str = "views", cfg: Adaptive = Adaptive()) -> DataFrame:
    """hours: as from closed_hours. Those without a brand or value have no threshold. To be started within keyed_state."""
    rows = hours.filter(F.col("brand").isNotNull() & F.col(value).isNotNull()).select("closed_at", "brand", "window_start", F.col(value).cast("double").alias("value"))
    return rows.groupBy("brand").transformWithStateInPandas(LastHours(cfg), LIMITS, "Append", "EventTime")


def adaptive_batch(hours: DataFrame, value: str = "views", cfg: Adaptive = Adaptive()) -> DataFrame:
    """The same over a table: a range of time by brand, bounded by the hours in it."""
    seconds = F.unix_timestamp(F.col("window_start").cast("timestamp"))
    before = Window.partitionBy("brand").orderBy(seconds).rangeBetween(-cfg.lookback_hours * 3600, -1)
    rows = hours.filter(F.col("brand").isNotNull() & F.col(value).isNotNull()).select("brand", "window_start", F.col(value).cast("double").alias("value"))
    limits = F.percentile("value", F.array(F.lit(cfg.low), F.lit(cfg.high))).over(before)
    out = rows.withColumns({"history": F.count(F.lit(1)).over(before).cast("int"), "limits": limits})
    known = F.col("history") >= cfg.min_history
    out = out.withColumns({name: F.when(known, F.round(F.col("limits")[k], 9)) for k, name in enumerate(("lower", "upper"))}).drop("limits")
    return out.withColumn("anomaly_type", F.when(F.col("value") < F.col("lower"), "drop").when(F.col("value") > F.col("upper"), "spike"))


# Baselines across batches.


def add_batch(batch: DataFrame, number: int, path: str, threshold: float = 2.0) -> None:
    """Adds a batch to the baselines of all before it, and writes its rows whose views deviate from them.

    moments/batch=n holds each brand's moments after batch n. Batch n reads those of n - 1, which a failure of n leaves alone,
    so it counts once however often it runs. Folders older than the one before last go.
    """
    spark = batch.sparkSession
    new = batch.groupBy("brand").agg(*moments.of("views")).select("brand", F.struct(*moments.FIELDS).alias("new"))
    old = events.safe_parquet(spark, f"{path}/moments/batch={number - 1}") if number else None
    if old is None:
        every = new.select("brand", F.col("new").alias("x"))
    else:
        old = old.select(F.col("brand").alias("of"), F.struct(*moments.FIELDS).alias("old"))
        joined = new.join(old, F.col("brand").eqNullSafe(F.col("of")), "full_outer")
        every = joined.select(F.coalesce("brand", "of").alias("brand"), moments.add(F.col("old"), F.col("new")).alias("x"))
    every.select("brand", *[F.col(f"x.{f}").alias(f) for f in moments.FIELDS]).write.mode("overwrite").parquet(f"{path}/moments/batch={number}")
    base = spark.read.parquet(f"{path}/moments/batch={number}").select(F.col("brand").alias("of"), "n", "mean", "m2")
    scored = batch.join(base, F.col("brand").eqNullSafe(F.col("of"))).withColumn("z_score", expr.zscore(F.col("views"), F.col("mean"), moments.deviation(F.col("n"), F.col("m2"))))
    kept = scored.filter(F.abs("z_score") > threshold).select(*batch.columns, F.col("n").alias("seen"), "z_score")
    kept.write.mode("overwrite").parquet(f"{path}/scores/batch={number}")
    _delete(spark, f"{path}/moments/batch={number - 2}")


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def start_baselines(stream: DataFrame, path: str, checkpoint: str, threshold: float = 2.0, trigger: dict | None = None, each: Callable[[DataFrame, int], None] | None = None):
    """stream: brand and views, a row for each hour; each: in place of add_batch."""
    run = each or (lambda batch, number: add_batch(batch, number, path, threshold))
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": Streaming().trigger})).start()


# Rows behind the watermark.


def split_batch(batch: DataFrame, number: int, path: str, cfg: Streaming = Streaming()) -> None:
    """Rows whose window has closed go to late/, all others to on_time/.

    A window has closed when it ends at or before the greatest time of all earlier batches less the delay; marks/batch=n
    holds the greatest time after batch n. Rows without a time belong to no window; they go with the others, for `clean` to judge.
    """
    spark = batch.sparkSession
    before = events.safe_parquet(spark, f"{path}/marks/batch={number - 1}") if number else None
    seen = before.first().seen if before is not None else None
    rows = batch.persist()
    try:
        closed = F.lit(False)
        if seen is not None:
            width = int(pd.Timedelta(cfg.window).total_seconds())
            end = (F.floor(F.unix_seconds("event_time") / width) + 1) * width
            closed = F.coalesce(F.timestamp_seconds(end) <= F.lit(seen) - F.expr(f"INTERVAL {cfg.watermark}"), F.lit(False))
        marked = rows.withColumn("is_late", closed)
        marked.filter("NOT is_late").drop("is_late").write.mode("overwrite").parquet(f"{path}/on_time/batch={number}")
        marked.filter("is_late").drop("is_late").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        last = rows.agg(F.max("event_time").alias("seen")).select(F.greatest("seen", F.lit(seen).cast("timestamp")).alias("seen"))
        last.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
    finally:
        rows.unpersist()


def start_split(stream: DataFrame, path: str, checkpoint: str, cfg: Streaming = Streaming(), trigger: dict | None = None):
    return stream.writeStream.foreachBatch(lambda batch, number: split_batch(batch, number, path, cfg)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": cfg.trigger})).start()


def with_late(gold: DataFrame, late: DataFrame) -> DataFrame:
    """An hourly funnel by brand with what late rows add to it. Sums add up, rates are taken anew."""
    more = funnel.hourly_brand(funnel.clean(late)).select(*[c for c in gold.columns if not c.endswith("_rate")])
    sums = gold.select(*more.columns).unionByName(more).groupBy("window_start", "window_end", "window_date", "brand")
    return sums.agg(*[F.sum(c).alias(c) for c in ("views", "carts", "purchases", "revenue")]).withColumns(expr.rates())


# Sessions and pairs.


def sessions(raw: DataFrame, gap: str = "30 minutes", cfg: Streaming = Streaming(), by: str = "user_id") -> DataFrame:
    """A funnel for each visit: events of one user with no gap as long as `gap`. The same over a table and over a stream, where a session is told once the watermark has passed its end."""
    rows = funnel.clean(raw.withColumn("event_time", F.col("event_time").cast("timestamp")))
    rows = rows.withWatermark("event_time", cfg.watermark) if rows.isStreaming else rows
    found = rows.groupBy(F.session_window("event_time", gap).alias("w"), by).agg(F.count(F.lit(1)).alias("events"), *expr.funnel_sums())
    return found.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), by, "events", "views", "carts", "purchases", "revenue")


def views_to_purchases(raw: DataFrame, within: str = "6 hours", cfg: Streaming = Streaming(), kind: str = "inner") -> DataFrame:
    """Each view with the purchases of its session that follow it within the time given; left_outer also tells views without one.

    Both sides have a watermark and the times bound each other, so a stream forgets a row once no partner of it can come any more.
    """
    rows = funnel.clean(raw.withColumn("event_time", F.col("event_time").cast("timestamp")))

    def side(event: str, name: str) -> DataFrame:
        one = rows.filter(F.col("event_type") == event).select(F.col("event_time").alias(f"{name}_time"), F.col("user_session").alias(f"{name}_session"), F.col("product_id").alias(f"{name}_product"), F.col("price").alias(f"{name}_price"))
        return one.withWatermark(f"{name}_time", cfg.watermark) if one.isStreaming else one

    on: Column = F.expr(f"view_session = purchase_session AND purchase_time >= view_time AND purchase_time <= view_time + INTERVAL {within}")
    return side("view", "view").join(side("purchase", "purchase"), on, kind).drop("purchase_session").withColumnRenamed("view_session", "user_session")


# Progress.

PROGRESS = "name string, batch long, rows long, late long, state_rows long, millis long"


class ProgressLog(StreamingQueryListener):
    """Writes a row for each micro-batch that read something, and stops the query after n of them.

    Every batch is told to the listener, unlike a query's own list of recent ones, which forgets. Batches without input are not counted, but their late rows are added to the last one's.
    """

    def __init__(self, path: str | None = None, n: int | None = None, name: str | None = None):
        self.path, self.n, self.name = path, n, name
        self.rows: list[tuple] = []
        self.done = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if (self.name and p.name != self.name) or self.done.is_set():
            return
        late, held = (sum(getattr(s, k) for s in p.stateOperators) for k in ("numRowsDroppedByWatermark", "numRowsTotal"))
        if p.numInputRows:
            self.rows.append((p.name, p.batchId, p.numInputRows, late, held, p.batchDuration))
        elif self.rows:
            self.rows[-1] = (*self.rows[-1][:3], self.rows[-1][3] + late, held, self.rows[-1][5])
        if self.n and len(self.rows) >= self.n:
            self.done.set()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.done.set()

    def write(self, spark: SparkSession) -> None:
        if self.path:
            spark.createDataFrame(self.rows[: self.n], PROGRESS).coalesce(1).write.mode("overwrite").parquet(self.path)


def watch(spark: SparkSession, start: Callable[[], object], log: ProgressLog, seconds: float = 600.0) -> list[tuple]:
    """Starts a query, waits until the log has what it wants, the query ends or the time is up, stops it, and writes the log."""
    spark.streams.addListener(log)
    try:
        query = start()
        log.done.wait(seconds)
        query.stop()
        log.write(spark)
    finally:
        spark.streams.removeListener(log)
    return log.rows[: log.n]
