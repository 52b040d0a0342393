"""Registered queries of streams that remember, each against the same result in SQL over the whole table."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import funnel
from ..sources import events, manifest, scratch
from ..streaming import funnel as streaming
from ..streaming import stateful
from .registry import BASE, CLOSED, GOLD, HOURLY, add, closed, hourly_brand, plain_times, raw


FILE_ROWS = 250_000  # events for each file that a part is written in


def files(s: SparkSession, d: str) -> int:
    """In how many files a part is written, by the events there are; the footers tell."""
    return max(1, ceil(s.read.parquet(f"{d}/events.parquet").count() / FILE_ROWS))


def in_parts(s: SparkSession, at: str, parts: list[DataFrame], n: int) -> DataFrame:
    """A stream of one batch for each part, in this order.

    A batch takes n files, so each part is written in n, as many tasks; one of too few rows for that is filled up with empty files.
    """
    none = s.createDataFrame([], parts[0].schema)
    for k, part in enumerate(parts, 1):
        part.repartition(n).write.mode("append").parquet(f"{at}/in")
        for _ in range(n * k - sum(f.endswith(".parquet") for f in manifest.names(s, f"{at}/in"))):
            none.coalesce(1).write.mode("append").parquet(f"{at}/in")
    return events.file_stream(s, f"{at}/in", parts[0].schema, n)


def timed(s: SparkSession, d: str) -> DataFrame:
    return raw(s, d).withColumn("event_time", F.col("event_time").cast("timestamp"))


def five_days() -> Column:
    """Six parts of the month."""
    return F.least(F.floor((F.dayofmonth("event_time") - 1) / 5), F.lit(5))


def ordered(s: SparkSession, d: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """make() over the events as a stream, five days a batch."""
    at, rows = scratch.path(s, "ordered"), timed(s, d)
    streaming.run_available(make(in_parts(s, at, [rows.filter(five_days() == k) for k in range(6)], files(s, d))), f"{at}/out", f"{at}/checkpoint")
    return plain_times(s.read.parquet(f"{at}/out"))


def adaptive(s: SparkSession, d: str) -> DataFrame:
    with stateful.keyed_state(s):
        return ordered(s, d, lambda x: stateful.adaptive_stream(stateful.closed_hours(x)))


# Thresholds of the last week.
LIMITS = HOURLY + """, g AS (SELECT brand, window_start, views::DOUBLE AS value FROM gold WHERE brand IS NOT NULL),
l AS (SELECT *, (count(*) OVER w)::INTEGER AS history, round(quantile_cont(value, 0.05) OVER w, 9) AS a, round(quantile_cont(value, 0.95) OVER w, 9) AS b FROM g
  WINDOW w AS (PARTITION BY brand ORDER BY window_start RANGE BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING)),
k AS (SELECT brand, window_start, value, history, CASE WHEN history >= 3 THEN a END AS lower, CASE WHEN history >= 3 THEN b END AS upper FROM l),
x AS (SELECT *, CASE WHEN value < lower THEN 'drop' WHEN value > upper THEN 'spike' END AS anomaly_type FROM k)"""
add("adaptive_thresholds", lambda s, d: stateful.adaptive_batch(hourly_brand(s, d)), LIMITS + "\nFINAL SELECT * FROM x", ("lower", "upper"))
add("stream_adaptive_thresholds", lambda s, d: closed(adaptive(s, d), s, d), LIMITS + f"\nFINAL SELECT * FROM x WHERE {CLOSED}", ("lower", "upper"))


# Baselines across batches.
FIRST, SECOND = "2024-01-11", "2024-01-21"


def third(time: str) -> Column:
    return F.when(F.col(time) < F.lit(FIRST).cast("timestamp"), 0).when(F.col(time) < F.lit(SECOND).cast("timestamp"), 1).otherwise(2)


def baselines(s: SparkSession, d: str) -> DataFrame:
    """Ten days a batch; the second batch fails after it has been written, and is run again."""
    at, failed = scratch.path(s, "baselines"), []
    rows = hourly_brand(s, d).select("brand", F.col("window_start").cast("timestamp").alias("window_start"), "views")
    stream = in_parts(s, at, [rows.filter(third("window_start") == k) for k in range(3)], files(s, d))

    def once(batch: DataFrame, number: int) -> None:
        stateful.add_batch(batch, number, f"{at}/out")
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost after writing")

    for each in (once, None):
        query = stateful.start_baselines(stream, f"{at}/out", f"{at}/checkpoint", trigger={"availableNow": True}, each=each)
        try:
            query.awaitTermination()
        except Exception:
            if each is None or not failed:
                raise
    return plain_times(s.read.parquet(f"{at}/out/scores"))


add("stream_baselines", baselines, HOURLY + f""", t AS (SELECT brand, window_start, views, CASE WHEN window_start < '{FIRST}' THEN 0 WHEN window_start < '{SECOND}' THEN 1 ELSE 2 END AS batch FROM gold),
u AS (SELECT *, count(views) OVER w AS seen, avg(views) OVER w AS m, stddev_samp(views) OVER w AS sd FROM t WINDOW w AS (PARTITION BY brand ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
z AS (SELECT brand, window_start, views, seen, batch, CASE WHEN sd IS NULL OR sd = 0 THEN 0 ELSE round((views - m) / sd, 9) END AS z_score FROM u)
FINAL SELECT * FROM z WHERE abs(z_score) > 2""", ("z_score",))


# Rows behind the watermark: a seventh of the first days comes ten days late, another seventh of an evening a little late.
HELD = f"(event_time < '{FIRST}' AND ((product_id % 7 = 0 AND event_time < '2024-01-08') OR (product_id % 7 = 1 AND event_time >= '2024-01-10 18:00:00')))"


def part() -> str:
    return f"CASE WHEN event_time < '{FIRST}' AND NOT coalesce({HELD}, false) THEN 0 WHEN event_time < '{SECOND}' THEN 1 ELSE 2 END"


def split(s: SparkSession, d: str) -> str:
    at, rows = scratch.path(s, "split"), timed(s, d)
    stream = in_parts(s, at, [rows.filter(F.expr(part()) == k) for k in range(3)], files(s, d))
    stateful.start_split(stream, f"{at}/out", f"{at}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return f"{at}/out"


def late_table(s: SparkSession, d: str) -> DataFrame:
    return plain_times(s.read.parquet(f"{split(s, d)}/late")).select("event_time", "user_id", "product_id", "event_type", "batch")


def split_sizes(s: SparkSession, d: str) -> DataFrame:
    at = split(s, d)
    sides = [s.read.parquet(f"{at}/{side}").groupBy("batch").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side)) for side in ("on_time", "late")]
    return sides[0].unionByName(sides[1])


def late_merged(s: SparkSession, d: str) -> DataFrame:
    at = split(s, d)
    on_time, late = (s.read.parquet(f"{at}/{side}").drop("batch") for side in ("on_time", "late"))
    return plain_times(stateful.with_late(funnel.hourly_brand(funnel.clean(on_time)), late))


LATE = BASE + f""", p AS (SELECT *, {part()} AS batch FROM raw), m AS (SELECT batch, max(max(event_time)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM p GROUP BY 1),
q AS (SELECT p.*, coalesce(time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR <= seen - INTERVAL 2 HOUR, false) AS is_late FROM p JOIN m USING (batch))"""
add("stream_late_table", late_table, LATE + "\nFINAL SELECT event_time, user_id, product_id, event_type, batch FROM q WHERE is_late")
add("stream_split_sizes", split_sizes, LATE + "\nFINAL SELECT batch, count(*) AS n, CASE WHEN is_late THEN 'late' ELSE 'on_time' END AS side FROM q GROUP BY 1, 3")
add("stream_late_merged", late_merged, HOURLY + "\nFINAL SELECT * FROM gold", GOLD)


# Sessions, and pairs of two streams.
SESSIONS = BASE + """, o AS (SELECT *, CASE WHEN event_time < lag(event_time) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM cleaned WINDOW w AS (PARTITION BY user_id ORDER BY event_time)),
i AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM o),
v AS (SELECT min(event_time) AS session_start, max(event_time) + INTERVAL 30 MINUTE AS session_end, user_id, count(*) AS events, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS carts,
  count(*) FILTER (event_type = 'purchase') AS purchases, sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue FROM i GROUP BY user_id, island)"""
PAIRS = BASE + """, a AS (SELECT event_time AS view_time, user_session, product_id AS view_product, price AS view_price FROM cleaned WHERE event_type = 'view'),
b AS (SELECT event_time AS purchase_time, user_session AS s, product_id AS purchase_product, price AS purchase_price FROM cleaned WHERE event_type = 'purchase'),
j AS (SELECT a.*, b.* EXCLUDE (s) FROM a LEFT JOIN b ON user_session = s AND purchase_time BETWEEN view_time AND view_time + INTERVAL 6 HOUR)"""
PRICES = ("view_price", "purchase_price")


def told(df: DataFrame, s: SparkSession, d: str, column: str, hours: int) -> DataFrame:
    """What the watermark has surely passed."""
    return closed(df.withColumnRenamed(column, "window_start"), s, d, hours).withColumnRenamed("window_start", column)


def past(column: str, hours: int) -> str:
    return f"{column} < (SELECT max(event_time) FROM silver) - INTERVAL {hours} HOUR"


add("session_funnels", lambda s, d: plain_times(stateful.sessions(timed(s, d))), SESSIONS + "\nFINAL SELECT * FROM v", ("revenue",))
add("stream_sessions", lambda s, d: told(ordered(s, d, stateful.sessions), s, d, "session_end", 3), SESSIONS + f"\nFINAL SELECT * FROM v WHERE {past('session_end', 3)}", ("revenue",))
add("view_purchase_pairs", lambda s, d: plain_times(stateful.views_to_purchases(timed(s, d))), PAIRS + "\nFINAL SELECT * FROM j WHERE purchase_time IS NOT NULL", PRICES)
add("stream_view_purchase_pairs", lambda s, d: ordered(s, d, stateful.views_to_purchases), PAIRS + "\nFINAL SELECT * FROM j WHERE purchase_time IS NOT NULL", PRICES)
add("stream_views_without_purchase", lambda s, d: told(ordered(s, d, lambda x: stateful.views_to_purchases(x, kind="left_outer")), s, d, "view_time", 24), PAIRS + f"\nFINAL SELECT * FROM j WHERE {past('view_time', 24)}", PRICES)


# Progress: a batch for each five days, and a stop after three batches.
def progress(s: SparkSession, d: str) -> DataFrame:
    at, rows = scratch.path(s, "progress"), timed(s, d)
    stream = in_parts(s, at, [rows.filter(five_days() == k) for k in range(6)], files(s, d))
    log = stateful.ProgressLog(f"{at}/progress", 3, "watched")
    begin = lambda: streaming.tumbling(stream).writeStream.queryName("watched").format("parquet").outputMode("append").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(processingTime="0 seconds").start()
    stateful.watch(s, begin, log)
    return s.read.parquet(f"{at}/progress").select("name", "batch", "rows", "late")


add("stream_progress", progress, BASE + """, p AS (SELECT least((day(event_time) - 1) // 5, 5) AS f, count(*) AS rows FROM raw GROUP BY 1)
FINAL SELECT 'watched' AS name, f::BIGINT AS batch, rows, 0::BIGINT AS late FROM p WHERE f < 3""")
