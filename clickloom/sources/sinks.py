"""Writers: partitioned tables, incremental ingest, stream input files, exports, broker sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SALTS = 32  # files a day of a large table has at most


def placed(df: DataFrame, by: str, *first: str) -> DataFrame:
    """Rows where the files of a table are written, by partition and a salt of these columns, so a day is a few files and no hot task."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*first), F.lit(SALTS))).repartition(by, "_salt")


def write_placed(df: DataFrame, path: str, by: str, whole: bool = False) -> None:
    """Replaces only the partitions that df holds, or the whole table."""
    df.drop("_salt").write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(by).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, whole: bool = False) -> None:
    """Files are in order of the first two columns, so rows that are alike lie side by side and take little room."""
    first = df.columns[:2]
    write_placed(placed(df, by, *first).sortWithinPartitions(by, *[c for c in first if c != by]), path, by, whole)


def ingest(df: DataFrame, path: str, by: str = "event_date") -> None:
    """Adds a month; running it again replaces its partitions and duplicates nothing."""
    write_partitioned(df, path, by)


def write_stream_input(df: DataFrame, path: str, files: int = 50) -> None:
    """Files in order of time, so that a watermark over them drops nothing."""
    df.repartitionByRange(files, "event_time").sortWithinPartitions("event_time").write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """An object a line; nested fields stay nested, and nulls stay."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def send_batch(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def start_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, by: str | None = None):
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"}))
    return (writer.partitionBy(by) if by else writer).start()


def start_console(df: DataFrame, truncate: bool = False):
    return df.writeStream.format("console").outputMode("append").option("truncate", truncate).start()


def start_broker(df: DataFrame, servers: str, topic: str, checkpoint: str):
    rows = df.select(F.to_json(F.struct("*")).alias("value"))
    return rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", f"{checkpoint}/{topic}").start()
