"""Event schemas, readers, the adapter of the test tables, and the synthetic producer."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    """A schema of plain columns; needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (x.split() for x in text.split(", "))])


EVENT_SCHEMA = _schema("event_time timestamp, event_type string, product_id long, category_id long, category_code string, brand string, price double, user_id long, user_session string")
#: As sent through a broker: the time is text.
MESSAGE_SCHEMA = _schema("event_time string, event_type string, user_id long, user_session string, product_id long, category_id long, category_code string, brand string, price double")
REALTIME_SCHEMA = _schema("event_time timestamp, event_type string, brand string, user_session string, price double")
EVENT_TYPES = ("view", "cart", "purchase", "remove_from_cart")


def read_csv(spark: SparkSession, glob: str) -> DataFrame:
    """Raw monthly files with a header; the schema is declared, so there is no pass to infer it."""
    raw = T.StructType([T.StructField(f.name, T.StringType() if f.name == "event_time" else f.dataType) for f in EVENT_SCHEMA])
    text = spark.read.schema(raw).option("header", True).csv(glob)
    plain = F.when(F.col("event_time").endswith(" UTC"), F.expr("left(event_time, length(event_time) - 4)")).otherwise(F.col("event_time"))
    return text.withColumn("event_time", F.try_to_timestamp(plain)).withColumn("event_date", F.to_date("event_time"))


def safe_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def source_or_bronze(spark: SparkSession, glob: str, bronze: str) -> DataFrame:
    """Raw files where they exist, else the bronze table."""
    try:
        return read_csv(spark, glob)
    except AnalysisException:
        return spark.read.parquet(bronze)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def with_columns_or(df: DataFrame, **defaults) -> DataFrame:
    """Adds those columns that are missing, with their defaults."""
    return df.withColumns({k: F.lit(v) for k, v in defaults.items() if k not in df.columns})


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def existing(df: DataFrame, *names: str) -> DataFrame:
    """The wanted columns that there are."""
    return df.select(*[n for n in names if n in df.columns])


def between_dates(df: DataFrame, first: str, last: str, column: str = "event_date") -> DataFrame:
    """Inclusive; a partition filter where the column is one."""
    return df.filter(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def synthetic(spark: SparkSession, n: int = 1000) -> DataFrame:
    i = F.col("id")
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + i).alias("event_time"), F.when(i % 3 != 0, "view").otherwise("purchase").alias("event_type"), (i % 200).alias("product_id"), F.lit(1).cast("long").alias("category_id"),
        F.lit("cosmetics.nail.polish").alias("category_code"), F.lit("testbrand").alias("brand"), F.lit(10.0).alias("price"), (i % 100).alias("user_id"), F.concat(F.lit("session-"), i % 50).alias("user_session"),
    )


def from_test_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` and `part` tables as shop events. Every tenth product has no brand, so that nulls occur.

    The join side is left to Spark: it broadcasts `part` only while it is under the session's threshold.
    """
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.when(F.col("event_type") == "click", "cart").when(F.col("event_type").isin("signup", "error"), "remove_from_cart").otherwise(F.col("event_type"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("ts").alias("event_time"), kind.alias("event_type"), k.alias("product_id"), (k % 6).alias("category_id"), F.col("value").alias("price"), "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("user_session"), F.to_date("ts").alias("event_date"),
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("brand"), F.lower("p_type").alias("category_code"))
    return events.join(part, "product_id", "left")


def parse_messages(messages: DataFrame, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
    """Broker rows with a JSON value to events with a real time."""
    rows = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")
    return rows.withColumn("event_time", F.try_to_timestamp(F.col("event_time").cast("string"))).withColumn("event_date", F.to_date("event_time"))


def to_messages(events: DataFrame) -> DataFrame:
    """key: the session; value: the event as JSON."""
    body = [F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"), *[F.col(f.name) for f in MESSAGE_SCHEMA if f.name != "event_time"]]
    return events.select(F.col("user_session").cast("string").alias("key"), F.to_json(F.struct(*body)).alias("value"))


def broker_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Needs Spark's connector for the broker on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).load()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = 2) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)
