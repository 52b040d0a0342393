"""The shared scratch folder: durable cuts of a plan that every machine of a cluster can read.

Everything of a session lies below one folder, so ``clear`` removes it when its results have been read.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The session's folder below ``spark.checkpoint.dir``; without that setting one is made, in local mode only."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="clickloom-")
        context.setCheckpointDir(found)
    return f"{found.rstrip('/')}/clickloom-{context.applicationId}"


def path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet and reads it back: lineage ends here, and lost executors cost nothing before it."""
    at = path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def clear(spark: SparkSession) -> None:
    """Deletes all scratch of the session, and the names of tables that lie in it; results that still read it must have been written elsewhere."""
    own = folder(spark)
    for table in spark.catalog.listTables():
        if table.name.startswith("clickloom_") and not table.isTemporary:
            where = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").filter("col_name = 'Location'").first()
            if where and where.data_type.removeprefix("file:").lstrip("/").startswith(own.removeprefix("file:").lstrip("/") + "/"):
                spark.sql(f"DROP TABLE {table.name}")
    at = spark._jvm.org.apache.hadoop.fs.Path(own)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
