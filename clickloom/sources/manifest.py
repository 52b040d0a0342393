"""What each day of a table was built from, so that a rebuild touches only what has changed.

A manifest has a row a day: number and hashes of the rows it was built from. Its versions are folders of their own, and the
newest whole one counts, so a run that dies leaves the one before it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "day date, n long, mix long, total long"
Days = dict[dt.date | None, tuple[int, int, int]]


def fingerprints(df: DataFrame, by: str) -> Days:
    """Number and two hashes of each day's rows, in any order of rows; one aggregate, a row a day comes to the driver."""
    mark = F.xxhash64(*[c for c in df.columns if c != by])
    found = df.groupBy(F.col(by).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("mix"), F.sum(mark.bitwiseAND(F.lit(0x7FFFFFFF))).alias("total"))
    return {r.day: (r.n, r.mix, r.total) for r in found.collect()}


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def days_of(spark: SparkSession, path: str, by: str) -> set[dt.date | None]:
    """The days for which a partitioned table has a folder."""
    values = [name.removeprefix(f"{by}=") for name in names(spark, path) if name.startswith(f"{by}=")]
    return {None if v == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(v) for v in values}


def drop_days(spark: SparkSession, path: str, by: str, days: set[dt.date | None]) -> None:
    for day in days & days_of(spark, path, by):
        delete(spark, f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}")


@dataclass(frozen=True)
class Manifest:
    spark: SparkSession
    path: str

    def _versions(self) -> list[int]:
        found = (int(n.removeprefix("version=")) for n in names(self.spark, self.path) if n.startswith("version="))
        return sorted(v for v in found if "_SUCCESS" in names(self.spark, f"{self.path}/version={v}"))

    def read(self) -> Days:
        versions = self._versions()
        if not versions:
            return {}
        rows = self.spark.read.schema(FIELDS).parquet(f"{self.path}/version={versions[-1]}").collect()
        return {r.day: (r.n, r.mix, r.total) for r in rows}

    def write(self, days: Days) -> None:
        before = self._versions()
        new = (before[-1] if before else 0) + 1
        rows = self.spark.createDataFrame([(d, *x) for d, x in days.items()], FIELDS)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/version={new}")
        for old in before:
            delete(self.spark, f"{self.path}/version={old}")


def within(df: DataFrame, by: str, days: set[dt.date | None]) -> DataFrame:
    """Rows of these days; a partition filter where `by` is one."""
    known = sorted(d for d in days if d is not None)
    keep = F.col(by).isin(known) if known else F.lit(False)
    return df.filter(keep | F.col(by).isNull() if None in days else keep)

