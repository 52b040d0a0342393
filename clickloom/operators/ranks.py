"""Exact ranks and row numbers without a sort of everything, or of a whole hot group, in one task.

Rows are sorted by ranges: each task sorts its own range, and what stands before a range is a sum over as many rows as
there are ranges. The ranges are written before they are counted, so that a lost executor cannot draw them anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch

_POSITION = 2**33  # monotonically_increasing_id: the partition's number times this, plus the row's place in it


def _ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df in ranges of `order`, with _range and the place _at in it, as a written table."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at)
    return scratch.save(placed.withColumns({"_range": F.floor(F.col("_at") / _POSITION), "_at": F.col("_at") % _POSITION}), name)


def _before(totals: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Sums of the ranges before each one: as many rows as ranges (for each group that a range holds)."""
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def row_numbers(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """df with exact numbers from 1 in the given order; rows that tie in it are numbered in any order."""
    rows = _ranged(df, order, "numbered")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    one = _before(sizes.withColumn("_all", F.lit(1)), "n", ["_all"]).select("_range", "_before")
    # As many rows as there are shuffle partitions.
    return rows.join(F.broadcast(one), "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")


def first_share(df: DataFrame, order: list[Column], share: float, name: str = "is_train") -> DataFrame:
    """Marks exactly floor(share * n) rows, the first ones in the order."""
    numbered = row_numbers(df, order, "_number")
    size = numbered.agg(F.floor(F.count(F.lit(1)) * F.lit(share)).alias("_limit"))
    return numbered.join(F.broadcast(size)).withColumn(name, F.col("_number") <= F.col("_limit")).drop("_number", "_limit")


def percent_ranks(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """(rank - 1) / (n - 1) of the value within its group, 0 in a group of one, null for a missing value; missing values do not count. A missing group is a group.

    Values are counted before anything is sorted; counts are summed up by ranges of (group, value), so a hot group is
    spread over as many tasks as it fills, and answers are joined back by group and value.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(by).alias("_by"), F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _ranged(counts, [F.col("_by"), F.col("_value")], "counted")
    inside = Window.partitionBy("_range", "_by").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    less = ranged.withColumn("_less", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    totals = _before(ranged.groupBy("_range", "_by").agg(F.sum("_n").alias("_sum")), "_sum", ["_by"])
    group = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.withColumn("_size", F.sum("_sum").over(group)).select(F.col("_range").alias("_r"), F.col("_by").alias("_b"), "_before", "_size")
    known = less.join(totals, (F.col("_range") == F.col("_r")) & F.col("_by").eqNullSafe(F.col("_b")))
    rank = F.when(F.col("_size") > 1, (F.col("_before") + F.col("_less")) / (F.col("_size") - 1)).otherwise(F.lit(0.0))
    ranks = known.select("_by", "_value", rank.alias(name))
    return df.join(ranks, F.col(by).eqNullSafe(F.col("_by")) & (F.col(value) == F.col("_value")), "left").drop("_by", "_value")
