"""Count, mean and squared deviation that can be merged, so that a baseline is kept and added to instead of counted again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n", "mean", "m2", "least", "most")


def of(value: str) -> list[Column]:
    """Aggregates of one column; nulls do not count. They are combined before a shuffle."""
    n = F.count(value)
    return [n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("m2"), F.min(value).alias("least"), F.max(value).alias("most")]


def add(a: Column, b: Column) -> Column:
    """The moments of both; either may be null or empty."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    both = F.struct(n.alias("n"), (a["mean"] + delta * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"), F.least(a["least"], b["least"]).alias("least"), F.greatest(a["most"], b["most"]).alias("most"))
    return F.when(a.isNull() | (F.coalesce(a["n"], F.lit(0)) == 0), b).when(b.isNull() | (F.coalesce(b["n"], F.lit(0)) == 0), a).otherwise(both)


def deviation(n: Column, m2: Column) -> Column:
    """Of a sample; null with fewer than two rows."""
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def merged(parts: DataFrame, *by: str, order: str) -> DataFrame:
    """Moments of each group from those of its parts (a few hundred days, say), in the order given, so that runs agree to the last bit."""
    one = F.struct(*FIELDS)
    listed = parts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), one.alias("x")))).alias("parts"))
    kind = parts.select(one.alias("x")).schema["x"].dataType.simpleString()  # every field may be null
    whole = F.aggregate("parts", F.lit(None).cast(kind), lambda found, part: add(found, part["x"]).cast(kind))
    return listed.select(*by, whole.alias("x")).select(*by, *[F.col(f"x.{f}").alias(f) for f in FIELDS])
