"""Hard negatives by one-dimensional distance keys.

Anchors' nearest rows of the same label are their positives; for each positive, hard negatives are the nearest rows of other
labels whose product lies between two shares of the positive's. Both are exact searches over one index of
(pivot, distance) keys (``distance_keys``): the first over all products, the second in a window of products for each positive,
all windows of an anchor at once.

Edge cases: rows whose label, id or vector is null, whose vector is empty or holds a null or non-finite component, or
whose squared length (of integers) reaches 2**50 take no part; vectors of another length than the anchor's have no
product with it; ties go to the smaller id; equal vectors are kept apart by id; rows that repeat an id are candidates
each, but never of that id's own anchor, and as an anchor an id counts once, with its least (label, vector); an anchor
without positives has no rows, a positive without negatives in its window has none; a positive of a negative product has
an empty window; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import distance_keys
from .common import save

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, **sizes: int) -> DataFrame:
    """rows: vec_id, embedding, label; is_anchor: a condition on id; label: the label, else the column of that name; low, high: percent of the positive's product; sizes: of the index."""
    spark = rows.sparkSession
    vectors = save(distance_keys.integer_vectors(rows, scale, F.col("label") if label is None else label), "vectors")
    index = distance_keys.build(vectors, **sizes)
    if index is None:
        return spark.createDataFrame([], RESULT)
    one = F.min(F.struct("label", "data")).alias("one")
    anchors = index.rows.filter(is_anchor).groupBy(F.col("id").alias("query_id")).agg(one).select("query_id", "one.label", "one.data")
    lowest, highest = (F.array(F.lit(x).cast("long")) for x in distance_keys.ANY)
    asked = save(anchors.withColumns({"lo": lowest, "hi": highest}), "anchors")
    near = distance_keys.search(index, asked, positives, "same").select("query_id", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score")
    # Whole numbers: the least at or above `low` percent, the greatest at or below `high` percent.
    window = F.struct("rank", F.when(score < 0, 1).otherwise(F.expr(f"({low} * positive_score + 99) div 100")).alias("lo"), F.when(score < 0, 0).otherwise(F.expr(f"({high} * positive_score) div 100")).alias("hi"))
    windows = near.groupBy("query_id").agg(F.sort_array(F.collect_list(window)).alias("w"))  # `positives` entries at most
    inside = asked.select("query_id", "label", "data").join(windows, "query_id").select("query_id", "label", "data", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    far = distance_keys.search(index, inside, negatives, "different").withColumnsRenamed({"rank": "place", "id": "negative_id", "score": "negative_score"})
    found = far.join(near, (far["query_id"] == near["query_id"]) & (far["w"] + 1 == near["rank"]))
    return found.select(near["query_id"].alias("anchor_id"), "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, moved)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * REPLACE (rank::INTEGER AS rank) FROM n WHERE rank <= 10
"""
