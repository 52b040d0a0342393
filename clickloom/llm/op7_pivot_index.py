"""Exact top-k by integer inner product over a pivot-distance index.

The index keys each vector by its nearest pivot and its distance from it; a search expands the annuli around each query
in rounds, nearest first, tightens the bound on the k-th distance after each, and stops when the triangle inequality says that no
annulus left can hold a better one (``distance_keys``, where the bounds are explained).

Edge cases: vectors that are null or empty, or hold null or non-finite components, or whose squared length (of integers)
reaches 2**50 take part in nothing; vectors of another length than the query's have no product with it; ties go to the
smaller id; equal vectors are kept apart by id; rows that repeat an id are candidates each, but never of that id's own query, and as a
query an id counts once, with its least vector; a null vec_id takes no part; fewer than k candidates give fewer rows;
an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import distance_keys
from .common import save


def top_products(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, first: int = 4096, **sizes: int) -> DataFrame:
    """rows: vec_id, embedding; is_query: a condition on id; first: rows that the first round scans for a query; sizes: of the index.

    Returns query_id, rank, vec_id, score: each query's k highest inner products over all other rows.
    """
    spark = rows.sparkSession
    index = distance_keys.build(save(distance_keys.integer_vectors(rows, scale), "vectors"), **sizes)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    one = index.rows.filter(is_query).groupBy(F.col("id").alias("query_id")).agg(F.min("data").alias("data"))
    bounds = {name: F.array(F.lit(x).cast("long")) for name, x in zip(("lo", "hi"), distance_keys.ANY, strict=True)}
    found = distance_keys.search(index, one.withColumns({"label": F.lit(0)} | bounds), k, first=first)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
