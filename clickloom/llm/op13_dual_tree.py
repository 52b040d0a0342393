"""Lloyd's clustering by two trees: a cover tree over each block of vectors and one over the centroids of the round.

The trees over vectors are built once, block by block where the rows lie, and stored; no row is shuffled. Each round
sends the centroids (k of them, so bounded by parameters) to the blocks, where pairs of nodes go down both trees together
(``cover_tree``); a task returns count and sums for each cluster, which are added before and after one shuffle of k rows a task. Sums and
squared distances are whole numbers, so results do not depend on blocks or order.

Edge cases: vectors that are null, have another length than `dim`, hold a null or non-finite component, or whose squared
length (of integers) reaches 2**50 are not kept; a null vec_id is clustered like any other, but starts a cluster only if
there are too few others; rows that repeat an id are clustered each, and of rows whose hashes tie the least vector starts first; equal centroids
tie to the smaller number, so the other one stays empty and where it is; fewer rows than k give as many clusters as rows; an empty
table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_tree
from .common import save
from .distance_keys import LONGEST

RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
_ARRAYS = {"order": np.int64, "start": np.int64, "stop": np.int64, "radius": np.float64, "child": np.int64, "last": np.int64}
_BLOCK = "ids array<long>, points binary, " + ", ".join(f"{a} binary" for a in _ARRAYS)


def kept_vectors(rows: DataFrame, dim: int, scale: int) -> DataFrame:
    """vec_id and v (array of integers) of the rows that are clustered."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    good = F.col("embedding").isNotNull() & (F.size("embedding") == dim) & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, c: s + F.pow(F.floor(c.cast("double") * scale).cast("double"), 2.0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.when(length < LONGEST, x)).alias("v")).filter("v IS NOT NULL")


def grow(vectors: DataFrame, block: int) -> DataFrame:
    """A row for each block of vectors, with its tree."""

    def trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), block):
                pdf = whole.iloc[at : at + block]
                tree = cover_tree.build(np.array(pdf["v"].tolist(), float))
                ids = pdf["vec_id"].astype("Int64").to_numpy(object, na_value=None)[tree.order]
                yield pd.DataFrame({"ids": [ids.tolist()], "points": [tree.points.astype(np.int32).tobytes()]} | {a: [getattr(tree, a).astype(t).tobytes()] for a, t in _ARRAYS.items()})

    return vectors.mapInPandas(trees, _BLOCK)


def _trees(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.Array, cover_tree.Tree]]:
    for k in range(len(batch)):
        arrays = {a: np.frombuffer(batch[a][k].as_buffer(), t) for a, t in _ARRAYS.items()}
        points = np.frombuffer(batch["points"][k].as_buffer(), np.int32).reshape(-1, dim).astype(float)
        yield batch["ids"][k].values, cover_tree.Tree(points=points, **arrays)


def totals(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, n, s0, s1, ..: a row for each cluster that has rows."""
    k, dim = centroids.shape
    few = cover_tree.build(centroids, 1)
    names = ["cluster", "n", *(f"s{c}" for c in range(dim))]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, tree in _trees(batch, dim):
                cluster, _ = cover_tree.nearest(tree, few)
                by = np.argsort(cluster, kind="stable")
                present, first, count = np.unique(cluster[by], return_index=True, return_counts=True)
                n[present] += count
                sums[present] += np.add.reduceat(tree.points[by].astype(np.int64), first, axis=0)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (there, n[there], *sums[there].T)], names=names)

    found = blocks.mapInArrow(step, ", ".join(f"{c} long" for c in names))
    return found.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in names[1:]])


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector."""
    dim = centroids.shape[1]
    few = cover_tree.build(centroids, 1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in _trees(batch, dim):
                cluster, _ = cover_tree.nearest(tree, few)
                distance = ((tree.points - centroids[cluster]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance.astype(np.int64))], names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(step, "vec_id long, cluster int, distance long")


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, block: int = 2048) -> DataFrame:
    """rows: vec_id, embedding. The k rows with the smallest hash of seed and id are the first centroids."""
    spark = rows.sparkSession
    vectors = save(kept_vectors(rows, dim, scale), "vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r.v for r in first], np.int64)
    blocks = save(grow(vectors, block), "trees")
    for _ in range(rounds):
        for r in totals(blocks, centroids).collect():  # k rows at most
            centroids[r.cluster] = [s // r.n for s in r[2:]]
    found = save(assign(blocks, centroids), "assigned")
    shares = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = shares.agg(F.sum("cluster_inertia").alias("inertia"))
    named = spark.createDataFrame([(n, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    # k rows and one.
    told = shares.join(F.broadcast(named), "cluster").join(F.broadcast(whole))
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def sql(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """All rounds, one after another, every vector against every centroid."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT rn, min((list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, c.x) + list_dot_product(c.x, c.x))::HUGEINT * 1000 + number) AS best FROM v, c{r} c GROUP BY rn)")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT number, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT number, list(mean ORDER BY i) AS x FROM (SELECT (best % 1000)::INTEGER AS number, i, floor(sum(v.x[i]) / count(*)) AS mean FROM a{r} JOIN v USING (rn), range(1, 65) t(i) GROUP BY ALL) GROUP BY number) m USING (number))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS number, x FROM v QUALIFY number < {k}),
{(',' + chr(10)).join(steps)},
f AS (SELECT vec_id, (best % 1000)::INTEGER AS cluster, (best // 1000)::BIGINT AS distance FROM a{rounds} JOIN v USING (rn)),
n AS (SELECT number, sha256(array_to_string(list_transform(x, lambda y: y::BIGINT), ',')) AS centroid_sha256 FROM c{rounds})
SELECT f.*, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM f JOIN n ON number = cluster
"""


SQL = sql()
