"""Suffix-array dedup: bytes covered by a string of 50 bytes that also starts in a smaller document.

``repeats`` brings all contexts that could share such a string to one shard. There the contexts are
suffix-sorted by the difference-cover algorithm (sorted triples of a sample, recursion on their
names, merge of the rest), and neighbours in suffix order whose first 50 bytes agree form the groups
of equal strings; the smallest document of a group decides. The sort is distributed by content: a
shard holds whole groups, so no order across shards is needed.

Edge cases: null and empty texts have no bytes; texts under 50 bytes lose nothing; rows with the same
doc_id never remove from each other; very long texts are searched whole, as chunks of their own; a null doc_id counts as larger than any other; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ids_back
from .repeats import Shard, Sizes, Units, find
from .suffix import equal_windows, suffix_array

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def byte_index(width: int):
    def index(shard: Shard) -> np.ndarray:
        """The smallest doc_id that has each window."""
        value = np.repeat(shard.least, shard.width)
        # No separators: only suffixes with a whole window inside their context are looked at.
        data = np.frombuffer(b"".join(shard.texts), np.uint8)
        # A context has width - 1 more bytes than windows.
        slot = np.full(len(data), -1, np.int64)
        slot[np.arange(len(value)) + np.repeat(np.arange(len(shard.width)) * (width - 1), shard.width)] = np.arange(len(value))
        # Symbols are the ranks of the bytes that occur, so that few triples are possible.
        symbol = np.cumsum(np.bincount(data, minlength=256) > 0).astype(np.uint64)
        order = suffix_array(symbol[data])
        order = order[slot[order] >= 0]
        group = equal_windows(data, order, width)
        firsts = np.flatnonzero(np.diff(group, prepend=-1))
        least = np.minimum.reduceat(value[slot[order]], firsts)
        value[slot[order]] = least[group]
        return value

    return index


def suffix_array_dedup(docs: DataFrame, width: int = 50, gram: int = 20, sizes: Sizes = Sizes()) -> DataFrame:
    """Removes every byte of a `width`-byte string that also starts in a document with a smaller id.

    docs: doc_id, text. Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept,
    the remaining bytes (a cut may fall inside a character, so they are binary).
    """

    def finish(chunk, gone):
        before = np.concatenate([[0], np.cumsum(gone)])
        ends = np.concatenate([[0], chunk.ends])
        removed = np.diff(before[ends])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        firsts = ends[:-1][np.diff(ends) > 0]
        opens[firsts] = gone[firsts]
        spans = np.diff(np.concatenate([[0], np.cumsum(opens)])[ends])
        kept = chunk.data[~gone].tobytes()
        cuts = (ends - before[ends]).tolist()
        texts = [kept[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays([ids_back(chunk.ids), pa.array(np.diff(ends)), pa.array(removed), pa.array(spans), pa.array(texts, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return find(docs, Units(width, gram, False), byte_index(width), finish, SCHEMA, True, sizes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT doc_id, s, hash(substr(x, 2 * s + 1, 100)) AS h
  FROM d, unnest(range(0, length(x) // 2 - 49)) AS t(s)),
m AS (SELECT h, min(doc_id) AS least, max(doc_id) AS most FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, s FROM w JOIN m USING (h) WHERE doc_id > least),
islands AS (
  SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS island
  FROM (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 50 THEN 0 ELSE 1 END AS opens FROM hit)),
spans AS (SELECT doc_id, island, min(s) AS a, max(s) + 50 AS b FROM islands GROUP BY doc_id, island),
g AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS stops FROM spans GROUP BY doc_id),
k AS (
  SELECT d.doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_spans IS NULL THEN x ELSE array_to_string(list_transform(range(1, len(starts) + 2),
      lambda i: substr(x, 2 * (CASE WHEN i = 1 THEN 0 ELSE stops[i - 1] END) + 1,
        2 * ((CASE WHEN i > len(starts) THEN length(x) // 2 ELSE starts[i] END) - (CASE WHEN i = 1 THEN 0 ELSE stops[i - 1] END)))), '') END AS kept
  FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256 FROM k
"""
