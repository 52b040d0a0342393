"""Substring dedup: words covered by a repeated window, found with an FM-index for each shard.

``repeats`` brings all contexts that could share a window to one shard. There an FM-index over the
distinct contexts (wavelet matrix of the Burrows-Wheeler transform) is searched backwards, and the
matching statistics say which windows occur a second time. A context that comes several times is in the index twice and
searched once as a whole.

Edge cases: null and empty texts have no words and keep the sha256 of the empty string; texts shorter
than a window lose nothing; very long texts are searched whole, as chunks of their own; ids may be null or repeat (each row is a document of its own); repeats
within a document count; an empty table gives an empty result; other columns are not read unless they are named.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .common import ids_back
from .fmindex import FMIndex, occurrences, repeated_windows
from .repeats import Shard, Sizes, Units, find

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string"


def word_index(width: int):
    def index(shard: Shard) -> np.ndarray:
        """True for each window that occurs at least twice among the documents."""
        words = [text.split() for text in shard.texts]
        codes, names = pd.factorize(np.array([w for text in words for w in [*text, b"\n"]], object))
        text = codes.astype(np.int64) + 1
        lengths = np.array([len(x) for x in words]) + 1
        starts = np.cumsum(lengths) - lengths
        # A context that comes several times is in the index twice, which is all that a search for two needs.
        several = np.flatnonzero(shard.count >= 2)
        twice = np.repeat(starts[several], lengths[several]) + np.arange(lengths[several].sum()) - np.repeat(np.cumsum(lengths[several]) - lengths[several], lengths[several])
        fm = FMIndex(np.concatenate([text, text[twice]]), len(names))
        # Where a whole context occurs twice all of its windows do; the others are searched window by window.
        whole = np.zeros(len(words), bool)
        whole[several] = occurrences(fm, text, starts[several], lengths[several] - 1) >= 2
        value = np.repeat(whole, shard.width)
        value[~value] = repeated_windows(fm, text, starts, np.where(whole, 0, shard.width), width)
        return value

    return index


def substring_dedup(docs: DataFrame, window: int = 35, gram: int = 8, sizes: Sizes = Sizes(), others: tuple[str, ...] = (), as_it_was: bool = False) -> DataFrame:
    """Removes every word in a window of `window` words that starts anywhere else too.

    docs: doc_id, text. Returns doc_id, n_words, n_removed, kept_text (kept words joined by a
    space), and the columns named in others as they are, in one struct `others`, so that no name clashes. With as_it_was, a text that loses nothing is
    kept byte for byte (a null one as the empty text).
    """
    extra = [StructField("others", StructType([docs.schema[c] for c in others]))] if others else []
    schema = StructType([*_parse_datatype_string(SCHEMA).fields, *extra])

    def finish(chunk, gone):
        before = np.concatenate([[0], np.cumsum(gone)])
        ends = np.concatenate([[0], chunk.unit_ends])
        removed = np.diff(before[ends])
        keep, texts, end = ~gone, [], 0
        for k, stop in enumerate(chunk.ends.tolist()):
            text = chunk.raw[end:stop]
            if removed[k]:
                text = b" ".join(compress(text.split(), keep[ends[k] : ends[k + 1]].tolist()))
            elif not as_it_was:
                text = b" ".join(text.split())
            texts.append(text)
            end = stop
        return pa.RecordBatch.from_arrays([ids_back(chunk.ids), pa.array(np.diff(ends)), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string()), *chunk.others()], names=[f.name for f in schema.fields])

    return find(docs, Units(window, gram, True), word_index(window), finish, schema, False, sizes, others)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.selectExpr("doc_id", "n_words", "n_removed", "sha2(kept_text, 256) AS kept_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
w AS (
  SELECT doc_id, words, s, sha256(array_to_string(words[s:s + 34], ' ')) AS h
  FROM d, unnest(range(1, len(words) - 33)) AS t(s)),
r AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, list(s) AS starts FROM w SEMI JOIN r ON w.h = r.h GROUP BY doc_id),
c AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(starts) AS s FROM hit), unnest(range(s, s + 35)) AS t(p)),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (
  SELECT d.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    list_where(words, list_transform(range(1, len(words) + 1), lambda i: NOT coalesce(list_contains(gone, i), false))) AS kept
  FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
