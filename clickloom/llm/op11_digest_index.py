"""Exact dedup against a persistent digest index, in DataFrame operations only.

The index is a table of one row a known text: the SHA-256 of the text without white space, the id that stays, its length
and how many rows had it when it came in. It is bucketed and sorted by digest, lies in a folder of its own, and is opened
again by later sessions. A batch

1. becomes (id, length, digest) rows, written once, so that texts are read once and never shuffled;
2. is reduced to one row a digest, combined before the shuffle, so that a text that a third of all rows share is one row
   a task;
3. meets the index in a sort-merge anti-join, whose index side is not shuffled (its buckets are the partitions), and what is new is appended;
4. gets its answers by one join of its rows with its digests, which adaptive execution splits where a digest is hot.

Batches are answered in order of arrival: a text that the index knows keeps its id, however long a later copy is. A batch
that is run again after a failure finds what it appended and answers the same, as keeping is decided by id.

Edge cases: null texts count as empty, and empty texts equal one another; texts of any length are hashed whole; of equal
texts the one with the most code points stays, then the smallest id; a null id comes after all others; rows that share
an id and a text are one document: they stay or go together; an empty table gives no rows and appends none; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch
from .common import save, shuffle_partitions

#: Space and the characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """32 bytes for each class of equal texts."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, ""), 256))


class DigestIndex:
    """A folder of known texts. buckets is fixed when the folder is new; later sessions must pass the same number.

    With fewer buckets than shuffle partitions Spark shuffles the index in joins, too.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets or shuffle_partitions(spark)
        self.table = f"clickloom_digests_{uuid.uuid4().hex}"

    def __enter__(self) -> DigestIndex:
        layout = f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        self.spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, keep_chars INT, n_rows BIGINT) USING parquet {layout}")
        return self

    def __exit__(self, *error) -> None:
        """Only the name goes from the catalog; the folder stays."""
        self.spark.sql(f"DROP TABLE {self.table}")

    def known(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, entries: DataFrame) -> None:
        """A file a bucket: rows are dealt as the table's buckets are."""
        self.spark.catalog.refreshTable(self.table)
        entries.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def first_of_equals(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_chars, n_rows: longest, then smallest id, null ids last."""
    best = F.min(F.struct((-F.col("chars")).alias("x"), F.col("doc_id").isNull().alias("y"), F.col("doc_id").alias("z"))).alias("best")
    found = rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("n_rows"))
    return found.select("digest", F.col("best.z").alias("keep_id"), (-F.col("best.x")).alias("keep_chars"), "n_rows")


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Judges a batch and adds it to the open index.

    Returns doc_id, keep_id, group_size (equal rows of this batch), kept, text_sha256 and known (the text came in an earlier batch).
    """
    rows = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("chars"), digest(F.col("text")).alias("digest")), "digests")
    groups = save(first_of_equals(rows), "groups")
    known = index.known().hint("merge")
    new = save(groups.join(known, "digest", "left_anti"), "new")
    old = save(groups.select("digest", "n_rows").join(known.select("digest", "keep_id"), "digest"), "old")
    index.append(new.select("digest", "keep_id", "keep_chars", "n_rows"))
    answers = new.select("digest", "keep_id", "n_rows", F.lit(False).alias("known")).union(old.select("digest", "keep_id", "n_rows", F.lit(True)))
    # Rows without an answer cannot be; the order of the sides lets a hot digest be split.
    found = rows.join(answers, "digest")
    return found.select("doc_id", "keep_id", F.col("n_rows").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "known")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the first batch of a new index."""
    with DigestIndex(spark, scratch.path(spark, "digest-index")) as index:
        return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), index).drop("known")


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, first(doc_id ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
