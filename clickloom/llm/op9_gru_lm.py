"""Language-model scoring: a gated recurrent network over the frequent words, exact counts for the rest.

1. Training documents are counted in full: every distinct word, wherever it occurs.
2. The most frequent words (`inside` of them) form the classes of the network's output softmax; end of text and "any
   other word" are words of it too. The network is trained by truncated backpropagation on all
   training documents: learners (one for each `learner_bytes` of text) begin a round with the same parameters
   and send how they changed, which is averaged by tokens; each document is learnt from once, from its
   beginning to its end.
3. Every document is scored in full, the state carried from window to window. Another word costs the
   network's probability of "any other" times its add-one share among such words.

Sizes that tasks receive are bounded by parameters: the network, and the counts of `frequent` words.
Counts of rarer words reach the documents by a join, so the vocabulary may grow without bound. Changes are
added up in steps of `fan` learners each, in streams, so that no task holds those of many.

Edge cases: null and empty texts are one token, the end; ids may be null or repeat, each row being a
document of its own; very long texts run through the same windows as others, in fewer lanes; without training
documents the counts are zero and the network is untrained; an empty table gives an empty result; other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru
from .common import id_crc_mod, ids_back, ids_of, save, shuffle_partitions, text_slices, words_of

_END, _OTHER = 0, 1
_PIECE = 1 << 14  # parameters that a message between tasks holds
_SLICE = 8192  # documents that are run together, by length
_CHANGES = "name string, piece long, learner long, tokens long, v binary"


def count_words(docs: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """word, n over all documents: counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            held.clear()
            return whole.rename_columns(["word", "n"]).to_batches()

        for batch in text_slices(batches, _SLICE):
            words, _ = words_of(batch.column(0))
            seen = words.value_counts()
            held.append(pa.table({"word": seen.field("values"), "n": seen.field("counts")}))
            if sum(map(len, held)) > flush:
                yield from merged()
        if held:
            yield from merged()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, frequent: int) -> list:
    """Rows of the `frequent` most frequent words (ties by the word), most frequent first.

    All words above a count, and of those of that very count the first ones: counts come in few values, so the table of values is small.
    """
    values = counts.groupBy("n").count().orderBy(F.desc("n")).limit(frequent).collect()
    held, floor = 0, None
    for row in values:
        if held + row["count"] > frequent:
            floor = row.n
            break
        held += row["count"]
    least = F.lit(floor) if floor is not None else F.lit(values[-1].n - 1 if values else 0)
    top = counts.filter(F.col("n") > least).collect()
    if floor is not None:
        top += counts.filter(F.col("n") == floor).orderBy("word").limit(frequent - held).collect()
    return sorted(top, key=lambda r: (-r.n, r.word.encode()))


class Words:
    """The frequent words; the first `inside` of them are the network's."""

    def __init__(self, top: list[str], inside: int):
        self.top, self.inside = pa.array(top, pa.string()), inside

    def find(self, words: pa.Array) -> np.ndarray:
        """The rank of each word, or -1."""
        return pc.index_in(words, value_set=self.top).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def numbers(self, rank: np.ndarray) -> np.ndarray:
        """What the network calls them."""
        return np.where((rank >= 0) & (rank < self.inside), rank + 2, _OTHER)

    def documents(self, texts: pa.Array) -> list[np.ndarray]:
        """Numbers of the words of each text, then the end."""
        words, n = words_of(texts)
        return with_end(self.numbers(self.find(words)), n)


def with_end(numbers: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    ends = np.cumsum(n)
    return np.split(np.insert(numbers, ends, _END), (ends + np.arange(1, len(n) + 1))[:-1]) if len(n) else []


def added(changes: DataFrame, partitions: int) -> DataFrame:
    """Sums of v over the rows of equal (name, piece, learner), one row in hand at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for name, piece, learner, tokens, v in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                x = np.frombuffer(v, np.float32)
                one = held.setdefault((name, piece, learner), [0, np.zeros(len(x))])
                one[0] += tokens
                one[1] += x
        for (name, piece, learner), (tokens, v) in held.items():
            columns = [pa.array([x], t) for x, t in ((name, pa.string()), (piece, pa.int64()), (learner, pa.int64()), (tokens, pa.int64()), (v.astype(np.float32).tobytes(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "piece", "learner", "tokens", "v"])

    return changes.repartition(partitions, "name", "piece", "learner").mapInArrow(run, _CHANGES)


def train(docs: DataFrame, words: Words, counts: np.ndarray, shape: gru.Shape, rounds: int, rate: float, learners: int, fan: int = 64) -> dict[str, np.ndarray]:
    """Parameters after `rounds` rounds; round k learns from the documents whose text hashes to k."""
    p, starts = gru.begin(shape, counts), gru.classes(counts)
    spark = docs.sparkSession

    for k in range(rounds):
        sent = spark.sparkContext.broadcast((p, starts, words))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            begun, starts, words = sent.value
            trainer, learner = gru.Trainer(begun, starts, shape, rate), TaskContext.get().partitionId()
            held: list[np.ndarray] = []
            size = 0
            for batch in text_slices(batches, _SLICE):
                held += words.documents(batch.column(0))
                size += len(batch)
                if size >= _SLICE:
                    trainer.learn(held, _END)
                    held, size = [], 0
            if held:
                trainer.learn(held, _END)
            if trainer.tokens:
                for name, value in trainer.p.items():
                    flat = ((value - begun[name]).ravel() * np.float32(trainer.tokens)).astype(np.float32)
                    values = [flat[a : a + _PIECE].tobytes() for a in range(0, len(flat), _PIECE)]
                    n = len(values)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(n), pa.int64()), pa.array([learner] * n, pa.int64()), pa.array([trainer.tokens] * n, pa.int64()), pa.array(values, pa.binary())], names=["name", "piece", "learner", "tokens", "v"])

        part = docs.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        changes, left = part.coalesce(learners).mapInArrow(learn, _CHANGES), learners
        while left > 1:
            left = ceil(left / fan)
            changes = added(changes.withColumn("learner", F.floor(F.col("learner") / fan)), shuffle_partitions(spark))
            if left > 1:
                changes = save(changes, "changes")
        p = {name: value.copy() for name, value in p.items()}
        for row in changes.toLocalIterator():
            mean = np.frombuffer(row.v, np.float32) / np.float32(row.tokens)
            p[row.name].reshape(-1)[row.piece * _PIECE : row.piece * _PIECE + len(mean)] += mean
        sent.unpersist()
    return p


def score_documents(docs: DataFrame, folds: int = 7, held_out: int = 2, shape: gru.Shape = gru.Shape(), rounds: int = 2, rate: float = 0.5, frequent: int = 1 << 16, inside: int = (1 << 15) - 2, learner_bytes: int = 16 << 20, hashed: int = 1 << 19) -> DataFrame:
    """docs: doc_id, text; learns from documents outside fold `held_out` of crc32(doc_id) modulo folds.

    The network knows the first `inside` words; the counts of `frequent` words are sent to the tasks, those of others are joined.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).
    """
    spark = docs.sparkSession
    learnt = docs.filter(id_crc_mod("doc_id", folds) != held_out)
    counts = save(count_words(learnt), "counts")
    n_docs = learnt.count()
    # A byte between words: texts are not read again for their size.
    totals = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.col("n") * (F.octet_length("word") + 1))).first()
    n_words, n_distinct, n_bytes = totals[0] or 0, totals[1], totals[2] or 0
    n, v = n_words + n_docs, n_distinct + (1 if n_docs else 0)
    top = frequent_words(counts, frequent)
    top_n = np.array([r.n for r in top], np.int64)
    words = Words([r.word for r in top], min(inside, len(top)))
    known = np.concatenate([[n_docs, n_words - top_n[:inside].sum()], top_n[:inside]]).astype(float)
    starts = gru.classes(known)
    p = train(learnt, words, known, shape, rounds, rate, max(1, ceil(n_bytes / rounds / learner_bytes)))
    sent = spark.sparkContext.broadcast((p, words, top_n))
    all_log = float(np.log10(n + v + 1))
    other_log = float(np.log10(n_words - int(top_n[:inside].sum()) + (n_distinct - words.inside) + 1))
    end_log = float(np.log10(n_docs + 1)) - all_log

    schema = "row long, doc_id long, n_tokens long, n_known long, base double, score double, rare array<struct<word:string,times:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        p, words, top_n = sent.value
        logs = np.log10(top_n + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, _SLICE):
            found, sizes = words_of(batch.column(1))
            rank = words.find(found)
            seen = rank >= 0
            of = np.repeat(np.arange(len(sizes)), sizes)
            n_seen = np.bincount(of[seen], minlength=len(sizes))
            base = np.bincount(of[seen], weights=logs[rank[seen]], minlength=len(sizes)) - n_seen * all_log + end_log
            # The others are counted for the join.
            mask = pa.array(~seen)
            rare = pa.table({"of": pa.array(of).filter(mask), "word": found.filter(mask)}).group_by(["of", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("of").combine_chunks()
            ends = np.concatenate([[0], np.cumsum(np.bincount(rare["of"].to_numpy(), minlength=len(sizes)))])
            pairs = pa.StructArray.from_arrays([pa.concat_arrays([pa.array([], pa.string()), *rare["word"].chunks]), pa.concat_arrays([pa.array([], pa.int64()), *rare["count_all"].chunks])], names=["word", "times"])
            deep = rank >= words.inside
            spread = np.bincount(of[deep], weights=logs[rank[deep]] - other_log, minlength=len(sizes))
            score = gru.score(p, starts, shape, with_end(words.numbers(rank), sizes), _END) / np.log(10) + spread
            rows = np.arange(row, row + len(sizes))
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), ids_back(ids_of(batch.column(0))), pa.array(sizes + 1, pa.int64()), pa.array(n_seen + (n_docs > 0), pa.int64()), pa.array(base), pa.array(score), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare"],
            )

    scored = save(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema), "scored")
    each = scored.select("row", F.explode("rare").alias("e")).select("row", "e.word", "e.times")
    # Counts are hashed instead of sorting both sides; partitions are so many that each holds about `hashed` words of them.
    parts = max(shuffle_partitions(spark), ceil(n_distinct / hashed))
    joined = each.repartition(parts, "word").join(counts.repartition(parts, "word").hint("shuffle_hash"), "word", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    logs = F.log10(F.col("n") + F.lit(1.0))
    by_row = joined.groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("r_known"), F.sum(F.col("times") * (logs - all_log)).alias("r_base"), F.sum(F.col("times") * (logs - other_log)).alias("r_score"))
    whole = scored.drop("rare").join(by_row, "row", "left")

    def both(a: str, b: str):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return whole.select("doc_id", (id_crc_mod("doc_id", folds) == held_out).alias("held_out"), "n_tokens", both("n_known", "r_known").cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), both("base", "r_base").alias("base_score"), both("score", "r_score").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
