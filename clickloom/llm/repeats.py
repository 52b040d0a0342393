"""Finding all repeated fixed-length windows of a corpus, on Spark, with every link kept.

Documents are packed into chunks (a bucketed scratch table, so later passes over the text need no
shuffle). Windows are split into runs by their minimal q-gram hash (``winnow``), and then:

1. each chunk sends its distinct minima, with 16 bits of a hash of each context, to key groups by hash; a group
   answers which of them occur more than once in the corpus, and which have very many different contexts;
2. each chunk sends the contexts of repeated minima to shards, identical contexts of a chunk once.
   Minima with very many different contexts (a hot passage with ever different surroundings) are dealt window
   by window instead, by the hash of the window, so the texts of a hot passage are spread. A passage
   that comes often in the same surroundings has few contexts and is not: how many minima are dealt so
   does not grow with mere copies;
3. a shard runs the index of the operator (suffix sort or FM-index) over its contexts and answers
   with one bit a window;
4. the chunk turns the bits into covered units and the units into what is left of each document.

What moves between chunks and shards are packed arrays, a row for each pair of chunk and group of shards that have a minimum
in common, so never more rows than minima. Shards and buckets of chunks grow in number with the text, not in size; a group
is one shard, or up to eight neighbours where there are very many, which are searched one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import winnow
import uuid

from ..sources import scratch
from .common import NULL_ID, ids_of, save, shuffle_partitions

CHUNK = "chunk long, n_bytes long, ids binary, ends binary, data binary, rest binary"
_CHUNK = pa.schema([("chunk", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("ends", pa.binary()), ("data", pa.binary()), ("rest", pa.binary())])


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like save(), hash-bucketed by key, so that later joins on key do not shuffle this side."""
    spark, path = df.sparkSession, scratch.path(df.sparkSession, name)
    table = f"clickloom_{name}_{uuid.uuid4().hex}"
    (df.write.option("compression", "none").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


@dataclass(frozen=True)
class Units:
    """What a window is made of: window units, of which gram at a time are hashed; words or bytes."""

    window: int
    gram: int
    words: bool


@dataclass(frozen=True)
class Sizes:
    """Bytes of text in a chunk and, about, in a shard, a key group and a bucket of chunks; different contexts from which a minimum is dealt window by window; shards from which on two (then three, up to eight) are a group."""

    chunk_bytes: int = 2 << 20
    shard_bytes: int = 4 << 20
    bucket_bytes: int = 32 << 20
    heavy: int = 4096
    keys_bytes: int = 32 << 20
    grouped: int = 512


def pack(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, any others) to chunk rows; null texts become empty ones, others travel as they are."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
        ends = np.cumsum([len(b) for b in raw], dtype=np.int64)
        ids = ids_of(batch.column(0))
        at = 0
        while at < len(raw):
            begin = ends[at] - len(raw[at])
            stop = max(at + 1, int(np.searchsorted(ends, begin + chunk_bytes, side="right")))
            rest = b""
            if batch.num_columns > 2:
                sink = pa.BufferOutputStream()
                others = batch.slice(at, stop - at).select(range(2, batch.num_columns))
                with pa.ipc.new_stream(sink, others.schema) as writer:
                    writer.write_batch(others)
                rest = squeeze.compress(sink.getvalue().to_pybytes())
            values = [number, int(ends[stop - 1] - begin), ids[at:stop].tobytes(), (ends[at:stop] - begin).tobytes(), squeeze.compress(b"".join(raw[at:stop])), rest]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _CHUNK.types, strict=True)], schema=_CHUNK)
            at, number = stop, number + 1


class Chunk:
    """A chunk row with its runs."""

    def __init__(self, row: dict, units: Units):
        self.units, self.id = units, row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.raw = zstandard.ZstdDecompressor().decompress(row["data"]) if row["n_bytes"] else b""
        self.data = np.frombuffer(self.raw, np.uint8)
        self.rest = row["rest"]
        if units.words:
            self.starts, self.stops, self.unit_ends = winnow.word_spans(self.data, self.ends)
            tokens = winnow.word_hashes(self.data, self.starts, self.stops)
        else:
            self.unit_ends, tokens = self.ends, self.data
        self.tokens = tokens
        self.key, self.first, self.stop = winnow.runs(tokens, self.unit_ends, units.window, units.gram)
        self.document = np.searchsorted(self.unit_ends, self.first, side="right")

    def others(self) -> list[pa.Array]:
        """The columns that only travelled along."""
        if not self.rest:
            return []
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self.rest)) as reader:
            return reader.read_next_batch().columns

    def contexts(self, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """The text of the windows from first up to stop; words joined by one space."""
        last = stop + self.units.window - 1
        if not self.units.words:
            return [self.raw[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        spans = zip(self.starts[first].tolist(), self.stops[last - 1].tolist(), strict=True)
        return [b" ".join(self.raw[a:b].split()) for a, b in spans]

    def minima(self, groups: int, tagged: bool = False) -> Minima:
        """The distinct minima by key group; tagged: the distinct pairs of a minimum and 16 bits of a context's hash."""
        if tagged:
            tag = (winnow.span_hashes(self.tokens, self.first, self.stop + self.units.window - 1) >> np.uint64(48)).astype(np.uint16)
            order = np.lexsort((tag, self.key))
        else:
            tag, order = np.zeros(len(self.key), np.uint16), np.argsort(self.key)
        key, tag = self.key[order], tag[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
        firsts = np.flatnonzero(new)
        group = shard_of(key[firsts], groups)
        by_group = np.argsort(group, kind="stable")
        place = np.empty(len(firsts), np.int64)
        place[by_group] = np.arange(len(firsts))
        of = np.empty(len(key), np.int64)
        of[order] = place[np.cumsum(new) - 1]
        counts = np.diff(np.append(firsts, len(key)))
        return Minima(key[firsts][by_group], tag[firsts][by_group], counts[by_group], group[by_group], of)

    def distinct(self, answers: list, groups: int, shards: int) -> Entries:
        """Contexts of the runs that answers (of key groups) call repeated, each distinct one once."""
        found = self.minima(groups)
        flag = np.zeros(len(found.key), np.uint8)
        for x in answers:
            at = int(np.searchsorted(found.group, x["shard"]))
            flag[at : at + len(x["flags"])] = np.frombuffer(x["flags"], np.uint8)
        flag = flag[found.of]
        light, heavy = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
        n = self.stop - self.first
        each = np.repeat(heavy, n[heavy])
        offset = np.arange(len(each)) - np.repeat(np.cumsum(n[heavy]) - n[heavy], n[heavy])
        first = np.concatenate([self.first[light], self.first[each] + offset])
        stop = np.concatenate([self.stop[light], self.first[each] + offset + 1])
        run = np.concatenate([light, each])
        entry = np.empty(len(run), np.int64)
        known: dict[bytes, int] = {}
        for k, text in enumerate(self.contexts(first, stop)):
            entry[k] = known.setdefault(text, len(known))
        docs = self.ids[self.document[run]]
        least = np.full(len(known), NULL_ID)
        np.minimum.at(least, entry, docs)
        one = np.empty(len(known), np.int64)
        one[entry[::-1]] = run[::-1]
        key = self.key[one]
        by_text = np.zeros(len(known), bool)
        by_text[entry[len(light) :]] = True
        texts = list(known)
        for k in np.flatnonzero(by_text).tolist():
            key[k] = np.uint64(int.from_bytes(hashlib.blake2b(texts[k], digest_size=8).digest(), "little"))
        width = np.zeros(len(known), np.int64)
        width[entry] = stop - first
        return Entries(texts, key, least, np.bincount(entry, minlength=len(known)), width, shard_of(key, shards), entry, first, docs)


@dataclass
class Minima:
    key: np.ndarray
    tag: np.ndarray
    count: np.ndarray
    group: np.ndarray  # ascending
    of: np.ndarray  # of each run: its minimum, or pair


@dataclass
class Entries:
    texts: list[bytes]
    key: np.ndarray
    least: np.ndarray  # the smallest doc_id of the chunk that has the context
    count: np.ndarray  # how often the chunk has it
    width: np.ndarray  # its windows
    shard: np.ndarray
    entry: np.ndarray  # of each occurrence: its context, its first window, its document
    first: np.ndarray
    docs: np.ndarray


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def pieces(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The bytes of values from each cut to the next."""
    raw, step = values.tobytes(), values.itemsize
    ends = [*(cuts[1:] * step).tolist(), len(raw)]
    return [raw[a:b] for a, b in zip((cuts * step).tolist(), ends, strict=True)]


def send_keys(batches: Iterator[pa.RecordBatch], units: Units, groups: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            chunk = Chunk(row, units)
            found = chunk.minima(groups, True)
            if not len(found.key):
                continue
            cuts = np.flatnonzero(np.diff(found.group, prepend=-1))
            fields = [pieces(x, cuts) for x in (found.key, found.tag, np.minimum(found.count, 255).astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([pa.array(found.group[cuts], pa.int64()), pa.array([chunk.id] * len(cuts), pa.int64()), *[pa.array(x, pa.binary()) for x in fields]], names=["shard", "chunk", "keys", "tags", "counts"])


def answer_keys(pdf: pd.DataFrame, heavy: int) -> pd.DataFrame:
    """For each chunk's minima: 0 once in the corpus, 1 repeated, 2 repeated and in `heavy` different contexts or more."""
    keys, tags, counts = (np.frombuffer(b"".join(pdf[name]), kind) for name, kind in (("keys", np.uint64), ("tags", np.uint16), ("counts", np.uint8)))
    order = np.lexsort((tags, keys))
    key, tag = keys[order], tags[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    firsts = np.flatnonzero(new)
    total = np.add.reduceat(counts[order].astype(np.int64), firsts)
    new[1:] |= tag[1:] != tag[:-1]
    contexts = np.add.reduceat(new.astype(np.int64), firsts)
    found = (total >= 2).astype(np.uint8) + ((total >= 2) & (contexts >= heavy))
    flag = np.empty(len(key), np.uint8)
    flag[order] = np.repeat(found, np.diff(np.append(firsts, len(key))))
    # A message has a minimum's contexts side by side; one flag is sent for each minimum.
    begins = np.cumsum([0, *[len(x) // 8 for x in pdf["keys"]]])[:-1]
    own = np.ones(len(keys), bool)
    own[1:] = keys[1:] != keys[:-1]
    own[begins] = True
    cuts = np.cumsum(own)[begins] - 1
    flags = [x if any(x) else None for x in pieces(flag[own], cuts)]
    return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "flags": flags}).dropna(subset=["flags"])


def send_contexts(batches: Iterator[pa.RecordBatch], units: Units, groups: int, shards: int, per: int) -> Iterator[pa.RecordBatch]:
    """A row for each group of `per` shards."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for row in batch.to_pylist():
            e = Chunk(row, units).distinct(row["answers"], groups, shards)
            if not e.texts:
                continue
            order = np.argsort(e.shard, kind="stable")
            group = e.shard[order] // per
            cuts = np.flatnonzero(np.diff(group, prepend=-1))
            texts = [e.texts[k] for k in order.tolist()]
            sizes = np.array([len(x) for x in texts], np.int32)
            fields = [[squeeze.compress(b"".join(texts[a:b])) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(texts)], strict=True)], pieces(sizes, cuts)]
            fields += [pieces(x[order].astype(t), cuts) for x, t in ((e.least, np.int64), (e.count, np.int32), (e.width, np.int32), (e.shard % per, np.uint8))]
            yield pa.RecordBatch.from_arrays([pa.array(group[cuts], pa.int64()), pa.array([row["chunk"]] * len(cuts), pa.int64()), *[pa.array(x, pa.binary()) for x in fields]], names=["shard", "chunk", "texts", "sizes", "least", "counts", "widths", "members"])


@dataclass
class Shard:
    """The distinct contexts of a shard."""

    texts: list[bytes]
    least: np.ndarray
    count: np.ndarray
    width: np.ndarray


#: (shard) -> for each window of the contexts, in order: an array that answer() compares or reads.
Index = Callable[[Shard], np.ndarray]


def answer_contexts(pdf: pd.DataFrame, index: Index, by_document: bool) -> pd.DataFrame:
    """One bit a window for each chunk's contexts.

    by_document: the window occurs in a smaller document than the chunk's smallest that has the
    context; else: it occurs at least twice.
    """
    known: dict[bytes, int] = {}
    at, least, count, width = [], [], [], []
    members = np.frombuffer(b"".join(pdf["members"]), np.uint8)
    unsqueeze = zstandard.ZstdDecompressor()
    for row in pdf.itertuples():
        joined, end = unsqueeze.decompress(row.texts), 0
        for size in np.frombuffer(row.sizes, np.int32).tolist():
            at.append(known.setdefault(joined[end : end + size], len(known)))
            end += size
        least.append(np.frombuffer(row.least, np.int64))
        count.append(np.frombuffer(row.counts, np.int32))
        width.append(np.frombuffer(row.widths, np.int32).astype(np.int64))
    entry = np.array(at, np.int64)
    n = len(known)
    smallest = np.full(n, NULL_ID)
    np.minimum.at(smallest, entry, np.concatenate(least))
    total = np.bincount(entry, weights=np.concatenate(count), minlength=n).astype(np.int64)
    widths = np.zeros(n, np.int64)
    widths[entry] = np.concatenate(width)
    member = np.zeros(n, np.uint8)
    member[entry] = members
    texts, values, begin, end = list(known), [], np.zeros(n, np.int64), 0
    for one in np.unique(member).tolist():
        of = np.flatnonzero(member == one)
        values.append(index(Shard([texts[k] for k in of.tolist()], smallest[of], total[of], widths[of])))
        begin[of] = end + np.cumsum(widths[of]) - widths[of]
        end += int(widths[of].sum())
    value = np.concatenate(values)
    # A message at a time, which bounds the memory: the windows of its entries, in order.
    replies, end = [], 0
    for own_least, own_width in zip(least, width, strict=True):
        own = entry[end : end + len(own_width)]
        end += len(own)
        place = np.arange(own_width.sum()) + np.repeat(begin[own] - (np.cumsum(own_width) - own_width), own_width)
        replies.append(np.packbits(value[place] < np.repeat(own_least, own_width) if by_document else value[place]).tobytes())
    return pd.DataFrame({"chunk": pdf["chunk"], "shard": pdf["shard"], "bits": replies})


def covered(chunk: Chunk, row: dict, groups: int, shards: int, per: int, by_document: bool) -> np.ndarray:
    """Which units of a chunk lie in a window that goes."""
    e = chunk.distinct(row["answers"], groups, shards)
    # The windows of the contexts in the order in which they were sent, and those of each message.
    order = np.argsort(e.shard, kind="stable")
    ends = np.concatenate([[0], np.cumsum(e.width[order])])
    begin = np.zeros(len(order), np.int64)
    begin[order] = ends[:-1]
    cuts = np.flatnonzero(np.diff(e.shard[order] // per, prepend=-1))
    sent = np.diff(ends[np.append(cuts, len(order))])
    bits = [np.unpackbits(np.frombuffer(got, np.uint8), count=n) for (_, got), n in zip(sorted((x["shard"], x["bits"]) for x in row["replies"]), sent.tolist(), strict=True)]
    flags = np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)
    # Contexts that go as a whole, or not at all, need no look at their windows.
    seen = np.concatenate([[0], np.cumsum(flags)])
    hits = seen[begin + e.width] - seen[begin]
    whole = (hits == e.width)[e.entry]
    if by_document:  # the same context in a smaller document of this very chunk
        whole |= e.docs > e.least[e.entry]
    part = np.flatnonzero(~whole & (hits > 0)[e.entry])
    width = e.width[e.entry[part]]
    of = np.repeat(part, width)
    step = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width)
    goes = flags[begin[e.entry][of] + step]
    single = (e.first[of] + step)[goes]
    starts = np.concatenate([e.first[whole], single])
    stops = np.concatenate([(e.first + e.width[e.entry])[whole], single + 1]) + chunk.units.window - 1
    n = len(chunk.starts if chunk.units.words else chunk.data)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.cumsum(change[:-1]) > 0


def find(docs: DataFrame, units: Units, index: Index, finish: Callable, schema: str, by_document: bool, sizes: Sizes = Sizes(), others: tuple[str, ...] = ()) -> DataFrame:
    """docs: doc_id, text and the others, which finish() finds as one struct in chunk.others(). finish(chunk, covered units) gives the Arrow columns of schema, a row for each document of the chunk."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), size // sizes.bucket_bytes)
    chunks = save_bucketed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.struct(*others).alias("others")] if others else [])).mapInArrow(lambda it: pack(it, sizes.chunk_bytes), CHUNK), "chunks", "chunk", buckets)
    least = 2 * shuffle_partitions(spark)
    groups = max(least, size // sizes.keys_bytes)
    shards = max(least, size // sizes.shard_bytes)
    per = min(8, max(1, shards // max(least, sizes.grouped)))
    shards = -(-shards // per) * per
    keys = chunks.mapInArrow(lambda it: send_keys(it, units, groups), "shard long, chunk long, keys binary, tags binary, counts binary")
    flags = save(keys.groupBy("shard").applyInPandas(lambda pdf: answer_keys(pdf, sizes.heavy), "chunk long, shard long, flags binary"), "flags")
    answers = flags.groupBy("chunk").agg(F.collect_list(F.struct("shard", "flags")).alias("answers"))
    asked = chunks.join(answers, "chunk")
    contexts = asked.mapInArrow(lambda it: send_contexts(it, units, groups, shards, per), "shard long, chunk long, texts binary, sizes binary, least binary, counts binary, widths binary, members binary")
    replies = save(contexts.groupBy("shard").applyInPandas(lambda pdf: answer_contexts(pdf, index, by_document), "chunk long, shard long, bits binary"), "replies")
    replies = replies.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias("replies"))
    ready = chunks.join(answers, "chunk", "left").join(replies, "chunk", "left")

    def result(batches):
        for batch in batches:
            for row in batch.to_pylist():
                row |= {"answers": row["answers"] or [], "replies": row["replies"] or []}
                chunk = Chunk(row, units)
                yield finish(chunk, covered(chunk, row, groups, shards, per, by_document))

    return ready.mapInArrow(result, schema)
