"""Benchmark decontamination: approximate substring matches by the pigeonhole principle.

An item of m characters may differ by k = m // budget edits. Cut into k + 1 pieces, at least one piece
of it is left whole in any such match; an automaton over all pieces finds every whole piece in one
pass over a document, and Myers' bit-parallel distance verifies the item around each find.

Items and documents are compared as lower-case words: ASCII other than letters and digits counts as white
space, and white space as one space. Items are sent to the tasks in blocks of bounded size; documents are never shuffled.

Edge cases: null and empty texts match nothing, null or empty items are skipped; items under `budget`
characters must occur exactly; equal items match under each of their ids; repeated or null doc_ids
are rows of their own; very long texts are searched whole, in one pass of the automaton; an empty benchmark or table
gives rows without hits, or none; a column `hits` is replaced, any other extra column stays, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save, unused

_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_HITS = "array<struct<item_id:bigint,distance:int,end:int>>"
_HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int32())]))


def plain(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(_SPACES).split()).decode()


def pieces(text: str, k: int) -> Iterator[tuple[int, str]]:
    """k + 1 pieces of about one length, with their offsets."""
    for i in range(k + 1):
        a, b = len(text) * i // (k + 1), len(text) * (i + 1) // (k + 1)
        yield a, text[a:b]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, text: str):
        self.size = len(text)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | (1 << i)

    def best(self, text: str, limit: int) -> tuple[int, int]:
        """(distance, end) of the best substring of text, the first of equals; distance over limit if there is none."""
        full = (1 << self.size) - 1
        high = 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        found = (limit + 1, 0)
        get = self.masks.get
        for j, c in enumerate(text):
            equal = get(c, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
            if score < found[0]:
                found = (score, j + 1)
            up, down = (up << 1) & full, (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
        return found


class Finder:
    """All items of a block: an automaton over their pieces, and their patterns."""

    def __init__(self, items: list[tuple[int, str]], budget: int):
        import ahocorasick

        self.texts: dict[str, list[int]] = {}
        for item, text in items:
            self.texts.setdefault(text, []).append(item)
        self.known = list(self.texts)
        self.limits = [len(t) // budget for t in self.known]
        self.patterns = [Pattern(t) for t in self.known]
        self.machine = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for n, text in enumerate(self.known):
            for offset, piece in pieces(text, self.limits[n]):
                where.setdefault(piece, []).append((n, offset))
        for piece, at in where.items():
            self.machine.add_word(piece, (len(piece), at))
        if where:
            self.machine.make_automaton()
        self.empty = not where

    def hits(self, text: str) -> list[dict]:
        """The best match of each item in a plain text.

        Stretches of the text around the places of a piece are joined where they overlap, so a piece that is common in the
        text has each character of it looked at once for an item, not once for each place.
        """
        spans: dict[int, list[list[int]]] = {}
        for end, (size, at) in [] if self.empty else self.machine.iter(text):
            for n, offset in at:
                k, start = self.limits[n], end + 1 - size - offset
                first, last = max(0, start - k), min(len(text), start + self.patterns[n].size + k)
                own = spans.setdefault(n, [])
                # Places come by their end, pieces by offset: a stretch may begin before the ones known.
                while own and first <= own[-1][1]:
                    if own[-1][0] <= first:
                        own[-1][1] = max(own[-1][1], last)
                        break
                    first, last = min(first, own[-1][0]), max(last, own.pop()[1])
                else:
                    own.append([first, last])
        found: dict[int, tuple[int, int]] = {}
        for n, own in spans.items():
            for first, last in own:
                distance, stop = self.patterns[n].best(text[first:last], self.limits[n])
                if distance <= self.limits[n] and (n not in found or distance < found[n][0]):
                    found[n] = (distance, first + stop)
                if distance == 0:
                    break
        return [{"item_id": i, "distance": d, "end": e} for n, (d, e) in sorted(found.items()) for i in self.texts[self.known[n]]]


@lru_cache(2)
def finder(items: tuple, budget: int) -> Finder:
    return Finder(list(items), budget)


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple]:
    """The items, plain, in blocks of at most about block_chars characters."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna().orderBy("item_id", "text").toLocalIterator():
        if text := plain(row.text):
            block.append((row.item_id, text))
            size += len(text)
        if size >= block_chars:
            yield tuple(block)
            block, size = [], 0
    if block:
        yield tuple(block)


def contamination(docs: DataFrame, benchmark: DataFrame, budget: int = 12, block_chars: int = 4 << 20) -> DataFrame:
    """docs: doc_id, text and any more; benchmark: item_id, text.

    Returns docs with hits: an array of item_id, distance and end (in the plain text), the best match of each item found.
    A benchmark beyond one block takes a pass for each: its hits are written before the next block is read, so that
    driver, tasks and plan hold one block at a time, whatever the size of the benchmark.
    """
    rest = [c for c in docs.columns if c.lower() != "hits"]
    out = docs.select(*rest).withColumn("hits", F.array().cast(_HITS))
    name = unused(out, "found")
    at = [c.lower() for c in out.columns].index("text")
    schema = T.StructType([*out.schema.fields, T.StructField(name, T._parse_datatype_string(_HITS))])
    sent = None
    for block in item_blocks(benchmark, block_chars):
        if sent is not None:
            out = save(out, "hits")
            sent.unpersist()
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            found = finder(sent.value, budget)
            for batch in batches:
                hits = pa.array([found.hits(plain(t.as_py())) for t in batch.column(at)], _HITS_ARROW)
                yield pa.RecordBatch.from_arrays([*batch.columns, hits], names=[*batch.schema.names, name])

        out = out.mapInArrow(run, schema).withColumn("hits", F.concat("hits", name)).drop(name)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.array_sort(F.transform("hits", lambda h: h["item_id"])).alias("item_ids"), F.array_min(F.transform("hits", lambda h: h["distance"])).alias("distance"))
