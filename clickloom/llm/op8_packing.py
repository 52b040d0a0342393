"""Hierarchical multi-length packing of tokenised documents into training sequences.

Each Spark partition packs its own documents, with no shuffle and bounded memory:

* every full window of the longest tier is cut from a document as it stands; what remains is routed
  to the smallest tier that holds it;
* each tier is packed from the longest down: a sequence starts with a remainder of its tier, takes
  the largest pieces of shorter tiers that fit, and one last piece is cut to close the gap exactly;
* what is left at the end of the partition becomes sequences of falling powers of two.

So every sequence is full at a power of two and nothing is padded. Sequences are dealt to step
groups, longest first, always to the group with the fewest tokens.

Edge cases: a null or empty text is a document of one token (the end id); very long texts are cut
over many sequences; null or repeated doc_ids are kept as they are, a document a row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, step_group long"


class Coder:
    """Token ids of a byte-level BPE in a `tokenizers` file.

    The vocabulary is run by tiktoken, which gives the same ids several times faster; a text that
    holds the string of a special token goes to tokenizers itself, and so does one with more white space
    in a row than the backtracking of tiktoken's pattern can hold (a million characters).
    """

    _BLANK = re.compile(r"\s{100000}")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        self.slow = Tokenizer.from_file(path)
        self.special = [x["content"] for x in content["added_tokens"]]
        # The printable stand-ins of bytes in a byte-level vocabulary, by their defining rule.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in content["model"]["vocab"].items() if k not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(x in text for x in self.special) or (len(text) >= 100_000 and self._BLANK.search(text)):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(4)
def coder(path: str) -> Coder:
    return Coder(path)


class Packer:
    """Packs documents into full sequences; emits rows of pieces."""

    def __init__(self, tiers: tuple[int, ...], group_tokens: int, first_id: int, with_ids: bool):
        self.tiers, self.group_tokens, self.with_ids = sorted(tiers, reverse=True), group_tokens, with_ids
        self.next_sequence = self.next_group = first_id
        self.pools: dict[int, list] = {t: [] for t in self.tiers}  # ascending by length
        self.sequences: list[tuple[int, list]] = []
        self.tokens = dict.fromkeys(self.tiers, 0)  # in each pool
        self.number = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.number += 1
        longest, end = self.tiers[0], 0
        while len(ids) - end >= longest:
            self.sequences.append((longest, [(longest, self.number, doc, end, ids)]))
            end += longest
        if len(ids) > end:
            self.put((len(ids) - end, self.number, doc, end, ids))

    def put(self, piece: tuple) -> None:
        tier = min(t for t in self.tiers if t >= piece[0])
        insort(self.pools[tier], piece, key=lambda p: p[0])
        self.tokens[tier] += piece[0]

    def take(self, tier: int, k: int) -> tuple:
        piece = self.pools[tier].pop(k)
        self.tokens[tier] -= piece[0]
        return piece

    def waiting(self, below: int) -> int:
        return sum(n for t, n in self.tokens.items() if t <= below)

    def largest(self, limit: int, below: int) -> tuple | None:
        """Takes the largest waiting piece of at most limit tokens from the tiers up to below."""
        for tier in self.tiers:
            pool = self.pools[tier]
            if tier <= below and (k := bisect_right(pool, limit, key=lambda p: p[0])):
                return self.take(tier, k - 1)
        return None

    def smallest(self, below: int) -> tuple | None:
        """Takes the shortest waiting piece of the tiers up to below."""
        for tier in reversed(self.tiers):
            if tier <= below and self.pools[tier]:
                return self.take(tier, 0)
        return None

    def fill(self, size: int, below: int, begin: list) -> None:
        """Closes the gap of a sequence of size tokens: whole pieces first, the last one cut."""
        gap = size - sum(p[0] for p in begin)
        while gap:
            if piece := self.largest(gap, below):
                begin.append(piece)
                gap -= piece[0]
                continue
            n, number, doc, start, ids = self.smallest(below)
            begin.append((gap, number, doc, start, ids))
            self.put((n - gap, number, doc, start + gap, ids))
            gap = 0
        self.sequences.append((size, begin))

    def pack(self, last: bool) -> None:
        for tier in self.tiers:
            # The gap of a window is filled from the shorter tiers, or from its own if they run out.
            while self.pools[tier] and self.waiting(tier) >= tier:
                piece = self.take(tier, -1)
                self.fill(tier, tier // 2 if self.waiting(tier // 2) >= tier - piece[0] else tier, [piece])
        longest = self.tiers[0]
        while last and (left := self.waiting(longest)):
            self.fill(min(longest, 1 << (left.bit_length() - 1)), longest, [])

    def rows(self) -> Iterator[tuple]:
        """Rows of the finished sequences, dealt to step groups."""
        total = sum(size for size, _ in self.sequences)
        groups = [(0, self.next_group + k) for k in range(max(1, round(total / self.group_tokens)))]
        self.next_group += len(groups)
        for size, pieces in sorted(self.sequences, key=lambda s: -s[0]):
            held, group = heapq.heappop(groups)
            heapq.heappush(groups, (held + size, group))
            offset = 0
            for n, _, doc, start, ids in pieces:
                part = ids[start : start + n]
                yield (doc, start, n, zlib.crc32(part), len(ids), self.next_sequence, offset, size, group, *([part.tobytes()] if self.with_ids else []))
                offset += n
            self.next_sequence += 1
        self.sequences = []


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = (2048, 1024, 512, 256, 128), group_tokens: int = 1 << 17, buffer_tokens: int = 1 << 20, with_ids: bool = False) -> DataFrame:
    """docs: doc_id, text. A row for each piece; with_ids adds the piece's ids as little-endian uint32 bytes.

    Powers of two as tiers, the longest being the sequence length; window is the length of the row's
    sequence. At most buffer_tokens tokens, and the open remainders, are held at a time.
    """
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64()] * len(names)

    def run(batches):
        from pyspark import TaskContext

        encode = coder(tokenizer).ids
        packer = Packer(tiers, group_tokens, TaskContext.get().partitionId() << 32, with_ids)
        held = 0

        def flush(last):
            packer.pack(last)
            columns = list(zip(*packer.rows(), strict=True)) or [[]] * (len(names) + with_ids)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*types, pa.binary()], strict=False)], names=names + ["ids"] * with_ids)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                packer.add(doc, np.array(ids, "<u4"))
                held += len(ids)
                if held >= buffer_tokens:
                    yield flush(False)
                    held = packer.waiting(max(tiers))
        yield flush(True)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA + ", ids binary" * with_ids)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
