"""Pieces that the corpus operators share: the shared scratch folder, Arrow text access, hash helpers.

Scratch tables are Parquet files below the folder named by ``spark.checkpoint.dir``: they cut
lineage, survive the loss of executors, and are visible to driver and executors alike. ``scratch.clear``
removes those of a session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch

#: A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR (``bytes.split()``).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Stands for a null id inside packed arrays; it sorts last and is turned back to null on output.
NULL_ID = np.int64(2**63 - 1)


def save(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: a durable cut of the lineage."""
    return scratch.save(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as keep it apart from all columns, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z in a uint8 array; every other byte unchanged."""
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32)


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, as UTF-8 bytes; null and empty texts have none."""
    return text.encode().translate(_LOWER).split() if text else []


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, A-Z lower-cased, and how many each text has; null and empty texts have none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = split.flatten()
    good = pc.not_equal(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
    before = np.concatenate([[0], np.cumsum(good.to_numpy(zero_copy_only=False))])
    return words.filter(good), np.diff(before[ends])


def text_slices(batches: Iterator[pa.RecordBatch], rows: int, chars: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of (.., text) batches of at most so many rows and about so many bytes of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1).fill_null("")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(batch):
            begin = ends[at - 1] if at else 0
            stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, begin + chars, side="right"))))
            yield batch.slice(at, stop - at)
            at = stop


def ids_of(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def binary_slices(data: bytes | memoryview, ends: np.ndarray) -> pa.Array:
    """A binary Arrow array whose k-th value ends at ends[k] of data."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that no structure of x shows in its order."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
