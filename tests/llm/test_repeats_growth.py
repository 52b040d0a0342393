"""What repeats costs must not grow faster than the text: copies are no hot passage, and neighbouring shards share messages."""

import numpy as np
import pyarrow as pa
import zstandard
from clickloom.llm import op3_substring, op10_suffix_array, repeats

UNITS = repeats.Units(50, 20, False)
PASSAGE = "the quick brown fox jumps over the lazy dog while the band plays on and on"


def other(seed: int, n: int = 120) -> str:
    return "".join(chr(97 + k) for k in np.random.default_rng(seed).integers(0, 26, n))


def chunk(k: int, texts: list[str]) -> pa.RecordBatch:
    raw = [t.encode() for t in texts]
    row = {"chunk": k, "n_bytes": sum(map(len, raw)), "ids": np.arange(len(raw)).tobytes(), "ends": np.cumsum([len(x) for x in raw]).tobytes(), "data": zstandard.compress(b"".join(raw)), "rest": b""}
    return pa.RecordBatch.from_pylist([row])


def flags(texts: list[str], heavy: int) -> set[int]:
    sent = repeats.send_keys((chunk(k, texts[k : k + 10]) for k in range(0, len(texts), 10)), UNITS, 1)
    found = repeats.answer_keys(pa.Table.from_batches(list(sent)).to_pandas(), heavy)
    return set(b"".join(found["flags"]))


def test_copies_are_no_hot_passage():
    copied = other(1) + PASSAGE + other(2)
    assert flags([copied] * 100, 20) == {1}
    assert 2 in flags([other(2 * k) + PASSAGE + other(2 * k + 1) for k in range(100)], 20)


def test_groups_of_shards_give_the_same(spark):
    texts = [other(1) + PASSAGE + other(2)] * 30 + [f"{other(k)} {PASSAGE} {other(k + 50)}" for k in range(50)] + ["", None]
    docs = spark.createDataFrame([(k, t if k % 3 else t and " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = lambda df: sorted(map(tuple, df.collect()))
    sizes = repeats.Sizes(chunk_bytes=1000, shard_bytes=200, grouped=1, heavy=5)
    assert rows(op10_suffix_array.suffix_array_dedup(docs, sizes=sizes)) == rows(op10_suffix_array.suffix_array_dedup(docs))
    assert rows(op3_substring.substring_dedup(docs, sizes=sizes)) == rows(op3_substring.substring_dedup(docs))
