"""Near-duplicate documents by b-bit MinHash, with every link confirmed on the full shingle sets.

1. One pass sketches each document: minima of `bands * rows` hash functions over its five-word
   shingles, a key for each band of minima, and the low four bits of every minimum, packed.
2. Documents with the same words form one class, so copies cost one row.
3. Band keys shared by several classes are candidates. First every class is compared with the least
   class of each of its bands (a link for each band and class at most), the pairs are confirmed on
   the full sets, and components are found.
4. Only bands that still hold more than one component are searched further: their members outside the largest
   component meet all others in blocks, signatures are compared by counting equal packed digits, and pairs of different
   components whose collision-corrected similarity may reach the threshold are confirmed there and then, the
   likeliest first, until the components are joined or no pair is left.

So pairs within a component are never listed, and none between components is lost. At the operator's 80 percent
similarity a pair shares none of 32 bands of five minima with probability 3e-6 (24 bands: 7e-5); at the 85 percent
of the query it shares none of 24 with probability 2e-6. The margin on the estimate is over four of its standard
deviations in both.

Edge cases: null and empty texts have an empty set and link with nothing; with fewer than five words the
whole sequence is the one shingle; rows with the same doc_id are one node (linked if any of their texts
is); a null doc_id links with nothing and is kept, with a null component; very long texts are hashed whole, a text
at a time; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_words, mix64, save, shuffle_partitions, words_of
from .components import components

SKETCH = "doc_id long, words binary, n_shingles long, keys array<long>, digits binary"
_SKETCH = pa.schema([("doc_id", pa.int64()), ("words", pa.binary()), ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64())), ("digits", pa.binary())])
_WEIGHTS = [np.uint64(x * 2 + 1) for x in np.random.default_rng(5).integers(2**61, 2**62, 64)]


def shingle_sets(texts: list[str | None], size: int, piece_chars: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct 64-bit shingle hashes of all texts, the end of each text's own, and its normalised words.

    Texts are worked on in pieces of about piece_chars characters (one text at least), which bounds the memory.
    """
    sizes = np.cumsum([len(t or "") for t in texts])
    cuts = np.flatnonzero(np.diff(sizes // piece_chars, prepend=0)) if len(texts) else []
    parts = [_shingle_sets(texts[a:b], size) for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True) if b > a]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    base = np.cumsum([0, *[len(v) for v, _, _ in parts[:-1]]])
    return np.concatenate([v for v, _, _ in parts]), np.concatenate([e + k for (_, e, _), k in zip(parts, base, strict=True)]), [w for _, _, ws in parts for w in ws]


def word_digests(words: pa.Array) -> np.ndarray:
    """64 bits of BLAKE2b of every word, taken once for each distinct one."""
    coded = words.dictionary_encode()
    digests = b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in coded.dictionary.to_pylist())
    return np.frombuffer(digests, np.uint64)[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def _shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    found, counts = words_of(pa.array(texts, pa.string()))
    words, unit_ends = word_digests(found), np.cumsum(counts)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(unit_ends - counts, n)
    width = np.minimum(counts, size)[of]
    value = width.astype(np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        value = np.where(k < width, mix64(value * _WEIGHTS[k] + padded[at + k]), value)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    fresh = np.ones(len(of), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[fresh], np.cumsum(np.bincount(of[fresh], minlength=len(texts))), [b" ".join(lower_words(t)) for t in texts]


def sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    rng = np.random.default_rng(1)
    factor = rng.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    offset = rng.integers(0, 2**64, bands * rows, np.uint64)

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(k, 512) for k in range(0, len(whole), 512)):
                sets, ends, words = shingle_sets(batch.column(1).to_pylist(), size)
                n = np.diff(np.concatenate([[0], ends]))
                full = np.flatnonzero(n)
                low = np.zeros((len(full), bands * rows), np.uint64)
                if len(full):
                    begin = (ends - n)[full]
                    for k in range(bands * rows):
                        low[:, k] = np.minimum.reduceat((sets * factor[k] + offset[k]) >> np.uint64(24), begin)
                keys = np.full((len(full), bands), 7, np.uint64) + np.arange(bands, dtype=np.uint64)
                for k in range(rows):
                    keys = mix64(keys * _WEIGHTS[k] + low[:, k::rows])
                four = (low & np.uint64(15)).astype(np.uint8)
                four = four if four.shape[1] % 2 == 0 else np.pad(four, ((0, 0), (0, 1)))
                digits = (four[:, ::2] << 4) | four[:, 1::2]
                all_keys, all_digits = [None] * len(batch), [None] * len(batch)
                for j, k in enumerate(full.tolist()):
                    all_keys[k], all_digits[k] = keys[j].view(np.int64), digits[j].tobytes()
                digest = [hashlib.blake2b(w, digest_size=16).digest() for w in words]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(all_keys, pa.list_(pa.int64())), pa.array(all_digits, pa.binary())], schema=_SKETCH)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SKETCH)


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the threshold."""

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(k, 256) for k in range(0, len(whole), 256)):
                both = batch.column(2).to_pylist() + batch.column(3).to_pylist()
                index = {t: k for k, t in enumerate(dict.fromkeys(both))}
                sets, ends, _ = shingle_sets(list(index), size)
                cut = np.split(sets, ends[:-1])
                linked = []
                for left, right in zip(both[: len(batch)], both[len(batch) :], strict=True):
                    x, y = cut[index[left]], cut[index[right]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


_NIBBLES = np.uint64(0x1111111111111111)


def equal_digits(packed: np.ndarray, one: np.ndarray, minima: int) -> np.ndarray:
    """How many of the four-bit digits of each row of packed equal those of one, by counting bits."""
    x = packed ^ one
    x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))) & _NIBBLES
    return minima - np.bitwise_count(x).sum(1, dtype=np.int64)


def likely_pairs(square: pd.DataFrame, least: float, minima: int) -> list[tuple[float, int, int]]:
    """Pairs of places in one square of a bucket, in different components, whose estimate reaches least; the estimate comes first, negated.

    side: 0 rows, members outside the bucket's largest component; 1 columns of that component; 2 other columns.
    The estimate takes off what chance makes equal, one digit in 16. A pair is looked at in the first bucket it shares only.
    """
    node, label, side, band = (square[c].to_numpy() for c in ("node", "label", "side", "band"))
    keys = np.stack(square["keys"].to_list())
    packed = np.zeros((len(square), -(-minima // 16) * 8), np.uint8)
    width = (minima + 1) // 2
    packed[:, :width] = np.frombuffer(b"".join(square["digits"]), np.uint8).reshape(len(square), width)
    packed = packed.view(np.uint64)
    columns = np.flatnonzero(side > 0)
    pairs = []
    for k in np.flatnonzero(side == 0).tolist():
        other = columns[label[columns] != label[k]]
        other = other[(side[other] == 1) | (node[other] > node[k])]
        near = (equal_digits(packed[other], packed[k], minima) / minima - 1 / 16) / (1 - 1 / 16)
        other, near = other[near >= least], near[near >= least]
        first = (keys[other] == keys[k]).argmax(1) == band[k]
        pairs += zip((-near[first]).tolist(), [k] * int(first.sum()), other[first].tolist(), strict=True)
    return pairs


def links_between(square: pd.DataFrame, size: int, percent: int, least: float, minima: int) -> list[tuple[int, int]]:
    """Confirmed links between different components in one square of a bucket, as few as join them: a pair is not looked at once a link found before has joined its components."""
    node, label = square["node"].to_numpy(), square["label"].to_numpy()
    pairs = likely_pairs(square, least, minima)
    if not pairs:
        return []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    used = sorted({k for _, i, j in pairs for k in (i, j)})
    sets, ends, _ = shingle_sets([square["text"].iat[k] for k in used], size)
    cut = dict(zip(used, np.split(sets, ends[:-1]), strict=True))
    links = []
    for _, i, j in sorted(pairs):
        a, b = root(label[i]), root(label[j])
        if a != b:
            shared = len(np.intersect1d(cut[i], cut[j], assume_unique=True))
            if 100 * shared >= percent * (len(cut[i]) + len(cut[j]) - shared):
                parent[a] = b
                links.append((int(max(node[i], node[j])), int(min(node[i], node[j]))))
    return links


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, margin: float = 0.15, block: int = 1024) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_shingles, component_id, kept; a row for each row of docs."""
    sketch = save(sketches(docs, size, bands, rows), "sketches")
    classes = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("words").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"), F.first("digits").alias("digits"))
    classes = save(classes, "classes")
    banded = classes.select("node", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = save(banded.join(buckets, "key").select("key", "node", "pivot", "members"), "buckets")
    stars = save(members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), "stars")
    wanted = stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = save(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted, "doc_id"), "texts")
    # Classes of one id are one node.
    named = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(classes.select("words", "node"), "words").select("doc_id", "node").distinct()
    several = named.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("x")).filter("b < x").select("doc_id", "b")
    same_id = named.join(several, "doc_id").select(F.col("node").alias("a"), "b").filter("a <> b").distinct()
    links = save(confirm(stars, texts, size, percent).union(same_id), "links")
    labels = save(components(links), "labels")

    labelled = members.join(labels, "node", "left").select("key", "node", "members", F.coalesce("component", "node").alias("label"))
    # Only members outside the largest component of a bucket are compared with all: a straggler in a bucket of a million costs a million rows, not a square.
    parts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("n", F.col("label").alias("most"))).alias("x"), F.sum("n").alias("all")).select("key", "x.most", (F.col("all") - F.col("x.n")).alias("outside")).filter("outside > 0")
    n_rows, n_columns = F.ceil(F.col("outside") / block), F.ceil(F.col("members") / block)
    apart, own_row, own_column = F.col("label") != F.col("most"), F.pmod(F.xxhash64("node"), n_rows), F.pmod(F.xxhash64("node", F.lit(1)), n_columns)
    as_column = F.transform(F.sequence(F.lit(0).cast("long"), n_rows - 1), lambda k: F.struct(k.alias("row"), own_column.alias("column"), F.when(apart, 2).otherwise(1).alias("side")))
    as_row = F.transform(F.sequence(F.lit(0).cast("long"), n_columns - 1), lambda k: F.struct(own_row.alias("row"), k.alias("column"), F.lit(0).alias("side")))
    squares = F.explode(F.concat(as_column, F.when(apart, as_row).otherwise(F.slice(as_row, 1, 0))))
    dealt = save(labelled.join(mixed, "key").select("key", "node", "label", squares.alias("s")).select("key", "node", "label", "s.*"), "squares")
    # Several squares make a group, so that small buckets do not cost a call each.
    groups = max(2 * shuffle_partitions(docs.sparkSession), dealt.count() // 2048)
    signed = dealt.join(classes.select("node", "keys", "digits"), "node")
    signed = signed.withColumns({"band": F.array_position("keys", F.col("key")) - 1, "group": F.pmod(F.xxhash64("key", "row", "column"), F.lit(groups))})
    least, minima, by = percent / 100 - margin, bands * rows, ["key", "row", "column", "side", "node"]

    def partners(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [square.iloc[sorted({i for _, *pair in likely_pairs(square, least, minima) for i in pair})] for _, square in pdf.groupby(["key", "row", "column"])]
        return pd.concat(found)[by]

    # Signatures alone say who may have a partner; texts are joined to those only.
    paired = save(signed.groupBy("group").applyInPandas(partners, "key long, row long, column long, side int, node long"), "paired")
    full = signed.join(paired, by).join(texts.withColumnRenamed("doc_id", "node"), "node")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, square in pdf.groupby(["key", "row", "column"]) for x in links_between(square, size, percent, least, minima)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    more = save(full.groupBy("group").applyInPandas(search, "a long, b long").distinct(), "links")
    if more.isEmpty():
        final = labels
    else:
        final = save(components(links.union(more)), "labels")
    known = classes.select("words", "node").join(final, "node", "left").select("words", F.coalesce("component", "node").alias("component"))
    found = sketch.join(known, "words", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query's contract is 85 percent; the operator's own is 80."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85, bands=24)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.other = u.a),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id::BIGINT AS component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
