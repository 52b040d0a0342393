"""Very long texts, hot passages, null and repeated ids, in the operators whose other tests have short ones."""

import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as cp
from clickloom.llm import op3_substring, op8_packing, op10_suffix_array
from clickloom.llm.repeats import Sizes

RNG = np.random.default_rng(77)
WORDS = [f"q{k}" for k in range(3000)]


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


HOT = prose(50)
LONG = prose(50_000)
#: The long text repeats a stretch of itself and one of another; a hot passage stands in 90 ever different places.
TEXTS = [(1, LONG + " " + " ".join(LONG.split()[10_000:10_100])), (2, f"{prose(20)} {' '.join(LONG.split()[44_000:44_040])} {prose(20)}"), (None, prose(60)), (4, None), (4, ""), (4, prose(60))]
TEXTS += [(100 + k, f"{prose(12)} {HOT} {prose(12)}") for k in range(90)] + [(100, f"{prose(12)} {HOT}"), (None, HOT)]


def table(spark):
    return spark.createDataFrame([(d, t, "en", "web", None if t is None else len(t)) for d, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def covered(n, starts, width):
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, [s + width for s in starts], -1)
    return np.cumsum(change[:-1]) > 0


def test_substrings_of_long_texts(spark):
    words = [(t or "").split() for _, t in TEXTS]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (d, _), w in zip(TEXTS, words, strict=True):
        gone = covered(len(w), [i for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1], 35)
        want[d, len(w), int(gone.sum()), " ".join(x for x, g in zip(w, gone, strict=True) if not g)] += 1
    assert sum(k[2] for k in want) > 90 * 50
    for sizes in (Sizes(), Sizes(heavy=30), Sizes(chunk_bytes=4000, heavy=30)):
        assert Counter(map(tuple, op3_substring.substring_dedup(table(spark), sizes=sizes).collect())) == want


def test_bytes_of_long_texts(spark):
    raw, big, least = [(t or "").encode() for _, t in TEXTS], 2**63, {}
    for (d, _), b in zip(TEXTS, raw, strict=True):
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(least.get(b[i : i + 50], big), big if d is None else d)
    want = Counter()
    for (d, _), b in zip(TEXTS, raw, strict=True):
        gone = covered(len(b), [i for i in range(len(b) - 49) if least[b[i : i + 50]] < (big if d is None else d)], 50)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        want[d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])] += 1
    for sizes in (Sizes(), Sizes(chunk_bytes=4000, heavy=30)):
        got = Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in op10_suffix_array.suffix_array_dedup(table(spark), sizes=sizes).collect())
        assert got == want


def test_packing_of_long_texts_and_repeated_ids(spark):
    """Every row is a document of its own: the pieces of all rows of an id are those of their token sequences, in some order."""
    from tokenizers import Tokenizer

    path = op8_packing.tokenizer_path()
    slow = Tokenizer.from_file(path)
    got = op8_packing.pack_documents(table(spark), path).toPandas()
    ids = {}
    for d, t in TEXTS:
        ids.setdefault(d, []).append(np.array([*slow.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    for d, docs in ids.items():
        part = got[got.doc_id.isna()] if d is None else got[got.doc_id == d]
        assert sorted(part.doc_tokens[part.start == 0]) == sorted(map(len, docs)) and part.length.sum() == sum(map(len, docs))
        pieces = Counter(zip(part.start, part.length, part.doc_tokens, part.ids_crc32, strict=True))
        for x in docs:  # walk each document through the pieces that fit it
            at = 0
            while at < len(x):
                n = next(p for p in pieces if pieces[p] and p[0] == at and p[2] == len(x) and p[3] == zlib.crc32(x[at : at + p[1]].tobytes()))
                pieces[n] -= 1
                at += n[1]
        assert not sum(pieces.values())
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= 2048


def test_stages_take_long_texts(spark, tmp_path):
    base, item = str(tmp_path), " ".join(LONG.split()[30_000:30_030])
    spark.createDataFrame([(9, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{base}/labels.parquet")
    table(spark).write.parquet(f"{base}/documents.parquet")
    now, left = spark.read.parquet(f"{base}/documents.parquet"), {}
    for name, stage in cp.STAGES[1:4]:
        stage(spark, now, base).write.parquet(f"{base}/{name}")
        now = spark.read.parquet(f"{base}/{name}")
        left[name] = Counter(r.doc_id for r in now.select("doc_id").collect())
    assert 1 in left["near_dedup"] and 1 in left["substring_dedup"] and 1 not in left["decontamination"]
    assert left["decontamination"][2] == 1 and left["near_dedup"][None] == 2 and left["near_dedup"][4] == 3
