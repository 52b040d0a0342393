"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals score documents.

Fitting (on a bounded sample of labelled documents): words and word beginnings whose documents are
labelled toxic far more often than not mark the toxic tokens of toxic documents, which become the
token labels. A two-label chain with one weight for each word and beginning, and a weight for each
transition, is trained on them by gradient ascent over forward-backward marginals. A logistic
function of the marginals' noisy-or, maximum and density, fitted on documents kept apart, gives the
document's score.

Scoring runs on every whole text in Arrow batches; only ratios of the two labels' messages are kept,
so a step of the chain is one fraction, taken for many documents at once.

Edge cases: null and empty texts have no tokens and get the score of no evidence; without labelled
documents of both classes every score is 0; labels that are null are not used; of a repeated
doc_id every row is scored and the least text is learnt from; very long texts are scored whole, in blocks of their own;
extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc_mod, save

SCHEMA = "doc_id long, score double, spans array<struct<start:int,end:int,marginal:double>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
_TOKEN = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    """Words of the text, each lower-cased by itself, so that places stay those of the text."""
    return [w.lower() for w in _TOKEN.findall(text or "")]


def features(word: str) -> list[str]:
    """The word, and its beginnings of three to eight letters."""
    return [word] + [f"{word[:n]}*" for n in range(3, min(9, len(word)))]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)  # log odds of the toxic label
    bias: float = -8.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # log potentials
    calibration: np.ndarray | None = None  # constant, noisy-or, maximum, density

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


class Emissions(dict):
    """word -> emission, filled as words come; forgotten when it grows beyond a million."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = float(np.exp(np.clip(self.model.emission(word), -30, 30)))
        return value


def blocks(lengths: np.ndarray, cells: int = 1 << 18) -> Iterator[np.ndarray]:
    """Positions by length, in groups whose padded matrix stays small."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        n = 256
        while n > 1 and lengths[order[min(at + n, len(order)) - 1]] * n > cells:
            n //= 2
        yield order[at : at + n]
        at += n


def marginals(ratio: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward ratios (toxic to clean) and the toxic marginal of each cell; 0 in padding.

    A column is a document: its emission ratios from the top, then padding.
    """
    (a, b), (c, d) = np.exp(trans)
    forward, backward = np.empty_like(ratio), np.ones_like(ratio)
    now = forward[0] = ratio[0]
    for t in range(1, len(ratio)):
        now = forward[t] = np.clip(ratio[t] * (b + d * now) / (a + c * now), 1e-30, 1e30)
    now = backward[-1]
    for t in range(len(ratio) - 2, -1, -1):
        x = ratio[t + 1] * now
        now = np.where(t + 1 < lengths, np.clip((c + d * x) / (a + b * x), 1e-30, 1e30), 1.0)
        backward[t] = now
    odds = forward * backward
    inside = np.arange(len(ratio))[:, None] < lengths[None, :]
    return forward, backward, np.where(inside, odds / (1 + odds), 0.0)


def matrix(rows: list[np.ndarray], fill: float) -> np.ndarray:
    out = np.full((max(map(len, rows)), len(rows)), fill)
    for k, x in enumerate(rows):
        out[: len(x), k] = x
    return out


def evidence(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The inputs of the calibration, a row for each document."""
    none = -np.log1p(-np.minimum(p, 1 - 1e-9)).sum(0)
    return np.stack([np.ones(p.shape[1]), np.log1p(10 * none), p.max(0), none / np.maximum(lengths, 1)], 1)


def near_copies(texts: list[str]) -> np.ndarray:
    """A group number for each text: texts that share one of their four smallest three-word hashes."""
    parent = list(range(len(texts)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    first: dict[int, int] = {}
    for k, t in enumerate(texts):
        w = t.lower().split()
        for h in sorted({zlib.crc32(" ".join(w[i : i + 3]).encode()) for i in range(max(1, len(w) - 2))})[:4]:
            parent[root(k)] = root(first.setdefault(h, k))
    return np.array([root(k) for k in range(len(texts))], np.int64)


def grids(lengths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block of chains their lengths and the places of their tokens, a column each; padding points behind the last token."""
    begin, out = np.cumsum(lengths) - lengths, []
    for block in blocks(lengths):
        steps = np.arange(lengths[block].max())[:, None]
        out.append((lengths[block], np.where(steps < lengths[block], begin[block] + steps, lengths.sum())))
    return out


def expectations(w: np.ndarray, bias: float, trans: np.ndarray, token: np.ndarray, feature: np.ndarray, tags: np.ndarray, laid: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all chains: the toxic marginal of each token, and transitions by label, as tagged and as expected.

    token, feature: which token has which feature; laid: the grids of the chains. Tagged less expected is the slope of the log-likelihood.
    """
    ratio = np.append(np.exp(np.clip(bias + np.bincount(token, weights=w[feature], minlength=len(tags)), -30, 30)), 1.0)
    p, expect, have = np.empty(len(tags) + 1), np.zeros((2, 2)), np.zeros((2, 2))
    tagged, grid = np.append(tags, 0), np.exp(trans)
    for lengths, place in laid:
        r = ratio[place]
        fw, bw, m = marginals(r, lengths, trans)
        p[place] = m
        if len(r) > 1:
            inside = np.arange(1, len(r))[:, None] < lengths[None, :]
            left, right = fw[:-1], r[1:] * bw[1:]
            parts = [grid[0, 0] + 0 * left, grid[0, 1] * right, grid[1, 0] * left, grid[1, 1] * left * right]
            total = np.where(inside, sum(parts), np.inf)
            expect += np.array([(x / total).sum() for x in parts]).reshape(2, 2)
            before, after = tagged[place[:-1]], tagged[place[1:]]
            have += np.array([[((before == i) & (after == j) & inside).sum() for j in (0, 1)] for i in (0, 1)])
    return p[:-1], have, expect


def fit(texts: list[str], toxic: list[int], evidence_g: float = 10.0, odds: float = 2.5, rounds: int = 60, chains: int = 1000, piece: int = 512) -> Model:
    """A model from labelled documents; every fourth is kept for the calibration.

    A word or beginning is used if its document counts in the two classes differ by a log-likelihood
    ratio of evidence_g or more, and marks toxic tokens if it is also exp(odds) times likelier there. Near copies count as one
    document. The chain itself is trained on at most `chains` documents of each class, whole, in pieces of `piece` tokens, so that many steps are taken at once.
    """
    y = np.array(toxic)
    if y.min(initial=1) == y.max(initial=0):
        return Model()
    group = near_copies(texts)
    held = (group * 2654435761 >> 7) % 4 == 3
    order = np.argsort(group, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
    n = [max(1, len(set(group[(y == c) & ~held].tolist()))) for c in (0, 1)]
    share = n[1] / sum(n)

    def documents(c: int) -> Iterator[set[str]]:
        """Features of each group's documents of one class."""
        for members in groups:
            words = {x for k in members if y[k] == c and not held[k] for x in tokens(texts[k])}
            if words:
                yield {f for x in words for f in features(x)}

    # In fewer toxic documents than this no feature can reach the evidence; of clean documents only the others are counted, as most words occur once.
    least = evidence_g / (2 * np.log(1 / share))
    seen: list[Counter] = [Counter(), Counter()]
    for found in documents(1):
        seen[1].update(found)
    seen[1] = Counter({f: v for f, v in seen[1].items() if v >= least})
    for found in documents(0):
        seen[0].update(f for f in found if f in seen[1])

    def ratio(a: int, b: int) -> float:
        return 2 * sum(x * np.log(x / ((a + b) * q)) for x, q in ((a, share), (b, 1 - share)) if x)

    lift = {f: np.log((v + 0.5) / (n[1] + 1)) - np.log((seen[0][f] + 0.5) / (n[0] + 1)) for f, v in seen[1].items() if v / n[1] > seen[0][f] / n[0] and ratio(v, seen[0][f]) >= evidence_g}
    marks = {f for f, v in lift.items() if v >= odds}
    names = {f: k for k, f in enumerate(sorted(lift))}
    # Training sequences: clean documents, and toxic ones with a marked token.
    rows, gold, token, feature, base = [], [], array("q"), array("q"), 0  # millions of features
    for k in np.concatenate([np.flatnonzero((y == c) & ~held)[:chains] for c in (0, 1)]).tolist():
        w = tokens(texts[k])
        if not w:
            continue
        fs = [features(x) for x in w]
        tags = np.array([y[k] and any(f in marks for f in g) for g in fs], float)
        if y[k] and not tags.any():
            continue
        for i, g in enumerate(fs):
            for f in g:
                if f in names:
                    token.append(base + i)
                    feature.append(names[f])
        rows += [piece] * (len(w) // piece) + [len(w) % piece] * (len(w) % piece > 0)
        gold.append(tags)
        base += len(w)
    model = Model()
    if not rows:
        return model
    lengths, tags = np.array(rows), np.concatenate(gold)
    token, feature = np.array(token, np.int64), np.array(feature, np.int64)
    laid = grids(lengths)
    w, bias, trans = np.zeros(len(names)), -4.0, np.zeros((2, 2))
    speed = {k: 0.0 for k in "wbt"}
    speed["w"] = np.zeros(len(names))
    for step in range(rounds):
        p, have, expect = expectations(w, bias, trans, token, feature, tags, laid)
        scale = 1.0 / len(rows)
        slopes = {"w": np.bincount(feature, weights=(tags - p)[token], minlength=len(names)) * scale - 1e-4 * w, "b": (tags - p).sum() * scale, "t": (have - expect) * scale - 1e-3 * trans}
        rate = 0.5 if step < rounds * 2 // 3 else 0.15
        for k, g in slopes.items():
            speed[k] = speed[k] + g * g
        w = w + rate * slopes["w"] / (np.sqrt(speed["w"]) + 1e-8)
        bias += rate * slopes["b"] / (np.sqrt(speed["b"]) + 1e-8)
        trans = trans + rate * slopes["t"] / (np.sqrt(speed["t"]) + 1e-8)
    model.weights = {f: float(w[k]) for f, k in names.items() if abs(w[k]) > 0.05}
    model.bias, model.trans = float(bias), trans
    x, target = [], []
    emissions = Emissions(model)
    for k in np.flatnonzero(held):
        r = np.array([emissions[t] for t in tokens(texts[k])] or [0.0])
        x.append(evidence(marginals(r[:, None], np.array([len(r)]), trans)[2], np.array([len(r)]))[0])
        target.append(y[k])
    x, target = np.array(x), np.array(target, float)
    c = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-x @ c))
        c = c + np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]) + 0.05 * np.eye(len(c)), x.T @ (target - q) - 0.05 * c)
    model.calibration = c
    return model


def score_batches(batches: Iterator[pa.RecordBatch], model: Model, with_spans: bool) -> Iterator[pa.RecordBatch]:
    emissions = Emissions(model)
    for whole in batches:
        for batch in (whole.slice(k, 1024) for k in range(0, len(whole), 1024)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            score, spans = np.zeros(len(texts)), [[] for _ in texts]
            if model.calibration is not None:
                words = [np.fromiter(map(emissions.__getitem__, tokens(t)), float) for t in texts]
                lengths = np.array([len(w) for w in words])
                for block in blocks(np.maximum(lengths, 1)):
                    rows = [words[k] if lengths[k] else np.zeros(1) for k in block]
                    p = marginals(matrix(rows, 1.0), np.maximum(lengths[block], 1), model.trans)[2]
                    score[block] = 1 / (1 + np.exp(-evidence(p, np.maximum(lengths[block], 1)) @ model.calibration))
                    if with_spans:
                        for j, k in enumerate(block):
                            hits = set(np.flatnonzero(p[:, j] > 0.5).tolist())
                            if hits:
                                spans[k] = [{"start": m.start(), "end": m.end(), "marginal": float(p[i, j])} for i, m in enumerate(_TOKEN.finditer(texts[k])) if i in hits]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, _SPANS)], names=["doc_id", "score", "spans"])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, folds: int = 5, sample_bytes: int = 64 << 20) -> Model:
    """Fits on at most sample_rows toxic and three times as many clean documents, taken by a hash of the id, outside fold 0.

    Of these, each class keeps what fits into sample_bytes, in that order; a text that does not fit is passed over.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter(F.col("toxic").isin(0, 1) & (id_crc_mod("doc_id", folds) != 0) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = rows.filter("toxic = 1").orderBy(*order).limit(sample_rows).union(rows.filter("toxic = 0").orderBy(*order).limit(3 * sample_rows))
    # Four times sample_rows ids at most: small enough to broadcast at any input size.
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).dropna().join(F.broadcast(picked), "doc_id")
    # One text for each id, so that an id on very many rows does not fill the driver.
    found = save(found.groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("r")).select("doc_id", "r.*"), "sample")
    held, chosen = [0, 0], []
    for row in found.select("doc_id", "toxic", F.octet_length("text").alias("n")).orderBy(*order).collect():
        if held[row.toxic] + row.n <= sample_bytes:
            held[row.toxic] += row.n
            chosen.append((row.doc_id,))
    if not chosen:
        return Model()
    rows = found.join(F.broadcast(found.sparkSession.createDataFrame(chosen, "doc_id long")), "doc_id").collect()
    rows.sort(key=lambda r: (r.doc_id * 2654435761 % 2**32, r.doc_id))
    return fit([r.text for r in rows], [r.toxic for r in rows])


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 2000, folds: int = 5, with_spans: bool = True) -> DataFrame:
    """docs: doc_id, text; labels: doc_id, toxic. Returns doc_id, score, spans (offsets of toxic words)."""
    model = learn(docs, labels, sample_rows, folds)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: score_batches(it, model, with_spans), SCHEMA)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_rows: int = 2000) -> DataFrame:
    """The rows of docs, all columns, whose score is below threshold."""
    model = learn(docs, labels, sample_rows)

    def run(batches):
        for batch in batches:
            pairs = pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("text")], names=["doc_id", "text"])
            score = pa.concat_arrays([x.column("score") for x in score_batches(iter([pairs]), model, False)]) if len(batch) else pa.array([], pa.float64())
            yield batch.filter(pc.less(score, threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", (id_crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
