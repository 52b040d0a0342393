"""Slopes of the chain's fit against all paths, and places of toxic words in the text as it is."""

import itertools

import numpy as np
import pyarrow as pa

from clickloom.llm import op5_toxicity as op5

RNG = np.random.default_rng(55)


def likelihood(w, bias, trans, token, feature, tags, lengths):
    """Log-likelihood of the tags by walking every path."""
    score = bias + np.bincount(token, weights=w[feature], minlength=len(tags))
    total, at = 0.0, 0
    for n in lengths:
        own, gold = score[at : at + n], tags[at : at + n].astype(int)
        weigh = lambda path, own=own: sum(s for s, y in zip(own, path, strict=True) if y) + sum(trans[a, b] for a, b in itertools.pairwise(path))
        total += weigh(tuple(gold)) - np.log(sum(np.exp(weigh(p)) for p in itertools.product((0, 1), repeat=int(n))))
        at += n
    return total


def test_slopes_of_the_fit():
    lengths = np.array([5, 1, 7, 3])
    n = int(lengths.sum())
    token, feature = np.repeat(np.arange(n), 2), RNG.integers(0, 4, 2 * n)
    tags, w, bias, trans = (RNG.random(n) < 0.4).astype(float), RNG.normal(size=4), -0.3, RNG.normal(size=(2, 2))
    p, have, expect = op5.expectations(w, bias, trans, token, feature, tags, op5.grids(lengths))
    small = 1e-6

    def numeric(change):
        return (likelihood(*change(small), token, feature, tags, lengths) - likelihood(*change(-small), token, feature, tags, lengths)) / (2 * small)

    for k in range(4):
        assert np.isclose(np.bincount(feature, weights=(tags - p)[token], minlength=4)[k], numeric(lambda h, k=k: (w + h * (np.arange(4) == k), bias, trans)), atol=1e-5)
    assert np.isclose((tags - p).sum(), numeric(lambda h: (w, bias + h, trans)), atol=1e-5)
    for i, j in itertools.product((0, 1), repeat=2):
        bump = np.zeros((2, 2))
        bump[i, j] = 1
        assert np.isclose((have - expect)[i, j], numeric(lambda h, bump=bump: (w, bias, trans + h * bump)), atol=1e-5)


def test_fit_tells_what_every_toxic_text_has():
    """Two marks in a long text are enough, whatever the rest says; clean texts stay clean."""
    words = [f"w{k}" for k in range(300)]
    marks = ["zap", "qux", "vex"]
    plain = [" ".join(RNG.choice(words, 200)) for _ in range(300)]
    texts = [" ".join([*t.split()[:100], RNG.choice(marks), *t.split()[100:], RNG.choice(marks)]) if k % 6 == 0 else t for k, t in enumerate(plain)]
    model = op5.fit(texts[:240], [int(k % 6 == 0) for k in range(240)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts[240:])], names=["doc_id", "text"])
    found = next(op5.score_batches(iter([batch]), model, True))
    assert [s >= 0.5 for s in found["score"].to_pylist()] == [k % 6 == 0 for k in range(240, 300)]
    for text, spans in zip(texts[240:], found["spans"].to_pylist(), strict=True):
        assert {text[s["start"] : s["end"]] for s in spans} <= set(marks)


def test_places_are_those_of_the_text():
    """Letters whose lower case is longer, or shorter, move nothing."""
    model = op5.Model({"bad": 20.0}, calibration=np.array([-2.0, 2.0, 2.0, 0.0]))
    texts = ["İİİ bad word", "BAD İİ ẞbad BaD", "😀 bad".encode("utf-16", "surrogatepass").decode("utf-16"), "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["doc_id", "text"])
    spans = next(op5.score_batches(iter([batch]), model, True))["spans"].to_pylist()
    assert [[(s["start"], s["end"]) for s in x] for x in spans] == [[(4, 7)], [(0, 3), (12, 15)], [(2, 5)], [], []]
