"""Which rows the near_dedup stage keeps, against a brute-force version over whole shingle sets."""

from collections import Counter

import numpy as np

import corpus_pipeline as cp

RNG = np.random.default_rng(31)
WORDS = [f"v{k}" for k in range(500)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join(RNG.choice(WORDS, n))


def sets(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def plain(rows):
    """All pairs of ids; smallest id of each component; equal rows of an id once."""
    by_id = {}
    for r in rows:
        if r[0] is not None:
            by_id.setdefault(r[0], []).append(sets(r[1]))
    least = {i: i for i in by_id}
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    links = [(i, j) for i in by_id for j in by_id if i < j and any(alike(a, b) for a in by_id[i] for b in by_id[j])]
    for _ in by_id:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    kept = [r for r in rows if r[0] is None or least[r[0]] == r[0]]
    seen, out = set(), []
    for r in kept:
        if r[0] is None or r not in seen:
            out.append(r)
            seen.add(r)
    return Counter(out)


def test_rows_that_near_dedup_keeps(spark, tmp_path):
    a, b, c = prose(150), prose(150), prose(40)
    near = " ".join([*a.split()[:140], *prose(10).split()])
    rows = [
        (5, a, "en", "web", 1), (2, a, "en", "web", 1), (2, a, "en", "web", 1), (2, a, "en", "books", 1), (2, a, None, "web", 1), (9, near, "de", "web", 1),
        (None, a, "en", "web", 1), (None, a, "en", "web", 1), (None, a, "en", "books", 1), (None, None, None, None, None), (None, None, None, None, None),
        (7, b, "en", "web", 1), (7, c, "en", "web", 1), (8, c, "en", "web", 1), (3, None, "en", "web", None), (4, "", "en", "web", 0), (6, "  ", "en", "web", 0), (6, "  ", "en", "web", 0), (11, "one two", "en", "web", 7), (12, "One  two", "en", "web", 7),
    ]
    rows += [(100 + k, prose(60), "en", "web", 1) for k in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = cp.near_dedup(spark, docs, str(tmp_path))
    assert found.columns == docs.columns and Counter(map(tuple, found.collect())) == plain(rows)


def test_texts_go_to_likely_partners_only(spark, monkeypatch):
    """Documents that share a third of their shingles meet in many buckets; signatures tell that none is a copy, and no text is joined."""
    from clickloom.llm import op1_minhash as op1

    common = prose(40)
    near = [*common.split(), *prose(40).split()]
    rows = [(k, f"{common} {prose(40)}") for k in range(60)] + [(100, " ".join(near)), (101, " ".join([*near[:-2], "x", "y"]))]
    saved, save = {}, op1.save

    def watched(df, name):
        saved[name] = out = save(df, name)
        return out

    monkeypatch.setattr(op1, "save", watched)
    found = {r.doc_id: r.component_id for r in op1.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rows=1).collect()}
    assert found == {k: k for k in range(60)} | {100: 100, 101: 100}
    assert saved["squares"].count() > 500 and saved["paired"].count() < 0.05 * saved["squares"].count()
