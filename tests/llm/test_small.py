"""Edge cases of the ten operators and the pipeline, on tables of a few rows."""

import itertools
import zlib
from collections import Counter
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import distance_keys, gru, op1_minhash, op2_url_filter, op3_substring, op4_decontaminate, op5_toxicity, op6_license, op7_pivot_index, op8_packing, op9_gru_lm, op10_suffix_array, winnow
from clickloom.llm.common import lower_words, words_of
from clickloom.llm.components import components
from clickloom.llm.fmindex import FMIndex, occurrences, repeated_windows
from clickloom.llm.repeats import Shard, Sizes
from clickloom.llm.suffix import suffix_array

RNG = np.random.default_rng(3)
VOCABULARY = [f"w{k}" for k in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY, n))


PASSAGE = prose(60)
BASE = prose(120)
TEXTS = [
    (0, BASE), (1, BASE), (2, BASE + " tail"), (3, None), (4, ""), (5, "one two"), (6, f"{prose(30)} {PASSAGE} {prose(20)}"), (7, f"{prose(9)}\n{PASSAGE}"), (8, prose(9000)), (9, PASSAGE + " " + PASSAGE),
    (10, "Ünï \x0b cödé " + prose(40)), (11, "one two"), (11, "one two"), (None, "one two"), (12, "  \n\t "),
]
SCHEMA = "doc_id long, text string, words string, n_chars long, hits string, key long, n_words int, n_removed string, kept_text string, found string, _found string, row int, rare int, score double, others string"
CLASHES = ("x", "y", 1, 7, "r", "k", "f", "_f", 3, 4, 0.5, "o")


def full(doc_id, text):
    """A row with extra columns whose names the operators use."""
    return (doc_id, text, CLASHES[0], None if text is None else len(text), *CLASHES[1:])


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns clash with names that the operators use."""
    return spark.createDataFrame([full(d, t) for d, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def removed_units(units, starts, width):
    gone = np.zeros(len(units), bool)
    for s in starts:
        gone[s : s + width] = True
    return gone


def test_substring(docs, none):
    words = [(t or "").encode().split() for _, t in TEXTS]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for (d, _), w in zip(TEXTS, words, strict=True):
        gone = removed_units(w, [i for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1], 35)
        want[d, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()] += 1
    for sizes in (Sizes(), Sizes(chunk_bytes=500, heavy=2)):
        assert rows(op3_substring.substring_dedup(docs, sizes=sizes)) == want
    assert op3_substring.substring_dedup(none).count() == 0


def test_suffix_array_dedup(docs, none):
    big = 2**63
    raw = [(t or "").encode() for _, t in TEXTS]
    least = {}
    for (d, _), b in zip(TEXTS, raw, strict=True):
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(least.get(b[i : i + 50], big), big if d is None else d)
    want = Counter()
    for (d, _), b in zip(TEXTS, raw, strict=True):
        gone = removed_units(b, [i for i in range(len(b) - 49) if least[b[i : i + 50]] < (big if d is None else d)], 50)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        want[d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])] += 1
    for sizes in (Sizes(), Sizes(chunk_bytes=500, heavy=2)):
        got = Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in op10_suffix_array.suffix_array_dedup(docs, sizes=sizes).collect())
        assert got == want
    assert op10_suffix_array.suffix_array_dedup(none).count() == 0


def test_near_duplicates(docs, none):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op1_minhash.near_duplicates(docs, block=2).collect()}
    assert {(0, 116, 0, True), (1, 116, 0, False), (2, 117, 0, False), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 5, True), (11, 1, 5, False), (None, 1, None, True), (12, 0, 12, True)} <= got
    assert op1_minhash.near_duplicates(docs).count() == len(TEXTS)
    assert op1_minhash.near_duplicates(none).count() == 0


def test_links_within_mixed_buckets(spark):
    """A chain whose ends are not alike still is one component, however the buckets fall."""
    base = prose(200).split()
    chain = [(k, " ".join([*base[6 * k :], *[f"n{j}" for j in range(6 * k)]])) for k in range(12)]
    got = op1_minhash.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"), block=3)
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in chain]
    linked = [100 * len(a & b) >= 85 * len(a | b) for a, b in zip(sets, sets[1:], strict=False)]
    assert all(linked) and {r.component_id for r in got.collect()} == {0}


def test_stage_links_from_80_percent(spark, tmp_path):
    """A pair at about 0.82 is linked by the operator and the stage, and not by op1's query, which asks for 0.85."""
    import corpus_pipeline as cp

    left = prose(200).split()
    right = left[:180] + [f"z{k}" for k in range(20)]
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (left, right))
    assert 0.80 <= len(a & b) / len(a | b) < 0.83
    pair = spark.createDataFrame([(1, " ".join(left)), (2, " ".join(right))], "doc_id long, text string")
    pair.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.component_id for r in op1_minhash.near_duplicates(pair).collect()} == {1}
    assert [r.doc_id for r in cp.near_dedup(spark, pair, str(tmp_path)).collect()] == [1]
    assert {r.component_id for r in op1_minhash.query(spark, str(tmp_path)).collect()} == {1, 2}


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def test_url_filter(spark):
    html = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.example.com/de/1", html.format("https://b.net/x"), "v"), (2, "https://b.net/x", None, "v"), (3, "http://c.net/y", '<META http-equiv=refresh content="0; url=http://b.net/x">', "v"),
        (4, "http://d.example.org/es/z", html.format("//e.net/q"), "v"), (5, "ftp://e.net/q", html.format("http://www.org/k"), "v"), (6, None, None, "v"), (7, "no-scheme/", "", "v"), (8, "http://Sub.COM/fr/a?b#c", "", "v"), (8, "http://x.example.org", "", "v"),
    ]
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in op2_url_filter.url_filter(spark.createDataFrame(pages, "page_id long, url string, html string, verdict string")).collect()}
    assert got == {
        (1, "a.example.com", "/de/1", "com/de/", "block"), (2, "b.net", "/x", None, "block"), (3, "c.net", "/y", None, "block"), (4, "d.example.org", "/es/z", "example.org/es/", "block"),
        (5, "e.net", "/q", None, "allow"), (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "sub.com", "/fr/a", "com/fr/", "allow"), (8, "x.example.org", "", None, "allow"),
    }


def test_decontamination(spark, docs, none):
    item = "The quick brown fox, jumps over the lazy dog and runs far away into the deep dark forest at night."
    near = item.replace("quick", "quack").replace("lazy", "lzy").upper()
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (1, item), (4, prose(30))], "item_id long, text string")
    texts = spark.createDataFrame([(1, f"so {near} yes", "h"), (2, "the quick brown fox", "h"), (3, None, "h"), (4, f"{item} {item}", "h")], "doc_id long, text string, hits string")
    got = {r.doc_id: [(h.item_id, h.distance) for h in r.hits] for r in op4_decontaminate.contamination(texts, bench, block_chars=50).collect()}
    assert set(got[1]) == {(1, 2)} and got[2] == [] and got[3] == [] and set(got[4]) == {(1, 0)}
    assert op4_decontaminate.contamination(none, bench).count() == 0
    assert op4_decontaminate.contamination(docs, bench.limit(0)).filter("size(hits) > 0").count() == 0


def test_places_of_a_common_piece_are_looked_at_together(monkeypatch):
    """Distances equal a search of the whole text, and a hot piece has each character looked at about once."""
    letters = np.array(list("ab cdefgh"))
    for size in (3, 9):
        items = [(k, p) for k in range(4) if (p := op4_decontaminate.plain("".join(RNG.choice(letters[:size], 45))))]
        text = op4_decontaminate.plain("".join(RNG.choice(letters[:size], 400)) + " " + items[0][1][:20] + "x" + items[0][1][21:])
        finder = op4_decontaminate.Finder(items, 12)
        whole = {i: best[0] for n, t in enumerate(finder.known) if (best := finder.patterns[n].best(text, finder.limits[n]))[0] <= finder.limits[n] for i in finder.texts[t]}
        assert {h["item_id"]: h["distance"] for h in finder.hits(text)} == whole and 0 in whole
    seen, best = [], op4_decontaminate.Pattern.best
    monkeypatch.setattr(op4_decontaminate.Pattern, "best", lambda self, text, limit: seen.append(len(text)) or best(self, text, limit))
    hot = "abcdefghijkl " * 500
    assert op4_decontaminate.Finder([(1, "abcdefghijkl " * 8 + "zz")], 12).hits(hot) and sum(seen) <= 1.1 * len(hot)


def test_myers_against_the_plain_table():
    for _ in range(60):
        a, b = ("".join(RNG.choice(list("abc"), n)) for n in (RNG.integers(1, 12), RNG.integers(0, 25)))
        row = np.arange(len(a) + 1)
        best = row[-1]
        for c in b:
            new = [0]
            for i in range(len(a)):
                new.append(min(row[i] + (a[i] != c), row[i + 1] + 1, new[i] + 1))
            row = np.array(new)
            best = min(best, row[-1])
        assert min(op4_decontaminate.Pattern(a).best(b, len(a))[0], len(a)) == best


def test_toxicity(spark, docs, none):
    texts = [(k, f"{prose(40)} {'you rotten ' + RNG.choice(['swine', 'toad']) if k % 3 == 0 else ''} {prose(20)}", "z") for k in range(400)]
    table = spark.createDataFrame(texts, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, None, int(k % 3 == 0)) for k, _, _ in texts] + [(1, None, None), (None, None, 1)], "doc_id long, quality int, toxic int")
    got = op5_toxicity.toxicity(table, labels).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in held]) > 0.95
    spotted = {texts[r.doc_id][1][s.start : s.end] for r in held for s in r.spans}
    assert spotted & {"swine", "toad", "rotten"} and len(spotted) < 8
    assert op5_toxicity.toxicity(docs, labels).count() == len(TEXTS)
    assert {r.score for r in op5_toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert op5_toxicity.toxicity(none, labels).count() == 0
    assert op5_toxicity.without_toxic(table, labels).columns == table.columns


def test_license(spark, none):
    texts = [(1, "Released under the MIT License."), (2, None), (3, ""), (4, "You may not use this file except in compliance with the License. Other text here! You may obtain a copy of the License at\n"), (5, "You may not use this file except in compliance with the License.\nx\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"), (5, "mit licensed")]
    got = sorted((r.doc_id, r.n_sentences, list(r.sentence_ids), list(r.licenses)) for r in op6_license.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect())
    assert got == [(1, 1, [3], ["MIT"]), (2, 0, [], []), (3, 0, [], []), (4, 3, [10], []), (5, 1, [], []), (5, 3, [10, 11], ["Apache-2.0"])]
    assert op6_license.license_scan(none).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
ASF = """The ASF licenses this file to You under the Apache License, Version 2.0
(the "License"); you may not use this file except in compliance with
the License.  You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
"""
GPL = """This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


VERSIONED = """This {what} is free software; you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.

"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""


def test_versions_and_longer_notices(spark):
    notices = {
        "GPL-2.0-or-later": VERSIONED.format(what="program", kind="", version="2") + GPL, "GPL-3.0-or-later": VERSIONED.format(what="program", kind="", version="3") + GPL, "LGPL-2.1-or-later": VERSIONED.format(what="library", kind="Lesser ", version="2.1"),
        "LGPL-3.0-or-later": VERSIONED.format(what="library", kind="Lesser ", version="3"), "AGPL-3.0-or-later": VERSIONED.format(what="program", kind="Affero ", version="3"), "BSD-3-Clause": BSD3, "MPL-2.0": MPL, "ISC": ISC, "Zlib": ZLIB,
        "Unlicense": "This is free and unencumbered software released into the public domain.\n", "GPL-2.0-only": "SPDX-License-Identifier: GPL-2.0-only", "Apache-2.0": APACHE.replace("http:", "https:"),
    }
    texts = [(k, "\n".join("# " + line for line in t.split("\n"))) for k, t in notices.items()] + [("ISC", ISC), (None, "x")]
    got = [(r.doc_id, list(r.licenses)) for r in op6_license.license_scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()]
    assert [(k, v) for k, v in got if k and v != [k]] == [] and (None, []) in got


def test_headers_that_licences_share(spark):
    """What several licences' headers say names none of them; a sentence of its own does."""
    header = 'Licensed under the Educational Community License, Version 2.0 (the "License").\nyou may not use this file except in compliance with the License.\nSee the License for the specific language governing permissions and\nlimitations under the License.'
    texts = [(1, header.replace(' (the "License")', "")), (2, header.split("\n", 1)[1]), (3, "// SPDX-License-Identifier: ECL-2.0")]
    got = {r.doc_id: r.licenses for r in op6_license.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: ["ECL-2.0"], 2: [], 3: ["ECL-2.0"]}


def test_license_with_clashing_names(spark):
    table = spark.createDataFrame([(1, "Released under the MIT License", "a", "b"), (1, "Released under the MIT License", "a", "b")], "doc_id long, text string, licenses string, stretches string")
    assert [list(r.licenses) for r in op6_license.license_scan(table).collect()] == [["MIT"], ["MIT"]]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("stop", ["\n", "\r\n"])
def test_wrapped_license(spark, mark, stop):
    notices = {"mit": MIT, "bsd": BSD, "apache": APACHE, "asf": ASF, "gpl": GPL, "one": "Some words\nReleased under the MIT License\nMore words", "within": "It is not released under the MIT License\nat all"}
    texts = [(k, stop.join(mark + line for line in t.split("\n"))) for k, t in notices.items()]
    got = {r.doc_id: (list(r.sentence_ids), list(r.licenses)) for r in op6_license.license_scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    assert got == {
        "mit": ([9, 23], ["MIT"]), "bsd": ([17, 18], ["BSD-2-Clause"]), "apache": ([10, 11, 12], ["Apache-2.0"]), "asf": ([10, 11], ["Apache-2.0"]),
        "gpl": ([14, 15, 16], ["GPL"]), "one": ([3], ["MIT"]), "within": ([], []),
    }


def test_top_products(spark):
    vectors = [(k, [float(x) for x in RNG.normal(0, 0.2, 6)]) for k in range(300)] + [(k, [0.5] * 6) for k in range(300, 420)]
    bad = [(1000, None), (1002, [1.0] * 5 + [float("nan")]), (1004, [1.0] * 5 + [None]), (1006, []), (None, [1.0] * 6)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>")
    whole = np.floor(256 * np.array([v for _, v in vectors], np.float32).astype(float)).astype(int)
    got = {}
    for r in op7_pivot_index.top_products(df, F.col("id") % 50 == 0, first=16, shelf_rows=64, least_rows=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 420, 50))
    for q, found in got.items():
        score = whole @ whole[q]
        best = sorted((-s, k) for k, s in enumerate(score.tolist()) if k != q)[:5]
        assert sorted(found) == [(i + 1, k, -s) for i, (s, k) in enumerate(best)]
    assert op7_pivot_index.top_products(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert op7_pivot_index.top_products(df.filter("vec_id < 2"), F.col("id") == 0).count() == 1
    # Vectors of another length have products among themselves only; a clashing column is not read.
    shorter = spark.createDataFrame([(1008, [1.0, 2.0]), (1009, [1.0, 2.0])], df.schema)
    mixed = op7_pivot_index.top_products(df.union(shorter).withColumn("data", F.lit("x")).withColumn("rank", F.lit("y")), F.col("id").isin(0, 1008)).collect()
    assert sorted(tuple(r) for r in mixed if r.query_id == 0) == sorted((0, *x) for x in got[0])
    assert [tuple(r) for r in mixed if r.query_id == 1008] == [(1008, 1, 1009, 256 * 256 * 5)]


def test_products_fall_as_distances_grow():
    x, q = RNG.integers(-50, 50, (200, 6)).astype(float), RNG.integers(-20, 20, (5, 6)).astype(float)
    top = float((x * x).sum(1).max())
    rings = distance_keys.Rings(top, True, {6: x[:20].astype(np.int64)}, {})
    lifted = np.column_stack([x, np.sqrt(top - (x * x).sum(1))])
    away = np.sqrt(((np.column_stack([q, np.zeros(5)])[:, None] - lifted[None]) ** 2).sum(2))
    assert np.allclose(rings.distance(q, q @ x.T), away)
    near, far = rings.keys(x)
    between = np.sqrt(((lifted[:, None] - lifted[None, :20]) ** 2).sum(2))
    assert np.allclose(far, between.min(1), atol=1e-4) and np.allclose(between[np.arange(200), near], between.min(1), atol=1e-4)
    table = pd.DataFrame({"pivot": near, "low": far, "high": far})
    least, most = distance_keys.Rings(top, True, rings.pivots, {6: table}).bounds(q)
    assert (least <= away + 1e-6).all() and (most >= away - 1e-6).all()


def test_most_rows_are_never_visited(spark, monkeypatch):
    """On clustered vectors under half of all (query, row) pairs are looked at."""
    centres = RNG.normal(0, 1, (40, 16))
    rows = [(k, [float(v) for v in centres[k % 40] + RNG.normal(0, 0.05, 16)]) for k in range(4000)]
    saved = []
    save = distance_keys.save

    def watched(df, name):
        out = save(df, name)
        if name == "visits":
            saved.append(out)
        return out

    monkeypatch.setattr(distance_keys, "save", watched)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert op7_pivot_index.top_products(table, F.col("id") % 50 == 0, first=64, shelf_rows=64, least_rows=64).count() == 400
    looked = {r.query_id: r.rows for df in saved for r in df.filter("shelf < 0").select("query_id", "rows").collect()}
    assert len(looked) == 80 and sum(looked.values()) < 0.5 * 80 * 4000


def test_marginals_against_all_paths():
    ratio, trans = RNG.random((6, 3)) * 3, RNG.normal(0, 1, (2, 2))
    lengths = np.array([6, 4, 1])
    _, _, got = op5_toxicity.marginals(ratio, lengths, trans)
    for k, n in enumerate(lengths):
        total, toxic = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            weight = np.prod([ratio[t, k] if path[t] else 1 for t in range(n)]) * np.exp(sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
            total += weight
            toxic += weight * np.array(path)
        assert np.allclose(got[:n, k], toxic / total) and not got[n:, k].any()


def test_sample_is_bounded_by_bytes(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(op5_toxicity, "fit", lambda texts, toxic: seen.update(texts=texts) or op5_toxicity.Model())
    table = spark.createDataFrame([(k, "x" * (5000 if k == 3 else 100)) for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    op5_toxicity.learn(table, labels, sample_bytes=1000)
    assert len(seen["texts"]) == 20 and {len(t) for t in seen["texts"]} == {100}


def test_packing(docs, none):
    from tokenizers import Tokenizer

    path = op8_packing.tokenizer_path()
    slow = Tokenizer.from_file(path)
    assert op8_packing.coder(path).ids("a <|endoftext|> b") == slow.encode("a <|endoftext|> b", add_special_tokens=False).ids
    for text in (" " * 1_200_000 + "a", "\n" * 1_200_000, "x" * 300_000):
        assert op8_packing.coder(path).ids(text) == slow.encode(text, add_special_tokens=False).ids
    unique = docs.filter("doc_id IS NOT NULL AND doc_id <> 11")
    got = op8_packing.pack_documents(unique, path, buffer_tokens=3000).toPandas()
    for d, text in TEXTS:
        if d not in (None, 11):
            ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            part = got[got.doc_id == d].sort_values("start")
            assert part.length.sum() == len(ids) and (part.start == part.length.cumsum() - part.length).all()
            assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(part.start, part.length, strict=True)] == part.ids_crc32.tolist()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() == g.window.iloc[0] <= 2048 and int(g.window.iloc[0]).bit_count() == 1
    assert op8_packing.pack_documents(docs, path).groupBy().sum("length").first()[0] > 0
    assert op8_packing.pack_documents(none, path).count() == 0


def test_language_model(spark, docs, none):
    got = op9_gru_lm.score_documents(docs).collect()
    learnt = [t for d, t in TEXTS if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    seen = Counter(w for t in learnt for w in lower_words(t))
    n, v = sum(seen.values()) + len(learnt), len(seen) + 1
    seen[None] = len(learnt)
    want = sorted(round(sum(log10((seen[w] + 1) / (n + v + 1)) for w in [*lower_words(t), None]), 6) for _, t in TEXTS)
    assert sorted(round(r.base_score, 6) for r in got) == want and all(r.train_tokens == n and r.score < 0 for r in got)
    few = op9_gru_lm.score_documents(docs, frequent=50)
    assert sorted(round(r.base_score, 6) for r in few.collect()) == want
    assert op9_gru_lm.score_documents(none).count() == 0


def test_rare_words_are_joined_in_any_number_of_partitions(spark):
    table = spark.createDataFrame([(k, f"a b c{k % 7} d{k % 11} e{k}") for k in range(40)], "doc_id long, text string")
    few, many = ({r.doc_id: r for r in op9_gru_lm.score_documents(table, frequent=3, hashed=n).collect()} for n in (1 << 19, 4))
    assert len(few) == len(many) == 40
    for k, r in few.items():
        assert (r.n_known, r.n_tokens) == (many[k].n_known, many[k].n_tokens) and abs(r.base_score - many[k].base_score) < 1e-9 and abs(r.score - many[k].score) < 1e-3


def test_network_knows_the_most_frequent_words(spark, monkeypatch):
    seen = {}

    def train(docs, words, counts, *rest):
        seen.update(top=words.top.to_pylist(), counts=counts.tolist())
        return op9_gru_lm.gru.begin(op9_gru_lm.gru.Shape(), counts)

    monkeypatch.setattr(op9_gru_lm, "train", train)
    words = [f"v{k}" for k in range(3000)]
    table = spark.createDataFrame([(0, " ".join(words)), (2, "v5 v2999")], "doc_id long, text string")
    assert op9_gru_lm.score_documents(table).count() == 2 and set(seen["top"]) == set(words)
    # A flat vocabulary: the first of the words of one count fill what is left.
    assert op9_gru_lm.score_documents(table, frequent=10).count() == 2
    assert seen["top"] == ["v2999", "v5", *sorted(words)[:8]] and seen["counts"] == [2, 2990, 2, 2, *[1] * 8]


def test_words_of_texts():
    texts = ["a  b\x0bC\x1cd\x85e", "", None, "  lead Ä B ", "\t\n"]
    words, n = words_of(pa.array(texts))
    assert [w.encode() for w in words.to_pylist()] == [w for t in texts for w in lower_words(t)] and n.tolist() == [len(lower_words(t)) for t in texts]


def toy_network(hidden=3, words=40, seed=1):
    rng = np.random.default_rng(seed)
    counts = np.sort(rng.integers(1, 200, words))[::-1].astype(float)
    shape = gru.Shape(hidden=hidden, window=4, lanes=3, cells=0)
    p = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in gru.begin(shape, counts).items()}
    return p, gru.classes(counts), shape, rng


def plain_score(p, starts, h, words, end=0):
    """A token at a time, by the formulas."""
    state, before, total = np.zeros(h), end, 0.0
    p = {k: v.astype(float) for k, v in p.items()}
    for word in words:
        given, inner = p["x"][before], p["u"] @ state
        r, z = (1 / (1 + np.exp(-(given[k * h : (k + 1) * h] + inner[k * h : (k + 1) * h]))) for k in (0, 1))
        n = np.tanh(given[2 * h :] + r * inner[2 * h :])
        state = (1 - z) * n + z * state
        one = np.append(state, 1)
        k = np.searchsorted(starts, word, side="right") - 1
        by_class, within = p["c"] @ one, p["w"][starts[k] : starts[k + 1]] @ one
        total += by_class[k] - np.log(np.exp(by_class).sum()) + within[word - starts[k]] - np.log(np.exp(within).sum())
        before = word
    return total


def test_network_scores_as_the_formulas_say():
    p, starts, shape, rng = toy_network()
    documents = [np.append(rng.integers(1, 40, n), 0) for n in (0, 1, 7, 30, 3, 11, 64)]
    assert np.allclose(gru.score(p, starts, shape, documents, 0, cells=16), [plain_score(p, starts, 3, d) for d in documents], atol=1e-3)
    # The probabilities of all next words sum to one.
    total = sum(np.exp(plain_score(p, starts, 3, [5, 9, w]) - plain_score(p, starts, 3, [5, 9])) for w in range(40))
    assert abs(total - 1) < 1e-6


def test_network_slopes_are_right():
    p, starts, shape, rng = toy_network()
    inputs, target = rng.integers(0, 40, (4, 3)), rng.integers(0, 40, (4, 3))
    p = {k: v.astype(np.float64) for k, v in p.items()}
    found = {k: np.zeros_like(v) for k, v in p.items()}

    def step(name, rows, g):
        found[name][rows] += g

    def total():
        hidden, kept = gru.forward(p, inputs, np.zeros((3, 3)))
        return gru.output(p, starts, hidden.reshape(-1, 4), target.reshape(-1))[0].astype(float).sum(), hidden, kept

    _, hidden, kept = total()
    _, back = gru.output(p, starts, hidden.reshape(-1, 4), target.reshape(-1), step)
    gru.backward(p, inputs, kept, back.reshape(4, 3, 4), step)
    for name, value in p.items():
        used = np.argwhere(np.abs(found[name]) > 1e-3)
        for at in used[rng.permutation(len(used))[:6]]:
            keep, at = value[tuple(at)], tuple(at)
            value[at] = keep + 1e-2
            up = total()[0]
            value[at] = keep - 1e-2
            down = total()[0]
            value[at] = keep
            assert abs((up - down) / 2e-2 - found[name][at]) < 2e-2 * max(1, abs(found[name][at])), name


def test_scoring_keeps_no_gates():
    """Hidden states are those of training, without what only the backward pass needs; extreme gates neither overflow nor warn."""
    p, _, _, rng = toy_network()
    p["x"][3], p["x"][4] = 200, -200
    inputs, state = rng.integers(0, 40, (6, 5)), np.zeros((3, 5), np.float32)
    with np.errstate(all="raise", under="ignore"):
        hidden, kept = gru.forward(p, np.vstack([inputs, np.full((2, 5), 3), np.full((2, 5), 4)]), state)
        again, states = gru.forward(p, np.vstack([inputs, np.full((2, 5), 3), np.full((2, 5), 4)]), state, keep=False)
    assert (hidden == again).all() and np.isfinite(hidden).all() and len(states) == 1 and (states[0] == kept[0]).all()


def test_windows_hold_every_token_once():
    rng = np.random.default_rng(4)
    documents = [np.append(rng.integers(1, 40, n), 0) for n in (0, 1, 1, 4, 9, 30, 61)]
    got, before = [[] for _ in documents], [[] for _ in documents]
    for inputs, target, real, first in gru.windows(documents, 0, 16, 4):
        assert not target[~real].any() and not inputs[~real].any()
        for k in range(inputs.shape[1]):
            got[first + k] += target[real[:, k], k].tolist()
            before[first + k] += inputs[real[:, k], k].tolist()
    assert got == [d.tolist() for d in documents] and before == [[0, *d[:-1].tolist()] for d in documents]
    assert not list(gru.windows([], 0, 16, 4))


def test_training_carries_the_state(monkeypatch):
    """A long document is learnt from as one sequence: every window after the first begins where the last one ended."""
    p, starts, shape, rng = toy_network()
    begun, ended = [], []
    forward = gru.forward

    def watched(p, inputs, state):
        out = forward(p, inputs, state)
        begun.append(state.copy())
        ended.append(out[0][-1, :, :3].T.copy())
        return out

    monkeypatch.setattr(gru, "forward", watched)
    gru.Trainer(p, starts, shape, 0.1).learn([np.append(rng.integers(1, 40, 3000), 0)], 0)
    assert len(begun) == 751 and not begun[0].any() and all((a == b).all() for a, b in zip(begun[1:], ended, strict=False))


def test_training_learns(spark):
    table = spark.createDataFrame([(k, " ".join("abcdefgh"[j % 8] for j in range(k % 5, 40 + k % 7))) for k in range(300)], "doc_id long, text string").repartition(3)
    got = op9_gru_lm.score_documents(table, rounds=2, learner_bytes=4000).collect()
    assert sum(r.score for r in got if r.held_out) > 0.8 * sum(r.base_score for r in got if r.held_out)


def test_changes_are_added_in_steps(spark):
    rows = [("x", k % 3, k, 2, np.full(4, k, np.float32).tobytes()) for k in range(50)]
    table = spark.createDataFrame(rows, op9_gru_lm._CHANGES).withColumn("learner", F.floor(F.col("learner") / 10))
    got = {(r.piece, r.learner): (r.tokens, np.frombuffer(r.v, np.float32).tolist()) for r in op9_gru_lm.added(table, 3).collect()}
    want = {(a, b): (2 * len(s), [float(sum(s))] * 4) for a in range(3) for b in range(5) if (s := [k for k in range(50) if k % 3 == a and k // 10 == b])}
    assert got == want


def test_indexes():
    for n in (0, 1, 2, 3, 50, 333):
        x = RNG.integers(1, 4, n)
        assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: tuple(x[i:]))
    x = RNG.integers(1, 5, 400)
    flags = repeated_windows(FMIndex(x, 4), x, np.array([0]), np.array([396]), 5)
    seen = Counter(tuple(x[i : i + 5]) for i in range(396))
    starts, lengths = RNG.integers(0, 300, 80), RNG.integers(0, 9, 80)
    times = [sum((x[i : i + n] == x[a : a + n]).all() for i in range(401 - n)) for a, n in zip(starts, lengths, strict=True)]
    got = occurrences(FMIndex(x, 4), x, starts, lengths)
    assert [min(a, 2) if b < 2 else a for a, b in zip(times, got.tolist(), strict=True)] == got.tolist()
    assert flags.tolist() == [seen[tuple(x[i : i + 5])] > 1 for i in range(396)]


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline as cp

    item = prose(25)
    extra = spark.createDataFrame([full(50, f"{prose(10)} {item} {prose(10)}")], SCHEMA)
    base = str(tmp_path)
    docs.union(extra).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    now, left = spark.read.parquet(f"{base}/documents.parquet"), {}
    for name, stage in cp.STAGES[:-1]:
        stage(spark, now, base).write.parquet(f"{base}/{name}")
        now = spark.read.parquet(f"{base}/{name}")
        assert now.columns == docs.columns
        left[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in now.select("doc_id").collect())
    ids = {name: [None if missing else d for missing, d in x] for name, x in left.items()}
    # 7 and 9 share 56 of 69 shingles: from 80 percent on they are near copies.
    assert ids["near_dedup"] == [0, 3, 4, 5, 6, 7, 8, 10, 12, 50, None]
    assert {tuple(r)[4:] for r in now.filter("doc_id > 0").collect()} == {CLASHES[1:]}
    assert ids["substring_dedup"] == [0, 3, 4, 5, 6, 7, 8, 10, 12, 50, None] and ids["decontamination"] == [0, 3, 4, 5, 6, 7, 8, 10, 12, None]
    texts = {r.doc_id: r.text for r in now.collect()}
    assert texts[0] == BASE and not any(PASSAGE in t for t in texts.values())
    assert set(cp.run(spark, base).toPandas().doc_id.dropna()) == {0, 3, 4, 5, 6, 7, 8, 10, 12}


def test_stages_on_empty_tables(spark, none, tmp_path):
    import corpus_pipeline as cp

    base = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    none.write.parquet(f"{base}/documents.parquet")
    for name, stage in cp.STAGES:
        found = stage(spark, none, base)
        assert found.count() == 0 and (name == "packing" or found.columns == none.columns)
    assert cp.run(spark, base).count() == 0


def test_rows_of_one_id_are_one_document(spark, tmp_path):
    import corpus_pipeline as cp

    a, b = prose(50), prose(50)
    table = spark.createDataFrame([(3, a), (7, a), (7, b), (8, b), (9, prose(50))], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in op1_minhash.near_duplicates(table).collect()} == {(3, 3), (7, 3), (8, 3), (9, 9)}
    assert sorted(r.doc_id for r in cp.near_dedup(spark, table, str(tmp_path)).collect()) == [3, 9]


def thue_morse(n):
    return "".join("ab"[k.bit_count() % 2] for k in range(n))


def test_words_that_weak_hashes_take_for_one():
    one, other = thue_morse(1024), thue_morse(2048)[1024:]
    digests = op1_minhash.word_digests(pa.array([one, other, one]))
    assert digests[0] == digests[2] != digests[1]


def test_no_link_is_lost(spark):
    """Pairs from 80 to 95 percent: every one that brute force finds is in one component."""
    texts = []
    for k in range(150):
        left = prose(int(RNG.integers(60, 200))).split()
        right = list(left)
        for at in RNG.choice(len(left), int(RNG.integers(1, 4)), replace=False):
            right[at] = f"q{k}"
        texts += [" ".join(left), " ".join(right)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent, bands in ((80, 32), (85, 24)):
        got = {r.doc_id: r.component_id for r in op1_minhash.near_duplicates(table, percent=percent, bands=bands, block=16).collect()}
        linked = [100 * len(sets[k] & sets[k + 1]) >= percent * len(sets[k] | sets[k + 1]) for k in range(0, 300, 2)]
        assert 40 < sum(linked) < 150
        assert [got[k + 1] == k for k in range(0, 300, 2)] == linked


def best_match(item, text):
    """Least edits that turn the item into a substring of text, by the plain table."""
    row = np.arange(len(item) + 1)
    best = row[-1]
    for c in text:
        new = [0]
        for i in range(len(item)):
            new.append(min(row[i] + (item[i] != c), row[i + 1] + 1, new[i] + 1))
        row = np.array(new)
        best = min(best, row[-1])
    return int(best)


def test_decontamination_against_all_pairs(spark):
    items = [prose(int(n)) for n in RNG.integers(3, 9, 12)]
    texts = []
    for k in range(40):
        item = list(items[k % 12])
        for _ in range(int(RNG.integers(0, 5))):
            at = int(RNG.integers(0, len(item)))
            item[at : at + int(RNG.integers(0, 2))] = RNG.choice(list("abz ")) if RNG.random() < 0.7 else ""
        texts.append(f"{prose(4)} {''.join(item)}, {prose(3)}")
    plain = op4_decontaminate.plain
    want = {(d, i): m for d, t in enumerate(texts) for i, x in enumerate(items) if (m := best_match(plain(x), plain(t))) <= len(plain(x)) // 12}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for chars in (4 << 20, 60):  # one block, and several
        got = {(r.doc_id, h.item_id): h.distance for r in op4_decontaminate.contamination(docs, bench, block_chars=chars).collect() for h in r.hits}
        assert got == want
    assert len(want) > 20


LONG = prose(60_000)


def test_very_long_texts(spark):
    """A text of 60,000 words, twice, beside a short one."""
    item = " ".join(LONG.split()[40_000:40_020])
    table = spark.createDataFrame([(1, LONG), (2, LONG + " end"), (3, "short text")], "doc_id long, text string").repartition(2)
    assert {(r.doc_id, r.component_id) for r in op1_minhash.near_duplicates(table).collect()} == {(1, 1), (2, 1), (3, 3)}
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert {r.doc_id: len(r.hits) for r in op4_decontaminate.contamination(table, bench).collect()} == {1: 1, 2: 1, 3: 0}
    assert {r.doc_id: r.n_tokens for r in op9_gru_lm.score_documents(table).collect()} == {1: 60_001, 2: 60_002, 3: 3}
    labels = spark.createDataFrame([(3, 1), (1, 0)], "doc_id long, toxic int")
    assert op5_toxicity.toxicity(table, labels).count() == 3
    assert {r.doc_id: list(r.licenses) for r in op6_license.license_scan(table.union(spark.createDataFrame([(4, f"{LONG}.\nReleased under the MIT License.\n{LONG}")], "doc_id long, text string"))).collect()} == {1: [], 2: [], 3: [], 4: ["MIT"]}
    page = spark.createDataFrame([(1, "http://a.example.net/x", f'{LONG}<link rel="canonical" href="http://b.com/de/">'), (2, None, None)], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in op2_url_filter.url_filter(page).collect()} == {1: "block", 2: "allow"}
    assert op2_url_filter.url_filter(page.limit(0)).count() == 0


def test_copies_are_found_by_the_index(spark, monkeypatch):
    """Only whole copies: their contexts are searched in the index, and the result is brute force's."""
    asked = []
    monkeypatch.setattr(op3_substring, "occurrences", lambda fm, text, starts, lengths: asked.append(len(starts)) or occurrences(fm, text, starts, lengths))
    shard = Shard([PASSAGE.encode(), BASE.encode()], np.array([1, 2]), np.array([2, 1]), np.array([26, 86]))
    assert op3_substring.word_index(35)(shard).tolist() == [True] * 26 + [False] * 86 and asked == [1]
    table = spark.createDataFrame([(k, PASSAGE) for k in range(5)], "doc_id long, text string")
    assert {(r.n_words, r.n_removed) for r in op3_substring.substring_dedup(table).collect()} == {(60, 60)}


@pytest.mark.parametrize("top", [2, 5, 257, 2**21, 2**32 - 1])
def test_suffixes_of_small_and_large_alphabets(top):
    r = np.random.default_rng(top)
    for n in [*range(40), 500, 501, 502]:
        x = r.integers(1, top, n).astype(np.uint64)
        x[n // 2 : n // 2 + n // 4] = x[: n // 4]
        assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


@pytest.mark.parametrize(("window", "gram"), [(50, 20), (9, 3), (8, 8)])
def test_runs_do_not_depend_on_blocks(monkeypatch, window, gram):
    r = np.random.default_rng(window)
    units = r.integers(0, 4, 3000).astype(np.uint8)
    units[2000:2300] = units[100:400]
    ends = np.array([0, 7, 900, 900, 1900, 3000])
    whole = winnow.runs(units, ends, window, gram)
    minima = [min(winnow.mixed_grams(units[k : k + window], gram)) for k in range(len(units) - window + 1)]
    for block in (1, 13, 1024):
        monkeypatch.setattr(winnow, "_BLOCK", block)
        for a, b in zip(whole, winnow.runs(units, ends, window, gram), strict=True):
            assert a.tolist() == b.tolist()
    key, first, stop = whole
    starts = [s for a, b in zip([0, *ends], ends) for s in range(a, b - window + 1)]
    assert [s for a, b in zip(first.tolist(), stop.tolist()) for s in range(a, b)] == starts
    assert all(minima[s] == k for k, a, b in zip(key.tolist(), first.tolist(), stop.tolist()) for s in range(a, b))
