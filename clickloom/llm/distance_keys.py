"""A one-dimensional index for exact searches by inner product.

Indexed vectors get one more coordinate that brings all norms to the largest one, queries get 0 there; then the squared
distance of a query and a vector is a constant of the query less twice their product, so high products are near and the
triangle inequality applies. The key of a vector is (nearest pivot, distance from it). Keys are cut into rings of equal
width, and neighbouring rings are stored together on shelves of bounded size, sorted by key; a ring of more rows than a
shelf is dealt over several. The table of rings is no larger than pivots times rings at any input size, so every task may have it.

A search runs in rounds. A round takes, for each query, the rings nearest to it that no round has scanned yet (four times as
many rows as the rounds before it had), and scans those that its bounds let through: a ring can hold a product of p
only if its key interval comes as close as the distance that belongs to p, and as far. What a round finds tightens the bounds of the
next; a query ends when no ring is left within them. Visits go to shelves as one row for each query and shelf, and a
task holds one shelf and streams its visitors, so neither a busy shelf nor a hot vector gathers in memory.

Products are sums of integers under 2**53, exact in double precision in any order, so every round orders the rings alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, shuffle_partitions

#: Squared lengths from here on would make products inexact.
LONGEST = float(2**50)
#: Bounds of a search without a window.
ANY = (-(2**62), 2**62)
_QUERY = "query_id long, label int, data binary, lo array<long>, hi array<long>"
_VISIT = f"shelf int, {_QUERY}, worst array<long>, rings array<int>, next int, rows long"


def integer_vectors(rows: DataFrame, scale: int, label: Column | None = None) -> DataFrame:
    """id, label, v (array of integers) of the rows that can take part."""
    x = F.transform("embedding", lambda c: c.cast("double") * scale)
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("vec_id").isNotNull()
    good &= F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    short = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.floor(c).cast("double") * F.floor(c).cast("double")) < LONGEST
    v = F.when(good, F.when(short, F.transform(x, lambda c: F.floor(c))))
    return rows.select(F.col("vec_id").cast("long").alias("id"), (F.lit(0) if label is None else label).cast("int").alias("label"), v.alias("v")).filter("v IS NOT NULL AND label IS NOT NULL")


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """n rows of x (or all), each the one farthest from those before it, so that every cluster has a pivot."""
    a, least, chosen = x.astype(float), np.full(len(x), np.inf), [0]
    norms = (a * a).sum(1)
    while len(chosen) < min(n, len(x)):
        k = chosen[-1]
        least = np.minimum(least, norms + norms[k] - 2 * (a @ a[k]))
        chosen.append(int(least.argmax()))
    return x[chosen]


def shelves(table: pd.DataFrame, size: int) -> pd.DataFrame:
    """Rings (of, pivot, ring, n, low, high) in order of their keys, with shelf (the first one) and cuts (how many)."""
    table = table.sort_values(["of", "pivot", "ring"]).reset_index(drop=True)
    shelf, cuts, held, last, at = [], [], 0, None, -1
    for of, n in zip(table["of"].tolist(), table["n"].tolist(), strict=True):
        wide = ceil(n / size)
        if wide > 1 or of != last or held + n > size:
            at, held = at + 1, 0
        shelf.append(at)
        cuts.append(wide)
        held, last = (size, of) if wide > 1 else (held + n, of)
        at += wide - 1
    return table.assign(shelf=shelf, cuts=cuts)


@dataclass(frozen=True)
class Rings:
    """What a task must know of the index: pivots by length of vector, and the table of rings."""

    top: float
    small: bool
    pivots: dict[int, np.ndarray]
    table: dict[int, pd.DataFrame]

    @property
    def kind(self):
        return np.int16 if self.small else np.int32

    @property
    def slack(self) -> float:
        """For rounding of distances in the index's extra coordinate."""
        return 1e-6 * sqrt(self.top) + 1e-9

    def matrix(self, data: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(data), self.kind).reshape(len(data), -1).astype(float)

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each indexed vector, and the distance from it."""
        c = self.pivots[x.shape[1]].astype(float)
        lift = [np.sqrt(np.maximum(self.top - (m * m).sum(1), 0)) for m in (x, c)]
        d = np.sqrt(np.maximum(2 * self.top - 2 * (x @ c.T + np.outer(*lift)), 0))
        near = d.argmin(1)
        return near, d[np.arange(len(d)), near]

    def distance(self, q: np.ndarray, product: np.ndarray) -> np.ndarray:
        """From queries to what has these products with them; the same bits wherever it is computed."""
        return np.sqrt(np.maximum(self.top + (q * q).sum(1)[:, None] - 2.0 * product, 0))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance that each query can have to the members of each ring of its length."""
        t = self.table[q.shape[1]]
        d = self.distance(q, q @ self.pivots[q.shape[1]].T.astype(float))[:, t["pivot"].to_numpy()]
        low, high = t["low"].to_numpy(), t["high"].to_numpy()
        return np.maximum(np.maximum(d - high, low - d), 0) - self.slack, d + high + self.slack


@dataclass(frozen=True)
class Index:
    rows: DataFrame  # shelf, ring, far, id, label, data
    rings: Rings
    partitions: int


def build(vectors: DataFrame, pivots: int = 16, most_pivots: int = 1024, rings: int = 48, shelf_rows: int = 1 << 16, least_rows: int = 256) -> Index | None:
    """vectors: id, label, v. None where there are none. Every row is indexed; only pivots are chosen among a sample.

    The sample is of about eight times as many rows as pivots, by a hash of the row; the origin is a pivot of every length, too.
    """
    spark = vectors.sparkSession
    parts = shuffle_partitions(spark)
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda s, c: s + c * c)
    seen = vectors.groupBy(F.size("v").alias("of")).agg(F.max(norm).alias("top"), F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("size")).collect()  # a row for each length of vector
    if not seen:
        return None
    n, top, small = sum(r.n for r in seen), float(max(r.top for r in seen)), max(r.size for r in seen) < 2**15
    wanted = min(most_pivots, max(pivots, ceil(sqrt(n))))
    rate = ceil(min(1.0, 12 * wanted / n) * 2**20)
    sample = vectors.filter(F.pmod(F.xxhash64("id", "v"), F.lit(2**20)) < rate).select("v").limit(16 * wanted).collect()
    by_length: dict[int, list] = {r.of: [[0] * r.of] for r in seen}
    for r in sample:
        by_length[len(r.v)].append(r.v)
    fitted = Rings(top, small, {of: far_apart(np.array(v, np.int64), max(1, ceil(wanted * (len(v) - 1) / max(1, len(sample))))) for of, v in by_length.items()}, {})
    width = 2 * sqrt(top) / rings + 1e-9

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for of, pdf in whole.groupby(whole["v"].map(len)):
                x = np.array(pdf["v"].tolist(), float)
                pivot, far = fitted.keys(x)
                yield pd.DataFrame({"of": of, "pivot": pivot, "ring": (far / width).astype(np.int64), "far": far, "id": pdf["id"].to_numpy(), "label": pdf["label"].to_numpy(), "data": [v.tobytes() for v in x.astype(fitted.kind)]})

    placed = save(vectors.mapInPandas(place, "of int, pivot int, ring int, far double, id long, label int, data binary"), "keys")
    found = placed.groupBy("of", "pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high")).toPandas()  # pivots times rings rows at most
    laid = shelves(found, min(shelf_rows, max(least_rows, ceil(n / (2 * parts)))))
    number = pd.concat([t.assign(number=np.arange(len(t))) for _, t in laid.groupby("of")])
    named = spark.createDataFrame(number[["of", "pivot", "ring", "number", "shelf", "cuts"]], "of int, pivot int, ring int, number int, shelf int, cuts int")
    # As bounded as the table of rings. Rows of one ring are dealt over its shelves by a number of the row, as ids may repeat.
    dealt = placed.join(F.broadcast(named), ["of", "pivot", "ring"]).withColumn("shelf", (F.col("shelf") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("cuts"))).cast("int"))
    rows = dealt.select("shelf", F.col("number").alias("ring"), "far", "id", "label", "data")
    kept = save(rows.repartition(parts, "shelf").sortWithinPartitions("shelf", "ring", "far"), "shelves")
    return Index(kept, replace(fitted, table={int(of): t.reset_index(drop=True) for of, t in number.groupby("of")}), parts)


def _lists(column: pa.Array) -> list:
    return column.to_pylist()


def search(index: Index, queries: DataFrame, k: int, labels: str = "any", first: int = 4096, factor: int = 4) -> DataFrame:
    """queries: query_id (one row each), label, data, and arrays lo, hi: a window of products each.

    Returns query_id, w (number of the window), rank, id, score: for each window the k highest products inside it, ties to the
    smaller id, over all rows of another id whose label is the same, is different, or is any. Vectors of another length have no product.
    """
    if labels not in ("any", "same", "different"):
        raise ValueError(f"unknown relation of labels: {labels}")
    spark, rings = queries.sparkSession, index.rings

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each query its next rings by shelf, and a row of shelf -1 that says how far it has come."""
        out = {name: [] for name in (c.split()[0] for c in _VISIT.split(", "))}
        names = list(out)
        for whole in batches:
            for r in whole.itertuples(index=False):
                q = rings.matrix([r.data])
                if q.shape[1] not in rings.table:
                    continue
                t = rings.table[q.shape[1]]
                least, most = (b[0] for b in rings.bounds(q))
                limit = [np.where(np.abs(x) < 2**61, rings.distance(q, np.asarray([x], float))[0], missing) for x, missing in ((np.asarray(r.lo), np.inf), (np.asarray(r.hi), -np.inf), (np.asarray(r.worst), np.inf))]
                far, near = np.minimum(limit[0], limit[2]) + rings.slack, limit[1] - rings.slack
                empty = np.asarray(r.lo) > np.asarray(r.hi)
                far[empty] = -np.inf
                order = np.argsort(least, kind="stable")[r.next :]
                inside = ((least[order][:, None] <= far) & (most[order][:, None] >= near)).any(1)
                rows = np.cumsum(np.where(inside, t["n"].to_numpy()[order], 0))
                stop = int(np.searchsorted(rows, max(first, (factor - 1) * r.rows), side="left")) + 1
                chosen = order[:stop][inside[:stop]]
                if not len(chosen):
                    continue
                passed = min(stop, len(order))
                by_shelf: dict[int, list[int]] = {}
                for ring, shelf, cuts in zip(chosen.tolist(), t["shelf"].to_numpy()[chosen].tolist(), t["cuts"].to_numpy()[chosen].tolist(), strict=True):
                    for c in range(cuts):
                        by_shelf.setdefault(shelf + c, []).append(ring)
                by_shelf[-1] = []
                for shelf, of in by_shelf.items():
                    for name, x in zip(names, (shelf, r.query_id, r.label, r.data, r.lo, r.hi, r.worst, of, r.next + passed, r.rows + int(rows[passed - 1])), strict=True):
                        out[name].append(x)
                if len(out["shelf"]) >= 4096:
                    yield pd.DataFrame(out)
                    out = {name: [] for name in names}
        if out["shelf"]:
            yield pd.DataFrame(out)

    hit = pa.schema([("query_id", pa.int64()), ("w", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def hits(shelf: list[pa.RecordBatch], visits: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The k best of a shelf for each visitor and window, none under what the visitor has."""
        rows = pa.Table.from_batches(shelf)
        ids, label, ring = (rows[c].to_numpy() for c in ("id", "label", "ring"))
        order = np.argsort(ids, kind="stable")
        ids, label, ring = ids[order], label[order], ring[order]
        m = rings.matrix(rows["data"].to_pylist())[order]
        there, local = np.unique(ring, return_inverse=True)
        step = max(1, (1 << 21) // len(ids))
        for at in range(0, len(visits), step):
            part = visits.slice(at, step)
            query, own = part["query_id"].to_numpy(), part["label"].to_numpy()
            score = rings.matrix(part["data"].to_pylist()) @ m.T
            want = np.array([np.isin(there, np.asarray(r, np.int64)) for r in _lists(part["rings"])])
            mine = want[:, local] & (query[:, None] != ids)
            if labels != "any":
                mine &= (own[:, None] == label) == (labels == "same")
            lo, hi, worst = (_lists(part[c]) for c in ("lo", "hi", "worst"))
            for w in range(max(map(len, lo))):
                low = np.array([max(a[w], b[w]) if w < len(a) else 2**62 for a, b in zip(lo, worst, strict=True)], float)
                high = np.array([a[w] if w < len(a) else -(2**62) for a in hi], float)
                value = np.where(mine & (score >= low[:, None]) & (score <= high[:, None]), score, -np.inf)
                if len(ids) > k:
                    value[value < np.partition(value, -k, axis=1)[:, -k][:, None]] = -np.inf
                of, place = np.nonzero(value > -np.inf)
                best = np.lexsort((place, -value[of, place], of))  # places are in order of ids
                of, place = of[best], place[best]
                keep = np.arange(len(of)) - np.searchsorted(of, of) < k
                of, place = of[keep], place[keep]
                if len(of):
                    yield pa.RecordBatch.from_arrays([pa.array(query[of]), pa.array(np.full(len(of), w, np.int32)), pa.array(ids[place]), pa.array(value[of, place].astype(np.int64))], schema=hit)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shelves in order, the rows of each before its visitors."""
        now, held = None, []
        for batch in batches:
            shelf, kind = batch["shelf"].to_numpy(), batch["kind"].to_numpy()
            cut = np.flatnonzero((np.diff(shelf) != 0) | (np.diff(kind) != 0)) + 1
            for begin, end in zip([0, *cut], [*cut, len(batch)], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if shelf[begin] != now:
                    now, held = shelf[begin], []
                if kind[begin] == 0:
                    held.append(part.select(["ring", "id", "label", "data"]))
                elif held:
                    yield from hits(held, part)

    side = {"query_id": "long", "lo": "array<long>", "hi": "array<long>", "worst": "array<long>", "rings": "array<int>"}
    stored = index.rows.select("shelf", F.lit(0).alias("kind"), "ring", "id", "label", "data", *[F.lit(None).cast(t).alias(c) for c, t in side.items()])
    none = F.transform("lo", lambda _: F.lit(ANY[0]).cast("long"))
    state = save(queries.select("query_id", "label", "data", "lo", "hi", none.alias("worst"), F.lit(0).alias("next"), F.lit(0).cast("long").alias("rows")).repartition(index.partitions), "state")
    found = spark.createDataFrame([], "query_id long, w int, id long, score long, rank int")
    best = Window.partitionBy("query_id", "w").orderBy(F.desc("score"), "id")
    while True:
        planned = save(state.mapInPandas(plan, _VISIT), "visits")
        if planned.isEmpty():
            return found.select("query_id", "w", "rank", "id", "score")
        visits = planned.filter("shelf >= 0").select("shelf", F.lit(1).alias("kind"), F.lit(0).alias("ring"), F.lit(0).cast("long").alias("id"), "label", "data", *side)
        scanned = stored.unionByName(visits).repartition(index.partitions, "shelf").sortWithinPartitions("shelf", "kind").mapInArrow(scan, "query_id long, w int, id long, score long")
        found = save(found.drop("rank").unionByName(scanned).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "found")
        # What a full window has to beat; others take all.
        last = found.filter(F.col("rank") == k).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("last"))
        told = planned.filter("shelf < 0").drop("shelf", "worst", "rings").join(last, "query_id", "left")
        worst = F.transform("lo", lambda _, w: F.coalesce(F.try_element_at("last", w), F.lit(ANY[0]).cast("long")))
        state = told.select("query_id", "label", "data", "lo", "hi", worst.alias("worst"), "next", "rows")
