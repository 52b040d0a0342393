"""Changepoints of a brand's conversion rate: three searches, two costs, and the rows near a change."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stored


class Squares:
    """Squared deviation from the segment's mean."""

    def __init__(self, x: np.ndarray):
        self.one, self.two = np.concatenate([[0], np.cumsum(x)]), np.concatenate([[0], np.cumsum(x * x)])

    def ending(self, a: int, b: int) -> np.ndarray:
        """Costs of the segments from each of a..b-1 up to b."""
        k = np.arange(a, b)
        return self.two[b] - self.two[k] - (self.one[b] - self.one[k]) ** 2 / (b - k)

    def beginning(self, a: int, b: int) -> np.ndarray:
        """Costs of the segments from a up to each of a+1..b."""
        k = np.arange(a + 1, b + 1)
        return self.two[k] - self.two[a] - (self.one[k] - self.one[a]) ** 2 / (k - a)


class Kernel:
    """Spread within a segment as a Gaussian kernel sees it; the width is the median distance of at most 500 points.

    Sums over blocks of the kernel matrix are built up row by row, so memory is linear in the series.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        some = x[np.linspace(0, len(x) - 1, min(len(x), 500)).astype(int)]
        middle = np.median(((some[:, None] - some[None, :]) ** 2)[np.triu_indices(len(some), 1)]) if len(some) > 1 else 0
        self.gamma = 1 / middle if middle > 0 else 1.0

    def row(self, k: int, a: int, b: int) -> np.ndarray:
        return np.exp(-np.clip(self.gamma * (self.x[a:b] - self.x[k]) ** 2, 1e-2, 1e2))

    def beginning(self, a: int, b: int) -> np.ndarray:
        grown = np.array([2 * self.row(k, a, k).sum() + 1 for k in range(a, b)])
        n = np.arange(1, b - a + 1)
        return n - np.cumsum(grown) / n

    def ending(self, a: int, b: int) -> np.ndarray:
        grown = np.array([2 * self.row(k, k + 1, b).sum() + 1 for k in range(a, b)])
        n = np.arange(b - a, 0, -1)
        return n - np.cumsum(grown[::-1])[::-1] / n


COSTS = {"l2": Squares, "rbf": Kernel}


def pelt(x: np.ndarray, cost, penalty: float, least: int) -> list[int]:
    """Ends of the segments (without the last) of least cost plus penalty: exact dynamic programming with pruning."""
    n = len(x)
    best, back = np.full(n + 1, np.inf), np.zeros(n + 1, int)
    best[0], open_at = -penalty, np.array([0])
    inside = np.zeros(n + 1)  # of the kernel: the block sum from each start up to the end in hand
    for end in range(1, n + 1):
        if isinstance(cost, Kernel):
            row = cost.row(end - 1, 0, end - 1)
            inside[:end] += 2 * np.concatenate([np.cumsum(row[::-1])[::-1], [0]]) + 1
        if end < least:
            continue
        width = end - open_at
        one = width - inside[open_at] / width if isinstance(cost, Kernel) else cost.ending(0, end)[open_at]
        total = np.where(width >= least, best[open_at] + one + penalty, np.inf)
        k = int(total.argmin())
        best[end], back[end] = total[k], open_at[k]
        keep = (best[open_at] + one <= best[end]) | (width < least)
        open_at = np.append(open_at[keep], end - least + 1)
    out, end = [], n
    while end > 0:
        end = int(back[end])
        if end:
            out.append(end)
    return out[::-1]


def halving(x: np.ndarray, cost, penalty: float, least: int) -> list[int]:
    """Splits where that gains most, while it gains more than the penalty."""

    def split(a: int, b: int) -> tuple[float, int]:
        if b - a < 2 * least:
            return 0.0, a
        left, right = cost.beginning(a, b), cost.ending(a, b)
        gain = right[0] - left[least - 1 : b - a - least] - right[least : b - a - least + 1]
        k = int(gain.argmax())
        return float(gain[k]), a + least + k

    parts, out = {(0, len(x)): split(0, len(x))}, []
    while parts:
        (a, b), (gain, k) = max(parts.items(), key=lambda p: p[1][0])
        if gain <= penalty:
            break
        del parts[a, b]
        out.append(k)
        parts[a, k], parts[k, b] = split(a, k), split(k, b)
    return sorted(out)


def merging(x: np.ndarray, cost, penalty: float, least: int) -> list[int]:
    """From segments of the least size: joins the neighbours that lose least, while they lose less than the penalty."""
    ends = [*range(least, len(x) - least + 1, least), len(x)]
    starts = [0, *ends[:-1]]

    def whole(a: int, b: int) -> float:
        return float(cost.beginning(a, b)[-1])

    costs = [whole(a, b) for a, b in zip(starts, ends, strict=True)]
    loss = [whole(starts[k], ends[k + 1]) - costs[k] - costs[k + 1] for k in range(len(ends) - 1)]
    while loss:
        k = int(np.argmin(loss))
        if loss[k] >= penalty:
            break
        costs[k : k + 2] = [loss[k] + costs[k] + costs[k + 1]]
        del starts[k + 1], ends[k], loss[k]
        for j in (k - 1, k):
            if 0 <= j < len(loss):
                loss[j] = whole(starts[j], ends[j + 1]) - costs[j] - costs[j + 1]
    return ends[:-1]


SEARCHES = {"pelt": pelt, "binseg": halving, "bottomup": merging}


def segment_ends(x: np.ndarray, penalty: float, least: int, search: str = "pelt", cost: str = "rbf") -> list[int]:
    return SEARCHES[search](x, COSTS[cost](x), penalty, least) if len(x) >= 2 * least else []


def changepoints(df: DataFrame, least: int = 24, penalty: float = 10.0, min_change: float = 0.15, search: str = "pelt", cost: str = "rbf") -> DataFrame:
    """brand, changepoint_time, mean_before, mean_after, magnitude: where the mean conversion shifts by min_change or more.

    A brand whose search raises has one row, without a time, and the reason in `error`.

    The series is standardised for squared costs (the kernel has its own width), so that one penalty fits all brands.
    """
    if search not in SEARCHES or cost not in COSTS:
        raise ValueError(f"unknown search or cost: {search}, {cost}")

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return shifts(pdf).assign(error=None)
        except Exception as error:  # of this brand alone
            return pd.DataFrame([(pdf["brand"].iloc[0], None, None, None, None, stored.reason(error))], columns=["brand", "changepoint_time", "mean_before", "mean_after", "magnitude", "error"])

    def shifts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["conversion_rate"]).sort_values("window_start")
        x = pdf["conversion_rate"].to_numpy(float)
        scaled = (x - x.mean()) / x.std() if cost == "l2" and len(x) and x.std() > 0 else x
        ends = [0, *segment_ends(scaled, penalty, least, search, cost), len(x)]
        rows = []
        for a, b, c in zip(ends, ends[1:], ends[2:], strict=False):
            before, after = x[a:b].mean(), x[b:c].mean()
            size = abs(after - before) / abs(before) if before else 0.0
            if size >= min_change:
                rows.append((pdf["brand"].iloc[0], pdf["window_start"].iloc[b], before, after, size))
        return pd.DataFrame(rows, columns=["brand", "changepoint_time", "mean_before", "mean_after", "magnitude"])

    kind = df.schema["window_start"].dataType.simpleString()
    series = df.select("brand", "window_start", "conversion_rate").filter("brand IS NOT NULL")
    return series.groupBy("brand").applyInPandas(find, f"brand string, changepoint_time {kind}, mean_before double, mean_after double, magnitude double, error string")


def flag_changepoints(df: DataFrame, points: DataFrame, hours: int = 2) -> DataFrame:
    """Marks rows within hours of a changepoint of their brand; of several, the latest counts.

    The range is turned into equal keys: a changepoint is dealt to each hour that it reaches, so the join is by brand and hour.
    """
    reach = F.explode(F.sequence(F.lit(-hours), F.lit(hours))).alias("k")
    near = points.select("brand", "changepoint_time", "magnitude", reach).withColumn("hour", F.date_trunc("hour", F.timestamp_add("HOUR", F.col("k"), F.col("changepoint_time"))))
    rows = df.withColumn("hour", F.date_trunc("hour", "window_start"))
    close = F.abs(F.unix_timestamp("window_start") - F.unix_timestamp("changepoint_time")) <= hours * 3600
    hits = rows.select("brand", "window_start", "hour").join(near, ["brand", "hour"]).filter(close).groupBy("brand", "window_start").agg(F.max_by("magnitude", "changepoint_time").alias("m"))
    out = df.join(hits, ["brand", "window_start"], "left")
    return out.withColumns({"is_at_changepoint": F.col("m").isNotNull(), "changepoint_is_anomaly": F.col("m").isNotNull(), "changepoint_anomaly_score": F.coalesce(F.least(F.col("m") * 2, F.lit(1.0)), F.lit(0.0))}).drop("m")


def summary(points: DataFrame) -> DataFrame:
    """Points in order of brand and time; brands whose search failed have none."""
    return points.filter(F.col("changepoint_time").isNotNull()).drop("error").withColumn("direction", F.when(F.col("mean_after") > F.col("mean_before"), "increase").otherwise("decrease")).orderBy("brand", "changepoint_time")
