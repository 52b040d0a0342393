"""Seasonal regression: a piecewise linear trend times (or plus) daily and weekly waves, one model for each brand."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import stored

PERIODS = {"daily": (24.0, 4), "weekly": (168.0, 3)}
FIELDS = "prophet_expected double, prophet_lower double, prophet_upper double, prophet_anomaly_score double, prophet_is_anomaly boolean"


def hours(times: pd.Series) -> np.ndarray:
    return (pd.to_datetime(times) - pd.Timestamp("2000-01-01")).dt.total_seconds().to_numpy() / 3600


def waves(t: np.ndarray, name: str) -> np.ndarray:
    period, n = PERIODS[name]
    return np.stack([f(2 * np.pi * k * t / period) for k in range(1, n + 1) for f in (np.sin, np.cos)], 1)


def bends(t: np.ndarray, model: dict) -> np.ndarray:
    """Constant, slope and a hinge at each knot."""
    u = (t - model["origin"]) / model["span"]
    return np.stack([np.ones(len(u)), u, *[np.maximum(u - k, 0) for k in model["knots"]]], 1)


def ridge(x: np.ndarray, y: np.ndarray, penalty: np.ndarray | float) -> np.ndarray:
    """Least squares; penalty is for each column."""
    return np.linalg.lstsq(np.vstack([x, np.diag(np.sqrt(np.broadcast_to(penalty, x.shape[1])))]), np.concatenate([y, np.zeros(x.shape[1])]), rcond=None)[0]


def learn(t: np.ndarray, y: np.ndarray, multiplicative: bool = True, knots: int = 8, rounds: int = 20, bend: float = 0.05) -> dict[str, np.ndarray]:
    """Trend and waves in turn, each by least squares against what the other leaves; knots lie in the first four fifths.

    bend is how freely the trend may turn; waves that are hardly needed are held back a little.
    """
    model = {"origin": t.min(), "span": max(np.ptp(t), 1.0), "knots": np.linspace(0, 0.8, knots + 2)[1:-1], "multiplicative": np.array(multiplicative)}
    base, seasons = bends(t, model), np.concatenate([waves(t, name) for name in PERIODS], 1)
    hold = np.array([1e-9, 1e-9, *[1 / bend] * knots]) * 1e-3 * len(t)
    beta = np.zeros(seasons.shape[1])
    for _ in range(rounds if multiplicative else rounds * 2):
        swing = seasons @ beta
        weight = 1 + swing if multiplicative else np.ones(len(t))
        trend = ridge(base * weight[:, None], y if multiplicative else y - swing, hold)
        level = base @ trend
        beta = ridge(seasons * level[:, None] if multiplicative else seasons, y - level, 1e-6 * len(t) * max(float(np.mean(level**2)) if multiplicative else 1.0, 1e-12))
    model |= {"trend": trend, "waves": beta}
    return model | {"sigma": (y - parts(t, model)["expected"]).std(), "last": t.max()}


def parts(t: np.ndarray, model: dict) -> dict[str, np.ndarray]:
    """expected, trend, and a column for each season (shares of the trend where it multiplies)."""
    out, at = {"trend": bends(t, model) @ model["trend"]}, 0
    for name, (_, n) in PERIODS.items():
        out[name] = waves(t, name) @ model["waves"][at : at + 2 * n]
        at += 2 * n
    swing = sum(out[name] for name in PERIODS)
    return out | {"expected": out["trend"] * (1 + swing) if model["multiplicative"] else out["trend"] + swing}


def fit(df: DataFrame, min_rows: int = 30, multiplicative: bool = True) -> DataFrame:
    def make(pdf: pd.DataFrame) -> dict | None:
        pdf = pdf.dropna(subset=["conversion_rate"])
        return learn(hours(pdf["window_start"]), pdf["conversion_rate"].to_numpy(float), multiplicative) if len(pdf) >= min_rows else None

    return stored.fit(df, "prophet", ("conversion_rate",), make)


def score(df: DataFrame, models: DataFrame, width: float = 1.96) -> DataFrame:
    """Adds the expected value, its bounds, how far outside them the row lies (0 to 1) and whether it does.

    A row without a rate lies nowhere; a brand without a model is expected to be as it is.
    """

    def say(pdf: pd.DataFrame, model: dict) -> dict:
        y, mean = pdf["conversion_rate"].to_numpy(float), parts(hours(pdf["window_start"]), model)["expected"]
        half = width * float(model["sigma"])
        low, high = mean - half, mean + half
        over = np.nan_to_num(np.clip(np.maximum(low - y, y - high) / (half + 1e-8), 0, 1))
        return {"prophet_expected": mean, "prophet_lower": low, "prophet_upper": high, "prophet_anomaly_score": over, "prophet_is_anomaly": (y < low) | (y > high)}

    as_it_is = {f"prophet_{x}": F.col("conversion_rate") for x in ("expected", "lower", "upper")}
    return stored.score(df, models, "prophet", ("conversion_rate",), FIELDS, say, as_it_is | {"prophet_anomaly_score": 0.0, "prophet_is_anomaly": False})


def _from_models(models: DataFrame, periods: int, fields: str, make) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        model = unpacked_of(pdf)
        t = float(model["last"]) + 1 + np.arange(periods)
        return pd.DataFrame({"brand": pdf["brand"].iloc[0], "window_start": pd.Timestamp("2000-01-01") + pd.to_timedelta(t, unit="h")} | make(t, model))

    return stored.fitted(models).filter(F.col("kind") == "prophet").groupBy("brand").applyInPandas(run, f"brand string, window_start timestamp_ntz, {fields}")


def unpacked_of(pdf: pd.DataFrame) -> dict:
    return stored.unpacked(pdf["params"].iloc[0])


def forecast(models: DataFrame, periods: int = 168, width: float = 1.96) -> DataFrame:
    """brand, window_start, expected, lower, upper, trend for the hours after each model's last."""

    def make(t, model):
        found, half = parts(t, model), width * float(model["sigma"])
        return {"expected": found["expected"], "lower": found["expected"] - half, "upper": found["expected"] + half, "trend": found["trend"]}

    return _from_models(models, periods, "expected double, lower double, upper double, trend double", make)


def components(models: DataFrame, periods: int = 168) -> DataFrame:
    """brand, window_start, trend, daily, weekly for the hours after each model's last."""
    return _from_models(models, periods, "trend double, daily double, weekly double", lambda t, model: {k: v for k, v in parts(t, model).items() if k != "expected"})
