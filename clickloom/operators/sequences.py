"""A recurrent autoencoder in numpy: LSTM layers down to a dense code, and LSTM layers back to the sequence.

One model for each brand, trained on its sliding sequences by Adam with dropout and early stopping. A sequence that
is rebuilt badly ends in an unusual hour.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import stored

COLUMNS = ("conversion_rate", "views", "purchases")
FIELDS = "lstm_reconstruction_error double, lstm_anomaly_score double, lstm_is_anomaly boolean"


@dataclass(frozen=True)
class Plan:
    steps: int = 168
    units: tuple[int, ...] = (64, 32)
    code: int = 32
    dropout: float = 0.2
    epochs: int = 50
    batch: int = 32
    held: float = 0.2
    rate: float = 1e-3
    patience: int = 10
    percentile: float = 95.0
    factor: float = 1.5
    seed: int = 42


def begin(plan: Plan, columns: int) -> dict[str, np.ndarray]:
    rng, p = np.random.default_rng(plan.seed), {}

    def layer(name: str, n_in: int, n: int) -> None:
        p[f"{name}.w"] = rng.uniform(-1, 1, (n_in + n, 4 * n)) * np.sqrt(3 / (n_in + n))
        p[f"{name}.b"] = np.repeat([0.0, 1.0, 0.0, 0.0], n)  # the forget gate begins open

    sizes = [columns, *plan.units]
    for k, n in enumerate(plan.units):
        layer(f"in{k}", sizes[k], n)
    sizes = [plan.code, *reversed(plan.units)]
    for k, n in enumerate(reversed(plan.units)):
        layer(f"out{k}", sizes[k], n)
    for name, a, b in (("code", plan.units[-1], plan.code), ("last", plan.units[0], columns)):
        p[f"{name}.w"], p[f"{name}.b"] = rng.uniform(-1, 1, (a, b)) * np.sqrt(3 / a), np.zeros(b)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (steps x rows x units) over inputs (steps x rows x columns), and what the way back needs."""
    n = w.shape[1] // 4
    h, c = np.zeros((x.shape[1], n)), np.zeros((x.shape[1], n))
    out, kept = np.empty((*x.shape[:2], n)), []
    for t in range(len(x)):
        both = np.concatenate([x[t], h], 1)
        z = both @ w + b
        i, f, o, g = _sigmoid(z[:, :n]), _sigmoid(z[:, n : 2 * n]), _sigmoid(z[:, 2 * n : 3 * n]), np.tanh(z[:, 3 * n :])
        before, c = c, f * c + i * g
        s = np.tanh(c)
        h = out[t] = o * s
        kept.append((both, i, f, o, g, before, s))
    return out, kept


def lstm_back(d_out: np.ndarray, kept: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients by inputs, weights and biases."""
    n = w.shape[1] // 4
    n_in = w.shape[0] - n
    d_w, d_b, d_x = np.zeros_like(w), np.zeros(w.shape[1]), np.empty((*d_out.shape[:2], n_in))
    d_h, d_c = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
    for t in range(len(d_out) - 1, -1, -1):
        both, i, f, o, g, before, s = kept[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - s * s)
        z = np.concatenate([d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * s * o * (1 - o), d_c * i * (1 - g * g)], 1)
        d_w += both.T @ z
        d_b += z.sum(0)
        d_both = z @ w.T
        d_x[t], d_h, d_c = d_both[:, :n_in], d_both[:, n_in:], d_c * f
    return d_x, d_w, d_b


def run(p: dict, plan: Plan, x: np.ndarray, rng: np.random.Generator | None = None) -> tuple[np.ndarray, list]:
    """The rebuilt sequences (rows x steps x columns); with rng, layers drop out. Also what the way back needs."""
    trail, now, n = [], np.swapaxes(x, 0, 1), len(plan.units)

    def through(name: str, now: np.ndarray) -> np.ndarray:
        out, kept = lstm(now, p[f"{name}.w"], p[f"{name}.b"])
        mask = (rng.random(out.shape) >= plan.dropout) / (1 - plan.dropout) if rng is not None else None
        trail.append((name, kept, mask))
        return out if mask is None else out * mask

    for k in range(n):
        now = through(f"in{k}", now)
    ends = now[-1]
    code = np.maximum(ends @ p["code.w"] + p["code.b"], 0)
    now = np.broadcast_to(code, (x.shape[1], *code.shape))
    for k in range(n):
        now = through(f"out{k}", now)
    return np.swapaxes(now @ p["last.w"] + p["last.b"], 0, 1), [trail, ends, code, now]


def slopes(p: dict, plan: Plan, x: np.ndarray, rng: np.random.Generator | None = None) -> tuple[float, dict]:
    """Mean squared error and its gradient by each parameter."""
    y, (trail, ends, code, top) = run(p, plan, x, rng)
    n, g = len(plan.units), {}
    d_y = np.swapaxes(2 * (y - x) / x.size, 0, 1)
    g["last.w"], g["last.b"] = np.einsum("tri,trj->ij", top, d_y), d_y.sum((0, 1))
    d = d_y @ p["last.w"].T
    for k in range(2 * n - 1, -1, -1):
        name, kept, mask = trail[k]
        if k == n - 1:  # below the code: only the last step's state was used
            d_code = d.sum(0) * (code > 0)
            g["code.w"], g["code.b"] = ends.T @ d_code, d_code.sum(0)
            d = np.zeros((x.shape[1], *ends.shape))
            d[-1] = d_code @ p["code.w"].T
        d, g[f"{name}.w"], g[f"{name}.b"] = lstm_back(d if mask is None else d * mask, kept, p[f"{name}.w"])
    return float(((y - x) ** 2).mean()), g


def sequences(z: np.ndarray, steps: int) -> np.ndarray:
    """rows x steps x columns."""
    return np.swapaxes(np.lib.stride_tricks.sliding_window_view(z, steps, axis=0), 1, 2)


def errors(p: dict, plan: Plan, x: np.ndarray) -> np.ndarray:
    """Mean absolute error of each sequence."""
    return np.concatenate([np.abs(x[k : k + 256] - run(p, plan, x[k : k + 256])[0]).mean((1, 2)) for k in range(0, len(x), 256)])


def learn(values: np.ndarray, plan: Plan) -> dict[str, np.ndarray] | None:
    """Parameters, scaler and threshold; the last fifth of the sequences says when to stop."""
    if len(values) < plan.steps + 4:
        return None
    mean, std = values.mean(0), values.std(0) + 1e-8
    x = sequences((values - mean) / std, plan.steps)
    cut = max(1, int(len(x) * (1 - plan.held)))
    rng, p = np.random.default_rng(plan.seed), begin(plan, values.shape[1])
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    best, kept, bad, step = np.inf, p, 0, 0
    for _ in range(plan.epochs):
        order = rng.permutation(cut)
        for at in range(0, cut, plan.batch):
            _, g = slopes(p, plan, x[order[at : at + plan.batch]], rng if plan.dropout else None)
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - plan.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
        loss = errors(p, plan, x[cut:] if cut < len(x) else x).mean()
        if loss < best:
            best, kept, bad = loss, dict(p), 0
        elif (bad := bad + 1) >= plan.patience:
            break
    threshold = np.percentile(errors(kept, plan, x), plan.percentile) * plan.factor
    return kept | {"mean": mean, "std": std, "threshold": threshold}


def fit(df: DataFrame, plan: Plan = Plan()) -> DataFrame:
    return stored.fit(df, "lstm", COLUMNS, lambda pdf: learn(stored.numbers(pdf, COLUMNS), plan))


def score(df: DataFrame, models: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Adds the error of the sequence that ends in the row (0 for the first ones), its share of the threshold up to 1, and whether it exceeds it."""

    def say(pdf: pd.DataFrame, model: dict) -> dict:
        values, limit = stored.numbers(pdf, COLUMNS), float(model["threshold"])
        error = np.zeros(len(values))
        if len(values) >= plan.steps:
            error[plan.steps - 1 :] = errors(model, plan, sequences((values - model["mean"]) / model["std"], plan.steps))
        return {"lstm_reconstruction_error": error, "lstm_anomaly_score": np.clip(error / limit, 0, 1) if limit > 0 else error * 0, "lstm_is_anomaly": error > limit}

    return stored.score(df, models, "lstm", COLUMNS, FIELDS, say, {"lstm_reconstruction_error": 0.0, "lstm_anomaly_score": 0.0, "lstm_is_anomaly": False})
