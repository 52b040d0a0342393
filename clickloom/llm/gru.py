"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax.

Words are numbered by frequency and cut into classes of about equal sums of root counts, so that frequent
words are in small classes; the probability of a word is that of its class times that of the word
within it. Documents run side by side in lanes, window by window; the hidden state of a lane is carried from one
window to the next, in training as in scoring, and only the gradient stops at a window's edge.

Hidden states have a last column of ones, so the last column of the output parameters holds the biases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Shape:
    hidden: int = 16
    window: int = 32  # steps, or more where lanes are few
    lanes: int = 1024
    cells: int = 8192  # that a window of training has, about, where lanes are few


#: name, rows (or all of them), gradient
Step = Callable[[str, "np.ndarray | slice", np.ndarray], None]


def classes(counts: np.ndarray) -> np.ndarray:
    """First word of each class, and the number of words. So many classes that both softmaxes together cost least."""
    root = np.sqrt(counts + 0.1)
    n = max(1, round(root.sum() / np.sqrt((counts + 0.1).sum())))
    of = np.minimum(np.cumsum(root) / root.sum() * n, n - 1e-9).astype(np.int64)
    return np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(counts))


def narrow(x: np.ndarray, top: int) -> np.ndarray:
    """Two bytes a number where that is enough: they sort faster."""
    return x.astype(np.uint16) if top <= 1 << 16 else x


def begin(shape: Shape, counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters before training: the output biases give the unigram probabilities."""
    rng, h, starts = np.random.default_rng(seed), shape.hidden, classes(counts)
    share = counts + 0.1
    by = np.add.reduceat(share, starts[:-1])
    within = share / np.repeat(by, np.diff(starts))
    # With equal word probabilities in an empty context, only the biases speak.
    zeros = np.zeros((len(by), h)), np.zeros((len(counts), h))
    return {
        "x": rng.normal(0, 0.3, (len(counts), 3 * h)).astype(np.float32),
        "u": rng.normal(0, 0.5 / np.sqrt(h), (3 * h, h)).astype(np.float32),
        "c": np.column_stack([zeros[0], np.log(by / by.sum())]).astype(np.float32),
        "w": np.column_stack([zeros[1], np.log(within)]).astype(np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; the exponential takes less time than the hyperbolic tangent."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def forward(p: dict, inputs: np.ndarray, state: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
    """Hidden states after each input (window x lanes x hidden + 1), and what the backward pass needs, unless it isn't to be kept: then states alone.

    state is hidden x lanes: within the loop lanes come last, so that gates are contiguous.
    """
    h, steps = len(state), len(inputs)
    gates = np.empty((steps if keep else 1, 3 * h, inputs.shape[1]), p["x"].dtype)
    states = np.empty((steps + 1, *state.shape), np.float32)
    fresh, inner = np.empty((2, steps if keep else 1, *state.shape), np.float32)
    states[0] = state
    for t in range(steps):
        k = t if keep else 0
        gate = gates[k]
        gate[:] = p["x"].take(inputs[t], 0).T
        both = p["u"] @ states[t]
        gate[: 2 * h] += both[: 2 * h]
        _sigmoid(gate[: 2 * h])
        inner[k] = both[2 * h :]
        n = np.multiply(gate[:h], inner[k], out=fresh[k])
        n += gate[2 * h :]
        np.tanh(n, out=n)
        now = np.subtract(states[t], n, out=states[t + 1])
        now *= gate[h : 2 * h]
        now += n
    out = np.ones((*inputs.shape, h + 1), np.float32)
    out[:, :, :h] = states[1:].transpose(0, 2, 1)
    return out, (states, gates, fresh, inner) if keep else (states,)


def _softmax(weights: np.ndarray, wide: bool, hidden: np.ndarray, cell: np.ndarray, logit: np.ndarray, total: np.ndarray, back: np.ndarray | None, room: np.ndarray, ones: np.ndarray) -> np.ndarray | None:
    """Fills logit of each target (whose place among all products is its cell) and total of all exponentials; with back, it gets the gradient by hidden times -total, and that by weights comes back.

    Hidden states stay within -1 and 1, so only wide weights can overflow. Exponentials are made in room, which stays in the cache.
    """
    n, k = len(hidden), len(weights)
    flat = room[: n * k]
    e = flat.reshape(n, k)
    np.matmul(hidden, weights.T, out=e)
    if wide:
        e -= e.max(1, keepdims=True)
    flat.take(cell, out=logit, mode="clip")
    np.exp(e, out=e)
    np.matmul(e, ones[:k], out=total)
    if back is None:
        return None
    flat[cell] -= total
    np.matmul(e, weights[:, :-1], out=back)
    return e.T @ (hidden / -total[:, None])


def output(p: dict, starts: np.ndarray, hidden: np.ndarray, target: np.ndarray, step: Step | None = None, piece: int = 1 << 15) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each target; with a step, it gets the gradients by "c" and "w", and that by hidden comes back.

    Targets are sorted, so that those of a class lie together; about `piece` exponentials are in hand at a time.
    """
    n, kind, sizes = len(target), p["c"].dtype, np.diff(starts)
    order = np.argsort(narrow(target, starts[-1]), kind="stable")
    words, h = target.take(order), hidden.astype(kind, copy=False).take(order, 0)
    cuts = np.searchsorted(words, starts)
    cls = np.repeat(np.arange(len(sizes)), np.diff(cuts))
    wide = {name: bool((np.abs(p[name]) @ np.ones(h.shape[1], kind)).max(initial=0) > 80) for name in ("c", "w")}
    logit, total = np.zeros((2, n), kind), np.ones((2, n), kind)
    back = np.zeros((2, n, h.shape[1] - 1), kind) if step else (None, None)
    rows, most = np.maximum(16, piece // sizes), max(16, piece // len(sizes))
    room = np.empty(max(int((np.minimum(rows, n) * sizes).max(initial=0)), min(most, n) * len(sizes)), kind)
    ones = np.ones(max(len(sizes), int(sizes.max(initial=0))), kind)
    places = np.arange(n)
    cells = places % most * len(sizes) + cls, (places - cuts[cls]) % rows[cls] * sizes[cls] + words - starts[cls]

    def over(level: int, weights: np.ndarray, wide: bool, rows: int, a: int, b: int) -> np.ndarray | None:
        found = None
        for k in range(a, b, rows):
            part = slice(k, min(k + rows, b))
            g = _softmax(weights, wide, h[part], cells[level][part], logit[level, part], total[level, part], back[level][part] if step else None, room, ones)
            if found is None:
                found = g
            else:
                found += g
        return found

    d_c = over(0, p["c"], wide["c"], most, 0, n)
    bounds, rows = cuts.tolist(), rows.tolist()
    for k in np.flatnonzero((np.diff(cuts) > 0) & (sizes > 1)).tolist():
        a, b = starts[k], starts[k + 1]
        d_w = over(1, p["w"][a:b], wide["w"], rows[k], bounds[k], bounds[k + 1])
        if step:
            step("w", slice(a, b), d_w)
    logp = np.empty(n, np.float32)
    logp[order] = (logit - np.log(total)).sum(0)
    if not step:
        return logp, None
    if n:
        step("c", slice(None), d_c)
    back /= -total[:, :, None]
    by_hidden = np.zeros_like(hidden)  # the column of ones has no gradient
    by_hidden[:, :-1][order] = back[0] + back[1]
    return logp, by_hidden


def backward(p: dict, inputs: np.ndarray, kept: tuple, d_out: np.ndarray, step: Step) -> None:
    """Gradients by the recurrent parameters within one window."""
    states, gates, fresh, inner = kept
    h = states.shape[1]
    d_given = np.empty((len(inputs), 3 * h, inputs.shape[1]), np.float32)
    d_u, both, carry = np.zeros_like(p["u"]), np.empty(d_given.shape[1:], np.float32), np.zeros_like(states[0])
    back = np.ascontiguousarray(p["u"].T)
    for t in range(len(inputs) - 1, -1, -1):
        r, z, n = gates[t, :h], gates[t, h : 2 * h], fresh[t]
        carry += d_out[t].T[:h]
        given = 1 - z
        given *= carry
        d_r, d_z, d_n = (d_given[t, k * h : (k + 1) * h] for k in range(3))
        np.multiply(n, n, out=d_n)
        np.subtract(1, d_n, out=d_n)
        d_n *= given
        np.subtract(states[t], n, out=d_z)
        d_z *= given
        d_z *= z
        np.subtract(1, r, out=d_r)
        d_r *= r
        d_r *= inner[t]
        d_r *= d_n
        both[: 2 * h] = d_given[t, : 2 * h]
        np.multiply(d_n, r, out=both[2 * h :])
        d_u += both @ states[t].T
        carry *= z
        carry += back @ both
        np.clip(carry, -10, 10, out=carry)  # gradients may grow over a long window
    step("u", slice(None), d_u)
    # Sums by word, one column after the other where they lie.
    words = inputs.reshape(-1)
    there = np.zeros(len(p["x"]), bool)
    there[words] = True
    used = np.flatnonzero(there)
    number = np.cumsum(there)[words] - 1
    d_x = np.empty((3 * h, len(used)), np.float32)
    for k in range(3 * h):
        d_x[k] = np.bincount(number, d_given[:, k].astype(np.float64).reshape(-1), len(used))
    step("x", used, np.ascontiguousarray(d_x.T))


def lanes(documents: list[np.ndarray], shape: Shape) -> Iterator[np.ndarray]:
    """Positions of documents by length, as many as run side by side."""
    order = np.argsort([len(d) for d in documents], kind="stable")
    yield from (order[k : k + shape.lanes] for k in range(0, len(order), shape.lanes))


def windows(documents: list[np.ndarray], end: int, cells: int, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(inputs, targets, which cells are real, first lane still running) of documents in order of length.

    A lane stops with its document. A window has `shortest` steps, or more if that keeps it under cells.
    """
    lengths = np.array([len(d) for d in documents])
    flat = np.concatenate([[end], *documents], dtype=np.int32, casting="same_kind")
    begins = 1 + np.cumsum(lengths) - lengths
    at, first = 0, 0
    while first < len(documents):
        steps = max(shortest, cells // (len(documents) - first))
        steps = min(steps, int(lengths[-1]) - at)
        now = np.arange(at, at + steps)[:, None]
        real = now < lengths[first:]
        cell = (begins[first:] + now) * real
        target = flat.take(cell)
        inputs = flat.take(np.maximum(cell - 1, 0))
        if not at:
            inputs[0] = end
        yield inputs, target, real, first
        at += steps
        first = int(np.searchsorted(lengths, at, side="right"))


def chosen(x: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Rows of the cells of a window that are real."""
    return x.reshape(-1, *x.shape[2:]) if real.all() else x[real]


def score(p: dict, starts: np.ndarray, shape: Shape, documents: list[np.ndarray], end: int, cells: int = 1 << 15) -> np.ndarray:
    """Natural log probability of each document, its state carried over all its windows."""
    out = np.zeros(len(documents))
    for block in lanes(documents, shape):
        state = np.zeros((shape.hidden, len(block)), np.float32)
        held: list[tuple[np.ndarray, ...]] = []

        def settle(block=block, held=held) -> None:
            hidden, target, lane = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            out[block] += np.bincount(lane, weights=output(p, starts, hidden, target)[0], minlength=len(block))

        for inputs, target, real, first in windows([documents[k] for k in block], end, cells, shape.window):
            hidden, kept = forward(p, inputs, state[:, state.shape[1] - inputs.shape[1] :], keep=False)
            state = kept[0][-1]
            lane = np.broadcast_to(np.arange(first, len(block)), real.shape)
            held.append((chosen(hidden, real), chosen(target, real), chosen(lane, real)))
            if sum(len(x[1]) for x in held) >= 2 * cells:
                settle()
        if held:
            settle()
    return out


class Trainer:
    """Adagrad over windows."""

    def __init__(self, p: dict, starts: np.ndarray, shape: Shape, rate: float):
        self.p, self.starts, self.shape, self.rate, self.tokens = {k: v.copy() for k, v in p.items()}, starts, shape, np.float32(rate), 0
        # Gradients would be divided by the root of a whole window, the same for all, so that those of few tokens move little; the start is multiplied instead.
        self.speed = {k: np.full_like(v, 1e-2 * shape.lanes * shape.window) for k, v in p.items()}
        self.rng = np.random.default_rng(3)

    def step(self, name: str, rows: np.ndarray | slice, g: np.ndarray) -> None:
        speed = self.speed[name][rows]
        speed += g * g
        g = g / np.sqrt(speed)
        g *= self.rate
        if isinstance(rows, slice):  # speed was a view
            self.p[name][rows] += g
        else:
            self.speed[name][rows] = speed
            self.p[name][rows] += g

    def learn(self, documents: list[np.ndarray], end: int) -> None:
        """One pass, over blocks of documents of about one length in random order."""
        blocks = list(lanes(documents, self.shape))
        for number in self.rng.permutation(len(blocks)).tolist():
            block = blocks[number]
            state = np.zeros((self.shape.hidden, len(block)), np.float32)
            for inputs, target, real, _ in windows([documents[k] for k in block], end, self.shape.cells, self.shape.window):
                hidden, kept = forward(self.p, inputs, state[:, state.shape[1] - inputs.shape[1] :])
                state = kept[0][-1]
                _, back = output(self.p, self.starts, chosen(hidden, real), chosen(target, real), self.step)
                if len(back) == real.size:
                    d_out = back.reshape(hidden.shape)
                else:
                    d_out = np.zeros_like(hidden)
                    d_out[real] = back
                backward(self.p, inputs, kept, d_out, self.step)
                self.tokens += int(real.sum())
