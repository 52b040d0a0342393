"""Cover trees over integer vectors, and a dual-tree search of the nearest of few by the nodes of many.

A tree is arrays. Points are put in an order in which the descendants of every node are neighbours. Radii halve by
level: the children of a node are balls of half its scale around points that lie further apart than that, chosen greedily, the node's own
point first. Levels that split nothing are left out, and a node of few points, or of equal points, is a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 16


@dataclass
class Tree:
    points: np.ndarray  # in the tree's order, as doubles that hold integers
    order: np.ndarray  # place of each point in the input
    start: np.ndarray  # of each node: its points are points[start:stop], the first one is its centre
    stop: np.ndarray
    radius: np.ndarray  # greatest distance of a descendant from the centre
    child: np.ndarray  # children are nodes child:last; none in a leaf
    last: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Top down, a level of one node at a time; a node's children are numbered together."""
    x = np.asarray(points, float)
    norms = (x * x).sum(1)
    order = np.arange(len(x))
    start, stop, radius, child, last = [0], [len(x)], [0.0], [0], [0]
    at = 0
    while at < len(start):
        begin, end = start[at], stop[at]
        own = order[begin:end]
        far = _from(x, norms, own, own[0]) if end > begin else np.zeros(0)
        radius[at] = float(far.max(initial=0.0))
        child[at] = last[at] = len(start)
        if end - begin > leaf and radius[at] > 0:
            scale, label = radius[at] / 2, np.zeros(len(own), np.int64)
            while True:
                # A ball around the node's own point, then around the first point that is in no ball yet.
                label[:], n, distance = -1, 0, far
                while True:
                    free = label < 0
                    label[free & (distance <= scale)] = n
                    n += 1
                    rest = np.flatnonzero(label < 0)
                    if not len(rest):
                        break
                    distance = _from(x, norms, own, own[rest[0]])
                if n > 1:
                    break
                scale /= 2
            by = np.argsort(label, kind="stable")
            order[begin:end] = own[by]
            edges = begin + np.searchsorted(label[by], np.arange(n + 1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                start.append(a), stop.append(b), radius.append(0.0), child.append(0), last.append(0)
            last[at] = len(start)
        at += 1
    return Tree(x[order], order, *(np.array(v, np.int64) for v in (start, stop)), np.array(radius), *(np.array(v, np.int64) for v in (child, last)))


def _from(x: np.ndarray, norms: np.ndarray, of: np.ndarray, centre: int) -> np.ndarray:
    return np.sqrt(np.maximum(norms[of] + norms[centre] - 2.0 * (x[of] @ x[centre]), 0))


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, .. count[k] of them, for all k in a row."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first, count)


def nearest(tree: Tree, few: Tree) -> tuple[np.ndarray, int]:
    """For each point of tree, in its order, the nearest point of few, by its place in few's input; ties to the smaller place.

    Pairs of nodes go down both trees together. A pair goes when even its nearest points are further apart than the farthest
    point of its node is from some point of few; a node left with one point of few gives all its points to it; leaves that meet are compared exactly.
    Returns the distances computed, too.
    """
    out = np.full(len(tree.points), -1, np.int64)
    centre, other = tree.points[tree.start], few.points[few.start]
    a_norm, b_norm = (centre * centre).sum(1), (other * other).sum(1)
    slack = 1e-6 * np.sqrt(max(a_norm.max(initial=0), b_norm.max(initial=0))) + 1e-9
    node, at, cost = np.zeros(min(1, len(tree.points)), np.int64), np.zeros(min(1, len(tree.points)), np.int64), 0
    is_leaf, one = tree.child == tree.last, (few.stop - few.start) == 1
    settled: list[tuple[np.ndarray, np.ndarray]] = []
    while len(node):
        d = np.sqrt(np.maximum(a_norm[node] + b_norm[at] - 2.0 * np.einsum("ij,ij->i", centre[node], other[at]), 0))
        cost += len(node)
        nodes, of = np.unique(node, return_inverse=True)
        bound = np.full(len(nodes), np.inf)
        np.minimum.at(bound, of, d + tree.radius[node])
        keep = d - tree.radius[node] - few.radius[at] <= bound[of] + slack
        node, at, of = node[keep], at[keep], of[keep]
        count = np.bincount(of, minlength=len(nodes))
        alone = (count[of] == 1) & one[at]
        for k, c in zip(node[alone].tolist(), at[alone].tolist(), strict=True):
            out[tree.start[k] : tree.stop[k]] = few.order[few.start[c]]
        node, at, of = node[~alone], at[~alone], of[~alone]
        low = few.child[at] == few.last[at]
        done = is_leaf[node] & (np.bincount(of, ~low, minlength=len(nodes))[of] == 0)
        settled.append((node[done], at[done]))
        node, at, low = node[~done], at[~done], low[~done]
        # The wider side of a pair is opened, or the one that can be; all pairs of a node go down with it.
        wide = np.zeros(len(tree.start), bool)
        if len(node):
            reach = np.zeros(len(tree.start))
            np.maximum.at(reach, node, np.where(low, 0.0, few.radius[at]))
            wide = ~is_leaf & (tree.radius >= reach)
        down = wide[node]
        width = np.where(down, tree.last[node] - tree.child[node], 1)
        below_node = np.where(np.repeat(down, width), _spread(np.where(down, tree.child[node], node), width), np.repeat(node, width))
        below_at, still, shut = np.repeat(at, width), np.repeat(~down, width), np.repeat(low, width)
        opened = still & ~shut
        width = np.where(opened, few.last[below_at] - few.child[below_at], 1)
        node = np.repeat(below_node, width)
        at = np.where(np.repeat(opened, width), _spread(np.where(opened, few.child[below_at], below_at), width), np.repeat(below_at, width))
    for nodes, others in settled:
        by = np.argsort(nodes, kind="stable")
        nodes, others = nodes[by], others[by]
        for k, begin in zip(*np.unique(nodes, return_index=True), strict=True):
            end = begin + np.searchsorted(nodes[begin:], k, side="right")
            spans = [np.arange(few.start[c], few.stop[c]) for c in others[begin:end].tolist()]
            among = np.concatenate(spans)
            among = among[np.argsort(few.order[among])]
            y = few.points[among]
            x = tree.points[tree.start[k] : tree.stop[k]]
            cost += x.shape[0] * y.shape[0]
            out[tree.start[k] : tree.stop[k]] = few.order[among[((y * y).sum(1) - 2.0 * (x @ y.T)).argmin(1)]]
    return out, cost
