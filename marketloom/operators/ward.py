"""Ward clustering through mergeable clustering features (number, squared norm, sum of the rows they hold).

Each task reads its rows in parts. A row joins the feature for which Ward's criterion rises least, if it rises by no more than the largest rise accepted so
far (0 at first, so only equal rows are joined); other rows become features of their own. Whenever there are more than twice ``leaves``
features, Ward's own merging (its lowest merges, in rounds) brings them back to ``leaves``, and the largest rise of these merges is accepted from then on. Features of
tasks are united and merged in the same way, ``FAN_IN`` at a time in tasks of their own, up to one table of at most ``leaves`` features. With no more different rows than that, they are the rows
themselves and the clustering is plain Ward.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from marketloom.operators.blocks import distinct, gather, square_gaps

PART = 1024
NEAREST_ROWS = 256
BOX_ROWS = 64
FAN_IN = 8  # tables of features that one task merges in a row


def chain_merges(size: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All merges (pairs of current groups, named by their lowest member) of Ward's method, and the rise of each, by
    nearest-neighbour chains."""
    size, centre = size.astype(float).copy(), centre.astype(float).copy()
    live = np.arange(len(size))
    pairs, rises, chain = [], [], []

    def rise(i: int) -> np.ndarray:
        gap = centre[live] - centre[i]
        out = size[i] * size[live] / (size[i] + size[live]) * np.einsum("ij,ij->i", gap, gap)
        out[live == i] = np.inf
        return out

    while len(live) > 1:
        if not chain:
            chain.append(int(live[0]))
        costs = rise(chain[-1])
        best = costs.min()
        at = int(live[costs.argmin()])
        if len(chain) > 1 and costs[live == chain[-2]][0] <= best:
            at = chain[-2]
        if len(chain) > 1 and at == chain[-2]:
            b, a = sorted((chain.pop(), chain.pop()), reverse=True)
            pairs.append((a, b))
            rises.append(float(best))
            whole = size[a] + size[b]
            centre[a] = (size[a] * centre[a] + size[b] * centre[b]) / whole
            size[a] = whole
            live = live[live != b]
        else:
            chain.append(at)
    return np.array(pairs, np.int64).reshape(-1, 2), np.array(rises)


def cut(n: int, pairs: np.ndarray, rises: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """(group of each of n items when the lowest merges have left k groups, numbered by first member; the largest rise used)."""
    parent = np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.argsort(rises, kind="stable")[: max(n - k, 0)]
    for a, b in pairs[order]:
        a, b = root(int(a)), root(int(b))
        parent[max(a, b)] = min(a, b)
    return np.unique([root(i) for i in range(n)], return_inverse=True)[1], float(rises[order].max()) if len(order) else 0.0


def groups(size: np.ndarray, centre: np.ndarray, k: int) -> np.ndarray:
    """Ward's k groups of weighted points, numbered by their first point."""
    return cut(len(size), *chain_merges(size, centre), k)[0]


def lowest_merges(size: np.ndarray, centre: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges (pairs of current groups, named by their lowest member, and the rise of each) that hold the ``count`` lowest of Ward's method.

    Pairs of groups that are nearest to each other merge in rounds. A merge never rises less than those inside it, and a new group is
    nearer to no other than its parts were, so only groups that lost their nearest one look for it again, and a pair that rises more
    than ``count`` known merges need not merge.
    """
    size, centre = size.astype(float).copy(), centre.astype(float).copy()
    n = len(size)
    live, near, least = np.arange(n), np.zeros(n, np.int64), np.full(n, np.inf)
    asked, pairs, rises, done = live, [], [], 0
    while len(live) > 1:
        norm = (centre[live] ** 2).sum(1)
        for at in range(0, len(asked), NEAREST_ROWS):
            some = asked[at : at + NEAREST_ROWS]
            gap = np.maximum(square_gaps(centre[some], centre[live]) + (centre[some] ** 2).sum(1)[:, None], 0.0)
            gap *= size[live] / (size[some][:, None] + size[live])
            gap[np.arange(len(some)), np.searchsorted(live, some)] = np.inf
            near[some] = live[gap.argmin(1)]
        other = near[asked]
        least[asked] = size[asked] * size[other] / (size[asked] + size[other]) * ((centre[asked] - centre[other]) ** 2).sum(1)
        limit = np.partition(np.concatenate(rises), count - 1)[count - 1] if done >= count else np.inf
        a = live[(near[near[live]] == live) & (live < near[live]) & (least[live] <= limit)]
        if not len(a):  # equal rises may send groups round in a ring, which the lowest pair breaks
            a = live[least[live].argmin()][None]
            if least[a[0]] > limit:
                break
        b = near[a]
        rises.append(least[a])
        a, b = np.minimum(a, b), np.maximum(a, b)
        pairs.append(np.stack([a, b], 1))
        done += len(a)
        whole = size[a] + size[b]
        centre[a] = (size[a][:, None] * centre[a] + size[b][:, None] * centre[b]) / whole[:, None]
        size[a] = whole
        gone = np.zeros(n, bool)
        gone[b] = True
        changed = gone.copy()
        changed[a] = True
        live = live[~gone[live]]
        asked = live[changed[live] | changed[near[live]]]
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64), np.concatenate(rises) if rises else np.zeros(0)


def condensed(state: np.ndarray, leaves: int) -> tuple[np.ndarray, float]:
    """At most ``leaves`` features (rows of number, squared norm, sums), and the largest rise of the merges."""
    if len(state) <= leaves:
        return state, 0.0
    group, height = cut(len(state), *lowest_merges(state[:, 0], state[:, 2:] / state[:, :1], len(state) - leaves), leaves)
    out = np.zeros((leaves, state.shape[1]))
    np.add.at(out, group, state)
    return out, height


def _united(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.concatenate([w[:, None], (w * (x**2).sum(1))[:, None], x * w[:, None]], 1)


def joined(rows: np.ndarray, counts: np.ndarray, held: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(the feature for which Ward's criterion rises least, whether that is more than ``limit``) of each row. Rows come in order, so
    neighbours are alike: only features that some point of their box could join within the limit are looked at."""
    best, new = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
    size, centre, norm = held[:, 0], held[:, 2:] / held[:, :1], (rows**2).sum(1)
    square = (centre**2).sum(1)
    for at in range(0, len(rows), BOX_ROWS):
        part = slice(at, at + BOX_ROWS)
        x, n, most = rows[part], counts[part], limit + 1e-12 * counts[part] * norm[part]
        away = np.maximum(np.maximum(x.min(0) - centre, centre - x.max(0)), 0.0)
        near = np.flatnonzero(size / (size + 1) * (away**2).sum(1) <= most.max())
        if not len(near):
            continue
        cost = square[near] - 2 * x @ centre[near].T
        cost += norm[part][:, None]
        np.maximum(cost, 0.0, out=cost)
        cost *= size[near] / (size[near] + 1) if (n == 1).all() else n[:, None] * size[near] / (n[:, None] + size[near])
        place = cost.argmin(1)
        best[part], new[part] = near[place], cost[np.arange(len(x)), place] > most
    return best, new


def features(blocks: DataFrame, width: int, leaves: int) -> np.ndarray:
    """Features (number, squared norm, sums) of all rows."""

    def step(state, x, w, _):
        # The first row of a task's state holds the rise that is accepted.
        held, limit = (np.zeros((0, 2 + width)), 0.0) if state is None else (state[1:], state[0, 0])
        for at in range(0, len(x), PART):
            rows, counts = distinct(x[at : at + PART], w[at : at + PART])
            new = np.ones(len(rows), bool)
            if len(held):
                best, new = joined(rows, counts, held, limit)
                np.add.at(held, best[~new], _united(rows[~new], counts[~new]))
            held = np.concatenate([held, _united(rows[new], counts[new])])
            if len(held) > 2 * leaves:
                held, height = condensed(held, leaves)
                limit = max(limit, height)
        first = np.zeros((1, 2 + width))
        first[0, 0] = limit
        return np.concatenate([first, held])

    def same(held: np.ndarray) -> np.ndarray:
        """Features of equal rows united, so that few different rows stay themselves."""
        centre, place = np.unique(held[:, 2:] / held[:, :1], axis=0, return_inverse=True)
        out = np.zeros((len(centre), held.shape[1]))
        np.add.at(out, place.reshape(-1), held)
        return out

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return condensed(same(np.concatenate([a, b])), leaves)[0]

    found = gather(blocks, width, step, merge, finish=lambda state: condensed(same(state[1:]), leaves)[0], fan_in=FAN_IN)
    return np.zeros((0, 2 + width)) if found is None else found
