"""Gaussian mixtures with full covariances, fitted by expectation maximisation over packed blocks.

The log-density of a component is a quadratic form, so all components of all mixtures (every number of components, every start) are one
matrix product with the rows' monomials (1, x, x x'); a log-sum-exp per mixture gives the responsibilities, and a second
product gives the weights, sums and scatters of the next step. Per pass and task one small array leaves the rows.

Rows are centred and scaled along the principal components that carry variance, as collinear features have no full covariance; likelihoods are those of
the principal component scores. Starts come from k-means on one weighted draw over all rows. ``RIDGE`` is added to the variances of the scaled
components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from marketloom.operators.blocks import all_final, cell_sums, finalists, hopeless, monomials, pack, square_gaps, starts, total, weighted_draws

SEED = 42
ROUNDS = 200
TOLERANCE = 1e-3
RIDGE = 1e-6
LEAST_VARIANCE = 1e-8  # share of the total variance below which a component counts as none
STARTS = 10
K_RANGE = tuple(range(2, 11))


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def coefficients(self) -> np.ndarray:
        """Monomial x component: log weight plus log-density as a quadratic form."""
        k, d = self.means.shape
        i, j = np.triu_indices(d)
        out = np.zeros((1 + d + len(i), k))
        for c in range(k):
            factor = np.linalg.cholesky(self.covariances[c])
            half = np.linalg.inv(factor)
            precision = half.T @ half
            pulled = precision @ self.means[c]
            out[0, c] = (
                math.log(max(self.weights[c], 1e-300)) - 0.5 * (d * math.log(2 * math.pi) + self.means[c] @ pulled) - np.log(np.diag(factor)).sum()
            )
            out[1 : 1 + d, c] = pulled
            out[1 + d :, c] = np.where(i == j, -0.5, -1.0) * precision[i, j]
        return out

    @classmethod
    def of(cls, sums: np.ndarray, ridge: float) -> Mixture:
        """From the components' weighted sums of monomials (component x monomial)."""
        k, size = sums.shape
        d = int((math.sqrt(8 * size + 1) - 3) / 2)
        i, j = np.triu_indices(d)
        n = sums[:, 0] + 10 * np.finfo(float).eps
        means = sums[:, 1 : 1 + d] / n[:, None]
        covariances = np.zeros((k, d, d))
        covariances[:, i, j] = covariances[:, j, i] = sums[:, 1 + d :] / n[:, None] - means[:, i] * means[:, j]
        covariances[:, range(d), range(d)] += ridge
        for c in range(k):
            if np.linalg.eigvalsh(covariances[c])[0] <= 0:  # fewer rows than dimensions, or rounding
                values, vectors = np.linalg.eigh(covariances[c])
                covariances[c] = (vectors * np.maximum(values, max(ridge, 1e-12))) @ vectors.T
        return cls(n / n.sum(), means, covariances)


def _spans(sizes: Sequence[int]) -> list[slice]:
    ends = np.cumsum(sizes)
    return [slice(int(e - s), int(e)) for s, e in zip(sizes, ends)]


def step(blocks: DataFrame, width: int, change: np.ndarray, centre: np.ndarray, mixtures: list[Mixture]) -> tuple[list[float], list[np.ndarray]]:
    """(log-likelihood, sums of monomials by component) of each mixture, in one pass over all rows; rows are (x - centre) @ change."""
    weights = np.concatenate([m.coefficients() for m in mixtures], 1)
    spans = _spans([len(m.weights) for m in mixtures])

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        terms = monomials((x - centre) @ change)
        share = terms @ weights
        out = np.zeros((weights.shape[1], terms.shape[1] + 1))
        for s in spans:
            top = share[:, s].max(1)
            share[:, s] = np.exp(share[:, s] - top[:, None])
            whole = share[:, s].sum(1)
            share[:, s] *= (w / whole)[:, None]
            out[s.start, -1] = w @ (top + np.log(whole))
        out[:, :-1] = share.T @ terms
        return out

    found = total(blocks, width, kernel)
    return [float(found[s.start, -1]) for s in spans], [found[s, :-1] for s in spans]


def hard_sums(blocks: DataFrame, width: int, change: np.ndarray, centre: np.ndarray, sets: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of monomials when every row belongs to its nearest centre (given for the rows as they are)."""
    stacked = np.concatenate(sets)
    spans = _spans([len(s) for s in sets])

    def kernel(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        gap, rows = square_gaps(x, stacked), np.arange(len(x))
        share = np.zeros_like(gap)
        for s in spans:
            share[rows, s.start + gap[:, s].argmin(1)] = w
        return share.T @ monomials((x - centre) @ change)

    found = total(blocks, width, kernel)
    return [found[s] for s in spans]


def principal(blocks: DataFrame, width: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, centre, matrix to principal scores of variance 1, deviations of the scores) of all rows."""
    sums = total(blocks, width, lambda x, w: (monomials(x) * w[:, None]).sum(0)[None, :])
    if sums is None:
        return 0.0, np.zeros(width), np.zeros((width, 0)), np.zeros(0)
    centre = sums[0, 1 : 1 + width] / sums[0, 0]
    # The second pass is centred, so large means cost no digits.
    spread = total(blocks, width, lambda x, w: ((x - centre) * w[:, None]).T @ (x - centre)) / max(sums[0, 0] - 1, 1)
    values, vectors = np.linalg.eigh(spread)
    kept = values > LEAST_VARIANCE * max(values.sum(), 1e-300)
    deviation = np.sqrt(values[kept])
    return float(sums[0, 0]), centre, vectors[:, kept] / deviation, deviation


def criteria(log_likelihood: float, k: int, d: int, n: float) -> tuple[float, float]:
    """(BIC, AIC) of a full-covariance mixture."""
    free = k - 1 + k * d + k * d * (d + 1) / 2
    return -2 * log_likelihood + free * math.log(n), -2 * log_likelihood + 2 * free


@dataclass
class Fit:
    mixture: Mixture
    log_likelihood: float
    rounds: int
    converged: bool


@dataclass
class Fits:
    best: dict[int, Fit]
    n: float
    d: int
    centre: np.ndarray
    change: np.ndarray


def _on_cells(cells: np.ndarray, mixture: Mixture) -> tuple[Mixture, float]:
    """(mixture, mean log-likelihood) after the rounds of expectation maximisation in which all rows of a cell share their
    responsibilities, those of the cell's mean log-densities: the likelihood is a lower bound of that of the rows."""
    n, last = cells[:, 0], -math.inf
    for _ in range(ROUNDS):
        share = (cells / n[:, None]) @ mixture.coefficients()
        top = share.max(1)
        share = np.exp(share - top[:, None])
        whole = share.sum(1)
        likelihood = float(n @ (top + np.log(whole)) / n.sum())
        if likelihood - last < TOLERANCE:
            return mixture, likelihood
        last = likelihood
        mixture = Mixture.of((share / whole[:, None]).T @ cells, RIDGE)
    return mixture, last


def _best_on_cells(
    blocks: DataFrame, width: int, change: np.ndarray, centre: np.ndarray, plans: list[tuple[int, int]], n: float
) -> tuple[list[tuple[int, int]], list[Mixture]]:
    """The starts of each k that go on over all rows, after all starts have converged on the sums of all rows by cell."""
    drawn = weighted_draws(blocks, width, SEED)
    sets = starts(blocks, width, plans, SEED, drawn)
    cells = cell_sums(blocks, width, drawn[0], lambda x: monomials((x - centre) @ change))
    d = change.shape[1]
    middle, rows = cells[:, 1 : 1 + d] / cells[:, :1], np.arange(len(cells))
    mixtures, cost = [], []
    for own in sets:
        share = np.zeros((len(cells), len(own)))
        share[rows, square_gaps(middle, (own - centre) @ change).argmin(1)] = 1.0
        mixture, likelihood = _on_cells(cells, Mixture.of(share.T @ cells, RIDGE))
        mixtures.append(mixture)
        cost.append(-likelihood)
    kept = finalists(plans, cost, n)
    return [plans[i] for i in kept], [mixtures[i] for i in kept]


def fit(matrix: DataFrame, columns: Sequence[str], ks: Sequence[int], n_init: int = STARTS) -> Fits:
    """The most likely mixture of ``n_init`` starts for every number of components; all of them share every pass.

    A start ends when its mean log-likelihood rises by less than ``TOLERANCE``, after ``ROUNDS`` rounds, or as hopeless. On tables too large for
    ``n_init`` starts in every pass, all of them converge on sums by cell first and only the best of each k go on.
    """
    width = len(columns)
    blocks = pack(matrix, columns)
    n, centre, change, deviation = principal(blocks, width)
    d = len(deviation)
    if n == 0 or d == 0:
        return Fits({}, n, d, centre, change)
    plans = [(k, start) for k in ks for start in range(n_init)]
    if all_final(plans, n):
        sets = starts(blocks, width, plans, SEED)
        mixtures = [Mixture.of(s, RIDGE) for s in hard_sums(blocks, width, change, centre, sets)]
    else:
        plans, mixtures = _best_on_cells(blocks, width, change, centre, plans, n)
    cost, gain = dict.fromkeys(range(len(plans)), math.inf), {}
    rounds, done = dict.fromkeys(cost, 0), dict.fromkeys(cost, False)
    active = set(cost)
    for turn in range(1, ROUNDS + 1):
        order = sorted(active)
        likelihood, sums = step(blocks, width, change, centre, [mixtures[i] for i in order])
        for i, ll, s in zip(order, likelihood, sums):
            gain[i], cost[i], rounds[i] = cost[i] + ll / n, -ll / n, turn
            if gain[i] < TOLERANCE:
                done[i] = True
                active.discard(i)
            else:
                mixtures[i] = Mixture.of(s, RIDGE)
        if turn >= 3:
            active -= hopeless(plans, cost, gain, active)
        if not active:
            break
    scale = n * float(np.log(deviation).sum())
    best = {}
    for k in ks:
        i = min((i for i, p in enumerate(plans) if p[0] == k), key=lambda i: (cost[i], i))
        best[k] = Fit(mixtures[i], -cost[i] * n - scale, rounds[i], done[i])
    return Fits(best, n, d, centre, change)


def labelled(matrix: DataFrame, columns: Sequence[str], fits: Fits, k: int, label: str = "gmm_cluster") -> DataFrame:
    """The matrix with the most likely component and its probability (``confidence``); both null without a usable row."""
    names, found = list(columns), fits.best.get(k)
    kept = [c for c in matrix.columns if c not in (label, "confidence")]
    coefficients = found.mixture.coefficients() if found else np.zeros((1, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], 1)
            fine = np.isfinite(x).all(1)
            terms = monomials((np.where(fine[:, None], x, 0.0) - fits.centre) @ fits.change)
            share = terms @ coefficients if found else np.zeros((len(x), 1))
            share = np.exp(share - share.max(1, keepdims=True))
            at = share.argmax(1)
            best = share[np.arange(len(x)), at] / share.sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(at.astype(np.int32), mask=~fine), pa.array(best, mask=~fine)],
                names=[*kept, label, "confidence"],
            )

    schema = StructType([matrix.schema[c] for c in kept] + StructType.fromDDL(f"{label} int, confidence double").fields)
    return matrix.mapInArrow(run, schema)


def from_labels(matrix: DataFrame, columns: Sequence[str], label: str, ridge: float = RIDGE) -> DataFrame:
    """The mixture whose components are the groups of ``label``: its likelihood and criteria, columns taken as they are."""
    width = len(columns)
    groups = sorted(r[0] for r in matrix.select(label).where(matrix[label].isNotNull()).distinct().collect())  # as many as components
    blocks = pack(matrix, [*columns, label])
    names = np.array(groups, float)

    def hard(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        share = (x[:, width:] == names[None, :]) * w[:, None]
        return share.T @ monomials(x[:, :width])

    schema = "n_components int, log_likelihood double, bic double, aic double"
    sums = total(blocks, width + 1, hard) if groups else None
    if sums is None:
        return matrix.sparkSession.createDataFrame([], schema)
    mixture = Mixture.of(sums, ridge)
    identity = np.eye(width + 1)[:, :width]
    (likelihood,), _ = step(blocks, width + 1, identity, np.zeros(width + 1), [mixture])
    bic, aic = criteria(likelihood, len(groups), width, sums[:, 0].sum())
    return matrix.sparkSession.createDataFrame([(len(groups), likelihood, bic, aic)], schema)
