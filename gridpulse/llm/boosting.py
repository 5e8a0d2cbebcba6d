"""Gradient boosted trees over small counted tables of discrete features, as column expressions.

The counts of feature patterns are what is learned from, so they can cover any number of
rows; the trees become CASE expressions that Spark evaluates like any other column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS, DEPTH, RATE, PENALTY = 16, 3, 0.5, 1.0
LEAST_GAIN = 1e-4


@dataclass(frozen=True)
class Cell:
    """A pattern of feature values, and how many rows with it are positive and negative."""

    values: tuple[int, ...]
    positive: int
    negative: int


@dataclass(frozen=True)
class Tree:
    """`yes` where the feature has the value, `no` elsewhere; a leaf has an amount only."""

    amount: float = 0.0
    feature: int | None = None
    value: int = 0
    yes: Tree | None = None
    no: Tree | None = None

    def score(self, values: Sequence[int]) -> float:
        at = self
        while at.feature is not None:
            at = at.yes if values[at.feature] == at.value else at.no
        return at.amount

    def column(self, features: Sequence[Column]) -> Column:
        if self.feature is None:
            return F.lit(self.amount)
        return F.when(features[self.feature] == self.value, self.yes.column(features)).otherwise(self.no.column(features))


@dataclass(frozen=True)
class Model:
    start: float
    trees: tuple[Tree, ...]

    def score(self, values: Sequence[int]) -> float:
        # Added up one by one, as the column expression does, so both give the same number.
        return reduce(add, (tree.score(values) for tree in self.trees), self.start)

    def column(self, features: Sequence[Column]) -> Column:
        return reduce(add, (tree.column(features) for tree in self.trees), F.lit(self.start))


def _grown(rows: list[tuple[tuple[int, ...], float, float]], depth: int) -> Tree:
    """The tree of the best splits of rows (values, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Tree(RATE * g / (h + PENALTY))
    if not depth or len(rows) < 2:
        return leaf
    sums: dict[tuple[int, int], list[float]] = {}
    for values, dg, dh in rows:
        for split in enumerate(values):
            at = sums.setdefault(split, [0.0, 0.0])
            at[0] += dg
            at[1] += dh

    def gain(split: tuple[int, int]) -> float:
        a, b = sums[split]
        return a * a / (b + PENALTY) + (g - a) ** 2 / (h - b + PENALTY) - g * g / (h + PENALTY)

    best = max(sorted(sums), key=gain)
    if gain(best) < LEAST_GAIN:
        return leaf
    yes = [r for r in rows if r[0][best[0]] == best[1]]
    no = [r for r in rows if r[0][best[0]] != best[1]]
    return Tree(0.0, best[0], best[1], _grown(yes, depth - 1), _grown(no, depth - 1)) if no else leaf


def learned(cells: list[Cell]) -> Model:
    """Boosted trees for the log odds of the positive rows, by Newton steps on the logistic loss."""
    positive, negative = sum(c.positive for c in cells), sum(c.negative for c in cells)
    start = math.log((positive + 1) / (negative + 1))
    scores, trees = [start] * len(cells), []
    for _ in range(ROUNDS):
        rows = []
        for cell, score in zip(cells, scores):
            p, many = 1 / (1 + math.exp(-score)), cell.positive + cell.negative
            rows.append((cell.values, cell.positive - many * p, many * p * (1 - p)))
        tree = _grown(rows, DEPTH)
        trees.append(tree)
        scores = [s + tree.score(c.values) for s, c in zip(scores, cells)]
    return Model(start, tuple(trees))


def threshold(model: Model, cells: list[Cell], sure: float, least: int) -> float:
    """The least score whose calibrated share of positives is `sure`; infinite without `least` positives from there.

    Calibration is isotonic: over cells in order of score, neighbours that fall are pooled.
    """
    pools: list[list[float]] = []  # least score, positives, all
    for score, positive, many in sorted((model.score(c.values), c.positive, c.positive + c.negative) for c in cells):
        if pools and pools[-1][0] == score:
            pools[-1][1] += positive
            pools[-1][2] += many
        else:
            pools.append([score, positive, many])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, positive_above, many_above = pools.pop()
            pools[-1][1] += positive_above
            pools[-1][2] += many_above
    chosen = [p for p in pools if p[1] >= sure * p[2]]
    return chosen[0][0] if sum(p[1] for p in chosen) >= least else math.inf
