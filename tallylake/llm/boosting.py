"""Gradient boosting of small trees over a table of distinct feature rows with class weights.

The rows are counts per combination of small integer features, so their number is bounded by
the features' ranges and not by the data; fitting them is plain arithmetic on the driver,
and the fitted trees are SQL expressions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24
RATE = 0.3
SHRINK = 1.0  # weight that each leaf is pulled to zero with


@dataclass(frozen=True)
class Tree:
    """``value`` at a leaf, else rows with ``feature <= cut`` go to ``low``."""

    value: float = 0.0
    feature: str = ""
    cut: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def of(self, row: Mapping[str, int]) -> float:
        if not self.feature:
            return self.value
        return (self.low if row[self.feature] <= self.cut else self.high).of(row)

    def column(self, features: Mapping[str, Column]) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(
            features[self.feature] <= self.cut, self.low.column(features)
        ).otherwise(self.high.column(features))


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def of(self, row: Mapping[str, int]) -> float:
        return _sigmoid(self.start + sum(t.of(row) for t in self.trees))

    def column(self, features: Mapping[str, Column]) -> Column:
        logit = F.lit(self.start)
        for tree in self.trees:
            logit = logit + tree.column(features)
        return 1 / (1 + F.exp(-logit))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _grow(rows: list[tuple[Mapping[str, int], float, float]], names: Sequence[str], depth: int) -> Tree:
    """Tree of second-order boosting over (features, gradient, curvature) rows."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best, best_gain = None, 1e-9
    for name in names if depth else ():
        sums: dict[int, list[float]] = {}
        for features, gi, hi in rows:
            at = sums.setdefault(features[name], [0.0, 0.0])
            at[0] += gi
            at[1] += hi
        left_g = left_h = 0.0
        for value in sorted(sums)[:-1]:
            left_g += sums[value][0]
            left_h += sums[value][1]
            gain = (
                left_g**2 / (left_h + SHRINK)
                + (g - left_g) ** 2 / (h - left_h + SHRINK)
                - g**2 / (h + SHRINK)
            )
            if gain > best_gain:
                best, best_gain = (name, value), gain
    if best is None:
        return Tree(value=RATE * g / (h + SHRINK))
    name, cut = best
    return Tree(
        feature=name,
        cut=cut,
        low=_grow([r for r in rows if r[0][name] <= cut], names, depth - 1),
        high=_grow([r for r in rows if r[0][name] > cut], names, depth - 1),
    )


def fit(table: Sequence[tuple[Mapping[str, int], float, float]], names: Sequence[str], depth: int = 3) -> Boosted:
    """Boosted trees for (features, positive weight, negative weight) rows."""
    positive, negative = sum(r[1] for r in table), sum(r[2] for r in table)
    start = math.log((positive + 1) / (negative + 1))
    logits = [start] * len(table)
    trees = []
    for _ in range(ROUNDS):
        steps = []
        for (features, p, n), logit in zip(table, logits):
            chance = _sigmoid(logit)
            steps.append((features, p - (p + n) * chance, (p + n) * chance * (1 - chance)))
        tree = _grow(steps, names, depth)
        trees.append(tree)
        logits = [logit + tree.of(row[0]) for logit, row in zip(logits, table)]
    return Boosted(start, tuple(trees))
