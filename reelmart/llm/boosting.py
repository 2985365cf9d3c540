"""Gradient-boosted trees on a small sample, as plain numbers and as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Node:
    """A split (feature < cut goes to ``low``) or, without one, a leaf value."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


@dataclass
class Boosted:
    """A log-odds score: a constant plus the leaves of all trees."""

    start: float = 0.0
    trees: list[Node] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((leaves(t, x) for t in self.trees), np.zeros(len(x)))

    def expression(self, feature: Callable[[int], Column]) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + branch(tree, feature)
        return total


def leaves(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] < node.cut, leaves(node.low, x), leaves(node.high, x))


def branch(node: Node, feature: Callable[[int], Column]) -> Column:
    if node.feature < 0:
        return F.lit(node.value)
    return F.when(feature(node.feature) < F.lit(node.cut), branch(node.low, feature)).otherwise(branch(node.high, feature))


def grown(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, least: int = 5, ridge: float = 1.0) -> Node:
    """A tree of second-order gain; equal gains go to the earlier feature and the smaller cut."""
    leaf = Node(value=float(slope.sum() / (curve.sum() + ridge)))
    if depth == 0 or len(x) < 2 * least:
        return leaf
    base, best = slope.sum() ** 2 / (curve.sum() + ridge), (1e-6, -1, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value, g, h = x[order, f], np.cumsum(slope[order]), np.cumsum(curve[order])
        at = np.flatnonzero(value[1:] > value[:-1])
        at = at[(at + 1 >= least) & (len(x) - at - 1 >= least)]
        if len(at):
            gain = g[at] ** 2 / (h[at] + ridge) + (g[-1] - g[at]) ** 2 / (h[-1] - h[at] + ridge) - base
            top = int(gain.argmax())
            if gain[top] > best[0] + 1e-9:
                best = (float(gain[top]), f, float((value[at[top]] + value[at[top] + 1]) / 2))
    if best[1] < 0:
        return leaf
    low = x[:, best[1]] < best[2]
    children = [grown(x[m], slope[m], curve[m], depth - 1, least, ridge) for m in (low, ~low)]
    return Node(feature=best[1], cut=best[2], low=children[0], high=children[1])


def fit(x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 3, rate: float = 0.3) -> Boosted:
    """Logistic boosting; with one label only, a constant."""
    rate_of = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    model = Boosted(start=float(np.log(rate_of / (1 - rate_of))))
    if len(set(y.tolist())) < 2:
        return model
    score = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grown(x, y - p, p * (1 - p), depth)
        scale(tree, rate)
        model.trees.append(tree)
        score += leaves(tree, x)
    return model


def scale(node: Node, rate: float) -> None:
    node.value *= rate
    if node.feature >= 0:
        scale(node.low, rate)
        scale(node.high, rate)


def calibrated(score: np.ndarray, y: np.ndarray, precision: float = 0.95) -> float:
    """The lowest score from which on at least ``precision`` of the rows are positive.

    Even log-odds (0.0) without positives to learn from, and never below it.
    """
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last_of_score = np.append(score[order][1:] < score[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((hits >= precision) & last_of_score)
    return max(0.0, float(score[order][good[-1]])) if len(good) else 0.0
