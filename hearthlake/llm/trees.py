"""Decision trees over binned features: fitted on counts, applied as column expressions.

Features are small integers, so all training rows with equal features are one row of counts.
That table, not the rows, is what a fit needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most distinct feature rows that a fit takes, the most frequent ones first.
FIT_ROWS = 50_000


@dataclass
class Node:
    """A leaf (``feature`` None) or a test ``feature <= limit``."""

    value: float
    feature: str | None = None
    limit: int = 0
    low: Node | None = None
    high: Node | None = None

    def column(self) -> Column:
        if self.feature is None:
            return F.lit(float(self.value))
        return F.when(F.col(self.feature) <= self.limit, self.low.column()).otherwise(self.high.column())

    def values(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        if self.feature is None:
            return np.full(n, self.value)
        return np.where(x[self.feature] <= self.limit, self.low.values(x, n), self.high.values(x, n))


def grow(x: dict[str, np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: float, pick=None, ridge: float = 1.0) -> Node:
    """The tree that minimises sum(h * (value - g / h)^2), leaf values g / (h + ridge), at least ``least`` h in a leaf."""
    total_g, total_h = g.sum(), h.sum()
    node = Node(total_g / (total_h + ridge))
    if depth == 0 or total_h < 2 * least:
        return node
    best = 1e-9
    for name in pick() if pick else x:
        bins = x[name]
        sums_g, sums_h = np.cumsum(np.bincount(bins, g)), np.cumsum(np.bincount(bins, h))
        low_g, low_h = sums_g[:-1], sums_h[:-1]
        high_g, high_h = total_g - low_g, total_h - low_h
        gain = low_g**2 / (low_h + ridge) + high_g**2 / (high_h + ridge) - total_g**2 / (total_h + ridge)
        gain = np.where((low_h >= least) & (high_h >= least), gain, 0)
        if len(gain) and gain.max() > best * (1 + 1e-9):  # equal gains: the first feature
            best, node.feature, node.limit = gain.max(), name, int(gain.argmax())
    if node.feature is None:
        return node
    low = x[node.feature] <= node.limit
    part = lambda m: ({k: v[m] for k, v in x.items()}, g[m], h[m])
    node.low, node.high = grow(*part(low), depth - 1, least, pick, ridge), grow(*part(~low), depth - 1, least, pick, ridge)
    return node


def feature_counts(labelled: DataFrame, features: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(features, ones, zeros, fold) of the distinct feature rows of ``labelled`` (features, label 0/1, fold)."""
    counted = labelled.groupBy(*features, "fold").agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
    order = [(F.col("ones") + F.col("zeros")).desc(), *features, "fold"]
    rows = counted.orderBy(*order).limit(FIT_ROWS).collect()
    column = lambda name: np.array([r[name] for r in rows], np.int64)
    return {f: column(f) for f in features}, column("ones").astype(float), column("zeros").astype(float), column("fold")


def boosted(x, ones, zeros, rounds: int = 24, depth: int = 3, rate: float = 0.3) -> list[Node]:
    """Gradient boosting of the logistic loss by Newton steps; the trees' sum is the logit."""
    n = ones + zeros
    logit, trees = np.zeros(len(n)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-logit))
        tree = grow(x, rate * (ones - n * p), n * p * (1 - p), depth, least=0.5)
        trees.append(tree)
        logit = logit + tree.values(x, len(n))
    return trees


def forest(x, ones, zeros, seed: int, trees: int = 24, depth: int = 6) -> list[Node]:
    """A random forest: Poisson-weighted rows and a third of the features at each split; the mean is a share."""
    rng, names = np.random.default_rng(seed), sorted(x)
    most = max(2, len(names) // 3)
    pick = lambda: rng.choice(names, most, replace=False)
    out = []
    for _ in range(trees):
        own_ones, own_zeros = rng.poisson(ones), rng.poisson(zeros)
        some = own_ones + own_zeros > 0
        part = {k: v[some] for k, v in x.items()}
        out.append(grow(part, own_ones[some].astype(float), (own_ones + own_zeros)[some].astype(float), depth, least=2, pick=pick, ridge=0.1))
    return out


def total(trees: list[Node]) -> Column:
    return sum((t.column() for t in trees), F.lit(0.0))


def threshold(score: np.ndarray, ones: np.ndarray, zeros: np.ndarray, precision: float) -> float | None:
    """The lowest score from which on the share of ones is at least ``precision``; None if there is none."""
    order = np.argsort(-score, kind="stable")
    up_to, hits = np.cumsum((ones + zeros)[order]), np.cumsum(ones[order])
    last = np.append(np.diff(score[order]) != 0, True)  # equal scores are taken together
    good = last & (hits >= precision * up_to) & (hits > 0)
    return float(score[order][np.flatnonzero(good)[-1]]) if good.any() else None
