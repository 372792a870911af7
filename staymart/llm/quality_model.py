"""Quality classifier: a sparse ensemble of rules, run as Spark column expressions.

Paths of small boosted trees are conjunctions of comparisons over document statistics.
A logistic regression with an L1 penalty keeps the few that matter. What is left is a sum
of weighted conditions, which Spark evaluates in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from staymart.llm.common import held_out
from staymart.llm.statistics import FEATURES, sample_for, with_statistics
from staymart.llm.trees import Trees, boost, sigmoid

#: (feature, True for "greater", threshold)
Condition = tuple[int, bool, float]


@dataclass
class Rules:
    conditions: list[list[Condition]]
    weights: np.ndarray
    bias: float

    def column(self) -> Column:
        """The probability of label 1 as an expression over the columns of ``FEATURES``."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.conditions, self.weights):
            tests = [
                (F.col(FEATURES[f]) > F.lit(t)) if more else (F.col(FEATURES[f]) <= F.lit(t))
                for f, more, t in rule
            ]
            z = z + F.when(reduce(and_, tests), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.bias + truth(self.conditions, x) @ self.weights)


def paths(trees: Trees) -> list[list[Condition]]:
    """Every path from a root to a node below it, each once, shortest first."""
    found: dict[tuple, None] = {}
    for feature, threshold in zip(trees.feature, trees.threshold):
        held: dict[int, tuple | None] = {0: ()}
        for i in range(len(feature)):
            above = held.get(i)
            if above is None or feature[i] < 0:
                continue
            for child, more in ((2 * i + 1, False), (2 * i + 2, True)):
                rule = tuple(sorted({*above, (int(feature[i]), more, float(threshold[i]))}))
                found[rule] = None
                held[child] = rule
    return [list(rule) for rule in sorted(found, key=lambda r: (len(r), r))]


def truth(rules: list[list[Condition]], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, more, t in rule:
            out[:, k] *= x[:, f] > t if more else x[:, f] <= t
    return out


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradient steps."""
    n, k = a.shape
    spread = np.sqrt(np.maximum(a.var(axis=0), 1e-9))
    centre = a.mean(axis=0)
    s = (a - centre) / spread
    top = np.linalg.norm(s.T @ s, 2) if k else 1.0
    step = 4 * n / (top + n)
    w, b = np.zeros(k), 0.0
    v, c, m = w, b, 1.0
    for _ in range(steps):
        p = sigmoid(s @ v + c) - y
        w_next = v - step * (s.T @ p) / n
        w_next = np.sign(w_next) * np.maximum(np.abs(w_next) - step * penalty, 0)
        b_next = c - step * p.mean()
        m_next = (1 + np.sqrt(1 + 4 * m * m)) / 2
        v, c = w_next + (m - 1) / m_next * (w_next - w), b_next + (m - 1) / m_next * (b_next - b)
        w, b, m = w_next, b_next, m_next
    weights = w / spread
    return weights, float(b - weights @ centre)


def fit_rule_ensemble(x: np.ndarray, y: np.ndarray, penalty: float = 0.002) -> Rules:
    """Rules of 30 trees over half of the rows each; those of weight zero are dropped.

    Without rows, or with one label only, the model is a constant.
    """
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Rules([], np.zeros(0), float(np.log(share / (1 - share))))
    rules = paths(boost(x, y, trees=30, depth=2, rate=0.3, draw=0.5, least=20 if len(y) > 2000 else 5))
    weights, bias = lasso(truth(rules, x), y, penalty)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return Rules([rules[k] for k in kept], weights[kept], bias)


def quality_scores(docs: DataFrame, model: Rules, least: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    A null text counts as empty and is scored like any other. Only the text is read; extra
    columns, repeated rows and empty tables change nothing else. A null id is not held out.
    """
    return with_statistics(docs).select(
        "doc_id",
        held_out().alias("held_out"),
        model.column().alias("score"),
        (model.column() >= least).cast("int").alias("predicted"),
    )


def rule_ensemble_for(docs: DataFrame, sf_dir: str) -> Rules:
    return fit_rule_ensemble(*sample_for(docs.sparkSession, docs, sf_dir))
