"""Quality classifier: a sparse ensemble of rules over document statistics.

Shallow boosted trees are grown on a bounded sample of labelled documents; every
path from a root to a node is a conjunction of bounds on statistics, a rule.  A
lasso logistic regression over all rules keeps the few that matter, and these
become one Spark expression: the score of a document is the logistic of an
intercept plus the weights of the rules that hold.

The sample has ``PER_CLASS`` documents of each class at most (fewer labelled rows
are all used) and its classes are weighed back to their shares.  Statistics come
from whole texts; scoring is a projection of a written table of numbers.

Defined results: null and empty texts have no words, all their shares are 0, and
are scored by the rules like any other; documents that repeat a doc_id are scored
each, and count once in training; without labels every score is 0.5, with one
class only it is that class; only doc_id and text of documents are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import staged
from voltframe.llm.labelled import crc_remainder, sampled_labels
from voltframe.llm.quality_rules import statistics

PER_CLASS = 10_000
TREES = 40
DEPTH = 3
BINS = 32
SHRINKAGE = 0.2
LEAST_ROWS = 10
LASSO = 2e-4
LASSO_ROUNDS = 400
GOOD_AT = 0.7


def features() -> dict[str, Column]:
    """Shares and sizes by statistic, null-free."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars, lines = F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    columns = {
        "words": F.col("n_words"), "word_length": F.col("word_chars") / n, "symbols": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines") / lines, "repeats": F.col("n_repeat_words") / n,
        "common": F.col("n_common") / n, "letters": F.col("n_letters") / chars,
        "distinct": F.col("n_distinct") / n, "line_words": F.col("n_words") / lines,
    }
    return {k: c.cast("double") for k, c in columns.items()}


#: feature -> (more than, at most)
Rule = tuple[tuple[str, float, float], ...]


@dataclass
class Ensemble:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The score as an expression over the feature columns."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(_holds(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _holds(rule: Rule) -> Column:
    held = F.lit(True)
    for name, low, high in rule:
        if low > -math.inf:
            held = held & (F.col(name) > low)
        if high < math.inf:
            held = held & (F.col(name) <= high)
    return held


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _grow(binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, path: list,
          paths: list, step: np.ndarray, depth: int) -> None:
    """Splits ``rows`` by the best gain; every node's path goes to ``paths``, leaf steps to ``step``."""
    g, h = grad[rows], hess[rows]
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * LEAST_ROWS:
        whole = g.sum() ** 2 / (h.sum() + 1)
        for f in range(binned.shape[1]):
            b = binned[rows, f]
            gs, hs = np.cumsum(np.bincount(b, g, BINS)), np.cumsum(np.bincount(b, h, BINS))
            ns = np.cumsum(np.bincount(b, minlength=BINS))
            gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
            gain[(ns < LEAST_ROWS) | (ns[-1] - ns < LEAST_ROWS)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
    if best[1] < 0:
        step[rows] = -SHRINKAGE * g.sum() / (h.sum() + 1)
        return
    _, f, k = best
    left = binned[rows, f] <= k
    for side, own in ((0, rows[left]), (1, rows[~left])):
        below = [*path, (f, k, side)]
        paths.append(below)
        _grow(binned, grad, hess, own, below, paths, step, depth - 1)


def _as_rule(path: list, names: list[str], cuts: list[np.ndarray]) -> Rule:
    bounds: dict[str, list[float]] = {}
    for f, k, side in path:
        b = bounds.setdefault(names[f], [-math.inf, math.inf])
        cut = float(cuts[f][k])
        b[0], b[1] = (max(b[0], cut), b[1]) if side else (b[0], min(b[1], cut))
    return tuple((n, *bounds[n]) for n in sorted(bounds))


def fit(values: np.ndarray, names: list[str], y: np.ndarray, importance: np.ndarray) -> Ensemble:
    if not len(y):
        return Ensemble(0.0, [])
    importance = importance / importance.mean()
    share = float((y * importance).sum() / importance.sum())
    start = math.log(min(1 - 1e-6, max(1e-6, share)) / (1 - min(1 - 1e-6, max(1e-6, share))))
    if share in (0.0, 1.0):
        return Ensemble(start, [])
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(values.shape[1])]
    binned = np.stack([np.searchsorted(c, values[:, f], side="left") for f, c in enumerate(cuts)], 1)
    z, paths = np.full(len(y), start), []
    for _ in range(TREES):
        p, step = _logistic(z), np.zeros(len(y))
        _grow(binned, importance * (p - y), importance * p * (1 - p), np.arange(len(y)), [], paths, step, DEPTH)
        z += step
    rules = sorted({_as_rule(p, names, cuts) for p in paths})
    if not rules:
        return Ensemble(start, [])
    place = {n: k for k, n in enumerate(names)}
    held = np.ones((len(y), len(rules)), np.float32)
    for r, rule in enumerate(rules):
        for n, low, high in rule:
            held[:, r] *= (values[:, place[n]] > low) & (values[:, place[n]] <= high)
    spread = np.maximum(held.std(0), 1e-2)
    weights, intercept = _lasso(held / spread, y, importance, start)
    return Ensemble(intercept, [(rule, float(w / s)) for rule, w, s in zip(rules, weights, spread) if abs(w) > 1e-9])


def _lasso(x: np.ndarray, y: np.ndarray, importance: np.ndarray, start: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on the mean weighted log loss plus ``LASSO`` times the weights' sizes."""
    n = len(y)
    v = np.random.default_rng(3).normal(size=x.shape[1]).astype(np.float32)
    for _ in range(20):  # the largest eigenvalue bounds the curvature
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    rate = 1 / (0.25 * importance.max() * (np.linalg.norm(x @ v) ** 2 / n + 1) + 1e-12)
    w = u = np.zeros(x.shape[1], np.float32)
    b = c = start
    t = 1.0
    for _ in range(LASSO_ROUNDS):
        g = importance * (_logistic(x @ u + c) - y) / n
        moved = u - rate * (x.T @ g.astype(np.float32))
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - rate * LASSO, 0)
        new_b = c - rate * g.sum()
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        u, c = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w.astype(float), float(b)


def train(measured: DataFrame, labels: DataFrame, held_out: Column, per_class: int = PER_CLASS) -> Ensemble:
    """Fits to the labels that are not held out; ``measured`` has doc_id and the features."""
    names = list(features())
    sample, stands_for = sampled_labels(labels, "quality", held_out, per_class)
    # At most 2 * per_class rows of two numbers are sent out, and as many of a few numbers come back.
    rows = (measured.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label")
            .agg(F.min(F.struct(*names)).alias("f")).select("doc_id", "label", "f.*")).toPandas()
    rows = rows.sort_values("doc_id")
    y = rows["label"].to_numpy(float)
    return fit(rows[names].to_numpy(float).reshape(-1, len(names)), names, y,
               np.array(stands_for)[y.astype(int)])


def held_out_fold(column: str = "doc_id") -> Column:
    return crc_remainder(F.col(column), 4) == 2


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    wanted = features()
    # Written once: texts are read a single time for training and scoring.
    measured = staged(statistics(docs).select("doc_id", *[c.alias(k) for k, c in wanted.items()]), "rule-features")
    ensemble = train(measured, labels, held_out_fold())
    scored = measured.select("doc_id", held_out_fold().alias("held_out"), ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_AT).cast("int"))
