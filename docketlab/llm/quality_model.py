"""Quality classifier as a sparse rule ensemble.

Small boosted trees over text statistics are grown on a bounded sample of labelled documents; every path from a root is
a rule, a conjunction of comparisons. Lasso logistic regression keeps few of the rules, and these are compiled into one
Spark column expression over statistics that are column expressions too: scoring runs inside the engine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize
from .labelled import fold, label_sample

#: Labelled documents of each class that are learnt from at most.
PER_CLASS = 8_000
HELD_OUT_OF = 3


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text that is not null, none of which depends on who wrote it or on its id."""
    n = F.length(text)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    split = F.split(text, " ", -1)
    per = lambda a, b: a / F.greatest(b, F.lit(1))
    words = F.size(split)
    return {
        "log_chars": F.log1p(n.cast("double")),
        "chars_per_word": per(n, words),
        "symbols": per(count(r"[#*$%&|<>]"), words),
        "marks": per(count("!"), words),
        "stops": per(count(r"[.?;:]"), words),
        "commas": per(count(","), words),
        "capital_runs": per(count(r"[A-Z]{2,}"), words),
        "digits": per(count(r"[0-9]"), n),
        "same_again": per(count(r" (\S++)(?= \1(?: |$))"), words),
        "distinct": per(F.size(F.array_distinct(split)), words),
        "lines": per(count("\n"), words),
    }


#: A rule: comparisons (statistic number, threshold, True if greater).
Rule = tuple[tuple[int, float, bool], ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, cut, above in rule:
        out &= (x[:, k] > cut) == above
    return out


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], depth: int, rows: np.ndarray, path: Rule, least: int) -> tuple[list[Rule], list[tuple[Rule, float]]]:
    """One tree on gradients: the rules of all its nodes, and its leaves with their values."""
    value = grad[rows].sum() / (hess[rows].sum() + 1.0)
    best = (1e-6, None)
    if depth and len(rows) >= 2 * least:
        g, h = grad[rows], hess[rows]
        for k, c in enumerate(cuts):
            if not len(c):
                continue
            at = np.searchsorted(c, x[rows, k], side="left")  # values above cut j have at > j
            gs, hs, ns = (np.bincount(at, v, len(c) + 1).cumsum()[:-1] for v in (g, h, np.ones(len(rows))))
            gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (gain[j], (k, float(c[j])))
    if best[1] is None:
        return [], [(path, value)]
    k, cut = best[1]
    rules, leaves = [], []
    for above in (False, True):
        step = (*path, (k, cut, above))
        rules.append(step)
        more, ends = grow(x, grad, hess, cuts, depth - 1, rows[(x[rows, k] > cut) == above], step, least)
        rules += more
        leaves += ends
    return rules, leaves


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, seed: int = 0) -> list[Rule]:
    """Distinct rules of boosted trees, each grown on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(col, np.linspace(0.01, 0.99, 48))) for col in x.T] if len(x) else []
    margin, rules, least = np.zeros(len(y)), {}, max(3, len(y) // 200)
    for _ in range(trees if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        found, leaves = grow(x, y - p, p * (1 - p), cuts, depth, rows, (), least)
        rules |= dict.fromkeys(found)
        for path, value in leaves:
            margin[_holds(path, x)] += rate * np.clip(value, -4, 4)
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, strength: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an L1 penalty (not on the intercept), by accelerated proximal gradient."""
    n, m = z.shape
    centre = z.mean(axis=0) if n else np.zeros(m)
    a = np.hstack([z - centre, np.ones((n, 1))])
    step = 4.0 * n / max(1e-9, _top(a)) if n else 1.0
    w = v = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - step * (a.T @ (p - y)) / max(1, n)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * strength, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        moved = np.abs(new - w).max(initial=0)
        w, t = new, t_new
        if moved < 1e-7:
            break
    return float(w[-1] - centre @ w[:-1]), w[:-1]


def _top(a: np.ndarray) -> float:
    """Largest eigenvalue of a'a, by power iteration, rounded up a little."""
    v = np.ones(a.shape[1])
    for _ in range(30):
        u = a.T @ (a @ v)
        size = np.linalg.norm(u)
        if not size:
            return 0.0
        v = u / size
    return 1.05 * float(size)


@dataclass
class RuleModel:
    names: list[str]
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score, from 0 to 1, over columns named as the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            both = F.lit(True)
            for k, cut, above in rule:
                both = both & ((F.col(self.names[k]) > cut) if above else (F.col(self.names[k]) <= cut))
            total = total + F.when(both, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * _holds(rule, x)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, names: list[str], strength: float = 2e-4) -> RuleModel:
    rules = extract_rules(x, y)
    z = np.stack([_holds(r, x) for r in rules], axis=1).astype(float) if rules else np.zeros((len(x), 0))
    if z.shape[1]:
        _, first = np.unique(z, axis=1, return_index=True)  # rules that hold for the same documents count once
        rules, z = [rules[i] for i in sorted(first)], z[:, sorted(first)]
    intercept, weights = lasso(z, y, strength)
    return RuleModel(names, intercept, [(r, float(w)) for r, w in zip(rules, weights) if w])


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return base.select("doc_id", *(c.cast("double").alias(k) for k, c in statistics(F.col("body")).items()))


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", allowed=None, per_class: int = PER_CLASS) -> RuleModel:
    """Learn from the statistics of at most ``per_class`` labelled documents of each class (the sample's bound)."""
    sample, _ = label_sample(labels, column, F.lit(True) if allowed is None else allowed, per_class)
    sample = materialize(sample, "sample")  # at most 2 * per_class pairs of numbers
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id").cast("long") == F.col("id"), "left_semi")
    rows = with_statistics(chosen).join(F.broadcast(sample), F.col("doc_id") == F.col("id")).drop("id").toPandas()
    names = [c for c in rows.columns if c not in ("doc_id", "label")]
    rows = rows.sort_values(["doc_id", *names])
    return fit(rows[names].to_numpy(float), rows["label"].to_numpy(float), names)


def assess(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``; 1 is good.

    Labelled rows are learnt from only if their id is not held out (crc32 modulo three is not one). Null texts count as
    empty; all-zero statistics get a score as any. Without labels all scores are even. Repeated rows are scored each;
    an empty table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, allowed=fold(HELD_OUT_OF) != 1, per_class=per_class)
    return with_statistics(docs).select("doc_id", model.column().alias("score"))
