"""Quality classifier: a sparse rule ensemble.

Small boosted trees are grown over text statistics on a bounded sample of labelled documents; every path of a tree is a rule, a
conjunction of comparisons. A lasso logistic regression weighs the rules and leaves few. These are compiled into one Spark
column expression, which scores every document inside the JVM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keeps_columns, text_of

#: How many labelled documents the fit may see: those with the least hash of their id.
MAX_LABELLED = 20_000
TREES, DEPTH, BINS, RATE, LEAF = 24, 3, 48, 0.3, 10
LASSO, STEPS = 1e-3, 400


def _count(char: str) -> Column:
    return F.length("_t") - F.length(F.replace(F.col("_t"), F.lit(char)))


def _matched(pattern: str) -> Column:
    return F.length("_t") - F.length(F.regexp_replace("_t", pattern, ""))


def _per(a: Column, b: Column) -> Column:
    return (a / F.greatest(b, F.lit(1))).cast("double")


#: Statistics of a text, by name; each is 0 for an empty text.
STATISTICS = {
    "words": lambda: F.size("_w").cast("double"),
    "word_length": lambda: _per(F.length("_t"), F.size("_w")),
    "symbols": lambda: _per(_matched("[#*$%&~^=<>\\\\{}]+"), F.length("_t")),
    "pipes": lambda: _per(_count("|"), F.size("_w")),
    "exclaims": lambda: _per(_count("!"), F.size("_w")),
    "capitals": lambda: _per(_matched("\\p{Lu}+"), F.length("_t")),
    "digits": lambda: _per(_matched("[0-9]+"), F.length("_t")),
    "stops": lambda: _per(_count("."), F.size("_w")),
    "commas": lambda: _per(_count(","), F.size("_w")),
    "distinct_words": lambda: _per(F.size(F.array_distinct("_w")), F.size("_w")),
    "echoes": lambda: _per(F.size(F.filter("_w", lambda w, i: w == F.get("_w", i - 1))), F.size("_w")),
    "line_words": lambda: _per(F.size("_w"), F.size("_l")),
    "distinct_lines": lambda: _per(F.size(F.array_distinct("_l")), F.size("_l")),
    "longest_word": lambda: F.coalesce(F.array_max(F.transform("_w", F.length)), F.lit(0)).cast("double"),
}
NAMES = list(STATISTICS)


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with _stats, a struct of STATISTICS, computed from the text alone."""
    rows = docs.withColumn("_t", text_of(text_col))
    rows = rows.withColumn("_w", F.filter(F.split("_t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).withColumn("_l", F.split("_t", "\n"))
    return rows.withColumn("_stats", F.struct(*[f().alias(k) for k, f in STATISTICS.items()])).drop("_t", "_w", "_l")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, whether at most, bound) with its weight."""

    tests: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for name, most, bound in self.tests:
            out = out & ((F.col(f"_stats.{name}") <= bound) if most else (F.col(f"_stats.{name}") > bound))
        return out

    def array(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, most, bound in self.tests:
            v = x[:, NAMES.index(name)]
            out &= (v <= bound) if most else (v > bound)
        return out


def _tree(x: np.ndarray, cuts: list[np.ndarray], binned: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, tests: tuple, out: list, step: np.ndarray) -> None:
    """Grows a tree below rows; adds the path of each node to out and the leaf values to step."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-9, None)
    if len(tests) < DEPTH and len(rows) >= 2 * LEAF:
        for f, bounds in enumerate(cuts):
            if not len(bounds):
                continue
            b = binned[rows, f]
            n = np.bincount(b, minlength=len(bounds) + 1).cumsum()[:-1]
            gl = np.bincount(b, grad[rows], len(bounds) + 1).cumsum()[:-1]
            hl = np.bincount(b, hess[rows], len(bounds) + 1).cumsum()[:-1]
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(n < LEAF) | (len(rows) - n < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k))
    if best[1] is None:
        step[rows] = g / (h + 1)
        return
    f, k = best[1]
    low = binned[rows, f] <= k
    for most, part in ((True, rows[low]), (False, rows[~low])):
        path = (*tests, (NAMES[f], most, float(cuts[f][k])))
        out.append(path)
        _tree(x, cuts, binned, grad, hess, part, path, out, step)


def _simple(path: tuple) -> tuple:
    """Of comparisons of the same kind on a statistic only the sharpest."""
    sharp: dict = {}
    for name, most, bound in path:
        old = sharp.get((name, most))
        sharp[name, most] = bound if old is None else min(old, bound) if most else max(old, bound)
    return tuple(sorted((n, m, b) for (n, m), b in sharp.items()))


def grow_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 2)[1:-1])) for f in range(x.shape[1])]
    cuts = [c[c < x[:, f].max()] for f, c in enumerate(cuts)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    at = np.full(len(y), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    paths: list = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-at))
        step = np.zeros(len(y))
        _tree(x, cuts, binned, y - p, p * (1 - p), np.arange(len(y)), (), paths, step)
        at = at + RATE * step
    return [Rule(t) for t in dict.fromkeys(map(_simple, paths))]


def lasso(z: np.ndarray, y: np.ndarray, strength: float = LASSO) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an L1 penalty, by accelerated proximal steps."""
    mean, spread = z.mean(0), np.maximum(z.std(0), 0.05)
    s = (z - mean) / spread
    n, k = s.shape
    bound = 0.25 * (np.linalg.norm(s.T @ s / n, 2) + 1)
    w, b, v, c, t = np.zeros(k), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)), np.zeros(k), 0.0, 1.0
    c = b
    for _ in range(STEPS):
        r = 1 / (1 + np.exp(-(s @ v + c))) - y
        new = v - (s.T @ r / n) / bound
        new = np.sign(new) * np.maximum(np.abs(new) - strength / bound, 0)
        nb = c - r.mean() / bound
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return float(b - (w * mean / spread).sum()), w / spread


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of label 1, as an expression over _stats."""
        total = F.lit(self.intercept)
        for r in self.rules:
            total = total + F.when(r.column(), r.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """With one label alone, or no rows, a model without rules."""
    if not len(y) or y.min() == y.max():
        return Model(8.0 * float(y.mean() > 0.5) - 4.0 if len(y) else 0.0, ())
    rules = grow_rules(x, y)
    if not rules:
        return Model(math.log(y.mean() / (1 - y.mean())), ())
    b, w = lasso(np.stack([r.array(x) for r in rules], axis=1).astype(float), y)
    return Model(b, tuple(Rule(r.tests, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-4))


def held_out(id_col: str = "doc_id") -> Column:
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % 4) == 2


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """A model from the labelled documents that are not held out, max_labelled of them at most.

    Labels without a document, null labels and null ids are left out; of documents that share an id the one with the least statistics is
    taken. The sample is small by its bound, so it is broadcast.
    """
    seen = labels.where(~held_out(id_col)).where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    seen = seen.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    rows = docs.join(F.broadcast(seen), F.col(id_col) == F.col("_id")).select("_id", "_y", F.col(text_col).alias("text"))
    rows = text_statistics(rows).groupBy("_id").agg(F.min(F.struct("_y", "_stats")).alias("_m")).select("_id", "_m._y", "_m._stats.*").collect()  # at most max_labelled
    data = np.asarray([list(r)[1:] for r in sorted(rows)], dtype=float).reshape(-1, len(NAMES) + 1)
    return fit(data[:, 1:], data[:, 0])


@keeps_columns
def score_quality(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with held_out, score and predicted.

    Null or empty text: all statistics are 0, scored like any other. Null id: not held out. Rows are independent. Input
    columns held_out, score and predicted are replaced; the others pass through.
    """
    docs = docs.drop("held_out", "score", "predicted", "_stats")
    out = text_statistics(docs, text_col).withColumn("score", model.score()).drop("_stats")
    return out.withColumns({"held_out": F.coalesce(held_out(id_col), F.lit(False)), "predicted": (F.col("score") >= threshold).cast("int")})
