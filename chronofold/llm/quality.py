"""Quality classification by a sparse rule ensemble over text statistics.

Statistics are Spark column expressions. On a bounded labelled sample shallow trees are boosted over them; every path
from a root to an inner node or leaf becomes a conjunctive rule; a lasso logistic regression keeps few rules and
weighs them; and the rules are compiled back into one Spark column, so that scoring stays in generated code.

Defined results: a null text counts as the empty one, whose statistics are all 0; repeated rows get a row each; other
columns are ignored by score() and kept by keep_good(); without labels of both classes every score is the share of
label 1 (1 without labels, so that nothing is thrown away); an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm import labelled

#: Labelled documents of each class that a model is fitted on.
SAMPLE_DOCS = 4000
TREES, DEPTH, RATE, BINS, LEAST_LEAF = 30, 3, 0.3, 32, 8
#: Weight of the lasso penalty, as a share of the smallest that leaves no rule.
LASSO = 0.01
STATISTICS = ("chars", "words", "distinct_words", "word_chars", "marks", "capitals", "digits", "line_words", "distinct_lines", "bars")


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """docs' columns in keep, and one double for each of STATISTICS."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*keep, t.alias("_t"), F.length(t).alias("_n"))
    words, lines = F.split("_t", " "), F.split("_t", "\n")
    base = base.select(
        *keep, "_n", words.alias("_w"), lines.alias("_l"),
        (F.col("_n") - F.length(F.regexp_replace("_t", r"[&%$#*!?=<>{}~^_\\|]+", ""))).alias("_marks"),
        (F.col("_n") - F.length(F.regexp_replace("_t", r"\p{Lu}+", ""))).alias("_capitals"),
        (F.col("_n") - F.length(F.regexp_replace("_t", r"[0-9]+", ""))).alias("_digits"),
        (F.col("_n") - F.length(F.replace("_t", F.lit("|"), F.lit("")))).alias("_bars"),
    )
    n, w, l = F.greatest(F.col("_n"), F.lit(1)).cast("double"), F.size("_w").cast("double"), F.size("_l").cast("double")
    filled = F.when(F.col("_n") > 0, 1.0).otherwise(0.0)
    values = {
        "chars": F.col("_n").cast("double"), "words": w * filled,
        "distinct_words": F.size(F.array_distinct("_w")) / w * filled, "word_chars": F.col("_n") / w,
        "marks": F.col("_marks") / n, "capitals": F.col("_capitals") / n, "digits": F.col("_digits") / n,
        "line_words": w / l * filled, "distinct_lines": F.size(F.array_distinct("_l")) / l * filled, "bars": F.col("_bars") / w,
    }
    return base.select(*keep, *[values[k].cast("double").alias(k) for k in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each statistic, low < value <= high."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, low, high in self.bounds:
            v = x[:, STATISTICS.index(name)]
            out &= (v > low) & (v <= high)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out = out & (F.col(name) > F.lit(low))
            if high < math.inf:
                out = out & (F.col(name) <= F.lit(high))
        return out


@dataclass(frozen=True)
class Model:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def column(self) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """Boost shallow trees on the logistic loss; the rules of all their nodes but the roots."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    z, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, bounds: dict, depth: int, slope: np.ndarray, curve: np.ndarray, out: np.ndarray) -> None:
        g, h = slope[rows].sum(), curve[rows].sum()
        best = (1e-6, None, None)
        if depth < DEPTH and len(rows) >= 2 * LEAST_LEAF:
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, j]
                gs, hs, ns = (np.cumsum(np.bincount(b, v, len(c) + 1))[:-1] for v in (slope[rows], curve[rows], np.ones(len(rows))))
                fits = (ns >= LEAST_LEAF) & (len(rows) - ns >= LEAST_LEAF)
                gain = np.where(fits, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), -1)
                if (k := int(gain.argmax())) >= 0 and gain[k] > best[0]:
                    best = (gain[k], j, k)
        if bounds:
            rules.setdefault(tuple(sorted((STATISTICS[j], lo, hi) for j, (lo, hi) in bounds.items())))
        if best[1] is None:
            out[rows] = RATE * g / (h + 1)
            return
        _, j, k = best
        cut, (lo, hi) = float(cuts[j][k]), bounds.get(j, (-math.inf, math.inf))
        left = binned[rows, j] <= k
        grow(rows[left], bounds | {j: (lo, min(hi, cut))}, depth + 1, slope, curve, out)
        grow(rows[~left], bounds | {j: (max(lo, cut), hi)}, depth + 1, slope, curve, out)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), {}, 0, weight * (y - p), weight * p * (1 - p), step)
        z += step
    return [Rule(b) for b in rules]


def _lasso(a: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Lasso logistic regression by accelerated proximal gradient steps; the intercept is free."""
    weight = weight / weight.sum()
    share = float((weight * y).sum())
    base = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    penalty = LASSO * np.abs(a.T @ (weight * (y - share))).max()
    b, c, at_b, at_c, t = np.zeros(a.shape[1]), base, np.zeros(a.shape[1]), base, 1.0
    step = 4 / max(np.linalg.norm(np.column_stack([a, np.ones(len(a))]) * np.sqrt(weight)[:, None], 2) ** 2, 1e-9)
    for _ in range(rounds):
        r = weight * (1 / (1 + np.exp(-np.clip(a @ at_b + at_c, -30, 30))) - y)
        nb, nc = at_b - step * (a.T @ r), at_c - step * r.sum()
        nb = np.sign(nb) * np.maximum(np.abs(nb) - step * penalty, 0)
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        at_b, at_c = nb + (t - 1) / nt * (nb - b), nc + (t - 1) / nt * (nc - c)
        b, c, t = nb, nc, nt
    return b, c


def fit(x: np.ndarray, y: np.ndarray, shares: dict[int, float]) -> Model:
    counts = Counter(y.tolist())
    if len(counts) < 2:
        return Model((), -30.0 if counts.get(0) else 30.0)
    weight = np.array([1 / max(shares[k], 1e-9) for k in y.tolist()])
    weight /= weight.mean()
    rules = _trees(x, y.astype(float), weight)
    if not rules:
        return Model((), math.log(counts[1] / counts[0]))
    b, c = _lasso(np.column_stack([r.holds(x) for r in rules]).astype(float), y.astype(float), weight)
    return Model(tuple((r, float(v)) for r, v in zip(rules, b) if abs(v) > 1e-6), float(c))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on a bounded sample of labelled documents, SAMPLE_DOCS of each class."""
    slim = labels.select(id_col, F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    picked, shares = labelled.sample(slim, id_col, "label", SAMPLE_DOCS)
    rows = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(picked), id_col)
    got = sorted(tuple(r) for r in statistics(rows, "text", (id_col, "label")).limit(8 * SAMPLE_DOCS).collect())
    x = np.array([r[2:] for r in got], float).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r[1] for r in got], np.int64), shares)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of each document."""
    return statistics(docs, text_col, (id_col,)).select(id_col, model.column().alias("score"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all their columns, that score threshold or more."""
    own = [f"_c{i}" for i in range(len(docs.columns))]
    slim = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)], F.col(f"`{text_col}`").alias("_text"))
    # beside a column that is not deterministic the filter stays above the statistics, which every rule would else compute anew
    judged = statistics(slim, "_text", tuple(own)).select(*own, (model.column() >= threshold).alias("_good"), F.monotonically_increasing_id().alias("_at"))
    return judged.where("_good AND _at >= 0").select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])
