"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small boosted trees are grown on labelled documents, every path from a root becomes a rule, and a lasso logistic
regression keeps and weighs few of them.  The model is a list of rules and compiles into one Spark column.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgrade.llm.common import map_rows, materialise, remainder, utf8

#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
TREES, DEPTH, BINS, RATE = 24, 3, 32, 0.3
LEAST_ROWS = 20
PENALTY = 2e-3
STATISTICS = (
    "log_words", "mean_word", "long_words", "upper", "digit", "punctuation", "symbols", "bars", "exclamations",
    "distinct", "top_word", "pair_repeats", "line_repeats", "log_lines", "sentence_ends", "other_bytes",
)

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGIT = b"0123456789"
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_ENDS = b".?!"
_SYMBOLS = b"#$%&*<>@^_~|{}[]\\=+"
_OTHER = bytes(range(128, 256))


def statistics_of(text: str | None) -> tuple[float, ...]:
    """The statistics of one text; an empty text has zeros."""
    raw = utf8(text)
    words = raw.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, size = len(words), len(raw)

    def share(of: bytes) -> float:
        return (size - len(raw.translate(None, of))) / size

    counts = Counter(words)
    pairs = set(zip(words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        math.log1p(n),
        (size - n) / n,
        sum(len(w) > 20 for w in counts) / len(counts),
        share(_UPPER),
        share(_DIGIT),
        share(_PUNCTUATION),
        share(_SYMBOLS),
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        len(counts) / n,
        max(counts.values()) / n if n > 4 else 0.0,
        1 - len(pairs) / (n - 1) if n > 1 else 0.0,
        1 - len(set(lines)) / len(lines),
        math.log1p(len(lines)),
        sum(raw.count(bytes([c])) for c in _ENDS) / n,
        share(_OTHER),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text."""

    def make():
        return lambda texts: [statistics_of(t) for t in texts]

    return map_rows(docs, ["text"], make, ", ".join(f"{s} double" for s in STATISTICS), ["doc_id"])


#: (statistic, whether it must be at most the bound, bound)
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions and an intercept on the log-odds scale."""

    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...] = ()

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for feature, at_most, bound in conditions:
                value = F.col(STATISTICS[feature])
                holds = holds & (value <= bound if at_most else value > bound)
            total = total + F.when(holds, F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def text(self) -> list[str]:
        """The rules in words, the heaviest first."""
        return [
            f"{w:+.3f} if " + " and ".join(f"{STATISTICS[f]} {'<=' if low else '>'} {b:.4g}" for f, low, b in c)
            for c, w in sorted(self.rules, key=lambda r: -abs(r[1]))
        ]


def holds(conditions: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for feature, at_most, bound in conditions:
        out &= x[:, feature] <= bound if at_most else x[:, feature] > bound
    return out


def simplified(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The tightest bound per statistic and side, in a fixed order."""
    best: dict[tuple[int, bool], float] = {}
    for f, low, b in path:
        key = (f, low)
        best[key] = b if key not in best else (min if low else max)(best[key], b)
    return tuple(sorted((f, low, b) for (f, low), b in best.items()))


def grow(x: np.ndarray, bins: list[np.ndarray], codes: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, list]:
    """A regression tree on gradients: its value for each row, and the paths of all its nodes."""
    value, paths = np.zeros(len(x)), []
    todo: list[tuple[np.ndarray, tuple[Condition, ...]]] = [(np.arange(len(x)), ())]
    while todo:
        rows, path = todo.pop()
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value[rows] = g / (h + 1.0)
        if path:
            paths.append(simplified(path))
        if len(path) >= DEPTH or len(rows) < 2 * LEAST_ROWS:
            continue
        best = (1e-6, -1, -1)
        for f, edges in enumerate(bins):
            if not len(edges):
                continue
            gs = np.bincount(codes[rows, f], gradient[rows], len(edges) + 1).cumsum()[:-1]
            hs = np.bincount(codes[rows, f], hessian[rows], len(edges) + 1).cumsum()[:-1]
            ns = np.bincount(codes[rows, f], minlength=len(edges) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < LEAST_ROWS) | (len(rows) - ns < LEAST_ROWS)] = -1
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
        if best[1] < 0:
            continue
        _, f, at = best
        left = codes[rows, f] <= at
        bound = float(bins[f][at])
        todo += [(rows[left], (*path, (f, True, bound))), (rows[~left], (*path, (f, False, bound)))]
    return value, paths


def paths_of_trees(x: np.ndarray, y: np.ndarray) -> list[tuple[Condition, ...]]:
    bins = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(b, x[:, f], side="left") for f, b in enumerate(bins)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), math.log(mean / (1 - mean)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        value, paths = grow(x, bins, codes, y - p, p * (1 - p))
        score += RATE * value
        found |= dict.fromkeys(paths)
    return list(found)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an l1-penalised logistic regression by accelerated proximal gradient steps."""
    n, k = z.shape
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b, w = math.log(mean / (1 - mean)), np.zeros(k)
    vb, v, t = b, w.copy(), 1.0
    step = 4 * n / (np.linalg.norm(np.column_stack([np.ones(n), z]), 2) ** 2 + 1e-9)
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(z @ v + vb))) - y
        nb = vb - step * r.mean()
        nw = v - step * (z.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        vb, v = nb + (t - 1) / nt * (nb - b), nw + (t - 1) / nt * (nw - w)
        b, w, t = nb, nw, nt
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Rules:
    """Rules from labelled statistics; without two classes only the intercept."""
    if not len(y):
        return Rules(0.0)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    if y.min() == y.max():
        return Rules(math.log(mean / (1 - mean)))
    paths = paths_of_trees(x, y)
    if not paths:
        return Rules(math.log(mean / (1 - mean)))
    z = np.stack([holds(p, x) for p in paths], axis=1).astype(np.float64)
    b, w = lasso(z, y, penalty)
    return Rules(b, tuple((p, float(v)) for p, v in zip(paths, w) if v))


def is_held_out() -> Column:
    return remainder("doc_id", FOLDS) == HELD_OUT


def labelled(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and quality of at most ``rows`` labels outside the held-out fold, those whose ids have the smallest hashes."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality").where(~is_held_out())
    return known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)


def fit(stats: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> Rules:
    """Rules fitted on the statistics of ``known`` labelled documents; of repeated ones at most ``rows`` in all, by the same order."""
    found = stats.join(F.broadcast(known), "doc_id")
    taken = found.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS).limit(rows)
    taken = taken.select("quality", *STATISTICS).toPandas().sort_values(["quality", *STATISTICS])
    return fit_rules(taken[list(STATISTICS)].to_numpy(np.float64), taken["quality"].to_numpy(np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, the likelihood of label 1) and predicted (score >= ``CUT``) per document.

    Only the text is an input of the score.  Null and empty texts are scored by their zero statistics; repeated rows
    get a row each; a null doc_id is scored and counts as held out.  Without labels every score is 0.5.
    """
    stats = materialise(statistics(docs), "statistics")
    model = fit(stats, labelled(labels, rows), rows)
    scored = stats.select("doc_id", is_held_out().alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, all columns as they are.

    Statistics are worked out once for every text, and before that for the labelled ones that the rules are learned from.
    """
    columns = docs.columns

    def make():
        return lambda texts: [statistics_of(t) for t in texts]

    known = labelled(labels)
    model = fit(statistics(docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id").distinct()), "doc_id")), known)
    wide = map_rows(docs.select(F.struct(*columns).alias("_row")), ["_row.text"], make, ", ".join(f"{s} double" for s in STATISTICS), ["_row"])
    return wide.where(model.column() >= CUT).select("_row.*")
