"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on the statistics of a bounded labelled sample;
every path from a root to a node is a conjunctive rule.  A logistic regression
with an L1 penalty weighs the rules and leaves most of them out.  What is left
is compiled into one Spark column over the statistics.

Defined results: a null or empty text has zero statistics and a score like any
other; texts of any length are read whole; equal texts score alike; without any
labelled row every score is 1, so nothing is rejected; an empty table gives no
rows; further columns are ignored by `score` and kept by `keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import fold_of, labelled_sample, unused_name
from tallymill.llm.words import Words, shingle_hashes

SAMPLE = 12_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

TREES, DEPTH, RATE = 40, 3, 0.3
CUTS = 48
LEAST_ROWS = 8
PENALTY = 4e-4
STEPS = 400

STATISTICS = (
    "chars", "words", "word_bytes", "words_per_line", "upper", "digits", "spaces", "stops",
    "bars", "bangs", "signs", "sign_words", "distinct_words", "commonest_word",
    "repeated_neighbours", "repeated_shingles", "repeated_lines",
)
STATISTICS_SCHEMA = ", ".join(f"{name} double" for name in STATISTICS)


def _class(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[*characters.encode()]] = True
    return table


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = _class("0123456789")
SPACES = _class(" \t\r\n")
STOPS = _class(".,;:?'\"()-")
SIGNS = _class("#$%&*+/<=>@[\\]^_`{}~")


def statistics(text: str) -> tuple[float, ...]:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    words = Words(text)
    n, size = len(words), max(1, len(raw))
    counts = np.bincount(raw, minlength=256)
    lines = [line for line in text.split("\n") if line.strip()]
    hashes = words.hashes()
    _, often = np.unique(hashes, return_counts=True)
    shingles = shingle_hashes(hashes, 5)
    most = max(1, n)
    # A word is followed by a sign where the byte after its end is one.
    after = words.raw[np.minimum(words.ends, len(words.raw) - 1)] if n else words.raw
    return (
        float(len(text)),
        float(n),
        float((words.ends - words.starts).sum() / most),
        n / max(1, len(lines)),
        counts[UPPER].sum() / size,
        counts[DIGITS].sum() / size,
        counts[SPACES].sum() / size,
        counts[STOPS].sum() / size,
        counts[ord("|")] / size,
        counts[ord("!")] / size,
        counts[SIGNS].sum() / size,
        float(SIGNS[after].sum() / most),
        len(often) / most,
        float(often.max() / most) if n else 0.0,
        float((hashes[1:] == hashes[:-1]).sum() / most),
        1 - len(np.unique(shingles)) / max(1, len(shingles)) if n else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    )


def with_statistics(documents: DataFrame, name: str = "stats") -> DataFrame:
    """The documents and their statistics as a struct of this name."""

    @F.pandas_udf(STATISTICS_SCHEMA)
    def of_texts(texts):
        import pandas as pd

        rows = [statistics(t or "") for t in texts]
        return pd.DataFrame(rows, columns=STATISTICS, dtype="float64")

    return documents.withColumn(name, of_texts("text"))


@dataclass(frozen=True)
class Rule:
    """All of (statistic, above, bound) hold: > bound if above, else <= bound."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(and_, [(x[:, s] > b) == above for s, above, b in self.terms])

    def column(self, stats: str) -> Column:
        tests = []
        for s, above, bound in self.terms:
            value = F.col(f"{stats}.{STATISTICS[s]}")
            tests.append(value > bound if above else value <= bound)
        return reduce(and_, tests)


@dataclass
class Model:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def column(self, stats: str = "stats") -> Column:
        """The score as a column over the struct of statistics."""
        logit = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            logit = logit + F.when(rule.column(stats), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))

    def scores(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            logit = logit + np.where(rule.holds(x), weight, 0.0)
        return 1 / (1 + np.exp(-logit))


def simplified(terms: list[tuple[int, bool, float]]) -> Rule:
    """One bound per statistic and side: the tightest."""
    tightest: dict[tuple[int, bool], float] = {}
    for s, above, bound in terms:
        old = tightest.get((s, above), bound)
        tightest[s, above] = max(old, bound) if above else min(old, bound)
    return Rule(tuple(sorted((s, above, b) for (s, above), b in tightest.items())))


def grown_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees; each tree is fitted to the loss that is left."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    bins = [np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)]
    logit, rules = np.zeros(len(y)), {}

    def best_split(rows: np.ndarray, g: np.ndarray, h: np.ndarray):
        best = (1e-6, None, None)
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for s, c in enumerate(cuts):
            if not len(c):
                continue
            b, size = bins[s][rows], len(c) + 1
            left_g = np.cumsum(np.bincount(b, g[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(b, h[rows], size))[:-1]
            left_n = np.cumsum(np.bincount(b, minlength=size))[:-1]
            right_g, right_h = g[rows].sum() - left_g, h[rows].sum() - left_h
            gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - whole
            gain[(left_n < LEAST_ROWS) | (len(rows) - left_n < LEAST_ROWS)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], s, float(c[at]))
        return best[1:]

    def grow(rows: np.ndarray, path: list, g: np.ndarray, h: np.ndarray) -> None:
        if path:
            rules.setdefault(simplified(path))
        split = best_split(rows, g, h) if len(path) < DEPTH else (None, None)
        if split[0] is None:
            logit[rows] -= RATE * g[rows].sum() / (h[rows].sum() + 1)
            return
        s, bound = split
        above = x[rows, s] > bound
        grow(rows[~above], [*path, (s, False, bound)], g, h)
        grow(rows[above], [*path, (s, True, bound)], g, h)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        grow(np.arange(len(y)), [], p - y, p * (1 - p))
    return [*rules]


def lasso(hits: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic regression, by
    accelerated proximal gradient steps."""
    n, k = hits.shape
    a = np.ones((n, k + 1), dtype=np.float32)
    a[:, :k] = hits
    v = np.ones(k + 1, dtype=np.float32)
    for _ in range(30):  # the largest eigenvalue bounds the curvature
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float(v @ (a.T @ (a @ v))) / n * 1.05 + 1e-12)
    bound = np.append(np.full(k, PENALTY * step), 0.0)
    w, ahead, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ ahead.astype(np.float32), -35, 35)))
        moved = ahead - step * (a.T @ (p - y).astype(np.float32)) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - bound, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    rules = grown_rules(x, y)
    if not rules:
        good = (y.sum() + 0.5) / (len(y) + 1)
        return Model([], [], float(np.log(good / (1 - good))))
    weights, intercept = lasso(np.stack([r.holds(x) for r in rules], 1), y)
    kept = [(r, float(w)) for r, w in zip(rules, weights) if w]
    return Model([r for r, _ in kept], [w for _, w in kept], intercept)


def train(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Fitted on the driver, on at most SAMPLE rows of len(STATISTICS) numbers."""
    sample = labelled_sample(
        documents, labels, "quality", fold_of("doc_id", FOLDS) != HELD_OUT, SAMPLE
    )
    rows = with_statistics(sample).select("turn", "label", "stats.*").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["turn", "label", *STATISTICS])
    return fit(rows[[*STATISTICS]].to_numpy(np.float64), rows["label"].to_numpy(np.float64))


def score_column(model: Model | None, stats: str = "stats") -> Column:
    return F.lit(1.0) if model is None else model.column(stats)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(documents, labels)
    rows = with_statistics(documents.select("doc_id", "text")).withColumn(
        "score", score_column(model)
    )
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, model: Model | None) -> DataFrame:
    """Rows and columns of the documents that are predicted good."""
    name = unused_name(documents, "stats")
    good = score_column(model, name) >= THRESHOLD
    return with_statistics(documents, name).where(good).drop(name)
