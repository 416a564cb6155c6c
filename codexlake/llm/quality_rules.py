"""Quality rules: fixed base rules over document statistics, then gradient-boosted trees over the same statistics.

The statistics of each whole text are computed once, in Arrow batches, and written; the trees are fitted on a bounded
sample of labelled documents (SAMPLE_ROWS) and flattened into numpy node arrays, which score all documents at once.
Trees may not let a document rise with more symbols, repeats, repeated lines or capitals (MONOTONE).

Defined results: a null or empty text has no words, fails the base rules and is not kept; equal rows get equal results;
without usable labels only the base rules decide.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import WORD, fold, labelled, small_batches, table, written

SAMPLE_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
_words = re.compile(WORD).findall
_blank = " \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("symbols", "dup_lines", "repeats", "capitals", "exclaims", "word_length", "distinct", "line_words", "log_words", "stops")
#: -1: more of it never raises the score.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1, "exclaims": -1}


def statistics(text: str | None) -> tuple:
    """COUNTS and RATIOS of one text."""
    text = text or ""
    words = _words(text)
    n = len(words)
    chars = len("".join(words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_blank)]
    dup = len(lines) - len(set(lines))
    repeat = 0
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(seen := set(windows)) < len(windows):
        if len(seen) == 1:
            repeat = n
        else:
            often = {w for w, k in Counter(windows).items() if k > 1}
            end = 0  # first word that no window has covered yet
            for i, w in enumerate(windows):
                if w in often:
                    repeat += i + 5 - max(i, end)
                    end = i + 5
    m, k = max(n, 1), max(len(lines), 1)
    ratios = (symbols / max(chars, 1), dup / k, repeat / m, sum(map(str.isupper, words)) / m, text.count("!") / m, chars / m, len(set(words)) / m, n / k, float(np.log1p(n)), sum(w[-1:] in ".?!" for w in words) / m)
    return (n, chars, symbols, dup, repeat, *ratios)


def document_statistics(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    names = [*COUNTS, *RATIOS]

    def run(batches):
        for b in batches:
            out = pd.DataFrame([statistics(t) for t in b["t"]], columns=names)
            out.insert(0, "id", b["id"].to_numpy())
            yield out

    small_batches(docs.sparkSession)
    schema = "id long, " + ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in RATIOS])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInPandas(run, schema)


class Trees:
    """Boosted trees for log-odds as flat node arrays: feature (-1: leaf), threshold, left child, value. Right is left + 1."""

    def __init__(self, base: float, roots: list[int], feature, threshold, left, value):
        self.base, self.roots = base, roots
        self.feature, self.threshold, self.left, self.value = (np.asarray(x) for x in (feature, threshold, left, value))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                if (f < 0).all():
                    break
                right = x[rows, np.maximum(f, 0)] > self.threshold[at]
                at = np.where(f < 0, at, self.left[at] + right)
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Second-order boosting on the log loss over quantile histograms; signs: monotone direction of each feature, 0 free."""
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate0 / (1 - rate0)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    score, roots = np.full(len(x), base), []
    feature, threshold, left, value = [], [], [], []

    def node() -> int:
        for a, v in ((feature, -1), (threshold, 0.0), (left, 0), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    def grow(at: int, rows: np.ndarray, deep: int, low: float, high: float, g, h) -> None:
        value[at] = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high)) * rate
        best = (1e-6, None)
        if deep:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(codes[rows, j], g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, j], h[rows], len(c) + 1))[:-1]
                gr, hr = total_g - gl, total_h - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - total_g**2 / (total_h + ridge)
                wl, wr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                bad = (hl < least * 0.05) | (hr < least * 0.05) | (signs[j] * (wr - wl) < 0)
                gain[bad] = -1
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, wl[k], wr[k]))
        if best[1] is None:
            return
        j, k, wl, wr = best[1]
        a, b = node(), node()
        feature[at], threshold[at], left[at] = j, float(cuts[j][k]), a
        mid, goes = (wl + wr) / 2, codes[rows, j] <= k
        grow(a, rows[goes], deep - 1, *((mid, high) if signs[j] < 0 else (low, mid) if signs[j] > 0 else (low, high)), g, h)
        grow(b, rows[~goes], deep - 1, *((low, mid) if signs[j] < 0 else (mid, high) if signs[j] > 0 else (low, high)), g, h)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        roots.append(node())
        first = len(feature) - 1
        grow(first, np.arange(len(x)), depth, -8.0, 8.0, p - y, p * (1 - p))
        score = score + Trees(0.0, [first], feature, threshold, left, value).log_odds(x)
    return Trees(base, roots, feature, threshold, left, value)


def fitted(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees | None:
    """The trees of at most `rows` labelled documents outside the held-out quarter; None if they have one class only."""
    known = labelled(labels, "quality", rows, 4, 2)
    # rows that share an id are one row here, the least of them, or the sample would have no bound
    found = stats.join(F.broadcast(known), stats["id"] == known["doc_id"]).groupBy("id").agg(F.min(F.struct(*RATIOS, "y")).alias("row"))
    got = found.select("id", "row.*").toPandas().sort_values("id", kind="stable")
    y = got["y"].to_numpy(float)
    if len(y) < 20 or y.min() == y.max():
        return None
    return fit(got[list(RATIOS)].to_numpy(), y, np.array([MONOTONE.get(r, 0) for r in RATIOS]))


def scored(stats: DataFrame, trees: Trees | None) -> DataFrame:
    """Adds score, the trees' probability of good quality (null without trees)."""
    if trees is None:
        return stats.withColumn("score", F.lit(None).cast("double"))
    base, roots, *flat = trees.base, trees.roots, trees.feature, trees.threshold, trees.left, trees.value

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(Trees(base, roots, *flat).probability(np.column_stack([c.to_numpy() for c in columns])))

    return stats.withColumn("score", score(*RATIOS))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(id, COUNTS, RATIOS, score, base_failed, kept) of every document."""
    stats = written(document_statistics(docs))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored(stats, fitted(stats, labels)).withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(F.col("score") >= threshold, F.lit(True)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = keep(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), *COUNTS, "base_failed", "kept", "score", (fold("id", 4) == 2).alias("held_out"))
