"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding: lower case, compatibility forms, no combining marks, invisible characters removed, look-alike letters of other
scripts and digit substitutions mapped to one Latin skeleton (i, l, 1 and ! share one letter). Words with letters beyond
ASCII are matched as they are written too, for in some languages a mark makes another word.

The lexicon is learned from at most SAMPLE_ROWS labelled documents outside the held-out fold. Its roots are word beginnings
whose share among toxic documents is far above that among others. Longer beginnings and whole words below a root whose
shares differ from the root's have weights of their own, none if toxic documents hold them no more often than others: so a
harmless word may share the beginning of abuse. Terms have SHORTEST to LONGEST letters; a longer word is known by its
beginning. A word counts with its longest term. Exception phrases cover hits inside them. A document's score is a logistic
function of the summed weights of its hits and of their share of its words, fitted on the same rows.

Defined results: a null or empty text has no hits and the score of such texts; equal texts get equal scores; texts of any
length are read whole; without usable labels every score is the prior 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fold, forget, labelled, small_batches, table, written

SAMPLE_ROWS = 20_000
#: A root needs this many toxic documents and this ratio of the (smoothed) shares of both classes.
LEAST_DOCS, LEAST_RATIO = 3, 6.0
#: And this log-likelihood ratio (G squared), so that chance finds among very many beginnings stay out; a term below a root
#: needs the other one against the root's shares.
LEAST_G2, CHILD_G2 = 20.0, 6.6
SHORTEST, LONGEST = 4, 12

# Look-alikes, each string's letters stand for the letter before it.
LOOKALIKES = {
    "a": "аαɑ4@", "b": "Ьъвβ8", "c": "сϲ", "d": "ԁ", "e": "еёєε3", "g": "ɡ9", "h": "һн", "i": "іїιıӏІlɩ1!|", "j": "ј", "k": "кκ", "m": "м", "n": "ոп", "o": "оοσө0",
    "p": "рρ", "q": "ԛ", "s": "ѕ5$", "t": "тτ7", "u": "υս", "v": "ν", "w": "ԝѡω", "x": "хχ", "y": "уγү", "z": "ᴢ2",
}
# Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown", "sore loser", "pond scum", "soap scum")
_TABLE = {ord(c): to for to, cs in LOOKALIKES.items() for c in cs} | {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
_MARKS = re.compile(r"[̀-ͯ]+")
_TOKEN = re.compile(r"[^\W_]+")
_RUNS = re.compile(r"(.)\1{2,}")


def folded(text: str | None) -> str:
    text = text or ""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _RUNS.sub(r"\1", text.lower().translate(_TABLE))


def terms_of(text: str | None) -> set[str]:
    """Beginnings and whole words ($ behind them) of the folded text and, where it differs, of the words as written (= before them)."""
    found = set(_TOKEN.findall(folded(text)))
    if text and not text.isascii():
        found.update("=" + w for w in _TOKEN.findall(text.lower()) if not w.isascii())
    out = set()
    for w in found:
        mark = w.startswith("=")
        out.update(w[:k] for k in range(SHORTEST + mark, min(len(w), LONGEST + mark) + 1))
        if len(w) <= LONGEST + mark:
            out.add(w + "$")
    return out


def term_counts(sample: DataFrame) -> DataFrame:
    """sample: (t, y). (term, y, n): in how many documents of each class a word with this beginning occurs."""

    def run(batches):
        counts = (Counter(), Counter())
        for b in batches:
            for text, y in zip(b["t"], b["y"]):
                counts[int(y)].update(terms_of(text))
                if sum(map(len, counts)) > 400_000:
                    yield pd.DataFrame([(w, k, n) for k in (0, 1) for w, n in counts[k].items()], columns=["term", "y", "n"])
                    counts = (Counter(), Counter())
        yield pd.DataFrame([(w, k, n) for k in (0, 1) for w, n in counts[k].items()], columns=["term", "y", "n"])

    small_batches(sample.sparkSession)
    return sample.mapInPandas(run, "term string, y int, n long").groupBy("term").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"))


def g2(p: int, n: int, share: float) -> float:
    """Twice the log-likelihood ratio of p toxic and n other documents against a share of toxic ones."""
    share = min(max(share, 1e-9), 1 - 1e-9)
    return 2 * sum(x * math.log(x / ((p + n) * q)) for x, q in ((p, share), (n, 1 - share)) if x)


def roots(rows: list[tuple[str, int, int]], pos_docs: int, neg_docs: int) -> dict[str, tuple[int, int]]:
    """Term to counts. Of a word's beginnings the longest is a root that has (nearly) as many toxic documents as the shorter ones."""
    share = pos_docs / (pos_docs + neg_docs)
    good = {w: (p, n) for w, p, n in rows if not w.endswith("$") and g2(p, n, share) >= LEAST_G2 and weight(p, n, pos_docs, neg_docs) >= math.log(LEAST_RATIO)}
    out: dict[str, tuple[int, int]] = {}
    for w in sorted(good, key=lambda w: (len(w), w)):
        if any(w[:k] in out for k in range(SHORTEST, len(w))):
            continue
        while longer := [x for x in good if len(x) == len(w) + 1 and x.startswith(w) and good[x][0] >= 0.75 * good[w][0]]:
            w = max(longer, key=lambda x: (good[x][0], x))
        out[w] = good[w]
    return out


def weight(p: int, n: int, pos_docs: int, neg_docs: int) -> float:
    return math.log((p + 0.5) / (pos_docs + 1) / ((n + 0.5) / (neg_docs + 1)))


def lexicon(found: dict[str, tuple[int, int]], rows: list[tuple[str, int, int]], pos_docs: int, neg_docs: int) -> dict[str, float]:
    """Term to weight: the roots, and the terms below them (rows) whose shares differ from those of the term above."""
    counts, out = dict(found), {w: weight(*c, pos_docs, neg_docs) for w, c in found.items()}
    for w, p, n in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        above = next((w[:k] for k in range(len(w) - 1, SHORTEST - 1, -1) if w[:k] in counts), None)
        if above is not None and w not in counts and g2(p, n, (counts[above][0] + 0.5) / (sum(counts[above]) + 1)) >= CHILD_G2:
            counts[w], out[w] = (p, n), max(0.0, weight(p, n, pos_docs, neg_docs))
    return out


class Matcher:
    """Hits of a lexicon at the beginnings of words of a folded text, and of the text as written, outside exception phrases."""

    def __init__(self, terms: dict[str, float]):
        self.folded, self.written = ({}, {})
        for w, x in terms.items():
            into = self.written if w.startswith("=") else self.folded
            key = w.strip("=$")
            begins, whole = into.get(key, (None, None))
            into[key] = (begins, x) if w.endswith("$") else (x, whole)
        self.automata = [self._automaton(t, phrases) for t, phrases in ((self.folded, EXCEPTIONS), (self.written, ()))]

    @staticmethod
    def _automaton(terms: dict[str, tuple], phrases):
        out = ahocorasick.Automaton()
        for w, x in terms.items():
            out.add_word(w, (len(w), x))
        for phrase in phrases:
            out.add_word(folded(phrase), (len(folded(phrase)), None))
        if len(out):
            out.make_automaton()
        return out

    @staticmethod
    def _found(automaton, flat: str) -> list[tuple[int, int, float]]:
        best: dict[int, tuple[int, float]] = {}
        free = []
        for last, (size, weights) in automaton.iter(flat):
            start, end = last + 1 - size, last + 1
            if weights is None:
                free.append((start, end))
            elif not start or not flat[start - 1].isalnum():
                begins, whole = weights
                x = whole if whole is not None and (end == len(flat) or not flat[end].isalnum()) else begins
                if x is not None:  # matches of one start come by their length
                    best[start] = (end, x)
        hits = [(a, b, x) for a, (b, x) in best.items() if x > 0]
        if free and hits:
            # phrases by start; the furthest end up to a start covers a hit or none does
            free.sort()
            starts, reach = [a for a, _ in free], list(accumulate((b for _, b in free), max))
            hits = [h for h in hits if not ((k := bisect_right(starts, h[0])) and reach[k - 1] >= h[1])]
        return hits

    def hits(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """(start, end, weight) in the folded text, then in the text as written, and the number of words."""
        flat = folded(text)
        found = self._found(self.automata[0], flat) if self.folded or EXCEPTIONS else []
        if self.written and text and not text.isascii():
            found = found + self._found(self.automata[1], text.lower())
        return found, len(flat.split())

    def features(self, text: str | None) -> tuple[float, float, int]:
        """Log of the summed weights, log of their sum a hundred words, hits."""
        found, words = self.hits(text)
        total = sum(h[2] for h in found)
        return math.log1p(total), math.log1p(100 * total / max(words, 20)), len(found)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method; the last coefficient is the constant."""
    x, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, terms: dict[str, float], coefficients):
        self.terms, self.coefficients = terms, coefficients


def _features(docs: DataFrame, terms: dict[str, float], coefficients=None) -> DataFrame:
    """docs: (id, t, ...). id, y and score, or the features where there are no coefficients."""
    rest = [c for c in docs.columns if c != "t"]

    def run(batches):
        matcher = Matcher(terms)
        for b in batches:
            x = np.array([matcher.features(t) for t in b["t"]], float).reshape(-1, 3)
            out = b[rest].copy()
            if coefficients is None:
                out["f0"], out["f1"] = x[:, 0], x[:, 1]
            else:
                out["score"] = 1 / (1 + np.exp(-np.clip(x[:, :2] @ coefficients[:2] + coefficients[2], -30, 30)))
                out["hits"] = x[:, 2].astype("int64")
            yield out

    small_batches(docs.sparkSession)
    kinds = dict(docs.dtypes)
    return docs.mapInPandas(run, ", ".join([f"`{c}` {kinds[c]}" for c in rest] + (["f0 double", "f1 double"] if coefficients is None else ["score double", "hits long"])))


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most `rows` labelled rows, none of the held-out fifth."""
    known = labelled(labels, "toxic", rows, 5, 0)
    found = docs.select(F.col("doc_id"), F.col("text").alias("t")).join(F.broadcast(known), "doc_id")
    # rows that share an id are one row here, that of the least text, or the sample would have no bound; only their texts move
    shared = written(docs.select("doc_id").join(F.broadcast(known), "doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), rows)
    if not shared.isEmpty():
        one = found.join(F.broadcast(shared), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("t").alias("t"), F.min("y").alias("y"))
        found = found.join(F.broadcast(shared), "doc_id", "left_anti").unionByName(one)
    sample = found.select("t", F.when(F.col("y") > 0, 1).otherwise(0).alias("y"))
    classes = dict(known.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect())
    pos, neg = classes.get(1, 0), classes.get(0, 0)
    if not pos or not neg:
        return Model({}, None)
    terms = written(term_counts(sample).where(F.col("pos") + F.col("neg") >= min(LEAST_DOCS, pos)).select("term", "pos", "neg"))
    often = terms.where((F.col("pos") >= min(LEAST_DOCS, pos)) & ((F.col("pos") + 0.5) / (pos + 1) >= LEAST_RATIO * (F.col("neg") + 0.5) / (neg + 1)))
    above = roots([tuple(r) for r in often.collect()], pos, neg)
    if not above:
        return Model({}, None)
    begins = F.array(*[F.lit(w) for w in above])
    below = terms.where(F.exists(begins, lambda w: F.col("term").startswith(w)))
    found = lexicon(above, [tuple(r) for r in below.collect()], pos, neg)
    forget(terms)
    got = _features(sample, found).toPandas()
    return Model(found, logistic(got[["f0", "f1"]].to_numpy(), got["y"].to_numpy(float)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, hits) of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    if model.coefficients is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("hits"))
    return _features(rows, model.terms, model.coefficients)


def non_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores below the threshold, with all their columns."""
    if model.coefficients is None:
        return docs
    terms, w = model.terms, model.coefficients

    @F.pandas_udf("boolean")
    def fine(texts: pd.Series) -> pd.Series:
        matcher = Matcher(terms)
        x = np.array([matcher.features(t)[:2] for t in texts], float).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ w[:2] + w[2], -30, 30))) < threshold)

    small_batches(docs.sparkSession)
    return docs.where(fine(F.col(text_col)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fitted(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
