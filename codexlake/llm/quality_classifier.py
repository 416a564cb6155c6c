"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Random indexing: every word has a sparse ternary index vector, a function of its hash; a word's vector is the sum of the
index vectors of its neighbours over all documents. Words are hashed to VOCABULARY buckets, so every task holds, and sends,
one table of VOCABULARY x SIZE sums, whatever the corpus; the sums are added up by bucket. Vectors lose their common
direction and are scaled to length 1. A document is the mean of its words' vectors with the logs of its length and of the
mean's length. A network with one hidden layer is trained on at most SAMPLE_ROWS labelled rows outside the held-out fold; a
temperature, fitted on a slice it has not seen, calibrates its probabilities.

Words are runs of letters (those in capitals are marked, so that their shape counts), digits or other signs.

Defined results: a null or empty text has a zero vector and gets the network's score for it; equal texts get equal
scores; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fold, labelled, small_batches, table, written

SAMPLE_ROWS, VOCABULARY, SIZE, NONZERO, REACH = 20_000, 8192, 48, 2, 2
#: Words that a task remembers, and the length from which on a word is hashed anew each time, which bounds their memory.
CACHE, REMEMBERED = 400_000, 64
_tokens = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+").findall


class Buckets(dict):
    """Word to bucket, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        shape = "U:" if len(word) > 1 and word.isupper() else ""
        k = zlib.crc32((shape + word.lower()).encode("utf-8", "surrogatepass")) % VOCABULARY
        if len(word) < REMEMBERED:
            self[word] = k
        return k


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of all buckets' index vectors."""
    random = np.random.default_rng(7)
    return random.integers(0, SIZE, (VOCABULARY, NONZERO)), random.choice(np.array([-1.0, 1.0]), (VOCABULARY, NONZERO))


def ids_of(text: str | None, buckets: Buckets) -> np.ndarray:
    found = _tokens(text or "")
    return np.fromiter(map(buckets.__getitem__, found), np.int64, len(found))


def context_sums(docs: DataFrame) -> DataFrame:
    """(bucket, v0, v1, ...): sums over all documents of the index vectors of the neighbours."""
    columns = [f"v{k}" for k in range(SIZE)]

    def run(batches):
        places, signs = index_vectors()
        buckets, total = Buckets(), np.zeros(VOCABULARY * SIZE)
        seen = False
        for b in batches:
            # documents are kept apart by -1, which has no neighbours
            parts = [x for t in b["t"] for x in (ids_of(t, buckets), np.full(REACH, -1))]
            ids = np.concatenate(parts) if parts else np.zeros(0, int)
            for at in range(0, len(ids), 2_000_000):
                part = ids[max(0, at - REACH) : at + 2_000_000]
                for reach in range(1, REACH + 1):
                    left, right = part[:-reach], part[reach:]
                    fine = (left >= 0) & (right >= 0)
                    if at:  # pairs of the overlap are counted already
                        fine &= np.arange(len(left)) + reach >= REACH
                    left, right = left[fine], right[fine]
                    for k in range(NONZERO):
                        for to, of in ((left, right), (right, left)):
                            total += np.bincount(to * SIZE + places[of, k], signs[of, k], VOCABULARY * SIZE)
            seen = seen or len(ids) > 0
        if seen:
            sums = total.reshape(VOCABULARY, SIZE)
            used = np.flatnonzero(np.abs(sums).sum(1))
            out = pd.DataFrame(sums[used].astype("float32"), columns=columns)
            out.insert(0, "bucket", used)
            yield out

    small_batches(docs.sparkSession, 1024)
    parts = docs.mapInPandas(run, "bucket long, " + ", ".join(f"{c} float" for c in columns))
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """VOCABULARY x SIZE unit vectors (zero for buckets without words): a table of fixed size."""
    got = context_sums(docs).toPandas()
    out = np.zeros((VOCABULARY, SIZE), "float32")
    if len(got):
        raw = got[[f"v{k}" for k in range(SIZE)]].to_numpy()
        raw = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
        raw = raw - raw.mean(0)
        out[got["bucket"].to_numpy()] = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
    return out


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """docs: (id, t). (id, x): the document vector."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # VOCABULARY x SIZE floats

    def run(batches):
        buckets = Buckets()
        for b in batches:
            rows = []
            for t in b["t"]:
                seen, times = np.unique(ids_of(t, buckets), return_counts=True)
                n = max(times.sum(), 1)
                mean = times @ shared.value[seen] / n
                rows.append(np.append(mean, (np.log1p(n) / 10, np.log(np.linalg.norm(mean) + 1e-3), np.log(max(len(seen), 1) / n))).astype("float32"))
            yield pd.DataFrame({"id": b["id"], "x": rows})

    small_batches(docs.sparkSession)
    return docs.mapInPandas(run, f"id {dict(docs.dtypes)['id']}, x array<float>")


class Network:
    """One hidden layer of tanh units; probabilities at a temperature."""

    def __init__(self, size: int, hidden: int = 24, seed: int = 3):
        random = np.random.default_rng(seed)
        self.w1, self.b1 = random.normal(0, 1 / np.sqrt(size), (size, hidden)), np.zeros(hidden)
        self.w2, self.b2, self.temperature = random.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1), 1.0
        self.mean, self.scale = np.zeros(size), np.ones(size)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-3, seed: int = 5) -> Network:
        random = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        weights = [self.w1, self.b1, self.w2, self.b2]
        m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for rows in np.array_split(order, max(1, len(x) // 128)):
                h = np.tanh(x[rows] @ self.w1 + self.b1)
                d = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2[0], -30, 30))) - y[rows]) / len(rows)
                dh = np.outer(d, self.w2) * (1 - h * h)
                step += 1
                for k, g in enumerate((x[rows].T @ dh + decay * self.w1, dh.sum(0), h.T @ d + decay * self.w2, np.array([d.sum()]))):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Network:
        logits = self.logits(x)
        loss = lambda t: np.logaddexp(0, -np.where(y > 0, 1, -1) * logits / t).mean()
        self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
        return self


def fitted(vectors: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """vectors: (id, x). Trained on at most `rows` labelled rows, none of the held-out quarter; a fifth of them calibrates."""
    known = labelled(labels, "quality", rows, 4, 2)
    # rows that share an id are one row here, the least of them, or the sample would have no bound
    found = vectors.join(F.broadcast(known), vectors["id"] == known["doc_id"]).groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    got = found.toPandas().sort_values("id", kind="stable")
    y = (got["y"].to_numpy() > 0).astype(float)
    if len(y) < 20 or y.min() == y.max():
        return None
    x = np.stack(got["x"].to_numpy()).astype(float)
    held = np.random.default_rng(1).permutation(len(y)) < len(y) // 5
    return Network(x.shape[1]).fit(x[~held], y[~held]).calibrate(x[held], y[held])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    vectors = written(pooled(rows, word_vectors(rows.select("t"))))
    network = fitted(vectors, labels)
    if network is None:
        return vectors.select("id", F.lit(0.5).alias("score"))

    @F.pandas_udf("double")
    def probability(x: pd.Series) -> pd.Series:
        return pd.Series(network.probability(np.stack(x.to_numpy()).astype(float)) if len(x) else [], dtype="float64")

    return vectors.select("id", probability("x").alias("score"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
