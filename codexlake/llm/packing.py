"""Packing of tokenized documents into sequences of fixed length, as a cutting-stock problem.

A document's ids are cut into full sequences and one rest. The rests' lengths make a histogram of CLASSES length classes
(rounded up to GRAIN); its size does not depend on the data, so one driver solves the linear program over patterns by
column generation: the basis starts with greedy patterns, a knapsack dynamic program prices new columns, and the
rounded-down solution plus a best-fit of the few rests left over becomes a list of (pattern, count). The documents' rests
are ranked within their class in two steps (salted buckets, then bucket offsets), so no class has to fit in one task, and
their rank says which instance of which pattern they belong to.

Defined results: a null or empty text is one piece with the end id alone; repeated rows are packed each; ties in rank fall
in any order, the sequences' contents stay valid; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import string
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import small_batches, table, written

LENGTH, GRAIN, END_ID = 2048, 8, 1
#: Distinct words whose ids a Python worker remembers, and the length up to which it does, which bounds their memory.
CACHE, REMEMBERED = 600_000, 64
_tokenizers: dict[str, tuple] = {}


#: Lines of small Latin letters with ASCII punctuation behind them (no apostrophe), which the tokenizer splits off in any case.
_LINES = re.compile(r"^([a-zß-öø-ÿ]+)([" + re.escape("".join(c for c in string.punctuation if c != "'")) + r"]*)$", re.M)
_END = np.array([END_ID], "<u4").tobytes()


class Known(dict):
    """Ids of words as bytes. A missing word is noted with a place that is filled when it is learned."""

    def __init__(self):
        super().__init__()
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        self[word] = self.new[word] = place = bytearray()
        return place


class Tokens:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer lower-cases, drops white space, never joins over it, and parts letters from punctuation; so texts are
    encoded space by space, a word apart from punctuation behind it, and the ids of what has been met are remembered.
    Texts with a control string, or with a capital sigma (whose small form depends on its place), are not lower-cased ahead.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), Known()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self) -> list[str]:
        """Learns the noted words, fills their places and returns those that are too long to be kept.

        Letter runs are one word each, so they go through the tokenizer in long texts and are parted where words end.
        """
        new, self.known.new = self.known.new, {}
        letters, tailed = {}, {}
        for word, tail in _LINES.findall("\n".join(new)):  # no word has a line feed
            if not tail:
                letters[word] = None
            elif "<|" not in tail:
                tailed[word + tail] = word, tail
        others = dict.fromkeys(p for p in new if p not in letters and p not in tailed)
        for word, tail in tailed.values():
            if word not in self.known:
                letters[word] = None
            if tail not in self.known:
                others[tail] = None
        runs, rest = list(letters), list(others)
        for i in range(0, len(runs), 2_000):
            some = runs[i : i + 2_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                rest += some
                continue
            data, at = ids.tobytes(), 0
            for p, end in zip(some, (4 * ends).tolist()):
                self.known[p] = data[at:end]
                at = end
        for i in range(0, len(rest), 20_000):
            some = rest[i : i + 20_000]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[p] = np.array(e.ids, "<u4").tobytes()
        for p, (word, tail) in tailed.items():
            self.known[p] = self.known[word] + self.known[tail]
        for p, place in new.items():
            place += self.known[p]
        return [p for some in (new, letters, others) for p in some if len(p) > REMEMBERED]

    def batch(self, texts: list[str | None]) -> list[bytes]:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        rows = []
        for t in texts:
            t = t or ""
            t = t if "<|" in t or "Σ" in t else t.lower()
            rows.append(list(map(known.__getitem__, t.replace("\n", " ").split(" "))))
        long = self._learn()
        out = [b"".join(ids) + _END for ids in rows]
        for p in long:
            known.pop(p, None)
        return out


def pieces(docs: DataFrame, path: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the documents' full pieces and rests."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _tokenizers:
            _tokenizers[path] = Tokens(path)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for b in batches:
            rows = []
            for i, ids in zip(b["doc_id"], _tokenizers[path].batch(list(b["t"]))):
                view = memoryview(ids)
                for at in range(0, len(ids), 4 * length):
                    part = view[at : at + 4 * length]
                    rows.append((i, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": b["doc_id"].dtype})

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).mapInPandas(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The best pattern of the priced sizes: unbounded knapsack by dynamic programming."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        n = int(np.searchsorted(sizes, w, side="right"))
        best[w], choice[w] = best[w - 1], -1
        if n:
            found = values[:n] + best[w - sizes[:n]]
            k = int(found.argmax())
            if found[k] > best[w] + 1e-12:
                best[w], choice[w] = found[k], k
    pattern, w = np.zeros(len(sizes), int), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= int(sizes[choice[w]])
    return float(best[room]), pattern


def triangular_inverse(u: np.ndarray) -> np.ndarray:
    """The inverse of an upper triangular matrix, from the last row up.

    Without linear algebra routines: their thread pool does not survive the fork that starts a JVM in the same process.
    """
    out = np.eye(len(u))
    for i in range(len(u) - 1, -1, -1):
        out[i] = (out[i] - (u[i, i + 1 :, None] * out[i + 1 :]).sum(0)) / u[i, i]
    return out


def column_generation(sizes: np.ndarray, counts: np.ndarray, room: int, gap: float = 1e-4, steps: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, in real numbers: a basic solution within gap of the bound."""
    m = len(sizes)
    # start: from the largest size down as many of it as fit, topped up with smaller sizes of which enough are left; the
    # matrix is triangular and the solution not negative
    columns, left, x = np.zeros((m, m)), counts.astype(float).copy(), np.zeros(m)
    for i in range(m - 1, -1, -1):
        columns[i, i] = room // sizes[i]
        x[i], free = left[i] / columns[i, i], room % sizes[i]
        left[i] = 0
        for j in range(min(i, int(np.searchsorted(sizes, free, side="right"))) - 1, -1, -1):
            if sizes[j] <= free and left[j] >= x[i]:
                columns[j, i] = 1
                left[j] -= x[i]
                free -= sizes[j]
    inverse = triangular_inverse(columns)
    for _ in range(steps):
        prices = inverse.sum(0)
        value, pattern = knapsack(prices, sizes, room)
        if value <= 1 + gap:  # the total divided by value is a lower bound
            break
        d = (inverse * pattern).sum(1)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        if not np.isfinite(ratio[r]):
            break
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        columns[:, r] = pattern
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
    return columns.astype(int).reshape(m, -1), x


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (size to multiplicity) with their counts, which use every item of the histogram exactly once."""
    whole = [({room: 1}, histogram[room])] if histogram.get(room) else []
    sizes = np.array(sorted(s for s in histogram if s < room and histogram[s]), int)
    if not len(sizes):
        return whole
    left = np.array([histogram[int(s)] for s in sizes])
    columns, x = column_generation(sizes, left.astype(float), room)
    out = []
    for k in np.argsort(-x):
        a = columns[:, k]
        n = int(min(np.floor(x[k] + 1e-9), *(left[a > 0] // a[a > 0])))
        if n > 0:
            left = left - n * a
            out.append(({int(sizes[i]): int(a[i]) for i in np.flatnonzero(a)}, n))
    bins: list[tuple[dict[int, int], int]] = []
    free = np.zeros(int(left.sum()), int)
    for i in range(len(sizes) - 1, -1, -1):  # best fit of the rests, large ones first
        for _ in range(int(left[i])):
            fits = np.flatnonzero(free[: len(bins)] >= sizes[i])
            if len(fits):
                k = int(fits[free[fits].argmin()])
            else:
                k = len(bins)
                bins.append(({}, 1))
                free[k] = room
            free[k] -= sizes[i]
            bins[k][0][int(sizes[i])] = bins[k][0].get(int(sizes[i]), 0) + 1
    return whole + out + bins


def segments(chosen: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, rank behind the last, multiplicity, first sequence id) of every class in every pattern."""
    out, base, used = [], 0, {}
    for pattern, n in chosen:
        for size, k in pattern.items():
            at = used.get(size, 0)
            out.append((size, at, at + n * k, k, base))
            used[size] = at + n * k
        base += n
    return out


def pack_pieces(cut: DataFrame, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Adds sequence_id and offset to pieces; cut is read several times, so it should be a written table."""
    spark = cut.sparkSession
    classed = cut.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["class"]: r["count"] for r in classed.groupBy("class").count().collect()}  # length / grain rows at most
    chosen = segments(plan(histogram, length // grain))
    # at most a few segments for each of length / grain classes and patterns, whatever the number of documents
    table_ = spark.createDataFrame(chosen or [(0, 0, 0, 1, 0)], "class int, lo long, hi long, times long, base long")
    buckets = max(512, -(-max(histogram.values(), default=0) // 5000))
    salted = classed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    sizes = salted.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("row", F.row_number().over(within)).join(starts, ["class", "bucket"]).withColumn("rank", F.col("ahead") + F.col("row") - 1)
    placed = ranked.join(F.broadcast(table_), "class").where("rank >= lo AND rank < hi").withColumn("sequence_id", (F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("times"))).cast("long"))
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long")).select(*cut.columns, "sequence_id", "offset")


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most `length` ids."""
    return pack_pieces(written(pieces(docs, path or public_path(), length)), length)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
