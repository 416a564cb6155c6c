"""Secret scans with multipart credential linking.

Base patterns find assignments, access key ids and long hex strings in each whole text. Beside them there are weak
candidates: identifiers (user names, client ids), loose secrets (long strings of high entropy) and endpoints (urls,
host settings). An interval join within a text links parts whose spans lie at most SCOPE code points apart; a weak
candidate is reported only if its scope holds complementary parts: a secret together with an identifier or an endpoint.
Base spans always stay and count as secrets (assign, hex) or identifiers (access).

Defined results: a null text is empty and has no spans; repeated rows each get their result; offsets are code points,
ends exclusive; a match that fails its length is dropped and its characters are not scanned again for that kind; texts
of any length are scanned whole.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import small_batches, table

SCOPE = 200
ENTROPY = 3.6
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_IDENTIFIER = re.compile(r"""\b(?:user(?:name|_id)?|login|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
_ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+]{1,15}://[^\s"'<>]{4,}|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::\d+)?)""", re.A)
_LOOSE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def weak_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out = [(*m.span(), "identifier") for m in _IDENTIFIER.finditer(text)] if ":" in text or "=" in text else []
    out += [(*m.span(), "endpoint") for m in _ENDPOINT.finditer(text)] if ":" in text or "=" in text else []
    taken = sorted((a, b) for a, b, _ in [*base, *out])
    reach = list(accumulate((b for _, b in taken), max))  # the furthest end of the spans up to each
    for m in _LOOSE.finditer(text):
        a, b = m.span()
        k = bisect.bisect_left(taken, (b,))  # spans that begin before b
        if k and reach[k - 1] > a:
            continue
        if re.search(r"\d", m[0]) and re.search(r"[A-Z]", m[0]) and re.search(r"[a-z]", m[0]) and entropy(m[0]) >= ENTROPY:
            out.append((a, b, "secret"))
    return out


_PART = {"assign": "secret", "hex": "secret", "secret": "secret", "access": "identifier", "identifier": "identifier", "endpoint": "endpoint"}


def linked(weak: list[tuple[int, int, str]], base: list[tuple[int, int, str]], scope: int = SCOPE) -> list[tuple[int, int, str]]:
    """The weak spans with a complementary part within scope, by one sorted interval list for each part."""
    starts: dict[str, list[int]] = {}
    reach: dict[str, list[int]] = {}
    for part in ("secret", "identifier", "endpoint"):
        own = sorted((a, b) for a, b, k in [*base, *weak] if _PART[k] == part)
        starts[part] = [a for a, _ in own]
        most, reach[part] = -1, []
        for _, b in own:
            most = max(most, b)
            reach[part].append(most)

    def near(a: int, b: int, part: str) -> bool:
        k = bisect.bisect_right(starts[part], b + scope)
        return k > 0 and reach[part][k - 1] >= a - scope

    out = []
    for a, b, kind in weak:
        other = ("identifier", "endpoint") if kind == "secret" else ("secret",)
        if any(near(a, b, part) for part in other):
            out.append((a, b, kind))
    return out


def spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans), each by start, then by KINDS."""
    text = text or ""
    base = base_spans(text)
    weak = weak_spans(text, base)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted([*base, *(linked(weak, base) if weak else [])], key=order)


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def redacted(text: str | None, found: list[tuple[int, int, str]]) -> str | None:
    """The text with every span but endpoints replaced by <secret>; overlapping spans are one."""
    if not text or not found:
        return text
    out, end = [], 0
    for a, b, kind in found:
        if kind == "endpoint":
            continue
        if a >= end:
            out += [text[end:a], "<secret>"]
        end = max(end, b)
    return "".join(out) + text[end:] if out else text


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base, spans) of every document; base and spans joined as kind:start:end."""

    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b["id"], b["t"]):
                base, every = spans(t)
                n = Counter(k for _, _, k in base)
                rows.append((i, *(n[k] for k in BASE), joined(base), joined(every)))
            yield pd.DataFrame(rows, columns=["id", "n_assign", "n_access", "n_hex", "base", "spans"]).astype({"id": b["id"].dtype})

    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInPandas(run, f"id {kind}, n_assign long, n_access long, n_hex long, base string, spans string")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the secrets of the text column masked; other columns as they are."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted(t, spans(t)[1]) if t else t)

    small_batches(docs.sparkSession)
    return docs.withColumn(text_col, mask(F.col(text_col)))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def base_sha256(text: str | None) -> str:
    return hashlib.sha256(joined(spans(text)[0]).encode()).hexdigest()
