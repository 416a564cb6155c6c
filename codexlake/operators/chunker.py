"""Greedy size-bounded chunking of a document's blocks, with a preference for headings.

The running size restarts with every chunk, so a plain window cannot express it; it is one aggregate() over the array of a
document's blocks. The state holds the current chunk only as its first block and size, and the finished ones as structs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = "array<struct<start:int,blocks:int,bytes:bigint>>"


def chunks(blocks: Column, limit: int, min_part: int, fold_below: int) -> Column:
    """blocks: array<struct<size, heading>> in order. array<struct<start, blocks, bytes>>; start counts from 0.

    A new chunk begins where the current one is not empty and either has min_part bytes and a heading follows, or would
    exceed limit. Chunks under fold_below at the end are folded into their predecessor, again and again.
    """
    size = lambda b: b["size"].cast("long")
    one = lambda start, n, z: F.struct(start.cast("int").alias("start"), n.cast("int").alias("blocks"), z.cast("long").alias("bytes"))

    def add(done: Column, block: Column) -> Column:
        last = F.element_at(done, F.greatest(F.size(done), F.lit(1)))
        fresh = (F.size(done) == 0) | (block["heading"] & (last["bytes"] >= min_part)) | (last["bytes"] + size(block) > limit)
        begin = F.when(F.size(done) == 0, F.lit(0)).otherwise(last["start"] + last["blocks"])
        grown = F.array_append(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), one(last["start"], last["blocks"] + 1, last["bytes"] + size(block)))
        return F.when(fresh, F.array_append(done, one(begin, F.lit(1), size(block)))).otherwise(grown)

    def fold(kept: Column, chunk: Column) -> Column:
        # from the back: while only small chunks have been met, they gather in the one before them
        tail = F.element_at(kept, F.greatest(F.size(kept), F.lit(1)))
        gather = (F.size(kept) == 1) & (tail["bytes"] < fold_below)
        return F.when(gather, F.array(one(chunk["start"], chunk["blocks"] + tail["blocks"], chunk["bytes"] + tail["bytes"]))).otherwise(F.array_append(kept, chunk))

    empty = F.array().cast(CHUNK)
    return F.reverse(F.aggregate(F.reverse(F.aggregate(blocks, empty, add)), empty, fold))


def chunked(rows: DataFrame, doc: str, pos: str, size: str, heading: str, limit: int = 280_000, min_part: int = 60_000, fold_below: int = 8_000) -> DataFrame:
    """(doc, part, start, blocks, bytes) of the documents whose blocks are rows."""
    blocks = F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(size).alias("size"), F.col(heading).alias("heading")))), lambda b: F.struct(b["size"].alias("size"), b["heading"].alias("heading")))
    per_doc = rows.groupBy(doc).agg(blocks.alias("blocks"))
    parts = per_doc.select(doc, F.posexplode(chunks(F.col("blocks"), limit, min_part, fold_below)).alias("part", "c"))
    return parts.select(doc, F.col("part").cast("int").alias("part"), "c.start", "c.blocks", "c.bytes")
