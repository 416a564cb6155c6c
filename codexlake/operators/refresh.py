"""Budgeted refresh: which items are built, rebuilt, taken from the cache or served stale.

A row that needs the builder (no cache yet, or another version than the cached one) takes from the budget in the order of
pos; first builds are always done but count. The order is by pos, so the result does not depend on scheduling. One running
number over the callers decides; within a partition (a shelf, a source), never over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import least_items, numbered


def decide(items: DataFrame, partition: list[str], limit: int, pos: str = "pos", cached: str = "cached", version: str = "version", refresh: str = "refresh", failed: str | None = None, rows_a_bucket: int = 1_000_000) -> DataFrame:
    """pos is a number; callers are numbered in buckets of rows_a_bucket positions, so that a shelf may be of any size.

    items: cached (version in the cache or null), version (the source's), refresh (asked for). Adds calls, action, deferred.

    action: build, cached, rebuild, stale; with a failed column stale_after_failure and failed as well.
    """
    first = F.col(cached).isNull()
    changed = ~first & F.col(refresh) & ~F.col(cached).eqNullSafe(F.col(version))
    out = numbered(items.withColumn("calls", first | changed), [*partition, "calls"], [pos], "_k", F.floor(F.col(pos) / rows_a_bucket))
    over = F.col("calls") & (F.col("_k") > limit)
    action = F.when(first, "build").when(~F.col("calls"), "cached").when(over, "stale").otherwise("rebuild")
    if failed:
        action = F.when(action.isin("build", "rebuild") & F.coalesce(F.col(failed), F.lit(False)), F.when(first, "failed").otherwise("stale_after_failure")).otherwise(action)
    return out.withColumns({"action": action, "deferred": over & ~first}).drop("_k")


def totals(decided: DataFrame, partition: list[str], limit: int) -> DataFrame:
    """(partition, used, n_deferred, deferred): budget used and the first ten deferred items by pos."""
    counts = decided.groupBy(*partition).agg(F.least(F.lit(limit), F.count_if("calls")).cast("int").alias("used"), F.count_if("deferred").alias("n_deferred"))
    shown = least_items(decided.where("deferred"), partition, "pos", 10, "deferred")
    return counts.join(shown, partition, "left").withColumn("deferred", F.coalesce("deferred", F.array().cast(shown.schema["deferred"].dataType)))
