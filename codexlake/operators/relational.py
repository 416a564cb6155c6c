"""Grouping, paging, window-like and set operators. Input order is a column (pos); nothing relies on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _c

PAGE = 50


def keep_first(rows: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Of the rows of each key the first by pos; ties by the whole row. One shuffle with partial minima, no sort."""
    rest = [c for c in rows.columns if c not in (*keys, pos)]
    first = rows.groupBy(*keys).agg(F.min(F.struct(pos, *rest)).alias("_r"))
    return first.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in (pos, *rest)]).select(rows.columns)


def first_seen_groups(rows: DataFrame, key: str, firsts: list[str], pos: str = "pos") -> DataFrame:
    """One row a group: the group's first values of the columns in firsts, its count and its first pos."""
    return rows.groupBy(key).agg(*[F.min_by(c, pos).alias(c) for c in firsts], F.count("*").alias("n"), F.min(pos).alias("first_pos"))


def numbered(rows: DataFrame, partition: list[str], order: list, name: str = "rn", bucket: Column | None = None) -> DataFrame:
    """Adds the row number within the partition, from 1.

    bucket: a coarse key that never falls along the order (a prefix or a quotient of its first column), for partitions that
    may be too large for one task: rows are numbered within buckets, and a bucket begins behind those before it, whose
    counts are added up. One more pass, and no task sorts more than a bucket.
    """
    if bucket is None:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    inside = rows.withColumn("_bucket", bucket)
    ahead = inside.groupBy(*partition, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.withColumn("_ahead", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in (*partition, "_bucket")]
    joined = inside.alias("_l").join(ahead.alias("_r"), same).select("_l.*", "_r._ahead")
    return joined.withColumn(name, (F.row_number().over(Window.partitionBy(*partition, "_bucket").orderBy(*order)) + F.col("_ahead")).cast("int")).drop("_bucket", "_ahead")


def paged(rows: DataFrame, partition: list[str], order: list, size: int = PAGE, bucket: Column | None = None) -> DataFrame:
    """Adds page, pages, slot, prev_page and next_page. Partitions are feeds; bucket, as in numbered, is for large ones."""
    if bucket is None:
        out = numbered(rows, partition, order, "_rn").withColumn("_n", F.count("*").over(Window.partitionBy(*partition)))
    else:
        counts = rows.groupBy(*partition).agg(F.count("*").alias("_n"))
        same = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in partition]
        out = numbered(rows, partition, order, "_rn", bucket).alias("_l").join(counts.alias("_r"), same).select("_l.*", "_r._n")
    page = (F.floor((F.col("_rn") - 1) / size) + 1).cast("int")
    pages = F.greatest(F.lit(1), F.ceil(F.col("_n") / size)).cast("int")
    out = out.withColumns({"page": page, "pages": pages, "slot": ((F.col("_rn") - 1) % size + 1).cast("int")})
    return out.withColumns({"prev_page": F.when(F.col("page") > 1, F.col("page") - 1), "next_page": F.when(F.col("page") < F.col("pages"), F.col("page") + 1)}).drop("_rn", "_n")


def least_items(rows: DataFrame, keys: list[str], value: str, most: int = 10, name: str = "items") -> DataFrame:
    """(keys, name): the least values of each group in order, null ones left out. Ranks are pruned before the shuffle, and
    only `most` values of a group are gathered."""
    ranked = rows.where(F.col(value).isNotNull()).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(value))).where(F.col("_k") <= most)
    return ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def feed_pages(feeds: DataFrame, entries: DataFrame, key: str, size: int = PAGE) -> DataFrame:
    """(key, page, pages, n, prev, next) of every page of every feed; a feed without entries has one empty page."""
    counted = feeds.join(entries.groupBy(key).count(), key, "left").withColumn("n", F.coalesce("count", F.lit(0)))
    pages = F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("int")
    out = counted.withColumn("pages", pages).withColumn("page", F.explode(F.sequence(F.lit(1), "pages"))).drop("count")
    return out.withColumns({"prev": F.when(F.col("page") > 1, F.col("page") - 1), "next": F.when(F.col("page") < F.col("pages"), F.col("page") + 1)})


def page_title(title, page, pages) -> Column:
    suffix = F.format_string(" (%d/%d)", _c(page), _c(pages))
    return F.concat(_c(title), F.when(_c(pages) > 1, suffix).otherwise(""))


def page_path(path, page) -> Column:
    return F.concat(_c(path), F.when(_c(page) > 1, F.concat(F.lit("-"), _c(page).cast("string"))).otherwise(""), F.lit(".xml"))


def control_break(rows: DataFrame, partition: list[str], order: list, group: str, name: str = "starts") -> DataFrame:
    """True where the group differs from the row before (nulls are values of their own)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn(name, (F.row_number().over(w) == 1) | ~F.lag(group).over(w).eqNullSafe(F.col(group)))


def drop_consecutive(rows: DataFrame, partition: list[str], order: list, keys: list[str]) -> DataFrame:
    """Without rows whose keys equal those of the row right before."""
    w = Window.partitionBy(*partition).orderBy(*order)
    same = F.lag(F.struct(*keys)).over(w).eqNullSafe(F.struct(*keys)) & (F.row_number().over(w) > 1)
    return rows.withColumn("_same", same).where(~F.col("_same")).drop("_same")


def islands(rows: DataFrame, partition: list[str], order: list, breaks: Column, name: str = "island") -> DataFrame:
    """Numbers runs of neighbouring rows; a row where breaks holds begins a new one."""
    w = Window.partitionBy(*partition).orderBy(*order)
    start = (breaks | (F.row_number().over(w) == 1)).cast("int")
    return rows.withColumn("_b", start).withColumn(name, F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def first_occurrence_number(rows: DataFrame, partition: list[str], value: str, pos: str, name: str = "number") -> DataFrame:
    """1, 2, 3 … in the order in which values first occur within a partition."""
    first = F.min(pos).over(Window.partitionBy(*partition, value))
    return rows.withColumn("_first", first).withColumn(name, F.dense_rank().over(Window.partitionBy(*partition).orderBy("_first", value))).drop("_first")


def grid(rows: DataFrame, partition: list[str], order: list, columns: int) -> DataFrame:
    out = numbered(rows, partition, order, "_rn").withColumns({"row": F.floor((F.col("_rn") - 1) / columns).cast("int"), "column": ((F.col("_rn") - 1) % columns).cast("int")})
    return out.drop("_rn")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).count().where("count > 1").select(key, F.col("count").alias("n"))


def missing(rows: DataFrame, known: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """The rows whose keys are not among the known ones (null keys are missing)."""
    condition = [rows[a] == known[b] for a, b in keys]
    return rows.join(known, condition, "left_anti")


def prefix_join(rows: DataFrame, roots: DataFrame, key: str, root: str) -> DataFrame:
    """rows whose key equals a root or begins with root and a slash.

    A theta join would pair every row with every root, so the prefixes of a key are exploded (as many as it has slashes) and
    joined by equality.
    """
    parts = F.split(key, "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    exploded = rows.withColumn("_prefix", F.explode_outer(prefixes))
    return exploded.join(roots, exploded["_prefix"] == roots[root]).drop("_prefix")


def merge_last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Of the rows of a key the one with the greatest seq."""
    rest = [c for c in rows.columns if c not in (key, seq)]
    last = rows.groupBy(key).agg(F.max(F.struct(seq, *rest)).alias("_r"))
    return last.select(key, *[F.col(f"_r.{c}").alias(c) for c in (seq, *rest)]).select(rows.columns)


def apply_renames(text, renames) -> Column:
    """renames: array<struct<old, new>>, applied in order."""
    return F.aggregate(renames, _c(text), lambda t, r: F.replace(t, r["old"], r["new"]))


def reason_text(errors, most: int = 10, by: str = "; ") -> Column:
    return F.array_join(F.slice(_c(errors), 1, most), by)


def first_titles(titles, most: int = 5) -> Column:
    return F.concat(F.array_join(F.slice(_c(titles), 1, most), ", "), F.when(F.size(_c(titles)) > most, "…").otherwise(""))
