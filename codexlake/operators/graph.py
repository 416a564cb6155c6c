"""Reachability over links between feeds: breadth-first with depths, typed rows and a scripted walk."""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import checkpointed


def entry_kind(links: Column) -> Column:
    """struct(kind, href) of an entry's links (array<struct<rel, type, href>>): the last feed link makes it NAV, else an
    acquisition link to an EPUB makes it BOOK."""
    nav = F.filter(links, lambda x: F.contains(x["type"], F.lit("application/atom+xml")))
    book = F.filter(links, lambda x: F.contains(x["rel"], F.lit("opds-spec.org/acquisition")) & (x["type"] == "application/epub+zip"))
    return F.when(F.size(nav) > 0, F.struct(F.lit("NAV").alias("kind"), F.element_at(nav, -1)["href"].alias("href"))).when(F.size(book) > 0, F.struct(F.lit("BOOK").alias("kind"), F.element_at(book, 1)["href"].alias("href")))


def with_page_rows(rows: DataFrame, feeds: DataFrame) -> DataFrame:
    """rows: (feed, pos, kind, href); feeds: (feed, prev, next). The link to the previous page comes first, to the next last."""
    before = feeds.where("prev IS NOT NULL").select("feed", F.lit(-1).cast("long").alias("pos"), F.lit("NAV").alias("kind"), F.col("prev").alias("href"))
    after = feeds.where("next IS NOT NULL").select("feed", F.lit(2**31).cast("long").alias("pos"), F.lit("NAV").alias("kind"), F.col("next").alias("href"))
    return rows.select("feed", F.col("pos").cast("long").alias("pos"), "kind", "href").unionByName(before).unionByName(after)


def reachable(edges: DataFrame, roots: DataFrame, most: int | None = None) -> DataFrame:
    """edges: (src, dst); roots: (node). (node, depth) of all nodes reachable, depth the least number of steps.

    One anti-join with the visited nodes for each level, until a level is empty; `most` bounds the depth where that is the
    question. The frontier is checkpointed each time and the visited nodes every eighth, so plans stay short.
    """
    links = checkpointed(edges.where("src IS NOT NULL AND dst IS NOT NULL").distinct())
    frontier = checkpointed(roots.select("node").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    for level in count(1) if most is None else range(1, most + 1):
        step = links.join(frontier, links["src"] == frontier["node"], "left_semi").select(F.col("dst").alias("node")).distinct()
        frontier = checkpointed(step.join(visited, "node", "left_anti").withColumn("depth", F.lit(level)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
        if level % 8 == 0:
            visited = checkpointed(visited)
    return visited


def crawl(rows: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """rows: (feed, pos, kind, href). The reached feeds (feed, depth) and the books with the reached feeds that list them."""
    spark = rows.sparkSession
    nav = rows.where("kind = 'NAV'").select(F.col("feed").alias("src"), F.col("href").alias("dst"))
    feeds = reachable(nav, spark.sql("SELECT :root AS node", args={"root": root})).withColumnRenamed("node", "feed")
    books = rows.where("kind = 'BOOK'").join(feeds, "feed", "left_semi").groupBy("href").agg(F.array_sort(F.collect_set("feed")).alias("feeds"))
    return feeds, books


def crawl_totals(rows: DataFrame, root: str, expected: int | None = None) -> DataFrame:
    """One row: feeds, max_depth, nav_rows, book_rows and unique_books of the reached feeds, and as_expected: whether the
    books are as many as expected (null: nothing expected)."""
    feeds, books = crawl(rows, root)
    own = rows.join(feeds, "feed", "left_semi").agg(F.count_if(F.col("kind") == "NAV").alias("nav_rows"), F.count_if(F.col("kind") == "BOOK").alias("book_rows"))
    return (
        feeds.agg(F.count("*").alias("feeds"), F.max("depth").alias("max_depth"))
        .crossJoin(own)
        .crossJoin(books.agg(F.count("*").alias("unique_books")))
        .withColumn("as_expected", F.col("unique_books") == F.lit(expected).cast("long"))
    )


def walk(rows: DataFrame, root: str, steps: int = 12) -> DataFrame:
    """(step, feed, kind, href): at each feed the first book ends the walk, else the first navigation row that is no page link
    is followed, at most `steps` times."""
    own = rows.where("pos >= 0 AND pos < 2147483648")
    best = own.groupBy("feed").agg(F.min_by("href", F.when(F.col("kind") == "BOOK", F.col("pos"))).alias("book"), F.min_by("href", F.when(F.col("kind") == "NAV", F.col("pos"))).alias("nav"), F.count_if(F.col("kind") == "BOOK").alias("books"))
    best = best.select("feed", F.when(F.col("books") > 0, "BOOK").otherwise("NAV").alias("kind"), F.when(F.col("books") > 0, F.col("book")).otherwise(F.col("nav")).alias("href"))
    view = f"walk_{uuid.uuid4().hex}"  # of its own, for walks may run at one time
    best.createOrReplaceTempView(view)
    out = rows.sparkSession.sql(
        f"""WITH RECURSIVE w(step, feed, kind, href) MAX RECURSION LEVEL {steps + 2} AS (
          SELECT 1, feed, kind, href FROM {view} WHERE feed = :root
          UNION ALL
          SELECT w.step + 1, b.feed, b.kind, b.href FROM w JOIN {view} b ON w.kind = 'NAV' AND b.feed = w.href WHERE w.step < {steps})
        SELECT step, feed, kind, href FROM w""",
        args={"root": root},
    )
    rows.sparkSession.catalog.dropTempView(view)  # the plan holds what it needs
    return out


def back_stack(walked: DataFrame, rows: DataFrame) -> DataFrame:
    """walked: the rows of walk(). (step, feed, back, fine): the way back from the last feed to the root.

    Going back from a step leads to the feed of the step before it, which must list the feed it is left from; the root leads
    nowhere (back is null).
    """
    before = walked.select((F.col("step") + 1).alias("step"), F.col("feed").alias("back"))
    listed = rows.where("kind = 'NAV'").select(F.col("feed").alias("back"), F.col("href").alias("feed"), F.lit(True).alias("listed")).distinct()
    out = walked.select("step", "feed").join(before, "step", "left").join(listed, ["back", "feed"], "left")
    return out.select("step", "feed", "back", F.when(F.col("back").isNull(), F.col("step") == 1).otherwise(F.coalesce("listed", F.lit(False))).alias("fine"))
