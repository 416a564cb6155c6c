"""Feed files: reading Atom feeds into rows, rendering rows into feeds, writing them one file a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_html, iso_utc
from ..operators.graph import entry_kind

FEED = "id STRING, title STRING, updated STRING, link ARRAY<STRUCT<_rel: STRING, _type: STRING, _href: STRING>>, entry ARRAY<STRUCT<id: STRING, title: STRING, link: ARRAY<STRUCT<_rel: STRING, _type: STRING, _href: STRING>>>>"


def read_feeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(feeds, rows): feeds (feed, id, title, up, prev, next), rows (feed, pos, title, kind, href); feed is the file's path."""
    raw = spark.read.format("xml").option("rowTag", "feed").option("recursiveFileLookup", "true").schema(FEED).load(path).withColumn("feed", F.input_file_name())
    link = lambda rel: F.element_at(F.filter("link", lambda x: x["_rel"] == rel), -1)["_href"]
    pick = lambda rel: F.when(F.exists("link", lambda x: x["_rel"] == rel), link(rel))
    feeds = raw.select("feed", "id", "title", pick("up").alias("up"), pick("previous").alias("prev"), pick("next").alias("next"))
    rows = raw.select("feed", F.posexplode("entry").alias("pos", "e"))
    plain = F.transform("e.link", lambda x: F.struct(x["_rel"].alias("rel"), x["_type"].alias("type"), x["_href"].alias("href")))
    kinds = rows.select("feed", F.col("pos").cast("long").alias("pos"), "e.title", entry_kind(plain).alias("k"))
    return feeds, kinds.select("feed", "pos", "title", "k.kind", "k.href")


def render(feeds: DataFrame, entries: DataFrame) -> DataFrame:
    """feeds: (path, feed_id, title, updated, links array<struct<rel, type, href>>); entries: (path, pos, xml). (path, xml)."""
    body = entries.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "xml"))), lambda e: e["xml"]), "").alias("body"))
    links = F.array_join(F.transform("links", lambda x: F.concat(F.lit('<link rel="'), escape_html(x["rel"]), F.lit('" type="'), escape_html(x["type"]), F.lit('" href="'), escape_html(x["href"]), F.lit('"/>'))), "")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom"><id>'), escape_html("feed_id"), F.lit("</id><title>"), escape_html("title"),
        F.lit("</title><updated>"), iso_utc("updated"), F.lit("</updated>"), links, F.coalesce("body", F.lit("")), F.lit("</feed>"),
    )
    return feeds.join(body, "path", "left").select("path", xml.alias("xml"))


def entry_xml(entry_id, title, updated, content, rel, kind, href):
    part = lambda tag, c: F.concat(F.lit(f"<{tag}>"), escape_html(c), F.lit(f"</{tag}>"))
    return F.concat(F.lit("<entry>"), part("id", entry_id), part("title", title), part("updated", iso_utc(updated)), part("content", content), F.lit('<link rel="'), escape_html(rel), F.lit('" type="'), escape_html(kind), F.lit('" href="'), escape_html(href), F.lit('"/></entry>'))


def write_tree(pages: DataFrame, folder: str) -> None:
    """Each (path, xml) row as the file of that path below a folder, written by the tasks to a folder that all of them share.

    A file is written under another name and renamed, so a task that is tried again leaves whole files only.
    """
    local = folder.removeprefix("file://") if folder.startswith("file://") or "://" not in folder else None
    if local is None:
        raise ValueError("write_tree writes to a mounted folder; for object stores use write_pages and copy by its manifest")

    def put(rows) -> None:
        import os
        import uuid

        for r in rows:
            path = os.path.join(local, r["path"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            part = f"{path}.{uuid.uuid4().hex}.part"
            with open(part, "w", encoding="utf-8") as f:
                f.write(r["xml"])
            os.replace(part, path)

    pages.select("path", "xml").foreachPartition(put)


def write_pages(pages: DataFrame, folder: str) -> None:
    """Each (path, xml) row as one file of a folder, written by the tasks through a text sink partitioned by path."""
    pages.select(F.col("path"), F.col("xml").alias("value")).write.mode("overwrite").partitionBy("path").text(folder)


def write_lines(lines: DataFrame, order: list[str], column: str, folder: str) -> None:
    """Lines as a text in order: the part files of the folder, one behind the other, are the text."""
    lines.orderBy(*order).select(F.col(column).alias("value")).write.mode("overwrite").option("lineSep", "").text(folder)


def write_report(rows: DataFrame, path: str) -> None:
    """The build report as JSON lines; the folder is overwritten as a whole."""
    rows.write.mode("overwrite").json(path)
