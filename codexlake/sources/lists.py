"""Curated book lists (YAML) with explicit schemas, and the cached downloads that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UK_SCHEMA = (
    "pos long, slug string, page string, title string, subtitle string, author string, author_died int, "
    "edition struct<city:string,publisher:string,year:int>, source_note string, genre string, pd_status string, us_only_edition boolean, "
    "strip_editorial boolean, strip_images boolean, exclude_pages array<string>, keep_note_markers array<string>, summary string, notes string, "
    "hold string, cover_title string, feed_title string"
)
EN_SCHEMA = (
    "pos long, slug string, se string, gutenberg int, title string, author string, author_sort string, author_died int, translator string, "
    "translator_died int, editor string, editor_died int, illustrator string, illustrator_died int, published int, category string, "
    "subject string, summary string, strip_images boolean, strip_images_reason string"
)
REQUIRED = {"uk": "slug title author edition summary".split(), "en": "slug title author author_sort category summary".split()}


def books_from_rows(spark: SparkSession, rows: list[dict], lang: str) -> DataFrame:
    """A curated list as a DataFrame; pos keeps the order of the list. A missing required field is an error."""
    schema = UK_SCHEMA if lang == "uk" else EN_SCHEMA
    names = [part.split()[0] for part in schema.replace("struct<city:string,publisher:string,year:int>", "struct").split(", ")]
    for k, row in enumerate(rows):
        lacking = [c for c in REQUIRED[lang] if row.get(c) is None]
        if lacking:
            raise ValueError(f"row {k} ({row.get('slug')}) lacks {', '.join(lacking)}")

    def value(row: dict, name: str):
        x = row.get(name)
        if name == "edition":
            return None if x is None else (x.get("city"), None if x.get("publisher") is None else str(x["publisher"]), x.get("year"))
        return x

    return spark.createDataFrame([tuple([k, *(value(row, c) for c in names[1:])]) for k, row in enumerate(rows)], schema)


def read_books(spark: SparkSession, text: str, lang: str, only: list[str] | None = None) -> DataFrame:
    """A curated YAML list. It is written by hand, so its size is a driver's matter; all that follows is distributed."""
    import yaml

    rows = yaml.safe_load(text) or []
    out = books_from_rows(spark, rows["books"] if isinstance(rows, dict) else rows, lang)
    return out.where(F.col("slug").isin(only)) if only else out


def all_books(uk: DataFrame, en: DataFrame) -> DataFrame:
    """Both lists in one table, in their order: lang, then pos."""
    return uk.withColumn("lang", F.lit("uk")).unionByName(en.withColumn("lang", F.lit("en")), allowMissingColumns=True)


def cached_files(spark: SparkSession, folder: str, pattern: str = "*.epub") -> DataFrame:
    """(slug, path, length, content, fetched) of a folder of downloads; select without content to leave the bytes unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("slug"), "path", "length", "content", F.col("modificationTime").alias("fetched"))


def with_archives(books: DataFrame, files: DataFrame) -> DataFrame:
    """books left-joined to their files; usable only where the bytes begin with the zip magic PK."""
    magic = F.coalesce(F.hex(F.substring("content", 1, 2)) == "504B", F.lit(False))
    return books.join(files.select("slug", "content"), "slug", "left").withColumn("usable", magic)


def revisions(books: DataFrame, answers: DataFrame) -> DataFrame:
    """answers: (slug, json) as cached. books with revid and rev_time; broken or missing answers are nulls."""
    parsed = answers.select("slug", F.from_json("json", "revid BIGINT, timestamp STRING").alias("r"))
    return books.join(parsed, "slug", "left").withColumns({"revid": F.col("r.revid"), "rev_time": F.try_to_timestamp("r.timestamp")}).drop("r")


def revision_of_answer(json):
    """struct(revid, timestamp) of a wiki API answer: the first page's first revision."""
    schema = "query STRUCT<pages: MAP<STRING, STRUCT<revisions: ARRAY<STRUCT<revid: BIGINT, timestamp: STRING>>>>>"
    pages = F.map_values(F.from_json(json, schema)["query"]["pages"])
    return F.get(F.get(pages, F.lit(0))["revisions"], F.lit(0))
