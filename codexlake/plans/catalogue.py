"""The catalogue: from books to feeds, their entries and pages.

books: (lang, pos, slug, title, author, author_sort, author_died, genre, category, subject, summary, edition, source_note,
translator, se, gutenberg, published, feed_title, size, updated, source_url); columns of the other language are null.
Everything is keyed by feed path; paging is a window over one feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import collation as K
from ..functions import text as X
from ..operators import relational as R

ACQ = "application/atom+xml;profile=opds-catalog;kind=acquisition"
NAV = "application/atom+xml;profile=opds-catalog;kind=navigation"
RESERVED = ["index", "fiction", "nonfiction"]
CATEGORIES = ("fiction", "non-fiction")
ROWS_A_BUCKET = 100_000


def is_uk() -> Column:
    return ~F.col("lang").eqNullSafe("en")


def with_keys(books: DataFrame) -> DataFrame:
    """Adds display name, author slug and the collation keys. Keys of both languages are arrays of numbers."""
    display = F.when(is_uk(), K.author_display("author")).otherwise(X.first_present("author_sort", "author"))
    codes = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x))
    key = lambda c: F.when(is_uk(), K.uk_key(c)).otherwise(codes(K.en_key(c)))
    out = books.withColumn("display", display)
    return out.withColumns({"author_key": key(F.col("display")), "title_key": key(F.col("title")), "author_slug": K.slugify("display"), "genre_name": X.first_present("genre", F.lit(K.OTHER_GENRE[0]))})


def author_groups(books: DataFrame) -> DataFrame:
    """One row an author and language: first seen name, slug and year of death, number of books, latest update."""
    return with_keys(books).groupBy("lang", "display").agg(
        F.min_by("author", "pos").alias("name"), F.min_by("author_slug", "pos").alias("slug"), F.min_by("author_died", "pos").alias("died"),
        F.min_by("author_key", "pos").alias("key"), F.count("*").alias("n"), F.max("updated").alias("latest"), F.min("pos").alias("first_pos"),
    )


def slug_collisions(groups: DataFrame) -> DataFrame:
    """(lang, slug) that two authors share or that is reserved."""
    reserved = F.col("slug").isin(RESERVED + [f"genre-{s}" for s in (*K.GENRES.values(), K.OTHER_GENRE[1])])
    return groups.groupBy("lang", "slug").count().where((F.col("count") > 1) | reserved).select("lang", "slug", F.col("count").alias("n"))


def shelves(books: DataFrame) -> DataFrame:
    """(path, lang, shelf, label, slot order..., book pos): every feed of books with its books.

    A book stands on its genre's or category's shelf, its author's and in the list of all: one explode, no join.
    """
    b = with_keys(books)
    genre = F.struct(F.concat(F.lit("opds/uk/genre-"), K.genre_slug("genre")).alias("path"), F.lit("genre").alias("shelf"), F.col("genre_name").alias("label"))
    category = F.struct(F.concat(F.lit("opds/en/"), F.replace("category", F.lit("-"), F.lit(""))).alias("path"), F.lit("category").alias("shelf"), F.initcap("category").alias("label"))
    author = F.struct(F.concat(F.lit("opds/"), F.when(is_uk(), "uk/").otherwise("en/"), F.col("author_slug")).alias("path"), F.lit("author").alias("shelf"), F.col("author").alias("label"))
    everything = F.struct(F.lit("opds/all").alias("path"), F.lit("all").alias("shelf"), F.lit("all").alias("label"))
    first = F.when(is_uk(), genre).otherwise(category)
    return b.withColumn("_s", F.explode(F.array(first, author, everything))).select("*", "_s.path", "_s.shelf", "_s.label").drop("_s")


def shelf_pages(books: DataFrame, size: int = R.PAGE) -> DataFrame:
    """Every book on every shelf with its page and slot; shelves keep their own orders."""
    lang_order = F.when(is_uk(), 0).otherwise(1)
    none = F.array().cast("array<int>")
    by_author = F.when(F.col("shelf").isin("genre", "category"), F.col("author_key")).otherwise(none)
    by_title = F.when(F.col("shelf") != "all", F.col("title_key")).otherwise(none)
    # the list of all is as long as the library: buckets of positions there, of first letters on the other shelves
    leading, everything = F.when(F.col("shelf") == "author", by_title).otherwise(by_author), F.col("shelf") == "all"
    bucket = F.struct(F.slice(leading, 1, 3).alias("a"), F.when(everything, lang_order).otherwise(0).alias("b"), F.when(everything, F.floor(F.col("pos") / ROWS_A_BUCKET)).otherwise(0).cast("long").alias("c"))
    return R.paged(shelves(books), ["path"], [by_author, by_title, lang_order, F.col("pos")], size, bucket)


def genre_rows(books: DataFrame) -> DataFrame:
    g = with_keys(books).where(is_uk()).groupBy("genre_name").agg(F.count("*").alias("n"), F.max("updated").alias("latest"), F.min("pos").alias("first_pos"))
    return g.select(F.lit("opds/uk/index").alias("path"), F.lit(0).alias("section"), F.struct(K.genre_index("genre_name").alias("i"), F.col("first_pos").alias("p")).alias("order"), F.concat(F.col("genre_name"), F.lit(" · "), F.col("n").cast("string")).alias("title"),
                    F.concat(F.lit("opds/uk/genre-"), K.genre_slug("genre_name"), F.lit(".xml")).alias("href"), F.concat_ws(" ", F.col("n").cast("string"), X.uk_books_word("n")).alias("content"), "latest")


def category_rows(books: DataFrame) -> DataFrame:
    g = books.where(~is_uk() & F.col("category").isin(*CATEGORIES)).groupBy("category").agg(F.count("*").alias("n"), F.max("updated").alias("latest"))
    return g.select(F.lit("opds/en/index").alias("path"), F.lit(0).alias("section"), F.struct((F.col("category") != CATEGORIES[0]).cast("int").alias("i"), F.lit(0).cast("long").alias("p")).alias("order"), F.concat(F.initcap("category"), F.lit(" · "), F.col("n").cast("string")).alias("title"),
                    F.concat(F.lit("opds/en/"), F.replace("category", F.lit("-"), F.lit("")), F.lit(".xml")).alias("href"), F.concat(F.col("n").cast("string"), F.lit(" books")).alias("content"), "latest")


def author_rows(books: DataFrame) -> DataFrame:
    g = R.numbered(author_groups(books), ["lang"], ["key", "first_pos"], "rank", F.slice("key", 1, 3))
    rank = F.col("rank")
    word = F.when(is_uk(), X.uk_books_word("n")).otherwise(X.en_books_word("n"))
    folder = F.when(is_uk(), "opds/uk/").otherwise("opds/en/")
    return g.select(F.concat(folder, F.lit("index")).alias("path"), F.lit(1).alias("section"), F.struct(rank.alias("i"), F.col("first_pos").alias("p")).alias("order"), F.concat(F.col("display"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("title"),
                    F.concat(folder, F.col("slug"), F.lit(".xml")).alias("href"), F.concat(F.col("n").cast("string"), F.lit(" "), word, F.lit(" · "), X.died_label("died", "lang")).alias("content"), "latest")


def navigation(books: DataFrame, size: int = R.PAGE) -> DataFrame:
    """The rows of both index feeds: genres or categories first, then authors, paged."""
    rows = genre_rows(books).unionByName(category_rows(books)).unionByName(author_rows(books))
    bucket = F.struct("section", F.floor(F.col("order.i") / ROWS_A_BUCKET).alias("i"))
    return R.paged(rows, ["path"], ["section", "order"], size, bucket).withColumn("title", X.fit_bytes("title")).drop("order")


def root_rows(books: DataFrame) -> DataFrame:
    """Counts for the root feed, by language and overall, in one aggregation over grouping sets."""
    lang = F.when(is_uk(), "uk").otherwise("en")
    return (
        books.withColumn("l", lang).groupingSets([["l"], []], "l")
        .agg(F.count("*").alias("n"), F.count_if(F.col("category") == "fiction").alias("fiction"), F.sum("size").alias("bytes"), F.max("updated").alias("latest"))
        .select(F.coalesce("l", F.lit("all")).alias("lang"), "n", "fiction", "bytes", "latest")
    )


def book_entries(books: DataFrame, base: str) -> DataFrame:
    """The columns of a book's entry; the texts differ by language."""
    translated = F.when(X.is_translator("translator"), F.concat(F.lit(" Translated by "), F.col("translator"), F.lit("."))).otherwise("")
    origin = F.when(F.col("se").isNotNull(), "Standard Ebooks (CC0)").otherwise(F.concat(F.lit("Project Gutenberg #"), F.coalesce(F.col("gutenberg").cast("string"), F.lit(""))))
    source = X.source_line("source_note", F.col("edition.city"), F.col("edition.publisher"), F.col("edition.year"), "Вікіджерела")
    content = F.when(is_uk(), F.concat(F.col("summary"), F.lit(" Джерело тексту: "), source, F.lit(". Рік смерті автора: "), F.coalesce(F.col("author_died").cast("string"), F.lit("")), F.lit("."))).otherwise(
        F.concat(F.col("summary"), translated, F.lit(" Source: "), origin, F.lit(".")))
    issued = F.when(is_uk(), F.col("edition.year")).otherwise(F.when(F.col("published") > 0, F.col("published")))
    return books.select(
        "lang", "pos", "slug", F.concat(F.lit("urn:book:"), F.col("slug")).alias("id"), X.fit_bytes(X.first_present("feed_title", "title")).alias("title"), "author", X.iso_utc("updated").alias("updated"),
        issued.alias("issued"), F.when(is_uk(), F.col("genre")).otherwise(F.col("subject")).alias("category"), content.alias("content"),
        F.concat(F.lit(f"{base}books/"), F.col("slug"), F.lit(".epub")).alias("href"), "size", "source_url",
    )


def summary_lines(books: DataFrame) -> DataFrame:
    """(lang, position, slug, line): the lines of the Markdown summary, a heading wherever the genre or category changes.

    books may have release_ready and reasons, which make the last column. A line a row, so that no value grows with the
    library; the sink writes them by position.
    """
    status = F.when(F.col("release_ready"), "✅").otherwise(F.concat(F.lit("⏸ "), F.left(F.coalesce("reasons", F.lit("")), F.lit(160)))) if "release_ready" in books.columns else F.lit("✅")
    group = F.when(is_uk(), X.first_present("genre", F.lit(K.OTHER_GENRE[0]))).otherwise(F.when(F.col("category") == CATEGORIES[0], "Fiction").otherwise("Non-fiction"))
    keys = {
        "l": F.when(is_uk(), "uk").otherwise("en"), "g": group, "gi": F.when(is_uk(), K.genre_index("genre")).otherwise((F.col("category") != CATEGORIES[0]).cast("int")),
        "k": F.when(is_uk(), K.uk_key(K.surname("author"))).otherwise(F.transform(F.split(F.lower(X.first_present("author_sort", "author")), ""), lambda c: F.ascii(c))),
        "kt": F.when(is_uk(), K.uk_key("title")).otherwise(F.transform(F.split("title", ""), lambda c: F.ascii(c))),
    }
    rows = books.withColumns(keys)
    order, bucket = ["gi", "g", "k", "kt", "pos"], F.struct("gi", "g", F.slice("k", 1, 3).alias("k"))
    numbered = R.numbered(rows, ["l"], order, "position", bucket)
    # a heading stands before the first line of a genre
    first = numbered.groupBy("l", "gi", "g").agg(F.min("position").alias("_first"))
    lined = numbered.join(first, ["l", "gi", "g"])
    head = F.when(F.col("position") == F.col("_first"), F.concat(F.lit("\n## "), F.col("g"), F.lit("\n\n"))).otherwise("")
    edition = F.when(is_uk(), X.source_line("source_note", F.col("edition.city"), F.col("edition.publisher"), F.col("edition.year"), "")).otherwise(F.coalesce("subject", F.lit("")))
    line = F.concat(head, F.lit("| "), F.concat_ws(" | ", F.col("author"), F.col("title"), F.coalesce(edition, F.lit("")), X.human_size(F.coalesce("size", F.lit(0))), status), F.lit(" |\n"))
    return lined.select(F.col("l").alias("lang"), "position", "slug", line.alias("line"))


def summary_totals(books: DataFrame) -> DataFrame:
    """(lang, published, held, fiction, bytes), by language and overall; books have release_ready; sizes of held books do not count."""
    ready = F.coalesce("release_ready", F.lit(False))
    totals = (
        books.withColumn("l", F.when(is_uk(), "uk").otherwise("en")).groupingSets([["l"], []], "l")
        .agg(F.count_if(ready).alias("published"), F.count_if(~ready).alias("held"), F.count_if(ready & (F.col("category") == CATEGORIES[0])).alias("fiction"), F.coalesce(F.sum(F.when(ready, F.col("size"))), F.lit(0)).alias("bytes"))
        .select(F.coalesce("l", F.lit("all")).alias("lang"), "published", "held", "fiction", "bytes")
    )
    # grouping sets make no row of nothing, not even the one of all languages
    zeros = books.sparkSession.range(1).select(F.lit("all").alias("lang"), *(F.lit(0).cast("long").alias(c) for c in totals.columns[1:]))
    return totals.unionByName(zeros).groupBy("lang").agg(*(F.sum(c).alias(c) for c in totals.columns[1:]))


def licence_lines(books: DataFrame) -> DataFrame:
    """(lang, position, slug, line): one line a book; Ukrainian by genre, surname and title, English by plain code points."""
    source = X.source_line("source_note", F.col("edition.city"), F.col("edition.publisher"), F.col("edition.year"), "не вказано")
    year = F.coalesce(F.col("author_died").cast("string"), F.lit("?"))
    line = F.when(is_uk(), F.concat(F.lit("«"), F.col("title"), F.lit("», "), F.col("author"), F.lit(" (†"), year, F.lit("). "), source)).otherwise(F.concat(F.col("title"), F.lit(", "), F.col("author"), F.lit(" (d. "), year, F.lit(")")))
    keys = {
        "l": F.when(is_uk(), "uk").otherwise("en"), "k1": F.when(is_uk(), K.genre_index("genre")).otherwise(0), "k2": F.when(is_uk(), K.uk_key(K.surname("author"))), "k3": F.when(is_uk(), K.uk_key("title")),
        "k4": F.when(~is_uk(), X.first_present("author_sort", "author")), "k5": F.when(~is_uk(), F.col("title")),
    }
    bucket = F.struct("k1", F.slice("k2", 1, 3).alias("k2"), F.when(F.col("k2").isNull(), F.left("k4", F.lit(3))).alias("k4"))
    return R.numbered(books.withColumns(keys), ["l"], ["k1", "k2", "k3", "k4", "k5", "pos"], "position", bucket).select(F.col("l").alias("lang"), "position", "slug", line.alias("line"))
