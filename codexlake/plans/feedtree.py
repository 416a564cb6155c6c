"""The feed tree and the landing page: feeds, their pages, links and entries as rows, rendered to files last.

Every feed has one page at least; a page is one row whose entries are gathered by page, at most PAGE of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import collation as K
from ..functions import text as X
from ..operators import relational as R
from . import catalogue as C


@dataclass(frozen=True)
class Site:
    base: str
    title: str
    subtitle: str
    author: str
    urn: str = "urn:library"


def _counted(n) -> F.Column:
    return F.concat_ws(" ", n.cast("string"), X.uk_books_word(n))


def feeds(books: DataFrame, site: Site) -> DataFrame:
    """(path, feed_id, title, subtitle, kind, updated, up, lang) of every feed but the root."""
    home, last = F.lit(f"{site.base}opds/index.xml"), F.max("updated").alias("updated")
    index = lambda lang: F.lit(f"{site.base}opds/{lang}/index.xml")

    def rows(groups, path, feed_id, title, subtitle, kind, up, lang):
        parts = (path, F.concat(F.lit(f"{site.urn}:"), feed_id), title, subtitle, F.lit(kind), F.col("updated"), up, lang)
        return groups.select(*[(p if isinstance(p, F.Column) else F.lit(p)).alias(n) for p, n in zip(parts, "path feed_id title subtitle kind updated up lang".split())])

    uk, en = books.where(C.is_uk()), books.where(~C.is_uk())
    slug = K.genre_slug("genre")
    # unknown genres share one feed, named after the first
    genres = uk.groupBy(slug.alias("slug")).agg(F.min_by(X.first_present("genre", F.lit(K.OTHER_GENRE[0])), "pos").alias("label"), last)
    kinds = en.where(F.col("category").isin(*C.CATEGORIES)).groupBy("category").agg(last)
    flat = F.replace("category", F.lit("-"), F.lit(""))
    authors = C.author_groups(books).withColumn("updated", F.col("latest"))
    short = F.when(C.is_uk(), "uk").otherwise("en")
    lived = F.concat(F.when(C.is_uk(), _counted(F.col("n"))).otherwise(F.concat_ws(" ", F.col("n").cast("string"), X.en_books_word("n"))), F.lit(" · "), X.died_label("died", "lang"))
    some = lambda b: b.agg(last)
    return reduce(DataFrame.unionByName, [
        rows(genres, F.concat(F.lit("opds/uk/genre-"), F.col("slug")), F.concat(F.lit("uk:genre:"), F.col("slug")), F.col("label"), "Українська класика", "acquisition", index("uk"), "uk"),
        rows(kinds, F.concat(F.lit("opds/en/"), flat), F.concat(F.lit("en:"), F.col("category")), F.when(F.col("category") == C.CATEGORIES[0], "Fiction").otherwise("Non-fiction"), "English classics", "acquisition", index("en"), "en"),
        rows(authors, F.concat(F.lit("opds/"), short, F.lit("/"), F.col("slug")), F.concat(short, F.lit(":author:"), F.col("slug")), F.col("name"), lived, "acquisition", F.concat(F.lit(f"{site.base}opds/"), short, F.lit("/index.xml")), short),
        rows(some(uk), "opds/uk/index", F.lit("uk"), "Українська", "Жанри й автори", "navigation", home, "uk"),
        rows(some(en), "opds/en/index", F.lit("en"), "English", "Fiction, non-fiction and authors", "navigation", home, "en"),
        rows(some(books), "opds/all", F.lit("all"), f"{site.title} — усі книжки", site.subtitle, "acquisition", home, "uk"),
        rows(some(books), "opds/index", F.lit("root"), site.title, site.subtitle, "navigation", F.lit(None).cast("string"), "uk"),
    ])


def root_entries(books: DataFrame) -> DataFrame:
    """(path, page, slot, title, href, content, latest): the root's three rows with their counts."""
    t = books.groupBy().agg(*[F.count_if(c).alias(n) for n, c in (("uk", C.is_uk()), ("en", ~C.is_uk()), ("fic", ~C.is_uk() & (F.col("category") == "fiction")), ("non", ~C.is_uk() & (F.col("category") == "non-fiction")))], F.max(F.when(C.is_uk(), F.col("updated"))).alias("uk_at"), F.max(F.when(~C.is_uk(), F.col("updated"))).alias("en_at"), F.max("updated").alias("at"))
    number = lambda c: F.col(c).cast("string")
    row = lambda slot, title, href, content, at: F.struct(F.lit("opds/index").alias("path"), F.lit(1).alias("page"), F.lit(slot).alias("slot"), title.alias("title"), F.lit(href).alias("href"), content.alias("content"), F.coalesce(at, "at").alias("latest"))
    rows = F.array(
        row(1, F.concat(F.lit("Українська ("), number("uk"), F.lit(")")), "opds/uk/index.xml", F.concat(_counted(F.col("uk")), F.lit(" української класики")), F.col("uk_at")),
        row(2, F.concat(F.lit("English ("), number("en"), F.lit(")")), "opds/en/index.xml", F.concat(number("en"), F.lit(" English classics: "), number("fic"), F.lit(" fiction, "), number("non"), F.lit(" non-fiction")), F.col("en_at")),
        row(3, F.concat(F.lit("Усі книжки · All books ("), (F.col("uk") + F.col("en")).cast("string"), F.lit(")")), "opds/all.xml", F.lit("Єдиний список усіх книжок"), F.col("at")),
    )
    return t.select(F.explode(rows).alias("r")).select("r.*")


def navigation_entries(books: DataFrame, site: Site) -> DataFrame:
    """(path, page, slot, xml) of the rows that lead to other feeds."""
    rows = C.navigation(books).select("path", "page", "slot", "title", "href", "content", "latest").unionByName(root_entries(books))
    kind = F.when(F.col("path") == "opds/index", F.when(F.col("slot") < 3, C.NAV).otherwise(C.ACQ)).otherwise(C.ACQ)
    entry_id = F.concat(F.lit(f"{site.urn}:nav:"), F.regexp_replace(F.regexp_replace("href", r"^opds/|(/index)?\.xml$", ""), "/", ":"))
    return rows.select("path", "page", "slot", entry(entry_id, X.fit_bytes("title"), "latest", F.col("content"), "subsection", kind, F.concat(F.lit(site.base), F.col("href"))).alias("xml"))


def book_entries(books: DataFrame, site: Site) -> DataFrame:
    """(path, page, slot, xml) of the books on their shelves."""
    e = C.book_entries(books, site.base)
    more = F.concat(
        F.lit("<author><name>"), X.escape_html("author"), F.lit("</name></author>"), F.coalesce(F.concat(F.lit("<dc:issued>"), F.col("issued").cast("string"), F.lit("</dc:issued>")), F.lit("")),
        F.coalesce(F.concat(F.lit('<category term="'), X.escape_html("category"), F.lit('"/>')), F.lit("")),
    )
    xml = e.select("lang", "slug", entry(F.col("id"), F.col("title"), F.to_timestamp("updated"), F.col("content"), "http://opds-spec.org/acquisition/open-access", F.lit("application/epub+zip"), F.col("href"), more).alias("xml"))
    return C.shelf_pages(books).select("path", "page", "slot", "lang", "slug").join(xml, ["lang", "slug"]).select("path", "page", "slot", "xml")


def entry(entry_id, title, updated, content, rel: str, kind, href, more=None):
    part = lambda tag, c, a="": F.concat(F.lit(f"<{tag}{a}>"), X.escape_html(c), F.lit(f"</{tag}>"))
    return F.concat(F.lit("<entry>"), part("id", entry_id), part("title", title), F.lit("<updated>"), X.iso_utc(updated), F.lit("</updated>"), more if more is not None else F.lit(""), part("content", content, ' type="text"'), F.lit(f'<link rel="{rel}" type="'), kind, F.lit('" href="'), X.escape_html(href), F.lit('"/></entry>\n'))


def pages(books: DataFrame, site: Site, entries: DataFrame | None = None) -> DataFrame:
    """(path, file, page, pages, n, title, subtitle, kind, updated, up, previous, next, feed_id, lang) of every page."""
    entries = C.navigation(books).select("path").unionByName(root_entries(books).select("path")).unionByName(C.shelves(books).select("path")) if entries is None else entries.select("path")
    out = R.feed_pages(feeds(books, site), entries, "path")
    near = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(site.base), R.page_path("path", c)))
    return out.select("path", R.page_path("path", F.col("page")).alias("file"), "page", "pages", "n", R.page_title(F.col("title"), "page", "pages").alias("title"), "subtitle", "kind", "updated", "up", near("prev").alias("previous"), near("next").alias("next"), F.concat("feed_id", F.lit(":"), F.col("page").cast("string")).alias("feed_id"), "lang")


def feed_files(books: DataFrame, site: Site) -> DataFrame:
    """(path, xml): the files of the feed tree."""
    entries = navigation_entries(books, site).unionByName(book_entries(books, site))
    body = entries.groupBy("path", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", "xml"))), lambda x: x["xml"]), "").alias("body"))
    head = pages(books, site).join(body, ["path", "page"], "left")
    kind = F.when(F.col("kind") == "navigation", C.NAV).otherwise(C.ACQ)
    link = lambda rel, t, href: F.coalesce(F.concat(F.lit(f'<link rel="{rel}" type="'), t, F.lit('" href="'), X.escape_html(href), F.lit('"/>\n')), F.lit(""))
    own = F.concat(F.lit(site.base), F.col("file"))
    links = F.concat(link("self", kind, own), link("start", F.lit(C.NAV), F.lit(f"{site.base}opds/index.xml")), link("alternate", F.lit("text/html"), F.lit(site.base)), link("up", F.lit(C.NAV), F.col("up")), link("previous", kind, F.col("previous")), link("next", kind, F.col("next")))
    part = lambda tag, c: F.concat(F.lit(f"<{tag}>"), X.escape_html(c), F.lit(f"</{tag}>\n"))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<feed xmlns="http://www.w3.org/2005/Atom" xmlns:dc="http://purl.org/dc/terms/" xmlns:opds="http://opds-spec.org/2010/catalog" xml:lang="'), F.col("lang"), F.lit('">\n'),
        part("id", F.col("feed_id")), part("title", F.col("title")), part("subtitle", F.col("subtitle")), F.lit("<updated>"), X.iso_utc(F.coalesce("updated", F.lit("2026-01-01").cast("timestamp"))), F.lit(f"</updated>\n<icon>{site.base}assets/icon.png</icon>\n<author><name>"),
        X.escape_html(F.lit(site.author)), F.lit(f"</name><uri>{site.base}</uri></author>\n"), links, F.coalesce("body", F.lit("")), F.lit("</feed>\n"),
    )
    return head.select(F.col("file").alias("path"), xml.alias("xml"))


def landing_cards(books: DataFrame) -> DataFrame:
    """(lang, author_slug, display, author_rank, rank, slug, title, sub, facts, source, size): the cards of the landing page, by author and title."""
    known = C.with_keys(books)
    groups = R.numbered(C.author_groups(books), ["lang"], ["key", "first_pos"], "author_rank", F.slice("key", 1, 3))
    cards = R.numbered(known.drop("author_slug"), ["lang", "display"], ["title_key", "pos"], "rank", F.slice("title_key", 1, 8)).join(groups.select("lang", "display", "slug", "author_rank").withColumnRenamed("slug", "author_slug"), ["lang", "display"])
    place = F.nullif(F.concat_ws(", ", F.replace("edition.city", F.lit("; "), F.lit("–")), F.col("edition.year").cast("string")), F.lit(""))
    uk_facts = F.coalesce(place, F.nullif("source_note", F.lit("")), F.lit("Вікіджерела"))
    year = F.when(F.col("published") < 0, F.concat((-F.col("published")).cast("string"), F.lit(" BC"))).otherwise(F.coalesce(F.nullif("published", F.lit(0)).cast("string"), F.lit("")))
    en_facts = F.concat(year, F.when(X.is_translator("translator"), F.concat(F.lit(" · tr. "), F.col("translator"))).otherwise(""))
    subtitle = F.col("subtitle") if "subtitle" in books.columns else F.lit(None).cast("string")
    sub = F.when(C.is_uk(), X.facts_line("genre", subtitle)).otherwise(F.concat(F.when(F.col("category") == "fiction", "Fiction").otherwise("Non-fiction"), F.lit(" · "), F.coalesce("subject", F.lit(""))))
    source = F.when(C.is_uk(), "Вікіджерела").when(F.col("se").isNotNull(), "Standard Ebooks").otherwise("Project Gutenberg")
    return cards.select("lang", "author_slug", "display", "author_rank", "rank", "slug", "title", sub.alias("sub"), F.when(C.is_uk(), uk_facts).otherwise(en_facts).alias("facts"), source.alias("source"), "size", "author_died", "summary", "source_url")


def landing_lines(books: DataFrame, site: Site) -> DataFrame:
    """(part, lang, position, html): the landing page as lines in order of part, language and position.

    Parts: 0 opening, 1 head of a language, 2 links to its authors, 3 cards (an author's block opens before the first and
    closes behind the last), 4 end of a language, 5 closing. The sink writes the lines one behind the other.
    """
    cards = landing_cards(books)
    lang_order = F.when(F.col("lang").eqNullSafe("en"), 1).otherwise(0)
    short = F.when(F.col("lang").eqNullSafe("en"), "en").otherwise("uk")
    span = cards.groupBy("lang", "display").agg(F.max("rank").alias("last"))
    anchor = F.concat(short, F.lit("-"), F.col("author_slug"))
    book = F.concat(F.lit("books/"), X.escape_html("slug"), F.lit(".epub"))
    wrap = lambda tag, kind, c: F.concat(F.lit(f'<{tag} class="{kind}">'), c, F.lit(f"</{tag}>"))
    card = F.concat(
        F.lit('<li class="book"><a class="cover" href="'), book, F.lit('"><img src="covers/'), X.escape_html("slug"), F.lit('.jpg" width="200" height="300" alt="" loading="lazy"></a><div class="meta"><h4><a href="'), book, F.lit('">'), X.escape_html("title"), F.lit("</a></h4>"),
        wrap("p", "sub", X.escape_html("sub")), wrap("p", "summary", X.escape_html(F.coalesce("summary", F.lit("")))),
        wrap("p", "facts", F.concat(X.escape_html("facts"), F.lit(' · <a href="'), X.escape_html(F.coalesce("source_url", F.lit(""))), F.lit('">'), F.col("source"), F.lit('</a> · <a class="dl" href="'), book, F.lit('">EPUB, '), X.human_size("size"), F.lit("</a>"))), F.lit("</div></li>"),
    )
    opens = F.concat(F.lit('<div class="author-block" id="'), anchor, F.lit('"><h3>'), X.escape_html("display"), F.lit(' <span class="died">('), X.escape_html(X.died_label("author_died", "lang")), F.lit(')</span></h3><ul class="books">'))
    whole = F.concat(F.when(F.col("rank") == 1, opens).otherwise(""), card, F.when(F.col("rank") == F.col("last"), "</ul></div>").otherwise(""))
    lines = cards.join(span, ["lang", "display"]).select(F.lit(3).alias("part"), lang_order.alias("lang"), F.struct(F.col("author_rank").alias("a"), F.col("rank").alias("b")).alias("position"), whole.alias("html"))
    authors = cards.where("rank = 1").select(F.lit(2), lang_order, F.struct("author_rank", "rank"), F.concat(F.lit('<a href="#'), anchor, F.lit('">'), X.escape_html("display"), F.lit("</a>")))
    counts = books.groupBy(lang_order.alias("lang")).agg(F.count("*").alias("n"))
    nothing = F.struct(F.lit(0), F.lit(0))
    heading = F.when(F.col("lang") == 0, "Українська").otherwise("English")
    section = F.concat(F.lit('<section class="lang" id="'), F.when(F.col("lang") == 0, "uk").otherwise("en"), F.lit('"><h2>'), heading, F.lit(' <span class="count">'), F.col("n").cast("string"), F.lit("</span></h2>"))
    heads, ends = counts.select(F.lit(1), "lang", nothing, section), counts.select(F.lit(4), "lang", nothing, F.lit("</section>"))
    title = X.escape_html(F.lit(site.title))
    total = books.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    opening = total.select(F.lit(0), F.lit(0), nothing, F.concat(F.lit('<!doctype html>\n<html lang="uk"><head><meta charset="utf-8"><title>'), title, F.lit("</title></head><body><h1>"), title, F.lit("</h1><p>"), X.escape_html(F.lit(site.subtitle)), F.lit(" · "), F.col("n").cast("string"), F.lit(" · "), X.human_size("bytes"), F.lit("</p>")))
    closing = total.select(F.lit(5), F.lit(1), nothing, F.lit("</body></html>"))
    return reduce(DataFrame.union, [lines, authors, heads, ends, opening, closing])
