"""Queries over a library whose books are made from whole tables: the catalogue, the feed tree, the landing page, rules and steps of
whole-book transforms. The SQL makes the same books from the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import book, graph, rules
from ..operators import relational as R
from . import catalogue as C
from . import feedtree
from .define import Definitions, table
from .queries_functions import _literals, rows_of

DEFINED = Definitions()
SITE = feedtree.Site("https://books.example.org/", "Library", "Classics", "Library")

# The authors with what the SQL cannot compute by itself: display name, slug and place in the alphabet.
_AUTHORS = [
    (0, "Іван Франко", 1916, "Франко Іван", "franko-ivan", 5), (1, "Леся Українка", 1913, "Леся Українка", "lesia-ukrainka", 2), (2, "Валер’ян Підмогильний", 1937, "Підмогильний Валер’ян", "pidmohylnyi-valerian", 4),
    (3, "Михайло Коцюбинський", 1913, "Коцюбинський Михайло", "kotsiubynskyi-mykhailo", 1), (4, "Невідомий", -30, "Невідомий", "nevidomyi", 3), (5, "Ольга Кобилянська", 1942, "Кобилянська Ольга", "kobylianska-olha", 0),
]
_GENRES = [(0, "Проза", "proza", 0), (1, "Поезія", "poeziia", 1), (2, "Драма", "drama", 2), (3, "Казки", "inshe", 5), (4, None, "inshe", 5)]
#: Places in the alphabet by surname: pseudonyms and names of one word stay whole.
_SURNAMES = {0: 5, 1: 2, 2: 4, 3: 1, 4: 3, 5: 0}


def library(spark, d):
    """Ukrainian books from part, English ones from customer."""
    authors = rows_of(spark, "ai, author, author_died", [a[:3] for a in _AUTHORS])
    genres = rows_of(spark, "gi, genre", [g[:2] for g in _GENRES])
    none = lambda kind: F.lit(None).cast(kind)
    p = table(spark, d, "part").join(authors, F.col("p_size") % 6 == F.col("ai")).join(genres, F.col("p_partkey") % 5 == F.col("gi"))
    key = F.col("p_partkey").cast("string")
    title = F.concat(F.lit("Том "), F.lpad(key, 6, "0"))
    edition = F.struct(F.when(F.col("p_size") % 3 == 0, "Київ").alias("city"), none("string").alias("publisher"), F.when(F.col("p_size") % 4 > 0, 1850 + F.col("p_size")).alias("year"))
    uk = p.select(
        F.lit("uk").alias("lang"), F.col("p_partkey").alias("pos"), F.concat(F.lit("p"), key).alias("slug"), title.alias("title"), "author", none("string").alias("author_sort"), "author_died", "genre", none("string").alias("category"), none("string").alias("subject"),
        F.concat(F.lit("About "), title).alias("summary"), edition.alias("edition"), none("string").alias("source_note"), none("string").alias("translator"), none("string").alias("se"), none("int").alias("gutenberg"), none("int").alias("published"),
        none("string").alias("feed_title"), (F.col("p_size").cast("long") * 100_000 + F.col("p_partkey")).alias("size"), F.timestamp_add("DAY", "p_size", F.lit("2026-01-01").cast("timestamp")).alias("updated"), F.lit("https://example.org/").alias("source_url"),
    )
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    en = c.select(
        F.lit("en").alias("lang"), F.col("c_custkey").alias("pos"), F.concat(F.lit("c"), key).alias("slug"), F.col("c_name").alias("title"), F.col("n_name").alias("author"), F.col("n_name").alias("author_sort"), (1800 + F.col("c_nationkey")).alias("author_died"), none("string").alias("genre"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "fiction").otherwise("non-fiction").alias("category"), F.col("c_mktsegment").alias("subject"), F.concat(F.lit("About "), "c_name").alias("summary"), F.lit(None).cast(edition_type()).alias("edition"), none("string").alias("source_note"),
        F.when(F.col("c_nationkey") % 4 == 0, "anonymous hand").when(F.col("c_nationkey") % 4 == 1, "T. Lator").alias("translator"), F.when(even, F.concat(F.lit("c"), key)).alias("se"), F.when(~even, F.col("c_custkey")).cast("int").alias("gutenberg"), (F.col("c_nationkey") * 100 - 500).alias("published"),
        none("string").alias("feed_title"), (F.col("c_custkey") * 1000 + 7).alias("size"), F.timestamp_add("DAY", "c_nationkey", F.lit("2026-02-01").cast("timestamp")).alias("updated"), F.lit("https://example.org/").alias("source_url"),
    )
    return uk.unionByName(en)


def edition_type() -> str:
    return "struct<city:string,publisher:string,year:int>"


_SQL = f"""
authors(ai, author, died, display, aslug, aord) AS (VALUES {_literals(_AUTHORS)}), genres(gi, genre, gslug, gord) AS (VALUES {_literals(_GENRES)}),
surnames(si, sord) AS (VALUES {_literals(list(_SURNAMES.items()))}),
uk AS (SELECT p_partkey AS pos, 'p' || p_partkey AS slug, 'Том ' || lpad(p_partkey::VARCHAR, 6, '0') AS title, *, p_size::BIGINT * 100000 + p_partkey AS size, TIMESTAMP '2026-01-01' + to_days(p_size) AS updated,
  CASE WHEN p_size % 3 = 0 THEN 'Київ' END AS city, CASE WHEN p_size % 4 > 0 THEN 1850 + p_size END AS year FROM part JOIN authors ON p_size % 6 = ai JOIN genres ON p_partkey % 5 = gi JOIN surnames ON si = ai),
en AS (SELECT c_custkey AS pos, 'c' || c_custkey AS slug, c_name AS title, n_name AS author, lower(replace(n_name, '_', '-')) AS aslug, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'fiction' ELSE 'non-fiction' END AS category,
  c_custkey * 1000 + 7 AS size, TIMESTAMP '2026-02-01' + to_days(c_nationkey) AS updated, * FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
_WORD = "CASE WHEN n % 10 = 1 AND n % 100 <> 11 THEN 'книжка' WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 12 AND 14 THEN 'книжки' ELSE 'книжок' END"
_DIED = "'†' || abs(died) || CASE WHEN died > 0 THEN '' ELSE ' до н. е.' END"
_NAVIGATION = f"""
ug AS (SELECT coalesce(genre, 'Інше') AS g, gslug, gord, count(*) AS n, min(pos) AS p FROM uk GROUP BY ALL), ua AS (SELECT display, aslug, aord, died, count(*) AS n FROM uk GROUP BY ALL),
ec AS (SELECT category, count(*) AS n FROM en GROUP BY 1), ea AS (SELECT author, aslug, min(c_nationkey) AS k, count(*) AS n, min(pos) AS p FROM en GROUP BY 1, 2),
rows AS (SELECT 'opds/uk/index' AS path, 0 AS s, lpad(gord::VARCHAR, 9, '0') AS o, p, g || ' · ' || n AS title, 'opds/uk/genre-' || gslug || '.xml' AS href, n || ' ' || {_WORD} AS content FROM ug
 UNION ALL SELECT 'opds/uk/index', 1, lpad(aord::VARCHAR, 9, '0'), 0, display || ' (' || n || ')', 'opds/uk/' || aslug || '.xml', n || ' ' || {_WORD} || ' · ' || {_DIED} FROM ua
 UNION ALL SELECT 'opds/en/index', 0, category, 0, CASE category WHEN 'fiction' THEN 'Fiction' ELSE 'Non-fiction' END || ' · ' || n, 'opds/en/' || replace(category, '-', '') || '.xml', n || ' books' FROM ec
 UNION ALL SELECT 'opds/en/index', 1, lower(author), p, author || ' (' || n || ')', 'opds/en/' || aslug || '.xml', n || CASE n WHEN 1 THEN ' book' ELSE ' books' END || ' · d. ' || (1800 + k) FROM ea)"""
_SHELVES = """
shelf AS (SELECT 'opds/uk/genre-' || gslug AS path, lpad(aord::VARCHAR, 3, '0') || title AS o, pos, slug, updated FROM uk UNION ALL SELECT 'opds/uk/' || aslug, title, pos, slug, updated FROM uk UNION ALL SELECT 'opds/all', '0' || lpad(pos::VARCHAR, 12, '0'), pos, slug, updated FROM uk
 UNION ALL SELECT 'opds/en/' || replace(category, '-', ''), lower(author) || ' ' || lower(title), pos, slug, updated FROM en UNION ALL SELECT 'opds/en/' || aslug, lower(title), pos, slug, updated FROM en UNION ALL SELECT 'opds/all', '1' || lpad(pos::VARCHAR, 12, '0'), pos, slug, updated FROM en)"""


@DEFINED.add(f"WITH {_SQL}, {_NAVIGATION}, r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY s, o, p) AS rn FROM rows) SELECT path, ((rn - 1) // 50 + 1)::INTEGER AS page, ((rn - 1) % 50 + 1)::INTEGER AS slot, title, href, content FROM r")
def library_navigation(spark, d):
    """Genres or categories, then authors: the rows of both index feeds."""
    return C.navigation(library(spark, d)).select("path", "page", "slot", "title", "href", "content")


@DEFINED.add(f"WITH {_SQL}, {_SHELVES}, r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY o, pos) AS rn FROM shelf) SELECT path, ((rn - 1) // 50 + 1)::INTEGER AS page, ((rn - 1) % 50 + 1)::INTEGER AS slot, slug FROM r")
def library_shelves(spark, d):
    """Every book on every shelf, with its page and slot."""
    return C.shelf_pages(library(spark, d)).select("path", "page", "slot", "slug")


@DEFINED.add(f"WITH {_SQL}, b AS (SELECT 'uk' AS lang, NULL AS category, size, updated FROM uk UNION ALL SELECT 'en', category, size, updated FROM en) SELECT coalesce(lang, 'all') AS lang, count(*) AS n, count(*) FILTER (category = 'fiction') AS fiction, sum(size)::BIGINT AS bytes, max(updated) AS latest FROM b GROUP BY GROUPING SETS ((lang), ())")
def library_totals(spark, d):
    return C.root_rows(library(spark, d)).withColumn("latest", F.col("latest").cast("timestamp_ntz"))


@DEFINED.add(f"""
WITH {_SQL} SELECT slug, title, 'About ' || title || ' Джерело тексту: ' || coalesce(nullif(concat_ws(', ', city, year::VARCHAR), ''), 'Вікіджерела') || '. Рік смерті автора: ' || died || '.' AS content, year::INTEGER AS issued, genre AS category, strftime(updated, '%Y-%m-%dT%H:%M:%SZ') AS updated FROM uk
UNION ALL SELECT slug, title, 'About ' || title || CASE WHEN c_nationkey % 4 = 1 THEN ' Translated by T. Lator.' ELSE '' END || ' Source: ' || CASE WHEN c_custkey % 2 = 0 THEN 'Standard Ebooks (CC0)' ELSE 'Project Gutenberg #' || c_custkey END || '.',
 CASE WHEN c_nationkey * 100 - 500 > 0 THEN c_nationkey * 100 - 500 END::INTEGER, c_mktsegment, strftime(updated, '%Y-%m-%dT%H:%M:%SZ') FROM en""")
def library_entries(spark, d):
    return C.book_entries(library(spark, d), SITE.base).select("slug", "title", "content", "issued", "category", "updated")


_SIZE = "CASE WHEN size < 1048576 THEN printf('%.0f КБ', size / 1024.0::DOUBLE) ELSE printf('%.1f МБ', size / 1048576.0::DOUBLE) END"


@DEFINED.add(f"""
WITH {_SQL}, b AS (SELECT 'uk' AS lang, gord AS gi, coalesce(genre, 'Інше') AS g, lpad(sord::VARCHAR, 3, '0') || title AS o, pos, slug, author || ' | ' || title || ' | ' || coalesce(nullif(concat_ws(', ', city, year::VARCHAR), ''), '') || ' | ' || {_SIZE} AS cells, p_size % 7 > 0 AS ready FROM uk
 UNION ALL SELECT 'en', (category <> 'fiction')::INTEGER, CASE category WHEN 'fiction' THEN 'Fiction' ELSE 'Non-fiction' END, lower(author) || ' ' || title, pos, slug, author || ' | ' || title || ' | ' || c_mktsegment || ' | ' || {_SIZE}, TRUE FROM en),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY gi, g, o, pos) AS rn, row_number() OVER (PARTITION BY lang, gi, g ORDER BY o, pos) AS k FROM b)
SELECT lang, rn::INTEGER AS position, slug, CASE WHEN k = 1 THEN chr(10) || '## ' || g || chr(10) || chr(10) ELSE '' END || '| ' || cells || ' | ' || CASE WHEN ready THEN '✅' ELSE '⏸ rights' END || ' |' || chr(10) AS line FROM r""")
def library_summary(spark, d):
    """The Markdown summary, a line a book."""
    return C.summary_lines(_with_verdicts(library(spark, d)))


def _with_verdicts(books):
    # a Ukrainian book's size is p_size * 100,000 + p_partkey, and the key may well pass 100,000
    held = (F.col("lang") == "uk") & F.coalesce((F.col("size") - F.col("pos")) % 700_000 <= 0, F.lit(False))
    return books.withColumns({"release_ready": ~held, "reasons": F.when(held, "rights")})


@DEFINED.add(f"""
WITH {_SQL}, b AS (SELECT 'uk' AS lang, FALSE AS fiction, size, p_size % 7 > 0 AS ready FROM uk UNION ALL SELECT 'en', category = 'fiction', size, TRUE FROM en)
SELECT coalesce(lang, 'all') AS lang, count(*) FILTER (ready) AS published, count(*) FILTER (NOT ready) AS held, count(*) FILTER (ready AND fiction) AS fiction, coalesce(sum(size) FILTER (ready), 0)::BIGINT AS bytes FROM b GROUP BY GROUPING SETS ((lang), ())""")
def library_summary_totals(spark, d):
    return C.summary_totals(_with_verdicts(library(spark, d)))


@DEFINED.add(f"""
WITH {_SQL}, b AS (SELECT 'uk' AS lang, lpad(gord::VARCHAR, 2, '0') || lpad(sord::VARCHAR, 3, '0') || title AS o, pos, slug, '«' || title || '», ' || author || ' (†' || died || '). ' || coalesce(nullif(concat_ws(', ', city, year::VARCHAR), ''), 'не вказано') AS line FROM uk
 UNION ALL SELECT 'en', author || ' ' || title, pos, slug, title || ', ' || author || ' (d. ' || (1800 + c_nationkey) || ')' FROM en)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY o, pos))::INTEGER AS position, slug, line FROM b""")
def library_licences(spark, d):
    return C.licence_lines(library(spark, d))


@DEFINED.add("""
WITH b AS (SELECT CASE WHEN p_size % 10 = 1 THEN 'Fiction' WHEN p_partkey % 2 = 0 THEN p_brand ELSE replace(p_brand, '#', ' ') END AS author FROM part), g AS (SELECT author, lower(regexp_replace(author, '[^A-Za-z0-9]+', '-', 'g')) AS slug FROM b GROUP BY 1)
SELECT 'en' AS lang, slug, count(*) AS n FROM g GROUP BY slug HAVING count(*) > 1 OR slug IN ('index', 'fiction', 'nonfiction')""")
def author_slug_collisions(spark, d):
    """Authors whose slugs fall together or are reserved."""
    author = F.when(F.col("p_size") % 10 == 1, "Fiction").when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    books = table(spark, d, "part").select(F.lit("en").alias("lang"), F.col("p_partkey").alias("pos"), author.alias("author"), F.lit(None).cast("string").alias("author_sort"), F.col("p_name").alias("title"), F.lit(None).cast("string").alias("genre"), F.lit(1900).alias("author_died"), F.lit(None).cast("timestamp").alias("updated"))
    return C.slug_collisions(C.author_groups(books))


_HEADS = """
feeds AS (SELECT path, count(*) AS n FROM shelf GROUP BY 1 UNION ALL SELECT path, count(*) FROM rows GROUP BY 1 UNION ALL SELECT 'opds/index', 3),
pages AS (SELECT *, unnest(range(1, greatest(1, ceil(n / 50))::INTEGER + 1))::INTEGER AS page, greatest(1, ceil(n / 50))::INTEGER AS pages FROM feeds)"""


@DEFINED.add(f"""
WITH {_SQL}, {_NAVIGATION}, {_SHELVES}, {_HEADS}
SELECT path || CASE WHEN page > 1 THEN '-' || page ELSE '' END || '.xml' AS file, page, pages, n, CASE WHEN path = 'opds/index' THEN NULL WHEN path LIKE '%/index' OR path = 'opds/all' THEN 'https://books.example.org/opds/index.xml' ELSE 'https://books.example.org/' || regexp_extract(path, '^opds/[a-z]+') || '/index.xml' END AS up,
 CASE WHEN page > 1 THEN 'https://books.example.org/' || path || CASE WHEN page > 2 THEN '-' || (page - 1) ELSE '' END || '.xml' END AS previous, CASE WHEN page < pages THEN 'https://books.example.org/' || path || '-' || (page + 1) || '.xml' END AS next FROM pages""")
def feed_pages(spark, d):
    """Every page of every feed with its links."""
    return feedtree.pages(library(spark, d), SITE).select("file", "page", "pages", "n", "up", "previous", "next")


@DEFINED.add(f"""
WITH {_SQL}, {_NAVIGATION}, {_SHELVES}, {_HEADS}
SELECT path || CASE WHEN page > 1 THEN '-' || page ELSE '' END || '.xml' AS path, least(50, n - 50 * (page - 1))::INTEGER AS entries, TRUE AS well_formed FROM pages""")
def feed_files(spark, d):
    """The rendered files of the feed tree: how many entries each has, and whether it is well-formed."""
    from ..sources.archive import well_formed

    files = feedtree.feed_files(library(spark, d), SITE)
    return files.select("path", F.regexp_count("xml", F.lit("<entry>")).alias("entries"), well_formed(F.encode("xml", "UTF-8")).alias("well_formed"))


@DEFINED.add(f"""
WITH {_SQL}, b AS (SELECT 'uk' AS lang, aslug, lpad(aord::VARCHAR, 3, '0') AS ao, title AS t, pos, slug, coalesce(genre, '') AS sub, coalesce(nullif(concat_ws(', ', city, year::VARCHAR), ''), 'Вікіджерела') AS facts, 'Вікіджерела' AS source FROM uk
 UNION ALL SELECT 'en', aslug, lower(author), lower(title), pos, slug, CASE category WHEN 'fiction' THEN 'Fiction' ELSE 'Non-fiction' END || ' · ' || c_mktsegment, CASE WHEN c_nationkey < 5 THEN (500 - c_nationkey * 100) || ' BC' WHEN c_nationkey = 5 THEN '' ELSE (c_nationkey * 100 - 500)::VARCHAR END || CASE WHEN c_nationkey % 4 = 1 THEN ' · tr. T. Lator' ELSE '' END,
  CASE WHEN c_custkey % 2 = 0 THEN 'Standard Ebooks' ELSE 'Project Gutenberg' END FROM en)
SELECT lang, aslug AS author_slug, (dense_rank() OVER (PARTITION BY lang ORDER BY ao))::INTEGER AS author_rank, (row_number() OVER (PARTITION BY lang, aslug ORDER BY t, pos))::INTEGER AS rank, slug, sub, facts, source FROM b""")
def landing_cards(spark, d):
    """The cards of the landing page in their order."""
    return feedtree.landing_cards(library(spark, d)).select("lang", "author_slug", "author_rank", "rank", "slug", "sub", "facts", "source")


@DEFINED.add(f"""
WITH {_SQL}, n AS (SELECT 'uk' AS l, count(*) AS books, count(DISTINCT aslug) AS authors FROM uk UNION ALL SELECT 'en', count(*), count(DISTINCT aslug) FROM en)
SELECT sum(books)::BIGINT AS cards, sum(authors)::BIGINT AS blocks, count(*) AS sections, TRUE AS closed FROM n""")
def landing_page(spark, d):
    """The landing page as a whole: its cards, blocks of authors and sections, and whether blocks and sections are closed."""
    lines = feedtree.landing_lines(library(spark, d), SITE)
    count = lambda x: F.sum(F.regexp_count("html", F.lit(x)))
    return lines.agg(count('<li class="book">').alias("cards"), count('<div class="author-block"').alias("blocks"), count("<section").alias("sections"), ((count("<section") == count("</section>")) & (count("<ul") == count("</ul>")) & (count("<div") == count("</div>"))).alias("closed"))


# packages from tables


def _package_tables(spark, d):
    """Books are orders, items and files their lines; some lines name no file, some places in the spine no item."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    slug = F.col("l_orderkey").cast("string")
    item, part = F.concat(F.lit("i"), F.col("l_linenumber").cast("string")), F.col("l_partkey").cast("string")
    gone = F.col("l_partkey") % 50 == 0
    none = lambda kind: F.lit(None).cast(kind)
    manifest = lines.select(slug.alias("slug"), F.col("l_linenumber").alias("ord"), item.alias("item_id"), part.alias("href"), F.concat(F.lit("p"), part).alias("path"), F.lit("application/xhtml+xml").alias("media_type"), F.when(F.col("l_linenumber") == 1, F.array(F.lit("nav"))).otherwise(F.array().cast("array<string>")).alias("properties")).distinct()
    archive = lines.select(slug.alias("slug"), F.lit(1).alias("ord"), F.concat(F.when(gone, "stray").otherwise("p"), part).alias("path"), none("binary").alias("content")).distinct()
    spine = lines.select(slug.alias("slug"), F.col("l_linenumber").alias("ord"), F.when(F.col("l_suppkey") % 40 == 7, "nobody").otherwise(item).alias("idref")).distinct()
    books = orders.select(F.col("o_orderkey").cast("string").alias("slug"), F.lit(True).alias("zip_ok"), F.lit("p.opf").alias("opf_path"), F.when(F.col("o_orderkey") % 97 == 0, "ncx").alias("toc"), F.when(F.col("o_orderpriority") == "1-URGENT", "rights").alias("hold"))
    return {"books": books, "archive": archive, "manifest": manifest, "spine": spine}


_FAULTS = """
l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS i, l_partkey AS p, l_suppkey % 40 = 7 AS lost FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)), al AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS i, l_partkey AS p, l_suppkey % 40 = 7 AS lost FROM lineitem),
f AS (SELECT DISTINCT k, i, p, 'missing_file' AS rule, 'p' || p AS subject FROM al WHERE p % 50 = 0
 UNION ALL SELECT DISTINCT k, 0, p, 'stray_file', 'stray' || p FROM l WHERE p % 50 = 0
 UNION ALL SELECT DISTINCT k, i, 0, 'spine_idref', 'nobody' FROM al WHERE lost
 UNION ALL SELECT o_orderkey, 0, 0, 'empty_spine', NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
 UNION ALL SELECT o_orderkey, 0, 0, 'spine_toc', 'ncx' FROM orders WHERE o_orderkey % 97 = 0
 UNION ALL SELECT o_orderkey, 0, 0, 'no_nav', NULL FROM orders WHERE o_orderkey NOT IN (SELECT k FROM l WHERE i = 1)
 UNION ALL SELECT o_orderkey, 0, 0, 'cover_count', '0' FROM orders)"""


@DEFINED.add(f"WITH {_FAULTS} SELECT k::VARCHAR AS slug, rule, subject FROM f")
def injected_faults(spark, d):
    """The rules of the manifest over packages made of whole tables."""
    return _manifest_faults(_package_tables(spark, d))


def _manifest_faults(t):
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), rules.manifest_rules(t))


@DEFINED.add(f"""
WITH {_FAULTS}, e AS (SELECT k, count(*) AS n, list_sort(list(rule || coalesce(': ' || subject, '')))[1:10] AS e FROM f WHERE rule <> 'cover_count' GROUP BY k)
SELECT o_orderkey::VARCHAR AS slug, coalesce(n, 0) AS n_errors, CASE WHEN o_orderpriority = '1-URGENT' THEN 'hold: rights' ELSE coalesce(array_to_string(e, '; '), '') END AS reasons, o_orderpriority <> '1-URGENT' AND n IS NULL AS release_ready, n IS NOT NULL AS failed FROM orders LEFT JOIN e ON k = o_orderkey""")
def publication_verdicts(spark, d):
    """What may be published: a hold blocks without being a failure. Books without covers are not held against anyone here."""
    t = _package_tables(spark, d)
    return rules.verdicts(t["books"].select("slug", "hold"), _manifest_faults(t).where("rule <> 'cover_count'"))


# steps of whole-book transforms


@DEFINED.add("""
WITH pages AS (SELECT DISTINCT l_suppkey AS s, l_orderkey // 40 AS f, l_linenumber AS part FROM lineitem), ids AS (SELECT DISTINCT l_suppkey AS s, l_orderkey // 40 AS f, l_linenumber AS part, 'q' || l_partkey AS id FROM lineitem),
links AS (SELECT DISTINCT l_suppkey AS s, 'o' || l_orderkey AS path, l_orderkey // 40 AS f, 1 AS part, 'q' || (l_partkey + (l_linenumber % 2)) AS id FROM lineitem),
owned AS (SELECT s, f, id, min(part) AS part FROM ids GROUP BY ALL)
SELECT l.s::VARCHAR AS slug, l.path, 'f' || l.f || '-1' AS target, l.id, 'f' || l.f || '-' || o.part AS owner FROM links l JOIN owned o ON o.s = l.s AND o.f = l.f AND o.id = l.id WHERE o.part > 1 AND EXISTS (SELECT 1 FROM pages p WHERE p.s = l.s AND p.f = l.f AND p.part = 1)""")
def link_owners(spark, d):
    """Links into split pages and the parts that own their ids now: a supplier is a book, forty orders a page, line numbers its parts."""
    lines = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("slug"), F.concat(F.lit("f"), F.floor(F.col("l_orderkey") / 40).cast("string")).alias("family"), F.col("l_linenumber").alias("part"), "l_orderkey", "l_partkey")
    path = F.concat("family", F.lit("-"), F.col("part").cast("string"))
    parts = lines.select("slug", "family", "part", path.alias("path")).distinct()
    ids = lines.select("slug", path.alias("path"), F.concat(F.lit("q"), F.col("l_partkey").cast("string")).alias("id")).distinct()
    links = lines.select("slug", F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("path"), F.concat("family", F.lit("-1")).alias("target"), F.concat(F.lit("q"), (F.col("l_partkey") + F.col("part") % 2).cast("string")).alias("id")).distinct()
    return book.owners_of_links(links, parts, ids)


@DEFINED.add("""
SELECT c_nationkey::VARCHAR AS slug, 'images/' || c_name || '.png' AS path FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey // 2 * 2 = c_custkey)""")
def unused_images(spark, d):
    """Customers are images, orders the pages that show them (the even one of two neighbours)."""
    customer = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("slug"))
    images = customer.select("slug", F.concat(F.lit("images/"), "c_name", F.lit(".png")).alias("path"))
    shown = table(spark, d, "orders").join(customer, F.floor(F.col("o_custkey") / 2) * 2 == F.col("c_custkey"))
    pages = shown.select("slug", F.concat(F.lit('<p><img src="images/'), F.col("c_name"), F.lit('.png"/>'), "o_orderpriority", F.lit("</p>")).alias("text"))
    # names hold a #, which ends the name in a reference: written without one on both sides
    plain = lambda t, c: t.withColumn(c, F.replace(c, F.lit("#"), F.lit("_")))
    return book.unused_images(plain(images, "path"), plain(pages, "text")).select("slug", F.replace("path", F.lit("_"), F.lit("#")).alias("path"))


@DEFINED.add("""
WITH x AS (SELECT page_id, '<p id="a">' || page_id || '</p><a class="k" href="#a">in</a> <a href="#gone">out <b>of</b> it</a> <a href="q' || ((page_id + 1) % (SELECT count(*) FROM pages)) || '.xhtml#' || CASE WHEN page_id % 2 = 0 THEN 'a' ELSE 'z' END || '">next</a> <a href="far.xhtml#z">far</a>' AS t FROM pages)
SELECT page_id, replace(CASE WHEN page_id % 2 = 0 THEN t ELSE regexp_replace(t, '<a href="q[0-9]+.xhtml#z">next</a>', 'next') END, '<a href="#gone">out <b>of</b> it</a>', 'out <b>of</b> it') AS text FROM x""")
def dead_references(spark, d):
    """Links to ids that are not there become their text; links to pages that are not there stay for the rules to find."""
    pages = table(spark, d, "pages").select("page_id")
    n = pages.agg(F.count("*").alias("n"))
    number = lambda c: c.cast("string")
    text = F.concat(F.lit('<p id="a">'), number(F.col("page_id")), F.lit('</p><a class="k" href="#a">in</a> <a href="#gone">out <b>of</b> it</a> <a href="q'), number((F.col("page_id") + 1) % F.col("n")), F.lit(".xhtml#"), F.when(F.col("page_id") % 2 == 0, "a").otherwise("z"), F.lit('">next</a> <a href="far.xhtml#z">far</a>'))
    docs = pages.join(n).select(F.lit("all").alias("slug"), F.concat(F.lit("q"), number(F.col("page_id")), F.lit(".xhtml")).alias("path"), text.alias("text"), "page_id")
    loose = book.dangling(book.links_of(docs), book.ids_of(docs), docs).groupBy("slug", "path").agg(F.array_join(F.array_sort(F.collect_set(book.quoted(F.col("ref")))), "|").alias("refs"))
    return docs.join(loose, ["slug", "path"], "left").select("page_id", F.coalesce(book.unlinked(F.col("text"), F.col("refs")), "text").alias("text"))


@DEFINED.add("""
SELECT p_partkey, '../' || CASE WHEN p_size % 2 = 0 THEN '../' ELSE '' END || 'images/' || p_partkey || '.png' AS way FROM part""")
def relative_paths(spark, d):
    p = F.col("p_partkey").cast("string")
    folder = F.concat(F.lit("OEBPS/text"), F.when(F.col("p_size") % 2 == 0, "/deep").otherwise(""))
    return table(spark, d, "part").select("p_partkey", X.relative_path(F.concat(F.lit("OEBPS/images/"), p, F.lit(".png")), folder).alias("way"))


@DEFINED.add("""
WITH t AS (SELECT c_custkey, r_name || '/' || n_name || '/' || c_name AS title FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), r AS (SELECT r_name AS root FROM region UNION ALL SELECT r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey, root FROM t JOIN r ON title = root OR starts_with(title, root || '/')""")
def prefix_join(spark, d):
    places = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat_ws("/", "r_name", "n_name", "c_name").alias("title"))
    roots = table(spark, d, "region").select(F.col("r_name").alias("root")).unionByName(places.select(F.concat_ws("/", "r_name", "n_name").alias("root")))
    return R.prefix_join(rows, roots, "title", "root").select("c_custkey", "root")


@DEFINED.add(f"""
WITH {_SQL}, {_NAVIGATION}, {_SHELVES}, {_HEADS}
SELECT (SELECT count(*) FROM feeds) AS feeds, 2 AS max_depth, (SELECT count(*) FROM rows) + 3 AS nav_rows, (SELECT count(*) FROM shelf) AS book_rows, (SELECT count(*) FROM uk) + (SELECT count(*) FROM en) AS unique_books, TRUE AS as_expected""")
def crawled_library(spark, d):
    """The feed tree crawled from its root, all pages of a feed as one: every feed and every book is reached."""
    books = library(spark, d)
    nav = C.navigation(books).select("path", "slot", "href").unionByName(feedtree.root_entries(books).select("path", "slot", "href"))
    shelf = C.shelf_pages(books).select("path", "slot", "slug")
    rows = nav.select(F.col("path").alias("feed"), F.col("slot").alias("pos"), F.lit("NAV").alias("kind"), F.regexp_replace("href", r"\.xml$", "").alias("href")).unionByName(shelf.select(F.col("path").alias("feed"), F.col("slot").alias("pos"), F.lit("BOOK").alias("kind"), F.col("slug").alias("href")))
    return graph.crawl_totals(rows, "opds/index", books.count())
