"""Queries for groups, totals, reports and texts gathered by group."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relational as R
from . import catalogue as C
from .define import Definitions, table
from .queries_functions import _literals, rows_of

DEFINED = Definitions()


@DEFINED.add("""
SELECT c_nationkey, arg_min(c_name, c_custkey) AS name, arg_min(c_mktsegment, c_custkey) AS segment, count(*) AS n, min(c_custkey) AS first_pos FROM customer GROUP BY 1""")
def first_seen_groups(spark, d):
    out = R.first_seen_groups(table(spark, d, "customer"), "c_nationkey", ["c_name", "c_mktsegment"], "c_custkey")
    return out.select("c_nationkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), "n", "first_pos")


@DEFINED.add("""
SELECT coalesce(c_mktsegment, 'all') AS lang, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS fiction, sum(c_custkey)::BIGINT AS bytes FROM customer GROUP BY GROUPING SETS ((c_mktsegment), ())""")
def grouping_totals(spark, d):
    return (
        table(spark, d, "customer").groupingSets([["c_mktsegment"], []], "c_mktsegment")
        .agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("fiction"), F.sum("c_custkey").alias("bytes"))
        .select(F.coalesce("c_mktsegment", F.lit("all")).alias("lang"), "n", "fiction", "bytes")
    )


@DEFINED.add("""
SELECT n_nationkey, strftime(coalesce(max(o_orderdate), TIMESTAMP '2026-01-01'), '%Y-%m-%d') AS latest, coalesce(bool_or(o_orderstatus = 'F'), FALSE) AS failed FROM nation LEFT JOIN customer ON c_nationkey // 2 * 2 = n_nationkey
LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def latest_with_default(spark, d):
    # customers of odd nations are counted with the one before, so that some nations have none
    per = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy((F.floor(F.col("c_nationkey") / 2) * 2).cast("int").alias("n_nationkey")).agg(F.max("o_orderdate").alias("m"), F.bool_or(F.col("o_orderstatus") == "F").alias("f"))
    return table(spark, d, "nation").join(per, "n_nationkey", "left").select("n_nationkey", F.date_format(F.coalesce("m", F.lit("2026-01-01").cast("timestamp")), "yyyy-MM-dd").alias("latest"), F.coalesce("f", F.lit(False)).alias("failed"))


@DEFINED.add("SELECT lang, coalesce(max(strlen(text)), 0)::INTEGER AS largest, sum(strlen(text))::BIGINT AS bytes, count(DISTINCT source) AS sources FROM documents GROUP BY lang")
def largest_documents(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("largest"), F.sum(F.octet_length("text")).alias("bytes"), F.countDistinct("source").alias("sources"))


@DEFINED.add(r"""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>.*?</li>')) AS row FROM pages), g AS (SELECT page_id, count(*) AS rows, count(*) FILTER (regexp_matches(row, 'href="[^h#]')) AS linked FROM r GROUP BY 1)
SELECT page_id, rows, linked, rows >= 3 AND 10 * linked >= 6 * rows AS toc FROM g""")
def toc_pages(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("(<li>.*?</li>)"), 1)).alias("row"))
    g = rows.groupBy("page_id").agg(F.count("*").alias("rows"), F.count_if(F.col("row").rlike('href="[^h#]')).alias("linked"))
    return g.withColumn("toc", X.is_toc_table(F.lit(None).cast("array<string>"), "rows", "linked"))


@DEFINED.add("""
SELECT o_custkey, array_to_string(list_sort(list(e))[1:10], '; ') AS reasons, left(array_to_string(list_sort(list(e))[1:10], '; '), 160) AS shown, array_to_string(list_sort(list(e))[1:5], ', ') || CASE WHEN count(*) > 5 THEN '…' ELSE '' END AS titles
FROM (SELECT o_custkey, lpad(o_orderkey::VARCHAR, 8, '0') || ' ' || o_orderpriority AS e FROM orders) GROUP BY 1""")
def joined_reasons(spark, d):
    e = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit(" "), F.col("o_orderpriority"))
    g = R.least_items(table(spark, d, "orders").select("o_custkey", e.alias("e")), ["o_custkey"], "e", 10, "e")
    return g.select("o_custkey", R.reason_text("e").alias("reasons"), F.left(R.reason_text("e"), F.lit(160)).alias("shown"), R.first_titles("e").alias("titles"))


@DEFINED.add("SELECT p_brand AS slug, count(*) AS n FROM part WHERE p_size < 20 GROUP BY 1 HAVING count(*) > 1")
def duplicate_slugs(spark, d):
    return R.duplicates(table(spark, d, "part").where("p_size < 20").select(F.col("p_brand").alias("slug")), "slug")


@DEFINED.add("SELECT l_suppkey AS url, array_to_string(list_sort(list_distinct(list(l_returnflag || l_linestatus))), ' ') AS feeds FROM lineitem GROUP BY 1")
def feeds_of_books(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("url")).agg(F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), " ").alias("feeds"))


@DEFINED.add("""
SELECT r_name, rn::INTEGER AS rn, CASE WHEN rn = 1 OR seg <> before THEN '## ' || seg || chr(10) ELSE '' END || '- ' || name || chr(10) AS line
FROM (SELECT r_name, c_mktsegment AS seg, c_name AS name, row_number() OVER w AS rn, lag(c_mktsegment) OVER w AS before FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WINDOW w AS (PARTITION BY r_name ORDER BY c_mktsegment, c_name, c_custkey))""")
def markdown_summary(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    order = ["c_mktsegment", "c_name", "c_custkey"]
    numbered = R.numbered(rows, ["r_name"], order, "rn", F.concat_ws(" ", "c_mktsegment", F.left("c_name", F.lit(15))))
    first = numbered.groupBy("r_name", "c_mktsegment").agg(F.min("rn").alias("first"))
    line = F.concat(F.when(F.col("rn") == F.col("first"), F.concat(F.lit("## "), "c_mktsegment", F.lit("\n"))).otherwise(""), F.lit("- "), "c_name", F.lit("\n"))
    return numbered.join(first, ["r_name", "c_mktsegment"]).select("r_name", "rn", line.alias("line"))


@DEFINED.add("SELECT rpad(p_brand, 10, ' ') || ' ' || lpad(count(*)::VARCHAR, 6, ' ') || ' ' || CASE WHEN count(*) > 80 THEN 'ok' ELSE 'FAIL' END AS line FROM part GROUP BY p_brand")
def padded_table(spark, d):
    g = table(spark, d, "part").groupBy("p_brand").count()
    return g.select(F.concat_ws(" ", F.rpad("p_brand", 10, " "), F.lpad(F.col("count").cast("string"), 6, " "), F.when(F.col("count") > 80, "ok").otherwise("FAIL")).alias("line"))


#: A small catalogue in both languages; names from public fixtures of this kind.
_BOOKS = [
    ("uk", 0, "misto", "Місто", "Валер’ян Підмогильний", None, 1937, "Проза", None, "1928", 300000),
    ("uk", 1, "zakhar", "Захар Беркут", "Іван Франко", None, 1916, "Проза", None, "1883", 2000000),
    ("uk", 2, "lisova", "Лісова пісня", "Леся Українка", None, 1913, "Драма", None, "1911", 90000),
    ("uk", 3, "boryslav", "Борислав сміється", "Іван Франко", None, 1916, "Проза", None, "1882", 500),
    ("uk", 4, "kazka", "Казка", "Невідомий", None, -30, None, None, None, 1100000),
    ("en", 0, "eyre", "Jane Eyre", "Charlotte Brontë", "Brontë, Charlotte", 1855, None, "fiction", "1847", 800000),
    ("en", 1, "meditations", "Meditations", "Marcus Aurelius", "Aurelius, Marcus", 180, None, "non-fiction", "180", 250000),
    ("en", 2, "villette", "Villette", "Charlotte Brontë", "Brontë, Charlotte", 1855, None, "fiction", "1853", 900000),
]


def sample_books(spark):
    rows = rows_of(spark, "lang, pos, slug, title, author, author_sort, author_died, genre, category, year, size", _BOOKS)
    return rows.select(
        "lang", F.col("pos").cast("long"), "slug", "title", "author", "author_sort", "author_died", "genre", "category", F.lit("Novel").alias("subject"), F.concat(F.lit("About "), "title").alias("summary"),
        F.struct(F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("publisher"), F.col("year").cast("int").alias("year")).alias("edition"), F.lit(None).cast("string").alias("source_note"),
        F.lit(None).cast("string").alias("translator"), F.when(F.col("lang") == "en", F.col("slug")).alias("se"), F.lit(None).cast("int").alias("gutenberg"), F.col("year").cast("int").alias("published"),
        F.lit(None).cast("string").alias("feed_title"), F.col("size").cast("long"), F.make_timestamp(F.lit(2026), F.lit(1), F.col("pos") + 1, F.lit(0), F.lit(0), F.lit(0)).alias("updated"), F.lit("https://example.org/").alias("source_url"),
    )


_NAVIGATION = [
    ("opds/uk/index", 1, "Проза · 3", "opds/uk/genre-proza.xml", "3 книжки"), ("opds/uk/index", 2, "Драма · 1", "opds/uk/genre-drama.xml", "1 книжка"), ("opds/uk/index", 3, "Інше · 1", "opds/uk/genre-inshe.xml", "1 книжка"),
    ("opds/uk/index", 4, "Леся Українка (1)", "opds/uk/lesia-ukrainka.xml", "1 книжка · †1913"), ("opds/uk/index", 5, "Невідомий (1)", "opds/uk/nevidomyi.xml", "1 книжка · †30 до н. е."),
    ("opds/uk/index", 6, "Підмогильний Валер’ян (1)", "opds/uk/pidmohylnyi-valerian.xml", "1 книжка · †1937"), ("opds/uk/index", 7, "Франко Іван (2)", "opds/uk/franko-ivan.xml", "2 книжки · †1916"),
    ("opds/en/index", 1, "Fiction · 2", "opds/en/fiction.xml", "2 books"), ("opds/en/index", 2, "Non-fiction · 1", "opds/en/nonfiction.xml", "1 books"),
    ("opds/en/index", 3, "Aurelius, Marcus (1)", "opds/en/aurelius-marcus.xml", "1 book · d. 180"), ("opds/en/index", 4, "Brontë, Charlotte (2)", "opds/en/bronte-charlotte.xml", "2 books · d. 1855"),
]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_NAVIGATION)}) t(path, slot, title, href, content)")
def navigation_rows(spark, d):
    return C.navigation(sample_books(spark)).select("path", "slot", "title", "href", "content")


_SHELVES = [
    ("opds/uk/genre-proza", 1, "misto"), ("opds/uk/genre-proza", 2, "boryslav"), ("opds/uk/genre-proza", 3, "zakhar"), ("opds/uk/genre-drama", 1, "lisova"), ("opds/uk/genre-inshe", 1, "kazka"), ("opds/uk/pidmohylnyi-valerian", 1, "misto"),
    ("opds/uk/franko-ivan", 1, "boryslav"), ("opds/uk/franko-ivan", 2, "zakhar"), ("opds/uk/lesia-ukrainka", 1, "lisova"), ("opds/uk/nevidomyi", 1, "kazka"), ("opds/en/fiction", 1, "eyre"), ("opds/en/fiction", 2, "villette"),
    ("opds/en/nonfiction", 1, "meditations"), ("opds/en/bronte-charlotte", 1, "eyre"), ("opds/en/bronte-charlotte", 2, "villette"), ("opds/en/aurelius-marcus", 1, "meditations"),
    *[("opds/all", k + 1, s) for k, s in enumerate("misto zakhar lisova boryslav kazka eyre meditations villette".split())],
]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_SHELVES)}) t(path, slot, slug)")
def shelf_pages(spark, d):
    return C.shelf_pages(sample_books(spark)).select("path", "slot", "slug")


@DEFINED.example("SELECT * FROM (VALUES ('uk', 5, 0, 3490500::BIGINT), ('en', 3, 2, 1950000::BIGINT), ('all', 8, 2, 5440500::BIGINT)) t(lang, n, fiction, bytes)")
def root_rows(spark, d):
    return C.root_rows(sample_books(spark)).drop("latest").withColumns({"n": F.col("n").cast("int"), "fiction": F.col("fiction").cast("int")})


_ENTRIES = [("misto", "About Місто Джерело тексту: 1928. Рік смерті автора: 1937.", 1928), ("zakhar", "About Захар Беркут Джерело тексту: 1883. Рік смерті автора: 1916.", 1883), ("kazka", "About Казка Джерело тексту: Вікіджерела. Рік смерті автора: -30.", None), ("eyre", "About Jane Eyre Source: Standard Ebooks (CC0).", 1847)]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_ENTRIES)}) t(slug, content, issued)")
def book_entries(spark, d):
    wanted = [e[0] for e in _ENTRIES]
    return C.book_entries(sample_books(spark), "https://example.org/").where(F.col("slug").isin(wanted)).select("slug", "content", "issued")
