"""Queries for joins, windows, paging, sets, sorts, chunks, refresh and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunker, graph, refresh
from ..operators import relational as R
from .define import Definitions, table
from .queries_functions import _literals, rows_of

DEFINED = Definitions()


@DEFINED.add("""
WITH g AS (SELECT r_name, n_name, n_nationkey, count(c_custkey) AS n, coalesce(max(c_acctbal), 0) AS best FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY lower(n_name), n_nationkey) AS rn, count(*) OVER (PARTITION BY r_name) AS k FROM g)
SELECT r_name AS feed, n_name || ' (' || n || ')' AS title, n, best, ((rn - 1) // 2 + 1)::INTEGER AS page, ceil(k / 2)::INTEGER AS pages, ((rn - 1) % 2 + 1)::INTEGER AS slot,
  CASE WHEN (rn - 1) // 2 > 0 THEN (rn - 1) // 2 END::INTEGER AS prev_page, CASE WHEN (rn - 1) // 2 + 1 < ceil(k / 2) THEN (rn - 1) // 2 + 2 END::INTEGER AS next_page FROM o""")
def paged_index(spark, d):
    """Owners grouped, counted, collated and paged: the flagship."""
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"), F.max("c_acctbal").alias("best"))
    owners = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(counts, "n_nationkey", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "best": F.coalesce("best", F.lit(0.0))})
    out = R.paged(owners, ["r_name"], [F.lower("n_name"), "n_nationkey"], 2)
    return out.select(F.col("r_name").alias("feed"), F.concat("n_name", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("title"), "n", "best", "page", "pages", "slot", "prev_page", "next_page")


@DEFINED.add("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_custkey) AS rn, count(*) OVER (PARTITION BY c_nationkey) AS k FROM customer)
SELECT c_custkey, 'opds/' || c_nationkey || CASE WHEN (rn - 1) // 50 > 0 THEN '-' || ((rn - 1) // 50 + 1) ELSE '' END || '.xml' AS path, 'N' || CASE WHEN ceil(k / 50) > 1 THEN ' (' || ((rn - 1) // 50 + 1) || '/' || ceil(k / 50)::INTEGER || ')' ELSE '' END AS title,
  ((rn - 1) % 50 + 1)::INTEGER AS slot FROM o""")
def paged_books(spark, d):
    out = R.paged(table(spark, d, "customer"), ["c_nationkey"], ["c_name", "c_custkey"], bucket=F.left("c_name", F.lit(15)))
    return out.select("c_custkey", R.page_path(F.concat(F.lit("opds/"), F.col("c_nationkey").cast("string")), F.col("page")).alias("path"), R.page_title(F.lit("N"), "page", "pages").alias("title"), "slot")


@DEFINED.add("""
WITH n AS (SELECT n_nationkey, n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey // 2 * 2 = n_nationkey GROUP BY ALL)
SELECT n_name, n, p AS page, greatest(1, ceil(n / 2))::INTEGER AS pages, CASE WHEN p > 1 THEN p - 1 END::INTEGER AS prev, CASE WHEN p < greatest(1, ceil(n / 2)) THEN p + 1 END::INTEGER AS next
FROM (SELECT *, unnest(range(1, greatest(1, ceil(n / 2))::INTEGER + 1))::INTEGER AS p FROM n)""")
def feeds_with_empty_pages(spark, d):
    feeds = table(spark, d, "nation").select("n_name", "n_nationkey")
    # suppliers of odd nations are listed with the nation before, whose own feed is empty
    entries = table(spark, d, "supplier").select((F.floor(F.col("s_nationkey") / 2) * 2).cast("int").alias("n_nationkey"))
    return R.feed_pages(feeds, entries, "n_nationkey", 2).drop("n_nationkey")


@DEFINED.add("SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) WHERE rn = 1")
def keep_first(spark, d):
    rows = table(spark, d, "part").select("p_brand", F.struct((-F.col("p_retailprice")).alias("a"), F.col("p_partkey").alias("b")).alias("pos"), "p_partkey", "p_name")
    return R.keep_first(rows, ["p_brand"]).drop("pos")


@DEFINED.add("""
SELECT l_orderkey, l_linenumber, l_suppkey, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY f, l_suppkey)::INTEGER AS number FROM (SELECT *, min(pos) OVER (PARTITION BY l_orderkey, l_suppkey) AS f
 FROM (SELECT *, l_linenumber * 1000000 + l_partkey AS pos FROM lineitem))""")
def first_occurrence_numbers(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("pos"))
    return R.first_occurrence_number(rows, ["l_orderkey"], "l_suppkey", "pos").drop("pos")


@DEFINED.add("""
SELECT user_id, event_id, event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 AS starts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island
FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def control_breaks(spark, d):
    rows = R.control_break(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return R.islands(rows, ["user_id"], ["ts", "event_id"], F.col("starts")).select("user_id", "event_id", "starts", "island")


@DEFINED.add("""
SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS b, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn = 1 OR b IS DISTINCT FROM event_type""")
def consecutive_duplicates(spark, d):
    return R.drop_consecutive(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


@DEFINED.add("SELECT p_partkey, 'img' || lpad((rn)::VARCHAR, 5, '0') AS file, ((rn - 1) // 3)::INTEGER AS row, ((rn - 1) % 3)::INTEGER AS \"column\" FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS rn FROM part)")
def renamed_images(spark, d):
    rows = R.numbered(R.grid(table(spark, d, "part"), ["p_brand"], ["p_name", "p_partkey"], 3), ["p_brand"], ["p_name", "p_partkey"])
    return rows.select("p_partkey", F.concat(F.lit("img"), F.lpad(F.col("rn").cast("string"), 5, "0")).alias("file"), "row", "column")


@DEFINED.add("""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 13 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS k FROM lineitem)
SELECT l_orderkey, l_linenumber, k AS missing_part FROM c WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = k)""")
def dangling_references(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 13 == 0, -F.col("l_partkey") - 1).otherwise(F.col("l_partkey")).alias("missing_part"))
    return R.missing(rows, table(spark, d, "part").select("p_partkey"), [("missing_part", "p_partkey")])


@DEFINED.add("SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = (d.lang <> 'en')::INTEGER)")
def two_key_antijoin(spark, d):
    """Documents without a row of labels that has both their id and the toxicity that goes with their language here."""
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("known"), F.col("toxic").cast("int").alias("kind"))
    docs = table(spark, d, "documents").select("doc_id", "lang", (F.col("lang") != "en").cast("int").alias("wanted"))
    return R.missing(docs, labels, [("doc_id", "known"), ("wanted", "kind")]).drop("wanted")


@DEFINED.add("SELECT o_orderkey, c_name, coalesce(c_acctbal, 0.0) AS balance FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey")
def lookup_with_default(spark, d):
    """Keys are doubled, so that those of the upper half find nobody."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal")
    return table(spark, d, "orders").join(customers, F.col("o_custkey") * 2 == F.col("key"), "left").select("o_orderkey", "c_name", F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"))


@DEFINED.example("""
WITH r(root) AS (VALUES ('a'), ('a/b'), ('a/bc'), ('d')), t(title) AS (VALUES ('a'), ('a/b'), ('a/b/c'), ('a/bc'), ('ab'), ('d/e/f'), ('e'))
SELECT title, root FROM t JOIN r ON title = root OR starts_with(title, root || '/')""")
def prefix_join(spark, d):
    rows = rows_of(spark, "title", [("a",), ("a/b",), ("a/b/c",), ("a/bc",), ("ab",), ("d/e/f",), ("e",)])
    return R.prefix_join(rows, rows_of(spark, "root", [("a",), ("a/b",), ("a/bc",), ("d",)]), "title", "root")


@DEFINED.add("""
SELECT page_id, md5(replace(replace(replace(html, '</p>', '<!p>'), 'article', 'main'), 'main>', 'MAIN>')) AS renamed FROM pages""")
def applied_renames(spark, d):
    pairs = F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in (("</p>", "<!p>"), ("article", "main"), ("main>", "MAIN>"))])
    return table(spark, d, "pages").select("page_id", F.md5(R.apply_renames("html", pairs).cast("binary")).alias("renamed"))


@DEFINED.add("""
SELECT 'customer' AS side, c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier""")
def bag_union(spark, d):
    a = table(spark, d, "customer").select(F.lit("customer").alias("side"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return a.unionByName(table(spark, d, "supplier").select(F.lit("supplier").alias("side"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")))


@DEFINED.add("""
(SELECT 'stray' AS kind, o_custkey * 2 AS id FROM orders EXCEPT SELECT 'stray', c_custkey FROM customer) UNION ALL (SELECT 'both', l_suppkey * 2 FROM lineitem INTERSECT SELECT 'both', s_suppkey FROM supplier)""")
def set_operations(spark, d):
    """Doubled keys: what no customer has, and what suppliers have as well."""
    rows = lambda name, kind, key: table(spark, d, name).select(F.lit(kind).alias("kind"), key.alias("id"))
    stray = rows("orders", "stray", F.col("o_custkey") * 2).subtract(rows("customer", "stray", F.col("c_custkey")))
    return stray.unionByName(rows("lineitem", "both", F.col("l_suppkey") * 2).intersect(rows("supplier", "both", F.col("s_suppkey"))))


@DEFINED.add("SELECT o_custkey AS path, max_by(o_orderpriority, o_orderkey) AS content FROM orders GROUP BY 1")
def last_write_wins(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("content"))
    return R.merge_last_wins(rows, "path", "seq").drop("seq")


@DEFINED.add("""
SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment <> 'BUILDING', lower(c_name) DESC, c_custkey)::INTEGER AS summary_order, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_acctbal, c_custkey)::INTEGER AS licence_order FROM customer""")
def named_orders(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", (F.col("c_mktsegment") != "BUILDING").alias("other"), F.lower("c_name").alias("name"), "c_mktsegment", "c_acctbal")
    # a name from the last to the first: the bucket is the negative of the number at its end, by thousands
    behind = -F.floor(F.substring_index("name", "#", -1).cast("long") / 1000)
    first = R.numbered(rows, ["c_nationkey"], ["other", F.desc("name"), "c_custkey"], "summary_order", F.struct("other", behind.alias("b")))
    both = R.numbered(first, ["c_nationkey"], ["c_mktsegment", "c_acctbal", "c_custkey"], "licence_order", F.struct("c_mktsegment", F.floor(F.col("c_acctbal") / 100).alias("b")))
    return both.select("c_custkey", "summary_order", "licence_order")


_CHUNKS = """
WITH RECURSIVE b AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(list_transform(ls, lambda l: strlen(l))) AS z, unnest(list_transform(ls, lambda l: strlen(l) < 60)) AS h FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
c AS (SELECT doc_id, i, 0 AS part, z AS bytes FROM b WHERE i = 1
  UNION ALL SELECT b.doc_id, b.i, CASE WHEN (c.bytes >= 400 AND b.h) OR c.bytes + b.z > 2000 THEN c.part + 1 ELSE c.part END, CASE WHEN (c.bytes >= 400 AND b.h) OR c.bytes + b.z > 2000 THEN b.z ELSE c.bytes + b.z END FROM c JOIN b ON b.doc_id = c.doc_id AND b.i = c.i + 1),
p AS (SELECT c.doc_id, part, sum(z) AS bytes, count(*) AS blocks, min(c.i) - 1 AS start FROM c JOIN b ON b.doc_id = c.doc_id AND b.i = c.i GROUP BY ALL),
s AS (SELECT *, sum(bytes) OVER (PARTITION BY doc_id ORDER BY part DESC) AS behind, max(part) OVER (PARTITION BY doc_id) AS last FROM p),
f AS (SELECT doc_id, CASE WHEN part > keep THEN keep ELSE part END AS part, bytes, blocks, start FROM (SELECT *, coalesce(max(part) FILTER (behind >= 150) OVER (PARTITION BY doc_id), 0) AS keep FROM s))
SELECT doc_id, part::INTEGER AS part, min(start)::INTEGER AS start, sum(blocks)::INTEGER AS blocks, sum(bytes)::BIGINT AS bytes FROM f GROUP BY doc_id, part"""


@DEFINED.add(_CHUNKS)
def greedy_chunks(spark, d):
    """Lines as blocks, short ones as headings; limits scaled down."""
    lines = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = lines.select("doc_id", "pos", F.octet_length("line").alias("size"), (F.octet_length("line") < 60).alias("heading"))
    return chunker.chunked(rows, "doc_id", "pos", "size", "heading", limit=2000, min_part=400, fold_below=150)


_REFRESH = """
WITH i AS (SELECT *, cached IS NULL AS first, cached IS NOT NULL AND refresh AND cached <> version AS changed FROM (SELECT event_id AS pos, user_id % 8 AS shelf, CASE WHEN event_id % 11 > 0 THEN CASE WHEN event_id % 3 = 0 THEN 'click' ELSE event_type END END AS cached, event_type AS version, event_id % 5 > 0 AS refresh FROM events)),
k AS (SELECT *, row_number() OVER (PARTITION BY shelf, first OR changed ORDER BY pos) AS k FROM i)
"""


@DEFINED.add(_REFRESH + "SELECT pos, shelf, CASE WHEN first THEN 'build' WHEN NOT changed THEN 'cached' WHEN k > 12 THEN 'stale' ELSE 'rebuild' END AS action, changed AND k > 12 AS deferred FROM k")
def budgeted_refresh(spark, d):
    return refresh.decide(_changes(spark, d), ["shelf"], 12).select("pos", "shelf", "action", "deferred")


@DEFINED.add(_REFRESH + "SELECT shelf, least(12, count(*) FILTER (first OR changed))::INTEGER AS used, count(*) FILTER (changed AND k > 12) AS n_deferred, array_to_string(list_sort(list(pos) FILTER (changed AND k > 12))[1:10], ' ') AS deferred FROM k GROUP BY shelf")
def refresh_totals(spark, d):
    out = refresh.totals(refresh.decide(_changes(spark, d), ["shelf"], 12), ["shelf"], 12)
    return out.withColumn("deferred", F.array_join(F.transform("deferred", lambda x: x.cast("string")), " "))


def _changes(spark, d):
    e = F.col("event_id")
    return table(spark, d, "events").select(e.alias("pos"), (F.col("user_id") % 8).alias("shelf"), F.when(e % 11 > 0, F.when(e % 3 == 0, "click").otherwise(F.col("event_type"))).alias("cached"), F.col("event_type").alias("version"), (e % 5 > 0).alias("refresh"))


_EDGES = "SELECT 'p' || p_partkey AS src, 'p' || ((p_partkey * 7 + p_size) % (SELECT count(*) FROM part)) AS dst FROM part UNION ALL SELECT 'p' || p_partkey, 'p' || (p_partkey // 2) FROM part"


@DEFINED.add(f"""
WITH RECURSIVE e AS ({_EDGES}), r(node, depth) AS (SELECT 'p5', 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON src = node WHERE depth < 40)
SELECT node, min(depth)::INTEGER AS depth FROM r GROUP BY node""")
def reachable_feeds(spark, d):
    part = table(spark, d, "part")
    n = part.agg(F.count("*").alias("n"))
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    a = part.join(n).select(name(F.col("p_partkey")).alias("src"), name((F.col("p_partkey") * 7 + F.col("p_size")) % F.col("n")).alias("dst"))
    b = part.select(name(F.col("p_partkey")).alias("src"), name(F.floor(F.col("p_partkey") / 2)).alias("dst"))
    return graph.reachable(a.unionByName(b), spark.sql("SELECT 'p5' AS node"))


_TREE = [("index", 0, "NAV", "uk/index"), ("index", 1, "NAV", "new"), ("index", 2, "NAV", "mixed"), ("mixed", 0, "NAV", "uk/index"), ("mixed", 1, "BOOK", "nioba"), ("new", 0, "BOOK", "misto"), ("uk/index", 0, "NAV", "uk/franko"), ("uk/index", 2147483648, "NAV", "uk/index-2"), ("uk/index-2", -1, "NAV", "uk/index"), ("uk/index-2", 0, "NAV", "uk/lesia"), ("uk/franko", 0, "BOOK", "zakhar"), ("uk/franko", 1, "BOOK", "boryslav"), ("uk/lesia", 0, "BOOK", "lisova")]
_DEPTHS = [("index", 0), ("uk/index", 1), ("new", 1), ("mixed", 1), ("uk/index-2", 2), ("uk/franko", 2), ("uk/lesia", 3)]
_BOOKS = [("nioba", "mixed"), ("misto", "new"), ("zakhar", "uk/franko"), ("boryslav", "uk/franko"), ("lisova", "uk/lesia")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_DEPTHS)}) t(feed, depth)")
def crawled_feeds(spark, d):
    return graph.crawl(rows_of(spark, "feed, pos, kind, href", _TREE), "index")[0]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_BOOKS)}) t(href, feeds)")
def crawled_books(spark, d):
    return graph.crawl(rows_of(spark, "feed, pos, kind, href", _TREE), "index")[1].withColumn("feeds", F.array_join("feeds", " "))


@DEFINED.example("SELECT * FROM (VALUES (1, 'index', 'NAV', 'uk/index'), (2, 'uk/index', 'NAV', 'uk/franko'), (3, 'uk/franko', 'BOOK', 'zakhar')) t(step, feed, kind, href)")
def scripted_walk(spark, d):
    return graph.walk(rows_of(spark, "feed, pos, kind, href", _TREE), "index")


@DEFINED.add("""
SELECT doc_id, title, octet FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title, strlen(text)::INTEGER AS octet FROM documents) WHERE octet > 6000 AND (contains(title, 'the') OR contains(title, 'und'))""")
def excluded_and_oversize(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.octet_length("text").alias("octet"))
    return rows.where((F.col("octet") > 6000) & X.matches_any("title", F.array(F.lit("the"), F.lit("und"))))
