"""Operators on small tables: trees, chunks, packages, feeds, refresh, streaming."""

import random

import pytest
from pyspark.sql import functions as F

from codexlake.functions import text
from codexlake.operators import book, chunker, graph, html_tree, refresh, relational, rules
from codexlake.plans import feedtree, queries_rules
from codexlake.plans.catalogue import navigation, shelf_pages
from codexlake.plans.queries_aggregates import sample_books
from codexlake.sources import archive, feeds, lists


def plain_chunks(blocks, limit, min_part, fold):
    out = []
    for k, (size, heading) in enumerate(blocks):
        if not out or (heading and out[-1][2] >= min_part) or out[-1][2] + size > limit:
            out.append([k, 0, 0])
        out[-1][1] += 1
        out[-1][2] += size
    while len(out) > 1 and out[-1][2] < fold:
        _, n, size = out.pop()
        out[-1][1] += n
        out[-1][2] += size
    return [tuple(c) for c in out]


def test_chunks_equal_the_plain_rule(spark):
    random.seed(4)
    docs = [[(random.choice([1, 5, 20, 70]), random.random() < 0.3) for _ in range(random.randint(1, 25))] for _ in range(200)]
    rows = spark.createDataFrame([(d, p, z, h) for d, blocks in enumerate(docs) for p, (z, h) in enumerate(blocks)], "doc long, pos long, size long, heading boolean")
    got = {}
    for r in chunker.chunked(rows, "doc", "pos", "size", "heading", 100, 40, 15).orderBy("doc", "part").collect():
        got.setdefault(r.doc, []).append((r.start, r.blocks, r.bytes))
    assert got == {d: plain_chunks(b, 100, 40, 15) for d, b in enumerate(docs)}


def test_split_loses_no_text(spark):
    body = "".join(f"<h3>H{k}</h3>" + "".join(f"<p>{'word ' * 40}{k}.{j}</p>" for j in range(6)) for k in range(5))
    page = f"<html><body>lead<div>{body}</div>tail</body></html>"
    blocks = html_tree.shredded(spark.createDataFrame([("d", page)], "doc_id string, html string"), limit=2000).cache()
    text = "".join(r.html for r in blocks.orderBy("pos").collect())
    assert text.count("word") == 1200 and "lead" in text and "tail" in text
    parts = chunker.chunked(blocks, "doc_id", "pos", "size", "heading", 2000, 800, 50).orderBy("part").collect()
    assert len(parts) > 1 and max(p.bytes for p in parts) <= 2000


def test_notes_are_filtered_and_renumbered():
    page = '<body><p>a<sup class="mw-ref"><a href="#cite_note-2"><span class="mw-reflink-text">[2]</span></a></sup>b<sup class="mw-ref"><a href="#cite_note-1"><span>[1]</span></a></sup></p><ol class="references"><li id="cite_note-1">editor</li><li id="cite_note-2">AUTHOR note</li></ol></body>'
    out = html_tree.clean_text(page, True, False, ["AUTHOR"])
    assert "[1]" in out[0] and "[2]" not in out[0] and "editor" not in out[0] and (out[6], out[7]) == (["AUTHOR note"], ["editor"])


def test_images_go_with_what_they_leave_empty():
    t = html_tree.Tree('<body><div><figure><img src="./a.jpg"/></figure></div>x</body>')
    assert html_tree.remove_images(t, True) == ["a.jpg"] and t.serialized() == "<body>x</body>"


def test_broken_documents_give_nulls(spark):
    docs = spark.createDataFrame([("a", "<p>", False, False, []), ("b", None, False, False, None)], "doc_id string, html string, strip_notes boolean, strip_images boolean, keep_markers array<string>")
    assert [r.html for r in html_tree.clean_documents(docs).collect()] == [None, None]


def test_archives_are_deterministic(spark):
    once = queries_rules.sample_archive(spark).where("slug = 'fine'")
    a, b = (archive.write_archives(once.orderBy(F.rand(seed))).first().content for seed in (1, 2))
    assert a == b


def test_feed_files_round_trip(spark, tmp_path):
    nav = navigation(sample_books(spark))
    entry = feeds.entry_xml(F.col("href"), F.col("title"), F.col("latest"), F.col("content"), F.lit("subsection"), F.lit("application/atom+xml"), F.col("href"))
    entries = nav.select("path", F.col("slot").alias("pos"), entry.alias("xml"))
    pages = nav.groupBy("path").agg(F.max("latest").alias("updated")).select("path", F.col("path").alias("feed_id"), F.lit("T & t").alias("title"), "updated", F.array(F.struct(F.lit("up").alias("rel"), F.lit("x").alias("type"), F.lit("../i.xml").alias("href"))).alias("links"))
    feeds.write_pages(feeds.render(pages, entries), str(tmp_path / "out"))
    heads, rows = feeds.read_feeds(spark, str(tmp_path / "out" / "*" / "*.txt"))
    assert {r.title for r in heads.collect()} == {"T & t"} and {r.up for r in heads.collect()} == {"../i.xml"}
    assert rows.count() == nav.count() and {r.kind for r in rows.collect()} == {"NAV"}


def test_feed_rules(spark):
    rows = spark.createDataFrame([("a", "BOOK", "https://x/b.epub"), ("a", "BOOK", "b.epub"), ("b", "NAV", "a")], "feed string, kind string, href string")
    fs = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", False)], "feed string, parsed boolean")
    files = spark.createDataFrame([("other.epub",)], "path string")
    got = {(r.feed, r.rule) for r in rules.feed_rules(fs, rows, files, "https://x/", 1).collect()}
    assert got == {("a", "too_many"), ("a", "outside_base"), ("a", "not_absolute"), ("a", "no_file"), ("c", "empty"), ("d", "not_parsed")}


def test_last_feed_link_wins(spark):
    rows = spark.sql("SELECT array(named_struct('rel', 'http://opds-spec.org/acquisition', 'type', 'application/epub+zip', 'href', 'b'), named_struct('rel', 'x', 'type', 'application/atom+xml', 'href', 'f'), named_struct('rel', 'x', 'type', 'application/atom+xml', 'href', 'g')) AS l")
    assert tuple(rows.select(graph.entry_kind(F.col("l"))).first()[0]) == ("NAV", "g")


def test_refresh_matches_a_simulation(spark):
    random.seed(2)
    items = [(k, random.choice([None, "a", "b"]), random.choice("ab"), random.random() < 0.8) for k in range(200)]
    used, want = 0, []
    for _, cached, version, asked in items:
        first, changed = cached is None, cached is not None and asked and cached != version
        free = used < 20
        used += (first or changed) and free
        want.append("build" if first else "cached" if not changed else "rebuild" if free else "stale")
    rows = spark.createDataFrame([(0, *i) for i in items], "shelf int, pos long, cached string, version string, refresh boolean")
    assert [r.action for r in refresh.decide(rows, ["shelf"], 20).orderBy("pos").collect()] == want


def test_refresh_stream(spark, tmp_path):
    from codexlake.streaming.refresh import refresh_stream

    rows = spark.createDataFrame([(0, 1, None, "a", True), (0, 2, "a", "b", True)], "shelf int, pos long, cached string, version string, refresh boolean")
    rows.write.parquet(str(tmp_path / "in"))
    query = refresh_stream(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "out"), str(tmp_path / "cp"), ["shelf"], 12)
    query.awaitTermination(120)
    assert sorted((r.pos, r.action) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "build"), (2, "rebuild")]


def test_curated_lists(spark):
    text = "books:\n- {slug: a, title: T, author: A B, summary: S, edition: {city: null, publisher: P, year: 1900}, keep_note_markers: [x]}\n- {slug: b, title: U, author: C, summary: S, edition: {year: 1901}}\n"
    books = lists.read_books(spark, text, "uk")
    assert [(r.pos, r.slug, r.edition.year) for r in books.orderBy("pos").collect()] == [(0, "a", 1900), (1, "b", 1901)]
    assert lists.read_books(spark, text, "uk", ["b"]).count() == 1
    with pytest.raises(ValueError):
        lists.books_from_rows(spark, [{"slug": "x"}], "uk")
    en = lists.books_from_rows(spark, [{"slug": "e", "title": "T", "author": "A", "author_sort": "A", "category": "fiction", "summary": "s"}], "en")
    assert lists.all_books(books, en).count() == 3


def test_cached_files_and_revisions(spark, tmp_path):
    (tmp_path / "a.epub").write_bytes(b"PK..")
    (tmp_path / "b.epub").write_bytes(b"<html>")
    books = spark.createDataFrame([("a",), ("b",), ("c",)], "slug string")
    got = lists.with_archives(books, lists.cached_files(spark, str(tmp_path)))
    assert {r.slug: r.usable for r in got.collect()} == {"a": True, "b": False, "c": False}
    answers = spark.createDataFrame([("a", '{"revid": 5, "timestamp": "2026-01-02T03:04:05Z"}'), ("b", "broken")], "slug string, json string")
    assert {r.slug: (r.revid, r.rev_time is None) for r in lists.revisions(books, answers).collect()} == {"a": (5, False), "b": (None, True), "c": (None, True)}


def test_pages_of_sixty_books(spark):
    first = sample_books(spark).where("slug = 'misto'")
    many = first.crossJoin(spark.range(60)).withColumns({"pos": F.col("id"), "slug": F.concat("slug", F.col("id").cast("string"))}).drop("id")
    pages = shelf_pages(many).groupBy("path").agg(F.max("page").alias("p"), F.max("slot").alias("s"))
    assert {r.path: (r.p, r.s) for r in pages.collect()} == {"opds/all": (2, 50), "opds/uk/genre-proza": (2, 50), "opds/uk/pidmohylnyi-valerian": (2, 50)}


def test_relational_on_empty_tables(spark):
    empty = spark.createDataFrame([], "k string, pos long, v string")
    assert relational.keep_first(empty, ["k"]).count() == 0 and relational.paged(empty, ["k"], ["pos"]).count() == 0
    assert relational.duplicates(empty, "k").count() == 0 and graph.reachable(spark.createDataFrame([], "src string, dst string"), empty.select(F.col("k").alias("node"))).count() == 0


def test_crawl_totals(spark):
    rows = spark.createDataFrame([("a", 0, "NAV", "b"), ("a", 1, "NAV", "c"), ("b", 0, "BOOK", "x"), ("b", 1, "BOOK", "y"), ("c", 0, "BOOK", "x"), ("c", 1, "NAV", "a"), ("far", 0, "BOOK", "z")], "feed string, pos long, kind string, href string")
    assert [tuple(graph.crawl_totals(rows, "a", n).first()) for n in (2, 3, None)] == [(3, 1, 3, 3, 2, x) for x in (True, False, None)]


def test_collection_titles_become_book_titles(spark):
    page = "<html xmlns='http://www.w3.org/1999/xhtml'><head><title>{}</title></head><body><p>x</p></body></html>"
    docs = spark.createDataFrame([(1, page.format("Тво ри. Том II"), "Book"), (2, page.format("Own"), "Book"), (3, page.format("Твори"), None)], "doc_id long, html string, book_title string")
    docs = docs.withColumns({"strip_notes": F.lit(False), "strip_images": F.lit(False), "keep_markers": F.array().cast("array<string>")})
    for frame, wanted in ((docs, ["Book", "Own", "Твори"]), (docs.drop("book_title"), ["Тво ри. Том II", "Own", "Твори"])):
        got = html_tree.clean_documents(frame).orderBy("doc_id").collect()
        assert all(f"{t}</" in r.html for r, t in zip(got, wanted))


def test_tree_edits_nest():
    def cleaned(body):
        return html_tree.clean_text(f"<body>{body}</body>", False, False, [])[0][6:-7]

    assert cleaned("<p><i>a<table><tr><td>x</td></tr></table></i></p>") == "<div><div>a<table><tr><td>x</td></tr></table></div></div>"
    assert cleaned("<b><dl><dd>a</dd></dl></b>") == '<b><span style="display:block" class="dl"><span style="display:block" class="dd">a</span></span></b>'.replace(' style="display:block" class="dl"', ' class="dl" style="display:block"').replace(' style="display:block" class="dd"', ' class="dd" style="display:block"')
    assert cleaned('<p align="center" style="color:red">x<p>y</p></p>') == '<p style="color:red; text-align:center">x<span style="display:block">y</span></p>'.replace("color:red; text-align:center", "color:red; text-align:center")
    assert cleaned("<ul><li><p>x</p></li></ul>") == "<ul><li><p>x</p></li></ul>"
    assert html_tree.clean_text('<body class="x"><p>a</p></body>', False, False, [], body_class="ours")[0] == '<body class="ours"><p>a</p></body>'


def test_css_of_trees_equals_css_of_columns(spark):
    styles = ["color: RED ;margin:0!important", "position:absolute;width:1px", "a:;b:(;c:')", "1x:2;-x-y:z", "font-family:x", "", ";;", "a:b:c", "k : url('a;b')", "e:f ! important"]
    got = spark.createDataFrame([(s,) for s in styles], "s string").select(text.css_declarations("s").alias("d")).collect()
    assert [(r.d.clean, len(r.d.dropped)) for r in got] == [html_tree.clean_css(s) for s in styles]


def test_split_pages_keep_wrappers_and_text():
    body = "lead<div class='w'>" + "".join(f"<h3 id='h{k}'>H{k}</h3>" + "".join(f"<p>{'word ' * 40}{k}.{j}</p>tail{k}.{j}" for j in range(6)) for k in range(5)) + "</div>end"
    page = f"<html xmlns='http://www.w3.org/1999/xhtml'><head><title>T</title></head><body class='b'>{body}</body></html>"
    parts = html_tree.split_page(page, 2000, 800, 50)
    assert len(parts) == 5 and html_tree.split_page(page) == [page]
    trees = [html_tree.Tree(x) for x in parts]
    assert "".join("".join(t.root[1].itertext()) for t in trees) == "".join(html_tree.Tree(page).root[1].itertext())
    assert all(t.root[0][0].text == "T" and t.root[1].get("class") == "b" and t.root[1][0].get("class") == "w" for t in trees)


def test_way_back_of_a_walk(spark):
    rows = spark.createDataFrame([("a", 0, "NAV", "b"), ("b", 0, "NAV", "c"), ("c", 0, "BOOK", "x")], "feed string, pos long, kind string, href string")
    walked = graph.walk(rows, "a")
    assert [tuple(r) for r in graph.back_stack(walked, rows).orderBy("step").collect()] == [(1, "a", None, True), (2, "b", "a", True), (3, "c", "b", True)]
    assert [r.fine for r in graph.back_stack(walked, rows.where("feed <> 'b'")).orderBy("step").collect()] == [True, True, False]


def test_ranks_in_buckets_equal_plain_ranks(spark):
    random.seed(8)
    rows = spark.createDataFrame([(random.choice(["a", "b", None]), random.randrange(500), k) for k in range(600)], "p string, v long, k long")
    plain = relational.numbered(relational.numbered(rows, ["p"], ["v", "k"], "x"), ["p"], ["v", "k"], "y", F.floor(F.col("v") / 7))
    assert plain.where("x <> y").count() == 0 and plain.count() == 600
    a, b = (relational.paged(rows, ["p"], ["v", "k"], 10, bucket) for bucket in (None, F.floor(F.col("v") / 50)))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_small_functions(spark):
    row = spark.range(1).select(
        text.rewritten_css(F.lit('@font-face { src: x }\nbody { font-family: "FreeSerif"; }\np{}'), "/* more */").alias("css"), text.list_of_changes((None, F.lit("a")), (F.lit(False), F.lit("b")), (F.lit(True), F.lit("c"))).alias("changes"),
        text.is_list_of_illustrations(F.lit("t/loi.xhtml"), F.lit("")).alias("loi"), text.shows_only(F.lit("<title>A long title of forty letters and more, surely</title><img src='old.jpg'/>"), F.lit("old.jpg")).alias("cover"), text.shows_only(F.lit("old.jpg " + "word " * 20), F.lit("old.jpg")).alias("page"),
        text.is_large_image(F.lit("image/png"), F.lit("a/logo.png"), F.lit(90_000)).alias("logo"), text.is_large_image(F.lit("image/png"), F.lit("a/x.png"), F.lit(50_000)).alias("large"), text.ascii_apostrophes(F.lit("м'ята")).alias("apostrophe"),
        text.drop_srcset(F.lit('<img src="a" srcset="b 2x"/>')).alias("srcset"), text.local_path(F.lit("https://x/a/b"), "https://x/").alias("local"), text.is_font_item(F.lit("font/ttf"), F.lit("x")).alias("font"),
        text.is_heading(F.lit("p"), F.lit("text-align: center"), F.lit(None).cast("array<string>"), F.lit("Chapter"), F.lit(0)).alias("heading"),
    ).first()
    assert row.css == "p{}/* more */" and row.changes == ["a", "c"] and row.loi and row.cover and not row.page and not row.logo and row.large and row.apostrophe == "м’ята"
    assert tuple(row.srcset) == ('<img src="a"/>', 1) and row.local == "a/b" and row.font and row.heading


def wiki_book():
    import io
    import zipfile

    def page(body, title="x"):
        return f'<?xml version="1.0" encoding="UTF-8"?><html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>{title}</title></head><body>{body}</body></html>'

    long = "".join(f'<h3 id="h{k}">Part {k}</h3>' + "".join(f"<p>{'word ' * 60}</p>" for _ in range(8)) for k in range(4))
    members = {
        "mimetype": "application/epub+zip", "META-INF/container.xml": '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OPS/content.opf"/></rootfiles></container>',
        "OPS/title.xhtml": page("logo"), "OPS/c0_Book.xhtml": page('<p><a href="c1_Book_One.xhtml" title="Book/One">One</a> <a href="c2_Ad.xhtml" title="Other">Ad</a> <a href="c1_Book_One.xhtml#h3">there</a> <a href="#none">dead</a> <a href="http://x.org/">out</a></p><p><img src="images/a.png" alt=""/><img src="images/odd" alt=""/></p>'),
        "OPS/c1_Book_One.xhtml": page(long), "OPS/c2_Ad.xhtml": page("buy"), "OPS/about.xhtml": page("source"), "OPS/images/a.png": "x", "OPS/images/b.png": "x", "OPS/images/odd": "x", "OPS/fonts/f.ttf": "x",
        "OPS/main.css": '@font-face { src: x }\nbody { font-family: "FreeSerif"; }\np{}', "OPS/nav.xhtml": page('<nav epub:type="toc"><ol><li><a href="title.xhtml">T</a></li><li><a href="c2_Ad.xhtml">Ad</a></li></ol></nav>'),
        "OPS/toc.ncx": '<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/"><navMap><navPoint id="a" playOrder="1"><navLabel><text>Root</text></navLabel><content src="title.xhtml"/></navPoint><navPoint id="b" playOrder="2"><navLabel><text>Chapter One</text></navLabel><content src="c1_Book_One.xhtml"/></navPoint></navMap></ncx>',
        "OPS/content.opf": """<package xmlns="http://www.idpf.org/2007/opf" unique-identifier="old"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>Old</dc:title></metadata><manifest>
          <item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="css" href="main.css" media-type="text/css"/><item id="f" href="fonts/f.ttf" media-type="font/ttf"/>
          <item id="title" href="title.xhtml" media-type="application/xhtml+xml"/><item id="c0" href="c0_Book.xhtml" media-type="application/xhtml+xml"/><item id="c1" href="c1_Book_One.xhtml" media-type="application/xhtml+xml"/><item id="c1" href="c1_Book_One.xhtml" media-type="application/xhtml+xml"/>
          <item id="c2" href="c2_Ad.xhtml" media-type="application/xhtml+xml"/><item id="about" href="about.xhtml" media-type="application/xhtml+xml"/><item id="a" href="images/a.png" media-type="image/png"/><item id="b" href="images/b.png" media-type="image/png"/><item id="o" href="images/odd" media-type="image/png"/>
          </manifest><spine toc="ncx"><itemref idref="title"/><itemref idref="c0"/><itemref idref="c1"/><itemref idref="c2"/><itemref idref="about"/></spine></package>""",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_whole_books(spark):
    """An export of a wiki becomes a sound book: the rules find nothing, foreign pages are out, links lead where their ids are."""
    import io
    import zipfile

    books = spark.createDataFrame([("b", "Book", "An Author", "uk", "About & so", "Book"), ("bad", "Bad", "A", "uk", None, "Bad")], "slug string, title string, author string, lang string, summary string, page string")
    files = spark.createDataFrame([("b", bytearray(wiki_book())), ("bad", bytearray(b"no zip"))], "slug string, content binary")
    out, log = book.transform(files, books, "uk", body_class="ours", limit=6000, min_part=2000, fold_below=100)
    out = out.collect()
    assert [r.slug for r in out] == ["b"]
    z = zipfile.ZipFile(io.BytesIO(bytes(out[0].content)))
    names = set(z.namelist())
    assert z.namelist()[0] == "mimetype" and not names & {"OPS/title.xhtml", "OPS/c2_Ad.xhtml", "OPS/fonts/f.ttf", "OPS/images/b.png", "OPS/images/odd"} and {"OPS/images/img01.png", "OPS/images/a.png", "OPS/cover.xhtml", "OPS/credits.xhtml", "OPS/images/cover.jpg", "OPS/c1_Book_One-p2.xhtml"} <= names
    read = lambda name: z.read(name).decode()
    root = read("OPS/c0_Book.xhtml")
    owner = next(n for n in sorted(names) if n.startswith("OPS/c1_") and 'id="h3"' in read(n))
    assert f'href="{owner[4:]}#h3"' in root and owner != "OPS/c1_Book_One.xhtml" and 'src="images/img01.png"' in root and "dead" in root and "#none" not in root and "Ad" in root and "c2_Ad" not in root and 'class="ours"' in root
    assert read("OPS/main.css").startswith("p{}") and "FreeSerif" not in read("OPS/main.css")
    assert "Chapter One" in read("OPS/nav.xhtml") and "Part 0" not in root and 'playOrder="1"' in read("OPS/toc.ncx") and "About &amp; so" in read("OPS/content.opf")
    assert {(r.what, r.subject) for r in log.collect()} >= {("duplicate item", "c1"), ("font", "OPS/fonts/f.ttf"), ("title page", "title.xhtml"), ("foreign chapter", "c2_Ad.xhtml"), ("split", "c1_Book_One.xhtml"), ("unused image", "b.png"), ("renamed image", "odd"), ("dangling link", "#none")}
    again = spark.createDataFrame([("b", bytearray(out[0].content))], "slug string, content binary")
    assert rules.violations(archive.tables(archive.unzip(again).cache())).collect() == []


def test_feed_tree_on_disk(spark, tmp_path):
    files = feedtree.feed_files(sample_books(spark), feedtree.Site("https://x.org/", "T & t", "S", "A"))
    feeds.write_tree(files, str(tmp_path / "out"))
    heads, rows = feeds.read_feeds(spark, str(tmp_path / "out"))
    names = {str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*.xml")}
    assert names == {r.path for r in files.collect()} and "opds/uk/franko-ivan.xml" in names and not list((tmp_path / "out").rglob("*.part"))
    kinds = {r.kind for r in rows.collect()}
    assert kinds == {"NAV", "BOOK"} and "T & t" in {r.title for r in heads.collect()}
