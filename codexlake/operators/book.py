"""Whole-book transforms, over the tables of many books at once.

A Package holds files(slug, path, content), items(slug, ord, item_id, href, path, media_type, properties), spine(slug, ord,
item_id), books (slug, opf_path and the columns of the list) and log(slug, what, subject), a row for every change. Each
step is a function from Package to Package whose joins are keyed by slug; documents are edited as texts in columns, and as
trees only where nesting decides. What steps read again is checkpointed, so plans stay short.

Columns of books that the steps read: title, author, lang, summary, page (the name of the root page), exclude_pages,
strip_notes, strip_images, keep_markers, cover (JPEG bytes), year, modified; missing ones count as null.

Defined results: a book whose container or package file cannot be read gives no package and is left out; items without a
file stay in the manifest; documents that do not parse stay as they are; books without documents get cover and credits.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import collation as K
from ..functions import text as X
from ..sources import archive as A
from . import html_tree
from . import relational as R
from .lineage import checkpointed

XHTML = "application/xhtml+xml"
LIMIT = 280_000
NO_STRINGS = "array<string>"
_EXTENSIONS = {"image/jpeg": ".jpg", "image/png": ".png", "image/gif": ".gif", "image/svg+xml": ".svg", "image/webp": ".webp"}


@dataclass(frozen=True)
class Package:
    files: DataFrame
    items: DataFrame
    spine: DataFrame
    books: DataFrame
    log: DataFrame

    def noted(self, rows: DataFrame) -> DataFrame:
        return self.log.unionByName(rows)


def note(rows: DataFrame, what: str, subject) -> DataFrame:
    return rows.select("slug", F.lit(what).alias("what"), (F.col(subject) if isinstance(subject, str) else subject).cast("string").alias("subject"))


def _column(books: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in books.columns else F.lit(None).cast(kind).alias(name)


def read(files: DataFrame, books: DataFrame) -> Package:
    """files: (slug, content) zips. Items and places in the spine that come twice count once."""
    archive = checkpointed(A.unzip(files))
    tables = A.tables(archive)
    found = tables["books"].where("zip_ok AND opf_path IS NOT NULL").select("slug", "opf_path")
    items = tables["manifest"].select("slug", F.col("ord").cast("long").alias("ord"), "item_id", "href", "path", "media_type", "properties")
    spine = tables["spine"].select("slug", F.col("ord").cast("long").alias("ord"), F.col("idref").alias("item_id"))
    once = checkpointed(R.keep_first(items, ["slug", "item_id"], "ord"))
    log = note(items.join(once.select("slug", "item_id", "ord"), ["slug", "item_id", "ord"], "left_anti"), "duplicate item", "item_id")
    kinds = {"title": "string", "author": "string", "lang": "string", "summary": "string", "page": "string", "exclude_pages": NO_STRINGS, "strip_notes": "boolean", "strip_images": "boolean", "keep_markers": NO_STRINGS, "cover": "binary", "year": "int", "modified": "timestamp"}
    own = books.select("slug", *[_column(books, c, k).cast(k).alias(c) for c, k in kinds.items()]).join(found, "slug")
    return Package(archive.where("zip_ok AND path IS NOT NULL").select("slug", "path", "content").join(found.select("slug"), "slug", "left_semi"), once, R.keep_first(spine, ["slug", "item_id"], "ord"), checkpointed(own), log)


def texts(p: Package, media_type: str = XHTML) -> DataFrame:
    """(slug, item_id, path, text) of the items of a kind."""
    kinds = p.items.where(F.col("media_type") == media_type).select("slug", "item_id", "path")
    return p.files.join(kinds, ["slug", "path"]).select("slug", "item_id", "path", F.decode("content", "UTF-8").alias("text"))


def with_texts(files: DataFrame, changed: DataFrame) -> DataFrame:
    """files with the contents of changed (slug, path, text) put in place or added."""
    new = changed.select("slug", "path", F.encode("text", "UTF-8").alias("content"))
    return files.join(new, ["slug", "path"], "left_anti").unionByName(new)


def without_items(p: Package, gone: DataFrame, what: str) -> Package:
    """Without the items of gone (slug, item_id): neither in the manifest, the spine, the files nor the tables of contents."""
    gone = checkpointed(gone.select("slug", "item_id").join(p.items.select("slug", "item_id", "path"), ["slug", "item_id"]))
    keys = gone.select("slug", "item_id")
    names = gone.groupBy("slug").agg(F.array_join(F.array_sort(F.collect_set(quoted(X.basename("path")))), "|").alias("names"))
    toc = p.files.where(F.col("path").rlike(r"(?i)\.(ncx|x?html)$")).withColumn("text", F.decode("content", "UTF-8"))
    toc = toc.where(F.col("path").endswith(".ncx") | F.contains("text", F.lit('epub:type="toc"'))).join(names, "slug")
    toc = checkpointed(toc.select("slug", "path", without_entries(F.col("text"), F.col("names"), F.col("path").endswith(".ncx")).alias("text")))
    files = with_texts(p.files, toc).join(gone.select("slug", "path"), ["slug", "path"], "left_anti")
    return replace(p, files=checkpointed(files), items=checkpointed(p.items.join(keys, ["slug", "item_id"], "left_anti")), spine=checkpointed(p.spine.join(keys, ["slug", "item_id"], "left_anti")), log=p.noted(note(gone, what, X.basename("path"))))


def quoted(text: Column) -> Column:
    """A pattern for just this text."""
    return F.regexp_replace(text, r"([^\p{L}\p{N}_/-])", r"\\$1")


def without_entries(text: Column, names: Column, ncx: Column) -> Column:
    """A table of contents without the entries for files of these names (alternatives of a pattern); places are numbered anew."""
    point = F.concat(F.lit(r'(?s)<navPoint\b(?:(?!<navPoint\b).)*?<content src="(?:[^"]*/)?(?:'), names, F.lit(r')(?:#[^"]*)?"\s*/>\s*</navPoint>\s*'))
    entry = F.concat(F.lit(r'(?s)<li\b[^>]*>\s*<a [^>]*?href="(?:[^"]*/)?(?:'), names, F.lit(r')(?:#[^"]*)?"[^>]*>(?:(?!</a>).)*</a>\s*</li>\s*'))
    pieces = F.split(F.regexp_replace(text, point, F.lit("")), r'playOrder="\d+"')
    counted = F.array_join(F.transform(pieces, lambda x, k: F.when(k == 0, x).otherwise(F.concat(F.lit('playOrder="'), k.cast("string"), F.lit('"'), x))), "")
    return F.when(ncx, counted).otherwise(F.regexp_replace(text, entry, F.lit("")))


def unlinked(text: Column, targets: Column) -> Column:
    """Links to the targets (alternatives of a pattern for href) become their text."""
    return F.regexp_replace(text, F.concat(F.lit(r'(?s)<a\b[^>]*?\shref="(?:'), targets, F.lit(r')"[^>]*>((?:(?!</a>).)*)</a>')), F.lit("$1"))


# steps


def without_fonts(p: Package, css: str = "") -> Package:
    """No embedded fonts, neither as items nor as files, and style sheets that do without them."""
    fonts = p.items.where(X.is_font_item("media_type", "href"))
    loose = p.files.where(F.concat(F.lit("/"), F.col("path")).contains("/fonts/")).select("slug", "path")
    gone = checkpointed(loose.unionByName(fonts.select("slug", "path")).distinct())
    files = p.files.join(gone, ["slug", "path"], "left_anti").where("path <> 'META-INF/com.apple.ibooks.display-options.xml'")
    items = p.items.join(fonts.select("slug", "item_id"), ["slug", "item_id"], "left_anti")
    sheets = texts(replace(p, items=items), "text/css").select("slug", "path", X.rewritten_css("text", css).alias("text"))
    return replace(p, files=checkpointed(with_texts(files, sheets)), items=checkpointed(items), log=p.noted(note(gone, "font", "path")))


def documents(p: Package) -> DataFrame:
    """(slug, ord, item_id, path, text): the documents of the spine but for the notice about the source."""
    return p.spine.join(texts(p), ["slug", "item_id"]).where("item_id <> 'about'")


def page_titles(docs: DataFrame) -> DataFrame:
    """(slug, file, title): the first titled link to a document of the same folder, in reading order."""
    tags = docs.select("slug", "ord", F.posexplode(F.regexp_extract_all("text", F.lit(r"(<a\b[^>]*>)"), 1)).alias("k", "tag"))
    value = lambda name: F.when(F.col("tag").rlike(rf'\s{name}="'), X.unescape_html(F.regexp_extract("tag", rf'\s{name}="([^"]*)"', 1)))
    links = tags.select("slug", F.struct("ord", "k").alias("pos"), F.split_part(value("href"), F.lit("#"), F.lit(1)).alias("file"), value("title").alias("title"))
    fine = links.where("file LIKE '%.xhtml' AND file NOT LIKE '%/%' AND title <> ''")
    return fine.groupBy("slug", "file").agg(F.min_by("title", "pos").alias("title"))


def own_chapters_only(p: Package) -> Package:
    """Documents that are neither the root page nor a page below it, or that are excluded by title, go; links to them as well."""
    docs = checkpointed(documents(p).select("slug", "ord", "item_id", "path", "text"))
    first = docs.groupBy("slug").agg(F.min("ord").alias("first"), F.min_by(X.basename("path"), "ord").alias("root_file"))
    named = docs.drop("text").withColumn("file", X.basename("path")).join(first, "slug").join(page_titles(docs), ["slug", "file"], "left").join(p.books.select("slug", "page", "exclude_pages"), "slug")
    own = X.is_own_chapter("title", "file", F.coalesce("page", F.lit("")), "root_file") & ~(F.col("title").isNotNull() & X.matches_any("title", "exclude_pages"))
    gone = checkpointed(named.where((F.col("ord") > F.col("first")) & ~own).select("slug", "item_id", "file"))
    names = gone.groupBy("slug").agg(F.concat(F.lit("(?:"), F.array_join(F.array_sort(F.collect_set(quoted(F.col("file")))), "|"), F.lit(r')(?:#[^"]*)?')).alias("names"))
    q = without_items(p, gone, "foreign chapter")
    fixed = documents(q).join(names, "slug").select("slug", "path", unlinked(F.col("text"), F.col("names")).alias("text"))
    return replace(q, files=checkpointed(with_texts(q.files, checkpointed(fixed))))


def cleaned(p: Package, body_class: str | None = None) -> Package:
    """The tree edits of operators.html_tree on every document of the spine."""
    flags = p.books.select("slug", F.coalesce("strip_notes", F.lit(False)).alias("strip_notes"), F.coalesce(F.col("strip_images") | F.col("strip_notes"), "strip_images", "strip_notes", F.lit(False)).alias("strip_images"), F.coalesce("keep_markers", F.array().cast(NO_STRINGS)).alias("keep_markers"), F.col("title").alias("book_title"))
    docs = documents(p).join(flags, "slug").select(F.struct("slug", "path").alias("key"), "*")
    wanted = docs.select(F.to_json("key").alias("doc_id"), F.col("text").alias("html"), "strip_notes", "strip_images", "keep_markers", "book_title")
    out = checkpointed(html_tree.clean_documents(wanted, body_class).where("html IS NOT NULL").withColumn("key", F.from_json("doc_id", "slug string, path string")))
    counted = out.select("key.slug", F.posexplode(F.array(*[F.lit(c) for c in ("licence_boxes", "toc_tables")])).alias("k", "what"), F.array("licence_boxes", "toc_tables").alias("n"))
    log = p.noted(note(out.select("key.slug", F.explode("images_removed").alias("x")), "image", "x")).unionByName(note(out.select("key.slug", F.explode("notes_removed").alias("x")), "note", "x")).unionByName(note(out.select("key.slug", F.explode("notes_kept").alias("x")), "kept note", "x"))
    log = log.unionByName(counted.where(F.get("n", F.col("k")) > 0).select("slug", "what", F.get("n", F.col("k")).cast("string").alias("subject")))
    return replace(p, files=checkpointed(with_texts(p.files, out.select("key.slug", "key.path", F.concat(F.lit(html_tree.PROLOG), "html").alias("text")))), log=log)


def owners_of_links(links: DataFrame, parts: DataFrame, ids: DataFrame) -> DataFrame:
    """links: (slug, path, target, id); parts: (slug, family, part, path); ids: (slug, path, id).

    (slug, path, target, id, owner): links into a page that was split whose id stands in another part now; owner is the first
    part that has it. Links whose own target has the id, or whose id no part has, do not come.
    """
    family = parts.select("slug", F.col("path").alias("target"), "family")
    held = parts.join(ids, ["slug", "path"]).groupBy("slug", "family", "id").agg(F.min_by("path", "part").alias("owner"))
    there = ids.select("slug", F.col("path").alias("target"), "id")
    return links.join(family, ["slug", "target"]).join(there, ["slug", "target", "id"], "left_anti").join(held, ["slug", "family", "id"]).select("slug", "path", "target", "id", "owner")


def links_of(pages: DataFrame) -> DataFrame:
    """pages: (slug, path, text). (slug, path, ref, target, id) of the references with a fragment and without a scheme."""
    refs = pages.select("slug", "path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r'\s(?:href|src)="([^"]*#[^"]+)"'), 1))).alias("ref")).where(~F.col("ref").rlike("^[a-z]+:"))
    target = F.when(F.col("ref").startswith("#"), F.col("path")).otherwise(X.resolve_path("path", "ref"))
    return refs.select("slug", "path", "ref", target.alias("target"), F.regexp_extract("ref", "#(.*)$", 1).alias("id"))


def ids_of(pages: DataFrame) -> DataFrame:
    return pages.select("slug", "path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r'\sid="([^"]+)"'), 1))).alias("id"))


def rewired(pages: DataFrame, changes: DataFrame) -> DataFrame:
    """pages: (slug, path, text); changes: (slug, path, old, new) values of href and src. The pages with changes, changed."""
    pairs = changes.groupBy("slug", "path").agg(F.array_sort(F.collect_set(F.struct("old", "new"))).alias("pairs"))
    both = F.flatten(F.transform("pairs", lambda x: F.array(*[F.struct(F.concat(F.lit(f' {a}="'), x["old"], F.lit('"')).alias("old"), F.concat(F.lit(f' {a}="'), x["new"], F.lit('"')).alias("new")) for a in ("href", "src")])))
    return pages.join(pairs, ["slug", "path"]).select("slug", "path", R.apply_renames(F.col("text"), both).alias("text"))


def split(p: Package, limit: int = LIMIT, min_part: int = 60_000, fold_below: int = 8_000) -> tuple[Package, DataFrame]:
    """Documents over limit in parts, with all links to what moved. Also (slug, path, label) of the new parts."""
    large = documents(p).where(F.octet_length("text") > limit).select("slug", "path", F.col("text").alias("html"))
    cut = checkpointed(html_tree.split_pages(large, limit, min_part, fold_below))
    several = cut.where("part > 0").select("slug", "path").distinct()
    stem = F.regexp_replace("path", r"\.[^./]*$", "")
    parts = checkpointed(cut.join(several, ["slug", "path"]).select("slug", F.col("path").alias("family"), "part", F.when(F.col("part") == 0, F.col("path")).otherwise(F.concat(stem, F.lit("-p"), (F.col("part") + 1).cast("string"), F.lit(".xhtml"))).alias("path"), F.col("html").alias("text"), "label"))
    files = checkpointed(with_texts(p.files, parts))
    new = parts.where("part > 0").select("slug", F.col("family").alias("path"), "part", F.col("path").alias("new"))
    apart = 100_000  # room for the parts of a document between it and the next one
    spread = lambda t: t.withColumn("ord", F.col("ord") * apart)
    folder = F.regexp_extract("href", "^(.*/)?[^/]*$", 1)
    more = spread(p.items).join(new, ["slug", "path"]).select("slug", (F.col("ord") + F.col("part")).alias("ord"), F.concat("item_id", F.lit("-p"), (F.col("part") + 1).cast("string")).alias("item_id"), F.concat(folder, X.basename("new")).alias("href"), F.col("new").alias("path"), "media_type", F.array().cast(NO_STRINGS).alias("properties"))
    places = spread(p.spine).join(p.items.select("slug", "item_id", "path"), ["slug", "item_id"]).join(new, ["slug", "path"]).select("slug", (F.col("ord") + F.col("part")).alias("ord"), F.concat("item_id", F.lit("-p"), (F.col("part") + 1).cast("string")).alias("item_id"))
    q = replace(p, files=files, items=checkpointed(spread(p.items).unionByName(more)), spine=checkpointed(spread(p.spine).unionByName(places)), log=p.noted(note(several, "split", X.basename("path"))))
    pages = q.files.where(F.col("path").rlike(r"(?i)\.(x?html|ncx)$")).join(several.select("slug").distinct(), "slug", "left_semi").select("slug", "path", F.decode("content", "UTF-8").alias("text"))
    links = checkpointed(links_of(pages))
    moved = owners_of_links(links, parts.select("slug", "family", "part", "path"), ids_of(pages))
    way = F.when(F.col("owner") == F.col("path"), "").otherwise(X.relative_path("owner", X.dirname("path")))
    changes = links.join(moved, ["slug", "path", "target", "id"]).select("slug", "path", F.col("ref").alias("old"), F.concat(way, F.lit("#"), "id").alias("new"))
    q = replace(q, files=checkpointed(with_texts(q.files, checkpointed(rewired(pages, changes)))))
    return q, parts.where("part > 0").select("slug", "path", "label")


def dangling(links: DataFrame, ids: DataFrame, pages: DataFrame) -> DataFrame:
    """links: (slug, path, ref, target, id): those into a page that is there and has no such id."""
    return links.join(pages.select("slug", F.col("path").alias("target")), ["slug", "target"], "left_semi").join(ids.select("slug", F.col("path").alias("target"), "id"), ["slug", "target", "id"], "left_anti")


def without_dangling_links(p: Package) -> Package:
    """Links to ids that no longer exist become their text."""
    pages = p.files.where(F.col("path").rlike(r"(?i)\.x?html$")).select("slug", "path", F.decode("content", "UTF-8").alias("text"))
    loose = checkpointed(dangling(links_of(pages), ids_of(pages), pages))
    targets = loose.groupBy("slug", "path").agg(F.array_join(F.array_sort(F.collect_set(quoted(F.col("ref")))), "|").alias("refs"))
    fixed = pages.join(targets, ["slug", "path"]).select("slug", "path", unlinked(F.col("text"), F.col("refs")).alias("text"))
    return replace(p, files=checkpointed(with_texts(p.files, checkpointed(fixed))), log=p.noted(note(loose, "dangling link", "ref")))


def unused_images(images: DataFrame, pages: DataFrame) -> DataFrame:
    """images: (slug, path, ...); pages: (slug, text). The images whose file name stands in no page or style sheet."""
    named = pages.select("slug", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r'([^"/()\s,#]+)(?=["#)\s,])'), 1))).alias("file")).distinct()
    return images.withColumn("file", X.basename("path")).join(named, ["slug", "file"], "left_anti").drop("file")


def without_unused_images(p: Package) -> Package:
    """Images that no document and no style sheet names go; the cover stays."""
    images = p.items.where(F.col("media_type").startswith("image/") & ~F.array_contains("properties", "cover-image"))
    pages = p.files.where(F.col("path").rlike(r"(?i)\.(x?html|css)$")).select("slug", F.decode("content", "UTF-8").alias("text"))
    gone = checkpointed(unused_images(images, pages).select("slug", "item_id", "path"))
    keys = gone.select("slug", "item_id")
    return replace(p, files=checkpointed(p.files.join(gone.select("slug", "path"), ["slug", "path"], "left_anti")), items=checkpointed(p.items.join(keys, ["slug", "item_id"], "left_anti")), log=p.noted(note(gone, "unused image", X.basename("path"))))


def with_image_names(p: Package) -> Package:
    """Images without an extension of their kind get numbered names, in documents as well."""
    odd = p.items.where(F.col("media_type").startswith("image/") & ~F.lower("href").rlike(r"\.(jpe?g|png|gif|svg|webp)$"))
    kind = F.create_map(*[F.lit(x) for pair in _EXTENSIONS.items() for x in pair])
    number = F.concat(F.lit("img"), F.lpad(F.col("rn").cast("string"), 2, "0"))
    named = R.numbered(odd, ["slug"], ["ord"]).withColumns({"new_id": number, "new_href": F.concat(F.lit("images/"), number, F.coalesce(F.element_at(kind, F.col("media_type")), F.lit(".bin")))})
    folder = p.books.select("slug", X.dirname("opf_path").alias("folder"))
    named = checkpointed(named.join(folder, "slug").withColumn("new_path", X.normalize_path(F.concat_ws("/", F.nullif("folder", F.lit("")), "new_href"))))
    moved = named.select("slug", "path", "new_path")
    files = p.files.join(moved, ["slug", "path"], "left").select("slug", F.coalesce("new_path", "path").alias("path"), "content")
    new = named.select("slug", "item_id", "new_id", "new_href", "new_path")
    items = p.items.join(new, ["slug", "item_id"], "left").select("slug", "ord", F.coalesce("new_id", "item_id").alias("item_id"), F.coalesce("new_href", "href").alias("href"), F.coalesce("new_path", "path").alias("path"), "media_type", "properties")
    pages = texts(p)
    near = lambda c: X.relative_path(c, X.dirname(F.col("page")))
    changes = pages.select("slug", F.col("path").alias("page")).join(moved, "slug").select("slug", F.col("page").alias("path"), near(F.col("path")).alias("old"), near(F.col("new_path")).alias("new"))
    return replace(p, files=checkpointed(with_texts(files, checkpointed(rewired(pages.select("slug", "path", "text"), changes)))), items=checkpointed(items), log=p.noted(note(named, "renamed image", X.basename("path"))))


# generated pages


def _page(lang, title, head: str, body) -> Column:
    opening = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" xml:lang="%s" lang="%s">\n<head><meta charset="UTF-8"/><title>%s</title>' + head.replace("%", "%%") + "</head>\n%s\n</html>\n"
    return F.format_string(opening, lang, lang, X.escape_html(title), body)


def cover_page(title, lang, image) -> Column:
    style = "<style>html,body{margin:0;padding:0;text-align:center} img{max-width:100%;max-height:100%}</style>"
    body = F.concat(F.lit('<body epub:type="cover"><div class="cover"><img src="'), X.escape_html(image), F.lit('" alt="'), X.escape_html(title), F.lit('"/></div></body>'))
    return _page(lang, title, style, body)


def credits_page(heading, lang, paragraphs: Column, changes: Column, label) -> Column:
    """paragraphs: array of texts; changes: array of texts, a list below the label."""
    each = lambda tag: lambda x: F.concat(F.lit(f"<{tag}>"), X.escape_html(x), F.lit(f"</{tag}>"))
    body = F.concat(
        F.lit('<body epub:type="backmatter">\n<section epub:type="colophon">\n<h2>'), X.escape_html(heading), F.lit("</h2>\n"), F.array_join(F.transform(paragraphs, each("p")), "\n"),
        F.lit("\n<p><b>"), X.escape_html(label), F.lit("</b></p>\n<ul>\n"), F.array_join(F.transform(changes, each("li")), "\n"), F.lit("\n</ul>\n</section>\n</body>"),
    )
    return _page(lang, heading, "", body)


def nav_page(title, lang, heading, toc: Column, landmarks: Column) -> Column:
    """toc: array<struct<label, href>>; landmarks: array<struct<type, label, href>>."""
    line = lambda x, more: F.concat(F.lit("<li><a "), more, F.lit('href="'), X.escape_html(x["href"]), F.lit('">'), X.escape_html(x["label"]), F.lit("</a></li>"))
    marks = F.transform(landmarks, lambda x: line(x, F.concat(F.lit('epub:type="'), x["type"], F.lit('" '))))
    body = F.concat(F.lit('<body>\n<nav epub:type="toc" id="toc"><h1>'), X.escape_html(heading), F.lit("</h1>\n<ol>\n"), F.array_join(F.transform(toc, lambda x: line(x, F.lit(""))), "\n"), F.lit('\n</ol>\n</nav>\n<nav epub:type="landmarks" id="landmarks" hidden="hidden">\n<ol>\n'), F.array_join(marks, "\n"), F.lit("\n</ol>\n</nav>\n</body>"))
    return _page(lang, title, "", body)


def ncx_page(uid, title, author, lang, toc: Column) -> Column:
    point = lambda x, k: F.format_string('<navPoint id="np%d" playOrder="%d"><navLabel><text>%s</text></navLabel><content src="%s"/></navPoint>', k + 1, k + 1, X.escape_html(x["label"]), X.escape_html(x["href"]))
    meta = "".join(f'<meta name="dtb:{n}" content="{v}"/>\n' for n, v in (("depth", 1), ("totalPageCount", 0), ("maxPageNumber", 0)))
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/" version="2005-1" xml:lang="'), lang, F.lit('">\n<head>\n<meta name="dtb:uid" content="'), X.escape_html(uid), F.lit(f'"/>\n{meta}</head>\n<docTitle><text>'),
        X.escape_html(title), F.lit("</text></docTitle>\n<docAuthor><text>"), X.escape_html(author), F.lit("</text></docAuthor>\n<navMap>\n"), F.array_join(F.transform(toc, point), "\n"), F.lit("\n</navMap>\n</ncx>\n"),
    )


def ncx_labels(p: Package) -> DataFrame:
    """(slug, href, label, first) of the old table of contents; first is the label of its first entry."""
    ncx = texts(p, "application/x-dtbncx+xml").select("slug", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?s)<navPoint\b.*?<content\b[^>]*>"), 0)).alias("pos", "x"))
    label, href = F.regexp_extract("x", r"(?s)<text>(.*?)</text>", 1), F.regexp_extract("x", r'src="([^"#]*)', 1)
    rows = ncx.select("slug", "pos", X.collapse_space(X.unescape_html(label)).alias("label"), X.unescape_html(href).alias("href"))
    first = rows.groupBy("slug").agg(F.min_by("label", "pos").alias("first"))
    return rows.groupBy("slug", "href").agg(F.max_by("label", "pos").alias("label")).join(first, "slug")


def toc_entries(p: Package, part_labels: DataFrame, labels: DataFrame, fixed: dict[str, str]) -> DataFrame:
    """(slug, toc): array<struct<label, href>> in reading order. labels: those of the old table (ncx_labels); fixed: by item id.

    A part of a split page stands there if it begins with a heading; labels that are missing, that only repeat the first
    entry's, that name a collection or end in the book's title behind a dash give way to the book's title.
    """
    short = F.split_part("title", F.lit(" ("), F.lit(1))
    given = F.coalesce(*[F.when(F.col("item_id") == k, F.lit(v)) for k, v in fixed.items()], F.lit(None).cast("string"))
    folder = p.books.select("slug", "title")
    rows = p.spine.join(p.items.select("slug", "item_id", "href", "path"), ["slug", "item_id"]).join(folder, "slug").join(labels, ["slug", "href"], "left").join(part_labels.select("slug", "path", F.col("label").alias("part_label"), F.lit(True).alias("is_part")), ["slug", "path"], "left")
    vague = F.coalesce("label", F.lit("")).isin("") | (F.col("label") == F.col("first")) | (F.contains("label", F.lit("—")) & F.endswith("label", short)) | F.regexp_replace("label", r"(?U)\s", "").startswith("Твори")
    label = F.when(F.col("is_part"), F.col("part_label")).otherwise(F.coalesce(given, F.when(vague, F.col("title")).otherwise(X.ascii_apostrophes("label"))))
    return rows.withColumn("label", label).where("label IS NOT NULL").groupBy("slug").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "label", "href"))), lambda x: F.struct(x["label"].alias("label"), x["href"].alias("href"))).alias("toc"))


def package_file(p: Package, urn: str, publisher: str, rights: str) -> DataFrame:
    """(slug, path, text): the package file, written anew from the tables, with metadata of its own."""
    dc = lambda tag, c, more="": F.concat(F.lit(f"<dc:{tag}{more}>"), X.escape_html(c), F.lit(f"</dc:{tag}>\n"))
    attribute = lambda name, c: F.concat(F.lit(f' {name}="'), X.escape_html(c), F.lit('"'))
    item = F.concat(F.lit("<item"), attribute("id", F.col("item_id")), attribute("href", F.col("href")), attribute("media-type", F.col("media_type")), F.when(F.size("words") > 0, attribute("properties", F.array_join("words", " "))).otherwise(""), F.lit("/>\n"))
    listed = lambda rows, xml, name: rows.groupBy("slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", xml.alias("xml")))), lambda x: x["xml"]), "").alias(name))
    items = listed(p.items.withColumn("words", F.array_remove(F.coalesce("properties", F.array().cast(NO_STRINGS)), "")), item, "items")
    spine = listed(p.spine, F.concat(F.lit("<itemref"), attribute("idref", F.col("item_id")), F.lit(' linear="yes"/>\n')), "refs")
    ncx = p.items.where("media_type = 'application/x-dtbncx+xml'").groupBy("slug").agg(F.min("item_id").alias("ncx"))
    b = p.books.join(items, "slug").join(spine, "slug", "left").join(ncx, "slug", "left")
    stamp = X.iso_utc(F.coalesce("modified", F.lit("2026-01-01").cast("timestamp")))
    text = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="uid" xml:lang="'), F.col("lang"), F.lit('">\n<metadata xmlns:dc="http://purl.org/dc/elements/1.1/">\n'),
        dc("identifier", F.concat(F.lit(urn), F.col("slug")), ' id="uid"'), dc("title", F.col("title"), ' id="meta-title"'), dc("creator", F.col("author"), ' id="meta-aut"'), dc("language", F.col("lang")), dc("publisher", F.lit(publisher)),
        F.coalesce(dc("description", F.col("summary")), F.lit("")), dc("rights", F.lit(rights)), F.coalesce(dc("date", F.col("year").cast("string")), F.lit("")),
        F.lit('<meta refines="#meta-title" property="title-type">main</meta>\n<meta refines="#meta-aut" property="role" scheme="marc:relators">aut</meta>\n<meta refines="#meta-aut" property="file-as">'), X.escape_html(K.file_as("author")),
        F.lit('</meta>\n<meta property="dcterms:modified">'), stamp, F.lit('</meta>\n<meta name="cover" content="cover-image"/>\n</metadata>\n<manifest>\n'), F.col("items"), F.lit("</manifest>\n<spine"),
        F.when(F.col("ncx").isNotNull(), attribute("toc", F.col("ncx"))).otherwise(""), F.lit(">\n"), F.coalesce("refs", F.lit("")), F.lit('</spine>\n<guide><reference type="cover" title="Cover" href="cover.xhtml"/></guide>\n</package>\n'),
    )
    return b.select("slug", F.col("opf_path").alias("path"), text.alias("text"))


def with_page(p: Package, item_id: str, href: str, text: DataFrame, media_type: str = XHTML, properties: tuple = (), place: int | None = None) -> Package:
    """Adds a generated file: text (slug, text or content). place: its place in the spine (None: none)."""
    paths = p.books.select("slug", X.normalize_path(F.concat_ws("/", F.nullif(X.dirname("opf_path"), F.lit("")), F.lit(href))).alias("path"))
    content = F.col("content") if "content" in text.columns else F.encode("text", "UTF-8")
    new = text.join(paths, "slug").select("slug", "path", content.alias("content"))
    item = new.select("slug", F.lit(10**12).cast("long").alias("ord"), F.lit(item_id).alias("item_id"), F.lit(href).alias("href"), "path", F.lit(media_type).alias("media_type"), F.array(*[F.lit(x) for x in properties]).cast(NO_STRINGS).alias("properties"))
    spine = p.spine if place is None else p.spine.unionByName(new.select("slug", F.lit(place).cast("long").alias("ord"), F.lit(item_id).alias("item_id")))
    return replace(p, files=p.files.join(new.select("slug", "path"), ["slug", "path"], "left_anti").unionByName(new), items=p.items.unionByName(item), spine=spine)


def old_cover_pages(p: Package) -> DataFrame:
    """(slug, item_id): documents that show only the old cover image."""
    cover = p.items.where(F.array_contains("properties", "cover-image")).groupBy("slug").agg(F.min(X.basename("path")).alias("image"))
    return documents(p).join(cover, "slug").where(X.shows_only("text", "image")).select("slug", "item_id")


#: Rules behind every style sheet.
STYLES = "\n.center, .tiInherit { text-indent: 0; }\n.cover img { max-width: 100%; }\ndiv.dd { margin-left: 1.5em; }\nul.toc { list-style: none; padding-left: 0; }\nul.toc li { margin: 0.2em 0; }\nli.toc-head { font-weight: bold; margin-top: 0.6em; }\n"
#: Messages by what the log says; %d stands for how often.
MESSAGES = {
    "font": "removed %d embedded fonts", "title page": "replaced the title page", "licence_boxes": "replaced licence boxes by this page (%d)", "renamed image": "gave %d images proper names", "image": "removed %d illustrations",
    "note": "removed %d notes of the editors", "kept note": "kept %d notes of the author", "foreign chapter": "left out %d pages that do not belong to the work", "toc_tables": "made plain lists of %d tables of contents",
    "split": "split %d long documents", "unused image": "dropped %d images that nothing shows", "dangling link": "unlinked %d dead references",
}


def changes_of(p: Package) -> DataFrame:
    """(slug, changes): the messages for what the log holds, in the order of MESSAGES."""
    counts = p.log.groupBy("slug").pivot("what", list(MESSAGES)).count()
    messages = [(F.col(f"`{k}`") > 0, F.format_string(m, F.col(f"`{k}`")) if "%d" in m else F.lit(m)) for k, m in MESSAGES.items()]
    return p.books.select("slug").join(counts, "slug", "left").select("slug", X.list_of_changes(*messages).alias("changes"))


def transform(files: DataFrame, books: DataFrame, lang: str = "uk", urn: str = "urn:book:", publisher: str = "", rights: str = "", body_class: str | None = None, limit: int = LIMIT, min_part: int = 60_000, fold_below: int = 8_000) -> tuple[DataFrame, DataFrame]:
    """files: (slug, content) zips; books: the list. (slug, content) of the finished zips, and the log.

    For exports of a wiki (uk): fonts, title page, foreign chapters, tree edits, parts, images, cover, credits, metadata and
    tables of contents. Books that come finished (en) keep their documents but for illustrations that must go, lists of
    them, dead links, unused images and documents that are too long.
    """
    p = read(files, books)
    old_labels = checkpointed(ncx_labels(p))
    if lang != "en":
        p = without_fonts(p, STYLES)
        p = without_items(p, p.items.where("item_id = 'title'").select("slug", "item_id"), "title page")
        p = cleaned(own_chapters_only(p), body_class)
    else:
        lists = documents(p).join(p.books.where("strip_images").select("slug"), "slug", "left_semi").where(X.is_list_of_illustrations("path", "text"))
        p = without_items(p, checkpointed(lists.select("slug", "item_id")), "list of illustrations")
        p = without_items(p, checkpointed(old_cover_pages(p)), "title page")
        plain = texts(p).withColumn("x", X.drop_srcset("text")).where("x.n > 0").select("slug", "path", "x.text")
        p = replace(p, files=checkpointed(with_texts(p.files, checkpointed(plain))))
    p, labels = split(p, limit, min_part, fold_below)
    p = with_image_names(without_unused_images(without_dangling_links(p)))
    p = replace(p, items=checkpointed(p.items.withColumn("properties", F.array_remove("properties", "cover-image"))), log=checkpointed(p.log))
    b = p.books
    p = with_page(p, "cover-image", "images/cover.jpg", b.select("slug", F.coalesce("cover", F.unhex(F.lit("FFD8FFD9"))).alias("content")), "image/jpeg", ("cover-image",))
    p = with_page(p, "cover", "cover.xhtml", b.select("slug", cover_page(F.col("title"), F.col("lang"), F.lit("images/cover.jpg")).alias("text")), place=-1)
    lines = F.array_compact(F.array(F.concat_ws(", ", "title", "author"), F.col("summary")))
    page = b.join(changes_of(p), "slug").select("slug", credits_page(F.lit("About this edition"), F.col("lang"), lines, F.col("changes"), F.lit("Changes:")).alias("text"))
    p = with_page(p, "credits", "credits.xhtml", page, place=2**40)
    p = replace(p, files=checkpointed(p.files), items=checkpointed(p.items), spine=checkpointed(p.spine))
    toc = checkpointed(toc_entries(p, labels, old_labels, {"cover": "Cover", "credits": "About this edition", "about": "About the source"}))
    marks = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(label).alias("label"), href.alias("href")) for t, label, href in (("cover", "Cover", F.lit("cover.xhtml")), ("bodymatter", "Text", F.coalesce(F.get("toc", F.lit(1))["href"], F.lit("cover.xhtml"))), ("colophon", "About this edition", F.lit("credits.xhtml")))])
    rows = b.join(toc, "slug")
    nav = p.items.where(F.array_contains("properties", "nav")).select("slug", "path").join(rows, "slug").select("slug", "path", nav_page(F.col("title"), F.col("lang"), F.lit("Contents"), F.col("toc"), marks).alias("text"))
    ncx = p.items.where("media_type = 'application/x-dtbncx+xml'").select("slug", "path").join(rows, "slug").select("slug", "path", ncx_page(F.concat(F.lit(urn), F.col("slug")), F.col("title"), F.col("author"), F.col("lang"), F.col("toc")).alias("text"))
    written = checkpointed(with_texts(p.files, nav.unionByName(ncx).unionByName(package_file(p, urn, publisher, rights))))
    return A.write_archives(written), p.log
