"""Queries for the structural rules: on injected faults in whole tables, and on packages given in the code."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from ..operators import html_tree, rules
from ..sources import archive as A
from .define import Definitions, table
from .queries_functions import _literals, rows_of

DEFINED = Definitions()

_CONTAINER = '<container xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/p.opf"/></rootfiles></container>'
_META = '<dc:identifier id="uid">urn:x</dc:identifier><dc:title>T</dc:title><dc:creator>C</dc:creator><dc:language>{lang}</dc:language><meta property="dcterms:modified">2026-01-01T00:00:00Z</meta><meta name="cover" content="cov"/>'
_OPF = """<package xmlns="http://www.idpf.org/2007/opf" unique-identifier="uid"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/">{meta}</metadata><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml"{nav}/>
<item id="c1" href="c1.xhtml" media-type="application/xhtml+xml"{second}/><item id="cov" href="cover.jpg" media-type="image/jpeg" properties="cover-image"/>{more}</manifest><spine{toc}>{refs}</spine></package>"""
_PAGE = '<html xmlns="http://www.w3.org/1999/xhtml"><body>{0}</body></html>'


def _zip(lang="uk", more="", refs="", toc="", c1='<p id="a">x</p><a href="#a">y</a>', cover=b"\xff\xd8x", extra=(), stored=True, first="mimetype", kind=b"application/epub+zip", damage=False, spine=True, nav=True, covers=1, meta=_META) -> bytes:
    opf = _OPF.format(meta=meta.format(lang=lang), nav=' properties="nav"' if nav else "", second=' properties="cover-image"' if covers > 1 else "", more=more, toc=toc, refs=('<itemref idref="c1"/>' if spine else "") + refs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        members = [("mimetype", kind), ("META-INF/container.xml", _CONTAINER), ("OEBPS/p.opf", opf), ("OEBPS/nav.xhtml", _PAGE.format('<a href="c1.xhtml#a">1</a>')), ("OEBPS/c1.xhtml", _PAGE.format(c1)), ("OEBPS/cover.jpg", cover), *extra]
        for name, data in sorted(members, key=lambda m: m[0] != first):
            z.writestr(zipfile.ZipInfo(name, (2026, 1, 1, 0, 0, 0)), data, zipfile.ZIP_STORED if stored or name != "mimetype" else zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    return data.replace(b"\xff\xd8x", b"\xff\xd8y", 1) if damage else data


#: slug to archive; the faults are what its name says.
PACKAGES = {
    "fine": _zip(),
    "broken": b"no zip at all",
    "order": _zip(first="OEBPS/c1.xhtml"),
    "deflated": _zip(stored=False),
    "font": _zip(more='<item id="f" href="f.ttf" media-type="font/ttf"/>', extra=[("OEBPS/f.ttf", b"x")]),
    "missing": _zip(more='<item id="g" href="gone.xhtml" media-type="application/xhtml+xml"/>', refs='<itemref idref="nobody"/>', toc=' toc="ncx"'),
    "stray": _zip(extra=[("OEBPS/stray.txt", b"x")]),
    "links": _zip(c1='<p id="a" style="width:;color:red">x</p><a href="gone.xhtml">y</a><a href="nav.xhtml#z">z</a><a href="http://x">w</a>'),
    "cover": _zip(lang="en-US", cover=b"PNG"),
    "malformed": _zip(c1="<p>x", extra=[("OEBPS/y.svg", b"<svg")], more='<item id="y" href="y.svg" media-type="image/svg+xml"/>'),
    "type": _zip(stored=True, kind=b"application/zip"),
    "crc": _zip(damage=True),
    "large": _zip(c1="<p>" + "x" * 470_000 + "</p>"),
    "nothing": _zip(spine=False, nav=False, covers=2, more='<item id="i" href="i.bin" media-type="image/png"/>', extra=[("OEBPS/i.bin", b"x")]),
    "meta": _zip(meta='<dc:title> </dc:title><dc:language>uk</dc:language><meta name="cover" content="other"/>'),
}
_FOUND = [
    ("broken", "not_a_zip", None), ("order", "mimetype_first", "OEBPS/c1.xhtml"), ("deflated", "mimetype_stored", "mimetype"), ("font", "font", "OEBPS/f.ttf"), ("missing", "missing_file", "OEBPS/gone.xhtml"),
    ("missing", "spine_idref", "nobody"), ("missing", "spine_toc", "ncx"), ("stray", "stray_file", "OEBPS/stray.txt"), ("links", "broken_reference", "OEBPS/c1.xhtml gone.xhtml"),
    ("malformed", "not_well_formed", "OEBPS/c1.xhtml"), ("malformed", "not_well_formed", "OEBPS/y.svg"), ("type", "mimetype_content", "mimetype"), ("crc", "crc", "OEBPS/cover.jpg"), ("large", "oversize", "OEBPS/c1.xhtml"), ("large", "dangling_fragment", "OEBPS/nav.xhtml c1.xhtml#a"), ("malformed", "dangling_fragment", "OEBPS/nav.xhtml c1.xhtml#a"),
    ("nothing", "empty_spine", None), ("nothing", "no_nav", None), ("nothing", "cover_count", "2"), ("nothing", "cover_not_jpeg", "OEBPS/c1.xhtml"), ("nothing", "image_extension", "i.bin"), ("meta", "metadata_missing", "title"), ("meta", "metadata_missing", "creator"), ("meta", "metadata_missing", "identifier"),
    ("meta", "unique_identifier", "uid"), ("meta", "modified_missing", None), ("meta", "cover_meta", "cov"), ("links", "dangling_fragment", "OEBPS/c1.xhtml nav.xhtml#z"), ("links", "inline_css", "OEBPS/c1.xhtml: width:"), ("cover", "cover_not_jpeg", "OEBPS/cover.jpg"), ("cover", "language", "en-US"),
]


def sample_archive(spark):
    return A.unzip(spark.createDataFrame([(k, v) for k, v in PACKAGES.items()], "slug string, content binary"))


def sample_tables(spark):
    """Every table is read by several rules, so each is kept."""
    return {name: t.cache() for name, t in A.tables(sample_archive(spark).cache()).items()}


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_FOUND)}) t(slug, rule, subject)")
def package_violations(spark, d):
    return rules.violations(sample_tables(spark))


@DEFINED.example("SELECT * FROM (VALUES " + _literals([(s, sum(f[0] == s for f in _FOUND), s == "fine") for s in PACKAGES]) + ") t(slug, n_errors, held)")
def package_verdicts(spark, d):
    books = rows_of(spark, "slug, hold", [(s, "rights" if s == "fine" else None) for s in PACKAGES])
    out = rules.verdicts(books, rules.violations(sample_tables(spark)))
    return out.select("slug", F.col("n_errors").cast("int").alias("n_errors"), (~F.col("release_ready") & ~F.col("failed")).alias("held"))


@DEFINED.example("SELECT * FROM (VALUES " + _literals([(s, s != "crc") for s in PACKAGES if s != "broken"]) + ") t(slug, same)")
def rewritten_archives(spark, d):
    """Every readable package unzipped, written and unzipped again: the same members, mimetype first; a member that could not
    be read is empty then."""
    once = sample_archive(spark).where("zip_ok").cache()
    again = A.unzip(A.write_archives(once))
    digest = lambda a: a.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("path", F.md5("content")))).alias("m"), F.bool_or((F.col("ord") == 0) & (F.col("path") == "mimetype")).alias("first"))
    both = digest(once).withColumnRenamed("m", "a").drop("first").join(digest(again), "slug")
    return both.select("slug", ((F.col("a") == F.col("m")) & F.col("first")).alias("same"))


_DOCS = [
    ("entity", "a<span typeof=\"mw:Entity\"> </span>b<i>c</i>", "a b<i>c</i>", 2),
    ("spans", "<p><span>x</span><span class=\"k\">y</span></p>", "<p>x<span class=\"k\">y</span></p>", 1),
    ("toc", "<table><tr><td>1.</td><td><a href=\"c1.xhtml\">One ....</a></td><td>7</td></tr><tr><td><a href=\"c2.xhtml\">Two</a></td></tr><tr><td><a href=\"c2.xhtml\">Two</a></td></tr></table>", "<ul class=\"toc\"><li>1. <a href=\"c1.xhtml\">One</a></li><li><a href=\"c2.xhtml\">Two</a></li></ul>", 1),
    ("model", "<dl><dd>a</dd></dl><span>b<div>c</div></span>", "<div class=\"dl\"><div class=\"dd\">a</div></div>b<span style=\"display:block\">c</span>", 3),
    ("links", "<p><a href=\"http://x\">out</a> <a href=\"c1.xhtml\">in</a></p>", "<p>out <a href=\"c1.xhtml\">in</a></p>", 1),
    ("page", "<p>x<span class=\"pagenum\">7</span>y</p><p><span class=\"pagenum\">8</span></p>", "<p>xy</p>", 2),
]


@DEFINED.example("SELECT * FROM (VALUES " + _literals([(a, c) for a, _, c, _ in _DOCS]) + ") t(doc_id, html)")
def cleaned_documents(spark, d):
    docs = rows_of(spark, "doc_id, body", [(a, b) for a, b, _, _ in _DOCS]).select("doc_id", F.concat(F.lit("<body>"), "body", F.lit("</body>")).alias("html"), F.lit(False).alias("strip_notes"), F.lit(False).alias("strip_images"), F.array().cast("array<string>").alias("keep_markers"))
    return html_tree.clean_documents(docs).select("doc_id", F.regexp_extract("html", "^<body>(.*)</body>$", 1).alias("html"))
