"""Packaged books as tables, and back: unzip, package discovery, shredding, deterministic writing."""

from __future__ import annotations

import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARCHIVE = "slug string, ord int, path string, content binary, compress_type int, extra_len int, crc_ok boolean, zip_ok boolean"
STAMP = (2026, 1, 1, 0, 0, 0)
_OPF, _DC = "{http://www.idpf.org/2007/opf}", "{http://purl.org/dc/elements/1.1/}"


def unzip(files: DataFrame) -> DataFrame:
    """files: (slug, content). One row a member; what is no zip gives one row with zip_ok false."""

    def run(batches):
        for b in batches:
            for slug, content in zip(b["slug"], b["content"]):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
                        for k, info in enumerate(i for i in z.infolist() if not i.is_dir()):
                            try:
                                data, fine = z.read(info), True
                            except (zipfile.BadZipFile, OSError, EOFError):
                                data, fine = None, False
                            rows.append((slug, k, info.filename, data, info.compress_type, len(info.extra), fine, True))
                except zipfile.BadZipFile:
                    rows = [(slug, 0, None, None, None, None, None, False)]
                out = pd.DataFrame(rows, columns=["slug", "ord", "path", "content", "compress_type", "extra_len", "crc_ok", "zip_ok"])
                yield out.astype({"ord": "Int32", "compress_type": "Int32", "extra_len": "Int32", "crc_ok": "boolean", "zip_ok": "boolean"})

    return files.select("slug", "content").mapInPandas(run, ARCHIVE)


def _full(opf: str, href: str) -> str:
    return posixpath.normpath(posixpath.join(posixpath.dirname(opf), href or ""))


def _package(slug: str, opf: str, content: bytes) -> list[tuple]:
    """(slug, kind, ord, a, b, c, d) rows of one package file: books, manifest, spine and meta entries."""
    rows: list[tuple] = []
    try:
        root = ET.fromstring(content)
    except ET.ParseError:
        return rows
    spine = root.find(f"{_OPF}spine")
    rows.append((slug, "book", 0, opf, root.get("unique-identifier"), None if spine is None else spine.get("toc"), None))
    for k, item in enumerate(root.iterfind(f"{_OPF}manifest/{_OPF}item")):
        rows.append((slug, "manifest", k, item.get("id"), item.get("href"), item.get("media-type"), item.get("properties") or ""))
    for k, ref in enumerate(() if spine is None else spine.iterfind(f"{_OPF}itemref")):
        rows.append((slug, "spine", k, ref.get("idref"), ref.get("linear"), None, None))
    for k, e in enumerate(root.find(f"{_OPF}metadata") if root.find(f"{_OPF}metadata") is not None else ()):
        if e.tag.startswith(_DC):
            rows.append((slug, "meta", k, e.tag[len(_DC) :], e.get("id"), (e.text or "").strip(), None))
        elif e.get("property") == "dcterms:modified":
            rows.append((slug, "meta", k, "modified", e.get("id"), (e.text or "").strip(), None))
        elif e.get("name") == "cover":
            rows.append((slug, "meta", k, "cover", None, e.get("content"), None))
    return rows


def tables(archive: DataFrame, lang: str = "uk") -> dict[str, DataFrame]:
    """The tables that the rules read, of an archive table (best a written one)."""
    container = archive.where("path = 'META-INF/container.xml'").select("slug", F.regexp_extract(F.decode("content", "UTF-8"), r'full-path="([^"]+)"', 1).alias("opf_path"))
    opf = archive.join(container, "slug").where("path = opf_path").select("slug", "opf_path", "content")

    def run(batches):
        for b in batches:
            rows = [r for s, p, c in zip(b["slug"], b["opf_path"], b["content"]) for r in _package(s, p, c)]
            yield pd.DataFrame(rows, columns=["slug", "kind", "ord", "a", "b", "c", "d"]).astype({"ord": "int32"})

    entries = opf.mapInPandas(run, "slug string, kind string, ord int, a string, b string, c string, d string")
    package = entries.where("kind = 'book'").select("slug", F.col("a").alias("opf_path"), F.col("b").alias("unique_identifier"), F.col("c").alias("toc"))

    @F.udf("string", useArrow=True)
    def full(opf_path: str, href: str) -> str:
        return _full(opf_path, href)

    manifest = entries.where("kind = 'manifest'").select("slug", "ord", F.col("a").alias("item_id"), F.col("b").alias("href"), F.col("c").alias("media_type"), F.split("d", " ").alias("properties"))
    manifest = manifest.join(package.select("slug", "opf_path"), "slug").withColumn("path", full("opf_path", "href")).drop("opf_path")
    books = archive.groupBy("slug").agg(F.bool_and("zip_ok").alias("zip_ok")).join(package, "slug", "left").withColumn("lang", F.lit(lang))
    docs = archive.join(manifest.where("media_type = 'application/xhtml+xml'").select("slug", "path"), ["slug", "path"], "left_semi")
    text = docs.select("slug", F.col("path").alias("doc"), F.decode("content", "UTF-8").alias("text"))
    found = lambda pattern: F.posexplode(F.regexp_extract_all("text", F.lit(pattern), 1))
    return {
        "archive": archive.where("zip_ok"),
        "books": books,
        "manifest": manifest,
        "spine": entries.where("kind = 'spine'").select("slug", "ord", F.col("a").alias("idref"), F.col("b").alias("linear")),
        "meta": entries.where("kind = 'meta'").select("slug", "ord", F.col("a").alias("tag"), F.col("b").alias("id"), F.col("c").alias("value")),
        "links": text.select("slug", "doc", found(r'(?:src|href)="([^"]+)"').alias("pos", "ref")),
        "ids": text.select("slug", "doc", found(r'\sid="([^"]+)"').alias("pos", "id")).select("slug", "doc", "id").distinct(),
        "styles": text.select("slug", "doc", found(r'\sstyle="([^"]*)"').alias("pos", "style")),
    }


def is_well_formed(content: bytes | None) -> bool:
    try:
        ET.fromstring(content or b"")
        return True
    except ET.ParseError:
        return False


@F.pandas_udf(T.BooleanType())
def well_formed(content: pd.Series) -> pd.Series:
    return content.map(lambda c: is_well_formed(bytes(c)) if c is not None else False)


def member_order(path: str) -> tuple:
    """mimetype, container, package files, then the rest by code points."""
    return (path != "mimetype", path != "META-INF/container.xml", not path.endswith(".opf"), path)


def write_archives(archive: DataFrame) -> DataFrame:
    """(slug, content): one zip a book, always the same bytes for the same members; images and mimetype are stored."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for path, content in sorted(zip(pdf["path"], pdf["content"]), key=lambda r: member_order(r[0])):
                info = zipfile.ZipInfo(path, STAMP)
                stored = path == "mimetype" or re.search(r"\.(jpe?g|png|gif|webp)$", path, re.I)
                info.compress_type = zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED
                # a member that could not be read is empty, so that the book can still be written
                z.writestr(info, bytes(content) if content is not None else b"", compresslevel=None if stored else 9)
        return pd.DataFrame({"slug": [pdf["slug"].iloc[0]], "content": [out.getvalue()]})

    # a book's members are together by nature: the zip is one value
    return archive.select("slug", "path", "content").groupBy("slug").applyInPandas(build, "slug string, content binary")
