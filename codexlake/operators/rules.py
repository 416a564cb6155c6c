"""Structural rules over the tables of packaged books. Each rule gives (slug, rule, subject) rows of violations.

Tables: archive(slug, ord, path, content, compress_type, extra_len, crc_ok), manifest(slug, ord, item_id, href, path,
media_type, properties), spine(slug, ord, idref), links(slug, doc, pos, ref), ids(slug, doc, id), meta(slug, tag, id, value),
books(slug, lang, unique_identifier, toc, zip_ok, opf_path). Equi-joins and anti-joins throughout, keyed by slug first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import css_declarations, is_font_path, is_skipped_ref, resolve_path
from ..sources.archive import well_formed
from .relational import least_items

MAX_XHTML = 462_000
#: Files that must be well-formed.
MARKUP = r"(?i)\.(x?html|opf|ncx|xml|svg)$"
Tables = dict[str, DataFrame]


def _found(rows: DataFrame, rule: str, subject) -> DataFrame:
    return rows.select("slug", F.lit(rule).alias("rule"), (subject if isinstance(subject, Column) else F.col(subject)).cast("string").alias("subject"))


def _sound(t: Tables) -> DataFrame:
    """Books whose container could be read; later rules say nothing about others."""
    return t["books"].where("zip_ok AND opf_path IS NOT NULL")


def archive_rules(t: Tables) -> list[DataFrame]:
    a = t["archive"]
    first = a.where("ord = 0")
    return [
        _found(t["books"].where("NOT zip_ok"), "not_a_zip", F.lit(None)),
        _found(first.where("path <> 'mimetype'"), "mimetype_first", "path"),
        _found(a.where("path = 'mimetype' AND compress_type <> 0"), "mimetype_stored", "path"),
        _found(a.where("path = 'mimetype' AND content <> CAST('application/epub+zip' AS BINARY)"), "mimetype_content", "path"),
        _found(a.where("path = 'mimetype' AND extra_len > 0"), "mimetype_extra", "path"),
        _found(a.where("NOT crc_ok").groupBy("slug").agg(F.min_by("path", "ord").alias("path")), "crc", "path"),
        _found(a.where(F.lower("path").rlike(r"\.x?html$") & (F.octet_length("content") > MAX_XHTML)), "oversize", "path"),
        _found(a.where(is_font_path("path")), "font", "path"),
        _found(a.where(F.col("path").rlike(MARKUP) & ~well_formed("content")), "not_well_formed", "path"),
        _found(t["books"].where("zip_ok AND opf_path IS NULL"), "container", F.lit(None)),
    ]


def manifest_rules(t: Tables) -> list[DataFrame]:
    m, a, sound = t["manifest"], t["archive"], _sound(t)
    names = a.select("slug", "path")
    exempt = F.col("path").isin("mimetype", "onix.xml") | F.col("path").startswith("META-INF/") | F.col("path").endswith("/onix.xml")
    stray = a.where(~exempt).join(sound.select("slug", F.col("opf_path").alias("path")), ["slug", "path"], "left_anti").join(m, ["slug", "path"], "left_anti")
    items = m.select("slug", F.col("item_id").alias("idref"))
    per_book = m.groupBy("slug").agg(F.coalesce(F.bool_or(F.array_contains("properties", "nav")), F.lit(False)).alias("nav"), F.count_if(F.array_contains("properties", "cover-image")).alias("covers"))
    covers = m.where(F.array_contains("properties", "cover-image")).join(a.select("slug", "path", "content"), ["slug", "path"])
    return [
        _found(m.join(names, ["slug", "path"], "left_anti"), "missing_file", "path"),
        _found(stray.join(sound, "slug", "left_semi"), "stray_file", "path"),
        _found(sound.join(t["spine"], "slug", "left_anti"), "empty_spine", F.lit(None)),
        _found(t["spine"].join(items, ["slug", "idref"], "left_anti"), "spine_idref", "idref"),
        _found(sound.where("toc IS NOT NULL").withColumn("idref", F.col("toc")).join(items, ["slug", "idref"], "left_anti"), "spine_toc", "toc"),
        _found(sound.join(per_book.where("nav"), "slug", "left_anti"), "no_nav", F.lit(None)),
        _found(sound.join(per_book, "slug", "left").where("coalesce(covers, 0) <> 1"), "cover_count", F.coalesce("covers", F.lit(0))),
        _found(covers.where(F.hex(F.substring("content", 1, 2)) != "FFD8"), "cover_not_jpeg", "path"),
        _found(m.where(F.col("media_type").startswith("image/") & ~F.lower("href").rlike(r"\.(jpe?g|png|gif|svg|webp)$")), "image_extension", "href"),
    ]


def metadata_rules(t: Tables) -> list[DataFrame]:
    meta, sound = t["meta"], _sound(t)
    blank = F.coalesce(F.trim("value"), F.lit("")) == ""
    have = meta.where(~blank).select("slug", "tag")
    wanted = sound.select("slug", F.explode(F.array(*[F.lit(x) for x in ("title", "creator", "identifier")])).alias("tag"))
    lang = meta.where("tag = 'language'").groupBy("slug").agg(F.min_by("value", "ord").alias("value"))
    wrong = sound.join(lang, "slug", "left").where(~F.lower(F.split_part(F.trim(F.coalesce("value", F.lit(""))), F.lit("-"), F.lit(1))).eqNullSafe(F.col("lang")))
    ids = meta.where("tag = 'identifier'").select("slug", F.col("id").alias("unique_identifier"))
    cover_meta = meta.where("tag = 'cover'").select("slug", F.col("value").alias("item_id"))
    covers = t["manifest"].where(F.array_contains("properties", "cover-image")).select("slug", "item_id")
    one = covers.groupBy("slug").count().where("count = 1").select("slug")
    return [
        _found(wanted.join(have, ["slug", "tag"], "left_anti"), "metadata_missing", "tag"),
        _found(wrong, "language", "value"),
        _found(sound.join(ids, ["slug", "unique_identifier"], "left_anti"), "unique_identifier", "unique_identifier"),
        _found(sound.join(meta.where("tag = 'modified'"), "slug", "left_anti"), "modified_missing", F.lit(None)),
        _found(covers.join(one, "slug", "left_semi").join(cover_meta, ["slug", "item_id"], "left_anti"), "cover_meta", "item_id"),
    ]


def reference_rules(t: Tables) -> list[DataFrame]:
    links = t["links"].where(~is_skipped_ref("ref")).withColumns({"path": resolve_path("doc", "ref"), "id": F.when(F.col("ref").contains("#"), F.regexp_extract("ref", "#(.*)$", 1))})
    names = t["archive"].select("slug", "path")
    broken = links.join(names, ["slug", "path"], "left_anti")
    inside = links.where("id <> ''").where(F.col("path").rlike(r"\.x?html$")).join(names, ["slug", "path"], "left_semi")
    dangling = inside.join(t["ids"].select("slug", F.col("doc").alias("path"), "id"), ["slug", "path", "id"], "left_anti")
    styles = t.get("styles")
    out = [_found(broken, "broken_reference", F.concat_ws(" ", "doc", "ref")), _found(dangling, "dangling_fragment", F.concat_ws(" ", "doc", "ref"))]
    if styles is not None:
        bad = styles.withColumn("d", css_declarations("style")["dropped"]).where("size(d) > 0").groupBy("slug", "doc").agg(F.min_by("d", "pos").alias("d"))
        out.append(_found(bad, "inline_css", F.concat(F.col("doc"), F.lit(": "), F.array_join(F.slice("d", 1, 3), "; "))))
    return out


def violations(t: Tables) -> DataFrame:
    """(slug, rule, subject) of all rules."""
    return reduce(DataFrame.unionByName, [*archive_rules(t), *manifest_rules(t), *metadata_rules(t), *reference_rules(t)])


def verdicts(books: DataFrame, found: DataFrame, most: int = 10) -> DataFrame:
    """(slug, n_errors, reasons, release_ready, failed): a hold blocks publication but is no failure."""
    lines = found.select("slug", F.concat_ws(": ", "rule", "subject").alias("line"))
    per_book = lines.groupBy("slug").agg(F.count("*").alias("n_errors")).join(least_items(lines, ["slug"], "line", most, "errors"), "slug")
    out = books.join(per_book, "slug", "left").withColumn("n_errors", F.coalesce("n_errors", F.lit(0)))
    hold = F.coalesce(F.col("hold"), F.lit("")) != "" if "hold" in books.columns else F.lit(False)
    reasons = F.when(hold, F.concat(F.lit("hold: "), F.col("hold") if "hold" in books.columns else F.lit(""))).otherwise(F.array_join(F.coalesce("errors", F.array().cast("array<string>")), "; "))
    return out.select("slug", "n_errors", reasons.alias("reasons"), (~hold & (F.col("n_errors") == 0)).alias("release_ready"), (F.col("n_errors") > 0).alias("failed"))


def feed_rules(feeds: DataFrame, rows: DataFrame, files: DataFrame, base: str, most: int = 50) -> DataFrame:
    """feeds: (feed, parsed); rows: (feed, kind, href); files: (path). (feed, rule, subject) violations of the feed tree."""
    counted = feeds.join(rows.groupBy("feed").count(), "feed", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    books = rows.where("kind = 'BOOK'")
    local = books.withColumn("path", F.when(F.col("href").startswith(base), F.substr("href", F.lit(len(base) + 1))))
    out = [
        counted.where("NOT parsed").select("feed", F.lit("not_parsed").alias("rule"), F.lit(None).cast("string").alias("subject")),
        counted.where("parsed AND n = 0").select("feed", F.lit("empty").alias("rule"), F.lit(None).cast("string").alias("subject")),
        counted.where(F.col("n") > most).select("feed", F.lit("too_many").alias("rule"), F.col("n").cast("string").alias("subject")),
        local.where("path IS NULL").select("feed", F.lit("outside_base").alias("rule"), F.col("href").alias("subject")),
        local.where("path IS NOT NULL").join(files, "path", "left_anti").select("feed", F.lit("no_file").alias("rule"), F.col("href").alias("subject")),
        books.where(~F.col("href").rlike("^https?://")).select("feed", F.lit("not_absolute").alias("rule"), F.col("href").alias("subject")),
    ]
    return reduce(DataFrame.unionByName, out)
