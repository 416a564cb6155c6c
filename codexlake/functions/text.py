"""Text functions: apostrophes, escaping, byte limits, labels, paths and urls."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LETTER = r"[\p{L}\p{Nl}\p{No}]"
#: White space as Unicode has it; Java's \s and trim() know the ASCII ones only.
SPACE = r"(?U)\s+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def typographic_apostrophes(text) -> Column:
    """' ʼ ` ´ between letters become ’; at the edge of a word they stay."""
    return F.regexp_replace(_c(text), rf"(?<={_LETTER})['ʼ`´](?={_LETTER})", "’")


def ascii_apostrophes(text) -> Column:
    """Only the ASCII ' between letters becomes ’ (navigation labels)."""
    return F.regexp_replace(_c(text), rf"(?<={_LETTER})'(?={_LETTER})", "’")


#: Columns with text for readers; keys, page names and urls are never touched (fixed values).
DISPLAY_FIELDS = "title author subtitle summary pd_status source_note cover_title feed_title series genre".split()


def normalized_books(books):
    """Typographic apostrophes in every display column that is there, and in the strings of the struct edition."""
    kinds = dict(books.dtypes)
    changed = {c: typographic_apostrophes(c) for c in DISPLAY_FIELDS if kinds.get(c) == "string"}
    if "edition" in books.columns:
        edition = F.col("edition")
        for field in books.schema["edition"].dataType.fields:
            if field.dataType.simpleString() == "string":
                edition = edition.withField(field.name, typographic_apostrophes(F.col("edition")[field.name]))
        changed["edition"] = F.when(F.col("edition").isNotNull(), edition)
    return books.withColumns(changed)


def escape_html(text) -> Column:
    out = _c(text).cast("string")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


@F.pandas_udf(T.StringType())
def unescape_html(text: pd.Series) -> pd.Series:
    """All named and numbered references; the entity table has no built-in form."""
    return text.map(html.unescape, na_action="ignore")


def iso_utc(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def collapse_space(text) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(text), SPACE, " "), "^ | $", "")


def fit_bytes(text, limit: int = 160) -> Column:
    """Cut at a word boundary, with an ellipsis, so that the UTF-8 form has at most limit bytes; short texts stay as they are."""
    text = _c(text)
    # what stands behind limit + 1 characters cannot come in; a word that is cut there is too long in any case
    words = F.filter(F.split(F.left(text, F.lit(limit + 1)), SPACE), lambda w: w != "")
    start = F.struct(F.lit("").alias("kept"), F.lit(False).alias("full"))

    def add(state: Column, word: Column) -> Column:
        trial = F.when(state["kept"] == "", word).otherwise(F.concat(state["kept"], F.lit(" "), word))
        over = state["full"] | (F.octet_length(trial) + 3 > limit)
        return F.struct(F.when(over, state["kept"]).otherwise(trial).alias("kept"), over.alias("full"))

    cut = F.aggregate(words, start, add, lambda s: F.concat(F.regexp_replace(s["kept"], r"[ ,.;:]+$", ""), F.lit("…")))
    return F.when(F.octet_length(text) <= limit, text).otherwise(cut)


def human_size(n) -> Column:
    """KB without, MB with one decimal; ties to even, as the value is exact in binary."""
    n = _c(n)
    small = F.concat(F.format_string("%.0f", F.bround(n / 1024.0, 0)), F.lit(" КБ"))
    return F.when(n < 1024 * 1024, small).otherwise(F.concat(F.format_string("%.1f", F.bround(n / 1048576.0, 1)), F.lit(" МБ")))


def uk_books_word(n) -> Column:
    n = _c(n)
    return F.when((n % 10 == 1) & (n % 100 != 11), "книжка").when((n % 10).between(2, 4) & ~(n % 100).between(12, 14), "книжки").otherwise("книжок")


def en_books_word(n) -> Column:
    return F.when(_c(n) == 1, "book").otherwise("books")


def died_label(year, lang) -> Column:
    """Ukrainian with a dagger, else English; years up to 0 are BC; null is empty."""
    year, uk = _c(year), ~_c(lang).eqNullSafe("en")
    text = F.abs(year).cast("string")
    return (
        F.when(year.isNull(), "")
        .when(uk, F.concat(F.lit("†"), text, F.when(year > 0, "").otherwise(" до н. е.")))
        .otherwise(F.concat(F.lit("d. "), text, F.when(year > 0, "").otherwise(" BC")))
    )


def year_label(year) -> Column:
    year = _c(year)
    return F.when(year.isNull(), "unknown").when(year < 0, F.concat(F.abs(year).cast("string"), F.lit(" BC"))).otherwise(year.cast("string"))


def join_present(parts: list, by: str) -> Column:
    """The parts that are neither null nor empty nor 0, joined; null if there are none."""
    present = [F.when(~_c(p).cast("string").isin("", "0"), _c(p).cast("string")) for p in parts]
    return F.nullif(F.concat_ws(by, *present), F.lit(""))


def edition_line(city, publisher, year, by: str = ", ") -> Column:
    return join_present([city, publisher, year], by)


def first_present(*parts) -> Column:
    return F.coalesce(*[F.nullif(_c(p), F.lit("")) for p in parts])


def source_line(note, city, publisher, year, default: str) -> Column:
    return first_present(note, edition_line(city, publisher, year), F.lit(default))


def is_translator(name) -> Column:
    name = _c(name)
    return F.coalesce((name != "") & ~name.startswith("anonymous"), F.lit(False))


def credits_line(author, author_died, people: list[tuple[str, str, str]]) -> Column:
    """people: (role, name column, year-of-death column)."""
    parts = [F.concat(_c(author), F.lit(" (d. "), year_label(author_died), F.lit(")"))]
    for role, name, died in people:
        label = F.concat(F.lit(f"{role}: "), _c(name), F.when(F.coalesce(_c(died), F.lit(0)) != 0, F.concat(F.lit(" (d. "), year_label(died), F.lit(")"))).otherwise(""))
        parts.append(F.when(F.coalesce(_c(name), F.lit("")) != "", label))
    return F.array_join(F.array_compact(F.array(*parts)), "; ")


def facts_line(genre, subtitle) -> Column:
    """genre · subtitle, without the genre where both begin with the same four letters."""
    g, s = F.coalesce(_c(genre), F.lit("")), F.coalesce(_c(subtitle), F.lit(""))
    same = F.lower(F.left(g, F.lit(4))) == F.lower(F.left(s, F.lit(4)))
    return F.concat_ws(" · ", F.when(~same & (g != ""), g), F.when(s != "", s))


def cover_line(translator, year) -> Column:
    year = _c(year)
    bc = F.when(year < 0, F.concat(F.abs(year).cast("string"), F.lit(" BC")))
    return F.when(is_translator(translator), F.concat(F.lit("Translated by "), _c(translator))).otherwise(F.coalesce(bc, F.nullif(year, F.lit(0)).cast("string")))


def heading_text(text, limit: int = 80) -> Column:
    return F.left(collapse_space(text), F.lit(limit))


def toc_label(text) -> Column:
    """Without dotted leaders and page numbers at the end."""
    out = collapse_space(text)
    out = F.regexp_replace(out, r"(?U)(?:[.·…_\s]+|\s)(?:[0-9]{1,4}|[IVXLC]{1,6})\s*$", "")
    out = F.regexp_replace(out, r"(?U)[.·…_\s]{3,}$", "")
    return F.regexp_replace(out, r"[ .·…]+$", "")


def strip_tags(text) -> Column:
    return F.regexp_replace(_c(text), "<[^>]*>", "")


def drop_srcset(text) -> Column:
    """struct(text, n): without srcset attributes, and how many there were."""
    pattern = r'\ssrcset="[^"]*"'
    return F.struct(F.regexp_replace(_c(text), pattern, "").alias("text"), F.regexp_count(_c(text), F.lit(pattern)).alias("n"))


def checker_counts(output) -> Column:
    """struct(fatals, errors, warnings) of an external checker's summary line; without one a single fatal."""
    line = r"Messages:\s*(\d+) fatals?\s*/\s*(\d+) errors?\s*/\s*(\d+) warnings?"
    found = F.coalesce(F.regexp_like(_c(output), F.lit(line)), F.lit(False))
    number = lambda k, other: F.when(found, F.regexp_extract(_c(output), line, k).cast("int")).otherwise(other)
    return F.struct(number(1, 1).alias("fatals"), number(2, 0).alias("errors"), number(3, 0).alias("warnings"))


def plain_year(text) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD, else null."""
    return F.when(_c(text).rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), _c(text))


def effective_time(pipeline, revision, run_time) -> Column:
    """The later of both; without a revision the time of the run."""
    return F.when(_c(revision).isNull(), _c(run_time)).otherwise(F.greatest(_c(pipeline), _c(revision)))


def css_declarations(style) -> Column:
    """struct(clean, dropped): valid declarations normalized and joined, the rest as they were.

    A declaration needs a property name, a value, balanced brackets and quotes and none of {}<>; layout properties that make
    no sense on paged readers are dropped as well.
    """
    dropped_names = "position z-index right left top bottom font-family".split()  # fixed values
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))

    def parse(decl: Column) -> Column:
        at = F.instr(decl, F.lit(":"))
        name = F.lower(trim(F.when(at > 0, F.substr(decl, F.lit(1), at - 1)).otherwise(decl)))
        value = F.when(at > 0, trim(F.substr(decl, at + 1))).otherwise("")
        important = F.lower(value).endswith("!important")
        bare = F.when(important, trim(F.regexp_replace(value, "(?i)!important$", ""))).otherwise(value)
        fine = (
            (at > 0) & name.rlike("^-?[a-zA-Z][a-zA-Z0-9-]*$") & (bare != "") & (count(bare, "(") == count(bare, ")"))
            & (count(bare, '"') % 2 == 0) & (count(bare, "'") % 2 == 0) & ~bare.rlike("[{};<>]") & ~name.isin(dropped_names)
        )
        return F.struct(decl.alias("raw"), fine.alias("fine"), F.concat(name, F.lit(":"), bare, F.when(important, " !important").otherwise("")).alias("clean"))

    parsed = F.transform(F.filter(F.transform(F.split(_c(style), ";"), trim), lambda d: d != ""), parse)
    return F.struct(
        F.array_join(F.transform(F.filter(parsed, lambda p: p["fine"]), lambda p: p["clean"]), "; ").alias("clean"),
        F.transform(F.filter(parsed, lambda p: ~p["fine"]), lambda p: p["raw"]).alias("dropped"),
    )


def normalize_path(path) -> Column:
    """POSIX normalization: empty and . parts vanish, .. takes its parent away; at the root it vanishes; nothing left is '.'."""
    path = _c(path)
    rooted = path.startswith("/")
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))

    def step(done: Column, part: Column) -> Column:
        up = (part == "..") & (F.size(done) > 0) & (F.element_at(done, F.greatest(F.size(done), F.lit(1))) != "..")
        stay = (part == "..") & (F.size(done) == 0) & rooted
        return F.when(up, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(stay, done).otherwise(F.array_append(done, part))

    out = F.concat(F.when(rooted, "/").otherwise(""), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    return F.when(out == "", ".").otherwise(out)


def dirname(path) -> Column:
    folder = F.regexp_replace(F.regexp_extract(_c(path), "^(.*)/[^/]*$", 1), "(?<=[^/])/+$", "")
    return F.when((folder == "") & _c(path).startswith("/"), "/").otherwise(folder)


def basename(path) -> Column:
    return F.regexp_extract(_c(path), "([^/]*)$", 1)


def resolve_path(base_file, ref) -> Column:
    """The normalized path of a reference from a file; what stands behind # does not count."""
    ref = F.split_part(_c(ref), F.lit("#"), F.lit(1))
    folder = dirname(base_file)
    return normalize_path(F.when(ref.startswith("/") | (folder == ""), ref).otherwise(F.concat(folder, F.lit("/"), ref)))


def wiki_url(page, base: str = "https://uk.wikisource.org/wiki/") -> Column:
    """Percent-encoded page name; / ( ) , ' – stay, spaces are underscores."""
    out = F.url_encode(F.replace(_c(page), F.lit(" "), F.lit("_")))
    for code, char in (("%2F", "/"), ("%28", "("), ("%29", ")"), ("%2C", ","), ("%27", "'"), ("%E2%80%93", "–"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.concat(F.lit(base), out)


def is_external_link(href) -> Column:
    return F.coalesce(_c(href).rlike(r"^(https?://|\./|//)"), F.lit(False))


def is_skipped_ref(ref) -> Column:
    """References with a scheme (lower case) or to the same file only."""
    return _c(ref).rlike("^([a-z]+:|#)")


def is_font_item(media_type, href) -> Column:
    return F.coalesce(_c(media_type), F.lit("")).rlike(r"^(font/|application/font|application/x-font|application/vnd\.ms-opentype)") | F.contains(F.concat(F.lit("/"), F.coalesce(_c(href), F.lit(""))), F.lit("/fonts/"))


def is_font_path(path) -> Column:
    return F.lower(_c(path)).rlike(r"\.(ttf|otf|woff2?)$")


def is_own_chapter(title, file, root_title, root_file) -> Column:
    """The root itself or one of its subpages, by title; without a title by file stems without their c<N>_ prefix."""
    spaced = lambda c: F.trim(F.replace(_c(c), F.lit("_"), F.lit(" ")))
    stem = lambda c: F.regexp_replace(F.regexp_replace(_c(c), r"\.[^.]*$", ""), r"^c\d+_", "")
    t, r = spaced(title), spaced(root_title)
    by_file = (stem(file) == stem(root_file)) | F.startswith(stem(file), F.concat(stem(root_file), F.lit("_")))
    return F.when(F.coalesce(_c(title), F.lit("")) != "", (t == r) | F.startswith(t, F.concat(r, F.lit("/")))).otherwise(by_file)


def is_heading(tag, style, classes, text, breaks) -> Column:
    """h1 to h6, or a centred block of 1 to 80 characters with at most three line breaks."""
    centred = F.contains(F.replace(F.coalesce(_c(style), F.lit("")), F.lit(" "), F.lit("")), F.lit("text-align:center")) | F.arrays_overlap(F.coalesce(_c(classes), F.array().cast("array<string>")), F.array(F.lit("center"), F.lit("tiInherit"))) | (_c(tag) == "center")
    short = F.length(collapse_space(text)).between(1, 80)
    return _c(tag).isin([f"h{k}" for k in range(1, 7)]) | (_c(tag).isin("div", "p", "center") & centred & short & (_c(breaks) <= 3))


def is_toc_table(classes, rows, linked_rows) -> Column:
    """By class, or at least three rows of which at least 60 % link into the book."""
    names = F.coalesce(_c(classes), F.array().cast("array<string>"))
    return F.exists(names, lambda c: c.startswith("ws-summary") | (c == "ws-toc")) | ((_c(rows) >= 3) & (10 * _c(linked_rows) >= 6 * _c(rows)))


def wrap_words(text, width: int) -> Column:
    """Greedy lines of at most width characters; a longer word has a line of its own, a hyphen allows a break behind it."""
    words = F.filter(F.split(F.regexp_replace(_c(text), r"(?<=\S)-(?=\S)", "-\u0001"), r"\s+|(?=\u0001)"), lambda w: w != "")

    def add(lines: Column, word: Column) -> Column:
        soft = word.startswith("\u0001")
        bare = F.replace(word, F.lit("\u0001"), F.lit(""))
        last = F.element_at(lines, F.greatest(F.size(lines), F.lit(1)))
        trial = F.concat(last, F.when(soft, "").otherwise(" "), bare)
        fits = (F.size(lines) > 0) & (F.length(trial) <= width)
        return F.when(fits, F.array_append(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), trial)).otherwise(F.array_append(lines, bare))

    return F.aggregate(words, F.array().cast("array<string>"), add)


def matches_any(text, needles) -> Column:
    """Whether a text contains one of an array of strings (null: none)."""
    return F.exists(F.coalesce(_c(needles), F.array().cast("array<string>")), lambda m: F.contains(_c(text), m))


def local_path(url, base: str) -> Column:
    """What stands behind the base of a url; null outside the base."""
    return F.when(_c(url).startswith(base), F.substr(_c(url), F.lit(len(base) + 1)))


def relative_path(path, folder) -> Column:
    """The way from a folder ('' for the top) to a file, both normalized and relative to one top."""
    parts = lambda c: F.filter(F.split(c, "/"), lambda x: x != "")
    a, b = parts(_c(path)), parts(_c(folder))
    common = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, same: F.struct(F.when(s["on"] & same, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["on"] & same).alias("on")), lambda s: s["n"])
    return F.concat(F.repeat(F.lit("../"), F.size(b) - common), F.array_join(F.slice(a, common + 1, F.greatest(F.size(a) - common, F.lit(0))), "/"))


def rewritten_css(css, more: str = "") -> Column:
    """A style sheet without embedded fonts and the rule that sets the exported font, with rules of one's own behind it."""
    plain = F.regexp_replace(_c(css), r"@font-face\s*\{[^}]*\}\s*", "")
    return F.concat(F.regexp_replace(plain, r'body\s*\{\s*font-family:\s*"FreeSerif"\s*;?\s*\}\s*', ""), F.lit(more))


def list_of_changes(*changes: tuple) -> Column:
    """array<string>: the messages whose conditions hold, in order. changes: (condition or None for always, message column)."""
    return F.array_compact(F.array(*[_c(m) if when is None else F.when(when, _c(m)) for when, m in changes]))


def is_list_of_illustrations(path, text) -> Column:
    return (basename(path) == "loi.xhtml") | F.coalesce(_c(text).rlike(r'epub:type="[^"]*\bloi\b'), F.lit(False))


def shows_only(text, image) -> Column:
    """Whether a page names an image file and has fewer than 40 characters of text beside its title."""
    rest = F.regexp_replace(F.regexp_replace(_c(text), r"(?s)<title>.*?</title>", ""), r"(?U)<[^>]+>|\s+", "")
    return F.contains(_c(text), _c(image)) & (F.length(rest) < 40)


def is_large_image(media_type, path, size) -> Column:
    """Raster images of 50,000 bytes or more, without logos and title pages; pixels are not looked at."""
    raster = _c(media_type).isin("image/jpeg", "image/png", "image/gif")
    return raster & ~F.lower(basename(path)).rlike("logo|titlepage") & (_c(size) >= 50_000)
