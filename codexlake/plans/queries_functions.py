"""Queries that apply the scalar functions, one a family, to whole tables or to rows given in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import collation as K
from ..functions import text as X
from .define import Definitions, table

DEFINED = Definitions()
GENRES = "['Проза', 'Поезія', 'Драма', 'Дитяча', 'Спогади, есеї, нонфікшн', 'Казки', NULL]"


def _literals(values) -> str:
    quote = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, bool)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quote, row)) + ")" for row in values)


def rows_of(spark, columns: str, values):
    """Rows given in the code, with named parameters for the strings, so that no quoting is at stake."""
    args, lines = {}, []
    for row in values:
        marks = []
        for v in row:
            args[f"p{len(args)}"] = v
            marks.append(f":p{len(args) - 1}")
        lines.append("(" + ", ".join(marks) + ")")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t({columns})", args=args)


@DEFINED.add(r"""
SELECT p_partkey, regexp_replace(regexp_replace(replace(p_name, ' ', chr(39)), '([\p{L}\p{Nl}\p{No}])[''ʼ`´]([\p{L}\p{Nl}\p{No}])', '\1’\2', 'g'), '([\p{L}\p{Nl}\p{No}])[''ʼ`´]([\p{L}\p{Nl}\p{No}])', '\1’\2', 'g') AS name FROM part""")
def apostrophes(spark, d):
    return table(spark, d, "part").select("p_partkey", X.typographic_apostrophes(F.replace("p_name", F.lit(" "), F.lit("'"))).alias("name"))


@DEFINED.add("""
SELECT p_partkey, replace(replace(replace(replace(replace('<' || p_name || '&"' || chr(39) || '>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') AS escaped FROM part""")
def escape_html(spark, d):
    return table(spark, d, "part").select("p_partkey", X.escape_html(F.concat(F.lit("<"), "p_name", F.lit("&\"'>"))).alias("escaped"))


_UNESCAPE = [("a &amp; b", "a & b"), ("&lt;p&gt;&copy;", "<p>©"), ("&#x27;&#39;", "''"), ("&eacute;&unknown;", "é&unknown;"), (None, None)]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_UNESCAPE)}) t(escaped, plain)")
def unescape_html(spark, d):
    return rows_of(spark, "escaped, expected", _UNESCAPE).select("escaped", X.unescape_html("escaped").alias("plain"))


@DEFINED.add("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS updated FROM orders")
def iso_timestamps(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.iso_utc("o_orderdate").alias("updated"))


_FIT = r"""
WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\s\x0B\x1C-\x1F\x85\xA0\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{1680}}]+'), lambda x: x <> '') AS ws FROM (SELECT doc_id, text FROM documents)),
k AS (SELECT doc_id, text, coalesce(list_max(list_filter(range(1, least(len(ws), {most}) + 1), lambda i: strlen(array_to_string(ws[1:i], ' ')) + 3 <= {limit})), 0) AS n, ws FROM w)
SELECT doc_id, CASE WHEN strlen(text) <= {limit} THEN text ELSE regexp_replace(coalesce(array_to_string(ws[1:n], ' '), ''), '[ ,.;:]+$', '') || '…' END AS title FROM k"""


@DEFINED.add(_FIT.format(limit=160, most=160))
def fit_titles(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fit_bytes("text", 160).alias("title"))


@DEFINED.add("""
SELECT o_orderkey, CASE WHEN n < 1048576 THEN printf('%.0f КБ', n / 1024.0::DOUBLE) ELSE printf('%.1f МБ', n / 1048576.0::DOUBLE) END AS size
FROM (SELECT o_orderkey, (o_totalprice * 8)::BIGINT AS n FROM orders)""")
def human_sizes(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.human_size(F.bround(F.col("o_totalprice") * 8, 0).cast("long")).alias("size"))


@DEFINED.add("""
SELECT p_partkey, CASE WHEN n % 10 = 1 AND n % 100 <> 11 THEN 'книжка' WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 12 AND 14 THEN 'книжки' ELSE 'книжок' END AS uk,
  CASE WHEN n = 1 THEN 'book' ELSE 'books' END AS en FROM (SELECT p_partkey, p_partkey % 230 AS n FROM part)""")
def plural_words(spark, d):
    n = F.col("p_partkey") % 230
    return table(spark, d, "part").select("p_partkey", X.uk_books_word(n).alias("uk"), X.en_books_word(n).alias("en"))


_FOLD = "regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g')"


@DEFINED.add(f"""
SELECT doc_id, trim(regexp_replace({_FOLD.format("lower(split_part(text, chr(10), 1))")}, '[^a-z0-9]+', '-', 'g'), '-') AS slug, lower({_FOLD.format("split_part(text, chr(10), 1)")}) AS sort_key
FROM documents""")
def slugs_and_keys(spark, d):
    line = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, d, "documents").select("doc_id", K.slugify(line).alias("slug"), K.en_key(line).alias("sort_key"))


_SLUGS = [("Франко Іван", "franko-ivan"), ("Підмогильний Валер’ян", "pidmohylnyi-valerian"), ("Brontë, Charlotte", "bronte-charlotte"), ("Щедрий Вечір!", "shchedryi-vechir"), ("Ærøskøbing", "rskbing"), ("", "")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_SLUGS)}) t(name, slug)")
def slugs_of_names(spark, d):
    return rows_of(spark, "name, expected", _SLUGS).select("name", K.slugify("name").alias("slug"))


_NAMES = [("Іван Франко",), ("Леся Українка",), ("Ольга Кобилянська",), ("Марко Вовчок",), ("Михайло Коцюбинський",), ("Єва Ґаль",), ("Юрій Яновський",), ("а б",), ("аб",), ("Гнат",), ("Ґава",), ("Dumas",)]


@DEFINED.example(f"""
WITH n AS (SELECT author, CASE WHEN author NOT IN ('Леся Українка', 'Марко Вовчок', 'Панас Мирний', 'Дніпрова Чайка') AND len(string_split(author, ' ')) = 2
             THEN split_part(author, ' ', 2) || ' ' || split_part(author, ' ', 1) ELSE author END AS display,
           CASE WHEN author IN ('Леся Українка', 'Марко Вовчок', 'Панас Мирний', 'Дніпрова Чайка') THEN author ELSE string_split(author, ' ')[-1] END AS surname,
           CASE WHEN author <> 'Леся Українка' AND len(string_split(author, ' ')) = 2 THEN split_part(author, ' ', 2) || ', ' || split_part(author, ' ', 1) ELSE author END AS file_as
         FROM (VALUES {_literals(_NAMES)}) t(author)),
k AS (SELECT *, list_transform(string_split(lower(display), ''), lambda c: CASE WHEN instr('{K.UK_ALPHABET}', c) > 0 THEN instr('{K.UK_ALPHABET}', c) - 1 ELSE 100 + unicode(c) END) AS key FROM n)
SELECT author, display, surname, file_as, array_to_string(key, ' ') AS key, row_number() OVER (ORDER BY key)::INTEGER AS place FROM k""")
def ukrainian_collation(spark, d):
    from pyspark.sql import Window

    named = rows_of(spark, "author", _NAMES).withColumns({"display": K.author_display("author"), "surname": K.surname("author"), "file_as": K.file_as("author")}).withColumn("k", K.uk_key("display"))
    # a dozen rows, given above
    return named.select("author", "display", "surname", "file_as", F.array_join(F.transform("k", lambda x: x.cast("string")), " ").alias("key"), F.row_number().over(Window.orderBy("k")).alias("place"))


@DEFINED.add("""
SELECT p_partkey, CASE WHEN y IS NULL THEN '' WHEN y > 0 THEN '†' || y ELSE '†' || -y || ' до н. е.' END AS died_uk, CASE WHEN y IS NULL THEN '' WHEN y > 0 THEN 'd. ' || y ELSE 'd. ' || -y || ' BC' END AS died_en,
  CASE WHEN y IS NULL THEN 'unknown' WHEN y < 0 THEN -y || ' BC' ELSE y::VARCHAR END AS year
FROM (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size - 25 END AS y FROM part)""")
def year_labels(spark, d):
    y = F.when(F.col("p_partkey") % 17 != 0, F.col("p_size") - 25)
    return table(spark, d, "part").withColumn("y", y).select("p_partkey", X.died_label("y", F.lit("uk")).alias("died_uk"), X.died_label("y", F.lit("en")).alias("died_en"), X.year_label("y").alias("year"))


@DEFINED.add(f"""
SELECT p_partkey, CASE g WHEN 'Проза' THEN 'proza' WHEN 'Поезія' THEN 'poeziia' WHEN 'Драма' THEN 'drama' WHEN 'Дитяча' THEN 'dytiacha' WHEN 'Спогади, есеї, нонфікшн' THEN 'nonfiction' ELSE 'inshe' END AS slug,
  coalesce(list_position({GENRES}[1:5], g) - 1, 5)::INTEGER AS place FROM (SELECT p_partkey, {GENRES}[(p_partkey % 7 + 1)::INT] AS g FROM part)""")
def genre_slugs(spark, d):
    g = F.expr("element_at(array" + GENRES.replace("[", "(").replace("]", ")") + ", CAST(p_partkey % 7 + 1 AS INT))")
    return table(spark, d, "part").withColumn("g", g).select("p_partkey", K.genre_slug("g").alias("slug"), K.genre_index("g").alias("place"))


_PATHS = [("OEBPS/text/c1.xhtml", "../images/a.jpg#x", "OEBPS/images/a.jpg"), ("c1.xhtml", "c2.xhtml#n", "c2.xhtml"), ("a/b/c.xhtml", "../../../x", "../x"), ("a/b.xhtml", "./c//d/.", "a/c/d"), ("a/b.xhtml", "/r/../s", "/s"), ("a/b.xhtml", "..", "."), ("/a.xhtml", "../b", "/b")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_PATHS)}) t(file, ref, target)")
def resolved_paths(spark, d):
    return rows_of(spark, "file, ref, expected", _PATHS).select("file", "ref", X.resolve_path("file", "ref").alias("target"))


@DEFINED.add(r"""
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(url_encode(replace(title, ' ', '_')), '%2F', '/'), '%28', '('), '%29', ')'), '%2C', ','), '%27', chr(39)), '%E2%80%93', '–'), '%7E', '~') AS link
FROM (SELECT page_id, 'Твори (том 1)/' || split_part(split_part(html, '<title>', 2), '</title>', 1) AS title FROM pages)""")
def wiki_urls(spark, d):
    title = F.concat(F.lit("Твори (том 1)/"), F.split_part(F.split_part("html", F.lit("<title>"), F.lit(2)), F.lit("</title>"), F.lit(1)))
    return table(spark, d, "pages").select("page_id", X.wiki_url(title, "").alias("link"))


@DEFINED.add("""
SELECT p_partkey, coalesce(nullif(note, ''), nullif(concat_ws(', ', city, publisher, CASE WHEN y <> 0 THEN y END), ''), 'Вікіджерела') AS source, nullif(concat_ws(' · ', city, CASE WHEN y <> 0 THEN y END), '') AS line
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_type WHEN p_partkey % 5 = 1 THEN '' END AS note, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS city, CASE WHEN p_partkey % 4 > 0 THEN p_name END AS publisher,
  CASE WHEN p_partkey % 7 > 1 THEN p_size WHEN p_partkey % 7 = 1 THEN 0 END AS y FROM part)""")
def edition_lines(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").withColumns({"note": F.when(k % 5 == 0, F.col("p_type")).when(k % 5 == 1, ""), "city": F.when(k % 3 > 0, F.col("p_brand")), "publisher": F.when(k % 4 > 0, F.col("p_name")), "y": F.when(k % 7 > 1, F.col("p_size")).when(k % 7 == 1, 0)})
    return rows.select("p_partkey", X.source_line("note", "city", "publisher", "y", "Вікіджерела").alias("source"), X.join_present(["city", "y"], " · ").alias("line"))


@DEFINED.add(r"""
SELECT doc_id, left(t, 80) AS heading, md5(t) AS collapsed FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x0B\x1C-\x1F\x85\xA0\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1680}]+', ' ', 'g'), ' ') AS t FROM documents)""")
def heading_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", X.heading_text("text").alias("heading"), F.md5(X.collapse_space("text").cast("binary")).alias("collapsed"))


_LABELS = [("Розділ перший ..... 12", "Розділ перший"), ("  I.   Вступ  …… XIV ", "I. Вступ"), ("Без сторінки", "Без сторінки"), ("Повість · · · · 7", "Повість"), ("1984", "1984"), ("Рік 1984", "Рік"), ("", "")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_LABELS)}) t(raw, label)")
def toc_labels(spark, d):
    return rows_of(spark, "raw, expected", _LABELS).select("raw", X.toc_label("raw").alias("label"))


@DEFINED.add("""
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE p_partkey % 3 END::INTEGER AS fatals, CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_size END::INTEGER AS errors, CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE p_partkey % 11 END::INTEGER AS warnings FROM part""")
def checker_lines(spark, d):
    line = F.when(F.col("p_partkey") % 9 == 0, "no such file").otherwise(F.format_string("x\nMessages: %d fatals / %d errors / %d warnings / 0 infos", F.col("p_partkey") % 3, F.col("p_size"), F.col("p_partkey") % 11))
    return table(spark, d, "part").select("p_partkey", X.checker_counts(line).alias("c")).select("p_partkey", "c.*")


_CSS = [("float:right; width:; color:red !important; position:absolute", "float:right; color:red !important", "width:|position:absolute"), ("COLOR : Blue;;", "color:Blue", ""), ("background:url(a", "", "background:url(a"), ("font-family:x; margin:0 !IMPORTANT", "margin:0 !important", "font-family:x"), ("x", "", "x"), ("", "", ""), ("content:'a", "", "content:'a")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_CSS)}) t(style, clean, dropped)")
def css_sanitizer(spark, d):
    return rows_of(spark, "style, a, b", _CSS).select("style", X.css_declarations("style").alias("c")).select("style", "c.clean", F.array_join("c.dropped", "|").alias("dropped"))


@DEFINED.add(r"""
SELECT o_orderkey, CASE WHEN regexp_full_match(y, '\d{4}(-\d{2}(-\d{2})?)?') THEN y END AS year, strftime(CASE WHEN rev IS NULL THEN TIMESTAMP '2026-01-01' ELSE greatest(o_orderdate, rev) END, '%Y-%m-%d') AS effective
FROM (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN 'c. ' || strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y-%m') END AS y,
  CASE WHEN o_orderkey % 5 > 0 THEN TIMESTAMP '1996-06-01' END AS rev FROM orders)""")
def dates_of_editions(spark, d):
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    y = F.when(k % 4 == 0, F.date_format(day, "yyyy")).when(k % 4 == 1, F.date_format(day, "yyyy-MM-dd")).when(k % 4 == 2, F.concat(F.lit("c. "), F.date_format(day, "yyyy"))).otherwise(F.date_format(day, "yyyy-MM"))
    rev = F.when(k % 5 > 0, F.lit("1996-06-01").cast("timestamp"))
    return table(spark, d, "orders").withColumns({"y": y, "rev": rev}).select("o_orderkey", X.plain_year("y").alias("year"), F.date_format(X.effective_time("o_orderdate", "rev", F.lit("2026-01-01").cast("timestamp")), "yyyy-MM-dd").alias("effective"))


@DEFINED.add("""
SELECT p_partkey, concat_ws(' · ', CASE WHEN lower(left(g, 4)) <> lower(left(s, 4)) AND g <> '' THEN g END, CASE WHEN s <> '' THEN s END) AS facts,
  concat_ws('; ', p_brand || ' (d. ' || p_size || ')', CASE WHEN t <> '' THEN 'translator: ' || t || CASE WHEN p_partkey % 2 = 0 THEN ' (d. ' || p_size || ')' ELSE '' END END) AS credits,
  CASE WHEN t <> '' AND NOT starts_with(t, 'anonymous') THEN 'Translated by ' || t WHEN p_partkey % 4 = 0 THEN p_size || ' BC' ELSE p_size::VARCHAR END AS cover
FROM (SELECT *, p_type AS g, CASE WHEN p_partkey % 3 = 0 THEN left(p_type, 5) || 'x' WHEN p_partkey % 3 = 1 THEN '' ELSE p_name END AS s, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN 'anonymous hand' ELSE '' END AS t FROM part WHERE p_size > 0)""")
def lines_for_readers(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").where("p_size > 0").withColumns({"s": F.when(k % 3 == 0, F.concat(F.left("p_type", F.lit(5)), F.lit("x"))).when(k % 3 == 1, "").otherwise(F.col("p_name")), "t": F.when(k % 3 == 0, F.col("p_name")).when(k % 3 == 1, "anonymous hand").otherwise(""), "died": F.when(k % 2 == 0, F.col("p_size")), "y": F.when(k % 4 == 0, -F.col("p_size")).otherwise(F.col("p_size"))})
    return rows.select("p_partkey", X.facts_line("p_type", "s").alias("facts"), X.credits_line("p_brand", "p_size", [("translator", "t", "died")]).alias("credits"), X.cover_line("t", "y").alias("cover"))


@DEFINED.add(r"""
SELECT page_id, len(regexp_extract_all(html, '(?:src|href)="([^"]+)"', 1))::BIGINT AS links, length(regexp_replace(html, '<[^>]*>', '', 'g'))::BIGINT AS text_chars,
  len(list_filter(regexp_extract_all(html, '(?:src|href)="([^"]+)"', 1), lambda r: NOT regexp_matches(r, '^([a-z]+:|#)')))::BIGINT AS internal, regexp_matches(url, '^(https?://|\./|//)') AS is_external FROM pages""")
def page_references(spark, d):
    refs = F.regexp_extract_all("html", F.lit(r'(?:src|href)="([^"]+)"'), 1)
    return table(spark, d, "pages").select("page_id", F.size(refs).cast("long").alias("links"), F.length(X.strip_tags("html")).cast("long").alias("text_chars"), F.size(F.filter(refs, lambda r: ~X.is_skipped_ref(r))).cast("long").alias("internal"), X.is_external_link("url").alias("is_external"))


@DEFINED.add("""SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, to_json({'event_id': event_id, 'kind': event_type})::VARCHAR AS report FROM events""")
def json_fields(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"), F.to_json(F.struct("event_id", F.col("event_type").alias("kind"))).alias("report"))


_CHAPTERS = [("Місто/1/III", "c3_x.xhtml", "Місто", "c0_Misto.xhtml", True), ("Захар Беркут", "c9_x.xhtml", "Місто", "c0_Misto.xhtml", False), ("Містоманія", "c2_x.xhtml", "Місто", "c0_Misto.xhtml", False), ("", "c3_Misto_1_III.xhtml", "Місто", "c0_Misto.xhtml", True), (None, "c9_Zahar_Berkut.xhtml", "Місто", "c0_Misto.xhtml", False), ("Дві_книги/а", "c1.xhtml", "Дві книги", "c0.xhtml", True)]


@DEFINED.example(f"SELECT title, file, own FROM (VALUES {_literals(_CHAPTERS)}) t(title, file, r, f, own)")
def own_chapters(spark, d):
    return rows_of(spark, "title, file, r, f, expected", _CHAPTERS).select("title", "file", X.is_own_chapter("title", "file", "r", "f").alias("own"))


_WRAP = [("a bb ccc dddd", "a bb|ccc|dddd"), ("long-word here", "long-|word|here"), ("unbreakable x", "unbreakable|x"), ("", "")]


@DEFINED.example(f"SELECT * FROM (VALUES {_literals(_WRAP)}) t(raw, lines)")
def wrapped_titles(spark, d):
    return rows_of(spark, "raw, expected", _WRAP).select("raw", F.array_join(X.wrap_words("raw", 5), "|").alias("lines"))
