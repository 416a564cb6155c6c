"""Collation keys, transliteration and the names and orders that go with them."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Alphabet, transliteration, genres, pseudonyms.
UK_ALPHABET = "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя"
SINGLE = ("абвгґдезиіїйклмнопрстуф", "abvhgdezyiiiklmnoprstuf")
MULTI = {"є": "ie", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "iu", "я": "ia", "ь": "", "’": "", "'": ""}
GENRES = {"Проза": "proza", "Поезія": "poeziia", "Драма": "drama", "Дитяча": "dytiacha", "Спогади, есеї, нонфікшн": "nonfiction"}
OTHER_GENRE = ("Інше", "inshe")
PSEUDONYMS = ("Леся Українка", "Марко Вовчок", "Панас Мирний", "Дніпрова Чайка")


@cache
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """From the Unicode data: characters whose compatibility decomposition leaves ASCII. One ASCII character each: (from, to);
    several: a dictionary, for the Latin blocks only."""
    source, target, several = [], [], {}
    for code in range(0x80, 0x3000):
        char = chr(code)
        ascii_ = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(ascii_) == 1:
            source.append(char)
            target.append(ascii_)
        elif len(ascii_) > 1 and code < 0x250:
            several[char] = ascii_
    return "".join(source), "".join(target), several


def ascii_fold(text) -> Column:
    """Decomposed and without what is not ASCII; letters that do not decompose (ß, ø, œ) vanish."""
    source, target, several = _decompositions()
    out = F.translate(_c(text), source, target)
    for char, to in several.items():
        out = F.replace(out, F.lit(char), F.lit(to))
    return F.regexp_replace(out, r"[^\x00-\x7F]", "")


def slugify(text) -> Column:
    out = F.translate(F.lower(_c(text)), *SINGLE)
    for char, to in MULTI.items():
        out = F.replace(out, F.lit(char), F.lit(to))
    return F.regexp_replace(F.regexp_replace(ascii_fold(out), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def en_key(text) -> Column:
    return F.lower(ascii_fold(text))


def uk_key(text) -> Column:
    """ARRAY<INT> in Ukrainian alphabetical order; other characters come after the letters, by code point."""
    chars = F.filter(F.split(F.lower(_c(text)), ""), lambda c: c != "")
    return F.transform(chars, _uk_place)


def _uk_place(char: Column) -> Column:
    at = F.position(char, F.lit(UK_ALPHABET))
    return F.when(at > 0, at - 1).otherwise(100 + F.ascii(char)).cast("int")


def _words(name) -> Column:
    return F.filter(F.split(_c(name), r"(?U)\s+"), lambda w: w != "")


def surname(author) -> Column:
    parts = _words(author)
    return F.when(_c(author).isin(*PSEUDONYMS) | (F.size(parts) < 2), _c(author)).otherwise(F.element_at(parts, -1))


def author_display(author) -> Column:
    """Surname first for names of two words; pseudonyms and others stay."""
    parts = _words(author)
    return F.when(~_c(author).isin(*PSEUDONYMS) & (F.size(parts) == 2), F.concat_ws(" ", parts[1], parts[0])).otherwise(_c(author))


def file_as(name) -> Column:
    """Surname, name; of the pseudonyms only the first is known here."""
    parts = _words(name)
    return F.when((_c(name) != PSEUDONYMS[0]) & (F.size(parts) == 2), F.concat_ws(", ", parts[1], parts[0])).otherwise(_c(name))


def genre_slug(genre) -> Column:
    table = F.create_map(*[F.lit(x) for pair in GENRES.items() for x in pair])
    return F.coalesce(F.element_at(table, F.coalesce(_c(genre), F.lit(""))), F.lit(OTHER_GENRE[1]))


def genre_index(genre) -> Column:
    """Place in the fixed order; unknown ones and null come last."""
    at = F.array_position(F.array(*[F.lit(g) for g in GENRES]), F.coalesce(_c(genre), F.lit("")))
    return F.when(at > 0, at - 1).otherwise(len(GENRES)).cast("int")
