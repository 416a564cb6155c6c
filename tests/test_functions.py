"""Golden rows and properties of the scalar functions."""

import html
import posixpath
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from codexlake.functions import collation as K
from codexlake.functions import text as X


def one(spark, column, *values):
    """The column over rows (v,) of strings."""
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in rows.orderBy("k").select(column).collect()]


def test_plurals(spark):
    words = one(spark, X.uk_books_word(F.col("v").cast("int")), *map(str, (1, 2, 5, 11, 21, 22, 25)))
    assert words == "книжка книжки книжок книжок книжка книжки книжок".split()


def test_apostrophes_stay_at_word_edges(spark):
    assert one(spark, X.typographic_apostrophes("v"), "Валер'ян", "'так'", "п`ять", None) == ["Валер’ян", "'так'", "п’ять", None]


def test_normalized_books_touch_display_fields_only(spark):
    rows = spark.sql("SELECT \"п'ять\" AS title, \"п'ять\" AS page, named_struct('city', \"Кам'янець\", 'year', 1900) AS edition")
    got = X.normalized_books(rows).first()
    assert (got.title, got.page, got.edition.city, got.edition.year) == ("п’ять", "п'ять", "Кам’янець", 1900)


def test_fit_bytes(spark):
    long = "слово " * 60
    cut, short, word = one(spark, X.fit_bytes("v"), long, "Місто", "х" * 200)
    assert len(cut.encode()) <= 160 and cut.endswith("…") and short == "Місто" and word == "…"


def reference_fit(text, limit):
    """A plain statement of the rule: the longest run of whole words that fits with the ellipsis."""
    if len(text.encode()) <= limit:
        return text
    kept = ""
    for n in range(1, len(text.split()) + 1):
        trial = " ".join(text.split()[:n])
        if len(trial.encode()) + 3 > limit:
            break
        kept = trial
    return re.sub(r"[ ,.;:]+$", "", kept) + "…"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aб, .;:\n", min_size=0, max_size=60), min_size=30, max_size=60))
def test_fit_bytes_property(spark, texts):
    assert one(spark, X.fit_bytes("v", 20), *texts) == [reference_fit(t, 20) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab./", min_size=1, max_size=14), min_size=40, max_size=80))
def test_paths_property(spark, paths):
    want = [posixpath.normpath(p) for p in paths]
    want = [w[1:] if w.startswith("//") else w for w in want]  # two leading slashes are one here
    assert one(spark, X.normalize_path("v"), *paths) == want


def test_escapes_are_inverse(spark):
    texts = ["<a href=\"x\">'&amp;'</a>", "", "plain"]
    assert one(spark, X.escape_html("v"), *texts) == [html.escape(t, quote=True) for t in texts]
    assert one(spark, X.unescape_html(X.escape_html("v")), *texts) == texts


def test_human_size_rounds_half_even(spark):
    got = one(spark, X.human_size(F.col("v").cast("long")), *map(str, (512, 2560, 1310720, 1536, 1048575)))
    assert got == [f"{n / 1024:.0f} КБ" if n < 1 << 20 else f"{n / (1 << 20):.1f} МБ" for n in (512, 2560, 1310720, 1536, 1048575)]


@pytest.mark.parametrize("name,slug", [("Франко Іван", "franko-ivan"), ("Підмогильний Валер’ян", "pidmohylnyi-valerian"), ("Brontë, Charlotte", "bronte-charlotte")])
def test_slugs(spark, name, slug):
    assert one(spark, K.slugify("v"), name) == [slug]


def test_author_order(spark):
    names = ["Іван Франко", "Леся Українка", "Ольга Кобилянська", "Марко Вовчок", "Михайло Коцюбинський"]
    rows = spark.createDataFrame([(n,) for n in names], "v string").select(K.author_display("v").alias("d"))
    got = [r.d for r in rows.orderBy(K.uk_key("d")).collect()]
    assert got == ["Кобилянська Ольга", "Коцюбинський Михайло", "Леся Українка", "Марко Вовчок", "Франко Іван"]


def test_css(spark):
    got = one(spark, X.css_declarations("v"), "float:right; width:; color:red !important; position:absolute", None)
    assert (got[0].clean, got[0].dropped) == ("float:right; color:red !important", ["width:", "position:absolute"])


def test_functions_pass_nulls(spark):
    for f in (X.typographic_apostrophes, X.escape_html, X.collapse_space, X.fit_bytes, X.strip_tags, X.toc_label, X.normalize_path, K.slugify, K.en_key, K.surname, K.author_display):
        assert one(spark, f("v"), None) == [None], f
