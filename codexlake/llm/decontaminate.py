"""Benchmark decontamination by template windows, with DataFrame expressions only.

Words are canonicalised: lower case, outer punctuation dropped, and numbers, names (capitalised words inside a sentence)
and units replaced by typed placeholders. Windows of WINDOW words are hashed on both sides, canonical and bare (in lower
case, without placeholders, so that capitals and titles hide no copy), and either kind is joined by hash. The windows of
the benchmark are broadcast behind a check of their number; beyond it the join is shuffled.

Before that, texts are searched for anchors: of every window of the benchmark the longest pair of neighbouring words that
are no placeholders (a word, where there is no such pair) stands in every text in which the window stands in either form,
so only texts with an anchor are canonicalised and hashed.

A window matches literally if its words are equal but for case and punctuation; a document holds an item literally if
such windows are at least SHARE of the item's. For templates only windows with LEAST_LITERAL words beside the placeholders
are counted, and slots (the words under placeholders) are compared: every value of the item must stand for one value of
the document, over the windows that start the item at the same word, or over those of a copy (starts less than half an item
apart), or over all windows of the document; one of these with SHARE of the windows makes a re-parameterised question. An
item shorter than a window is one window of all its words, and is looked up anywhere in a document.

Defined results: null or empty texts and items have no windows and match nothing; repeated rows count once for each
id, texts of one id together; matches leaves rows without an id out, clean judges each of them by its text; texts of any
length are read whole; an empty table on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import table, written

WINDOW, LEAST_LITERAL, SHARE = 8, 4, 0.25
#: The benchmark's windows are broadcast up to this many rows (about 40 bytes each), else the join is shuffled.
BROADCAST_ROWS = 500_000
#: Anchors up to this number stand in the plan as a set, more are joined.
ANCHORS = 20_000
# Units of measure.
UNITS = "mm cm m km in ft yd mi mg g kg lb oz t ml cl l gal s sec min h hr hrs ms day days week weeks month months year years hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres percent usd eur gbp dollar dollars euro euros cent cents kb mb gb tb hz khz mhz ghz w kw kwh v mv a ma j kj cal kcal k c f mph kph"


#: Private-use characters that stand for placeholders inside canonical texts.
_NAME, _NUMBER, _UNIT = "\ue001", "\ue002", "\ue003"
_MARKS = f"{_NAME}{_NUMBER}{_UNIT}"


def bare(text: Column) -> Column:
    """Lower-case words of letters and digits, apart by white space."""
    return F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}\s{_MARKS}]+", "")


def canonical(text: Column) -> Column:
    """The same words, of which names, numbers and units (after numbers) are one placeholder character each.

    The patterns run over whole texts, for inside higher-order functions they would be interpreted word by word.
    """
    clean = F.regexp_replace(text, f"[{_MARKS}]", " ")
    names = F.regexp_replace(clean, r"(?=[^\p{Ll}\p{N}\s])(?<=[^\s.!?:;][ \t\n]{1,2})[^\p{L}\p{N}\s]*+\p{Lu}\S*+", _NAME)
    numbers = F.regexp_replace(names, r"(?=[^\p{L}\s])(?<!\S)[^\p{L}\p{N}\s]*+[0-9][0-9.,:/%]*+(?:st|nd|rd|th)?[^\p{L}\p{N}\s]*+(?!\S)", _NUMBER)
    units = F.regexp_replace(numbers, rf"(?i){_NUMBER}\s(?:{'|'.join(UNITS.split())})(?=[^\p{{L}}\p{{N}}]|$)", f"{_NUMBER} {_UNIT}")
    return bare(units)


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def words(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, canon, bare): the words in both forms, one to one."""
    text = F.regexp_replace(F.col(text_col), f"[{_MARKS}]", " ")
    return rows.select(F.col(id_col).alias("id"), tokens(canonical(F.col(text_col))).alias("canon"), tokens(bare(text)).alias("bare"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hashes(hashes: str, n: int) -> Column:
    """A hash for every word: of the window that starts there, which is shorter than n at the end; null without words.

    The column stands here twice, so that the optimizer does not move its expression into the loop.
    """
    return F.transform(F.when(F.size(hashes) > 0, F.sequence(F.lit(1), F.size(hashes))), lambda i: F.xxhash64(F.slice(hashes, i, n)))


def hashed(rows: DataFrame, id_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """(id, n_words, hashes): of the canonical and the bare windows of each size; hashes is null for a text without words.

    Explode hashes with an outer explode: for an inner one the optimizer adds a filter on their size below, which computes
    the nested expressions again for every word.
    """
    split = words(rows, id_col, text_col).select("id", F.size("canon").alias("n_words"), word_hashes(F.col("canon")).alias("canon"), word_hashes(F.col("bare")).alias("bare"))
    return split.select("id", "n_words", F.concat(*(window_hashes(form, n) for n in sizes for form in ("canon", "bare"))).alias("hashes"))


def anchors(canon: Column, bare: Column, n: Column, usable: Column) -> Column:
    """Hashes of word pairs, or of a word, one of which is in every text that holds the window in its template or bare form."""
    plain = F.transform(canon, lambda w: ~w.isin(*_MARKS))
    rated = lambda fine, words, text: F.struct(fine.alias("fine"), F.length(text).alias("size"), F.xxhash64(*words).alias("hash"))
    pairs = F.transform(F.when(n > 1, F.sequence(F.lit(0), n - 2)), lambda i: rated(F.get(plain, i) & F.get(plain, i + 1), (F.get(bare, i), F.get(bare, i + 1)), F.concat(F.get(bare, i), F.get(bare, i + 1))))
    single = F.array_max(F.transform(bare, lambda w, i: rated(F.get(plain, i), (w,), w)))
    best = F.array_max(pairs)
    return F.when(n == 1, F.array(single["hash"])).when(best["fine"], F.array(best["hash"])).when(usable, F.array(best["hash"], single["hash"])).otherwise(F.array(best["hash"]))


def suspected(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of base (doc_id, text) whose text holds an anchor. wanted: (hash)."""
    words = F.split(bare(F.col("text")), rf"[\s{_MARKS}]+")
    # a pair and its first word alone, for anchors may be either
    hashes = lambda ws: F.concat(F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1))), F.transform(ws, lambda w: F.xxhash64(w)))
    some = wanted.limit(ANCHORS + 1).collect()
    if len(some) <= ANCHORS:
        found = [r["hash"] for r in some]
        # the words are a variable of the outer lambda, so that they are computed once for a text
        return base.where(F.exists(F.array(words), lambda ws: F.exists(hashes(ws), lambda h: h.isin(found)))) if found else base.where(F.lit(False))
    split = base.select("doc_id", words.alias("ws"))
    known = split.select("doc_id", F.explode_outer(hashes(F.col("ws"))).alias("hash")).join(wanted, "hash", "left_semi").select("doc_id").distinct()
    return base.join(written(known), "doc_id", "left_semi")


def matches(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, n: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots, kind): the items that documents hold."""
    marks = [F.lit(m) for m in _MARKS]
    placed = lambda p, n: F.slice(F.arrays_zip("canon", "bare"), p + 1, n)
    slots = lambda p, n: F.transform(F.filter(placed(p, n), lambda t: t["canon"].isin(*marks)), lambda t: t["bare"])
    digest = lambda c, p, n: F.xxhash64(word_hashes(F.slice(c, p + 1, n)))
    items = words(benchmark.select("item_id", "text").where("text IS NOT NULL"), "item_id", "text").withColumn("n", F.least(F.size("canon"), F.lit(n)))
    starts = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.size("canon") - F.col("n")))
    known = items.select(F.col("id").alias("item_id"), "n", "canon", "bare", F.explode_outer(starts).alias("item_pos")).where("item_pos IS NOT NULL")
    plain = F.filter(F.slice("canon", F.col("item_pos") + 1, F.col("n")), lambda w: ~w.isin(*marks))
    # a template needs literal words, a literal copy does not
    usable = F.size(plain) >= F.least(F.lit(LEAST_LITERAL), F.col("n"))
    at = (F.col("item_pos"), F.col("n"))
    known = written(known.select("item_id", "item_pos", "n", F.when(usable, digest("canon", *at)).alias("item_hash"), digest("bare", *at).alias("item_literal"), slots(*at).alias("item_slots"), anchors(F.slice("canon", F.col("item_pos") + 1, F.col("n")), F.slice("bare", F.col("item_pos") + 1, F.col("n")), F.col("n"), usable).alias("anchors")))
    total = known.groupBy("item_id").agg(F.countDistinct("item_pos").alias("windows"), F.countDistinct(F.when(F.col("item_hash").isNotNull(), F.col("item_pos"))).alias("template_windows"))
    few = known.count() <= BROADCAST_ROWS
    small = lambda t: F.broadcast(t) if few else t
    keys = known.select(F.explode_outer(F.array("item_hash", "item_literal")).alias("hash")).where("hash IS NOT NULL").distinct()
    # at most n: items shorter than n words are looked up with windows of their own length
    sizes = sorted(r.n for r in known.select("n").distinct().collect()) or [n]

    base = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    base = written(suspected(base, known.select(F.explode("anchors").alias("hash")).where("hash IS NOT NULL").distinct()))
    known = known.drop("anchors")
    light = hashed(base, "doc_id", "text", sizes).select(F.col("id").alias("doc_id"), "n_words", F.posexplode_outer("hashes").alias("pos", "hash"))
    hit = light.where("hash IS NOT NULL").join(small(keys), "hash", "left_semi")
    per_doc = written(hit.groupBy("doc_id").agg(F.collect_set(F.col("pos") % F.col("n_words")).alias("at")))
    # only documents with a hit are canonicalised once more, for their slots
    found = written(words(base.join(per_doc.select("doc_id"), "doc_id", "left_semi"), "doc_id", "text").join(per_doc, F.col("id") == F.col("doc_id")).select("doc_id", "canon", "bare", "at"))
    side = lambda n: F.transform(F.filter("at", lambda p: p + n <= F.size("canon")), lambda p: F.struct(p.alias("pos"), digest("canon", p, n).alias("hash"), digest("bare", p, n).alias("literal"), slots(p, n).alias("slots")))
    rows = found.select("doc_id", F.explode_outer(F.concat(*map(side, sizes))).alias("w")).select("doc_id", "w.*").distinct()
    zipped = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    ends = ("doc_id", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("start"))
    literal = rows.join(small(known), rows["literal"] == known["item_literal"]).select(*ends, F.col("item_hash").isNotNull().alias("usable"), F.lit(True).alias("same"), F.lit(None).cast("array<struct<a:string,b:string>>").alias("slots"))
    template = rows.join(small(known), (rows["hash"] == known["item_hash"]) & (rows["literal"] != known["item_literal"])).select(*ends, F.lit(True).alias("usable"), F.lit(False).alias("same"), zipped.alias("slots"))
    pairs = literal.unionByName(template).join(small(total), "item_id")
    # starts less than half an item apart are one copy, into which or out of which words were put
    order = Window.partitionBy("doc_id", "item_id").orderBy("start")
    apart = F.coalesce((F.col("start") - F.lag("start").over(order)) * 2 >= F.col("windows") + n - 1, F.lit(True))
    pairs = pairs.withColumn("apart", apart.cast("long")).withColumn("copy", F.sum("apart").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    level = lambda rank, key, all_: F.struct(F.lit(rank).alias("rank"), key.cast("long").alias("key"), F.col(all_).alias("item_windows"))
    literally = F.array(level(0, F.lit(0), "windows"), F.when(F.col("usable"), level(1, F.lit(0), "template_windows")))
    aligned = F.array(level(2, F.col("start"), "template_windows"), level(3, F.col("copy"), "template_windows"), level(4, F.lit(0), "template_windows"))
    levels = F.concat(F.when(F.col("same"), literally).otherwise(F.array()), F.when(F.col("usable"), aligned).otherwise(F.array()))
    held = (
        pairs.select("doc_id", "item_id", "item_pos", "slots", F.explode_outer(levels).alias("l"))
        .where("l IS NOT NULL")
        .groupBy("doc_id", "item_id", "l")
        .agg(F.size(F.collect_set("item_pos")).cast("long").alias("n_windows"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
        .where(F.col("n_windows") >= F.ceil(share * F.col("l.item_windows")))
        .where(F.size(F.array_distinct(F.transform("slots", lambda s: s["a"]))) == F.size("slots"))
    )
    best = held.groupBy("doc_id", "item_id").agg(F.min(F.struct(F.greatest("l.rank", F.lit(1)).alias("rank"), (-F.col("n_windows")).alias("less"), F.col("l.item_windows").alias("item_windows"), F.size("slots").cast("long").alias("n_slots"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.less")).alias("n_windows"), "b.item_windows", "b.n_slots", F.when(F.col("b.rank") == 1, "literal").otherwise("reparameterised").alias("kind"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item of the benchmark, with all their columns; rows without an id are judged by their text."""
    leaks = written(matches(docs, benchmark).select("doc_id").distinct())
    kept = docs.join(leaks, "doc_id", "left_anti").select(docs.columns)
    nameless = docs.where("doc_id IS NULL AND text IS NOT NULL").select(F.xxhash64("text").alias("doc_id"), "text")
    if nameless.isEmpty():
        return kept
    bad = written(matches(nameless, benchmark).select(F.col("doc_id").alias("_leaked_text")).distinct())
    named, rest = kept.where("doc_id IS NOT NULL"), kept.where("doc_id IS NULL")
    return named.unionByName(rest.join(bad, F.xxhash64("text") == F.col("_leaked_text"), "left_anti"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
