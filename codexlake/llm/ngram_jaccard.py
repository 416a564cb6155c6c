"""N-gram Jaccard self-join by universe partitioning.

A document's set holds the 64-bit hashes of its distinct word shingles. Sets are put into size bands of ratio 1 / threshold,
so partners stand in one band or in neighbouring ones. For a band the universe of hashes is cut into segments, some of them
with one-deletion neighbourhoods; how many of either is chosen by cost (signatures against expected false partners). Each
set sends the signatures of its own band's scheme and of the next lower one's.

Only strong signatures are sent, those of LEAST elements or more; others say so little that their groups would grow with the
corpus. A segment withstands as many differences as its strong signatures cover: none if its own is strong, one if all its
deletions are strong too. Two sets within the threshold differ in at most U elements, so if the numbers of differences that
a set's segments withstand, each plus one, sum to more than U, some segment of both agrees within its allowance, by the
pigeonhole principle. A set whose segments by chance sum to less is signed again by another, independent partition (its
next level); partners meet at the first level that is enough for one of them. A set for which no level is enough sends its
weak signatures of the last level too, for which the segments of all such sets do.

Equal sets are one class from the start. Links between classes are found in two steps, each verified exactly on the sets:

1. Stars: in every signature group the members of other components than the least one are compared with the group's
   leader, each member with few of its leaders; components are joined; this runs STAR_ROUNDS times with other leaders.
2. The rest: groups that still hold several components are joined with themselves across components only, behind a size
   test and a lower bound of the difference from parity sketches. A set leaves the groups of more than CROWD members (those
   of passages that many texts share) if its other segments still sum to more than U, for then it meets its partners
   there; other sets stay. Two sets may share hundreds of signatures: each carries the EARLIER ones right before, in one
   order for all sets, and where the two have one of these in common they have met before. At the first signature that
   they share they cannot have one, so nothing is skipped and no link between components is lost.

Classes are known by 64 bits of a sum over their set and its size; for 10**9 different texts a mix-up of two classes has a
chance of about 3 %, of two signatures it only costs a comparison.

Defined results: null or empty texts have no shingles and are components of their own; with fewer words than a shingle the
whole sequence is the one shingle; a null id gets a null component; rows with one id are one node, linked through their
texts, whatever these are (with link_ids=False each is a node); ids are integers; texts of any length are read as a whole;
other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import forget, small_batches, table, written
from .components import components

log = logging.getLogger(__name__)
CACHE = 400_000
STAR_ROUNDS = 3
#: Leaders that a member is compared with in a round after the first; what they miss is left to step 2, which is exact.
LEADERS = 6
#: Members of a signature group from which on sets leave it that meet their partners elsewhere.
CROWD = 32
#: Signatures right before its own that a row carries, by which two sets see that they have met in another group.
EARLIER = 8
#: Elements of a strong signature, and independent partitions for sets that have too few of them.
LEAST, LEVELS = 2, 8
#: Cost of a false partner, in signatures: it falls to the sketches inside the join, a signature is shuffled.
PARTNER_COST = 0.05
#: Chance that an element of a set stands in another set of no kinship, for the cost of an allocation only.
COMMON = 1e-3
NO_ID = -(2**63)
SKETCH = 8  # 64-bit words of the parity sketch
_MIX1, _MIX2, _GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_S33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """The usual 64-bit finalizer (public constants)."""
    x = (x ^ (x >> _S33)) * _MIX1
    x = (x ^ (x >> _S33)) * _MIX2
    return x ^ (x >> _S33)


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, n: int, words: Words) -> np.ndarray:
    """The sorted hashes of the distinct shingles; only A-Z are lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(n, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * _GOLD + h[k : len(h) - size + 1 + k])
    return np.unique(total)


class Threshold:
    """A Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def differ(self, total: int) -> int:
        """How many elements two sets within the threshold may differ in, given the sum of their sizes."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self, largest: int) -> list[tuple[int, int]]:
        out, low = [], 1
        while low <= largest:
            high = max(low, low * self.den // self.num)
            out.append((low, high))
            low = high + 1
        return out

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if not len(a) or not len(b) or min(len(a), len(b)) * self.den < max(len(a), len(b)) * self.num:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both * self.den >= (len(a) + len(b) - both) * self.num


class Allocation:
    """A band's scheme: so many segments, of which the first `deep` have one-deletion neighbourhoods."""

    def __init__(self, segments: int, deep: int):
        self.segments, self.deep = segments, deep

    def withstood(self, sizes: np.ndarray) -> np.ndarray:
        """The differences, plus one, that a set's strong signatures withstand; sizes: elements of its segments, the last axis."""
        return (sizes >= LEAST).sum(-1) + (sizes[..., : self.deep] > LEAST).sum(-1)

    def signatures(self, sizes: np.ndarray) -> np.ndarray:
        few = sizes[..., : self.deep]
        return (sizes >= LEAST).sum(-1) + np.where(few > LEAST, few, 0).sum(-1)

    def cost(self, cases: list[tuple[int, int]], sets: int, random: np.random.Generator, draws: int = 24) -> float:
        """Signatures of a set, with those of further levels, and the price of its false partners; cases: (size, U)."""
        total = 0.0
        for size, differ in cases:
            sizes = random.multinomial(size, np.full(self.segments, 1 / self.segments), draws)
            enough = max((self.withstood(sizes) > differ).mean(), 0.5 / draws)
            weakest = np.where(sizes >= LEAST, COMMON ** np.minimum(sizes, 40), 0.0).sum(-1).mean()
            empty = self.segments * np.exp(-2 * size / self.segments)
            partners = sets * (weakest / enough + empty * (1 - enough) ** (2 * LEVELS))
            total += self.signatures(sizes).mean() / enough + PARTNER_COST * partners
        return total / len(cases)


def allocate(low: int, high: int, threshold: Threshold, sets: int) -> Allocation:
    """The allocation of least cost for a band with so many sets."""
    up = lambda n: n * threshold.den // threshold.num
    most = threshold.differ(high + up(high))
    above = min(up(high), high + 1 + high // 10)
    cases = [(n, threshold.differ(n + up(n))) for n in sorted({low, (low + high) // 2, high})] + [(above, threshold.differ(above + high))]
    enough = lambda m: m * (1 - np.exp(-low / m) * (1 + low / m)) > 0.85 * cases[0][1]
    tried = range(1, high + 1) if high <= 24 else [m for s in (9, 8, 7, 6, 5, 4.5, 4, 3.5, 3.2, 3, 2.8, 2.6, 2.4, 2.2, 2, 1.8) if enough(m := int(-(-high // s)))][:6] or [high // 2]
    shapes = [Allocation(m, deep) for m in tried for deep in (sorted({0, m // 4, m // 2, m}) if high <= 400 or sets > 10**6 else (0,)) if m + deep > most]
    shapes = shapes or [Allocation(most + 1, 0)]
    if not sets:
        return shapes[0]
    random = np.random.default_rng(high)
    return min(shapes, key=lambda a: a.cost(cases, sets, random))


class Schemes:
    """The scheme of each band: it holds for pairs within the band and for pairs with the next higher one."""

    def __init__(self, threshold: Threshold, counts: dict[int, int], largest: int):
        self.threshold, self.bands = threshold, threshold.bands(max(largest, 1))
        self.highs = np.array([h for _, h in self.bands])
        self.plans = []
        for k, (low, high) in enumerate(self.bands):
            differ = threshold.differ(high + high * threshold.den // threshold.num)
            self.plans.append(None if differ == 0 else allocate(low, high, threshold, counts.get(k, 0) + counts.get(k + 1, 0)))

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.highs, size))

    def of_scheme(self, h: np.ndarray, k: int) -> tuple[list[np.ndarray], int, int]:
        """(signatures, last level, room): room is how many signatures of the last level the set can do without.

        The lowest bit of a signature is that of its band's number, the next three are its level.
        """
        if k < 0 or k >= len(self.plans) or self.plans[k] is None:
            return [], 0, -1
        plan, t = self.plans[k], self.threshold
        partner = min(len(h) * t.den // t.num, int(self.highs[k]) if len(h) > self.highs[k] else len(h) * t.den // t.num)
        differ, token, out = t.differ(len(h) + partner), mixed(h + _GOLD), []
        for level in range(LEVELS):
            segment = ((mixed(h * _GOLD + np.uint64(k + 4096 * level)) >> np.uint64(32)) % np.uint64(plan.segments)).astype(np.int64)
            size = np.bincount(segment, minlength=plan.segments)
            order = np.argsort(segment, kind="stable")
            ends = np.concatenate([[np.uint64(0)], np.cumsum(token[order], dtype=np.uint64)])
            bounds = np.concatenate([[0], np.cumsum(size)])
            sums = ends[bounds[1:]] - ends[bounds[:-1]]
            tag = mixed(np.full(plan.segments, k + 4096 * level, np.uint64) * _MIX1 + np.arange(plan.segments, dtype=np.uint64))
            room = int(plan.withstood(size)) - 1 - differ
            least = 0 if room < 0 and level == LEVELS - 1 else LEAST
            bits = np.uint64((k & 1) + 2 * level)
            some = size >= least
            few = order[: bounds[plan.deep]]
            few = few[size[segment[few]] > least]
            for x in (sums[some] ^ tag[some], (sums[segment[few]] - token[few]) ^ tag[segment[few]]):
                out.append((mixed(x) & ~np.uint64(15)) | bits)
            if room >= 0:
                break
        return out, level, room

    def signatures(self, h: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """The signatures of both schemes, and (last level, room) of the schemes with even, then with odd numbers."""
        k = self.band(len(h))
        own, lower = self.of_scheme(h, k), self.of_scheme(h, k - 1)
        both = [lower, own] if k & 1 else [own, lower]
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *own[0], *lower[0]])), [x for b in both for x in b[1:]]


def sketch(h: np.ndarray) -> np.ndarray:
    """SKETCH words of parities: the bits in which two sketches differ are at most as many as the sets' differences."""
    odd = np.bincount((mixed(h ^ _GOLD) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(h: np.ndarray) -> bytes:
    """Parities in a power of two of bits, as many as elements at least; sketches of different width are folded to the lesser."""
    bits = max(64, 1 << max(0, len(h) - 1).bit_length())
    odd = np.bincount((mixed(h ^ _GOLD) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def size_counts(texts: DataFrame, n: int, threshold: Threshold) -> tuple[dict[int, int], int]:
    """Sets in each band and the largest size, by the number of words (an upper bound of the size): a few dozen rows."""
    size = F.greatest(F.size(F.split(F.col("t"), r"[\x20\x09-\x0D]+")) - (n - 1), F.lit(1))
    sizes = written(texts.where("t IS NOT NULL").groupBy(size.alias("size")).count())
    largest = sizes.agg(F.max("size")).first()[0] or 1
    # about log(size) / log(1 / threshold) bands
    edges = F.array(*[F.lit(h) for _, h in threshold.bands(largest)])
    rows = sizes.groupBy(F.size(F.filter(edges, lambda h: h < F.col("size"))).alias("band")).agg(F.sum("count").alias("n")).collect()
    return {r["band"]: r["n"] for r in rows}, largest


def sets(docs: DataFrame, n: int, schemes: Schemes | None = None) -> DataFrame:
    """docs: (id, t). With schemes (id, th, n, f1, s0.., wide, room, sigs), without (id, f1, h): h is the set as bytes, th a hash of the text."""

    def run(batches):
        words = Words()
        for b in batches:
            rows = []
            for i, th, t in zip(b["id"], b["th"], b["t"]):
                h = shingles(t, n, words)
                f1 = int(mixed(mixed(h + np.uint64(1)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))[0].astype(np.int64))
                if schemes is None:
                    rows.append((i, f1, h.tobytes()))
                else:
                    sigs, room = schemes.signatures(h)
                    rows.append((i, th, len(h), f1, *map(int, sketch(h)), wide_sketch(h), room, sigs.astype(np.int64)))
            yield pd.DataFrame(rows, columns=names)

    names = ["id", "f1", "h"] if schemes is None else ["id", "th", "n", "f1", *[f"s{k}" for k in range(SKETCH)], "wide", "room", "sigs"]
    kinds = {"h": "binary", "wide": "binary", "room": "array<int>", "sigs": "array<long>"}
    small_batches(docs.sparkSession)
    # a null among integers would make pandas turn them into doubles
    numbered = docs.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), F.xxhash64("t").alias("th"), "t")
    return numbered.mapInPandas(run, ", ".join(f"{c} {kinds.get(c, 'long')}" for c in names)).withColumn("id", F.nullif("id", F.lit(NO_ID)))


def verified(pairs: DataFrame, held: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) of classes that are linked. held: (f1, h)."""
    both = pairs.join(held.select(F.col("f1").alias("a"), F.col("h").alias("ha")), "a").join(held.select(F.col("f1").alias("b"), F.col("h").alias("hb")), "b")

    def run(batches):
        for b in batches:
            fine = [threshold.linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b["ha"], b["hb"])]
            yield b[["a", "b"]][np.array(fine, bool)]

    small_batches(pairs.sparkSession)
    return both.mapInPandas(run, "a long, b long")


def sketched(pairs: DataFrame, classes: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs (a, b) whose wide sketches allow a link; a sketch takes a 64th of its set, so few sets need to travel."""
    side = lambda x: classes.select(F.col("f1").alias(x), F.col("wide").alias(f"w{x}"), F.col("n").alias(f"n{x}"))

    def run(batches):
        for b in batches:
            fine = [differing_bits(x, y) <= threshold.differ(int(n)) for x, y, n in zip(b["wa"], b["wb"], b["na"] + b["nb"])]
            yield b[["a", "b"]][np.array(fine, bool)]

    small_batches(pairs.sparkSession)
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


def near_enough(threshold: Threshold):
    """Whether the sizes and sketches of the sides _a and _b allow a link: differing bits bound the differing elements."""
    num, den = threshold.num, threshold.den
    bits = [F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(SKETCH)]
    sizes = (F.col("n_a") * den >= F.col("n_b") * num) & (F.col("n_b") * den >= F.col("n_a") * num)
    return sizes & (sum(bits[1:], bits[0]) * (den + num) <= (F.col("n_a") + F.col("n_b")) * (den - num))


def without_crowds(rest: DataFrame, classes: DataFrame) -> DataFrame:
    """rest: (sig, f1, c). Without the rows of crowded groups whose sets meet their partners at their other signatures."""
    crowds = written(rest.groupBy("sig").count().where(F.col("count") > CROWD).select("sig"))
    if crowds.isEmpty():
        return rest
    parity, level = F.col("sig").bitwiseAND(F.lit(1)).cast("int"), F.shiftright("sig", 1).bitwiseAND(F.lit(7)).cast("int")
    inside = written(rest.join(crowds, "sig").select("sig", "f1", parity.alias("parity"), level.alias("level")))
    room = classes.select("f1", "room")
    last, spare = F.element_at("room", F.col("parity") * 2 + 1), F.element_at("room", F.col("parity") * 2 + 2)
    leave = inside.groupBy("f1", "parity", "level").count().join(room, "f1").where((F.col("level") == last) & (F.col("count") <= spare)).select("f1", "parity", "level")
    return rest.join(inside.join(leave, ["f1", "parity", "level"]).select("sig", "f1"), ["sig", "f1"], "left_anti")


def with_earlier(rest: DataFrame) -> DataFrame:
    """rest: (sig, f1, ..). Adds the set's signatures right before this one, in the order of schemes and levels, then values."""
    before = Window.partitionBy("f1").orderBy(F.col("sig").bitwiseAND(F.lit(15)), "sig").rowsBetween(-EARLIER, -1)
    return rest.withColumn("earlier", F.collect_list("sig").over(before))


def meetings(rest: DataFrame, threshold: Threshold) -> DataFrame:
    """(a, b) of sets in one signature group and in different components whose sizes and sketches allow a link.

    rest: (sig, f1, c, n, s0.., earlier). Of the groups in which two sets meet the first counts, and few of the others.
    """
    a, b = (rest.select("sig", *[F.col(x).alias(f"{x}_{side}") for x in ("f1", "c", "n", *[f"s{k}" for k in range(SKETCH)], "earlier")]) for side in "ab")
    first = ~F.arrays_overlap("earlier_a", "earlier_b")
    return a.join(b, "sig").where((F.col("c_a") < F.col("c_b")) & near_enough(threshold) & first).select(F.col("f1_a").alias("a"), F.col("f1_b").alias("b"))


def components_of_rows(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, link_ids: bool) -> DataFrame:
    """(id, th, n, component, component_id) of every row; component is null without an id or words."""
    threshold = Threshold(num, den)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    schemes = Schemes(threshold, *size_counts(texts, n, threshold))
    signed = written(sets(texts, n, schemes))
    used = signed.where("n > 0 AND id IS NOT NULL")
    words = [f"s{k}" for k in range(SKETCH)]
    base = written(signed.select("id", "th", "n", "f1"))
    classes = written(used.drop("sigs").groupBy("f1").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("room").alias("room"), F.min("wide").alias("wide"), *[F.min(s).alias(s) for s in words]))

    # signature groups with several classes
    exploded = used.select("f1", F.explode("sigs").alias("sig"))
    groups = written(exploded.groupBy("sig").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).where("lo <> hi").select("sig"))
    members = written(exploded.join(groups, "sig").distinct())
    forget(groups, signed)
    m = members.count()
    known = classes.select("f1", "n", *words)

    def plausible(pairs: DataFrame) -> DataFrame:
        """(a, b) pairs whose sizes and sketches allow a link."""
        sides = [known.select(*[F.col(x).alias(f"{x}_{side}") for x in known.columns]) for side in "ab"]
        return pairs.join(sides[0], F.col("a") == F.col("f1_a")).join(sides[1], F.col("b") == F.col("f1_b")).where(near_enough(threshold)).select("a", "b")

    component = links = held = None
    if link_ids:
        shared = base.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).where("lo <> hi")
        links = written(base.where("n > 0").join(shared, "id").select(F.col("lo").alias("a"), F.col("f1").alias("b")).where("a <> b").distinct())
    for round_ in range(STAR_ROUNDS + 1):
        last = round_ == STAR_ROUNDS
        labelled = members.withColumn("c", F.col("f1"))
        if component is not None:
            labelled = written(members.join(component.withColumnRenamed("node", "f1"), "f1", "left").withColumn("c", F.coalesce("component", "f1")).drop("component"), m)
        # a member of the least component leads its group: the least one at first, then others by chance, lest the same pairs return
        turn = F.xxhash64("f1", "sig", F.lit(round_)) if round_ else F.col("f1")
        open_groups = written(labelled.groupBy("sig").agg(F.min(F.struct("c", turn.alias("turn"), "f1")).alias("least"), F.max("c").alias("most")).where("least.c <> most").select("sig", F.col("least.c").alias("lc"), F.col("least.f1").alias("lf")), m)
        open_ = labelled.join(open_groups, "sig")
        if not last:
            leaders = open_.where("c <> lc").groupBy(F.col("f1").alias("b")).agg(F.array_sort(F.collect_set("lf")).alias("lf"))
            proposed = written(leaders.select("b", F.explode(F.slice("lf", 1, LEADERS if round_ else 1)).alias("a")), m)
            pairs = written(plausible(proposed), m)
        else:
            met = written(without_crowds(written(open_.select("sig", "f1", "c"), m), classes), m)
            rest = written(with_earlier(met.join(known, "f1")))
            pairs = written(meetings(rest, threshold).distinct())
            forget(met, rest)
        loose, pairs = pairs, written(sketched(pairs, classes, threshold), pairs.count())
        n_pairs = pairs.count()
        log.info("round %d: %d pairs compared", round_, n_pairs)
        # the sets of the documents in pairs, made from the texts when first wanted
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("f1")).distinct()
        if held is not None:
            wanted = wanted.join(held.select("f1"), "f1", "left_anti")
        wanted = written(classes.join(wanted, "f1", "left_semi").select("f1", "id"), 2 * n_pairs)
        # a row of the same id may hold another text, hence the join on both; equal rows give equal sets
        more = written(sets(texts.join(wanted.select("id").distinct(), "id", "left_semi"), n).join(wanted, ["id", "f1"], "left_semi").select("f1", "h"))
        held = more if held is None else held.unionByName(more)
        new = written(verified(pairs, held, threshold), n_pairs)
        links = new if links is None else links.unionByName(new)
        component = written(components(links), 2 * links.count())
        forget(open_groups, loose, pairs, wanted, *([labelled] if round_ else []))

    # the least id of each component, then of each class
    own = classes.join(component.withColumnRenamed("node", "f1"), "f1", "left").select("f1", "id", F.coalesce("component", "f1").alias("component"))
    least = own.groupBy("component").agg(F.min("id").alias("component_id"))
    final = written(own.join(least, "component").select(F.col("f1").alias("key"), "component", "component_id"))
    fine = base.withColumn("key", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("f1")))
    return fine.join(final, "key", "left").select("id", "th", "n", "component", F.coalesce("component_id", "id").alias("component_id"))


def near_duplicates(docs: DataFrame, n: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every document: links are pairs of sets with a similarity of at least num / den."""
    rows = components_of_rows(docs, n, num, den, id_col, text_col, True)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, n: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component, that of the least id; rows without an id or words all stay, but for repeated ones.

    Here texts under one id are nodes of their own, so that different ones both stay; of one component the row with the
    least hash of the text stays, of rows equal in id and text any one.
    """
    rows = written(components_of_rows(docs, n, num, den, id_col, text_col, False).where("id IS NOT NULL").groupBy("id", "th", "component").agg(F.count("*").alias("times")))
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("id", "th")).alias("first"), F.count("*").alias("members")).where("members > 1")
    others = rows.join(first.select("component", "first"), "component").where((F.col("first.id") != F.col("id")) | (F.col("first.th") != F.col("th"))).select("id", "th")
    apart = lambda t: t.select(F.col("id").alias(name_id), F.col("th").alias(name_th))
    name_id, name_th = (f"_{c}_{len(''.join(docs.columns))}" for c in ("id", "th"))
    key = (F.col(id_col).cast("long") == F.col(name_id)) & (F.xxhash64(F.col(text_col)) == F.col(name_th))
    kept = docs.join(apart(written(others)), key, "left_anti")
    often = written(rows.where("times > 1").select("id", "th"))
    if often.isEmpty():
        return kept
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    twice = kept.join(apart(often), key, "left_semi").groupBy(id_col, text_col).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in rest])
    return kept.join(apart(often), key, "left_anti").unionByName(twice.select(docs.columns))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op1_ngram_jaccard": r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS s FROM w),
c AS MATERIALIZED (SELECT s, min(doc_id) AS c, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
e AS MATERIALIZED (SELECT c, n, unnest(s) AS g FROM c),
l AS MATERIALIZED (
  SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.g = b.g AND a.c < b.c AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
x AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, least) AS (SELECT c, c FROM c UNION SELECT x.b, r.least FROM r JOIN x ON x.a = r.node WHERE r.least < x.b),
k AS (SELECT c.s, min(r.least) AS component_id FROM c JOIN r ON r.node = c.c GROUP BY c.s)
SELECT d.doc_id, coalesce(len(d.s), 0)::BIGINT AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id FROM s d LEFT JOIN k ON k.s = d.s"""
}
