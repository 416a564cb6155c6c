"""URL rules whose block decisions reach the aliases of a page.

Redirect equivalence: the targets of canonical links and of refresh redirects, decoded and resolved against the page's url,
are aliases of the page. Connected
components over these edges hold the aliases together; a component with a blocked member blocks every member that no
rule names, unless the component also has an explicitly allowed member, for an allow takes precedence.

Defined results: a null url or one without :// has empty host and path, fits no rule and has no aliases; repeated rows
each get a verdict; rows keep their other columns; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table, written
from .components import components


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules (fixed values).
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ATTRIBUTE = r"""\s*=\s*["']?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, of equally long ones the first; else null."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: -len(r.text))
    ]
    return reduce(lambda a, b: F.coalesce(a, b), fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def unescaped(text: Column) -> Column:
    """Text whose character references (numeric, and the named ones of markup and urls) are decoded once."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("sol", "/"), ("colon", ":")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))

    def decoded(done: Column, ref: Column) -> Column:
        code = F.when(F.lower(ref).startswith("x"), F.conv(F.substr(ref, F.lit(2)), 16, 10)).otherwise(ref).cast("int")
        valid = (code > 0) & (code != 38) & ((code < 0xD800) | code.between(0xE000, 0x10FFFF))
        return F.when(valid, F.replace(done, F.concat(F.lit("&#"), ref, F.lit(";")), F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32"))).otherwise(done)

    text = F.aggregate(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), 1), text, decoded)
    # & last, so that what it begins is not decoded again
    return F.regexp_replace(text, "&(?:amp|#0*38|#[xX]0*26);", "&")


def without_dots(path: Column) -> Column:
    """An absolute path without its segments . and .. (RFC 3986, 5.2.4)."""
    step = lambda kept, part: F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))
    parts = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    end = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def resolved(target: Column, url: Column) -> Column:
    """The absolute url of a target in the page at url; null for targets in the page itself and urls without ://."""
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    path, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None).cast("string"))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.when(target.rlike(r"^[^/?#]*://"), target))
        .when(target.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), target))
        .when(target.startswith("?"), F.concat(origin, path_of(url), target))
        .when(target.startswith("/"), F.concat(origin, without_dots(path), rest))
        .otherwise(F.concat(origin, without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), path)), rest))
    )


def alias_targets(html: Column, url: Column) -> Column:
    """Targets of <link rel=canonical> and of <meta http-equiv=refresh> in the page at url, as absolute urls."""
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<link\b[^>]*>)"), 1), lambda t: t.rlike(r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b")),
        lambda t: F.regexp_extract(t, r"(?is)\bhref" + ATTRIBUTE, 1),
    )
    refresh = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<meta\b[^>]*>)"), 1), lambda t: t.rlike(r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh")),
        lambda t: F.regexp_extract(t, r"(?is)\burl" + ATTRIBUTE, 1),
    )
    return F.array_compact(F.transform(F.array_distinct(F.concat(canonical, refresh)), lambda t: resolved(unescaped(t), url)))


def alias_key(url: Column) -> Column:
    """Urls that name one resource whatever the scheme and the fragment: host in lower case and all from the path on."""
    return F.concat(host_of(url), F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1), F.lit("")))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Adds host, path, rule and verdict (allow or block) to pages, and component, the least alias node (null: no alias).

    The edges are pages to alias targets, keyed by a 64-bit hash of the url key; only pages with edges, and pages that are
    targets, take part in a shuffle.
    """
    url = F.col(url_col)
    own = {"__url_key": F.xxhash64(alias_key(url)), "host": host_of(url), "path": path_of(url)}
    judged = pages.drop("host", "path", "rule", "verdict", "component").withColumns(own).withColumn("__r", rule_of(F.col("host"), F.col("path"), rules))
    edges = written(
        pages.where(url.contains("://") & F.col(html_col).rlike("(?i)canonical|refresh"))
        .select(F.xxhash64(alias_key(url)).alias("a"), F.explode(alias_targets(F.col(html_col), url)).alias("target"))
        .select("a", F.xxhash64(alias_key(F.col("target"))).alias("b"), rule_of(host_of(F.col("target")), path_of(F.col("target")), rules)["verdict"].alias("b_verdict"))
    )
    if edges.isEmpty():
        decided = judged.withColumns({"component": F.lit(None).cast("long"), "__c": F.lit(None).cast("string")})
    else:
        node = components(edges.select("a", "b"))
        node = written(node)
        known = judged.where("__r IS NOT NULL AND host <> ''").select(F.col("__url_key").alias("node"), F.col("__r.verdict").alias("v"))
        known = known.unionByName(edges.where("b_verdict IS NOT NULL").select(F.col("b").alias("node"), F.col("b_verdict").alias("v")))
        # 'allow' < 'block', so the minimum gives the explicit allow precedence
        decision = known.join(node, "node").groupBy("component").agg(F.min("v").alias("__c"))
        per_node = node.join(decision, "component", "left").select(F.col("node").alias("__url_key"), "component", "__c")
        decided = judged.join(per_node, "__url_key", "left")
    return decided.withColumns({"rule": F.col("__r.rule"), "verdict": F.coalesce(F.col("__r.verdict"), F.when(F.col("host") != "", F.col("__c")), F.lit("allow"))}).drop("__r", "__c", "__url_key")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


_HOST = "lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'))"
_PATH = "regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's')"
ORACLE_SQL = {
    "op5_url_filters": f"""
WITH u AS (SELECT page_id, coalesce({_HOST}, '') AS host, coalesce({_PATH}, '') AS path FROM pages),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, host, path, h || p AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS n
      FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1"""
}
