"""Columns and rows read out of HTML."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.functions.text import digits, let
from attesta.functions.urls import SOCIAL_URL, normalize_social_url
from attesta.session import fixed, spread, stored

SCRIPT_JSON = r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"


def _tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def unescape(text: Column) -> Column:
    """The entities that matter in names and addresses."""
    for entity, plain in (("&nbsp;", " "), ("&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                          ("&oslash;", "ø"), ("&Oslash;", "Ø"), ("&aring;", "å"), ("&Aring;", "Å"), ("&aelig;", "æ"), ("&AElig;", "Æ"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def strip_tags(html: Column) -> Column:
    """Visible text: scripts, styles and tags become spaces, runs of spaces collapse."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|noscript)[^>]*>.*?</\1>", " ")
    return _tidy(F.regexp_replace(bare, "<[^>]+>", " "))


def page_title(html: Column) -> Column:
    return strip_tags(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def meta_content(html: Column, name: str) -> Column:
    """Content of a meta tag, whichever order its attributes have; NULL when absent."""
    before = rf"(?is)<meta[^>]+(?:name|property|itemprop)=[\"']{re.escape(name)}[\"'][^>]+content=[\"']([^\"']*)[\"']"
    after = rf"(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]+(?:name|property|itemprop)=[\"']{re.escape(name)}[\"']"
    return F.nullif(F.trim(F.coalesce(F.nullif(F.regexp_extract(html, before, 1), F.lit("")), F.regexp_extract(html, after, 1))), F.lit(""))


def region_text(html: Column, tag: str) -> Column:
    """Text of every block of one tag."""
    blocks = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return strip_tags(F.array_join(blocks, " "))


CONTACT_BLOCK = (
    r"(?is)<(?:div|section|address)\b[^>]*(?:class|id)=[\"'][^\"']*(?:kontakt|contact|impressum|footer|address)[^\"']*[\"'][^>]*>"
    r"(.*?)</(?:div|section|address)>"
)


def contact_text(html: Column) -> Column:
    return strip_tags(F.array_join(F.regexp_extract_all(html, F.lit(CONTACT_BLOCK), F.lit(1)), " "))


def owner_text(html: Column) -> Column:
    """Regions where a site says who owns it: header, footer, address."""
    blocks = [F.regexp_extract_all(html, F.lit(rf"(?is)<{t}\b[^>]*>(.*?)</{t}>"), F.lit(1)) for t in ("header", "footer", "address")]
    return strip_tags(F.array_join(F.concat(*blocks), " "))


def page_signals(html: Column) -> list[Column]:
    """The identity regions of a page, whole."""
    return [
        page_title(html).alias("title"), F.coalesce(meta_content(html, "description"), F.lit("")).alias("meta_description"),
        region_text(html, "footer").alias("footer_text"), contact_text(html).alias("contact_text"), strip_tags(html).alias("body_text"),
    ]


# ---- contacts ----

EMAIL = r"([a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,})"
PHONE = r"(?<!\d)((?:(?:\+47|0047)\s?)?[2-9](?:\s?\d){7})(?!\d)"
IMAGE = r"\.(?:png|jpg|gif|svg|webp)$"


def emails(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(1)), F.lower)
    return F.array_distinct(F.filter(found, lambda m: ~m.rlike(IMAGE)))


def clean_phone(raw: Column) -> Column:
    """+47 with mobile or landline grouping; NULL when it is no eight-digit number."""
    number = digits(raw)
    core = F.when(number.rlike("^47[0-9]{8}$"), F.substring(number, 3, 8)).otherwise(number)
    part = lambda start, size: F.substring(core, start, size)
    mobile = F.concat_ws(" ", F.lit("+47"), part(1, 3), part(4, 2), part(6, 3))
    landline = F.concat_ws(" ", F.lit("+47"), part(1, 2), part(3, 2), part(5, 2), part(7, 2))
    return F.when(core.rlike("^[49][0-9]{7}$"), mobile).when(core.rlike("^[2-8][0-9]{7}$"), landline)


def phones(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(PHONE), F.lit(1)), clean_phone)
    return F.array_distinct(F.array_compact(found))


def social_links(html: Column) -> Column:
    """Distinct struct(platform, url) in order of links, widget addresses, frames and bare addresses."""
    patterns = [
        r"(?i)<a\b[^>]*?href=[\"']([^\"']+)[\"']", r"(?i)data-href=[\"']([^\"']+)[\"']", r"(?i)<iframe\b[^>]*?src=[\"']([^\"']+)[\"']",
        r"(https?://[^\s\"'<>]+)",
    ]
    raw = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in patterns])
    # A page has many links and few to these hosts; the cheap test goes first.
    likely = F.array_distinct(F.filter(raw, lambda u: u.rlike(SOCIAL_URL)))
    return F.array_distinct(F.array_compact(F.transform(likely, lambda u: normalize_social_url(unescape(u)))))


# ---- JSON-LD ----

NODE = "array<struct<path: array<int>, v: variant>>"
FOUND = "array<struct<path: array<int>, types: array<string>, node: string, open: boolean>>"
LEVELS = 8  # of nesting walked in one pass


def jsonld_scripts(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(SCRIPT_JSON), F.lit(1))


def _opened(values: Column) -> Column:
    """Those values that are objects (m) or lists (l), opened once; nothing else has a type or holds values."""
    inside = lambda x, kind: F.try_variant_get(x["v"], "$", kind)
    opened = F.transform(values, lambda x: F.struct(x["path"].alias("path"), x["v"].alias("v"), inside(x, "map<string,variant>").alias("m"), inside(x, "array<variant>").alias("l")))
    return F.filter(opened, lambda x: x["m"].isNotNull() | x["l"].isNotNull())


def _children(x: Column) -> Column:
    """The values inside an object or a list, with their places."""
    below = lambda value, i: F.struct(F.concat(x["path"], F.array(i)).alias("path"), value.alias("v"))
    return F.coalesce(F.transform(F.map_entries(x["m"]), lambda e, i: below(e["value"], i)), F.transform(x["l"], below))


def _types(m: Column) -> Column:
    """Last parts of an object's types; NULL without one. An object is no type."""

    def kept(t: Column) -> Column:
        named = F.coalesce(F.try_variant_get(t, "$", "array<string>"), F.array(F.try_variant_get(t, "$", "string")))
        return F.transform(F.filter(named, lambda n: (F.length(n) > 0) & ~n.startswith("{")), lambda n: F.regexp_extract(n, "([^/]*)$", 1))

    found = let(F.try_element_at(m, F.lit("@type")), lambda t: F.when(t.isNotNull(), kept(t)))
    return let(found, lambda types: F.when(F.size(types) > 0, types))


def _walk(level: Column, left: int) -> Column:
    """Typed objects of a level and those below it; what is deeper than the levels left comes back unwalked."""
    if not left:
        return F.transform(level, lambda x: F.struct(x["path"].alias("path"), F.lit(None).cast("array<string>").alias("types"), F.to_json(x["v"]).alias("node"), F.lit(True).alias("open")))
    named = lambda a: F.filter(F.transform(a, lambda x: F.struct(x["path"].alias("path"), _types(x["m"]).alias("types"), x["v"].alias("v"))), lambda x: x["types"].isNotNull())
    typed = lambda a: F.transform(named(a), lambda x: F.struct(x["path"].alias("path"), x["types"].alias("types"), F.to_json(x["v"]).alias("node"), F.lit(False).alias("open")))
    # Most pages end after a few levels.
    return let(_opened(level), lambda a: F.when(F.size(a) > 0, F.concat(typed(a), _walk(F.flatten(F.transform(a, _children)), left - 1))).otherwise(F.array().cast(FOUND)))


def _nodes(pages: DataFrame, start: Column) -> DataFrame:
    """(page_key, pos, path, types, node, open) under the values ``start`` of each row, in the order of their places."""
    return pages.select("page_key", F.posexplode(F.array_sort(_walk(start.cast(NODE), LEVELS))).alias("pos", "x")).select("page_key", "pos", "x.*")


def _parsed(scripts: Column) -> Column:
    parsed = F.transform(scripts, lambda t, i: F.struct(F.array(i).alias("path"), F.try_parse_json(t).alias("v")))
    return F.filter(parsed, lambda x: x["v"].isNotNull())


def walked(scripts: Column) -> Column:
    """The typed nodes of a page's scripts as one array, without a shuffle; what is deeper than one pass walks is ``open``, for ``deeper_nodes``."""
    return _walk(_parsed(scripts).cast(NODE), LEVELS)


def deeper_nodes(unwalked: DataFrame) -> list[DataFrame]:
    """(page_key, path, node) of open nodes → the typed nodes below them, a table a pass."""
    parts = []
    while not unwalked.isEmpty():
        found = stored(_nodes(unwalked, F.array(F.struct("path", F.try_parse_json("node").alias("v")))), "markup-nodes")
        parts.append(found.filter("NOT open"))
        unwalked = found.filter("open")
    return parts


def jsonld_nodes(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(page_key, pos, types, node JSON) of every typed node at any depth, parents before children, keys of an object in order of name."""
    return placed_nodes(pages, key, html).drop("path")


def placed_nodes(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """The nodes with their paths: a node inside another has that one's path as the start of its own.

    JSON is parsed once to VARIANT and walked level by level in the JVM. The nodes are stored, as their readers each take other
    types of them; nodes deeper than one pass walks go through another. A walk costs far more than the bytes of its page, so
    the scripts, not the pages, are dealt to every core.
    """
    scripts = pages.select(F.col(key).cast("string").alias("page_key"), jsonld_scripts(F.col(html)).alias("scripts"))
    keyed = spread(fixed(scripts).filter(F.size("scripts") > 0), "page_key", "scripts")
    found = stored(_nodes(keyed, _parsed(F.col("scripts"))), "markup-nodes")
    parts = [found.filter("NOT open"), *deeper_nodes(found.filter("open"))]
    every = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        every = every.withColumn("pos", F.row_number().over(W.partitionBy("page_key").orderBy("path")) - 1)
    return every.select("page_key", "pos", "path", "types", "node")


def node_text(node: Column, path: str) -> Column:
    """Text of a node's property, whether plain, a list's first item, or an object with a name or value."""
    tries = [f"$.{path}.name", f"$.{path}['@value']", f"$.{path}[0]", f"$.{path}"]
    picked = F.coalesce(*[F.get_json_object(node, t) for t in tries])
    return F.nullif(F.trim(F.when(~picked.startswith("{"), picked)), F.lit(""))


def node_has_type(*names: str) -> Column:
    return F.arrays_overlap("types", F.array(*[F.lit(n) for n in names]))


ORGANISATION_TYPES = ["Organization", "Corporation", "LocalBusiness", "Store", "Restaurant"]
