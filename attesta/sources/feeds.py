"""RSS, Atom and sitemap documents as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta.functions.dates import date_only, feed_dates
from attesta.functions.urls import host, url_path
from attesta.session import stored

ITEM = (
    "array<struct<title:string,link:string,source:string,pubDate:string,published:string,date:string,issued:string,"
    "updated:string,modified:string,lastmod:string>>"
)
ENTRY = (
    "array<struct<title:string,link:array<struct<_href:string,_rel:string>>,source:string,pubDate:string,published:string,"
    "date:string,issued:string,updated:string,modified:string,lastmod:string>>"
)
FEED_SCHEMA = f"channel struct<item:{ITEM}>, item {ITEM}, entry {ENTRY}, _corrupt_record string"
SITEMAP_SCHEMA = "url array<struct<loc:string,lastmod:string>>, sitemap array<struct<loc:string>>, _corrupt_record string"
XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

# Article addresses, pages that are not articles, and maps that list news.
NEWS_PATH = r"(?i)/(?:[^/]+/)*(?:news|newsroom|nyhet(?:er)?|aktuelt|press(?:room)?|presse|pressemeldinger|artikler|articles|blogg?|innsikt|insights?)(?:/|[-_])"
SKIP_PATH = r"(?i)/(?:tag|category|author|page|feed|sitemap)(?:/|$)"
SECTION_NAMES = ["news", "nyheter", "aktuelt", "press", "presse", "blog", "blogg", "articles", "artikler"]
NEWS_MAP = r"(?i)news|nyhet|post|artik|blog|press|aktuelt"
SKIP_MAP = r"(?i)product|tag|category|author|attachment"


def _xml(column: str, schema: str) -> Column:
    return F.from_xml(F.col(column), schema, XML_OPTIONS)


def _readable(xml: Column) -> Column:
    """Whether the document opens and closes the same root element."""
    root = F.regexp_extract(xml, r"^(?:﻿|\s|<\?[^>]*\?>|<!--(?s:.*?)-->|<![^>]*>)*<([A-Za-z_][\w:.-]*)", 1)
    closes = F.trim(xml).endswith(F.concat(F.lit("</"), root, F.lit(">")))
    return F.coalesce((root != "") & closes, F.lit(False))


def _iso_dates(e: Column) -> Column:
    return feed_dates(
        [e["pubDate"], e["published"], e["date"], e["issued"]],
        [e["updated"], e["modified"], e["lastmod"]],
        ["pubdate", "published", "date", "issued", "updated", "modified", "lastmod"],
    )


def _entry(e: Column, link: Column) -> Column:
    return F.struct(
        F.trim(e["title"]).alias("title"), F.trim(link).alias("link"), F.trim(e["source"]).alias("publisher"),
        _iso_dates(e).alias("dated"),
    )


def explode_feed(docs: DataFrame) -> DataFrame:
    """(org, url, xml) → one row per item; a document that is no XML gives one parse_failure row."""
    parsed = docs.select("org", "url", F.sha2("xml", 256).alias("content_sha256"), _xml("xml", FEED_SCHEMA).alias("d"), _readable(F.col("xml")).alias("whole"))
    alternate = lambda e: F.coalesce(  # noqa: E731 - a column helper, not a function of rows
        F.try_element_at(F.filter(e["link"], lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate"), F.lit(1)),
        F.try_element_at(e["link"], F.lit(1)),
    )["_href"]
    empty = F.array().cast("array<struct<title:string,link:string,publisher:string,dated:struct<date:string,kind:string,source:string>>>")

    def entries(source: Column, link) -> Column:
        return F.coalesce(F.transform(source, lambda e: _entry(e, link(e))), empty)

    items = F.concat(
        entries(F.col("d.channel.item"), lambda e: e["link"]), entries(F.col("d.item"), lambda e: e["link"]),
        entries(F.col("d.entry"), alternate),
    )
    broken = ~F.col("whole") | F.col("d").isNull() | F.col("d._corrupt_record").isNotNull()
    rows = parsed.withColumn("broken", F.coalesce(broken, F.lit(True)))
    good = rows.filter(~F.col("broken")).select("org", "url", "content_sha256", F.posexplode(items).alias("pos", "i"))
    listed = good.select(
        "org", "url", "content_sha256", "pos", F.lit("item").alias("outcome"), "i.title", "i.link", "i.publisher",
        F.when(F.col("i.dated.kind") == "published", F.col("i.dated.date")).otherwise("").alias("published"),
        F.when(F.col("i.dated.kind") == "modified", F.col("i.dated.date")).otherwise("").alias("modified"),
        F.col("i.dated.kind").alias("date_kind"),
        F.when(F.col("i.dated.source") != "", F.concat(F.lit("feed:"), "i.dated.source")).otherwise("").alias("date_source"),
    ).filter((F.length("title") > 0) & (F.length("link") > 0))
    failed = rows.filter("broken").select("org", "url", "content_sha256", F.lit("parse_failure").alias("outcome"))
    return listed.unionByName(failed, allowMissingColumns=True)


def article_candidate(url: Column) -> Column:
    """Whether an address looks like one article rather than a section or a machine file."""
    path = F.lower(url_path(url))
    last = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    return (
        path.rlike(NEWS_PATH) & ~path.rlike(SKIP_PATH) & ~path.rlike(r"\.(?:xml|xml\.gz|rss|atom|json)$") & ~last.isin(SECTION_NAMES)
    )


def explode_sitemaps(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """Walk sitemap indexes from ``roots`` (org, url) through the captured ``docs`` (url, xml), to their last level.

    Documents are parsed once, into the addresses they list. Each level is one equi-join on the address; an address met
    before is not walked again, so the walk ends. Rows are page addresses with their last change.
    """
    d = _xml("xml", SITEMAP_SCHEMA)
    entry = lambda nested, loc, changed: F.struct(F.lit(nested).alias("nested"), F.trim(loc).alias("loc"), changed.alias("modified"))
    listed = F.concat(
        F.coalesce(F.transform(F.col("d.url"), lambda u: entry(False, u["loc"], date_only(u["lastmod"]))), F.array()),
        F.coalesce(F.transform(F.col("d.sitemap"), lambda m: entry(True, m["loc"], F.lit(None).cast("string"))), F.array()),
    )
    entries = stored(docs.select("url", d.alias("d")).select(F.col("url").alias("sitemap"), F.explode(listed).alias("e")).select("sitemap", "e.*"), "sitemaps")
    same_site = (host(F.col("loc")) == F.col("site")) | host(F.col("loc")).endswith(F.concat(F.lit("."), F.col("site")))
    frontier = stored(roots.select("org", "url", host(F.col("url")).alias("site")).distinct(), "maps")
    seen, walked, level = frontier.select("org", "url"), None, 0
    while not frontier.isEmpty():
        this = frontier.withColumn("level", F.lit(level))
        walked = this if walked is None else walked.unionByName(this)
        met = frontier.join(entries.filter("nested"), F.col("url") == F.col("sitemap")).filter(same_site & ~F.col("loc").rlike(SKIP_MAP))
        frontier = stored(met.select("org", F.col("loc").alias("url"), "site").distinct().join(seen, ["org", "url"], "left_anti"), "maps")
        seen = seen.unionByName(frontier.select("org", "url"))
        level += 1
    walked = frontier.withColumn("level", F.lit(0)) if walked is None else walked
    pages = walked.join(entries.filter("NOT nested"), F.col("url") == F.col("sitemap")).filter(same_site)
    return pages.select("org", "sitemap", F.col("loc").alias("url"), "modified", "level", article_candidate(F.col("loc")).alias("is_article"))


def map_priority(url: Column) -> Column:
    """0 for maps that list news, 1 for the rest: the order to read nested maps in."""
    return F.when(url.rlike(NEWS_MAP), 0).otherwise(1)


def video_activity(items: DataFrame) -> DataFrame:
    """(org, published, title, link, views text) → upload count, newest item, sum of numeric views."""
    views = F.col("views").try_cast("bigint")
    newest = F.max_by(F.struct("published", "title", "link"), F.struct("published", "link"))
    return items.groupBy("org").agg(
        F.count(F.lit(1)).alias("uploads"), newest.alias("n"), F.sum(views).alias("views"), F.count(views).alias("items_with_views")
    ).select("org", "uploads", F.col("n.published").alias("latest_published"), F.col("n.title").alias("latest_title"),
             F.col("n.link").alias("latest_url"), "views", "items_with_views")
