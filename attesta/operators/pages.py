"""Captured pages: links, crawl events, merged sites and what sites state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta.functions import markup
from attesta.functions.dates import extract_iso_date
from attesta.functions.ids import stable_id
from attesta.functions.urls import host, normalize_homepage, url_path
from attesta.operators.register import publication_reason

# Words that make a link worth a request, and those that never do.
VALUE_WORDS = [
    "om-oss", "about", "kontakt", "contact", "ledelse", "leadership", "team",
    "ansatte", "people", "styre", "board", "karriere", "career", "jobb", "job",
    "ledige", "stilling", "nyheter", "news", "aktuelt", "presse", "press",
    "lokasjon", "location", "avdeling", "office", "investor", "impressum",
]
SKIP_WORDS = [
    "/cart", "/handlekurv", "/login", "/logg-inn", "/wp-admin", "/wp-login",
    "/tag/", "/category/", "/produkt/", "/product/", "/cookie", "/personvern",
    ".pdf", ".jpg", ".png", ".zip", ".mp4", "/feed", "/rss", "?add-to-cart",
]
PRIORITY_WORDS = [
    "kontakt", "contact", "karriere", "career", "stillinger", "jobs", "jobb", "om-oss", "om_oss", "about", "ledelse", "management",
    "team", "people", "locations", "lokasjoner", "avdelinger", "butikker", "news", "press", "aktuelt", "nyheter",
]
ANCHOR = r"(?is)<a\b[^>]*?href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
CAREER_PATH = r"(?i)/(?:karriere|jobs|stillinger|ledige-stillinger|work-with-us|jobb|vacanc)(?:/|$)"
NEWS_PATH = r"(?i)/(?:news|press|aktuelt|nyheter|artikler|blog|media)(?:/|$)"
DATE_METAS = ["article:published_time", "og:published_time", "datePublished", "pubdate", "date"]


def _has_any(text: Column, words: list[str]) -> Column:
    escaped = "|".join("".join("\\" + c if c in r".^$*+?()[]{}|\/-" else c for c in w) for w in words)
    return F.coalesce(text.rlike(escaped), F.lit(False))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute address of a link on a page."""
    scheme = F.regexp_extract(base, "^([a-zA-Z]+):", 1)
    root = F.regexp_extract(base, "^([a-zA-Z]+://[^/?#]*)", 1)
    folder = F.regexp_extract(url_path(base), "^(.*/)", 1)
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, url_path(base), href))
        .when(href.startswith("#") | (href == ""), base)
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), href))
    )


def page_links(pages: DataFrame, base: str = "url", html: str = "html") -> DataFrame:
    """(…page columns, pos, link, anchor): every web link of every page, fragments cut."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(2)).alias("text")
    )
    listed = pages.select(*[c for c in pages.columns if c != html], F.posexplode(pairs).alias("pos", "a"))
    usable = listed.filter(~F.col("a.href").rlike("(?i)^(?:mailto:|tel:|javascript:|#)"))
    link = F.regexp_replace(resolve_url(F.col(base), F.col("a.href")), "#.*$", "")
    anchor = F.lower(F.regexp_replace("a.text", "<[^>]+>", " "))
    return usable.select(*[c for c in pages.columns if c != html], "pos", link.alias("link"), anchor.alias("anchor")).filter(F.col("link").startswith("http"))


def harvest_links(pages: DataFrame, key: str, base: str = "url") -> DataFrame:
    """Distinct same-host links with their worth: +2 path, +1 anchor, -5 for paths without facts."""
    links = page_links(pages.select(key, base, "html"), base).filter(host(F.col("link")) == host(F.col(base)))
    low = F.lower("link")
    skipped = _has_any(low, SKIP_WORDS)
    score = (
        F.when(~skipped & _has_any(low, VALUE_WORDS), 2).otherwise(0) + F.when(_has_any(F.col("anchor"), VALUE_WORDS), 1).otherwise(0) - F.when(skipped, 5).otherwise(0)
    )
    scored = links.withColumn("score", score)
    return scored.groupBy(key, F.lower("link").alias("_link")).agg(F.min_by(F.struct("pos", "link", "score"), "pos").alias("x")).select(key, "x.*")


def valuable_links(pages: DataFrame, key: str, base: str = "url") -> DataFrame:
    return harvest_links(pages, key, base).filter(F.col("score") > 0)


def link_family(link: Column) -> Column:
    """career / news / contact / link of an address."""
    low = F.lower(link)
    return (
        F.when(_has_any(low, ["karriere", "career", "stilling", "jobb", "job", "ledige", "vacan"]), "career")
        .when(_has_any(low, ["nyhet", "news", "aktuelt", "presse", "press", "blog"]), "news")
        .when(_has_any(low, ["kontakt", "contact", "om-oss", "about"]), "contact")
        .otherwise("link")
    )


# Paths worth a guess.
GUESSED_PATHS = {
    "career": ["/karriere", "/careers", "/stillinger", "/jobb", "/ledige-stillinger"],
    "news": ["/nyheter", "/aktuelt", "/presse", "/news", "/blogg"],
    "contact": ["/kontakt", "/om-oss", "/contact", "/about"],
}


def queue_inputs(origins: DataFrame, links: DataFrame) -> DataFrame:
    """Found links (org, link, pos) plus guessed paths under each origin (org, origin), for the crawl queue."""
    found = links.select("org", F.col("link").alias("url"), link_family(F.col("link")).alias("family"), F.lit(True).alias("harvested"), F.col("pos").cast("int").alias("pos"))
    guessed = F.array(*[F.struct(F.lit(family).alias("family"), F.lit(path).alias("path"), F.lit(i).alias("pos")) for family, paths in GUESSED_PATHS.items() for i, path in enumerate(paths)])
    more = origins.select("org", "origin", F.explode(guessed).alias("g")).select(
        "org", F.concat(F.regexp_replace("origin", "/+$", ""), "g.path").alias("url"), "g.family", F.lit(False).alias("harvested"), F.col("g.pos").alias("pos")
    )
    own = origins.select("org", F.lower(F.regexp_replace("origin", "/+$", "")).alias("_own"))
    both = found.unionByName(more).join(own, "org")
    return both.filter(F.lower(F.regexp_replace("url", "/+$", "")) != F.col("_own")).drop("_own")


def diverse_links(links: DataFrame, keep: int) -> DataFrame:
    """Second generation: one link per section first, then the rest by section rank, ``keep`` per page."""
    from pyspark.sql import Window as W

    hay = F.concat(F.lower(url_path(F.col("link"))), F.lit(" "), "anchor")
    rank = F.coalesce(*[F.when(F.contains(hay, F.lit(w)), F.lit(i)) for i, w in enumerate(PRIORITY_WORDS)])
    clean = F.regexp_replace("link", r"\?.*$", "")
    ranked = links.withColumns({"link": clean, "rank": rank}).filter(F.col("rank").isNotNull()).groupBy("org", "link").agg(F.min("rank").alias("rank"))
    ranked = ranked.withColumn("section", _section(F.col("link")))
    # At most ``keep`` of a section can be chosen, so the filter prunes early and loses nothing.
    turn = F.row_number().over(W.partitionBy("org", "section").orderBy("rank", "link"))
    held = ranked.withColumn("turn", turn).filter(F.col("turn") <= keep)
    place = F.row_number().over(W.partitionBy("org").orderBy(F.col("turn") > 1, "rank", "link"))
    return held.withColumn("place", place).filter(F.col("place") <= keep).select("org", "place", "link", "section")


def _section(link: Column) -> Column:
    path = F.lower(url_path(link))
    return (
        F.when(path.rlike("kontakt|contact"), "contact").when(path.rlike("career|karriere|stilling|jobs|jobb"), "careers")
        .when(path.rlike("news|press|aktuelt|nyheter"), "news").otherwise("identity")
    )


def role_links(links: DataFrame) -> DataFrame:
    """Same-site role pages linked from a careers page."""
    careers = F.regexp_extract(url_path(F.col("url")), r"(?i)(career|karriere|stilling|jobs|jobb)", 1) != ""
    path = F.regexp_replace(url_path(F.col("link")), "/+$", "")
    role = path.rlike(r"(?i)/(?:careers?|karriere|stillinger|jobs|jobb)(?:/|[-_]).+") & ~F.lower(path).rlike(r"\.(?:pdf|jpg|png|xml)$")
    return links.filter(careers & role & (host(F.col("link")) == host(F.col("url"))))


# ---- crawl events ----


def page_events(pages: DataFrame) -> DataFrame:
    """(org, requested_url, final_url, status_code, content_type, page_kind, html, retrieved_at) → terminal events; a page_id is carried along."""
    html = F.col("html")
    web = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("html"))
    fetched = F.col("status_code").between(200, 299)
    status = F.when(~fetched, F.when(F.col("status_code").isin(404, 410), "not_found").otherwise("source_error")).when(~web, "source_error").otherwise("available")
    error = F.when(~fetched, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))).when(~web, F.concat(F.lit("Unsupported content type: "), "content_type"))
    good = status == "available"
    text = markup.strip_tags(html)
    scripts = F.size(F.regexp_extract_all(html, F.lit(r"(?i)(<script\b[^>]*\bsrc=)"), F.lit(1)))
    # A page without visible words and with outside scripts is drawn by them.
    state = F.when((F.length(text) < 100) & (scripts >= 2), "js_fallback_candidate").otherwise("static_complete")
    described = F.coalesce(markup.meta_content(html, "description"), markup.meta_content(html, "og:description"))
    return pages.select(
        *[c for c in ("page_id",) if c in pages.columns],
        "org", "requested_url", "final_url", "status_code", "content_type", "page_kind", "retrieved_at", status.alias("status"), error.alias("error"),
        F.octet_length(html).alias("bytes"), F.sha2(html, 256).alias("content_sha256"), F.when(good, markup.unescape(markup.page_title(html))).alias("title"),
        F.when(good, described).alias("description"), F.when(good, text).alias("main_text"), F.when(good, markup.owner_text(html)).alias("identity_text"),
        F.when(good, markup.social_links(html)).alias("social_links"), F.when(good, state).alias("extraction_state"),
    )


def missing_seed_events(profiles: DataFrame, events: DataFrame) -> DataFrame:
    """A terminal error event for every profile with a usable site and no event at all."""
    site = normalize_homepage(F.col("website"))
    silent = profiles.select("org", site.alias("requested_url")).filter(F.col("requested_url").isNotNull()).join(events.select("org").distinct(), "org", "left_anti")
    return silent.select(
        "org", "requested_url", F.col("requested_url").alias("final_url"), F.lit(0).alias("status_code"), F.lit("homepage").alias("page_kind"),
        F.lit("source_error").alias("status"), F.lit("no page event; the request was rejected before download").alias("error"),
        F.sha2(F.lit(""), 256).alias("content_sha256"),
    )


def merge_page_events(events: DataFrame, page: str = "final_url") -> DataFrame:
    """One website row per entity from its newest homepage event; its pages stay a table of their own.

    ``page`` names a page: its address, or the id of a capture where captures of one address are pages of their own.
    """
    home = F.col("page_kind") == "homepage"
    newest = F.struct("retrieved_at", "final_url")
    fields = F.struct("requested_url", "final_url", "status", "error", "title", "description", "content_sha256", "retrieved_at")
    good = F.col("status") == "available"
    merged = events.groupBy("org").agg(
        F.max_by(F.when(home, fields), F.when(home, newest)).alias("h"), F.count_distinct(F.when(good, F.col(page))).alias("pages"),
        F.count_if(~good).alias("crawl_errors"),
        F.bool_or(good & (F.regexp_replace(url_path(F.col("final_url")), "/+$", "") == "")).alias("root_captured"),
    )
    deep = ~F.regexp_replace(url_path(F.col("h.final_url")), "^/+|/+$", "").rlike(r"(?i)^(?:|no|en|nb|nn|index\.html?)$")
    status = F.when(F.col("h").isNull(), "not_found").otherwise(F.col("h.status"))
    return merged.select(
        "org", status.alias("status"), F.col("h.requested_url").alias("requested_url"), F.col("h.final_url").alias("final_url"), F.col("h.title").alias("title"),
        F.col("h.content_sha256").alias("content_sha256"), F.when(F.col("h").isNull(), "no homepage crawl event").otherwise(F.col("h.error")).alias("note"),
        F.when(status == "available", F.col("pages")).otherwise(0).alias("pages"), "crawl_errors",
        F.coalesce(deep, F.lit(False)).alias("homepage_required"), (F.coalesce(deep, F.lit(False)) & F.col("root_captured")).alias("owner_captured"),
    )


def merged_pages(events: DataFrame, page: str = "final_url") -> DataFrame:
    """Captured pages, one per final address or whatever column names a ``page``, homepages first."""
    good = events.filter("status = 'available'")
    order = F.struct((F.col("page_kind") != "homepage").alias("later"), F.negate(F.unix_micros(F.col("retrieved_at"))).alias("age"), "content_sha256")
    carried = [c for c in ("title", "identity_text", "main_text", "content_sha256", "page_kind") if c in events.columns]
    fields = F.struct(F.col("final_url").alias("page_url"), *carried)
    return good.groupBy("org", F.col(page).alias("_page")).agg(F.min_by(fields, order).alias("p")).select("org", "p.*")


def merged_social_links(events: DataFrame) -> DataFrame:
    """Distinct (org, platform, url) with the first page that shows the link."""
    good = events.filter("status = 'available'").select("org", "final_url", "content_sha256", F.explode("social_links").alias("k"))
    return good.groupBy("org", F.col("k.platform").alias("platform"), F.col("k.url").alias("url")).agg(
        F.min_by(F.struct("final_url", "content_sha256"), "final_url").alias("x")
    ).select("org", "platform", "url", F.lit("verified_site_link").alias("discovery_source"), F.col("x.final_url").alias("evidence_url"), F.col("x.content_sha256").alias("evidence_sha256"))


# ---- what a verified site states ----


def site_contacts(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(org, field, value) of accepted sites with the first page each value stands on.

    ``pages``: org, pos, url, html. ``verdicts``: org, publishable.
    """
    accepted = pages.join(verdicts.filter("publishable").select("org").distinct(), "org", "left_semi")
    html = F.col("html")
    text = markup.strip_tags(html)
    none = F.lit(None).cast("string")
    item = lambda field, v, subject: F.struct(F.lit(field).alias("field"), v.alias("value"), subject.alias("subject"))
    found = F.concat(
        F.transform(markup.emails(F.concat(text, F.lit("\n"), html)), lambda v: item("contact_email", v, none)),
        F.transform(markup.phones(text), lambda v: item("contact_phone", v, none)),
        F.transform(markup.social_links(html), lambda v: item("social_profiles", v["url"], v["platform"])),
    )
    rows = accepted.select("org", "pos", "url", F.sha2(html, 256).alias("content_sha256"), F.explode(found).alias("f"))
    return rows.groupBy("org", "f.field", "f.subject", "f.value").agg(F.min_by(F.struct("pos", "url", "content_sha256"), "pos").alias("x")).select(
        "org", "field", "subject", "value", F.col("x.pos").alias("pos"), F.col("x.url").alias("source_url"), F.col("x.content_sha256").alias("content_sha256")
    )


def site_claims(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Website, hiring and dated-news claims of accepted sites, one row each."""
    accepted = pages.join(verdicts.filter("publishable").select("org").distinct(), "org", "left_semi")
    path = url_path(F.col("url"))
    html = F.col("html")
    metas = [extract_iso_date(markup.meta_content(html, name)) for name in DATE_METAS]
    moment = extract_iso_date(F.regexp_extract(html, r"(?is)<time[^>]+datetime=[\"']([^\"']+)[\"']", 1))
    rows = accepted.select(
        "org", "pos", "url", markup.page_title(html).alias("title"), path.rlike(CAREER_PATH).alias("career"), path.rlike(NEWS_PATH).alias("news"),
        F.coalesce(*metas, moment, extract_iso_date(html), extract_iso_date(F.col("url"))).alias("day"),
    )
    page = F.struct("pos", "url", "title", "day")
    sites = rows.groupBy("org").agg(
        F.min_by(page, "pos").alias("home"), F.min_by(F.when(F.col("career"), page), F.when(F.col("career"), F.col("pos"))).alias("c"),
        F.min_by(F.when(F.col("news"), page), F.when(F.col("news"), F.col("pos"))).alias("n"), F.count(F.lit(1)).alias("pages"), F.count_if("career").alias("career_pages"),
    )
    none = F.lit(None).cast("string")

    def claim(field: str, value: Column, url: Column, confidence: float, period: Column = none) -> Column:
        return F.struct(F.lit(field).alias("field"), value.alias("value"), url.alias("source_url"), F.lit(confidence).alias("confidence"), period.alias("reporting_period"))

    hiring = F.when(F.col("career_pages") > 0, "active_recruitment").otherwise("site_active")
    stated = F.array(
        claim("website", F.concat(F.lit("https://"), host(F.col("home.url"))), F.col("home.url"), 0.99),
        claim("hiring_or_activity_signal", hiring, F.coalesce("c.url", "home.url"), 0.95),
        F.when(F.col("n").isNotNull(), claim("dated_public_activity", F.col("n.title"), F.col("n.url"), 0.95, F.col("n.day"))),
    )
    return sites.select("org", "pages", "career_pages", F.explode(F.array_compact(stated)).alias("k")).select("org", "pages", "career_pages", "k.*")


def site_news(pages: DataFrame, profiles: DataFrame, verdicts: DataFrame, as_of: str) -> DataFrame:
    """Own-site posts with a real publication date, as observations.

    ``pages``: org, url, title, main_text, published, content_sha256. ``profiles``: org, founded.
    """
    own = verdicts.filter("publishable AND content_attributable").select("org").distinct()
    j = pages.join(own, "org", "left_semi").join(profiles.select("org", "founded"), "org", "left")
    reason = publication_reason(F.col("published"), F.col("founded"), F.col("url"), F.concat_ws(" ", "title", "main_text"))
    dated = (F.col("published").try_cast("date") <= F.lit(as_of).cast("date")) & (F.length("content_sha256") == 64) & (F.length(F.trim("title")) > 0) & F.col("url").rlike("^https?://")
    kept = j.filter(F.coalesce(dated, F.lit(False)) & reason.isNull())
    return kept.select(
        stable_id(F.col("org"), F.col("url"), prefix="company-site-").alias("id"), "org", F.lit("company_site").alias("platform"), F.lit("public_post").alias("signal_type"),
        F.col("url").alias("source_url"), "content_sha256", F.col("published").alias("published_at"), F.col("title").alias("evidence_span"),
    )


def deepest_news_page(pages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One news page per accepted site, the one deepest in the path tree."""
    accepted = pages.join(verdicts.filter("publishable").select("org").distinct(), "org", "left_semi").filter(url_path(F.col("url")).rlike(NEWS_PATH))
    depth = F.size(F.filter(F.split(url_path(F.col("url")), "/"), lambda p: F.length(p) > 0))
    best = accepted.groupBy("org").agg(F.min_by("url", F.struct(F.negate(depth), F.col("url"))).alias("source_url"), F.count(F.lit(1)).alias("news_pages"))
    return best.withColumn("id", stable_id(F.col("org"), F.col("source_url"), prefix="company-site-news-"))


def site_activity(pages: DataFrame, links: DataFrame, verdicts: DataFrame, structured: DataFrame | None = None) -> DataFrame:
    """Captured pages, verified links and structured records per accepted site."""
    accepted = verdicts.filter("publishable").select("org").distinct()
    counted = pages.groupBy("org").agg(F.count_distinct("url").alias("pages_captured"))
    linked = links.groupBy("org").agg(F.count(F.lit(1)).alias("verified_social_links"))
    rows = accepted.join(counted, "org", "left").join(linked, "org", "left")
    if structured is not None:
        rows = rows.join(structured.groupBy("org").agg(F.count(F.lit(1)).alias("structured_records")), "org", "left")
    else:
        rows = rows.withColumn("structured_records", F.lit(0).cast("long"))
    return rows.fillna(0, ["pages_captured", "verified_social_links", "structured_records"])
