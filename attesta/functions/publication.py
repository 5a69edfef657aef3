"""When a page was published, by its document structure: metadata, its article's markup, the heading of its article.

A date that only says when something changed is no publication date, and neither is one in a list of related stories, in
body text or in a footer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions import markup
from attesta.functions.dates import date_only, valid_date
from attesta.functions.text import let

# What marks a publication date, in the order in which marks count.
MARKERS = [
    'meta[property="article:published_time"]', 'meta[name="datePublished"]', 'meta[itemprop="datePublished"]',
    'time[itemprop="datePublished"][datetime]', "time.published[datetime]", "time.entry-date:not(.updated)[datetime]",
]
ARTICLES = ["Article", "NewsArticle", "BlogPosting", "Report"]
CHANGED = r"(?i)oppdatert|modified|updated|revidert"
VISIBLE = r"(?i)\b(\d{1,2})\.?\s+([A-Za-zæøå]+)\s+(20\d{2})\b"


def attribute(tag: Column, name: str) -> Column:
    """An attribute of a start tag, quoted or bare; NULL without it."""
    pattern = rf"(?is)(?<![\w-]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    return F.when(tag.rlike(pattern), markup.unescape(value))


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b[^>]*>"), F.lit(0))


def _classes(tag: Column) -> Column:
    return F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+")


def marked_date(html: Column) -> Column:
    """struct(date, source) of the first marker whose first element on the page holds a date; NULL without one."""
    has = lambda name, value: lambda t: F.coalesce(attribute(t, name) == value, F.lit(False))
    timed = lambda test: lambda t: attribute(t, "datetime").isNotNull() & test(t)
    entry = lambda t: F.array_contains(_classes(t), "entry-date") & ~F.array_contains(_classes(t), "updated")
    tests = [
        ("meta", has("property", "article:published_time"), "content"), ("meta", has("name", "datePublished"), "content"), ("meta", has("itemprop", "datePublished"), "content"),
        ("time", timed(has("itemprop", "datePublished")), "datetime"), ("time", timed(lambda t: F.array_contains(_classes(t), "published")), "datetime"), ("time", timed(entry), "datetime"),
    ]

    def picked(metas: Column, times: Column) -> Column:
        def one(name: str, tag: str, test, where: str) -> Column:
            first = F.get(F.filter(metas if tag == "meta" else times, test), F.lit(0))
            return let(date_only(attribute(first, where)), lambda day: F.when(day != "", F.struct(day.alias("date"), F.lit(f"page:{name}").alias("source"))))

        return F.coalesce(*[one(name, *test) for name, test in zip(MARKERS, tests, strict=True)])

    # Few pages have many of these tags; they are found once.
    likely = F.filter(_tags(html, "meta"), lambda t: F.contains(F.lower(t), F.lit("publish")))
    return let(likely, lambda metas: let(_tags(html, "time"), lambda times: picked(metas, times)))


def header_date(html: Column) -> Column:
    """The one visible date in the heading of the page's article; NULL where there is none, several, or a word of change."""
    holders = F.regexp_extract_all(html, F.lit(r"(?is)<(article|main)\b[^>]*>.*?</\1\s*>"), F.lit(0))
    head = r"(?is)<header\b[^>]*>(.*?)</header\s*>"
    block = F.regexp_extract(F.coalesce(F.get(F.filter(holders, lambda x: x.rlike(head)), F.lit(0)), F.lit("")), head, 1)
    month = F.create_map(*[F.lit(v) for name in sorted({*lx.NORWEGIAN_MONTHS, *lx.ENGLISH_MONTHS}) for v in (name, lx.MONTH_NUMBERS[name])])

    def day(hit: Column) -> Column:
        number = F.try_element_at(month, F.lower(F.regexp_extract(hit, VISIBLE, 2)))
        made = F.format_string("%s-%02d-%02d", F.regexp_extract(hit, VISIBLE, 3), number, F.regexp_extract(hit, VISIBLE, 1).cast("int"))
        return F.when(number.isNotNull(), valid_date(made))

    def judged(text: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(VISIBLE), F.lit(0))
        return F.when((F.size(hits) == 1) & ~text.rlike(CHANGED), day(F.get(hits, F.lit(0))))

    return let(block, lambda b: F.when(b.rlike(r"(?is)<h1\b"), let(markup.strip_tags(markup.unescape(b)), judged)))


def _same_page(left: Column, right: Column) -> Column:
    bare = lambda u: F.rtrim(F.substring_index(u, "#", 1), F.lit("/"))
    return bare(left) == bare(right)


def article_dates(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """(page_key, date) of articles in a page's markup that describe this very page.

    An article names its page, or it is the only article there. The first with a date counts.
    """
    nodes = markup.jsonld_nodes(pages, key, html).filter(markup.node_has_type(*ARTICLES))
    own = pages.select(F.col(key).cast("string").alias("page_key"), F.col(url).alias("_url"))
    held = nodes.groupBy("page_key").agg(F.count(F.lit(1)).alias("_articles"))
    get = lambda path: F.nullif(F.get_json_object("node", path), F.lit(""))
    plain = lambda path: F.when(~get(path).startswith("{") & ~get(path).startswith("["), get(path))
    declared = F.coalesce(plain("$.url"), get("$.mainEntityOfPage['@id']"), plain("$.mainEntityOfPage"), plain("$['@id']"))
    rows = nodes.join(own, "page_key").join(held, "page_key").withColumns({"_declared": declared, "_day": date_only(get("$.datePublished"))})
    mine = F.when(F.col("_declared").isNotNull(), _same_page(F.col("_declared"), F.col("_url"))).otherwise(F.col("_articles") == 1)
    return rows.filter(mine & (F.col("_day") != "")).groupBy("page_key").agg(F.min_by("_day", "pos").alias("date"))


def page_publication_date(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """(page_key, published, source) of every page, one row per key; both are empty where nothing tells.

    Markers in the page's tags come first, then the markup of its article, then the date in its article's heading.
    """
    tags = pages.select(F.col(key).cast("string").alias("page_key"), marked_date(F.col(html)).alias("m"), header_date(F.col(html)).alias("h"))
    found = tags.join(article_dates(pages, key, url, html), "page_key", "left")
    by = F.when(F.col("m").isNotNull(), F.col("m.source")).when(F.col("date").isNotNull(), "page:Article.datePublished").when(F.col("h").isNotNull(), "page:article_header_visible_date")
    return found.select("page_key", F.coalesce("m.date", "date", "h", F.lit("")).alias("published"), F.coalesce(by, F.lit("")).alias("source"))
