import json

import pytest
from pyspark.sql import functions as F

from attesta.functions import markup, publication

URL = "https://example.no/news/a"
HEADER = "<article><header><h1>New project</h1><span>15. oktober 2026</span></header><p>Since 2020</p></article><aside>Related: 9. oktober 2026</aside>"


def script(value):
    return f'<script type="application/ld+json">{json.dumps(value)}</script>'


NEWS = {"@type": "NewsArticle", "url": URL, "datePublished": "2026-10-01", "dateModified": "2026-11-01"}
ARTICLE = ("2026-10-01", "page:Article.datePublished")
CASES = [
    (HEADER, ("2026-10-15", "page:article_header_visible_date")), (HEADER.replace("15. oktober", "Oppdatert 15. oktober"), ("", "")), (HEADER.replace("2026</span>", "2026, 16 oktober 2026</span>"), ("", "")),
    (HEADER.replace("oktober 2026</span>", "October 2026</span>"), ("2026-10-15", "page:article_header_visible_date")), (HEADER.replace("<h1>New project</h1>", ""), ("", "")), (HEADER.replace("15. oktober", "35. oktober"), ("", "")),
    ("<main><p>x</p><header><h1>T</h1>3 mai 2024</header></main>", ("2024-05-03", "page:article_header_visible_date")), ("<header><h1>T</h1>3 mai 2024</header>", ("", "")),
    (script(NEWS), ARTICLE), (script({**NEWS, "url": "https://example.no/news/b"}), ("", "")), (script({"@type": "NewsArticle", "dateModified": "2026-11-01"}), ("", "")),
    (script({**NEWS, "url": URL + "/#top"}), ARTICLE), (script({"@graph": [{"@type": ["Report", "Thing"], "datePublished": "2026-10-01"}]}), ARTICLE), (script([{"@type": "Article", "datePublished": "2026-10-01"}] * 2), ("", "")),
    (script({"@type": "BlogPosting", "mainEntityOfPage": {"@id": URL}, "datePublished": "Thu, 01 Oct 2026 10:00:00 GMT"}), ARTICLE), (script({"@type": "WebPage", "datePublished": "2026-10-01"}), ("", "")),
    ("<meta property='article:published_time' content=2026-01-02T03:04>" + script(NEWS), ("2026-01-02", "page:" + publication.MARKERS[0])),
    ("<meta name=datePublished content='junk'><META CONTENT=\"2026-01-03\" itemprop=\"datePublished\">", ("2026-01-03", "page:" + publication.MARKERS[2])),
    ("<meta property='article:published_time' content='junk'><meta property='article:published_time' content='2026-01-02'>", ("", "")),
    ("<time class='entry-date updated' datetime='2026-02-01'></time><time class='x entry-date' datetime='2026-02-02'>", ("2026-02-02", "page:" + publication.MARKERS[5])),
    ("<time class='published'>x</time><time datetime=2026-02-03 class=published>", ("2026-02-03", "page:" + publication.MARKERS[4])), ("<p>1. mai 2024</p>", ("", "")), ("", ("", "")), (None, ("", "")),
]


def test_pages_are_dated_by_their_structure(spark):
    pages = spark.createDataFrame([(k, URL, html) for k, (html, _) in enumerate(CASES)], "k int, url string, html string")
    found = {int(r.page_key): (r.published, r.source) for r in publication.page_publication_date(pages, "k").collect()}
    assert found == {k: want for k, (_, want) in enumerate(CASES)}


def walked(value):
    """Typed objects in order: parents first, an object's keys by name."""
    if isinstance(value, dict):
        kind = value.get("@type")
        if kind:
            yield [str(t).rsplit("/", 1)[-1] for t in (kind if isinstance(kind, list) else [kind])]
        for k in sorted(value):
            yield from walked(value[k])
    elif isinstance(value, list):
        for item in value:
            yield from walked(item)


def nested(depth):
    value = {"@type": f"T{depth}"}
    for k in range(depth - 1, -1, -1):
        value = {"@type": f"http://schema.org/T{k}", "inner": [value, {"@type": ["A", "B"]}]} if k % 2 else {"b": value, "a": {"@type": "C"}, "@type": f"T{k}"}
    return value


@pytest.mark.parametrize("depth", [3, 20])
def test_nodes_of_any_depth(spark, depth):
    values = [nested(depth), [{"x": 1}, [{"@type": ""}, {"@type": "D", "@graph": []}]], "text", 3, None, {"@type": {"odd": 1}}]
    html = "".join(script(v) for v in values) + '<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@type":"E","a":1,"a":2}</script>'
    pages = spark.createDataFrame([("p", html), ("q", "<p>none</p>"), ("r", None)], "k string, html string")
    got = sorted(markup.jsonld_nodes(pages, "k").collect(), key=lambda r: r.pos)
    want = [x for v in values[:-1] for x in walked(v)] + [["E"]]
    assert [r.types for r in got] == want and [r.pos for r in got] == list(range(len(want))) and {r.page_key for r in got} == {"p"}
    assert json.loads(got[-1].node) == {"@type": "E", "a": 2}


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([("p", script(NEWS))], "k string, html string")
    start = F.array(F.struct(F.array(F.lit(0)).alias("path"), F.try_parse_json("html").alias("v")))
    plan = markup._nodes(pages.withColumnRenamed("k", "page_key"), start)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
