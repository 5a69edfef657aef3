"""Readers of JSON, XML and markup, over documents Spark writes out of the given tables.

The given tables hold no register answers, feeds or structured markup, so each
customer, order, part or supplier is first written as such a document; the operator
then has to read the facts back, which the SQL takes from the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from attesta import lexicon as lx
from attesta.functions import markup, publication, urls
from attesta.functions.publication import MARKERS
from attesta.operators import extract, gates, pages as site_pages
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import PROFILES_SQL
from attesta.session import spread, stored
from attesta.sources import feeds, official

AS_OF = "1999-06-30"


def _none() -> Column:
    return F.lit(None).cast("string")


def _key(name: str) -> Column:
    return views.padded(F.col(name))


# ---- official answers ----


@bind(
    "normalize_entity",
    "A10",
    f"""WITH {PROFILES_SQL}, c AS (
  SELECT org, 'legal_name' AS field, name AS value, 'available' AS availability FROM profiles UNION ALL SELECT org, 'organisation_number', org, 'available' FROM profiles
  UNION ALL SELECT org, 'organisation_form', legal_form, 'available' FROM profiles UNION ALL SELECT org, 'website_registry', website, 'available' FROM profiles WHERE website IS NOT NULL
  UNION ALL SELECT org, 'industry_code', industry_code, 'available' FROM profiles UNION ALL SELECT org, 'employees', employees::VARCHAR, CASE WHEN employees IS NULL THEN 'not_available' ELSE 'available' END FROM profiles
  UNION ALL SELECT org, 'operating_status', CASE WHEN bankrupt OR liquidating THEN 'false' ELSE 'true' END, 'available' FROM profiles UNION ALL SELECT org, 'register_memberships', NULL, 'available' FROM profiles) SELECT * FROM c""",
)
def normalize_entity(spark, sf):
    profile = views.profiles(spark, sf)
    body = F.to_json(F.struct(
        F.col("org").alias("organisasjonsnummer"), F.col("name").alias("navn"), F.struct(F.col("legal_form").alias("kode")).alias("organisasjonsform"),
        F.col("employees").alias("antallAnsatte"), F.col("employees").isNotNull().alias("harRegistrertAntallAnsatte"), F.col("bankrupt").alias("konkurs"),
        F.col("liquidating").alias("underAvvikling"), F.col("website").alias("hjemmeside"),
        F.struct(F.col("industry_code").alias("kode"), F.col("industry_label").alias("beskrivelse")).alias("naeringskode1"),
    ))
    claims = official.normalize_entity(profile.select("org", body.alias("body")))
    plain = F.when(F.col("value").startswith("{"), F.coalesce(F.get_json_object("value", "$.code"), F.get_json_object("value", "$.active"))).otherwise(F.col("value"))
    return claims.select("org", "field", plain.alias("value"), "availability")


@bind(
    "normalize_roles",
    "A11",
    """SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS org, CASE WHEN c THEN 'available' ELSE 'not_available' END AS availability, CASE WHEN c THEN 'Kunde ' || o_custkey END AS name,
  CASE WHEN c THEN CASE o_orderstatus WHEN 'O' THEN 'board_chair' ELSE 'board_member' END END AS position FROM (SELECT *, o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority <> '5-LOW') AS c FROM orders)""",
)
def normalize_roles(spark, sf):
    status = F.col("o_orderstatus")
    code = F.when(status == "O", "LEDE").when(status == "F", "REVI").otherwise("MEDL")
    name = F.struct(F.lit("Kunde").alias("fornavn"), F.col("o_custkey").cast("string").alias("etternavn"))
    role = F.struct(F.struct(code.alias("kode")).alias("type"), F.struct(name.alias("navn"), F.lit("1960-01-01").alias("fodselsdato")).alias("person"), ((status == "P") & (F.col("o_orderpriority") == "5-LOW")).alias("avregistrert"))
    body = F.to_json(F.struct(F.array(F.struct(F.array(role, role).alias("roller"))).alias("rollegrupper")))
    return official.normalize_roles(table(spark, sf, "orders").select(_key("o_orderkey").alias("org"), body.alias("body"))).select("org", "availability", "name", "position")


@bind(
    "normalize_locations",
    "A12",
    """WITH o AS (SELECT *, lpad(o_orderkey::VARCHAR, 9, '0') AS org FROM orders)
SELECT org, 'location' AS field, 'available' AS availability, lpad(o_custkey::VARCHAR, 9, '0') AS subject, NULL AS counted FROM o WHERE o_orderstatus <> 'P' UNION ALL SELECT org, 'location_count', 'available', NULL, '7' FROM o WHERE o_orderstatus = 'F'
UNION ALL SELECT org, 'location', 'not_available', NULL, NULL FROM o WHERE o_orderstatus = 'P'""",
)
def normalize_locations(spark, sf):
    status = F.col("o_orderstatus")
    unit = F.struct(_key("o_custkey").alias("organisasjonsnummer"), F.lit("Avdeling").alias("navn"))
    full = F.to_json(F.struct(F.struct(F.array(unit).alias("underenheter")).alias("_embedded"), F.struct(F.when(status == "F", 7).otherwise(1).alias("totalElements")).alias("page")))
    answers = table(spark, sf, "orders").select(_key("o_orderkey").alias("org"), F.when(status == "P", "{}").otherwise(full).alias("body"))
    claims = official.normalize_locations(answers)
    return claims.select("org", "field", "availability", "subject", F.when(F.col("field") == "location_count", F.col("value")).alias("counted"))


@bind(
    "replay_responses",
    "A21",
    f"""WITH {PROFILES_SQL} SELECT org, 'registry_live' AS module, CASE WHEN revenue > 0 THEN 'available' ELSE 'not_found' END AS status, CASE WHEN revenue > 0 THEN sha256('{{"navn":"' || name || '"}}') END AS content_sha256 FROM profiles
UNION ALL SELECT org, 'roles', 'source_error', NULL FROM profiles""",
)
def replay_responses(spark, sf):
    profiles = views.profiles(spark, sf)
    good = F.col("revenue") > 0
    recorded = profiles.select(
        F.concat(F.lit("https://data.brreg.no/enhetsregisteret/api/enheter/"), "org").alias("url"), F.when(good, 200).otherwise(404).alias("status"),
        F.when(good, F.to_json(F.struct(F.col("name").alias("navn")))).alias("body"), F.lit("t").alias("retrieved_at"), F.lit("t").alias("effective_at"),
    )
    return official.replay_responses(profiles.select("org"), recorded, ["registry_live", "roles"]).select("org", "module", "status", "content_sha256")


# ---- feeds ----


@bind(
    "explode_feed",
    "A8",
    """SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS org, CASE WHEN o_orderstatus = 'P' THEN 'parse_failure' ELSE 'item' END AS outcome, CASE WHEN o_orderstatus <> 'P' THEN 'Ordre ' || o_orderkey END AS title,
  CASE WHEN o_orderstatus <> 'P' THEN 'https://a.no/nyheter/' || o_orderkey END AS link, CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'F' THEN '' END AS published,
  CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN '' END AS modified FROM orders""",
)
def explode_feed(spark, sf):
    key, day, status = F.col("o_orderkey").cast("string"), F.col("o_orderdate"), F.col("o_orderstatus")
    months = F.array(*[F.lit(m) for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")])
    mailed = F.concat(F.date_format(day, "dd"), F.lit(" "), F.element_at(months, F.month(day)), F.lit(" "), F.date_format(day, "yyyy"), F.lit(" 08:00:00 GMT"))
    head = F.concat(F.lit("<title>Ordre "), key, F.lit("</title>"))
    rss = F.concat(F.lit("<rss><channel><item>"), head, F.lit("<link>https://a.no/nyheter/"), key, F.lit("</link><pubDate>Mon, "), mailed, F.lit("</pubDate></item></channel></rss>"))
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry>'), head, F.lit('<link rel="self" href="https://a.no/x"/><link rel="alternate" href="https://a.no/nyheter/'), key,
        F.lit('"/><updated>'), F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z</updated></entry></feed>"),
    )
    xml = F.when(status == "O", rss).when(status == "F", atom).otherwise(F.concat(F.lit("<rss><channel><item>"), head))
    docs = table(spark, sf, "orders").select(_key("o_orderkey").alias("org"), F.lit("https://a.no/feed").alias("url"), xml.alias("xml"))
    return feeds.explode_feed(docs).select("org", "outcome", "title", "link", "published", "modified")


@bind(
    "explode_sitemaps",
    "A9",
    """WITH l AS (SELECT o_custkey AS k, max(o_orderkey) AS o, max(o_orderdate) AS d FROM orders GROUP BY 1)
SELECT lpad(k::VARCHAR, 9, '0') AS org, 'https://www.c' || k || '.no/nyheter/' || o AS url, strftime(d, '%Y-%m-%d') AS modified, 1 AS level, TRUE AS is_article FROM l
UNION ALL SELECT lpad(k::VARCHAR, 9, '0'), 'https://c' || k || '.no/om-oss', '', 1, FALSE FROM l""",
)
def explode_sitemaps(spark, sf):
    key = F.col("o_custkey").cast("string")
    last = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("o"), F.max("o_orderdate").alias("d"))
    root, nested = F.concat(F.lit("https://c"), key, F.lit(".no/sitemap.xml")), F.concat(F.lit("https://c"), key, F.lit(".no/news.xml"))
    index = F.concat(F.lit("<sitemapindex><sitemap><loc>"), nested, F.lit("</loc></sitemap><sitemap><loc>https://andre.no/x.xml</loc></sitemap></sitemapindex>"))
    pages = F.concat(
        F.lit("<urlset><url><loc>https://www.c"), key, F.lit(".no/nyheter/"), F.col("o").cast("string"), F.lit("</loc><lastmod>"), F.date_format("d", "yyyy-MM-dd"),
        F.lit("</lastmod></url><url><loc>https://c"), key, F.lit(".no/om-oss</loc></url><url><loc>https://andre.no/nyheter/x</loc></url></urlset>"),
    )
    docs = last.select(root.alias("url"), index.alias("xml")).unionAll(last.select(nested, pages))
    return feeds.explode_sitemaps(docs, last.select(_key("o_custkey").alias("org"), root.alias("url"))).drop("sitemap")


# ---- structured markup ----


def _script(node: Column) -> Column:
    return F.concat(F.lit('<html><script type="application/ld+json">'), F.to_json(node), F.lit("</script></html>"))


def _job_pages(spark, sf):
    """Orders as role pages of a company; only an open order names the company as employer."""
    key, day = F.col("o_orderkey").cast("string"), F.col("o_orderdate").cast("date")
    employer = F.struct(F.lit("Organization").alias("@type"), F.when(F.col("o_orderstatus") == "O", "Blåbær Teknikk").otherwise("Annet Firma").alias("name"))
    node = F.struct(
        F.lit("JobPosting").alias("@type"), F.concat(F.lit("Stilling "), key).alias("title"), F.date_format(day, "yyyy-MM-dd").alias("datePosted"),
        F.date_format(F.date_add(day, 60), "yyyy-MM-dd").alias("validThrough"), employer.alias("hiringOrganization"),
    )
    url = F.concat(F.lit("https://blabaer.no/jobb/"), key)
    return table(spark, sf, "orders").select(F.lit("974760673").alias("org"), url.alias("url"), _script(node).alias("html")).withColumn("content_sha256", F.sha2("html", 256))


@bind(
    "jsonld_nodes",
    "G10",
    "SELECT 'https://blabaer.no/jobb/' || o_orderkey AS page_key, unnest([0, 1]) AS pos, unnest(['JobPosting', 'Organization']) AS kind FROM orders",
)
def jsonld_nodes(spark, sf):
    return markup.jsonld_nodes(_job_pages(spark, sf), "url").select("page_key", "pos", F.col("types")[0].alias("kind"))


@bind(
    "site_jobs",
    "H4 B11",
    f"SELECT 'https://blabaer.no/jobb/' || o_orderkey AS source_url, 'Stilling ' || o_orderkey AS evidence_span FROM orders WHERE o_orderstatus = 'O' AND o_orderdate::DATE <= DATE '{AS_OF}' AND DATE '{AS_OF}' <= o_orderdate::DATE + 60",
)
def site_jobs(spark, sf):
    pages = _job_pages(spark, sf)
    profiles = pages.select("org").distinct().withColumn("name", F.lit("Blåbær Teknikk AS"))
    verdicts = profiles.select("org", F.lit(True).alias("publishable"), F.lit(True).alias("content_attributable"), F.lit("https://blabaer.no/").alias("site_url"))
    return extract.site_jobs(pages, profiles, verdicts, f"{AS_OF} 00:00:00").select("source_url", "evidence_span")


@bind(
    "document_observations",
    "H3",
    f"""WITH o AS (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, 'https://' || CASE WHEN o_orderkey % 2 = 0 THEN 'katalog.no/' ELSE 'egen.no/' END || o_orderkey AS source_url, o_orderkey % 2 = 1 AS own, o_orderstatus AS s, left(o_orderpriority, 1)::INTEGER AS p, o_orderkey AS k, o_orderdate::DATE AS d, o_totalprice AS t FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 3 = 0)
SELECT org, source_url, 'review' AS signal_type, 'Omtale ' || k AS evidence_span, CASE WHEN p >= 4 THEN 'positive' WHEN p <= 2 THEN 'negative' ELSE 'neutral' END AS sentiment_label FROM o WHERE NOT own
UNION ALL SELECT org, source_url, 'review_summary', 'Kunde: ' || p || '.0/5.0 from ' || (k % 9) || ' ratings', NULL FROM o WHERE NOT own AND k % 9 > 0
UNION ALL SELECT org, source_url, 'workforce_snapshot', 'Kunde: numberOfEmployees=' || (k % 900), NULL FROM o WHERE own
UNION ALL SELECT org, source_url, 'profile_metrics', 'Film ' || k, NULL FROM o JOIN profiles USING (org) WHERE own
UNION ALL SELECT org, source_url, 'job_posting', 'Stilling ' || k, NULL FROM o WHERE d <= DATE '{AS_OF}' AND DATE '{AS_OF}' <= d + 60
UNION ALL SELECT org, source_url, 'public_mention', 'Ordre ' || k || CASE WHEN s = 'P' THEN ' Uten nummer' ELSE ' Org.nr. ' || org[1:3] || ' ' || org[4:6] || ' ' || org[7:9] END, NULL FROM o WHERE NOT own AND s <> 'F' AND d <= DATE '{AS_OF}'""".replace("WITH o AS", f"WITH {PROFILES_SQL}, o AS"),
)
def document_observations(spark, sf):
    """Orders as pages of a catalogue or the entity's own site, each with a review, ratings, staff, a film and a role in its markup.

    Closed ones name the entity in their text, a third of the pending ones in their markup only, the others nowhere.
    """
    key, org, number = F.col("o_orderkey").cast("string"), F.col("org"), F.col("o_orderkey")
    stars, status, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"), F.col("o_orderdate").cast("date")
    kind = lambda name: F.lit(name).alias("@type")
    who = F.when((status != "P") | (number % 3 == 0), org).alias("taxID")
    site = F.concat(F.lit("https://"), F.when(number % 2 == 0, "katalog.no/").otherwise("egen.no/"), key)
    review = F.struct(
        kind("Review"), F.struct(kind("LocalBusiness"), org.alias("taxID")).alias("itemReviewed"), F.concat(F.lit("Omtale "), key).alias("reviewBody"),
        F.struct(stars.alias("ratingValue"), F.lit("5").alias("bestRating")).alias("reviewRating"),
    )
    owner = F.struct(
        kind("Organization"), F.lit("Kunde").alias("name"), who, F.struct((number % 900).alias("value")).alias("numberOfEmployees"),
        F.struct(stars.alias("ratingValue"), (number % 9).alias("ratingCount")).alias("aggregateRating"),
    )
    film = F.struct(
        kind("VideoObject"), F.concat(F.lit("Film "), key).alias("name"), F.struct(F.col("name").alias("name")).alias("author"),
        F.array(F.struct(F.lit("https://schema.org/WatchAction").alias("interactionType"), number.alias("userInteractionCount"))).alias("interactionStatistic"),
    )
    role = F.struct(
        kind("JobPosting"), F.concat(F.lit("Stilling "), key).alias("title"), F.date_format(day, "yyyy-MM-dd").alias("datePosted"), F.date_format(F.date_add(day, 60), "yyyy-MM-dd").alias("validThrough"),
        F.struct(kind("Organization"), who).alias("hiringOrganization"),
    )
    html = F.concat(_script(F.struct(review.alias("a"), F.array(owner).alias("b"))), _script(film), _script(role))
    plain = F.when(status == "P", F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(F.struct(kind("Thing")).alias("x"))), F.lit("</script>")))
    spaced = F.concat_ws(" ", F.substring(org, 1, 3), F.substring(org, 4, 3), F.substring(org, 7, 3))
    # Dealt by entity while the rows are small: the pages made of them are never shuffled.
    orders = spread(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate", _key("o_custkey").alias("org")), "org")
    docs = orders.join(views.profiles(spark, sf).select(F.col("org").alias("_org"), "name").hint("merge"), org == F.col("_org")).select(
        "org", F.when(status == "F", "reviews").otherwise("news").alias("category"), site.alias("url"), F.when((status != "P") | (number % 3 == 0), html).otherwise(plain).alias("html"),
        F.when(status == "P", "Uten nummer").otherwise(F.concat(F.lit("Org.nr. "), spaced)).alias("text"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"),
        F.concat(F.lit("Ordre "), key).alias("title"),
    ).withColumn("content_sha256", F.sha2("html", 256))
    profiles = views.profiles(spark, sf).select("org", "name", "municipality", F.lit("egen.no").alias("own_domain"), _none().alias("street"), F.lit(None).cast("array<string>").alias("people"), _none().alias("founded"))
    found = extract.document_observations(docs, profiles, f"{AS_OF} 00:00:00", dealt=True)
    return found.select("org", "source_url", "signal_type", "evidence_span", "sentiment_label")


@bind(
    "place_observations",
    "H7",
    """WITH s AS (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, s_acctbal > 0 AS pos, s_acctbal > 5000 AS site, s_nationkey % 5 + 1 AS st FROM supplier)
SELECT org, 'place_summary' AS signal_type, NULL AS sentiment_label FROM s UNION ALL SELECT org, 'company_profile', NULL FROM s WHERE site
UNION ALL SELECT org, unnest(['review_summary', 'profile_metrics', 'buzz_metrics']), NULL FROM s WHERE pos UNION ALL SELECT org, 'review', CASE WHEN st <= 2 THEN 'negative' WHEN st >= 4 THEN 'positive' ELSE 'neutral' END FROM s""",
)
def place_observations(spark, sf):
    stars = (F.col("s_nationkey") % 5 + 1).cast("double")
    review = F.struct(F.col("s_suppkey").cast("string").alias("review_id"), stars.alias("rating"), F.lit("").alias("text"), _none().alias("published_at"))
    places = table(spark, sf, "supplier").select(
        _key("s_suppkey").alias("org"), F.col("s_suppkey").cast("string").alias("place_id"), F.col("s_name").alias("title"), F.lit("Gata 1").alias("address"), F.lit("22334455").alias("phone"),
        F.when(F.col("s_acctbal") > 5000, "site.no").alias("web_site"), F.concat(F.lit("https://maps/"), F.col("s_suppkey").cast("string")).alias("link"), stars.alias("review_rating"),
        F.when(F.col("s_acctbal") > 0, 10).otherwise(0).alias("review_count"), F.array(review).alias("user_reviews"),
    )
    resolved = places.select("org", F.lit("exact_match").alias("status"), "place_id")
    return extract.place_observations(resolved, places).select("org", "signal_type", "sentiment_label")


@bind(
    "profile_page_metrics",
    "H8",
    f"""WITH {PROFILES_SQL}, p AS (SELECT org, org::BIGINT AS k, employees FROM profiles),
m AS (SELECT org, 'https://linkedin.com/company/firma-' || org AS page_url, 1000 + coalesce(employees, 0) AS followers, employees::BIGINT AS visible_employees,
  CASE WHEN employees < 50 THEN '11-50' WHEN employees >= 50 THEN '51-200' END AS employee_size_label, k % 3 AS posts, CASE WHEN k % 3 > 0 THEN k % 100 ELSE 0 END AS likes,
  CASE WHEN k % 3 > 0 THEN k % 7 ELSE 0 END AS comments, k % 3 <> 0 OR k % 2 = 0 AS known FROM p)
SELECT org, page_url, followers, visible_employees, employee_size_label, posts, likes, comments, CASE WHEN known THEN 1 + (employee_size_label IS NOT NULL)::BIGINT + posts ELSE 0 END AS observations FROM m""",
)
def profile_page_metrics(spark, sf):
    """Customers as saved company pages, each saved twice under two handles, with up to two own posts, a stranger's and one without text.

    The first post has two cards, of which the last counts, the second none. A third of the pages names another company; of these
    every second states the entity's own site.
    """
    key = F.col("org").cast("long")
    followers = F.format_number(F.lit(1000) + F.coalesce("employees", F.lit(0)), 0)
    own = F.concat(F.lit("https://no.linkedin.com/company/Firma-"), "org")
    node = F.struct(
        F.lit("Organization").alias("@type"), F.when(key % 3 > 0, F.col("name")).otherwise("Annet Navn").alias("name"), own.alias("url"),
        F.struct(F.col("employees").alias("value")).alias("numberOfEmployees"),
    )
    number = lambda i: (key * 10 + i).cast("string")

    def post(i: int, text: str, author: Column) -> Column:
        who = F.struct(F.lit("Organization").alias("@type"), F.lit("En forfatter").alias("name"), author.alias("url"))
        return F.struct(
            F.lit("DiscussionForumPosting").alias("@type"), F.concat(F.lit("https://linkedin.com/posts/x-activity-"), number(i), F.lit("-a")).alias("url"), F.lit(text).alias("text"),
            F.lit("2026-01-01").alias("datePublished"), who.alias("author"),
        )

    posts = F.concat(
        F.when(key % 3 > 0, F.array(post(1, "Hei", own))).otherwise(F.array()), F.when(key % 3 > 1, F.array(post(2, "Igjen", own))).otherwise(F.array()),
        F.array(post(3, "Fremmed", F.lit("https://linkedin.com/company/andre")), post(4, "", own)),
    )

    def card(i: int, likes: Column, comments: Column) -> Column:
        return F.concat(
            F.lit('<article class="main-feed-activity-card" data-activity-urn="urn:li:activity:'), number(i), F.lit('"><a data-test-id="social-actions__reactions" data-num-reactions="'), likes.cast("string"),
            F.lit('"></a><a data-test-id="social-actions__comments" data-num-comments="'), comments.cast("string"), F.lit('"></a></article>'),
        )

    fact = lambda name, value: F.concat(F.lit(f'<div data-test-id="about-us__{name}"><dt>x</dt><dd>'), value, F.lit("</dd></div>"))
    label = F.when(F.col("employees") < 50, "11-50").when(F.col("employees") >= 50, "51-200")
    site = F.concat(F.lit("firma-"), "org", F.lit(".example.com"))
    stated = lambda text: F.coalesce(text, F.lit(""))
    about = F.concat(stated(fact("size", label)), stated(fact("website", F.concat(F.lit("https://www."), site))))
    html = F.concat(
        F.lit('<meta name="description" content="Firma | '), followers, F.lit(' followers on the site">'), _script(node), _script(F.struct(posts.alias("@graph"))), about,
        *[stated(c) for c in (card(1, F.lit(999), F.lit(999)), card(1, key % 100, key % 7), card(3, F.lit(5), F.lit(5)))],
    )
    known = views.profiles(spark, sf)
    saved = known.select("org", html.alias("html")).select("org", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("handle"), "html")
    address = F.concat(F.lit("https://linkedin.com/company/"), "handle", "org")
    pages = saved.select("org", address.alias("requested_url"), address.alias("url"), "html").withColumn("content_sha256", F.sha2("html", 256))
    nodes = extract.profile_page_nodes(pages)
    metrics = stored(extract.profile_page_metrics(pages, nodes), "profile-metrics")
    written = extract.profile_page_posts(pages, metrics, nodes)
    judged = extract.profile_page_identity(metrics, known.select("org", "name", F.when(key % 2 == 0, site).alias("domain")).distinct())
    seen = extract.profile_page_observations(judged, written).groupBy("org").agg(F.count(F.lit(1)).alias("observations"))
    engagement = written.groupBy("org", "page_url").agg(F.count(F.lit(1)).alias("posts"), F.sum("likes").alias("likes"), F.sum("comments").alias("comments"))
    found = metrics.join(engagement, ["org", "page_url"], "left").join(seen, "org", "left").fillna(0, ["posts", "likes", "comments", "observations"])
    return found.select("org", "page_url", "followers", "visible_employees", "employee_size_label", "posts", "likes", "comments", "observations")


@bind(
    "employer_search_claims",
    "H10",
    """WITH s AS (SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS org, o_orderkey, o_orderstatus <> 'P' AS hit FROM orders)
SELECT org, 'active_job_count' AS field, CASE WHEN hit THEN '1' ELSE '0' END AS value FROM s UNION ALL SELECT org, 'job_posting', 'ab-' || o_orderkey FROM s WHERE hit UNION ALL SELECT org, 'hiring_or_activity_signal', '1' FROM s WHERE hit""",
)
def employer_search_claims(spark, sf):
    """Orders as job searches: the ad names the company, its branch, or somebody else."""
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    employer = F.when(status == "O", "ALFA BYGG").when(status == "F", "Alfa Bygg AS avd Oslo").otherwise("Alfa Byggeri AS")
    html = F.concat(F.lit('<article><a href="/stillinger/stilling/ab-'), key, F.lit('">Selger</a><p>Arbeidsgiver</p><p>'), employer, F.lit("</p><p>Sted</p><p>Oslo</p><p>3. mars 2026</p></article>"))
    results = table(spark, sf, "orders").select(_key("o_orderkey").alias("org"), html.alias("html"))
    profiles = results.select("org", F.lit("Alfa Bygg AS").alias("name"))
    claims = extract.employer_search_claims(results, profiles)
    value = F.coalesce(F.get_json_object("value", "$.uuid"), F.get_json_object("value", "$.active_job_ads"), F.col("value"))
    return claims.select("org", "field", value.alias("value"))


@bind(
    "ats_listings",
    "C15",
    "SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, 'https://boards.greenhouse.io/c' || o_custkey || '/jobs/' || o_orderkey AS source_url FROM orders WHERE o_orderstatus = 'O'",
)
def ats_listings(spark, sf):
    """Customers with a board linked from their site; an order is a posting, open ones state the number."""
    board = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    org = _key("o_custkey")
    orders = table(spark, sf, "orders")
    links = orders.select(org.alias("org"), F.concat(F.lit("https://boards.greenhouse.io/"), board).alias("link"), F.lit("https://egen.no/").alias("evidence_url"), F.sha2(F.lit("x"), 256).alias("evidence_sha256"))
    text = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("<p>Org.nr. "), org, F.lit("</p>"))).otherwise("<p>Uten</p>")
    postings = orders.select(
        F.lit("greenhouse").alias("provider"), board.alias("token"), F.col("o_orderkey").cast("string").alias("job_id"), F.concat(F.lit("Stilling "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("https://boards.greenhouse.io/"), board, F.lit("/jobs/"), F.col("o_orderkey").cast("string")).alias("url"), text.alias("content"), F.lit("1").alias("internal_job_id"),
        _none().alias("published_at"), F.sha2(text, 256).alias("content_sha256"),
    )
    profiles = views.profiles(spark, sf).select("org", "name", "municipality", _none().alias("own_domain"), _none().alias("street"), F.lit(None).cast("array<string>").alias("people"))
    return extract.ats_listings(extract.evidenced_boards(links), postings, profiles, "2000-01-01T00:00:00Z").select("org", "source_url")


# ---- leads, links and handles ----


@bind("promote_leads", "C20", "SELECT lpad(p_partkey::VARCHAR, 9, '0') AS org FROM part WHERE p_size < 20 AND p_type <> 'PROMO' AND p_type <> 'SMALL'")
def promote_leads(spark, sf):
    """Parts as entities whose lead names them, names another, lies deep in a site, or is not needed."""
    part = table(spark, sf, "part")
    empty = F.lit(None).cast("array<string>")
    org = _key("p_partkey").alias("org")
    profiles = part.select(
        org, F.concat("p_name", F.lit(" AS")).alias("name"), _none().alias("municipality"), empty.alias("websites"), _none().alias("email"), _none().alias("street"), _none().alias("postcode"),
        _none().alias("city"), _none().alias("phone"), empty.alias("people"), empty.alias("known_orgs"),
    )
    address = F.concat(F.lit("https://p"), F.col("p_partkey").cast("string"), F.lit(".com/"), F.when(F.col("p_type") == "PROMO", "kunder/x").otherwise(""))
    title = F.when(F.col("p_size") < 20, F.concat(F.lit("Velkommen til "), "p_name", F.lit(" AS"))).otherwise("Velkommen")
    nodes = F.array().cast("array<struct<name:string,legal_name:string,alternate_name:string,url:string,tax_id:string,vat_id:string,identifier:string>>")
    blank = F.lit("")
    sites = part.select(
        org, address.alias("site_url"), address.alias("requested_url"), title.alias("title"), blank.alias("description"), blank.alias("heading"), blank.alias("identity_text"),
        blank.alias("ownership_text"), blank.alias("main_text"), F.lit(False).alias("owner_captured"), F.lit(False).alias("homepage_required"), F.lit(False).alias("article_document"), nodes.alias("organisations"),
    )
    return gates.promote_leads(profiles, sites, part.filter("p_type = 'SMALL'").select(org)).select("org")


@bind(
    "handle_observations",
    "H12 C8",
    "SELECT lpad(p_partkey::VARCHAR, 9, '0') AS org, 'linkedin' AS platform FROM part WHERE p_size < 30 AND p_type <> 'PROMO' UNION ALL SELECT lpad(p_partkey::VARCHAR, 9, '0'), 'facebook' FROM part WHERE p_type <> 'PROMO'",
)
def handle_observations(spark, sf):
    part = table(spark, sf, "part")
    org = _key("p_partkey").alias("org")
    slug, label = F.replace("p_name", F.lit(" "), F.lit("-")), F.concat(F.lit("merke"), F.col("p_partkey").cast("string"))
    page = F.concat(F.lit("https://"), label, F.lit(".no/"))
    link = lambda platform, url: F.struct(F.lit(platform).alias("platform"), url.alias("url"))
    shown = F.array(
        link("linkedin", F.concat(F.lit("https://linkedin.com/company/"), F.when(F.col("p_size") < 30, slug).otherwise("annet-navn"))),
        link("facebook", F.concat(F.lit("https://facebook.com/"), label, F.lit("norge"))),
    )
    links = part.select(org, F.explode(shown).alias("k"), page.alias("evidence_url")).select(
        "org", "k.platform", "k.url", F.lit("verified_site_link").alias("discovery_source"), "evidence_url", F.sha2("evidence_url", 256).alias("evidence_sha256"), F.lit(False).alias("declared")
    )
    verdicts = part.select(org, F.lit(True).alias("publishable"), (F.col("p_type") != "PROMO").alias("content_attributable"), page.alias("site_url"))
    judged = gates.social_gate(part.select(org, F.concat("p_name", F.lit(" AS")).alias("name")), links, verdicts)
    return gates.handle_observations(judged).select("org", "platform")


@bind(
    "social_urls",
    "G7",
    """SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN 'https://linkedin.com/company/' || s WHEN p_type = 'MEDIUM' THEN 'https://facebook.com/' || s WHEN p_type = 'STANDARD' THEN 'https://x.com/' || s WHEN p_type = 'PROMO' THEN 'https://youtube.com/@' || s END AS url
FROM (SELECT *, replace(p_name, ' ', '-') AS s FROM part)""",
)
def social_urls(spark, sf):
    slug, kind = F.replace("p_name", F.lit(" "), F.lit("-")), F.col("p_type")
    raw = (
        F.when(kind == "LARGE", F.concat(F.lit("https://no.linkedin.com/company/"), slug, F.lit("/about?trk=x")))
        .when(kind == "MEDIUM", F.concat(F.lit("https://www.facebook.com/plugins/page.php?href=https%3A%2F%2Fwww.facebook.com%2F"), slug, F.lit("&tabs=timeline")))
        .when(kind == "STANDARD", F.concat(F.lit("twitter.com/"), slug)).when(kind == "PROMO", F.concat(F.lit("//youtube.com/@"), slug, F.lit("/videos")))
        .when(kind == "SMALL", F.concat(F.lit("https://instagram.com/p/"), slug)).otherwise(F.concat(F.lit("https://linkedin.com/in/"), slug))
    )
    return table(spark, sf, "part").select("p_partkey", urls.normalize_social_url(raw)["url"].alias("url"))


# ---- publication dates ----

MONTHS = lx.NORWEGIAN_MONTHS


def _articles(spark, sf):
    """Documents as article pages of their source's site, each with one of ten ways to say or not to say when it appeared."""
    way, day = F.col("doc_id") % 10, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 400).cast("int"))
    iso = F.date_format(day, "yyyy-MM-dd")
    url = F.concat(F.lit("https://"), "source", F.lit(".example.com/news/"), F.col("doc_id").cast("string"))
    spoken = F.concat(F.dayofmonth(day).cast("string"), F.lit(". "), F.get(F.array(*[F.lit(m) for m in MONTHS]), F.month(day) - 1), F.lit(" "), F.year(day).cast("string"))
    script = lambda node: F.concat(F.lit('<script type="application/ld+json">'), F.to_json(node), F.lit("</script>"))
    article = lambda kind, *more: F.struct(F.lit(kind).alias("@type"), iso.alias("datePublished"), F.lit("2025-12-31").alias("dateModified"), *more)
    heading = lambda text: F.concat(F.lit("<header class='top'><h1>Sak</h1><span>"), text, F.lit("</span></header>"))
    head = (
        F.when(way == 0, F.concat(F.lit('<meta content="'), iso, F.lit('T10:00:00+01:00" property="article:published_time"><meta property="article:modified_time" content="2025-12-31">')))
        .when(way == 1, F.concat(F.lit('<meta itemprop="datePublished" content="2024-99-32"><time class="byline published" datetime="'), iso, F.lit('">da</time>')))
        .when(way == 2, F.concat(F.lit('<meta property="article:modified_time" content="2025-12-31">'), script(article("NewsArticle", F.concat(url, F.lit("/#a")).alias("url")))))
        .when(way == 3, script(article("NewsArticle", F.concat(url, F.lit("-annen")).alias("url"))))
        .when(way == 4, F.concat(script(article("Article")), script(article("Report"))))
        .when(way == 5, script(F.struct(F.array(F.struct(F.lit("WebPage").alias("@type"), F.array(article("BlogPosting")).alias("hasPart"))).alias("@graph"))))
        .when(way == 9, F.concat(F.lit('<time class="entry-date updated" datetime="2025-12-31">x</time><time datetime='), iso, F.lit(' class="entry-date">x</time>')))
        .otherwise("")
    )
    top = F.when(way == 6, heading(spoken)).when(way == 7, heading(F.concat(F.lit("Oppdatert "), spoken))).when(way == 8, heading(F.concat(spoken, F.lit(" og "), spoken))).otherwise("")
    safe = F.replace(F.replace("text", F.lit("<"), F.lit(" ")), F.lit("&"), F.lit(" "))
    html = F.concat(F.lit("<html><head>"), head, F.lit("</head><body><article>"), top, F.lit("<p>"), safe, F.lit("</p></article><footer>1. mai 2020</footer></body></html>"))
    return table(spark, sf, "documents").select("doc_id", F.col("source").alias("org"), url.alias("url"), html.alias("html"), safe.alias("main_text"))


ARTICLES_SQL = f"""
w AS (SELECT doc_id, source AS org, 'https://' || source || '.example.com/news/' || doc_id AS url, doc_id % 10 AS way, strftime(DATE '2024-01-01' + (doc_id % 400)::INTEGER, '%Y-%m-%d') AS iso, text FROM documents),
d AS (SELECT doc_id, org, url, text, CASE WHEN way IN (0, 1, 2, 5, 6, 9) THEN iso ELSE '' END AS published, CASE way WHEN 0 THEN 'page:{MARKERS[0]}' WHEN 1 THEN 'page:{MARKERS[4]}' WHEN 9 THEN 'page:{MARKERS[5]}'
  WHEN 6 THEN 'page:article_header_visible_date' WHEN 2 THEN 'page:Article.datePublished' WHEN 5 THEN 'page:Article.datePublished' ELSE '' END AS source FROM w)
"""


@bind("page_publication_date", "G11", f"WITH {ARTICLES_SQL} SELECT doc_id::VARCHAR AS page_key, published, source FROM d")
def page_publication_date(spark, sf):
    return publication.page_publication_date(_articles(spark, sf), "doc_id")


@bind(
    "dated_site_news",
    "H5 G11 B9",
    f"""WITH {ARTICLES_SQL} SELECT 'company-site-' || substr(sha256(org || '|' || url), 1, 24) AS id, org, url AS source_url, published AS published_at FROM d WHERE published <> '' AND published <= '2024-10-01' AND published >= '2024-02-01'""",
)
def dated_site_news(spark, sf):
    """Posts of a site, dated by the structure of their pages."""
    articles = _articles(spark, sf).withColumn("page_key", F.col("doc_id").cast("string"))
    dated = publication.page_publication_date(articles, "page_key").filter("published <> ''")
    pages = articles.join(dated, "page_key").select("org", "url", F.lit("Sak").alias("title"), "main_text", "published", F.sha2("html", 256).alias("content_sha256"))
    verdicts = articles.select("org").distinct().select("org", F.lit(True).alias("publishable"), F.lit(True).alias("content_attributable"))
    return site_pages.site_news(pages, verdicts.select("org", F.lit("2024-02-01").alias("founded")), verdicts, "2024-10-01").select("id", "org", "source_url", "published_at")
