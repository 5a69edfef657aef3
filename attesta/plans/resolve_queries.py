"""Entity resolution over parts, orders, pages, benchmark passages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta import lexicon as lx
from attesta.functions import markup, urls
from attesta.operators import gates, observations as obs, resolve as op
from attesta.plans import sqltext as sql, views
from attesta.plans.catalog import bind, table
from attesta.plans.views import PROFILES_SQL

# ---- employers ----


def _name_index(spark, sf):
    """Each distinct part name is an employer; customers of each order are its subunits' parents."""
    part = table(spark, sf, "part")
    parents = part.groupBy(F.col("p_name").alias("name")).agg(views.padded(F.min("p_partkey")).alias("org"))
    units = part.filter("p_type = 'PROMO'").select(views.padded(F.col("p_size")).alias("parent_org"), F.concat("p_brand", F.lit(" AS")).alias("name"))
    return op.index_names(parents.select("org", F.concat("name", F.lit(" ASA")).alias("name")), units)


INDEX_SQL = """
idx AS (SELECT p_name AS name_key, lpad(min(p_partkey)::VARCHAR, 9, '0') AS org FROM part GROUP BY 1
  UNION SELECT DISTINCT replace(lower(p_brand), '#', ' ') AS name_key, lpad(p_size::VARCHAR, 9, '0') FROM part WHERE p_type = 'PROMO')
"""


@bind("index_names", "C2", f"WITH {INDEX_SQL} SELECT name_key, org FROM idx")
def index_names(spark, sf):
    return _name_index(spark, sf)


@bind(
    "match_employer_names",
    "C3",
    f"""WITH {INDEX_SQL}, ads AS (SELECT p_partkey AS ad, CASE WHEN p_size < 10 THEN 'brand ' || regexp_extract(p_brand, '[0-9]+') ELSE p_name END || CASE WHEN p_size % 2 = 0 THEN ', ' ELSE ' ' END || lower(p_type) AS whole,
  CASE WHEN p_size < 10 THEN 'brand ' || regexp_extract(p_brand, '[0-9]+') ELSE p_name END AS head, p_type FROM part)
SELECT DISTINCT ad, org FROM ads JOIN idx ON replace(whole, ', ', ' ') = name_key OR starts_with(replace(whole, ', ', ' '), name_key || ' ') OR (contains(whole, ', ') AND head = name_key)""",
)
def match_employer_names(spark, sf):
    brand = F.concat(F.lit("Brand "), F.regexp_extract("p_brand", "[0-9]+", 0))
    head = F.when(F.col("p_size") < 10, brand).otherwise(F.col("p_name"))
    joiner = F.when(F.col("p_size") % 2 == 0, ", ").otherwise(" ")
    feed = table(spark, sf, "part").select(F.col("p_partkey").alias("ad"), F.concat(head, joiner, "p_type").alias("business_name"))
    return op.match_employer_names(feed, _name_index(spark, sf))


AS_OF = "1999-06-30"


def _ads(spark, sf):
    """Orders as ads that name their customer's unit; the number given is right, the unit's, wrong or missing."""
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    wrong = views.padded(F.col("o_custkey") + 1)
    number = F.when(status == "O", views.padded(F.col("o_custkey"))).when(status == "F", views.padded(F.col("o_orderkey") + 500_000_000)).otherwise(
        F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(wrong)
    )
    return orders.select(
        F.col("o_orderkey").alias("ad"), F.when(F.col("o_orderpriority") == "1-URGENT", "INACTIVE").otherwise("ACTIVE").alias("status"),
        number.alias("employer_org"), F.date_add(F.col("o_orderdate").cast("date"), 30).alias("expires"), F.concat(F.lit("Selger "), "o_orderpriority").alias("title"),
        F.col("o_orderdate").cast("date").alias("published"),
    )


def _verified(spark, sf):
    orders = table(spark, sf, "orders")
    candidates = orders.select(F.col("o_orderkey").alias("ad"), views.padded(F.col("o_custkey")).alias("org"))
    subunits = orders.select(views.padded(F.col("o_orderkey") + 500_000_000).alias("subunit_org"), views.padded(F.col("o_custkey")).alias("parent_org"))
    return op.verify_employer(_ads(spark, sf), candidates, subunits, AS_OF)


VERIFY_SQL = f"""
v AS (SELECT o_orderkey AS ad, lpad(o_custkey::VARCHAR, 9, '0') AS org, CASE o_orderstatus WHEN 'O' THEN 'exact_employer_number' WHEN 'F' THEN 'brreg_subunit_parent_mapping' END AS identity_method,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'inactive' WHEN o_orderstatus = 'P' THEN 'identity_rejected' WHEN o_orderdate::DATE + 30 < DATE '{AS_OF}' THEN 'expired' ELSE 'published' END AS outcome,
  o_orderdate::DATE AS published, o_orderdate::DATE + 30 AS expires FROM orders)
"""


@bind("verify_employer", "C4", f"WITH {VERIFY_SQL} SELECT * EXCLUDE (published, expires) FROM v")
def verify_employer(spark, sf):
    return _verified(spark, sf).select("ad", "org", "identity_method", "outcome")


@bind(
    "job_activity",
    "B11 C4",
    f"WITH {VERIFY_SQL} SELECT 'nav-job-' || ad AS id, org, TRUE AS direct, published <= DATE '{AS_OF}' AND DATE '{AS_OF}' <= expires AS active FROM v WHERE outcome = 'published'",
)
def job_activity(spark, sf):
    jobs = op.job_observations(_verified(spark, sf), F.concat(F.lit("https://pam-stilling-feed.nav.no/api/v1/feedentry/"), F.col("ad").cast("string")))
    return jobs.select("id", "org", obs.direct_job().alias("direct"), obs.active_job(AS_OF).alias("active"))


# ---- leads and sites over pages ----

PAGE_SQL = f"""
pg AS (SELECT page_id, url, html, {sql.host('url')} AS host, {sql.path('url')} AS path, {sql.title('html')} AS title FROM pages),
ent AS (SELECT host AS org, arg_min(title, page_id) AS name, min(page_id) AS first_page FROM pg GROUP BY host)
"""


def _pages(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", "url", "html", urls.host(u).alias("host"), urls.url_path(u).alias("path"), markup.page_title(F.col("html")).alias("title"))


def _entities(spark, sf):
    """One entity per host, named by the title of its first page."""
    return _pages(spark, sf).groupBy(F.col("host").alias("org")).agg(F.min_by("title", "page_id").alias("name"), F.min("page_id").alias("first_page"))


@bind(
    "website_candidates",
    "C5",
    f"""WITH {PAGE_SQL}, src AS (SELECT host AS org, 0 AS turn, page_id AS pos, 'previously_verified_site_lead' AS source, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || path AS url, path FROM pg WHERE url LIKE 'https:%'
  UNION ALL SELECT host, 1, page_id, 'universe_website_cache', regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || path, path FROM pg WHERE url NOT LIKE '%example.org%'
  UNION ALL SELECT host, 2, 0, 'brreg_entity_cache', 'https://' || host || '/', '' FROM pg GROUP BY host),
k AS (SELECT *, org || regexp_replace(path, '/+$', '') AS lead FROM src)
SELECT org, lead, url, source FROM (SELECT *, row_number() OVER (PARTITION BY org, lead ORDER BY turn, pos, url) AS rn FROM k) WHERE rn = 1""",
)
def website_candidates(spark, sf):
    pages = _pages(spark, sf).withColumn("org", F.col("host"))
    known = pages.filter(F.col("url").startswith("https:")).select("org", "url", F.col("page_id").alias("pos"))
    seeded = pages.filter(~F.contains("url", F.lit("example.org"))).select("org", "url", F.col("page_id").alias("pos"))
    register = pages.select("org", F.concat(F.lit("https://"), "host", F.lit("/")).alias("url")).distinct()
    rows = op.website_candidates([("previously_verified_site_lead", known), ("universe_website_cache", seeded), ("brreg_entity_cache", register)])
    return rows.select("org", "lead", "url", "source")


def _site_rows(spark, sf):
    pages = _pages(spark, sf).withColumn("org", F.col("host"))
    candidates = pages.select("org", "url", "page_id", F.when(F.contains("path", F.lit("/en/")), "registry").otherwise("search").alias("source"), F.struct("page_id").alias("priority"))
    size = F.length("html")
    status = F.when(size < 2000, "not_found").when(size < 3000, "blocked").when(size < 4000, "source_error").otherwise("available")
    verdicts = pages.select("org", "url", "page_id", status.alias("status"), ((status == "available") & F.col("url").startswith("https:") & (size > 9000)).alias("publishable"), (size / 100000).alias("score"))
    return candidates, verdicts


SITE_SQL = f"""
{PAGE_SQL}, s AS (SELECT host AS org, url, page_id, CASE WHEN contains(path, '/en/') THEN 'registry' ELSE 'search' END AS source, length(html) AS size, CASE WHEN length(html) < 2000 THEN 'not_found' WHEN length(html) < 3000 THEN 'blocked'
   WHEN length(html) < 4000 THEN 'source_error' ELSE 'available' END AS status FROM pg),
t AS (SELECT *, coalesce(status = 'available' AND url LIKE 'https:%' AND size > 9000, FALSE) AS publishable FROM s),
w AS (SELECT *, min(page_id) FILTER (publishable) OVER (PARTITION BY org) AS won FROM t)
"""


@bind(
    "select_verified_site",
    "C21",
    f"""WITH {SITE_SQL} SELECT org, url, source, CASE WHEN publishable THEN 'published' WHEN status = 'available' THEN 'identity_rejected' WHEN status = 'blocked' THEN 'fetch_blocked'
  WHEN status = 'source_error' THEN 'provider_error' ELSE 'not_found' END AS outcome FROM w WHERE won IS NULL OR page_id <= won""",
)
def select_verified_site(spark, sf):
    return op.select_verified_site(*_site_rows(spark, sf), capture=("page_id",)).select("org", "url", "source", "outcome")


@bind(
    "site_outcome",
    "C21",
    f"""WITH {SITE_SQL} SELECT org, CASE WHEN bool_or(publishable) THEN 'published' ELSE 'not_found' END AS state, max(url) FILTER (publishable) AS url, count(*) AS attempts FROM w WHERE won IS NULL OR page_id <= won GROUP BY org""",
)
def site_outcome(spark, sf):
    return op.site_outcome(op.select_verified_site(*_site_rows(spark, sf), capture=("page_id",)))


@bind(
    "best_scored_site",
    "C21",
    f"""WITH {SITE_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY page_id, url) AS place FROM t), k AS (SELECT * FROM c WHERE place <= 3),
z AS (SELECT *, min(place) FILTER (publishable) OVER (PARTITION BY org) AS st FROM k)
SELECT org, arg_max(url, (size, -place)) AS url, arg_max(publishable, (size, -place)) AS publishable FROM z WHERE st IS NULL OR place <= st GROUP BY org""",
)
def best_scored_site(spark, sf):
    return op.best_scored_site(*_site_rows(spark, sf), F.lit(3), capture=("page_id",)).select("org", "url", "publishable")


@bind(
    "website_origins",
    "D16",
    f"""WITH {SITE_SQL}, a AS (SELECT org FROM w GROUP BY org HAVING bool_or(publishable)), o AS (SELECT org, arg_min(source, page_id) AS origin FROM s GROUP BY org) SELECT origin, count(*) AS sites FROM a JOIN o USING (org) GROUP BY 1""",
)
def website_origins(spark, sf):
    candidates, verdicts = _site_rows(spark, sf)
    accepted = op.site_outcome(op.select_verified_site(candidates, verdicts, capture=("page_id",))).filter("state = 'published'")
    return op.website_origins(accepted, candidates)


RESULT_SQL = f"""
{PAGE_SQL}, r AS (SELECT p.host AS org, p.page_id, p.url, p.title, {sql.footer('p.html')} AS snippet, e.name, p.host AS site, split_part(p.path, '/', 2) AS town FROM pg p JOIN ent e ON e.org = p.host)
"""


def _results(spark, sf):
    return _pages(spark, sf).select(F.col("host").alias("org"), F.col("page_id").cast("int").alias("rank"), "url", "title", markup.region_text(F.col("html"), "footer").alias("snippet"))


def _searched(spark, sf):
    return _entities(spark, sf).select("org", "name", F.lit("en").alias("municipality"))


@bind(
    "relevant_search_results",
    "B15",
    f"""WITH {RESULT_SQL}, k0 AS (SELECT page_id, {sql.long_words('name')} AS c0, {sql.long_words('title')} AS tt, {sql.long_words('snippet')} AS sn, {sql.long_words('site')} AS ho FROM r),
k AS (SELECT page_id, {sql.without('c0', lx.OWNER_GENERIC)} AS c0, {sql.without('tt', lx.OWNER_GENERIC)} AS tt, {sql.without('sn', lx.OWNER_GENERIC)} AS sn, {sql.without('ho', lx.OWNER_GENERIC)} AS ho FROM k0),
c AS (SELECT *, list_distinct(c0) AS core, list_concat(tt, ho, sn) AS ev FROM k),
o AS (SELECT *, len(list_filter(core, lambda t: list_contains(ev, t))) AS ov, list_filter(core, lambda t: length(t) >= 5) AS tell FROM c)
SELECT page_id AS rank, len(core) > 0 AND (ov = len(core) OR (len(tell) > 0 AND ((len(list_filter(tell, lambda t: list_contains(list_concat(tt, ho), t))) > 0 AND (len(core) = 1 OR ov / len(core) >= 0.34))
  OR (list_contains(list_concat(tt, sn), 'en') AND ov / len(core) >= 0.34)))) AS relevant FROM o""",
)
def relevant_search_results(spark, sf):
    return op.relevant_search_results(_results(spark, sf), _searched(spark, sf)).select("rank", "relevant")


SCORE_SQL = f"""
{RESULT_SQL}, k AS (SELECT page_id, org, url, {sql.long_words('name')} AS n0, {sql.long_words('title')} AS tt, {sql.long_words('snippet')} AS sn, {sql.long_words('site')} AS ho FROM r),
c AS (SELECT *, {sql.without('n0', lx.SEARCH_GENERIC_NAMES)} AS n FROM k),
f AS (SELECT *, len(n) > 0 AND len(list_filter(n, lambda t: NOT list_contains(tt, t))) = 0 AS in_title, len(n) > 0 AND len(list_filter(n, lambda t: NOT list_contains(list_concat(tt, sn, ho), t))) = 0 AS in_any,
   len(n) > 0 AND contains(array_to_string(ho, ''), array_to_string(n, '')) AS in_host, list_contains(sn, 'en') AS town FROM c),
sc AS (SELECT *, round(CASE WHEN in_title THEN 0.45 WHEN in_any THEN 0.25 ELSE 0 END + CASE WHEN in_host THEN 0.3 ELSE 0 END + CASE WHEN town THEN 0.1 ELSE 0 END, 4)::DOUBLE AS score FROM f)
"""


@bind(
    "score_search_candidates",
    "C11",
    f"WITH {SCORE_SQL} SELECT page_id AS rank, score, CASE WHEN score >= 0.75 AND in_host AND in_title THEN 'accepted_for_crawl' WHEN score >= 0.6 THEN 'review' ELSE 'rejected' END AS status FROM sc",
)
def score_search_candidates(spark, sf):
    return op.score_search_candidates(_results(spark, sf), _searched(spark, sf)).select("rank", "score", "status")


@bind(
    "choose_search_candidate",
    "C11",
    f"""WITH {SCORE_SQL}, a AS (SELECT *, score >= 0.75 AND in_host AND in_title AS good FROM sc)
SELECT org, arg_min(url, (-score, CASE WHEN page_id = 0 THEN 10000 ELSE page_id END, url)) FILTER (good) AS selected, count(*) AS candidates, count(*) FILTER (good) AS accepted, count(*) FILTER (good) = 0 AS abstained FROM a GROUP BY org""",
)
def choose_search_candidate(spark, sf):
    return op.choose_search_candidate(op.score_search_candidates(_results(spark, sf), _searched(spark, sf)))


# ---- names in text ----


@bind(
    "news_title_match",
    "C9",
    f"""WITH {PAGE_SQL}, n AS (SELECT org, {sql.without("regexp_extract_all(lower(name), '[a-z0-9æøå]+')", op.TITLE_SUFFIXES)} AS c FROM ent),
h AS (SELECT page_id, regexp_extract_all(lower(title), '[a-z0-9æøå]+') AS raw, {sql.without("regexp_extract_all(lower(title), '[a-z0-9æøå]+')", op.TITLE_SUFFIXES)} AS w FROM pg),
x AS (SELECT page_id AS item, org FROM h JOIN n ON len(c) > 0 AND len(c) <= len(w) AND (
  w[1:len(c)] = c OR len(list_filter(range(2, len(w) + 1), lambda i: w[i:i + len(c) - 1] = c AND list_contains({sql.listed(op.ALLOWED_BEFORE)}, w[i - 1]))) > 0)
  AND (len(c) > 1 OR len(list_filter(raw, lambda t: list_contains({sql.listed(sorted(set(op.TITLE_SUFFIXES + op.CORPORATE_WORDS)))}, t))) > 0))
SELECT DISTINCT item, org FROM x""",
)
def news_title_match(spark, sf):
    items = _pages(spark, sf).select(F.col("page_id").alias("item"), "title")
    return op.news_title_match(_entities(spark, sf), items)


@bind(
    "news_proximity",
    "C10",
    f"""WITH s0 AS (SELECT item_id, unnest(string_split(text, '.')) AS s, generate_subscripts(string_split(text, '.'), 1) AS i FROM benchmark),
p0 AS (SELECT lpad((item_id * 1000 + i)::VARCHAR, 9, '0') AS org, {sql.long_words("s")} AS w FROM s0), p AS (SELECT org, {sql.name_tokens('w')} AS core FROM p0),
a0 AS (SELECT doc_id, text, {sql.long_words('text')} AS w FROM documents), a AS (SELECT doc_id, text, {sql.name_tokens('w')} AS w FROM a0),
pt AS (SELECT org, len(core) AS k, core[1] AS one, unnest(core) AS t FROM p WHERE len(core) > 0), atk AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM a),
m AS (SELECT doc_id, org, k, one, count(*) AS n, max(i) - min(i) + 1 AS span FROM atk JOIN pt USING (t) GROUP BY ALL),
s AS (SELECT doc_id, org, CASE WHEN n = k AND k >= 2 AND span <= greatest(14, k + 4) THEN 0.95 WHEN n = k AND k = 1 AND length(one) >= 5 THEN 0.80 ELSE 0.30 END AS score FROM m),
d AS (SELECT doc_id, org, 1.0 AS score FROM documents JOIN p0 ON contains(regexp_replace(text, '\\D', '', 'g'), org)),
b AS (SELECT doc_id, org, max(score) AS score FROM (SELECT * FROM s WHERE score > 0.3 UNION ALL SELECT * FROM d) GROUP BY ALL)
SELECT doc_id AS item, org, score::DOUBLE AS score, CASE WHEN score >= 0.9 THEN 'exact' ELSE 'review' END AS status FROM b""",
)
def news_proximity(spark, sf):
    """Every sentence of a benchmark text is a name to look for."""
    sentences = table(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", "[.]")).alias("i", "name"))
    named = sentences.select(views.padded(F.col("item_id") * 1000 + F.col("i") + 1).alias("org"), "name")
    articles = table(spark, sf, "documents").select(F.col("doc_id").alias("item"), F.lit("").alias("title"), "text")
    return op.news_proximity(named, articles).select("item", "org", "score", "status")


# ---- places and profiles elsewhere ----


def _places(spark, sf):
    """Suppliers as places of the customer with the same number; the nation is the address."""
    customer, nation = views.profiles(spark, sf), table(spark, sf, "nation")
    profiles = customer.select(
        "org", "name", F.lit(None).cast("string").alias("street"), F.col("municipality_number").alias("postcode"), F.lit(None).cast("string").alias("city"),
        F.concat(F.lit("22"), F.substring("org", 4, 6)).alias("phone"), F.lit(None).cast("string").alias("site"),
    )
    supplier = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    places = supplier.select(
        views.padded(key).alias("org"), F.concat(F.lit("place-"), key.cast("string")).alias("place_id"), F.col("s_name").alias("title"),
        F.concat(F.lit("Gata 1, "), F.lpad(F.col("s_nationkey").cast("string"), 4, "0"), F.lit(" "), "n_name").alias("address"),
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("+47 22"), F.substring(views.padded(key), 4, 6))).alias("phone"), F.lit(None).cast("string").alias("web_site"),
        F.floor(F.greatest(F.col("s_acctbal"), F.lit(0.0))).cast("int").alias("review_count"),
    )
    twins = places.filter(F.col("review_count") > 9000).withColumn("place_id", F.concat("place_id", F.lit("-b")))
    return op.assess_places(profiles, places.unionAll(twins), noise=["customer", "supplier"])


PLACES_SQL = f"""
{PROFILES_SQL}, a AS (SELECT p.org, s_suppkey, s_acctbal, municipality_number = lpad(s_nationkey::VARCHAR, 4, '0') AS pc, s_acctbal > 5000 AS ph FROM supplier JOIN profiles p ON p.org = lpad(s_suppkey::VARCHAR, 9, '0')),
b AS (SELECT org, 'place-' || s_suppkey AS place_id, pc, ph, round(4 + CASE WHEN ph THEN 2 ELSE 0 END + CASE WHEN pc THEN 2 ELSE 0 END + least(1.0, log10(greatest(1, floor(s_acctbal))) / 5), 4) AS score, pc OR ph AS accepted, floor(greatest(s_acctbal, 0)) > 9000 AS twin FROM a),
c AS (SELECT * FROM b UNION ALL SELECT org, place_id || '-b', pc, ph, score, accepted, twin FROM b WHERE twin)
"""


@bind("assess_places", "C12", f"WITH {PLACES_SQL} SELECT org, place_id, pc AS postcode_city_match, ph AS phone_match, score, accepted FROM c")
def assess_places(spark, sf):
    return _places(spark, sf).select("org", "place_id", "postcode_city_match", "phone_match", "score", "accepted")


@bind(
    "resolve_places",
    "C12",
    f"""WITH {PLACES_SQL} SELECT org, count(*) AS candidates, CASE WHEN NOT bool_or(accepted) THEN 'no_exact_match' WHEN bool_or(twin) THEN 'ambiguous_exact_match' ELSE 'exact_match' END AS status,
  CASE WHEN bool_or(accepted) AND NOT bool_or(twin) THEN min(place_id) END AS place_id, CASE WHEN bool_or(accepted) AND NOT bool_or(twin) THEN max(score) END AS score FROM c GROUP BY org""",
)
def resolve_places(spark, sf):
    return op.resolve_places(_places(spark, sf))


def _unclaimed(spark, sf):
    """Customers with a street, number and site, and suppliers as places that carry no entity: five ways to name the same company."""
    key, nation = F.col("c_custkey"), lambda k: F.lpad(k.cast("string"), 4, "0")
    name = lambda k, segment: F.concat(F.lower(segment), F.lit(" unit"), (k % 50).cast("string"), F.lit(" kust"), k.cast("string"))
    number = lambda k: F.concat(F.lit("22"), F.lpad((k % 300).cast("string"), 6, "0"))
    customer = table(spark, sf, "customer")
    profiles = customer.select(
        views.padded(key).alias("org"), F.concat(name(key, F.col("c_mktsegment")), F.lit(" AS")).alias("name"), F.concat(F.lit("Gata "), F.col("c_nationkey").cast("string")).alias("street"),
        F.when(key % 3 > 0, nation(F.col("c_nationkey"))).alias("postcode"), F.lit(None).cast("string").alias("city"), number(key).alias("phone"), F.concat(F.lit("kust"), key.cast("string"), F.lit(".example.com")).alias("site"),
    )
    s, own = F.col("s_suppkey"), customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    places = table(spark, sf, "supplier").join(own, s == F.col("c_custkey"))
    full = name(s, F.col("c_mktsegment"))
    title = F.when(s % 5 == 0, F.concat(full, F.lit(" filial"))).when(s % 5 == 1, F.substring_index(full, " ", 2)).when(s % 5 == 2, F.substring_index(full, " ", 1))
    title = title.when(s % 5 == 3, F.concat(F.lit("Butikk "), s.cast("string"))).otherwise(F.concat(full, F.lit("x")))
    where = F.when(F.col("s_acctbal") > 2000, F.col("c_nationkey")).otherwise(F.col("s_nationkey"))
    places = places.select(
        F.concat(F.lit("place-"), s.cast("string")).alias("place_id"), title.alias("title"), F.concat(F.lit("Gata "), where.cast("string"), F.lit(", "), nation(where), F.lit(" By")).alias("address"),
        F.when(F.col("s_acctbal") > 4000, F.concat(F.lit("+47 "), number(s))).alias("phone"), F.when(F.col("s_acctbal") < 7000, F.concat(F.lit("https://www.kust"), s.cast("string"), F.lit(".example.com/a"))).alias("web_site"),
        F.lit(10).alias("review_count"),
    )
    trade = table(spark, sf, "supplier").filter(s % 2 == 1).select(views.padded(s).alias("org"), F.concat(F.lit("butikk "), s.cast("string")).alias("title_key"))
    return profiles, places, trade


UNCLAIMED_SQL = """
p AS (SELECT c_custkey AS k, lpad(c_custkey::VARCHAR, 9, '0') AS org, [lower(c_mktsegment), 'unit' || (c_custkey % 50), 'kust' || c_custkey] AS t, c_nationkey AS n, c_custkey % 3 > 0 AS has_code, c_custkey % 300 AS ph FROM customer),
q AS (SELECT s_suppkey AS k, s_suppkey % 5 AS v, lower(c_mktsegment) AS seg, CASE WHEN s_acctbal > 2000 THEN c_nationkey ELSE s_nationkey END AS n, CASE WHEN s_acctbal > 4000 THEN s_suppkey % 300 END AS ph, s_acctbal < 7000 AS web FROM supplier JOIN customer ON c_custkey = s_suppkey),
q1 AS (SELECT *, CASE v WHEN 0 THEN [seg, 'unit' || (k % 50), 'kust' || k, 'filial'] WHEN 1 THEN [seg, 'unit' || (k % 50)] WHEN 2 THEN [seg] WHEN 3 THEN ['butikk', k::VARCHAR] ELSE [seg, 'unit' || (k % 50), 'kust' || k || 'x'] END AS t FROM q),
pairs AS (SELECT p.org, 'place-' || q1.k AS place_id, len(list_intersect(p.t, q1.t)) / 3 AS ns, p.n = q1.n AS located, p.has_code, q1.ph IS NOT NULL AND q1.ph = p.ph AS phone, q1.web AND q1.k = p.k AS web,
  q1.v = 3 AND q1.k = p.k AND q1.k % 2 = 1 AS known, array_to_string(p.t, ' ') AS a, array_to_string(q1.t, ' ') AS b, q1.v FROM p CROSS JOIN q1),
judged AS (SELECT *, located::INT + phone::INT + web::INT AS channels, CASE WHEN v = 3 THEN 0 ELSE 2 * least(length(a), length(b)) / (length(a) + length(b)) END AS ratio FROM pairs),
ok AS (SELECT org, place_id, round(round(ns, 4) * 4 + located::INT * 3 + phone::INT * 2 + web::INT * 3 + (located AND has_code)::INT * 2 + 0.2, 4) AS score FROM judged
  WHERE (ns >= 0.99 AND channels >= 1) OR (round(ns, 4) >= 0.66 AND channels >= 2) OR (ns = 0 AND located AND phone AND known) OR (web AND round(ratio, 4) >= 0.85))
"""


@bind("candidate_places", "C12", f"WITH {UNCLAIMED_SQL} SELECT * FROM ok")
def candidate_places(spark, sf):
    """Accepted pairs among places that carry no entity, found by keys; the SQL looks at every pair."""
    profiles, places, trade = _unclaimed(spark, sf)
    found = op.assess_places(profiles, op.candidate_places(profiles, places, trade), trade)
    return found.filter("accepted").select("org", "place_id", "score")


@bind(
    "resolve_unclaimed_places",
    "C12",
    f"""WITH {UNCLAIMED_SQL}, b AS (SELECT org, max(score) AS score FROM ok GROUP BY 1), l AS (SELECT org, count(*) AS leaders, min(place_id) AS place_id FROM ok JOIN b USING (org, score) GROUP BY 1)
SELECT org, CASE WHEN leaders > 1 THEN 'ambiguous_exact_match' ELSE 'exact_match' END AS status, CASE WHEN leaders = 1 THEN place_id END AS place_id, CASE WHEN leaders = 1 THEN score END AS score FROM l JOIN b USING (org)""",
)
def resolve_unclaimed_places(spark, sf):
    profiles, places, trade = _unclaimed(spark, sf)
    judged = op.assess_places(profiles, op.candidate_places(profiles, places, trade), trade)
    return op.resolve_places(judged).filter("status <> 'no_exact_match'").select("org", "status", "place_id", "score")


@bind(
    "match_external_profiles",
    "C13",
    f"""WITH {PROFILES_SQL}, e AS (SELECT s_suppkey, lpad(s_suppkey::VARCHAR, 9, '0') AS num, s_nationkey, s_acctbal FROM supplier),
j AS (SELECT p.org, 's' || s_suppkey AS external_id, s_acctbal > 0 AS full_name, 'nation-' || ltrim(municipality_number, '0') = 'nation-' || s_nationkey OR (municipality_number = '0000' AND s_nationkey = 0) AS same_nation, contains('head office nation ' || s_nationkey, 'nation ' || municipality_number::INTEGER) AS town_named FROM profiles p JOIN e ON e.num = p.org),
r AS (SELECT org, external_id, same_nation AS dom, full_name AND town_named AS town FROM j)
SELECT org, external_id, concat_ws(',', CASE WHEN dom THEN 'core_name_and_domain' END, CASE WHEN town THEN 'full_name_and_town' END) AS proof FROM r WHERE dom OR town""",
)
def match_external_profiles(spark, sf):
    empty = F.array().cast("array<string>")
    site = lambda key: F.concat(F.lit("nation-"), key.cast("int").cast("string"), F.lit(".example.com"))
    profiles = views.profiles(spark, sf).select(
        "org", F.concat("name", F.lit(" AS")).alias("name"), site(F.col("municipality_number")).alias("domain"), "municipality", empty.alias("aliases"), empty.alias("leaders")
    )
    supplier = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    number = views.padded(F.col("s_suppkey"))
    external = supplier.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("external_id"),
        F.concat(F.lit("Customer#"), number, F.when(F.col("s_acctbal") > 0, " AS").otherwise("")).alias("name"), site(F.col("s_nationkey")).alias("domain"),
        F.concat(F.lit("Head office, "), "n_name").alias("location"), F.lit("").alias("about"), F.lit(None).cast("string").alias("company_id_org"),
    )
    return op.match_external_profiles(profiles, external).withColumn("proof", F.array_join("proof", ","))


@bind(
    "match_job_cards",
    "C14",
    f"""WITH {PAGE_SQL} SELECT DISTINCT host AS org, (page_id + 1000000)::VARCHAR AS job_id, 'https://linkedin.com/company/' || replace(host, '.', '-') AS company_page FROM pg WHERE url LIKE 'https:%'""",
)
def match_job_cards(spark, sf):
    pages = _pages(spark, sf)
    slug = F.replace("host", F.lit("."), F.lit("-"))
    number = (F.col("page_id") + 1_000_000).cast("string")
    secure = F.col("url").startswith("https:")
    cards = pages.select(
        F.when(secure, F.concat(F.lit("https://no.linkedin.com/company/"), F.upper(slug), F.lit("?trk=x"))).otherwise(F.concat(F.lit("https://jobs.example.com/company/"), slug)).alias("company_url"),
        F.when(F.col("page_id") > 100, F.concat(F.lit("urn:li:jobPosting:"), number)).alias("urn"), F.concat(F.lit("https://no.linkedin.com/jobs/view/x-"), number, F.lit("?p=1")).alias("job_url"), "title",
    )
    known = pages.select(F.col("host").alias("org"), F.concat(F.lit("https://www.linkedin.com/company/"), slug, F.lit("/about/")).alias("profile_url"))
    return op.match_job_cards(cards, known).select("org", "job_id", "company_page")


@bind(
    "legal_proof",
    "C16",
    f"""WITH {PROFILES_SQL} SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'captured_exact_organisation_number' WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'captured_legal_name_and_domain_or_city' END AS proof
FROM orders JOIN profiles ON org = lpad(o_custkey::VARCHAR, 9, '0')""",
)
def legal_proof(spark, sf):
    orders = table(spark, sf, "orders").withColumn("org", views.padded(F.col("o_custkey")))
    # Letters for digits, so that a name never holds an organisation number by itself.
    lettered = F.translate("name", "0123456789", "abcdefghij")
    j = orders.join(views.profiles(spark, sf).withColumn("name", lettered), "org")
    spaced = F.concat_ws(" ", F.substring("org", 1, 3), F.substring("org", 4, 3), F.substring("org", 7, 3))
    named = F.concat(F.lit("Levert til "), "name", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.concat(F.lit(" i "), "municipality")).otherwise(" i Utlandet"))
    body = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Org.nr. "), spaced)).when(F.col("o_orderstatus") == "F", named).otherwise(F.concat(F.lit("Levert i "), "municipality"))
    none, nobody = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    proof = op.legal_proof(F.col("org"), F.col("name"), F.col("municipality"), none, none, nobody, body, none)
    return j.select("o_orderkey", proof.alias("proof"))


# ---- outcomes ----


@bind(
    "explain_misses",
    "C18",
    f"""WITH {PROFILES_SQL}, o AS (SELECT lpad(user_id::VARCHAR, 9, '0') AS org, CASE WHEN max(value) > 150 THEN 'failed' ELSE 'official' END AS disposition, CASE WHEN min(value) < 0.2 THEN 'available' ELSE 'ambiguous' END AS ws, count(*) FILTER (event_type = 'click' AND value > 60) AS rh FROM events GROUP BY 1),
j AS (SELECT p.org, p.website IS NOT NULL AS listed, o.*EXCLUDE (org), o.org IS NULL AS gone FROM profiles p LEFT JOIN o USING (org))
SELECT org, CASE WHEN gone THEN 'system_error' WHEN disposition = 'failed' THEN 'fatal_execution_error' WHEN NOT listed AND rh = 0 THEN 'shell_holding_no_dns' WHEN NOT listed THEN 'identity_gate_rejected_unregistered' WHEN rh = 0 THEN 'dead_registry_domain' ELSE 'identity_gate_rejected_registered' END AS cluster
FROM j WHERE gone OR disposition = 'failed' OR ws <> 'available'""",
)
def explain_misses(spark, sf):
    value = F.col("value")
    ours = table(spark, sf, "events").groupBy(views.padded(F.col("user_id")).alias("org")).agg(
        F.when(F.max(value) > 150, "failed").otherwise("official").alias("disposition"), F.when(F.min(value) < 0.2, "available").otherwise("ambiguous").alias("website_state"),
        F.count_if((F.col("event_type") == "click") & (value > 60)).alias("resolved_hosts"),
    )
    other = ours.select("org", F.lit("available").alias("website_state"))
    return op.explain_misses(views.profiles(spark, sf).select("org", "name", "website"), ours, other).select("org", "cluster")


@bind(
    "merge_channels",
    "C19",
    """WITH e AS (SELECT lpad(user_id::VARCHAR, 9, '0') AS org, 'p' || (json_extract_string(props, '$.k')::INTEGER // 10) AS platform, event_type || '/' || event_id AS url, CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS turn, event_type FROM events),
c AS (SELECT org, platform, arg_min(url, (turn, url)) AS url, arg_min(event_type, (turn, url)) AS source FROM e GROUP BY ALL)
SELECT *, CASE WHEN bool_or(source = 'purchase') OVER (PARTITION BY org) THEN 'open_data' ELSE 'external_directory' END AS source_class, CASE WHEN bool_or(source = 'purchase') OVER (PARTITION BY org) THEN 0.9 ELSE 0.75 END::DOUBLE AS confidence FROM c""",
)
def merge_channels(spark, sf):
    k = views.props_k(F.col("props"))
    rows = table(spark, sf, "events").select(
        views.padded(F.col("user_id")).alias("org"), F.concat(F.lit("p"), (k / 10).cast("int").cast("string")).alias("platform"),
        F.concat("event_type", F.lit("/"), F.col("event_id").cast("string")).alias("url"), "event_type",
    )
    sources = [(name, rows.filter(F.col("event_type") == name)) for name in ("view", "signup", "purchase", "click", "error")]
    return op.merge_channels(sources, exact_sources=["purchase"])


@bind(
    "plan_tasks",
    "H9",
    f"""WITH {PROFILES_SQL}, t AS (SELECT org, unnest(['google_places_api', 'licensed_news_search', 'jobs_provider'] || CASE WHEN website IS NULL THEN ['permitted_search_api'] ELSE ['linkedin_connector'] END) AS connector, website IS NOT NULL AS v, name, municipality FROM profiles),
p AS (SELECT *, CASE connector WHEN 'google_places_api' THEN 'resolve_places_and_public_rating' WHEN 'licensed_news_search' THEN 'discover_independent_mentions' WHEN 'jobs_provider' THEN 'discover_active_jobs' WHEN 'permitted_search_api' THEN 'discover_social_handles' ELSE 'refresh_verified_profile_metrics' END AS purpose,
  CASE WHEN connector = 'linkedin_connector' THEN 'https://linkedin.com/company/' || org END AS u FROM t)
SELECT substr(sha256(org || '|' || name || '|' || municipality || '|' || connector || '|' || purpose || '|' || coalesce(u, '') || '|' || CASE WHEN u IS NOT NULL AND v THEN 'true' ELSE 'false' END), 1, 24) AS task_id, org, connector, purpose, u IS NOT NULL AND v AS candidate_identity_verified FROM p""",
)
def plan_tasks(spark, sf):
    link = F.struct(F.lit("linkedin").alias("platform"), F.concat(F.lit("https://linkedin.com/company/"), "org").alias("url"))
    profiles = views.profiles(spark, sf).select(
        "org", "name", "municipality", F.col("website").isNotNull().alias("verified_site"), F.when(F.col("website").isNotNull(), F.array(link)).alias("social_links")
    )
    return op.plan_tasks(profiles).select("task_id", "org", "connector", "purpose", "candidate_identity_verified")


# ---- identity gates ----


def _gate_pages(spark, sf):
    return table(spark, sf, "pages").select(
        urls.host(F.col("url")).alias("org"), "page_id", "url", F.when(F.col("url").startswith("https:"), "registry").otherwise("search").alias("origin"),
        urls.host(F.col("url")).alias("hostname"), *markup.page_signals(F.col("html")), F.array().cast("array<string>").alias("structured_names"),
    )


def _gate_profiles(spark, sf):
    empty = F.array().cast("array<string>")
    none = F.lit(None).cast("string")
    return _entities(spark, sf).select("org", "name", empty.alias("former_names"), none.alias("postcode"), none.alias("city"), empty.alias("streets"), empty.alias("phones"))


def _hits(text: str) -> str:
    """Expected tokens found in folded text, short ones as whole words."""
    return f"list_filter(t, lambda x: CASE WHEN length(x) <= 3 THEN contains(' ' || regexp_replace({text}, '[^a-z0-9_]+', ' ', 'g') || ' ', ' ' || x || ' ') ELSE contains({text}, x) END)"


def _marked(text: str, markers: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{m}')" for m in markers) + ")"


GATE_SQL = f"""
WITH {PAGE_SQL},
g0 AS (SELECT p.host AS org, p.page_id, p.url, p.url LIKE 'https:%' AS tr, p.title, {sql.footer('p.html')} AS foot, {sql.strip_tags('p.html')} AS body, e.name,
  coalesce(nullif(regexp_extract(p.html, '(?is)<meta[^>]+name=["'']description["''][^>]+content=["'']([^"'']*)["'']', 1), ''), '') AS meta FROM pg p JOIN ent e ON e.org = p.host),
g1 AS (SELECT *, concat_ws(' ', nullif(title, ''), nullif(meta, ''), nullif(foot, ''), org) AS region FROM g0),
g2 AS (SELECT *, region || ' ' || body AS whole, {sql.long_words('name')} AS w FROM g1),
g3 AS (SELECT *, {sql.name_tokens('w')} AS t, {sql.fold('region')} AS fr, {sql.fold('whole')} AS fw, {sql.long_words('title')} AS w1, {sql.long_words('foot')} AS w2, {sql.long_words('org')} AS w3 FROM g2),
g4 AS (SELECT *, {_hits('fr')} AS m, {_hits('fw')} AS ma, len(t) AS n, {sql.name_tokens('w1')} AS t1, {sql.name_tokens('w2')} AS t2, {sql.name_tokens('w3')} AS t3, split_part(org, '.', 1) AS lab, length(trim(body)) >= 200 AS solid FROM g3),
g5 AS (SELECT *, len(m) AS hits, n > 0 AND len(m) = n AS fullm, CASE WHEN n > 0 THEN len(m) / n ELSE 0 END AS share, starts_with(array_to_string(t, ''), substr(lab, 1, 6)) AS dom,
  n > 0 AND (len(list_filter(t, lambda x: NOT list_contains(t1, x))) = 0 OR len(list_filter(t, lambda x: NOT list_contains(t2, x))) = 0 OR len(list_filter(t, lambda x: NOT list_contains(t3, x))) = 0) AS named,
  {_marked('fw', lx.NORWEGIAN_PAGE_WORDS)} OR regexp_matches(whole, '(\\+47|0047)\\s*\\d') AS ctx, {_marked('fw', lx.PARKED_MARKERS)} AS parked, {_marked('fw', lx.NETWORK_MARKERS)} AS net,
  list_filter(list_distinct(list_transform(regexp_extract_all(whole, '\\b\\d{{3}}[\\s. ]?\\d{{3}}[\\s. ]?\\d{{3}}\\b'), lambda x: regexp_replace(x, '\\D', '', 'g'))), lambda x: {"((11 - (" + " + ".join(f"substr(x, {i}, 1)::INTEGER * {w}" for i, w in enumerate([3, 2, 7, 6, 5, 4, 3, 2], start=1)) + ") % 11) % 11) = substr(x, 9, 1)::INTEGER"}) AS orgs FROM g4),
g6 AS (SELECT *, CASE WHEN tr AND (dom OR fullm) AND hits > 0 AND n < 2 THEN 0.95 WHEN tr AND (dom OR fullm) AND hits > 0 AND (fullm OR share >= 0.75) THEN 0.95 WHEN tr AND (dom OR fullm) AND hits > 0 THEN 0.92
  WHEN n >= 2 AND (named OR (fullm AND dom)) AND solid AND ctx THEN 0.95 WHEN n = 1 AND (named OR dom OR fullm) AND solid AND ctx THEN 0.95 WHEN n < 2 THEN 0.5
  WHEN fullm AND n >= 2 AND dom AND tr THEN 0.92 WHEN fullm AND n >= 2 AND dom THEN 0.70
  WHEN tr AND (share >= 0.5 OR (len(ma) = n AND n >= 2)) AND solid THEN 0.92 WHEN fullm AND tr THEN 0.92 WHEN fullm THEN 0.70 WHEN share >= 0.75 AND hits >= 2 THEN 0.65 ELSE 0.30 END AS base FROM g5),
g7 AS (SELECT *, CASE WHEN parked THEN 0.05 WHEN len(orgs) > 0 AND hits = 0 THEN 0.15 WHEN n = 0 THEN 0.2 WHEN net OR len(orgs) > 0 THEN least(base, 0.7) ELSE base END::DOUBLE AS score FROM g6)
"""


@bind(
    "identity_gate_v1",
    "C6",
    GATE_SQL + """SELECT org, url, score, CASE WHEN parked OR (len(orgs) > 0 AND hits = 0) THEN 'rejected' WHEN score >= 0.9 THEN 'exact' WHEN score >= 0.8 THEN 'review' ELSE 'ambiguous' END AS status,
  array_to_string(CASE WHEN parked THEN [] WHEN hits > 0 THEN m ELSE ma END, ' ') AS matched FROM g7""",
)
def identity_gate_v1(spark, sf):
    judged = gates.identity_gate_v1(_gate_profiles(spark, sf), _gate_pages(spark, sf))
    return judged.select("org", "url", "score", "status", F.array_join("matched_tokens", " ").alias("matched"))


EXACT_NOISE = [w for w in lx.OWNER_GENERIC if w not in ("b", "v")]
OWNER_SQL = " || ' ' || ".join(sql.strip_tags(f"array_to_string(regexp_extract_all(html, '(?is)<{t}\\b[^>]*>(.*?)</{t}>', 1), ' ')") for t in ("header", "footer", "address"))


@bind(
    "identity_gate_v3",
    "C7",
    f"""WITH {PAGE_SQL}, h AS (SELECT e.org, p.url, e.name, p.title, {OWNER_SQL} AS own, {sql.footer('p.html')} AS foot, {sql.strip_tags('p.html')} AS body, {sql.words('e.name')} AS w FROM ent e JOIN pg p ON p.page_id = e.first_page),
n AS (SELECT *, {sql.without('w', EXACT_NOISE)} AS core, array_to_string(w, ' ') AS legal, array_to_string({sql.words('own')}, ' ') AS ownw FROM h),
f AS (SELECT *, len(core) > 0 AS named, length(legal) > 0 AND contains(' ' || ownw || ' ', ' ' || legal || ' ') AS owner, len(core) >= 2 AS several, len(regexp_extract_all(' ' || title || ' ' || foot || ' ', '[^0-9][89]\\d{{2}}[ .]*\\d{{3}}[ .]*\\d{{3}}[^0-9]')) > 0 AS conflict FROM n),
v AS (SELECT *, CASE WHEN conflict THEN 0.2 WHEN owner THEN 0.98 WHEN named THEN 0.95 ELSE 0.3 END::DOUBLE AS score,
  CASE WHEN conflict THEN 'Homepage identifies another Norwegian organisation number' WHEN owner THEN 'Exact legal name is declared in captured homepage owner/contact regions' WHEN named AND several THEN 'Contiguous legal name appears in homepage evidence'
    WHEN named THEN 'Contiguous company name is corroborated by registry, contact evidence or its Norwegian name domain' ELSE 'No exact legal identity or corroborated company name was found' END AS reason FROM f)
SELECT org, url AS site_url, score, CASE WHEN score >= 0.9 THEN 'exact' ELSE 'related_or_uncertain' END AS status, score >= 0.9 AS publishable, score >= 0.9 AS content_attributable, reason, TRUE AS registry_link, conflict AS conflicting_org FROM v""",
)
def identity_gate_v3(spark, sf):
    """The ownership gate over every page as a site of its host's entity."""
    entities = _entities(spark, sf)
    none, empty = F.lit(None).cast("string"), F.array().cast("array<string>")
    profiles = entities.select(
        "org", "name", none.alias("municipality"), F.array(F.concat(F.lit("https://"), "org")).alias("websites"), none.alias("email"), none.alias("street"), none.alias("postcode"),
        none.alias("city"), none.alias("phone"), empty.alias("people"), empty.alias("known_orgs"),
    )
    html = F.col("html")
    organisations = F.array().cast("array<struct<name:string,legal_name:string,alternate_name:string,url:string,tax_id:string,vat_id:string,identifier:string>>")
    pages = _pages(spark, sf)
    first = entities.select("first_page")
    homes = pages.join(first, pages.page_id == first.first_page, "left_semi")
    sites = homes.select(
        F.col("host").alias("org"), F.col("url").alias("site_url"), F.col("url").alias("requested_url"), "title", markup.meta_content(html, "description").alias("description"),
        none.alias("heading"), markup.region_text(html, "footer").alias("identity_text"), markup.owner_text(html).alias("ownership_text"), markup.strip_tags(html).alias("main_text"),
        F.lit(True).alias("owner_captured"), F.lit(False).alias("homepage_required"), F.lit(False).alias("article_document"), organisations.alias("organisations"),
    )
    site_of = sites.select(F.col("org").alias("host"), "site_url")
    others = pages.join(site_of, "host").filter(F.col("url") != F.col("site_url")).select(
        F.col("host").alias("org"), "site_url", F.col("url").alias("page_url"), "title", markup.region_text(html, "footer").alias("identity_text"), markup.strip_tags(html).alias("main_text")
    )
    judged = gates.identity_gate_v3(profiles, sites, others)
    return judged.select("org", "site_url", "score", "status", "publishable", "content_attributable", "reason", "registry_link", "conflicting_org")


HANDLE_SQL = f"""
h AS (SELECT p_partkey, string_split(p_name, ' ') AS t, CASE WHEN p_size < 20 THEN replace(p_name, ' ', '-') WHEN p_size < 35 THEN split_part(p_name, ' ', 1) || lower(p_type) ELSE lower(p_brand) END AS raw FROM part),
g AS (SELECT p_partkey, len(t) AS n, array_to_string(t, '') AS compact, len(list_filter(t, lambda x: contains(handle, x))) AS hits, handle FROM (SELECT *, 'company' || array_to_string(regexp_extract_all(raw, '[a-z0-9]{{2,}}'), '') AS handle FROM h))
"""


@bind(
    "social_gate",
    "C8",
    f"""WITH {HANDLE_SQL} SELECT lpad(p_partkey::VARCHAR, 9, '0') AS org, CASE WHEN contains(handle, compact) THEN 0.98 WHEN n = 1 AND hits > 0 THEN 0.95 WHEN hits / n >= 0.75 AND hits >= 2 THEN 0.9 ELSE 0.3 END::DOUBLE AS identity_score FROM g""",
)
def social_gate(spark, sf):
    part = table(spark, sf, "part")
    org = views.padded(F.col("p_partkey")).alias("org")
    slug = F.when(F.col("p_size") < 20, F.replace("p_name", F.lit(" "), F.lit("-"))).when(F.col("p_size") < 35, F.concat(F.substring_index("p_name", " ", 1), F.lower("p_type"))).otherwise(F.regexp_replace(F.lower("p_brand"), "#", "%23"))
    links = part.select(org, F.lit("linkedin").alias("platform"), F.concat(F.lit("https://linkedin.com/company/"), slug).alias("url"))
    return gates.social_gate(part.select(org, F.concat("p_name", F.lit(" AS")).alias("name")), links).select("org", "identity_score")


@bind(
    "site_inherited_links",
    "C8",
    f"WITH {PAGE_SQL} SELECT page_id, CASE WHEN url LIKE 'https:%' AND page_id >= 20 AND length(split_part(host, '.', 1)) >= 3 THEN 0.92 ELSE 0.0 END::DOUBLE AS score FROM pg",
)
def site_inherited_links(spark, sf):
    pages = _pages(spark, sf)
    platform = F.when(F.col("page_id") < 20, "X").otherwise("facebook")
    link = F.concat(F.lit("https://facebook.com/"), F.upper(F.substring_index("host", ".", 1)), F.lit("%20official"))
    return pages.select("page_id", gates.site_inherited_link(F.col("url").startswith("https:"), F.col("url"), platform, link).alias("score"))
