"""Rankings, allocations and capped lists over events, customers, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta import lexicon as lx
from attesta.operators import ranking as op, register as reg
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.source_queries import FILED_SQL, _filed_profiles
from attesta.plans.views import PROFILES_SQL

ORIGINS = ["registry", "search", "dns_guess", "wikidata", "other"]
ORIGIN_SQL = "CASE event_type WHEN 'view' THEN 'registry' WHEN 'signup' THEN 'search' WHEN 'click' THEN 'dns_guess' WHEN 'purchase' THEN 'wikidata' ELSE 'other' END"


def _leads(spark, sf):
    kind = F.col("event_type")
    origin = F.when(kind == "view", "registry").when(kind == "signup", "search").when(kind == "click", "dns_guess").when(kind == "purchase", "wikidata").otherwise("other")
    return table(spark, sf, "events").select(
        views.padded(F.col("user_id")).alias("org"), F.col("event_id").cast("string").alias("url"), origin.alias("origin"),
        (views.props_k(F.col("props")) + 1).alias("rank"), F.when(F.col("value") > 30, F.least(F.lit(0.99), F.floor("value") / 400)).alias("p"),
    )


@bind(
    "rank_candidates",
    "E1 J3",
    f"""WITH c AS (SELECT lpad(user_id::VARCHAR, 9, '0') AS org, event_id::VARCHAR AS url, {ORIGIN_SQL} AS origin, json_extract_string(props, '$.k')::INTEGER + 1 AS rank, CASE WHEN value > 30 THEN least(0.99, floor(value) / 400) END AS p FROM events),
s AS (SELECT *, CASE WHEN origin IN ('registry', 'wikidata') THEN 0 ELSE 1 END AS guess,
  round(CASE WHEN origin NOT IN ('registry', 'wikidata') AND p IS NOT NULL THEN p ELSE greatest(0.05, CASE origin WHEN 'registry' THEN 0.97 WHEN 'wikidata' THEN 0.95 WHEN 'search' THEN 0.55 WHEN 'dns_guess' THEN 0.45 ELSE 0.4 END - 0.03 * (rank - 1)) END, 4) AS probability FROM c)
SELECT org, url, origin, probability, row_number() OVER (PARTITION BY org ORDER BY guess, probability DESC, rank, url) AS place FROM s""",
)
def rank_candidates(spark, sf):
    return op.rank_candidates(_leads(spark, sf), probability="p").select("org", "url", "origin", "probability", "place")


CREDITS_SQL = f"""WITH {PROFILES_SQL}, r AS (SELECT *, 30 + CASE WHEN employees IS NOT NULL THEN 20 ELSE 0 END + 10 + CASE WHEN bankrupt OR liquidating THEN 0 ELSE 20 END + 20 AS readiness,
  least(30, coalesce(employees, 0) // 2) + CASE WHEN revenue > 0 THEN 25 ELSE 0 END + CASE WHEN website IS NOT NULL THEN 15 ELSE 0 END + CASE WHEN legal_form = 'ASA' THEN 15 ELSE 0 END AS priority FROM profiles),
w AS (SELECT org, row_number() OVER (ORDER BY priority DESC, readiness DESC, org) AS i FROM r WHERE readiness >= 75)
"""


@bind(
    "allocate_credits",
    "E8",
    CREDITS_SQL + "SELECT org, readiness, priority, CASE WHEN i IS NULL THEN 0 ELSE greatest(0, least(2, 301 - (i - 1) * 2)) END AS credits FROM r LEFT JOIN w USING (org)",
)
def allocate_credits(spark, sf):
    rows = views.profiles(spark, sf).withColumns(
        {"address": F.when(F.col("employees").isNotNull(), F.lit("Gata 1")), "postcode": F.col("municipality_number"),
         "own_site": F.lit(False), "has_operating_names": F.col("legal_form") == "ASA"}
    )
    return op.allocate_credits(rows, limit=301)


@bind(
    "allocate_grants",
    "E9",
    f"""WITH {FILED_SQL}, g AS (SELECT org, tier, CASE tier WHEN 'shell' THEN 3 WHEN 'standard' THEN 12 ELSE 30 END AS base FROM tiered), t AS (SELECT sum(base) AS planned FROM g)
SELECT org, tier, CASE WHEN planned > 5000 THEN greatest(1, floor(base * (5000 / planned)))::INTEGER ELSE base END AS granted, CASE WHEN planned > 5000 THEN 0 ELSE 5000 - planned END::BIGINT AS reserve FROM g, t""",
)
def allocate_grants(spark, sf):
    return op.allocate_grants(_filed_profiles(spark, sf).withColumn("tier", reg.tier()), cap=5000)


@bind(
    "cap_candidates",
    "E10",
    """WITH m AS (SELECT event_id AS ad, lpad(user_id::VARCHAR, 9, '0') AS org, ts FROM events UNION ALL SELECT event_id, lpad(json_extract_string(props, '$.k'), 9, '0'), ts FROM events WHERE json_extract_string(props, '$.k')::BIGINT <> user_id),
k AS (SELECT *, row_number() OVER (PARTITION BY org ORDER BY ts DESC, ad) AS place FROM m QUALIFY place <= 15), a AS (SELECT ad, max(ts) AS t FROM k GROUP BY 1 ORDER BY t DESC, ad LIMIT 250)
SELECT ad, org, place FROM k WHERE ad IN (SELECT ad FROM a)""",
)
def cap_candidates(spark, sf):
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    own = events.select(F.col("event_id").alias("ad"), views.padded(F.col("user_id")).alias("org"), F.col("ts").alias("modified"))
    other = events.filter(k.cast("bigint") != F.col("user_id")).select(F.col("event_id"), views.padded(k), "ts")
    return op.cap_candidates(own.unionAll(other)).select("ad", "org", "place")


@bind(
    "operating_names",
    "E12",
    """WITH u AS (SELECT lpad((p_size)::VARCHAR, 9, '0') AS org, p_name AS name, p_name AS k, (p_retailprice / 10)::DOUBLE AS e0 FROM part),
g AS (SELECT org, k, max(floor(e0)::INTEGER) AS employees, arg_max(name, (floor(e0)::INTEGER, name)) AS name FROM u WHERE length(k) >= 4 GROUP BY ALL),
own AS (SELECT lpad(p_size::VARCHAR, 9, '0') AS org, arg_min(p_name, p_partkey) AS own FROM part GROUP BY 1)
SELECT org, place, name, employees FROM (SELECT g.*, row_number() OVER (PARTITION BY org ORDER BY employees DESC, k) AS place FROM g JOIN own USING (org) WHERE k <> own) WHERE place <= 2""",
)
def operating_names(spark, sf):
    part = table(spark, sf, "part")
    org = views.padded(F.col("p_size")).alias("org")
    parents = part.groupBy(org).agg(F.concat(F.min_by("p_name", "p_partkey"), F.lit(" AS")).alias("name"))
    units = part.select(org.alias("parent_org"), F.col("p_name").alias("name"), F.floor(F.col("p_retailprice") / 10).alias("employees"))
    return op.operating_names(parents, units, keep=2)


@bind(
    "limit_news",
    "E13",
    r"""WITH d AS (SELECT source AS org, doc_id * 100000 + generate_subscripts(string_split(text, E'\n'), 1) AS pos, unnest(string_split(text, E'\n')) AS title FROM documents), f AS (SELECT org, lower(trim(title)) AS t, min(pos) AS pos FROM d GROUP BY ALL)
SELECT org, pos, place FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY pos) AS place FROM f) WHERE place <= 5""",
)
def limit_news(spark, sf):
    items = table(spark, sf, "documents").select(F.col("source").alias("org"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "title")).select("org", (F.col("doc_id") * 100000 + F.col("line") + 1).alias("pos"), "title")
    return op.limit_news(items, 5).select("org", "pos", "place")


@bind(
    "prefer_dated_articles",
    "E13",
    """WITH p AS (SELECT regexp_replace(lower(regexp_extract(url, '//([^/?#]+)', 1)), '^www\\.', '') AS org, page_id AS pos, regexp_replace(regexp_extract(url, '//[^/?#]*([^?#]*)', 1), '/+$', '') AS path, url LIKE 'https:%' AS dated FROM pages),
k AS (SELECT *, CASE WHEN starts_with(path, '/en/') THEN regexp_extract(path, '([^/]*)$', 1) ELSE path END AS art, CASE WHEN dated THEN -(page_id_day) ELSE 0 END AS age FROM (SELECT *, (date '2024-01-01' - date '1970-01-01')::INTEGER + (pos % 28)::INTEGER AS page_id_day FROM p)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org, art ORDER BY NOT dated, age, starts_with(path, '/en/'), pos) AS rn FROM k) WHERE rn = 1)
SELECT org, pos, place FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY NOT dated, age, starts_with(path, '/en/'), pos) AS place FROM b) WHERE place <= 3""",
)
def prefer_dated_articles(spark, sf):
    from attesta.functions.urls import host

    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 28).cast("int")), "yyyy-MM-dd")
    items = table(spark, sf, "pages").select(
        host(F.col("url")).alias("org"), F.col("page_id").alias("pos"), "url", F.when(F.col("url").startswith("https:"), day).otherwise("").alias("published"), F.lit("").alias("modified")
    )
    return op.prefer_dated_articles(items, 3).select("org", "pos", "place")


@bind(
    "rank_strategies",
    "E15",
    f"""WITH l(strategy, listed) AS (VALUES {', '.join(f"('{s}', {i})" for i, s in enumerate(lx.STRATEGIES))}),
e AS (SELECT CASE event_type WHEN 'view' THEN 'company_site_feed' WHEN 'signup' THEN 'youtube_channel_feed' WHEN 'click' THEN 'independent_sentiment' WHEN 'purchase' THEN 'places_rating_reviews' ELSE 'jobs_feed_discovery' END AS strategy, value - 20 AS g FROM events),
s AS (SELECT strategy, count(*) AS n, count(*) FILTER (g > 0) AS w, avg(g) AS m FROM e GROUP BY 1),
p AS (SELECT l.strategy, listed, coalesce(n, 0) AS prior_runs, coalesce(w, 0) AS prior_successes, coalesce(m, 0) AS m, coalesce(m, 0) + 0.35 * sqrt(ln((SELECT count(*) FROM events) + 1) / (coalesce(n, 0) + 1)) AS pr FROM l LEFT JOIN s USING (strategy))
SELECT strategy, prior_runs, prior_successes, round(m, 3) AS mean_gain, round(pr, 6) AS priority, row_number() OVER (ORDER BY pr DESC, listed) AS place FROM p""",
)
def rank_strategies(spark, sf):
    kind = F.col("event_type")
    name = F.when(kind == "view", "company_site_feed").when(kind == "signup", "youtube_channel_feed").when(kind == "click", "independent_sentiment").when(kind == "purchase", "places_rating_reviews").otherwise("jobs_feed_discovery")
    log = table(spark, sf, "events").select(name.alias("strategy"), F.lit(None).cast("double").alias("learning_gain"), (F.col("value") - 20).alias("score_delta"))
    return op.rank_strategies(log).withColumn("priority", F.round("priority", 6))


@bind(
    "latency_summary",
    "D14",
    "SELECT event_type, count(*) AS n, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, max(value) AS maximum FROM events GROUP BY 1",
)
def latency_summary(spark, sf):
    return op.latency_summary(table(spark, sf, "events"), "value", ["event_type"])


@bind(
    "domain_fairness",
    "D14",
    """WITH d AS (SELECT regexp_extract(url, '//([^/?#]+)', 1) AS h, count(*) AS n FROM pages GROUP BY 1)
SELECT count(*) AS domains, quantile_disc(n, 0.5) AS p50_requests, quantile_disc(n, 0.95) AS p95_requests, max(n) AS max_requests FROM d""",
)
def domain_fairness(spark, sf):
    return op.domain_fairness(table(spark, sf, "pages"), F.regexp_extract("url", "//([^/?#]+)", 1))
