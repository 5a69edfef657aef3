"""Observations, sentiment and audits over events, documents and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import observations as op
from attesta.operators.ordering import with_totals
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import CLAIMS_SQL, EVIDENCE_SQL, OBSERVATIONS_SQL, PROFILES_SQL

AS_OF = "2024-01-31 00:00:00"

RULES = [
    ("coalesce(trim(id), '') = ''", "missing observation id"),
    ("NOT regexp_full_match(org, '[0-9]+')", "missing or invalid organisation number"),
    ("platform = 'bulletin'", "unsupported platform"),
    ("NOT exact_entity", "exact legal entity is not verified"),
    ("NOT has_proof", "missing exact-entity proof"),
    ("acquisition_mode <> 'official_api'", "acquisition mode is not approved for publication"),
    ("rights_status <> 'approved'", "source rights are not approved"),
    ("signal_type IN ('review', 'public_post', 'public_mention') AND evidence_span IS NULL", "missing evidence span"),
    ("sentiment_label IS NOT NULL AND source_class NOT IN ('customer_review', 'public_news')", "sentiment source is not independent"),
    ("sentiment_label IS NOT NULL AND sentiment_model_version IS NULL", "missing sentiment model version"),
]
REASONS_SQL = "concat_ws('; ', " + ", ".join(f"CASE WHEN {test} THEN '{text}' END" for test, text in RULES) + ")"
RATED_SQL = f"""
WITH {OBSERVATIONS_SQL},
rated AS (SELECT *, {REASONS_SQL} AS reasons, regexp_replace(regexp_extract(source_url, '//([^/]+)', 1), '^www\\.', '') AS host FROM observations),
ok AS (SELECT * FROM rated WHERE reasons = '')
"""
FRESH = "TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 45 DAY"
NOW = "TIMESTAMP '2024-01-31 00:00:00'"


@bind("validate_observations", "B6", RATED_SQL + "SELECT id, reasons, reasons = '' AS accepted FROM rated")
def validate_observations(spark, sf):
    rated = op.with_reasons(views.observations(spark, sf))
    return rated.select("id", F.array_join("reasons", "; ").alias("reasons"), (F.size("reasons") == 0).alias("accepted"))


@bind(
    "freshness_split",
    "B10",
    RATED_SQL + f"SELECT id, retrieved_at BETWEEN {FRESH} AND {NOW} AS fresh, published_at BETWEEN {FRESH} AND {NOW} AS recent FROM rated",
)
def freshness_split(spark, sf):
    return op.freshness_split(views.observations(spark, sf), AS_OF).select("id", "fresh", "recent")


FOOTPRINT_SQL = (
    RATED_SQL
    + f""", foot AS (
SELECT org, count(*) FILTER (reasons = '') AS accepted, count(*) FILTER (reasons <> '') AS rejected,
  coalesce(string_agg(DISTINCT platform, ',' ORDER BY platform) FILTER (reasons = ''), '') AS platforms,
  count(*) FILTER (reasons = '' AND retrieved_at BETWEEN {FRESH} AND {NOW}) AS fresh,
  count(*) FILTER (reasons = '' AND published_at BETWEEN {FRESH} AND {NOW}) AS recent,
  count(*) FILTER (reasons = '' AND signal_type = 'review') AS review_signals,
  count(DISTINCT source_url) FILTER (reasons = '' AND signal_type = 'job_posting') AS active_jobs,
  count(DISTINCT source_url) FILTER (reasons = '' AND signal_type IN ('public_post', 'public_mention')) AS public_items,
  0 AS public_engagement,
  count(*) FILTER (reasons = '' AND sentiment_label IS NOT NULL) AS sentiment_items,
  count(DISTINCT host) FILTER (reasons = '' AND sentiment_label IS NOT NULL) AS sentiment_sources,
  count(DISTINCT reviewer_id) FILTER (reasons = '' AND sentiment_label IS NOT NULL) AS sentiment_reviewers,
  count(*) FILTER (reasons = '' AND sentiment_label = 'positive') AS n_positive,
  count(*) FILTER (reasons = '' AND sentiment_label = 'neutral') AS n_neutral,
  count(*) FILTER (reasons = '' AND sentiment_label = 'negative') AS n_negative,
  count(*) FILTER (reasons = '' AND sentiment_label = 'mixed') AS n_mixed
FROM rated GROUP BY org)
"""
)


@bind(
    "aggregate_footprint",
    "D6",
    FOOTPRINT_SQL
    + """SELECT *, CASE WHEN accepted > 0 THEN 'available' ELSE 'not_available' END AS status,
  CASE WHEN sentiment_items >= 10 AND (sentiment_sources >= 2 OR sentiment_reviewers >= 10) THEN 'available' ELSE 'abstain' END AS sentiment_status,
  CASE WHEN sentiment_items >= 10 AND (sentiment_sources >= 2 OR sentiment_reviewers >= 10)
       THEN round_even(50 + 50.0::DOUBLE * (n_positive - n_negative) / (n_positive + n_neutral + n_negative), 1) END AS sentiment_score FROM foot""",
)
def aggregate_footprint(spark, sf):
    rows = op.aggregate_footprint(views.observations(spark, sf), AS_OF)
    return rows.withColumn("platforms", F.array_join("platforms", ",")).drop("platform_counts")


@bind("platform_counts", "D6", RATED_SQL + "SELECT org, platform, count(*) AS n FROM ok GROUP BY ALL")
def platform_counts(spark, sf):
    rows = op.aggregate_footprint(views.observations(spark, sf), AS_OF)
    return rows.select("org", F.explode("platform_counts").alias("platform", "n"))


@bind(
    "coverage_summary",
    "D7",
    RATED_SQL
    + """SELECT count(*) AS accepted, string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms,
  count(DISTINCT host) FILTER (source_class IN ('public_news', 'customer_review')) AS independent_hosts,
  count(*) FILTER (platform = 'news') AS news_items, count(*) FILTER (signal_type = 'review') AS review_signals,
  count(*) FILTER (signal_type = 'job_posting') AS job_postings, 0 AS workforce_snapshots, 0 AS engagement_signals, 0 AS rating_polarity_items FROM ok""",
)
def coverage_summary(spark, sf):
    return op.coverage_summary(views.observations(spark, sf)).withColumn("platforms", F.array_join("platforms", ","))


@bind(
    "cross_company_disputes",
    "C17",
    RATED_SQL
    + """SELECT replace(source_url, '//www.', '//') AS owner_url, count(DISTINCT org) AS owners, min(org) AS first_org FROM rated
WHERE signal_type IN ('profile_handle', 'public_post', 'job_posting') GROUP BY 1 HAVING count(DISTINCT org) > 1""",
)
def cross_company_disputes(spark, sf):
    return op.cross_company_disputes(views.observations(spark, sf))


@bind(
    "union_observations",
    "F1",
    f"""WITH {OBSERVATIONS_SQL}, late AS (SELECT * FROM observations WHERE retrieved_at >= TIMESTAMP '2024-01-10'), early AS (SELECT * FROM observations WHERE retrieved_at < TIMESTAMP '2024-01-20')
SELECT id, org, 'late' AS origin FROM late UNION ALL SELECT id, org, 'early' FROM early WHERE id NOT IN (SELECT id FROM late)""",
)
def union_observations(spark, sf):
    rows = views.observations(spark, sf).select("id", "org", "retrieved_at")
    early = rows.filter("retrieved_at < TIMESTAMP '2024-01-20'").withColumn("origin", F.lit("early"))
    late = rows.filter("retrieved_at >= TIMESTAMP '2024-01-10'").withColumn("origin", F.lit("late"))
    return op.union_observations(early, late).select("id", "org", "origin")


def _news_items(spark, sf):
    """Documents as dated independent items: the source publishes, the language is the entity."""
    text = F.col("text")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("org"),
        (F.col("n_chars") > 40).alias("exact_entity"),
        F.when(F.col("source").isin("src0", "src1", "src2"), "company_owned").otherwise("public_news").alias("source_class"),
        F.concat(F.lit("https://www."), "source", F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("source_url"),
        F.lit(None).cast("string").alias("source_id"),
        F.lit("2024-01-01").alias("retrieved_at"),
        F.nullif(F.trim(text), F.lit("")).alias("evidence_span"),
        F.sha2(text, 256).alias("content_sha256"),
        text.alias("text"),
        F.when(F.contains(F.lower(text), F.lit("ther")), "positive").when(F.contains(F.lower(text), F.lit("que")), "negative").otherwise("neutral").alias("label"),
    )


NEWS_SQL = """
news AS (
  SELECT doc_id::VARCHAR AS id, lang AS org, n_chars > 40 AS exact_entity,
    CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'company_owned' ELSE 'public_news' END AS source_class,
    source || '.example.com' AS host, doc_id, text, nullif(trim(text), '') AS evidence_span,
    CASE WHEN contains(lower(text), 'ther') THEN 'positive' WHEN contains(lower(text), 'que') THEN 'negative' ELSE 'neutral' END AS label
  FROM documents),
eligible AS (SELECT *, concat_ws('; ', CASE WHEN NOT exact_entity THEN 'exact company identity is not verified' END,
    CASE WHEN source_class <> 'public_news' THEN 'source is not an allowed independent class' END,
    CASE WHEN evidence_span IS NULL THEN 'missing evidence_span' END, CASE WHEN nullif(trim(text), '') IS NULL THEN 'missing text' END) AS reasons FROM news)
"""


@bind("sentiment_eligibility", "B7", f"WITH {NEWS_SQL} SELECT id, reasons FROM eligible")
def sentiment_eligibility(spark, sf):
    return op.sentiment_reasons(_news_items(spark, sf)).select("id", F.array_join("reasons", "; ").alias("reasons"))


@bind(
    "company_sentiment",
    "D8",
    f"""WITH {NEWS_SQL}, agg AS (SELECT org, count(*) FILTER (reasons = '') AS accepted_items, count(*) FILTER (reasons <> '') AS rejected_items,
  count(DISTINCT host) FILTER (reasons = '') AS independent_sources, count(DISTINCT doc_id) FILTER (reasons = '') AS source_urls,
  count(*) FILTER (reasons = '' AND label = 'positive') AS n_positive, count(*) FILTER (reasons = '' AND label = 'neutral') AS n_neutral,
  count(*) FILTER (reasons = '' AND label = 'negative') AS n_negative, 0 AS n_mixed FROM eligible GROUP BY org)
SELECT *, CASE WHEN independent_sources >= 2 THEN 'available' ELSE 'abstain' END AS status,
  CASE WHEN independent_sources < 2 THEN NULL WHEN n_positive > 0 AND n_negative > 0 THEN 'mixed' WHEN n_positive > 0 THEN 'positive'
       WHEN n_negative > 0 THEN 'negative' ELSE 'neutral' END AS label FROM agg""",
)
def company_sentiment(spark, sf):
    return op.company_sentiment(_news_items(spark, sf))


@bind(
    "headline_rollup",
    "D8",
    f"""WITH {NEWS_SQL}, named AS (SELECT org, label FROM news) SELECT org, count(*) AS items,
  CASE WHEN count(DISTINCT label) FILTER (label <> 'neutral') > 1 THEN 'mixed' ELSE coalesce(min(label) FILTER (label <> 'neutral'), 'neutral') END AS label FROM named GROUP BY org""",
)
def headline_rollup(spark, sf):
    return op.headline_rollup(_news_items(spark, sf))


GOLD_SQL = (
    f"WITH {NEWS_SQL}"
    + """, gold AS (SELECT doc_id::VARCHAR AS id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS actual FROM labels),
pairs AS (SELECT g.*, p.label AS predicted, p.exact_entity, p.source_class, p.reasons FROM gold g LEFT JOIN eligible p USING (id)),
t AS (SELECT count(*)::DOUBLE AS gold_items, count(predicted)::DOUBLE AS published, count(*) FILTER (predicted = actual) AS correct,
  count(*) FILTER (predicted IS NOT NULL AND NOT exact_entity) AS wrong_entity, count(*) FILTER (predicted IS NOT NULL AND reasons = '') AS supported,
  count(*) FILTER (source_class = 'company_owned') AS company_owned,
"""
    + ", ".join(
        f"count(*) FILTER (actual = '{n}' AND predicted = '{n}') AS tp_{n}, count(*) FILTER (actual <> '{n}' AND predicted = '{n}') AS fp_{n}, "
        f"count(*) FILTER (actual = '{n}')::DOUBLE AS support_{n}"
        for n in ("positive", "neutral", "negative", "mixed")
    )
    + " FROM pairs), pr AS (SELECT *, "
    + ", ".join(
        f"coalesce(tp_{n} / nullif(tp_{n} + fp_{n}, 0), 0.0) AS precision_{n}, coalesce(tp_{n} / nullif(support_{n}, 0), 0.0) AS recall_{n}"
        for n in ("positive", "neutral", "negative", "mixed")
    )
    + " FROM t), f AS (SELECT *, "
    + ", ".join(
        f"coalesce(2 * precision_{n} * recall_{n} / nullif(precision_{n} + recall_{n}, 0), 0.0) AS f1_{n}"
        for n in ("positive", "neutral", "negative", "mixed")
    )
    + " FROM pr) "
)


@bind(
    "evaluate_predictions",
    "D9",
    GOLD_SQL
    + """SELECT gold_items, published, correct, wrong_entity, supported, company_owned, support_positive, support_neutral, support_negative,
  round(precision_positive, 9) AS precision_positive, round(recall_negative, 9) AS recall_negative, round(f1_neutral, 9) AS f1_neutral,
  round(correct / gold_items, 9) AS accuracy, round((f1_positive + f1_neutral + f1_negative) / 3, 9) AS macro_f1, round(published / gold_items, 9) AS coverage,
  FALSE AS qualification_passed FROM f""",
)
def evaluate_predictions(spark, sf):
    gold = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral").alias("label"),
    )
    report = op.evaluate_predictions(gold, _news_items(spark, sf))
    rounded = ["precision_positive", "recall_negative", "f1_neutral", "accuracy", "macro_f1", "coverage"]
    return report.select(
        "gold_items", "published", "correct", "wrong_entity", "supported", "company_owned", "support_positive", "support_neutral",
        "support_negative", *[F.round(c, 9).alias(c) for c in rounded], "qualification_passed",
    )


def _marks(spark, sf):
    return table(spark, sf, "labels").select(
        F.concat(F.lit("obs-"), F.col("doc_id").cast("string")).alias("id"), (F.col("quality") == 1).alias("exact_entity"),
        (F.col("toxic") == 0).alias("metric_correct"), (F.col("quality") == 1).alias("sentiment_correct"),
    )


@bind(
    "audit_observations",
    "D10",
    RATED_SQL
    + f""", {PROFILES_SQL}, marks AS (SELECT 'obs-' || doc_id AS id, quality = 1 AS me, toxic = 0 AS mm FROM labels),
a AS (SELECT count(*) AS observations, count(me) AS audited, count(*) FILTER (reasons = '' AND me IS NOT NULL) AS published,
  count(*) FILTER (reasons = '' AND NOT me) AS wrong_entity, count(*) FILTER (reasons = '' AND NOT mm) AS wrong_metric,
  count(*) FILTER (reasons = '' AND me IS NOT NULL AND sentiment_label IS NOT NULL) AS sentiment_audited,
  count(*) FILTER (reasons = '' AND me AND sentiment_label IS NOT NULL) AS sentiment_correct FROM rated LEFT JOIN marks USING (id)),
p AS (SELECT org, count(DISTINCT platform) AS n, bool_or(signal_type = 'job_posting') AS w, bool_or(signal_type = 'review') AS r,
  bool_or(signal_type IN ('public_post', 'public_mention')) AS b, bool_or(sentiment_label IS NOT NULL) AS s FROM ok GROUP BY org),
c AS (SELECT count(*) AS profiles, count(*) FILTER (n >= 1) / count(*) AS any_external, count(*) FILTER (n >= 2) / count(*) AS two_platforms,
  count(*) FILTER (w) / count(*) AS workforce_jobs, count(*) FILTER (r) / count(*) AS ratings_reviews, count(*) FILTER (b) / count(*) AS buzz_engagement,
  count(*) FILTER (s) / count(*) AS sentiment FROM profiles LEFT JOIN p USING (org))
SELECT a.*, c.profiles, round(any_external, 9) AS any_external, round(two_platforms, 9) AS two_platforms, round(workforce_jobs, 9) AS workforce_jobs,
  round(ratings_reviews, 9) AS ratings_reviews, round(buzz_engagement, 9) AS buzz_engagement, round(sentiment, 9) AS sentiment,
  round(CASE WHEN published > 0 THEN (published - wrong_entity) / published ELSE 0 END, 9) AS entity_precision,
  round(CASE WHEN published > 0 THEN (published - wrong_metric) / published ELSE 0 END, 9) AS metric_precision,
  (SELECT count(*) FROM labels) AS labels, (SELECT count(*) FROM labels) >= 100 AS audit_size_gate FROM a, c""",
)
def audit_observations(spark, sf):
    row = op.audit_observations(views.observations(spark, sf), _marks(spark, sf), views.profiles(spark, sf))
    shares = ["any_external", "two_platforms", "workforce_jobs", "ratings_reviews", "buzz_engagement", "sentiment", "entity_precision", "metric_precision"]
    return row.select(
        "observations", "audited", "published", "wrong_entity", "wrong_metric", "sentiment_audited", "sentiment_correct", "profiles",
        "labels", "audit_size_gate", *[F.round(c, 9).alias(c) for c in shares],
    )


def _sites(spark, sf):
    return views.profiles(spark, sf).select("org", F.col("website").isNotNull().alias("publishable"))


SCORE_SQL = (
    FOOTPRINT_SQL
    + f""", {PROFILES_SQL}, ex AS (SELECT *, acquisition_mode = 'jobspy_experiment' AND exact_entity AND has_proof AS x FROM rated),
s AS (SELECT e.org, count(*) FILTER (reasons = '') AS accepted, count(*) FILTER (x) AS experimental,
  count(DISTINCT platform) FILTER (reasons = '' AND signal_type = 'profile_handle') AS h,
  count(DISTINCT platform) FILTER ((reasons = '' OR x) AND signal_type = 'profile_handle') AS xh,
  bool_or(reasons = '' AND signal_type = 'review') AS rv, bool_or((reasons = '' OR x) AND signal_type = 'review') AS xrv,
  bool_or(reasons = '' AND signal_type = 'job_posting') AS jb, bool_or((reasons = '' OR x) AND signal_type = 'job_posting') AS xjb,
  bool_or(reasons = '' AND signal_type IN ('public_post', 'public_mention')) AS bz, bool_or((reasons = '' OR x) AND signal_type IN ('public_post', 'public_mention')) AS xbz,
  count(*) FILTER (x AND sentiment_label IS NOT NULL) AS xi, count(DISTINCT host) FILTER (x AND sentiment_label IS NOT NULL) AS xho,
  count(DISTINCT reviewer_id) FILTER (x AND sentiment_label IS NOT NULL) AS xre FROM ex e GROUP BY e.org),
j AS (SELECT s.*, coalesce(p.website IS NOT NULL, FALSE) AS idok, (f.sentiment_items >= 10 AND (f.sentiment_sources >= 2 OR f.sentiment_reviewers >= 10)) AS ready
  FROM s JOIN foot f USING (org) LEFT JOIN profiles p USING (org)),
scored AS (SELECT org, accepted, experimental,
  CASE WHEN idok AND accepted > 0 THEN 20.0 ELSE 0.0 END AS exact_external_identity, least(15.0, h * 5.0) AS verified_handles, 0.0 AS profile_metrics, 0.0 AS places_identity,
  CASE WHEN rv THEN 10.0 ELSE 0.0 END AS places_reviews, CASE WHEN jb THEN 10.0 ELSE 0.0 END AS workforce_jobs, CASE WHEN bz THEN 10.0 ELSE 0.0 END AS public_buzz,
  CASE WHEN ready THEN 15.0 ELSE 0.0 END AS independent_sentiment, CASE WHEN accepted > 0 THEN 5.0 ELSE 0.0 END AS freshness_evidence,
  CASE WHEN idok AND accepted + experimental > 0 THEN 20.0 ELSE 0.0 END + least(15.0, xh * 5.0) + CASE WHEN xrv THEN 10.0 ELSE 0.0 END + CASE WHEN xjb THEN 10.0 ELSE 0.0 END
    + CASE WHEN xbz THEN 10.0 ELSE 0.0 END + CASE WHEN ready OR (xi >= 10 AND (xho >= 2 OR xre >= 10)) THEN 15.0 ELSE 0.0 END + CASE WHEN accepted > 0 THEN 5.0 ELSE 0.0 END AS potential_score
  FROM j),
total AS (SELECT *, exact_external_identity + verified_handles + places_reviews + workforce_jobs + public_buzz + independent_sentiment + freshness_evidence AS score FROM scored)
"""
)


POINTS = [
    "exact_external_identity", "verified_handles", "profile_metrics", "places_identity", "places_reviews", "workforce_jobs", "public_buzz",
    "independent_sentiment", "freshness_evidence", "score", "potential_score",
]


@bind("development_score", "D11", SCORE_SQL + "SELECT org, accepted, experimental, " + ", ".join(f"{c}::DOUBLE AS {c}" for c in POINTS) + " FROM total")
def development_score(spark, sf):
    return op.development_score(views.observations(spark, sf), _sites(spark, sf), AS_OF)


def _foundation(spark, sf):
    p = views.profiles(spark, sf)
    return p.select(
        "org", F.lit(True).alias("official_identity"), (F.col("revenue") > 0).alias("annual_accounts"),
        F.col("employees").isNotNull().alias("roles"), (F.col("legal_form") != "ENK").alias("locations"),
        F.col("website").isNotNull().alias("website_terminal_state"),
    )


COMPLETE_SQL = (
    SCORE_SQL
    + """, comp AS (SELECT t.org, CASE WHEN p.org IS NULL THEN 0 ELSE 5 + CASE WHEN p.revenue > 0 THEN 10 ELSE 0 END + CASE WHEN p.employees IS NOT NULL THEN 5 ELSE 0 END
   + CASE WHEN p.legal_form <> 'ENK' THEN 5 ELSE 0 END + CASE WHEN p.website IS NOT NULL THEN 5 ELSE 0 END END AS foundation_score,
  round(8 * exact_external_identity / 20, 3) + round(8 * verified_handles / 15, 3) + round(8 * places_reviews / 10, 3) + round(8 * workforce_jobs / 10, 3)
   + round(8 * public_buzz / 10, 3) + round(12 * independent_sentiment / 15, 3) + round(6 * freshness_evidence / 5, 3) AS enrich, p.legal_form, verified_handles
  FROM total t LEFT JOIN profiles p USING (org))
"""
)


@bind("completeness", "D12", COMPLETE_SQL + "SELECT org, foundation_score, round(foundation_score + enrich, 3) AS completeness_score FROM comp")
def completeness(spark, sf):
    scores = op.development_score(views.observations(spark, sf), _sites(spark, sf), AS_OF)
    return op.completeness(_foundation(spark, sf), scores).select("org", "foundation_score", "completeness_score")


@bind(
    "summarize_completeness",
    "D12",
    COMPLETE_SQL
    + """SELECT legal_form, count(*) AS companies, round(avg(foundation_score), 3) AS foundation_mean, round(avg(round(foundation_score + enrich, 3)), 3) AS completeness_mean,
  count(*) FILTER (foundation_score + enrich >= 49.9999) AS at_50, count(*) FILTER (foundation_score + enrich >= 64.9999) AS at_65,
  round(count(*) FILTER (verified_handles > 0) / count(*), 4) AS cover_verified_handles FROM comp GROUP BY legal_form""",
)
def summarize_completeness(spark, sf):
    scores = op.development_score(views.observations(spark, sf), _sites(spark, sf), AS_OF)
    rows = op.completeness(_foundation(spark, sf), scores).join(views.profiles(spark, sf).select("org", "legal_form"), "org", "left")
    return op.summarize_completeness(rows, "legal_form").select(
        "legal_form", "companies", "foundation_mean", "completeness_mean", "at_50", "at_65", "cover_verified_handles"
    )


RUBRIC_FACTS = """
facts AS (SELECT TRUE AS ok, c.two_platforms, c.workforce_jobs, c.ratings_reviews, c.buzz_engagement, c.sentiment, r.fin, r.rl, r.web FROM
  (SELECT count(*) FILTER (n >= 2) / count(*) AS two_platforms, count(*) FILTER (w) / count(*) AS workforce_jobs, count(*) FILTER (rr) / count(*) AS ratings_reviews,
     count(*) FILTER (b) / count(*) AS buzz_engagement, count(*) FILTER (s) / count(*) AS sentiment FROM profiles LEFT JOIN
     (SELECT org, count(DISTINCT platform) AS n, bool_or(signal_type = 'job_posting') AS w, bool_or(signal_type = 'review') AS rr,
        bool_or(signal_type IN ('public_post', 'public_mention')) AS b, bool_or(sentiment_label IS NOT NULL) AS s FROM ok GROUP BY org) USING (org)) c,
  (SELECT count(*) FILTER (revenue > 0) / count(*) AS fin, count(*) FILTER (employees IS NOT NULL AND legal_form <> 'ENK') / count(*) AS rl,
     count(*) FILTER (website IS NOT NULL) / count(*) AS web FROM profiles) r)
"""


@bind(
    "weighted_rubric",
    "D13",
    RATED_SQL
    + f", {PROFILES_SQL}, {RUBRIC_FACTS}"
    + """, pts AS (SELECT round(10 + round(10 * two_platforms, 3) + round(7 * workforce_jobs, 3) + round(8 * ratings_reviews, 3) + round(7 * buzz_engagement, 3) + 3 + round(10 * sentiment, 3), 3) AS external_points,
  round(4 + round(4 * fin, 3) + round(4 * rl, 3) + round(3 * web, 3), 3) AS foundation_points FROM facts)
SELECT external_points, foundation_points, 7.5::DOUBLE AS research_points, 12.0::DOUBLE AS extensibility_points, round(external_points + foundation_points + 19.5, 3) AS raw_score FROM pts""",
)
def weighted_rubric(spark, sf):
    audit = op.audit_observations(views.observations(spark, sf), _marks(spark, sf), views.profiles(spark, sf))
    f = _foundation(spark, sf)

    def share(test):
        return F.count_if(F.coalesce(test, F.lit(False))) / F.count(F.lit(1))

    base = f.agg(
        share(F.col("official_identity")).alias("exact_registry"), share(F.col("annual_accounts")).alias("financial_share"),
        share(F.col("roles") & F.col("locations")).alias("roles_locations_share"), share(F.col("website_terminal_state")).alias("website_terminal_share"),
    )
    yes = F.lit(True)
    facts = with_totals(audit, base).withColumns(
        {"qualification_passed": yes, "wrong_entity": F.lit(0), "published": F.lit(1), "fresh_coverage": F.lit(1.0), "sentiment_passed": yes,
         "research_score": F.lit(9.0), "external_qa_passed": yes, "batch_valid": yes, "resume_valid": yes, "refresh_valid": yes,
         "p95_ms": F.lit(100.0), "connector_policy": yes}
    )
    return op.weighted_rubric(facts).select("external_points", "foundation_points", "research_points", "extensibility_points", "raw_score")


@bind(
    "observation_counts",
    "D10",
    RATED_SQL
    + """, g AS (SELECT platform, acquisition_mode, signal_type, org, reasons = '' AS good FROM rated)
SELECT CASE GROUPING(platform, acquisition_mode, signal_type) WHEN 3 THEN 'platform' WHEN 5 THEN 'acquisition_mode' WHEN 6 THEN 'signal_type' WHEN 0 THEN 'combination' ELSE 'all' END AS dimension,
  platform, acquisition_mode, signal_type, count(*) AS observations, count(*) FILTER (good) AS accepted, count(DISTINCT org) AS entities, count(DISTINCT org) FILTER (good) AS accepted_entities
FROM g GROUP BY GROUPING SETS ((platform), (acquisition_mode), (signal_type), (platform, acquisition_mode, signal_type), ())""",
)
def observation_counts(spark, sf):
    return op.observation_counts(views.observations(spark, sf))


PART_SQL = COMPLETE_SQL + """, parts AS (SELECT org, CASE WHEN org < '000000075' THEN 'base' ELSE 'extension' END AS part, foundation_score, round(foundation_score + enrich, 3) AS score FROM comp)
"""


def _parts(spark, sf):
    """Scored companies, the lower numbers as the base and the others as its extension."""
    scores = op.development_score(views.observations(spark, sf), _sites(spark, sf), AS_OF)
    rows = op.completeness(_foundation(spark, sf), scores)
    return rows.withColumn("part", F.when(F.col("org") < "000000075", "base").otherwise("extension"))


@bind(
    "completeness_distribution",
    "D12",
    PART_SQL + "SELECT part, score AS completeness_score, count(*) AS companies FROM parts GROUP BY ALL UNION ALL SELECT 'combined', score, count(*) FROM parts GROUP BY ALL",
)
def completeness_distribution(spark, sf):
    return op.completeness_distribution(_parts(spark, sf), "part")


@bind(
    "completeness_transfer",
    "D12",
    PART_SQL
    + """, m AS (SELECT coalesce(round(avg(score) FILTER (part = 'base'), 3), 0) AS b, coalesce(round(avg(score) FILTER (part = 'extension'), 3), 0) AS e FROM parts)
SELECT b AS strict_base_mean, e AS strict_extension_mean, round(e - b, 3) AS strict_mean_delta, CASE WHEN b <> 0 THEN round(e / b, 4) END AS strict_retention FROM m""",
)
def completeness_transfer(spark, sf):
    return op.completeness_transfer(_parts(spark, sf), "part", "base", "extension")


def _verdicts(spark, sf):
    """Register sites with a verdict: the smallest entities' sites name someone else."""
    p = views.profiles(spark, sf)
    small = F.coalesce("employees", F.lit(0)) < 55
    return p, p.select("org", F.col("website").alias("site_url"), (~small).alias("publishable"), (F.col("legal_form") == "AS").alias("content_attributable"), F.when(small, F.array(F.lit("name not on page"))).otherwise(F.array().cast("array<string>")).alias("reasons"))


@bind(
    "gate_rejections",
    "D15",
    f"WITH {PROFILES_SQL} SELECT org, name, website AS url, 'name not on page' AS reasons FROM profiles WHERE website IS NOT NULL AND coalesce(employees, 0) < 55",
)
def gate_rejections(spark, sf):
    return op.gate_rejections(*_verdicts(spark, sf)).withColumn("reasons", F.array_join("reasons", "; "))


@bind(
    "site_gate_counts",
    "D15",
    f"""WITH {PROFILES_SQL} SELECT count(*) FILTER (employees >= 55) AS common_gate_websites, count(*) FILTER (employees >= 55 AND legal_form = 'AS') AS common_gate_content_sites,
  count(*) FILTER (coalesce(employees, 0) < 55) AS common_gate_rejections FROM profiles WHERE website IS NOT NULL""",
)
def site_gate_counts(spark, sf):
    return op.site_gate_counts(_verdicts(spark, sf)[1])


@bind(
    "evidence_audit",
    "D15",
    RATED_SQL
    + f""", {PROFILES_SQL}, q AS (SELECT r.* FROM rated r LEFT JOIN profiles p USING (org)
   WHERE exact_entity AND rights_status = 'approved' AND has_proof AND (
     NOT (platform = 'company_site' OR (platform = 'news' AND source_class LIKE 'company\\_%' ESCAPE '\\') OR signal_type = 'profile_handle') OR coalesce(p.website IS NOT NULL, FALSE))),
d AS (SELECT source_url FROM q WHERE signal_type IN ('profile_handle', 'public_post', 'job_posting') GROUP BY 1 HAVING count(DISTINCT org) > 1),
k AS (SELECT * FROM q WHERE source_url NOT IN (SELECT source_url FROM d)),
o AS (SELECT org, count(DISTINCT platform) AS n, count(*) FILTER (signal_type = 'profile_handle') AS h, count(*) FILTER (platform IN ('company_site', 'news') AND signal_type IN ('public_post', 'public_mention')) AS nw,
  count(*) FILTER (sentiment_label IS NOT NULL AND source_class IN ('customer_review', 'public_news') AND sentiment_model_version IS NOT NULL) AS s FROM k GROUP BY org)
SELECT count(*) FILTER (h > 0) AS companies_with_social, count(*) FILTER (nw > 0) AS companies_with_dated_news, count(*) FILTER (s > 0) AS companies_with_sentiment,
  count(*) FILTER (n >= 2) AS companies_with_two_sources, sum(nw)::BIGINT AS dated_news_items, (SELECT count(*) FROM d) AS disputed_urls,
  (SELECT count(*) FROM rated WHERE signal_type = 'job_posting') AS misclassified_job_items FROM o""",
)
def evidence_audit(spark, sf):
    sites = _sites(spark, sf).withColumnRenamed("publishable", "content_attributable")
    return op.evidence_audit(views.observations(spark, sf), sites, AS_OF).select(
        "companies_with_social", "companies_with_dated_news", "companies_with_sentiment", "companies_with_two_sources",
        "dated_news_items", "disputed_urls", "misclassified_job_items",
    )


EVENT_FAMILIES = [
    ("view", "company_site", "company_profile", "company_site"),
    ("purchase", "google_places", "place_summary", "customer_review"),
    ("click", "news", "public_mention", "public_news"),
]


@bind(
    "claims_to_observations",
    "D21",
    f"""WITH {CLAIMS_SQL}, {EVIDENCE_SQL}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org, claim_key ORDER BY CASE WHEN availability = 'available' THEN 0 ELSE 1 END, confidence DESC, pos) AS rn,
   min(pos) OVER (PARTITION BY org, claim_key) AS first_pos FROM claims) WHERE rn = 1),
fam(field, platform, signal_type, source_class) AS (VALUES ('view', 'company_site', 'company_profile', 'company_site'), ('purchase', 'google_places', 'place_summary', 'customer_review'), ('click', 'news', 'public_mention', 'public_news')),
ranked AS (SELECT b.org, b.claim_key, f.*, row_number() OVER (PARTITION BY b.org, b.field ORDER BY first_pos) AS place FROM best b JOIN fam f ON f.field = b.field WHERE availability = 'available'),
firstev AS (SELECT org, claim_key, arg_min(ev_id, pos) AS ev_id FROM claims GROUP BY ALL)
SELECT 'obs-' || platform || '-' || signal_type || '-' || r.org || CASE WHEN place > 1 THEN '-' || (place - 1) ELSE '' END AS id, r.org, platform, signal_type, e.source_url, e.content_sha256, r.source_class
FROM ranked r JOIN firstev f ON f.org = r.org AND f.claim_key = r.claim_key JOIN evidence e ON e.id = f.ev_id""",
)
def claims_to_observations(spark, sf):
    from attesta.operators import claims as claim_op

    claims = views.claims(spark, sf)
    best = claim_op.dedupe_claims(claims)
    rows = op.claims_to_observations(best, claim_op.claim_links(claims), views.evidence(spark, sf), EVENT_FAMILIES)
    return rows.select("id", "org", "platform", "signal_type", "source_url", "content_sha256", "source_class")
