"""Sentences, answers and cards over events, customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import narrative as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.claim_queries import BEST_SQL, _held
from attesta.plans.screen_queries import screen_profiles
from attesta.plans.views import OBSERVATIONS_SQL, PROFILES_SQL
from attesta.sources import official


def _stated(spark, sf):
    """Event claims under the field names sentences use."""
    held, _ = _held(spark, sf)
    field = F.col("field")
    renamed = (
        F.when(field == "view", "employees").when(field == "signup", "website").when(field == "click", "revenue").when(field == "purchase", "active_job_count").otherwise("founded_at")
    )
    value = F.when(field == "click", F.concat(F.lit('{"amount":'), F.floor(F.col("value").cast("double")).cast("string"), F.lit("}"))).when(field == "purchase", F.format_string("%d", F.floor(F.col("value").cast("double")).cast("int"))).otherwise(F.col("value"))
    return held.withColumns({"value": value, "field": renamed})


@bind(
    "synthesise",
    "D23",
    BEST_SQL
    + """, s AS (SELECT org, arg_min(value, first_pos) FILTER (field = 'view' AND availability = 'available') AS emp, arg_min(value, first_pos) FILTER (field = 'signup' AND availability = 'available') AS site,
  arg_min(floor(value::DOUBLE)::INTEGER, first_pos) FILTER (field = 'purchase' AND availability = 'available') AS jobs, arg_min(value, first_pos) FILTER (field = 'error' AND availability = 'available') AS founded,
  arg_min(floor(value::DOUBLE)::BIGINT, first_pos) FILTER (field = 'click' AND availability = 'available') AS rev, arg_min(CASE WHEN claim_key LIKE '%|2024' THEN '2024' ELSE '' END, first_pos) FILTER (field = 'click' AND availability = 'available') AS per,
  bool_or(field = 'signup' AND availability <> 'not_applicable') AS cs, bool_or(field = 'click' AND availability <> 'not_applicable') AS cr, bool_or(field = 'purchase' AND availability <> 'not_applicable') AS cj FROM held GROUP BY org),
gaps AS (SELECT org, nullif(concat_ws(', ', CASE WHEN site IS NULL AND cs THEN 'a verified official website' END, CASE WHEN rev IS NULL AND cr THEN 'latest annual revenue' END, CASE WHEN jobs IS NULL AND cj THEN 'a current hiring signal' END), '') AS gap FROM s)
SELECT org, 'In ' || per || ', revenue was NOK ' || replace(format('{:,}', rev), ',', ' ') || '.' AS text, FALSE AS growth_signal FROM s WHERE rev IS NOT NULL
UNION ALL SELECT org, 'Not established from the checked sources: ' || gap || '.', FALSE FROM gaps WHERE gap IS NOT NULL
UNION ALL SELECT org, 'Customer (org. no. ' || org || ') is a registered company.', FALSE FROM s
UNION ALL SELECT org, 'It is registered ' || substr(founded, 1, 10) || '.', FALSE FROM s WHERE founded IS NOT NULL
UNION ALL SELECT org, 'The register records ' || emp || ' employees.', FALSE FROM s WHERE emp IS NOT NULL
UNION ALL SELECT org, 'Its verified website is ' || site || '.', FALSE FROM s WHERE site IS NOT NULL
UNION ALL SELECT org, 'It appears to be hiring: ' || jobs || ' active job posting' || CASE WHEN jobs <> 1 THEN 's' ELSE '' END || ' on the public job board.', TRUE FROM s WHERE jobs > 0""",
)
def synthesise(spark, sf):
    claims = _stated(spark, sf)
    names = claims.select("org").distinct().withColumn("input_name", F.lit("Customer"))
    return op.synthesise(claims, names).select("org", "text", "growth_signal")


@bind(
    "summaries",
    "D23",
    BEST_SQL
    + """, s AS (SELECT org, arg_min(value, first_pos) FILTER (field = 'view' AND availability = 'available') AS emp, arg_min(value, first_pos) FILTER (field = 'signup' AND availability = 'available') AS site,
  arg_min(floor(value::DOUBLE)::INTEGER, first_pos) FILTER (field = 'purchase' AND availability = 'available') AS jobs, arg_min(value, first_pos) FILTER (field = 'error' AND availability = 'available') AS founded,
  arg_min(floor(value::DOUBLE)::BIGINT, first_pos) FILTER (field = 'click' AND availability = 'available') AS rev, arg_min(CASE WHEN claim_key LIKE '%|2024' THEN '2024' ELSE '' END, first_pos) FILTER (field = 'click' AND availability = 'available') AS per,
  bool_or(field = 'signup' AND availability <> 'not_applicable') AS cs, bool_or(field = 'click' AND availability <> 'not_applicable') AS cr, bool_or(field = 'purchase' AND availability <> 'not_applicable') AS cj FROM held GROUP BY org),
l AS (SELECT org, list_filter(['Customer (org. no. ' || org || ') is a registered company.', 'It is registered ' || substr(founded, 1, 10) || '.', 'The register records ' || emp || ' employees.',
   'In ' || per || ', revenue was NOK ' || replace(format('{:,}', rev), ',', ' ') || '.', 'Its verified website is ' || site || '.',
   CASE WHEN jobs > 0 THEN 'It appears to be hiring: ' || jobs || ' active job posting' || CASE WHEN jobs <> 1 THEN 's' ELSE '' END || ' on the public job board.' END,
   'Not established from the checked sources: ' || nullif(concat_ws(', ', CASE WHEN site IS NULL AND cs THEN 'a verified official website' END, CASE WHEN rev IS NULL AND cr THEN 'latest annual revenue' END, CASE WHEN jobs IS NULL AND cj THEN 'a current hiring signal' END), '') || '.'], lambda x: x IS NOT NULL) AS t FROM s)
SELECT org, array_to_string(t, ' ') AS summary, len(t) AS sentences FROM l""",
)
def summaries(spark, sf):
    claims = _stated(spark, sf)
    return op.summaries(op.synthesise(claims, claims.select("org").distinct().withColumn("input_name", F.lit("Customer"))))


def _facts(spark, sf):
    profiles = screen_profiles(spark, sf)
    newest = official.normalize_accounts(views.accounts(spark, sf), keep=1).withColumn("period", F.col("period_to").cast("string"))
    none = F.lit(None).cast("string")
    supplier, own = table(spark, sf, "supplier"), views.padded(F.col("s_suppkey"))
    held = F.array(
        F.struct(F.lit(1).alias("pos"), F.col("s_name").alias("name"), none.alias("holder_org"), F.lit("Styreleder").alias("role"), F.lit(False).alias("inactive")),
        F.struct(F.lit(2).alias("pos"), none.alias("name"), views.padded(F.col("s_nationkey")).alias("holder_org"), F.when(F.col("s_acctbal") > 5000, "Regnskapsfører").alias("role"), (F.col("s_acctbal") < 0).alias("inactive")),
    )
    roles = supplier.select(own.alias("org"), F.inline(held), F.lit("Andre roller").alias("group_name"))
    locations = table(spark, sf, "orders").select(views.padded(F.col("o_custkey")).alias("org"), views.padded(F.col("o_orderkey")).alias("subunit_org"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"))
    links = F.array().cast("array<struct<platform:string,url:string>>")
    sites = profiles.filter("website IS NOT NULL").select("org", (F.col("annual_result") > 7000).alias("publishable"), F.col("name").alias("description"), links.alias("links"))
    register = profiles.select("org", F.lit("registry").alias("module"), F.concat(F.lit("register/"), "org").alias("source_url"), F.lit("2002-01-01").alias("retrieved_at"), F.sha2("name", 256).alias("content_sha256"))
    books = newest.select("org", F.lit("financials"), F.concat(F.lit("accounts/"), F.col("record_id").cast("string")), F.lit("2002-01-01"), F.sha2(F.col("record_id").cast("string"), 256))
    facts = op.profile_facts(profiles, newest, roles, locations, sites, views.observations(spark, sf), register.unionAll(books))
    return facts, sites, profiles


def _questions(profiles):
    """Two questions per profile: on a topic chosen by its legal form, and on its roles."""
    form = F.col("legal_form")
    text = (
        F.when(form == "AS", "What revenue did it report?").when(form == "BRL", "Where is it located?").when(form == "ASA", "Any news or reviews?")
        .when(form == "ENK", "How many employees are there?").otherwise("Tell me about sentiment")
    )
    asked = F.array(F.struct(F.concat(F.lit("q"), "org").alias("qid"), text.alias("question")), F.struct(F.concat(F.lit("r"), "org").alias("qid"), F.lit("Who has a leading role?").alias("question")))
    return profiles.select("org", F.inline(asked)).select("qid", "org", "question")


ANSWER_SQL = f"""
WITH {PROFILES_SQL}, {OBSERVATIONS_SQL},
latest AS (SELECT * FROM (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, o_orderkey, o_totalprice, o_orderdate::DATE AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, (o_orderstatus <> 'F') DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
u AS (SELECT * FROM (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY lpad(o_orderkey::VARCHAR, 9, '0')) AS rn FROM orders)),
fx AS (
  SELECT org, 'registry' AS topic, 'Registered name' AS claim, name AS value FROM profiles WHERE legal_form = 'ENK' UNION ALL SELECT org, 'registry', 'Organisation number', org FROM profiles WHERE legal_form = 'ENK'
  UNION ALL SELECT org, 'registry', 'Legal form', legal_form FROM profiles WHERE legal_form = 'ENK' UNION ALL SELECT org, 'registry', 'Municipality', municipality FROM profiles WHERE legal_form = 'ENK'
  UNION ALL SELECT org, 'registry', 'Registry employee count', employees::VARCHAR FROM profiles WHERE legal_form = 'ENK' AND employees IS NOT NULL
  UNION ALL SELECT org, 'financials', 'Reporting period', d::VARCHAR FROM latest JOIN profiles USING (org) WHERE legal_form = 'AS'
  UNION ALL SELECT org, 'financials', 'Revenue', o_totalprice::DOUBLE::VARCHAR FROM latest JOIN profiles USING (org) WHERE legal_form = 'AS'
  UNION ALL SELECT org, 'locations', 'Registered subunit', 'Order ' || o_orderkey FROM u JOIN profiles USING (org) WHERE legal_form = 'BRL'
  UNION ALL SELECT o.org, 'external', CASE signal_type WHEN 'review' THEN 'Verified individual review' WHEN 'public_post' THEN 'Dated company news' ELSE 'Verified external evidence' END, source_url FROM observations o JOIN profiles p ON p.org = o.org
    WHERE legal_form = 'ASA' AND exact_entity AND has_proof AND rights_status = 'approved' AND signal_type IN ('review', 'public_post', 'public_mention'))
"""


ROLES_SQL = """, ro AS (SELECT 'r' || org AS qid, org, 'roles' AS topic, claim, value FROM (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, 'Styreleder' AS claim, s_name AS value FROM supplier
  UNION ALL SELECT lpad(s_suppkey::VARCHAR, 9, '0'), CASE WHEN s_acctbal > 5000 THEN 'Regnskapsfører' ELSE 'Andre roller' END, lpad(s_nationkey::VARCHAR, 9, '0') FROM supplier WHERE s_acctbal >= 0) JOIN profiles USING (org))
"""


@bind("answer_questions", "D24", ANSWER_SQL + ROLES_SQL + "SELECT 'q' || org AS qid, topic, claim, value FROM fx UNION ALL SELECT qid, topic, claim, value FROM ro")
def answer_questions(spark, sf):
    facts, _, profiles = _facts(spark, sf)
    answers = op.answer_questions(_questions(profiles), facts)
    return answers.select("qid", "topic", "claim", "value")


@bind(
    "unsupported_answers",
    "D24",
    ANSWER_SQL
    + ROLES_SQL
    + """SELECT 'r' || org AS qid, 'roles' AS topic FROM profiles WHERE org NOT IN (SELECT org FROM ro) UNION ALL SELECT 'q' || org AS qid, 'sentiment' AS topic FROM profiles WHERE legal_form = 'NUF' UNION ALL SELECT 'q' || org, 'external' FROM profiles WHERE legal_form = 'ASA' AND org NOT IN (SELECT org FROM fx WHERE topic = 'external')
UNION ALL SELECT 'q' || org, 'locations' FROM profiles WHERE legal_form = 'BRL' AND org NOT IN (SELECT org FROM fx WHERE topic = 'locations') UNION ALL SELECT 'q' || org, 'financials' FROM profiles WHERE legal_form = 'AS' AND org NOT IN (SELECT org FROM latest)""",
)
def unsupported_answers(spark, sf):
    facts, sites, profiles = _facts(spark, sf)
    asked = _questions(profiles)
    return op.unsupported_answers(asked, op.answer_questions(asked, facts), sites).select("qid", "topic")


@bind(
    "company_cards",
    "D27",
    f"""WITH {PROFILES_SQL}, {OBSERVATIONS_SQL}, k AS (SELECT * FROM observations WHERE exact_entity AND rights_status = 'approved'),
t AS (SELECT org, count(*) AS n, count(DISTINCT platform) AS p FROM k GROUP BY org),
r AS (SELECT *, row_number() OVER (PARTITION BY org, signal_type ORDER BY retrieved_at DESC, id) AS place FROM k WHERE signal_type IN ('public_post', 'job_posting')),
l AS (SELECT org, string_agg(id, ',' ORDER BY place) FILTER (signal_type = 'public_post') AS posts, string_agg(id, ',' ORDER BY place) FILTER (signal_type = 'job_posting') AS jobs FROM r WHERE place <= 10 GROUP BY org)
SELECT p.org, bankrupt OR liquidating AS adverse, coalesce(t.n, 0) AS observations, coalesce(t.p, 0) AS platforms, coalesce(l.posts, '') AS posts, coalesce(l.jobs, '') AS jobs, coalesce(w.people, '') AS people,
  CASE WHEN website IS NOT NULL THEN revenue <= 7000 END AS site_quarantined FROM profiles p LEFT JOIN t USING (org) LEFT JOIN l USING (org)
LEFT JOIN (SELECT org, string_agg('Person ' || event_id, ',' ORDER BY event_id) AS people FROM (SELECT lpad(user_id::VARCHAR, 9, '0') AS org, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events WHERE event_type = 'signup') WHERE place <= 30 GROUP BY org) w USING (org)""",
)
def company_cards(spark, sf):
    profiles = views.profiles(spark, sf)
    events = table(spark, sf, "events").filter("event_type = 'signup'")
    roles = events.select(views.padded(F.col("user_id")).alias("org"), F.col("event_id").alias("pos"), F.concat(F.lit("Person "), F.col("event_id").cast("string")).alias("name"), F.lit("LEDE").alias("role_code"))
    sites = profiles.filter("website IS NOT NULL").select("org", (F.col("revenue") > 7000).alias("publishable"), F.col("name").alias("title"))
    cards = op.company_cards(profiles, views.observations(spark, sf), roles, sites, posts=10, people=30)
    ids = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x["id"]), ","), F.lit(""))
    people = F.coalesce(F.array_join(F.transform("roles", lambda x: x["name"]), ","), F.lit(""))
    return cards.select("org", "adverse", "observations", "platforms", ids("posts").alias("posts"), ids("jobs").alias("jobs"), people.alias("people"), "site_quarantined")
