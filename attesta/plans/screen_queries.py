"""Screens and revenue comparisons over customers and orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from attesta.operators import ranking, screening as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import ACCOUNTS_SQL, PROFILES_SQL
from attesta.session import stored
from attesta.sources import official


def screen_profiles(spark, sf):
    """Profiles with the revenue of their newest own-company account record."""
    latest = official.normalize_accounts(views.accounts(spark, sf), keep=1).select(
        "org", F.col("revenue").alias("latest_revenue"), F.lit(True).alias("financials_ok"), F.col("record_id")
    )
    profiles = views.profiles(spark, sf).withColumnRenamed("revenue", "annual_result")
    return profiles.join(latest, "org", "left").withColumnRenamed("latest_revenue", "revenue").withColumn("website_ok", F.col("website").isNotNull())


SCREEN_SQL = f"""
WITH {PROFILES_SQL}, {ACCOUNTS_SQL},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY period_to DESC, (account_type <> 'KONSERN') DESC, record_id DESC) AS rn FROM accounts) WHERE rn = 1),
rows AS (SELECT p.org, p.name, p.municipality, p.legal_form, p.employees, p.revenue AS annual_result, p.website, l.revenue, l.record_id, l.org IS NOT NULL AS financials_ok,
  p.industry_code || ' ' || p.industry_label AS industry FROM profiles p LEFT JOIN latest l USING (org))
"""
FILTERS = [("municipality", "eq", "nation_3"), ("revenue", ">", 100000.0)]
SORT = ("revenue", 10)


def _module_evidence(profiles):
    """The register row, the account record and the site each profile rests on."""
    register = profiles.select("org", F.lit("registry").alias("module"), F.concat(F.lit("register/"), "org").alias("source_url"), F.sha2(F.col("name"), 256).alias("content_sha256"))
    books = profiles.filter("financials_ok").select(
        "org", F.lit("financials"), F.concat(F.lit("accounts/"), F.col("record_id").cast("string")), F.sha2(F.col("record_id").cast("string"), 256)
    )
    sites = profiles.filter("website_ok").select("org", F.lit("website"), F.concat(F.lit("site/"), "org"), F.sha2("website", 256))
    return register.unionAll(books).unionAll(sites).withColumn("retrieved_at", F.lit("2002-01-01"))


@bind(
    "screen_with_citations",
    "B12 E14 A13",
    SCREEN_SQL
    + """, hit AS (SELECT * FROM rows WHERE lower(municipality) = 'nation_3' AND revenue > 100000 ORDER BY revenue DESC, org LIMIT 10)
SELECT org, name, revenue, 'financials' AS module, 'accounts/' || record_id AS source_url, sha256(record_id::VARCHAR) AS content_sha256 FROM hit
UNION ALL SELECT org, name, revenue, 'registry', 'register/' || org, sha256(name) FROM hit""",
)
def screen_with_citations(spark, sf):
    profiles = screen_profiles(spark, sf)
    hits = op.screen(profiles, FILTERS, SORT)
    cited = op.with_citations(hits, _module_evidence(profiles), op.cited_modules(FILTERS, SORT))
    return cited.select("org", "name", "revenue", "module", "source_url", "content_sha256")


@bind(
    "screen_filters",
    "B12",
    SCREEN_SQL + "SELECT org, employees, annual_result FROM rows WHERE legal_form = 'AS' AND employees >= 20 AND annual_result > 0 AND website IS NOT NULL AND contains(lower(industry), 'mach')",
)
def screen_filters(spark, sf):
    filters = [("legal_form", "eq", "as"), ("employees", ">=", 20), ("annual_result", ">", 0), ("website", "present", True), ("industry", "contains", "MACH")]
    return op.screen(screen_profiles(spark, sf), filters).select("org", "employees", "annual_result")


@bind(
    "screen_question",
    "B13 B12 E14",
    SCREEN_SQL + "SELECT org, employees, revenue FROM rows WHERE upper(municipality) = 'NATION_7' AND employees > 10 AND annual_result > 0 ORDER BY employees DESC, org LIMIT 25".replace("upper(municipality) = 'NATION_7' AND ", ""),
)
def screen_question(spark, sf):
    question = "Profitable companies having more than 10 registered employees, top 25 by employees"
    return op.answer_screen(screen_profiles(spark, sf), question).select("org", "employees", "revenue")


@bind(
    "planned_screens",
    "B13",
    """SELECT 'companies with over ' || (c_custkey % 50) || ' employees and revenue at least ' || c_nationkey || ' million' AS query,
  'employees > ' || (c_custkey % 50) || ', revenue >= ' || c_nationkey || '000000.0' AS plan, TRUE AS executable FROM customer WHERE c_nationkey > 0
UNION ALL SELECT 'companies with over ' || (c_custkey % 50) || ' employees and revenue at least ' || c_nationkey || ' million', 'employees > ' || (c_custkey % 50) || ', revenue >= 0.0', TRUE FROM customer WHERE c_nationkey = 0""",
)
def planned_screens(spark, sf):
    asked = table(spark, sf, "customer").select(
        F.format_string("companies with over %d employees and revenue at least %d million", F.col("c_custkey") % 50, F.col("c_nationkey")).alias("query")
    )
    planned = op.plan_screens(asked)

    def shown(f):
        value = F.when(f["field"] == "revenue", F.format_string("%.1f", f["value"].cast("double"))).otherwise(f["value"])
        return F.concat_ws(" ", f["field"], f["operator"], value)

    return planned.select("query", F.array_join(F.transform("filters", shown), ", ").alias("plan"), "executable")


@bind(
    "revenue_comparison",
    "E7",
    f"""WITH {ACCOUNTS_SQL},
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY period_to DESC, (account_type <> 'KONSERN') DESC, record_id DESC) AS rn FROM accounts) WHERE rn = 1),
p AS (SELECT * FROM (SELECT a.*, row_number() OVER (PARTITION BY a.org ORDER BY a.period_to DESC, a.record_id DESC) AS rn FROM accounts a JOIN l USING (org)
   WHERE a.account_type = l.account_type AND a.period_to < l.period_to) WHERE rn = 1),
j AS (SELECT l.org, l.period_to AS lp, p.period_to AS pp, l.revenue AS lr, p.revenue AS pr, CASE WHEN p.org IS NULL THEN 'no_prior_year'
   WHEN NOT (year(l.period_to) = year(p.period_to) + 1 AND abs((l.period_to - l.period_from) - (p.period_to - p.period_from)) <= 31 AND l.period_from > p.period_to) THEN 'periods_not_comparable'
   WHEN l.currency <> p.currency THEN 'currency_changed' WHEN p.revenue = 0 THEN 'prior_is_zero' ELSE 'compared' END AS state FROM l LEFT JOIN p USING (org))
SELECT org, state, lp::VARCHAR AS latest_period_end, pp::VARCHAR AS prior_period_end, lr AS latest_revenue, CASE WHEN state = 'compared' THEN pr END AS prior_revenue,
  CASE WHEN state = 'compared' THEN round_even((lr - pr) / abs(pr) * 100, 1) END AS change_pct FROM j""",
)
def revenue_comparison(spark, sf):
    rows = ranking.revenue_comparison(views.accounts(spark, sf))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("latest_period_end", "prior_period_end")})


def _asked(spark, sf):
    """One question per legal form and head count in the register, two more per head count, and refused ones."""
    known = screen_profiles(spark, sf).filter("employees IS NOT NULL").select("legal_form", "employees").distinct()
    n, form = F.col("employees"), F.lower("legal_form")
    plain = F.format_string("companies with legal form %s and over %d employees", form, n)
    ranked = F.format_string("profitable companies with at least %d employees and revenue under %d million with a website, top %d by revenue", n, n + 1, n + 1)
    kept = F.format_string('loss-making companies with fewer than %d employees, industry contains "machinery"', n + 5)
    refused = F.format_string("legal form %s with positive sentiment", form)
    entry = lambda kind, text, own, size: F.struct(F.lit(kind).alias("kind"), text.alias("query"), own.alias("form"), size.alias("n"))
    none = F.lit("")
    return known.select(F.inline(F.array(entry("plain", plain, F.col("legal_form"), n), entry("ranked", ranked, none, n), entry("kept", kept, none, n), entry("refused", refused, F.col("legal_form"), F.lit(0))))).distinct()


ASKED_SQL = (
    SCREEN_SQL
    + """, known AS (SELECT DISTINCT legal_form, employees FROM rows WHERE employees IS NOT NULL),
asked AS (SELECT 'companies with legal form ' || lower(legal_form) || ' and over ' || employees || ' employees' AS query, 'plain' AS kind, legal_form AS form, employees AS n FROM known
  UNION SELECT 'profitable companies with at least ' || employees || ' employees and revenue under ' || (employees + 1) || ' million with a website, top ' || (employees + 1) || ' by revenue', 'ranked', '', employees FROM known
  UNION SELECT 'loss-making companies with fewer than ' || (employees + 5) || ' employees, industry contains "machinery"', 'kept', '', employees FROM known
  UNION SELECT 'legal form ' || lower(legal_form) || ' with positive sentiment', 'refused', legal_form, 0 FROM known),
hits AS (SELECT a.*, r.org, r.financials_ok, row_number() OVER (PARTITION BY a.query ORDER BY r.org) AS place FROM asked a JOIN rows r ON a.kind = 'plain' AND r.legal_form = a.form AND r.employees > a.n
  UNION ALL SELECT * FROM (SELECT a.*, r.org, r.financials_ok, row_number() OVER (PARTITION BY a.query ORDER BY r.revenue DESC, r.org) AS place
    FROM asked a JOIN rows r ON a.kind = 'ranked' AND r.employees >= a.n AND r.annual_result > 0 AND r.revenue < (a.n + 1) * 1e6 AND r.website IS NOT NULL) WHERE place <= least(100, n + 1)
  UNION ALL SELECT a.*, r.org, r.financials_ok, row_number() OVER (PARTITION BY a.query ORDER BY r.org) FROM asked a JOIN rows r ON a.kind = 'kept' AND r.employees < a.n + 5 AND r.annual_result < 0 AND contains(lower(r.industry), 'machinery'))
"""
)


def _answered(spark, sf):
    profiles = stored(screen_profiles(spark, sf), "screened")
    asked = stored(_asked(spark, sf), "asked")
    planned = stored(op.plan_screens(asked.select("query")), "plans")
    return profiles, asked, planned, stored(op.screen_many(profiles, planned), "screens")


@bind("screen_many", "B12 B13 E14", ASKED_SQL + "SELECT query, org, CAST(place AS BIGINT) AS place FROM hits")
def screen_many(spark, sf):
    """Hundreds of screens over all profiles as one join of rules with facts."""
    return _answered(spark, sf)[3].withColumn("place", F.col("place").cast("long"))


EXPECTED_SQL = """, judged AS (SELECT a.query, a.kind, count(h.org) AS results, a.kind <> 'plain' OR count(h.org) < 2 OR a.n % 4 <> 1 AS membership_exact,
  a.kind <> 'plain' OR a.n % 5 <> 2 AS plan_exact, coalesce(bool_and(h.kind = 'plain' OR h.financials_ok), TRUE) AS citations_complete
  FROM asked a LEFT JOIN hits h ON h.query = a.query GROUP BY a.query, a.kind, a.n)
"""


def _evaluated(spark, sf):
    """The screens against expectations made from the register directly; some are wrong on purpose: swapped ranks, a field too few."""
    profiles, asked, planned, hits = _answered(spark, sf)
    p = profiles.select("org", "legal_form", "employees", "annual_result", "revenue", "website_ok", F.lower(F.concat_ws(" ", "industry_code", "industry_label")).alias("industry"))
    n, own = F.col("n"), W.partitionBy("query")
    plain = asked.filter("kind = 'plain'").join(p, (F.col("form") == F.col("legal_form")) & (F.col("employees") > n))
    ranked = asked.filter("kind = 'ranked'").join(p.filter("annual_result > 0 AND website_ok"), (F.col("employees") >= n) & (F.col("revenue") < (n + 1) * 1e6))
    kept = asked.filter("kind = 'kept'").join(p.filter("annual_result < 0 AND contains(industry, 'machinery')"), F.col("employees") < n + 5)
    place = F.row_number().over(own.orderBy("org"))
    swapped = F.when((n % 4 == 1) & (F.col("place") <= 2) & (F.col("held") > 1), 3 - F.col("place")).otherwise(F.col("place"))
    plain = plain.withColumns({"place": place, "held": F.count(F.lit(1)).over(own)}).withColumn("place", swapped)
    ranked = ranked.withColumn("place", F.row_number().over(own.orderBy(F.col("revenue").desc(), "org"))).filter(F.col("place") <= F.least(F.lit(op.MAX_ROWS), n + 1))
    members = reduce(DataFrame.unionByName, [x.select("query", "place", "org") for x in (plain, ranked, kept.withColumn("place", place))])
    names = lambda *fields: F.array(*[F.lit(f) for f in fields])
    kind = F.col("kind")
    fields = F.when((kind == "plain") & (n % 5 != 2), names("legal_form", "employees")).when(kind == "ranked", names("employees", "revenue", "annual_result", "website"))
    fields = fields.when(kind == "kept", names("employees", "annual_result", "industry")).otherwise(names("legal_form"))
    expected = asked.select("query", fields.alias("expected_filter_fields"), (kind == "refused").alias("must_abstain"))
    return op.evaluate_screens(expected, members, planned, hits, op.cite_many(hits, planned, _module_evidence(profiles)))


@bind(
    "evaluate_screens",
    "D25",
    ASKED_SQL + EXPECTED_SQL + "SELECT query, results, membership_exact, plan_exact, citations_complete, kind = 'refused' AS abstained, kind = 'refused' AS must_abstain FROM judged",
)
def evaluate_screens(spark, sf):
    return _evaluated(spark, sf)


@bind(
    "screen_points",
    "D25",
    ASKED_SQL
    + EXPECTED_SQL
    + """, t AS (SELECT count(*) AS questions, 3 * count(*) FILTER (kind <> 'refused' AND membership_exact) / count(*) FILTER (kind <> 'refused') AS a,
  2 * count(*) FILTER (kind <> 'refused' AND plan_exact) / count(*) FILTER (kind <> 'refused') AS b, CASE WHEN bool_and(citations_complete) FILTER (kind <> 'refused') THEN 1 ELSE 0 END AS c FROM judged)
SELECT questions, round(a, 9) AS cross_company_screening, round(b, 9) AS exact_inspectable_filters, 1::DOUBLE AS unsupported_abstention, c::DOUBLE AS provenance_export,
  round(a + b + 1 + c, 9) AS score, 7::DOUBLE AS maximum, FALSE AS qualification_passed FROM t""",
)
def screen_points(spark, sf):
    row = op.screen_points(_evaluated(spark, sf))
    return row.withColumns({c: F.round(c, 9) for c in ("cross_company_screening", "exact_inspectable_filters", "score")})
