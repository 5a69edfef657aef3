"""The chain from claims to contract to changes over customers and orders at two dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import contract as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import PROFILES_SQL

OLD, NEW = "2000-06-30", "2001-06-30"


def _claims(spark, sf, cut):
    """Register facts of customers, and what their orders up to a date say about accounts, people, workplaces, jobs and updates."""
    p = views.profiles(spark, sf)
    text = lambda c: c.cast("string")
    fact = lambda field, value, state=None: F.struct(F.lit(field).alias("field"), text(value).alias("value"), (F.when(value.isNull(), "not_available").otherwise("available") if state is None else state).alias("availability"))
    register = p.select("org", F.lit(0).cast("long").alias("pos"), F.inline(F.array(
        fact("legal_name", F.col("name")), fact("organisation_form", F.to_json(F.struct(F.col("legal_form").alias("code"), F.lit("x").alias("description")))),
        fact("registered_address", F.to_json(F.struct(F.concat(F.lit("Gata "), "org").alias("street"), F.col("municipality_number").alias("postal_code"), F.col("municipality").alias("postal_town")))),
        fact("industry_code", F.to_json(F.struct(F.col("industry_code").alias("code"), F.col("industry_label").alias("description")))), fact("employees", F.col("employees")),
        fact("operating_status", F.to_json(F.struct("bankrupt", F.col("liquidating").alias("under_liquidation")))),
        fact("website", F.col("website"), F.when(F.col("website").isNotNull(), "available").when(F.col("bankrupt"), "blocked").otherwise("ambiguous")),
    )))
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(cut).cast("timestamp"))
    key, org = F.col("o_orderkey"), views.padded(F.col("o_custkey"))
    newest = orders.groupBy(org.alias("org")).agg(F.max_by(F.struct("o_totalprice", "o_orderkey", "o_orderdate"), F.struct("o_orderdate", "o_orderkey")).alias("x"))
    books = newest.select("org", F.col("x.o_orderkey").alias("pos"), F.inline(F.array(
        fact("revenue", F.to_json(F.struct(F.col("x.o_totalprice").alias("amount"), F.lit("NOK").alias("currency")))),
        fact("registry_update", F.to_json(F.struct(F.date_format("x.o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("Endring").alias("change_type")))),
    )))
    lines = orders.select(org.alias("org"), key.alias("pos"), F.inline(F.array_compact(F.array(
        F.when(F.col("o_orderpriority") == "1-URGENT", fact("leadership", F.to_json(F.struct(F.concat(F.lit("Person "), text(key % 7)).alias("name"), F.lit("Styremedlem").alias("role_title_no"))))),
        F.when(F.col("o_orderpriority") == "2-HIGH", fact("location", F.to_json(F.struct(F.concat(F.lit("Enhet "), text(key)).alias("name"), F.struct(F.lit("Kaia 1").alias("street")).alias("address"))))),
        F.when(F.col("o_orderstatus") == "P", fact("job_posting", F.concat(F.lit("Stilling "), text(key)))),
    ))))
    claims = register.unionByName(books).unionByName(lines)
    own = F.concat_ws("|", "field", F.col("pos").cast("string"))
    return claims.select("org", "field", "value", "availability", F.lit(0.9).alias("confidence"), F.col("pos").alias("first_pos"), own.alias("claim_key"))


def _contract(spark, sf, cut):
    orgs = views.profiles(spark, sf).select("org", F.when(F.coalesce("employees", F.lit(0)) == 0, "shell").otherwise("full").alias("tier"))
    return op.contract(_claims(spark, sf, cut), orgs)


def _contract_sql(name, cut):
    return f"""{name}_o AS (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, * FROM orders WHERE o_orderdate <= TIMESTAMP '{cut}'),
{name}_n AS (SELECT org, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price, strftime(max(o_orderdate), '%Y-%m-%d') AS day FROM {name}_o GROUP BY org),
{name}_j AS (SELECT org, arg_min(o_orderkey, o_orderkey) AS k FROM {name}_o WHERE o_orderstatus = 'P' GROUP BY org),
{name}_s AS (SELECT p.*, coalesce(employees, 0) = 0 AS shell, price, day, j.k AS job FROM profiles p LEFT JOIN {name}_n USING (org) LEFT JOIN {name}_j j USING (org)),
{name} AS (
  SELECT org, unnest(['legal_name', 'legal_form', 'registered_business_address', 'industry', 'employee_count', 'bankruptcy_or_liquidation_status', 'accounting_obligation_status', 'latest_annual_revenue', 'latest_annual_result', 'latest_total_assets', 'latest_equity',
    'corporate_group_structure', 'official_website', 'hiring_or_activity_signal', 'dated_public_activity', 'social_profiles', 'accounts_filing_years', 'active_job_count', 'ratings_and_reviews', 'buzz_or_engagement', 'qualified_sentiment']) AS field, 1::BIGINT AS place,
   unnest([name, legal_form, 'Gata ' || org || ', ' || municipality_number || ' ' || municipality || ', Norge', industry_code || ' - ' || industry_label, employees::VARCHAR, '{{"bankrupt":' || bankrupt || ',"liquidating":' || liquidating || '}}', NULL, price::VARCHAR, NULL, NULL, NULL,
    NULL, website, 'Stilling ' || job, '{{"title":"Official registration change: Endring","date":"' || day || '","change_type":"Endring","source":"official_registry"}}', NULL, NULL, NULL, NULL, NULL, NULL]) AS value,
   unnest(['x', 'x', 'x', 'x', 'not_available', 'x', 'not_available', 'not_available', 'not_available', 'not_available', 'not_available', 'not_available', CASE WHEN bankrupt THEN 'blocked' ELSE 'ambiguous' END,
    CASE WHEN shell THEN 'not_applicable' ELSE 'not_available' END, CASE WHEN shell THEN 'not_applicable' ELSE 'not_available' END, CASE WHEN shell THEN 'not_applicable' ELSE 'not_available' END, 'not_available',
    CASE WHEN shell THEN 'not_applicable' ELSE 'not_available' END, CASE WHEN shell THEN 'not_applicable' ELSE 'not_available' END, CASE WHEN website IS NULL THEN 'not_applicable' ELSE 'not_available' END, 'not_available']) AS gap FROM {name}_s
  UNION ALL SELECT org, 'leadership_role', row_number() OVER (PARTITION BY org ORDER BY o_orderkey), 'Styremedlem: Person ' || (o_orderkey % 7), NULL FROM {name}_o WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT org, 'registered_workplace', row_number() OVER (PARTITION BY org ORDER BY o_orderkey), 'Enhet ' || o_orderkey || ' — Kaia 1, Norge', NULL FROM {name}_o WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT org, 'job_posting', row_number() OVER (PARTITION BY org ORDER BY o_orderkey), 'Stilling ' || o_orderkey, NULL FROM {name}_o WHERE o_orderstatus = 'P'
  UNION ALL SELECT org, 'leadership_role', 1, NULL, 'not_available' FROM profiles WHERE org NOT IN (SELECT org FROM {name}_o WHERE o_orderpriority = '1-URGENT')
  UNION ALL SELECT org, 'registered_workplace', 1, NULL, 'not_available' FROM profiles WHERE org NOT IN (SELECT org FROM {name}_o WHERE o_orderpriority = '2-HIGH'))
"""


@bind("contract_chain", "D4", f"WITH {PROFILES_SQL}, {_contract_sql('c', NEW)} SELECT org, field, place, value, CASE WHEN value IS NOT NULL THEN 'available' ELSE gap END AS availability FROM c")
def contract_chain(spark, sf):
    """Every customer's contract, with rendered addresses, industries, people and gaps by tier."""
    rows = _contract(spark, sf, NEW)
    return rows.select("org", "field", F.col("place").cast("long").alias("place"), "value", "availability")


@bind(
    "contract_diff",
    "D4 F4",
    f"""WITH {PROFILES_SQL}, {_contract_sql('a', OLD)}, {_contract_sql('b', NEW)}, w(field) AS (VALUES ('latest_annual_revenue'), ('hiring_or_activity_signal'), ('dated_public_activity')),
s AS (SELECT a.org, a.field, a.value AS old_value, b.value AS new_value FROM a JOIN w USING (field) JOIN b ON a.org = b.org AND a.field = b.field WHERE a.value IS DISTINCT FROM b.value),
x AS (SELECT org, field, value, count(*) AS n FROM a WHERE field IN ('leadership_role', 'registered_workplace') AND value IS NOT NULL GROUP BY ALL), y AS (SELECT org, field, value, count(*) AS n FROM b WHERE field IN ('leadership_role', 'registered_workplace') AND value IS NOT NULL GROUP BY ALL),
m AS (SELECT org, field, sum(greatest(0, coalesce(y.n, 0) - coalesce(x.n, 0)))::BIGINT AS added, sum(greatest(0, coalesce(x.n, 0) - coalesce(y.n, 0)))::BIGINT AS removed FROM x FULL JOIN y USING (org, field, value) WHERE coalesce(x.n, 0) <> coalesce(y.n, 0) GROUP BY org, field)
SELECT org, field, old_value, new_value, NULL::BIGINT AS added, NULL::BIGINT AS removed FROM s UNION ALL SELECT org, field, NULL, NULL, added, removed FROM m""",
)
def contract_diff(spark, sf):
    """What a refresh a year later changed, in the contract's own vocabulary."""
    return op.contract_changes(_contract(spark, sf, OLD), _contract(spark, sf, NEW))
