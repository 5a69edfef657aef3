"""Hash samples, splits and strata over customers and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import register as reg, sampling as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.source_queries import FILED_SQL, _filed_profiles
from attesta.plans.views import PROFILES_SQL

SEED = 20260825
BAND_SQL = """CASE WHEN employees IS NULL THEN 'missing' WHEN employees = 0 THEN '0' WHEN employees < 5 THEN '1-4' WHEN employees < 20 THEN '5-19' WHEN employees < 100 THEN '20-99' ELSE '100+' END"""
STRATUM_SQL = f"""concat_ws('|', CASE WHEN legal_form IN ('AS', 'ASA', 'ENK') THEN legal_form ELSE 'OTHER' END, {BAND_SQL},
  CASE WHEN bankrupt OR liquidating THEN 'adverse' ELSE 'active' END, CASE WHEN website IS NOT NULL THEN 'web' ELSE 'no-web' END)"""


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select(views.padded(F.col("s_suppkey")).alias("org"), "s_acctbal")


@bind(
    "hash_sample",
    "E2",
    f"""WITH {PROFILES_SQL}, s AS (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, s_acctbal FROM supplier),
pool AS (SELECT p.*, coalesce(s.s_acctbal > 9000, FALSE) AS preserved FROM profiles p LEFT JOIN s USING (org) WHERE coalesce(s.s_acctbal, 5000) >= 1000)
SELECT org, preserved FROM pool ORDER BY preserved DESC, CASE WHEN preserved THEN sha256('{SEED}:preserved:' || org) ELSE sha256('{SEED}:' || org) END LIMIT 100""",
)
def hash_sample(spark, sf):
    suppliers = _suppliers(spark, sf)
    sample = op.hash_sample(views.profiles(spark, sf), 100, SEED, suppliers.filter("s_acctbal < 1000"), suppliers.filter("s_acctbal > 9000"))
    return sample.select("org", "preserved")


@bind(
    "assign_splits",
    "E4",
    f"""WITH {PROFILES_SQL}, r AS (SELECT org, row_number() OVER (ORDER BY sha256('{SEED}:order:' || org)) AS position, count(*) OVER () AS n FROM profiles)
SELECT org, position, CASE WHEN position <= round_even(n * 0.6, 0) THEN 'development' WHEN position <= round_even(n * 0.6, 0) + round_even(n * 0.2, 0) THEN 'validation' ELSE 'held_out' END AS evaluation_split FROM r""",
)
def assign_splits(spark, sf):
    return op.assign_splits(views.profiles(spark, sf), SEED).select("org", "position", "evaluation_split")


@bind(
    "grouped_split",
    "E4",
    f"""WITH o AS (SELECT DISTINCT lpad(o_custkey::VARCHAR, 9, '0') AS org FROM orders), r AS (SELECT org, row_number() OVER (ORDER BY sha256('{SEED}:' || org)) <= greatest(1, floor(count(*) OVER () * 0.25)) AS is_test FROM o)
SELECT is_test, count(*) AS rows, count(DISTINCT o_custkey) AS orgs FROM orders JOIN r ON r.org = lpad(o_custkey::VARCHAR, 9, '0') GROUP BY 1""",
)
def grouped_split(spark, sf):
    rows = table(spark, sf, "orders").select(views.padded(F.col("o_custkey")).alias("org"))
    split = op.grouped_split(rows, SEED, 0.25)
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("org").alias("orgs"))


@bind(
    "stress_sample",
    "E3",
    f"""WITH {PROFILES_SQL}, k AS (SELECT org, {STRATUM_SQL} AS stratum, sha256('{SEED}:population:' || org) AS ph, sha256('{SEED}:stress:' || org) AS sh FROM profiles),
pop AS (SELECT * FROM k ORDER BY ph LIMIT 140),
rest AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sh) AS place FROM k WHERE org NOT IN (SELECT org FROM pop)),
lim AS (SELECT greatest(1, least(3, floor(60 / count(DISTINCT stratum)))) AS m FROM k),
st AS (SELECT rest.*, place > m AS late FROM rest, lim WHERE place <= 40 ORDER BY late, CASE WHEN NOT late THEN stratum END NULLS FIRST, CASE WHEN NOT late THEN place END NULLS FIRST, sh LIMIT 60)
SELECT org, stratum, 'population' AS sample_slice FROM pop UNION ALL SELECT org, stratum, 'stress' FROM st""",
)
def stress_sample(spark, sf):
    return op.stress_sample(views.profiles(spark, sf), 200, SEED).select("org", "stratum", "sample_slice")


@bind(
    "quota_sample",
    "E3",
    f"""WITH {PROFILES_SQL}, k AS (SELECT *, concat_ws('|', CASE WHEN coalesce(employees, 0) = 0 THEN '0' WHEN employees < 5 THEN '1-4' WHEN employees < 20 THEN '5-19' WHEN employees < 100 THEN '20-99' ELSE '100+' END, legal_form) AS stratum FROM profiles),
w AS (SELECT stratum, count(*) AS wanted, sum(count(*)) OVER () AS aw FROM k WHERE website IS NULL GROUP BY 1),
h AS (SELECT stratum, count(*) AS pool, sum(count(*)) OVER () AS ap FROM k WHERE website IS NOT NULL GROUP BY 1),
q AS (SELECT stratum, wanted, greatest(1, round_even(100 * wanted / aw, 0)) AS quota, round((wanted / aw) / (pool / ap), 4) AS stratum_weight FROM w JOIN h USING (stratum)),
r AS (SELECT org, stratum, row_number() OVER (PARTITION BY stratum ORDER BY sha256('{SEED}:' || org)) AS place FROM k WHERE website IS NOT NULL)
SELECT org, stratum, stratum_weight FROM r JOIN q USING (stratum) WHERE place <= quota ORDER BY wanted DESC, stratum, place LIMIT 100""",
)
def quota_sample(spark, sf):
    profiles = views.profiles(spark, sf)
    drawn = op.quota_sample(profiles.filter("website IS NOT NULL"), profiles.filter("website IS NULL"), 100, SEED)
    return drawn.select("org", "stratum", "stratum_weight")


@bind(
    "tier_mix_sample",
    "E3 B2",
    f"""WITH {FILED_SQL}, r AS (SELECT org, tier, sha256('{SEED}:' || org) AS h, row_number() OVER (PARTITION BY tier ORDER BY sha256('{SEED}:' || org)) AS place FROM tiered)
SELECT org, tier FROM r ORDER BY place > CASE tier WHEN 'rich' THEN 44 WHEN 'standard' THEN 24 ELSE 12 END, h LIMIT 80""",
)
def tier_mix_sample(spark, sf):
    rows = _filed_profiles(spark, sf).withColumn("tier", reg.tier())
    return op.tier_mix_sample(rows, 80, SEED).select("org", "tier")


@bind(
    "unique_host_sample",
    "E5",
    f"""WITH k AS (SELECT lpad(page_id::VARCHAR, 9, '0') AS org, regexp_replace(lower(regexp_extract(url, '//([^/?#]+)', 1)), '^www\\.', '') AS host FROM pages),
f AS (SELECT host, arg_min(org, sha256('{SEED}:' || org)) AS org, min(sha256('{SEED}:' || org)) AS h FROM k WHERE host NOT LIKE '%.org' AND org <> '000000003' GROUP BY host)
SELECT host, org FROM f ORDER BY h LIMIT 20""",
)
def unique_host_sample(spark, sf):
    rows = table(spark, sf, "pages").select(views.padded(F.col("page_id")).alias("org"), F.col("url").alias("website"))
    from attesta.functions.urls import host

    org_hosts = rows.select(host(F.col("website")).alias("host")).filter(F.col("host").endswith(".org"))
    return op.unique_host_sample(rows, 20, SEED, rows.filter("org = '000000003'"), org_hosts).select("host", "org")


@bind(
    "strata_counts",
    "E6",
    f"""WITH {PROFILES_SQL}, k AS (SELECT org, {STRATUM_SQL} AS stratum FROM profiles), s AS (SELECT org FROM profiles ORDER BY sha256('{SEED}:' || org) LIMIT 100)
SELECT stratum, count(*) AS population, count(s.org) AS selected FROM k LEFT JOIN s USING (org) GROUP BY ROLLUP (stratum)""",
)
def strata_counts(spark, sf):
    profiles = views.profiles(spark, sf)
    return op.strata_counts(profiles, op.hash_sample(profiles, 100, SEED))


@bind(
    "filer_strata",
    "E6 B5",
    f"""WITH {FILED_SQL}, k AS (SELECT concat_ws('|', legal_form, {BAND_SQL}, split_part(industry_code, '.', 1), substr(municipality_number, 1, 2), CASE WHEN website IS NOT NULL THEN 'web' ELSE 'no-web' END) AS stratum,
  (coalesce(latest_submitted_accounts, '') = '2001' AND NOT bankrupt AND NOT liquidating)::INTEGER AS s FROM filed)
SELECT stratum, count(*) AS population, sum(s)::BIGINT AS selected FROM k GROUP BY ROLLUP (stratum)""",
)
def filer_strata(spark, sf):
    rows = _filed_profiles(spark, sf)
    return op.strata_counts(rows, rows.filter(reg.filer_eligible("2001")), op.filer_stratum())
