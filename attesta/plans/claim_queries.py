"""Claims, envelopes and batch checks over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import claims as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import CLAIMS_SQL, EVIDENCE_SQL

BEST_SQL = f"""
WITH {CLAIMS_SQL},
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY org, claim_key ORDER BY CASE WHEN availability = 'available' THEN 0 ELSE 1 END, confidence DESC, pos) AS rn,
           min(pos) OVER (PARTITION BY org, claim_key) AS first_pos, count(*) OVER (PARTITION BY org, claim_key) AS merged
    FROM claims) WHERE rn = 1),
links AS (SELECT org, claim_key, ev_id, min(pos) AS first_cited FROM claims GROUP BY ALL),
{EVIDENCE_SQL},
verdicts AS (SELECT org, max(value::DOUBLE) >= 200 AS publishable FROM claims GROUP BY org),
held AS (
  SELECT b.* EXCLUDE (availability), v.publishable AS identity_ok,
         CASE WHEN b.availability = 'available' AND NOT v.publishable AND NOT EXISTS (
           SELECT 1 FROM links l JOIN evidence e ON e.id = l.ev_id
           WHERE l.org = b.org AND l.claim_key = b.claim_key
             AND e.source_class IN ('official_registry', 'official_annual_accounts', 'official_job_board', 'open_data', 'public_news', 'licensed_feed'))
         THEN 'ambiguous' ELSE b.availability END AS availability
  FROM best b JOIN verdicts v USING (org))
"""


def _verdicts(spark, sf):
    return views.claims(spark, sf).groupBy("org").agg((F.max(F.col("value").cast("double")) >= 200).alias("publishable"))


def _held(spark, sf):
    claims = views.claims(spark, sf)
    links = op.claim_links(claims)
    return op.downgrade_unproven(op.dedupe_claims(claims), links, views.evidence(spark, sf), _verdicts(spark, sf)), links


@bind("dedupe_claims", "D1 G15", BEST_SQL + "SELECT org, claim_key, first_pos, merged, pos, value, availability, confidence FROM best")
def dedupe_claims(spark, sf):
    return op.dedupe_claims(views.claims(spark, sf)).select(
        "org", "claim_key", "first_pos", "merged", "pos", "value", "availability", "confidence"
    )


@bind("claim_evidence_links", "D1", BEST_SQL + "SELECT org, claim_key, ev_id AS evidence_id, first_cited FROM links")
def claim_evidence_links(spark, sf):
    return op.claim_links(views.claims(spark, sf)).select("org", "claim_key", "evidence_id", F.col("first_cited.pos").alias("first_cited"))


@bind("downgrade_unproven", "D2", BEST_SQL + "SELECT org, claim_key, availability, identity_ok FROM held")
def downgrade_unproven(spark, sf):
    return _held(spark, sf)[0].select("org", "claim_key", "availability", "identity_ok")


@bind(
    "build_envelopes",
    "D3",
    BEST_SQL
    + """, marked AS (
  SELECT h.*, EXISTS (SELECT 1 FROM links l JOIN evidence e ON e.id = l.ev_id WHERE l.org = h.org AND l.claim_key = h.claim_key
           AND e.source_class IN ('official_registry', 'official_annual_accounts', 'official_job_board')) AS official FROM held h)
SELECT org,
  CASE WHEN count(*) FILTER (availability = 'available') > 0 AND (bool_or(identity_ok) OR bool_or(availability = 'available' AND official)) THEN 'official'
       WHEN count(*) FILTER (availability = 'ambiguous') > 0 THEN 'ambiguous'
       WHEN count(*) FILTER (availability = 'blocked') > 0 AND count(*) FILTER (availability = 'available') = 0 THEN 'blocked'
       ELSE 'empty' END AS disposition,
  count(*) AS total, count(*) FILTER (availability = 'available') AS n_available,
  count(*) FILTER (availability = 'not_available') AS n_not_available, count(*) FILTER (availability = 'blocked') AS n_blocked,
  count(*) FILTER (availability = 'not_applicable') AS n_not_applicable, count(*) FILTER (availability = 'ambiguous') AS n_ambiguous,
  count(*) FILTER (availability = 'failed') AS n_failed
FROM marked GROUP BY org""",
)
def build_envelopes(spark, sf):
    held, links = _held(spark, sf)
    return op.envelope_headers(held, links, views.evidence(spark, sf))


@bind("referenced_evidence", "D3", BEST_SQL + "SELECT DISTINCT l.org, e.id, e.source_url, e.source_class, e.content_sha256 FROM links l JOIN evidence e ON e.id = l.ev_id")
def referenced_evidence(spark, sf):
    links = op.claim_links(views.claims(spark, sf))
    return op.referenced_evidence(links, views.evidence(spark, sf)).select("org", "id", "source_url", "source_class", "content_sha256")


EVENT_CONTRACT = {
    "website": ["view", "click"],
    "social_profiles": ["signup"],
    "revenue": ["purchase", "signup"],
    "news": ["error"],
    "employees": ["headcount"],
}


@bind(
    "contract_rows",
    "D4",
    BEST_SQL
    + """, mapping(contract_field, field, preference) AS (VALUES ('website', 'view', 0), ('website', 'click', 1), ('social_profiles', 'signup', 0),
  ('revenue', 'purchase', 0), ('revenue', 'signup', 1), ('news', 'error', 0), ('employees', 'headcount', 0)),
orgs AS (SELECT DISTINCT org FROM claims),
pick AS (SELECT * FROM (
  SELECT h.org, m.contract_field, h.claim_key, h.value, h.availability, h.confidence,
    row_number() OVER (PARTITION BY h.org, m.contract_field ORDER BY CASE WHEN h.availability = 'available' THEN 0 ELSE 1 END, m.preference, h.first_pos) AS rn2,
    count(*) FILTER (h.availability = 'available') OVER (PARTITION BY h.org, m.contract_field) AS statements
  FROM held h JOIN mapping m ON m.field = h.field) WHERE rn2 = 1)
SELECT o.org, f.contract_field, coalesce(p.availability, 'not_available') AS availability,
  CASE WHEN p.availability = 'available' THEN p.value END AS value, CASE WHEN p.availability = 'available' THEN p.confidence END AS confidence,
  p.claim_key, coalesce(p.statements, 0) AS statements
FROM orgs o CROSS JOIN (SELECT DISTINCT contract_field FROM mapping) f LEFT JOIN pick p ON p.org = o.org AND p.contract_field = f.contract_field""",
)
def contract_rows(spark, sf):
    held, _ = _held(spark, sf)
    return op.to_contract(held, views.claims(spark, sf), EVENT_CONTRACT)


@bind(
    "claims_to_profiles",
    "D22",
    BEST_SQL
    + """SELECT org, arg_min(value, first_pos) FILTER (field = 'view' AND availability = 'available') AS view,
  arg_min(value, first_pos) FILTER (field = 'signup' AND availability = 'available') AS signup,
  arg_min(value, first_pos) FILTER (field = 'purchase' AND availability = 'available') AS purchase FROM held GROUP BY org""",
)
def claims_to_profiles(spark, sf):
    return op.claims_to_profiles(_held(spark, sf)[0], ["view", "signup", "purchase"])


@bind(
    "field_availability",
    "D16",
    f"""WITH {CLAIMS_SQL} SELECT field, count(*) FILTER (availability = 'available') AS available, count(*) FILTER (availability = 'not_available') AS not_available,
  count(*) FILTER (availability = 'blocked') AS blocked, count(*) FILTER (availability = 'not_applicable') AS not_applicable,
  count(*) FILTER (availability = 'ambiguous') AS ambiguous, count(*) FILTER (availability = 'failed') AS failed, count(DISTINCT org) AS orgs
FROM claims GROUP BY field""",
)
def field_availability(spark, sf):
    return op.field_availability(views.claims(spark, sf))


def _modules(spark, sf):
    """Newest event per (user, type) as that module's evidence row."""
    events = table(spark, sf, "events")
    latest = events.groupBy(views.padded(F.col("user_id")).alias("org"), F.col("event_type").alias("module")).agg(
        F.max_by(F.struct("value", "ts"), F.struct("ts", "event_id")).alias("last")
    )
    value = F.col("last.value")
    status = (
        F.when(value >= 40, "available").when(value >= 20, "not_found").when(value >= 10, "blocked")
        .when(value >= 5, "source_error").when(value >= 2, "not_applicable").otherwise("not_fetched")
    )
    return latest.select(
        "org", "module", status.alias("status"),
        F.when((value >= 10) & (value < 15), "robots.txt disallows").alias("note"),
        F.date_format("last.ts", "yyyy-MM-dd HH:mm:ss").alias("retrieved_at"),
    )


MODULES_SQL = """
modules AS (
  SELECT org, module, ts, CASE WHEN value >= 40 THEN 'available' WHEN value >= 20 THEN 'not_found' WHEN value >= 10 THEN 'blocked'
      WHEN value >= 5 THEN 'source_error' WHEN value >= 2 THEN 'not_applicable' ELSE 'not_fetched' END AS status,
    CASE WHEN value >= 10 AND value < 15 THEN 'robots.txt disallows' END AS note,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS retrieved_at
  FROM (SELECT lpad(user_id::VARCHAR, 9, '0') AS org, event_type AS module, value, ts,
          row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
states AS (SELECT org, module, retrieved_at AS final_timestamp, CASE WHEN status = 'available' THEN 'complete'
    WHEN status IN ('not_applicable', 'not_found', 'source_error') THEN status
    WHEN status = 'blocked' THEN CASE WHEN note LIKE '%robot%' THEN 'blocked_robots' ELSE 'blocked_policy' END ELSE 'submission_error' END AS state FROM modules)
"""


@bind("terminal_states", "D5", f"WITH {MODULES_SQL} SELECT org, module, state, final_timestamp FROM states")
def terminal_states(spark, sf):
    return op.terminal_states(_modules(spark, sf))


@bind(
    "validate_batch",
    "D5",
    f"""WITH {MODULES_SQL}, entity AS (SELECT org, bool_or(state = 'submission_error') AS broken FROM states GROUP BY org),
facts AS (SELECT count(*) AS n, count(DISTINCT org) AS orgs FROM entity), expected AS (SELECT count(*) AS n FROM customer)
SELECT facts.n = expected.n AS exact_expected_count, facts.n = orgs AS unique_orgs, TRUE AS all_entity_states_terminal, TRUE AS all_module_states_terminal,
  facts.n = expected.n AND facts.n = orgs AS zero_silent_drops, facts.n = expected.n AND facts.n = orgs AS passed FROM facts, expected""",
)
def validate_batch(spark, sf):
    expected = table(spark, sf, "customer").count()
    return op.validate_batch(op.entity_states(op.terminal_states(_modules(spark, sf))), expected)


@bind(
    "module_coverage",
    "D20",
    f"""WITH {MODULES_SQL} SELECT org, coalesce(string_agg(module, ',' ORDER BY module) FILTER (status = 'available'), '') AS found,
  coalesce(string_agg(module || ': ' || coalesce(note, status), ',' ORDER BY module) FILTER (status <> 'available'), '') AS blank FROM modules GROUP BY org""",
)
def module_coverage(spark, sf):
    return op.module_coverage(_modules(spark, sf)).select(
        "org", F.array_join("found", ",").alias("found"), F.array_join("blank", ",").alias("blank")
    )


@bind(
    "attempt_ledger",
    "D20",
    "SELECT lpad(user_id::VARCHAR, 9, '0') AS org, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence FROM events",
)
def attempt_ledger(spark, sf):
    attempts = table(spark, sf, "events").select(views.padded(F.col("user_id")).alias("org"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return op.attempt_ledger(attempts, ["ts", "event_id"]).select("org", "event_id", "sequence")
