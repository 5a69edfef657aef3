"""Snapshot comparisons over orders and events cut at two dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import diffs as op
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.views import ACCOUNTS_SQL, CLAIMS_SQL, OBSERVATIONS_SQL
from attesta.sources import official

OLD, NEW = "2000-06-30", "2001-06-30"


def _snapshot(spark, sf, cut):
    """Order facts of each customer as known on a date, as tracked fields."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(cut).cast("timestamp"))
    last = F.struct("o_orderdate", "o_orderkey")
    wide = orders.groupBy(views.padded(F.col("o_custkey")).alias("org")).agg(
        F.max_by("o_orderstatus", last).alias("status"), F.count(F.lit(1)).alias("orders"),
        F.max(F.year("o_orderdate")).alias("year"), F.max_by(F.col("o_orderkey"), last).alias("key"),
    )
    wide = wide.withColumns({"content_sha256": F.sha2(F.col("key").cast("string"), 256), "source_url": F.concat(F.lit("orders/"), F.col("key").cast("string")),
                             "retrieved_at": F.lit(cut), "effective_at": F.lit(cut), })
    return op.unpivot_fields(
        wide, {"registry.legal_form": F.col("status"), "registry.employees": F.when(F.col("orders") > 9, F.col("orders")),
               "registry.latest_submitted_accounts": F.col("year"), "untracked.key": F.col("key")},
    )


def _members(spark, sf, cut):
    """The entities of a snapshot, without their facts: whoever has an order by its date."""
    return table(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(cut).cast("timestamp")).select(views.padded(F.col("o_custkey")).alias("org"))


def _snap_sql(name, cut):
    return f"""{name} AS (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS a, CASE WHEN count(*) > 9 THEN count(*)::VARCHAR END AS b,
  max(year(o_orderdate))::VARCHAR AS c, sha256(arg_max(o_orderkey, (o_orderdate, o_orderkey))::VARCHAR) AS h FROM orders WHERE o_orderdate <= TIMESTAMP '{cut}' GROUP BY 1)"""


SNAP_SQL = f"""WITH {_snap_sql('o', OLD)}, {_snap_sql('n', NEW)},
ol AS (SELECT org, 'registry.legal_form' AS field, a AS v, h FROM o UNION ALL SELECT org, 'registry.employees', b, h FROM o UNION ALL SELECT org, 'registry.latest_submitted_accounts', c, h FROM o),
nl AS (SELECT org, 'registry.legal_form' AS field, a AS v, h FROM n UNION ALL SELECT org, 'registry.employees', b, h FROM n UNION ALL SELECT org, 'registry.latest_submitted_accounts', c, h FROM n),
diff AS (SELECT org, field, ol.v AS old_value, nl.v AS new_value, ol.h AS old_content_sha256, nl.h AS new_content_sha256 FROM ol FULL JOIN nl USING (org, field) WHERE ol.v IS DISTINCT FROM nl.v)
"""


@bind("diff_snapshots", "F2", SNAP_SQL + "SELECT * FROM diff")
def diff_snapshots(spark, sf):
    return op.diff_snapshots(_snapshot(spark, sf, OLD), _snapshot(spark, sf, NEW)).select(
        "org", "field", "old_value", "new_value", "old_content_sha256", "new_content_sha256"
    )


@bind("membership_difference", "F2", SNAP_SQL + "SELECT org, 'previous_only' AS side FROM o WHERE org NOT IN (SELECT org FROM n) UNION ALL SELECT org, 'current_only' FROM n WHERE org NOT IN (SELECT org FROM o)")
def membership_difference(spark, sf):
    return op.membership_difference(_members(spark, sf, OLD), _members(spark, sf, NEW))


@bind(
    "score_changes",
    "F5",
    SNAP_SQL
    + """, e AS (SELECT DISTINCT lpad(o_custkey::VARCHAR, 9, '0') AS org, 'registry.legal_form' AS field FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01' AND o_orderdate <= TIMESTAMP '2001-06-30'),
m AS (SELECT count(*) FILTER (e.org IS NOT NULL AND d.org IS NOT NULL) AS tp, count(*) FILTER (e.org IS NULL) AS fp, count(*) FILTER (d.org IS NULL) AS fn FROM e FULL JOIN (SELECT DISTINCT org, field FROM diff) d ON e.org = d.org AND e.field = d.field)
SELECT tp AS true_positive, fp AS false_positive, fn AS false_negative, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1 END, 9) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1 END, 9) AS recall, TRUE AS idempotent FROM m""",
)
def score_changes(spark, sf):
    old, new = _snapshot(spark, sf, OLD), _snapshot(spark, sf, NEW)
    expected = table(spark, sf, "orders").filter("o_orderdate > TIMESTAMP '2001-01-01' AND o_orderdate <= TIMESTAMP '2001-06-30'").select(
        views.padded(F.col("o_custkey")).alias("org"), F.lit("registry.legal_form").alias("field")
    )
    row = op.score_changes(expected, op.diff_snapshots(old, new), rerun=op.diff_snapshots(new, new))
    return row.select("true_positive", "false_positive", "false_negative", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), "idempotent")


def _tracked(spark, sf, cut):
    """Observations known on a date, one address per counter with tracking parameters that must not matter."""
    rows = views.observations(spark, sf).filter(F.col("retrieved_at") <= F.lit(cut).cast("timestamp"))
    tagged = F.concat("source_url", F.lit("/?utm_source=d"), F.dayofmonth("retrieved_at").cast("string"))
    metrics = F.to_json(F.struct(F.floor("value").alias("level"), F.col("retrieved_at").cast("string").alias("as_of")))
    return rows.withColumns({"source_url": tagged, "metrics": metrics, "published_at": F.lit(None).cast("timestamp")})


def _tracked_sql(name, cut):
    return f"""{name} AS (SELECT org, platform || '|' || signal_type || '|' || source_url || CASE WHEN signal_type = 'review' THEN '|' || id ELSE '' END AS observation_key, signal_type,
  arg_max(floor(value)::BIGINT, (retrieved_at, id)) AS lvl, arg_max(sentiment_label, (retrieved_at, id)) FILTER (sentiment_label IS NOT NULL) AS lab
  FROM observations WHERE retrieved_at <= TIMESTAMP '{cut}' AND exact_entity AND rights_status = 'approved' GROUP BY ALL)"""


@bind(
    "diff_observations",
    "F3",
    f"""WITH {OBSERVATIONS_SQL}, {_tracked_sql('o', '2024-01-20')}, {_tracked_sql('n', '2024-01-25')}
SELECT n.org, 'external_footprint.' || n.signal_type AS field, n.observation_key, CASE WHEN o.org IS NULL THEN 'new_evidence' ELSE 'metric_changed' END AS change_kind
FROM n LEFT JOIN o USING (org, observation_key) WHERE o.org IS NULL OR n.lvl <> o.lvl OR n.lab IS DISTINCT FROM o.lab""",
)
def diff_observations(spark, sf):
    changes = op.diff_observations(_tracked(spark, sf, "2024-01-20"), _tracked(spark, sf, "2024-01-25"))
    return changes.select("org", "field", "observation_key", "change_kind")


EVENT_FIELDS = ["view", "signup", "purchase", "click", "error"]


@bind(
    "diff_envelopes",
    "F4",
    f"""WITH {CLAIMS_SQL}, o AS (SELECT * FROM claims WHERE pos < (SELECT count(*) * 0.9 FROM events)), n AS (SELECT * FROM claims),
sh AS (SELECT DISTINCT org FROM o INTERSECT SELECT DISTINCT org FROM n),
s AS (SELECT coalesce(a.org, b.org) AS org, coalesce(a.field, b.field) AS field, a.v AS old_value, b.v AS new_value FROM
  (SELECT org, field, arg_max(value, pos) AS v FROM o JOIN sh USING (org) WHERE field IN ('view', 'signup', 'error') GROUP BY ALL) a
  FULL JOIN (SELECT org, field, arg_max(value, pos) AS v FROM n JOIN sh USING (org) WHERE field IN ('view', 'signup', 'error') GROUP BY ALL) b ON a.org = b.org AND a.field = b.field WHERE a.v IS DISTINCT FROM b.v),
m AS (SELECT coalesce(a.org, b.org) AS org, coalesce(a.field, b.field) AS field, coalesce(a.c, 0) AS oc, coalesce(b.c, 0) AS nc FROM
  (SELECT org, field, value, count(*) AS c FROM o JOIN sh USING (org) WHERE field IN ('purchase', 'click') GROUP BY ALL) a
  FULL JOIN (SELECT org, field, value, count(*) AS c FROM n JOIN sh USING (org) WHERE field IN ('purchase', 'click') GROUP BY ALL) b ON a.org = b.org AND a.field = b.field AND a.value = b.value)
SELECT org, field, old_value, new_value, NULL::BIGINT AS added, NULL::BIGINT AS removed FROM s
UNION ALL SELECT org, field, NULL, NULL, sum(greatest(0, nc - oc))::BIGINT, sum(greatest(0, oc - nc))::BIGINT FROM m WHERE oc <> nc GROUP BY org, field""",
)
def diff_envelopes(spark, sf):
    claims = views.claims(spark, sf)
    cut = table(spark, sf, "events").agg((F.count(F.lit(1)) * 0.9).alias("_cut"))
    from attesta.operators.ordering import with_totals

    old = with_totals(claims, cut).filter(F.col("pos") < F.col("_cut")).drop("_cut")
    return op.diff_envelopes(old, claims, EVENT_FIELDS, multi=["purchase", "click"])


@bind(
    "reextract_accounts",
    "F6",
    f"""WITH {ACCOUNTS_SQL},
st AS (SELECT org, record_id, account_type, period_to, row_number() OVER (PARTITION BY org ORDER BY record_id DESC) AS place FROM accounts),
fr AS (SELECT org, record_id, account_type, period_to, row_number() OVER (PARTITION BY org ORDER BY period_to DESC, (account_type <> 'KONSERN') DESC, record_id DESC) AS place FROM accounts),
j AS (SELECT org, bool_or(st.record_id IS DISTINCT FROM fr.record_id) AS changed, bool_or(place = 1 AND st.period_to <> fr.period_to) AS lp, bool_or(place = 1 AND st.account_type = 'KONSERN' AND fr.account_type = 'SELSKAP') AS sc
  FROM st FULL JOIN fr USING (org, place) GROUP BY org),
c AS (SELECT org, bool_or(later > period_to) AS ch FROM (SELECT org, period_to, lead(period_to) OVER (PARTITION BY org ORDER BY place) AS later FROM st) GROUP BY org)
SELECT count(*) AS profiles, count(*) FILTER (changed) AS changed, count(*) FILTER (lp) AS latest_period_corrected, count(*) FILTER (sc) AS scope_corrected, count(*) FILTER (ch) AS chronology_error FROM j JOIN c USING (org)""",
)
def reextract_accounts(spark, sf):
    from pyspark.sql import Window as W

    records = views.accounts(spark, sf)
    by_id = F.row_number().over(W.partitionBy("org").orderBy(F.col("record_id").desc()))
    stored = records.withColumn("place", by_id)
    return op.reextract_report(op.reextract_accounts(stored, official.normalize_accounts(records)))
