"""Streams and resumable batches over events and orders, drained to their final state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.claim_queries import MODULES_SQL, _modules
from attesta.plans.diff_queries import _snap_sql, _snapshot
from attesta.plans.views import PROFILES_SQL
from attesta.session import checkpoint_folder, stored
from attesta.streaming.changes import ChangeLog
from attesta.streaming.feed_index import FeedIndex, fold_entries, in_window
from attesta.streaming.resume import ResumableRun, pending


def _fresh(spark, name):
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _entries(events):
    kind = F.col("event_type")
    return events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("k").cast("string")).alias("uuid"), F.col("ts").cast("timestamp").alias("modified"),
        F.when(kind == "error", "inactive").otherwise("active").alias("status"), kind.alias("business_name"), F.col("event_id").cast("string").alias("url"), F.col("event_id").alias("arrival"),
    )


SINCE = "2024-01-20 00:00:00"
FEED_SQL = f"""
f AS (SELECT user_id || '-' || json_extract_string(props, '$.k') AS uuid, arg_max(event_type, (ts, event_id)) AS business_name, arg_max(event_id, (ts, event_id))::VARCHAR AS url, max(ts) AS m FROM events GROUP BY 1)
SELECT uuid, business_name, url, CASE WHEN business_name = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status FROM f WHERE m >= TIMESTAMP '{SINCE}' OR business_name <> 'error'
"""
START, LOADS, LOAD_DAYS, FEED_WINDOW = "2024-01-01", 5, 6, "11 days"  # the last read is 11 days after SINCE


def _loads(spark, sf):
    """The events as numbered reads of a feed: late entries, repeated ones, and one read that broke off before its retry."""
    rows = _entries(table(spark, sf, "events").withColumn("k", views.props_k(F.col("props"))))
    own = F.floor(F.datediff("modified", F.lit(START)) / LOAD_DAYS).cast("int") + F.when(F.col("arrival") % 7 == 0, 1).otherwise(0)
    load = F.least(F.lit(LOADS - 1), own)
    again = F.when((F.col("arrival") % 11 == 0) & (load < LOADS - 1), load + 1)
    placed = rows.withColumn("load", F.explode(F.array_compact(F.array(load, again)))).withColumn("complete", F.lit(True))
    # The broken read: half of one load, as versions that must never be seen.
    broken = placed.filter((F.col("load") == 2) & (F.col("arrival") % 2 == 0)).withColumns({"complete": F.lit(False), "status": F.lit("inactive"), "modified": F.col("modified") + F.expr("INTERVAL 1 DAY")})
    clock = F.lit(START).cast("timestamp") + F.make_dt_interval(days=(F.col("load") + 1) * LOAD_DAYS)
    return stored(placed.unionByName(broken).withColumn("retrieved_at", clock), "loads")


def _feed(spark, sf):
    """An index that has drained the reads one by one as they arrive."""
    base, loads = _fresh(spark, "feed"), _loads(spark, sf)
    index = FeedIndex(spark, f"{base}/index")
    for number in range(LOADS):
        loads.filter(F.col("load") == number).drop("load").write.mode("append").parquet(f"{base}/loads")
        stream = spark.readStream.schema(loads.drop("load").schema).parquet(f"{base}/loads")
        index.run(stream, f"{base}/checkpoint", FEED_WINDOW, compact_every=3)
    return index


@bind("feed_index_stream", "I1", f"WITH {FEED_SQL}")
def feed_index_stream(spark, sf):
    """The index after streaming the events through keyed state: late, repeated and broken reads, a window and a compaction."""
    return _feed(spark, sf).current(since=SINCE).select("uuid", "business_name", "url", "status")


@bind("feed_index_batch", "I1", f"WITH {FEED_SQL}")
def feed_index_batch(spark, sf):
    events = table(spark, sf, "events").withColumn("k", views.props_k(F.col("props")))
    rows = _entries(events).withColumn("status", F.upper("status"))
    return in_window(fold_entries(rows), SINCE).select("uuid", "business_name", "url", "status")


@bind(
    "resume_pending",
    "I2",
    f"""WITH {PROFILES_SQL}, {MODULES_SQL}, d AS (SELECT org FROM modules WHERE module IN ('view', 'signup') AND status <> 'not_fetched' GROUP BY org HAVING count(DISTINCT module) = 2)
SELECT org, revenue FROM profiles WHERE org NOT IN (SELECT org FROM d)""",
)
def resume_pending(spark, sf):
    return pending(views.profiles(spark, sf), _modules(spark, sf), ["view", "signup"], priority="revenue").select("org", "revenue")


EVERY, TICKS = 400, 12


@bind(
    "resume_run",
    "I2",
    f"""WITH {PROFILES_SQL}, {MODULES_SQL}, d AS (SELECT org FROM modules WHERE module IN ('view', 'signup') AND status <> 'not_fetched' GROUP BY org HAVING count(DISTINCT module) = 2),
q AS (SELECT *, row_number() OVER (ORDER BY coalesce(revenue, 0) DESC, org) AS place FROM profiles WHERE org NOT IN (SELECT org FROM d))
SELECT org, legal_form, CAST(place AS BIGINT) AS place, CAST((place - 1) // {EVERY} AS BIGINT) AS step FROM q""",
)
def resume_run(spark, sf):
    """A run over the pending entities in priority order that is stopped after a step and started again."""
    waiting = pending(views.profiles(spark, sf), _modules(spark, sf), ["view", "signup"], priority="revenue")
    run = ResumableRun(spark, _fresh(spark, "resume"), EVERY, TICKS)
    run.enqueue(waiting.select("org", "legal_form", "order_key"))
    process = lambda rows: rows.select("org", "legal_form", F.col("place").cast("long").alias("place"), "step")
    run.run(process, most=1)
    run.run(process)
    return run.results("org string, legal_form string, place long, step long")


OLD, NEW = "2000-06-30", "2001-06-30"


@bind(
    "change_stream",
    "I3",
    f"""WITH {_snap_sql('o', OLD)}, {_snap_sql('n', NEW)},
ol AS (SELECT org, 'registry.legal_form' AS field, a AS v, h FROM o UNION ALL SELECT org, 'registry.employees', b, h FROM o UNION ALL SELECT org, 'registry.latest_submitted_accounts', c, h FROM o),
nl AS (SELECT org, 'registry.legal_form' AS field, a AS v, h FROM n UNION ALL SELECT org, 'registry.employees', b, h FROM n UNION ALL SELECT org, 'registry.latest_submitted_accounts', c, h FROM n)
SELECT org, field, ol.v AS old_value, nl.v AS new_value, ol.h AS old_content_sha256, nl.h AS new_content_sha256 FROM nl LEFT JOIN ol USING (org, field) WHERE ol.v IS DISTINCT FROM nl.v""",
)
def change_stream(spark, sf):
    """Events between two snapshots of the orders, the first as initial state, the second replayed and an older one after it."""
    base, baseline = _fresh(spark, "changes"), _snapshot(spark, sf, OLD).withColumn("snapshot", F.lit(0))
    log = ChangeLog(spark, f"{base}/log", ["registry.legal_form", "registry.employees", "registry.latest_submitted_accounts"])
    for number, cut in ((1, NEW), (1, NEW), (0, OLD)):
        arrived = _snapshot(spark, sf, cut).withColumn("snapshot", F.lit(number).cast("long"))
        arrived.write.mode("append").parquet(f"{base}/snapshots")
        log.run(spark.readStream.schema(arrived.schema).parquet(f"{base}/snapshots"), f"{base}/checkpoint", baseline=baseline)
    return log.events().select("org", "field", "old_value", "new_value", "old_content_sha256", "new_content_sha256")
