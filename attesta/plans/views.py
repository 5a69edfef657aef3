"""The entity roles the given tables play, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from attesta.plans.catalog import table


def padded(key: Column) -> Column:
    return F.lpad(key.cast("string"), 9, "0")


def props_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _legal_form(segment: Column) -> Column:
    return (
        F.when(segment == "MACHINERY", "AS")
        .when(segment == "BUILDING", "BRL")
        .when(segment == "AUTOMOBILE", "ASA")
        .when(segment == "FURNITURE", "ENK")
        .otherwise("NUF")
    )


def _industry(segment: Column) -> Column:
    return (
        F.when(segment == "MACHINERY", "28.1")
        .when(segment == "BUILDING", "41.2")
        .when(segment == "AUTOMOBILE", "45.1")
        .when(segment == "FURNITURE", "68.2")
        .otherwise("96.0")
    )


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as register profiles; a negative balance leaves employees unknown."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    balance = F.col("c_acctbal")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        padded(F.col("c_custkey")).alias("org"),
        F.col("c_name").alias("name"),
        _legal_form(F.col("c_mktsegment")).alias("legal_form"),
        F.col("n_name").alias("municipality"),
        F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("municipality_number"),
        F.when(balance >= 0, F.floor(balance / 100).cast("int")).alias("employees"),
        (balance < -500).alias("bankrupt"),
        ((balance >= -500) & (balance < -250)).alias("liquidating"),
        F.when(balance > 5000, F.concat(F.lit("www.customer-"), F.col("c_custkey").cast("string"), F.lit(".example.com/"))).alias("website"),
        balance.alias("revenue"),
        F.col("c_mktsegment").alias("industry_label"),
        _industry(F.col("c_mktsegment")).alias("industry_code"),
    )


PROFILES_SQL = """
profiles AS (
  SELECT lpad(c_custkey::VARCHAR, 9, '0') AS org, c_name AS name,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'AS' WHEN 'BUILDING' THEN 'BRL' WHEN 'AUTOMOBILE' THEN 'ASA'
              WHEN 'FURNITURE' THEN 'ENK' ELSE 'NUF' END AS legal_form,
         n_name AS municipality, lpad(c_nationkey::VARCHAR, 4, '0') AS municipality_number,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 100)::INTEGER END AS employees,
         c_acctbal < -500 AS bankrupt,
         (c_acctbal >= -500 AND c_acctbal < -250) AS liquidating,
         CASE WHEN c_acctbal > 5000 THEN 'www.customer-' || c_custkey || '.example.com/' END AS website,
         c_acctbal AS revenue, c_mktsegment AS industry_label, CASE c_mktsegment WHEN 'MACHINERY' THEN '28.1' WHEN 'BUILDING' THEN '41.2' WHEN 'AUTOMOBILE' THEN '45.1' WHEN 'FURNITURE' THEN '68.2' ELSE '96.0' END AS industry_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as account records: the order month is the period, the status is the account type."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        padded(F.col("o_custkey")).alias("org"),
        F.col("o_orderkey").alias("record_id"),
        F.when(status == "O", "SELSKAP").when(status == "F", "KONSERN").otherwise("MORSELSKAP").alias("account_type"),
        F.trunc(F.col("o_orderdate").cast("date"), "year").alias("period_from"),
        F.col("o_orderdate").cast("date").alias("period_to"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "EUR").otherwise("NOK").alias("currency"),
        F.col("o_totalprice").alias("revenue"),
    )


ACCOUNTS_SQL = """
accounts AS (
  SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, o_orderkey AS record_id,
         CASE o_orderstatus WHEN 'O' THEN 'SELSKAP' WHEN 'F' THEN 'KONSERN' ELSE 'MORSELSKAP' END AS account_type,
         date_trunc('year', o_orderdate)::DATE AS period_from, o_orderdate::DATE AS period_to,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'EUR' ELSE 'NOK' END AS currency,
         o_totalprice AS revenue
  FROM orders)
"""


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as external observations of the user's entity."""
    events = table(spark, sf, "events")
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k")
    labelled = kind.isin("purchase", "click")
    return events.withColumn("k", props_k(F.col("props"))).select(
        F.concat(F.lit("obs-"), F.col("event_id").cast("string")).alias("id"),
        padded(F.col("user_id")).alias("org"),
        F.when(kind == "view", "company_site").when(kind == "signup", "linkedin").when(kind == "click", "news")
        .when(kind == "purchase", "google_places").when(value < 5, "bulletin").otherwise("job_board").alias("platform"),
        F.when(kind == "view", "public_post").when(kind == "signup", "profile_handle").when(kind == "click", "public_mention")
        .when(kind == "purchase", "review").otherwise("job_posting").alias("signal_type"),
        F.concat(F.lit("https://www."), kind, F.lit("-"), (k / 10).cast("int").cast("string"), F.lit(".example.com/item/"), k.cast("string")).alias("source_url"),
        F.col("ts").cast("timestamp").alias("retrieved_at"),
        (F.col("ts").cast("timestamp") - F.make_interval(days=k)).alias("published_at"),
        F.sha2(F.col("props"), 256).alias("content_sha256"),
        (value >= 1).alias("exact_entity"),
        F.when(value >= 2, F.array(F.create_map(F.lit("type"), F.lit("register_key")))).alias("identity_proof"),
        F.when(k < 80, "official_api").when(k < 90, "jobspy_experiment").otherwise("scrape").alias("acquisition_mode"),
        F.when(value < 200, "approved").otherwise("pending").alias("rights_status"),
        F.when(kind == "purchase", "customer_review").when((kind == "click") & (k < 50), "public_news").otherwise("company_site").alias("source_class"),
        F.when(value > 3, F.col("props")).alias("evidence_span"),
        F.when(kind == "purchase", F.concat(F.lit("r"), k.cast("string"))).alias("reviewer_id"),
        F.when(labelled, F.when(value < 15, "negative").when(value < 60, "neutral").otherwise("positive")).alias("sentiment_label"),
        F.when(labelled & (k < 95), "rules-1").alias("sentiment_model_version"),
        F.col("props").alias("metrics"),
        kind.alias("strategy"),
        k.alias("k"),
        value.alias("value"),
    )


OBSERVATIONS_SQL = """
ev AS (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events),
observations AS (
  SELECT 'obs-' || event_id AS id, lpad(user_id::VARCHAR, 9, '0') AS org,
         CASE event_type WHEN 'view' THEN 'company_site' WHEN 'signup' THEN 'linkedin' WHEN 'click' THEN 'news'
              WHEN 'purchase' THEN 'google_places' ELSE CASE WHEN value < 5 THEN 'bulletin' ELSE 'job_board' END END AS platform,
         CASE event_type WHEN 'view' THEN 'public_post' WHEN 'signup' THEN 'profile_handle' WHEN 'click' THEN 'public_mention'
              WHEN 'purchase' THEN 'review' ELSE 'job_posting' END AS signal_type,
         'https://www.' || event_type || '-' || (k // 10) || '.example.com/item/' || k AS source_url,
         ts AS retrieved_at, ts - to_days(k) AS published_at, sha256(props) AS content_sha256,
         value >= 1 AS exact_entity, value >= 2 AS has_proof,
         CASE WHEN k < 80 THEN 'official_api' WHEN k < 90 THEN 'jobspy_experiment' ELSE 'scrape' END AS acquisition_mode,
         CASE WHEN value < 200 THEN 'approved' ELSE 'pending' END AS rights_status,
         CASE WHEN event_type = 'purchase' THEN 'customer_review' WHEN event_type = 'click' AND k < 50 THEN 'public_news' ELSE 'company_site' END AS source_class,
         CASE WHEN value > 3 THEN props END AS evidence_span,
         CASE WHEN event_type = 'purchase' THEN 'r' || k END AS reviewer_id,
         CASE WHEN event_type IN ('purchase', 'click') THEN CASE WHEN value < 15 THEN 'negative' WHEN value < 60 THEN 'neutral' ELSE 'positive' END END AS sentiment_label,
         CASE WHEN event_type IN ('purchase', 'click') AND k < 95 THEN 'rules-1' END AS sentiment_model_version,
         props AS metrics, event_type AS strategy, k, value
  FROM ev)
"""


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """One evidence record per counter value seen in the events."""
    k = F.col("k")
    return (
        table(spark, sf, "events").select(props_k(F.col("props")).alias("k")).distinct()
        .select(
            F.concat(F.lit("ev"), k.cast("string")).alias("id"),
            F.concat(F.lit("https://src"), k.cast("string"), F.lit(".example.org/a")).alias("source_url"),
            F.when(k < 10, "official_registry").when(k < 20, "official_annual_accounts").when(k < 30, "open_data")
            .when(k < 40, "public_news").when(k < 80, "company_owned").otherwise("external_directory").alias("source_class"),
            F.sha2(k.cast("string"), 256).alias("content_sha256"),
        )
    )


EVIDENCE_SQL = """
evidence AS (
  SELECT DISTINCT 'ev' || k AS id, 'https://src' || k || '.example.org/a' AS source_url,
         CASE WHEN k < 10 THEN 'official_registry' WHEN k < 20 THEN 'official_annual_accounts' WHEN k < 30 THEN 'open_data'
              WHEN k < 40 THEN 'public_news' WHEN k < 80 THEN 'company_owned' ELSE 'external_directory' END AS source_class,
         sha256(k::VARCHAR) AS content_sha256
  FROM (SELECT json_extract_string(props, '$.k')::INTEGER AS k FROM events))
"""


def claims(spark: SparkSession, sf: str) -> DataFrame:
    """Events as claims: the type is the field, the decade of the counter is the subject."""
    k, value = F.col("k"), F.col("value")
    return table(spark, sf, "events").withColumn("k", props_k(F.col("props"))).select(
        padded(F.col("user_id")).alias("org"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("field"),
        F.format_string("%.2f", value).alias("value"),
        F.when(value >= 20, "available").when(value >= 10, "not_available").when(value >= 5, "ambiguous")
        .when(value >= 3, "blocked").when(value >= 1, "not_applicable").otherwise("failed").alias("availability"),
        F.round(F.least(value / 100, F.lit(1.0)), 1).alias("confidence"),
        F.when(k >= 50, F.concat(F.lit("s"), (k / 25).cast("int").cast("string"))).alias("subject"),
        F.when(k < 25, "2024").alias("reporting_period"),
        F.array(F.concat(F.lit("ev"), k.cast("string"))).alias("evidence_ids"),
        F.lit(None).cast("string").alias("note"),
    )


CLAIMS_SQL = """
claims AS (
  SELECT lpad(user_id::VARCHAR, 9, '0') AS org, event_id AS pos, event_type AS field,
         printf('%.2f', value) AS value,
         CASE WHEN value >= 20 THEN 'available' WHEN value >= 10 THEN 'not_available' WHEN value >= 5 THEN 'ambiguous'
              WHEN value >= 3 THEN 'blocked' WHEN value >= 1 THEN 'not_applicable' ELSE 'failed' END AS availability,
         round(least(value / 100, 1.0), 1) AS confidence,
         CASE WHEN k >= 50 THEN 's' || (k // 25) END AS subject,
         CASE WHEN k < 25 THEN '2024' END AS reporting_period,
         'ev' || k AS ev_id,
         event_type || CASE WHEN k >= 50 THEN '|s' || (k // 25) ELSE '' END || CASE WHEN k < 25 THEN '|2024' ELSE '' END AS claim_key
  FROM (SELECT *, json_extract_string(props, '$.k')::INTEGER AS k FROM events))
"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")
