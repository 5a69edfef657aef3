"""Register tables, indexes, accounts and captures over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta.operators import register as reg
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.claim_queries import BEST_SQL, _held
from attesta.plans.views import ACCOUNTS_SQL, PROFILES_SQL
from attesta.session import checkpoint_folder
from attesta.sources import captures, feeds, official, registry


def _register_updates(spark, sf):
    """Orders as register rows: a low-priority row carries an unusable key, a later one replaces an earlier."""
    key = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_custkey").cast("string")).otherwise(views.padded(F.col("o_custkey")))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), key.alias("org"), F.col("o_orderstatus").alias("legal_form"),
        F.lpad(F.floor(F.col("o_totalprice") / 50000).cast("string"), 4, "0").alias("municipality_number"),
        F.date_format("o_orderdate", "yyyy").alias("latest_submitted_accounts"),
    )


UPDATES_SQL = """
updates AS (SELECT o_orderkey AS pos, CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey::VARCHAR ELSE lpad(o_custkey::VARCHAR, 9, '0') END AS org,
  o_orderstatus AS legal_form, lpad(floor(o_totalprice / 50000)::INTEGER::VARCHAR, 4, '0') AS municipality_number,
  strftime(o_orderdate, '%Y') AS latest_submitted_accounts FROM orders)
"""


@bind(
    "registry_table",
    "A1 A2",
    f"""WITH {UPDATES_SQL} SELECT org, arg_max(legal_form, pos) AS legal_form, arg_max(municipality_number, pos) AS municipality_number,
  arg_max(latest_submitted_accounts, pos) AS latest_submitted_accounts FROM updates WHERE length(org) = 9 GROUP BY org""",
)
def registry_table(spark, sf):
    return registry.build_registry_table(_register_updates(spark, sf))


@bind(
    "registry_counters",
    "A2",
    f"WITH {UPDATES_SQL} SELECT count(*) AS rows_read, count(*) FILTER (length(org) = 9) AS rows_indexed, count(DISTINCT org) FILTER (length(org) = 9) AS companies FROM updates",
)
def registry_counters(spark, sf):
    return registry.registry_counters(_register_updates(spark, sf)).drop("source_sha256")


def _subunits(spark, sf):
    """Orders as subunits of the customer that placed them."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pos"), views.padded(F.col("o_orderkey")).alias("subunit_org"),
        views.padded(F.col("o_custkey")).alias("parent_org"), F.floor(F.col("o_totalprice") / 100000).cast("int").alias("employees"),
    )


@bind(
    "subunit_parents",
    "A3",
    """SELECT lpad(o_custkey::VARCHAR, 9, '0') AS parent_org, count(DISTINCT o_orderkey) AS subunits, sum(floor(o_totalprice / 100000))::BIGINT AS employees
FROM orders GROUP BY 1""",
)
def subunit_parents(spark, sf):
    return registry.subunit_parents(registry.build_subunit_table(_subunits(spark, sf)))


MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _contacts(spark, sf):
    """Documents as register rows whose e-mail is the first one in the text."""
    return table(spark, sf, "documents").select(
        views.padded(F.col("doc_id")).alias("org"),
        F.when(F.col("source") == "src1", F.concat(F.lit("www."), "source", F.lit(".example.com"))).alias("website"),
        F.nullif(F.regexp_extract("text", f"({MAIL})", 1), F.lit("")).alias("email"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("mobile"), F.col("lang").alias("municipality"),
    )


CONTACTS_SQL = f"""
contacts AS (SELECT lpad(doc_id::VARCHAR, 9, '0') AS org, CASE WHEN source = 'src1' THEN 'www.src1.example.com' END AS homepage,
  nullif(lower(regexp_extract(text, '{MAIL[:-1].split("@")[0]}@([A-Za-z0-9.-]+\\.[A-Za-z]{{2,}})', 1)), '') AS mail_domain, lang AS municipality FROM documents)
"""


@bind("domain_index", "A6", f"WITH {CONTACTS_SQL} SELECT org, homepage, mail_domain, municipality FROM contacts WHERE homepage IS NOT NULL OR mail_domain IS NOT NULL")
def domain_index(spark, sf):
    return registry.build_domain_index(_contacts(spark, sf)).drop("phone")


@bind(
    "domain_index_coverage",
    "A6",
    f"""WITH {CONTACTS_SQL} SELECT count(*) AS rows, count(homepage) AS with_homepage, count(mail_domain) AS with_email, count(mail_domain) AS with_own_domain,
  count(*) FILTER (homepage IS NOT NULL OR mail_domain IS NOT NULL) AS indexed FROM contacts""",
)
def domain_index_coverage(spark, sf):
    return registry.domain_index_coverage(_contacts(spark, sf))


def _seed_maps(spark, sf):
    supplier, customer = table(spark, sf, "supplier"), table(spark, sf, "customer")
    base = supplier.select(
        views.padded(F.col("s_suppkey")).alias("org"),
        F.when(F.col("s_acctbal") > 4000, F.concat(F.lit("Supplier-"), F.col("s_suppkey").cast("string"), F.lit(".example.com"))).alias("homepage"),
        F.when(F.col("s_acctbal") < 1000, F.concat(F.lit("mail"), F.col("s_nationkey").cast("string"), F.lit(".example.org"))).alias("mail_domain"),
    )
    incoming = customer.select(
        views.padded(F.col("c_custkey")).alias("org"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("https://www.customer-"), F.col("c_nationkey").cast("string"), F.lit(".example.com/"))).alias("website"),
        F.concat(F.lit("https://profiles.example.com/"), "c_name").alias("profile_url"),
    )
    return registry.merge_seed_maps(base, incoming)


SEEDS_SQL = """
merged AS (SELECT org, coalesce(homepage, website) AS homepage, mail_domain, profile_url FROM
  (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, CASE WHEN s_acctbal > 4000 THEN 'Supplier-' || s_suppkey || '.example.com' END AS homepage,
     CASE WHEN s_acctbal < 1000 THEN 'mail' || s_nationkey || '.example.org' END AS mail_domain FROM supplier)
  FULL JOIN (SELECT lpad(c_custkey::VARCHAR, 9, '0') AS org, CASE WHEN c_acctbal > 0 THEN 'www.customer-' || c_nationkey || '.example.com' END AS website,
     'https://profiles.example.com/' || c_name AS profile_url FROM customer) USING (org))
"""


@bind("merge_seed_maps", "A7", f"WITH {SEEDS_SQL} SELECT * FROM merged")
def merge_seed_maps(spark, sf):
    return _seed_maps(spark, sf)


@bind(
    "crawl_targets",
    "A7",
    f"WITH {SEEDS_SQL} SELECT DISTINCT replace(lower(site), 'www.', '') AS host FROM (SELECT homepage AS site FROM merged UNION ALL SELECT mail_domain FROM merged) WHERE site IS NOT NULL",
)
def crawl_targets(spark, sf):
    return registry.crawl_targets(_seed_maps(spark, sf))


KEPT_SQL = f"""
WITH {ACCOUNTS_SQL}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY period_to DESC, (account_type <> 'KONSERN') DESC, record_id DESC) AS place FROM accounts) WHERE place <= 3)
"""


@bind("normalize_accounts", "A13", KEPT_SQL + "SELECT org, place, record_id, account_type, period_to::VARCHAR AS period_to, revenue FROM kept")
def normalize_accounts(spark, sf):
    rows = official.normalize_accounts(views.accounts(spark, sf), keep=3)
    return rows.select("org", "place", "record_id", "account_type", F.col("period_to").cast("string").alias("period_to"), "revenue")


@bind(
    "account_claims",
    "A13",
    KEPT_SQL.replace("WHERE place <= 3", "")
    + """SELECT org, place, 'revenue' AS field, revenue AS amount, CASE WHEN account_type = 'KONSERN' THEN 'consolidated' ELSE 'entity' END AS subject,
  strftime(period_to, '%Y') AS reporting_period, currency FROM kept""",
)
def account_claims(spark, sf):
    claims = official.account_claims(official.normalize_accounts(views.accounts(spark, sf)))
    return claims.select(
        "org", F.col("pos.place").alias("place"), "field", F.get_json_object("value", "$.amount").cast("double").alias("amount"),
        "subject", "reporting_period", F.get_json_object("value", "$.currency").alias("currency"),
    )


@bind(
    "filing_history",
    "A14",
    """SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, string_agg(DISTINCT strftime(o_orderdate, '%Y'), ',' ORDER BY strftime(o_orderdate, '%Y')) AS years,
  min(year(o_orderdate)) AS first_year, count(DISTINCT year(o_orderdate)) AS filings FROM orders GROUP BY 1""",
)
def filing_history(spark, sf):
    years = table(spark, sf, "orders").select(views.padded(F.col("o_custkey")).alias("org"), F.date_format("o_orderdate", "yyyy").alias("year"))
    return official.filing_history(years).withColumn("years", F.array_join("years", ","))


@bind(
    "latest_registry_update",
    "A15",
    """SELECT lpad(user_id::VARCHAR, 9, '0') AS org, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_update, arg_max(event_type, (ts, event_id)) AS change_type,
  arg_max(event_id, (ts, event_id)) AS update_id, count(*) AS updates FROM events GROUP BY 1""",
)
def latest_registry_update(spark, sf):
    updates = table(spark, sf, "events").select(
        views.padded(F.col("user_id")).alias("org"), F.col("ts").alias("at"), F.col("event_type").alias("change_type"), F.col("event_id").alias("update_id")
    )
    return official.latest_registry_update(updates).withColumn("latest_update", F.date_format("latest_update", "yyyy-MM-dd HH:mm:ss"))


@bind(
    "group_edges",
    "A16",
    """SELECT 'c' || c_custkey AS org, 'n' || n_nationkey AS parent_org, n_name AS parent_name FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'n' || n_nationkey, 'r' || r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def group_edges(spark, sf):
    def tag(letter, key):
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    none = F.lit(None).cast("string")
    entities = (
        table(spark, sf, "customer").select(tag("c", "c_custkey").alias("org"), F.col("c_name").alias("name"), tag("n", "c_nationkey").alias("parent_org"))
        .unionAll(table(spark, sf, "nation").select(tag("n", "n_nationkey"), "n_name", tag("r", "n_regionkey")))
        .unionAll(table(spark, sf, "region").select(tag("r", "r_regionkey"), "r_name", none))
    )
    return official.group_edges(entities)


@bind("new_captures", "A17", "SELECT DISTINCT sha256(html) AS content_sha256, length(html) AS chars FROM pages WHERE sha256(html) NOT IN (SELECT sha256(html) FROM pages WHERE url LIKE 'https:%')")
def new_captures(spark, sf):
    pages = views.pages(spark, sf)
    store = captures.capture_rows(pages.filter(F.col("url").startswith("https:")), "html")
    return captures.new_captures(pages, store, "html").select("content_sha256", F.length("body").alias("chars"))


@bind("append_captures", "A17", "SELECT sha256(html) AS content_sha256, length(html) AS chars, CASE WHEN bool_or(url LIKE 'https:%') THEN 0 ELSE 1 END::BIGINT AS batch FROM pages GROUP BY html")
def append_captures(spark, sf):
    """A store that gets the secure pages, then all pages, then all again: the third run writes nothing."""
    pages = views.pages(spark, sf)
    store = captures.CaptureStore(spark, f"{checkpoint_folder(spark)}/captures-{uuid.uuid4().hex}", f"capture_digests_{uuid.uuid4().hex}")
    for batch, rows in enumerate((pages.filter(F.col("url").startswith("https:")), pages, pages)):
        store.append(rows, batch, "html")
    held = store.digests().select("content_sha256", F.col("batch").alias("known"))
    return store.bodies().join(held, "content_sha256").filter("batch = known").select("content_sha256", F.length("body").alias("chars"), "batch")


def _audited(spark, sf):
    pages = views.pages(spark, sf)
    records = pages.select(F.col("page_id").cast("string").alias("org"), "url", F.sha2("html", 256).alias("content_sha256"))
    # Every plain-http capture is kept altered, so the audit has something to find.
    store = captures.capture_rows(pages, "html").join(
        records.groupBy("content_sha256").agg(F.bool_or(F.col("url").startswith("http:")).alias("altered")), "content_sha256"
    )
    return captures.audit_captures(records, store.withColumn("body", F.when(F.col("altered"), F.upper("body")).otherwise(F.col("body"))))


@bind("audit_captures", "A18", "SELECT page_id::VARCHAR AS org, NOT bool_or(url LIKE 'http:%') OVER (PARTITION BY html) AS intact FROM pages")
def audit_captures(spark, sf):
    return _audited(spark, sf).select("org", "intact")


@bind(
    "audit_capture_summary",
    "A18",
    """SELECT count(*) AS captures_checked, count(*) FILTER (bad) AS failures, count(*) AS accepted_sites, count(*) FILTER (bad) = 0 AS passed
FROM (SELECT bool_or(url LIKE 'http:%') OVER (PARTITION BY html) AS bad FROM pages)""",
)
def audit_capture_summary(spark, sf):
    return captures.audit_summary(_audited(spark, sf))


@bind(
    "envelope_json",
    "A19",
    BEST_SQL
    + """SELECT '{"org":"' || org || '","claim_key":"' || claim_key || '","availability":"' || availability || '","first_pos":' || first_pos || '}' AS line FROM held""",
)
def envelope_json(spark, sf):
    held, _ = _held(spark, sf)
    rows = held.select("org", "claim_key", "availability", "first_pos")
    return rows.select(captures.json_lines(rows).alias("line"))


@bind(
    "apply_verified_seeds",
    "A20",
    f"""WITH {PROFILES_SQL} SELECT org, coalesce(s.site, website) AS website, CASE WHEN s.site IS NOT NULL THEN 'independently_verified_exact_entity' END AS website_seed_source
FROM profiles LEFT JOIN (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, 'https://' || lower(replace(s_name, '#', '-')) || '.example.com' AS site FROM supplier) s USING (org)""",
)
def apply_verified_seeds(spark, sf):
    seeds = table(spark, sf, "supplier").select(
        views.padded(F.col("s_suppkey")).alias("org"),
        F.concat(F.lit("https://"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.lit(".example.com")).alias("website"),
        F.concat(F.lit("https://proof.example.org/"), F.col("s_suppkey").cast("string")).alias("proof_url"),
    )
    return registry.apply_verified_seeds(views.profiles(spark, sf), seeds).select("org", "website", "website_seed_source")


def _manifest(spark, sf):
    """The customers with an order, and suppliers under numbers that the register does not have."""
    known = table(spark, sf, "orders").groupBy(views.padded(F.col("o_custkey")).alias("org")).agg(F.min("o_orderkey").alias("pos"))
    unknown = table(spark, sf, "supplier").select(F.col("s_suppkey") + 900_000_000, F.negate(F.col("s_suppkey")) - 1).toDF("org", "pos")
    return known.unionAll(unknown.select(F.col("org").cast("string"), "pos"))


MANIFEST_SQL = """manifest AS (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, min(o_orderkey) AS pos FROM orders GROUP BY 1 UNION ALL SELECT (s_suppkey + 900000000)::VARCHAR, -s_suppkey - 1 FROM supplier)"""


@bind("select_from_registry", "C1", f"WITH {PROFILES_SQL}, {MANIFEST_SQL} SELECT org, pos, name, revenue FROM manifest JOIN profiles USING (org)")
def select_from_registry(spark, sf):
    return registry.select_from_registry(views.profiles(spark, sf), _manifest(spark, sf)).select("org", "pos", "name", "revenue")


@bind("missing_from_registry", "C1", f"WITH {PROFILES_SQL}, {MANIFEST_SQL} SELECT org, pos FROM manifest WHERE org NOT IN (SELECT org FROM profiles)")
def missing_from_registry(spark, sf):
    return registry.missing_from_registry(views.profiles(spark, sf), _manifest(spark, sf))


@bind(
    "seed_coverage",
    "D17",
    f"""WITH {PROFILES_SQL}, s AS (SELECT org, 1 AS m FROM profiles WHERE website IS NOT NULL UNION SELECT lpad(o_custkey::VARCHAR, 9, '0'), 2 FROM orders WHERE o_orderstatus = 'F'
  UNION SELECT lpad(user_id::VARCHAR, 9, '0'), 4 FROM events), t AS (SELECT org, sum(m) AS m FROM s GROUP BY org)
SELECT count(*) AS companies, count(*) FILTER (m % 2 = 1) AS in_site, count(*) FILTER (m = 1) AS only_site, count(*) FILTER (m IN (2, 3, 6, 7)) AS in_accounts, count(*) FILTER (m = 2) AS only_accounts,
  count(*) FILTER (m >= 4) AS in_activity, count(*) FILTER (m = 4) AS only_activity FROM t""",
)
def seed_coverage(spark, sf):
    return registry.seed_coverage(
        {
            "site": views.profiles(spark, sf).filter("website IS NOT NULL"),
            "accounts": table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(views.padded(F.col("o_custkey")).alias("org")),
            "activity": table(spark, sf, "events").select(views.padded(F.col("user_id")).alias("org")),
        }
    )


@bind(
    "video_activity",
    "D26",
    """SELECT lpad(user_id::VARCHAR, 9, '0') AS org, count(*) AS uploads, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_published, arg_max(event_type, (ts, event_id::VARCHAR)) AS latest_title,
  sum(json_extract_string(props, '$.k')::BIGINT) FILTER (event_type <> 'error')::BIGINT AS views, count(*) FILTER (event_type <> 'error') AS items_with_views FROM events GROUP BY 1""",
)
def video_activity(spark, sf):
    k = F.get_json_object("props", "$.k")
    items = table(spark, sf, "events").select(
        views.padded(F.col("user_id")).alias("org"), F.col("ts").alias("published"), F.col("event_type").alias("title"),
        F.col("event_id").cast("string").alias("link"), F.when(F.col("event_type") == "error", F.concat(k, F.lit(" views"))).otherwise(k).alias("views"),
    )
    return feeds.video_activity(items).select(
        "org", "uploads", F.date_format("latest_published", "yyyy-MM-dd HH:mm:ss").alias("latest_published"), "latest_title", "views", "items_with_views"
    )


# ---- register predicates ----


def _filed_profiles(spark, sf):
    """Profiles with the year of their newest order as the account year."""
    years = table(spark, sf, "orders").groupBy(views.padded(F.col("o_custkey")).alias("org")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy").alias("latest_submitted_accounts")
    )
    return views.profiles(spark, sf).join(years, "org", "left")


FILED_SQL = (
    PROFILES_SQL
    + """, filed AS (SELECT p.*, y.y AS latest_submitted_accounts FROM profiles p
  LEFT JOIN (SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, strftime(max(o_orderdate), '%Y') AS y FROM orders GROUP BY 1) y USING (org)),
tiered AS (SELECT *, CASE WHEN website IS NOT NULL OR coalesce(employees, 0) >= 5 THEN 'rich' WHEN coalesce(employees, 0) >= 1 OR legal_form = 'NUF' THEN 'standard'
   WHEN legal_form = 'AS' AND latest_submitted_accounts IS NOT NULL AND NOT bankrupt AND NOT liquidating THEN 'standard' ELSE 'shell' END AS tier FROM filed)
"""
)


@bind("classify_tier", "B2", f"WITH {FILED_SQL} SELECT org, tier FROM tiered")
def classify_tier(spark, sf):
    return _filed_profiles(spark, sf).select("org", reg.tier().alias("tier"))


@bind(
    "discovery_eligibility",
    "B3",
    f"""WITH {FILED_SQL} SELECT org, tier <> 'shell' AND NOT bankrupt AND NOT liquidating AND legal_form <> 'BRL' AND (coalesce(employees, 0) >= 1 OR (legal_form = 'AS' AND latest_submitted_accounts IS NOT NULL)) AS search,
  legal_form <> 'BRL' AND NOT bankrupt AND NOT liquidating AND NOT (industry_code = '68.2' AND coalesce(employees, 0) < 5)
  AND (industry_code IN ('41.2', '45.1', '96.0') OR coalesce(employees, 0) >= 2 OR (tier = 'rich' AND coalesce(employees, 0) >= 1)) AS places FROM tiered""",
)
def discovery_eligibility(spark, sf):
    rows = _filed_profiles(spark, sf).withColumn("tier", reg.tier())
    return rows.select("org", reg.search_eligible(F.col("tier")).alias("search"), reg.places_eligible(F.col("tier")).alias("places"))


@bind(
    "accounting_obligation",
    "B4",
    f"""WITH {FILED_SQL} SELECT org, CASE WHEN latest_submitted_accounts IS NOT NULL THEN 'filing_observed' WHEN legal_form IN ('AS', 'ASA', 'BRL') THEN 'required_by_legal_form'
  WHEN legal_form IN ('ENK', 'NUF') THEN 'threshold_or_activity_dependent' ELSE 'special_rule_or_review_required' END AS classification FROM filed""",
)
def accounting_obligation(spark, sf):
    return _filed_profiles(spark, sf).select("org", reg.accounting_obligation()["classification"].alias("classification"))


@bind("filer_eligible", "B5", f"WITH {FILED_SQL} SELECT org FROM filed WHERE latest_submitted_accounts = '2001' AND NOT bankrupt AND NOT liquidating")
def filer_eligible(spark, sf):
    return _filed_profiles(spark, sf).filter(reg.filer_eligible("2001")).select("org")


@bind(
    "enrich_profile",
    "B1",
    f"""WITH {PROFILES_SQL}, r AS (SELECT lpad(s_suppkey::VARCHAR, 9, '0') AS org, s_name, s_nationkey, s_acctbal FROM supplier)
SELECT p.org, coalesce(CASE WHEN p.revenue > 2000 THEN p.name END, r.s_name) AS name, coalesce(p.website, CASE WHEN r.s_acctbal > 0 THEN 'https://mail' || r.s_nationkey || '.example.com' END) AS website,
  coalesce(p.employees, CASE WHEN r.s_acctbal > 5000 THEN r.s_nationkey END) AS employees, coalesce(p.legal_form, 'AS') AS legal_form FROM profiles p LEFT JOIN r USING (org)""",
)
def enrich_profile(spark, sf):
    profiles = views.profiles(spark, sf).select(
        "org", F.when(F.col("revenue") > 2000, F.col("name")).otherwise("").alias("name"), "website", "employees", "legal_form"
    )
    register = table(spark, sf, "supplier").select(
        views.padded(F.col("s_suppkey")).alias("org"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("post@mail"), F.col("s_nationkey").cast("string"), F.lit(".example.com"))).alias("website"),
        F.col("s_nationkey").alias("employees"), (F.col("s_acctbal") > 5000).alias("employees_registered"), F.lit("AS").alias("legal_form"),
    )
    rows = reg.enrich_profile(profiles, register)
    return rows.select("org", F.nullif("name", F.lit("")).alias("name"), "website", "employees", "legal_form")


@bind(
    "publication_eligible",
    "B9",
    """WITH first AS (SELECT o_custkey, quantile_disc(o_orderdate, 0.5) AS founded FROM orders GROUP BY 1)
SELECT o.o_orderkey AS item_id, CASE WHEN o_orderpriority = '5-LOW' THEN 'missing_supported_publication_date' WHEN o_orderdate < founded THEN 'predates_exact_legal_entity'
  WHEN o_orderpriority = '1-URGENT' THEN 'default_template_content' END AS withheld FROM orders o JOIN first USING (o_custkey)""",
)
def publication_eligible(spark, sf):
    orders = table(spark, sf, "orders")
    org = views.padded(F.col("o_custkey")).alias("org")
    founded = orders.groupBy(org).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(CAST(o_orderdate AS DATE)))").alias("x"))
    founded = founded.select("org", F.date_from_unix_date(F.col("x").cast("int")).alias("founded"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    items = orders.select(
        F.col("o_orderkey").alias("item_id"), org, F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published"),
        F.when(urgent, "https://x.example.com/hello-world/").otherwise("https://x.example.com/news/a").alias("url"),
        F.when(urgent, "Hello world!").otherwise("Annual result").alias("text"),
    )
    return reg.publication_eligible(items, founded).select("item_id", "withheld")
