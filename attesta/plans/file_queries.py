"""Readers and writers over files that Spark writes out of the given tables and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from attesta.functions import labels
from attesta.operators import claims as claim_op, observations
from attesta.plans import views
from attesta.plans.catalog import bind, table
from attesta.plans.claim_queries import BEST_SQL, _held
from attesta.plans.views import ACCOUNTS_SQL, PROFILES_SQL
from attesta.session import checkpoint_folder
from attesta.sources import captures, feeds, official, registry


def _fresh(spark, name):
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


@bind(
    "registry_file",
    "A1 A2",
    f"WITH {PROFILES_SQL} SELECT org, name, legal_form, employees, bankrupt, municipality, website, industry_code FROM profiles",
)
def registry_file(spark, sf):
    """The register as compressed separated files with the export's headers, read, typed and folded."""
    folder, p = _fresh(spark, "register"), views.profiles(spark, sf)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("  "))
    header = {
        "organisasjonsnummer": F.col("org"), "navn": F.col("name"), "organisasjonsform.kode": F.col("legal_form"), "antallAnsatte": blank("employees"), "konkurs": F.col("bankrupt").cast("string"),
        "forretningsadresse.kommune": F.concat(F.lit(" "), "municipality"), "hjemmeside": blank("website"), "naeringskode1.kode": F.col("industry_code"),
    }
    short = p.withColumn("org", F.substring("org", 1, 8))
    rows = p.unionByName(short).select(*[c.alias(name) for name, c in header.items()])
    rows.write.option("header", True).option("sep", ";").option("compression", "gzip").csv(folder)
    return registry.build_registry_table(registry.read_registry(spark, folder)).select("org", "name", "legal_form", "employees", "bankrupt", "municipality", "website", "industry_code")


@bind("manifest_file", "A4", f"WITH {PROFILES_SQL} SELECT org, CASE WHEN org::BIGINT % 3 > 0 THEN name END AS name FROM profiles")
def manifest_file(spark, sf):
    """A manifest of three kinds of lines: wrapped lists, objects, bare numbers; every entity comes twice, orders' keys are no entities."""
    folder, p = _fresh(spark, "manifest"), views.profiles(spark, sf)
    kind = F.col("org").cast("long") % 3
    listed = F.to_json(F.struct(F.array(F.struct(F.col("org").alias("organisasjonsnummer"), F.col("name").alias("navn"))).alias("companies")))
    plain = F.to_json(F.struct(F.concat(F.substring("org", 1, 3), F.lit(" "), F.substring("org", 4, 6)).alias("orgnr"), F.col("name").alias("input_name")))
    lines = p.select(F.when(kind == 1, listed).when(kind == 2, plain).otherwise(F.col("org")).alias("value"))
    odd = table(spark, sf, "orders").select(F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"))).alias("value")).filter(F.length("value") < 18)
    lines.unionAll(lines).unionAll(odd).write.text(folder)
    return registry.read_manifest(spark, folder).select("org", "name")


@bind("manifest_strict", "A4", f"WITH {PROFILES_SQL} SELECT org, name FROM profiles")
def manifest_strict(spark, sf):
    """A manifest without faults, one JSON array per municipality, read strictly."""
    folder = _fresh(spark, "manifest")
    entry = F.struct(F.col("org").alias("organisation_number"), "name")
    arrays = views.profiles(spark, sf).groupBy("municipality").agg(F.to_json(F.collect_list(entry)).alias("value")).select("value")
    arrays.write.text(folder)
    return registry.read_manifest(spark, folder, strict=True).select("org", "name")


@bind("org_map_file", "A5", f"WITH {PROFILES_SQL} SELECT org, legal_form FROM profiles WHERE employees IS NOT NULL")
def org_map_file(spark, sf):
    """Maps of entities, one JSON object per municipality; rows that name another entity are left out."""
    folder = _fresh(spark, "map")
    own = F.struct(F.when(F.col("employees").isNotNull(), F.col("org")).otherwise("000000000").alias("org_nr"), "legal_form")
    pairs = views.profiles(spark, sf).groupBy("municipality").agg(F.collect_list(F.struct("org", own.alias("row"))).alias("pairs"))
    maps = pairs.select("municipality", F.to_json(F.map_from_entries("pairs")).alias("value"))
    maps.repartition("municipality").write.partitionBy("municipality").text(folder)
    found = registry.read_org_map(spark, f"{folder}/*")
    return found.select("org", F.try_variant_get("row", "$.legal_form", "string").alias("legal_form"))


@bind(
    "account_records",
    "A13",
    f"WITH {ACCOUNTS_SQL} SELECT org, record_id, account_type, period_from::VARCHAR AS period_from, period_to::VARCHAR AS period_to, currency, CASE WHEN record_id % 5 > 0 THEN revenue END AS revenue, record_id % 2 = 0 AS not_audited FROM accounts",
)
def account_records(spark, sf):
    """Orders as answers of the accounts register, lists and single objects, read into typed records."""
    a = views.accounts(spark, sf)
    revenue = F.struct(F.struct(F.struct(F.when(F.col("record_id") % 5 > 0, F.col("revenue")).alias("sumDriftsinntekter")).alias("driftsinntekter")).alias("driftsresultat"))
    record = F.struct(
        F.col("record_id").alias("id"), F.col("account_type").alias("regnskapstype"), F.struct(F.col("period_from").cast("string").alias("fraDato"), F.col("period_to").cast("string").alias("tilDato")).alias("regnskapsperiode"),
        F.when(F.col("currency") != "NOK", F.col("currency")).alias("valuta"), revenue.alias("resultatregnskapResultat"), F.struct((F.col("record_id") % 2 == 0).alias("ikkeRevidertAarsregnskap")).alias("revisjon"),
    )
    body = F.when(F.col("record_id") % 3 == 0, F.to_json(record)).otherwise(F.to_json(F.array(record)))
    return official.account_records(a.select("org", body.alias("body"))).select("org", "record_id", "account_type", "period_from", "period_to", "currency", "revenue", "not_audited")


@bind(
    "group_parent",
    "A16",
    """SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS org, 'Mor ' || o_custkey AS parent_name, lpad(o_custkey::VARCHAR, 9, '0') AS parent_org FROM orders WHERE o_orderstatus <> 'P'""",
)
def group_parent(spark, sf):
    """Orders as answers of the group register: the parent stated, or found in the list of children, or for someone else only."""
    own, parent = views.padded(F.col("o_orderkey")), views.padded(F.col("o_custkey"))
    name = F.concat(F.lit("Mor "), F.col("o_custkey").cast("string"))
    child = lambda org, who: F.struct(org.alias("organisasjonsnummer"), who.alias("parentNavn"), parent.alias("parentOrganisasjonsnummer"))
    direct = F.to_json(F.struct(name.alias("parentNavn"), parent.alias("parentOrganisasjonsnummer")))
    listed = F.to_json(F.struct(F.array(child(F.lit("999999999"), F.lit("Annen")), child(own, name)).alias("children")))
    others = F.to_json(F.struct(F.array(child(F.lit("999999999"), F.lit("Annen"))).alias("children")))
    status = F.col("o_orderstatus")
    return official.group_parent(table(spark, sf, "orders").select(own.alias("org"), F.when(status == "O", direct).when(status == "F", listed).otherwise(others).alias("body")))


@bind(
    "written_envelopes",
    "A19 D3",
    BEST_SQL + "SELECT org, claim_key, availability, CAST(first_pos AS BIGINT) AS place, count(*) OVER (PARTITION BY org) AS total FROM held",
)
def written_envelopes(spark, sf):
    """Envelopes written as JSON lines, headers and claims, and read back."""
    held, links = _held(spark, sf)
    folder = _fresh(spark, "envelopes")
    headers = claim_op.envelope_headers(held, links, views.evidence(spark, sf))
    captures.write_envelopes(headers, claim_op.envelope_claims(held, headers), folder)
    headers = spark.read.schema("org string, disposition string, total long").json(f"{folder}/headers")
    body = spark.read.schema("org string, disposition string, place long, claim struct<claim_key:string,availability:string>").json(f"{folder}/claims")
    return body.join(headers, ["org", "disposition"]).select("org", "claim.claim_key", "claim.availability", "place", "total")


@bind(
    "subunit_file",
    "A1 A3",
    "SELECT lpad(o_orderkey::VARCHAR, 9, '0') AS subunit_org, lpad(o_custkey::VARCHAR, 9, '0') AS parent_org, 'Enhet ' || o_orderkey AS name, CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 90)::INTEGER END AS employees FROM orders WHERE o_orderstatus <> 'P'",
)
def subunit_file(spark, sf):
    """Orders as the subunit export: separated files with quoted names; pending ones have no usable parent."""
    folder, key = _fresh(spark, "subunits"), F.col("o_orderkey")
    parent = F.when(F.col("o_orderstatus") == "P", F.col("o_custkey").cast("string")).otherwise(views.padded(F.col("o_custkey")))
    parent = F.when(F.col("o_orderstatus") == "P", F.substring(parent, 1, 8)).otherwise(parent)
    rows = table(spark, sf, "orders").select(
        views.padded(key).alias("Organisasjonsnummer"), parent.alias("Overordnet enhet"), F.concat(F.lit("Enhet "), key.cast("string")).alias("Navn"), F.when(key % 4 > 0, key % 90).cast("string").alias("Antall ansatte")
    )
    rows.write.option("header", True).option("sep", ",").option("quoteAll", True).csv(folder)
    return registry.build_subunit_table(registry.read_subunits(spark, folder)).select("subunit_org", "parent_org", "name", "employees")


@bind("filing_years", "A14", "SELECT lpad(o_custkey::VARCHAR, 9, '0') AS org, year(o_orderdate)::VARCHAR AS year FROM orders")
def filing_years(spark, sf):
    """Customers' order years as the answer of the filing register, a list each."""
    years = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(F.year("o_orderdate").cast("string")).alias("years"))
    return official.filing_years(years.select(views.padded(F.col("o_custkey")).alias("org"), F.to_json("years").alias("body")))


@bind(
    "subunit_rows",
    "A12",
    "SELECT lpad(o_custkey::VARCHAR, 9, '0') AS parent_org, lpad(o_orderkey::VARCHAR, 9, '0') AS subunit_org, 'Enhet ' || o_orderkey AS name, (o_orderkey % 90)::INTEGER AS employees, 'www.enhet-' || o_orderkey || '.no' AS website FROM orders",
)
def subunit_rows(spark, sf):
    """Orders as the subunits of a customer's answer, read back into rows."""
    key = F.col("o_orderkey")
    unit = F.struct(
        views.padded(key).alias("organisasjonsnummer"), F.concat(F.lit("Enhet "), key.cast("string")).alias("navn"), (key % 90).cast("int").alias("antallAnsatte"),
        F.concat(F.lit("www.enhet-"), key.cast("string"), F.lit(".no")).alias("hjemmeside"),
    )
    body = F.to_json(F.struct(F.struct(F.array(unit).alias("underenheter")).alias("_embedded")))
    answers = table(spark, sf, "orders").select(views.padded(F.col("o_custkey")).alias("org"), body.alias("body"))
    return official.subunit_rows(answers).select("parent_org", "subunit_org", "name", "employees", "website")


@bind("discovery_query", "G18", f"""WITH {PROFILES_SQL} SELECT org, '"' || name || '" ' || org || ' ' || municipality AS query FROM profiles""")
def discovery_query(spark, sf):
    p = views.profiles(spark, sf)
    return p.select("org", labels.discovery_query(F.concat(F.lit(" "), F.replace("name", F.lit(" "), F.lit("  "))), F.concat(F.substring("org", 1, 3), F.lit(" "), F.substring("org", 4, 6)), F.col("municipality")).alias("query"))


@bind("duplicate_ids", "D9", "SELECT o_custkey::VARCHAR AS id, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return observations.duplicate_ids(table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("id")))


@bind("map_priority", "A9", "SELECT page_id, CASE WHEN regexp_matches(lower(url), 'news|nyhet|post|artik|blog|press|aktuelt') THEN 0 ELSE 1 END AS priority FROM pages")
def map_priority(spark, sf):
    return views.pages(spark, sf).select("page_id", feeds.map_priority(F.col("url")).alias("priority"))
