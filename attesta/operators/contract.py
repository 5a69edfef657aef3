"""The flat contract of an entity: one vocabulary from claims to contract to the differences of two contracts.

A contract is a long table (org, field, place, value, availability, confidence, claim_key, tier). Fields with one value have one row,
fields with several one row per value, and a field that nothing was found for has one row that says so. Values are rendered as
the contract shows them; nothing is invented.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.functions.text import format_address
from attesta.operators.diffs import MULTI_VALUED, REFRESH_FIELDS, diff_envelopes
from attesta.session import stored

# Contract fields, the claim fields each is made of (the first with an available claim counts), and how its value reads.
FIELDS = {
    "legal_name": (["legal_name"], "plain"),
    "legal_form": (["organisation_form", "legal_form"], "code"),
    "registered_business_address": (["registered_address", "registered_business_address"], "address"),
    "industry": (["industry_code", "industry"], "labelled"),
    "employee_count": (["employees", "employee_count"], "plain"),
    "bankruptcy_or_liquidation_status": (["operating_status", "bankruptcy_or_liquidation_status"], "status"),
    "accounting_obligation_status": (["accounting_obligation_status"], "plain"),
    "latest_annual_revenue": (["revenue", "latest_annual_revenue"], "amount"),
    "latest_annual_result": (["operating_result", "latest_annual_result"], "amount"),
    "latest_total_assets": (["total_assets", "latest_total_assets"], "amount"),
    "latest_equity": (["equity", "latest_equity"], "amount"),
    "leadership_role": (["leadership", "leadership_role"], "person"),
    "registered_workplace": (["location", "registered_workplace"], "workplace"),
    "corporate_group_structure": (["in_corporate_group", "corporate_group_structure"], "plain"),
    "official_website": (["website", "official_website"], "plain"),
    "hiring_or_activity_signal": (["hiring_or_activity_signal", "job_posting", "active_job_count"], "plain"),
    "dated_public_activity": (["dated_public_activity", "news_mention", "registry_update"], "plain"),
    "social_profiles": (["social_profiles", "social_links"], "plain"),
    "accounts_filing_years": (["accounts_filing_years"], "plain"),
    "active_job_count": (["active_job_count"], "plain"),
    "job_posting": (["job_posting"], "plain"),
    "ratings_and_reviews": (["ratings_and_reviews"], "plain"),
    "buzz_or_engagement": (["buzz_or_engagement", "ratings_and_reviews", "dated_public_activity"], "plain"),
    "qualified_sentiment": (["qualified_sentiment"], "plain"),
    "news_mention": (["news_mention"], "plain"),
}
SEVERAL = [*MULTI_VALUED, "job_posting", "news_mention"]
OPTIONAL = ["job_posting", "news_mention"]  # no row where there is no value
# Of a shell company these do not apply; the last one not either where the register counts no employees.
NOT_OF_SHELLS = ["hiring_or_activity_signal", "dated_public_activity", "social_profiles", "ratings_and_reviews", "active_job_count"]
UNCERTAIN = {"official_website": ["ambiguous", "blocked"]}  # states that are kept


def rendered(kind: Column, source: Column, value: Column) -> Column:
    """A claim's value as the contract shows it; plain text and JSON of other shapes stay."""
    get = lambda path: F.get_json_object(value, f"$.{path}")
    address = lambda at: format_address(get(f"{at}street"), get(f"{at}postal_code"), get(f"{at}postal_town"), get(f"{at}country"))
    json = F.coalesce(F.ltrim(value).startswith("{"), F.lit(False))
    flag = lambda *paths: F.coalesce(*[get(p).try_cast("boolean") for p in paths], F.lit(False))
    place = F.when(get("address").isNotNull(), address("address."))
    readings = {
        "code": get("code"),
        "address": address(""),
        "labelled": F.concat_ws(" - ", get("code"), get("description")),
        "status": F.to_json(F.struct(flag("bankrupt").alias("bankrupt"), flag("under_liquidation", "liquidating").alias("liquidating"))),
        "amount": get("amount"),
        "person": F.concat(F.coalesce(get("role_title_no"), get("role"), F.lit("Role")), F.lit(": "), F.coalesce(get("name"), F.lit("Holder"))),
        "workplace": F.concat_ws(" — ", F.coalesce(get("name"), F.lit("Subunit")), F.nullif(place, F.lit(""))),
    }
    count = F.to_json(F.struct(value.try_cast("long").alias("active_job_ads"), F.lit("nav_no").alias("source")))
    kind_of_change = F.coalesce(get("change_type"), get("endringstype"))
    day = F.coalesce(get("latest_update_date"), F.substring(get("dato"), 1, 10), get("date"))
    update = F.to_json(F.struct(
        F.concat_ws(": ", F.lit("Official registration change"), kind_of_change).alias("title"), day.alias("date"), kind_of_change.alias("change_type"), F.lit("official_registry").alias("source")
    ))
    reviews = F.to_json(F.struct(F.coalesce(get("review_count").try_cast("long"), F.lit(1)).alias("public_reviews"), get("rating").try_cast("double").alias("rating")))
    by_source = F.when(source == "hiring_or_activity_signal|active_job_count", count).when(source == "dated_public_activity|registry_update", update)
    by_source = by_source.when(source == "buzz_or_engagement|ratings_and_reviews", reviews)
    by_kind = reduce(lambda a, b: F.coalesce(a, b), [F.when(json & (kind == k), text) for k, text in readings.items()])
    return F.coalesce(by_source, by_kind, value)


def contract(claims: DataFrame, orgs: DataFrame) -> DataFrame:
    """The contract of every entity of ``orgs`` (org, tier), from claims (org, field, value, availability, confidence, first_pos, claim_key)."""
    spark = claims.sparkSession
    # Every part below reads them, so they are made once.
    claims = stored(claims.select("org", "field", "value", "availability", "confidence", "first_pos", "claim_key"), "contract-claims")
    orgs = stored(orgs.select("org", "tier").distinct(), "contract-orgs")
    listed = [(target, source, i, kind, target in SEVERAL) for target, (sources, kind) in FIELDS.items() for i, source in enumerate(sources)]
    mapping = spark.createDataFrame(listed, "target string, field string, preference int, kind string, several boolean")  # a fixed list
    held = claims.join(F.broadcast(mapping), "field").filter(F.col("availability").isNotNull())
    stated = held.filter(F.col("availability") == "available")
    # The first source with an available claim; of a field with several values all its claims, else the earliest.
    best = stated.groupBy("org", "target").agg(F.min("preference").alias("preference"))
    from_best = stated.join(best, ["org", "target", "preference"])
    order = W.partitionBy("org", "target").orderBy("first_pos", "claim_key")
    single = from_best.filter("NOT several").groupBy("org", "target").agg(F.min_by(F.struct("kind", "field", "value", "confidence", "claim_key"), F.struct("first_pos", "claim_key")).alias("x")).select("org", "target", F.lit(1).alias("place"), "x.*")
    many = from_best.filter("several").withColumn("place", F.row_number().over(order)).select("org", "target", "place", "kind", "field", "value", "confidence", "claim_key")
    source = F.concat_ws("|", "target", "field")
    found = single.unionByName(many).select("org", F.col("target").alias("field"), "place", rendered(F.col("kind"), source, F.col("value")).alias("value"), F.lit("available").alias("availability"), "confidence", "claim_key")
    found = stored(found, "contract-found")
    doubtful = [(F.col("target") == t) & F.col("availability").isin(states) for t, states in UNCERTAIN.items()]
    doubts = held.filter(reduce(lambda a, b: a | b, doubtful)).groupBy("org", "target").agg(F.min_by(F.struct("availability", "confidence", "claim_key"), F.struct("preference", "first_pos")).alias("d"))
    wanted = orgs.withColumn("field", F.explode(F.array(*[F.lit(f) for f in FIELDS if f not in OPTIONAL])))
    staff = claims.filter(F.col("field").isin("employees", "employee_count") & (F.col("availability") == "available")).groupBy("org").agg(F.min_by("value", "first_pos").try_cast("double").alias("staff"))
    site = stated.filter(F.col("target") == "official_website").select("org").distinct().withColumn("site", F.lit(True))
    gaps = wanted.join(found.select("org", "field").distinct(), ["org", "field"], "left_anti").join(doubts.withColumnRenamed("target", "field"), ["org", "field"], "left").join(staff, "org", "left").join(site, "org", "left")
    shell = F.col("field").isin(NOT_OF_SHELLS) & (F.col("tier") == "shell")
    nobody = (F.col("field") == "active_job_count") & (F.col("staff") == 0)
    silent = (F.col("field") == "buzz_or_engagement") & F.col("site").isNull()
    idle = F.coalesce(shell, F.lit(False)) | F.coalesce(nobody, F.lit(False)) | silent
    state = F.coalesce("d.availability", F.when(idle, "not_applicable").otherwise("not_available"))
    sure = F.coalesce("d.confidence", F.when(idle, 1.0).otherwise(0.6))
    none = F.lit(None).cast("string")
    empty = gaps.select("org", "field", F.lit(1).alias("place"), none.alias("value"), state.alias("availability"), sure.alias("confidence"), F.col("d.claim_key").alias("claim_key"))
    return found.unionByName(empty).join(orgs, "org")


def contract_evidence(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(org, field, place, evidence_id) of the claims that a contract rests on."""
    return rows.filter("claim_key IS NOT NULL").join(links.select("org", "claim_key", "evidence_id"), ["org", "claim_key"]).select("org", "field", "place", "evidence_id").distinct()


def contract_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """What a refresh changed in the contract fields it compares, of entities that both contracts cover."""
    rows = lambda df: df.filter(F.col("field").isin(REFRESH_FIELDS) & (~F.col("field").isin(MULTI_VALUED) | F.col("value").isNotNull())).select("org", "field", "value", F.col("place").alias("pos"))
    return diff_envelopes(stored(rows(previous), "contract-previous"), stored(rows(current), "contract-current"))
