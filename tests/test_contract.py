import json

from attesta.operators import contract as op

CLAIM = "org string, field string, value string, availability string, confidence double, first_pos long, claim_key string"
ORGS = "org string, tier string"


def claim(org, field, value, pos=1, state="available"):
    return (org, field, json.dumps(value) if isinstance(value, (dict, list)) else value, state, 0.9, pos, f"{field}|{pos}")


def table(spark, rows, orgs=(("1", "full"),)):
    found = {}
    for r in op.contract(spark.createDataFrame(rows, CLAIM), spark.createDataFrame(list(orgs), ORGS)).collect():
        found.setdefault((r.org, r.field), []).append((r.place, r.value, r.availability))
    return {k: sorted(v) for k, v in found.items()}


def test_values_read_as_the_contract_shows_them(spark):
    found = table(spark, [
        claim("1", "organisation_form", {"code": "AS"}), claim("1", "legal_form", "ENK"), claim("1", "registered_address", {"street": "Gata 1", "postal_code": "0150", "postal_town": "OSLO"}),
        claim("1", "industry_code", {"code": "41.2", "description": "Bygg"}), claim("1", "operating_status", {"under_liquidation": True}), claim("1", "revenue", {"amount": 1.5}),
        claim("1", "leadership", {"name": "Kari", "role": "chair"}, 2), claim("1", "leadership", {"role_title_no": "Daglig leder"}, 1), claim("1", "location", {"name": "Avd", "address": {"street": "Kaia 2"}}), claim("1", "location", "Lager", 2),
        claim("1", "website", None, state="blocked"), claim("1", "active_job_count", "3"), claim("1", "registry_update", {"dato": "2025-02-03T10", "endringstype": "Ny"}), claim("1", "ratings_and_reviews", {"review_count": 7, "rating": 4.5}),
        claim("1", "employees", "12", 2), claim("1", "employees", "10", 1), claim("1", "employees", "9", 0, "ambiguous"),
    ])
    one = lambda field: found["1", field][0][1]
    assert (one("legal_form"), one("registered_business_address"), one("industry"), one("latest_annual_revenue"), one("employee_count")) == ("AS", "Gata 1, 0150 OSLO, Norge", "41.2 - Bygg", "1.5", "10")
    assert json.loads(one("bankruptcy_or_liquidation_status")) == {"bankrupt": False, "liquidating": True}
    assert [v for _, v, _ in found["1", "leadership_role"]] == ["Daglig leder: Holder", "chair: Kari"] and [v for _, v, _ in found["1", "registered_workplace"]] == ["Avd — Kaia 2, Norge", "Lager"]
    assert found["1", "official_website"] == [(1, None, "blocked")] and json.loads(one("hiring_or_activity_signal")) == {"active_job_ads": 3, "source": "nav_no"}
    assert json.loads(one("dated_public_activity"))["date"] == "2025-02-03" and json.loads(one("buzz_or_engagement")) == {"public_reviews": 7, "rating": 4.5}


def test_gaps_are_stated_by_tier(spark):
    found = table(spark, [claim("3", "employees", "0")], [("1", "shell"), ("2", "full"), ("3", "full")])
    state = lambda org, field: found[org, field][0][2]
    assert [state(o, "social_profiles") for o in "12"] == ["not_applicable", "not_available"] and [state(o, "active_job_count") for o in "123"] == ["not_applicable", "not_available", "not_applicable"]
    assert state("1", "legal_name") == "not_available" and ("1", "job_posting") not in found
    assert {org for org, _ in found} == {"1", "2", "3"} and len([k for k in found if k[0] == "2"]) == len(op.FIELDS) - len(op.OPTIONAL)


def test_two_contracts_differ_in_the_same_vocabulary(spark):
    orgs = spark.createDataFrame([("1", "full"), ("2", "full")], ORGS)
    before = [claim("1", "revenue", {"amount": 1}), claim("1", "leadership", {"name": "A", "role": "chair"}), claim("2", "legal_name", "B")]
    after = [claim("1", "revenue", {"amount": 2}), claim("1", "leadership", {"name": "A", "role": "chair"}), claim("1", "leadership", {"name": "C", "role": "chair"}, 2), claim("2", "legal_name", "B")]
    make = lambda rows: op.contract(spark.createDataFrame(rows, CLAIM), orgs)
    changes = sorted((r.org, r.field, r.old_value, r.new_value, r.added, r.removed) for r in op.contract_changes(make(before), make(after)).collect())
    assert changes == [("1", "latest_annual_revenue", "1", "2", None, None), ("1", "leadership_role", None, None, 1, 0)]
    assert op.contract_changes(make(after), make(after)).count() == 0
    links = spark.createDataFrame([("1", "revenue|1", "e1"), ("1", "revenue|1", "e2"), ("2", "revenue|1", "e3")], "org string, claim_key string, evidence_id string")
    assert sorted((r.field, r.evidence_id) for r in op.contract_evidence(make(before), links).collect()) == [("latest_annual_revenue", "e1"), ("latest_annual_revenue", "e2")]


def test_the_claims_are_made_once(spark):
    """Every part of a contract reads the same claims, which may be costly to make."""
    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            made.add(1)
            yield row

    rows = [claim(f"{k}", field, "x") for k in range(20) for field in ("legal_name", "website")]
    claims = spark.createDataFrame(spark.createDataFrame(rows, CLAIM).rdd.mapPartitions(count), CLAIM)
    orgs = spark.createDataFrame([(f"{k}", "full") for k in range(20)], ORGS)
    contract = op.contract(claims, orgs)
    assert op.contract_changes(contract, contract).count() == 0 and made.value == len(rows)
