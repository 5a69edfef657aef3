import json
import random

import pytest
from pyspark.sql import functions as F

from attesta.operators import claims as cl, diffs, narrative, observations as obs, ordering, ranking, sampling, screening
from attesta.operators import learning, register

CLAIM = "org string, pos long, field string, value string, availability string, confidence double, subject string, reporting_period string, evidence_ids array<string>, note string"


def claim(org, pos, field, value, state, confidence=None, subject=None, period=None, ids=(), note=None):
    return (org, pos, field, value, state, confidence, subject, period, list(ids), note)


def test_dedupe_prefers_available_then_confidence_then_first(spark):
    rows = [
        claim("1", 1, "revenue", "a", "ambiguous", 0.99, ids=["e1"]), claim("1", 2, "revenue", "b", "available", 0.5, ids=["e2"]), claim("1", 3, "revenue", "c", "available", 0.9, ids=["e3", "e1"]),
        claim("1", 4, "revenue", "d", "available", 0.9, ids=["e4"]), claim("1", 5, "revenue", "e", "available", 0.9, subject="group", ids=["e5"]), claim("1", 6, "name", None, "not_available"),
    ]
    frame = spark.createDataFrame(rows, CLAIM)
    best = {r.claim_key: r for r in cl.dedupe_claims(frame).collect()}
    assert (best["revenue"].value, best["revenue"].first_pos, best["revenue"].merged) == ("c", 1, 4)
    assert best["revenue|group"].value == "e" and best["name"].value is None
    links = cl.claim_links(frame).filter("claim_key = 'revenue'").orderBy("first_cited").collect()
    assert [r.evidence_id for r in links] == ["e1", "e2", "e3", "e4"]
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    again = cl.dedupe_claims(spark.createDataFrame(shuffled, CLAIM).repartition(3))
    assert sorted(map(str, again.collect())) == sorted(map(str, best.values()))


def test_claim_rules(spark):
    bad = cl.check_claims(spark.createDataFrame([claim("1", 1, "a", None, "available"), claim("1", 2, "b", "x", "maybe", ids=["e"]), claim("1", 3, "c", "x", "available", ids=["e"])], CLAIM))
    assert {r.field: r.reasons for r in bad.collect()} == {"a": ["available claim cites no evidence", "available claim has no value"], "b": ["invalid availability state"]}


def envelopes(spark, rows, verdicts, evidence):
    frame = spark.createDataFrame(rows, CLAIM)
    links = cl.claim_links(frame)
    sources = spark.createDataFrame(evidence, "id string, source_class string")
    proven = spark.createDataFrame(verdicts, "org string, publishable boolean")
    held = cl.downgrade_unproven(cl.dedupe_claims(frame), links, sources, proven)
    return held, links, sources


def test_unproven_identity_holds_only_unexempt_claims(spark):
    rows = [claim("1", 1, "site", "x", "available", ids=["own"], note="seen"), claim("1", 2, "name", "x", "available", ids=["reg"]), claim("1", 3, "news", "x", "available", ids=["own", "news"]),
            claim("2", 1, "site", "x", "available", ids=["own"]), claim("3", 1, "site", "x", "blocked"), claim("4", 1, "site", None, "not_available")]
    held, links, sources = envelopes(spark, rows, [("1", False), ("2", True)], [("own", "company_owned"), ("reg", "official_registry"), ("news", "public_news")])
    states = {(r.org, r.field): (r.availability, r.note) for r in held.collect()}
    assert states["1", "site"] == ("ambiguous", "seen | identity not proven to publish threshold; held as ambiguous")
    assert states["1", "name"][0] == states["1", "news"][0] == states["2", "site"][0] == "available"
    runs = spark.createDataFrame([("5", True, True), ("1", False, True)], "org string, run_failed boolean, entity_resolved boolean")
    headers = {r.org: (r.disposition, r.total) for r in cl.envelope_headers(held, links, sources, runs).collect()}
    assert headers == {"1": ("official", 3), "2": ("official", 1), "3": ("blocked", 1), "4": ("empty", 1), "5": ("failed", 0)}


def test_envelopes_have_one_shape_and_lose_nothing(spark, tmp_path):
    rows = [claim("1", i, "post", "v", "available", subject=f"s{i}", ids=["own"]) for i in range(500)] + [claim("2", 1, "post", "v", "available", ids=["own"])]
    held, links, sources = envelopes(spark, rows, [("1", True), ("2", True)], [("own", "company_owned")])
    headers = cl.envelope_headers(held, links, sources)
    body = cl.envelope_claims(held, headers)
    assert {r.org: r["count"] for r in body.groupBy("org").count().collect()} == {"1": 500, "2": 1}
    from attesta.sources.captures import write_envelopes

    write_envelopes(headers, body, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/headers")).count() == 2 and spark.read.json(str(tmp_path / "out/claims")).count() == 501


def test_contract_states_gaps_and_invents_nothing(spark):
    rows = [claim("1", 1, "legal_form", "AS", "available", 1.0, ids=["r"]), claim("1", 2, "organisation_form", "ASA", "available", 1.0, ids=["r"]), claim("1", 3, "website", "x", "ambiguous", 0.5, ids=["r"])]
    contract = cl.to_contract(cl.dedupe_claims(spark.createDataFrame(rows, CLAIM)), spark.createDataFrame([("1",), ("2",)], "org string"))
    found = {(r.org, r.contract_field): r for r in contract.collect()}
    assert len(found) == 2 * len(cl.CONTRACT_FIELDS)
    assert found["1", "organisation_form"].value == "ASA" and found["1", "organisation_form"].statements == 2
    assert (found["1", "website"].availability, found["1", "website"].value) == ("ambiguous", None)
    assert (found["2", "legal_name"].availability, found["2", "legal_name"].claim_key) == ("not_available", None)


def test_batch_checks(spark):
    rows = [("1", "a", "available", None, "t"), ("1", "b", "blocked", "Robots.txt", "t"), ("2", "a", "blocked", "policy", "t")]
    modules = spark.createDataFrame(rows, "org string, module string, status string, note string, retrieved_at string")
    wanted = cl.require_modules(modules, spark.createDataFrame([("1",), ("2",)], "org string"), ["a", "b"])
    states = cl.terminal_states(wanted)
    assert sorted((r.org, r.module, r.state) for r in states.collect()) == [("1", "a", "complete"), ("1", "b", "blocked_robots"), ("2", "a", "blocked_policy"), ("2", "b", "submission_error")]
    entities = cl.entity_states(states)
    assert {r.org: r.state for r in entities.collect()} == {"1": "complete", "2": "submission_error"}
    assert cl.validate_batch(entities, 2).first().passed and not cl.validate_batch(entities, 3).first().zero_silent_drops


# ---- positions and percentiles under skew ----


def test_positions_are_exact_for_a_hot_key(spark):
    rows = [("hot", i % 97, i) for i in range(3000)] + [(f"k{i}", i, i) for i in range(50)]
    frame = spark.createDataFrame(rows, "org string, score int, id int")
    numbered = ordering.number_within(frame, ["org"], ["score", "id"], "place")
    expected = {}
    for org, score, key in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        expected[org, key] = sum(1 for o in expected if o[0] == org) + 1 if org != "hot" else None
    hot = sorted([r for r in rows if r[0] == "hot"], key=lambda r: (r[1], r[2]))
    places = {(r.org, r.id): r.place for r in numbered.collect()}
    assert [places["hot", r[2]] for r in hot] == list(range(1, 3001))
    assert all(places[f"k{i}", i] == 1 for i in range(50))


def test_ranges_split_what_equal_widths_would_not(spark):
    frame = spark.range(5000).selectExpr("IF(id < 4500, 0.001 * id / 4500, 1.0 * id) AS v", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        busy = ordering.dealt(frame, ["v", "id"], "b").filter("v < 0.01").groupBy("b").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(busy) > 2 and max(r["count"] for r in busy) < 2500


def test_running_totals_and_hash_numbers(spark):
    values = spark.createDataFrame([(i, (i * 7) % 13) for i in range(400)], "k int, v int")
    rows = ordering.running_totals(values, ["k"], ["v"]).orderBy("k").collect()
    total = 0
    for row in rows:
        total += row.v
        assert row.c_v == total
    hashed = values.withColumn("h", F.sha2(F.col("k").cast("string"), 256))
    assert [r.place for r in ordering.number_by_hash(hashed, "h", "place").orderBy("h").collect()] == list(range(1, 401))


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0, 3.0, 4.0], [7.0] * 900 + [1.0, 2.0, 1e9], [float(i * i) for i in range(501)]])
def test_nearest_rank_equals_the_definition(spark, values):
    import math

    found = ordering.nearest_rank(spark.createDataFrame([("a", v) for v in values], "k string, v double"), ["k"], "v", {"p50": 0.5, "p95": 0.95}).first()
    ordered = sorted(values)
    assert (found.p50, found.p95) == tuple(ordered[max(0, math.ceil(q * len(ordered)) - 1)] for q in (0.5, 0.95))
    assert found.n == len(values) and found.maximum == max(values)


# ---- samples ----


def people(spark, n=300):
    rows = [(f"{i:09d}", "AS" if i % 3 else "ENK", None if i % 7 == 0 else i % 30, i % 11 == 0, False, "a.no" if i % 2 else None) for i in range(n)]
    return spark.createDataFrame(rows, "org string, legal_form string, employees int, bankrupt boolean, liquidating boolean, website string")


def test_samples_ignore_input_order(spark):
    first = people(spark)
    second = first.orderBy(F.rand(3)).repartition(7)
    for draw in (lambda d: sampling.hash_sample(d, 40, 7), lambda d: sampling.stress_sample(d, 60, 7), lambda d: sampling.assign_splits(d, 7)):
        assert sorted(map(str, draw(first).collect())) == sorted(map(str, draw(second).collect()))


def test_preserved_come_first_and_excluded_never(spark):
    frame = people(spark)
    keep, drop = frame.filter("org < '000000010'"), frame.filter("org >= '000000250'")
    sample = [r.org for r in sampling.hash_sample(frame, 30, 7, drop, keep).collect()]
    assert len(sample) == 30 and {f"{i:09d}" for i in range(10)} <= set(sample) and max(sample) < "000000250"
    assert len(sampling.hash_sample(frame, 5, 7, None, keep).collect()) == 5


def test_splits_and_groups(spark):
    counts = {r.evaluation_split: r["count"] for r in sampling.assign_splits(people(spark, 100), 3).groupBy("evaluation_split").count().collect()}
    assert counts == {"development": 60, "validation": 20, "held_out": 20}
    twice = people(spark, 40).unionAll(people(spark, 40))
    sides = sampling.grouped_split(twice, 3, 0.25).groupBy("org").agg(F.count_distinct("is_test").alias("n"), F.max("is_test").alias("t"))
    assert sides.filter("n <> 1").count() == 0 and sides.filter("t").count() == 10


def test_unknown_employees_are_their_own_band(value):
    assert [value(sampling.employee_band(F.lit(n).cast("int"))) for n in (None, 0, 4, 19, 99, 100)] == ["missing", "0", "1-4", "5-19", "20-99", "100+"]


# ---- diffs ----

SNAP = "org string, field string, value string, source_url string, retrieved_at string, effective_at string, content_sha256 string, status string"


def snap(spark, rows):
    return spark.createDataFrame([(o, f, v, "u", "t", "t", h, "available") for o, f, v, h in rows], SNAP)


def test_snapshot_diff_is_null_safe_and_idempotent(spark):
    old = snap(spark, [("1", "registry.employees", None, "h1"), ("1", "registry.name", "A", "h1"), ("1", "other", "x", "h1")])
    new = snap(spark, [("1", "registry.employees", "0", "h2"), ("1", "registry.name", "A", "h2"), ("1", "other", "y", "h2")])
    changes = diffs.diff_snapshots(old, new)
    assert [(r.field, r.old_value, r.new_value, r.old_content_sha256, r.new_content_sha256) for r in changes.collect()] == [("registry.employees", None, "0", "h1", "h2")]
    assert diffs.diff_snapshots(new, new).count() == 0
    with pytest.raises(ValueError):
        diffs.require_same_membership(old, snap(spark, [("2", "registry.name", "B", "h")]))
    expected = spark.createDataFrame([("1", "registry.employees"), ("1", "registry.website")], "org string, field string")
    score = diffs.score_changes(expected, changes, diffs.diff_snapshots(new, new)).first()
    assert (score.true_positive, score.false_positive, score.false_negative, score.precision, score.recall) == (1, 0, 1, 1.0, 0.5)
    assert score.evidence_complete and score.idempotent and not score.qualification_passed


def test_observation_diff(spark):
    schema = "id string, org string, platform string, signal_type string, source_url string, exact_entity boolean, rights_status string, metrics string, published_at string, sentiment_label string, content_sha256 string, retrieved_at string"
    row = lambda i, url, metrics, signal="public_post", rights="approved": (i, "1", "x", signal, url, True, rights, json.dumps(metrics), None, None, "h" + i, "2026-01-01")
    old = spark.createDataFrame([row("1", "https://a.no/x?utm_source=q", {"likes": 1, "as_of": "d1"}), row("2", "https://a.no/gone", {"likes": 1}), row("3", "https://a.no/y", {"likes": 1})], schema)
    new = spark.createDataFrame([row("1", "https://A.no/x/", {"as_of": "d2", "likes": 1}), row("3", "https://a.no/y", {"likes": 2}), row("4", "https://a.no/z", {}), row("5", "https://a.no/w", {}, rights="pending")], schema)
    assert sorted((r.observation_key, r.change_kind) for r in diffs.diff_observations(old, new).collect()) == [("x|public_post|https://a.no/y", "metric_changed"), ("x|public_post|https://a.no/z", "new_evidence")]
    assert diffs.diff_observations(new, new).count() == 0


def test_envelope_diff_compares_values_as_multisets(spark):
    schema = "org string, pos int, field string, value string"
    old = spark.createDataFrame([("1", 1, "leadership_role", "A"), ("1", 2, "leadership_role", "B"), ("1", 3, "legal_name", "X"), ("2", 1, "legal_name", "Only old")], schema)
    new = spark.createDataFrame([("1", 1, "leadership_role", "B"), ("1", 2, "leadership_role", "A"), ("1", 3, "legal_name", "Y")], schema)
    assert [(r.field, r.old_value, r.new_value) for r in diffs.diff_envelopes(old, new).collect()] == [("legal_name", "X", "Y")]
    more = new.unionAll(spark.createDataFrame([("1", 4, "leadership_role", "B")], schema))
    assert [(r.field, r.added, r.removed) for r in diffs.diff_envelopes(new, more).collect()] == [("leadership_role", 1, 0)]


# ---- screens, answers, sentences ----


@pytest.mark.parametrize("question,filters,sort,executable", [
    ("companies in Oslo with more than 10 employees", [("municipality", "eq", "OSLO"), ("employees", ">", "10")], None, True),
    ("legal form AS, revenue at least 2,5 million", [("legal_form", "eq", "AS"), ("revenue", ">=", "2500000.0")], None, True),
    ("unprofitable companies with a website top 500 by revenue", [("annual_result", "<", "0"), ("website", "present", "true")], ("revenue", 100), True),
    ("employees >= 5 with annual accounts", [("employees", ">=", "5"), ("financials", "available", "true")], None, True),
    ("industry contains 'Bygg'", [("industry", "contains", "bygg")], None, True),
    ("companies with good sentiment in Oslo", [("municipality", "eq", "OSLO")], None, False), ("nice companies", [], None, False)])
def test_questions_become_filters(spark, question, filters, sort, executable):
    plan = screening.plan_screens(spark.createDataFrame([(question,)], "query string")).first()
    got = [(f["field"], f["operator"], f"{float(f['value']):.1f}" if f["field"] == "revenue" else f["value"]) for f in plan["filters"]]
    assert (got, tuple(plan["sort"]) if plan["sort"] else None, plan["executable"]) == (filters, sort, executable)


def test_screens_put_unknowns_last_and_never_match_them(spark):
    rows = spark.createDataFrame([("1", 5, None), ("2", None, 3.0), ("3", 5, 9.0), ("4", 7, 9.0)], "org string, employees int, revenue double")
    assert [r.org for r in screening.screen(rows, [("employees", ">=", 5)]).orderBy("org").collect()] == ["1", "3", "4"]
    assert [r.org for r in screening.top_screen(rows, "revenue", 10).collect()] == ["3", "4", "2", "1"]
    assert screening.answer_screen(rows, "something vague").count() == 0


PROFILE = "org string, municipality string, legal_form string, employees int, revenue double, annual_result double, industry_code string, industry_label string, website_ok boolean, financials_ok boolean"
ASKED = [
    "companies with legal form AS and over 3 employees", "legal form enk with an official website", "profitable companies, top 2 by employees", "loss-making companies with at most 5 employees and annual accounts",
    "revenue at least 2 million, industry contains 'Fish'", "companies with employees = 5, top 3 by revenue", "top 4 by revenue", "top 3 by employees", "companies with fewer than 1 employees",
    "companies in oslo with revenue over 1,5 million", "legal form AS without a website", "nothing to go on",
]


def test_many_screens_give_what_each_gives_alone(spark):
    generator = random.Random(8)
    pick = lambda *values: generator.choice(values)
    rows = [
        (f"{k:03d}", pick("OSLO", "BERGEN", None), pick("AS", "ENK", "NUF", None), pick(None, 0, 3, 4, 5, 5, 80), pick(None, 0.0, 1.5e6, 2e6, 2e6, 9e9), pick(None, -5.0, 0.0, 7.0), pick("03.1", "41", None), pick("Fishing", "building", None), pick(True, False, None), pick(True, None))
        for k in range(200)
    ]
    profiles = spark.createDataFrame(rows, PROFILE)
    planned = screening.plan_screens(spark.createDataFrame([(q,) for q in ASKED + ASKED[:2]], "query string"))
    got = {}
    for r in screening.screen_many(profiles, planned).orderBy("query", "place").collect():
        got.setdefault(r.query, []).append((r.place, r.org))
    for plan in planned.dropDuplicates(["query"]).collect():
        alone = []
        if plan["executable"]:
            filters, sort = screening.plan_parts(plan)
            answer = screening.screen(profiles, filters, sort)
            alone = sorted(r.org for r in answer.collect())
            if sort:
                size = {r[0]: r[4 if sort[0] == "revenue" else 3] for r in rows}
                alone.sort(key=lambda o: (size[o] is None, -(size[o] or 0), o))
        assert got.get(plan["query"], []) == list(enumerate(alone, 1)), plan["query"]
    assert len(got) >= 9 and screening.screen_many(profiles.limit(0), planned).count() == 0 and screening.screen_many(profiles, planned.limit(0)).count() == 0


def test_the_rarest_rule_of_a_screen_leads(spark):
    """Entities are tested where a screen's rarest rule leads to them, not once for each of its rules."""
    rows = [(f"{k:03d}", "OSLO" if k < 3 else "BERGEN", "AS", k, 1e6 * k, 1.0, None, "fishing" if k % 2 else "building", True, True) for k in range(200)]
    values = screening.fact_lists(spark.createDataFrame(rows, PROFILE)).selectExpr("inline(facts)").groupBy("field", "text", "number").agg(F.count(F.lit(1)).alias("n"))
    asked = ["legal form AS in oslo with a website", "legal form AS, over 195 employees", "revenue at least 2 million, industry contains 'fish'", "legal form DA with a website"]
    rules = screening.rules_of(screening.plan_screens(spark.createDataFrame([(q,) for q in asked], "query string")))
    found = {r.query: (r.field, r.operator) for r in screening.rarest_rules(rules, values, screening._bins(values)).collect()}
    assert found == {asked[0]: ("municipality", "eq"), asked[1]: ("employees", ">"), asked[2]: ("industry", "contains"), asked[3]: ("legal_form", "eq")}


def test_screens_are_evaluated_row_by_row(spark):
    profiles = spark.createDataFrame([("1", "OSLO", "AS", 5, 1.0, 1.0, None, None, True, True), ("2", "OSLO", "AS", 9, 2.0, 1.0, None, None, True, True), ("3", "OSLO", "ENK", 9, 2.0, 1.0, None, None, True, None)], PROFILE)
    questions = ["legal form AS, top 5 by revenue", "legal form AS with over 1 employees", "legal form ENK", "legal form DA", "legal form AS by buzz"]
    planned = screening.plan_screens(spark.createDataFrame([(q,) for q in questions], "query string"))
    hits = screening.screen_many(profiles, planned)
    evidence = spark.createDataFrame([("1", "registry", "u", "t", "h"), ("2", "registry", "u", "t", "h"), ("1", "financials", "u", "t", None), ("2", "financials", "u", "t", "h")], "org string, module string, source_url string, retrieved_at string, content_sha256 string")
    cited = screening.cite_many(hits, planned, evidence)
    fields = [["legal_form"], ["employees", "legal_form"], ["legal_form"], ["legal_form"], ["legal_form"]]
    expected = spark.createDataFrame([(q, f, "buzz" in q) for q, f in zip(questions, fields)], "query string, expected_filter_fields array<string>, must_abstain boolean")
    members = spark.createDataFrame([(questions[0], 1, "2"), (questions[0], 2, "1"), (questions[1], 1, "1"), (questions[2], 1, "2")], "query string, place int, org string")
    judged = screening.evaluate_screens(expected, members, planned, hits, cited)
    found = {r.query: (r.membership_exact, r.plan_exact, r.citations_complete, r.abstained, r.results) for r in judged.collect()}
    assert found == {
        questions[0]: (True, True, False, False, 2), questions[1]: (False, False, True, False, 2), questions[2]: (False, True, False, False, 1), questions[3]: (True, True, True, False, 0), questions[4]: (True, True, True, True, 0),
    }
    row = screening.screen_points(judged).first()
    assert (row.questions, row.cross_company_screening, row.exact_inspectable_filters, row.unsupported_abstention, row.provenance_export, row.score, row.qualification_passed) == (5, 1.5, 1.5, 1.0, 0.0, 4.0, False)


def test_sentences_state_facts_and_gaps(spark):
    j = json.dumps
    rows = [
        claim("974760673", 1, "legal_name", "Alfa AS", "available", 1.0, ids=["e"]), claim("974760673", 2, "organisation_form", j({"code": "AS", "description": "Aksjeselskap"}), "available", ids=["e"]),
        claim("974760673", 3, "operating_status", j({"active": True, "bankrupt": False}), "available", ids=["e"]), claim("974760673", 4, "registered_address", j({"postal_town": "OSLO"}), "available", ids=["e"]),
        claim("974760673", 5, "employees", "0", "available", ids=["e"]), claim("974760673", 6, "revenue", j({"amount": 1234567.0, "currency": "NOK"}), "available", period="2024", ids=["e"]),
        claim("974760673", 7, "leadership", j({"name": "Kari", "role": "chief_executive", "title": "Daglig leder"}), "available", subject="Kari", ids=["e"]),
        claim("974760673", 8, "active_job_count", "2", "available", ids=["e"]), claim("974760673", 9, "website", None, "ambiguous"), claim("974760673", 10, "ratings_and_reviews", None, "not_applicable"),
        claim("974760673", 11, "social_profiles", j({"x": "u", "facebook": "v"}), "available", ids=["e"]),
    ]
    said = narrative.synthesise(cl.dedupe_claims(spark.createDataFrame(rows, CLAIM)), spark.createDataFrame([("974760673", "ALFA"), ("2", "Beta")], "org string, input_name string"))
    assert [r.text for r in said.filter("org <> '2'").orderBy("place").collect()] == [
        "Alfa AS (org. no. 974760673) is an active aksjeselskap.", "It is seated in Oslo.", "The register records 0 employees.", "In 2024, revenue was NOK 1 234 567.",
        "Leadership includes Kari (Daglig leder).", "It appears to be hiring: 2 active job postings on the public job board.", "Verified company-owned profiles: facebook, x.",
        "Not established from the checked sources: a verified official website."]
    assert [r.text for r in said.filter("org = '2'").collect()] == ["Beta (org. no. 2) is a registered company."]
    assert narrative.summaries(said).filter("org = '2'").first().sentences == 1


def test_answers_abstain_without_evidence(spark):
    specs = spark.createDataFrame([("a", 1, ["Verified review summary"], False), ("b", 1, [], True)], "qid string, minimum_facts int, required_claims array<string>, must_abstain boolean")
    answers = spark.createDataFrame([("a", "1", "external", 1, "Verified review summary", "u", "verified_external_observation", "u", "t", "h" * 64)],
                                    "qid string, org string, topic string, place int, claim string, value string, classification string, source_url string, retrieved_at string, content_sha256 string")
    gaps = spark.createDataFrame([("b", "note")], "qid string, note string")
    assert {r.qid: r.passed for r in narrative.evaluate_answers(specs, answers, gaps).collect()} == {"a": True, "b": True}


# ---- rankings ----


def test_allocation_stops_at_the_limit(spark):
    rows = spark.createDataFrame([(f"{i:09d}", f"Firma {i}", "Gata 1", "0150", i, 1.0, None) for i in range(10)], "org string, name string, address string, postcode string, employees int, revenue double, website string")
    rows = rows.withColumns({"bankrupt": F.lit(False), "liquidating": F.lit(False), "own_site": F.lit(False), "has_operating_names": F.lit(False)})
    credits = {r.org: r.credits for r in ranking.allocate_credits(rows, 5, 2).collect()}
    assert sum(credits.values()) == 5 and [credits[f"{i:09d}"] for i in (8, 9, 6, 0)] == [2, 2, 1, 0]


def test_crawl_queue_takes_turns(spark):
    row = lambda url, family, found, pos: ("1", url, family, found, pos)
    links = spark.createDataFrame([
        row("https://a.no/jobb", "career", True, 0), row("https://a.no/karriere", "career", False, 0), row("https://a.no/nytt", "news", True, 1), row("https://a.no/nyheter", "news", False, 0),
        row("https://a.no/kontakt/", "contact", False, 0), row("https://a.no/KONTAKT", "contact", True, 5), row("https://a.no/annet", "link", True, 2)], "org string, url string, family string, harvested boolean, pos int")
    assert [r.url for r in ranking.crawl_queue(links, 6).orderBy("place").collect()] == [
        "https://a.no/jobb", "https://a.no/nytt", "https://a.no/KONTAKT", "https://a.no/karriere", "https://a.no/nyheter", "https://a.no/annet"]


def test_crawl_queue_folds_spellings_before_it_cuts(spark):
    links = [("1", f"https://a.no/jobb#{k}", "career", True, k) for k in range(12)] + [("1", "https://a.no/stilling", "career", True, 12)]
    queue = ranking.crawl_queue(spark.createDataFrame(links, "org string, url string, family string, harvested boolean, pos int"), 2)
    assert [r.url for r in queue.orderBy("place").collect()] == ["https://a.no/jobb#0", "https://a.no/stilling"]


def test_top_screen_gives_what_is_asked(spark):
    rows = spark.range(400).selectExpr("cast(id as string) AS org", "id AS revenue")
    assert screening.top_screen(rows, "revenue", 300).count() == 300


def test_strategies_never_tried_keep_the_whole_bonus(spark):
    log = spark.createDataFrame([("company_site_feed", None, 5.0), ("company_site_feed", 0.0, 1.0), ("youtube_channel_feed", -1.0, 0.0)], "strategy string, learning_gain double, score_delta double")
    ranked = ranking.rank_strategies(log).orderBy("place").collect()
    assert ranked[0].strategy == "company_site_feed" and ranked[0].prior_runs == 2 and ranked[0].mean_gain == 3.0
    assert ranked[1].strategy == "company_site_identity" and ranked[-1].strategy == "youtube_channel_feed"


def test_publication_reasons(spark):
    rows = spark.createDataFrame([("2024-01-01", None, "https://a.no/x", "ok"), ("snart", None, "", ""), ("1999-01-01", "2001-01-01", "", ""), ("2024-01-01", None, "https://a.no/hello-world/", "Hello world!"), ("2024-01-01", None, "", "Welcome to WordPress")],
                                 "published string, founded string, url string, text string")
    assert [r[0] for r in rows.select(register.publication_reason(*[F.col(c) for c in ("published", "founded", "url", "text")])).collect()] == [
        None, "missing_supported_publication_date", "predates_exact_legal_entity", "default_template_content", "default_template_content"]


@pytest.mark.parametrize("scores", [[(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], [(0.5, 1)] * 5 + [(0.5, 0)] * 5, [(i / 50, int(i % 3 == 0)) for i in range(50)]])
def test_metrics_equal_brute_force(spark, scores):
    row = learning.ranker_metrics(spark.createDataFrame(scores, "probability double, label int")).first()
    pos, neg = [s for s, y in scores if y], [s for s, y in scores if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(row.roc_auc - wins / (len(pos) * len(neg))) < 1e-9
    steps = sum(sum(1 for q in pos if q >= p) / sum(1 for s, _ in scores if s >= p) for p in pos) / len(pos)
    assert abs(row.average_precision - steps) < 1e-9


def test_model_round_trip(spark):
    from attesta.plans.learning_queries import FIXED

    again = learning.RankerModel.from_json(FIXED.to_json())
    assert again.weights == FIXED.weights and again.platt_a == FIXED.platt_a
    with pytest.raises(ValueError):
        learning.RankerModel.from_json('{"kind": "other"}')


def test_footprint_gates(spark):
    schema = "id string, org string, platform string, signal_type string, source_url string, retrieved_at timestamp, published_at string, content_sha256 string, exact_entity boolean, identity_proof array<map<string,string>>, acquisition_mode string, rights_status string, source_class string, evidence_span string, reviewer_id string, sentiment_label string, sentiment_model_version string, metrics string"
    import datetime as dt

    def row(i, org, host, label="positive", signal="review"):
        return (f"o{org}{i}", org, "google_places", signal, f"https://{host}/x{i}", dt.datetime(2026, 1, 1), "2020-01-01", "a" * 64, True, [{"type": "x"}], "official_api", "approved", "customer_review", "t", None, label, "m", '{"likes": "3", "shares": 1}')

    frame = spark.createDataFrame([row(i, "1", "a.no" if i % 2 else "b.no", "negative" if i < 2 else "positive") for i in range(10)] + [row(i, "2", "a.no") for i in range(10)] + [row(0, "3", "c.no", None, "public_post")], schema)
    found = {r.org: r for r in obs.aggregate_footprint(frame, "2026-01-10 00:00:00").collect()}
    assert (found["1"].sentiment_status, found["1"].sentiment_score, found["1"].fresh, found["1"].recent) == ("available", 80.0, 10, 0)
    assert found["2"].sentiment_status == "abstain" and found["2"].sentiment_score is None
    assert found["3"].public_engagement == 4 and found["3"].public_items == 1
