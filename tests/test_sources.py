import gzip
import json

import pytest
from pyspark.sql import functions as F

from attesta.sources import captures, feeds, official, registry


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("separator", [",", ";", "\t"])
@pytest.mark.parametrize("norwegian", [False, True])
def test_registry_reader_takes_both_headers_and_any_separator(spark, tmp_path, separator, norwegian):
    head = ["Organisasjonsnummer", "Navn", "Antall ansatte", "Konkurs", "Forretningsadresse.kommunenummer"] if norwegian else [
        "organisasjonsnummer", "navn", "antallAnsatte", "konkurs", "forretningsadresse.kommunenummer"]
    body = [["111111111", "Alfa AS", "", "false", "0301"], ["222222222", "Beta AS", "0", "true", "4601"], ["33", "Kort", "3", "false", "1"],
            ["111111111", "Alfa Ny AS", "x", "false", "0301"]]
    path = tmp_path / "register.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as handle:
        handle.write("\n".join(separator.join(line) for line in [head, *body]) + "\n")
    raw = registry.read_registry(spark, str(path))
    assert raw.count() == 3
    table = registry.build_registry_table(raw)
    # The last row wins, a blank or bad count is unknown and zero stays zero.
    assert rows(table, "org", "name", "employees", "bankrupt", "municipality_number") == [
        ("111111111", "Alfa Ny AS", None, False, "0301"), ("222222222", "Beta AS", 0, True, "4601")]


def test_registry_table_and_subunit_table_can_be_written(spark, tmp_path):
    table = spark.createDataFrame([("1" * 9, "0301"), ("2" * 9, "4601")], "org string, municipality_number string")
    registry.write_registry_table(table, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    raw = spark.createDataFrame([(1, "3" * 9, "1" * 9, 2), (2, "bad", "1" * 9, 2), (3, "3" * 9, "2" * 9, 5)],
                                "pos long, subunit_org string, parent_org string, employees int")
    units = registry.build_subunit_table(raw)
    assert rows(units, "subunit_org", "parent_org", "employees") == [("3" * 9, "2" * 9, 5)]
    registry.write_subunit_table(units, "subunits_written", buckets=4)
    assert spark.table("subunits_written").count() == 1


@pytest.mark.parametrize("name,text,expected", [
    ("a.json", '["111111111", {"orgnr": "222 222 222", "navn": "Beta"}, "12"]', [("111111111", None), ("222222222", "Beta")]),
    ("b.json", json.dumps({"organisations": ["111111111", "111111111"]}, indent=1), [("111111111", None)]),
    ("c.jsonl", '{"organisation_number": "111111111", "name": "Alfa"}\n"222222222"\n', [("111111111", "Alfa"), ("222222222", None)]),
    ("d.txt", "# list\n111 111 111\n012345678\n\n111111111\n", [("012345678", None), ("111111111", None)]),
    ("e.csv", '111111111,Alfa AS\nBeta,"222222222"\n', [("111111111", "Alfa AS"), ("222222222", None)]),
])
def test_manifest_formats(spark, tmp_path, name, text, expected):
    (tmp_path / name).write_text(text, encoding="utf-8")
    assert rows(registry.read_manifest(spark, str(tmp_path / name)), "org", "name") == expected


def test_manifest_strict_mode_stops_on_bad_or_repeated_ids(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("111111111\n12\n")
    (tmp_path / "twice.txt").write_text("111111111\n111 111 111\n")
    (tmp_path / "good.txt").write_text("111111111\n222222222\n")
    for name in ("bad.txt", "twice.txt"):
        with pytest.raises(ValueError):
            registry.read_manifest(spark, str(tmp_path / name), strict=True)
    ordered = registry.read_manifest(spark, str(tmp_path / "good.txt"), strict=True).orderBy("pos")
    assert [r.org for r in ordered.collect()] == ["111111111", "222222222"]


def test_org_map_keeps_rows_that_name_their_own_key(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"1": {"org_nr": "1", "website": "a.no"}, "2": {"org_nr": "3"}, "4": "x"}))
    found = registry.read_org_map(spark, str(tmp_path / "map.json"))
    assert [(r.org, r.site) for r in found.select("org", F.variant_get("row", "$.website", "string").alias("site")).collect()] == [("1", "a.no")]


def test_verified_seeds_reject_unknown_and_relative(spark):
    profiles = spark.createDataFrame([("1", "a.no")], "org string, website string")
    for seed in [("9", "https://b.no", "https://p"), ("1", "b.no", "https://p")]:
        seeds = spark.createDataFrame([seed], "org string, website string, proof_url string")
        with pytest.raises(ValueError):
            registry.apply_verified_seeds(profiles, seeds)


ENTITY = {
    "organisasjonsnummer": "111111111", "navn": "Alfa AS", "organisasjonsform": {"kode": "AS", "beskrivelse": "Aksjeselskap"},
    "stiftelsesdato": "2001-02-03", "forretningsadresse": {"adresse": ["Gata 1", ""], "postnummer": "0150", "poststed": "OSLO"},
    "postadresse": {"adresse": ["Gata 1", ""], "postnummer": "0150", "poststed": "OSLO"}, "mobil": "40000000",
    "naeringskode1": {"kode": "62.010", "beskrivelse": "Programmering"}, "naeringskode3": {"kode": "70.220"},
    "harRegistrertAntallAnsatte": True, "antallAnsatte": 0, "konkurs": False, "underAvvikling": True,
    "registrertIMvaregisteret": True, "kapital": {"belop": 30000.0, "valuta": "NOK", "antallAksjer": 100},
    "historiskeNavn": [{"navn": "Gamle Alfa AS", "tilDato": "2010-05-06T00:00:00"}], "erIKonsern": False,
}


def test_entity_claims(spark):
    other = {"organisasjonsnummer": "222222222", "navn": "Beta", "harRegistrertAntallAnsatte": False}
    answers = spark.createDataFrame([("111111111", json.dumps(ENTITY)), ("222222222", json.dumps(other)), ("333333333", "<html>")], "org string, body string")
    claims = official.normalize_entity(answers)
    alfa = {(r.field, r.subject): r for r in claims.filter("org = '111111111'").collect()}
    assert json.loads(alfa["registered_address", None].value) == {"street": "Gata 1", "postal_code": "0150", "postal_town": "OSLO"}
    assert ("postal_address", None) not in alfa  # the same as the business address
    assert alfa["employees", None].value == "0" and alfa["employees", None].availability == "available"
    assert json.loads(alfa["operating_status", None].value)["active"] is False
    assert alfa["former_name", "Gamle Alfa AS"].reporting_period == "2010-05-06"
    assert alfa["in_corporate_group", None].value == "false"
    assert {s for f, s in alfa if f == "industry_code"} == {"nace_1", "nace_3"}
    beta = {r.field: r for r in claims.filter("org = '222222222'").collect()}
    assert beta["employees"].availability == "not_available" and beta["employees"].value is None
    assert [(r.field, r.availability) for r in claims.filter("org = '333333333'").collect()] == [("registry_entry", "failed")]


def test_roles_keep_current_leadership_once(spark):
    def person(first, last, code, **extra):
        return {"type": {"kode": code, "beskrivelse": code.title()}, "person": {"fodselsdato": "1960-01-01", "navn": {"fornavn": first, "etternavn": last}}, **extra}

    body = {"rollegrupper": [{"type": {"kode": "STYR"}, "sistEndret": "2024-01-01", "roller": [
        person("Kari", "Nordmann", "LEDE"), person("KARI", "NORDMANN", "LEDE"), person("Ola", "Hansen", "MEDL", avregistrert=True),
        person("Per", "Olsen", "REVI"), {"type": {"kode": "KOMP"}, "enhet": {"organisasjonsnummer": "999999999", "navn": ["Gamma AS"]}}]}]}
    answers = spark.createDataFrame([("1", json.dumps(body)), ("2", "{}")], "org string, body string")
    found = official.normalize_roles(answers)
    assert rows(found.filter("org = '1'"), "name", "role_code", "position", "holder_org") == [
        ("Gamma AS", "KOMP", "general_partner", "999999999"), ("Kari Nordmann", "LEDE", "board_chair", None)]
    assert [r.availability for r in found.filter("org = '2'").collect()] == ["not_available"]


def test_locations_report_the_registers_own_total(spark):
    unit = {"organisasjonsnummer": "555555555", "navn": "Alfa avd Bergen", "beliggenhetsadresse": {"adresse": ["Kaia 2"], "poststed": "BERGEN"}, "harRegistrertAntallAnsatte": True, "antallAnsatte": 4}
    answers = spark.createDataFrame([("1", json.dumps({"_embedded": {"underenheter": [unit]}, "page": {"totalElements": 9}})), ("2", "{}")], "org string, body string")
    claims = official.normalize_locations(answers)
    assert rows(claims, "org", "field", "availability") == [("1", "location", "available"), ("1", "location_count", "available"), ("2", "location", "not_available")]
    assert json.loads(claims.filter("field = 'location' AND org = '1'").first().value)["employees"] == 4


def test_accounts_prefer_own_company_and_leave_absent_lines_absent(spark):
    def record(number, kind, end, revenue=None):
        result = {} if revenue is None else {"driftsresultat": {"driftsinntekter": {"sumDriftsinntekter": revenue}}}
        return {"id": number, "regnskapstype": kind, "regnskapsperiode": {"fraDato": end[:4] + "-01-01", "tilDato": end}, "valuta": "NOK", "resultatregnskapResultat": result}

    body = [record(1, "KONSERN", "2023-12-31", 900.0), record(2, "SELSKAP", "2023-12-31", 0.0), record(3, "SELSKAP", "2022-12-31")]
    answers = spark.createDataFrame([("1", json.dumps(body))], "org string, body string")
    kept = official.normalize_accounts(official.account_records(answers), keep=3)
    assert [r.record_id for r in kept.orderBy("place").collect()] == [2, 1, 3]
    claims = official.account_claims(kept)
    assert rows(claims, "field", "subject", "reporting_period", "value") == [
        ("revenue", "consolidated", "2023", '{"amount":900.0,"currency":"NOK","consolidated":true}'),
        ("revenue", "entity", "2023", '{"amount":0.0,"currency":"NOK","consolidated":false}')]


def test_filing_years_and_group_parent(spark):
    answers = spark.createDataFrame([("1", '["2020", "2019", "2020", "x"]')], "org string, body string")
    row = official.filing_history(official.filing_years(answers)).first()
    assert (row.years, row.first_year, row.filings) == (["2019", "2020"], 2019, 2)
    groups = spark.createDataFrame([
        ("1", '{"parentNavn": "Mor AS", "parentOrganisasjonsnummer": "9"}'),
        ("2", '{"children": [{"organisasjonsnummer": "3", "parentNavn": "Feil"}, {"organisasjonsnummer": "2", "parentNavn": "Bestemor", "parentOrganisasjonsnummer": "8"}]}'),
        ("4", "{}")], "org string, body string")
    assert rows(official.group_parent(groups), "org", "parent_name", "parent_org") == [("1", "Mor AS", "9"), ("2", "Bestemor", "8")]


def test_replay_marks_a_missing_answer_as_an_error(spark):
    orgs = spark.createDataFrame([("1",)], "org string")
    responses = spark.createDataFrame([
        ("https://data.brreg.no/enhetsregisteret/api/enheter/1", 200, "{}", "t", "t"),
        ("https://data.brreg.no/enhetsregisteret/api/enheter/1/roller", 404, "", "t", "t")],
        "url string, status int, body string, retrieved_at string, effective_at string")
    replayed = official.replay_responses(orgs, responses, ["registry_live", "roles", "financials"])
    assert rows(replayed, "module", "status") == [("financials", "source_error"), ("registry_live", "available"), ("roles", "not_found")]


RSS = """<?xml version="1.0"?><rss><channel><title>Site</title>
<item><title>Ny avtale</title><link>https://a.no/nyheter/x</link><source url="https://p.no">Avisen</source><pubDate>Tue, 03 Mar 2026 10:00:00 +0100</pubDate></item>
<item><title>Uten dato</title><link>https://a.no/nyheter/y</link></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title type="html">Oppdatert sak</title>
<link rel="edit" href="https://a.no/edit"/><link rel="alternate" href="https://a.no/sak"/><updated>2026-02-01T00:00:00Z</updated></entry></feed>"""


def test_feeds_keep_published_and_modified_apart(spark):
    docs = spark.createDataFrame([("1", "u1", RSS), ("1", "u2", ATOM), ("1", "u3", "<rss><channel><item>")], "org string, url string, xml string")
    found = feeds.explode_feed(docs)
    assert sorted(tuple(map(str, r)) for r in found.select("url", "outcome", "title", "link", "published", "modified", "date_kind").collect()) == sorted([
        ("u1", "item", "Ny avtale", "https://a.no/nyheter/x", "2026-03-03", "", "published"),
        ("u1", "item", "Uten dato", "https://a.no/nyheter/y", "", "", "unknown"),
        ("u2", "item", "Oppdatert sak", "https://a.no/sak", "", "2026-02-01", "modified"),
        ("u3", "parse_failure", "None", "None", "None", "None", "None")])


def test_sitemaps_are_walked_once_and_stay_on_site(spark):
    index = "<sitemapindex xmlns='x'><sitemap><loc>https://a.no/news.xml</loc></sitemap><sitemap><loc>https://b.no/x.xml</loc></sitemap><sitemap><loc>https://a.no/map.xml</loc></sitemap><sitemap><loc>https://a.no/product.xml</loc></sitemap></sitemapindex>"
    news = "<urlset xmlns='x'><url><loc>https://a.no/nyheter/stor-sak</loc><lastmod>2026-01-02</lastmod></url><url><loc>https://a.no/nyheter/</loc></url><url><loc>https://c.no/nyheter/z</loc></url></urlset>"
    docs = spark.createDataFrame([("https://a.no/map.xml", index), ("https://a.no/news.xml", news)], "url string, xml string")
    roots = spark.createDataFrame([("1", "https://a.no/map.xml")], "org string, url string")
    assert rows(feeds.explode_sitemaps(docs, roots), "url", "modified", "level", "is_article") == [
        ("https://a.no/nyheter/", "", 1, False), ("https://a.no/nyheter/stor-sak", "2026-01-02", 1, True)]


def test_capture_store_appends_only_new_content(spark, tmp_path):
    store = captures.CaptureStore(spark, str(tmp_path / "store"), "digests_of_a_test")
    frame = lambda *bodies: spark.createDataFrame([(b,) for b in bodies], "body string")
    assert store.append(frame("a", "a", "b", None), 0) and store.append(frame("b", "c"), 1)
    assert not store.append(frame("a", "b", "c", "c"), 2) and not store.append(frame(), 3)
    assert sorted((r.body, r.batch) for r in store.bodies().collect()) == [("a", 0), ("b", 0), ("c", 1)]
    assert sorted(r.batch for r in store.digests().collect()) == [0, 0, 1]
    # The table can be declared again over its folder, and its buckets are used.
    spark.sql("DROP TABLE digests_of_a_test")
    again = captures.CaptureStore(spark, str(tmp_path / "store"), "digests_of_another_test")
    assert not again.append(frame("c", "a"), 4) and again.append(frame("d"), 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = frame("x").select(F.sha2("body", 256).alias("content_sha256"))
        plan = fresh.join(again.digests(), "content_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1


def test_bodies_are_fetched_by_row_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "bodies")
    spark.createDataFrame([(f"body {k % 7}",) for k in range(50)], "html string").repartition(4).write.parquet(path)
    rows, fresh = captures.first_rows(spark.read.parquet(path), body="html")
    found = captures.fetch(rows, fresh)
    assert sorted(r.body for r in found.collect()) == [f"body {k}" for k in range(7)]
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.body for r in captures.new_captures(spark.read.parquet(path), captures.capture_rows(spark.read.parquet(path).filter("html > 'body 2'"), "html"), "html").collect()) == ["body 0", "body 1", "body 2"]


def test_the_text_of_a_list_is_not_copied_to_its_entries(spark, tmp_path):
    (tmp_path / "m").write_text('[{"orgnr": "100000001", "name": "A"}, "100000002"]\n100000003,C\n')
    read = registry.read_manifest(spark, str(tmp_path / "m"))
    assert sorted((r.org, r.name) for r in read.collect()) == [("100000001", "A"), ("100000002", None), ("100000003", "C")]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate posexplode"):]
    assert "isnull(v#" in below and "isnull(v#" not in plan[: plan.index("Generate posexplode")]  # the choice is made before a line is split
