import pytest
from pyspark.sql import functions as F

from attesta.functions import dates, labels, markup, text, urls
from attesta.functions.workforce import needs_ocr, workforce_from_text

S = F.lit


@pytest.mark.parametrize("raw,expected", [("Blåbær Ærlig Øl", "blabaer aerlig ol"), ("Café Zürich ½", "cafe zurich 12"), (None, ""), ("ŠKODA № 5", "skoda no 5"), ("Ａｂｃ", "abc")])
def test_fold(value, raw, expected):
    assert value(text.fold(S(raw).cast("string"))) == expected


def test_name_tokens_fall_back_to_filler(value):
    assert value(text.name_tokens(S("Nordisk Blåbær Holding AS"))) == ["nordisk", "blabaer"]
    assert value(text.name_tokens(S("Holding Invest AS"))) == ["holding", "invest"]
    assert value(text.name_tokens(S("Alfa Alfa B AS"))) == ["alfa"]


@pytest.mark.parametrize("raw,expected", [("Alfa Bygg AS", "alfa bygg"), ("Alfa FL I", "alfa"), ("Alfa Stiftelsen AS", "alfa"), ("AS", ""), ("Ås AS", "")])
def test_normalize_employer(value, raw, expected):
    # "Ås" folds to "as", which is itself a legal form.
    assert value(text.normalize_employer(S(raw))) == expected


@pytest.mark.parametrize("a,b,same", [
    ("Alfa Bygg AS", "ALFA BYGG", True), ("Alfa Bygg AS", "Alfa Bygg AS avd Bergen", True), ("Alfa Bygg AS", "Alfa Byggeri AS", False), ("", "Alfa", False), ("Haakon AS", "Håkon", True)])
def test_names_match(value, a, b, same):
    assert value(text.names_match(S(a), S(b))) is same


def test_org_numbers_are_never_glued_from_other_numbers(value):
    body = "Org.nr 974 760 673, NO 923609016 MVA, tlf 22 33 44 55 66 77, pris 1000000000"
    assert sorted(value(text.find_org_numbers(S(body)))) == ["923609016", "974760673"]
    assert value(text.mod11_valid(S("974760673"))) and not value(text.mod11_valid(S("974760674")))
    assert value(text.number_in_text(S("974760673"), S("nr 974.760 673.")))
    assert not value(text.number_in_text(S("974760673"), S("9747606731")))


def test_phrase_and_token_hits(value):
    assert value(text.has_phrase(S("om alfa bygg her"), S("alfa bygg"))) and not value(text.has_phrase(S("alfabygg"), S("alfa")))
    assert value(text.token_hits(F.array(S("ski"), S("alfa")), S("skisenter alfabygg"))) == ["alfa"]


def test_proof_span(value):
    assert value(text.proof_span(S("a" * 100 + "  Alfa  Bygg " + "b" * 100), S("alfa"))).strip("ab") .strip() == "Alfa  Bygg".replace("  ", " ")
    assert value(text.proof_span(S("tekst"), S("borte"))) is None


@pytest.mark.parametrize("raw,host", [("https://www.Alfa.no:80/x", "alfa.no"), ("http://bruker@alfa.no/", "alfa.no"), ("alfa.no", ""), (None, "")])
def test_host(value, raw, host):
    assert value(urls.host(S(raw).cast("string"))) == host


@pytest.mark.parametrize("raw,expected", [
    ("alfa.no", "https://alfa.no/"), ("HTTP://alfa.no/om?x=1#y", "http://alfa.no/om"), ("", None), (None, None)])
def test_normalize_homepage(value, raw, expected):
    assert value(urls.normalize_homepage(S(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw,expected", [("www.alfa.no/", "https://alfa.no"), ("-", None), ("alfa bygg.no", None), ("alfa", None)])
def test_normalize_site(value, raw, expected):
    assert value(urls.normalize_site(S(raw))) == expected


def test_canonical_url_drops_tracking_only(value):
    assert value(urls.canonical_url(S("HTTPS://Alfa.no/a/?utm_source=x&id=3&fbclid=y#z"))) == "https://alfa.no/a?id=3"


def test_block_lists_cover_subdomains_only(value):
    assert value(urls.is_directory_host(S("no.linkedin.com"))) and value(urls.is_directory_host(S("oslo.kommune.no")))
    assert not value(urls.is_directory_host(S("mylinkedin.com"))) and not value(urls.is_directory_host(S("kommune.no")))


def test_registered_domain(value):
    assert value(urls.registered_domain(S("a.b.alfa.co.uk"))) == "alfa.co.uk"
    assert value(urls.registered_domain(S("no"))) == ""


@pytest.mark.parametrize("raw,expected", [
    ("https://www.linkedin.com/company/alfa-bygg/about", ("linkedin", "https://linkedin.com/company/alfa-bygg")),
    ("https://www.linkedin.com/in/person", None), ("https://facebook.com/sharer.php?u=x", None),
    ("//facebook.com/pages/Alfa", ("facebook", "https://facebook.com/Alfa")),
    ("https://www.facebook.com/plugins/page.php?href=https%3A%2F%2Fwww.facebook.com%2Falfa&tabs=x", ("facebook", "https://facebook.com/alfa")),
    ("https://instagram.com/p/abc", None), ("https://twitter.com/alfa", ("x", "https://x.com/alfa")), ("https://x.com/alfa/status/1", None),
    ("https://youtube.com/@alfa/videos", ("youtube", "https://youtube.com/@alfa")), ("https://youtube.com/watch?v=1", None),
    ("https://tiktok.com/@alfa", ("tiktok", "https://tiktok.com/@alfa")), ("https://alfa.no/facebook", None)])
def test_normalize_social_url(value, raw, expected):
    found = value(urls.normalize_social_url(S(raw)))
    assert (tuple(found) if found else None) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Publisert 2024-03-05.", "2024-03-05"), ("den 05.03.2024", "2024-03-05"), ("5. mars 2024", "2024-03-05"), ("March 5, 2024", "2024-03-05"), ("2019-03-05", "2019-03-05"), ("5. mai 2027", "2027-05-05"), ("ingen", None)])
def test_extract_iso_date(value, raw, expected):
    assert value(dates.extract_iso_date(S(raw))) == expected


@pytest.mark.parametrize("raw,expected", [
    ("Tue, 03 Mar 2026 10:00:00 +0100", "2026-03-03"), ("3 Mar 2026 10:00", "2026-03-03"), ("2026-03-03T01:00:00Z", "2026-03-03"), ("2026-02-30", ""), ("i går", ""), (None, "")])
def test_date_only(value, raw, expected):
    assert value(dates.date_only(S(raw).cast("string"))) == expected


def test_norwegian_date(value):
    assert value(dates.norwegian_date(S("Frist 12. mars 2026"))) == "2026-03-12"
    assert value(dates.norwegian_date(S("12. march 2026"))) is None


def test_domain_guesses_rank_and_limit(value):
    guessed = value(labels.domain_guesses(S("Blåbær Bygg Drift AS"), S("Oslo"), 4))
    assert guessed == ["https://blabaerbyggdrift.no/", "https://blabaerbygg.no/", "https://blabaerbyggdrift.com/", "https://blabaer-bygg-drift.no/"]
    assert value(labels.domain_guesses(S("Alfa Bergen AS"), S("Bergen"), 14))[1] == "https://alfabergen.com/" or "https://alfa.no/" in value(labels.domain_guesses(S("Alfa Bergen AS"), S("Bergen"), 14))
    assert value(labels.domain_guesses(S("AS"), S("Oslo"), 14)) == []


def test_candidate_hosts(value):
    assert value(labels.candidate_hosts(S("Alfa AB"), S(""), 1)) == ["alfa.no", "alfa.com", "alfa.se"]


def test_search_queries_drop_repeats(value):
    made = value(labels.search_queries(S("Alfa Bygg AS"), S("974760673"), S("Oslo"), S(None).cast("string")))
    assert made == ['"Alfa Bygg AS" -site:proff.no -site:1881.no -site:dnb.com', '"Alfa Bygg" "Oslo"', '"974760673" "Alfa Bygg AS"']


@pytest.mark.parametrize("raw,expected", [(1_250_000_000.0, "1.25B NOK"), (-3_400_000.0, "-3.40M NOK"), (7500.0, "7.5k NOK"), (12.0, "12 NOK"), (None, "N/A")])
def test_format_amount(value, raw, expected):
    assert value(text.format_amount_compact(S(raw).cast("double"))) == expected


def test_phones(value):
    body = "Tlf: +47 400 11 222 eller 22 33 44 55, faks 12345678, konto 1234 56 78901"
    assert value(markup.phones(S(body))) == ["+47 400 11 222", "+47 22 33 44 55"]


def test_contacts_skip_image_names(value):
    assert value(markup.emails(S("Post@Alfa.no logo@2x.png post@alfa.no"))) == ["post@alfa.no"]


HTML = """<html><head><title> Alfa &amp; Co </title><meta content="Om oss" name="description"><script type="application/ld+json">
{"@graph": [{"@type": "Organization", "name": "Alfa", "department": {"@type": ["Store", "Place"], "name": "Butikk"}}]}</script>
<script type='application/ld+json'>{broken</script><script>var x = "<title>No</title>"</script></head>
<body><p>Hei<noscript>skjult</noscript></p><div class="kontakt-oss">Gata 1</div><footer>Org 974 760 673</footer>
<a href="https://facebook.com/alfa">F</a><a href='/kontakt'>K</a></body></html>"""


def test_page_signals(spark):
    row = spark.createDataFrame([(HTML,)], "html string").select(*markup.page_signals(F.col("html"))).first()
    assert (row.title, row.meta_description, row.footer_text, row.contact_text) == ("Alfa &amp; Co", "Om oss", "Org 974 760 673", "Gata 1")
    assert "skjult" not in row.body_text and "var x" not in row.body_text


def test_jsonld_nodes_at_any_depth(spark):
    nodes = markup.jsonld_nodes(spark.createDataFrame([("p", HTML), ("q", "<p>no</p>")], "url string, html string"), "url")
    assert [(r.page_key, r.pos, r.types) for r in nodes.orderBy("pos").collect()] == [("p", 0, ["Organization"]), ("p", 1, ["Store", "Place"])]


@pytest.mark.parametrize("body,expected", [
    ("Antall årsverk sysselsatt i regnskapsaret er 12,5", (12.5, "full_time_equivalents", "accepted")),
    ("Gjennomsnittlig antall ansatte: 1O", (10.0, "employees", "accepted")),
    ("Selskapet har ingen ansatte", (0.0, "employees", "accepted")),
    ("Selskapet har to ansatte", (2.0, "employees", "accepted")),
    ("Konsernet: antall ansatte 900\nAntall ansatte 7", (7.0, "employees", "accepted")),
    ("Antall ansatte 7\nAntall ansatte 9", (None, None, "conflicting_employee_counts")),
    ("Antall ansatte 1.200", (1200.0, "employees", "accepted")),
    ("Antall ansatte\n er 4", (4.0, "employees", "accepted")),
    ("Årsberetning", (None, None, "no_employee_phrase"))])
def test_workforce(value, body, expected):
    found = value(workforce_from_text(S(body)))
    assert (found["value"], found["measure"], found["status"]) == expected
    assert (found["span"] is not None) == (found["status"] == "accepted")


def test_needs_ocr(value):
    assert value(needs_ocr(S("kort"))) and not value(needs_ocr(S("ansatt " * 40)))


def test_fuzzy_ratio(spark):
    rows = spark.createDataFrame([("alfa bygg", "alfa bygg"), ("alfa", "beta"), (None, None), ("", "")], "a string, b string")
    assert [r[0] and round(r[0], 3) for r in rows.select(text.fuzzy_ratio("a", "b")).collect()] == [1.0, 0.25, None, 1.0]


def test_polarity(value):
    assert value(text.rating_polarity(S(4.0), S(5.0))) == "positive" and value(text.rating_polarity(S(2.0), S(5.0))) == "negative"
    assert value(text.rating_polarity(S(3.0), S(5.0))) == "neutral" and value(text.headline_sentiment(S("Rekord og konkurs"))) == "neutral"
