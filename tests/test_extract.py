import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from attesta.operators import extract, observations as obs, pages as page_ops
from attesta.operators.resolve import legal_proof
from attesta.plans.catalog import CATALOG
from attesta.session import checkpoint_folder

AS_OF = "2026-03-10 12:00:00"
ORG = "974760673"
PROFILE = "org string, name string, municipality string, own_domain string, street string, people array<string>, founded string"


def profiles(spark, domain="blabaer.no"):
    return spark.createDataFrame([(ORG, "Blåbær Teknikk AS", "Trondheim", domain, None, None, "2001-01-01")], PROFILE)


def script(*nodes):
    return "".join(f'<script type="application/ld+json">{json.dumps(n, ensure_ascii=False)}</script>' for n in nodes)


def job(**extra):
    return {"@type": "JobPosting", "title": "Senior utvikler", "datePosted": "2026-03-01", "validThrough": "2026-04-01", "hiringOrganization": {"@type": "Organization", "name": "Blåbær Teknikk"}, **extra}


def test_site_jobs_need_their_own_page_an_open_date_and_the_employer(spark):
    pages = spark.createDataFrame([
        (ORG, "https://blabaer.no/jobb/utvikler", script(job())), (ORG, "https://blabaer.no/karriere", script(job(url="/jobb/annen"))),
        (ORG, "https://blabaer.no/jobb/utlopt", script(job(validThrough="2026-03-01"))), (ORG, "https://blabaer.no/jobb/fremmed", script(job(hiringOrganization={"name": "Annen AS"}))),
        (ORG, "https://blabaer.no/jobb/nummer", script({"@graph": [job(hiringOrganization={"name": "X", "identifier": {"value": "NO 974760673 MVA"}})]})),
    ], "org string, url string, html string").withColumn("content_sha256", F.sha2("html", 256))
    verdicts = spark.createDataFrame([(ORG, True, True, "https://blabaer.no/")], "org string, publishable boolean, content_attributable boolean, site_url string")
    found = extract.site_jobs(pages, profiles(spark), verdicts, AS_OF)
    assert sorted(r.source_url for r in found.collect()) == ["https://blabaer.no/jobb/nummer", "https://blabaer.no/jobb/utvikler"]
    assert found.select(obs.active_job(AS_OF).alias("a")).distinct().collect()[0].a
    closed = verdicts.withColumn("content_attributable", F.lit(False))
    assert extract.site_jobs(pages, profiles(spark), closed, AS_OF).count() == 0


def documents(spark, rows):
    schema = "org string, category string, url string, html string, text string, published string, title string"
    return spark.createDataFrame([(ORG, *r) for r in rows], schema).withColumn("content_sha256", F.sha2("html", 256))


def test_document_observations(spark):
    proven = "Blåbær Teknikk AS i Trondheim"
    review = {"@type": "Review", "itemReviewed": {"@type": "LocalBusiness", "name": "x", "taxID": ORG}, "reviewBody": "Bra", "reviewRating": {"ratingValue": "5", "bestRating": 5}, "datePublished": "2026-01-02T10:00"}
    rated = {"@type": "LocalBusiness", "name": "Blåbær Teknikk AS", "address": "Trondheim", "aggregateRating": {"ratingValue": 4.5, "reviewCount": 12}}
    owner = {"@type": "Organization", "name": "Blåbær Teknikk AS", "address": "Trondheim", "numberOfEmployees": {"value": 14}}
    media = {"@type": "VideoObject", "name": "Film", "author": {"name": "Blåbær Teknikk"}, "interactionStatistic": [{"interactionType": "https://schema.org/WatchAction", "userInteractionCount": 90}]}
    docs = documents(spark, [
        ("news", "https://avis.no/a", "<article>x</article>", proven, "2026-02-01", "Ny kontrakt"), ("news", "https://avis.no/gammel", "", proven, "1999-02-01", "For tidlig"),
        ("news", "https://avis.no/fremtid", "", proven, "2027-01-01", "Senere"), ("news", "https://avis.no/annen", "", "Et annet selskap", "2026-02-01", "Annet"),
        ("news", "https://avis.no/lenke", '<a href="https://www.blabaer.no/om">b</a>', "Blåbær og Teknikk", "2026-02-01", "Lenket"),
        ("reviews", "https://katalog.no/r", script(review, rated), "tekst " + proven, None, ""), ("workforce", "https://blabaer.no/om", script(owner, media), "Om oss", None, ""),
        ("careers", "https://blabaer.no/jobb/x", script(job()), "Jobb", None, ""),
    ])
    found = extract.document_observations(docs, profiles(spark), AS_OF)
    rows = sorted((r.signal_type, r.source_url) for r in found.collect())
    assert rows == [
        ("job_posting", "https://blabaer.no/jobb/x"), ("profile_metrics", "https://blabaer.no/om"), ("public_mention", "https://avis.no/a"), ("public_mention", "https://avis.no/lenke"),
        ("review", "https://katalog.no/r"), ("review_summary", "https://katalog.no/r"), ("workforce_snapshot", "https://blabaer.no/om")]
    one = {r.signal_type: r for r in found.collect()}
    assert one["review"].sentiment_label == "positive" and one["review"].published_at == "2026-01-02"
    assert json.loads(one["workforce_snapshot"].metrics) == {"employees": 14, "measure": "employees"}
    assert json.loads(one["profile_metrics"].metrics) == {"views": 90}
    assert json.loads(one["review_summary"].metrics) == {"rating": 4.5, "review_count": 12, "scale": 5.0}
    assert found.select("id").distinct().count() == found.count()


def test_boards_and_listings(spark):
    links = spark.createDataFrame([
        (ORG, "https://boards.greenhouse.io/blabaer/jobs/1", "https://blabaer.no/", "a" * 64), (ORG, "https://boards.greenhouse.io/blabaer", "https://blabaer.no/jobb", "b" * 64),
        (ORG, "https://jobs.lever.co/blab.aer", "https://blabaer.no/", "a" * 64), (ORG, "https://example.com/x", "https://blabaer.no/", "a" * 64)], "org string, link string, evidence_url string, evidence_sha256 string")
    boards = extract.evidenced_boards(links)
    assert [(r.provider, r.token) for r in boards.collect()] == [("greenhouse", "blabaer")]
    posting = "provider string, token string, job_id string, title string, url string, content string, internal_job_id string, published_at string, content_sha256 string"
    postings = spark.createDataFrame([
        ("greenhouse", "blabaer", "77", "Utvikler", "https://boards.greenhouse.io/blabaer/jobs/77", "&lt;p&gt;Blåbær Teknikk AS, Trondheim&lt;/p&gt;", "5", None, "c" * 64),
        ("greenhouse", "blabaer", "78", "Utvikler", "https://boards.greenhouse.io/blabaer/jobs/78", "Ingen", "5", None, "c" * 64),
        ("greenhouse", "blabaer", "79", "Kort", "https://boards.greenhouse.io/blabaer/jobs/79", "Blåbær Teknikk AS, Trondheim", "5", None, "c" * 64),
        ("greenhouse", "blabaer", "80", "Utvikler", "http://boards.greenhouse.io/blabaer/jobs/80", "Blåbær Teknikk AS, Trondheim", "5", None, "c" * 64)], posting)
    found = extract.ats_listings(boards, postings, profiles(spark), "2026-03-10T10:00:00Z")
    assert [r.source_url for r in found.collect()] == ["https://boards.greenhouse.io/blabaer/jobs/77"]
    checks = lambda at: found.select(obs.direct_job().alias("d"), obs.active_job(at).alias("a")).first()
    assert tuple(checks(AS_OF)) == (True, True) and tuple(checks("2026-03-12 12:00:00")) == (True, False)


@pytest.mark.parametrize("url,metrics,proof,expected", [
    ("https://finn.no/job/ad/123", {"job_title": "Kokk"}, None, True), ("https://finn.no/job/search", {"job_title": "Kokk"}, None, False),
    ("https://linkedin.com/jobs/view/1", {"job_title": "Kokk"}, None, True), ("https://linkedin.com/company/x", {"job_title": "Kokk", "deadline": "2026-04-01"}, None, False),
    ("https://alfa.no/karriere", {"job_title": "Kokk", "deadline": "2026-04-01"}, None, False), ("https://alfa.no/karriere/kokk", {"job_title": "Kokk", "deadline": "2026-04-01"}, None, True),
    ("https://alfa.no/karriere/kokk", {"job_title": "Kokk"}, None, False), ("https://facebook.com/x/y", {"job_title": "Kokk", "deadline": "2026-04-01"}, None, False),
    ("https://pam-stilling-feed.nav.no/api/v1/feedentry/u", {"title": "Kokk"}, "nav_employer_organisation_number", True), ("https://pam-stilling-feed.nav.no/api/v1/feedentry/u", {"title": "Kokk"}, "x", False),
    ("https://alfa.no/share/kokk", {"job_title": "Kokk", "deadline": "2026-04-01"}, None, False), ("https://alfa.no/x", {"job_title": "Ledige stillinger", "deadline": "2026-04-01"}, None, False)])
def test_direct_job(spark, url, metrics, proof, expected):
    row = spark.createDataFrame([(url, json.dumps(metrics), [{"type": proof}] if proof else [])], "source_url string, metrics string, identity_proof array<map<string,string>>")
    assert row.select(obs.direct_job().alias("d")).first().d is expected


def test_place_observations(spark):
    place = "org string, place_id string, title string, address string, phone string, web_site string, link string, review_rating double, review_count int, user_reviews array<struct<review_id:string,rating:double,text:string,published_at:string>>"
    places = spark.createDataFrame([("1", "p", "Alfa", "Gata 1", "22", "alfa.no", "https://maps/p", 4.5, 10, [("r1", 5.0, "Bra", "2026-01-01"), ("r2", 1.0, "", None), ("r3", 0.0, "x", None)]), ("2", "q", "B", "", "", None, "", 4.0, 3, [])], place)
    resolved = spark.createDataFrame([("1", "exact_match", "p"), ("2", "ambiguous_exact_match", None)], "org string, status string, place_id string")
    found = extract.place_observations(resolved, places)
    counts = {r.signal_type: r["count"] for r in found.groupBy("signal_type").count().collect()}
    assert counts == {"place_summary": 1, "company_profile": 1, "review_summary": 1, "profile_metrics": 1, "buzz_metrics": 1, "review": 2}
    assert sorted((r.evidence_span, r.sentiment_label) for r in found.filter("signal_type = 'review'").collect()) == [("Bra", "positive"), ("Explicit customer rating: 1.0/5", "negative")]


CARD = '<article class="main-feed-activity-card" data-activity-urn="urn:li:activity:555"><a data-test-id="social-actions__reactions" data-num-reactions="7"></a><a data-num-comments="2"></a></article>'


def test_profile_pages(spark):
    org_node = {"@type": "Organization", "name": "Blåbær Teknikk", "url": "https://www.linkedin.com/company/Blabaer", "numberOfEmployees": {"value": 12}}
    post = {"@type": "DiscussionForumPosting", "url": "https://linkedin.com/posts/x-activity-555-a", "text": "Hei", "datePublished": "2026-01-01", "author": {"url": "https://no.linkedin.com/company/blabaer"}}
    other = {**post, "author": {"url": "https://linkedin.com/company/andre"}}
    about = '<div data-test-id="about-us__size"><dt>Size</dt><dd>11-50</dd></div><div data-test-id="about-us__website"><dd><a>https://www.blabaer.no</a></dd></div>'
    html = '<meta name="description" content="Blåbær | 1,234 followers on LinkedIn">' + script({"@graph": [org_node, post, other]}) + about + CARD
    pages = spark.createDataFrame([(ORG, "https://linkedin.com/company/blabaer", "https://linkedin.com/company/blabaer", html), (ORG, "https://linkedin.com/company/blabaer-as", "https://linkedin.com/company/blabaer2", html)],
                                  "org string, requested_url string, url string, html string").withColumn("content_sha256", F.sha2("html", 256))
    metrics = extract.profile_page_metrics(pages)
    row = metrics.collect()
    assert len(row) == 1  # the second handle resolves to the same page
    assert (row[0].page_url, row[0].followers, row[0].visible_employees, row[0].employee_size_label, row[0].website) == ("https://linkedin.com/company/blabaer", 1234, 12, "11-50", "https://www.blabaer.no")
    posts = extract.profile_page_posts(pages, metrics)
    assert [(r.likes, r.comments, r.text) for r in posts.collect()] == [(7, 2, "Hei")]
    domain = spark.createDataFrame([(ORG, "Annet Navn AS", "blabaer.no")], "org string, name string, domain string")
    judged = extract.profile_page_identity(metrics, domain)
    assert judged.first().publishable and judged.first().reverse_domain and not judged.first().exact_name
    assert sorted(r.signal_type for r in extract.profile_page_observations(judged, posts).collect()) == ["profile_metrics", "public_post", "workforce_snapshot"]


def test_directory_ratings(spark):
    html = script({"@type": "Thing"}, {"@type": "LocalBusiness", "aggregateRating": {"ratingValue": "4.2", "ratingCount": 9}})
    pages = spark.createDataFrame([("1", "u", html), ("2", "v", "<p>")], "org string, url string, html string").withColumn("content_sha256", F.sha2("html", 256))
    assert [(r.org, r.rating, r.review_count) for r in extract.directory_ratings(pages).collect()] == [("1", 4.2, 9)]


def test_job_search_pages(spark):
    article = lambda u, e, d: f'<article><a href="/stillinger/stilling/{u}">Selger</a><p>Arbeidsgiver</p><p>{e}</p><p>Sted</p><p>Oslo</p><p>{d}</p></article>'
    html = article("aa-1", "Blåbær Teknikk avd Oslo", "12. mars 2026") + article("aa-1", "Blåbær Teknikk AS", "") + article("bb-2", "Blåbær Teknikk Holding", "1. mars 2026")
    results = spark.createDataFrame([(ORG, html), ("2", "<article></article>")], "org string, html string")
    named = spark.createDataFrame([(ORG, "Blåbær Teknikk AS"), ("2", "Annen AS")], "org string, name string")
    ads = extract.employer_search_ads(results, named).collect()
    assert [(r.uuid, r.employer, r.location, r.published) for r in ads] == [("aa-1", "Blåbær Teknikk avd Oslo", "Oslo", "2026-03-12")]
    claims = {(r.org, r.field): r.value for r in extract.employer_search_claims(results, named).collect()}
    assert claims[ORG, "active_job_count"] == "1" and claims["2", "active_job_count"] == "0" and ("2", "hiring_or_activity_signal") not in claims


def test_reviewed_rows_stop_on_bad_input(spark):
    rows = spark.createDataFrame([("9", "news", "review", "u", "a" * 64, "read")], "org string, platform string, signal_type string, source_url string, content_sha256 string, proof string")
    with pytest.raises(ValueError):
        extract.seed_observations(rows, profiles(spark))


def test_workforce_reports(spark):
    reports = spark.createDataFrame([
        (ORG, "2023", "u1", f"{ORG} Antall ansatte 5", "h"), (ORG, "2024", "u2", f"Org 974 760 673. Antall ansatte 8", "h"), ("2", "2024", "u", "Antall ansatte 3", "h"), ("3", "2024", "u", "3 Antall ansatte 3", "h")],
        "org string, year string, url string, text string, content_sha256 string")
    register = spark.createDataFrame([("3", 4)], "org string, employees int")
    found = {r.org: (r.year, r.status, r.workforce_value) for r in extract.workforce_observations(reports, register).collect()}
    assert found == {ORG: ("2024", "accepted", 8.0), "2": ("2024", "organisation_number_not_in_report", None)}


PAGE = "org string, requested_url string, final_url string, status_code int, content_type string, page_kind string, html string, retrieved_at timestamp"


def test_crawl_events_and_merged_sites(spark):
    import datetime as dt

    at = lambda d: dt.datetime(2026, 1, d)
    html = "<title>A &amp; B</title><footer>F</footer><a href='https://facebook.com/alfa'>f</a>"
    pages = spark.createDataFrame([
        ("1", "https://a.no/gammel", "https://a.no/gammel", 200, "text/html", "homepage", html, at(1)), ("1", "https://a.no/om/oss", "https://a.no/om/oss", 200, "text/html", "homepage", html, at(2)),
        ("1", "https://a.no/", "https://a.no/", 200, "text/html", "secondary", html, at(2)), ("1", "https://a.no/x", "https://a.no/x", 404, "text/html", "secondary", None, at(2)),
        ("2", "https://b.no/", "https://b.no/", 200, "application/pdf", "homepage", "%PDF", at(2)), ("3", "https://c.no/y", "https://c.no/y", 500, "text/html", "secondary", "", at(2))], PAGE)
    events = page_ops.page_events(pages)
    assert sorted((r.final_url, r.status, r.error) for r in events.filter("org <> '1' OR status <> 'available'").collect()) == [
        ("https://a.no/x", "not_found", "HTTP 404"), ("https://b.no/", "source_error", "Unsupported content type: application/pdf"), ("https://c.no/y", "source_error", "HTTP 500")]
    sites = {r.org: r for r in page_ops.merge_page_events(events).collect()}
    assert (sites["1"].final_url, sites["1"].title, sites["1"].pages, sites["1"].crawl_errors) == ("https://a.no/om/oss", "A & B", 3, 1)
    assert sites["1"].homepage_required and sites["1"].owner_captured
    assert (sites["2"].status, sites["3"].status) == ("source_error", "not_found")
    assert page_ops.merged_pages(events).count() == 3
    assert [(r.platform, r.url, r.evidence_url) for r in page_ops.merged_social_links(events).collect()] == [("facebook", "https://facebook.com/alfa", "https://a.no/")]
    profiles_ = spark.createDataFrame([("1", "a.no"), ("4", "d.no"), ("5", None)], "org string, website string")
    assert [(r.org, r.requested_url) for r in page_ops.missing_seed_events(profiles_, events).collect()] == [("4", "https://d.no/")]


def test_site_statements(spark):
    career = '<title>Jobb hos oss</title><a href="mailto:x">x</a> post@alfa.no Tlf 22 33 44 55 <a href="https://facebook.com/alfa">f</a>'
    news = '<title>Nytt bygg</title><meta property="article:published_time" content="2024-05-06"> post@alfa.no'
    pages = spark.createDataFrame([("1", 1, "https://alfa.no/", "<title>Alfa</title>"), ("1", 2, "https://alfa.no/karriere", career), ("1", 3, "https://alfa.no/nyheter/x", news), ("2", 1, "https://b.no/", career)],
                                  "org string, pos int, url string, html string")
    verdicts = spark.createDataFrame([("1", True), ("2", False)], "org string, publishable boolean")
    claims = {r.field: r for r in page_ops.site_claims(pages, verdicts).collect()}
    assert claims["website"].value == "https://alfa.no" and claims["hiring_or_activity_signal"].value == "active_recruitment"
    assert (claims["dated_public_activity"].value, claims["dated_public_activity"].reporting_period) == ("Nytt bygg", "2024-05-06")
    contacts = sorted((r.field, r.value, r.pos) for r in page_ops.site_contacts(pages, verdicts).collect())
    assert contacts == [("contact_email", "post@alfa.no", 2), ("contact_phone", "+47 22 33 44 55", 2), ("social_profiles", "https://facebook.com/alfa", 2)]


def test_links_families_and_roles(spark):
    html = '<a href="/om-oss">Om</a><a href="/om-oss#x">Igjen</a><a href="https://andre.no/kontakt">K</a><a href="/pris.pdf">P</a><a href="kontakt">Kontakt oss</a><a href="mailto:a@b.no">m</a>'
    pages = spark.createDataFrame([("1", "https://www.alfa.no/mappe/side", html)], "org string, url string, html string")
    assert sorted((r.link, r.score) for r in page_ops.harvest_links(pages, "org").collect()) == [
        ("https://www.alfa.no/mappe/kontakt", 3), ("https://www.alfa.no/om-oss", 2), ("https://www.alfa.no/pris.pdf", -5)]
    assert page_ops.valuable_links(pages, "org").count() == 2
    links = spark.createDataFrame([("1", "https://a.no/karriere", "https://a.no/karriere/kokk"), ("1", "https://a.no/karriere", "https://a.no/om"), ("1", "https://a.no/om", "https://a.no/karriere/kokk")], "org string, url string, link string")
    assert [r.link for r in page_ops.role_links(links).collect()] == ["https://a.no/karriere/kokk"]
    many = spark.createDataFrame([("1", f"https://a.no/{p}", "") for p in ("kontakt", "contact-us", "jobs", "news/a", "about", "team", "x")], "org string, link string, anchor string")
    assert [r.link for r in page_ops.diverse_links(many, 5).orderBy("place").collect()] == ["https://a.no/kontakt", "https://a.no/jobs", "https://a.no/about", "https://a.no/news/a", "https://a.no/contact-us"]


def test_documents_of_one_file_reach_every_core(spark):
    rows = [("news", f"https://avis.no/{k}", script(job()), "Blåbær Teknikk AS i Trondheim", "2026-02-01", "Ny kontrakt") for k in range(200)]
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(folder.glob("document-*"))
    found = extract.document_observations(documents(spark, rows).coalesce(1), profiles(spark), AS_OF)
    (facts,) = [f for f in set(folder.glob("document-*")) - before if f.name.startswith("document-facts")]
    assert len(list(facts.glob("*.parquet"))) >= 4 and found.count() == 400


def test_proof_by_number_folds_no_text(spark):
    proof = legal_proof(*[F.col(c) for c in ("org", "name", "municipality", "own_domain", "street")], F.col("people"), F.col("text"), F.lit("blabaer.no"))
    assert str(proof).startswith("Column<'CASE WHEN")
    texts = profiles(spark).crossJoin(spark.createDataFrame([("Org.nr. 974 760 673",), ("Om oss",)], "text string"))
    assert sorted(r[0] for r in texts.select(proof).collect()) == ["captured_exact_organisation_number", "verified_own_domain"]


def test_posts_of_a_profile_page(spark):
    """An author in a post is not the page's organisation; an activity's last card counts; a post shown twice counts once."""
    org_node = {"@type": "Organization", "name": "Blåbær Teknikk", "url": "https://www.linkedin.com/company/Blabaer", "numberOfEmployees": {"value": 12}}
    post = {"@type": "DiscussionForumPosting", "url": "https://linkedin.com/posts/x-activity-555-a", "text": "Hei", "author": {"@type": "Organization", "name": "Forfatter", "url": "https://linkedin.com/company/blabaer"}}
    html = script(org_node, {"@graph": [post, {**post, "url": "https://linkedin.com/posts/x-activity-556-a"}]}, post) + CARD.replace('"7"', '"1"') + CARD
    pages = spark.createDataFrame([(ORG, "https://linkedin.com/company/blabaer", "https://linkedin.com/company/blabaer", html)], "org string, requested_url string, url string, html string").withColumn("content_sha256", F.sha2("html", 256))
    nodes = extract.profile_page_nodes(pages)
    metrics = extract.profile_page_metrics(pages, nodes)
    assert [(r.page_name, r.visible_employees) for r in metrics.collect()] == [("Blåbær Teknikk", 12)]
    posts = extract.profile_page_posts(pages, metrics, nodes)
    assert sorted((r.activity, r.likes, r.comments) for r in posts.collect()) == [("555", 7, 2), ("556", 0, 0)]


def test_profile_page_query_joins_posts_with_engagement(spark):
    entry.queries()
    rows = CATALOG["profile_page_metrics"].run(spark, "/root/testdata/sf0.001").collect()
    assert {r.posts for r in rows} == {0, 1, 2} and any(r.likes for r in rows) and {r.employee_size_label for r in rows} == {None, "11-50", "51-200"} and any(r.observations == 4 for r in rows)


def test_documents_give_their_nodes_without_a_shuffle(spark):
    """Nodes stay in the row of their document; only repeated addresses and nodes below one pass are stored and joined by address."""
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    names = lambda: {f.name.split("-")[0] + "-" + f.name.split("-")[1] for f in set(folder.glob("*")) - before}
    before = set(folder.glob("*"))
    row = lambda url, *nodes: ("careers", url, script(*nodes), "Jobb", None, "")
    plain = [row(f"https://blabaer.no/jobb/{k}", job()) for k in range(4)]
    seen = lambda rows: sorted(r.source_url for r in extract.document_observations(documents(spark, rows), profiles(spark), AS_OF).filter("signal_type = 'job_posting'").collect())
    assert seen(plain) == [r[1] for r in plain] and names() == {"document-facts", "document-keys"}
    deep = job()
    for _ in range(20):
        deep = {"x": [deep]}
    assert seen([*plain, row("https://blabaer.no/jobb/dyp", deep)]) == [*(r[1] for r in plain), "https://blabaer.no/jobb/dyp"]
    assert seen([*plain, plain[0], row("https://blabaer.no/om", {"@type": "Thing"})]) == [plain[0][1]] * 4 + [r[1] for r in plain[1:]]
    assert {"markup-nodes", "document-nodes"} <= names()
