"""Sentences, cited answers and per-entity cards, from stated facts only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.functions.text import format_amount_grouped


def _true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


# Fields a reader decides on, as the text that names the gap.
KEY_FIELDS = {
    "website": "a verified official website", "revenue": "latest annual revenue", "leadership": "registered leadership",
    "active_job_count": "a current hiring signal", "social_profiles": "verified social profiles",
    "ratings_and_reviews": "customer ratings", "qualified_sentiment": "news sentiment",
}
SINGLE_FIELDS = [
    "legal_name", "organisation_form", "operating_status", "founded_at", "registered_at", "registered_address", "employees", "industry_code",
    "revenue", "net_result", "website", "active_job_count", "job_posting", "dated_public_activity", "news_mention", "ratings_and_reviews",
    "qualified_sentiment", "social_profiles",
]


def _first_claims(claims: DataFrame) -> DataFrame:
    """The earliest available claim of each field the sentences use, one struct column per field."""
    available = F.col("availability") == "available"
    pick = F.struct("value", "claim_key", "reporting_period")
    columns = []
    for field in SINGLE_FIELDS:
        mine = available & (F.col("field") == field)
        columns.append(F.min_by(F.when(mine, pick), F.when(mine, F.col("first_pos"))).alias(field))
    role = F.get_json_object("value", "$.role")
    lead = available & (F.col("field") == "leadership")
    for name, code in (("ceo", "chief_executive"), ("chair", "board_chair")):
        mine = lead & _true(role == code)
        columns.append(F.min_by(F.when(mine, pick), F.when(mine, F.col("first_pos"))).alias(name))
    columns.append(F.count_if(lead).alias("officers"))
    for field in KEY_FIELDS:
        mine = F.col("field") == field
        columns.append(F.bool_or(mine & available).alias(f"has_{field}"))
        columns.append(F.bool_or(mine & (F.col("availability") != "not_applicable")).alias(f"checked_{field}"))
    return claims.groupBy("org").agg(*columns)


def synthesise(claims: DataFrame, names: DataFrame) -> DataFrame:
    """One row per sentence: (org, place, text, claim_keys, growth_signal); the last may name the gaps.

    ``claims`` comes from ``dedupe_claims``; values are JSON text or plain. ``names`` is
    (org, input_name).
    """
    j = names.join(_first_claims(claims), "org", "left")

    def value(field: str) -> Column:
        return F.col(f"{field}.value")

    def part(field: str, path: str) -> Column:
        return F.get_json_object(value(field), f"$.{path}")

    def flag(path: str) -> Column:
        return _true(part("operating_status", path) == "true")

    def money(field: str) -> Column:
        return format_amount_grouped(part(field, "amount").try_cast("double"), part(field, "currency"))

    def keys(*fields: str) -> Column:
        return F.array_compact(F.array(*[F.col(f"{f}.claim_key") for f in fields]))

    def say(text: Column, cited: Column, growth: bool = False) -> Column:
        return F.when(text.isNotNull(), F.struct(text.alias("text"), cited.alias("claim_keys"), F.lit(growth).alias("growth_signal")))

    legal = F.coalesce(value("legal_name"), "input_name")
    form = F.lower(F.coalesce(F.nullif(part("organisation_form", "description"), F.lit("")), part("organisation_form", "code"), F.lit("company")))
    winding = flag("under_liquidation") | flag("under_compulsory_liquidation")
    word = F.when(flag("bankrupt"), "bankrupt").when(winding, "under liquidation").when(flag("active"), "active").otherwise("registered")
    phrase = F.concat_ws(" ", word, form)
    article = F.when(phrase.rlike("^[aeiou]"), "an ").otherwise("a ")
    start = F.concat(legal, F.lit(" (org. no. "), "org", F.lit(") is "))
    lead = F.when(word == "under liquidation", F.concat(start, F.lit("a "), form, F.lit(" under liquidation."))).otherwise(F.concat(start, article, phrase, F.lit(".")))
    since = F.coalesce(value("founded_at"), value("registered_at"))
    town = F.coalesce(F.nullif(part("registered_address", "postal_town"), F.lit("")), part("registered_address", "municipality"))
    seat = F.array_compact(F.array(F.concat(F.lit("registered "), F.substring(since, 1, 10)), F.concat(F.lit("seated in "), F.initcap(F.lower(town)))))
    seated = F.when(F.size(seat) > 0, F.concat(F.lit("It is "), F.array_join(seat, " and "), F.lit(".")))
    trade = F.nullif(part("industry_code", "description"), F.lit(""))
    period = F.coalesce("revenue.reporting_period", F.lit(""))
    books = F.concat(F.lit("In "), period, F.lit(", revenue was "), money("revenue"), F.coalesce(F.concat(F.lit(" and the net result "), money("net_result")), F.lit("")), F.lit("."))
    heads = F.array_compact(F.array(
        F.concat(part("ceo", "name"), F.lit(" ("), F.coalesce(part("ceo", "title"), F.lit("CEO")), F.lit(")")), F.concat(part("chair", "name"), F.lit(" (chair)"))
    ))
    led = F.when(F.size(heads) > 0, F.concat(F.lit("Leadership includes "), F.array_join(heads, " and "), F.lit("."))).when(
        F.col("officers") > 0, F.format_string("The register lists %d current officers.", "officers")
    )
    jobs = value("active_job_count").try_cast("int")
    plural = F.when(jobs != 1, "s").otherwise("")
    posting = part("job_posting", "title")
    hiring = F.when(jobs > 0, F.concat(F.lit("It appears to be hiring: "), jobs.cast("string"), F.lit(" active job posting"), plural, F.lit(" on the public job board."))).when(
        posting.isNotNull(), F.concat(F.lit("It appears to be hiring: active posting \""), posting, F.lit("\"."))
    )
    act = F.coalesce(value("dated_public_activity"), value("news_mention"))
    act_title = F.get_json_object(act, "$.title")
    act_day = F.substring(F.coalesce(F.get_json_object(act, "$.date"), F.get_json_object(act, "$.published_at")), 1, 10)
    activity = F.concat(F.lit("Recent dated public activity: "), act_title, F.coalesce(F.concat(F.lit(" ("), F.nullif(act_day, F.lit("")), F.lit(")")), F.lit("")), F.lit("."))
    reviews = F.coalesce(part("ratings_and_reviews", "rating_count"), part("ratings_and_reviews", "review_count"), F.lit("0"))
    rated = F.concat(F.lit("Customer ratings: "), part("ratings_and_reviews", "rating"), F.lit(" from "), reviews, F.lit(" public review(s)."))
    platforms = F.array_join(F.array_sort(F.json_object_keys(value("social_profiles"))), ", ")
    gaps = F.array_compact(F.array(*[F.when(~_true(F.col(f"has_{f}")) & _true(F.col(f"checked_{f}")), F.lit(text)) for f, text in KEY_FIELDS.items()]))
    sentences = F.array_compact(F.array(
        say(lead, keys("legal_name", "operating_status")), say(seated, keys("founded_at", "registered_address")),
        say(F.concat(F.lit("The register records "), value("employees"), F.lit(" employees.")), keys("employees")),
        say(F.concat(F.lit("Its primary registered activity is "), F.lower(trade), F.lit(" (NACE "), part("industry_code", "code"), F.lit(").")), keys("industry_code")),
        say(books, keys("revenue", "net_result")), say(led, keys("ceo", "chair")),
        say(F.concat(F.lit("Its verified website is "), value("website"), F.lit(".")), keys("website")),
        say(hiring, keys("active_job_count", "job_posting"), True), say(activity, keys("dated_public_activity", "news_mention"), True),
        say(rated, keys("ratings_and_reviews"), True),
        say(F.concat(F.lit("News sentiment is "), part("qualified_sentiment", "label"), F.lit(", classified from cited news only.")), keys("qualified_sentiment"), True),
        say(F.concat(F.lit("Verified company-owned profiles: "), F.nullif(platforms, F.lit("")), F.lit(".")), keys("social_profiles"), True),
        say(F.when(F.size(gaps) > 0, F.concat(F.lit("Not established from the checked sources: "), F.array_join(gaps, ", "), F.lit("."))), F.array().cast("array<string>")),
    ))
    return j.select("org", F.posexplode(sentences).alias("place", "s")).select("org", "place", "s.*")


def summaries(sentences: DataFrame) -> DataFrame:
    """Sentences joined to one summary; an entity has a dozen at most."""
    listed = F.array_sort(F.collect_list(F.struct("place", "text")))
    return sentences.groupBy("org").agg(F.array_join(F.transform(listed, lambda s: s["text"]), " ").alias("summary"), F.count(F.lit(1)).alias("sentences"))


# ---- answers ----

# Words that choose a topic.
FINANCIAL_WORDS = ["financial", "finance", "account", "revenue", "income", "profit", "result", "debt", "asset", "regnskap"]
EXTERNAL_WORDS = ["social", "news", "job", "hiring", "review", "rating", "external", "footprint", "engagement", "buzz", "workforce"]
OTHER_WORDS = ["lead", "role", "location", "where", "sentiment", "employee"]
GAPS = {
    "financials": "No normalized annual-account record was returned; missing values are not interpreted as zero.",
    "roles": "No active public role holder was returned.",
    "locations": "No registered subunit was returned; this does not prove the company has no physical presence.",
    "website": "The registry-linked company website was not available to this run.",
    "external": "No qualified external observation supports the requested topic; missing evidence is not a negative finding.",
    "quarantined": "A registry-linked website was fetched, but exact legal-entity identity was not established; its claims and social links are quarantined.",
    "sentiment": "Sentiment is not scored: no labelled evaluation corpus has been run, and company-owned pages are promotional.",
}


def _asks(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def question_topics(questions: DataFrame) -> DataFrame:
    """(qid, org, question) with one flag per topic; a question without a topic word asks for all."""
    q = F.lower("question")
    everything = ~_asks(q, FINANCIAL_WORDS + EXTERNAL_WORDS + OTHER_WORDS)
    topics = {
        "registry": F.contains(q, F.lit("employee")), "financials": _asks(q, FINANCIAL_WORDS), "roles": _asks(q, ["lead", "role"]),
        "locations": _asks(q, ["location", "where"]), "website": F.contains(q, F.lit("social")), "external": _asks(q, EXTERNAL_WORDS),
    }
    wanted = F.array_compact(F.array(*[F.when(everything | test, F.lit(name)) for name, test in topics.items()], F.when(F.contains(q, F.lit("sentiment")), F.lit("sentiment"))))
    open_ended = everything | _asks(q, ["external", "footprint"])
    return questions.withColumns({"topics": wanted, "any_external": open_ended, "q": q})


def profile_facts(profiles: DataFrame, accounts: DataFrame, roles: DataFrame, locations: DataFrame, sites: DataFrame, observations: DataFrame, sources: DataFrame) -> DataFrame:
    """Long (org, topic, place, claim, value, classification, subtopic, source columns).

    ``accounts``: newest record per org. ``sites``: org, publishable, description, links
    array<struct<platform,url>>. ``sources``: org, module, source_url, retrieved_at,
    content_sha256.
    """
    fact = lambda place, label, v: F.struct(F.lit(place).alias("place"), F.lit(label).alias("claim"), v.cast("string").alias("value"))
    register = profiles.select("org", F.explode(F.array(
        fact(1, "Registered name", F.col("name")), fact(2, "Organisation number", F.col("org")), fact(3, "Legal form", F.col("legal_form")),
        fact(4, "Municipality", F.col("municipality")), fact(5, "Registry employee count", F.col("employees")),
    )).alias("f")).select("org", F.lit("registry").alias("topic"), F.lit("official_registry_fact").alias("classification"), "f.*")
    lines = [("Reporting period", "period"), ("Revenue", "revenue"), ("Operating result", "operating_result"), ("Annual result", "net_result"), ("Assets", "total_assets"), ("Debt", "total_liabilities")]
    have = set(accounts.columns)
    books = accounts.select("org", F.explode(F.array(*[fact(i, label, F.col(c)) for i, (label, c) in enumerate(lines, start=1) if c in have])).alias("f")).select(
        "org", F.lit("financials").alias("topic"), F.lit("official_annual_account").alias("classification"), "f.*"
    )
    people_place = F.row_number().over(W.partitionBy("org").orderBy("pos"))
    people = roles.filter(~F.col("inactive")).withColumn("place", people_place).select(
        "org", F.lit("roles").alias("topic"), F.lit("official_role_record").alias("classification"), "place",
        F.coalesce("role", "group_name", F.lit("Registered role")).alias("claim"), F.coalesce("name", "holder_org").alias("value"),
    )
    unit_place = F.row_number().over(W.partitionBy("org").orderBy("subunit_org"))
    units = locations.withColumn("place", unit_place).select(
        "org", F.lit("locations").alias("topic"), F.lit("official_subunit_record").alias("classification"), "place", F.lit("Registered subunit").alias("claim"), F.col("name").alias("value")
    )
    open_sites = sites.filter("publishable")
    text = open_sites.select("org", F.lit("website").alias("topic"), F.lit("company_reported_claim").alias("classification"), F.lit(1).alias("place"), F.lit("Website description").alias("claim"), F.col("description").alias("value"))
    links = open_sites.select("org", F.explode("links").alias("k")).select(
        "org", F.lit("website").alias("topic"), F.lit("company_linked_social_profile").alias("classification"), F.lit(2).alias("place"),
        F.concat(F.lit("Declared "), "k.platform", F.lit(" profile")).alias("claim"), F.col("k.url").alias("value"),
    )
    official = register.unionByName(books).unionByName(people).unionByName(units).unionByName(text).unionByName(links).filter(F.col("value").isNotNull() & (F.col("value") != ""))
    module = F.col("topic")
    cited = official.join(sources.withColumnRenamed("module", "topic"), ["org", "topic"], "left").withColumn("subtopic", module)
    signal, platform = F.col("signal_type"), F.col("platform")
    label = (
        F.when(signal == "review", "Verified individual review").when(signal.isin("review_summary", "place_summary"), "Verified review summary")
        .when(signal == "workforce_snapshot", "Sourced workforce evidence").when(signal.isin("profile_metrics", "buzz_metrics"), "Sourced public metrics")
        .when(platform == "company_site", "Dated company news").when(F.contains(signal, F.lit("job")), "Verified job evidence")
        .when(signal == "profile_handle", "Verified social profile").otherwise("Verified external evidence")
    )
    sub = (
        F.when(platform.isin("company_site", "news") & signal.isin("public_post", "public_mention"), "news").when(signal == "profile_handle", "social")
        .when(F.contains(signal, F.lit("job")), "job").when(signal.isin("review", "review_summary", "place_summary"), "review").when(signal == "workforce_snapshot", "workforce")
        .when(signal.isin("profile_metrics", "buzz_metrics"), "buzz").otherwise("other")
    )
    allowed = (
        F.col("exact_entity") & (F.col("rights_status") == "approved") & (F.length("content_sha256") == 64) & (F.coalesce(F.size("identity_proof"), F.lit(0)) > 0)
        & F.col("source_url").isNotNull() & F.col("retrieved_at").isNotNull()
    )
    outside = observations.filter(_true(allowed)).select(
        "org", F.lit("external").alias("topic"), F.lit("verified_external_observation").alias("classification"), F.lit(1).alias("place"), label.alias("claim"),
        F.col("source_url").alias("value"), "source_url", F.col("retrieved_at").cast("string").alias("retrieved_at"), "content_sha256", sub.alias("subtopic"),
    )
    return cited.withColumn("retrieved_at", F.col("retrieved_at").cast("string")).unionByName(outside)


def answer_questions(questions: DataFrame, facts: DataFrame) -> DataFrame:
    """Cited facts per question, joined on the entity and kept by topic."""
    asked = question_topics(questions)
    q = F.col("q")
    wanted = (
        F.col("any_external")
        | ((F.col("subtopic") == "news") & F.contains(q, F.lit("news"))) | ((F.col("subtopic") == "social") & F.contains(q, F.lit("social")))
        | ((F.col("subtopic") == "job") & _asks(q, ["job", "hiring"])) | ((F.col("subtopic") == "review") & _asks(q, ["review", "rating"]))
        | ((F.col("subtopic") == "workforce") & F.contains(q, F.lit("workforce"))) | ((F.col("subtopic") == "buzz") & _asks(q, ["buzz", "engagement"]))
    )
    j = asked.join(facts, "org").filter(F.array_contains("topics", F.col("topic")) & ((F.col("topic") != "external") | wanted))
    return j.select("qid", "org", "topic", "place", "claim", "value", "classification", "source_url", "retrieved_at", "content_sha256")


def unsupported_answers(questions: DataFrame, answers: DataFrame, sites: DataFrame) -> DataFrame:
    """What a question asked for and the sources do not support, one row per topic."""
    asked = question_topics(questions).select("qid", "org", F.explode("topics").alias("topic")).filter("topic <> 'registry'")
    met = answers.select("qid", "topic").distinct()
    held = sites.select("org", (~F.col("publishable")).alias("held"))
    sited = asked.join(held, "org", "left")
    site_gap = F.when(F.col("held").isNull(), GAPS["website"]).when(F.col("held"), GAPS["quarantined"])
    empty = sited.join(met, ["qid", "topic"], "left_anti")
    text = F.coalesce(*[F.when(F.col("topic") == t, F.lit(GAPS[t])) for t in ("financials", "roles", "locations", "external", "sentiment")])
    open_gaps = empty.filter("topic <> 'website'").select("qid", "org", "topic", text.alias("note"))
    site_gaps = sited.filter("topic = 'website'").select("qid", "org", "topic", site_gap.alias("note")).filter(F.col("note").isNotNull())
    return open_gaps.unionByName(site_gaps)


def evaluate_answers(specs: DataFrame, answers: DataFrame, unsupported: DataFrame) -> DataFrame:
    """Per question: enough cited external facts, or a proper abstention.

    ``specs``: qid, minimum_facts, required_claims, must_abstain.
    """
    outside = answers.filter("classification = 'verified_external_observation'")
    cited = F.col("source_url").isNotNull() & F.col("retrieved_at").isNotNull() & (F.length("content_sha256") == 64)
    found = outside.groupBy("qid").agg(F.count(F.lit(1)).alias("facts"), F.bool_and(cited).alias("cited"), F.collect_set("claim").alias("claims"))
    noted = unsupported.groupBy("qid").agg(F.count(F.lit(1)).alias("notes"))
    j = specs.join(found, "qid", "left").join(noted, "qid", "left").fillna(0, ["facts", "notes"])
    covered = F.size(F.array_except(F.coalesce("required_claims", F.array().cast("array<string>")), F.coalesce("claims", F.array().cast("array<string>")))) == 0
    answered = F.coalesce("cited", F.lit(False)) & (F.col("facts") >= F.greatest(F.lit(1), F.coalesce("minimum_facts", F.lit(1)))) & covered
    passed = F.when(F.col("must_abstain"), (F.col("facts") == 0) & (F.col("notes") > 0)).otherwise(answered)
    return j.select("qid", "facts", passed.alias("passed"))


# ---- cards ----


def company_cards(profiles: DataFrame, observations: DataFrame, roles: DataFrame, sites: DataFrame, posts: int, people: int) -> DataFrame:
    """One bounded card per entity: header, newest posts and jobs, first roles, site view.

    Lists are cut by a rank filter before they are gathered, so a card never grows with
    its entity.
    """
    usable = observations.filter(_true(F.col("exact_entity") & (F.col("rights_status") == "approved")))
    newest = W.partitionBy("org", "signal_type").orderBy(F.col("retrieved_at").desc(), "id")
    shown = usable.filter(F.col("signal_type").isin("public_post", "job_posting")).withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= posts)
    lists = shown.groupBy("org").agg(
        F.array_sort(F.collect_list(F.when(F.col("signal_type") == "public_post", F.struct("place", "id", "source_url")))).alias("posts"),
        F.array_sort(F.collect_list(F.when(F.col("signal_type") == "job_posting", F.struct("place", "id", "source_url")))).alias("jobs"),
    )
    totals = usable.groupBy("org").agg(F.count(F.lit(1)).alias("observations"), F.count_distinct("platform").alias("platforms"), F.max("retrieved_at").alias("latest_retrieval"))
    listed = roles.withColumn("place", F.row_number().over(W.partitionBy("org").orderBy("pos"))).filter(F.col("place") <= people)
    heads = listed.groupBy("org").agg(F.array_sort(F.collect_list(F.struct("place", "name", "role_code"))).alias("roles"))
    held = _true(~F.col("publishable"))
    view = sites.select(
        "org", F.when(held, "Registry-linked site: identity not verified").otherwise(F.coalesce(F.nullif("title", F.lit("")), F.lit("Company site fetched"))).alias("site_title"),
        held.alias("site_quarantined"),
    )
    adverse = F.coalesce("bankrupt", F.lit(False)) | F.coalesce("liquidating", F.lit(False))
    return (
        profiles.withColumn("adverse", adverse).join(totals, "org", "left").join(lists, "org", "left").join(heads, "org", "left").join(view, "org", "left")
        .fillna(0, ["observations", "platforms"])
    )
