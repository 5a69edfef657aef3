"""Entity resolution as equi-joins: names, phrases, domains, leads and places.

No join condition holds a Python function or a non-equality alone. Where the
question is "contains", the searched side is exploded into the exact
keys that can match, so Spark plans hash or sort-merge joins and AQE can split a
hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta import lexicon as lx
from attesta.functions.ids import stable_id
from attesta.functions.text import (
    digits, fuzzy_ratio, has_phrase, let, lit_strings, long_words, name_tokens, normalize_employer, number_in_text, owner_tokens, text_tokens, word_line, words,
)
from attesta.functions.urls import candidate_key, host, host_listed, is_directory_host, is_listing_host, normalize_homepage, normalize_site
from attesta.session import fixed, spread, stored


def _true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def _subset(inner: Column, outer: Column) -> Column:
    return (F.size(inner) > 0) & (F.size(F.array_except(inner, outer)) == 0)


# ---- employer names ----


def index_names(profiles: DataFrame, subunits: DataFrame) -> DataFrame:
    """Distinct (name_key, org) of parents and their subunits, keys of three letters or more."""
    names = spread(profiles.select("org", "name").unionAll(subunits.select(F.col("parent_org").alias("org"), "name")), "org", "name")
    return names.select(normalize_employer(F.col("name")).alias("name_key"), "org").filter(F.length("name_key") >= 3).distinct()


NAME_PARTS = r"\s*,\s*|\s+[\-–—]\s+"


def match_employer_names(feed: DataFrame, index: DataFrame) -> DataFrame:
    """(ad, business_name) → distinct (ad, org): equal name, equal part, or a name the ad's name starts with.

    Every word prefix of the ad's name is a key, which turns the scan over all
    names into one equi-join. A few bytes of a table are many ads, an ad has many
    keys and a key many orgs, so each step's rows are dealt by number: Spark would
    size its tasks by the bytes before the step.
    """
    prefixes = lambda pieces: F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, F.lit(1), i), " "))
    parts = F.transform(F.split("business_name", NAME_PARTS), normalize_employer)
    keys = lambda whole: F.when(F.length(whole) > 0, F.array_distinct(F.concat(let(F.split(whole, " "), prefixes), parts))).otherwise(F.array().cast("array<string>"))
    ads = spread(feed.select("ad", "business_name"), "ad")
    exploded = ads.select("ad", F.explode(let(normalize_employer(F.col("business_name")), keys)).alias("name_key")).filter(F.length("name_key") >= 3)
    return spread(spread(exploded, "name_key").join(index, "name_key").select("ad", "org"), "ad", "org").distinct()


def verify_employer(ads: DataFrame, candidates: DataFrame, subunits: DataFrame, as_of: str) -> DataFrame:
    """Name-matched (ad, org) pairs with the employer number that settles them.

    ``ads`` is (ad, status, employer_org, expires, title …). The outcome of every pair
    is kept: published by direct number, by subunit, rejected, inactive or expired.
    """
    parents = subunits.select(F.col("subunit_org").alias("employer_org"), "parent_org").distinct()
    number = digits(F.col("employer_org"))
    clean = ads.withColumn("employer_org", F.when(F.length(number) == 9, number))
    joined = candidates.join(clean, "ad").join(parents, "employer_org", "left")
    method = F.when(F.col("employer_org") == F.col("org"), "exact_employer_number").when(
        F.col("parent_org") == F.col("org"), "brreg_subunit_parent_mapping"
    )
    expired = _true(F.col("expires").cast("date") < F.lit(as_of).cast("date"))
    outcome = (
        F.when(~_true(F.upper("status") == "ACTIVE"), "inactive")
        .when(method.isNull(), "identity_rejected")
        .when(expired, "expired")
        .otherwise("published")
    )
    return joined.withColumns({"identity_method": method, "outcome": outcome}).drop("parent_org")


def job_observations(verified: DataFrame, detail_url: Column) -> DataFrame:
    """Published pairs as job observations with the employer proof."""
    published = verified.filter("outcome = 'published'")
    direct = F.col("identity_method") == "exact_employer_number"
    proof = F.array(
        F.create_map(
            F.lit("type"), F.lit("nav_employer_organisation_number"), F.lit("employer_organisation_number"), F.col("employer_org"),
            F.lit("parent_organisation_number"), F.when(~direct, F.col("org")), F.lit("method"), F.col("identity_method"),
        )
    )
    metrics = F.to_json(
        F.struct(
            F.col("title").alias("job_title"), F.lit("ACTIVE").alias("status"), F.col("published").cast("string").alias("published"),
            F.col("expires").cast("string").alias("expires"),
        )
    )
    return published.select(
        F.concat(F.lit("nav-job-"), F.col("ad").cast("string")).alias("id"), "org", F.lit("job_board").alias("platform"),
        F.lit("job_posting").alias("signal_type"), detail_url.alias("source_url"), F.lit(True).alias("exact_entity"),
        proof.alias("identity_proof"), F.lit("official_api").alias("acquisition_mode"), F.lit("approved").alias("rights_status"),
        F.lit("official_nav_job_feed").alias("source_class"), metrics.alias("metrics"),
    )


# ---- website leads ----


def website_candidates(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Ordered lead sources (origin, (org, url[, pos])) → one row per lead, the first source wins.

    The first source per (org, lead) is an aggregate over all sources at once.
    """
    merged = None
    for turn, (origin, leads) in enumerate(sources):
        pos = F.col("pos") if "pos" in leads.columns else F.lit(0)
        part = leads.select("org", F.lit(turn).alias("turn"), F.lit(origin).alias("source"), pos.cast("long").alias("pos"), normalize_homepage(F.col("url")).alias("url"))
        merged = part if merged is None else merged.unionAll(part)
    keyed = merged.filter(F.col("url").isNotNull()).withColumn("lead", candidate_key(F.col("url")))
    order = F.struct("turn", "pos", "url")
    return keyed.groupBy("org", "lead").agg(F.min_by(F.struct("url", "source"), order).alias("x"), F.min(order).alias("priority")).select(
        "org", "lead", "x.url", "x.source", "priority"
    )


def mail_and_site_leads(subunits: DataFrame) -> DataFrame:
    """Sites and own mail domains of subunits as leads for the parent."""
    from attesta.functions.urls import mail_host

    mail = mail_host(F.col("email"))
    own = F.when((mail != "") & ~mail.isin(lx.SHARED_MAIL_HOSTS) & mail.rlike(r"^[a-z0-9.-]+\.[a-z]{2,}$"), F.concat(F.lit("https://"), mail, F.lit("/")))
    site = normalize_homepage(F.col("website"))
    rows = subunits.select(F.col("parent_org").alias("org"), F.explode(F.array(
        F.struct(site.alias("url"), F.lit("official_subunit_website").alias("source")),
        F.struct(own.alias("url"), F.lit("official_subunit_email").alias("source")),
    )).alias("x")).select("org", "x.url", "x.source")
    return rows.filter(F.col("url").isNotNull()).distinct()


def site_leads(profiles: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """First-generation leads: register site, its .no/.com twin, seed, mail domain and its twin."""
    from attesta.functions.urls import mail_host

    def twin(site: Column) -> Column:
        return F.when(site.endswith(".com"), F.regexp_replace(site, r"\.com$", ".no")).when(site.endswith(".no"), F.regexp_replace(site, r"\.no$", ".com"))

    site = normalize_site(F.col("website"))
    mail = mail_host(F.col("email"))
    own = F.when((mail != "") & ~mail.isin(lx.FREE_MAIL_HOSTS) & F.contains(mail, F.lit(".")), normalize_site(mail))
    rows = profiles if seeds is None else profiles.join(seeds.select("org", F.col("url").alias("seed")), "org", "left")
    seed = F.lit(None).cast("string") if seeds is None else normalize_site(F.col("seed"))
    offers = [(site, "registry"), (twin(site), "registry_cctld_fallback"), (seed, "universe_snapshot"), (own, "registry_email"), (twin(own), "registry_cctld_fallback")]
    listed = rows.select("org", F.posexplode(F.array(*[F.struct(u.alias("url"), F.lit(o).alias("origin")) for u, o in offers])).alias("turn", "x"))
    good = listed.select("org", "turn", "x.url", "x.origin", host(F.col("x.url")).alias("host")).filter(F.col("url").isNotNull() & ~is_directory_host(F.col("host")))
    first = good.groupBy("org", "host").agg(F.min_by(F.struct("url", "origin"), "turn").alias("x"), F.min("turn").alias("turn"))
    place = F.row_number().over(W.partitionBy("org").orderBy("turn"))
    return first.select("org", "host", "x.url", "x.origin", place.alias("rank"))


def relevant_host(name: Column, name_of_host: Column) -> Column:
    """Whether a searched host shares a name word, or its first three letters, with the entity."""
    slug = F.substring_index(name_of_host, ".", 1)

    def near(t: Column) -> Column:
        three = (F.length(t) >= 3) & (F.length(slug) >= 3)
        return F.contains(slug, t) | F.contains(t, slug) | (three & (F.substring(t, 1, 3) == F.substring(slug, 1, 3)))

    return F.exists(name_tokens(name), near)


def exclude_directory_hosts(urls: DataFrame, blocked: DataFrame | None = None, column: str = "url") -> DataFrame:
    """Rows whose host is neither a listed directory nor below one.

    The fixed list is an array test. A block list of any size comes as a table of
    hosts: distinct page hosts are exploded into their suffixes and equi-joined.
    """
    kept = urls.withColumn("_host", host(F.col(column)))
    if blocked is None:
        return kept.filter(~is_directory_host(F.col("_host"))).drop("_host")
    from attesta.functions.urls import host_suffixes

    hosts = kept.select("_host").distinct()
    hit = hosts.select("_host", F.explode(host_suffixes(F.col("_host"))).alias("host")).join(blocked.select("host").distinct(), "host").select("_host").distinct()
    return kept.join(hit, "_host", "left_anti").drop("_host")


# ---- search results ----


def relevant_search_results(results: DataFrame, profiles: DataFrame) -> DataFrame:
    """(org, url, title, snippet) with ``relevant``: worth fetching, which is not yet proof.

    ``profiles`` may carry ``operating_names``, an array of official trading names.
    """
    names = F.col("operating_names") if "operating_names" in profiles.columns else F.array().cast("array<string>")
    side = profiles.select("org", F.col("name").alias("_name"), F.col("municipality").alias("_town"), F.coalesce(names, F.array().cast("array<string>")).alias("_aliases"))
    j = results.join(side, "org")
    core = F.array_distinct(owner_tokens(F.col("_name")))
    title, site = owner_tokens(F.col("title")), owner_tokens(host(F.col("url")))
    context = F.concat(title, owner_tokens(F.col("snippet")))
    proof = F.concat(context, site)
    number = digits(F.col("org"))
    j = j.withColumns({
        "_core": core, "_strong": F.concat(title, site), "_proof": proof, "_overlap": F.array_intersect(core, proof),
        "_org": (number != "") & F.exists(F.array("url", "title", "snippet"), lambda t: F.contains(digits(t), number)),
        "_place": _subset(owner_tokens(F.col("_town")), context),
        "_blocked": is_listing_host(host(F.col("url"))) | host_listed(host(F.col("url")), lx.SEARCH_BLOCKED_HOSTS),
    })
    share = F.size("_overlap") / F.size("_core")
    telling = F.filter("_core", lambda t: F.length(t) >= 5)
    hit = F.arrays_overlap(telling, F.col("_strong"))
    alias = F.exists("_aliases", lambda a: _subset(owner_tokens(a), F.col("_proof")))
    relevant = (F.size("_core") > 0) & ~F.col("_blocked") & (
        (F.col("_org") & (F.size("_overlap") > 0))
        | alias
        | _subset(F.col("_core"), F.col("_proof"))
        | ((F.size(telling) > 0) & ((hit & ((F.size("_core") == 1) | (share >= 0.34))) | (F.col("_place") & (share >= 0.34))))
    )
    drop = [c for c in j.columns if c.startswith("_")]
    return j.withColumn("relevant", _true(relevant)).drop(*drop)


def score_search_candidates(results: DataFrame, profiles: DataFrame) -> DataFrame:
    """Additive score of every search result: register number, name, host, town."""
    side = profiles.select("org", F.col("name").alias("_name"), F.col("municipality").alias("_town"))
    j = results.join(side, "org")
    name = F.filter(long_words(F.col("_name")), lambda t: ~t.isin(lx.SEARCH_GENERIC_NAMES))
    title, snippet = long_words(F.col("title")), long_words(F.col("snippet"))
    home = normalize_homepage(F.col("url"))
    site = host(home)
    compact = F.array_join(long_words(site), "")
    j = j.withColumns({
        "_home": home, "host": site, "_blocked": host_listed(site, lx.SEARCH_BLOCKED_HOSTS),
        "_org": F.contains(digits(F.concat_ws(" ", "title", "snippet")), digits(F.col("org"))) & (digits(F.col("org")) != ""),
        "_title": _subset(name, title), "_any": _subset(name, F.concat(title, snippet, long_words(site))),
        "_host": (F.size(name) > 0) & F.contains(compact, F.array_join(name, "")), "_place": _subset(long_words(F.col("_town")), snippet),
    })
    points = (
        F.when(F.col("_org"), 0.75).otherwise(0.0)
        + F.when(F.col("_title"), 0.45).when(F.col("_any"), 0.25).otherwise(0.0)
        + F.when(F.col("_host"), 0.30).otherwise(0.0) + F.when(F.col("_place"), 0.10).otherwise(0.0)
    )
    usable = F.col("_home").isNotNull() & ~F.col("_blocked")
    score = F.when(usable, F.round(F.least(F.lit(1.0), points), 4)).otherwise(0.0)
    j = j.withColumns({"score": score, "_usable": usable})
    accepted = F.col("_usable") & (F.col("score") >= 0.75) & F.col("_host") & (F.col("_org") | F.col("_title"))
    status = F.when(accepted, "accepted_for_crawl").when(F.col("_usable") & (F.col("score") >= 0.6), "review").otherwise("rejected")
    j = j.withColumns({"publishable_candidate": _true(accepted), "status": status})
    return j.drop(*[c for c in j.columns if c.startswith("_")])


def choose_search_candidate(scored: DataFrame) -> DataFrame:
    """Per entity the best accepted result, or an abstention."""
    order = F.struct((-F.col("score")).alias("s"), F.coalesce(F.nullif("rank", F.lit(0)), F.lit(10_000)).alias("r"), "url")
    good = F.col("publishable_candidate")
    return scored.groupBy("org").agg(
        F.min_by(F.when(good, F.col("url")), F.when(good, order)).alias("selected"), F.count(F.lit(1)).alias("candidates"),
        F.count_if(good).alias("accepted"),
    ).withColumn("abstained", F.col("accepted") == 0)


# ---- names in text ----

# Headline grammar around a company name.
TITLE_SUFFIXES = ["as", "asa", "sa", "ba", "da", "ans", "enk", "nuf", "sti", "iks", "kf", "sf"]
CORPORATE_WORDS = [
    "as", "asa", "da", "ans", "aksje", "aksjer", "børs", "regnskap", "resultat",
    "cfo", "ceo", "styreleder", "direktør", "oppbud", "konkurs", "omsetning",
    "driftsresultat", "kvartal", "underskudd", "overskudd", "emisjon", "fusjon", "oppkjøp",
]
ALLOWED_BEFORE = ["av", "for", "fra", "hos", "i", "med", "om", "på", "til", "og", "kjøper", "velger", "ved"]


def _title_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9æøå]+)"), F.lit(1))


def _telling(text: Column) -> Column:
    return F.filter(_title_words(text), lambda w: ~w.isin(TITLE_SUFFIXES))


def news_title_match(profiles: DataFrame, items: DataFrame) -> DataFrame:
    """(item, org) where the headline carries the company name at its start or after a preposition.

    A headline is short, so every run of its words that begins at an allowed place is
    a key: one equi-join replaces comparing each headline with each name.
    """
    headline = F.regexp_replace("title", r" - (?:(?! - ).)*$", "")
    sized = items.select("item", _title_words(headline).alias("raw"), _telling(headline).alias("w")).filter(F.size("w") > 0)
    before = F.try_element_at(F.col("w"), F.greatest(F.lit(1), F.col("i") - 1))
    starts = sized.select("item", "raw", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i")).filter(
        F.when(F.col("i") == 1, True).otherwise(_true(before.isin(ALLOWED_BEFORE)))
    )
    runs = starts.select("item", "raw", "i", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("i") + 1)).alias("n")).select(
        "item", "raw", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("key")
    )
    context = F.arrays_overlap("raw", lit_strings(sorted(set(TITLE_SUFFIXES + CORPORATE_WORDS))))
    names = profiles.select("org", F.array_join(_telling(F.col("name")), " ").alias("key"), (F.size(_telling(F.col("name"))) == 1).alias("single")).filter("key <> ''")
    return runs.withColumn("context", context).join(names, "key").filter(~F.col("single") | F.col("context")).select("item", "org").distinct()


def title_names_company(name: Column, title: Column) -> Column:
    """The same test for one given pair."""
    headline = F.regexp_replace(title, r" - (?:(?! - ).)*$", "")
    w, raw, core = _telling(headline), _title_words(headline), _telling(name)
    k = F.size(core)
    at = F.exists(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w))),
        lambda i: (F.slice(w, i, F.greatest(F.lit(1), k)) == core)
        & ((i == 1) | F.array_contains(lit_strings(ALLOWED_BEFORE), F.try_element_at(w, F.greatest(F.lit(1), i - 1)))),
    )
    single_ok = (k > 1) | F.arrays_overlap(raw, lit_strings(sorted(set(TITLE_SUFFIXES + CORPORATE_WORDS))))
    return _true((k > 0) & (k <= F.size(w)) & single_ok & at)


def news_proximity(profiles: DataFrame, articles: DataFrame) -> DataFrame:
    """(item, org, status, score): register number, all name words close together, or one telling word.

    Name words are distinct and noise-free on both sides, so each has one position
    in an article. Every name is joined through its rarest word only, which any full
    match must contain; the other words of such a pair are then looked up by (item,
    word). Common words never multiply pairs, no token list travels with a pair, and
    nothing is dropped.
    """
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))
    bodies = spread(articles, "item").select("item", text_tokens(text).alias("w"), digits(text).alias("d"))
    # Folding the texts once and storing their words is cheaper.
    bodies = stored(bodies, "article-words")
    core = profiles.select("org", name_tokens(F.col("name")).alias("core"))
    wanted = stored(core.select("org", F.size("core").alias("k"), F.explode("core").alias("token")), "name-words")
    # Three joins read the words with their places in the article; those that no name has can meet none.
    tokens = stored(bodies.select("item", F.posexplode("w").alias("place", "token")).join(wanted.select("token").distinct(), "token", "left_semi"), "shared-words")
    # Words are short and well packed, so the planner could take them for small: the joins are merge joins.
    tokens = tokens.hint("merge")
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("seen"))
    anchors = wanted.join(frequency, "token").groupBy("org").agg(F.min_by("token", F.struct("seen", "token")).alias("token"))
    pairs = tokens.select("item", "token").join(anchors, "token").select("item", "org")
    met = pairs.join(wanted, "org").join(tokens, ["item", "token"]).groupBy("item", "org", "k").agg(
        F.count(F.lit(1)).alias("n"), (F.max("place") - F.min("place") + 1).alias("span"), F.min("token").alias("one")
    )
    full = F.col("n") == F.col("k")
    close = F.col("span") <= F.greatest(F.lit(14), F.col("k") + 4)
    by_name = met.select(
        "item", "org",
        F.when(full & close & (F.col("k") >= 2), 0.95).when(full & (F.col("k") == 1) & (F.length("one") >= 5), 0.80).otherwise(0.30).alias("score"),
    ).filter("score > 0.3")
    windows = F.transform(F.sequence(F.lit(1), F.length("d") - 8), lambda i: F.substr(F.col("d"), i, F.lit(9)))
    numbers = bodies.filter(F.length("d") >= 9).select("item", F.explode(F.array_distinct(windows)).alias("org"))
    by_number = numbers.join(profiles.select("org").distinct(), "org").select("item", "org", F.lit(1.0).alias("score"))
    best = by_name.unionByName(by_number).groupBy("item", "org").agg(F.max("score").alias("score"))
    status = F.when(F.col("score") >= lx.PUBLISH_THRESHOLD, "exact").when(F.col("score") >= lx.REVIEW_THRESHOLD, "review").otherwise("related_or_uncertain")
    return best.withColumn("status", status)


# ---- places ----

# Words that carry no name in a place title, and titles too general to trust.
PLACE_STOP = ["as", "asa", "sa", "enk", "nuf", "da", "ans", "ba", "stiftelsen", "sameiet", "avd", "avdeling"]
GENERIC_PLACE_WORDS = ["holding", "eiendom", "invest", "bolig", "service", "drift", "gruppen", "group"]


def place_phone(raw: Column) -> Column:
    number = digits(raw)
    local = F.when(number.startswith("47") & (F.length(number) > 8), F.substring(number, 3, 100)).otherwise(number)
    return F.right(local, F.lit(8))


# Of a name's words in a title; scores are rounded to four digits before they are compared with 0.66 and 0.99.
LEAST_SHARE, WHOLE_SHARE = 0.65995, 0.98995


def _telling_words(every: Column, noise: list[str] | None) -> Column:
    stop = PLACE_STOP + (noise or [])
    return F.array_distinct(F.filter(every, lambda w: ~w.isin(stop) & ((F.length(w) >= 3) | w.rlike("^[0-9]+$"))))


def _said(title: Column, address: Column, phone: Column, site: Column) -> Column:
    """What a place says, taken apart."""
    return F.struct(words(title).alias("title"), words(address).alias("address"), place_phone(phone).alias("phone"), _site_host(site).alias("site"))


def _site_host(site: Column) -> Column:
    return F.coalesce(host(F.when(F.contains(site, F.lit("://")), site).otherwise(F.concat(F.lit("https://"), site))), F.lit(""))


def candidate_places(profiles: DataFrame, places: DataFrame, trade_names: DataFrame | None = None, noise: list[str] | None = None) -> DataFrame:
    """``places`` that carry no entity, once for every entity that they could belong to.

    A place is accepted through a location, a phone number or a site, and but for a known trade name or a similar name on the
    entity's own site it holds two thirds of the name's words. So it is found by one of these keys, and no accepted place is missed:

    * spot (postcode, or the rarest street word where the entity has none) and a word, or phone number and a word, of a name held whole;
    * spot, phone number and two words of a name held by two thirds, as a part of a name needs two channels;
    * phone number and the whole title of a reviewed trade name;
    * site.

    Words weigh by how few places hold them: a name of k words is posted under its rarest ones only, as many as must include one, or
    two, of any two thirds, and one for the whole name. So a word that many titles hold is a key by itself only of names that have no
    rarer one. Keys are hashes; the pairs are dealt once, by entity, which is how ``assess_places`` and ``resolve_places`` need them,
    and carry what their place says (``_said``), so that ``assess_places`` does not take it apart again with each entity.
    """
    own = stored(spread(profiles, "org").select(
        "org", _telling_words(words(F.col("name")), noise).alias("target"), F.array_distinct(words(F.col("street"))).alias("street"), F.coalesce("postcode", F.lit("")).alias("code"),
        place_phone(F.col("phone")).alias("phone"), _site_host(F.col("site")).alias("site"),
    ), "place-owners")
    said = spread(places, "place_id").dropDuplicates(["place_id"]).withColumn("_said", _said(F.col("title"), F.col("address"), F.col("phone"), F.col("web_site")))
    theirs = fixed(said.select("place_id", "_said")).select(
        "place_id", F.array_sort(_telling_words(F.col("_said.title"), noise)).alias("title_words"), F.array_join("_said.title", " ").alias("title_key"),
        F.array_distinct("_said.address").alias("address_words"), F.col("_said.phone").alias("phone"), F.col("_said.site").alias("site"),
    )
    # A word of a name is looked for in titles, one of a spot in addresses.
    tagged = lambda names, spots: F.explode(F.concat(*[F.transform(c, lambda w: F.struct(F.lit(named).alias("named"), w.alias("word"))) for named, c in ((True, names), (False, spots))])).alias("x")  # noqa: E731, B023
    held = stored(theirs.select(tagged("title_words", "address_words")).groupBy("x.named", "x.word").agg(F.count(F.lit(1)).alias("n")), "place-words")
    spots = F.when(F.col("code") != "", F.array("code")).otherwise(F.col("street"))
    asked = own.withColumn("spots", spots).select("org", "target", "spots", "phone", tagged("target", "spots")).select("org", "target", "spots", "phone", "x.*").join(held, ["named", "word"])
    rarest = lambda test: F.array_sort(F.collect_set(F.when(test, F.struct("n", "word"))))
    ranked = asked.groupBy("org", "target", "spots", "phone").agg(rarest(F.col("named")).alias("names"), rarest(~F.col("named")).alias("where"))
    k = F.size("target")
    need = lambda share: F.ceil(k * share)
    # Words that no title holds are the rarest of all and no keys.
    rare = lambda share, least: F.slice("names", 1, F.greatest(F.lit(0), F.size("names") - need(share) + least).cast("int"))["word"]
    posted = ranked.select(
        "org", "phone", F.when((F.size("where") > 0) & (F.size("where") == F.size("spots")), F.get("where", F.lit(0))["word"]).alias("spot"), rare(WHOLE_SHARE, 1).alias("whole"),
        F.array_sort(F.when(need(LEAST_SHARE) > 1, rare(LEAST_SHARE, 2))).alias("part"),
    )
    key = lambda kind, *parts: F.xxhash64(F.lit(kind), *parts)
    nothing = F.array().cast("array<bigint>")
    every = lambda *keys: F.explode(F.array_distinct(F.concat(*[F.coalesce(c, nothing) for c in keys]))).alias("key")
    paired = lambda a: F.flatten(F.transform(a, lambda x, i: F.transform(F.slice(a, i + 2, F.size(a)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    dialled = F.length("phone") >= 5
    at = F.when(F.col("spot").isNotNull(), F.transform("whole", lambda w: key("at", "spot", w)))
    called = F.when(dialled, F.transform("whole", lambda w: key("phone", "phone", w)))
    both = F.when(dialled & F.col("spot").isNotNull(), F.transform(paired(F.col("part")), lambda p: key("both", "spot", "phone", p["a"], p["b"])))
    known = posted.select("org", every(at, called, both)).unionAll(own.filter("site <> ''").select("org", key("site", "site")))
    if trade_names is not None:
        traded = own.filter(dialled).select("org", "phone").join(trade_names.select("org", "title_key").filter("title_key IS NOT NULL"), "org")
        known = known.unionAll(traded.select("org", key("trade", "phone", "title_key")))
    parts = F.split("site", "[.]")
    parents = F.when(F.col("site") != "", F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: key("site", F.array_join(F.slice(parts, i, F.size(parts)), "."))))
    spoken = F.when(dialled, F.transform("title_words", lambda w: key("phone", "phone", w)))
    traded = F.when(dialled, F.array(key("trade", "phone", "title_key")))
    located = F.flatten(F.transform("address_words", lambda x: F.transform("title_words", lambda w: key("at", x, w))))
    near = F.when(dialled, F.flatten(F.transform("address_words", lambda x: F.transform(paired(F.col("title_words")), lambda p: key("both", x, "phone", p["a"], p["b"])))))
    met = theirs.select("place_id", every(located, near, spoken, traded, parents)).join(known, "key").select("place_id", "org")
    return spread(said.drop("org").join(met, "place_id"), "org").dropDuplicates(["org", "place_id"])


def assess_places(profiles: DataFrame, places: DataFrame, trade_names: DataFrame | None = None, noise: list[str] | None = None) -> DataFrame:
    """Every (entity, place) with its channels, score and whether it is accepted.

    ``profiles``: org, name, street, postcode, city, phone, site. ``places``: org,
    place_id, title, address, phone, web_site, review_count; ``candidate_places`` finds org where places have none.
    ``trade_names``: reviewed (org, title_key). A shared address or phone alone never accepts a place. The similarity of
    names is NULL where it decides nothing: without the entity's own site, or where the place is accepted anyway.
    """
    # What an entity says is taken apart once, not again with each of its places.
    side = spread(profiles, "org").select(
        "org", _telling_words(words(F.col("name")), noise).alias("_target"), words(F.col("street")).alias("_street"), F.coalesce("postcode", F.lit("")).alias("_code"),
        words(F.col("city")).alias("_city"), place_phone(F.col("phone")).alias("_phone"), _site_host(F.col("site")).alias("_own"),
    )
    if trade_names is not None:
        side = side.join(trade_names.groupBy("org").agg(F.collect_list("title_key").alias("_traded")), "org", "left")  # the reviewed titles of one entity
    said = _said(F.col("title"), F.col("address"), F.col("phone"), F.col("web_site"))
    theirs = places.dropDuplicates(["org", "place_id"])
    j = (theirs if "_said" in places.columns else fixed(theirs.withColumn("_said", said))).join(side, "org")
    j = j.withColumns({
        "_title": _telling_words(F.col("_said.title"), noise), "_address": F.col("_said.address"), "_theirs": F.col("_said.site"), "_title_key": F.array_join("_said.title", " "),
    })
    code, city = F.col("_code"), F.col("_city")
    share = F.when(F.size("_target") > 0, F.size(F.array_intersect("_target", "_title")) / F.size("_target")).otherwise(0.0)
    has_code = F.array_contains("_address", code)
    j = j.withColumns({
        "name_score": F.round(share, 4),
        "address_match": _true(_subset(F.col("_street"), F.col("_address")) & ((code == "") | has_code)),
        "postcode_city_match": _true((code != "") & has_code & ((F.size(city) == 0) | _subset(city, F.col("_address")))),
        "phone_match": _true((F.length("_phone") >= 5) & (F.col("_phone") == F.col("_said.phone"))),
        "website_match": (F.col("_own") != "") & (F.col("_theirs") != "") & ((F.col("_own") == F.col("_theirs")) | F.col("_theirs").endswith(F.concat(F.lit("."), "_own"))),
    })
    if trade_names is not None:
        # As a join with the reviewed titles gives: a title that is listed twice counts twice.
        times = F.size(F.filter(F.coalesce("_traded", F.array().cast("array<string>")), lambda t: t == F.col("_title_key")))
        j = j.withColumn("_times", times).select("*", F.explode(F.array_repeat(F.col("_times") > 0, F.greatest(F.lit(1), F.col("_times")))).alias("_known"))
    else:
        j = j.withColumn("_known", F.lit(False))
    located = F.col("address_match") | F.col("postcode_city_match")
    channels = located.cast("int") + F.col("phone_match").cast("int") + F.col("website_match").cast("int")
    trade = (F.col("name_score") == 0) & F.col("address_match") & F.col("phone_match") & _true(F.col("_known"))
    generic = (F.size("_target") == 1) & F.col("_target")[0].isin(GENERIC_PLACE_WORDS)
    weak = _true(generic) & ~(F.col("address_match") | F.col("phone_match") | F.col("website_match"))
    plain = ((F.col("name_score") >= 0.99) & (channels >= 1)) | ((F.col("name_score") >= 0.66) & (channels >= 2)) | trade
    j = j.withColumn("_open", F.col("website_match") & ~_true(plain))
    named = lambda c: F.when(F.col("_open"), F.array_join(c, " "))
    j = j.withColumn("fuzzy_name_score", F.round(fuzzy_ratio(named("_target"), named("_title")), 4))
    accepted = (plain | (F.col("website_match") & (F.col("fuzzy_name_score") >= 0.85))) & ~weak
    volume = F.least(F.lit(1.0), F.log10(F.greatest(F.lit(1), F.coalesce("review_count", F.lit(0)))) / 5)
    score = (
        F.col("name_score") * 4 + F.col("address_match").cast("int") * 3 + F.col("phone_match").cast("int") * 2
        + F.col("website_match").cast("int") * 3 + F.col("postcode_city_match").cast("int") * 2 + volume
    )
    done = j.withColumns({"accepted": _true(accepted), "score": F.round(score, 4), "trade_name_match": trade})
    return done.drop(*[c for c in done.columns if c.startswith("_")])


def resolve_places(assessed: DataFrame) -> DataFrame:
    """Per entity the one best accepted place; two equal best scores abstain."""
    scored = assessed.groupBy("org", F.when(F.col("accepted"), F.col("score")).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.min("place_id").alias("place_id"))
    best = scored.groupBy("org").agg(F.sum("n").alias("candidates"), F.max_by(F.struct("score", "n", "place_id"), "score").alias("x"))
    status = F.when(F.col("x").isNull(), "no_exact_match").when(F.col("x.n") > 1, "ambiguous_exact_match").otherwise("exact_match")
    only = lambda c: F.when(status == "exact_match", F.col(f"x.{c}")).alias(c)
    return best.select("org", "candidates", status.alias("status"), only("place_id"), only("score"))


def place_names_company(legal_name: Column, title: Column, address: Column, town: Column, registered: Column) -> Column:
    """The simple first-generation test: names agree and the place lies in the registered town or address."""
    from attesta.functions.text import fold

    def bare(text: Column) -> Column:
        return F.regexp_replace(text, r"(?<=\S)\s+(?:" + "|".join(lx.LEGAL_FORMS) + ")$", "")

    a, b = fold(legal_name), fold(title)
    a_tokens, b_tokens = name_tokens(legal_name), name_tokens(title)
    shared = F.size(F.array_intersect(a_tokens, b_tokens))
    names = (
        (bare(a) == bare(b)) | (a == b) | F.contains(bare(b), bare(a)) | F.contains(bare(a), bare(b))
        | ((F.size(a_tokens) > 0) & (shared >= F.least(F.size(a_tokens), F.lit(2))) & (shared / F.size(a_tokens) >= 0.5))
    )
    where = fold(address)
    near = F.contains(where, fold(town)) | F.exists(F.split(fold(registered), r"\s+"), lambda t: (F.length(t) >= 4) & F.contains(where, t))
    no_town = F.coalesce(F.trim(town), F.lit("")) == ""
    return _true((a != "") & (b != "") & names & (no_town | near))


# ---- profiles elsewhere ----


def plain_name(text: Column) -> Column:
    return F.array_join(_title_words(text), " ")


# Suffixes a company page may leave out.
PROFILE_SUFFIXES = ["as", "asa", "ba", "da", "enk", "nuf", "sa", "stiftelsen"]


def core_name(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.concat(F.lit(" "), plain_name(text)), "( (" + "|".join(PROFILE_SUFFIXES) + "))+$", ""))


def match_external_profiles(profiles: DataFrame, external: DataFrame) -> DataFrame:
    """(org, external_id) pairs that are the same entity, with the rules that say so.

    ``profiles``: org, name, domain, municipality, aliases, leaders. ``external``:
    external_id, name, domain, location, about, company_id_org. Every rule holds an
    equality of names, so two equi-joins find all pairs; the rest is checked per row.
    """
    p = profiles.select(
        "org", plain_name(F.col("name")).alias("full"), core_name(F.col("name")).alias("core"), F.lower("domain").alias("domain"),
        plain_name(F.col("municipality")).alias("town"), "aliases", "leaders",
    )
    e = external.select(
        "external_id", plain_name(F.col("name")).alias("e_full"), core_name(F.col("name")).alias("e_core"), F.lower("domain").alias("e_domain"),
        plain_name(F.col("location")).alias("e_place"), plain_name(F.col("about")).alias("e_about"), "company_id_org",
    )
    own = p.select("org", F.explode(F.array_distinct(F.array("full", "core"))).alias("key"), F.lit(False).alias("by_alias"))
    other = p.select("org", F.explode("aliases").alias("a")).select("org", F.explode(F.array_distinct(F.array(plain_name(F.col("a")), core_name(F.col("a"))))).alias("key"), F.lit(True).alias("by_alias"))
    keys = own.unionAll(other).filter("key <> ''").distinct()
    e_keys = e.select("external_id", F.explode(F.array_distinct(F.array("e_full", "e_core"))).alias("key")).filter("key <> ''")
    found = keys.join(e_keys, "key").groupBy("org", "external_id").agg(F.bool_or("by_alias").alias("alias_match"))
    j = found.join(p, "org").join(e, "external_id")
    full = (F.col("full") == F.col("e_full")) & (F.col("full") != "")
    core = (F.col("core") == F.col("e_core")) & (F.col("core") != "")
    domain = _true((F.col("domain") == F.col("e_domain")) & (F.col("domain") != ""))
    place = (F.col("town") != "") & F.contains("e_place", F.col("town"))
    led = F.coalesce(F.exists("leaders", lambda n: F.contains(F.col("e_about"), plain_name(n))), F.lit(False))
    rules = {
        "core_name_and_domain": core & domain, "alias_and_domain": F.col("alias_match") & domain, "full_name_and_town": full & place,
        "full_name_and_company_id": full & _true(F.col("company_id_org") == F.col("org")), "alias_town_and_leader": F.col("alias_match") & place & led,
    }
    proof = F.array_compact(F.array(*[F.when(_true(test), F.lit(name)) for name, test in rules.items()]))
    return j.select("org", "external_id", proof.alias("proof")).filter(F.size("proof") > 0)


def company_page(url: Column) -> Column:
    """``https://linkedin.com/company/<slug>`` of any address of that company page, else NULL."""
    name = F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[a-zA-Z]+://([^/?#:]*)", 1))
    on_site = (name == "linkedin.com") | name.endswith(".linkedin.com")
    slug = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*/+(?i:company)/+([^/?#]+)", 1))
    return F.when(on_site & (slug != ""), F.concat(F.lit("https://linkedin.com/company/"), slug))


def match_job_cards(cards: DataFrame, profile_urls: DataFrame) -> DataFrame:
    """Job cards whose company link is exactly a known company page; the job number from urn or address."""
    number = F.coalesce(
        F.nullif(F.regexp_extract("urn", r"(\d{6,})", 1), F.lit("")), F.nullif(F.regexp_extract("job_url", r"-(\d{6,})(?:[/?]|$)", 1), F.lit(""))
    )
    keyed = cards.withColumns({"page": company_page(F.col("company_url")), "job_id": number}).filter(F.col("page").isNotNull() & F.col("job_id").isNotNull())
    known = profile_urls.select("org", company_page(F.col("profile_url")).alias("page")).distinct()
    return keyed.join(known, "page").select(
        "org", "job_id", "title", F.col("page").alias("company_page"), F.concat(F.lit("https://www.linkedin.com/jobs/view/"), "job_id").alias("job_view_url")
    ).distinct()


# ---- outcomes ----


def explain_misses(manifest: DataFrame, ours: DataFrame, other: DataFrame) -> DataFrame:
    """Why each entity has no verified website.

    ``manifest``: org, name, website. ``ours``: org, disposition, website_state,
    resolved_hosts. ``other``: org, website_state of another run.
    """
    j = manifest.join(ours.withColumn("_ours", F.lit(True)), "org", "left").join(other.select("org", F.col("website_state").alias("other_state")), "org", "left")
    listed = F.length(F.trim(F.coalesce("website", F.lit("")))) > 0
    resolved = F.coalesce("resolved_hosts", F.lit(0)) > 0
    club = F.upper("name").rlike(r"B\.I\.L|BEDRIFTSIDRETTSLAG")
    cluster = (
        F.when(F.col("_ours").isNull(), "system_error")
        .when(F.col("disposition") == "failed", "fatal_execution_error")
        .when(F.col("website_state") == "available", None)
        .when(_true(club), "workplace_sports_club_quarantined")
        .when(~listed & ~resolved, "shell_holding_no_dns")
        .when(~listed, "identity_gate_rejected_unregistered")
        .when(~resolved, "dead_registry_domain")
        .otherwise("identity_gate_rejected_registered")
    )
    return j.select("org", cluster.alias("cluster"), "website_state", "other_state").filter(F.col("cluster").isNotNull())


def merge_channels(sources: list[tuple[str, DataFrame]], exact_sources: list[str]) -> DataFrame:
    """One address per (org, platform): the first source that has it wins.

    The entity's class and confidence depend on whether any exact open-data source
    took part.
    """
    merged = None
    for turn, (name, frame) in enumerate(sources):
        part = frame.select("org", "platform", "url", F.lit(turn).alias("turn"), F.lit(name).alias("source"))
        merged = part if merged is None else merged.unionAll(part)
    chosen = merged.filter(F.col("url").isNotNull()).groupBy("org", "platform").agg(
        F.min_by(F.struct("url", "source"), F.struct("turn", "url")).alias("x")
    )
    picked = chosen.select("org", "platform", "x.url", "x.source")
    exact = picked.groupBy("org").agg(F.bool_or(F.col("source").isin(exact_sources)).alias("exact"))
    return picked.join(exact, "org").select(
        "org", "platform", "url", "source", F.when(F.col("exact"), "open_data").otherwise("external_directory").alias("source_class"),
        F.when(F.col("exact"), 0.90).otherwise(0.75).alias("confidence"),
    )


def select_verified_site(candidates: DataFrame, verdicts: DataFrame, capture: tuple[str, ...] = ()) -> DataFrame:
    """Attempts per entity up to and including the first candidate that passes.

    ``candidates``: org, url, source, priority (an orderable column). ``verdicts``: org,
    url, status, publishable, score. A deep link that was not found retries its root,
    if the root was captured, right after it. Where an address was captured several times,
    both sides carry the ``capture`` columns, so that each candidate meets its own verdict.
    """
    joined = candidates.join(verdicts, ["org", "url", *capture], "left").drop(*capture)
    root = F.regexp_extract("url", r"^([a-z]+://[^/]+)/.+", 1)
    gone = joined.filter((F.col("status") == "not_found") & (root != "")).select(
        "org", F.concat(root, F.lit("/")).alias("url"), F.concat("source", F.lit("_root_recovery")).alias("source"), "priority"
    )
    retried = (
        gone.join(candidates.select("org", "url"), ["org", "url"], "left_anti")
        .groupBy("org", "url").agg(F.min_by(F.struct("source", "priority"), "priority").alias("x"))
        .select("org", "url", "x.source", "x.priority").join(_last_capture(verdicts, capture), ["org", "url"])
    )
    tried = joined.withColumn("retry", F.lit(0)).unionByName(retried.withColumn("retry", F.lit(1)), allowMissingColumns=True)
    place = F.struct("priority", "retry", "url")
    won = tried.groupBy("org").agg(F.min(F.when(_true(F.col("publishable")), place)).alias("_won"))
    kept = tried.join(won, "org").filter(F.col("_won").isNull() | (place <= F.col("_won")))
    outcome = (
        F.when(_true(F.col("publishable")), "published").when(F.col("status") == "available", "identity_rejected")
        .when(F.col("status") == "blocked", "fetch_blocked").when(F.col("status").isin("source_error", "failed"), "provider_error")
        .otherwise("not_found")
    )
    return kept.select("org", "url", "source", "priority", "retry", outcome.alias("outcome"), "score")


def _last_capture(verdicts: DataFrame, capture: tuple[str, ...]) -> DataFrame:
    """The verdict on the last capture of each address."""
    if not capture:
        return verdicts
    fields = [c for c in verdicts.columns if c not in ("org", "url", *capture)]
    return verdicts.groupBy("org", "url").agg(F.max_by(F.struct(*fields), F.struct(*capture)).alias("x")).select("org", "url", "x.*")


def site_outcome(attempts: DataFrame) -> DataFrame:
    """Final state per entity: the published site, else not_found."""
    good = F.col("outcome") == "published"
    return attempts.groupBy("org").agg(
        F.when(F.bool_or(good), "published").otherwise("not_found").alias("state"), F.max(F.when(good, F.col("url"))).alias("url"), F.count(F.lit(1)).alias("attempts")
    )


def best_scored_site(candidates: DataFrame, verdicts: DataFrame, cap: Column, capture: tuple[str, ...] = ()) -> DataFrame:
    """First generation: among the first ``cap`` candidates the best score, stopping at one that passes; ``capture`` as in ``select_verified_site``."""
    place = F.row_number().over(W.partitionBy("org").orderBy("priority", "url"))
    tried = candidates.withColumn("place", place).withColumn("cap", cap).filter(F.col("place") <= F.col("cap")).join(verdicts, ["org", "url", *capture])
    stop = tried.groupBy("org").agg(F.min(F.when(_true(F.col("publishable")), F.col("place"))).alias("_stop"))
    seen = tried.join(stop, "org").filter(F.col("_stop").isNull() | (F.col("place") <= F.col("_stop")))
    return seen.groupBy("org").agg(F.max_by(F.struct("url", "score", "publishable"), F.struct("score", -F.col("place"))).alias("x")).select("org", "x.*")


def website_origins(accepted: DataFrame, candidates: DataFrame) -> DataFrame:
    """How many accepted sites each origin supplied; an unmatched host is unknown."""
    hosts = candidates.groupBy("org", host(F.col("url")).alias("host")).agg(F.min_by("source", "priority").alias("source"))
    joined = accepted.select("org", host(F.col("url")).alias("host")).join(hosts, ["org", "host"], "left")
    return joined.groupBy(F.coalesce("source", F.lit("unknown")).alias("origin")).agg(F.count(F.lit(1)).alias("sites"))


# ---- proof in text ----


def legal_proof(org: Column, name: Column, town: Column, domain: Column, street: Column, people: Column, text: Column, text_domain: Column) -> Column:
    """The strongest proof type in a text: number, own domain, name with domain or town,
    brand with street and town, brand with a registered person; NULL when there is none."""
    nobody = F.array().cast("array<string>")
    folded = F.struct(
        word_line(text).alias("line"), word_line(name).alias("legal"), word_line(town).alias("place"), word_line(street).alias("road"),
        F.transform(F.coalesce(people, nobody), word_line).alias("people"),
        F.array_distinct(owner_tokens(name)).alias("brand"), owner_tokens(text).alias("tokens"),
    )

    has_domain = F.length(F.coalesce(domain, F.lit(""))) > 0

    def ladder(f: Column) -> Column:
        town_named = (F.length(f["place"]) >= 4) & has_phrase(f["line"], f["place"])
        named = (F.length(f["legal"]) >= 6) & has_phrase(f["line"], f["legal"])
        brand = (F.length(F.array_join(f["brand"], "")) >= 5) & _subset(f["brand"], f["tokens"])
        person = F.exists(f["people"], lambda p: (F.length(p) >= 10) & F.contains(p, F.lit(" ")) & has_phrase(f["line"], p))
        return (
            F.when(named & ((has_domain & F.contains(F.lower(text), F.lower(domain))) | town_named), "captured_legal_name_and_domain_or_city")
            .when(brand & (F.length(f["road"]) >= 6) & has_phrase(f["line"], f["road"]) & town_named, "captured_brand_and_registered_street_city")
            .when(brand & person, "captured_brand_and_current_registered_person")
        )

    # Texts and names are folded only where neither the number nor the domain proves the entity.
    return (
        F.when(number_in_text(org, text), "captured_exact_organisation_number")
        .when(has_domain & _true(text_domain == domain), "verified_own_domain")
        .otherwise(let(folded, ladder))
    )


def plan_tasks(profiles: DataFrame) -> DataFrame:
    """Connector tasks with ids that depend on their content only.

    ``profiles``: org, name, municipality, verified_site, social_links array<struct<platform,url>>.
    """
    def task(connector: Column | str, purpose: Column | str, url: Column | None = None) -> Column:
        as_column = lambda v: F.lit(v) if isinstance(v, str) else v
        return F.struct(as_column(connector).alias("connector"), as_column(purpose).alias("purpose"), (url if url is not None else F.lit(None).cast("string")).alias("candidate_url"))

    links = F.filter(F.coalesce("social_links", F.array().cast("array<struct<platform:string,url:string>>")), lambda k: (k["platform"] != "") & (k["url"] != ""))
    purpose = F.when(F.col("verified_site"), "refresh_verified_profile_metrics").otherwise("resolve_profile_identity_then_refresh_metrics")
    social = F.transform(links, lambda k: task(F.concat(k["platform"], F.lit("_connector")), purpose, k["url"]))
    base = F.array(
        task("google_places_api", "resolve_places_and_public_rating"), task("licensed_news_search", "discover_independent_mentions"),
        task("jobs_provider", "discover_active_jobs"),
    )
    search = F.when(F.size(links) == 0, F.array(task("permitted_search_api", "discover_social_handles"))).otherwise(F.slice(base, 1, 0))
    named = profiles.filter((F.coalesce("org", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != ""))
    rows = named.select("org", "name", "municipality", "verified_site", F.explode(F.concat(base, social, search)).alias("t")).select("org", "name", "municipality", "verified_site", "t.*")
    verified = F.col("candidate_url").isNotNull() & F.col("verified_site")
    key = stable_id(F.col("org"), F.col("name"), F.col("municipality"), F.col("connector"), F.col("purpose"), F.col("candidate_url"), verified)
    return rows.select(key.alias("task_id"), "org", "connector", "purpose", "candidate_url", verified.alias("candidate_identity_verified"), F.lit("pending").alias("state"))
