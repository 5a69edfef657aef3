"""Identity gates: does this page, handle or site belong to exactly this legal entity?

Signals are columns of one projection, the ladder is a second projection over
them, so no signal is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions.ids import stable_id
from attesta.functions.text import (
    any_marker, digits, exact_name_tokens, fold, has_phrase, let, lit_strings, name_tokens, number_in_text, owner_tokens, proof_span, token_hits,
    valid_org_numbers, word_line,
)
from attesta.functions.urls import host, is_directory_host, is_listing_host, mail_host, url_path
from attesta.session import fixed, spread

EMPTY = "array<string>"


def _true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def _filled(column: Column) -> Column:
    return F.length(F.coalesce(column, F.lit(""))) > 0


def _rung(test: Column, score: float, reason: str) -> tuple[Column, Column]:
    return test, F.struct(F.lit(score).alias("score"), F.lit(reason).alias("reason"))


def _ladder(rungs: list[tuple[Column, Column]], last: tuple[float, str]) -> Column:
    first = F.when(*rungs[0])
    for test, verdict in rungs[1:]:
        first = first.when(test, verdict)
    return first.otherwise(F.struct(F.lit(last[0]).alias("score"), F.lit(last[1]).alias("reason")))


def identity_signals(profiles: DataFrame, pages: DataFrame) -> DataFrame:
    """Everything the first-generation ladder looks at, one row per (entity, page).

    ``profiles``: org, name, former_names, postcode, city, streets, phones.
    ``pages``: org, url, origin, hostname, title, meta_description, structured_names,
    footer_text, contact_text, body_text.
    """
    j = pages.join(profiles.select("org", *[F.col(c).alias(f"p_{c}") for c in ("name", "former_names", "postcode", "city", "streets", "phones")]), "org")
    structured = F.array_join(F.coalesce("structured_names", F.array().cast(EMPTY)), " ")
    regions = ["title", "meta_description", "footer_text", "contact_text", "hostname"]
    region = F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in ("title", "meta_description")], F.nullif(structured, F.lit("")),
                         *[F.nullif(c, F.lit("")) for c in ("footer_text", "contact_text", "hostname")])
    j = j.withColumns({"region": region, "whole": F.concat_ws(" ", F.nullif(region, F.lit("")), F.nullif("body_text", F.lit("")))})
    j = j.withColumns({
        "f_region": fold(F.col("region")), "f_whole": fold(F.col("whole")), "t_now": name_tokens(F.col("p_name")),
        "found": valid_org_numbers(F.col("whole")), "site": host(F.col("url")),
        "parts": F.transform(F.filter(F.array(*regions, structured), lambda t: F.length(t) > 0), name_tokens),
    })
    share_now = F.when(F.size("t_now") > 0, F.size(token_hits(F.col("t_now"), F.col("f_region"))) / F.size("t_now")).otherwise(0.0)
    old = F.transform(
        F.filter(F.coalesce("p_former_names", F.array().cast(EMPTY)), lambda n: F.length(n) > 0),
        lambda n: F.struct(name_tokens(n).alias("t"), token_hits(name_tokens(n), F.col("f_region")).alias("m")),
    )
    fits = F.filter(old, lambda o: (F.size(o["t"]) > 0) & ((F.size(o["m"]) / F.size(o["t"]) >= 0.75) | ((F.size(o["t"]) >= 2) & (F.size(o["m"]) >= 2))))
    former = F.when(share_now < 0.75, F.try_element_at(fits, F.lit(1)))
    j = j.withColumn("former", former).withColumns({"by_former": F.col("former").isNotNull(), "expected": F.coalesce("former.t", "t_now")})
    j = j.withColumns({"matched": token_hits(F.col("expected"), F.col("f_region")), "anywhere": token_hits(F.col("expected"), F.col("f_whole"))})
    code, town = F.coalesce("p_postcode", F.lit("")), fold(F.col("p_city"))
    streets = F.coalesce("p_streets", F.array().cast(EMPTY))
    phones = F.filter(
        F.transform(F.coalesce("p_phones", F.array().cast(EMPTY)), lambda p: F.when(digits(p).rlike("^47[0-9]{8}$"), F.substring(digits(p), 3, 8)).otherwise(digits(p))),
        lambda p: F.length(p) == 8,
    )
    corroborated = F.array_compact(F.array(
        F.when((F.length(code) == 4) & F.rlike(F.col("whole"), F.concat(F.lit(r"\b"), code, F.lit(r"\b"))), "registered postcode"),
        F.when((F.length(town) > 3) & F.contains("f_whole", town), "registered city"),
        F.when(F.exists(streets, lambda s: (F.length(fold(s)) >= 4) & F.contains(F.col("f_whole"), fold(s))), "registered street address"),
        F.when(let(digits(F.col("whole")), lambda glued: F.exists(phones, lambda p: F.contains(glued, p))), "registered phone"),
    ))
    label = fold(F.substring_index("site", ".", 1))
    club = F.col("p_name").rlike(r"(?i)(?:^|\s)(?:B\.?\s*I\.?\s*L\.?|BEDRIFTSIDRETTSLAG|IDRETTSLAG)(?:\s|$)")
    local_town = F.exists(name_tokens(F.col("p_city")), lambda t: (F.length(t) >= 3) & F.contains(F.col("f_whole"), t))
    j = j.withColumns({
        "corroboration": corroborated,
        "local": _true(local_town) | ((code != "") & F.contains("whole", code)),
        "domain_name": (F.length(label) > 0) & F.array_join("expected", "").startswith(F.substring(label, 1, 6)),
        "is_club": _true(club), "n": F.size("expected"), "hits": F.size("matched"),
        "full": (F.size("expected") > 0) & (F.size("matched") == F.size("expected")),
        "share": F.when(F.size("expected") > 0, F.size("matched") / F.size("expected")).otherwise(0.0),
        "substantive": F.length(F.trim(F.coalesce("body_text", F.lit("")))) >= 200,
        "norwegian_host": F.col("site").endswith(".no"),
        "trusted": _true(F.col("origin").isin(lx.GATE_AUTHORITATIVE_ORIGINS)),
        "named_part": F.exists("parts", lambda t: (F.size(F.col("expected")) > 0) & (F.size(F.array_except(F.col("expected"), t)) == 0)),
        "org_found": F.array_contains("found", F.col("org")),
        "conflicting": F.array_sort(F.array_except("found", F.array("org"))),
    })
    context = (
        F.col("norwegian_host") | F.lower("url").rlike(r"/(nb-no|nn-no|no-no|no)(?:/|$)") | F.col("whole").rlike(r"(\+47|0047)\s*\d")
        | any_marker(F.col("f_whole"), lx.NORWEGIAN_PAGE_WORDS) | F.col("local") | (F.size("corroboration") > 0)
    )
    return j.withColumns({
        "norwegian": context,
        "directory": _filled(F.col("url")) & is_directory_host(F.col("site")),
        "parked": any_marker(F.col("f_whole"), lx.PARKED_MARKERS),
        "network": any_marker(F.col("f_whole"), lx.NETWORK_MARKERS),
        "club_page": any_marker(F.col("f_whole"), ["bedriftsidrett", "idrettslag", "b i l", "sport"]),
    })


def identity_gate_v1(profiles: DataFrame, pages: DataFrame) -> DataFrame:
    """First-generation gate: token ladder with register corroboration."""
    s = identity_signals(profiles, pages)
    n, hits, full, share = F.col("n"), F.col("hits"), F.col("full"), F.col("share")
    proven, local, trusted = F.size("corroboration") > 0, F.col("local"), F.col("trusted")
    named, domain, solid = F.col("named_part"), F.col("domain_name"), F.col("substantive")
    here, context = F.col("norwegian_host"), F.col("norwegian")
    home = solid & (here | context)
    owned = trusted & (domain | full) & (hits > 0)
    backed = full & (n >= 2) & (domain | local)
    # Scores and the wording of their reasons.
    rungs = [
        _rung(owned & (n < 2), 0.95, "authoritative statutory registry domain matching single-token entity name"),
        _rung(owned & (full | (share >= 0.75)), 0.95, "complete legal name on authoritative statutory registry domain"),
        _rung(owned, 0.92, "authoritative registry domain corroborated by name tokens"),
        _rung((n >= 2) & (named | (full & domain)) & home, 0.95, "all normalized legal-name tokens appear together in homepage identity evidence"),
        _rung((n == 1) & (named | domain | full) & home, 0.95, "single distinctive legal-name token on matching substantive domain with Norwegian context"),
        _rung((n < 2) & ~proven, 0.50, "single-token name requires explicit registered address, phone, or org number corroboration"),
        _rung(full & proven, 0.95, "complete legal name in identity region of the page"),
        _rung(backed & ((here & (local | proven)) | (context & proven)), 0.95, "complete multi-token legal name in identity region corroborated by domain and locality"),
        _rung(backed & trusted, 0.92, "complete multi-token legal name on authoritative registry/seed domain"),
        _rung(backed, 0.70, "multi-token name lacks independent Norwegian locality/address corroboration"),
        _rung((share >= 0.75) & (hits >= 2) & local & proven, 0.92, "most legal-name tokens present and corroborated by registered locality/postcode"),
        _rung(
            trusted & ((share >= 0.5) | ((F.size("anywhere") == n) & (n >= 2))) & (local | solid | proven | here), 0.92,
            "authoritative registry/seed domain corroborated by legal name tokens and page context",
        ),
        _rung(full & solid & (n >= 2) & (local | proven) & (here | trusted), 0.92, "complete legal name in identity region of a substantive page with physical corroboration"),
        _rung(full & solid & (n >= 2) & (local | proven), 0.70, "foreign domain requires explicit Norwegian locality corroboration"),
        _rung(full & trusted, 0.92, "complete legal name on authoritative registry domain"),
        _rung(full, 0.70, "complete legal name present but lacking independent physical corroboration (address/phone/orgnr)"),
        _rung((share >= 0.75) & (hits >= 2), 0.65, "most legal-name tokens present, exact identity incomplete"),
        _rung((n == 1) & (hits > 0) & solid & trusted, 0.92, "single-token legal name on authoritative domain"),
    ]
    others = F.size("conflicting")
    judged = s.withColumn("v", _ladder(rungs, (0.30, "no convincing exact-entity evidence on page")))
    capped = F.when(F.col("network") | (others > 0), F.least(F.col("v.score"), F.lit(0.7))).otherwise(F.col("v.score"))
    stopped = F.when(F.col("directory"), 1).when(F.col("parked"), 2).when(F.col("org_found"), 3).when((others > 0) & (hits == 0), 4).when(n == 0, 5).when(F.col("is_club") & ~F.col("club_page"), 6)
    score = (
        F.when(stopped == 1, 0.0).when(stopped == 2, 0.05).when(stopped == 3, 1.0).when(stopped == 4, 0.15).when(stopped == 5, 0.2)
        .when(stopped == 6, 0.30).otherwise(capped)
    )
    by_level = (
        F.when(score >= lx.PUBLISH_THRESHOLD, "exact").when(score >= lx.REVIEW_THRESHOLD, "review").otherwise("ambiguous")
    )
    status = F.when(stopped.isin(1, 2, 4), "rejected").otherwise(by_level)
    extra = F.when(F.col("by_former"), "entity matched by official historical legal name from register")
    proof = F.when(F.col("v.reason").startswith("complete legal name in identity region of the page"), F.concat(F.lit("corroborated by "), F.array_join("corroboration", " and ")))
    reasons = (
        F.when(stopped == 1, F.array(F.lit("source is a business directory or social platform, not the company's own site")))
        .when(stopped == 2, F.array(F.lit("page is parked, for sale, or a default server placeholder")))
        .when(stopped == 3, F.array_compact(F.array(extra, F.lit("exact organisation number present on page"), F.when(others > 0, F.format_string("page also lists %d other organisation number(s)", others)))))
        .when(stopped == 4, F.array(F.concat(F.lit("page states a different organisation number ("), F.try_element_at(F.col("conflicting"), F.lit(1)), F.lit(") and does not carry this entity's name"))))
        .when(stopped == 5, F.array(F.lit("legal name has no distinguishing tokens to verify against")))
        .when(stopped == 6, F.array(F.lit("business sports-club entity points to operating company site without club evidence")))
        .otherwise(F.array_compact(F.array(
            extra, F.col("v.reason"), proof, F.when(F.col("network"), "page describes a franchise, group or member network"),
            F.when(others > 0, F.format_string("page also states %d unrelated organisation number(s)", others)),
        )))
    )
    spaced = F.concat_ws(" ", F.substring("org", 1, 3), F.substring("org", 4, 3), F.substring("org", 7, 3))
    seen = F.try_element_at(F.when(hits > 0, F.col("matched")).otherwise(F.col("anywhere")), F.lit(1))
    span = F.when(stopped == 3, F.coalesce(proof_span(F.col("whole"), F.col("org")), proof_span(F.col("whole"), spaced))).when(
        stopped.isNull() & seen.isNotNull(), F.coalesce(proof_span(F.col("region"), seen), proof_span(F.col("whole"), seen))
    )
    no_tokens = stopped.isin(1, 2)
    return judged.select(
        "org", "url", F.round(score, 3).alias("score"), status.alias("status"), (by_level == "exact").alias("publishable"), reasons.alias("reasons"),
        F.when(no_tokens, F.array().cast(EMPTY)).when(hits > 0, F.col("matched")).otherwise(F.col("anywhere")).alias("matched_tokens"),
        F.col("expected").alias("expected_tokens"), F.col("org_found").alias("organisation_number_on_page"),
        F.col("conflicting").alias("conflicting_org_numbers"), span.alias("proof_span"),
    )


# ---- the ownership gate ----

HOST_IN_TEXT = r"(?i)\b(?:www\.)?[\w-]+(?:\.[\w-]+)*\.(?:no|com|net|org|se|dk|fi|eu|io|co|app)\b"
TRIVIAL_PATH = r"(?i)^(?:|no|en|nb|nn|index\.html?)$"
OWNER_PAGE = r"(?i)/(?:contact|kontakt|about|om-oss|personvern|privacy|legal|vilkar|terms)(?:[/.?_-]|$)"


def _names_company(part: Column) -> Column:
    """The name stands in the text itself, not only inside an echoed host name."""

    def named(bare: Column) -> Column:
        phrase = has_phrase(F.array_join(exact_name_tokens(bare), " "), F.col("name_line"))
        glued = (F.size("core") >= 2) & (F.length("compact") >= 8) & F.contains(F.replace(word_line(bare), F.lit(" "), F.lit("")), F.col("compact"))
        return _true(phrase | glued)

    return let(F.regexp_replace(F.coalesce(part, F.lit("")), HOST_IN_TEXT, " "), named)


PART_FLAGS = ["names", "legal", "number", "street", "code", "phone", "city", "person", "parked", "club"]


def _part_flags(text: Column) -> Column:
    """struct of what one piece of site text says about the entity; folded over pieces with OR."""

    def flags(t: Column) -> Column:
        line, tokens, raw = t["line"], t["tokens"], t["text"]
        return F.struct(
            _names_company(raw).alias("names"),
            has_phrase(line, F.col("legal_line")).alias("legal"),
            ((F.length("org") == 9) & number_in_text(F.col("org"), raw)).alias("number"),
            ((F.length("street_line") >= 6) & has_phrase(line, F.col("street_line"))).alias("street"),
            (F.col("postcode").rlike(r"^\d{4}$") & number_in_text(F.col("postcode"), raw)).alias("code"),
            ((F.length("phone8") == 8) & number_in_text(F.col("phone8"), raw)).alias("phone"),
            has_phrase(line, F.col("city_line")).alias("city"),
            _true(F.exists("person_lines", lambda p: has_phrase(tokens, p))).alias("person"),
            any_marker(F.lower(raw), lx.OWNER_PARKED_MARKERS).alias("parked"),
            (F.contains(line, F.lit("bedriftsidrett")) | F.contains(line, F.lit("b i l"))).alias("club"),
        )

    raw = F.coalesce(text, F.lit(""))
    return let(F.struct(raw.alias("text"), word_line(raw).alias("line"), F.array_join(owner_tokens(raw), " ").alias("tokens")), flags)


def _schema_number(node: Column) -> Column:
    return digits(F.coalesce(node["tax_id"], node["vat_id"], node["identifier"]))


def ownership_profiles(profiles: DataFrame) -> DataFrame:
    """Profile columns the ownership gate compares with.

    Input: org, name, municipality, websites array, email, street, postcode, city, phone,
    people array (current registered persons), known_orgs array (own subunits).
    """
    number = digits(F.col("phone"))
    local = F.when(number.rlike("^0047[0-9]{8}$"), F.substring(number, 5, 8)).when(number.rlike("^47[0-9]{8}$"), F.substring(number, 3, 8)).otherwise(number)
    core = exact_name_tokens(F.col("name"))
    people = F.filter(F.transform(F.coalesce("people", F.array().cast(EMPTY)), owner_tokens), lambda p: (F.size(p) >= 2) & (F.size(F.array_except(p, core)) > 0))
    site_host = lambda w: host(F.when(F.contains(w, F.lit("://")), w).otherwise(F.concat(F.lit("https://"), w)))
    sites = F.filter(F.coalesce("websites", F.array().cast(EMPTY)), lambda w: F.length(w) > 0)
    return profiles.select(
        "org", "name", core.alias("core"), F.array_join(core, " ").alias("name_line"), F.array_join(core, "").alias("compact"),
        word_line(F.col("name")).alias("legal_line"), word_line(F.col("street")).alias("street_line"), F.coalesce("postcode", F.lit("")).alias("postcode"),
        local.alias("phone8"), word_line(F.coalesce("city", "municipality")).alias("city_line"),
        F.transform(people, lambda p: F.array_join(p, " ")).alias("person_lines"), F.transform(sites, site_host).alias("declared_hosts"),
        F.transform(sites, lambda w: F.concat(site_host(w), F.regexp_replace(url_path(F.when(F.contains(w, F.lit("://")), w).otherwise(F.concat(F.lit("https://"), w))), "/+$", ""))).alias("declared_places"),
        F.nullif(mail_host(F.col("email")), F.lit("")).alias("mail_domain"), F.coalesce("known_orgs", F.array().cast(EMPTY)).alias("known_orgs"),
    )


def page_flags(profiles: DataFrame, site_pages: DataFrame) -> DataFrame:
    """Flags over all captured pages of a site; pages are folded by an aggregate, never listed."""
    p = ownership_profiles(profiles)
    text = F.concat_ws(" ", "title", "identity_text", "main_text")
    joined = site_pages.join(p, "org").select("org", "site_url", "page_url", _part_flags(text).alias("f"))
    contact = F.col("f.number") & F.col("page_url").rlike(OWNER_PAGE)
    return joined.groupBy("org", "site_url").agg(*[F.bool_or(F.col(f"f.{n}")).alias(f"g_{n}") for n in PART_FLAGS], F.bool_or(contact).alias("g_contact_number"))


def identity_gate_v3(profiles: DataFrame, sites: DataFrame, site_pages: DataFrame | None = None) -> DataFrame:
    """Ownership gate: a contiguous name in the owner's own words, or official identifiers.

    ``sites`` (one row per org and site_url): requested_url, title, description, heading,
    identity_text, ownership_text, main_text, owner_captured, homepage_required,
    article_document, organisations array<struct<name,legal_name,alternate_name,url,
    tax_id,vat_id,identifier>>. ``site_pages``: org, site_url, page_url, title,
    identity_text, main_text.
    """
    p = ownership_profiles(spread(profiles, "org"))
    j = spread(sites, "org").join(p, "org").withColumn("site", host(F.col("site_url")))
    base = F.concat(F.lit("https://"), F.col("site"), F.lit("/"))
    resolve = lambda u: F.when(u.rlike("^[a-z]+://"), u).otherwise(F.concat(base, F.regexp_replace(u, "^/+", "")))
    nodes = F.filter(
        F.coalesce("organisations", F.array().cast(dict(sites.dtypes)["organisations"])),
        lambda n: n["url"].isNotNull() & (host(resolve(n["url"])) == F.col("site")) & F.regexp_replace(url_path(resolve(n["url"])), "^/+|/+$", "").rlike(TRIVIAL_PATH),
    )
    j = j.withColumn("nodes", nodes)
    node_names = F.filter(F.flatten(F.transform("nodes", lambda n: F.array(n["name"], n["legal_name"], n["alternate_name"]))), lambda t: t.isNotNull())
    j = j.withColumn("node_names", node_names)
    home_text = F.concat_ws(" ", "title", "description", "identity_text", F.array_join("node_names", " "))
    j = j.withColumn("home_text", home_text).withColumn("h", _part_flags(F.concat_ws(" ", F.col("home_text"), F.col("main_text"))))
    j = j.withColumns({f"h_{n}": F.col(f"h.{n}") for n in PART_FLAGS})
    brand = (
        _names_company(F.col("title")) | _names_company(F.col("description")) | _names_company(F.col("heading")) | F.exists("node_names", _names_company)
    )
    owner_text = F.coalesce("ownership_text", "home_text")
    foreign = F.transform(
        F.regexp_extract_all(F.col("home_text"), F.lit(r"(?<!\d)([89]\d{2}[ .]*\d{3}[ .]*\d{3})(?!\d)"), F.lit(1)), lambda t: F.regexp_replace(t, r"\D", "")
    )
    numbers = F.transform("nodes", _schema_number)
    legal_owner = _true(has_phrase(word_line(F.col("ownership_text")), F.col("legal_line")))
    j = j.withColumns({
        "legal_owner": legal_owner, "named_home": brand | legal_owner,
        "legal_part": F.exists(F.concat(F.array("title", "description", "identity_text"), F.col("node_names")), lambda t: has_phrase(word_line(t), F.col("legal_line"))),
        "org_home": (F.length("org") == 9) & number_in_text(F.col("org"), F.coalesce(owner_text, F.lit(""))),
        "foreign": F.size(F.array_except(foreign, F.concat(F.array("org"), F.col("known_orgs")))) > 0,
        "scoped": F.exists(numbers, lambda x: x == F.col("org")),
        "scoped_other": F.exists(numbers, lambda x: x.rlike(r"^[89]\d{8}$") & (x != F.col("org"))),
        "declared_owner": F.exists("nodes", lambda n: exact_name_tokens(F.coalesce(n["name"], n["legal_name"])) == F.col("core")),
        "registry_link": (F.col("site") != "") & F.exists("declared_hosts", lambda h: (h != "") & ((F.col("site") == h) | F.col("site").endswith(F.concat(F.lit("."), h)))),
        "email_link": _true(~F.col("mail_domain").isin(lx.SHARED_MAIL_HOSTS) & ((F.col("site") == F.col("mail_domain")) | F.col("site").endswith(F.concat(F.lit("."), "mail_domain")))),
        "deep_entry": ~F.regexp_replace(url_path(F.col("site_url")), "^/+|/+$", "").rlike(TRIVIAL_PATH),
        "redirected": F.array_contains("declared_places", F.concat(host(F.col("requested_url")), F.regexp_replace(url_path(F.col("requested_url")), "/+$", ""))),
        "name_domain": (F.length("name_line") > 0) & F.col("site").endswith(".no") & (F.replace(F.substring_index("site", ".", 1), F.lit("-"), F.lit("")) == F.col("compact")),
    })
    names = PART_FLAGS
    if site_pages is None:
        for n in [*names, "contact_number"]:
            j = j.withColumn(f"g_{n}", F.lit(False))
    else:
        j = j.join(page_flags(profiles, site_pages), ["org", "site_url"], "left").fillna(False, [f"g_{n}" for n in [*names, "contact_number"]])
    both = {n: F.col(f"h_{n}") | F.col(f"g_{n}") for n in names}
    named, legal_home = F.col("named_home"), F.col("named_home") & _true(F.col("legal_part"))
    address = both["street"] & both["code"]
    local = address | both["phone"]
    registered = F.col("registry_link") | F.col("email_link")
    several = F.size("core") >= 2
    club = F.col("name").rlike(r"(?i)(?:^|\s)B\.?\s*I\.?\s*L\.?(?:\s|$)")
    scoped = _true(F.col("scoped"))
    host_label = F.substring_index("site", ".", 1)
    title_tokens = owner_tokens(F.col("title"))
    associated = F.exists(
        "core",
        lambda t: (F.length(t) >= 4) & ~t.isin("holding", "group", "invest", "eiendom", "service", "norge") & F.array_contains(title_tokens, t) & F.contains(host_label, t),
    )

    def rung(test: Column, score: float, reason: str, content: Column | bool = False) -> tuple[Column, Column]:
        own = content if isinstance(content, Column) else F.lit(content)
        return _true(test), F.struct(F.lit(score).alias("score"), F.lit(reason).alias("reason"), own.alias("content"))

    # Scores and the wording of their reasons.
    rungs = [
        rung(is_listing_host(F.col("site")), 0.0, "Registry/directory listings identify a company but do not establish ownership of that website"),
        rung(both["parked"], 0.1, "Captured page is a parked or generic hosting placeholder"),
        rung(F.col("title").rlike(r"(?i)\b404\b|page not found|siden finnes ikke"), 0.1, "Captured page is an error page"),
        rung(F.col("deep_entry") & ~_true(F.col("owner_captured")) & ~(scoped | registered), 0.1, "A deep entry has no independent owner homepage or registered-domain proof"),
        rung(
            _true(F.col("homepage_required")) & ~(named | scoped | F.col("org_home") | registered), 0.1,
            "A deep-page company mention needs captured homepage ownership or registered-domain corroboration",
        ),
        rung(_true(F.col("article_document")) & ~(_true(F.col("declared_owner")) | registered), 0.1, "A publisher article about a company is not evidence that the company owns the publisher's website"),
        rung(club & ~both["club"], 0.3, "Operating-company site does not establish the separate sports-club entity"),
        rung((F.col("foreign") & ~F.col("org_home")) | (_true(F.col("scoped_other")) & ~scoped), 0.2, "Homepage identifies another Norwegian organisation number"),
        rung(scoped, 1.0, "Domain-scoped Organization identifier matches the exact registry organisation", True),
        rung(F.col("g_contact_number") & named, 0.98, "Exact organisation number on a same-site contact/legal page corroborates the independently named homepage", True),
        rung(F.col("legal_owner"), 0.98, "Exact legal name is declared in captured homepage owner/contact regions", True),
        rung(F.col("org_home"), 1.0, "Exact organisation number appears in homepage evidence", True),
        rung(legal_home & several, 0.95, "Contiguous legal name appears in homepage evidence", True),
        rung(
            named & (registered | local | (F.col("name_domain") & several) | both["person"]), 0.95,
            "Contiguous company name is corroborated by registry, contact evidence or its Norwegian name domain", True,
        ),
        rung(F.col("redirected") & named & both["city"], 0.95, "Registered company URL redirects to a page naming the company in its registered city", True),
        rung(F.col("g_legal") & named & several & both["city"], 0.95, "Full legal name on a same-site page agrees with the homepage name and registered city", True),
        rung(F.col("registry_link") & F.col("email_link"), 0.92, "Both registered website and registered email identify this domain", named),
        rung(F.col("registry_link") & associated, 0.9, "Registered domain and homepage brand establish an associated website; wider content is not attributed to this entity"),
        rung(both["number"] | F.col("g_names") | named, 0.85, "Name or secondary-page reference needs independent legal-entity corroboration"),
    ]
    verdict = F.when(*rungs[0])
    for test, value in rungs[1:]:
        verdict = verdict.when(test, value)
    none = F.struct(F.lit(0.3).alias("score"), F.lit("No exact legal identity or corroborated company name was found").alias("reason"), F.lit(False).alias("content"))
    judged = j.withColumns({"v": verdict.otherwise(none), "address_match": address, "phone_match": both["phone"], "city_match": both["city"], "person_match": both["person"]})
    listing = is_listing_host(F.col("site"))
    status = (
        F.when(listing, "unverified").when(F.col("v.score") >= 0.9, "exact").when(F.col("v.score") >= 0.8, "review").otherwise("related_or_uncertain")
    )
    return judged.select(
        "org", "site_url", F.col("v.score").alias("score"), status.alias("status"), (status == "exact").alias("publishable"),
        F.col("v.content").alias("content_attributable"), F.col("v.reason").alias("reason"), F.col("core").alias("legal_name_tokens"),
        "registry_link", "email_link", "address_match", "phone_match", "city_match", "person_match",
        F.col("redirected").alias("registered_redirect"), F.col("foreign").alias("conflicting_org"),
    )


# ---- social handles ----


def handle_score(tokens: Column, path_tokens: Column) -> Column:
    """struct(score, reason, matched) of a profile address against the entity's name words."""
    handle = F.array_join(path_tokens, "")
    matched = F.filter(tokens, lambda t: F.contains(handle, t))
    compact = F.array_join(tokens, "")
    distinct = F.size(F.array_distinct(matched))
    share = F.when(F.size(tokens) > 0, distinct / F.size(F.array_distinct(tokens))).otherwise(0.0)

    def made(score: float, reason: str) -> Column:
        return F.struct(F.lit(score).alias("score"), F.lit(reason).alias("reason"), matched.alias("matched_tokens"))

    return (
        F.when((F.length(compact) > 0) & F.contains(handle, compact), made(0.98, "normalized legal-name sequence appears in the social handle"))
        .when((F.size(tokens) == 1) & (F.size(matched) > 0), made(0.95, "single distinctive legal-name token appears in the social handle"))
        .when((share >= 0.75) & (distinct >= 2), made(0.90, "most legal-name tokens appear in the social handle"))
        .otherwise(made(0.30, "social handle lacks strong exact-entity name evidence"))
    )


def social_gate(profiles: DataFrame, links: DataFrame, verdicts: DataFrame | None = None, owner_words: bool = True) -> DataFrame:
    """(org, platform, url, discovery_source, evidence_url, evidence_sha256, declared) with a verdict.

    ``verdicts`` is (org, publishable, content_attributable, site_url). A captured link
    from the entity's own site passes when its handle is that site's brand, or when
    the site's own organisation markup declares it.
    """
    tokens = owner_tokens if owner_words else name_tokens
    path = F.url_decode(F.regexp_replace(url_path(F.col("url")), "%(?![0-9A-Fa-f]{2})", "%25"))
    j = spread(links, "org").join(profiles.select("org", F.col("name").alias("_name")), "org")
    j = j.withColumn("h", handle_score(tokens(F.col("_name")), tokens(path)))
    if verdicts is None:
        return j.select(*links.columns, F.col("h.score").alias("identity_score"), (F.col("h.score") >= lx.PUBLISH_THRESHOLD).alias("publishable"), F.col("h.reason").alias("reason"), F.col("h.matched_tokens").alias("matched_tokens"))
    v = verdicts.select("org", F.col("publishable").alias("_pub"), F.col("content_attributable").alias("_own"), host(F.col("site_url")).alias("_site"))
    j = j.join(v, "org", "left")
    root = F.replace(F.substring_index("_site", ".", 1), F.lit("-"), F.lit(""))
    handle = F.array_join(tokens(F.element_at(F.split(path, "/"), -1)), "")
    rest = F.substr(handle, F.length(root) + 1)
    own_handle = (F.length(root) >= 4) & handle.startswith(root) & rest.isin("", "no", "norge", "as", "official")
    captured = (F.col("discovery_source") == "verified_site_link") & (F.length("evidence_sha256") == 64)
    inherited = _true(captured & F.col("_own") & (own_handle | _true(F.col("declared"))))
    score = F.when(inherited, 0.95).otherwise(F.col("h.score"))
    good = score >= lx.PUBLISH_THRESHOLD
    return j.select(
        *links.columns, score.alias("identity_score"), good.alias("publishable"),
        F.when(inherited, "Captured link from the exact company's own website names that site's brand").otherwise(F.col("h.reason")).alias("reason"),
        F.col("h.matched_tokens").alias("matched_tokens"), (good & _true(F.col("_pub")) & _true(F.col("_own"))).alias("published"),
    )


def quarantined_links(judged: DataFrame) -> DataFrame:
    return judged.groupBy("org").agg(F.count(F.lit(1)).alias("links"), F.count_if(~F.col("published")).alias("quarantined"))


def site_inherited_link(site_publishable: Column, site_url: Column, platform: Column, link: Column) -> Column:
    """First generation: 0.92 for a link of a verified site that carries the site's name, except on X."""
    token = F.substring_index(host(site_url), ".", 1)
    text = F.lower(F.url_decode(F.regexp_replace(F.trim(link), "%(?![0-9A-Fa-f]{2})", "%25")))
    good = _true(site_publishable) & ~F.lower(platform).isin("x", "twitter") & (F.length(token) >= 3) & F.contains(text, token)
    return F.when(_true(good), 0.92).otherwise(0.0)


def search_handle_leads(profiles: DataFrame, results: DataFrame) -> DataFrame:
    """Search-found handles whose result text repeats the name or number; leads only, never evidence."""
    from attesta.functions.urls import normalize_social_url

    j = results.join(profiles.select("org", F.col("name").alias("_name"), F.col("municipality").alias("_town")), "org")
    j = j.withColumn("link", normalize_social_url(F.col("url"))).filter(F.col("link").isNotNull())
    path = url_path(F.col("link.url"))
    j = j.withColumn("h", handle_score(name_tokens(F.col("_name")), name_tokens(path))).filter(F.col("h.score") >= lx.PUBLISH_THRESHOLD)
    context, town = F.lower(F.concat_ws(" ", "title", "snippet")), F.lower(F.trim("_town"))
    repeated = F.contains(context, F.lower(F.trim("_name"))) | F.contains(context, F.col("org"))
    short = F.size(owner_tokens(F.col("_name"))) <= 1
    town_named = (F.length(town) >= 4) & F.contains(context, town)
    return j.filter(_true(repeated | (short & town_named))).select("org", "link.platform", "link.url", F.col("h.score").alias("identity_score"))


def handle_observations(judged: DataFrame) -> DataFrame:
    """Published site links, one handle per (org, platform) with its page hash as proof."""
    ready = fixed(judged).filter(F.col("published") & (F.length("evidence_sha256") == 64) & _filled(F.col("evidence_url")))
    best = ready.groupBy("org", "platform").agg(F.min_by(F.struct("url", "evidence_url", "evidence_sha256", "identity_score"), "url").alias("x"))
    proof = F.array(F.create_map(F.lit("type"), F.lit("verified_company_site_outbound_link"), F.lit("evidence_url"), F.col("x.evidence_url")))
    return best.select(
        stable_id(F.col("org"), F.col("platform"), F.col("x.url"), prefix="social-").alias("id"), "org", "platform", F.lit("profile_handle").alias("signal_type"),
        F.col("x.url").alias("source_url"), F.col("x.evidence_sha256").alias("content_sha256"), F.lit(True).alias("exact_entity"), proof.alias("identity_proof"),
        F.lit("permitted_public_page").alias("acquisition_mode"), F.lit("approved").alias("rights_status"), F.lit("company_social").alias("source_class"),
    )


def handle_candidates(judged: DataFrame) -> DataFrame:
    """Links that stay leads, with why."""
    from_site = F.col("discovery_source") == "verified_site_link"
    outcome = F.when(from_site & ~F.col("publishable"), "identity_rejected").otherwise("candidate_unverified")
    return judged.filter(~F.col("published")).select("org", "platform", "url", outcome.alias("outcome"), "reason")


def handle_status(profiles: DataFrame, judged: DataFrame) -> DataFrame:
    """available / candidate_only / not_found per entity."""
    counted = judged.groupBy("org").agg(F.count_if("published").alias("published_profiles"), F.count_if(~F.col("published")).alias("candidate_profiles"))
    j = profiles.select("org").join(counted, "org", "left").fillna(0, ["published_profiles", "candidate_profiles"])
    status = F.when(F.col("published_profiles") > 0, "available").when(F.col("candidate_profiles") > 0, "candidate_only").otherwise("not_found")
    return j.withColumn("status", status)


def promote_leads(profiles: DataFrame, sites: DataFrame, owned: DataFrame) -> DataFrame:
    """Captured search leads that pass the ownership gate for entities without a site.

    ``sites`` has the gate's columns; ``owned`` lists entities that already have one.
    Deep or article pages also need a scoped owner or a registered domain.
    """
    fresh = sites.join(owned.select("org").distinct(), "org", "left_anti")
    fresh = fresh.filter(~is_listing_host(host(F.col("site_url"))) & ~F.coalesce(F.arrays_overlap(F.array(host(F.col("site_url"))), lit_strings(lx.SEARCH_BLOCKED_HOSTS)), F.lit(False)))
    judged = fixed(identity_gate_v3(profiles, fresh))
    facts = spread(fresh, "org").join(profiles.select("org", F.col("name").alias("_name")), "org").select(
        "org", "site_url", F.col("article_document").alias("_article"),
        F.exists(
            F.coalesce("organisations", F.array().cast(dict(sites.dtypes)["organisations"])),
            lambda n: (F.array_join(owner_tokens(F.coalesce(n["name"], n["legal_name"])), "") == F.array_join(owner_tokens(F.col("_name")), "")) & (host(n["url"]) == host(F.col("site_url"))),
        ).alias("_scoped"),
        F.contains(F.array_join(owner_tokens(F.col("title")), ""), F.array_join(owner_tokens(F.col("_name")), "")).alias("_titled"),
    )
    j = judged.filter(F.col("publishable") & F.col("content_attributable")).join(fixed(facts), ["org", "site_url"])
    owner = _true(F.col("_scoped")) | F.col("registry_link") | F.col("email_link")
    deep = ~F.regexp_replace(url_path(F.col("site_url")), "^/+|/+$", "").rlike(TRIVIAL_PATH)
    kept = j.filter((owner | (~deep & ~_true(F.col("_article")))) & (owner | _true(F.col("_titled"))))
    return kept.drop("_article", "_scoped", "_titled")
