"""Official JSON answers as typed claims and rows.

Inputs are (org, body) tables of raw answers. Each normaliser parses with an
explicit schema, so Spark reads only the fields used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

ADDRESS = "struct<adresse:array<string>,postnummer:string,poststed:string,kommune:string,kommunenummer:string,land:string,landkode:string>"
CODE = "struct<kode:string,beskrivelse:string>"
ENTITY_SCHEMA = (
    "organisasjonsnummer string, navn string, organisasjonsform " + CODE + ", registreringsdatoEnhetsregisteret string,"
    "stiftelsesdato string, forretningsadresse " + ADDRESS + ", postadresse " + ADDRESS + ", telefon string, mobil string,"
    "hjemmeside string, epostadresse string, naeringskode1 " + CODE + ", naeringskode2 " + CODE + ", naeringskode3 " + CODE + ","
    "institusjonellSektorkode " + CODE + ", vedtektsfestetFormaal array<string>, aktivitet array<string>,"
    "harRegistrertAntallAnsatte boolean, antallAnsatte int, registreringsdatoAntallAnsatteNAVAaregisteret string,"
    "registreringsdatoAntallAnsatteEnhetsregisteret string, konkurs boolean, underAvvikling boolean,"
    "underTvangsavviklingEllerTvangsopplosning boolean, registrertIForetaksregisteret boolean, registrertIMvaregisteret boolean,"
    "registrertIFrivillighetsregisteret boolean, registrertIStiftelsesregisteret boolean,"
    "kapital struct<belop:double,valuta:string,type:string,antallAksjer:long,innfortDato:string>,"
    "historiskeNavn array<struct<navn:string,tilDato:string>>, erIKonsern boolean, sisteInnsendteAarsregnskap string"
)
ROLES_SCHEMA = (
    "rollegrupper array<struct<type:" + CODE + ",sistEndret:string,roller:array<struct<type:" + CODE + ",avregistrert:boolean,"
    "person:struct<navn:struct<fornavn:string,mellomnavn:string,etternavn:string>>,"
    "enhet:struct<organisasjonsnummer:string,navn:variant>>>>>"
)
SUBUNITS_SCHEMA = (
    "_embedded struct<underenheter:array<struct<organisasjonsnummer:string,navn:string,beliggenhetsadresse:" + ADDRESS + ","
    "postadresse:" + ADDRESS + ",naeringskode1:" + CODE + ",harRegistrertAntallAnsatte:boolean,antallAnsatte:int,"
    "registreringsdatoEnhetsregisteret:string,hjemmeside:string,epostadresse:string,telefon:string>>>, page struct<totalElements:long>"
)
GROUP_SCHEMA = (
    "parentNavn string, parentOrganisasjonsnummer string,"
    "children array<struct<organisasjonsnummer:string,parentNavn:string,parentOrganisasjonsnummer:string>>"
)

# Role codes that are leadership, with their names; and those that are not.
LEADERSHIP_ROLES = {
    "DAGL": "chief_executive", "LEDE": "board_chair", "NEST": "board_deputy_chair", "MEDL": "board_member",
    "VARA": "board_deputy_member", "OBS": "board_observer", "INNH": "sole_proprietor", "DTPR": "general_partner",
    "DTSO": "limited_partner", "KOMP": "general_partner", "BEST": "managing_officer",
}
NON_LEADERSHIP_ROLES = ["REVI", "REGN", "KONT", "FFØR", "HLSE", "ADOS", "BOBE"]

# Account line items and where the answer holds them.
ACCOUNT_LINES = {
    "revenue": "resultatregnskapResultat.driftsresultat.driftsinntekter.sumDriftsinntekter",
    "operating_costs": "resultatregnskapResultat.driftsresultat.driftskostnad.sumDriftskostnad",
    "operating_result": "resultatregnskapResultat.driftsresultat.driftsresultat",
    "net_financial_items": "resultatregnskapResultat.finansresultat.nettoFinans",
    "result_before_tax": "resultatregnskapResultat.ordinaertResultatFoerSkattekostnad",
    "net_result": "resultatregnskapResultat.aarsresultat",
    "total_assets": "eiendeler.sumEiendeler",
    "current_assets": "eiendeler.omloepsmidler.sumOmloepsmidler",
    "fixed_assets": "eiendeler.anleggsmidler.sumAnleggsmidler",
    "equity": "egenkapitalGjeld.egenkapital.sumEgenkapital",
    "total_liabilities": "egenkapitalGjeld.gjeldOversikt.sumGjeld",
    "current_liabilities": "egenkapitalGjeld.gjeldOversikt.kortsiktigGjeld.sumKortsiktigGjeld",
    "long_term_liabilities": "egenkapitalGjeld.gjeldOversikt.langsiktigGjeld.sumLangsiktigGjeld",
}


def _text(column: Column) -> Column:
    return F.nullif(F.trim(column.cast("string")), F.lit(""))


def _json(**parts: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]))


def _joined(lines: Column) -> Column:
    return F.array_join(F.filter(F.transform(lines, F.trim), lambda p: F.length(p) > 0), ", ")


def _address(block: Column) -> Column:
    """JSON of an address block; NULL when every part is missing."""
    value = F.struct(
        _text(_joined(block["adresse"])).alias("street"), _text(block["postnummer"]).alias("postal_code"),
        _text(block["poststed"]).alias("postal_town"), _text(block["kommune"]).alias("municipality"),
        _text(block["kommunenummer"]).alias("municipality_number"), _text(block["land"]).alias("country"),
        _text(block["landkode"]).alias("country_code"),
    )
    text = F.to_json(value)
    return F.when(text != "{}", text)


def _coded(block: Column) -> Column:
    return F.when(_text(block["kode"]).isNotNull(), _json(code=block["kode"], description=F.coalesce(block["beskrivelse"], F.lit(""))))


def _claim(
    field: str, value: Column, *, subject: Column | None = None, period: Column | None = None,
    availability: Column | str = "available", confidence: Column | float = 1.0, note: Column | None = None,
) -> Column:
    none = F.lit(None).cast("string")
    state = F.lit(availability) if isinstance(availability, str) else availability
    return F.struct(
        F.lit(field).alias("field"), value.cast("string").alias("value"), state.alias("availability"),
        F.when(state == "available", F.lit(confidence)).alias("confidence"),
        (subject if subject is not None else none).alias("subject"),
        (period if period is not None else none).alias("reporting_period"),
        (note if note is not None else none).alias("note"),
    )


def _explode_claims(rows: DataFrame, claims: Column) -> DataFrame:
    """Claims in order; one that is available without a value was never stated and is left out."""
    kept = F.filter(claims, lambda c: c.isNotNull() & ((c["availability"] != "available") | c["value"].isNotNull()))
    return rows.select("org", F.posexplode(kept).alias("pos", "claim")).select("org", "pos", "claim.*")


def normalize_entity(answers: DataFrame) -> DataFrame:
    """Register answer → claims; an answer that is not an object gives one failed claim."""
    parsed = answers.select("org", F.from_json("body", ENTITY_SCHEMA).alias("e"), F.try_parse_json("body").isNull().alias("broken"))
    e = F.col("e")
    reported = F.coalesce(e["harRegistrertAntallAnsatte"], F.lit(False)) & e["antallAnsatte"].isNotNull()
    flags = {
        "bankrupt": F.coalesce(e["konkurs"], F.lit(False)),
        "under_liquidation": F.coalesce(e["underAvvikling"], F.lit(False)),
        "under_compulsory_liquidation": F.coalesce(e["underTvangsavviklingEllerTvangsopplosning"], F.lit(False)),
    }
    active = ~(flags["bankrupt"] | flags["under_liquidation"] | flags["under_compulsory_liquidation"])
    registers = {n: F.coalesce(e[f"registrertI{n[0].upper()}{n[1:]}"], F.lit(False)) for n in
                 ("foretaksregisteret", "mvaregisteret", "frivillighetsregisteret", "stiftelsesregisteret")}
    capital = e["kapital"]
    different_post = ~e["postadresse"].eqNullSafe(e["forretningsadresse"])
    purpose = F.coalesce(_text(_joined(e["vedtektsfestetFormaal"])), _text(_joined(e["aktivitet"])))
    stated = [
        _claim("legal_name", _text(e["navn"])),
        _claim("organisation_number", _text(e["organisasjonsnummer"])),
        _claim("organisation_form", _coded(e["organisasjonsform"])),
        _claim("registered_at", _text(e["registreringsdatoEnhetsregisteret"])),
        _claim("founded_at", _text(e["stiftelsesdato"])),
        _claim("registered_address", _address(e["forretningsadresse"])),
        _claim("postal_address", F.when(different_post, _address(e["postadresse"]))),
        _claim("phone", F.coalesce(_text(e["telefon"]), _text(e["mobil"]))),
        _claim("website_registry", _text(e["hjemmeside"])),
        _claim("email", _text(e["epostadresse"])),
        *[_claim("industry_code", _coded(e[f"naeringskode{i}"]), subject=F.lit(f"nace_{i}")) for i in (1, 2, 3)],
        _claim("sector_code", _coded(e["institusjonellSektorkode"])),
        _claim("stated_purpose", purpose),
        _claim(
            "employees", F.when(reported, e["antallAnsatte"]), availability=F.when(reported, "available").otherwise("not_available"),
            period=F.when(reported, F.coalesce(e["registreringsdatoAntallAnsatteNAVAaregisteret"], e["registreringsdatoAntallAnsatteEnhetsregisteret"])),
            note=F.when(~reported, "no employee count reported; that is not a count of zero"),
        ),
        _claim("operating_status", _json(active=active, **flags)),
        _claim("register_memberships", _json(**registers)),
        _claim(
            "share_capital",
            F.when(capital["belop"] != 0, _json(amount=capital["belop"], currency=F.coalesce(capital["valuta"], F.lit("NOK")), type=capital["type"], shares=capital["antallAksjer"])),
            period=capital["innfortDato"],
        ),
        _claim("in_corporate_group", e["erIKonsern"]),
    ]
    former = F.transform(
        F.filter(F.coalesce(e["historiskeNavn"], F.array()), lambda f: _text(f["navn"]).isNotNull()),
        lambda f: _claim("former_name", f["navn"], subject=f["navn"], period=_text(F.substring(f["tilDato"], 1, 10))),
    )
    failed = F.array(_claim("registry_entry", F.lit(None), availability="failed", note=F.lit("register answer was not a JSON object")))
    unreadable = F.col("broken") | e.isNull()
    return _explode_claims(parsed, F.when(unreadable, failed).otherwise(F.concat(F.array(*stated), former)))


def entity_profiles(answers: DataFrame) -> DataFrame:
    """Register answer → one profile row; missing stays NULL."""
    e = F.col("e")
    return answers.select("org", F.from_json("body", ENTITY_SCHEMA).alias("e")).select(
        "org", _text(e["navn"]).alias("name"), e["organisasjonsform"]["kode"].alias("legal_form"),
        e["antallAnsatte"].alias("employees"), e["konkurs"].alias("bankrupt"), e["underAvvikling"].alias("liquidating"),
        _text(e["hjemmeside"]).alias("website"), e["forretningsadresse"].alias("business_address"),
        e["postadresse"].alias("postal_address"), _text(e["sisteInnsendteAarsregnskap"]).alias("latest_submitted_accounts"),
        e["naeringskode1"]["kode"].alias("industry_code"), e["naeringskode1"]["beskrivelse"].alias("industry_label"),
        _text(e["epostadresse"]).alias("email"), F.coalesce(_text(e["telefon"]), _text(e["mobil"])).alias("phone"),
        F.filter(F.transform(e["historiskeNavn"], lambda f: f["navn"]), lambda n: n.isNotNull()).alias("former_names"),
        F.coalesce(e["harRegistrertAntallAnsatte"], F.lit(False)).alias("employees_registered"),
    )


def role_rows(answers: DataFrame) -> DataFrame:
    """One row per listed role, active or not; birth dates are never read."""
    groups = answers.select("org", F.posexplode(F.from_json("body", ROLES_SCHEMA)["rollegrupper"]).alias("g", "group"))
    roles = groups.select("org", "g", "group", F.posexplode("group.roller").alias("r", "role"))
    name = F.col("role.person.navn")
    person = _text(F.concat_ws(" ", _text(name["fornavn"]), _text(name["mellomnavn"]), _text(name["etternavn"])))
    holder = F.col("role.enhet")
    holder_name = F.coalesce(
        F.try_variant_get(holder["navn"], "$[0]", "string"), F.try_variant_get(holder["navn"], "$", "string")
    )
    return roles.select(
        "org", F.struct("g", "r").alias("pos"),
        F.coalesce(person, _text(holder_name)).alias("name"),
        holder["organisasjonsnummer"].alias("holder_org"),
        F.upper("role.type.kode").alias("role_code"), F.col("role.type.beskrivelse").alias("role"),
        F.col("group.type.kode").alias("group_code"), F.col("group.type.beskrivelse").alias("group_name"),
        F.col("group.sistEndret").alias("last_changed"),
        F.coalesce("role.avregistrert", F.lit(False)).alias("inactive"),
        F.when(F.col("role.person").isNotNull(), "person").when(holder.isNotNull(), "organisation").alias("holder_type"),
    )


def normalize_roles(answers: DataFrame) -> DataFrame:
    """Current leadership, one row per (name, code), first listed; none at all is a stated absence."""
    titles = F.create_map(*[F.lit(v) for pair in LEADERSHIP_ROLES.items() for v in pair])
    wanted = role_rows(answers).filter(
        ~F.col("inactive") & F.col("role_code").isin(list(LEADERSHIP_ROLES)) & F.col("name").isNotNull()
    )
    first = wanted.groupBy("org", F.lower("name").alias("_key"), "role_code").agg(
        F.min_by(F.struct("pos", "name", "holder_org", "role", "last_changed", "holder_type"), "pos").alias("x")
    )
    stated = first.select(
        "org", F.col("x.pos").alias("pos"), F.lit("available").alias("availability"), F.col("x.name").alias("name"), "role_code",
        titles[F.col("role_code")].alias("position"), F.col("x.role").alias("title"), F.col("x.holder_type").alias("holder_type"),
        F.col("x.holder_org").alias("holder_org"), F.col("x.last_changed").alias("reporting_period"),
    )
    empty = answers.select("org").distinct().join(stated.select("org").distinct(), "org", "left_anti")
    return stated.unionByName(empty.withColumn("availability", F.lit("not_available")), allowMissingColumns=True)


def normalize_locations(answers: DataFrame) -> DataFrame:
    """Subunits as location claims, plus the register's own total where more exist than were listed."""
    parsed = answers.select("org", F.from_json("body", SUBUNITS_SCHEMA).alias("s"))
    units = F.coalesce(F.col("s._embedded.underenheter"), F.array())
    total = F.coalesce(F.nullif(F.col("s.page.totalElements"), F.lit(0)), F.size(units).cast("long"))
    located = F.transform(
        units,
        lambda u: _claim(
            "location",
            _json(
                name=u["navn"], organisation_number=u["organisasjonsnummer"],
                address=F.coalesce(_address(u["beliggenhetsadresse"]), _address(u["postadresse"])),
                industry_code=_coded(u["naeringskode1"]), employees=F.when(u["harRegistrertAntallAnsatte"], u["antallAnsatte"]),
                registered_at=u["registreringsdatoEnhetsregisteret"],
            ),
            subject=F.coalesce(_text(u["organisasjonsnummer"]), u["navn"]),
        ),
    )
    count = F.when(total > F.size(units), F.array(_claim("location_count", total))).otherwise(F.array().cast(located_type()))
    none = F.array(_claim("location", F.lit(None), availability="not_available", note=F.lit("no registered subunits")))
    return _explode_claims(parsed, F.when(F.size(units) == 0, none).otherwise(F.concat(located, count)))


def located_type() -> str:
    return "array<struct<field:string,value:string,availability:string,confidence:double,subject:string,reporting_period:string,note:string>>"


def subunit_rows(answers: DataFrame) -> DataFrame:
    """Subunits as plain rows with contact columns."""
    units = answers.select("org", F.explode(F.from_json("body", SUBUNITS_SCHEMA)["_embedded"]["underenheter"]).alias("u"))
    return units.select(
        F.col("org").alias("parent_org"), F.col("u.organisasjonsnummer").alias("subunit_org"), F.col("u.navn").alias("name"),
        F.col("u.antallAnsatte").alias("employees"), F.col("u.hjemmeside").alias("website"),
        F.col("u.epostadresse").alias("email"), F.col("u.telefon").alias("phone"),
    )


# ---- accounts ----


def account_records(answers: DataFrame) -> DataFrame:
    """Raw accounts answer → one typed row per record and line; absent lines stay NULL."""
    listed = F.coalesce(
        F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>"), F.array(F.try_parse_json("body"))
    )
    records = answers.select("org", F.explode(listed).alias("r"))

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("r", f"$.{path}", kind)

    return records.select(
        "org", get("id", "bigint").alias("record_id"), get("regnskapstype").alias("account_type"),
        get("regnskapsperiode.fraDato").alias("period_from"), get("regnskapsperiode.tilDato").alias("period_to"),
        F.coalesce(get("valuta"), F.lit("NOK")).alias("currency"),
        *[get(path, "double").alias(name) for name, path in ACCOUNT_LINES.items()],
        get("revisjon.ikkeRevidertAarsregnskap", "boolean").alias("not_audited"),
        get("revisjon.fravalgRevisjon", "boolean").alias("audit_waived"),
        get("regnkapsprinsipper.smaaForetak", "boolean").alias("small_entity"),
        get("journalnr").alias("journal_number"),
    )


def normalize_accounts(records: DataFrame, keep: int | None = None) -> DataFrame:
    """Records by age per entity, own company before consolidated in one period; with ``keep`` the newest so many.

    The rank filter is pushed below the shuffle, so each task keeps at most ``keep``
    records of an entity however many it filed.
    """
    own = F.coalesce(F.upper("account_type") != "KONSERN", F.lit(True))
    newest = W.partitionBy("org").orderBy(F.col("period_to").desc_nulls_last(), own.desc(), F.col("record_id").desc())
    placed = records.withColumn("place", F.row_number().over(newest))
    return placed if keep is None else placed.filter(F.col("place") <= keep)


def account_claims(records: DataFrame) -> DataFrame:
    """Line items of the kept records as claims; a line that is absent gives no claim."""
    group = F.coalesce(F.upper("account_type") == "KONSERN", F.lit(False))
    year = _text(F.substring(F.col("period_to").cast("string"), 1, 4))
    subject = F.when(group, "consolidated").otherwise("entity")
    lines = [n for n in ACCOUNT_LINES if n in records.columns]
    stated = [
        F.when(F.col(n).isNotNull(), _claim(n, _json(amount=F.col(n), currency=F.col("currency"), consolidated=group), subject=subject, period=year))
        for n in lines
    ]
    return records.select("org", "place", F.posexplode(F.array_compact(F.array(*stated))).alias("line", "claim")).select(
        "org", F.struct("place", "line").alias("pos"), "claim.*"
    )


def filing_history(years: DataFrame) -> DataFrame:
    """(org, year text) → sorted distinct digit years, the first one and their number.

    A year is four digits at most in practice, so the set stays small per entity.
    """
    digits_only = years.filter(F.trim("year").rlike("^[0-9]+$")).select("org", F.trim("year").alias("year"))
    grouped = digits_only.groupBy("org").agg(F.array_sort(F.collect_set("year")).alias("years"))
    return grouped.select("org", "years", F.element_at("years", 1).cast("int").alias("first_year"), F.size("years").alias("filings"))


def filing_years(answers: DataFrame) -> DataFrame:
    """Raw answer, a JSON list of years → (org, year)."""
    return answers.select("org", F.explode(F.from_json("body", "array<string>")).alias("year"))


def latest_registry_update(events: DataFrame) -> DataFrame:
    """(org, at, change_type, update_id) → the newest event and the total per entity."""
    return events.groupBy("org").agg(
        F.max_by(F.struct("at", "change_type", "update_id"), F.struct("at", "update_id")).alias("last"),
        F.count(F.lit(1)).alias("updates"),
    ).select("org", F.col("last.at").alias("latest_update"), "last.change_type", "last.update_id", "updates")


def group_parent(answers: DataFrame) -> DataFrame:
    """(org, parent_name, parent_org): stated directly, or found in the child list."""
    g = F.from_json("body", GROUP_SCHEMA)
    parsed = answers.select("org", g.alias("g"))
    direct = _text(F.col("g.parentNavn"))
    mine = F.filter("g.children", lambda c: c["organisasjonsnummer"] == F.col("org"))
    child = F.try_element_at(mine, F.lit(1))
    return parsed.select(
        "org",
        F.coalesce(direct, child["parentNavn"]).alias("parent_name"),
        F.when(direct.isNotNull(), F.col("g.parentOrganisasjonsnummer")).otherwise(child["parentOrganisasjonsnummer"]).alias("parent_org"),
    ).filter(F.col("parent_name").isNotNull())


def group_edges(entities: DataFrame) -> DataFrame:
    """Parent link of every entity that names one: (org, parent_org, parent_name) by a self join."""
    parents = entities.select(F.col("org").alias("parent_org"), F.col("name").alias("parent_name"))
    return entities.filter(F.col("parent_org").isNotNull()).join(parents, "parent_org").select("org", "parent_org", "parent_name")


# ---- recorded answers ----

# Where each module's answer is recorded.
MODULE_URLS = {
    "registry_live": "https://data.brreg.no/enhetsregisteret/api/enheter/{org}",
    "roles": "https://data.brreg.no/enhetsregisteret/api/enheter/{org}/roller",
    "group": "https://data.brreg.no/enhetsregisteret/api/konsernstruktur/{org}",
    "locations": "https://data.brreg.no/enhetsregisteret/api/underenheter?overordnetEnhet={org}&size=1000",
    "financials": "https://data.brreg.no/regnskapsregisteret/regnskap/{org}",
    "financial_history": "https://data.brreg.no/regnskapsregisteret/regnskap/aarsregnskap/kopi/{org}/aar",
}


def module_urls(orgs: DataFrame, modules: list[str]) -> DataFrame:
    """(org, module, url) to ask or to look up."""
    pairs = [
        F.struct(F.lit(m).alias("module"), F.replace(F.lit(MODULE_URLS[m]), F.lit("{org}"), F.col("org")).alias("url"))
        for m in modules
    ]
    return orgs.select("org", F.explode(F.array(*pairs)).alias("x")).select("org", "x.*")


def replay_responses(orgs: DataFrame, responses: DataFrame, modules: list[str]) -> DataFrame:
    """Recorded answers joined by address, hashed and classified exactly as live ones would be.

    ``responses`` is (url, status, body, retrieved_at, effective_at). An address
    without a recorded answer becomes a source error, never an absence.
    """
    joined = module_urls(orgs, modules).join(responses, "url", "left")
    status = (
        F.when(F.col("status") == 200, "available")
        .when(F.col("status").isin(404, 410), "not_found")
        .otherwise("source_error")
    )
    note = F.when(F.col("status").isNull(), "recorded answer missing").when(F.col("status") != 200, F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    return joined.select(
        "org", "module", F.col("url").alias("source_url"), status.alias("status"), "retrieved_at", "effective_at",
        F.when(F.col("body").isNotNull(), F.sha2("body", 256)).alias("content_sha256"),
        F.when(F.col("status") == 200, F.col("body")).alias("body"), note.alias("note"),
    )
