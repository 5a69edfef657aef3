"""Claims: merging, downgrading, envelopes, contract rows and batch checks.

Claims and the evidence they cite travel as two long tables, ``claims`` (one row
per statement) and ``links`` (one row per cited evidence id). Nothing is gathered
into one list per entity, so an entity with a third of all rows stays spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions.ids import claim_key
from attesta.operators.ordering import number_within


def with_claim_key(claims: DataFrame) -> DataFrame:
    return claims.withColumn("claim_key", claim_key(F.col("field"), F.col("subject"), F.col("reporting_period")))


def claim_links(claims: DataFrame) -> DataFrame:
    """(org, claim_key, evidence_id, pos): the union of cited ids at their first position."""
    cited = with_claim_key(claims).select("org", "claim_key", "pos", F.posexplode("evidence_ids").alias("place", "evidence_id"))
    return cited.groupBy("org", "claim_key", "evidence_id").agg(F.min(F.struct("pos", "place")).alias("first_cited"))


def check_claims(claims: DataFrame) -> DataFrame:
    """Rows breaking the claim rules: unknown state, or available without value or evidence."""
    available = F.col("availability") == "available"
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("availability").isin(lx.AVAILABILITY_STATES), "invalid availability state"),
            F.when(available & (F.coalesce(F.size("evidence_ids"), F.lit(0)) < 1), "available claim cites no evidence"),
            F.when(available & F.col("value").isNull(), "available claim has no value"),
        )
    )
    return claims.withColumn("reasons", reasons).filter(F.size("reasons") > 0)


def dedupe_claims(claims: DataFrame) -> DataFrame:
    """One claim per key: available first, then confidence, then the earliest.

    The winner is picked by an aggregate, which combines before the shuffle, and
    not by a window, which would sort a hot key in one task.
    """
    keyed = with_claim_key(claims)
    order = F.struct(
        (F.col("availability") != "available").alias("held"),
        (-F.coalesce(F.col("confidence"), F.lit(0.0))).alias("weakness"),
        F.col("pos"),
    )
    carried = [c for c in keyed.columns if c not in ("org", "claim_key", "evidence_ids", "pos")]
    best = keyed.groupBy("org", "claim_key").agg(
        F.min_by(F.struct("pos", *carried), order).alias("best"),
        F.min("pos").alias("first_pos"),
        F.count(F.lit(1)).alias("merged"),
    )
    return best.select("org", "claim_key", "first_pos", "merged", "best.*")


def downgrade_unproven(claims: DataFrame, links: DataFrame, evidence: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Hold available claims as ambiguous where identity is unproven and no source is exempt.

    ``verdicts`` is (org, publishable). A missing verdict counts as unproven.
    """
    exempt_sources = evidence.filter(F.col("source_class").isin(lx.EXEMPT_SOURCE_CLASSES)).select(F.col("id").alias("evidence_id"))
    exempt = (
        links.join(exempt_sources, "evidence_id", "left_semi")
        .select("org", "claim_key").distinct()
        .withColumn("exempt", F.lit(True))
    )
    proven = verdicts.groupBy("org").agg(F.bool_or("publishable").alias("identity_ok"))
    joined = claims.join(exempt, ["org", "claim_key"], "left").join(proven, "org", "left")
    held = (
        (F.col("availability") == "available")
        & ~F.coalesce("exempt", F.lit(False))
        & ~F.coalesce("identity_ok", F.lit(False))
    )
    note = F.concat_ws(" | ", F.nullif("note", F.lit("")), F.lit("identity not proven to publish threshold; held as ambiguous"))
    return joined.select(
        *[c for c in claims.columns if c not in ("availability", "note")],
        F.when(held, "ambiguous").otherwise(F.col("availability")).alias("availability"),
        F.when(held, note).otherwise(F.col("note")).alias("note"),
        F.coalesce("identity_ok", F.lit(False)).alias("identity_ok"),
    )


def _state_counts() -> list[Column]:
    counts = [F.count(F.lit(1)).alias("total")]
    for state in lx.AVAILABILITY_STATES:
        counts.append(F.count_if(F.col("availability") == state).alias(f"n_{state}"))
    return counts


def envelope_headers(claims: DataFrame, links: DataFrame, evidence: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per entity: disposition and the seven claim counts.

    ``claims`` comes from ``downgrade_unproven``. ``runs`` is (org, run_failed,
    entity_resolved); an entity listed there without any claim still gets its row.
    """
    official_sources = evidence.filter(F.col("source_class").isin(lx.OFFICIAL_SOURCE_CLASSES)).select(F.col("id").alias("evidence_id"))
    official = (
        links.join(official_sources, "evidence_id", "left_semi")
        .select("org", "claim_key").distinct().withColumn("official", F.lit(True))
    )
    marked = claims.join(official, ["org", "claim_key"], "left")
    published = F.col("availability") == "available"
    headers = marked.groupBy("org").agg(
        *_state_counts(),
        F.bool_or("identity_ok").alias("identity_ok"),
        F.bool_or(published & F.coalesce("official", F.lit(False))).alias("official_published"),
    )
    if runs is None:
        headers = headers.withColumn("broken", F.lit(False))
    else:
        broken = runs.groupBy("org").agg(F.bool_or(F.col("run_failed") | ~F.col("entity_resolved")).alias("broken"))
        headers = headers.join(broken, "org", "full").fillna(0, ["total"] + [f"n_{s}" for s in lx.AVAILABILITY_STATES])
        headers = headers.fillna(False, ["identity_ok", "official_published", "broken"])
    disposition = (
        F.when(F.col("broken"), "failed")
        .when((F.col("n_available") > 0) & (F.col("identity_ok") | F.col("official_published")), "official")
        .when(F.col("n_ambiguous") > 0, "ambiguous")
        .when((F.col("n_blocked") > 0) & (F.col("n_available") == 0), "blocked")
        .otherwise("empty")
    )
    return headers.select("org", disposition.alias("disposition"), "total", *[f"n_{s}" for s in lx.AVAILABILITY_STATES])


def referenced_evidence(links: DataFrame, evidence: DataFrame) -> DataFrame:
    """(org, evidence …) for the evidence a claim of that entity cites, and no other."""
    cited = links.select("org", F.col("evidence_id").alias("id")).distinct()
    return cited.join(evidence, "id")


def envelope_claims(claims: DataFrame, headers: DataFrame) -> DataFrame:
    """The claims of every entity with a header, one row each: the body of the envelopes beside the table of headers.

    Every entity has this shape, however many claims it holds, so none is gathered into one row.
    """
    body = [c for c in claims.columns if c not in ("org", "first_pos")]
    return claims.join(headers.select("org", "disposition"), "org").select("org", "disposition", F.col("first_pos").alias("place"), F.struct(*body).alias("claim"))


# Contract field ← claim field. The first listed source wins.
CONTRACT_FIELDS = {
    "legal_name": ["legal_name"],
    "organisation_form": ["organisation_form", "legal_form"],
    "registered_status": ["registered_status", "status"],
    "business_address": ["business_address", "registered_address"],
    "municipality": ["registered_office_municipality", "municipality"],
    "industry": ["industry", "industry_code"],
    "employees": ["employees", "employee_count"],
    "founded": ["founded", "established_date"],
    "website": ["website"],
    "contact_email": ["contact_email", "email"],
    "contact_phone": ["contact_phone", "phone"],
    "social_profiles": ["social_profiles"],
    "roles": ["roles"],
    "subunits": ["registered_subunit"],
    "group_parent": ["group_parent"],
    "revenue": ["annual_turnover_nok", "revenue"],
    "operating_result": ["operating_profit_nok", "operating_result"],
    "annual_result": ["net_result", "annual_result_nok", "annual_result"],
    "assets": ["total_assets_nok", "total_assets", "assets"],
    "equity": ["total_equity", "equity"],
    "debt": ["total_liabilities", "debt"],
    "filing_history": ["filing_history", "account_years"],
    "job_postings": ["job_posting"],
    "news": ["public_mention", "news"],
    "qualified_sentiment": ["qualified_sentiment"],
}


def to_contract(claims: DataFrame, orgs: DataFrame, fields: dict[str, list[str]] | None = None) -> DataFrame:
    """Long contract: one row per (entity, contract field), every field present.

    A field takes the earliest available claim of its first source with one, else
    the earliest claim in any other state; a field never checked is
    ``not_available``. Nothing is invented: a row without a claim cites none.
    """
    fields = fields or CONTRACT_FIELDS
    spark = claims.sparkSession
    mapping = spark.createDataFrame(
        [(target, source, i) for target, sources in fields.items() for i, source in enumerate(sources)],
        "contract_field string, field string, preference int",
    )
    order = F.struct((F.col("availability") != "available").alias("held"), "preference", "first_pos")
    chosen = (
        claims.join(F.broadcast(mapping), "field")
        .groupBy("org", "contract_field")
        .agg(
            F.min_by(F.struct("claim_key", "value", "availability", "confidence"), order).alias("pick"),
            F.count_if(F.col("availability") == "available").alias("statements"),
        )
    )
    wanted = orgs.select("org").distinct().withColumn("contract_field", F.explode(F.array(*[F.lit(f) for f in fields])))
    return wanted.join(chosen, ["org", "contract_field"], "left").select(
        "org",
        "contract_field",
        F.coalesce("pick.availability", F.lit("not_available")).alias("availability"),
        F.when(F.col("pick.availability") == "available", F.col("pick.value")).alias("value"),
        F.when(F.col("pick.availability") == "available", F.col("pick.confidence")).alias("confidence"),
        F.col("pick.claim_key").alias("claim_key"),
        F.coalesce("statements", F.lit(0)).alias("statements"),
    )


def claims_to_profiles(claims: DataFrame, fields: list[str]) -> DataFrame:
    """Wide profile row per entity: the earliest available value of each field."""
    picks = []
    for field in fields:
        chosen = (F.col("field") == field) & (F.col("availability") == "available")
        picks.append(F.min_by(F.when(chosen, F.col("value")), F.when(chosen, F.col("first_pos"))).alias(field))
    return claims.groupBy("org").agg(*picks)


def field_availability(claims: DataFrame) -> DataFrame:
    """Claims per field and state."""
    counts = [F.count_if(F.col("availability") == s).alias(s) for s in lx.AVAILABILITY_STATES]
    return claims.groupBy("field").agg(*counts, F.count_distinct("org").alias("orgs"))


def terminal_states(module_evidence: DataFrame, completed_at: Column | None = None) -> DataFrame:
    """Terminal state of every (org, module) evidence row."""
    status, note = F.col("status"), F.lower(F.coalesce("note", F.lit("")))
    state = (
        F.when(status == "available", "complete")
        .when(status.isin("not_applicable", "not_found", "source_error"), status)
        .when(status == "blocked", F.when(F.contains(note, F.lit("robot")), "blocked_robots").otherwise("blocked_policy"))
        .otherwise("submission_error")
    )
    finished = F.col("retrieved_at") if completed_at is None else F.coalesce("retrieved_at", completed_at)
    return module_evidence.select("org", "module", state.alias("state"), finished.alias("final_timestamp"))


def require_modules(module_evidence: DataFrame, orgs: DataFrame, modules: list[str]) -> DataFrame:
    """Every requested (org, module) pair; a pair without evidence keeps a NULL status."""
    wanted = orgs.select("org").distinct().withColumn("module", F.explode(F.array(*[F.lit(m) for m in modules])))
    return wanted.join(module_evidence, ["org", "module"], "left")


def entity_states(states: DataFrame) -> DataFrame:
    broken = F.bool_or(F.col("state") == "submission_error")
    return states.groupBy("org").agg(
        F.when(broken, "submission_error").otherwise("complete").alias("state"),
        F.count(F.lit(1)).alias("modules"),
        F.count_if(~F.col("state").isin(lx.TERMINAL_STATES)).alias("invalid_modules"),
    )


def validate_batch(entities: DataFrame, expected_count: int) -> DataFrame:
    """One row of checks over the finished batch."""
    facts = entities.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("org").alias("orgs"),
        F.coalesce(F.bool_and(F.col("state").isin(lx.TERMINAL_STATES)), F.lit(True)).alias("all_entity_states_terminal"),
        (F.coalesce(F.sum("invalid_modules"), F.lit(0)) == 0).alias("all_module_states_terminal"),
    )
    exact = F.col("rows") == expected_count
    unique = F.col("rows") == F.col("orgs")
    return facts.select(
        exact.alias("exact_expected_count"),
        unique.alias("unique_orgs"),
        "all_entity_states_terminal",
        "all_module_states_terminal",
        (exact & unique).alias("zero_silent_drops"),
        (exact & unique & F.col("all_entity_states_terminal") & F.col("all_module_states_terminal")).alias("passed"),
    )


def module_coverage(module_evidence: DataFrame) -> DataFrame:
    """Found and blank modules per entity; the module names are a small closed set."""
    found = F.col("status") == "available"
    reason = F.concat_ws(": ", "module", F.coalesce("note", F.col("status"), F.lit("not_fetched")))
    return module_evidence.groupBy("org").agg(
        F.array_sort(F.collect_set(F.when(found, F.col("module")))).alias("found"),
        F.array_sort(F.collect_set(F.when(~F.coalesce(found, F.lit(False)), reason))).alias("blank"),
    )


def attempt_ledger(attempts: DataFrame, order: list[str]) -> DataFrame:
    """Attempt rows numbered from 1 within each entity in ``order``; a hot entity or a burst is split by ranges."""
    return number_within(attempts, ["org"], order, "sequence")
