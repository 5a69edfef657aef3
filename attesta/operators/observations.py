"""External observations: qualification, freshness, disputes, footprints and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions.dates import valid_date
from attesta.functions.urls import host, url_path
from attesta.operators.ordering import with_totals


def _blank(name: str) -> Column:
    return F.length(F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))) == 0


def _metric(name: str) -> Column:
    return F.get_json_object(F.col("metrics"), f"$.{name}")


def _true(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def _collect_reasons(rules: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(broken, F.lit(text)) for broken, text in rules]))


def with_reasons(observations: DataFrame) -> DataFrame:
    """Every publication rule an observation breaks; an empty list means accepted."""
    signal, label = F.col("signal_type"), F.col("sentiment_label")
    proof_size = F.coalesce(F.size("identity_proof"), F.lit(0))
    rules = [
        (_blank("id"), "missing observation id"),
        (~_true(F.col("org").rlike(r"^\d+$")), "missing or invalid organisation number"),
        (~_true(F.col("platform").isin(lx.PLATFORMS)), "unsupported platform"),
        (~_true(signal.isin(lx.SIGNAL_TYPES)), "unsupported signal type"),
        (host(F.col("source_url")) == "", "missing or invalid source URL"),
        (F.col("retrieved_at").isNull(), "missing retrieval time"),
        (F.coalesce(F.length("content_sha256"), F.lit(0)) != 64, "missing content hash"),
        (~_true(F.col("exact_entity")), "exact legal entity is not verified"),
        (proof_size < 1, "missing exact-entity proof"),
        (~_true(F.col("acquisition_mode").isin(lx.PUBLISHABLE_MODES)), "acquisition mode is not approved for publication"),
        (~_true(F.col("rights_status") == "approved"), "source rights are not approved"),
        (_true(signal.isin("review", "public_post", "public_mention")) & _blank("evidence_span"), "missing evidence span"),
        (label.isNotNull() & ~label.isin(lx.SENTIMENT_LABELS), "unsupported sentiment label"),
        (label.isNotNull() & ~_true(F.col("source_class").isin(lx.INDEPENDENT_OBSERVATION_CLASSES)), "sentiment source is not independent"),
        (label.isNotNull() & _blank("sentiment_model_version"), "missing sentiment model version"),
    ]
    return observations.withColumn("reasons", _collect_reasons(rules))


def accepted(observations: DataFrame) -> DataFrame:
    return with_reasons(observations).filter(F.size("reasons") == 0).drop("reasons")


def rejected(observations: DataFrame) -> DataFrame:
    return with_reasons(observations).filter(F.size("reasons") > 0)


def sentiment_reasons(items: DataFrame) -> DataFrame:
    """Why an item cannot feed a sentiment rollup; an empty list means eligible."""
    rules = [
        (~_true(F.col("exact_entity")), "exact company identity is not verified"),
        (~_true(F.col("source_class").isin(lx.INDEPENDENT_SENTIMENT_CLASSES)), "source is not an allowed independent class"),
    ]
    for name in ("source_url", "retrieved_at", "evidence_span", "content_sha256", "text"):
        rules.append((_blank(name), f"missing {name}"))
    return items.withColumn("reasons", _collect_reasons(rules))


def _age_within(moment: Column, as_of: Column, days: int) -> Column:
    age = F.unix_micros(as_of) - F.unix_micros(moment)
    return _true((age >= 0) & (age <= days * 86_400_000_000))


def published_moment(observations: DataFrame) -> Column:
    """When the item itself was published, from its column or its metrics."""
    metric = F.coalesce(_metric("activity_date"), _metric("published_at"), _metric("published")).try_cast("timestamp")
    return F.coalesce(F.col("published_at").try_cast("timestamp"), metric) if "published_at" in observations.columns else metric


def freshness_split(observations: DataFrame, as_of: str, days: int = 45) -> DataFrame:
    """Retrieved recently and published recently are different facts; the future is neither."""
    now = F.lit(as_of).cast("timestamp")
    return observations.withColumns(
        {
            "fresh": _age_within(F.col("retrieved_at").cast("timestamp"), now, days),
            "recent": _age_within(published_moment(observations), now, days),
        }
    )


def aggregate_footprint(observations: DataFrame, as_of: str, days: int = 45) -> DataFrame:
    """Conservative footprint per entity; counts stay source-specific, gates decide sentiment."""
    rated = freshness_split(with_reasons(observations), as_of, days)
    ok = F.size("reasons") == 0
    signal, label = F.col("signal_type"), F.col("sentiment_label")
    labelled = ok & label.isNotNull()
    public = ok & signal.isin("public_post", "public_mention", "buzz_metrics")
    engagement = sum((F.coalesce(_metric(m).try_cast("double").cast("long"), F.lit(0)) for m in ("likes", "comments", "shares")), F.lit(0))
    scalar = F.when(label == "negative", -1).when(label == "neutral", 0).when(label == "positive", 1)
    rows = rated.groupBy("org").agg(
        F.count_if(ok).alias("accepted"),
        F.count_if(~ok).alias("rejected"),
        F.array_sort(F.collect_set(F.when(ok, F.col("platform")))).alias("platforms"),
        *[F.count_if(ok & (F.col("platform") == p)).alias(f"_p_{p}") for p in lx.PLATFORMS],
        F.count_if(ok & F.col("fresh")).alias("fresh"),
        F.count_if(ok & F.col("recent")).alias("recent"),
        F.count_if(ok & signal.isin("review", "review_summary")).alias("review_signals"),
        F.count_distinct(F.when(ok & (signal == "job_posting"), F.col("source_url"))).alias("active_jobs"),
        F.count_distinct(F.when(public, F.col("source_url"))).alias("public_items"),
        F.coalesce(F.sum(F.when(public, engagement)), F.lit(0)).alias("public_engagement"),
        F.count_if(labelled).alias("sentiment_items"),
        F.count_distinct(F.when(labelled, host(F.col("source_url")))).alias("sentiment_sources"),
        F.count_distinct(F.when(labelled & ~_blank("reviewer_id"), F.col("reviewer_id"))).alias("sentiment_reviewers"),
        *[F.count_if(labelled & (label == name)).alias(f"n_{name}") for name in lx.SENTIMENT_LABELS],
        F.sum(F.when(labelled, scalar)).alias("_sum"),
        F.count(F.when(labelled, scalar)).alias("_scalars"),
    )
    ready = (F.col("sentiment_items") >= 10) & ((F.col("sentiment_sources") >= 2) | (F.col("sentiment_reviewers") >= 10))
    counts = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(p) for p in lx.PLATFORMS]), F.array(*[F.col(f"_p_{p}") for p in lx.PLATFORMS])),
        lambda _, n: n > 0,
    )
    return rows.select(
        "org",
        F.when(F.col("accepted") > 0, "available").otherwise("not_available").alias("status"),
        "accepted", "rejected", "platforms", counts.alias("platform_counts"), "fresh", "recent", "review_signals",
        "active_jobs", "public_items", "public_engagement",
        F.when(ready, "available").otherwise("abstain").alias("sentiment_status"),
        F.when(ready & (F.col("_scalars") > 0), F.bround(50 + 50 * F.col("_sum") / F.col("_scalars"), 1)).alias("sentiment_score"),
        "sentiment_items", "sentiment_sources", "sentiment_reviewers",
        *[f"n_{name}" for name in lx.SENTIMENT_LABELS],
    )


def coverage_summary(observations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Accepted signals by family, over all rows or per ``keys``."""
    ok = accepted(observations)
    signal = F.col("signal_type")
    independent = F.col("source_class").isin("public_news", "customer_review", "employee_review")
    measured = F.lit(False)
    for name in ("views", "likes", "followers", "comments", "subscribers"):
        measured = measured | _metric(name).isNotNull()
    return ok.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("accepted"),
        F.array_sort(F.collect_set("platform")).alias("platforms"),
        F.count_distinct(F.when(independent, host(F.col("source_url")))).alias("independent_hosts"),
        F.count_if((F.col("platform") == "news") & signal.isin("public_mention", "public_post")).alias("news_items"),
        F.count_if(signal.isin("review", "review_summary", "place_summary")).alias("review_signals"),
        F.count_if(signal == "job_posting").alias("job_postings"),
        F.count_if(signal == "workforce_snapshot").alias("workforce_snapshots"),
        F.count_if(signal.isin("profile_metrics", "buzz_metrics") & measured).alias("engagement_signals"),
        F.count_if(_true(F.col("sentiment_model_version") == "explicit-review-rating-polarity-v1")).alias("rating_polarity_items"),
    )


def owner_url(url: Column) -> Column:
    """URL form two claimants of the same page share."""
    scheme = F.lower(F.regexp_extract(url, r"^([a-zA-Z]+):", 1))
    place = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/?#]*)", 1)), r"^www\.", "")
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]+)", 1)
    return F.concat(scheme, F.lit("://"), place, F.regexp_replace(url_path(url), r"/+$", ""), query)


def cross_company_disputes(observations: DataFrame) -> DataFrame:
    """URLs claimed for more than one entity."""
    claimed = observations.filter(F.col("signal_type").isin("profile_handle", "public_post", "job_posting"))
    return (
        claimed.select(owner_url(F.col("source_url")).alias("owner_url"), "org").distinct()
        .groupBy("owner_url").agg(F.count(F.lit(1)).alias("owners"), F.min("org").alias("first_org"))
        .filter(F.col("owners") > 1)
    )


def undisputed(observations: DataFrame) -> DataFrame:
    keyed = observations.withColumn("owner_url", owner_url(F.col("source_url")))
    return keyed.join(cross_company_disputes(observations), "owner_url", "left_anti").drop("owner_url")


# ---- jobs ----

# Titles and paths that are never one vacancy.
NOT_A_TITLE = ["jobs", "careers", "join us", "ledige stillinger"]
NOT_A_VACANCY_TITLE = ["se våre ledige stillinger", "view jobs", "open positions", "rapporter annonse"]
NOT_A_VACANCY_PATH = ["", "/jobs", "/careers", "/karriere", "/stillinger", "/ledige-stillinger"]
SOCIAL_ONLY_HOSTS = ["facebook.com", "instagram.com", "youtube.com", "x.com", "twitter.com"]
JOB_FEED_HOST = "pam-stilling-feed.nav.no"


def _proof(test) -> Column:
    return F.coalesce(F.exists("identity_proof", test), F.lit(False))


def direct_job() -> Column:
    """Whether a job observation points at one vacancy rather than a list, share or profile page."""
    url = F.coalesce("source_url", F.lit(""))
    place, path = host(url), F.regexp_replace(F.lower(url_path(url)), r"/+$", "")
    raw_parts, parts = F.split(url_path(url), "/"), F.split(path, "/")
    job_title = F.coalesce(_metric("job_title"), F.lit(""))
    title = F.lower(F.trim(F.when(job_title != "", job_title).otherwise(F.coalesce(_metric("title"), F.lit("")))))
    job_id = _metric("job_id")
    listed = _proof(lambda p: (p["type"] == "public_ats_current_listing") & (p["job_id"] == job_id))
    listed_here = F.coalesce(
        F.array_contains(raw_parts, job_id) | (F.regexp_extract(url, r"[?&]gh_jid=([^&#]*)", 1) == job_id), F.lit(False)
    )
    from_feed = (place == JOB_FEED_HOST) & path.startswith("/api/v1/feedentry/")
    dated = (
        (F.coalesce(_metric("published_at"), F.lit("")) != "")
        | (F.coalesce(_metric("deadline"), F.lit("")) != "")
        | F.contains(path, F.lit("/jobs/view/"))
    )
    return (
        F.when((title == "") | F.contains(title, F.lit("linkedin")) | title.isin(NOT_A_TITLE), False)
        .when(listed, listed_here)
        .when(title.isin(NOT_A_VACANCY_TITLE), False)
        .when(place == "finn.no", (job_title != "") & path.rlike(r"^/job/ad/\d+$"))
        .when(F.arrays_overlap(parts, F.array(*[F.lit(p) for p in ("report", "search", "share", "map")])), False)
        .when((place == "linkedin.com") & ~path.startswith("/jobs/view/"), False)
        .when(place.isin(SOCIAL_ONLY_HOSTS), False)
        .when(from_feed, _proof(lambda p: p["type"] == "nav_employer_organisation_number"))
        .when(path.isin(NOT_A_VACANCY_PATH), False)
        .otherwise((job_title != "") & dated)
    )


def active_job(as_of: str) -> Column:
    """A direct vacancy with a proven employer that is open at ``as_of``."""
    now = F.lit(as_of).cast("timestamp")
    today = F.to_date(now)

    def checked(p: Column) -> Column:
        age = F.unix_seconds(now) - F.unix_seconds(p["active_as_of"].try_cast("timestamp"))
        return (p["type"] == "public_ats_current_listing") & p["employer_evidence"].isNotNull() & (age >= 0) & (age <= 86_400)

    on_board = _proof(lambda p: (p["type"] == "public_ats_current_listing") & p["employer_evidence"].isNotNull()) & _true(
        _metric("active_listing") == "true"
    )
    expires = valid_date(F.substring(F.coalesce(_metric("deadline"), _metric("expires")), 1, 10)).cast("date")
    published = valid_date(F.substring(F.coalesce(_metric("published_at"), _metric("published")), 1, 10)).cast("date")
    employer = _proof(
        lambda p: (p["type"] == "nav_employer_organisation_number")
        | (
            (p["type"] == "captured_own_site_jobposting")
            & ((p["employer_org_match"] == "true") | (p["employer_name_match"] == "true"))
        )
    )
    open_now = _true((published <= today) & (today <= expires))
    return direct_job() & F.when(on_board, _proof(checked)).otherwise(employer & open_now)


# ---- sentiment ----


def company_sentiment(items: DataFrame) -> DataFrame:
    """Rollup over eligible labelled items; fewer than two independent sources abstains."""
    texted = items.withColumn("text", F.coalesce("text", "evidence_span"))
    usable = sentiment_reasons(texted).withColumn("usable", (F.size("reasons") == 0) & _true(F.col("label").isin(lx.SENTIMENT_LABELS)))
    source = F.when(F.col("source_id").isNotNull(), F.lower(F.trim("source_id"))).otherwise(host(F.col("source_url")))
    ok = F.col("usable")
    counted = usable.groupBy("org").agg(
        F.count_if(ok).alias("accepted_items"),
        F.count_if(~ok).alias("rejected_items"),
        F.count_distinct(F.when(ok, F.nullif(source, F.lit("")))).alias("independent_sources"),
        F.count_distinct(F.when(ok, F.col("source_url"))).alias("source_urls"),
        *[F.count_if(ok & (F.col("label") == name)).alias(f"n_{name}") for name in lx.SENTIMENT_LABELS],
    )
    toned = [name for name in lx.SENTIMENT_LABELS if name != "neutral"]
    tones = sum(((F.col(f"n_{name}") > 0).cast("int") for name in toned), F.lit(0))
    only = F.coalesce(*[F.when(F.col(f"n_{name}") > 0, F.lit(name)) for name in toned])
    ready = F.col("independent_sources") >= 2
    label = F.when(tones == 1, only).when(tones > 1, "mixed").otherwise("neutral")
    return counted.select(
        "org",
        F.when(ready, "available").otherwise("abstain").alias("status"),
        F.when(ready, label).alias("label"),
        "accepted_items", "rejected_items", "independent_sources", "source_urls",
        *[f"n_{name}" for name in lx.SENTIMENT_LABELS],
    )


def headline_rollup(items: DataFrame) -> DataFrame:
    """First-generation rollup: one tone, mixed or neutral, without the two-source rule."""
    tone = F.when(F.col("label") != "neutral", F.col("label"))
    found = items.groupBy("org").agg(F.count(F.lit(1)).alias("items"), F.min(tone).alias("_lo"), F.max(tone).alias("_hi"))
    label = F.when(F.col("_lo").isNull(), "neutral").when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise("mixed")
    return found.select("org", "items", label.alias("label"))


def evaluate_predictions(gold: DataFrame, predictions: DataFrame, minimum_items: int = 300) -> DataFrame:
    """One row of accuracy, per-label scores, coverage and gates. Ids must be unique on both sides."""
    if minimum_items < 300:
        raise ValueError("the qualification minimum is 300 items")
    usable = (
        sentiment_reasons(predictions.withColumn("text", F.coalesce("text", "evidence_span")))
        .select("id", F.col("label").alias("predicted"), "exact_entity", "source_class", (F.size("reasons") == 0).alias("supported"))
    )
    pairs = gold.select("id", F.col("label").alias("actual")).join(usable, "id", "left")
    published = F.col("predicted").isin(lx.SENTIMENT_LABELS)
    facts = [
        F.count(F.lit(1)).alias("gold_items"),
        F.count_if(_true(published)).alias("published"),
        F.count_if(_true(F.col("predicted") == F.col("actual"))).alias("correct"),
        F.count_if(_true(published & ~_true(F.col("exact_entity")))).alias("wrong_entity"),
        F.count_if(_true(published & F.col("supported"))).alias("supported"),
        F.count_if(_true(published & (F.col("source_class") == "company_owned"))).alias("company_owned"),
    ]
    for name in lx.SENTIMENT_LABELS:
        is_actual, is_predicted = F.col("actual") == name, _true(F.col("predicted") == name)
        facts += [
            F.count_if(is_actual & is_predicted).alias(f"tp_{name}"),
            F.count_if(~is_actual & is_predicted).alias(f"fp_{name}"),
            F.count_if(is_actual).alias(f"support_{name}"),
        ]
    totals = pairs.agg(*facts)

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, top / bottom)

    scores, f1s, active = [], F.lit(0.0), F.lit(0)
    for name in lx.SENTIMENT_LABELS:
        tp, fp, support = F.col(f"tp_{name}"), F.col(f"fp_{name}"), F.col(f"support_{name}")
        precision = F.coalesce(ratio(tp, tp + fp), F.lit(0.0))
        recall = F.coalesce(ratio(tp, support), F.lit(0.0))
        f1 = F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0))
        scores += [precision.alias(f"precision_{name}"), recall.alias(f"recall_{name}"), f1.alias(f"f1_{name}")]
        f1s = f1s + F.when(support > 0, f1).otherwise(0.0)
        active = active + (support > 0).cast("int")
    scored = totals.select(
        "*", *scores,
        ratio(F.col("correct"), F.col("gold_items")).alias("accuracy"),
        F.coalesce(ratio(f1s, active), F.lit(0.0)).alias("macro_f1"),
        ratio(F.col("published"), F.col("gold_items")).alias("coverage"),
        ratio(F.col("published") - F.col("wrong_entity"), F.col("published")).alias("exact_entity_precision"),
        ratio(F.col("supported"), F.col("published")).alias("evidence_support_rate"),
    )
    present = (F.col("support_positive") > 0) & (F.col("support_neutral") > 0) & (F.col("support_negative") > 0)
    gate = (
        (F.col("gold_items") >= minimum_items) & present & (F.col("wrong_entity") == 0) & (F.col("company_owned") == 0)
        & (F.col("macro_f1") >= 0.8) & (F.col("precision_positive") >= 0.9) & (F.col("precision_negative") >= 0.9)
        & (F.col("supported") == F.col("published")) & _true(F.col("coverage") >= 0.5)
    )
    return scored.select(
        "*", present.alias("required_labels_present"), gate.alias("qualification_passed"),
        (gate & (F.col("gold_items") >= 600) & (F.col("support_mixed") > 0)).alias("production_scale_gate_passed"),
    ).drop(*[f"tp_{n}" for n in lx.SENTIMENT_LABELS], *[f"fp_{n}" for n in lx.SENTIMENT_LABELS])


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """Ids that occur more than once; a non-empty result stops an evaluation."""
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


# ---- audits and scores ----


def audit_observations(observations: DataFrame, labels: DataFrame, profiles: DataFrame, minimum_audit: int = 100) -> DataFrame:
    """One row: precision on the audited observations and coverage over all profiles."""
    rated = with_reasons(observations)
    ok = F.size("reasons") == 0
    marks = labels.select("id", F.col("exact_entity").alias("m_entity"), F.col("metric_correct").alias("m_metric"), F.col("sentiment_correct").alias("m_sentiment"))
    published = ok & F.col("m_entity").isNotNull()
    audited = rated.join(marks, "id", "left").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count("m_entity").alias("audited"),
        F.count_if(published).alias("published"),
        F.count_if(published & ~F.col("m_entity")).alias("wrong_entity"),
        F.count_if(published & ~F.col("m_metric")).alias("wrong_metric"),
        F.count_if(published & F.col("sentiment_label").isNotNull()).alias("sentiment_audited"),
        F.count_if(published & F.col("sentiment_label").isNotNull() & F.col("m_sentiment")).alias("sentiment_correct"),
    )
    signal = F.col("signal_type")
    per_org = rated.filter(ok).groupBy("org").agg(
        F.count_distinct("platform").alias("platforms"),
        F.bool_or(signal.isin("job_posting", "workforce_snapshot")).alias("workforce_jobs"),
        F.bool_or(signal.isin("review", "review_summary", "place_summary")).alias("ratings_reviews"),
        F.bool_or(signal.isin("public_post", "public_mention", "profile_metrics")).alias("buzz_engagement"),
        F.bool_or(F.col("sentiment_label").isNotNull()).alias("sentiment"),
    )
    families = ("workforce_jobs", "ratings_reviews", "buzz_engagement", "sentiment")

    def share(test: Column) -> Column:
        return F.count_if(_true(test)) / F.count(F.lit(1))

    coverage = profiles.select("org").distinct().join(per_org, "org", "left").agg(
        F.count(F.lit(1)).alias("profiles"),
        share(F.col("platforms") >= 1).alias("any_external"),
        share(F.col("platforms") >= 2).alias("two_platforms"),
        *[share(F.col(f)).alias(f) for f in families],
    )
    label_count = labels.agg(F.count(F.lit(1)).alias("labels"))
    row = with_totals(with_totals(audited, coverage), label_count)
    entity = F.when(F.col("published") > 0, (F.col("published") - F.col("wrong_entity")) / F.col("published")).otherwise(0.0)
    metric = F.when(F.col("published") > 0, (F.col("published") - F.col("wrong_metric")) / F.col("published")).otherwise(0.0)
    gate = F.col("labels") >= minimum_audit
    return row.select(
        "*",
        entity.alias("entity_precision"),
        metric.alias("metric_precision"),
        F.when(F.col("sentiment_audited") > 0, F.col("sentiment_correct") / F.col("sentiment_audited")).alias("sentiment_accuracy"),
        gate.alias("audit_size_gate"),
        (gate & (F.col("published") > 0) & (F.col("wrong_entity") == 0) & (entity >= 0.995) & (metric >= 0.98)).alias("qualification_passed"),
    )


def observation_counts(observations: DataFrame) -> DataFrame:
    """Counts by platform, by acquisition mode, by signal, by all three together and in all; one scan.

    Rows are first folded to one per entity and combination, so the entities of each set are counted by adding rows up and no
    row is repeated for a distinct count. ``dimension`` names the set; the columns outside it are NULL.
    """
    dims = ["platform", "acquisition_mode", "signal_type"]
    rated = with_reasons(observations).select("org", *dims, (F.size("reasons") == 0).alias("ok"))
    folded = rated.groupBy(*dims, "org").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("good"))
    sets = {"platform": ["platform"], "acquisition_mode": ["acquisition_mode"], "signal_type": ["signal_type"], "combination": dims, "all": []}
    sums = folded.groupingSets([[*names, "org"] for names in sets.values()], *dims, "org").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.grouping_id(*dims, "org").alias("_set"))
    bits = {name: sum(1 << (3 - i) for i, d in enumerate(dims) if d not in names) for name, names in sets.items()}
    dimension = F.coalesce(*[F.when(F.col("_set") == b, F.lit(name)) for name, b in bits.items()])
    counted = sums.groupBy("_set", *dims).agg(
        F.sum("n").alias("observations"), F.sum("good").alias("accepted"), F.count(F.lit(1)).alias("entities"), F.count_if(F.col("good") > 0).alias("accepted_entities")
    )
    return counted.select(dimension.alias("dimension"), *dims, "observations", "accepted", "entities", "accepted_entities")


# The most points each component can earn.
COMPONENT_POINTS = {
    "exact_external_identity": 20.0, "verified_handles": 15.0, "profile_metrics": 10.0, "places_identity": 5.0,
    "places_reviews": 10.0, "workforce_jobs": 10.0, "public_buzz": 10.0, "independent_sentiment": 15.0, "freshness_evidence": 5.0,
}


def development_score(observations: DataFrame, site_verdicts: DataFrame, as_of: str, detail: bool = False) -> DataFrame:
    """Nine capped components per entity, strict and with experimental evidence added.

    ``site_verdicts`` is (org, publishable). With ``detail`` the components with experimental evidence follow as ``x_`` columns.
    """
    rated = with_reasons(observations)
    ok = F.size("reasons") == 0
    experimental = (
        F.col("acquisition_mode").isin(lx.EXPERIMENTAL_MODES) & _true(F.col("exact_entity"))
        & (F.coalesce(F.size("identity_proof"), F.lit(0)) > 0) & ~_blank("content_sha256")
    )
    platform, signal, label = F.col("platform"), F.col("signal_type"), F.col("sentiment_label")
    either = ok | experimental
    groups = {
        "profile_metrics": ["profile_metrics"],
        "places_identity": ["place_summary"],
        "places_reviews": ["review", "review_summary"],
        "workforce_jobs": ["job_posting", "workforce_snapshot"],
        "public_buzz": ["public_post", "public_mention", "buzz_metrics"],
    }
    place = (platform == "google_places") & (signal == "place_summary")
    rating, reviews = _metric("rating").try_cast("double"), _metric("review_count").try_cast("int")
    rated_summary = (signal == "review_summary") & (reviews >= 10) & (rating > 0) & (rating <= 5)
    facts = rated.groupBy("org").agg(
        F.count_if(ok).alias("accepted"),
        F.count_if(experimental).alias("experimental"),
        F.count_distinct(F.when(ok & (signal == "profile_handle"), platform)).alias("handles"),
        F.count_distinct(F.when(either & (signal == "profile_handle"), platform)).alias("x_handles"),
        F.bool_or(_true(ok & (place | ((platform == "wikidata") & (signal == "company_profile"))))).alias("proof"),
        F.bool_or(_true(experimental & (place | ((platform == "company_directory") & (signal == "company_profile"))))).alias("x_proof"),
        *[F.bool_or(ok & signal.isin(names)).alias(f"s_{g}") for g, names in groups.items()],
        *[F.bool_or(either & signal.isin(names)).alias(f"x_{g}") for g, names in groups.items()],
        F.count_if(experimental & label.isNotNull()).alias("x_items"),
        F.count_distinct(F.when(experimental & label.isNotNull(), host(F.col("source_url")))).alias("x_hosts"),
        F.count_distinct(F.when(experimental & label.isNotNull(), F.nullif("reviewer_id", F.lit("")))).alias("x_reviewers"),
        F.bool_or(_true(experimental & rated_summary)).alias("x_summary"),
    )
    sentiment = aggregate_footprint(observations, as_of).select("org", (F.col("sentiment_status") == "available").alias("ready"))
    sites = site_verdicts.groupBy("org").agg(F.bool_or("publishable").alias("site_ok"))
    f = facts.join(sentiment, "org", "left").join(sites, "org", "left")
    identity = F.coalesce("site_ok", F.lit(False)) | F.col("proof")
    x_ready = F.col("x_summary") | ((F.col("x_items") >= 10) & ((F.col("x_hosts") >= 2) | (F.col("x_reviewers") >= 10)))

    def pts(test: Column, name: str) -> Column:
        return F.when(test, COMPONENT_POINTS[name]).otherwise(0.0)

    any_ok, any_row = F.col("accepted") > 0, (F.col("accepted") + F.col("experimental")) > 0
    strict = {
        "exact_external_identity": pts(identity & any_ok, "exact_external_identity"),
        "verified_handles": F.least(F.lit(15.0), F.col("handles") * 5.0),
        **{g: pts(F.col(f"s_{g}"), g) for g in groups},
        "independent_sentiment": pts(F.coalesce("ready", F.lit(False)), "independent_sentiment"),
        "freshness_evidence": pts(any_ok, "freshness_evidence"),
    }
    potential = {
        **strict,
        "exact_external_identity": pts((identity | F.col("x_proof")) & any_row, "exact_external_identity"),
        "verified_handles": F.least(F.lit(15.0), F.col("x_handles") * 5.0),
        **{g: pts(F.col(f"x_{g}"), g) for g in groups},
        "independent_sentiment": pts(x_ready | F.coalesce("ready", F.lit(False)), "independent_sentiment"),
    }
    return f.select(
        "org", "accepted", "experimental",
        *[c.alias(n) for n, c in strict.items()],
        F.round(sum(strict.values(), F.lit(0.0)), 3).alias("score"),
        F.round(sum(potential.values(), F.lit(0.0)), 3).alias("potential_score"),
        *([c.alias(f"x_{n}") for n, c in potential.items()] if detail else []),
    )


# Completeness weights.
FOUNDATION_WEIGHTS = {"official_identity": 5.0, "annual_accounts": 10.0, "roles": 5.0, "locations": 5.0, "website_terminal_state": 5.0}
ENRICHMENT_WEIGHTS = {
    "exact_external_identity": 8.0, "verified_handles": 8.0, "profile_metrics": 8.0, "places_identity": 4.0, "places_reviews": 8.0,
    "workforce_jobs": 8.0, "public_buzz": 8.0, "independent_sentiment": 12.0, "freshness_evidence": 6.0,
}


def completeness(foundation: DataFrame, scores: DataFrame) -> DataFrame:
    """Foundation points plus enrichment points, each enrichment a capped share of its component.

    ``foundation`` is (org, one boolean per foundation weight); ``scores`` comes from
    ``development_score``. A scored entity without a foundation row earns none.
    """
    base = sum((F.when(F.coalesce(F.col(n), F.lit(False)), w).otherwise(0.0) for n, w in FOUNDATION_WEIGHTS.items()), F.lit(0.0))
    parts = {
        n: F.round(w * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(n) / COMPONENT_POINTS[n])), 3) for n, w in ENRICHMENT_WEIGHTS.items()
    }
    joined = scores.join(foundation.select("org", *[F.col(n) for n in FOUNDATION_WEIGHTS]), "org", "left")
    more = []
    if "x_exact_external_identity" in scores.columns:
        wider = [F.round(w * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(f"x_{n}") / COMPONENT_POINTS[n])), 3) for n, w in ENRICHMENT_WEIGHTS.items()]
        more = [F.round(base + sum(wider, F.lit(0.0)), 3).alias("experimental_score")]
    return joined.select(
        "org",
        F.round(base, 3).alias("foundation_score"),
        F.round(base + sum(parts.values(), F.lit(0.0)), 3).alias("completeness_score"),
        *more,
        *[c.alias(f"e_{n}") for n, c in parts.items()],
    )


def summarize_completeness(rows: DataFrame, group: str) -> DataFrame:
    """Means, threshold counts and component coverage per group (base against extension)."""
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("companies"),
        F.round(F.avg("foundation_score"), 3).alias("foundation_mean"),
        F.round(F.avg("completeness_score"), 3).alias("completeness_mean"),
        F.count_if(F.col("completeness_score") >= 50).alias("at_50"),
        F.count_if(F.col("completeness_score") >= 65).alias("at_65"),
        *[F.round(F.count_if(F.col(f"e_{n}") > 0) / F.count(F.lit(1)), 4).alias(f"cover_{n}") for n in ENRICHMENT_WEIGHTS],
    )


def completeness_distribution(rows: DataFrame, group: str, score: str = "completeness_score") -> DataFrame:
    """How many companies have each score, per group and in all (``combined``); one scan."""
    counted = rows.groupBy(group, score).agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupingSets([[group, score], [score]], group, score).agg(F.sum("n").alias("companies"), F.grouping(group).alias("_all"))
    return sums.select(F.when(F.col("_all") == 1, "combined").otherwise(F.col(group)).alias(group), score, "companies")


def completeness_transfer(rows: DataFrame, group: str, base: str, extension: str) -> DataFrame:
    """One row: what an extension of the companies keeps of the base's completeness.

    The deltas and the share are of rounded means, as the summaries show them; the share is NULL where the base's mean is 0. Rows with an
    ``experimental_score`` are compared by it too.
    """
    scores = {"strict": "completeness_score"} | ({"experimental": "experimental_score"} if "experimental_score" in rows.columns else {})
    mean = lambda part, score: F.coalesce(F.round(F.avg(F.when(F.col(group) == part, F.col(score))), 3), F.lit(0.0))
    row = rows.agg(*[mean(part, score).alias(f"{name}_{kind}_mean") for name, score in scores.items() for kind, part in (("base", base), ("extension", extension))])
    deltas = [F.round(F.col(f"{name}_extension_mean") - F.col(f"{name}_base_mean"), 3).alias(f"{name}_mean_delta") for name in scores]
    kept = F.when(F.col("strict_base_mean") != 0, F.round(F.col("strict_extension_mean") / F.col("strict_base_mean"), 4))
    return row.select("*", *deltas, kept.alias("strict_retention"))


def weighted_rubric(facts: DataFrame) -> DataFrame:
    """Capped points by category and hard gates from one row of measured facts."""

    def capped(weight: float, value: Column) -> Column:
        return F.round(weight * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value, F.lit(0.0)))), 3)

    ok = F.col("qualification_passed")
    zero_wrong = (F.col("wrong_entity") == 0) & (F.col("published") > 0)
    external = (
        F.when(ok & zero_wrong, 10.0).otherwise(0.0)
        + F.when(ok, capped(10, F.col("two_platforms")) + capped(7, F.col("workforce_jobs")) + capped(8, F.col("ratings_reviews"))
                 + capped(7, F.col("buzz_engagement")) + capped(3, F.col("fresh_coverage"))).otherwise(0.0)
        + F.when(F.col("sentiment_passed"), capped(10, F.col("sentiment"))).otherwise(0.0)
    )
    foundation = (
        capped(4, F.col("exact_registry")) + capped(4, F.col("financial_share")) + capped(4, F.col("roles_locations_share"))
        + capped(3, F.col("website_terminal_share"))
    )
    research = F.least(F.lit(10.0), F.least(F.lit(12.0), F.col("research_score")) * 10 / 12)
    research = F.round(F.when(F.col("external_qa_passed"), research).otherwise(F.least(F.lit(5.0), research)), 3)
    extensibility = (
        F.when(F.col("batch_valid"), 4.0).otherwise(0.0) + F.when(F.col("resume_valid"), 2.0).otherwise(0.0)
        + F.when(F.col("refresh_valid"), 3.0).otherwise(0.0)
        + F.when(F.col("batch_valid") & _true(F.col("p95_ms") <= 10_000), 1.0).otherwise(0.0)
        + F.when(F.col("connector_policy"), 2.0).otherwise(0.0)
    )
    raw = F.round(F.round(external, 3) + F.round(foundation, 3) + research + extensibility, 3)
    gates = (
        F.col("audit_size_gate") & zero_wrong & F.col("connector_policy") & (F.col("exact_registry") == 1.0)
        & F.col("batch_valid") & F.col("refresh_valid")
    )
    return facts.select(
        F.round(external, 3).alias("external_points"), F.round(foundation, 3).alias("foundation_points"),
        research.alias("research_points"), extensibility.alias("extensibility_points"),
        raw.alias("raw_score"), gates.alias("qualification_passed"), F.when(gates, raw).otherwise(0.0).alias("awardable_score"),
    )


def gate_rejections(profiles: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(org, name, url, reasons) of sites that were read and that the identity gate refuses.

    ``verdicts`` is (org, site_url, publishable, reasons); entities without a site have no verdict.
    """
    refused = verdicts.filter("site_url IS NOT NULL AND NOT coalesce(publishable, FALSE)")
    return refused.join(profiles.select("org", "name"), "org", "left").select("org", "name", F.col("site_url").alias("url"), "reasons")


def site_gate_counts(verdicts: DataFrame) -> DataFrame:
    """One row: sites the common gate accepts, those whose content counts, those it refuses, and refusals by first reason."""
    read, ok = F.col("site_url").isNotNull(), F.coalesce("publishable", F.lit(False))
    return verdicts.agg(
        F.count_if(read & ok).alias("common_gate_websites"), F.count_if(read & ok & F.coalesce("content_attributable", F.lit(False))).alias("common_gate_content_sites"),
        F.count_if(read & ~ok).alias("common_gate_rejections"),
    )


def evidence_audit(observations: DataFrame, site_verdicts: DataFrame, as_of: str) -> DataFrame:
    """One row of company counts by signal family under one strict rule set.

    ``site_verdicts`` is (org, content_attributable); site-derived observations of
    an entity whose site is not attributable do not count.
    """
    rights = (
        (F.col("exact_entity")) & (F.col("rights_status") == "approved") & (F.coalesce(F.size("identity_proof"), F.lit(0)) > 0)
        & (F.length("content_sha256") == 64) & ~_blank("source_url") & F.col("retrieved_at").isNotNull()
    )
    platform, signal = F.col("platform"), F.col("signal_type")
    first_party_news = (platform == "news") & F.coalesce(F.col("source_class").startswith("company_"), F.lit(False))
    from_site = (platform == "company_site") | first_party_news | (signal == "profile_handle") | _true(F.col("source_class") == "company_careers")
    sites = site_verdicts.groupBy("org").agg(F.bool_or("content_attributable").alias("own_site"))
    qualified = observations.join(sites, "org", "left").filter(_true(rights) & (~from_site | F.coalesce("own_site", F.lit(False))))
    kept = undisputed(qualified).withColumns({"direct": direct_job(), "active": active_job(as_of)})
    news = platform.isin("company_site", "news") & signal.isin("public_post", "public_mention")
    families = {
        "social": signal == "profile_handle",
        "dated_news": news & published_moment(observations).isNotNull(),
        "direct_jobs": (signal == "job_posting") & F.col("direct"),
        "active_jobs": (signal == "job_posting") & F.col("active"),
        "reviews": signal.isin("review", "review_summary", "place_summary") & (_metric("rating").isNotNull() | _metric("review_count").isNotNull()),
        "workforce": signal == "workforce_snapshot",
        "sentiment": F.col("sentiment_label").isNotNull() & F.col("source_class").isin(lx.INDEPENDENT_OBSERVATION_CLASSES)
        & F.col("sentiment_model_version").isNotNull(),
    }
    per_org = kept.groupBy("org").agg(
        F.count_distinct(F.when(platform != "brreg", platform)).alias("sources"),
        *[F.count_if(_true(test)).alias(name) for name, test in families.items()],
    )
    counted = per_org.agg(
        *[F.count_if(F.col(name) > 0).alias(f"companies_with_{name}") for name in families],
        F.count_if(F.col("sources") >= 2).alias("companies_with_two_sources"),
        F.coalesce(F.sum("dated_news"), F.lit(0)).alias("dated_news_items"),
    )
    misclassified = observations.agg(F.count_if(_true((signal == "job_posting") & ~direct_job())).alias("misclassified_job_items"))
    disputes = cross_company_disputes(qualified).agg(F.count(F.lit(1)).alias("disputed_urls"))
    return with_totals(with_totals(counted, misclassified), disputes)


# ---- unions ----


def union_observations(*sources: DataFrame) -> DataFrame:
    """Union by name; for an id in several sources the later source wins."""
    merged = None
    for turn, source in enumerate(sources):
        tagged = source.withColumn("_turn", F.lit(turn))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    carried = [c for c in merged.columns if c not in ("id", "_turn")]
    best = merged.groupBy("id").agg(F.max_by(F.struct(*carried), F.col("_turn")).alias("row"))
    return best.select("id", "row.*")


# ---- claims → observations ----

# Observation families made from claims.
CLAIM_FAMILIES = [
    ("website", "company_site", "company_profile", "company_site"),
    ("hiring_or_activity_signal", "company_site", "profile_metrics", "company_site"),
    ("ratings_and_reviews", "google_places", "place_summary", "customer_review"),
    ("job_posting", "job_board", "job_posting", "licensed_news"),
    ("buzz_or_engagement", "youtube", "profile_metrics", "company_site"),
    ("news_mention", "news", "public_mention", "public_news"),
]


def claims_to_observations(claims: DataFrame, links: DataFrame, evidence: DataFrame, families=None) -> DataFrame:
    """Available claims as observations, numbered per family; dropped without a real hash or address.

    ``value`` is JSON text.
    """
    from pyspark.sql import Window as W

    families = families or CLAIM_FAMILIES
    spec = claims.sparkSession.createDataFrame(
        families, "field string, platform string, signal_type string, source_class string"
    )
    ranked = (
        claims.filter(F.col("availability") == "available")
        .join(F.broadcast(spec), "field")
        .withColumn("place", F.row_number().over(W.partitionBy("org", "field").orderBy("first_pos")))
    )
    hashed = evidence.filter(F.col("content_sha256").rlike("^[0-9a-fA-F]{64}$")).select(
        F.col("id").alias("evidence_id"), F.col("source_url").alias("ev_url"), "content_sha256"
    )
    first = (
        links.join(hashed, "evidence_id")
        .groupBy("org", "claim_key")
        .agg(F.min_by(F.struct("ev_url", "content_sha256"), "first_cited").alias("ev"))
    )
    own_url = F.coalesce(F.get_json_object("value", "$.url"), F.when(F.col("value").rlike("^[a-z]+://"), F.col("value")))
    stars = F.get_json_object("value", "$.rating").try_cast("double")
    polarity = F.when(stars >= 3.8, "positive").when(stars <= 2.2, "negative").when(stars.isNotNull(), "neutral")
    label = F.when(F.col("field") == "ratings_and_reviews", polarity).when(
        F.col("field") == "news_mention", F.get_json_object("value", "$.sentiment")
    )
    url = F.coalesce(own_url, "ev.ev_url")
    suffix = F.when(F.col("place") > 1, F.concat(F.lit("-"), (F.col("place") - 1).cast("string"))).otherwise("")
    return (
        ranked.join(first, ["org", "claim_key"])
        .filter(F.contains(url, F.lit("://")))
        .select(
            F.concat(F.lit("obs-"), "platform", F.lit("-"), "signal_type", F.lit("-"), "org", suffix).alias("id"),
            "org", "platform", "signal_type", url.alias("source_url"), F.col("ev.content_sha256").alias("content_sha256"),
            "source_class", label.alias("sentiment_label"), F.col("value").alias("metrics"),
        )
    )
