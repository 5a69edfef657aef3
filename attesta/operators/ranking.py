"""Ranking, allocation and capped lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta import lexicon as lx
from attesta.functions.text import lead_words
from attesta.operators.ordering import nearest_rank, number_within, with_totals
from attesta.operators.register import dormant_name


def origin_prior(origin: Column, rank: Column) -> Column:
    """Prior of a lead from its origin, lower for later guesses, never under 0.05."""
    prior = F.coalesce(*[F.when(origin == name, F.lit(p)) for name, p in lx.ORIGIN_PRIOR.items()], F.lit(0.4))
    return F.round(F.greatest(F.lit(0.05), prior - 0.03 * F.greatest(F.lit(0), rank - 1)), 4)


def rank_candidates(candidates: DataFrame, probability: str | None = None) -> DataFrame:
    """Position of every lead per entity: authoritative origins, then probability, then rank.

    ``probability`` names a column with the model's answer; where it is NULL, or for
    authoritative origins, the prior of the origin counts.
    """
    authoritative = F.col("origin").isin(lx.AUTHORITATIVE_ORIGINS)
    prior = origin_prior(F.col("origin"), F.col("rank"))
    scored = F.when(~authoritative, F.col(probability)) if probability else F.lit(None).cast("double")
    rated = candidates.withColumns(
        {
            "probability": F.coalesce(F.round(scored, 4), prior),
            "scored_by": F.when(scored.isNotNull(), "model").otherwise("heuristic"),
            "_guess": (~authoritative).cast("int"),
        }
    )
    order = ["_guess", F.col("probability").desc(), "rank", "url"]
    return number_within(rated, ["org"], order, "place").drop("_guess")


def revenue_comparison(records: DataFrame) -> DataFrame:
    """Latest revenue against the prior period of the same account type, or why it is withheld."""
    valid = records.filter(F.col("revenue").isNotNull())
    fields = F.struct("period_from", "period_to", "currency", "revenue", "account_type")
    own = F.coalesce(F.upper("account_type") != "KONSERN", F.lit(True))
    newest = F.struct("period_to", own.alias("own"), "record_id")
    latest = valid.groupBy("org").agg(F.max_by(fields, newest).alias("l"))
    earlier = valid.join(latest, "org").filter(
        (F.col("account_type") == F.col("l.account_type")) & (F.col("period_to") < F.col("l.period_to"))
    )
    prior = earlier.groupBy("org").agg(F.max_by(fields, newest).alias("p"))
    both = latest.join(prior, "org", "left")

    def days(side: str) -> Column:
        return F.datediff(F.col(f"{side}.period_to"), F.col(f"{side}.period_from")) + 1

    years = F.year("l.period_to") == F.year("p.period_to") + 1
    whole = (F.abs(days("l") - days("p")) <= 31) & (F.col("l.period_from") > F.col("p.period_to"))
    dated = F.col("l.period_from").isNotNull() & F.col("p.period_from").isNotNull()
    comparable = F.coalesce(years & F.when(dated, whole).otherwise(True), F.lit(False))
    state = (
        F.when(F.col("p").isNull(), "no_prior_year")
        .when(~comparable, "periods_not_comparable")
        .when(F.col("l.currency") != F.col("p.currency"), "currency_changed")
        .when(F.col("p.revenue") == 0, "prior_is_zero")
        .otherwise("compared")
    )
    change = (F.col("l.revenue") - F.col("p.revenue")) / F.abs("p.revenue") * 100
    return both.select(
        "org", state.alias("state"), F.col("l.period_to").alias("latest_period_end"), F.col("p.period_to").alias("prior_period_end"),
        F.col("l.revenue").alias("latest_revenue"),
        F.when(state == "compared", F.col("p.revenue")).alias("prior_revenue"),
        F.when(state == "compared", F.bround(change, 1)).alias("change_pct"),
    )


def search_readiness() -> Column:
    """Register completeness, 0 to 100; spending starts at 75."""
    def filled(name: str) -> Column:
        return F.length(F.trim(F.coalesce(F.col(name), F.lit("")))) > 0

    adverse = F.coalesce(F.col("bankrupt"), F.lit(False)) | F.coalesce(F.col("liquidating"), F.lit(False))
    return (
        F.when(F.length(F.trim(F.coalesce("name", F.lit("")))) >= 4, 30).otherwise(0)
        + F.when(filled("address"), 20).otherwise(0)
        + F.when(F.length(F.coalesce("postcode", F.lit(""))) == 4, 10).otherwise(0)
        + F.when(~adverse, 20).otherwise(0)
        + F.when(F.col("org").rlike("^[0-9]{9}$"), 20).otherwise(0)
    )


def search_potential() -> Column:
    """How much a search may find: staff, revenue, sites and operating names, less dormant names."""
    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    staff = F.floor(F.coalesce("employees", F.lit(0)) / 2).cast("int")
    score = (
        F.least(F.lit(30), staff) + F.when(F.coalesce("revenue", F.lit(0.0)) > 0, 25).otherwise(0)
        + F.when(F.length(F.coalesce("website", F.lit(""))) > 0, 15).otherwise(0)
        + F.when(flag("own_site"), 15).otherwise(0) + F.when(flag("has_operating_names"), 15).otherwise(0)
        - F.when(dormant_name(), 20).otherwise(0)
    )
    return F.greatest(F.lit(0), score)


def allocate_credits(profiles: DataFrame, limit: int, per_company: int = 2) -> DataFrame:
    """Credits per entity, best first until ``limit`` is spent; everyone else gets zero.

    Every entity that gets anything but the last gets the same amount, so an entity's
    place among the ready ones decides.
    """
    rated = profiles.withColumns({"readiness": search_readiness(), "priority": search_potential()})
    if limit <= 0 or per_company <= 0:
        return rated.select("org", "readiness", "priority", F.lit(0).alias("credits"))
    best = [F.col("priority").desc(), F.col("readiness").desc(), F.col("org")]
    placed = number_within(rated.filter(F.col("readiness") >= 75).select("org", "readiness", "priority"), [], best, "place")
    paid = placed.select("org", F.least(F.lit(per_company), F.lit(limit) - (F.col("place") - 1) * per_company).alias("credits")).filter("credits > 0")
    return rated.join(paid, "org", "left").select("org", "readiness", "priority", F.coalesce("credits", F.lit(0)).alias("credits"))


def allocate_grants(profiles: DataFrame, cap: int, tier: str = "tier") -> DataFrame:
    """Grant per tier; over-subscription scales every grant down, never below one."""
    base = F.coalesce(*[F.when(F.col(tier) == name, F.lit(g)) for name, g in lx.TIER_GRANTS.items()], F.lit(lx.TIER_GRANTS["standard"]))
    granted = profiles.withColumn("base_grant", base)
    planned = granted.agg(F.sum("base_grant").alias("planned"))
    scaled = F.greatest(F.lit(1), F.floor(F.col("base_grant") * (F.lit(cap) / F.col("planned"))))
    over = F.col("planned") > cap
    return with_totals(granted, planned).select(
        "org", tier, F.when(over, scaled).otherwise(F.col("base_grant")).cast("int").alias("granted"),
        F.when(over, 0).otherwise(F.lit(cap) - F.col("planned")).alias("reserve"),
    )


def cap_candidates(matches: DataFrame, per_org: int = 15, total: int = 250) -> DataFrame:
    """(ad, org, modified): the newest ``per_org`` ads per entity, then the newest ``total`` ads.

    An ad counts once against the total however many entities it may belong to.
    Both caps prune inside each task before any shuffle.
    """
    newest = W.partitionBy("org").orderBy(F.col("modified").desc(), "ad")
    kept = matches.withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= per_org)
    ads = kept.groupBy("ad").agg(F.max("modified").alias("_m")).orderBy(F.col("_m").desc(), "ad").limit(total)
    return kept.join(ads.select("ad"), "ad", "left_semi")


FAMILIES = ["career", "news", "contact"]


def crawl_queue(links: DataFrame, cap: int) -> DataFrame:
    """(org, url, family, harvested, pos) → the first ``cap`` addresses per entity.

    Families take turns; found links come before guessed ones; an address queued once
    is not queued again; other links come last. Spellings of one address fold before
    ranks are given, so a family's first ``cap`` ranks hold all it can add.
    """
    turn = F.when(F.col("family") == "career", 0).when(F.col("family") == "news", 1).when(F.col("family") == "contact", 2).otherwise(3)
    key = F.lower(F.regexp_replace(F.substring_index("url", "#", 1), "/+$", ""))
    earliest = F.struct((~F.col("harvested")).cast("int").alias("guess"), "pos", "url")
    folded = links.groupBy("org", "family", key.alias("_key")).agg(F.min(earliest).alias("_first")).select("org", "family", "_key", "_first", "_first.url")
    in_family = W.partitionBy("org", "family").orderBy("_first", "_key")
    ranked = folded.withColumn("_rank", F.row_number().over(in_family)).filter(F.col("_rank") <= cap)
    order = F.struct((turn == 3).cast("int").alias("late"), F.col("_rank").alias("rank"), turn.alias("turn"))
    unique = ranked.groupBy("org", "_key").agg(F.min_by(F.struct("url", "family"), order).alias("x"), F.min(order).alias("_order"))
    place = F.row_number().over(W.partitionBy("org").orderBy("_order", "_key"))
    return unique.withColumn("place", place).filter(F.col("place") <= cap).select("org", "place", "x.url", "x.family")


def operating_names(profiles: DataFrame, subunits: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` distinct subunit names with most staff that are not the parent's own name."""
    def key(column: Column) -> Column:
        return F.array_join(lead_words(column), " ")

    parents = profiles.select("org", key(F.col("name")).alias("_own"))
    units = subunits.select(
        F.col("parent_org").alias("org"), F.trim(F.regexp_replace("name", r"\s+", " ")).alias("name"),
        F.coalesce(F.col("employees").cast("int"), F.lit(0)).alias("employees"), key(F.col("name")).alias("_key"),
    ).filter(F.length("_key") >= 4)
    named = units.groupBy("org", "_key").agg(F.max_by("name", F.struct("employees", "name")).alias("name"), F.max("employees").alias("employees"))
    other = named.join(parents, "org").filter(F.col("_key") != F.col("_own"))
    place = F.row_number().over(W.partitionBy("org").orderBy(F.col("employees").desc(), "_key"))
    return other.withColumn("place", place).filter(F.col("place") <= keep).select("org", "place", "name", "employees")


def limit_news(items: DataFrame, keep: int) -> DataFrame:
    """(org, pos, title): repeated titles dropped ignoring case, then the first ``keep`` per entity."""
    carried = [c for c in items.columns if c not in ("org", "pos")]
    first = items.groupBy("org", F.lower(F.trim("title")).alias("_title")).agg(
        F.min("pos").alias("pos"), F.min_by(F.struct(*carried), "pos").alias("row")
    )
    place = F.row_number().over(W.partitionBy("org").orderBy("pos"))
    return first.withColumn("place", place).filter(F.col("place") <= keep).select("org", "pos", "place", "row.*")


def prefer_dated_articles(items: DataFrame, keep: int) -> DataFrame:
    """(org, pos, url, published, modified): dated items first and newest first, originals before
    English copies, one per article key, ``keep`` per entity."""
    from attesta.functions.urls import url_path

    path = F.regexp_replace(url_path(F.col("url")), "/+$", "")
    key = F.when(path.rlike("^/(?:no|en)/"), F.regexp_extract(path, "([^/]*)$", 1)).otherwise(path)
    dated = F.col("published") != ""
    order = F.struct(
        (~dated).alias("undated"),
        F.negate(F.coalesce(F.unix_date(F.nullif(F.when(dated, F.col("published")).otherwise(F.col("modified")), F.lit("")).try_cast("date")), F.lit(0))).alias("age"),
        url_path(F.col("url")).startswith("/en/").alias("english"),
        F.col("pos"),
    )
    carried = [c for c in items.columns if c != "org"]
    best = items.groupBy("org", key.alias("_article")).agg(F.min_by(F.struct(*carried), order).alias("row"), F.min(order).alias("_order"))
    place = F.row_number().over(W.partitionBy("org").orderBy("_order"))
    return best.withColumn("place", place).filter(F.col("place") <= keep).select("org", "place", "row.*")


def rank_strategies(log: DataFrame, strategies: list[str] | None = None) -> DataFrame:
    """Strategies by mean gain plus an exploration bonus; never tried ones keep the full bonus."""
    strategies = strategies or lx.STRATEGIES
    gain = F.coalesce(F.nullif("learning_gain", F.lit(0.0)), F.nullif("score_delta", F.lit(0.0)), F.lit(0.0))
    seen = log.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("prior_runs"), F.count_if(gain > 0).alias("prior_successes"), F.avg(gain).alias("mean_gain")
    )
    listed = log.sparkSession.createDataFrame([(s, i) for i, s in enumerate(strategies)], "strategy string, listed int")
    total = log.agg(F.greatest(F.lit(1), F.count(F.lit(1))).alias("total"))
    rated = with_totals(listed.join(seen, "strategy", "left"), total)
    runs, mean = F.coalesce("prior_runs", F.lit(0)), F.coalesce("mean_gain", F.lit(0.0))
    priority = mean + 0.35 * F.sqrt(F.log(F.col("total") + 1) / (runs + 1))
    scored = rated.select("strategy", "listed", runs.alias("prior_runs"), F.coalesce("prior_successes", F.lit(0)).alias("prior_successes"),
                          F.round(mean, 3).alias("mean_gain"), priority.alias("priority"))
    # The strategy list is fixed, so one small window orders it.
    return scored.withColumn("place", F.row_number().over(W.orderBy(F.col("priority").desc(), "listed"))).drop("listed")


def latency_summary(measurements: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Nearest-rank p50 and p95, the maximum and the count."""
    found = nearest_rank(measurements, keys or [], value, {"p50": 0.50, "p95": 0.95})
    rounded = [F.round(c, 3).alias(c) for c in ("p50", "p95", "maximum")]
    return found.select(*(keys or []), "n", *rounded)


def domain_fairness(requests: DataFrame, domain: Column) -> DataFrame:
    """How evenly requests spread over domains."""
    per_domain = requests.groupBy(domain.alias("domain")).agg(F.count(F.lit(1)).alias("requests"))
    found = nearest_rank(per_domain, [], "requests", {"p50_requests": 0.50, "p95_requests": 0.95})
    return found.select(F.col("n").alias("domains"), "p50_requests", "p95_requests", F.col("maximum").alias("max_requests"))
