"""Comparisons of snapshots, observations, envelopes and stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions.urls import canonical_url
from attesta.operators.ordering import with_totals

CARRIED = ["source_url", "retrieved_at", "effective_at", "content_sha256", "status"]


def unpivot_fields(profiles: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Wide rows → (org, field, value) with values as canonical text; NULL stays NULL."""
    carried = [c for c in CARRIED if c in profiles.columns]
    pairs = [F.struct(F.lit(name).alias("field"), column.cast("string").alias("value")) for name, column in fields.items()]
    return profiles.select("org", *carried, F.explode(F.array(*pairs)).alias("x")).select("org", "x.field", "x.value", *carried)


def membership_difference(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Entities in one snapshot only."""
    both = previous.select("org", F.lit(False).alias("new")).unionAll(current.select("org", F.lit(True).alias("new")))
    seen = both.groupBy("org").agg(F.bool_or("new").alias("new"), F.bool_or(~F.col("new")).alias("old"))
    return seen.filter("old <> new").select("org", F.when(F.col("old"), "previous_only").otherwise("current_only").alias("side"))


def require_same_membership(previous: DataFrame, current: DataFrame) -> None:
    """Stop the job when the snapshots cover different entities."""
    odd = membership_difference(previous, current).limit(3).collect()
    if odd:
        raise ValueError("snapshots cover different entities: " + ", ".join(f"{r['org']} ({r['side']})" for r in odd))


def diff_snapshots(previous: DataFrame, current: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Changed (org, field) rows of two long snapshots, NULL-safe: NULL → 0 is a change.

    Both sides are (org, field, value, …evidence columns). The caller checks
    membership first; the join itself keeps fields present on one side only. Without
    ``fields`` the tracked ones are compared, with an empty list all.
    """
    fields = lx.TRACKED_FIELDS if fields is None else fields
    wanted = F.col("field").isin(fields) if fields else F.lit(True)

    def side(df: DataFrame, mark: str) -> DataFrame:
        have = [c for c in CARRIED if c in df.columns]
        return df.filter(wanted).select("org", "field", F.col("value").alias(f"{mark}_value"), *[F.col(c).alias(f"{mark}_{c}") for c in have])

    joined = side(previous, "old").join(side(current, "new"), ["org", "field"], "full")
    changed = joined.filter(~F.col("old_value").eqNullSafe(F.col("new_value")))
    out = ["org", "field", "old_value", "new_value"]
    for name in CARRIED:
        if f"new_{name}" in changed.columns:
            if name == "content_sha256":
                out += [F.col("old_content_sha256"), F.col("new_content_sha256")]
            else:
                out.append(F.col(f"new_{name}").alias(name))
    return changed.select(*out)


def observation_key() -> Column:
    review = F.when(F.col("signal_type") == "review", F.concat(F.lit("|"), "id")).otherwise("")
    return F.concat(F.concat_ws("|", "platform", "signal_type", canonical_url(F.col("source_url"))), review)


def stable_metrics(metrics: Column) -> Column:
    """Metrics as sorted JSON text without the keys that change on every fetch."""
    pairs = F.from_json(metrics, "map<string,string>")
    kept = F.map_filter(F.coalesce(pairs, F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(lx.VOLATILE_METRICS))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def _comparable(observations: DataFrame) -> DataFrame:
    """One row per observation key: the last one among those allowed to count."""
    usable = observations.filter(F.col("exact_entity") & (F.col("rights_status") == "approved"))
    value = F.to_json(
        F.struct(stable_metrics(F.col("metrics")).alias("metrics"), F.col("published_at").cast("string").alias("published_at"), "sentiment_label"),
        {"ignoreNullFields": "false"},
    )
    return (
        usable.withColumns({"observation_key": observation_key(), "_value": value})
        .groupBy("org", "observation_key")
        .agg(F.max_by(F.struct("_value", "signal_type", "source_url", "content_sha256", "retrieved_at"), F.struct("retrieved_at", "id")).alias("o"))
    )


def diff_observations(previous: DataFrame, current: DataFrame) -> DataFrame:
    """New evidence and changed metrics; an observation missing from ``current`` is not a change."""
    old = _comparable(previous).select("org", "observation_key", F.col("o._value").alias("old_value"), F.col("o.content_sha256").alias("old_content_sha256"))
    new = _comparable(current).select("org", "observation_key", "o.*").withColumnRenamed("_value", "new_value")
    joined = new.join(old, ["org", "observation_key"], "left")
    kind = F.when(F.col("old_value").isNull(), "new_evidence").otherwise("metric_changed")
    return joined.filter(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(
        "org", F.concat(F.lit("external_footprint."), "signal_type").alias("field"), kind.alias("change_kind"), "observation_key",
        "old_value", "new_value", "source_url", "retrieved_at", "old_content_sha256", F.col("content_sha256").alias("new_content_sha256"),
    )


# Contract fields a refresh compares, and those with several values.
REFRESH_FIELDS = [
    "legal_name", "legal_form", "registered_business_address", "industry", "bankruptcy_or_liquidation_status",
    "accounting_obligation_status", "latest_annual_revenue", "latest_annual_result", "latest_total_assets", "latest_equity",
    "leadership_role", "registered_workplace", "corporate_group_structure", "official_website", "hiring_or_activity_signal",
    "dated_public_activity",
]
MULTI_VALUED = ["leadership_role", "registered_workplace"]


def _single_values(claims: DataFrame, fields: list[str], out: str) -> DataFrame:
    chosen = claims.filter(F.col("field").isin(fields))
    return chosen.groupBy("org", "field").agg(F.max_by("value", "pos").alias(out))


def diff_envelopes(previous: DataFrame, current: DataFrame, fields: list[str] | None = None, multi: list[str] | None = None) -> DataFrame:
    """Changed contract fields of entities both envelopes cover.

    Single-valued fields compare their last value. Several-valued fields compare as
    multisets: value counts are joined, so no entity's values meet in one list.
    """
    multi = MULTI_VALUED if multi is None else multi
    single = [f for f in (fields or REFRESH_FIELDS) if f not in multi]
    shared = previous.select("org").distinct().join(current.select("org").distinct(), "org")
    old, new = previous.join(shared, "org", "left_semi"), current.join(shared, "org", "left_semi")
    one = _single_values(old, single, "old_value").join(_single_values(new, single, "new_value"), ["org", "field"], "full")
    one = one.filter(~F.col("old_value").eqNullSafe(F.col("new_value"))).select(
        "org", "field", "old_value", "new_value", F.lit(None).cast("long").alias("added"), F.lit(None).cast("long").alias("removed")
    )

    def counts(df: DataFrame, out: str) -> DataFrame:
        return df.filter(F.col("field").isin(multi)).groupBy("org", "field", F.coalesce("value", F.lit("")).alias("value")).agg(F.count(F.lit(1)).alias(out))

    both = counts(old, "o").join(counts(new, "n"), ["org", "field", "value"], "full").fillna(0, ["o", "n"])
    many = both.filter(F.col("o") != F.col("n")).groupBy("org", "field").agg(
        F.sum(F.greatest(F.lit(0), F.col("n") - F.col("o"))).alias("added"), F.sum(F.greatest(F.lit(0), F.col("o") - F.col("n"))).alias("removed")
    )
    none = F.lit(None).cast("string")
    return one.unionByName(many.select("org", "field", none.alias("old_value"), none.alias("new_value"), "added", "removed"))


def score_changes(expected: DataFrame, observed: DataFrame, rerun: DataFrame | None = None) -> DataFrame:
    """One row: hits, misses, precision, recall, evidence completeness and idempotence.

    ``rerun`` is the diff of a snapshot with itself, which must be empty.
    """
    want = expected.select("org", "field").distinct().withColumn("_want", F.lit(True))
    got = observed.select("org", "field").distinct().withColumn("_got", F.lit(True))
    met = want.join(got, ["org", "field"], "full").agg(
        F.count_if(F.col("_want") & F.col("_got")).alias("true_positive"),
        F.count_if(F.col("_want").isNull()).alias("false_positive"),
        F.count_if(F.col("_got").isNull()).alias("false_negative"),
    )
    proof = [c for c in ("source_url", "retrieved_at", "effective_at", "old_content_sha256", "new_content_sha256") if c in observed.columns]
    full = F.lit(True)
    for name in proof:
        full = full & F.col(name).isNotNull()
    complete = observed.agg(F.count(F.lit(1)).alias("observed"), F.coalesce(F.bool_and(full), F.lit(True)).alias("evidence_complete"))
    row = with_totals(met, complete)
    row = with_totals(row, rerun.agg((F.count(F.lit(1)) == 0).alias("idempotent"))) if rerun is not None else row.withColumn("idempotent", F.lit(None).cast("boolean"))

    def share(other: str) -> Column:
        total = F.col("true_positive") + F.col(other)
        return F.when(total > 0, F.col("true_positive") / total).otherwise(1.0)

    precision, recall = share("false_positive"), share("false_negative")
    passed = (precision >= 0.95) & (recall >= 0.95) & F.col("evidence_complete") & F.coalesce("idempotent", F.lit(True))
    return row.select("*", precision.alias("precision"), recall.alias("recall"), passed.alias("qualification_passed"))


def reextract_accounts(stored: DataFrame, fresh: DataFrame, order: str = "place") -> DataFrame:
    """Per entity: what normalising the stored bytes again would change.

    Both sides are normalised records (org, place, record_id, account_type,
    period_to, revenue); a handful per entity, so the joins are on (org, place).
    """
    text = F.to_json(F.struct("record_id", "account_type", F.col("period_to").cast("string").alias("period_to"), "revenue"))
    old = stored.select("org", order, text.alias("old"), F.col("period_to").alias("old_period"), F.col("account_type").alias("old_type"))
    new = fresh.select("org", order, text.alias("new"), F.col("period_to").alias("new_period"), F.col("account_type").alias("new_type"))
    first = F.col(order) == 1
    next_up = stored.select("org", (F.col(order) - 1).alias(order), F.col("period_to").alias("later_period"))
    joined = old.join(new, ["org", order], "full").join(next_up, ["org", order], "left")
    return joined.groupBy("org").agg(
        F.bool_or(~F.col("old").eqNullSafe(F.col("new"))).alias("changed"),
        F.bool_or(F.coalesce(first & (F.col("old_period") != F.col("new_period")), F.lit(False))).alias("latest_period_corrected"),
        F.bool_or(F.coalesce(first & (F.col("old_type") == "KONSERN") & (F.col("new_type") == "SELSKAP"), F.lit(False))).alias("scope_corrected"),
        F.bool_or(F.coalesce(F.col("old_period") < F.col("later_period"), F.lit(False))).alias("chronology_error"),
    )


def reextract_report(changes: DataFrame) -> DataFrame:
    flags = ("changed", "latest_period_corrected", "scope_corrected", "chronology_error")
    return changes.agg(F.count(F.lit(1)).alias("profiles"), *[F.count_if(F.col(f)).alias(f) for f in flags])
