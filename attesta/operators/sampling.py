"""Samples that depend on hashes only, never on input order or a seeded stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.functions.ids import seeded_rank
from attesta.functions.urls import host
from attesta.operators.ordering import number_by_hash, with_totals


def employee_band(staff: Column) -> Column:
    """Bands of a reported count; an unknown count is its own band, not zero."""
    return (
        F.when(staff.isNull(), "missing").when(staff == 0, "0").when(staff < 5, "1-4").when(staff < 20, "5-19")
        .when(staff < 100, "20-99").otherwise("100+")
    )


def stratum() -> Column:
    form = F.when(F.col("legal_form").isin("AS", "ASA", "ENK"), F.col("legal_form")).otherwise("OTHER")
    adverse = F.coalesce(F.col("bankrupt"), F.lit(False)) | F.coalesce(F.col("liquidating"), F.lit(False))
    return F.concat_ws(
        "|", form, employee_band(F.col("employees")), F.when(adverse, "adverse").otherwise("active"), _web(),
    )


def _web() -> Column:
    return F.when(F.length(F.coalesce("website", F.lit(""))) > 0, "web").otherwise("no-web")


def filer_stratum() -> Column:
    """Finer reporting stratum: form, band, industry division, county, web."""
    form = F.coalesce(F.nullif("legal_form", F.lit("")), F.lit("missing"))
    division = F.substring_index(F.coalesce(F.nullif("industry_code", F.lit("")), F.lit("missing")), ".", 1)
    county = F.substring(F.coalesce(F.nullif("municipality_number", F.lit("")), F.lit("missing")), 1, 2)
    return F.concat_ws("|", form, employee_band(F.col("employees")), division, county, _web())


def hash_sample(
    rows: DataFrame, count: int, seed: int, exclude: DataFrame | None = None, preserve: DataFrame | None = None
) -> DataFrame:
    """``count`` rows by seeded hash; preserved entities first, excluded ones never.

    The limit over an order keeps only ``count`` rows per task, whatever the table size.
    """
    pool = rows if exclude is None else rows.join(exclude.select("org").distinct(), "org", "left_anti")
    kept = F.lit(False)
    if preserve is not None:
        pool = pool.join(preserve.select("org").distinct().withColumn("_kept", F.lit(True)), "org", "left")
        kept = F.coalesce("_kept", F.lit(False))
    key = F.when(kept, seeded_rank(seed, F.col("org"), "preserved")).otherwise(seeded_rank(seed, F.col("org")))
    chosen = pool.withColumns({"preserved": kept, "_key": key}).orderBy(F.col("preserved").desc(), "_key").limit(count)
    return chosen.drop("_key", "_kept")


def assign_splits(rows: DataFrame, seed: int, count: int | None = None, label: str = "order") -> DataFrame:
    """60 / 20 / 20 by hash position; ``count`` is the requested size the shares refer to.

    Without ``count`` the table's own size is used, from one aggregate.
    """
    numbered = number_by_hash(rows.withColumn("_key", seeded_rank(seed, F.col("org"), label)), "_key", "position")
    if count is None:
        numbered = with_totals(numbered, rows.agg(F.count(F.lit(1)).alias("_n")))
        size = F.col("_n")
    else:
        numbered, size = numbered.withColumn("_n", F.lit(count)), F.lit(count)
    first, second = F.bround(size * 0.6, 0), F.bround(size * 0.2, 0)
    split = F.when(F.col("position") <= first, "development").when(F.col("position") <= first + second, "validation").otherwise("held_out")
    return numbered.withColumn("evaluation_split", split).drop("_key", "_n")


def grouped_split(rows: DataFrame, seed: int, share: float, out: str = "is_test") -> DataFrame:
    """Whole entities on one side: the first ``share`` of entities by hash is the test side."""
    orgs = rows.select("org").distinct().withColumn("_key", seeded_rank(seed, F.col("org")))
    numbered = with_totals(number_by_hash(orgs, "_key", "_place"), orgs.agg(F.count(F.lit(1)).alias("_n")))
    wanted = F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    return rows.join(numbered.select("org", (F.col("_place") <= wanted).alias(out)), "org")


def stress_sample(rows: DataFrame, count: int, seed: int, population_share: float = 0.7, reservoir: int | None = None) -> DataFrame:
    """A population slice plus a stress slice with a few rows from every stratum."""
    size = round(count * population_share)
    stress = count - size
    reservoir = reservoir or max(30, count // 5)
    keyed = rows.withColumns({"stratum": stratum(), "_p": seeded_rank(seed, F.col("org"), "population"), "_s": seeded_rank(seed, F.col("org"), "stress")})
    population = keyed.orderBy("_p").limit(size).withColumn("sample_slice", F.lit("population"))
    rest = keyed.join(population.select("org"), "org", "left_anti")
    place = F.row_number().over(W.partitionBy("stratum").orderBy("_s"))
    held = rest.withColumn("_place", place).filter(F.col("_place") <= reservoir)
    strata = keyed.agg(F.count_distinct("stratum").alias("_strata"))
    minimum = F.greatest(F.lit(1), F.least(F.lit(3), F.floor(F.lit(stress) / F.col("_strata"))))
    chosen = (
        with_totals(held, strata)
        .withColumn("_late", F.col("_place") > minimum)
        .orderBy("_late", F.when(~F.col("_late"), F.col("stratum")), F.when(~F.col("_late"), F.col("_place")), "_s")
        .limit(stress)
        .withColumn("sample_slice", F.lit("stress"))
    )
    columns = [*rows.columns, "stratum", "sample_slice"]
    return population.select(*columns).unionByName(chosen.select(*columns))


def quota_sample(labelled: DataFrame, target: DataFrame, size: int, seed: int) -> DataFrame:
    """Labelled rows drawn so that strata match the target's shares, with their weights.

    Strata are (employee band of a known count, legal form). The quota of a stratum
    is its share of the target; a rank filter prunes each task before the shuffle.
    """

    def keyed(df: DataFrame) -> DataFrame:
        band = employee_band(F.coalesce("employees", F.lit(0)))
        return df.withColumn("stratum", F.concat_ws("|", band, F.coalesce("legal_form", F.lit("?"))))

    have, want = keyed(labelled), keyed(target)
    shares = want.groupBy("stratum").agg(F.count(F.lit(1)).alias("wanted"))
    shares = with_totals(shares, target.agg(F.count(F.lit(1)).alias("all_wanted")))
    pools = have.groupBy("stratum").agg(F.count(F.lit(1)).alias("pool"))
    pools = with_totals(pools, labelled.agg(F.count(F.lit(1)).alias("all_pool")))
    quotas = shares.join(pools, "stratum").select(
        "stratum", "wanted",
        F.greatest(F.lit(1), F.bround(F.lit(size) * F.col("wanted") / F.col("all_wanted"), 0)).cast("int").alias("quota"),
        F.round((F.col("wanted") / F.col("all_wanted")) / (F.col("pool") / F.col("all_pool")), 4).alias("stratum_weight"),
    )
    place = F.row_number().over(W.partitionBy("stratum").orderBy(seeded_rank(seed, F.col("org"))))
    ranked = have.withColumn("_place", place).filter(F.col("_place") <= size)
    drawn = ranked.join(quotas, "stratum").filter(F.col("_place") <= F.col("quota"))
    ordered = drawn.orderBy(F.col("wanted").desc(), "stratum", "_place").limit(size)
    return ordered.drop("_place", "quota", "wanted")


# Share of each spend tier in a mixed sample.
TIER_MIX = {"rich": 0.55, "standard": 0.30, "shell": 0.15}


def tier_mix_sample(rows: DataFrame, count: int, seed: int, tier: str = "tier", mix: dict[str, float] | None = None) -> DataFrame:
    """A fixed mix of tiers by hash, topped up from whatever remains."""
    mix = mix or TIER_MIX
    quota = F.coalesce(*[F.when(F.col(tier) == name, F.lit(round(count * share))) for name, share in mix.items()], F.lit(0))
    keyed = rows.withColumn("_key", seeded_rank(seed, F.col("org")))
    # No tier can give more than ``count`` rows, so the rank filter loses nothing.
    ranked = keyed.withColumn("_place", F.row_number().over(W.partitionBy(tier).orderBy("_key"))).filter(F.col("_place") <= count)
    return ranked.withColumn("_extra", F.col("_place") > quota).orderBy("_extra", "_key").limit(count).drop("_key", "_place", "_extra")


def unique_host_sample(
    rows: DataFrame, count: int, seed: int, exclude_orgs: DataFrame | None = None, exclude_hosts: DataFrame | None = None
) -> DataFrame:
    """One entity per website host in hash order, up to ``count`` hosts."""
    site = F.trim(F.coalesce("website", F.lit("")))
    full = F.when(F.contains(site, F.lit("://")), site).otherwise(F.concat(F.lit("https://"), site))
    pool = rows.withColumn("host", host(full)).filter((F.length(site) > 0) & (F.length("host") > 0))
    if exclude_orgs is not None:
        pool = pool.join(exclude_orgs.select("org").distinct(), "org", "left_anti")
    if exclude_hosts is not None:
        pool = pool.join(exclude_hosts.select("host").distinct(), "host", "left_anti")
    carried = [c for c in pool.columns if c != "host"]
    first = pool.groupBy("host").agg(
        F.min_by(F.struct(*carried), seeded_rank(seed, F.col("org"))).alias("row"), F.min(seeded_rank(seed, F.col("org"))).alias("_key")
    )
    return first.orderBy("_key").limit(count).select("host", "row.*")


def strata_counts(population: DataFrame, selected: DataFrame, key: Column | None = None) -> DataFrame:
    """Population and sample rows per stratum, with a total row whose stratum is NULL."""
    key = stratum() if key is None else key
    both = population.select(key.alias("stratum"), F.lit(0).alias("_picked")).unionAll(selected.select(key.alias("stratum"), F.lit(1)))
    return both.rollup("stratum").agg(
        F.count_if(F.col("_picked") == 0).alias("population"), F.count_if(F.col("_picked") == 1).alias("selected")
    )
