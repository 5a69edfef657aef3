"""Screens: conjunctive filters with citations, and questions turned into filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.operators.ordering import dealt, number_in_ranges, number_within
from attesta.session import stored

# Screen fields, the column each reads and the evidence module behind it.
FIELD_MODULES = {
    "municipality": "registry", "legal_form": "registry", "employees": "registry", "industry": "registry",
    "revenue": "financials", "annual_result": "financials", "financials": "financials", "website": "website",
}
MAX_ROWS = 100  # of a parsed question; a caller of ``screen`` gets what it asks for


def screen_column(field: str) -> Column:
    if field == "industry":
        return F.concat_ws(" ", "industry_code", "industry_label")
    if field == "website":
        return F.coalesce(F.col("website_ok"), F.lit(False))
    if field == "financials":
        return F.coalesce(F.col("financials_ok"), F.lit(False))
    return F.col(field)


def criterion(field: str, operator: str, value) -> Column:
    """One filter; an unknown value never passes a comparison."""
    actual = screen_column(field)
    if operator == "eq":
        test = F.lower(F.coalesce(actual.cast("string"), F.lit(""))) == F.lit(str(value).lower())
    elif operator in ("present", "available"):
        test = actual.cast("boolean") == F.lit(bool(value))
    elif operator == "contains":
        test = F.contains(F.lower(F.coalesce(actual, F.lit(""))), F.lit(str(value).lower()))
    else:
        test = {">": actual > value, ">=": actual >= value, "<": actual < value, "<=": actual <= value, "=": actual == value}[operator]
    return F.coalesce(test, F.lit(False))


def screen(profiles: DataFrame, filters: list[tuple], sort: tuple | None = None) -> DataFrame:
    """Profiles passing every (field, operator, value); ``sort`` is (field, limit).

    With a sort the answer is the top rows, unknown values last, ties by entity.
    """
    tests = [criterion(*f) for f in filters]
    hits = profiles.filter(reduce(lambda a, b: a & b, tests)) if tests else profiles
    return top_screen(hits, *sort) if sort else hits


def top_screen(rows: DataFrame, field: str, limit: int) -> DataFrame:
    return rows.orderBy(F.col(field).desc_nulls_last(), F.col("org")).limit(limit)


def cited_modules(filters: list[tuple], sort: tuple | None = None) -> list[str]:
    modules = {FIELD_MODULES[f[0]] for f in filters}
    if sort:
        modules.add("financials" if sort[0] == "revenue" else "registry")
    return sorted(modules)


def with_citations(hits: DataFrame, module_evidence: DataFrame, modules: list[str]) -> DataFrame:
    """One row per (hit, used module) with its source; a module without evidence keeps NULLs."""
    wanted = hits.withColumn("module", F.explode(F.array(*[F.lit(m) for m in modules])))
    cited = module_evidence.filter(F.col("module").isin(modules)).select("org", "module", "source_url", "retrieved_at", "content_sha256")
    return wanted.join(cited, ["org", "module"], "left")


# Terms a screen must refuse, phrases of comparison, units.
REFUSED_TERMS = {
    "sentiment": "sentiment is not qualified",
    "glassdoor": "Glassdoor data is not available through a permitted connector",
    "linkedin": "LinkedIn-derived employee data is not available through a permitted connector",
    "traffic": "website traffic is not available through a qualified provider",
    "reviews": "review data is not available through a qualified provider",
    "buzz": "social buzz is not available through a qualified provider",
    "without a website": "missing or unverified website evidence does not prove that a company has no website",
    "fraudulent": "fraud assessment is not available through an authoritative public connector",
}
COMPARISONS = {
    "more than": ">", "over": ">", "above": ">", "at least": ">=",
    "fewer than": "<", "less than": "<", "under": "<", "at most": "<=",
}
# Patterns of the criteria in a question.
MUNICIPALITY = r"\b(?:in|municipality(?:\s+is|\s*=)?)\s+([a-zæøåéü .'-]+?)(?=\s+(?:with|and|having|that|where|top)\b|$)"
LEGAL_FORM = r"\b(?:legal\s+form|organisation\s+form)\s*(?:is|=)?\s*(asa|as|enk|nuf|ans|da|sa|sti|brl)\b"
STAFF = [
    r"\b(more than|over|above|at least|fewer than|less than|under|at most)\s+(\d+)\s+(?:registered\s+)?employees?\b",
    r"\bemployees?\s*(>=|<=|>|<|=)\s*(\d+)\b",
]
REVENUE = [
    r"\brevenue\s*(>=|<=|>|<|=|more than|over|above|at least|fewer than|less than|under|at most)\s*(?:nok\s*)?([\d.,]+)\s*(billion|million|bn|m)?\b",
    r"\b(more than|over|above|at least|fewer than|less than|under|at most)\s*(?:nok\s*)?([\d.,]+)\s*(billion|million|bn|m)?\s+revenue\b",
]
LOSS, PROFIT = r"\bunprofitable|loss[- ]making|negative annual result\b", r"\bprofitable|positive annual result\b"
HAS_SITE = r"\b(?:with|has|have|that have)\s+(?:an?\s+)?(?:official\s+)?website\b"
HAS_ACCOUNTS = r"\b(?:with|has|have|that have)\s+(?:annual\s+)?accounts\b"
INDUSTRY = r"(?i)\bindustry(?:\s+contains|\s+is|\s*=)?\s+[\"']([^\"']+)[\"']"
TOP = r"\btop\s+(\d+)\s+by\s+(revenue|employees)\b"


def plan_screens(questions: DataFrame) -> DataFrame:
    """(query) → filters, sort, refusals and whether the screen can run.

    A question with a refused term, or without any known criterion, is not executable.
    """
    text = F.trim(F.regexp_replace("query", r"\s+", " "))
    q = F.lower(text)

    def part(patterns: list[str] | str, group: int) -> Column:
        patterns = [patterns] if isinstance(patterns, str) else patterns
        return F.coalesce(*[F.nullif(F.regexp_extract(q, p, group), F.lit("")) for p in patterns])

    def operator(column: Column) -> Column:
        known = F.create_map(*[F.lit(v) for pair in COMPARISONS.items() for v in pair])
        return F.coalesce(F.try_element_at(known, column), column)

    def made(field: str, op: Column | str, value: Column) -> Column:
        op = F.lit(op) if isinstance(op, str) else op
        entry = F.struct(F.lit(field).alias("field"), op.alias("operator"), value.cast("string").alias("value"), F.lit(FIELD_MODULES[field]).alias("evidence_module"))
        return F.when(value.isNotNull(), entry)

    # A number must come from the pattern its operator came from.
    staff_first = F.regexp_extract(q, STAFF[0], 1) != ""
    staff_op = F.when(staff_first, F.regexp_extract(q, STAFF[0], 1)).otherwise(F.nullif(F.regexp_extract(q, STAFF[1], 1), F.lit("")))
    staff = F.when(staff_first, F.regexp_extract(q, STAFF[0], 2)).otherwise(F.nullif(F.regexp_extract(q, STAFF[1], 2), F.lit("")))
    revenue_first = F.regexp_extract(q, REVENUE[0], 1) != ""

    def money(group: int) -> Column:
        return F.when(revenue_first, F.regexp_extract(q, REVENUE[0], group)).otherwise(F.regexp_extract(q, REVENUE[1], group))

    unit = F.when(money(3).isin("billion", "bn"), 1e9).when(money(3).isin("million", "m"), 1e6).otherwise(1.0)
    amount = F.replace(F.nullif(money(2), F.lit("")), F.lit(","), F.lit(".")).try_cast("double") * unit
    sign = F.when(q.rlike(LOSS), "<").when(q.rlike(PROFIT), ">")
    filters = F.array_compact(
        F.array(
            made("municipality", "eq", F.upper(F.trim(part(MUNICIPALITY, 1)))),
            made("legal_form", "eq", F.upper(part(LEGAL_FORM, 1))),
            made("employees", operator(staff_op), staff),
            made("revenue", operator(money(1)), amount),
            made("annual_result", sign, F.when(sign.isNotNull(), 0)),
            made("website", "present", F.when(q.rlike(HAS_SITE), "true")),
            made("financials", "available", F.when(q.rlike(HAS_ACCOUNTS), "true")),
            made("industry", "contains", F.lower(F.nullif(F.regexp_extract(text, INDUSTRY, 1), F.lit("")))),
        )
    )
    top = part(TOP, 1)
    sort = F.when(top.isNotNull(), F.struct(part(TOP, 2).alias("field"), F.least(F.lit(MAX_ROWS), top.cast("int")).alias("limit")))
    refused = F.array_compact(F.array(*[F.when(F.contains(q, F.lit(t)), F.lit(m)) for t, m in REFUSED_TERMS.items()]))
    planned = questions.select(*[c for c in questions.columns if c != "query"], text.alias("query"), filters.alias("filters"), sort.alias("sort"), refused.alias("unsupported"))
    return planned.withColumn("executable", ((F.size("filters") > 0) | F.col("sort").isNotNull()) & (F.size("unsupported") == 0))


def plan_parts(row) -> tuple[list[tuple], tuple | None]:
    """Typed filters and sort of one planned question."""
    typed = {"employees": int, "revenue": float, "annual_result": float}
    filters = [(f["field"], f["operator"], typed.get(f["field"], str)(float(f["value"])) if f["field"] in typed else f["value"]) for f in row["filters"]]
    return filters, (row["sort"]["field"], row["sort"]["limit"]) if row["sort"] else None


def answer_screen(profiles: DataFrame, question: str) -> DataFrame:
    """Run one question; an abstaining plan gives an empty answer. Only the plan reaches the driver."""
    spark = profiles.sparkSession
    row = plan_screens(spark.createDataFrame([(question,)], "query string")).first()
    if not row["executable"]:
        return profiles.limit(0)
    filters, sort = plan_parts(row)
    return screen(profiles, filters, sort)


# ---- many screens at once ----

BINS = 64
NUMERIC = ("employees", "revenue", "annual_result")
COMPARED = (">", ">=", "<", "<=", "=")
SPREAD = 16  # parts of a common value's entities


def fact_lists(profiles: DataFrame) -> DataFrame:
    """Profiles with ``facts``: (field, text, number) of every screen field; NULL numbers have no entry, as they pass no comparison."""
    text = lambda f: F.lower(F.coalesce(screen_column(f).cast("string"), F.lit("")))
    number = lambda f: screen_column(f).cast("double") if f in NUMERIC else F.lit(None).cast("double")
    entry = lambda f: F.struct(F.lit(f).alias("field"), text(f).alias("text"), number(f).alias("number"))
    entries = [F.when(number(f).isNotNull(), entry(f)) if f in NUMERIC else entry(f) for f in FIELD_MODULES]
    return profiles.select("org", F.col("revenue").cast("double").alias("_revenue"), F.col("employees").cast("double").alias("_employees"), F.array_compact(F.array(*entries)).alias("facts"))


def rules_of(planned: DataFrame) -> DataFrame:
    """(query, rule, field, operator, value, number) of every filter of the screens that can run, each once; ``rule`` stands for the rest."""
    rows = planned.filter("executable").select("query", F.explode("filters").alias("f"))
    rows = rows.select("query", "f.field", "f.operator", F.lower("f.value").alias("value"), F.col("f.value").try_cast("double").alias("number"))
    return rows.withColumn("rule", F.to_json(F.struct("field", "operator", "value"))).distinct()


def _bins(values: DataFrame) -> DataFrame:
    """(field, edges, total): cut points of each numeric field and its number of facts, one row per field."""
    shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    edges = F.array_distinct(F.percentile_approx("number", shares, F.lit(1000)))
    return values.filter("number IS NOT NULL").groupBy("field").agg(edges.alias("edges"), F.sum("n").alias("total"))


def _bin(edges: Column, number: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e <= number))


def _reach() -> Column:
    """The bins of its field that hold values a comparison can accept."""
    low, high = _bin(F.col("edges"), F.col("number")), F.size("edges")
    return (
        F.when(F.col("operator").isin(">", ">="), F.sequence(low, high)).when(F.col("operator").isin("<", "<="), F.sequence(F.lit(0), low)).otherwise(F.array(low))
    )


def passes(operator: Column, value: Column, wanted: Column, text: Column, actual: Column) -> Column:
    """Whether a fact's text or number satisfies a rule; what is unknown does not."""
    compare = {">": actual > wanted, ">=": actual >= wanted, "<": actual < wanted, "<=": actual <= wanted, "=": actual == wanted}
    test = F.when(operator == "eq", text == value).when(operator.isin("present", "available"), text == value.cast("boolean").cast("string")).when(operator == "contains", F.contains(text, value))
    for name, holds in compare.items():
        test = test.when(operator == name, holds)
    return F.coalesce(test, F.lit(False))


RULE = ["rule", "field", "operator", "value", "number"]


def _named(rules: DataFrame, values: DataFrame) -> DataFrame:
    """(rule, text, n): the distinct values that satisfy a rule on texts."""
    mine = values.select("field", "text", "n")
    eq = rules.filter(F.col("operator") == "eq").withColumn("text", F.col("value"))
    flags = rules.filter(F.col("operator").isin("present", "available")).withColumn("text", F.col("value").cast("boolean").cast("string"))
    parts = rules.filter(F.col("operator") == "contains").join(mine, "field").filter(F.contains("text", "value"))
    return eq.unionByName(flags).join(mine, ["field", "text"]).unionByName(parts)


def _ranged(rules: DataFrame, values: DataFrame, bins: DataFrame) -> DataFrame:
    """(rule, text): the distinct values that satisfy a comparison; a rule meets values of the bins it reaches only."""
    placed = values.filter("number IS NOT NULL").join(bins, "field").select("field", "text", F.col("number").alias("actual"), _bin(F.col("edges"), F.col("number")).alias("bin"))
    spread = rules.filter(F.col("operator").isin(*COMPARED) & F.col("number").isNotNull()).join(bins, "field").select(*RULE, F.explode(_reach()).alias("bin"))
    return spread.join(placed, ["field", "bin"]).filter(passes(F.col("operator"), F.col("value"), F.col("number"), F.col("text"), F.col("actual")))


def rarest_rules(rules: DataFrame, values: DataFrame, bins: DataFrame) -> DataFrame:
    """(query, rule): of each query the rule that the fewest entities satisfy. Comparisons are estimated by their bins; one that nothing satisfies is rarest."""
    distinct = rules.select(*RULE).distinct()
    named = _named(distinct, values).groupBy("rule").agg(F.sum("n").cast("double").alias("weight"))
    share = F.size(_reach()) / (F.size("edges") + 1) * F.col("total")
    ranged = distinct.filter(F.col("operator").isin(*COMPARED) & F.col("number").isNotNull()).join(bins, "field").select("rule", share.alias("weight"))
    weighed = rules.join(named.unionByName(ranged), "rule", "left")
    best = F.struct(F.coalesce("weight", F.lit(0.0)), "rule")
    return weighed.groupBy("query").agg(F.min_by(F.struct(*RULE), best).alias("r")).select("query", "r.*")


def screen_many(profiles: DataFrame, planned: DataFrame) -> DataFrame:
    """(query, org, place) of all screens in one job; ``place`` counts from 1 in the screen's order.

    ``planned`` is a table of plans as ``plan_screens`` makes it. The rarest rule of a screen leads through the distinct values that
    satisfy it to their entities, and these are tested on its other rules; so the work grows with the rarest rules' entities and not
    with those of all rules. Order and limit are those of ``screen``. A screen without rules is a plain top list, at most MAX_ROWS long.
    """
    # Entities by ranges of their id: a screen without a sort counts its places by them.
    listed = dealt(fact_lists(profiles), ["org"], "_bucket")
    facts = listed.select("*", F.inline("facts"))
    values = stored(facts.groupBy("field", "text", "number").agg(F.count(F.lit(1)).alias("n")), "screen-values")
    rules, bins = rules_of(planned), _bins(values)
    plans = stored(planned.filter("executable").select("query", "sort").dropDuplicates(["query"]).withColumn("_q", F.monotonically_increasing_id()), "screen-plans")
    own = rules.groupBy("query").agg(F.collect_list(F.struct(*RULE)).alias("rules"))
    led = rarest_rules(rules, values, bins)
    distinct = led.select(*RULE).distinct()
    met = _named(distinct, values).select("rule", "text").unionByName(_ranged(distinct, values, bins).select("rule", "text"))
    leads = led.select("query", "rule", "field").join(met, "rule").drop("rule").join(own, "query").join(plans, "query").drop("query")
    leads = leads.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    spread = facts.withColumn("_part", F.pmod(F.xxhash64("org"), F.lit(SPREAD)).cast("int"))
    fact = lambda r: F.get(F.filter("facts", lambda x: x["field"] == r["field"]), 0)
    tested = F.forall("rules", lambda r: passes(r["operator"], r["value"], r["number"], fact(r)["text"], fact(r)["number"]))
    by = F.when(F.col("sort.field") == "revenue", F.col("_revenue")).when(F.col("sort.field") == "employees", F.col("_employees"))
    hits = leads.join(spread, ["field", "text", "_part"]).filter(tested).select(
        "_q", "org", "_bucket", F.col("sort").isNotNull().alias("_sorted"), (F.col("sort").isNotNull() & by.isNull()).alias("_last"), F.coalesce(-by, F.lit(0.0)).alias("_down"), F.col("sort.limit").alias("_limit")
    )
    hits = stored(hits, "screen-hits")
    plain = number_in_ranges(hits.filter("NOT _sorted").select("_q", "org", "_bucket"), ["_q"], ["org"], "place")
    ranked = number_within(hits.filter("_sorted").drop("_bucket"), ["_q"], ["_last", "_down", "org"], "place").filter(F.col("_limit").isNull() | (F.col("place") <= F.col("_limit")))
    found = plain.select("_q", "org", "place").unionByName(ranked.select("_q", "org", "place")).join(plans.select("_q", "query"), "_q")
    bare = plans.join(own, "query", "left_anti").select("query", F.col("sort.field").alias("_field"), F.col("sort.limit").alias("_limit"))
    order = lambda f: W.partitionBy("_field").orderBy(F.col(f).desc_nulls_last(), "org")
    tops = [top_screen(profiles, f, MAX_ROWS).withColumn("_field", F.lit(f)).select("org", "_field", F.row_number().over(order(f)).alias("place")) for f in ("revenue", "employees")]
    lists = bare.join(tops[0].unionByName(tops[1]), "_field").filter(F.col("place") <= F.col("_limit"))
    return found.select("query", "org", "place").unionByName(lists.select("query", "org", "place"))


def cite_many(hits: DataFrame, planned: DataFrame, module_evidence: DataFrame) -> DataFrame:
    """One row per (query, org, used module) with its source; a module without evidence keeps NULLs."""
    by_sort = F.when(F.col("sort").isNotNull(), F.array(F.when(F.col("sort.field") == "revenue", "financials").otherwise("registry"))).otherwise(F.array().cast("array<string>"))
    used = planned.filter("executable").select("query", F.explode(F.array_distinct(F.concat(F.transform("filters", lambda f: f["evidence_module"]), by_sort))).alias("module")).distinct()
    evidence = module_evidence.select("org", "module", "source_url", "retrieved_at", "content_sha256")
    return hits.join(used, "query").join(evidence, ["org", "module"], "left")


def evaluate_screens(expected: DataFrame, members: DataFrame, planned: DataFrame, hits: DataFrame, cited: DataFrame) -> DataFrame:
    """Per expected question: exact ordered membership, exact plan, complete citations, abstention.

    ``expected`` is (query, expected_filter_fields, must_abstain) and ``members`` (query, place, org); ``planned``, ``hits`` and ``cited``
    are what ``plan_screens``, ``screen_many`` and ``cite_many`` give. Answers are compared row by row, not as lists.
    """
    want = members.select("query", "place", "org", F.lit(1).alias("_want"))
    got = hits.select("query", "place", "org", F.lit(1).alias("_got"))
    met = want.join(got, ["query", "place", "org"], "full").groupBy("query").agg(
        F.bool_and(F.col("_want").isNotNull() & F.col("_got").isNotNull()).alias("_same"), F.count("_got").alias("results")
    )
    proofs = cited.groupBy("query").agg(F.bool_and(F.col("source_url").isNotNull() & F.col("retrieved_at").isNotNull() & F.col("content_sha256").isNotNull()).alias("_full"))
    plans = planned.dropDuplicates(["query"]).select("query", F.transform("filters", lambda f: f["field"]).alias("_fields"), (~F.col("executable")).alias("abstained"))
    rows = expected.join(plans, "query", "left").join(met, "query", "left").join(proofs, "query", "left")
    abstained = F.coalesce("abstained", F.lit(False))
    return rows.select(
        "query", F.coalesce("results", F.lit(0)).alias("results"), F.coalesce("_same", F.lit(True)).alias("membership_exact"),
        F.coalesce(F.col("_fields") == F.col("expected_filter_fields"), F.lit(False)).alias("plan_exact"), F.coalesce("_full", F.lit(True)).alias("citations_complete"),
        abstained.alias("abstained"), F.coalesce("must_abstain", F.lit(False)).alias("must_abstain"),
    )


# What each part of the evaluation is worth.
POINTS = {"cross_company_screening": 3, "exact_inspectable_filters": 2, "unsupported_abstention": 1, "provenance_export": 1}


def screen_points(evaluated: DataFrame) -> DataFrame:
    """One row: the points of each part, their sum and whether the set qualifies.

    Shares are over the questions that must be answered; every one that must not has to be refused, and there has to be one.
    """
    asked = ~F.col("must_abstain")
    share = lambda c: F.coalesce(F.try_divide(F.count_if(asked & F.col(c)), F.count_if(asked)), F.lit(0.0))
    refused = F.coalesce(F.bool_and(F.when(F.col("must_abstain"), F.col("abstained"))), F.lit(False))
    cited = F.coalesce(F.bool_and(F.when(asked, F.col("citations_complete"))), F.lit(False))
    row = evaluated.agg(
        F.count(F.lit(1)).alias("questions"), share("membership_exact").alias("screen_rate"), share("plan_exact").alias("plan_rate"), refused.alias("refused"), cited.alias("cited")
    )
    worth = lambda part, value: (F.lit(float(POINTS[part])) * value).alias(part)
    row = row.select(
        "questions", worth("cross_company_screening", F.col("screen_rate")), worth("exact_inspectable_filters", F.col("plan_rate")),
        worth("unsupported_abstention", F.col("refused").cast("double")), worth("provenance_export", F.col("cited").cast("double")),
    )
    score = reduce(lambda a, b: a + b, [F.col(p) for p in POINTS])
    return row.select("*", score.alias("score"), F.lit(float(sum(POINTS.values()))).alias("maximum"), (score == sum(POINTS.values())).alias("qualification_passed"))
