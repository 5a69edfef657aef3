"""The lead ranker over parts and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import learning as op
from attesta.plans import views
from attesta.plans.catalog import bind, table

# Each part is an entity; its site is one of its own guesses, and every guess of another
# part's name resolves too.
REGISTER_SQL = """
reg AS (SELECT lpad(p_partkey::VARCHAR, 9, '0') AS org, p_name AS name, CASE WHEN p_size < 20 THEN replace(p_name, ' ', '') || '.no' WHEN p_size < 35 THEN replace(p_name, ' ', '-') || '.com' ELSE split_part(p_name, ' ', 1) || '.no' END AS truth, p_size FROM part),
v AS (SELECT org, truth, list_filter([replace(name, ' ', ''), replace(name, ' ', '-')] || CASE WHEN length(split_part(name, ' ', 1)) >= 4 THEN [split_part(name, ' ', 1)] ELSE [] END, lambda x: length(x) >= 3) AS labels FROM reg),
c AS (SELECT org, truth, unnest(labels) AS l, unnest(range(0, len(labels))) AS t FROM v),
h AS (SELECT org, truth, l, l || e AS candidate, t * 2 + i + 1 AS listed_rank FROM c, (VALUES ('.no', 0), ('.com', 1)) x(e, i)),
alive AS (SELECT DISTINCT truth AS host FROM reg),
ds AS (SELECT h.org, candidate, (candidate = truth)::INTEGER AS label, (candidate <> truth AND l = split_part(truth, '.', 1))::INTEGER AS excluded_negative, listed_rank FROM h JOIN alive ON host = candidate)
"""


def _dataset(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size")
    joined, dashed = F.replace("p_name", F.lit(" "), F.lit("")), F.replace("p_name", F.lit(" "), F.lit("-"))
    site = F.when(size < 20, F.concat(joined, F.lit(".no"))).when(size < 35, F.concat(dashed, F.lit(".com"))).otherwise(F.concat(F.substring_index("p_name", " ", 1), F.lit(".no")))
    register = part.select(
        views.padded(F.col("p_partkey")).alias("org"), F.col("p_name").alias("name"), site.alias("website"), size.alias("employees"), F.col("p_type").alias("legal_form"),
        F.lit(False).alias("bankrupt"), F.lit("2024").alias("latest_submitted_accounts"),
    )
    return op.ranker_dataset(register, register.select(F.col("website").alias("host")))


@bind("ranker_dataset", "J1", f"WITH {REGISTER_SQL} SELECT * FROM ds")
def ranker_dataset(spark, sf):
    return _dataset(spark, sf).select("org", "candidate", "label", "excluded_negative", "listed_rank")


@bind("train_ranker", "J2 J3")
def train_ranker(spark, sf):
    """Held-out scores of a model fitted on the other entities."""
    model, held_out = op.train_ranker(_dataset(spark, sf))
    return op.score_candidates(held_out, model).select("org", "candidate", "label", "probability")


# A fixed model, so that the scoring arithmetic has an exact check.
FIXED = op.RankerModel(["label_len", "trigram_jaccard", "has_hyphen", "legal_form=MEDIUM"], [8.0, 0.5, 0.2, 0.1], [2.0, 0.25, 0.4, 0.3], [-0.3, 1.7, -0.4, 0.2], -0.25, 1.2, 0.05)


@bind(
    "score_candidates",
    "J3",
    f"""WITH {REGISTER_SQL}, f AS (SELECT ds.org, candidate, length(regexp_replace(candidate, '\\.[^.]*$', '')) AS len, contains(candidate, '-')::INTEGER AS hy, p_type, replace(name, ' ', '') AS slug, regexp_replace(candidate, '\\.[^.]*$', '') AS core
  FROM ds JOIN reg USING (org) JOIN part ON lpad(p_partkey::VARCHAR, 9, '0') = ds.org),
t AS (SELECT *, list_distinct([substr(core, i, 3) FOR i IN range(1, length(core) - 1)]) AS x, list_distinct([substr(slug, i, 3) FOR i IN range(1, length(slug) - 1)]) AS y FROM f),
z AS (SELECT org, candidate, -0.25::DOUBLE + (len - 8) / 2.0::DOUBLE * -0.3 + (round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 4) - 0.5) / 0.25::DOUBLE * 1.7 + (hy - 0.2) / 0.4::DOUBLE * -0.4 + (CASE WHEN p_type = 'MEDIUM' THEN 1 ELSE 0 END - 0.1) / 0.3::DOUBLE * 0.2 AS z FROM t)
SELECT org, candidate, round(1 / (1 + exp(-(1.2::DOUBLE * z + 0.05))), 4) AS probability FROM z""",
)
def score_candidates(spark, sf):
    return op.score_candidates(_dataset(spark, sf), FIXED).select("org", "candidate", "probability")


def _scored(spark, sf):
    """Documents scored by their length, judged by their label."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return docs.select(F.col("quality").alias("label"), F.least(F.lit(0.99), F.floor(F.col("n_chars") / 30) / 100).alias("probability"))


SCORED_SQL = """
s AS (SELECT quality AS y, least(0.99, floor(n_chars / 30) / 100)::DOUBLE AS p FROM documents JOIN labels USING (doc_id)),
g AS (SELECT p, count(*) AS n, sum(y) AS pos FROM s GROUP BY p),
c AS (SELECT *, sum(n) OVER (ORDER BY p) AS cn, sum(pos) OVER (ORDER BY p) AS cp, sum(n) OVER () AS tn, sum(pos) OVER () AS tp FROM g)
"""


@bind(
    "ranker_metrics",
    "J4",
    f"""WITH {SCORED_SQL}, m AS (SELECT any_value(tn)::BIGINT AS rows, any_value(tp)::BIGINT AS positives, sum(pos * (cn - n + (n + 1) / 2)) AS rs, sum(pos * (tp - cp + pos) / (tn - cn + n)) AS st FROM c),
e AS (SELECT sum(n * abs(r - q)) AS gap FROM (SELECT least(9, floor(p * 10)) AS b, count(*) AS n, avg(y) AS r, avg(p) AS q FROM s GROUP BY 1))
SELECT rows, positives, round((rs - positives * (positives + 1) / 2) / (positives * (rows - positives)), 9)::DOUBLE AS roc_auc, round(st / positives, 9)::DOUBLE AS average_precision, round(gap / rows, 9)::DOUBLE AS ece FROM m, e""",
)
def ranker_metrics(spark, sf):
    row = op.ranker_metrics(_scored(spark, sf))
    return row.select("rows", "positives", *[F.round(c, 9).alias(c) for c in ("roc_auc", "average_precision", "ece")])


@bind(
    "threshold_table",
    "J4",
    f"""WITH {SCORED_SQL}, t(threshold) AS (VALUES (0.5::DOUBLE), (0.6), (0.7), (0.8), (0.9))
SELECT threshold, count(*) FILTER (p >= threshold) AS published, round(count(*) FILTER (p >= threshold AND y = 1) / nullif(count(*) FILTER (p >= threshold), 0), 9) AS precision,
  round(count(*) FILTER (p >= threshold AND y = 1) / sum(y), 9) AS recall FROM s, t GROUP BY threshold""",
)
def threshold_table(spark, sf):
    return op.threshold_table(_scored(spark, sf)).select("threshold", "published", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))
