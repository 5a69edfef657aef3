"""Costly work on small inputs: dealt to every core, and done once however often a filter or a column names it."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from attesta.functions.text import names_match
from attesta.plans.catalog import CATALOG
from attesta.session import fixed, spread


def plan(spark, name):
    entry.queries()
    return CATALOG[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_partition_are_spread(spark):
    rows = spark.range(1000).coalesce(1)
    dealt = spread(rows, "id")
    assert dealt.rdd.getNumPartitions() >= 8 and sorted(r.id for r in dealt.collect()) == list(range(1000))


def test_a_filter_stays_above_fixed_columns(spark):
    rows = spark.range(10).withColumn("x", F.regexp_replace(F.col("id").cast("string"), "1", "y"))
    kept = fixed(rows).filter("x = 'y'")
    assert [tuple(r) for r in kept.collect()] == [(1, "y")]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_names_are_folded_once():
    assert str(names_match(F.col("a"), F.col("b"))).count("translate(") == 2


@pytest.mark.parametrize("name", ["employer_search_claims", "promote_leads", "handle_observations", "score_candidates", "ats_listings"])
def test_searches_are_spread(spark, name):
    assert "REPARTITION_BY_NUM" in plan(spark, name)


@pytest.mark.parametrize("name", ["profile_page_metrics", "site_jobs"])
def test_pages_are_spread(spark, name):
    assert "REPARTITION_BY_NUM" in plan(spark, name)


def test_matched_names_are_dealt_at_each_step(spark):
    """Ads, their keys and the pairs found, so no task makes all pairs distinct, however few bytes the ads have."""
    assert plan(spark, "match_employer_names").count("REPARTITION_BY_NUM") >= 3


def test_scripts_of_pages_are_spread_for_the_walk(spark):
    """Scripts, not pages, are dealt by number; a page without one is not dealt."""
    from attesta.functions import markup

    pages = spark.createDataFrame([(f"p{i}", f'<script type="application/ld+json">{{"@type": "Thing", "x": [1, {{"@type": ["a/B"], "y": null}}], "n": {i}}}</script>') for i in range(400)] + [("q", "<p>none</p>")], "url string, html string").coalesce(1)
    nodes = markup.jsonld_nodes(pages, "url")
    assert len(nodes.inputFiles()) >= 8
    rows = sorted(nodes.select("page_key", "pos", "types").collect())
    assert rows == sorted((f"p{i}", pos, types) for i in range(400) for pos, types in ((0, ["Thing"]), (1, ["B"])))


def test_words_that_no_name_has_are_left_out_once(spark, tmp_path):
    """Articles are dealt, folded as whole texts, and their words that meet no name are dropped before the joins."""
    from pathlib import Path

    from attesta.operators import resolve
    from attesta.session import checkpoint_folder

    rows = [(1, "Blåbær", "og Teknikk samarbeider " + "annet ord her"), (2, "", "BLABAER TEKNIKK 974760673 x"), (3, None, "½ … teknikk Blåbær"), (4, "t", None)]
    articles = spark.createDataFrame(rows, "item int, title string, text string")
    profiles = spark.createDataFrame([("974760673", "Blåbær Teknikk AS")], "org string, name string")
    folder = Path(checkpoint_folder(spark).removeprefix("file:"))
    before = set(folder.glob("shared-words-*"))
    found = resolve.news_proximity(profiles, articles).collect()
    (shared,) = set(folder.glob("shared-words-*")) - before
    assert sorted((r.item, r.org, r.score) for r in found) == [(1, "974760673", 0.95), (2, "974760673", 1.0), (3, "974760673", 0.95)]
    assert {r.token for r in spark.read.parquet(str(shared)).collect()} == {"blabaer", "teknikk"}
