"""Queries against their SQL on tables with more copies than the given ones."""

import os

import __spark_entry__ as entry
import duckdb
import pytest
from compare import TABLES, compare, oracle

SF = "/root/testdata/sf0.001"
entry.queries()
from attesta.plans.catalog import CATALOG  # noqa: E402


def folder_with(path, **changed):
    """The smallest tables with some of them given by SQL over the others."""
    connection = oracle(SF)
    for name in TABLES:
        if name in changed:
            connection.execute(f"COPY ({changed[name]}) TO '{path}/{name}.parquet' (FORMAT parquet)")
        else:
            os.symlink(f"{SF}/{name}.parquet", f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def captured_again(tmp_path_factory):
    """Every page captured three times, each time with another size."""
    sizes = "CASE i WHEN 0 THEN html WHEN 1 THEN substr(html, 1, 2500) ELSE html || repeat(' x', 5000) END"
    return folder_with(tmp_path_factory.mktemp("pages"), pages=f"SELECT page_id + i * 1000 AS page_id, url, {sizes} AS html FROM pages, range(3) r(i)")


@pytest.mark.parametrize("name", ["merge_page_events", "merged_pages", "select_verified_site", "site_outcome", "best_scored_site", "website_origins"])
def test_captures_of_one_address_are_pages_of_their_own(spark, captured_again, name):
    report = compare(spark, oracle(captured_again), CATALOG[name], captured_again)
    assert report["status"] == "match" and report["rows"], report


def test_membership_reads_no_facts(spark):
    from attesta.operators import diffs

    old, new = (spark.createDataFrame([(o,) for o in rows], "org string") for rows in (["1", "1", "2", "3"], ["2", "2", "4"]))
    assert sorted(tuple(r) for r in diffs.membership_difference(old, new).collect()) == [("1", "previous_only"), ("3", "previous_only"), ("4", "current_only")]
    plan = CATALOG["membership_difference"].run(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Generate" not in plan and "max_by" not in plan  # each snapshot once, entities only
