"""Every bound query against its SQL on the smallest tables."""

import __spark_entry__ as entry
import pytest
from compare import compare, oracle

SF = "/root/testdata/sf0.001"
entry.queries()
from attesta.plans.catalog import CATALOG  # noqa: E402


@pytest.fixture(scope="session")
def connection():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_its_sql(spark, connection, name):
    report = compare(spark, connection, CATALOG[name], SF)
    assert report["status"] in ("match", "rows-only"), report


def test_entry_and_contract(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
