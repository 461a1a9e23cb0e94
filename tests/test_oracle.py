"""Every registered query against its plain SQL."""

import pytest

import __spark_entry__ as entry
from tallymark.plans import oracle, registry
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    rows = {r["finding_type"]: r["finding_count"] for r in entry.entry(spark).collect()}
    assert len(rows) == 6 and all(rows.values())
