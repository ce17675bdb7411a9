"""Registered queries against their SQL on the smallest given tables."""

import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from parity import compare  # noqa: E402
from parity.oracle import ORACLE  # noqa: E402
from parity.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not present")


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, con):
    assert compare.differences(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["Year_Ending", "Destination_RTO", "Trip_Type", "POV", "POV_Group",
                          "Total_Visitors", "Total_Trips", "Total_Respondents"]
    assert df.count() > 0
