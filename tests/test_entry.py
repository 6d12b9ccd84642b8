"""Driver contract: entry() smoke check and every registered query against
its DuckDB oracle on the smallest test tables."""
import os

import pytest

import __spark_entry__ as E
from scripts.check_oracle import compare, oracle_connection
from wharf.plans.registry import load_all

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["transaction_date", "accepted_count", "total_count", "acceptance_rate",
                          "dw_modified_at"]


def test_every_query_has_an_oracle():
    missing = set(load_all()) - set(E.oracle_sql())
    assert not missing, f"queries without oracle SQL: {sorted(missing)}"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_matches_oracle(spark, con, name):
    status, detail = compare(spark, con, SF, name, E.queries()[name], E.oracle_sql().get(name))
    assert status == "OK", detail
