"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
#: Queries of the training-data operators are held against plain Python in their own tests.
QUERIES = {n: q for n, q in contract.queries().items() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    assert name in ORACLES
    verdict = compare(spark, duck, SF, name, QUERIES, ORACLES)
    assert verdict.startswith("ok"), verdict


def test_entry_is_the_spread_analysis(spark):
    assert contract.entry(spark).count() == 24


@pytest.mark.parametrize("name", [
    n for n in QUERIES if not n.startswith(("stream_", "store_", "export_", "scan_csv",
                                            "metrics_v1", "contract_price_csv", "relative_value", "scan_quotes_day",
                                            "option_ingest", "option_refresh"))])
def test_no_cross_joins(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
