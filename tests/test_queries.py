"""Every registered query against its SQL in another engine, at the smallest scale."""

import os

import __spark_entry__ as driver
import pytest
from check_oracles import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_all_queries_match_their_sql(spark):
    assert set(driver.ORACLES) == set(driver.QUERIES)
    outcomes = compare(spark, SF, list(driver.QUERIES))
    assert {n: o for n, o in outcomes.items() if not o.startswith("ok")} == {}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_the_flagship_query_runs(spark):
    rows = driver.entry(spark)
    assert rows.columns == ["id", "name", "seen_at"] and rows.count() > 0
