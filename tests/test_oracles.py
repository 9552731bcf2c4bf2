"""Every registered query against its SQL, on the smallest data set (the driver repeats this on a larger one)."""

from __future__ import annotations

import os

import pytest

from oracle_compare import compare, connect
from plumbline.plans.star import all_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no star-schema data here")
@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_sql(spark, con, name):
    problem, _ = compare(spark, con, FOLDER, all_queries()[name])
    assert not problem, problem


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert all_queries().keys() <= e.oracle_sql().keys() <= e.queries().keys()
    assert e.entry(spark).limit(1).count() == 1
