"""Every registered query against its SQL."""

import os

import pytest

from acceptance.check import compare, views
from acceptance.oracle import statements
from acceptance.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return views(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) == set(statements())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_sql(spark, database, name):
    assert compare(spark, database, SF_DIR, name) is None
