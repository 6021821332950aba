"""Every registered query against the same result in SQL."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, connection, name):
    assert difference(queries()[name](spark, FOLDER), connection, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["cv_scores"])
def test_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 19
