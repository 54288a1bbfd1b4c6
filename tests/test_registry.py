"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, difference


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


QUERIES = sorted(contract.queries().keys() - contract.text_queries().keys())


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == contract.oracle_sql().keys() - contract.text_oracle_sql().keys()


def test_entry_gives_rows_with_a_stable_schema(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "platform",
        "release_year",
        "avg_tmdb_popularity",
        "avg_tmdb_popularity_is_nan",
        "avg_imdb_score",
    ]
    assert result.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, oracle, name):
    result = contract.queries()[name](spark, sf_dir)
    assert difference(result, oracle, contract.oracle_sql()[name]) is None
