"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from moodtide.catalog.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 4
