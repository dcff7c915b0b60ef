from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import difference, oracle_connection
from shown import SF_DIR
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import CATALOGUE


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert CATALOGUE.keys() == ORACLE.keys()
    assert CATALOGUE.keys() <= entry.queries().keys() and entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_agrees_with_sql(spark, oracle, name):
    assert difference(spark, oracle, SF_DIR, CATALOGUE[name], ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
