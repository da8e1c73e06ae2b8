"""Every registered query against its SQL."""

import pytest
from compare import difference, tables

from __spark_entry__ import entry, oracle_sql, queries
from callweave.plans.oracles import ORACLES as SQL
from callweave.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return tables(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["event_type", "records", "fraud_records"]
