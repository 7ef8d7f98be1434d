"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

from checks.compare import oracle_rows, spark_rows
from checks.queries import queries
from checks.sql import oracle_sql

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, name):
    got = spark_rows(queries()[name](spark, SF_DIR))
    assert got == oracle_rows(SF_DIR, oracle_sql()[name])


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["n_regex_matches"]
