"""Every core query beside its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from tallyloom.plans import catalogue
from tests.oracle import duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_rows_equal_sql(spark, name):
    assert spark_rows(catalogue.QUERIES[name](spark, FOLDER)) == duck_rows(catalogue.ORACLES[name], FOLDER)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES.keys() - catalogue.ORACLES.keys()))
def test_queries_without_sql_run(spark, name):
    assert catalogue.QUERIES[name](spark, FOLDER).columns
