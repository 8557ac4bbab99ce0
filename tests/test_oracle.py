"""Every registered query gives the rows its SQL gives."""

import pytest

import __spark_entry__ as entry_module
from compare import duck, duck_rows, spark_rows
from exposure.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duck_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_all_queries_are_registered():
    assert entry_module.queries().items() >= QUERIES.items()
    assert entry_module.oracle_sql().items() >= ORACLES.items()


def test_entry_is_the_flagship(spark):
    assert entry_module.entry(spark).columns == [
        "scan_id", "severity", "findings", "severity_rank", "label",
    ]
