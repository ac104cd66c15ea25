"""Every registered query against its SQL on the smallest tables."""

import __spark_entry__ as entry
import pytest

from tests.oracle import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_agrees_with_sql(spark, name):
    good, report = compare(spark, SMALL, name)
    assert good, report


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
