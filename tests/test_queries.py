import pytest

import __spark_entry__ as entry_points
import compare
from conftest import SF_DIR
from sangam.plans import catalogue, oracle


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(oracle.sql())
    assert set(catalogue.QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert compare.spark_rows(df) == compare.duck_rows(duck, entry_points.oracle_sql()[name])
