"""Every registered query gives the rows and types of its SQL."""

import compare
import pytest

import __spark_entry__ as contract
from mediacurate.plans import catalogue

# The corpus operators have tests of their own.
NAMES = sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_each_query_has_its_sql():
    assert set(NAMES) <= set(contract.queries()) and set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, db, name):
    df = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql()[name]
    assert compare.types_differ(df, db, sql) == []
    assert compare.spark_rows(df) == compare.duck_rows(db, sql)


def test_entry_has_the_output_columns(spark):
    from mediacurate.schemas import CAPTIONED

    df = contract.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CAPTIONED]
    assert df.count() == 95
